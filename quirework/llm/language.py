"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters in lower case and blanks between words give n-grams of one to three characters,
hashed into buckets. Counts of all training texts are summed by language and bucket, first
in each task. The matrix of log-probabilities (languages x buckets) is sent to all tasks;
there each text is a sparse row of bucket counts, scored by a product with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm.words import groups_of_texts, values_of

UNKNOWN = "und"
ORDERS = (1, 2, 3)
#: Texts of more characters are counted in pieces of this length.
LONG = 1 << 18


def held_out(id_col: Column, parts: int = 5) -> Column:
    """Whether a row is kept from training: by the CRC-32 of its id as text (null: empty)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts == 0


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts, and how many each text has."""
    counts = np.array([len(t) for t in texts], np.int64)
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), counts


def gram_buckets(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all texts' n-grams, and the place of each text's first one (and the end)."""
    points, counts = code_points([f" {(t or '').lower()} " for t in texts])
    text = np.repeat(np.arange(len(texts)), counts)
    letter = letters()[points]
    # One blank stands for all that is between two letters.
    keep = letter | np.concatenate(([True], letter[:-1]))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    keep[first] = True
    points, text = np.where(letter, points, np.uint32(32))[keep], text[keep]
    found, owners = [], []
    hashed = np.zeros(len(points), np.uint32)
    for order in ORDERS:
        at = len(points) - order + 1
        if at <= 0:
            break
        hashed = hashed[:at] * np.uint32(0x9E3779B1) + points[order - 1 :] + np.uint32(order)
        inside = text[:at] == text[order - 1 :]
        value = hashed ^ (hashed >> np.uint32(15))
        value = value * np.uint32(0x85EBCA6B)
        found.append(((value >> np.uint32(8)) % np.uint32(buckets))[inside])
        owners.append(text[:at][inside])
    out, limits = np.empty(sum(map(len, found)), np.int64), np.zeros(len(texts) + 1, np.int64)
    sizes = [np.bincount(o, minlength=len(texts)) for o in owners]
    np.cumsum(sum(sizes), out=limits[1:])
    # Each order's n-grams are in order of text; put a text's three runs side by side.
    begin = limits[:-1].copy()
    for values, size in zip(found, sizes, strict=True):
        within = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begin, size) + within] = values
        begin += size
    return out, limits


def long_counts(text: str, buckets: int) -> tuple[np.ndarray, bool]:
    """How often each bucket occurs in a text of any length, and whether it has a letter."""
    lowered = f" {text.lower()} "
    total, has_letter = np.zeros(buckets, np.int64), False
    before, tail = True, np.zeros(0, np.uint32)
    for at in range(0, len(lowered), LONG):
        points = code_points([lowered[at : at + LONG]])[0]
        letter = letters()[points]
        keep = letter | np.concatenate(([before], letter[:-1]))
        before, has_letter = bool(letter[-1]), has_letter or bool(letter.any())
        # The last two of the piece before, for the n-grams that go on from there.
        kept = np.concatenate((tail, np.where(letter, points, np.uint32(32))[keep]))
        hashed = np.zeros(len(kept), np.uint32)
        for order in ORDERS:
            n = len(kept) - order + 1
            if n <= 0:
                break
            hashed = hashed[:n] * np.uint32(0x9E3779B1) + kept[order - 1 :] + np.uint32(order)
            new = hashed[max(len(tail) - order + 1, 0) :]
            value = (new ^ (new >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            total += np.bincount((value >> np.uint32(8)) % np.uint32(buckets), minlength=buckets)
        tail = kept[-2:]
    return total, has_letter


def text_counts(texts: list[str | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """For each text its buckets, how often each occurs, and whether the text has a letter."""
    short = [t if len(t or "") <= LONG else None for t in texts]
    grams, limits = gram_buckets(short, buckets)
    points, counts = code_points([t or "" for t in short])
    ends = np.cumsum(counts)
    seen = np.concatenate(([0], np.cumsum(letters()[points])))
    has_letter = (seen[ends] > seen[ends - counts]).tolist()
    for k, text in enumerate(texts):
        own, known = grams[limits[k] : limits[k + 1]], has_letter[k]
        if len(text or "") > LONG:
            n, known = long_counts(text, buckets)
        elif len(own) * 8 < buckets:
            yield *np.unique(own, return_counts=True), known
            continue
        else:
            n = np.bincount(own, minlength=buckets)
        at = np.flatnonzero(n)
        yield at, n[at], known


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    buckets: int = 1 << 14,
    smoothing: float = 0.5,
    most_languages: int = 200,
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log priors and log-probabilities (languages x buckets), of all rows.

    Rows with a null text or language teach nothing. The model, of `buckets` numbers for
    each language, comes to the driver; over `most_languages` is an error.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )

    def count(batches):
        sums: dict[str, np.ndarray] = {}

        def rows_of(lang):
            n = sums.pop(lang)
            at = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"]
            )

        for batch in batches:
            langs = batch["lang"].to_pylist()
            for first, texts in groups_of_texts(values_of(batch["text"])):
                for k, (at, n, _) in enumerate(text_counts(texts, buckets)):
                    own = sums.setdefault(langs[first + k], np.zeros(buckets + 1, np.int64))
                    own[at] += n
                    own[buckets] += 1  # texts
            while len(sums) > most_languages:
                yield rows_of(next(iter(sums)))
        while sums:
            yield rows_of(next(iter(sums)))

    sums = (
        rows.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = sums.limit((most_languages + 1) * (buckets + 1)).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    if len(langs) > most_languages:
        raise ValueError(f"over {most_languages} languages to learn")
    counts = np.zeros((len(langs), buckets + 1))
    place = {name: k for k, name in enumerate(langs)}
    row = np.array([place[x] for x in found["lang"].to_pylist()], np.int64)
    counts[row, found["bucket"].to_numpy()] = found["n"].to_numpy()
    priors = np.log(counts[:, -1]) - np.log(max(counts[:, -1].sum(), 1))
    smooth = counts[:, :-1] + smoothing
    return langs, priors, np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `lang_pred`, `score` (its posterior probability) for each row.

    Texts that are null or without a letter, and all texts if nothing was learnt, are
    `und` with score 0. Equal scores go to the first language. A long text is counted in
    pieces, whose memory doesn't grow with it; the result is that of the whole.
    """
    langs, priors, logs = model
    sent = docs.sparkSession.sparkContext.broadcast((priors, np.ascontiguousarray(logs.T)))
    buckets = logs.shape[1]

    def run(batches):
        priors, table = sent.value
        for batch in batches:
            names, scores = [], []
            for _, texts in groups_of_texts(values_of(batch["text"])):
                for at, n, known in text_counts(texts, buckets):
                    if not known or not langs:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    joint = priors + n @ table[at]
                    best = int(joint.argmax())
                    names.append(langs[best])
                    scores.append(float(1 / np.exp(joint - joint[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, lang_pred string, score double"
    )
