"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of `PASSAGE` words. Each passage is encoded: frequencies of
hashed runs of one to three character classes (small and capital letters, digits, blanks,
each ASCII sign), and how many of its words the document had before, go through a learned
layer. A gated attention network weighs the passages of a document (tanh and sigmoid
branches, softmax over the bag), and the weighted sum of their codes gives the score. Only
documents have labels; encoder, attention and output are learnt together from them.

Training takes a bounded sample of the labelled documents to the driver, as features.
Scoring is one pass over all texts where they are read, with the small model in each task.
Long texts are encoded in blocks of passages, and the weighted sum is carried from block to
block, so that memory doesn't grow with a text; the score is that of the whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.language import code_points
from quirework.llm.words import BLANK, BYTE_VALUES, BYTES, groups_of_texts, hashed_words, mixed_bits, run_sums, values_of

PASSAGE = 40
#: Classes: 0 other, 1 small letter, 2 capital, 3 digit, 4 blank, 5 line end, then ASCII signs.
SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
CLASSES = 6 + len(SIGNS)
PAIRS, TRIPLES = 216, 252
SIZES = {1: CLASSES, 2: PAIRS, 3: TRIPLES}
FEATURES = sum(SIZES.values()) + 2
#: Texts of more characters are encoded in pieces of this length.
LONG = 1 << 18

_CLASS: list[np.ndarray] = []


def classes() -> np.ndarray:
    if not _CLASS:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                table[c] = 2 if s.isupper() else 1
            elif s.isdigit():
                table[c] = 3
        table[[32, 9, 11, 12]] = 4
        table[[10, 13]] = 5
        table[SIGNS] = np.arange(6, CLASSES)
        _CLASS.append(table)
    return _CLASS[0]


def gram_bucket(code: np.ndarray, order: int) -> np.ndarray:
    return code if order == 1 else (code * 0x9E3779B1 >> 7) % SIZES[order]


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all texts' passages, and the place of each text's first one (and the end).

    An empty text has one passage without features.
    """
    texts = [t or "" for t in texts]
    points, counts = code_points(texts)
    kinds = classes()[points].astype(np.int64)
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(texts)), counts)
    blank = (kinds == 4) | (kinds == 5)
    starts = ~blank
    starts[1:] &= blank[:-1] | (text[1:] != text[:-1])
    word = np.cumsum(starts)
    before = np.concatenate(([0], word))[ends - counts]
    n_words = np.concatenate(([0], word))[ends] - before
    n_passages = np.maximum(-(-n_words // PASSAGE), 1)
    limits = np.concatenate(([0], np.cumsum(n_passages)))
    # Blanks before the first word go to the first passage.
    place = limits[:-1][text] + np.maximum(word - before[text] - 1, 0) // PASSAGE
    out = np.zeros((limits[-1], FEATURES), np.float32)
    at = 0
    code = np.zeros(len(kinds), np.int64)
    for order, size in SIZES.items():
        n = len(kinds) - order + 1
        if n <= 0:
            break
        code = code[:n] * CLASSES + kinds[order - 1 :]
        same = place[:n] == place[order - 1 :]
        bucket = gram_bucket(code, order)
        owner = place[:n][same]
        found = np.bincount(owner * size + bucket[same], minlength=limits[-1] * size).reshape(-1, size)
        # Square roots of frequencies: rare classes count, very common ones don't drown them.
        out[:, at : at + size] = np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1))
        at += size
    words, word_limits = hashed_words([t.encode("utf-8", "replace") for t in texts])
    if len(words):
        counts = np.diff(word_limits)
        owner = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(len(words)) - word_limits[:-1][owner]
        passage = limits[:-1][owner] + np.minimum(within // PASSAGE, n_passages[owner] - 1)
        key = words ^ mixed_bits(owner.astype(np.uint64), 4)
        total = np.maximum(np.bincount(passage, minlength=limits[-1]), 1)
        seen = np.ones(len(key), bool)
        seen[np.unique(key, return_index=True)[1]] = False
        out[:, at] = np.bincount(passage[seen], minlength=limits[-1]) / total
        # Pairs of words the document had before.
        if len(key) > 1:
            pair = mixed_bits(key[:-1] * np.uint64(3) ^ key[1:])
            seen = np.ones(len(pair), bool)
            seen[np.unique(pair, return_index=True)[1]] = False
            out[:, at + 1] = np.bincount(passage[:-1][seen], minlength=limits[-1]) / total
    return out, limits


class Seen:
    """A growing set of numbers in sorted runs, each at least twice as long as the next."""

    def __init__(self):
        self.runs: list[np.ndarray] = []

    def repeats(self, values: np.ndarray) -> np.ndarray:
        """Which values were there before, here or earlier in `values`; all are there from now on."""
        found, first = np.unique(values, return_index=True)
        new = np.ones(len(found), bool)
        for run in self.runs:
            at = np.minimum(np.searchsorted(run, found), len(run) - 1)
            new &= run[at] != found
        repeated = np.ones(len(values), bool)
        repeated[first[new]] = False
        if new.any():
            self.runs.append(found[new])
        while len(self.runs) > 1 and 2 * len(self.runs[-1]) > len(self.runs[-2]):
            last = self.runs.pop()
            self.runs[-1] = np.sort(np.concatenate((self.runs[-1], last)))
        return repeated


def word_hashes(pieces: Iterator[str]) -> Iterator[np.ndarray]:
    """For each piece of a text the hashes of the words that end in it, as `hashed_words` has them.

    A word that goes on from piece to piece keeps its sum so far. After the last piece come
    those that end with the text.
    """
    total, length = 0, 0  # of the word that is not at its end
    for piece in pieces:
        raw = np.frombuffer(piece.encode("utf-8", "replace"), np.uint8)
        edge = np.diff(np.concatenate(([True], BLANK[raw], [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = run_sums(BYTE_VALUES[raw], starts, ends, BYTES)
        done = []
        if length and not (len(starts) and starts[0] == 0):
            done, total, length = [total], 0, 0
        if length:
            first = (total + int(sums[0]) * pow(BYTES.base, length, 2**64)) % 2**64
            sums[0], length = first, length + int(ends[0])
        sums = np.concatenate((np.array(done, np.uint64), sums))
        if len(ends) and ends[-1] == len(raw):
            total = int(sums[-1])
            length = length if len(starts) == 1 and length else int(ends[-1] - starts[-1])
            sums = sums[:-1]
        else:
            total = length = 0
        yield mixed_bits(sums, 3)
    yield mixed_bits(np.array([total] if length else [], np.uint64), 3)


def passage_blocks(text: str) -> Iterator[np.ndarray]:
    """Features of one text's passages, some at a time: put together, what `passages` gives.

    At any time it holds a piece of the text, the counts of the passages in it, and the
    hashes of the text's different words and pairs of them.
    """
    pieces = [range(at, min(at + LONG, len(text))) for at in range(0, len(text), LONG)]
    hashes = word_hashes(text[p.start : p.stop] for p in pieces)
    # Counts of the passages from number `first` on: class runs, then words and repeats.
    width = sum(SIZES.values())
    first, held = 0, np.zeros((1, width + 3), np.int64)
    words, pairs = Seen(), Seen()
    word, after_blank, done, last = -1, True, 0, None
    tail, tail_place = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def room(n):
        nonlocal held
        if n > len(held):
            held = np.concatenate((held, np.zeros((n - len(held), held.shape[1]), np.int64)))

    def ended(found):
        nonlocal done, last
        if not len(found):
            return
        passage = (done + np.arange(len(found))) // PASSAGE - first
        room(int(passage[-1]) + 1)
        held[:, width] += np.bincount(passage, minlength=len(held))
        held[:, width + 1] += np.bincount(passage[words.repeats(found)], minlength=len(held))
        both = found if last is None else np.concatenate(([last], found))
        # A pair belongs to the passage of its first word.
        of = passage[:-1] if last is None else np.concatenate(([(done - 1) // PASSAGE - first], passage[:-1]))
        pair = mixed_bits(both[:-1] * np.uint64(3) ^ both[1:])
        held[:, width + 2] += np.bincount(of[pairs.repeats(pair)], minlength=len(held))
        done, last = done + len(found), found[-1]

    def featured(counts):
        out, at = np.zeros((len(counts), FEATURES), np.float32), 0
        for size in SIZES.values():
            found = counts[:, at : at + size]
            out[:, at : at + size] = np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1))
            at += size
        out[:, at:] = counts[:, width + 1 :] / np.maximum(counts[:, width : width + 1], 1)
        return out

    for piece in pieces:
        kinds = classes()[code_points([text[piece.start : piece.stop]])[0]].astype(np.int64)
        blank = (kinds == 4) | (kinds == 5)
        starts = ~blank
        starts[1:] &= blank[:-1]
        starts[0] &= after_blank
        at_word = word + np.cumsum(starts)
        place = np.concatenate((tail_place, np.maximum(at_word, 0) // PASSAGE))
        kinds = np.concatenate((tail, kinds))
        room(int(place[-1]) - first + 1)
        code, at = np.zeros(len(kinds), np.int64), 0
        for order, size in SIZES.items():
            n = len(kinds) - order + 1
            if n <= 0:
                break
            code = code[:n] * CLASSES + kinds[order - 1 :]
            # Runs within the tail were counted with the piece before.
            new = (place[:n] == place[order - 1 :]) & (np.arange(n) + order > len(tail))
            found = (place[:n][new] - first) * size + gram_bucket(code[new], order)
            held[:, at : at + size] += np.bincount(found, minlength=len(held) * size).reshape(-1, size)
            at += size
        word, after_blank = int(at_word[-1]), bool(blank[-1])
        tail, tail_place = kinds[-2:], place[-2:]
        ended(next(hashes))
        # A passage is complete when the next one's first word is.
        complete = max((done - 1) // PASSAGE - first, 0)
        if complete:
            yield featured(held[:complete])
            held, first = held[complete:], first + complete
    ended(next(hashes))
    yield featured(held)


# The model ----------------------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(model: dict, x: np.ndarray, limits: np.ndarray) -> dict:
    """All values of the network for bags of passages."""
    begin, counts = limits[:-1], np.diff(limits)
    h = np.tanh((x - model["mean"]) / model["spread"] @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), sigmoid(h @ model["U"])
    e = (t * g) @ model["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), counts))
    a = e / np.repeat(np.add.reduceat(e, begin), counts)
    z = np.add.reduceat(a[:, None] * h, begin)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": sigmoid(z @ model["c"] + model["d"])}


def streamed(model: dict, blocks: Iterable[np.ndarray]) -> float:
    """The score of one bag of passages that comes in blocks: a softmax that is carried on."""
    top, total, z = -np.inf, 0.0, 0.0
    for x in blocks:
        h = np.tanh((x - model["mean"]) / model["spread"] @ model["W"] + model["b"])
        e = (np.tanh(h @ model["V"]) * sigmoid(h @ model["U"])) @ model["w"]
        new = max(top, float(e.max()))
        a, kept = np.exp(e - new), np.exp(top - new)
        top, total, z = new, total * kept + a.sum(), z * kept + a @ h
    return float(sigmoid(z / total @ model["c"] + model["d"])[0])


def gradients(model: dict, x: np.ndarray, limits: np.ndarray, y: np.ndarray) -> dict:
    counts = np.diff(limits)
    v = forward(model, x, limits)
    dlogit = (v["p"] - y) / len(y)
    dz = np.repeat(dlogit[:, None] * model["c"], counts, axis=0)
    # Through the softmax of each bag.
    da = (dz * v["h"]).sum(axis=1)
    de = v["a"] * (da - np.repeat(np.add.reduceat(v["a"] * da, limits[:-1]), counts))
    dt = de[:, None] * model["w"] * v["g"] * (1 - v["t"] ** 2)
    dg = de[:, None] * model["w"] * v["t"] * v["g"] * (1 - v["g"])
    dh = v["a"][:, None] * dz + dt @ model["V"].T + dg @ model["U"].T
    du = dh * (1 - v["h"] ** 2)
    scaled = (x - model["mean"]) / model["spread"]
    return {
        "W": scaled.T @ du,
        "b": du.sum(axis=0),
        "V": v["h"].T @ dt,
        "U": v["h"].T @ dg,
        "w": (v["t"] * v["g"]).T @ de,
        "c": v["z"].T @ dlogit,
        "d": dlogit.sum(keepdims=True),
    }


def fit(
    bags: list[np.ndarray],
    y: np.ndarray,
    hidden: int = 32,
    attention: int = 16,
    epochs: int = 30,
    batch: int = 64,
    rate: float = 0.003,
    decay: float = 1e-4,
    seed: int = 1,
) -> dict:
    """Adam over shuffled batches of bags, on the cross entropy of the document labels."""
    draw = np.random.default_rng(seed)
    # Sums in place of one array of all passages: the bags are in memory once.
    n = max(sum(map(len, bags)), 1)
    mean = sum((b.sum(axis=0, dtype=np.float64) for b in bags), np.zeros(FEATURES)) / n
    spread = sum((((b - mean) ** 2).sum(axis=0) for b in bags), np.zeros(FEATURES)) / n
    f32 = lambda a: np.asarray(a, np.float32)
    model = {
        "mean": f32(mean),
        "spread": f32(np.sqrt(spread) + 0.02),
        "W": f32(draw.normal(size=(FEATURES, hidden)) / np.sqrt(FEATURES)),
        "b": np.zeros(hidden, np.float32),
        "V": f32(draw.normal(size=(hidden, attention)) / np.sqrt(hidden)),
        "U": f32(draw.normal(size=(hidden, attention)) / np.sqrt(hidden)),
        "w": f32(draw.normal(size=attention) / np.sqrt(attention)),
        "c": f32(draw.normal(size=hidden) / np.sqrt(hidden)),
        "d": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    step, y = 0, f32(y)
    for _ in range(epochs if bags else 0):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            limits = np.concatenate(([0], np.cumsum([len(bags[i]) for i in own])))
            step += 1
            for k, g in gradients(model, np.concatenate([bags[i] for i in own]), limits, y[own]).items():
                g = g + decay * model[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model[k] = f32(model[k] - rate * move)
    return model


# Operators ----------------------------------------------------------------------------


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_documents: int = 4000,
    most_passages: int = 60_000,
    **options,
) -> dict:
    """Learn from `labels` (0 or 1; null teaches nothing) of documents, whole texts of them.

    Bounds: `most_documents` labelled rows, those with the smallest hashes of their ids, and
    of these, in the same order, as many as have `most_passages` passages together (60 MB of
    features on the driver). With no labels every text has score 0.5.
    """
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(most_documents)
    )

    def featured(batches):
        for batch in batches:
            data = []
            for _, texts in groups_of_texts(values_of(batch["text"])):
                x, limits = passages([t if len(t or "") <= LONG else None for t in texts])
                for text, a, b in zip(texts, limits[:-1], limits[1:], strict=True):
                    own = x[a:b] if len(text or "") <= LONG else within_bound(text)
                    data.append(None if own is None else own.astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch["id"], batch["y"], pa.array(data, pa.binary())], ["id", "y", "x"])

    def within_bound(text):
        blocks, n = [], 0
        for block in passage_blocks(text):
            blocks.append(block.astype(np.float16))
            n += len(block)
            if n > most_passages:
                return None
        return np.concatenate(blocks)

    kind = docs.schema[id_col].dataType.simpleString()
    in_turn = Window.orderBy(F.xxhash64("id"), "id", "y", "x")
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(chosen, "id")
        .select("id", "y", "text")
        .mapInArrow(featured, f"id {kind}, y int, x binary")
        .where(F.col("x").isNotNull())
        # Rows that repeat an id can only make more of them: the smallest of all come first.
        .orderBy(F.xxhash64("id"), "id", "y", "x")
        .limit(most_documents)
        .withColumn("passages", F.sum(F.octet_length("x") / (2 * FEATURES)).over(in_turn))
        .where(F.col("passages") <= most_passages)
        .select("y", "x")
        .toArrow()
    )
    bags = [np.frombuffer(x, np.float16).reshape(-1, FEATURES) for x in rows["x"].to_pylist()]
    return fit(bags, rows["y"].to_numpy(), **options)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `score` (0 to 1, higher: label 1 likelier) for each row; null texts are empty.

    An empty text is one passage without features. Memory doesn't grow with a text's length
    but for the hashes of its different words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [scored(sent.value, t) for _, t in groups_of_texts(values_of(batch["text"]))]
            column = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(column)], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, score double"
    )


def scored(model: dict, texts: list[str | None]) -> np.ndarray:
    x, limits = passages([t if len(t or "") <= LONG else None for t in texts])
    out = forward(model, x, limits)["p"].astype(np.float64)
    for k, text in enumerate(texts):
        if len(text or "") > LONG:
            out[k] = streamed(model, passage_blocks(text))
    return out


def accepted(docs: DataFrame, model: dict, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of `docs` with a score of at least `least`, each as it is."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [scored(sent.value, t) for _, t in groups_of_texts(values_of(batch[text_col]))]
            keep = np.concatenate(scores) >= least if scores else np.zeros(0, bool)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
