"""Importance resampling: documents drawn by how alike they are to a target's texts.

A text's features are its runs of words; a feature's bucket is the CRC-32 of its bytes. The
log ratio of a bucket's shares in the target and in the corpus is its gain; a document's
weight is the mean gain of its features. Seeded Gumbel noise is added to the weights, and
the highest sums are drawn: that samples without replacement in proportion to the ratios.

Features are never cut out of the text one by one. Each Python worker keeps an Aho-Corasick
automaton of the distinct words it has met, each bounded by blanks on both sides, with the
word's CRC and length as payload. One scan of a text emits the payloads in order. The CRC of
a run of words follows from the payloads of its words: appending n bytes to a text is linear
over its CRC's bits, so that of `a b` comes from those of `a` and ` b` and the length of the
latter. Words that the automaton does not hold are found by the places no payload covers;
their payloads are computed from their bytes, so results do not depend on what it holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.shared import written
from quirework.llm.words import values_of

# Words and their payloads -----------------------------------------------------------------

#: Bytes of words; A-Z become small letters, all else in ASCII a blank.
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
BYTES = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
IN_WORD = np.array([b != 0x20 for b in range(256)])
#: A longer word is not kept in the dictionary.
LONGEST = 48
#: Bytes of a text that are scanned at once.
PIECE = 1 << 20


class Dictionary:
    """Payloads of words: bounded by blanks in the automaton, or computed.

    It holds at most `most` words and is built anew as their number doubles, so that all
    building together costs about twice the last one.
    """

    def __init__(self, most: int = 50_000):
        self.most, self.met, self.held = most, {}, 0
        self.automaton = None

    def build(self) -> None:
        automaton = ahocorasick.Automaton()
        for word, payload in self.met.items():
            automaton.add_word(f" {word} ", payload)
        automaton.make_automaton()
        self.automaton, self.held = automaton, len(self.met)

    def payloads(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The CRC and the length of each word in order. `text`: as `BYTES` maps it, no word cut."""
        raw = np.frombuffer(text, np.uint8)
        edge = np.diff(np.concatenate(([False], IN_WORD[raw], [False])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        crcs = np.zeros(len(starts), np.uint32)
        missing = np.ones(len(starts), bool)
        if self.automaton is not None and len(starts):
            # Every byte as one character: places are those of the bytes, one blank before them.
            found = list(self.automaton.iter(f" {text.decode('latin-1')} "))
            if found:
                at, payload = zip(*found, strict=True)
                # A match ends with the blank behind its word; the blank in front moves it by one.
                word = np.searchsorted(ends, np.array(at) - 1)
                crcs[word], missing[word] = np.array(payload, np.uint32), False
        left = np.flatnonzero(missing)
        for k, a, b in zip(left.tolist(), starts[left].tolist(), ends[left].tolist(), strict=True):
            word = text[a:b]
            crcs[k] = crc = zlib.crc32(word)
            if len(self.met) < self.most and b - a <= LONGEST:
                self.met[word.decode("latin-1")] = crc
        if len(self.met) >= max(2 * self.held, 512) or (self.held < len(self.met) == self.most):
            self.build()
        return crcs, ends - starts


def pieces(text: str | None) -> Iterator[bytes]:
    """A text's bytes mapped, cut at a blank after PIECE bytes at least."""
    data = (text or "").encode("utf-8", "replace").translate(BYTES)
    at = 0
    while len(data) - at > PIECE:
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end
    yield data[at:]


# CRCs of runs of words --------------------------------------------------------------------

#: The reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def bytes_appended(doublings: int) -> np.ndarray:
    """What 2**doublings zero bytes do to each of the 32 bits of a CRC, without the inversions."""
    one = np.zeros(32, np.uint64)
    for bit in range(32):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (POLYNOMIAL if value & 1 else 0)
        one[bit] = value
    for _ in range(doublings):
        one = moved(one, one)
    return one


def moved(crcs: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The CRCs after the zero bytes that `step` stands for."""
    out = np.zeros(len(crcs), np.uint64)
    for bit in range(32):
        out ^= np.where(crcs >> np.uint64(bit) & np.uint64(1), step[bit], np.uint64(0))
    return out


STEPS = [bytes_appended(n) for n in range(32)]


def joined(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs of texts put together, from those of their halves and the second's length."""
    out = a.astype(np.uint64)
    for n, step in enumerate(STEPS):
        far = np.flatnonzero(length >> n & 1)
        if len(far):
            out[far] = moved(out[far], step)
    return (out ^ b.astype(np.uint64)).astype(np.uint32)


BLANK = np.uint32(zlib.crc32(b" "))


def features(crcs: np.ndarray, lengths: np.ndarray, longest: int) -> np.ndarray:
    """The CRCs of all runs of 1 to `longest` consecutive words, joined by one space."""
    runs, found = crcs, [crcs]
    for n in range(2, longest + 1):
        if len(crcs) < n:
            break
        spaced = joined(runs[: len(crcs) - n + 1], np.full(len(crcs) - n + 1, BLANK), np.ones(len(crcs) - n + 1, np.int64))
        runs = joined(spaced, crcs[n - 1 :], lengths[n - 1 :])
        found.append(runs)
    return np.concatenate(found)


class Reader:
    """Buckets of texts. One is kept by each Python worker, with what its dictionary has met."""

    kept: dict[int, Reader] = {}

    def __init__(self, most: int):
        self.dictionary = Dictionary(most)

    @classmethod
    def of_worker(cls, most: int) -> Reader:
        if most not in cls.kept:
            cls.kept[most] = cls(most)
        return cls.kept[most]

    def counts(self, text: str | None, longest: int, buckets: int, values: np.ndarray | None = None):
        """`words`, `features` and, with `values`, the sum of the buckets' values, else their counts.

        Long texts are read in pieces; runs across two pieces take the first one's last words along.
        """
        words = number = 0
        total = np.zeros(buckets, np.int64) if values is None else 0
        crcs, lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for piece in pieces(text):
            new_crcs, new_lengths = self.dictionary.payloads(piece)
            words += len(new_crcs)
            over = len(crcs)
            crcs, lengths = np.concatenate((crcs, new_crcs)), np.concatenate((lengths, new_lengths))
            bucket = features(crcs, lengths, longest) % np.uint32(buckets)
            # Runs within the words taken along were counted with the piece before.
            again = features(crcs[:over], lengths[:over], longest) % np.uint32(buckets)
            number += len(bucket) - len(again)
            if values is None:
                total += np.bincount(bucket, minlength=buckets) - np.bincount(again, minlength=buckets)
            else:
                total += int(values[bucket].sum()) - int(values[again].sum())
            keep = max(0, len(crcs) - longest + 1)
            crcs, lengths = crcs[keep:], lengths[keep:]
        return words, number, total


# The operator -----------------------------------------------------------------------------


def bucket_counts(
    texts: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = 10_000, most_words: int = 50_000
) -> DataFrame:
    """`bucket`, `n`: the features of all texts, each time they occur. Tasks add up their own first."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        reader = Reader.of_worker(most_words)
        for batch in batches:
            for text in values_of(batch["text"]):
                total += reader.counts(text, longest, buckets)[2]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def as_array(counts: DataFrame, buckets: int) -> np.ndarray:
    """Counts by bucket on the driver: `buckets` numbers, however much was counted."""
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray, scale: int = 1000) -> np.ndarray:
    """The scaled log ratio of each bucket's smoothed shares in target and corpus, floored."""
    t, s, n = target.astype(float), corpus.astype(float), len(target)
    ratio = ((t + 1) * (s.sum() + n)) / ((s + 1) * (t.sum() + n))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def weights(
    docs: DataFrame,
    gain: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 1,
    most_words: int = 50_000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """`id`, `n_words`, `n_features`, `weight` (the floored mean gain; 0 without features) for each row.

    The `carry` columns come along in the struct `carried`.
    """

    def run(batches):
        reader = Reader.of_worker(most_words)
        for batch in batches:
            found = [reader.counts(t, longest, len(gain), gain) for t in values_of(batch["text"])]
            words, number, total = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else [[]] * 3
            weight = [t // n if n else 0 for t, n in zip(total, number, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["carried"], *(pa.array(x, pa.int64()) for x in (words, number, weight))],
                ["id", "carried", "n_words", "n_features", "weight"],
            )

    carried = F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(None).cast("int").alias("none")])
    rows = docs.select(F.col(id_col).alias("id"), carried.alias("carried"), F.col(text_col).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    shape = f"id {kinds['id']}, carried {kinds['carried']}, n_words long, n_features long, weight long"
    return rows.mapInArrow(run, shape)


def noise(id_col, seed: str, scale: int = 1000):
    """Floored, scaled Gumbel noise of an id, from the first 8 hex digits of a seeded hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Add `rank`: 1, 2, 3... by falling score for the highest `percent` of the rows that are long enough.

    Scores are whole numbers within a range that logarithms of doubles set, some hundred
    thousand different ones at most, so a table of their counts is small at any size. It
    tells each score's first rank and the lowest score drawn. Only rows from this score on
    are shuffled, by score; ties go by id, then by the other columns, nulls last.
    """
    eligible = F.col("n_words") >= least_words
    counts = written(scored.where(eligible).groupBy("score").agg(F.count("*").alias("n")), "scores")
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    draw = percent * total // 100
    starts = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(higher), F.lit(0)))
        .where(F.col("before") < draw)
        .select("score", "before")
    )
    ties = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "weight", "n_features")
    high = scored.where(eligible).join(F.broadcast(starts), "score")
    rank = F.col("before") + F.row_number().over(ties)
    ranked = high.withColumn("rank", F.when(rank <= draw, rank)).drop("before")
    low = scored.join(F.broadcast(starts.select("score", F.lit(True).alias("high"))), "score", "left").where(
        F.col("high").isNull() | ~eligible
    )
    return ranked.unionByName(low.drop("high").withColumn("rank", F.lit(None).cast("long")))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
    most_words: int = 50_000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """`id`, `carried`, `n_words`, `n_features`, `weight`, `score`, `rank` for each row of `docs`.

    Words are runs of small letters, digits and all that is not ASCII, after A-Z became
    small. Null and empty texts have no features and weight 0. Rows without an id have the
    noise of an empty one and lose ties. Rows that are the same get ranks of their own.
    """
    corpus = as_array(bucket_counts(docs, text_col, longest, buckets, most_words), buckets)
    wanted = as_array(bucket_counts(target, target_col, longest, buckets, most_words), buckets)
    found = weights(docs, gains(wanted, corpus), id_col, text_col, longest, most_words, carry)
    scored = found.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    return drawn(written(scored, "scored"), percent, least_words)


def sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of `docs` as they are."""
    ranked = resampled(docs, target, carry=tuple(docs.columns), **options)
    return ranked.where("rank is not null").select("carried.*")
