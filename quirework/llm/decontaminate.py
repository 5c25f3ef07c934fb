"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search.

For each item, windows of its number of words slide over the documents. Each window has a
64-bit SimHash of its five-word shingles. Six blocks of the bits are looked up in tables of
the items' blocks, with up to floor(radius / 6) bits changed: by the pigeonhole principle
this finds every item fingerprint within `radius`. What is found is checked by Hamming
distance, then by the exact weighted similarity of the shingles: the sum of the smaller
counts over the sum of the larger ones.

Two exact bounds spare work without losing a match. A window without any shingle of the
benchmark has similarity 0, so windows are only made around such shingles. A document with
fewer words than an item is one window, if it has enough shingles to reach the similarity.

Words are runs of letters, digits and underscores, in lower case. Texts stay where they
are read: what travels is the benchmark, in slices of bounded size, to all tasks.
"""

from __future__ import annotations

import collections
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.words import PIECE, groups_of_texts, hashed_words, values_of, window_hashes

SHINGLE = 5
#: The bits of the six blocks.
BLOCKS = tuple(tuple(range(k * 64 // 6, (k + 1) * 64 // 6)) for k in range(6))
#: Shingles of a document that are looked around at once.
PART = 20_000
_OTHER = re.compile(r"\W+")
#: ASCII signs to blanks.
_SIGNS = bytes(c if chr(c).isalnum() or c == 0x5F or c >= 0x80 else 0x20 for c in range(256))


def plain_words(text: str | None) -> bytes:
    """The words, between blanks."""
    lowered = (text or "").lower()
    if lowered.isascii():
        return lowered.encode().translate(_SIGNS)
    return _OTHER.sub(" ", lowered).encode("utf-8", "replace")


def sums_of_bits(shingles: np.ndarray) -> np.ndarray:
    """Running counts of set bits: row i counts the first i shingles."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=out[1:])
    return out


def prints_of(sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of `size` shingles from each start: bits set in over half of them."""
    most = (sums[starts + size] - sums[starts]) * 2 > size
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


def block_values(prints: np.ndarray, block: tuple[int, ...]) -> np.ndarray:
    return (prints >> np.uint64(block[0])) & np.uint64((1 << len(block)) - 1)


@dataclass
class SameSize:
    """Items with the same number of words, and the tables of their fingerprints' blocks."""

    items: np.ndarray
    prints: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, items: list[int], prints: np.ndarray, radius: int) -> SameSize:
        tables = []
        for block in BLOCKS:
            changes = [
                sum(1 << b for b in bits)
                for n in range(radius // len(BLOCKS) + 1)
                for bits in itertools.combinations(range(len(block)), n)
            ]
            values = block_values(prints, block)[:, None] ^ np.array(changes, np.uint64)[None, :]
            order = np.argsort(values.ravel(), kind="stable")
            counts = np.bincount(values.ravel().astype(np.int64), minlength=1 << len(block))
            tables.append((np.concatenate(([0], np.cumsum(counts))), order // len(changes)))
        return cls(np.array(items), prints, tables)

    def near(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of windows and of items within the radius."""
        found = []
        for block, (limits, owners) in zip(BLOCKS, self.tables, strict=True):
            value = block_values(prints, block).astype(np.int64)
            n = limits[value + 1] - limits[value]
            window = np.repeat(np.arange(len(prints)), n)
            within = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
            found.append(window * len(self.items) + owners[limits[value][window] + within])
        pairs = np.unique(np.concatenate(found))
        window, item = np.divmod(pairs, len(self.items))
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= radius
        return window[close], item[close]


class Benchmark:
    """What the tasks need of some items."""

    def __init__(self, items: list[tuple], radius: int, similarity: float):
        self.radius, self.similarity = radius, similarity
        self.ids = [i for i, _ in items]
        words, limits = hashed_words([plain_words(t) for _, t in items])
        self.bags, by_size, self.whole = [], collections.defaultdict(list), collections.defaultdict(list)
        prints, shingles = {}, [np.zeros(0, np.uint64)]
        for n in range(len(items)):
            own = words[limits[n] : limits[n + 1]]
            if len(own) < SHINGLE:
                # Fewer words than a shingle: the whole sequence, of a whole document.
                self.bags.append(None)
                if len(own):
                    self.whole[own.tobytes()].append(n)
                continue
            found = window_hashes(own, np.arange(len(own) - SHINGLE + 1), SHINGLE)
            shingles.append(found)
            self.bags.append(collections.Counter(found.tolist()))
            by_size[len(own)].append(n)
            prints[n] = prints_of(sums_of_bits(found), np.zeros(1, np.int64), len(found))[0]
        self.shingles = np.unique(np.concatenate(shingles))
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.shingles & np.uint64(len(self.seen) - 1)] = True
        self.sizes = {
            size: SameSize.of(own, np.array([prints[n] for n in own], np.uint64), radius)
            for size, own in sorted(by_size.items())
        }

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.seen[shingles & np.uint64(len(self.seen) - 1)])
        if not len(self.shingles) or not len(maybe):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.shingles, shingles[maybe]), len(self.shingles) - 1)
        return maybe[self.shingles[at] == shingles[maybe]]

    def of_document(self, shingles: np.ndarray, hits: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Item -> (similarity, first word, words) of its best window, the first of equals.

        Shared shingles that are far apart, or very many, are looked around part by part.
        """
        best: dict[int, tuple[float, int, int]] = {}
        longest, begin = max(self.sizes), 0
        for end in range(1, len(hits) + 1):
            if (
                end == len(hits)
                or hits[end] - hits[end - 1] > 2 * longest
                or hits[end] - hits[begin] > PART
            ):
                self.around(shingles, hits[begin:end], best)
                begin = end
        return best

    def around(self, shingles: np.ndarray, hits: np.ndarray, best: dict) -> None:
        longest = max(self.sizes)
        first = int(max(0, hits[0] - longest))
        # All shingles that a window around a hit can hold.
        span = shingles[first : int(hits[-1]) + longest]
        sums, hits = sums_of_bits(span), hits - first
        for size, same in self.sizes.items():
            width = size - SHINGLE + 1
            if width > len(shingles):
                if len(shingles) < self.similarity * width:
                    continue
                width = len(shingles)
            steps = np.zeros(len(span) + 1, np.int64)
            np.add.at(steps, np.maximum(hits - width + 1, 0), 1)
            np.add.at(steps, hits + 1, -1)
            starts = np.flatnonzero(np.cumsum(steps)[:-1] > 0)
            starts = starts[starts + width <= len(span)]
            if not len(starts):
                continue
            window, item = same.near(prints_of(sums, starts, width), self.radius)
            for start, n in zip(starts[window].tolist(), same.items[item].tolist(), strict=True):
                bag = collections.Counter(span[start : start + width].tolist())
                small = (bag & self.bags[n]).total()
                score = small / (width + self.bags[n].total() - small)
                if score >= self.similarity and score > best.get(n, (0,))[0]:
                    best[n] = (score, first + start, width + SHINGLE - 1)

    def matches(self, texts: list[str | None]):
        """(place of the text, item, similarity, first word, words)."""
        words, limits = hashed_words([plain_words(t) for t in texts])
        counts = np.diff(limits)
        if self.whole:
            for n in np.flatnonzero(counts < SHINGLE).tolist():
                for item in self.whole.get(words[limits[n] : limits[n + 1]].tobytes(), ()):
                    yield n, item, 1.0, 0, int(counts[n])
        if not self.sizes or len(words) < SHINGLE:
            return
        shingles = window_hashes(words, np.arange(len(words) - SHINGLE + 1), SHINGLE)
        hits = self.shared(shingles)
        text = np.searchsorted(limits, hits, side="right") - 1
        hits, text = (x[hits + SHINGLE <= limits[text + 1]] for x in (hits, text))
        for n in np.unique(text).tolist():
            own = hits[np.searchsorted(text, n) : np.searchsorted(text, n, side="right")] - limits[n]
            of_text = shingles[limits[n] : limits[n + 1] - SHINGLE + 1]
            for item, found in self.of_document(of_text, own).items():
                yield n, item, *found


def slices(benchmark: DataFrame, id_col: str, text_col: str, slice_bytes: int):
    """The items in lists of about `slice_bytes` of text: what a task is sent at once."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // slice_bytes) or 1
    part = F.pmod(F.xxhash64("text"), F.lit(count))
    for n in range(count):
        yield [(r.id, r.text) for r in items.where(part == n).orderBy("id", "text").collect()]


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    radius: int = 17,
    slice_bytes: int = 8 << 20,
) -> DataFrame:
    """`id`, `item_id`, `similarity`, `first_word`, `n_words` of each document's best window.

    One row for each row of `docs` and each item that it holds. A benchmark over
    `slice_bytes` takes one pass over the documents for each slice. Null texts hold and are
    nothing. Items of one to four words match documents of just these words. Items that
    repeat an id with another text give rows of their own.
    """
    id_kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    parts = []
    for items in slices(benchmark, item_id_col, item_text_col, slice_bytes):
        sent = context.broadcast(Benchmark(items, radius, similarity))

        def run(batches, sent=sent):
            known = sent.value
            for batch in batches:
                for first, texts in groups_of_texts(values_of(batch["text"]), PIECE):
                    found = list(known.matches(texts))
                    if found:
                        place, item, score, start, n = zip(*found, strict=True)
                        yield pa.RecordBatch.from_pydict(
                            {
                                "id": batch["id"].take(pa.array([first + p for p in place])),
                                "item_id": [known.ids[i] for i in item],
                                "similarity": list(score),
                                "first_word": list(start),
                                "n_words": list(n),
                            }
                        )

        parts.append(
            rows.mapInArrow(
                run, f"id {id_kind}, item_id {item_kind}, similarity double, first_word long, n_words long"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    radius: int = 17,
    slice_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows of `docs` that hold no item, each as it is; see `matches`."""
    context = docs.sparkSession.sparkContext
    for items in slices(benchmark, item_id_col, item_text_col, slice_bytes):
        sent = context.broadcast(Benchmark(items, radius, similarity))

        def run(batches, sent=sent):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in groups_of_texts(values_of(batch[text_col]), PIECE):
                    for place, *_ in sent.value.matches(texts):
                        keep[first + place] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
