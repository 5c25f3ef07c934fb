"""Vector codes: each vector cut into parts, each part coded by its nearest codebook entry.

Components are integers, floor(256 * x), so that all distances and sums are exact and a
rerun, on however many tasks, gives the same codebooks.

The nearest entry is found by slice-and-intersect bitmasks. In every dimension of a part
the entries' coordinates are sorted, and a prefix mask says which entries are among the
first k of them: one bit for each of up to 64 entries. An entry within distance r of a part
is within r in each dimension. So two prefix masks, at the coordinates x - r and x + r, give
by one difference the entries of a dimension's range, and the AND over the dimensions
leaves few candidates. The initial r is the distance to some entry near in the first
dimensions, so the nearest one is always among the candidates, ties included: the distances
to them alone decide, exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import by_hot_key, written

#: Integer components are clamped to this: sums of squares then fit 64 bits at any usual length.
LARGEST = 1 << 24
MOST_ENTRIES = 64


def integer_vectors(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an Arrow list column: which rows are kept, each row's length, all rows' components.

    Rows that are null or hold null or non-finite components are not kept; components of
    such rows are missing from the values, those of the kept ones stand one after another.
    """
    n = len(column)
    if not n:
        return np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(whole, np.asarray(column.value_lengths().fill_null(0)), 0).astype(np.int64)
    flat = column.flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), np.float64)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ends = np.cumsum(sizes)
    whole &= bad[ends] == bad[ends - sizes]
    values = values[np.repeat(whole, sizes)]
    scaled = np.clip(np.floor(values * 256.0), -LARGEST, LARGEST).astype(np.int64)
    return whole, sizes, scaled


class Codebook:
    """The entries of one part position, ready to be searched: `entries` is (k, dims)."""

    def __init__(self, entries: np.ndarray):
        if not 1 <= len(entries) <= MOST_ENTRIES:
            raise ValueError(f"a codebook has 1 to {MOST_ENTRIES} entries, not {len(entries)}")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        #: prefix[k, d]: the entries with the k smallest coordinates of dimension d.
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])

    def in_range(self, low: np.ndarray, high: np.ndarray, dim: int) -> np.ndarray:
        """A mask of the entries whose coordinate is in [low, high], for each pair."""
        first = np.searchsorted(self.sorted[:, dim], low, "left")
        last = np.searchsorted(self.sorted[:, dim], high, "right")
        return self.prefix[last, dim] & ~self.prefix[first, dim]

    def guess(self, parts: np.ndarray) -> np.ndarray:
        """The squared distance of each part to some entry: of those next to it in a dimension, the nearest."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        for dim in range(parts.shape[1]):
            at = np.searchsorted(self.sorted[:, dim], parts[:, dim])
            at = np.minimum(at, len(self.entries) - 1)
            entry = self.order[at, dim]
            np.minimum(best, ((parts - self.entries[entry]) ** 2).sum(axis=1), out=best)
        return best

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """A mask for each part: all entries that may be its nearest, that one among them."""
        # The root is taken in doubles: one more makes up for its rounding.
        radius = np.ceil(np.sqrt(self.guess(parts).astype(np.float64))).astype(np.int64) + 1
        masks = np.full(len(parts), np.uint64(2**64 - 1))
        for dim in range(parts.shape[1]):
            x = parts[:, dim]
            masks &= self.in_range(x - radius, x + radius, dim)
        return masks

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry's index, the smaller one of ties, and its squared distance."""
        masks = self.candidates(parts)
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        distance = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(parts)))
        best = np.minimum.reduceat(distance, starts)
        # Pairs stand in the order of entries: the first at the least distance is the tie's winner.
        least = np.flatnonzero(distance == best[row])
        first = least[np.searchsorted(row[least], np.arange(len(parts)))]
        return entry[first], best


def coded(parts: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """`parts` is (rows, positions, dims): the codes of each row, and its squared distances."""
    codes = np.zeros(parts.shape[:2], np.uint8)
    errors = np.zeros(parts.shape[:2], np.int64)
    for position, book in enumerate(books):
        for at in range(0, len(parts), 4096):
            piece = slice(at, at + 4096)
            codes[piece, position], errors[piece, position] = book.nearest(parts[piece, position])
    return codes, errors


def learn(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positions: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> np.ndarray | None:
    """Codebooks (positions, entries, dims) after some rounds over all vectors; None if none is kept.

    They start as the parts of the vectors with the smallest ids (ties by the vector; rows
    without an id last). In a round all parts go to their nearest entries, and each entry
    that is used becomes the floored mean of its parts. Tasks add up their own vectors first;
    positions * entries rows come to the driver. With fewer than `entries` vectors there are
    as many entries. The length of the first vector that isn't empty is that of all, a
    multiple of `positions`, else it is an error; vectors of other lengths take no part.
    """
    usable = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    first = (
        vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where(F.col("vector").isNotNull() & usable & (F.size("vector") > 0))
        .orderBy(F.col("id").asc_nulls_last(), "vector")
    )
    head = first.limit(1).collect()
    if not head:
        return None
    dims = len(head[0].vector)
    if dims % positions:
        raise ValueError(f"a vector of {dims} components can't be cut into {positions} equal parts")
    start = first.where(F.size("vector") == dims).limit(entries).select("vector").toArrow()
    _, _, values = integer_vectors(start["vector"].combine_chunks())
    books = np.ascontiguousarray(values.reshape(-1, positions, dims // positions).transpose(1, 0, 2))
    for _ in range(rounds):
        books = improved(vectors.select(F.col(vector_col).alias("vector")), books)
    return books


def improved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one more round over `vector`."""
    positions, entries, width = books.shape

    def sums(batches):
        found = [Codebook(b) for b in books]
        total = np.zeros((positions, entries, width), np.int64)
        count = np.zeros((positions, entries), np.int64)
        for batch in batches:
            kept, sizes, values = integer_vectors(batch["vector"])
            parts = of_length(values, sizes[kept], positions * width).reshape(-1, positions, width)
            codes, _ = coded(parts, found)
            for position in range(positions):
                code = codes[:, position]
                count[position] += np.bincount(code, minlength=entries)
                for d in range(width):
                    # Sums of integers below 2**53 are exact in doubles; a batch's are.
                    added = np.bincount(code, parts[:, position, d].astype(np.float64), entries)
                    total[position, :, d] += added.astype(np.int64)
        at = np.flatnonzero(count.ravel())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at),
                pa.array(count.ravel()[at]),
                pa.array(list(total.reshape(-1, width)[at]), pa.list_(pa.int64())),
            ],
            ["entry", "n", "total"],
        )

    partial = vectors.mapInArrow(sums, "entry long, n long, total array<long>")
    added = partial.groupBy("entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(width)]
    )
    out = books.reshape(-1, width).copy()
    for row in added.collect():
        out[row.entry] = [row[f"t{d}"] // row.n for d in range(width)]
    return out.reshape(books.shape)


def of_length(values: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """The components of the vectors that have this length."""
    return values[np.repeat(sizes == length, sizes)]


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all integers by position, entry and place within the part, joined by commas."""
    flat = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def encode(
    vectors: DataFrame,
    books: np.ndarray | None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """`id`, the `carry` columns under `carried`, `codes` (a byte for each part), `error` (long).

    A row for each vector without null or non-finite components; other rows are dropped.
    `error` is the sum of the parts' squared distances. Vectors of another length than the
    codebooks' have null codes and errors. Components beyond 65,536 count as that.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    carried = F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(None).cast("int").alias("none")])
    rows = vectors.select(F.col(id_col).alias("id"), carried.alias("carried"), F.col(vector_col).alias("vector"))
    shape = f"id {kind}, carried {rows.schema['carried'].dataType.simpleString()}, codes binary, error long"
    length = 0 if books is None else books.shape[0] * books.shape[2]

    def run(batches):
        found = [] if books is None else [Codebook(b) for b in books]
        for batch in batches:
            kept, sizes, values = integer_vectors(batch["vector"])
            fits = (sizes[kept] == length) & (length > 0)
            n = int(kept.sum())
            codes, errors = np.full(n, None, object), np.zeros(n, np.int64)
            if length and fits.any():
                parts = of_length(values, sizes[kept], length).reshape(-1, *books.shape[::2])
                made, distances = coded(parts, found)
                codes[fits] = [c.tobytes() for c in made]
                errors[fits] = distances.sum(axis=1)
            out = batch.filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [out["id"], out["carried"], pa.array(codes, pa.binary()), pa.array(errors, mask=~fits)],
                ["id", "carried", "codes", "error"],
            )

    return rows.mapInArrow(run, shape)


def compressed(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positions: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, np.ndarray | None]:
    """All vectors' codes by codebooks learnt from all of them, and these codebooks.

    `id`, `label`, `codes`, `error`, `label_error` (the errors added up over equal labels;
    null labels are one). The written codes are read twice, not the vectors.
    """
    books = learn(vectors, id_col, vector_col, positions, entries, rounds)
    rows = encode(vectors, books, id_col, vector_col, (label_col,))
    rows = written(rows.select("id", F.col(f"carried.`{label_col}`").alias("label"), "codes", "error"), "codes")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return by_hot_key(rows, written(sums, "labels"), "label").select("id", "label", "codes", "error", "label_error"), books


def decoded(codes: bytes, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the scale of the input."""
    return (books[np.arange(len(books)), np.frombuffer(codes, np.uint8)].ravel() + 0.5) / 256.0
