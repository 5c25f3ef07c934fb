"""SimHash near-duplicates by pigeonring filtering.

The 64 bits are cut into 8 segments in a ring. If two fingerprints differ in at most 4
bits, then at some segment a chain starts whose first l segments differ in at most
floor(l * 4 / 8) bits, for every l from 1 to 8 (the strong form of the pigeonring
principle). The budgets are 0, 1, 1, 2, 2, 3, 3, 4. Those of the first five segments leave
three of them equal: the first, one of the next two, and one more of the next four. These
three make a 24-bit key. So each fingerprint stands under 40 keys, and fingerprints that
link meet under one of them at least. The budgets of seven segments leave four equal: 70
keys of 32 bits, by which very many fingerprints meet few others each.

Fingerprints under one key are checked segment by segment along the chain, each budget
pruning what the next one sees; the last is the full Hamming check. Links are not written
out as pairs: of the fingerprints that meet under a key, those that hang together are each
tied to one of them. Equal fingerprints count as one from the start.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.links import components
from quirework.llm.shared import id_or_none, written

SEGMENTS, WIDTH = 8, 8
#: From so many different fingerprints on, keys are taken from chains of seven segments.
#: With keys of 24 bits each would then meet 32 strangers under a key, with 32 bits one in eight.
MANY = 1 << 29

# Fingerprints -------------------------------------------------------------------------


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Each bit is 1 if it is set in over half the hashes of the word shingles."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = (ends - [len(p) for p in parts]).tolist()
    last = ends[words - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, last, strict=False)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42
) -> DataFrame:
    """`id`, `tag` (a hash of the text), `fingerprint` (the 64 bits as a signed long) for each row."""

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py(), words, seed) for t in batch["text"]]
            values = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["tag"], pa.array(values)], ["id", "tag", "fingerprint"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tag"), F.col(text_col).alias("text")
    ).mapInArrow(run, f"id {kind}, tag long, fingerprint long")


# Candidates ---------------------------------------------------------------------------


def budgets(radius: int) -> list[int]:
    """Most differing bits in the first 1, 2, ... segments of a chain."""
    return [n * radius // SEGMENTS for n in range(1, SEGMENTS + 1)]


def key_segments(radius: int, chain: int) -> list[tuple[int, ...]]:
    """The sets of segments of which one is equal if the budgets of a chain's start hold.

    A chain's first segments may have as many unequal ones as their budget has bits; the
    others are equal. A set serves for all others that it is a part of.
    """
    sets = set()
    for start in range(SEGMENTS):
        for unequal in itertools.product((0, 1), repeat=chain):
            if all(sum(unequal[: n + 1]) <= b for n, b in zip(range(chain), budgets(radius), strict=False)):
                sets.add(frozenset((start + n) % SEGMENTS for n in range(chain) if not unequal[n]))
    least = [s for s in sets if not any(t < s for t in sets)]
    return sorted(tuple(sorted(s)) for s in least)


def chain_for(prints: int) -> int:
    """How many segments of a chain set the keys of so many fingerprints; each choice finds all links."""
    return 5 if prints < MANY else 7


def chained(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs have a chain within all budgets, from any start; the last is the distance.

    Pairs that a budget rules out at a start are not looked at again for it.
    """
    x = np.bitwise_xor(a, b)
    ok = np.zeros(x.shape, bool)
    parts = x.view(np.uint8).reshape(*x.shape, 8)
    for start in range(SEGMENTS):
        left = np.flatnonzero(~ok.ravel() & (parts[..., start].ravel() == 0))
        chosen = parts.reshape(-1, 8)[left]
        total = np.zeros(len(left), np.uint8)
        for n, most in enumerate(budgets(radius)):
            total = total + np.bitwise_count(chosen[:, (start + n) % SEGMENTS])
            keep = total <= most
            if not keep.all():
                left, chosen, total = left[keep], chosen[keep], total[keep]
        ok.ravel()[left] = True
    return ok


def tied(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the place of the first one that it hangs together with.

    From each start outward; what is reached is never compared again, so that a group of
    close fingerprints costs little more than one comparison each.
    """
    root = np.full(len(prints), -1, np.int64)
    left = np.arange(len(prints))
    while len(left):
        first, left = left[0], left[1:]
        root[first], edge = first, np.array([first])
        while len(edge) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(edge), 64):
                far = np.flatnonzero(~near)
                if not len(far):
                    break
                block = chained(prints[edge[at : at + 64], None], prints[None, left[far]], radius)
                near[far] = block.any(axis=0)
            edge, left = left[near], left[~near]
            root[edge] = first
    return root


PAIRS = "a long, b long"
MEETINGS = "a long, b long, key long, block long, prints binary"
MEETING_SCHEMA = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("block", pa.int64()), ("prints", pa.binary())]
)
SHORT = 32


def pairs(a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    return [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]


def ties(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    root = tied(prints, radius)
    rest = np.flatnonzero(root != np.arange(len(root)))
    return prints[root[rest]], prints[rest]


def short_runs(key, prints, radius):
    """Links between neighbours in runs of equal keys, by their distance in the run."""
    for step in range(1, SHORT):
        at = np.flatnonzero(key[step:] == key[:-step]) if step < len(key) else key[:0]
        if not len(at):
            return
        near = at[chained(prints[at], prints[at + step], radius)]
        yield prints[near], prints[near + step]


def in_runs(key, prints, radius):
    """Links in whole runs of equal keys."""
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(edges)
    few = np.repeat((sizes > 1) & (sizes <= SHORT), sizes)
    found = list(short_runs(key[few], prints[few], radius))
    for start, size in zip(edges[:-1][sizes > SHORT], sizes[sizes > SHORT], strict=True):
        found.append(ties(prints[start : start + size], radius))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def meetings(rows: DataFrame, radius: int, block_rows: int) -> DataFrame:
    """Links under keys with up to `block_rows` fingerprints; the others are cut into blocks.

    Rows: `key`, `print`, sorted by key. Gives pairs `a`, `b`, or, of a longer run, the
    blocks in which it passed. At any time a task holds some batches.
    """

    def run(batches):
        key, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        block, long_key = 0, None

        def passed(last):
            """What can be told without the rows to come; the others are kept."""
            nonlocal key, prints, block, long_key
            edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            sizes, keys = np.diff(edges), key[edges[:-1]]
            long = sizes > block_rows
            if long_key is not None:
                long |= keys == long_key
            kept = np.zeros(len(key), bool)
            if not last:
                kept[edges[-2] :] = True
            whole = ~kept & ~np.repeat(long, sizes)
            if whole.any() and (found := in_runs(key[whole], prints[whole], radius)):
                n = len(found[0])
                nothing = [pa.nulls(n, f.type) for f in MEETING_SCHEMA][2:]
                yield pa.RecordBatch.from_arrays(pairs(*found) + nothing, schema=MEETING_SCHEMA)
            for start, end in zip(edges[:-1][long], edges[1:][long], strict=True):
                if key[start] != long_key:
                    long_key, block = key[start], 0
                for at in range(start, end, block_rows):
                    stop = min(at + block_rows, end)
                    if stop - at == block_rows or not kept[start]:
                        row = {"key": [int(long_key)], "block": [block], "prints": [prints[at:stop].tobytes()]}
                        yield pa.RecordBatch.from_pydict(
                            {"a": pa.nulls(1, pa.int64()), "b": pa.nulls(1, pa.int64())} | row, schema=MEETING_SCHEMA
                        )
                        block, kept[at:stop] = block + 1, False
            key, prints = key[kept], prints[kept]

        for batch in batches:
            key = np.concatenate((key, batch["key"].to_numpy()))
            prints = np.concatenate((prints, batch["print"].to_numpy().view(np.uint64)))
            if len(key) > 4 * block_rows:
                yield from passed(False)
        if len(key):
            yield from passed(True)

    return rows.mapInArrow(run, MEETINGS)


def links(prints: DataFrame, radius: int = 4, chain: int = 5, block_rows: int = 16_384) -> DataFrame:
    """Ties between fingerprints that hang together: `a`, `b`.

    `prints`: `print` (long, each once). Under a key with more than `block_rows`
    fingerprints, each pair of blocks is a task's work, so a key that very many share is
    dealt out; a task holds two blocks.
    """
    if radius >= SEGMENTS:
        raise ValueError(f"the first segment of a chain is only equal within {SEGMENTS - 1} bits")
    byte = [F.shiftrightunsigned("print", 8 * s).bitwiseAND(255) for s in range(SEGMENTS)]
    keys = []
    for number, chosen in enumerate(key_segments(radius, chain)):
        value = F.lit(number).cast("long")
        for s in chosen:
            value = value * 256 + byte[s]
        keys.append(value)
    rows = (
        prints.select("print", F.explode(F.array(*keys)).alias("key"))
        .repartition("key")
        .sortWithinPartitions("key")
    )
    met = written(meetings(rows, radius, block_rows), "meetings")
    blocks = met.where(F.col("key").isNotNull()).select("key", "block", "prints")
    other = blocks.select("key", F.col("block").alias("block_b"), F.col("prints").alias("prints_b"))

    def across(batches):
        for batch in batches:
            for p, q in zip(batch["prints"], batch["prints_b"], strict=True):
                both = np.frombuffer(p.as_py() + q.as_py(), np.uint64)
                yield pa.RecordBatch.from_arrays(pairs(*ties(both, radius)), ["a", "b"])

    crossed = (
        blocks.join(other, "key")
        .where("block < block_b")
        .repartition("key", "block", "block_b")
        .select("prints", "prints_b")
        .mapInArrow(across, PAIRS)
    )
    return met.where(F.col("key").isNull()).select("a", "b").unionByName(crossed)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    chain: int | None = None,
    block_rows: int = 16_384,
) -> DataFrame:
    """`id`, `tag`, `fingerprint`, `component_id`, `group` for each row.

    The component is the smallest id that links reach, the row's own included; links are at
    most `radius` differing bits. Texts without words, nulls included, have fingerprint
    zero and link like any other. Rows without an id count as larger than all others: a
    component of such rows alone is null. `tag` is a hash of the text, `group` one of the
    component's fingerprints; fingerprints are signed longs here. `chain` sets the keys (none:
    by the number of different fingerprints), not the result.
    """
    prints = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    least = F.min(id_or_none("id")).alias("least")
    nodes = written(prints.groupBy(F.col("fingerprint").alias("print")).agg(least), "nodes")
    chain = chain or chain_for(nodes.count())
    roots = components(links(nodes.select("print"), radius, chain, block_rows))
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("group")
    )
    named = rooted.groupBy("group").agg(F.min("least").alias("first"))
    by_print = rooted.join(named, "group").select(
        F.col("print").alias("fingerprint"), "group", F.col("first.id").alias("component_id")
    )
    return prints.join(by_print, "fingerprint").select("id", "tag", "fingerprint", "component_id", "group")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near-duplicates, as it is: that with the smallest id.

    Of rows that share this id, that with the smallest fingerprint and hash of its text
    stays; rows without an id come last. The texts are shuffled once, by id and hash.
    """
    order = F.struct(id_or_none("id").alias("of"), "fingerprint", "tag")
    kept = (
        near_duplicates(docs, id_col, text_col, **options)
        .groupBy("group")
        .agg(F.min(order).alias("first"))
        .select("first.of.none", F.coalesce("first.of.id", F.lit(0)).alias("id"), "first.tag")
    )
    kept = written(kept, "kept")
    rows = docs.select(
        F.col(id_col).isNull().alias("none"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.col(text_col)).alias("tag"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    number = F.row_number().over(Window.partitionBy("none", "id", "tag").orderBy(F.lit(0)))
    return (
        rows.join(kept, ["none", "id", "tag"], "left_semi")
        .withColumn("number", number)
        .where("number = 1")
        .select("row.*")
    )
