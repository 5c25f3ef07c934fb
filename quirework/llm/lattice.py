"""Near-duplicate vectors by lattice hashing.

Each table projects unit vectors onto 8 random directions, scales and shifts them, and
decodes the result to the nearest point of the E8 lattice, the densest packing in eight
dimensions. A vector is indexed under its own cell and looks into the nearest of the 240
cells around it too. Pairs that meet are verified by their cosine in double precision.

With one block (scale 1.5, 16 tables, 8 neighbours) two vectors meet in some table with
probability 0.991 at cosine 0.95, and over 0.999 from 0.97 on; unrelated ones meet about
once in 100,000 pairs and table, and their number grows with the square of the table. So keys
grow with it: in larger tables a cell is that of two or three blocks of 8 directions
together, and neighbours are the combinations of the blocks' nearest cells that are nearest
in all. Unrelated vectors then meet once in some ten million pairs and table, or more rarely;
coarser cells and more tables keep the probability for related ones. Equal vectors count as
one from the start.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.links import components
from quirework.llm.shared import apart, by_hot_key, id_or_none, written
from quirework.llm.words import mixed_bits


def shortest_vectors() -> np.ndarray:
    """The 240 neighbours of the origin in E8, times two."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((2, -2), repeat=2):
            found.append([a if k == i else b if k == j else 0 for k in range(8)])
    found += [s for s in itertools.product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(found, np.int64)


NEIGHBOURS = shortest_vectors()


def even_point(x: np.ndarray) -> np.ndarray:
    """The nearest integer point with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(odd))
    near[odd, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return near


def e8_point(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8, times two: of the even points and those moved by a half."""
    whole, half = even_point(x), even_point(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], whole, half)).astype(np.int64)


#: By number of different vectors: blocks, tables, neighbours and scale. Each scheme finds
#: pairs at cosine 0.95 with probability 0.99; a test measures it.
SCHEMES = [
    (200_000, {"blocks": 1, "tables": 16, "neighbours": 8, "scale": 1.5}),
    (50_000_000, {"blocks": 2, "tables": 23, "neighbours": 16, "scale": 1.0}),
    (float("inf"), {"blocks": 3, "tables": 22, "neighbours": 16, "scale": 0.7}),
]
#: Neighbours of a block that are combined with those of the others.
NEAREST = 8


def scheme(vectors: int) -> dict:
    return next(chosen for most, chosen in SCHEMES if vectors <= most)


class Tables:
    def __init__(self, dims: int, tables: int, scale: float, neighbours: int, seed: int, blocks: int = 1):
        draw = np.random.default_rng([seed, dims])
        self.directions = draw.normal(size=(tables, dims, 8 * blocks)) * scale
        self.shifts = draw.random(size=(tables, 8 * blocks))
        self.neighbours, self.dims, self.blocks = neighbours, dims, blocks

    def cells(self, units: np.ndarray):
        """For each table: the key of each vector's own cell, and of the cells it probes."""
        for number, (directions, shift) in enumerate(zip(self.directions, self.shifts, strict=True)):
            x = units @ directions + shift
            cost, points = np.zeros((len(x), 1)), np.zeros((len(x), 1, 0), np.int64)
            for at in range(0, 8 * self.blocks, 8):
                cost, points = self.joined(cost, points, *self.near(x[:, at : at + 8]))
            # Of all combinations the one that moves no block comes first and costs nothing.
            yield self.key(number, points[:, 0]), self.key(number, points[:, 1:])

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells of a block, each point's own one first, and how much farther each is than that."""
        own = e8_point(x)
        # The further x leans towards a neighbour, the nearer its cell is.
        lean = (x - own / 2) @ NEIGHBOURS.T
        n = self.neighbours if self.blocks == 1 else NEAREST
        nearest = np.argpartition(-lean, n, axis=1)[:, :n]
        cost = 2 - np.take_along_axis(lean, nearest, axis=1)
        points = own[:, None, :] + NEIGHBOURS[nearest]
        return (
            np.concatenate((np.zeros((len(x), 1)), cost), axis=1),
            np.concatenate((own[:, None, :], points), axis=1),
        )

    def joined(self, cost, points, other_cost, other_points):
        """The cheapest combinations of cells, that of the own ones first."""
        rows, other = np.arange(len(cost))[:, None], other_cost.shape[1]
        total = (cost[:, :, None] + other_cost[:, None, :]).reshape(len(cost), -1)
        chosen = np.zeros((len(cost), 1), np.int64)
        rest = min(self.neighbours, total.shape[1] - 1)
        if rest:
            best = np.argpartition(total[:, 1:], rest - 1, axis=1)[:, :rest] + 1
            chosen = np.concatenate((chosen, best), axis=1)
        both = np.concatenate((points[rows, chosen // other], other_points[rows, chosen % other]), axis=2)
        return total[rows, chosen], both

    def key(self, number: int, points: np.ndarray) -> np.ndarray:
        key = np.full(points.shape[:-1], number * 100_003 + self.dims, np.uint64)
        for k in range(points.shape[-1]):
            key = mixed_bits(key ^ points[..., k].astype(np.int64).view(np.uint64), k)
        return key.view(np.int64)


def unit(values) -> bytes | None:
    """The vector at length 1 in double precision; None if it links with nothing."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    most = np.abs(x).max()
    if not np.isfinite(most) or most == 0:
        return None
    x = x / most
    return (x / np.sqrt((x * x).sum()) + 0.0).astype("<f8").tobytes()


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    seed: int = 8,
    **chosen,
) -> DataFrame:
    """`id`, `n_links`, `component_id`, `kept` for each row.

    `n_links` counts the other rows at `cosine` or more, `component_id` is the smallest id
    that links reach, `kept` marks the row with this id. Null vectors, zero ones and those
    with null or non-finite components link with nothing, nor do vectors of different
    lengths. Rows that repeat an id are rows of their own; rows without one count as
    larger than all others, whatever theirs are. `blocks`, `tables`, `neighbours` and `scale`
    are chosen by the number of different vectors, unless they are given.
    """

    def units(batches):
        for batch in batches:
            found = [unit(v) for v in batch["vector"].to_pylist()]
            digests = [None if u is None else hashlib.sha256(u).digest() for u in found]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(digests, pa.binary()), pa.array(found, pa.binary())],
                ["id", "digest", "unit"],
            )

    rows = written(
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).mapInArrow(
            units, "id long, digest binary, unit binary"
        ),
        "units",
    )
    # A node is a different vector; its rows are counted. Of rows with the id of another
    # vector, nodes are told apart by their digests.
    nodes = written(
        rows.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min(id_or_none("id")).alias("least"), F.count("*").alias("n"), F.first("unit").alias("unit"))
        .withColumn("node", F.xxhash64("digest")),
        "nodes",
    )
    nodes = apart(nodes, "node", "digest")
    chosen = {**scheme(nodes.count()), **chosen}

    def keys(batches):
        made: dict[int, Tables] = {}
        for batch in batches:
            node, raw = batch["node"].to_numpy(), batch["unit"].to_pylist()
            sizes = np.array([len(u) for u in raw])
            for size in np.unique(sizes).tolist():
                dims = size // 8
                if dims not in made:
                    made[dims] = Tables(dims, seed=seed, **chosen)
                for at in np.array_split(np.flatnonzero(sizes == size), -(-len(raw) // 1000)):
                    x = np.frombuffer(b"".join([raw[i] for i in at]), "<f8").reshape(-1, dims)
                    for own, probes in made[dims].cells(x):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.concatenate((own, probes.ravel()))),
                                pa.array(np.concatenate((node[at], np.repeat(node[at], probes.shape[1])))),
                                pa.array(np.arange(probes.size + len(at)) < len(at)),
                            ],
                            ["key", "node", "own"],
                        )

    cells = nodes.select("node", "unit").mapInArrow(keys, "key long, node long, own boolean")
    own = cells.where("own").select("key", F.col("node").alias("a"))
    probes = cells.select("key", F.col("node").alias("b"), F.col("own").alias("own_b"))
    pairs = (
        own.join(probes, "key")
        .where("a < b or (a != b and not own_b)")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )

    def verified(batches):
        for batch in batches:
            a, b = batch["unit_a"].to_pylist(), batch["unit_b"].to_pylist()
            scores = np.array(
                [
                    np.dot(np.frombuffer(x), np.frombuffer(y)) if len(x) == len(y) else -1.0
                    for x, y in zip(a, b, strict=True)
                ]
            )
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(scores >= cosine, pa.bool_()))

    side = lambda s: nodes.select(
        F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("unit").alias(f"unit_{s}")
    )
    links = written(
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", "n_a", "n_b", "unit_a", "unit_b")
        .mapInArrow(verified, "a long, b long, n_a long, n_b long"),
        "links",
    )
    counts = (
        links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("node"), F.col("n_a").alias("n")))))
        .groupBy("col.node")
        .agg(F.sum("col.n").alias("linked"))
    )
    rooted = (
        nodes.select("node", "digest", "least", "n")
        .join(components(links.select("a", "b")), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    rooted = written(rooted, "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n"))
    known = (
        by_hot_key(rooted, written(groups, "groups"), "root")
        .join(counts, "node", "left")
        .select("digest", "component", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("linked"))
    )
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(
        F.col("component.id")
    )
    return (
        rows.select("id", "digest")
        .join(known, "digest", "left")
        .select("id", F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    )
