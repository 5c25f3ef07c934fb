"""Sharding by longest-processing-time scheduling: texts that are equal stay together.

A group's size is the bytes of all its rows. By size, the largest first, each group goes to
the shard with the least in it, which a heap tells. This is done twice, so that no task or
driver sees all groups:

* Groups are dealt by a hash into parts. In a part, read in order of size, a heap puts the
  groups into as many bins as there are shards. A task holds the loads, not the groups.
* The bins of all parts, parts * shards at most whatever the table's size, are put into the
  shards by the same rule on the driver.

With fewer groups than parts nearly all bins hold one group and the two steps are one plain
schedule. Shards differ by the size of the last bins placed, unless a group alone is larger.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.shared import by_hot_key, new_folder, written


def text_digest(text: Column) -> Column:
    """What equal texts share: the hex digits of their MD5; null ones are like empty ones."""
    return F.md5(F.coalesce(text, F.lit("")))


def byte_size(text: Column, overhead: int = 8) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def row_tag(id_col: Column, digest: Column) -> Column:
    """What rows of one id and text share."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("none")), F.lit(":"), digest))


def schedule(loads: list[int], shards: int) -> list[int]:
    """The shard of each load; `loads` fall."""
    heap = [(0, shard) for shard in range(shards)]
    out = []
    for load in loads:
        total, shard = heap[0]
        out.append(shard)
        heapq.heapreplace(heap, (total + load, shard))
    return out


def in_bins(groups: DataFrame, bins: int) -> DataFrame:
    """Each group's bin in its part: `digest`, `bytes`, `n`, `part` with `bin`. Heaps in the tasks."""

    def run(batches):
        part, heap = None, []
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int64)
            rows = zip(batch["part"].to_pylist(), batch["bytes"].to_pylist(), strict=True)
            for at, (of, size) in enumerate(rows):
                if of != part:
                    part, heap = of, [(0, bin) for bin in range(bins)]
                total, found[at] = heap[0]
                heapq.heapreplace(heap, (total + size, int(found[at])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "bin"])

    dealt = groups.repartition("part").sortWithinPartitions("part", F.desc("bytes"), "digest")
    return dealt.mapInArrow(run, "digest string, bytes long, n long, part string, bin long")


def place(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    overhead: int = 8,
    hex_digits: int = 3,
) -> DataFrame:
    """`tag`, `shard`, `slot` for each row of `docs`; rows of one id and text have one `tag`.

    Slots are gapless in a shard, from 0. They follow a hash of the row first, in 16 to the
    power of `hex_digits` parts that are numbered one by one: a shard, and a group of copies
    that is most of one, is dealt out over these. Rows of one tag follow each other. Null and
    empty texts are one group; rows without an id are told apart by their texts alone.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        text_digest(F.col("text")).alias("digest"),
        row_tag(F.col("id"), text_digest(F.col("text"))).alias("tag"),
        byte_size(F.col("text"), overhead).alias("size"),
    )
    rows = written(rows, "sizes")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    binned = written(in_bins(groups.withColumn("part", F.substring("digest", 1, hex_digits)), shards), "bins")
    loads = binned.groupBy("part", "bin").agg(F.sum("bytes").alias("load"))
    found = loads.toArrow().sort_by([("load", "descending"), ("part", "ascending"), ("bin", "ascending")])
    chosen = pa.array(schedule(found["load"].to_pylist(), shards), pa.int32())
    # At most 16**hex_digits * shards rows.
    shard_of = F.broadcast(spark.createDataFrame(found.drop_columns(["load"]).append_column("shard", chosen)))
    sharded = binned.join(shard_of, ["part", "bin"]).select("digest", "n", "shard")
    placed = written(by_hot_key(rows.select("digest", "tag"), sharded, "digest").select("tag", "shard"), "placed")

    cell = F.substring("tag", 1, hex_digits)
    cells = placed.groupBy("shard", cell.alias("cell")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("shard", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("tag")) - 1
    return (
        placed.withColumn("cell", cell)
        .withColumn("number", number)
        .join(F.broadcast(starts), ["shard", "cell"])
        .select("tag", "shard", (F.col("start") + F.col("number")).alias("slot"))
    )


def sharded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_col="shard", slot_col="slot", **options
) -> DataFrame:
    """The rows of `docs` with their shard (int) and their slot in it (long).

    These two columns replace any that `docs` has by these names. Texts are shuffled once.
    Rows of one id and text take that tag's slots in any order.
    """
    placed = place(docs, id_col, text_col, **options)
    firsts = placed.groupBy("tag").agg(F.first("shard").alias("shard"), F.min("slot").alias("slot"))
    rows = docs.select(
        row_tag(F.col(id_col), text_digest(F.col(text_col))).alias("tag"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (shard_col, slot_col)]).alias("row"),
    )
    number = F.row_number().over(Window.partitionBy("tag").orderBy(F.lit(0))) - 1
    return (
        rows.join(firsts, "tag")
        .withColumn("number", number)
        .select("row.*", F.col("shard").alias(shard_col), (F.col("slot") + F.col("number")).alias(slot_col))
    )


def write_shards(docs: DataFrame, path: str | None = None, **options) -> str:
    """A folder `shard=0`, `shard=1`, ... of Parquet files each, in order of slots. Gives its path."""
    path = path or new_folder(docs.sparkSession, "shards")
    rows = sharded(docs, **options)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
