"""Files and tables in the folder that all executors share."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.session import shared_folder


def id_or_none(column: str) -> Column:
    """A row's id for a minimum: a row without one comes after all others, whatever their ids are."""
    return F.struct(F.col(column).isNull().alias("none"), F.col(column).cast("long").alias("id"))


def apart(rows: DataFrame, number: str, digest: str) -> DataFrame:
    """Rows with different digests get different numbers, which are 64 bits of the digests.

    Of ten billion some are expected to be equal by chance. Those few are numbered anew from
    their digests; only if these meet another number again is it an error.
    """
    met = rows.groupBy(number).agg(F.count("*").alias("met")).where("met > 1").select(number)
    if met.isEmpty():
        return rows
    # As many as there are collisions; the digests are different.
    again = F.broadcast(met.withColumnRenamed(number, "met"))
    moved = rows.join(again, F.col(number) == F.col("met"), "left").withColumn(
        number, F.when(F.col("met").isNull(), F.col(number)).otherwise(F.xxhash64(F.lit("again"), digest))
    )
    moved = written(moved.drop("met"), "apart")
    if not moved.groupBy(number).agg(F.count("*").alias("met")).where("met > 1").isEmpty():
        raise ValueError("two digests have the same number twice")
    return moved


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, with the scheme of the shared one."""
    return f"{shared_folder(spark)}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a written table: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_hot_key(rows: DataFrame, groups: DataFrame, key: str, share: int = 4096) -> DataFrame:
    """Each row with the columns of its group. `groups`: one row for each `key`, `n` (its rows).

    Groups of more than 1/`share` of all rows, fewer than `share` of them whatever the table's
    size, are broadcast, so that their rows aren't shuffled; the others meet by a shuffled join,
    in which none has more than that share. Null keys are equal. Both sides are read twice.
    """
    total = groups.agg(F.sum("n").alias("n")).first().n or 0
    found = groups.withColumnsRenamed({key: "group_key", "n": "group_n"})
    hot = F.col("group_n") * share > total
    same = F.col(key).eqNullSafe(F.col("group_key"))
    large, small = found.where(hot).drop("group_n"), found.where(~hot).drop("group_n")
    near = rows.join(F.broadcast(large), same).drop("group_key")
    far = rows.join(F.broadcast(large.select("group_key")), same, "left_anti").join(small, same).drop("group_key")
    return near.unionByName(far)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class NewFile:
    """Written under another name and renamed at the end: a lost task leaves no half file.

    Each attempt has a name of its own, so that two of them never write to one file.
    Readers take the names from the rows of the attempt that succeeded.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.uri = f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"
        self.files, self.path = located(self.uri)

    def __enter__(self):
        self.files.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.files.open_output_stream(f"{self.path}.part", compression=None)
        return self

    def write(self, data) -> None:
        self.out.write(data)

    def __exit__(self, kind, value, trace):
        self.out.close()
        if kind is None:
            self.files.move(f"{self.path}.part", self.path)


def read_bytes(uri: str) -> bytes:
    files, path = located(uri)
    with files.open_input_stream(path, compression=None) as f:
        return f.read()
