"""Parquet and JSON tables: fixed-schema scans, counted writes, partition refresh."""

import uuid

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a missing path is an error, a given schema is applied as it is.

    A table that is missing because an overwrite was lost between its two renames is put
    in place first.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND" or not settle(spark, path):
            raise
        return reader.parquet(path)


def read_partition(
    spark: SparkSession, path: str, column: str, value, schema: T.StructType | None = None
) -> DataFrame:
    """One partition of a partitioned table; the others are not listed or read."""
    return read_table(spark, path, schema).filter(F.col(column) == value)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> int:
    """Write and return the row count, both in the same pass over the data.

    Partitioned writes are rebalanced first: each partition value gets few, evenly
    sized files, and the rows of a hot value are split over several tasks.

    Overwriting is staged: the rows go to a folder beside the table, which takes the table's
    place by renaming once all are written. A job that is lost before leaves the old table
    whole, and a query can overwrite a table that it reads. What lies under or above such a
    table can't be overwritten by the query. Where renaming is not atomic (object stores),
    readers must wait for the job.
    """
    counted = Observation()
    out = df.hint("rebalance", *partition_by) if partition_by else df
    staged = None
    if mode == "overwrite" and hasattr(df, "_jdf"):  # a remote session has no file systems
        refuse_nested_input(df, path)
        settle(df.sparkSession, path)
        staged = _Folder(df.sparkSession, path).beside(f"{uuid.uuid4().hex}.new")
    writer = out.observe(counted, F.count(F.lit(1)).alias("n")).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(str(staged) if staged else path)
        if staged:
            replace_by(df.sparkSession, path, staged)
    except Exception:
        if staged and not _Folder(df.sparkSession, path).pending():
            staged.delete()
        raise
    return counted.get["n"]


class _Folder:
    """A folder in a Hadoop file system."""

    def __init__(self, spark: SparkSession, path):
        self.spark, jvm = spark, spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path(str(path).rstrip("/"))
        self.files = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.path = self.path.makeQualified(self.files.getUri(), self.files.getWorkingDirectory())

    def __str__(self) -> str:
        return self.path.toString()

    def beside(self, suffix: str) -> "_Folder":
        """Hidden from listings of the parent by its leading dot."""
        return _Folder(self.spark, f"{self.path.getParent().toString().rstrip('/')}/.{self.path.getName()}.{suffix}")

    def exists(self) -> bool:
        return self.files.exists(self.path)

    def delete(self) -> None:
        self.files.delete(self.path, True)

    def rename(self, to: "_Folder") -> None:
        if not self.files.rename(self.path, to.path):
            raise OSError(f"{self} could not be renamed to {to}")

    def pending(self) -> str | None:
        """The staged folder that a manifest beside this table names."""
        manifest = self.beside("replacing")
        if not manifest.exists():
            return None
        found = self.files.open(manifest.path)
        try:
            return found.readUTF()
        finally:
            found.close()


def replace_by(spark: SparkSession, path: str, staged: _Folder) -> None:
    """Put a staged folder, all written, in a table's place.

    A manifest that names it comes first; from then on the new rows count, and `settle`
    finishes what a lost driver left.
    """
    manifest = _Folder(spark, path).beside("replacing")
    out = manifest.files.create(manifest.path, False)
    try:
        out.writeUTF(str(staged))
    finally:
        out.close()
    settle(spark, path)


def settle(spark: SparkSession, path: str) -> bool:
    """Finish an overwrite whose manifest is there; whether there was one."""
    table = _Folder(spark, path)
    named = table.pending()
    if named is None:
        return False
    staged, retired = _Folder(spark, named), table.beside("retired")
    if staged.exists():
        if table.exists():
            if retired.exists():
                retired.delete()
            table.rename(retired)
        staged.rename(table)
    table.beside("replacing").delete()
    if retired.exists():
        retired.delete()
    return True


def _input_roots(df: DataFrame) -> list[str]:
    """Root paths of the file relations in the plan, of either kind, not the files under them.

    The analyzed plan shows what a cached table reads, too.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        try:
            if kind == "LogicalRelation":
                roots = leaf.relation().location().rootPaths()
            elif kind in ("DataSourceV2Relation", "DataSourceV2ScanRelation"):
                roots = leaf.table().fileIndex().rootPaths()
            else:
                continue
        except Py4JError:  # a relation or table that is not made of files
            continue
        found += [roots.apply(k).toString() for k in range(roots.size())]
    return found


def refuse_nested_input(df: DataFrame, path: str) -> None:
    """An error if the query reads a folder around `path`, or one within it."""
    mine = f"{_Folder(df.sparkSession, path)}/"
    for root in _input_roots(df):
        other = root.rstrip("/") + "/"
        if mine != other and (mine.startswith(other) or other.startswith(mine)):
            raise ValueError(f"{path} is read by this query (as {root}); write elsewhere")


def write_checked(df: DataFrame, path: str, **options) -> int:
    """`write_table`, then compare with a count taken from the files' footers."""
    written = write_table(df, path, **options)
    stored = df.sparkSession.read.parquet(path).count()
    if stored != written:
        raise RuntimeError(f"{path}: wrote {written} rows, found {stored}")
    return written


def write_tables(tables: dict[str, DataFrame], base: str) -> dict[str, int]:
    """Write each table under `base`; returns rows per table. One job for each."""
    return {name: write_checked(df, f"{base}/{name}") for name, df in tables.items()}


def refresh_partition(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Replace only the partitions that occur in `df`; others keep their files."""
    counted = Observation()
    (
        df.hint("rebalance", *partition_by)
        .observe(counted, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return counted.get["n"]


def export_examples(df: DataFrame, path: str, split: str = "split", fmt: str = "json") -> int:
    """Training-set export: one folder per split, JSON lines or Parquet."""
    return write_table(df, path, partition_by=[split], fmt=fmt)
