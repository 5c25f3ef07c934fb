"""What the library takes from the caller's session."""

import tempfile
import uuid

#: The folders that `shared_folder` has given to this process.
_GIVEN: list[str] = []

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder for written intermediate tables, reachable by all executors.

    It lies under the folder that `spark.checkpoint.dir` names. Only a local-mode
    session that names none gets a temporary folder on this machine. Results read from it
    last until `remove_scratch`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _GIVEN.append(tempfile.mkdtemp(prefix="quirework-"))
    else:
        _GIVEN.append(f"{root.rstrip('/')}/quirework-{uuid.uuid4().hex}")
    return _GIVEN[-1]


def remove_scratch(spark: SparkSession) -> int:
    """Delete all folders that this process had from `shared_folder`; how many there were.

    DataFrames that still read from them are of no use afterwards: write results first.
    """
    removed = 0
    while _GIVEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_GIVEN.pop())
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        removed += bool(files.exists(path) and files.delete(path, True))
    return removed


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table in the shared folder: lineage ends there."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
