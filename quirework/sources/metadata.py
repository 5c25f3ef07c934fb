"""Per-folder metadata records, file listings and crawled pages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.schemas import METADATA
from quirework.sources.files import is_known, list_tree, read_contents
from quirework.sources.tables import write_table


_LOCAL = "^file:(?://)?(?=/)"


def _decoded(text: Column) -> Column:
    # File paths of a scan are percent-encoded; a plus sign stands for itself.
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def folder_of(path: Column) -> Column:
    """Name of the folder a file lies in; for `name=value` folders, the value."""
    folder = _decoded(F.try_element_at(F.split(path, "/"), F.lit(-2)))
    value = F.regexp_extract(folder, "^[^=]+=(.*)", 1)
    return F.when(value != "", _decoded(value)).otherwise(folder)


def parent_of(path: Column) -> Column:
    """Folder path of a file, without the `file:` scheme of local paths."""
    folder = _decoded(F.regexp_replace(path, r"/[^/]*\z", ""))
    return F.regexp_replace(folder, _LOCAL, "")


def _json_texts(
    spark: SparkSession, root: str, schema: T.StructType, pattern: str, json_array: bool
) -> DataFrame:
    """Files, or lines of them, with their records; `_records` is null where they are broken."""
    texts = (
        spark.read.text(f"{root}/{pattern}", wholetext=json_array)
        .select("value", F.col("_metadata.file_path").alias("_path"))
    )
    if json_array:
        records = F.from_json("value", T.ArrayType(schema))
        whole = F.json_array_length("value").isNotNull() & ~F.exists(records, F.isnull)
        return texts.withColumn("_records", F.when(whole, records))
    record = F.when(F.startswith(F.get_json_object("value", "$"), F.lit("{")), F.from_json("value", schema))
    lines = texts.filter(F.trim("value") != "")
    return lines.withColumn("_records", F.when(record.isNotNull(), F.array(record)))


def read_metadata(
    spark: SparkSession,
    root: str,
    schema: T.StructType = METADATA,
    pattern: str = "*/metadata.json",
    json_array: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Metadata records of every folder under `root`, with lineage columns.

    Missing keys are null, except that file name and type become empty. A file is
    one JSON array, and `record` the position in it from 0; `json_array=False` reads JSON
    lines, which also split. A file (or line) that is none fails the job; with
    `strict=False` it gives no records, and `broken_metadata` reports it.
    """
    texts = _json_texts(spark, root, schema, pattern, json_array)
    records = F.col("_records")
    if strict:
        message = F.concat(F.lit("no JSON metadata: "), F.col("_path"))
        records = F.coalesce(records, F.raise_error(message).cast(texts.schema["_records"].dataType))
    raw = texts.select("_path", F.posexplode(records).alias("record", "_row")).select(
        "_row.*", *(["record"] if json_array else []), "_path"
    )
    filled = {
        c: F.coalesce(F.col(c), F.lit("")) for c in ("filename", "file_type") if c in raw.columns
    }
    return (
        raw.withColumns(filled)
        .withColumn("exam_folder", folder_of(F.col("_path")))
        .withColumn(
            "source_pdf_path", F.concat_ws("/", parent_of(F.col("_path")), F.col("filename"))
        )
        .drop("_path")
    )


def broken_metadata(
    spark: SparkSession,
    root: str,
    schema: T.StructType = METADATA,
    pattern: str = "*/metadata.json",
    json_array: bool = True,
) -> DataFrame:
    """(exam_folder, path, content) of metadata files, or lines, that can't be read.

    Spark's scan skips files of no bytes: their folders are like those without a file.
    """
    broken = _json_texts(spark, root, schema, pattern, json_array).filter(F.col("_records").isNull())
    return broken.select(
        folder_of(F.col("_path")).alias("exam_folder"),
        F.col("_path").alias("path"),
        F.col("value").alias("content"),
    )


def write_metadata(df: DataFrame, path: str, folder: str = "exam_folder") -> int:
    """JSON lines per folder, text written as it is (no escaping beyond JSON's own)."""
    return write_table(df, path, partition_by=[folder], fmt="json")


def list_files(spark: SparkSession, root: str, pattern: str = "*.[pP][dD][fF]") -> DataFrame:
    """(source_pdf_path, size_kb) of files in any folder under `root`, content unread.

    Tasks list the folders. Only a store that they can't open is listed by Spark, on the driver.
    """
    if is_known(root):
        files = list_tree(spark, root, pattern)
    else:
        files = read_contents(spark, root, pattern).drop("content")
    return files.select(
        F.regexp_replace("path", _LOCAL, "").alias("source_pdf_path"),
        F.round(F.col("size") / 1024, 1).alias("size_kb"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Crawled pages: (page_id, url, html)."""
    return spark.read.schema("page_id bigint, url string, html string").parquet(path)
