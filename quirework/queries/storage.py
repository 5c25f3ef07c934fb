"""Scans and sinks, each written to the shared folder and read back."""

from pyspark.sql import functions as F

from quirework.operators.hooks import parse_documents
from quirework.operators.projections import conform
from quirework.plans.chat import split_examples
from quirework.queries import derive as D
from quirework.schemas import METADATA
from quirework.session import shared_folder
from quirework.sources import files as Files
from quirework.sources import metadata as M
from quirework.sources import tables as T

c = F.col


def schema_scan(spark, d):
    """Two columns of the file and one that it lacks, which is null."""
    stored = spark.read.parquet(f"{d}/orders.parquet").schema
    schema = type(stored)([stored["o_orderkey"], stored["o_orderstatus"]]).add("o_note", "string")
    return T.read_table(spark, f"{d}/orders.parquet", schema)


def file_listing(spark, d):
    """Folders of the metadata files that were written, with whether they hold data."""
    path = shared_folder(spark)
    M.write_metadata(D.derive(spark, d, "documents", D.METADATA).drop("source_pdf_path"), path)
    files = M.list_files(spark, path, "*.json")
    return files.groupBy(M.folder_of(c("source_pdf_path")).alias("exam_folder")).agg(
        (F.max("size_kb") > 0).alias("has_data")
    )


def broken_metadata(spark, d):
    """Metadata of which every tenth record lost its last character, counted by folder."""
    path = shared_folder(spark)
    records = D.derive(spark, d, "documents", {**D.METADATA, "doc_id": "doc_id"})
    text = F.to_json(F.struct(*METADATA.names))
    cut = F.when(c("doc_id") % 10 == 9, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    T.write_table(records.select("exam_folder", cut.alias("value")), path, ["exam_folder"], fmt="text")
    broken = M.broken_metadata(spark, path, pattern="*/*.txt", json_array=False)
    read = M.read_metadata(spark, path, pattern="*/*.txt", json_array=False, strict=False)
    return (
        read.select("exam_folder", F.lit("read").alias("status"))
        .unionByName(broken.select("exam_folder", F.lit("broken").alias("status")))
        .groupBy("exam_folder", "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _document_files(spark, d):
    """Every document as a file of its source's folder; every tenth one is no UTF-8. The root."""
    root = shared_folder(spark)
    name = F.concat(c("source"), F.lit("/part="), c("doc_id") % 3, F.lit("/"), c("doc_id"), F.lit(".Txt"))
    broken = F.concat(F.unhex(F.lit("C328")), c("text").cast("binary"))
    docs = D.table(spark, d, "documents").select(
        name.alias("name"), F.when(c("doc_id") % 10 == 7, broken).otherwise(c("text").cast("binary")).alias("content")
    )
    Files.write_files(docs, root, "name", "content")
    return root


def listed_files(spark, d):
    """Paths under the root and kilobytes of files in nested folders, listed by tasks."""
    root = _document_files(spark, d)
    files = M.list_files(spark, root, "*.[tT][xX][tT]")
    inner = Files.located(root)[1]
    return files.select(F.replace("source_pdf_path", F.lit(inner + "/"), F.lit("")).alias("path"), "size_kb")


def parsed_files(spark, d):
    """Pages out of files' bytes; those of broken files are a row with the error's kind."""

    def lines_as_pages(data: bytes) -> dict[int, str]:
        return {i: line for i, line in enumerate(data.decode().split("\n"), start=1) if line.strip(" ")}

    files = Files.list_tree(spark, _document_files(spark, d), "*.Txt").withColumn("file", c("path"))
    dealt = Files.dealt_by_size(files, "size", 8 << 20)
    pages = parse_documents(dealt, "path", Files.of_content(lines_as_pages))
    return pages.select(
        F.regexp_extract("file", r"([0-9]+)\.Txt$", 1).cast("bigint").alias("doc_id"),
        "size", "status", "page_count", "page_number", "raw_text",
        F.regexp_extract("error", "^[A-Za-z]+", 0).alias("error"),
    )


def metadata_paths(spark, d):
    """Metadata with the path that folder and file name give, read back from its folders."""
    root = shared_folder(spark)
    records = D.derive(spark, d, "documents", D.METADATA).drop("source_pdf_path")
    M.write_metadata(records, root)
    back = M.read_metadata(spark, root, pattern="*/*.json", json_array=False)
    inner = Files.located(root)[1]
    return back.select("exam_folder", F.replace("source_pdf_path", F.lit(inner), F.lit("")).alias("path"))


def overwritten_input(spark, d):
    """A table overwritten by a query that reads it."""
    path = shared_folder(spark)
    docs = D.table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    T.write_table(docs, path, partition_by=["lang"])
    T.write_table(T.read_table(spark, path).withColumn("n_chars", c("n_chars") + 1), path, partition_by=["lang"])
    return T.read_table(spark, path)


def crawled_pages(spark, d):
    return M.read_pages(spark, f"{d}/pages.parquet").select(
        "page_id", "url", F.length("html").alias("html_chars")
    )


def partition_scan(spark, d):
    path = shared_folder(spark)
    docs = D.table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    T.write_table(docs, path, partition_by=["lang"])
    return T.read_partition(spark, path, "lang", "fr").select(
        "doc_id", "source", "lang", F.length("text").alias("chars")
    )


def written_counts(spark, d):
    docs = D.table(spark, d, "documents")
    tables = {
        "languages": docs.select("lang").distinct(),
        "texts": docs.select("doc_id", "text"),
        "orders": D.table(spark, d, "orders"),
    }
    counts = T.write_tables(tables, shared_folder(spark))
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows bigint")


def refreshed_partition(spark, d):
    path = shared_folder(spark)
    docs = D.table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    T.write_table(docs, path, partition_by=["lang"])
    redone = docs.filter(c("lang") == "de").withColumn("n_chars", c("n_chars") * 2)
    T.refresh_partition(redone, path, ["lang"])
    return T.read_table(spark, path).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


def metadata_round_trip(spark, d):
    path = shared_folder(spark)
    records = D.derive(spark, d, "documents", D.METADATA).drop("source_pdf_path")
    M.write_metadata(records, path)
    back = M.read_metadata(spark, path, pattern="*/*.json", json_array=False)
    return conform(
        back, type(METADATA)(list(METADATA)).add("exam_folder", "string")
    )


def exported_splits(spark, d):
    path = shared_folder(spark)
    docs = D.table(spark, d, "documents").select(
        c("doc_id").cast("string").alias("training_id"), c("lang").alias("difficulty_level"), "text"
    )
    T.export_examples(split_examples(docs), path)
    back = spark.read.schema("training_id string, difficulty_level string, text string, split string").json(path)
    return back.select("training_id", "split", F.length("text").alias("chars"))


QUERIES = {
    "schema_scan": (schema_scan, "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_note FROM orders"),
    "file_listing": (
        file_listing,
        f"""SELECT DISTINCT exam_folder, true AS has_data
        FROM ({D.as_sql('documents', D.METADATA)})""",
    ),
    "listed_files": (
        listed_files,
        """SELECT source || '/part=' || doc_id % 3 || '/' || doc_id || '.Txt' AS path,
          round((strlen(text) + CASE WHEN doc_id % 10 = 7 THEN 2 ELSE 0 END) / 1024.0::DOUBLE, 1) AS size_kb
        FROM documents""",
    ),
    "parsed_files": (
        parsed_files,
        """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines, doc_id % 10 = 7 AS bad,
            (strlen(text) + CASE WHEN doc_id % 10 = 7 THEN 2 ELSE 0 END)::BIGINT AS size FROM documents),
          n AS (SELECT *, list_max(list_filter(range(1, len(lines) + 1),
            lambda i: trim(lines[i], ' ') <> '')) AS last FROM l),
          p AS (SELECT doc_id, size, lines, last, unnest(range(1, last + 1)) AS i FROM n WHERE NOT bad)
        SELECT doc_id, size, 'ok' AS status, CAST(last AS INTEGER) AS page_count, CAST(i AS INTEGER) AS page_number,
          CASE WHEN trim(lines[i], ' ') = '' THEN '' ELSE lines[i] END AS raw_text, NULL AS error FROM p
        UNION ALL SELECT doc_id, size, CASE WHEN bad THEN 'failed' ELSE 'empty' END, NULL, NULL, NULL,
          CASE WHEN bad THEN 'UnicodeDecodeError' END FROM n WHERE bad OR last IS NULL""",
    ),
    "metadata_paths": (
        metadata_paths,
        f"""SELECT exam_folder, '/exam_folder=' || exam_folder || '/' || filename AS path
        FROM ({D.as_sql('documents', D.METADATA)})""",
    ),
    "overwritten_input": (
        overwritten_input,
        "SELECT doc_id, n_chars + 1 AS n_chars, lang FROM documents",
    ),
    "broken_metadata": (
        broken_metadata,
        f"""SELECT exam_folder, CASE WHEN doc_id % 10 = 9 THEN 'broken' ELSE 'read' END AS status,
          count(*) AS n
        FROM ({D.as_sql('documents', {'exam_folder': D.METADATA['exam_folder'], 'doc_id': 'doc_id'})})
        GROUP BY 1, 2""",
    ),
    "crawled_pages": (
        crawled_pages,
        "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages",
    ),
    "partition_scan": (
        partition_scan,
        """SELECT doc_id, source, lang, CAST(length(text) AS INTEGER) AS chars
        FROM documents WHERE lang = 'fr'""",
    ),
    "written_counts": (
        written_counts,
        """SELECT 'languages' AS table_name, count(DISTINCT lang) AS n_rows FROM documents
        UNION ALL SELECT 'texts', count(*) FROM documents
        UNION ALL SELECT 'orders', count(*) FROM orders""",
    ),
    "refreshed_partition": (
        refreshed_partition,
        """SELECT lang, count(*) AS n, CAST(sum(CASE WHEN lang = 'de' THEN 2 ELSE 1 END * n_chars)
        AS BIGINT) AS chars FROM documents GROUP BY 1""",
    ),
    "metadata_round_trip": (
        metadata_round_trip,
        D.as_sql("documents", {k: v for k, v in D.METADATA.items() if k != "source_pdf_path"}),
    ),
    "exported_splits": (
        exported_splits,
        """SELECT CAST(doc_id AS VARCHAR) AS training_id, CAST(length(text) AS INTEGER) AS chars,
          CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, CAST('0x' || md5(lang || '|' || doc_id)[1:8] AS BIGINT) % 100 AS b
          FROM documents)""",
    ),
}
