"""One row per document page, with the file's metadata."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.keys import hash_key
from quirework.functions.labels import exam_edition
from quirework.functions.text import char_count, is_blank, word_count
from quirework.operators.aggregates import first_non_null
from quirework.operators.joins import keep_existing
from quirework.operators.predicates import equals_ignoring_case, has_suffix_ignoring_case
from quirework.operators.projections import conform, stamp_time
from quirework.schemas import PAGES_RAW


def paper_files(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Metadata of the test papers that exist as PDF files, keyed and stamped with
    their edition. The key depends on folder and file name only, so it is the same
    in every run."""
    wanted = metadata.filter(
        has_suffix_ignoring_case(F.col("filename"), ".pdf")
        & equals_ignoring_case(F.col("file_type"), "test paper")
    )
    return keep_existing(wanted, files, "source_pdf_path").withColumns(
        {
            "exam_id": hash_key("exam_folder", "filename"),
            "exam_edition": exam_edition(F.col("exam_folder"), F.col("exam_number")),
        }
    )


def pages_raw(
    metadata: DataFrame,
    files: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    as_of: str | None = None,
) -> DataFrame:
    """Metadata, files and parsed pages as one table.

    `parse` adds `page_count, page_number, raw_text` to each file's row, one row per
    page; see `hooks.parse_documents`. The metadata travels with the file through
    the parser, so page texts are never shuffled.
    """
    pages = parse(paper_files(metadata, files)).filter(F.col("page_number").isNotNull())
    text = F.col("raw_text")
    counted = pages.withColumns(
        {"word_count": word_count(text), "char_count": char_count(text)}
    )
    return conform(stamp_time(counted, "processed_at", as_of), PAGES_RAW)


def folder_editions(papers: DataFrame, order: str = "record") -> DataFrame:
    """Edition per folder: the first known one in record order, else the folder name."""
    return first_non_null(papers, ["exam_folder"], "exam_edition", order, F.col("exam_folder"))


def file_audit(parsed: DataFrame) -> DataFrame:
    """One row for each parsed file: status, pages, blank pages and the error, if any."""
    blank = F.count_if(F.col("page_number").isNotNull() & is_blank(F.col("raw_text")))
    return parsed.groupBy("exam_folder", "filename", "source_pdf_path").agg(
        F.max("status").alias("status"),
        F.count("page_number").alias("n_pages"),
        blank.alias("n_blank"),
        F.max("error").alias("error"),
    )


def folder_audit(files: DataFrame) -> DataFrame:
    """(exam_folder, n_files, n_with_pages) out of a file audit, folders without data too."""
    return files.groupBy("exam_folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("n_pages") > 0).alias("n_with_pages")
    )
