"""The three layer jobs: plain functions from tables to tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quirework import schemas as S
from quirework.functions.text import is_blank
from quirework.operators.aggregates import run_audit
from quirework.operators.blocks import segment_pages
from quirework.operators.hooks import parse_documents
from quirework.plans.bronze import file_audit, folder_audit, pages_raw
from quirework.plans.chat import chat_examples
from quirework.plans.stats import exam_stats
from quirework.plans import star
from quirework.session import written
from quirework.sources.files import dealt_by_size, of_content
from quirework.sources.metadata import list_files, read_metadata
from quirework.sources.tables import read_table, write_checked, write_table, write_tables


def run_bronze(
    spark: SparkSession,
    source: str,
    target: str,
    parser: Callable[[object], dict[int, str]],
    as_of: str | None = None,
    parallelism: int | None = None,
    audit_path: str | None = None,
    content: bool = False,
) -> dict[str, int]:
    """Parse the PDFs under `source` (a folder per exam) into the page table.

    `parser` is called with each file's path, inside the tasks; with `content`, with its
    bytes, which a task reads from the store, one file at a time. The list of files is small
    beside the work of parsing them: it is spread over `parallelism` tasks, or dealt by
    the files' sizes, 64 MB a task and one for each larger file. Returns the audit counts,
    taken in the same pass: pages, blank pages, files that failed or had no pages.

    With `audit_path`, what the parser gives is written to `<audit_path>/parsed` and read
    back, and `<audit_path>/files` has a row for each file, with the error of those that
    failed; `<audit_path>/folders` counts them by folder. A metadata file that can't be
    read stops the job; `broken_metadata` names such files.
    """
    metadata = read_metadata(spark, source)
    listed = written(list_files(spark, source), "files")
    audit = Observation()

    def parse(files: DataFrame) -> DataFrame:
        with_path = files.withColumn("_document", F.col("source_pdf_path"))
        if not parallelism:
            sizes = listed.select("source_pdf_path", (F.col("size_kb") * 1024).alias("_size"))
            with_path = dealt_by_size(with_path.join(sizes, "source_pdf_path", "left"), "_size").drop("_size")
        of_path = of_content(parser) if content else parser
        parsed = parse_documents(with_path, "_document", of_path, parallelism)
        if audit_path:
            write_table(parsed, f"{audit_path}/parsed")
            parsed = read_table(spark, f"{audit_path}/parsed")
        return parsed.observe(
            audit,
            F.count_if(is_blank(F.col("raw_text"))).alias("pages_blank"),
            F.count_if(F.col("status") == "failed").alias("files_failed"),
            F.count_if(F.col("status") == "empty").alias("files_empty"),
        )

    pages = pages_raw(metadata, listed, parse, as_of)
    counts = {"pages": write_checked(pages, target)} | audit.get
    if audit_path:
        write_table(file_audit(read_table(spark, f"{audit_path}/parsed")), f"{audit_path}/files")
        write_table(folder_audit(read_table(spark, f"{audit_path}/files")), f"{audit_path}/folders")
    return counts


def run_silver(
    spark: SparkSession,
    source: str,
    target: str,
    extract: Callable[[DataFrame], DataFrame] | None = None,
    as_of: str | None = None,
    min_confidence: float = 0.3,
) -> dict[str, int]:
    """Page table to dimensions and facts; returns rows per table.

    `extract` adds `questions` and `status` to pages with a `clean_text`; the
    default reads question blocks natively. Its output is written once, to
    `<target>/extracted`, so a slow or unrepeatable extractor never runs twice,
    not even when executors are lost. Dimensions are written even when no question
    was found. A date that is none becomes null, and its event stands in `bad_dates`,
    whose row count is returned like the others.
    """
    pages = read_table(spark, source, S.PAGES_RAW)
    extract = extract or (lambda df: segment_pages(df, "clean_text"))
    write_table(extract(star.content_pages(pages)), f"{target}/extracted")
    extracted = read_table(spark, f"{target}/extracted")

    base = star.keyed_pages(pages)
    questions = star.reliable_questions(extracted, min_confidence)
    counts = write_tables(
        {
            "dim_exam": star.dim_exam(base),
            "dim_file": star.dim_file(base),
            "dim_question": star.dim_question(questions),
            "dim_answer": star.dim_answer(questions, with_position=True),
            "fact_download": star.fact_download(base, as_of, strict=False),
            "bad_dates": star.bad_dates(base),
        },
        target,
    )
    facts = star.fact_qa(
        read_table(spark, f"{target}/dim_answer", S.DIM_ANSWER),
        read_table(spark, f"{target}/dim_question", S.DIM_QUESTION),
    )
    return counts | write_tables({"fact_qa": facts}, target)


def run_gold(
    spark: SparkSession,
    source: str,
    target: str,
    as_of: str | None = None,
    drop_incomplete: bool = False,
) -> dict[str, int]:
    """Dimensions to chat examples and exam statistics; returns rows per table.

    Options come in their printed order, which the silver job's answers carry.
    `drop_incomplete` leaves out examples with a message that could not be worded.
    """
    exams = read_table(spark, f"{source}/dim_exam", S.DIM_EXAM)
    questions = read_table(spark, f"{source}/dim_question", S.DIM_QUESTION)
    answers = read_table(spark, f"{source}/dim_answer", S.PRINTED_ANSWER)
    examples = chat_examples(
        exams, questions, answers, ["option_pos", "answer_id"], drop_incomplete=drop_incomplete
    )
    return write_tables(
        {
            "chat_examples": examples,
            "exam_stats": exam_stats(questions, answers, as_of),
        },
        target,
    )


def silver_audit(spark: SparkSession, silver: str) -> DataFrame:
    """(stage, status, n_rows) for extraction and for questions seen and kept."""
    extracted = read_table(spark, f"{silver}/extracted")
    kept = read_table(spark, f"{silver}/dim_question", S.DIM_QUESTION)
    seen = extracted.select(F.explode("questions"))
    return run_audit(
        {
            "page": (extracted, "status"),
            "question_seen": (seen.select(F.lit("seen").alias("status")), "status"),
            "question_kept": (kept.select(F.lit("kept").alias("status")), "status"),
        }
    )
