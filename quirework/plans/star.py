"""Dimensions and facts from the page table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.constants import FIRST_CONTENT_PAGE, READING_PAPER_SUFFIX
from quirework.functions.keys import hash_key
from quirework.functions.text import clean_text
from quirework.operators.aggregates import keep_first, one_per_key
from quirework.operators.nested import explode_answers, explode_questions
from quirework.operators.predicates import has_suffix, keep_reliable, keep_valid, not_blank
from quirework.operators.projections import (
    compute_once,
    conform,
    fill_text,
    rename,
    stamp_date,
)
from quirework.schemas import (
    DIM_ANSWER,
    DIM_EXAM,
    DIM_FILE,
    DIM_QUESTION,
    FACT_DOWNLOAD,
    FACT_QA,
    PRINTED_ANSWER,
)


def keyed_pages(pages: DataFrame) -> DataFrame:
    """Pages with file and download keys."""
    file_id = hash_key("filename", "source_pdf_path", "source_url")
    return pages.withColumn("file_id", file_id).withColumn(
        "download_id", hash_key("download_date", "download_status", "exam_id", "file_id")
    )


def dim_exam(base: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per exam key; `extra` adds string columns such as year or session."""
    names = {"label": "exam_name", "level": "topik_level", "section": "exam_section"}
    schema = T.StructType(list(DIM_EXAM))
    for name in extra:
        schema.add(name, T.StringType())
    return one_per_key(conform(rename(base, names), schema), "exam_id")


def dim_file(base: DataFrame) -> DataFrame:
    """One row per file key."""
    return one_per_key(conform(base, DIM_FILE), "file_id")


def fact_download(base: DataFrame, as_of: str | None = None, strict: bool = True) -> DataFrame:
    """One row per distinct download event. `strict=False` turns bad dates to null."""
    events = base.withColumnRenamed("processed_at", "bronze_processed_at")
    stamped = stamp_date(events, "silver_processed_at", as_of)
    return conform(stamped, FACT_DOWNLOAD, strict).distinct()


def bad_dates(base: DataFrame) -> DataFrame:
    """(download_id, download_date) of the download events whose date can't be read."""
    date = F.col("download_date")
    bad = date.isNotNull() & date.try_cast("date").isNull()
    return base.filter(bad).select("download_id", date.cast("string").alias("download_date")).distinct()


def content_pages(
    pages: DataFrame,
    suffix: str = READING_PAPER_SUFFIX,
    first_page: int = FIRST_CONTENT_PAGE,
) -> DataFrame:
    """Cleaned, non-blank pages of the wanted papers, cover pages left out.

    Both filters reach the Parquet scan. A suffix such as `I-Reading-...` also
    matches `II-Reading-...`; the suffix is the caller's.
    """
    wanted = pages.filter(
        has_suffix(F.col("filename"), suffix) & (F.col("page_number") >= first_page)
    )
    filled = fill_text(wanted, "raw_text").select(
        "exam_id", "filename", "page_number", "raw_text"
    )
    cleaned = compute_once(filled, "clean_text", clean_text(F.col("raw_text")))
    return cleaned.drop("raw_text").filter(not_blank(F.col("clean_text")))


def reliable_questions(
    extracted: DataFrame, min_confidence: float = 0.3, scope: str = "page"
) -> DataFrame:
    """Question rows from extracted pages that pass validation and reliability."""
    valid = keep_valid(extracted.filter(F.col("status") == "ok"), scope=scope)
    return explode_questions(
        keep_reliable(valid, min_confidence=min_confidence), ["exam_id", "page_number"]
    )


def dim_question(questions: DataFrame) -> DataFrame:
    """One row per question key; of repeats on a page the first one stays."""
    order = ["question_pos", "question_type", "topic", "difficulty_level", "confidence"]
    unique = keep_first(questions, ["question_id"], order)
    return conform(rename(unique, {"question_text": "raw_question_text"}), DIM_QUESTION)


def dim_answer(questions: DataFrame, with_position: bool = False) -> DataFrame:
    """One row per option key. Which option is right is not known, so it is null.

    `with_position` adds `option_pos`, the printed order, which the fixed schema
    does not carry.
    """
    options = keep_first(explode_answers(questions), ["answer_id"], ["option_pos"])
    named = options.withColumnRenamed("answer_text", "raw_answer_text").withColumn(
        "is_correct", F.lit(None).cast("boolean")
    )
    return conform(named, PRINTED_ANSWER if with_position else DIM_ANSWER)


def fact_qa(answers: DataFrame, questions: DataFrame, text: str | None = None) -> DataFrame:
    """Keys of exam, question and answer for every option.

    Both sides are made unique before the join (map-side first), so no distinct is
    needed after it and adaptive execution is free to split hot question keys.

    With `text`, the column of the options' texts, `answers` needs no `answer_id`: the key is
    made after the join. Within a question there is one key for each text, so the rows are the
    same, and both shuffles carry short texts in place of digests, which don't compress.
    """
    linked = answers.select("question_id", text or "answer_id").distinct().join(
        questions.select("question_id", "exam_id").distinct(), "question_id"
    )
    if text:
        linked = linked.withColumn("answer_id", hash_key("question_id", text))
    keyed = linked.withColumn("qa_id", hash_key("exam_id", "question_id", "answer_id"))
    return conform(keyed, FACT_QA)


def fact_qa_of_pages(questions: DataFrame) -> DataFrame:
    """The same rows as `fact_qa` of the two dimensions, straight from question rows.

    Questions and options are unfolded in one pass over the pages: a question's key tells its
    exam, and an option's key its question, so neither dimension is needed, nor a join.
    """
    options = questions.select("exam_id", "question_id", F.explode("answer_options").alias("o"))
    linked = options.select(
        "exam_id", "question_id", hash_key("question_id", F.col("o.answer_text")).alias("answer_id")
    ).distinct()
    keyed = linked.withColumn("qa_id", hash_key("exam_id", "question_id", "answer_id"))
    return conform(keyed, FACT_QA)


def incomplete_questions(questions: DataFrame, answers: DataFrame, wanted: int = 4) -> DataFrame:
    """Questions left with fewer distinct options than `wanted`."""
    counts = answers.groupBy("question_id").agg(F.count_distinct("answer_id").alias("n_options"))
    return (
        questions.select("question_id")
        .join(counts, "question_id", "left")
        .select("question_id", F.coalesce("n_options", F.lit(0)).alias("n_options"))
        .filter(F.col("n_options") < wanted)
    )
