"""Predicates as Columns, so that they compose and reach the scan where possible."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.constants import (
    DIFFICULTY_LEVELS,
    DOWNLOAD_EXTENSIONS,
    OPTIONS_PER_QUESTION,
    QUESTION_TYPES,
    TOPIC_MAX_CHARS,
)
from quirework.functions.text import hangul_ratio, is_blank
from quirework.operators.projections import compute_once


def has_suffix(name: Column, suffix: str) -> Column:
    return name.endswith(suffix)


def at_least(value: Column, low: int) -> Column:
    return value >= low


def equals_ignoring_case(value: Column, wanted: str) -> Column:
    return F.lower(value) == wanted.lower()


def has_suffix_ignoring_case(name: Column, suffix: str) -> Column:
    return F.lower(name).endswith(suffix.lower())


def has_extension(link: Column, extensions: tuple[str, ...] = DOWNLOAD_EXTENSIONS) -> Column:
    """The link ends in one of the extensions, in any case."""
    return F.rlike(link, F.lit(rf"(?i)\.(?:{'|'.join(extensions)})\z"))


def not_blank(text: Column) -> Column:
    return ~is_blank(text)


def all_of(*predicates: Column) -> Column:
    joined = predicates[0]
    for predicate in predicates[1:]:
        joined = joined & predicate
    return joined


def is_reliable(question: Column, min_confidence: float = 0.6) -> Column:
    """Structural checks on a question struct; never null.

    Confidence only counts when the extractor set it (above zero), and is compared
    as the double it arrives as, before any narrowing cast.
    """
    text = question["question_text"]
    options = question["answer_options"]
    confidence = F.coalesce(question["confidence"], F.lit(0.0))
    return all_of(
        F.coalesce(F.length(text) > 5, F.lit(False)),
        F.coalesce(F.size(options) == OPTIONS_PER_QUESTION, F.lit(False)),
        F.coalesce(
            F.forall(options, lambda o: F.coalesce(o["answer_text"] != "", F.lit(False))),
            F.lit(False),
        ),
        F.coalesce(hangul_ratio(text) > 0.5, F.lit(False)),
        (confidence <= 0) | (confidence >= min_confidence),
    )


def is_valid(question: Column) -> Column:
    """Required fields, enumerations, topic length, confidence range; never null."""

    def full(items: Column) -> Column:
        return F.coalesce(F.forall(items, lambda i: i.isNotNull()), F.lit(False))

    def allowed(value: Column, values: tuple[str, ...]) -> Column:
        return value.isNull() | value.isin(*values)

    options_ok = F.forall(
        question["answer_options"],
        lambda o: o["answer_text"].isNotNull()
        & full(o["answer_vocabulary_items"])
        & full(o["answer_grammar_patterns"]),
    )
    return all_of(
        question["question_text"].isNotNull(),
        F.coalesce(options_ok, F.lit(False)),
        full(question["question_vocabulary_items"]),
        full(question["question_grammar_patterns"]),
        allowed(question["question_type"], QUESTION_TYPES),
        allowed(question["difficulty_level"], DIFFICULTY_LEVELS),
        question["topic"].isNull() | (F.length(question["topic"]) <= TOPIC_MAX_CHARS),
        F.coalesce(question["confidence"], F.lit(0.0)).between(0.0, 1.0),
    )


def page_is_valid(questions: Column) -> Column:
    """One invalid question rejects the whole page."""
    return F.coalesce(F.forall(questions, is_valid), F.lit(False))


def keep_valid(df: DataFrame, questions: str = "questions", scope: str = "page") -> DataFrame:
    """Validate each page as a whole, or (`scope="row"`) drop single questions."""
    if scope == "page":
        return df.filter(page_is_valid(F.col(questions)))
    if scope == "row":
        return compute_once(df, questions, F.filter(F.col(questions), is_valid))
    raise ValueError(f"scope must be 'page' or 'row', not {scope!r}")


def keep_reliable(
    df: DataFrame, questions: str = "questions", min_confidence: float = 0.6
) -> DataFrame:
    """Keep the reliable questions of each page's array."""
    return df.withColumn(
        questions, F.filter(F.col(questions), lambda q: is_reliable(q, min_confidence))
    )
