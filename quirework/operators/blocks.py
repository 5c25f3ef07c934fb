"""Question blocks in page Markdown, read into an array of question structs.

Everything happens inside the page's row: no shuffle, no Python worker. A page is
cut at its question headings, each piece at its section headings, and the answers
at their option markers (not at line ends: words may stand one per line).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.constants import SPACE
from quirework.functions.text import strip_space
from quirework.operators.projections import compute_once
from quirework.schemas import QUESTIONS

# The block grammar.
_QUESTION_HEADING = r"(?md)^##[ \t]+Question[ \t]+(?=\p{Nd})"
_HEADING = r"(?md)^#{2,3}[ \t]+"
_STIMULUS = "Question Stimulus"
_REFERENCE = "Reference (?:Image|Text)"
_ANSWERS = "Answers"
_OPTION_MARK = rf"(?:^|(?<=[{SPACE}]))(?:[①②③④]|[1-4]\.(?!\p{{Nd}}))[{SPACE}]*"


def _section(sections: Column, title: str) -> Column:
    """Text of the first section with this title; null if missing or empty."""
    titled = F.filter(sections, lambda s: F.rlike(s, F.lit(rf"\A{title}[ \t]*(?:\n|\z)")))
    body = F.regexp_replace(F.get(titled, F.lit(0)), rf"\A{title}[ \t]*", "")
    # A one-item filter names the text once; `nullif` would compute it twice.
    return F.get(F.filter(F.array(strip_space(body)), lambda t: t != ""), F.lit(0))


def _after_first(pieces: Column) -> Column:
    # The length only has to exceed any array's; naming the size would split twice.
    return F.slice(pieces, 2, 2_000_000_000)


def _options(answers: Column) -> Column:
    texts = _after_first(F.split(F.coalesce(answers, F.lit("")), _OPTION_MARK))
    empty = F.array().cast("array<string>")
    return F.transform(
        texts,
        lambda t: F.struct(
            F.regexp_replace(strip_space(t), rf"[{SPACE}]+", " ").alias("answer_text"),
            empty.alias("answer_vocabulary_items"),
            empty.alias("answer_grammar_patterns"),
        ),
    )


def question_pieces(text: Column) -> Column:
    """The page cut at its question headings; what precedes the first is dropped."""
    return _after_first(F.split(text, _QUESTION_HEADING))


def question_number(piece: Column) -> Column:
    return F.regexp_extract(piece, r"^\p{Nd}+", 0).try_cast("int")


def segment_questions(text: Column) -> Column:
    """array<question> found in a page; empty when the page has no block headings.

    Classification fields stay null: the text alone does not carry them.
    """
    empty = F.array().cast("array<string>")
    missing = F.lit(None).cast("string")
    cut = F.transform(question_pieces(text), lambda piece: F.split(piece, _HEADING))
    return F.transform(
        cut,
        lambda sections: F.struct(
            _section(sections, _REFERENCE).alias("question_text"),
            _section(sections, _STIMULUS).alias("question_stimulus"),
            _options(_section(sections, _ANSWERS)).alias("answer_options"),
            missing.alias("question_type"),
            empty.alias("question_vocabulary_items"),
            empty.alias("question_grammar_patterns"),
            missing.alias("topic"),
            missing.alias("difficulty_level"),
            F.lit(0.0).alias("confidence"),
        ),
    ).cast(QUESTIONS)


def segment_pages(
    df: DataFrame, text: str, questions: str = "questions", status: str = "status"
) -> DataFrame:
    """Add the page's questions and a status: `ok`, or `no_blocks` for dead letters."""
    return compute_once(df, questions, segment_questions(F.col(text))).withColumn(
        status, F.when(F.size(questions) > 0, "ok").otherwise("no_blocks")
    )
