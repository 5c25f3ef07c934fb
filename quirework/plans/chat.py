"""Chat examples, one for each question, and their export split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.constants import OPTIONS_PER_QUESTION, SYSTEM_PROMPT
from quirework.functions.chat import chat_messages
from quirework.functions.keys import hash_bucket
from quirework.operators.aggregates import pivot_slots
from quirework.operators.joins import equi_join
from quirework.operators.projections import conform
from quirework.operators.windows import first_rows
from quirework.schemas import CHAT_EXAMPLE

_SLOTS = list(range(1, OPTIONS_PER_QUESTION + 1))


def question_options(answers: DataFrame, order: list[str]) -> DataFrame:
    """`answer_1..answer_4` per question; later options are ignored.

    Each map task passes on at most four options per question, the window and the
    aggregate share one shuffle, and only three narrow columns take part in it.
    """
    ranked = first_rows(
        answers.select("question_id", "raw_answer_text", *order),
        ["question_id"],
        [F.col(c) for c in order],
        OPTIONS_PER_QUESTION,
        "answer_order",
    )
    return pivot_slots(
        ranked, ["question_id"], "answer_order", _SLOTS, "raw_answer_text", "answer_"
    )


def chat_examples(
    exams: DataFrame,
    questions: DataFrame,
    answers: DataFrame,
    option_order: list[str] | None = None,
    system_prompt: str = SYSTEM_PROMPT,
    drop_incomplete: bool = False,
) -> DataFrame:
    """One training example per question that has an exam and at least one option.

    Options come in `answer_id` order unless `option_order` names other columns,
    such as `option_pos`. A missing topic, type, level or option makes its message
    null; `drop_incomplete` leaves such examples out. Questions and exams must be
    unique by key. Messages are built last, so the long texts are not shuffled.
    """
    options = question_options(answers, option_order or ["answer_id"])
    levels = exams.select("exam_id", "topik_level")
    joined = equi_join(questions.join(options, "question_id"), levels, "exam_id")
    messages = chat_messages(
        level=F.col("topik_level"),
        topic=F.col("topic"),
        difficulty=F.col("difficulty_level"),
        question_type=F.col("question_type"),
        stimulus=F.col("question_stimulus"),
        question=F.col("raw_question_text"),
        options=[F.col(f"answer_{i}") for i in _SLOTS],
        system_prompt=system_prompt,
    )
    examples = conform(
        joined.withColumns({"training_id": F.col("question_id"), "messages": messages}),
        CHAT_EXAMPLE,
    )
    if drop_incomplete:
        return examples.filter(F.forall("messages", lambda m: m["content"].isNotNull()))
    return examples


def split_column(
    key: str,
    stratum: str | None = None,
    shares: tuple[int, int, int] = (80, 10, 10),
    stratum_shares: dict[str, tuple[int, int, int]] | None = None,
) -> Column:
    """train / validation / test from the key's hash bucket.

    Shares are percentages; a stratum can have its own. A record keeps its split
    across runs, whatever else the data holds, and no pass over it is needed.
    """

    def cut(parts: tuple[int, int, int]) -> Column:
        if sum(parts) != 100:
            raise ValueError(f"shares must add up to 100, got {parts}")
        return (
            F.when(bucket < parts[0], "train")
            .when(bucket < parts[0] + parts[1], "validation")
            .otherwise("test")
        )

    # The stratum enters the hash, so that splits of strata are drawn independently.
    salted = F.concat_ws("|", F.col(stratum), F.col(key).cast("string")) if stratum else key
    bucket = hash_bucket(salted)
    default = cut(shares)
    if not (stratum and stratum_shares):
        return default
    chosen = None
    for value, parts in stratum_shares.items():
        hit = F.col(stratum) == value
        chosen = F.when(hit, cut(parts)) if chosen is None else chosen.when(hit, cut(parts))
    return chosen.otherwise(default)


def split_examples(
    df: DataFrame,
    key: str = "training_id",
    stratum: str = "difficulty_level",
    min_confidence: float | None = None,
    shares: tuple[int, int, int] = (80, 10, 10),
    stratum_shares: dict[str, tuple[int, int, int]] | None = None,
) -> DataFrame:
    """Quality gate on confidence, then the split label; no shuffle."""
    kept = df if min_confidence is None else df.filter(F.col("confidence") >= min_confidence)
    return kept.withColumn("split", split_column(key, stratum, shares, stratum_shares))
