"""From pages with question arrays to keyed question and option rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.keys import hash_key


def explode_questions(df: DataFrame, lineage: list[str], questions: str = "questions") -> DataFrame:
    """One row per question with its page's columns, position and key."""
    rows = df.select(*lineage, F.posexplode(questions).alias("question_pos", "q"))
    return rows.select(
        hash_key(
            "exam_id", "page_number", F.col("q.question_text"), F.col("q.question_stimulus")
        ).alias("question_id"),
        *lineage,
        "question_pos",
        "q.*",
    )


def explode_answers(questions: DataFrame) -> DataFrame:
    """One row per option with the question's key, the printed position and a key."""
    rows = questions.select(
        "question_id", F.posexplode("answer_options").alias("option_pos", "o")
    )
    return rows.select(
        hash_key("question_id", F.col("o.answer_text")).alias("answer_id"),
        "question_id",
        "option_pos",
        "o.*",
    )
