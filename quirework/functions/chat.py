"""Chat messages built from columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.constants import ASSISTANT_ANSWER, SYSTEM_PROMPT, USER_REQUEST


def fill(template: str, *values: Column) -> Column:
    """Put values into the `%s` slots in turn; any null value makes the whole null."""
    texts = template.split("%s")
    if len(texts) != len(values) + 1:
        raise ValueError(f"template has {len(texts) - 1} slots, got {len(values)} values")
    parts = [F.lit(texts[0])]
    for value, text in zip(values, texts[1:]):
        parts += [value, F.lit(text)]
    return F.concat(*parts)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_messages(
    level: Column,
    topic: Column,
    difficulty: Column,
    question_type: Column,
    stimulus: Column,
    question: Column,
    options: list[Column],
    system_prompt: str = SYSTEM_PROMPT,
) -> Column:
    """System text, user request and assistant answer as array<struct<role, content>>."""
    request = fill(USER_REQUEST, level, topic, difficulty, question_type)
    answer = fill(
        ASSISTANT_ANSWER, F.coalesce(stimulus, F.lit("")), question, *options
    )
    return F.array(
        message("system", F.lit(system_prompt)),
        message("user", request),
        message("assistant", answer),
    )
