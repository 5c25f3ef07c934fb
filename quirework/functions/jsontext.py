"""Repairs for JSON that arrives wrapped in free text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.constants import SPACE, WORD


def json_span(text: Column) -> Column:
    """Widest {...} span; null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def drop_bad_escapes(text: Column) -> Column:
    r"""Remove `\u` that four hex digits do not follow."""
    return F.regexp_replace(text, r"\\u(?![0-9a-fA-F]{4})", "")


def trim_keys(text: Column) -> Column:
    """Remove white space inside the quotes of object keys."""
    return F.regexp_replace(text, rf'"[{SPACE}]*([{WORD}]+)[{SPACE}]*"[{SPACE}]*:', '"$1":')
