"""Facts read out of folder names, link labels and headings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.constants import FILE_TYPES, LEVELS, MONTHS, SECTIONS, SPACE
from quirework.functions.text import strip_space

_ORDINAL = r"(?i)(\p{Nd}+)(?:st|nd|rd|th)"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def ordinal_suffix(digits: Column) -> Column:
    """English suffix for a string of digits; works on the digits, so any length."""
    tens = F.right(digits, F.lit(2)).cast("int")
    unit = F.right(digits, F.lit(1))
    return (
        F.when(tens.between(10, 20), "th")
        .when(unit == "1", "st")
        .when(unit == "2", "nd")
        .when(unit == "3", "rd")
        .otherwise("th")
    )


def exam_edition(folder: Column, number: Column) -> Column:
    """`102nd` from the folder name, else from the exam number, else null."""
    digits = strip_space(number.cast("string"))
    plain = F.regexp_replace(digits, "^0+(?=[0-9])", "")
    from_number = F.when(
        F.rlike(digits, F.lit(r"^[0-9]+\z")), F.concat(plain, ordinal_suffix(plain))
    )
    return F.coalesce(F.lower(_found(folder, _ORDINAL, 0)), from_number)


def exam_number(label: Column, filename: Column) -> Column:
    """Digits before an ordinal suffix, label first, then file name."""
    return F.coalesce(_found(label, _ORDINAL), _found(filename, _ORDINAL))


def year_from_heading(heading: Column) -> Column:
    return _found(heading, rf"(?i)Year[{SPACE}]+(\p{{Nd}}{{4}})")


def month_number(text: Column) -> Column:
    """Number of the first month, in calendar order, whose name occurs in the text."""
    lowered = F.lower(text)
    number = None
    for i, month in enumerate(MONTHS, start=1):
        hit = F.contains(lowered, F.lit(month))
        number = F.when(hit, i) if number is None else number.when(hit, i)
    return number


def month_name(number: Column) -> Column:
    names = F.array(*[F.lit(m.capitalize()) for m in MONTHS])
    return F.get(names, number - 1)


def season(number: Column) -> Column:
    """Spring for March-June, Fall for September-December, else Other; null stays."""
    return (
        F.when(number.isNull(), None)
        .when(number.between(3, 6), "Spring")
        .when(number.between(9, 12), "Fall")
        .otherwise("Other")
    )


def _first_contained(text: Column, values: tuple[str, ...]) -> Column:
    chain = None
    for value in values:
        hit = F.contains(text, F.lit(value))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def label_class(label: Column) -> dict[str, Column]:
    """Level, section and file type named in a link label; null when absent."""
    upper = F.upper(label)
    return {
        "level": _first_contained(upper, LEVELS),
        "section": F.initcap(_first_contained(upper, SECTIONS)),
        "file_type": F.initcap(_first_contained(upper, FILE_TYPES)),
    }
