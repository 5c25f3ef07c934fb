"""Text cleaning and measuring as native expressions.

Flags: `m` makes ^ and $ work per line, `d` makes \\n the only line end. Repeated
groups are possessive, so a run of any length is matched in a loop and cannot
exhaust the regex engine's stack. Patterns open with a test of one character, so
that places where nothing can start are passed over quickly.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.constants import (
    CIRCLED_DIGITS,
    FOREIGN_SCRIPT,
    NOT_HANGUL,
    NOT_SPACE,
    SPACE,
    SPACE_CHARS,
    WORD,
)

# The patterns of the cleaning rules. They must stay exactly as they are.
_NUMBER = rf"\p{{Nd}}{{1,3}}(?![{WORD}])"
_NUMBER_BLOCK = rf"(?=\p{{Nd}})(?<![{WORD}]){_NUMBER}(?:[{SPACE}]{_NUMBER}){{5,}}+"
_MARKUP = (
    rf"(?md)(?=[<\-=*＜])(?:<[^>]+>[^{WORD}{SPACE}]*|-{{10,}}|={{5,}}"
    rf"|＜보[{SPACE}]*기＞|\*[{SPACE}]*$)"
)
_POINTS = r"\(\p{Nd}점\)"
_HEADER_LINE = (
    rf"(?md)^(?:제\p{{Nd}}+회[^{SPACE}]*.*|TOPIK[{SPACE}]+[IⅠ]+.*|\p{{Nd}}{{1,2}})"
    rf"[{SPACE}]*$"
)


def strip_space(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def remove_foreign_script(text: Column) -> Column:
    """Drop kana and CJK ideographs."""
    return F.regexp_replace(text, FOREIGN_SCRIPT, "")


def remove_number_blocks(text: Column) -> Column:
    """Drop six or more 1-3 digit numbers with one white-space character between."""
    return F.regexp_replace(text, _NUMBER_BLOCK, "")


def remove_markup(text: Column) -> Column:
    """Drop tags with trailing debris, rulers, example markers, line-end asterisks."""
    return F.regexp_replace(text, _MARKUP, "")


def normalize_structure(text: Column) -> Column:
    """Circled digits to `N.`, then drop point labels and header or number lines."""
    for circled, plain in CIRCLED_DIGITS.items():
        text = F.replace(text, F.lit(circled), F.lit(plain))
    return F.regexp_replace(F.regexp_replace(text, _POINTS, ""), _HEADER_LINE, "")


def collapse_blank_lines(text: Column) -> Column:
    """At most one empty line in a row; no white space at the ends."""
    return strip_space(F.regexp_replace(text, r"\n\n\n+", "\n\n"))


def clean_text(text: Column, min_chars: int = 0) -> Column:
    """The whole cleaning chain, to be applied exactly once (it is not idempotent).

    Texts of at most `min_chars` characters are left as they are when it is set.
    """
    cleaned = text
    for step in (
        remove_foreign_script,
        remove_number_blocks,
        remove_markup,
        normalize_structure,
        collapse_blank_lines,
    ):
        cleaned = step(cleaned)
    if min_chars:
        return F.when(F.length(text) > min_chars, cleaned).otherwise(text)
    return cleaned


def hangul_ratio(text: Column) -> Column:
    """Hangul syllables over non-space characters; 0 for empty text."""
    hangul = F.length(F.regexp_replace(text, NOT_HANGUL, ""))
    spaces = F.length(F.regexp_replace(text, NOT_SPACE + "+", ""))
    visible = F.length(text) - spaces
    return hangul / F.greatest(visible, F.lit(1))


def word_count(text: Column) -> Column:
    """Number of white-space separated tokens."""
    return F.regexp_count(text, F.lit(NOT_SPACE + "+"))


def char_count(text: Column) -> Column:
    """Number of code points."""
    return F.length(text)


def is_blank(text: Column) -> Column:
    """True when nothing but white space is left."""
    return ~F.rlike(text, F.lit(NOT_SPACE))


def render_template(template: str, **slots: Column) -> Column:
    """Fill `{name}` slots of a template with column values.

    The template is cut at the slots, so text that a column brings in is never
    searched for further slots.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        found = [(rest.find("{" + n + "}"), n) for n in slots]
        found = [f for f in found if f[0] >= 0]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(slots[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts) if parts else F.lit("")
