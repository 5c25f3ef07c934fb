"""HTML extraction by pattern, one pass over each page, inside the row.

Lazy dots over a single character class are matched in a loop by the JVM, so
page length is not limited by the stack.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.constants import SPACE
from quirework.functions.text import strip_space

_ANCHOR_START = r"(?i)<a(?=[\s/])"
# The value of an attribute: in quotes, which may hold any sign, or up to a blank. A
# quote that is never closed counts as a bare value.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
# The rest of a tag up to its end, values in quotes as units.
_IN_TAG = rf"(?:[^>=]++|=\s*+{_VALUE})*+"
_NAME = r"(?:=[^\s=>/]*+|[^\s=>/]++)"
# What follows a link's start: other attributes, the address, then the text up to its end.
_HREF = (
    rf"(?is)^(?:[\s/]*+(?!href[\s=]){_NAME}(?:\s*+=\s*+{_VALUE})?+)*+[\s/]*+href\s*+=\s*+"
    r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
)
_LABEL = rf"(?is)^{_IN_TAG}>(.*?)(?:</a\s*>|\z)"
# A tag within a label or a heading; a bare `<` up to the next `>` as well.
_TAG = rf"<(?:/?[a-zA-Z]{_IN_TAG}|[^>]*+)>"
_HIDDEN = rf"(?is)<!--.*?-->|<script\b{_IN_TAG}>.*?</script\s*>|<style\b{_IN_TAG}>.*?</style\s*>"
_SEAM = "\ue000"  # private-use character that marks where a tag stood

_AMPERSAND = "\ue001"  # stands for a numbered `&`, which starts no further reference
_REFERENCE = r"^&#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));"

# Named character references, `&amp;` last so nothing decodes twice.
_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": "\u00a0",
    "&amp;": "&",
}


def drop_hidden(html: Column) -> Column:
    """Remove comments, scripts and style sheets."""
    return F.regexp_replace(html, _HIDDEN, "")


def _numbered(piece: Column) -> Column:
    """A piece that may start with a decimal or hexadecimal reference, with it decoded."""
    decimal = F.regexp_extract(piece, _REFERENCE, 1)
    code = F.conv(
        F.when(decimal != "", F.hex(decimal.cast("long"))).otherwise(
            F.nullif(F.regexp_extract(piece, _REFERENCE, 2), F.lit(""))
        ),
        16,
        10,
    ).cast("long")
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.when(code == 38, _AMPERSAND).when(
        known, F.decode(F.unhex(F.lpad(F.hex(F.when(known, code)), 8, "0")), "UTF-32")
    )
    rest = F.regexp_replace(piece, _REFERENCE, "")
    return F.when(code.isNull(), piece).otherwise(F.concat(F.coalesce(char, F.lit("\ufffd")), rest))


def unescape(text: Column) -> Column:
    """Named and numbered character references decoded, each once."""
    text = F.array_join(F.transform(F.split(text, "(?=&#)"), _numbered), "")
    for entity, char in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.replace(text, F.lit(_AMPERSAND), F.lit("&"))


def inner_text(fragment: Column) -> Column:
    """Text of a fragment, tags removed, white space as it stands."""
    return unescape(F.regexp_replace(fragment, _TAG, ""))


def stripped_text(fragment: Column) -> Column:
    """Text pieces between tags, each stripped, joined without a separator."""
    marked = unescape(F.regexp_replace(fragment, _TAG, _SEAM))
    return strip_space(
        F.regexp_replace(marked, rf"[{SPACE}]*{_SEAM}+[{SPACE}{_SEAM}]*", "")
    )


def anchors(html: Column) -> Column:
    """array<struct<href, label>> of all links with an href, in page order.

    The page is cut where links start, so a link that is never closed does not hide
    the next one; its label then ends there.
    """
    starts = F.slice(F.split(html, _ANCHOR_START), 2, 2_000_000_000)
    return F.transform(
        F.filter(starts, lambda a: F.rlike(a, F.lit(_HREF))),
        lambda a: F.struct(
            unescape(
                F.concat(*[F.regexp_extract(a, _HREF, group) for group in (1, 2, 3)])
            ).alias("href"),
            stripped_text(F.regexp_extract(a, _LABEL, 1)).alias("label"),
        ),
    )


def first_text(html: Column, tag: str) -> Column:
    """Text of the first element of this name; null when there is none."""
    fragment = F.regexp_extract(html, rf"(?is)<{tag}(?:\s{_IN_TAG})?>.*?</{tag}\s*>", 0)
    return F.when(fragment != "", inner_text(fragment))


def paragraph_texts(html: Column, limit: int) -> Column:
    """Texts of the first `limit` paragraphs (a report of the page head)."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<p(?:\s{_IN_TAG})?>(.*?)</p\s*>"), F.lit(1))
    return F.transform(F.slice(found, 1, limit), inner_text)


def heading_sections(html: Column) -> Column:
    """The page cut before every h2-h4; the first piece precedes any heading."""
    return F.split(html, r"(?i)(?=<h[2-4][\s>])")


def section_heading(section: Column) -> Column:
    """Lower-cased text of the heading a section starts with, null for none."""
    fragment = F.regexp_extract(section, rf"(?is)^<(h[2-4])(?:\s{_IN_TAG})?>.*?</\1\s*>", 0)
    return F.when(fragment != "", F.lower(stripped_text(fragment)))
