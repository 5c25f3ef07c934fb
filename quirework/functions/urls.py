"""URL parts, resolution against a page, and names derived from URLs.

Regular expressions are used in place of `parse_url`, whose strict parser gives
null for addresses with spaces or other stray characters.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#(?s:.*))?"
_ABSOLUTE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


def url_scheme(url: Column) -> Column:
    return F.regexp_extract(url, _SPLIT, 1)


def url_host(url: Column) -> Column:
    """Host with port, if any."""
    return F.regexp_extract(url, _SPLIT, 2)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _SPLIT, 3)


def cut_query_and_fragment(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*", 0)


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.regexp_extract(path, r"[^/]*\z", 0)


def file_name(url: Column) -> Column:
    """Last path segment without `;parameters`."""
    return F.regexp_extract(url_path(url), r"([^/;]*)(?:;[^/]*)?\z", 1)


def folder_name(url: Column) -> Column:
    """Last path segment without a leading `download-`, safe as a folder name."""
    path = F.regexp_replace(url_path(url), r";[^/]*\z", "")
    path = F.regexp_replace(path, r"/+\z", "")
    bare = F.regexp_replace(base_name(path), "^download-", "")
    safe = F.regexp_replace(bare, r'[<>:"/\\|?*]', "_")
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("unknown"))


def _resolve_dots(path: Column) -> Column:
    """Apply `.` and `..` segments; `..` above the root is dropped."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    closing = F.when(F.rlike(path, F.lit(r"/\.{1,2}\z")), "/").otherwise("")
    joined = F.concat(F.lit("/"), F.concat_ws("/", kept))
    return F.concat(joined, F.when(joined == "/", "").otherwise(closing))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute address of a link found on the page `base`."""
    scheme, host, path = url_scheme(base), url_host(base), url_path(base)
    origin = F.concat(scheme, F.lit("://"), host)
    link_path, tail = url_path(href), F.regexp_extract(href, r"[?#](?s:.*)\z", 0)
    merged = F.when(F.startswith(link_path, F.lit("/")), link_path).otherwise(
        F.concat(
            F.coalesce(F.nullif(F.regexp_extract(path, r"^.*/", 0), F.lit("")), F.lit("/")),
            link_path,
        )
    )
    dotted = F.rlike(merged, F.lit(r"/\.{1,2}(?:/|\z)"))
    full_path = F.when(dotted, _resolve_dots(merged)).otherwise(merged)
    return (
        F.when(href == "", base)
        .when(F.rlike(href, F.lit(_ABSOLUTE)), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("?")), F.concat(origin, path, href))
        .when(
            F.startswith(href, F.lit("#")),
            F.concat(F.regexp_extract(base, r"^[^#]*", 0), href),
        )
        .otherwise(F.concat(origin, full_path, tail))
    )
