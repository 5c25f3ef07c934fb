"""File catalogue and paper pages out of crawled HTML."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.constants import DEFAULT_FORMAT, DOWNLOAD_EXTENSIONS, FORMAT_MARKERS
from quirework.functions import html as H
from quirework.functions import labels as L
from quirework.functions import urls as U
from quirework.operators.aggregates import keep_first, one_per_key
from quirework.operators.predicates import has_extension
from quirework.operators.projections import compute_once
from quirework.operators.windows import carry_forward

HEAD_PARAGRAPHS = 8


def _visible(pages: DataFrame) -> DataFrame:
    """Pages with comments, scripts and styles dropped, once for all extractions."""
    return compute_once(pages, "_visible", H.drop_hidden(F.col("html"))).drop("html")


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, link_pos, href, label): all links of each page in order."""
    links = H.anchors(F.col("_visible"))
    return _visible(pages).select(
        "page_id", "url", F.posexplode(links).alias("link_pos", "a")
    ).select("page_id", "url", "link_pos", "a.*")


def page_head(pages: DataFrame, *keep: str) -> DataFrame:
    """First h1, h2, title and the first paragraphs of each page, as one row."""
    visible = F.col("_visible")
    return _visible(pages).select(
        *(keep or ("page_id", "url")),
        H.first_text(visible, "h1").alias("h1"),
        H.first_text(visible, "h2").alias("h2"),
        H.first_text(visible, "title").alias("title"),
        H.paragraph_texts(visible, HEAD_PARAGRAPHS).alias("paragraphs"),
    )


def file_catalogue(
    pages: DataFrame,
    extensions: tuple[str, ...] = DOWNLOAD_EXTENSIONS,
    paper_formats: DataFrame | None = None,
) -> DataFrame:
    """One row per downloadable file of each page, with what its label tells.

    The page text is reduced to its few facts before links are unfolded, so only
    short columns are shuffled. `paper_formats` (url, format) adds `topik_format`, null
    for pages without one; of several formats of a page the smallest counts.
    """
    visible = F.col("_visible")
    links = F.filter(H.anchors(visible), lambda a: has_extension(a["href"], extensions))
    head = F.concat_ws(
        " ",
        F.col("_h1"),
        H.first_text(visible, "h2"),
        H.first_text(visible, "title"),
        F.concat_ws(" ", H.paragraph_texts(visible, HEAD_PARAGRAPHS)),
    )
    # Each step is computed before the next one repeats it: a month reads its text 12 times.
    staged = _visible(pages)
    for name, step in {
        "_links": links,
        "_h1": H.first_text(visible, "h1"),
        "_head": head,
        "_month": L.month_number(F.col("_head")),
    }.items():
        staged = compute_once(staged, name, step)
    facts = staged.select(
        F.col("url").alias("page_url"),
        L.year_from_heading(F.col("_h1")).alias("exam_year"),
        "_month",
        F.posexplode("_links").alias("_pos", "_a"),
    )
    files = facts.withColumn("source_url", U.resolve_url(F.col("page_url"), F.col("_a.href")))
    first = keep_first(files, ["page_url", "source_url"], ["_pos"])
    label, name = F.col("_a.label"), U.file_name(F.col("source_url"))
    catalogue = first.select(
        name.alias("filename"),
        label.alias("label"),
        L.exam_number(label, name).alias("exam_number"),
        "exam_year",
        L.month_name(F.col("_month")).alias("exam_month"),
        L.season(F.col("_month")).alias("exam_session"),
        *[c.alias(n) for n, c in L.label_class(label).items()],
        "source_url",
        "page_url",
    )
    if paper_formats is None:
        return catalogue
    formats = paper_formats.select(
        F.col("url").alias("page_url"), F.col("format").alias("topik_format")
    )
    return catalogue.join(one_per_key(formats, "page_url"), "page_url", "left")


def paper_pages(pages: DataFrame, link_pattern: str) -> DataFrame:
    """Links to paper pages with the format heading they stand under.

    `link_pattern` tells which hrefs are paper pages. Pages are cut at their
    headings within the row; the format then carries forward from heading to
    heading, and of repeated links the first one counts.
    """
    sections = pages.select(
        "page_id",
        "url",
        F.posexplode(H.heading_sections(H.drop_hidden(F.col("html")))).alias("_pos", "_html"),
    )
    heading = H.section_heading(F.col("_html"))
    marked = F.lit(None).cast("string")
    for marker, name in reversed(FORMAT_MARKERS.items()):
        marked = F.when(F.contains(heading, F.lit(marker)), name).otherwise(marked)
    hrefs = F.transform(
        F.filter(H.anchors(F.col("_html")), lambda a: F.rlike(a["href"], F.lit(link_pattern))),
        lambda a: U.cut_query_and_fragment(U.resolve_url(F.col("url"), a["href"])),
    )
    narrow = sections.select(
        "page_id", "_pos", marked.alias("_marked"), F.array_distinct(hrefs).alias("_urls")
    ).filter(F.col("_marked").isNotNull() | (F.size("_urls") > 0))
    carried = carry_forward(
        narrow, "_marked", ["page_id"], ["_pos"], "format", default=DEFAULT_FORMAT
    )
    links = carried.select(
        F.col("page_id").alias("index_page_id"), "_pos", "format", F.explode("_urls").alias("url")
    )
    return keep_first(links, ["index_page_id", "url"], ["_pos"]).select(
        "index_page_id", "url", "format"
    )
