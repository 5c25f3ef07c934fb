"""Links, headings, file catalogue and paper pages out of HTML."""

from pyspark.sql import functions as F

from quirework.plans import catalogue as C
from quirework.queries import derive as D

c = F.col

_VISIBLE = (
    r"regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>"
    r"|<style\b[^>]*>.*?</style\s*>', '', 'g')"
)


def _plain(fragment: str) -> str:
    text = rf"regexp_replace({fragment}, '<[^>]*>', '', 'g')"
    for entity, char in (
        ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
        ("&apos;", "''''"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'"),
    ):
        text = f"replace({text}, '{entity}', {char})"
    return text


_LINKS_SQL = rf"""WITH v AS (SELECT page_id, url, {_VISIBLE} AS html FROM pages),
  a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a\s*>') AS tags FROM v),
  r AS (SELECT page_id, url, tags, unnest(range(1, len(tags) + 1)) AS i FROM a),
  links AS (SELECT page_id, url, CAST(i - 1 AS INTEGER) AS link_pos,
    regexp_extract(tags[i], 'href="([^"]*)"', 1) AS href, trim({_plain('tags[i]')}) AS label FROM r)"""

# Crawled pages with downloads: three file links before the page's own HTML, one of
# them twice, and a heading that names a year.
_FILES_HTML = (
    "concat('<h1>Download ', page_id, 'th (Year ', 2000 + page_id % 25, ') Papers</h1>"
    "<p>Held in ', CASE page_id % 3 WHEN 0 THEN 'October' WHEN 1 THEN 'July' ELSE 'autumn' END, "
    "'</p><p>2</p><p>3</p><p>4</p><p>5</p><p>6</p><p>7</p><p>8</p><ul>"
    "<li><a class=\"f\" href=\"/files/', page_id, 'th-Reading-Test-Paper.pdf\">', page_id, "
    "'th TOPIK II - <b>TEST PAPER</b> - READING</a></li>"
    "<li><A HREF=\"/files/audio-', page_id, '.MP3\"> LISTENING AUDIO FILE &amp; more </A></li>"
    "<li><a href=\"/files/', page_id, 'th-Reading-Test-Paper.pdf\">again</a></li></ul>', html)"
)
_FILE_PAGES = {"page_id": "page_id", "url": "url", "html": _FILES_HTML}
_ORIGIN = r"regexp_extract(url, '^[a-z]+://[^/?#]*')"

# An index page per crawled page, with headings of both formats.
_INDEX_HTML = (
    "concat('<a href=\"/download-1th\">1</a><h2>Papers in <i>New Format</i></h2>"
    "<a href=\"/', page_id, 'th?x=1\">p</a><h3>Other</h3><a href=\"/download-', page_id + 1, "
    "'th#top\">q</a><a href=\"/about\">no</a><h4>OLD FORMAT <a href=\"/', page_id + 2, "
    "'th\">r</a></h4><p><a href=\"/', page_id, 'th\">p again</a></p>"
    "<a href=\"/', page_id + 3, 'th\">s</a>', html)"
)
_INDEX_PAGES = {"page_id": "page_id", "url": "url", "html": _INDEX_HTML}
PAPER_LINK = r"^/(?:download-)?[0-9]+th"


def page_links(spark, d):
    return C.page_links(D.table(spark, d, "pages"))


# Links whose attributes hold what looks like ends of tags, other addresses and odd signs.
_QUOTED_HTML = (
    "concat('<a title=''a>b'' href=\"/q/', page_id, '\">One <img alt=\"x>y\"> two</a>"
    "<a data-x=\" href=/no \" href = ''/r>s'' >R</a><A class=x/y HREF=/bare', page_id, '>bare</A>"
    "<a =odd href=\"/odd\"title=\"t>\">odd</a><a xhref=\"/no\">none</a><a title=it''s href=\"/its\">its</a>"
    "<a title=\"no href=/x\" rel=''y'' href=/w >w</a><h2 title=\"2 > 1\">Head <b class=\">\">ing</b></h2>', html)"
)
_QUOTED_PAGES = {"page_id": "page_id", "url": "url", "html": _QUOTED_HTML}


def quoted_links(spark, d):
    """The first links and the first heading of pages with signs of tags in their attributes."""
    pages = D.derive(spark, d, "pages", _QUOTED_PAGES)
    links = C.page_links(pages).filter("link_pos < 6").select("page_id", "link_pos", "href", "label")
    head = C.page_head(pages, "page_id").select(
        "page_id", F.lit(-1).alias("link_pos"), F.lit(None).cast("string").alias("href"), c("h2").alias("label")
    )
    return links.unionByName(head)


def page_headings(spark, d):
    head = C.page_head(D.table(spark, d, "pages"), "page_id")
    return head.select(
        "page_id", "h1", "h2", "title", F.size("paragraphs").alias("n_paragraphs")
    )


def file_catalogue(spark, d):
    return C.file_catalogue(D.derive(spark, d, "pages", _FILE_PAGES))


def paper_pages(spark, d):
    return C.paper_pages(D.derive(spark, d, "pages", _INDEX_PAGES), PAPER_LINK)


def file_catalogue_with_format(spark, d):
    pages = D.derive(spark, d, "pages", _FILE_PAGES)
    formats = D.table(spark, d, "pages").select(
        "url", F.when(c("page_id") % 2 == 0, "New Format").otherwise("Old Format").alias("format")
    )
    return C.file_catalogue(pages, paper_formats=formats).select(
        "page_url", "filename", "topik_format"
    )


QUERIES = {
    "page_links": (
        page_links,
        f"{_LINKS_SQL} SELECT page_id, url, link_pos, href, label FROM links",
    ),
    "quoted_links": (
        quoted_links,
        """SELECT page_id, CAST(unnest([-1, 0, 1, 2, 3, 4, 5]) AS INTEGER) AS link_pos,
          unnest([NULL, '/q/' || page_id, '/r>s', '/bare' || page_id, '/odd', '/its', '/w']) AS href,
          unnest(['Head ing', 'Onetwo', 'R', 'bare', 'odd', 'its', 'w']) AS label FROM pages""",
    ),
    "page_headings": (
        page_headings,
        rf"""WITH v AS (SELECT page_id, {_VISIBLE} AS html FROM pages), x AS (SELECT page_id,
          regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>.*?</h1\s*>') AS a,
          regexp_extract(html, '(?is)<h2(?:\s[^>]*)?>.*?</h2\s*>') AS b,
          regexp_extract(html, '(?is)<title(?:\s[^>]*)?>.*?</title\s*>') AS t,
          regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>', 1)[1:8] AS p FROM v)
        SELECT page_id, CASE WHEN a <> '' THEN {_plain('a')} END AS h1,
          CASE WHEN b <> '' THEN {_plain('b')} END AS h2,
          CASE WHEN t <> '' THEN {_plain('t')} END AS title, CAST(len(p) AS INTEGER) AS n_paragraphs
        FROM x""",
    ),
    "file_catalogue": (
        file_catalogue,
        f"""WITH head AS (SELECT *, lower(coalesce({_plain("regexp_extract(html, '(?is)<title(?:[^>]*)>.*?</title>')")}, '')
            || coalesce({_plain("regexp_extract(" + _VISIBLE + ", '(?is)<h2(?:[^>]*)>.*?</h2>')")}, '')) AS extra
            FROM pages),
          m AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN 'october' WHEN page_id % 3 = 1 THEN 'july'
            END AS own FROM head),
          k AS (SELECT *, list_filter(['january', 'february', 'march', 'april', 'may', 'june', 'july',
            'august', 'september', 'october', 'november', 'december'],
            lambda x: contains(extra || ' ' || coalesce(own, ''), x))[1] AS month FROM m),
          f AS (SELECT *, upper(month[1]) || month[2:] AS exam_month,
            CASE WHEN month IS NULL THEN NULL WHEN month IN ('march', 'april', 'may', 'june') THEN 'Spring'
              WHEN month IN ('september', 'october', 'november', 'december') THEN 'Fall'
              ELSE 'Other' END AS exam_session FROM k)
        SELECT page_id || 'th-Reading-Test-Paper.pdf' AS filename,
          page_id || 'th TOPIK II -TEST PAPER- READING' AS label,
          CAST(page_id AS VARCHAR) AS exam_number, CAST(2000 + page_id % 25 AS VARCHAR) AS exam_year,
          exam_month, exam_session, 'TOPIK II' AS level, 'Reading' AS section, 'Test Paper' AS file_type,
          {_ORIGIN} || '/files/' || page_id || 'th-Reading-Test-Paper.pdf' AS source_url,
          url AS page_url FROM f
        UNION ALL SELECT 'audio-' || page_id || '.MP3', 'LISTENING AUDIO FILE & more', NULL,
          CAST(2000 + page_id % 25 AS VARCHAR), exam_month, exam_session, NULL, 'Listening', 'Audio File',
          {_ORIGIN} || '/files/audio-' || page_id || '.MP3', url FROM f""",
    ),
    "file_catalogue_with_format": (
        file_catalogue_with_format,
        """SELECT url AS page_url, page_id || 'th-Reading-Test-Paper.pdf' AS filename,
          CASE WHEN page_id % 2 = 0 THEN 'New Format' ELSE 'Old Format' END AS topik_format FROM pages
        UNION ALL SELECT url, 'audio-' || page_id || '.MP3',
          CASE WHEN page_id % 2 = 0 THEN 'New Format' ELSE 'Old Format' END FROM pages""",
    ),
    "paper_pages": (
        paper_pages,
        f"""WITH o AS (SELECT page_id, {_ORIGIN} AS origin FROM pages), l AS (
          SELECT page_id, 1 AS n, origin || '/download-1th' AS url, 'New Format' AS format FROM o
          UNION ALL SELECT page_id, 2, origin || '/' || page_id || 'th', 'New Format' FROM o
          UNION ALL SELECT page_id, 3, origin || '/download-' || (page_id + 1) || 'th', 'New Format' FROM o
          UNION ALL SELECT page_id, 4, origin || '/' || (page_id + 2) || 'th', 'Old Format' FROM o
          UNION ALL SELECT page_id, 5, origin || '/' || (page_id + 3) || 'th', 'Old Format' FROM o)
        SELECT page_id AS index_page_id, url, arg_min(format, n) AS format FROM l GROUP BY ALL""",
    ),
}
