"""Golden rows of the text functions, and the cleaning chain against Python's re."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import html as H
from quirework.functions import jsontext as J
from quirework.functions import labels as L
from quirework.functions import text as X
from quirework.functions import urls as U

CLEANED = [
    ("가を나 漢 다", "가나  다"),
    ("15 15 15 15 15 15 끝", "끝"),
    ("15  15 15 15 15 15 끝", "15  15 15 15 15 15 끝"),
    ("1 2 3 4 5 6", ""),
    ("가15 15 15 15 15 15", "가15 15 15 15 15 15"),
    ("표<br/>={$ 글", "표 글"),
    ('<img src="x">①구두', "1.구두"),
    ("----------\n가", "가"),
    ("＜보 기＞\n나", "나"),
    ("**굵게**\n다", "**굵게*\n다"),
    ("* \n\n라", "라"),
    ("① 구두 ② 우산", "1. 구두 2. 우산"),
    ("문제 (2점)", "문제"),
    ("（각 2점） (각 2점)", "（각 2점） (각 2점)"),
    ("제35회 한국어능력시험\n8\n\n\n\n  본문", "본문"),
    ("TOPIK II 읽기\n17\n가", "가"),
    ("TOPIK Ⅰ\n가", "가"),
    ("a\n\n\n\nb", "a\n\nb"),
    ("12.\n3", "12."),
    ("가\r\n8\r\n나", "가\r\n\n나"),
    ("8 　\n가", "가"),
    (None, None),
    ("", ""),
]


def values(spark, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean_text_golden(spark):
    assert values(spark, [a for a, _ in CLEANED], X.clean_text) == [b for _, b in CLEANED]


def python_clean(text):
    """The same rules in Python's regex dialect."""
    text = re.sub("[぀-ヿ㐀-䶿一-鿿]+", "", text)
    text = re.sub(r"\b\d{1,3}\b(?:\s\b\d{1,3}\b){5,}", "", text)
    text = re.sub(r"(?m)<[^>]+>[^\w\s]*|-{10,}|={5,}|＜보\s*기＞|\*\s*$", "", text)
    for i, circled in enumerate("①②③④", start=1):
        text = text.replace(circled, f"{i}.")
    text = re.sub(r"\(\d점\)", "", text)
    text = re.sub(r"(?m)^(?:제\d+회\S*.*|TOPIK\s+[IⅠ]+.*|\d{1,2})\s*$", "", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


PIECES = st.sampled_from(
    ["가", "나", "a", "1", "15", "123", "1234", " ", "  ", "\n", "\n\n\n", "\t", "　", "\xa0",
     "\x1c", "\x85", " ", "*", "**", "<b>", "</p>", "={$", "==", "=====", "-----------", "＜보기＞",
     "①", "④", "(2점)", "(각 2점)", "제35회", "회", "TOPIK", "II", "Ⅰ", "漢", "を", "_", ".", "\r", "é"]
)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=30).map("".join), min_size=40, max_size=60))
def test_clean_text_equals_python(spark, texts):
    assert values(spark, texts, X.clean_text) == [python_clean(t) for t in texts]


def test_long_number_run_does_not_exhaust_the_stack(spark):
    text = "시작 " + "7 " * 200_000 + "끝"
    assert values(spark, [text], X.remove_number_blocks) == ["시작  끝"]


def test_word_count_and_blank(spark):
    texts = ["  a b　c ", "", "\x1c\x85 ", "가", None]
    assert values(spark, texts, X.word_count) == [3, 0, 0, 1, None]
    assert values(spark, texts, X.is_blank) == [False, True, True, False, None]


def test_hangul_ratio(spark):
    assert values(spark, ["붉게 (        )", "abc가", "", "가　나"], X.hangul_ratio) == [
        0.5, 0.25, 0.0, 1.0,
    ]


def test_render_template_does_not_refill(spark):
    rendered = values(
        spark, ["{b}"], lambda v: X.render_template("<{a}|{b}>{c}", a=v, b=F.lit("x"))
    )
    assert rendered == ["<{b}|x>{c}"]


def test_edition(spark):
    rows = [("102nd-topik-test-papers", None), ("x", "11"), ("x", "21"), ("x", "112"),
            ("x", "103"), (None, None), ("x", " 007 "), ("5TH-set", "9"), ("x", "1a"), ("x", "0")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f string, n string")
    got = df.orderBy("i").select(L.exam_edition(F.col("f"), F.col("n"))).collect()
    assert [r[0] for r in got] == [
        "102nd", "11th", "21st", "112th", "103rd", None, "7th", "5th", None, "0th"
    ]


def test_labels(spark):
    label = L.label_class(F.col("v"))
    rows = spark.createDataFrame(
        [("102nd TOPIK I - TEST PAPER - READING",), ("102nd TOPIK I - LISTENING AUDIO FILE",),
         ("102nd TOPIK II - WRITING ANSWER KEYS",), ("102nd TOPIK II - LISTENING TRANSCRIPT",), ("x",)],
        "v string",
    ).select(*label.values())
    assert [tuple(r) for r in rows.collect()] == [
        ("TOPIK I", "Reading", "Test Paper"), ("TOPIK I", "Listening", "Audio File"),
        ("TOPIK II", "Writing", "Answer Keys"), ("TOPIK II", "Listening", "Transcript"),
        (None, None, None),
    ]


def test_heading_facts(spark):
    assert values(spark, ["Download 102nd (Year 2025) Papers", "none"], L.year_from_heading) == ["2025", None]
    assert values(spark, ["June, then March", "MAY", "x"], L.month_number) == [3, 5, None]
    assert values(spark, ["4", "11", "1", None], lambda v: L.season(v.cast("int"))) == [
        "Spring", "Fall", "Other", None,
    ]


def test_urls(spark):
    from urllib.parse import urljoin

    base = "http://h.com:8/a/b/c?x=1#f"
    hrefs = ["", "/x", "x.pdf", "../y", "./z?q#r", "//o.com/p", "?q=2", "#g", "https://a.b/c",
             "mailto:a@b", "../../../../q/.", "d/..", "a/./b/../c", "a b.pdf"]
    got = values(spark, hrefs, lambda v: U.resolve_url(F.lit(base), v))
    assert got == [urljoin(base, h) for h in hrefs]
    folders = ["https://s.org/download-102nd-test-papers/", "https://s.org/", "https://s.org/a:b?c",
               "https://s.org", "https://s.org/x/y;v=1"]
    assert values(spark, folders, U.folder_name) == ["102nd-test-papers", "unknown", "a_b", "unknown", "y"]
    names = ["https://s.org/a/b.pdf;v=1?x", "https://s.org/a;b/c.pdf", "https://s.org/a/"]
    assert values(spark, names, U.file_name) == ["b.pdf", "c.pdf", ""]


def test_html(spark):
    html = (
        "<!-- <a href='/no'>c</a> --><script>var a='<a href=\"/no\">x</a>';</script>"
        "<a name='top'>no href</a><abbr>x</abbr><a class=\"z\" href='/one'> A <b> b </b>c&amp;d </a>"
        '<A HREF="/two?x=1&amp;y=2">\n T  </A><a data-href="/no">n</a><a href=/three.pdf>3<a href="/four">4</a> tail'
    )
    links = values(spark, [html], lambda v: H.anchors(H.drop_hidden(v)))[0]
    assert [(a.href, a.label) for a in links] == [
        ("/one", "Abc&d"), ("/two?x=1&y=2", "T"), ("/three.pdf", "3"), ("/four", "4"),
    ]
    page = ["<h1 id='a'>One <i>two</i></h1><h1>no</h1><header>x</header>", "<hr>"]
    assert values(spark, page, lambda v: H.first_text(v, "h1")) == ["One two", None]


def test_attributes_are_read_as_units(spark):
    cases = {
        "<a title='a>b' href='/x.pdf'>L</a>": ("/x.pdf", "L"),
        '<a title="x href=\'/no\'" href=/yes>y</a>': ("/yes", "y"),
        '<a title="x"href="/glued">g</a>': ("/glued", "g"),
        "<a\nhref\n=\n'/lines'\n>l</a\n>": ("/lines", "l"),
        '<a title="never closed href=/x>z</a>': ("/x", "z"),
        "<a/href=/slash>s</a>": ("/slash", "s"),
        "<a href=''>empty</a>": ("", "empty"),
        "<a href=/one href=/two>first</a>": ("/one", "first"),
        '<a href="/i"><img alt="1 > 0"> text <b title=\'<\'>b</b></a>': ("/i", "textb"),
        "<a href=/m>1 < 2 > 3</a>": ("/m", "13"),
        "<a hrefx=/no>n</a>": None,
        "<a title=href=/no>n</a>": None,
    }
    got = values(spark, list(cases), H.anchors)
    assert [(a[0].href, a[0].label) if a else None for a in got] == list(cases.values())
    long = "<a " + "x='>' " * 20_000 + "href='/far'>" + "<b title='>'>" * 20_000 + "end</a>"
    assert [(a.href, a.label) for a in values(spark, [long], H.anchors)[0]] == [("/far", "end")]
    head = ["<h1 title='a > b'>One</h1>", "<h1>1 <i class=\">\">x</i></h1>"]
    assert values(spark, head, lambda v: H.first_text(v, "h1")) == ["One", "1 x"]


def test_json_repairs(spark):
    assert values(spark, ['so {"a": {"b": 1}} ok {', "none"], J.json_span) == ['{"a": {"b": 1}}', None]
    assert values(spark, [r"aé \uZZ \u12"], J.drop_bad_escapes) == [r"aé ZZ 12"]
    assert values(spark, ['{" a ": "x : y", "b":1}'], J.trim_keys) == ['{"a": "x : y", "b":1}']
