"""Inputs that the queries derive from the test tables.

Each expression is plain SQL that Spark and the checking engine both understand, so
the two sides start from the same derived rows and differ only in the operator.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NL = "chr(10)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(spark: SparkSession, folder: str, source: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, folder, source).select(
        *[F.expr(sql).alias(name) for name, sql in columns.items()]
    )


def as_sql(source: str, columns: dict[str, str]) -> str:
    items = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {items} FROM {source}"


# Snippets of scanned-page noise, put around every document's text.
NOISE = [
    "가を나 漢 다",
    "15 15 15 15 15 15 끝",
    "15  15 15 15 15 15 끝",
    "1 2 3 4 5 6",
    "표<br/>={$ 글",
    '<img src="x">①구두',
    "---------- 가",
    "======",
    "＜보 기＞",
    "**굵게**",
    "① 구두 ② 우산",
    "문제 (2점)",
    "제35회 한국어능력시험",
    "TOPIK II 읽기",
    "17",
    "TOPIK Ⅰ",
]


def _pick(values: list[str], by: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[1:], start=1))
    return f"CASE {by} {cases} ELSE '{values[0]}' END"


NOISY = {
    "doc_id": "doc_id",
    "raw_text": (
        f"concat({_pick(NOISE, f'doc_id % {len(NOISE)}')}, {NL}, text, {NL}, {NL}, {NL}, "
        f"{_pick(NOISE, f'(doc_id + 5) % {len(NOISE)}')}, {NL}, "
        f"{_pick(NOISE, f'(doc_id + 10) % {len(NOISE)}')}, ' ')"
    ),
}

_FOLDER = (
    "CASE WHEN length(source) % 2 = 0 THEN source "
    "ELSE concat(substr(source, 4), 'th-test-papers') END"
)
_FILENAME = (
    "concat('paper-', doc_id, CASE WHEN doc_id % 5 = 4 THEN '-Audio-File.mp3' "
    "WHEN doc_id % 5 = 3 THEN '-Listening-Test-Paper.PDF' "
    "ELSE '-Reading-Test-Paper.pdf' END)"
)
_LEVEL = "CASE WHEN doc_id % 2 = 0 THEN 'TOPIK I' ELSE 'TOPIK II' END"

METADATA = {
    "exam_folder": _FOLDER,
    "source_pdf_path": f"concat('/data/', {_FOLDER}, '/', {_FILENAME})",
    "filename": _FILENAME,
    "label": f"concat(doc_id, 'th ', {_LEVEL}, ' - TEST PAPER - READING')",
    "exam_number": "CASE WHEN doc_id % 9 = 8 THEN NULL ELSE CAST(doc_id % 130 AS VARCHAR(9)) END",
    "exam_year": "CAST(2000 + doc_id % 25 AS VARCHAR(9))",
    "exam_month": "CASE WHEN doc_id % 2 = 0 THEN 'April' ELSE 'October' END",
    "exam_session": "CASE WHEN doc_id % 2 = 0 THEN 'Spring' ELSE 'Fall' END",
    "topik_format": "CASE WHEN doc_id % 11 = 10 THEN 'Old Format' ELSE 'New Format' END",
    "level": _LEVEL,
    "section": "'Reading'",
    "file_type": (
        "CASE WHEN doc_id % 7 = 6 THEN 'Answer Keys' "
        "WHEN doc_id % 7 = 5 THEN 'test paper' ELSE 'Test Paper' END"
    ),
    "source_url": "concat('https://files.example.org/', source, '/', doc_id)",
    "page_url": "concat('https://files.example.org/', source)",
    "download_date": "concat('2025-01-', lpad(CAST(1 + doc_id % 28 AS VARCHAR(9)), 2, '0'))",
    "size_kb": "round(CAST(n_chars AS DOUBLE) / 1024, 1)",
    "download_status": "CASE WHEN doc_id % 13 = 12 THEN 'skip' ELSE 'ok' END",
}

# Every document as a scanned paper: two cover pages, then a page of question blocks
# with the document's whole text as the stimulus of the first block.
BLOCKS = (
    f"concat('## Question ', doc_id, {NL}, '### Question Stimulus', {NL}, text, {NL}, "
    f"'### Reference Text', {NL}, '창가에 둔 화분에 물을 주고 문을 닫았다 ', n_chars, {NL}, "
    f"'### Answers', {NL}, '① 첫째 ', source, {NL}, '② 둘째 ', lang, {NL}, '③ 셋째', {NL}, "
    f"'④ 넷째 ', doc_id, {NL}, {NL}, "
    f"'## Question ', doc_id + 1, {NL}, '### Reference Image', {NL}, '붉게 (        )', {NL}, "
    f"'### Answers', {NL}, '1. 가 2. 나', {NL}, '3. 다', {NL}, '4. 라', {NL}, "
    f"'## Question ', doc_id + 2, {NL}, '### Reference Text', {NL}, '새 책상을 주문한 뒤 사흘을 기다렸다', "
    f"{NL}, '### Answers', {NL}, '1.', {NL}, '온', {NL}, '지', {NL}, '2. 올 때', {NL}, '3. 오거나')"
)

BLOCK_PAGES = {
    "exam_id": "CAST(doc_id AS VARCHAR(20))",
    "page_number": "CAST(3 AS INT)",
    "page_text": BLOCKS,
}

# Orders as questions, customers as exams, line items as options.
EXAMS = {
    "exam_id": "CAST(c_custkey AS VARCHAR(20))",
    "exam_name": "c_name",
    "exam_edition": "CAST(c_nationkey AS VARCHAR(20))",
    "exam_number": "CAST(c_nationkey AS VARCHAR(20))",
    "topik_level": "c_mktsegment",
    "exam_section": "'Reading'",
}
QUESTIONS = {
    "question_id": "CAST(o_orderkey AS VARCHAR(20))",
    "exam_id": "CAST(o_custkey AS VARCHAR(20))",
    "page_number": "CAST(1 + o_orderkey % 40 AS INT)",
    "question_type": "CASE o_orderstatus WHEN 'F' THEN 'grammar' WHEN 'O' THEN 'vocabulary' END",
    "raw_question_text": "concat('Order ', o_orderkey, ' of customer ', o_custkey)",
    "question_stimulus": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END",
    "topic": "o_orderpriority",
    "difficulty_level": (
        "CASE WHEN o_custkey % 4 = 0 THEN 'easy' WHEN o_orderkey % 5 < 3 THEN 'medium' ELSE 'hard' END"
    ),
    "confidence": "CAST((o_orderkey % 9) / 8.0 AS FLOAT)",
}
ANSWERS = {
    "question_id": "CAST(l_orderkey AS VARCHAR(20))",
    "raw_answer_text": "concat('Part ', l_partkey, ' from supplier ', l_suppkey)",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_extendedprice": "l_extendedprice",
}
OPTION_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
