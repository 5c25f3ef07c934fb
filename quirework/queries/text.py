"""Text cleaning, labels, URL parts, keys and JSON repairs."""

from pyspark.sql import functions as F

from quirework.constants import MONTHS, SPACE, WORD
from quirework.functions import html as H
from quirework.functions import jsontext as JT
from quirework.functions import keys as K
from quirework.functions import labels as L
from quirework.functions import text as X
from quirework.functions import urls as U
from quirework.functions.chat import chat_messages, fill
from quirework.operators.hooks import text_udf
from quirework.operators.predicates import has_extension
from quirework.queries import derive as D

c = F.col


# ---- SQL side: the same rules in RE2 syntax --------------------------------
# The patterns below are those of the cleaning rules.
def _sub(text: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {to}, 'g')"


def sql_strip(text: str) -> str:
    return _sub(text, rf"^[{SPACE}]+|[{SPACE}]+$")


def sql_foreign(text: str) -> str:
    return _sub(text, r"[\x{3040}-\x{309F}\x{30A0}-\x{30FF}]+|[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]+")


def sql_numbers(text: str) -> str:
    return _sub(text, rf"(?:\b\d{{1,3}}\b[{SPACE}]){{5,}}\d{{1,3}}\b")


def sql_markup(text: str) -> str:
    return _sub(
        text,
        rf"(?m)<[^>]+>[^{WORD}{SPACE}]*|-{{10,}}|={{5,}}|＜보[{SPACE}]*기＞|\*[{SPACE}]*$",
    )


def sql_structure(text: str) -> str:
    for circled, plain in (("①", "1."), ("②", "2."), ("③", "3."), ("④", "4.")):
        text = f"replace({text}, '{circled}', '{plain}')"
    text = _sub(text, r"\(\p{Nd}점\)")
    return _sub(
        text,
        rf"(?m)^(?:제\p{{Nd}}+회[^{SPACE}]*.*|TOPIK[{SPACE}]+[IⅠ]+.*|\p{{Nd}}{{1,2}})[{SPACE}]*$",
    )


def sql_blanks(text: str) -> str:
    return sql_strip(_sub(text, r"\n{3,}", f"{D.NL} || {D.NL}"))


def sql_clean(text: str) -> str:
    return sql_blanks(sql_structure(sql_markup(sql_numbers(sql_foreign(text)))))


_NOISY_SQL = f"WITH noisy AS ({D.as_sql('documents', D.NOISY)})"


def _noisy_query(expression, sql):
    def run(spark, d):
        noisy = D.derive(spark, d, "documents", D.NOISY)
        return noisy.select("doc_id", expression(c("raw_text")).alias("result"))

    return run, f"{_NOISY_SQL} SELECT doc_id, {sql} AS result FROM noisy"


def _row_query(source, columns, results, sql):
    """Derive columns from a table, then apply the operator's expressions to them.

    `results` makes the expressions, which need a session to exist.
    """

    def run(spark, d):
        return D.derive(spark, d, source, columns).select(
            "id", *[e.alias(n) for n, e in results().items()]
        )

    items = ", ".join(f"{s} AS {n}" for n, s in sql.items())
    return run, f"WITH i AS ({D.as_sql(source, columns)}) SELECT id, {items} FROM i"


def word_char_counts(spark, d):
    noisy = D.derive(spark, d, "documents", D.NOISY)
    return noisy.select(
        "doc_id",
        X.word_count(c("raw_text")).alias("words"),
        X.char_count(c("raw_text")).alias("chars"),
    )


def page_clean_text(spark, d):
    return D.table(spark, d, "pages").select("page_id", X.clean_text(c("html")).alias("result"))


def clean_text_short_kept(spark, d):
    turns = D.table(spark, d, "conversations")
    return turns.select(
        "conv_id", "turn", X.clean_text(F.concat("text", F.lit("\n8")), 3).alias("result")
    )


def vectorized_text(spark, d):
    squeeze = text_udf(lambda s: " ".join(s.split()))
    return D.table(spark, d, "conversations").select(
        "conv_id", "turn", squeeze(c("text")).alias("result")
    )


# ---- Derived rows ----------------------------------------------------------
_MONTH_TEXT = {
    "id": "doc_id",
    "body": "concat(text, ' Held in ', CASE doc_id % 5 WHEN 0 THEN 'OCTOBER and April' "
    "WHEN 1 THEN 'July' WHEN 2 THEN 'december' WHEN 3 THEN 'January, March' ELSE 'winter' END)",
}
_MONTH_SQL = (
    f"list_filter({list(MONTHS)!r}, lambda m: contains(lower(body), m))[1]"
)
_LABEL = {
    "id": "p_partkey",
    "label": "concat(p_partkey, 'th TOPIK ', CASE p_partkey % 3 WHEN 0 THEN 'II' WHEN 1 THEN 'I' "
    "ELSE 'X' END, ' - ', CASE p_size % 5 WHEN 0 THEN 'Test Paper - Reading' "
    "WHEN 1 THEN 'READING ANSWER KEYS' WHEN 2 THEN 'LISTENING AUDIO FILE' "
    "WHEN 3 THEN 'Listening Transcript' ELSE 'Writing' END)",
}
_EDITION = {
    "id": "p_partkey",
    "folder": "CASE p_partkey % 4 WHEN 0 THEN concat(p_partkey, 'TH-test-papers') "
    "WHEN 1 THEN p_name WHEN 2 THEN NULL ELSE concat('download-', p_partkey, '1st-set') END",
    "number": "CASE WHEN p_partkey % 7 = 0 THEN p_brand "
    "WHEN p_partkey % 11 = 0 THEN NULL ELSE concat(' 0', p_partkey, ' ') END",
}
_EDITION_SQL = """CASE WHEN id % 4 = 0 THEN id || 'th' WHEN id % 4 = 3 THEN id || '1st'
  WHEN id % 7 = 0 OR id % 11 = 0 OR id IS NULL THEN NULL
  ELSE id || CASE WHEN id % 100 BETWEEN 10 AND 20 THEN 'th' WHEN id % 10 = 1 THEN 'st'
    WHEN id % 10 = 2 THEN 'nd' WHEN id % 10 = 3 THEN 'rd' ELSE 'th' END END"""
_NUMBERED = {
    "id": "p_partkey",
    "label": "CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE concat(p_partkey, 'Nd paper 7th') END",
    "filename": "CASE WHEN p_partkey % 2 = 0 THEN concat(p_size, 'rd.pdf') ELSE p_name END",
}
_HEADING = {
    "id": "p_partkey",
    "h1": "CASE WHEN p_partkey % 6 = 5 THEN p_name "
    "ELSE concat('Download ', p_partkey, 'th (YEAR  ', 1990 + p_size, ') Papers') END",
}
_LINKED = {
    "id": "page_id",
    "page": "url",
    "href": "CASE page_id % 9 WHEN 0 THEN concat('/files/', page_id, '.pdf') "
    "WHEN 1 THEN concat('part-', page_id, '.mp3?x=1') WHEN 2 THEN concat('//cdn.example.org/', page_id) "
    "WHEN 3 THEN 'https://other.example.org/a/../b' WHEN 4 THEN '?page=9' "
    "WHEN 5 THEN '/a/b/../c/./d.PDF' WHEN 6 THEN '#end' WHEN 7 THEN '' ELSE '/x/..' END",
}
_ORIGIN = r"regexp_extract(page, '^[a-z]+://[^/?#]*')"
_PATH = r"regexp_extract(page, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_RESOLVED_SQL = rf"""CASE id % 9 WHEN 0 THEN {_ORIGIN} || href
  WHEN 1 THEN {_ORIGIN} || coalesce(nullif(regexp_extract({_PATH}, '^.*/'), ''), '/') || href
  WHEN 2 THEN regexp_extract(page, '^[a-z]+:') || href WHEN 3 THEN href
  WHEN 4 THEN {_ORIGIN} || {_PATH} || href WHEN 5 THEN {_ORIGIN} || '/a/c/d.PDF'
  WHEN 6 THEN regexp_extract(page, '^[^#]*') || href WHEN 7 THEN page
  ELSE {_ORIGIN} || '/' END"""
_URLS = {
    "id": "page_id",
    "url": "CASE WHEN page_id % 5 = 0 THEN "
    "concat('https://files.example.org/download-', page_id, 'th-test:papers/') ELSE url END",
}
_FOLDER_SQL = r"""coalesce(nullif(regexp_replace(regexp_replace(regexp_extract(
  rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '[^/]*$'),
  '^download-', ''), '[<>:"/\\|?*]', '_', 'g'), ''), 'unknown')"""
_JSON = {
    "id": "conv_id * 1000 + turn",
    "raw": "concat(CASE WHEN turn % 3 = 2 THEN 'no object here' "
    "ELSE concat('Answer: {\" role \" : \"', role, '\", \"u\": \"x', chr(92), 'uZZ', chr(92), "
    "'u00e9\"}') END, ' done ', text)",
}
_ADDRESS = {
    "id": "doc_id",
    "href": "concat('/', source, '/', doc_id, CASE doc_id % 5 WHEN 0 THEN '.pdf' "
    "WHEN 1 THEN '.MP3' WHEN 2 THEN '.pdf?x=1' WHEN 3 THEN '.html' ELSE '.Pdf' END)",
}


def extension_filter(spark, d):
    return D.derive(spark, d, "documents", _ADDRESS).filter(has_extension(c("href")))


def chat_turns(spark, d):
    orders = D.derive(spark, d, "orders", D.QUESTIONS)
    messages = chat_messages(
        F.lit("TOPIK I"), c("topic"), c("difficulty_level"), c("question_type"),
        c("question_stimulus"), c("raw_question_text"),
        [F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d")],
        system_prompt="Write a question.",
    )
    return orders.select("question_id", F.posexplode(messages).alias("pos", "m")).select(
        "question_id", "pos", "m.role", "m.content"
    )


def hashed_keys(spark, d):
    docs = D.table(spark, d, "documents")
    return docs.select(
        "doc_id",
        K.hash_key("doc_id", F.nullif(c("lang"), F.lit("fr")), "text").alias("key"),
        K.hash_bucket("doc_id").alias("bucket"),
    )


def rendered_prompts(spark, d):
    docs = D.table(spark, d, "documents")
    prompt = X.render_template(
        "Rules: {format_instructions}\nText:\n{input}\nEnd",
        input=c("text"),
        format_instructions=F.concat(F.lit("JSON about {input} in "), c("lang")),
    )
    return docs.select("doc_id", prompt.alias("prompt"))


QUERIES = {
    "foreign_script_removal": _noisy_query(X.remove_foreign_script, sql_foreign("raw_text")),
    "number_block_removal": _noisy_query(X.remove_number_blocks, sql_numbers("raw_text")),
    "markup_removal": _noisy_query(X.remove_markup, sql_markup("raw_text")),
    "structure_normalization": _noisy_query(X.normalize_structure, sql_structure("raw_text")),
    "blank_line_collapse": _noisy_query(X.collapse_blank_lines, sql_blanks("raw_text")),
    "clean_text": _noisy_query(X.clean_text, sql_clean("raw_text")),
    "page_clean_text": (
        page_clean_text,
        f"SELECT page_id, {sql_clean('html')} AS result FROM pages",
    ),
    "clean_text_short_kept": (
        clean_text_short_kept,
        f"""SELECT conv_id, turn, CASE WHEN length(t) > 3 THEN {sql_clean('t')} ELSE t END AS result
        FROM (SELECT *, text || {D.NL} || '8' AS t FROM conversations)""",
    ),
    "hangul_ratio": _noisy_query(
        X.hangul_ratio,
        r"length(regexp_replace(raw_text, '[^\x{AC00}-\x{D7A3}]', '', 'g')) "
        rf"/ greatest(length(regexp_replace(raw_text, '[{SPACE}]', '', 'g')), 1)",
    ),
    "word_char_counts": (
        word_char_counts,
        f"""{_NOISY_SQL} SELECT doc_id, CAST(len(regexp_extract_all(raw_text, '[^{SPACE}]+'))
        AS INTEGER) AS words, CAST(length(raw_text) AS INTEGER) AS chars FROM noisy""",
    ),
    "vectorized_text": (
        vectorized_text,
        rf"""SELECT conv_id, turn, {sql_strip("regexp_replace(text, '[" + SPACE + "]+', ' ', 'g')")}
        AS result FROM conversations""",
    ),
    "edition_label": _row_query(
        "part", _EDITION, lambda: {"edition": L.exam_edition(c("folder"), c("number"))},
        {"edition": _EDITION_SQL},
    ),
    "exam_number": _row_query(
        "part", _NUMBERED, lambda: {"number": L.exam_number(c("label"), c("filename"))},
        {"number": "CASE WHEN id % 3 <> 0 THEN CAST(id AS VARCHAR) WHEN id % 2 = 0 "
                   "THEN replace(filename, 'rd.pdf', '') END"},
    ),
    "heading_year": _row_query(
        "part", _HEADING, lambda: {"year": L.year_from_heading(c("h1"))},
        {"year": "CASE WHEN id % 6 <> 5 THEN h1[length(h1) - 11:length(h1) - 8] END"},
    ),
    "month_in_text": _row_query(
        "documents", _MONTH_TEXT,
        lambda: {"number": L.month_number(c("body")), "name": L.month_name(L.month_number(c("body")))},
        {"number": f"CAST(list_position({list(MONTHS)!r}, {_MONTH_SQL}) AS INTEGER)",
         "name": f"upper({_MONTH_SQL}[1]) || {_MONTH_SQL}[2:]"},
    ),
    "season": _row_query(
        "orders", {"id": "o_orderkey", "month": "CASE WHEN o_orderkey % 50 = 0 THEN NULL "
                   "ELSE month(o_orderdate) END"},
        lambda: {"season": L.season(c("month"))},
        {"season": "CASE WHEN month IS NULL THEN NULL WHEN month IN (3, 4, 5, 6) THEN 'Spring' "
                   "WHEN month >= 9 THEN 'Fall' ELSE 'Other' END"},
    ),
    "label_class": _row_query(
        "part", _LABEL, lambda: L.label_class(c("label")),
        {
            "level": "CASE WHEN contains(label, 'TOPIK II') THEN 'TOPIK II' "
                     "WHEN contains(label, 'TOPIK I') THEN 'TOPIK I' END",
            "section": "CASE WHEN label ILIKE '%reading%' THEN 'Reading' WHEN label ILIKE "
                       "'%listening%' THEN 'Listening' WHEN label ILIKE '%writing%' THEN 'Writing' END",
            "file_type": "CASE WHEN label ILIKE '%test paper%' THEN 'Test Paper' WHEN label ILIKE "
                         "'%answer keys%' THEN 'Answer Keys' WHEN label ILIKE '%audio file%' THEN "
                         "'Audio File' WHEN label ILIKE '%transcript%' THEN 'Transcript' END",
        },
    ),
    "folder_name": _row_query(
        "pages", _URLS, lambda: {"folder": U.folder_name(c("url"))}, {"folder": _FOLDER_SQL}
    ),
    "url_parts": _row_query(
        "pages", {"id": "page_id", "url": "url"},
        lambda: {
            "host": U.url_host(c("url")),
            "path": U.url_path(c("url")),
            "file": U.file_name(c("url")),
            "bare": U.cut_query_and_fragment(c("url")),
        },
        {
            "host": "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)",
            "path": "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)",
            "file": "regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$')",
            "bare": "split_part(split_part(url, '?', 1), '#', 1)",
        },
    ),
    "resolved_urls": _row_query(
        "pages", _LINKED, lambda: {"resolved": U.resolve_url(c("page"), c("href"))},
        {"resolved": _RESOLVED_SQL},
    ),
    "extension_filter": (
        extension_filter,
        f"""SELECT * FROM ({D.as_sql('documents', _ADDRESS)})
        WHERE lower(href) LIKE '%.pdf' OR lower(href) LIKE '%.mp3'""",
    ),
    "json_span": _row_query(
        "conversations", _JSON, lambda: {"found": JT.json_span(c("raw"))},
        {"found": r"nullif(regexp_extract(raw, '(?s)\{.*\}'), '')"},
    ),
    "json_escape_repair": _row_query(
        "conversations", _JSON, lambda: {"fixed": JT.drop_bad_escapes(c("raw"))},
        {"fixed": "replace(raw, chr(92) || 'uZZ', 'ZZ')"},
    ),
    "json_key_trim": _row_query(
        "conversations", _JSON, lambda: {"trimmed": JT.trim_keys(c("raw"))},
        {"trimmed": r"""regexp_replace(raw, '"\s*(\w+)\s*"\s*:', '"\1":', 'g')"""},
    ),
    "rendered_prompts": (
        rendered_prompts,
        f"""SELECT doc_id, 'Rules: JSON about {{input}} in ' || lang || {D.NL} || 'Text:' || {D.NL}
        || text || {D.NL} || 'End' AS prompt FROM documents""",
    ),
    "null_propagating_concat": _row_query(
        "orders", {"id": "o_orderkey", **{k: v for k, v in D.QUESTIONS.items() if k != "question_id"}},
        lambda: {"sentence": fill("%s: %s (%s)", c("topic"), c("question_type"), c("question_stimulus"))},
        {"sentence": "topic || ': ' || question_type || ' (' || question_stimulus || ')'"},
    ),
    "null_default": _row_query(
        "orders", {"id": "o_orderkey", "s": D.QUESTIONS["question_stimulus"]},
        lambda: {"stimulus": F.coalesce(c("s"), F.lit(""))}, {"stimulus": "ifnull(s, '')"},
    ),
    "chat_turns": (
        chat_turns,
        f"""WITH q AS ({D.as_sql('orders', D.QUESTIONS)})
        SELECT question_id, CAST(0 AS INTEGER) AS pos, 'system' AS role, 'Write a question.' AS content FROM q
        UNION ALL SELECT question_id, 1, 'user', 'Generate a TOPIK I multiple-choice question about the topic "'
          || topic || '", with difficulty level "' || difficulty_level || '" and question type "'
          || question_type || '". Follow the output format specified in the system prompt.' FROM q
        UNION ALL SELECT question_id, 2, 'assistant', 'Question stimulus: ' || ifnull(question_stimulus, '')
          || {D.NL} || 'Question text: ' || raw_question_text || {D.NL} || 'Option 1. a' || {D.NL}
          || 'Option 2. b' || {D.NL} || 'Option 3. c' || {D.NL} || 'Option 4. d' FROM q""",
    ),
    "hashed_keys": (
        hashed_keys,
        """SELECT doc_id, sha256(concat_ws('||', doc_id, nullif(lang, 'fr'), text)) AS key,
        CAST(CAST('0x' || md5(CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) % 100 AS INTEGER) AS bucket
        FROM documents""",
    ),
}
