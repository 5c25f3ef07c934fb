"""Question blocks, model output, validation, reliability and user hooks."""

import json

from pyspark.sql import functions as F

from quirework.operators import hooks
from quirework.operators.blocks import question_number, question_pieces, segment_pages
from quirework.operators.model_output import dead_letters, parse_model_output
from quirework.operators.nested import explode_answers, explode_questions
from quirework.operators.predicates import is_reliable, keep_reliable, keep_valid
from quirework.plans import bronze
from quirework.queries import derive as D
from quirework.queries.text import sql_strip
from quirework.schemas import QUESTIONS

c = F.col


def _segmented(spark, d):
    return segment_pages(D.derive(spark, d, "documents", D.BLOCK_PAGES), "page_text")


def segmented_blocks(spark, d):
    pages = D.derive(spark, d, "documents", D.BLOCK_PAGES)
    numbered = segment_pages(pages, "page_text").withColumn(
        "numbers", F.transform(question_pieces(c("page_text")), question_number)
    )
    rows = numbered.select(
        "exam_id", "status", F.posexplode(F.arrays_zip("numbers", "questions")).alias("pos", "z")
    )
    return rows.select(
        "exam_id",
        "status",
        "pos",
        c("z.numbers").alias("number"),
        "z.questions.question_text",
        "z.questions.question_stimulus",
        F.array_join("z.questions.answer_options.answer_text", "|").alias("options"),
    )


def exploded_questions(spark, d):
    rows = explode_questions(_segmented(spark, d), ["exam_id", "page_number"])
    return rows.select("question_id", "exam_id", "page_number", "question_pos", "question_text")


def exploded_answers(spark, d):
    rows = explode_answers(explode_questions(_segmented(spark, d), ["exam_id", "page_number"]))
    return rows.select("answer_id", "question_id", "option_pos", "answer_text")


def reliable_questions(spark, d):
    kept = keep_reliable(_segmented(spark, d), min_confidence=0.3)
    rows = kept.select("exam_id", F.explode("questions").alias("q"))
    return rows.select("exam_id", "q.question_text", F.size("q.answer_options").alias("n_options"))


# ---- Question arrays with every kind of flaw, one page per document ---------
def _flawed(spark, d):
    docs = D.table(spark, d, "documents")
    n = c("doc_id") % 12

    def option(i, text):
        return F.struct(
            text.alias("answer_text"),
            F.array(F.lit("단어")).alias("answer_vocabulary_items"),
            F.array().cast("array<string>").alias("answer_grammar_patterns"),
        )

    def question(flawed: bool):
        def pick(at, bad, good):
            return F.when((n == at) & F.lit(flawed), bad).otherwise(good)

        options = F.array(
            option(1, F.lit("가")),
            option(2, c("lang")),
            option(3, pick(1, F.lit(""), F.lit("다"))),
            option(4, pick(2, F.lit(None).cast("string"), c("source"))),
        )
        items = F.array(F.lit("말"), pick(3, F.lit(None).cast("string"), F.lit("글")))
        return F.struct(
            pick(4, F.lit("짧은글다라"), F.lit("다음 글을 읽고 고르십시오")).alias("question_text"),
            F.lit(None).cast("string").alias("question_stimulus"),
            pick(5, F.slice(options, 1, 3), options).alias("answer_options"),
            pick(6, F.lit("essay"), F.lit("grammar")).alias("question_type"),
            items.alias("question_vocabulary_items"),
            F.array().cast("array<string>").alias("question_grammar_patterns"),
            pick(7, F.repeat(F.lit("주"), F.lit(31)), F.lit("여행")).alias("topic"),
            pick(8, F.lit("extreme"), F.lit("easy")).alias("difficulty_level"),
            pick(9, F.lit(1.5), pick(10, F.lit(0.29), F.lit(0.3))).alias("confidence"),
        )

    return docs.select(
        "doc_id", F.array(question(False), question(True)).cast(QUESTIONS).alias("questions")
    )


def validated_pages(spark, d):
    return keep_valid(_flawed(spark, d)).select("doc_id", F.size("questions").alias("n"))


def validated_rows(spark, d):
    return keep_valid(_flawed(spark, d), scope="row").select(
        "doc_id", F.size("questions").alias("n")
    )


def reliability_flags(spark, d):
    rows = _flawed(spark, d).select("doc_id", F.posexplode("questions").alias("pos", "q"))
    return rows.select("doc_id", "pos", is_reliable(c("q"), 0.3).alias("reliable"))


# ---- Model output with injected faults -------------------------------------
def _model_output(spark, d):
    turns = D.table(spark, d, "conversations")
    kind = (c("conv_id") + c("turn")) % 15
    option = [
        F.struct(
            F.concat(F.lit(f"보기 {i} "), c("role")).alias("answer_text"),
            F.array(c("role")).alias("answer_vocabulary_items"),
            F.array().cast("array<string>").alias("answer_grammar_patterns"),
        )
        for i in range(1, 5)
    ]
    question = F.to_json(
        F.struct(
            F.array(F.concat(F.lit("["), c("role"), F.lit("]"))).alias("question_vocabulary_items"),
            F.concat(F.lit("질문 "), c("text")).alias("question_text"),
            c("role").alias("question_stimulus"),
            F.array(*option).alias("answer_options"),
            F.when(kind == 8, "essay").otherwise("grammar").alias("question_type"),
            F.array().cast("array<string>").alias("question_grammar_patterns"),
            F.lit("여행").alias("topic"),
            F.lit("easy").alias("difficulty_level"),
            F.lit(0.75).alias("confidence"),
        )
    )
    wrapped = F.concat(F.lit('{"questions":['), question, F.lit("]}"))
    raw = (
        F.when(kind == 1, F.concat(F.lit("Here it is: "), wrapped, F.lit(" Done.")))
        .when(kind == 2, F.regexp_replace(wrapped, r'"(\w+)":', '" $1  " :'))
        .when(kind == 3, F.replace(wrapped, F.lit("질문 "), F.lit("질문 \\uZZ")))
        .when(kind == 4, question)
        .when(kind == 5, F.concat(F.lit('{"text":"x","output":'), wrapped, F.lit("}")))
        .when(kind == 6, F.concat(F.lit('{"n":1,"data":['), question, F.lit("]}")))
        .when(kind == 7, F.substring(wrapped, F.lit(1), F.length(wrapped) - 5))
        .when(kind == 9, F.lit("I found no questions."))
        .when(kind == 10, F.lit('{"answer": [1, 2]}'))
        .when(kind == 11, F.replace(wrapped, F.lit('"confidence":0.75'), F.lit('"confidence":"high"')))
        .when(kind == 12, F.replace(wrapped, F.lit('"confidence":0.75'), F.lit('"confidence":null')))
        .when(kind == 13, F.replace(wrapped, F.lit('"confidence":0.75'), F.lit('"confidence":"0.75"')))
        .when(kind == 14, F.replace(wrapped, F.lit('"topic":"여행"'), F.lit('"topic":12')))
        .otherwise(wrapped)
    )
    return parse_model_output(turns.select("conv_id", "turn", raw.alias("raw")), "raw")


def model_output_questions(spark, d):
    rows = _model_output(spark, d).select("conv_id", "turn", F.posexplode("questions").alias("pos", "q"))
    return rows.select(
        "conv_id",
        "turn",
        "pos",
        "q.question_text",
        "q.question_stimulus",
        "q.question_type",
        "q.confidence",
        F.array_join("q.answer_options.answer_text", "|").alias("options"),
    )


def model_output_dead_letters(spark, d):
    return dead_letters(_model_output(spark, d)).select("conv_id", "turn", "status")


def model_output_nested(spark, d):
    """Questions under other objects and lists, before and behind other things."""
    turns = D.table(spark, d, "conversations")
    kind = (c("conv_id") + c("turn")) % 12

    def question(name, *before):
        """A question as JSON text, after the fields `before`; its stimulus is the name."""
        option = F.struct(
            c("role").alias("answer_text"),
            F.array().cast("array<string>").alias("answer_vocabulary_items"),
            F.array(F.lit('{["')).alias("answer_grammar_patterns"),
        )
        return F.to_json(
            F.struct(
                *before,
                F.array(F.lit("말")).alias("question_vocabulary_items"),
                F.concat(F.lit("질문 "), c("text")).alias("question_text"),
                F.lit(name).alias("question_stimulus"),
                F.array(option, option).alias("answer_options"),
                F.array().cast("array<string>").alias("question_grammar_patterns"),
            )
        )

    meta = F.struct(c("conv_id").alias("a"), F.array(F.lit(1)).alias("b")).alias("meta")
    one, two = question("one", meta), question("two")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    raw = (
        F.when(kind == 0, text('{"data":[', one, "]}"))
        .when(kind == 1, text('{"z":{"y":{"questions":[', one, ']}},"a":{"questions":[', two, ",", two, "]}}"))
        .when(kind == 2, text('{"n":{"questions":null},"o":{"p":', two, "}}"))
        .when(kind == 3, text('{"list":[{"questions":[', one, ']}],"last":', two, "}"))
        .when(kind == 4, text('{"list":[[1],[{"q":{"questions":[', one, ",", two, "]}}]]}"))
        .when(kind == 5, text('{"text":"[{}]","out":[', two, ",", one, "]}"))
        .when(kind == 6, text('{"a":{"b":{"c":{"d":{"e":{"f":', one, "}}}}}}"))
        .when(kind == 7, text('{"a":{"b":{"c":{"d":{"e":{"f":{"g":', one, "}}}}}}}"))
        .when(kind == 8, text('{"a":{"questions":"none"},"b":', one, "}"))
        .when(kind == 9, text('{"a":{"question_text":"x"},"b":[{"answer_options":[]},[1]]}'))
        .when(kind == 10, text('Sure! {" out ":', one, "} Done."))
        .otherwise(F.lit('{"answer":{"b":[]}}'))
    )
    found = parse_model_output(turns.select("conv_id", "turn", raw.alias("raw")), "raw")
    return found.select(
        "conv_id",
        "turn",
        "status",
        F.array_join("questions.question_stimulus", ",").alias("found"),
        F.try_element_at("questions", F.lit(1))["question_text"].alias("first_text"),
    )


# ---- User hooks ------------------------------------------------------------
# The user functions are local ones, so that they travel to the workers by value and
# need no installed package there.
def extractor_hook(spark, d):
    def line_questions(text: str) -> list[dict]:
        if "\n" not in text:
            raise ValueError("a page of one line")
        return [
            {
                "question_text": line,
                "question_stimulus": None,
                "answer_options": [
                    {"answer_text": w, "answer_vocabulary_items": [], "answer_grammar_patterns": []}
                    for w in line.split(" ")
                ],
                "question_type": "grammar",
                "question_vocabulary_items": [],
                "question_grammar_patterns": [],
                "topic": None,
                "difficulty_level": None,
                "confidence": 0.5,
            }
            for line in text.split("\n")
        ]

    docs = D.table(spark, d, "documents").select("doc_id", "text")
    found = hooks.extract_pages(docs, "text", line_questions, max_attempts=2, retry_delay=0.0)
    return found.select(
        "doc_id", "status", "attempts", F.posexplode_outer("questions").alias("pos", "q")
    ).select(
        "doc_id",
        "status",
        "attempts",
        "pos",
        "q.question_text",
        F.array_join("q.answer_options.answer_text", "|").alias("options"),
    )


def extractor_hook_validated(spark, d):
    """An extractor of documents that breaks a rule, always or at its first attempt."""

    def by_length(text: str, asked={}) -> list[dict]:  # noqa: B006 - attempts of this worker
        kind, again = len(text) % 8, asked.pop(text, False)
        found = {
            "question_text": text,
            "answer_options": [],
            "question_type": "grammar",
            "question_vocabulary_items": [],
            "question_grammar_patterns": [],
            "confidence": 0.5,
        }
        if 1 <= kind <= 5 and not again:
            asked[text] = True
        if kind == 1:
            del found["question_text"]
        elif kind == 2:
            found["question_type"] = "song"
        elif kind == 3 and not again:
            found["topic"] = "t" * 31
        elif kind == 4:
            found["answer_options"] = [{"answer_text": "a"}]
        elif kind == 5 and not again:
            found["confidence"] = 1.5
        elif kind == 6:
            return [found, found | {"confidence": "0.25"}]
        return [found]

    docs = D.table(spark, d, "documents").select("doc_id", "text")
    found = hooks.extract_pages(docs, "text", by_length, max_attempts=2, retry_delay=0.0)
    return found.select(
        "doc_id",
        "status",
        "attempts",
        "error",
        F.size("questions").alias("n"),
        F.length(F.array_join("questions.question_text", "")).alias("chars"),
        F.array_max("questions.confidence").alias("confidence"),
    )


def extracted_replies(spark, d):
    """A model that wraps what it is asked in JSON, with faults that it makes once or always."""

    def reply(text: str, asked={}) -> str:  # noqa: B006 - attempts of this worker
        kind, again = len(text) % 7, asked.pop(text, False)
        question = {
            "question_text": text,
            "answer_options": [],
            "question_type": "grammar",
            "question_vocabulary_items": [],
            "question_grammar_patterns": [],
        }
        whole = json.dumps({"out": {"questions": [question]}})
        if kind in (1, 2, 3, 5) and not again:
            asked[text] = True
        if kind == 1 and not again:
            return whole[:-3]
        if kind == 2:
            return "I found no questions."
        if kind == 3:
            return json.dumps({"answer": text})
        if kind == 4:
            return f"Here it is: {whole}"
        if kind == 5 and not again:
            return whole.replace("grammar", "song")
        return whole

    turns = D.table(spark, d, "conversations").select("conv_id", "turn", "text")
    found = hooks.extract_replies(turns, "text", reply, max_attempts=2, retry_delay=0.0)
    return found.select(
        "conv_id",
        "turn",
        "status",
        "attempts",
        "error",
        F.try_element_at("questions", F.lit(1))["question_text"].alias("question_text"),
    )


def parser_hook(spark, d):
    def lines_as_pages(text: str) -> dict[int, str]:
        return {i: line for i, line in enumerate(text.split("\n"), start=1) if line.strip(" ")}

    docs = D.table(spark, d, "documents").select("doc_id", "text")
    return hooks.parse_documents(docs, "text", lines_as_pages).select(
        "doc_id", "status", "page_count", "page_number", "raw_text"
    )


def file_audit(spark, d):
    """A row for each document as a file: those of one line fail, with their error."""

    def lines_as_pages(text: str) -> dict[int, str]:
        if "\n" not in text:
            raise ValueError("a file of one line")
        return {i: line for i, line in enumerate(text.split("\n"), start=1) if line.strip(" ")}

    columns = {k: D.METADATA[k] for k in ("exam_folder", "filename", "source_pdf_path")}
    files = D.derive(spark, d, "documents", {**columns, "text": "text"})
    return bronze.file_audit(hooks.parse_documents(files, "text", lines_as_pages)).drop("source_pdf_path")


_AUDIT_COLUMNS = {k: D.METADATA[k] for k in ("exam_folder", "filename")}
_BLOCKS_SQL = f"""WITH b AS (
  SELECT doc_id, lang, source, n_chars, {sql_strip('text')} AS stimulus FROM documents),
  q AS (
    SELECT doc_id, CAST(0 AS INTEGER) AS pos, CAST(doc_id AS INTEGER) AS number, stimulus,
      '창가에 둔 화분에 물을 주고 문을 닫았다 ' || n_chars AS text,
      ['첫째 ' || source, '둘째 ' || lang, '셋째', '넷째 ' || doc_id] AS options FROM b
    UNION ALL SELECT doc_id, 1, CAST(doc_id + 1 AS INTEGER), NULL, '붉게 (        )',
      ['가', '나', '다', '라'] FROM b
    UNION ALL SELECT doc_id, 2, CAST(doc_id + 2 AS INTEGER), NULL,
      '새 책상을 주문한 뒤 사흘을 기다렸다', ['온 지', '올 때', '오거나'] FROM b),
  k AS (SELECT *, CAST(doc_id AS VARCHAR) AS exam_id,
    sha256(concat_ws('||', doc_id, 3, text, stimulus)) AS question_id FROM q)"""

_FLAWS_SQL = "SELECT doc_id, CAST(doc_id % 12 AS INTEGER) AS k FROM documents"

QUERIES = {
    "segmented_blocks": (
        segmented_blocks,
        f"""{_BLOCKS_SQL} SELECT exam_id, 'ok' AS status, pos, number, text AS question_text,
        stimulus AS question_stimulus, array_to_string(options, '|') AS options FROM k""",
    ),
    "exploded_questions": (
        exploded_questions,
        f"""{_BLOCKS_SQL} SELECT question_id, exam_id, CAST(3 AS INTEGER) AS page_number,
        pos AS question_pos, text AS question_text FROM k""",
    ),
    "exploded_answers": (
        exploded_answers,
        f"""{_BLOCKS_SQL}, u AS (SELECT question_id, options,
          unnest(range(1, len(options) + 1)) AS i FROM k)
        SELECT sha256(question_id || '||' || options[i]) AS answer_id, question_id,
          CAST(i - 1 AS INTEGER) AS option_pos, options[i] AS answer_text FROM u""",
    ),
    "reliable_questions": (
        reliable_questions,
        f"""{_BLOCKS_SQL} SELECT exam_id, text AS question_text, CAST(4 AS INTEGER) AS n_options
        FROM k WHERE pos = 0""",
    ),
    "validated_pages": (
        validated_pages,
        f"""SELECT doc_id, CAST(2 AS INTEGER) AS n FROM ({_FLAWS_SQL})
        WHERE k NOT IN (2, 3, 6, 7, 8, 9)""",
    ),
    "validated_rows": (
        validated_rows,
        f"""SELECT doc_id, CAST(CASE WHEN k IN (2, 3, 6, 7, 8, 9) THEN 1 ELSE 2 END AS INTEGER) AS n
        FROM ({_FLAWS_SQL})""",
    ),
    "reliability_flags": (
        reliability_flags,
        f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos,
          pos = 0 OR k NOT IN (1, 2, 4, 5, 10) AS reliable
        FROM ({_FLAWS_SQL}), (VALUES (0), (1)) v(pos)""",
    ),
    "model_output_questions": (
        model_output_questions,
        """SELECT conv_id, turn, CAST(0 AS INTEGER) AS pos,
          CASE WHEN (conv_id + turn) % 15 = 3 THEN '질문 ZZ' ELSE '질문 ' END || text AS question_text,
          role AS question_stimulus, 'grammar' AS question_type, CAST(0.75 AS DOUBLE) AS confidence,
          '보기 1 ' || role || '|보기 2 ' || role || '|보기 3 ' || role || '|보기 4 ' || role AS options
        FROM conversations WHERE (conv_id + turn) % 15 < 7 OR (conv_id + turn) % 15 = 13""",
    ),
    "model_output_dead_letters": (
        model_output_dead_letters,
        """SELECT conv_id, turn, CASE (conv_id + turn) % 15 WHEN 7 THEN 'unparsable'
          WHEN 9 THEN 'no_json' WHEN 10 THEN 'no_questions' ELSE 'invalid' END AS status
        FROM conversations WHERE (conv_id + turn) % 15 >= 7 AND (conv_id + turn) % 15 <> 13""",
    ),
    "model_output_nested": (
        model_output_nested,
        """SELECT conv_id, turn, CASE WHEN k = 7 THEN 'too_deep' WHEN k = 8 THEN 'invalid'
            WHEN k IN (9, 11) THEN 'no_questions' ELSE 'ok' END AS status,
          CASE WHEN k IN (7, 8, 9, 11) THEN NULL WHEN k IN (2, 3) THEN 'two' WHEN k = 4 THEN 'one,two'
            WHEN k = 5 THEN 'two,one' ELSE 'one' END AS found,
          CASE WHEN k NOT IN (7, 8, 9, 11) THEN '질문 ' || text END AS first_text
        FROM (SELECT *, (conv_id + turn) % 12 AS k FROM conversations)""",
    ),
    "extractor_hook_validated": (
        extractor_hook_validated,
        """SELECT doc_id, CASE WHEN k IN (1, 2, 4) THEN 'failed' ELSE 'ok' END AS status,
          CAST(CASE WHEN k BETWEEN 1 AND 5 THEN 2 ELSE 1 END AS INTEGER) AS attempts,
          'ValueError: invalid: ' || CASE k WHEN 1 THEN 'question_text is no text'
            WHEN 2 THEN 'question_type is ' || chr(39) || 'song' || chr(39)
            WHEN 4 THEN 'answer_vocabulary_items is no list of texts' END AS error,
          CAST(CASE WHEN k IN (1, 2, 4) THEN NULL WHEN k = 6 THEN 2 ELSE 1 END AS INTEGER) AS n,
          CAST(CASE WHEN k IN (1, 2, 4) THEN NULL WHEN k = 6 THEN 2 ELSE 1 END * length(text) AS INTEGER) AS chars,
          CASE WHEN k NOT IN (1, 2, 4) THEN CAST(0.5 AS DOUBLE) END AS confidence
        FROM (SELECT *, length(text) % 8 AS k FROM documents)""",
    ),
    "extracted_replies": (
        extracted_replies,
        """SELECT conv_id, turn, CASE WHEN k IN (2, 3) THEN 'failed' ELSE 'ok' END AS status,
          CAST(CASE WHEN k IN (1, 2, 3, 5) THEN 2 ELSE 1 END AS INTEGER) AS attempts,
          CASE k WHEN 2 THEN 'ValueError: no_json' WHEN 3 THEN 'ValueError: no_questions' END AS error,
          CASE WHEN k NOT IN (2, 3) THEN text END AS question_text
        FROM (SELECT *, length(text) % 7 AS k FROM conversations)""",
    ),
    "extractor_hook": (
        extractor_hook,
        """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
          q AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l WHERE len(lines) > 1)
        SELECT doc_id, 'ok' AS status, CAST(1 AS INTEGER) AS attempts, CAST(i - 1 AS INTEGER) AS pos,
          lines[i] AS question_text, replace(lines[i], ' ', '|') AS options FROM q
        UNION ALL SELECT doc_id, 'failed', 2, NULL, NULL, NULL FROM l WHERE len(lines) = 1""",
    ),
    "file_audit": (
        file_audit,
        f"""WITH l AS (SELECT exam_folder, filename, string_split(text, chr(10)) AS lines
            FROM ({D.as_sql('documents', {**_AUDIT_COLUMNS, 'text': 'text'})})),
          n AS (SELECT *, len(lines) = 1 AS bad, coalesce(list_max(list_filter(range(1, len(lines) + 1),
            lambda i: trim(lines[i], ' ') <> '')), 0) AS last FROM l)
        SELECT exam_folder, filename, CASE WHEN bad THEN 'failed' WHEN last = 0 THEN 'empty' ELSE 'ok' END
            AS status, CASE WHEN bad THEN 0 ELSE last END AS n_pages,
          CASE WHEN bad THEN 0 ELSE len(list_filter(lines[1:last], lambda x: trim(x, ' ') = '')) END AS n_blank,
          CASE WHEN bad THEN 'ValueError: a file of one line' END AS error FROM n""",
    ),
    "parser_hook": (
        parser_hook,
        """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
          n AS (SELECT doc_id, lines, list_max(list_filter(range(1, len(lines) + 1),
            lambda i: trim(lines[i], ' ') <> '')) AS last FROM l),
          p AS (SELECT doc_id, lines, last, unnest(range(1, last + 1)) AS i FROM n)
        SELECT doc_id, 'ok' AS status, CAST(last AS INTEGER) AS page_count,
          CAST(i AS INTEGER) AS page_number,
          CASE WHEN trim(lines[i], ' ') = '' THEN '' ELSE lines[i] END AS raw_text FROM p
        UNION ALL SELECT doc_id, 'empty', NULL, NULL, NULL FROM n WHERE last IS NULL""",
    ),
}
