"""Page table, star schema, chat examples, statistics, splits."""

from pyspark.sql import functions as F

from quirework.constants import SPACE, SYSTEM_PROMPT
from quirework.functions.keys import hash_key
from quirework.operators.aggregates import keep_first
from quirework.operators.blocks import segment_pages
from quirework.operators.model_output import parse_model_output
from quirework.operators.windows import number_rows
from quirework.plans import bronze, chat, star, stats
from quirework.queries import derive as D
from quirework.queries.text import sql_clean, sql_strip
from quirework.session import shared_folder, written
from quirework.sources.tables import read_table

c = F.col
AS_OF = "2025-03-01"


# ---- The page table, out of documents --------------------------------------
def _pages(spark, d):
    documents = D.derive(
        spark, d, "documents", {**D.METADATA, "blocks": D.BLOCKS}
    )
    files = documents.select("source_pdf_path")

    def parse(papers):
        texts = F.array(F.lit("표지 안내"), F.lit(""), c("blocks"))
        return papers.select(
            "*", F.lit(3).alias("page_count"), F.posexplode(texts).alias("_pos", "raw_text")
        ).withColumn("page_number", c("_pos") + 1)

    return bronze.pages_raw(documents, files, parse, f"{AS_OF}T00:00:00+00:00")


_PAGES_SQL = f"""WITH m AS (SELECT *, sha256(concat_ws('||', exam_folder, filename)) AS exam_id,
    CASE WHEN exam_folder LIKE '%th-test-papers' THEN replace(exam_folder, '-test-papers', '')
      WHEN exam_number IS NULL THEN NULL ELSE exam_number ||
        CASE WHEN CAST(exam_number AS INTEGER) % 100 BETWEEN 10 AND 20 THEN 'th'
          WHEN exam_number LIKE '%1' THEN 'st' WHEN exam_number LIKE '%2' THEN 'nd'
          WHEN exam_number LIKE '%3' THEN 'rd' ELSE 'th' END END AS exam_edition
    FROM ({D.as_sql('documents', {**D.METADATA, 'record': 'doc_id', 'blocks': D.BLOCKS})})
    WHERE lower(filename) LIKE '%.pdf' AND lower(file_type) = 'test paper'),
  t AS (SELECT *, '표지 안내' AS raw_text, CAST(1 AS INTEGER) AS page_number FROM m
    UNION ALL SELECT *, '', 2 FROM m UNION ALL SELECT *, blocks, 3 FROM m),
  pages_raw AS (SELECT * EXCLUDE (record, blocks), '{AS_OF}T00:00:00+00:00' AS processed_at,
    CAST(3 AS INTEGER) AS page_count,
    CAST(len(regexp_extract_all(raw_text, '[^{SPACE}]+')) AS INTEGER) AS word_count,
    CAST(length(raw_text) AS INTEGER) AS char_count FROM t),
  base AS (SELECT *, sha256(concat_ws('||', filename, source_pdf_path, source_url)) AS file_id,
      sha256(concat_ws('||', download_date, download_status, exam_id,
        sha256(concat_ws('||', filename, source_pdf_path, source_url)))) AS download_id
    FROM pages_raw)"""

_QUESTIONS_SQL = f"""{_PAGES_SQL},
  cleaned AS (SELECT exam_id, page_number, {sql_clean('raw_text')} AS page FROM base
    WHERE filename LIKE '%-Reading-Test-Paper.pdf' AND page_number >= 3),
  q AS (SELECT exam_id, page_number,
    {sql_strip("regexp_extract(page, '(?s)### Question Stimulus(.*?)### Reference Text', 1)")} AS stimulus,
    {sql_strip("regexp_extract(page, '(?s)### Reference Text(.*?)### Answers', 1)")} AS text,
    [regexp_extract(page, '1\\. (첫째 .*)', 1), regexp_extract(page, '2\\. (둘째 .*)', 1),
      '셋째', regexp_extract(page, '4\\. (넷째 .*)', 1)] AS options FROM cleaned),
  dq AS (SELECT *, sha256(concat_ws('||', exam_id, page_number, text, nullif(stimulus, '')))
    AS question_id FROM q),
  da AS (SELECT exam_id, question_id, i, unnest(options) AS text FROM (
    SELECT *, 0 AS i FROM dq))"""


def _questions(spark, d):
    extracted = segment_pages(star.content_pages(_pages(spark, d)), "clean_text")
    return star.reliable_questions(extracted)


def pages_raw(spark, d):
    return _pages(spark, d)


def folder_editions(spark, d):
    records = D.derive(spark, d, "documents", {**D.METADATA, "record": "doc_id"})
    papers = bronze.paper_files(records, records.select("source_pdf_path"))
    return bronze.folder_editions(papers, "record")


def keyed_pages(spark, d):
    return star.keyed_pages(_pages(spark, d)).select(
        "exam_id", "page_number", "file_id", "download_id"
    )


def dim_exam(spark, d):
    return star.dim_exam(star.keyed_pages(_pages(spark, d)))


def dim_file(spark, d):
    return star.dim_file(star.keyed_pages(_pages(spark, d)))


def fact_download(spark, d):
    return star.fact_download(star.keyed_pages(_pages(spark, d)), AS_OF)


def content_pages(spark, d):
    return star.content_pages(_pages(spark, d))


def dim_question(spark, d):
    flat = star.dim_question(_questions(spark, d))
    return flat.withColumns(
        {
            "question_vocabulary_items": F.array_join("question_vocabulary_items", "|"),
            "question_grammar_patterns": F.array_join("question_grammar_patterns", "|"),
        }
    )


def dim_answer(spark, d):
    flat = star.dim_answer(_questions(spark, d))
    return flat.withColumns(
        {
            "answer_vocabulary_items": F.array_join("answer_vocabulary_items", "|"),
            "answer_grammar_patterns": F.array_join("answer_grammar_patterns", "|"),
        }
    )


def fact_qa(spark, d):
    return star.fact_qa_of_pages(_questions(spark, d))


# ---- Orders as questions ---------------------------------------------------
def _order_answers(spark, d):
    answers = D.derive(spark, d, "lineitem", D.ANSWERS)
    return answers.withColumn("answer_id", hash_key("question_id", "raw_answer_text"))


def order_links(spark, d):
    questions = D.derive(spark, d, "orders", D.QUESTIONS)
    return star.fact_qa(D.derive(spark, d, "lineitem", D.ANSWERS), questions, "raw_answer_text")


def incomplete_questions(spark, d):
    return star.incomplete_questions(
        D.derive(spark, d, "orders", D.QUESTIONS), _order_answers(spark, d)
    )


def _flat(examples):
    return examples.select(
        "training_id", "exam_id", "question_id", "topik_level", "topic", "difficulty_level",
        "question_type", "confidence",
        *[F.col("messages")[i]["role"].alias(f"role_{i}") for i in range(3)],
        *[F.col("messages")[i]["content"].alias(f"content_{i}") for i in range(3)],
    )


def chat_examples(spark, d):
    """Options in their printed order."""
    return _flat(
        chat.chat_examples(
            D.derive(spark, d, "customer", D.EXAMS),
            D.derive(spark, d, "orders", D.QUESTIONS),
            D.derive(spark, d, "lineitem", D.ANSWERS),
            option_order=D.OPTION_ORDER,
        )
    )


def chat_examples_by_key(spark, d):
    """Options in the order of their keys, incomplete examples left out."""
    answers = keep_first(_order_answers(spark, d), ["answer_id"], D.OPTION_ORDER)
    return _flat(
        chat.chat_examples(
            D.derive(spark, d, "customer", D.EXAMS),
            D.derive(spark, d, "orders", D.QUESTIONS),
            answers,
            drop_incomplete=True,
        )
    )


# ---- From a model's replies to chat examples --------------------------------
def _replies(spark, d):
    """Each conversation turn as a page and the model's reply to it. Of five replies one is
    plain JSON, one stands in prose, one is unsure, one is cut and one lacks an option."""
    turns = D.table(spark, d, "conversations")
    kind = (c("conv_id") + c("turn")) % 5

    def option(i):
        return F.struct(
            F.concat(F.lit(f"보기 {i} "), c("role")).alias("answer_text"),
            F.array(F.lit(f"낱말{i}")).alias("answer_vocabulary_items"),
            F.array(c("role")).alias("answer_grammar_patterns"),
        )

    options = F.array(*[option(i) for i in range(1, 5)])
    question = F.struct(
        F.concat(F.lit("다음 글에 알맞은 제목을 하나만 고르십시오 "), c("turn").cast("string")).alias("question_text"),
        F.concat(F.lit("지문 "), c("text")).alias("question_stimulus"),
        F.when(kind == 4, F.slice(options, 1, 3)).otherwise(options).alias("answer_options"),
        F.lit("reading comprehension").alias("question_type"),
        F.array(F.lit("[제목]"), c("role")).alias("question_vocabulary_items"),
        F.array(F.lit("-(으)ㄴ")).alias("question_grammar_patterns"),
        F.lit("신문").alias("topic"),
        F.lit("medium").alias("difficulty_level"),
        F.when(kind == 2, 0.25).otherwise(0.75).alias("confidence"),
    )
    reply = F.to_json(F.struct(F.array(question).alias("questions")))
    raw = (
        F.when(kind == 1, F.concat(F.lit("Here you are: "), reply, F.lit(" That is all.")))
        .when(kind == 3, F.substring(reply, F.lit(1), F.length(reply) - 4))
        .otherwise(reply)
    )
    return turns.select(
        c("conv_id").cast("string").alias("exam_id"), c("turn").cast("int").alias("page_number"), raw.alias("raw")
    )


def _model_questions(spark, d):
    return star.reliable_questions(parse_model_output(_replies(spark, d), "raw"))


def model_dim_question(spark, d):
    flat = star.dim_question(_model_questions(spark, d))
    items = ("question_vocabulary_items", "question_grammar_patterns")
    return flat.withColumns({name: F.array_join(name, "|") for name in items})


def model_dim_answer(spark, d):
    flat = star.dim_answer(_model_questions(spark, d), with_position=True)
    items = ("answer_vocabulary_items", "answer_grammar_patterns")
    return flat.withColumns({name: F.array_join(name, "|") for name in items})


def model_chat_examples(spark, d):
    exams = D.table(spark, d, "conversations").select(
        c("conv_id").cast("string").alias("exam_id"),
        F.when(c("conv_id") % 2 == 0, "TOPIK I").otherwise("TOPIK II").alias("topik_level"),
    )
    questions = _model_questions(spark, d)
    return _flat(
        chat.chat_examples(
            exams.distinct(),
            star.dim_question(questions),
            star.dim_answer(questions, with_position=True),
            option_order=["option_pos"],
            drop_incomplete=True,
        )
    )


def answer_order(spark, d):
    """Rank by key."""
    texts = D.derive(spark, d, "lineitem", D.ANSWERS).select("question_id", "raw_answer_text").distinct()
    unique = texts.select("question_id", hash_key("question_id", "raw_answer_text").alias("answer_id"))
    return number_rows(unique, ["question_id"], [c("answer_id")], "answer_order")


def _printed_maps(table):
    def text(name):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(
            F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
        )

    return table.withColumns(
        {n: text(n) for n in ("distribution_by_difficulty", "distribution_by_type")}
    )


def exam_stats(spark, d):
    return _printed_maps(
        stats.exam_stats(
            D.derive(spark, d, "orders", D.QUESTIONS),
            D.derive(spark, d, "lineitem", D.ANSWERS),
            f"{AS_OF} 00:00:00",
        )
    )


def refreshed_stats(spark, d):
    """Statistics of most orders, then of late ones of some customers, then of one customer anew."""
    folder = shared_folder(spark)
    questions = D.derive(spark, d, "orders", {**D.QUESTIONS, "late": "o_custkey % 7 = 3 AND o_orderkey % 2 = 0"})
    answers = written(stats.answer_totals(D.derive(spark, d, "lineitem", D.ANSWERS)), "totals")
    stats.start_stats(folder, questions.filter("NOT late"), answers, "first", "2025-01-01 00:00:00")
    late = questions.filter("late")
    stats.refresh_stats(folder, late, answers, "late", f"{AS_OF} 00:00:00")
    stats.refresh_stats(folder, late, answers, "late", f"{AS_OF} 00:00:00")  # repeated, as after a lost run
    again = questions.filter("exam_id = '8'")
    stats.refresh_stats(folder, again, answers, "again", "2025-04-01 00:00:00", replaced=True)
    return _printed_maps(read_table(spark, f"{folder}/stats").drop("bucket"))


def split_and_gate(spark, d):
    questions = D.derive(spark, d, "orders", D.QUESTIONS)
    return chat.split_examples(
        questions, "question_id", "difficulty_level", min_confidence=0.3,
        stratum_shares={"hard": (60, 20, 20)},
    ).select("question_id", "difficulty_level", "confidence", "split")


_ORDER = ", ".join(D.OPTION_ORDER)


_ORDERS_SQL = f"""WITH e AS ({D.as_sql('customer', D.EXAMS)}), q AS ({D.as_sql('orders', D.QUESTIONS)}),
      a AS ({D.as_sql('lineitem', D.ANSWERS)})"""
_REPLIES_SQL = """WITH t AS (SELECT CAST(conv_id AS VARCHAR) AS exam_id, CAST(turn AS INTEGER) AS page_number,
    conv_id, role, '다음 글에 알맞은 제목을 하나만 고르십시오 ' || turn AS raw_question_text,
    '지문 ' || text AS question_stimulus FROM conversations WHERE (conv_id + turn) % 5 IN (0, 1)),
  q AS (SELECT *, sha256(concat_ws('||', exam_id, page_number, raw_question_text, question_stimulus))
      AS question_id, 'reading comprehension' AS question_type, '신문' AS topic,
    'medium' AS difficulty_level, CAST(0.75 AS FLOAT) AS confidence FROM t),
  a AS (SELECT question_id, role, i, '보기 ' || i || ' ' || role AS raw_answer_text
    FROM q, (VALUES (1), (2), (3), (4)) v(i)),
  e AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS exam_id,
    CASE WHEN conv_id % 2 = 0 THEN 'TOPIK I' ELSE 'TOPIK II' END AS topik_level FROM conversations)"""


def _examples_sql(options: str, where: str = "", tables: str = _ORDERS_SQL) -> str:
    prompt = SYSTEM_PROMPT.replace("'", "''")
    return f"""{tables}, {options},
      p AS (SELECT question_id, max(raw_answer_text) FILTER (n = 1) AS o1,
        max(raw_answer_text) FILTER (n = 2) AS o2, max(raw_answer_text) FILTER (n = 3) AS o3,
        max(raw_answer_text) FILTER (n = 4) AS o4 FROM r GROUP BY 1),
      x AS (SELECT question_id AS training_id, exam_id, question_id, topik_level, topic,
        difficulty_level, question_type, confidence, 'system' AS role_0, 'user' AS role_1,
        'assistant' AS role_2, '{prompt}' AS content_0,
        'Generate a ' || topik_level || ' multiple-choice question about the topic "' || topic ||
          '", with difficulty level "' || difficulty_level || '" and question type "' ||
          question_type || '". Follow the output format specified in the system prompt.' AS content_1,
        'Question stimulus: ' || ifnull(question_stimulus, '') || {D.NL} || 'Question text: ' ||
          raw_question_text || {D.NL} || 'Option 1. ' || o1 || {D.NL} || 'Option 2. ' || o2 ||
          {D.NL} || 'Option 3. ' || o3 || {D.NL} || 'Option 4. ' || o4 AS content_2
        FROM q JOIN p USING (question_id) JOIN e USING (exam_id))
    SELECT * FROM x {where}"""


def _stats_sql(last_updated):
    return f"""WITH q AS ({D.as_sql('orders', D.QUESTIONS)}), a AS ({D.as_sql('lineitem', D.ANSWERS)}),
          qa AS (SELECT exam_id, count(*) AS total_answers,
            avg(len(string_split(raw_answer_text, ' '))) AS avg_word_count_answer
            FROM q JOIN a USING (question_id) GROUP BY 1),
          qs AS (SELECT exam_id, count(*) AS total_questions,
            avg(len(string_split(raw_question_text, ' '))) AS avg_word_count_question FROM q GROUP BY 1),
          df AS (SELECT exam_id, string_agg(k || '=' || n, ',' ORDER BY k) AS s FROM (SELECT exam_id,
            difficulty_level AS k, count(*) AS n FROM q GROUP BY 1, 2) GROUP BY 1),
          ty AS (SELECT exam_id, string_agg(k || '=' || n, ',' ORDER BY k) AS s FROM (SELECT exam_id,
            question_type AS k, count(*) AS n FROM q WHERE question_type IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
        SELECT sha256(exam_id) AS stats_id, exam_id, CAST(total_questions AS INTEGER) AS total_questions,
          CAST(coalesce(total_answers, 0) AS INTEGER) AS total_answers, avg_word_count_question,
          avg_word_count_answer, df.s AS distribution_by_difficulty,
          coalesce(ty.s, '') AS distribution_by_type, {last_updated} AS last_updated
        FROM qs LEFT JOIN qa USING (exam_id) LEFT JOIN df USING (exam_id) LEFT JOIN ty USING (exam_id)"""


QUERIES = {
    "pages_raw": (
        pages_raw,
        f"{_PAGES_SQL} SELECT * FROM pages_raw",
    ),
    "folder_editions": (
        folder_editions,
        f"""{_PAGES_SQL} SELECT exam_folder, coalesce(arg_min(exam_edition, record)
        FILTER (exam_edition IS NOT NULL), exam_folder) AS exam_edition FROM m GROUP BY 1""",
    ),
    "keyed_pages": (
        keyed_pages,
        f"{_PAGES_SQL} SELECT exam_id, page_number, file_id, download_id FROM base",
    ),
    "dim_exam": (
        dim_exam,
        f"""{_PAGES_SQL} SELECT DISTINCT exam_id, label AS exam_name, exam_edition, exam_number,
        level AS topik_level, section AS exam_section FROM base""",
    ),
    "dim_file": (
        dim_file,
        f"""{_PAGES_SQL} SELECT DISTINCT file_id, filename, file_type, size_kb, page_count,
        source_pdf_path, source_url FROM base""",
    ),
    "fact_download": (
        fact_download,
        f"""{_PAGES_SQL} SELECT DISTINCT download_id, exam_id, file_id,
        CAST(download_date AS DATE) AS download_date, download_status,
        DATE '{AS_OF}' AS bronze_processed_at, DATE '{AS_OF}' AS silver_processed_at FROM base""",
    ),
    "content_pages": (
        content_pages,
        f"""{_PAGES_SQL} SELECT exam_id, filename, page_number, {sql_clean('raw_text')} AS clean_text
        FROM base WHERE filename LIKE '%-Reading-Test-Paper.pdf' AND page_number >= 3""",
    ),
    "dim_question": (
        dim_question,
        f"""{_QUESTIONS_SQL} SELECT question_id, exam_id, page_number,
        CAST(NULL AS VARCHAR) AS question_type, text AS raw_question_text,
        nullif(stimulus, '') AS question_stimulus, '' AS question_vocabulary_items,
        '' AS question_grammar_patterns, CAST(NULL AS VARCHAR) AS topic,
        CAST(NULL AS VARCHAR) AS difficulty_level, CAST(0 AS FLOAT) AS confidence FROM dq""",
    ),
    "dim_answer": (
        dim_answer,
        f"""{_QUESTIONS_SQL} SELECT sha256(question_id || '||' || text) AS answer_id, question_id,
        text AS raw_answer_text, CAST(NULL AS BOOLEAN) AS is_correct,
        '' AS answer_vocabulary_items, '' AS answer_grammar_patterns FROM da""",
    ),
    "fact_qa": (
        fact_qa,
        f"""{_QUESTIONS_SQL} SELECT sha256(concat_ws('||', exam_id, question_id,
        sha256(question_id || '||' || text))) AS qa_id, exam_id, question_id,
        sha256(question_id || '||' || text) AS answer_id FROM da""",
    ),
    "order_links": (
        order_links,
        f"""WITH q AS ({D.as_sql('orders', D.QUESTIONS)}), a AS (SELECT DISTINCT question_id,
          sha256(question_id || '||' || raw_answer_text) AS answer_id
          FROM ({D.as_sql('lineitem', D.ANSWERS)}))
        SELECT sha256(concat_ws('||', exam_id, question_id, answer_id)) AS qa_id, exam_id,
          question_id, answer_id FROM a JOIN q USING (question_id)""",
    ),
    "incomplete_questions": (
        incomplete_questions,
        f"""SELECT question_id, count(DISTINCT raw_answer_text) AS n_options
        FROM ({D.as_sql('orders', D.QUESTIONS)}) q
        LEFT JOIN ({D.as_sql('lineitem', D.ANSWERS)}) a USING (question_id)
        GROUP BY 1 HAVING count(DISTINCT raw_answer_text) < 4""",
    ),
    "answer_order": (
        answer_order,
        f"""WITH a AS (SELECT DISTINCT question_id, sha256(question_id || '||' || raw_answer_text)
          AS answer_id FROM ({D.as_sql('lineitem', D.ANSWERS)}))
        SELECT question_id, answer_id, CAST(row_number() OVER
          (PARTITION BY question_id ORDER BY answer_id) AS INTEGER) AS answer_order FROM a""",
    ),
    "chat_examples": (
        chat_examples,
        _examples_sql(
            f"r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY {_ORDER}) AS n FROM a)"
        ),
    ),
    "chat_examples_by_key": (
        chat_examples_by_key,
        _examples_sql(
            """r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY
            sha256(question_id || '||' || raw_answer_text)) AS n
            FROM (SELECT DISTINCT question_id, raw_answer_text FROM a))""",
            "WHERE content_1 IS NOT NULL AND content_2 IS NOT NULL",
        ),
    ),
    "model_dim_question": (
        model_dim_question,
        f"""{_REPLIES_SQL} SELECT question_id, exam_id, page_number, question_type, raw_question_text,
        question_stimulus, '[제목]|' || role AS question_vocabulary_items,
        '-(으)ㄴ' AS question_grammar_patterns, topic, difficulty_level, confidence FROM q""",
    ),
    "model_dim_answer": (
        model_dim_answer,
        f"""{_REPLIES_SQL} SELECT sha256(question_id || '||' || raw_answer_text) AS answer_id,
        question_id, raw_answer_text, CAST(NULL AS BOOLEAN) AS is_correct,
        '낱말' || i AS answer_vocabulary_items, role AS answer_grammar_patterns,
        CAST(i - 1 AS INTEGER) AS option_pos FROM a""",
    ),
    "model_chat_examples": (
        model_chat_examples,
        _examples_sql(
            "r AS (SELECT *, i AS n FROM a)",
            "WHERE content_1 IS NOT NULL AND content_2 IS NOT NULL",
            _REPLIES_SQL,
        ),
    ),
    "exam_stats": (exam_stats, _stats_sql(f"TIMESTAMP '{AS_OF} 00:00:00'")),
    "refreshed_stats": (
        refreshed_stats,
        _stats_sql(
            f"""CASE WHEN exam_id = '8' THEN TIMESTAMP '2025-04-01 00:00:00' WHEN exam_id IN (
              SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey % 7 = 3 AND o_orderkey % 2 = 0)
            THEN TIMESTAMP '{AS_OF} 00:00:00' ELSE TIMESTAMP '2025-01-01 00:00:00' END"""
        ),
    ),
    "split_and_gate": (
        split_and_gate,
        f"""SELECT question_id, difficulty_level, confidence,
          CASE WHEN b < CASE difficulty_level WHEN 'hard' THEN 60 ELSE 80 END THEN 'train'
            WHEN b < CASE difficulty_level WHEN 'hard' THEN 80 ELSE 90 END THEN 'validation'
            ELSE 'test' END AS split
        FROM (SELECT *, CAST('0x' || md5(difficulty_level || '|' || question_id)[1:8] AS BIGINT) % 100 AS b
          FROM ({D.as_sql('orders', D.QUESTIONS)}) WHERE confidence >= 0.3)""",
    ),
}
