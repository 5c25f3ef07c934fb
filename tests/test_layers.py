"""The three layer jobs, from files to chat examples and statistics."""

import json

import pytest
from pyspark.sql import functions as F

from quirework import schemas as S
from quirework.functions.text import clean_text
from quirework.operators.blocks import segment_questions
from quirework.plans import chat, layers, star
from quirework.plans.catalogue import file_catalogue, paper_pages
from quirework.plans.stats import exam_stats
from quirework.sources.tables import export_examples

c = F.col

QUESTION = """## Question {n}
### Question Stimulus
※ 아래 설명에 맞는 물건을 하나 찾으세요.
### Reference Text
비가 와도 젖지 않고 손잡이가 아주 튼튼해요 {n}
### Answers
① 구두
② 우산
③ 자전거 {n}
④ 선풍기
"""


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("papers")
    records = {
        "102nd-papers": ["102nd-I-Reading-Test-Paper.pdf", "102nd-II-Reading-Test-Paper.pdf",
                         "broken-Reading-Test-Paper.pdf", "gone-Reading-Test-Paper.pdf"],
        "sample": ["sample-Listening-Test-Paper.PDF", "sample-Reading-Test-Paper.pdf", "audio.mp3"],
    }
    for folder, names in records.items():
        (root / folder).mkdir()
        rows = [
            {"filename": n, "label": n[:5], "exam_number": "83" if folder == "sample" else None,
             "file_type": "TEST PAPER", "level": "TOPIK I", "section": "Reading",
             "source_url": f"https://x.org/{n}", "download_date": "2025-01-02", "size_kb": 1.0,
             "download_status": "ok"}
            for n in names
        ]
        (root / folder / "metadata.json").write_text(json.dumps(rows), encoding="utf-8")
        for n in names:
            if not n.startswith("gone"):
                (root / folder / n).write_bytes(b"%PDF")

    template = QUESTION

    def parser(path):
        if "broken" in path:
            raise ValueError("cannot parse")
        if "Listening" in path:
            return {}
        page = template.format(n=5) + "\n" + template.format(n=6) + template.format(n=5)
        return {1: "cover", 3: page, 5: "   \n", 6: "no blocks here"}

    out = tmp_path_factory.mktemp("out")
    bronze, silver, gold = (str(out / n) for n in ("bronze", "silver", "gold"))
    counts = {"bronze": layers.run_bronze(spark, str(root), bronze, parser, "2025-03-01T00:00:00", 4,
                                          audit_path=str(out / "audit"))}
    counts |= layers.run_silver(spark, bronze, silver, as_of="2025-03-02")
    counts |= layers.run_gold(spark, silver, gold, as_of="2025-03-03 00:00:00")
    return counts, bronze, silver, gold


def test_counts(built):
    assert built[0] == {
        "bronze": {"pages": 18, "pages_blank": 9, "files_failed": 1, "files_empty": 1},
        "dim_exam": 3, "dim_file": 3, "dim_question": 6, "dim_answer": 24,
        "fact_download": 3, "bad_dates": 0, "fact_qa": 24, "chat_examples": 6, "exam_stats": 3,
    }


def test_files_are_audited(spark, built):
    audit = built[1].removesuffix("bronze") + "audit"
    files = {r.filename: r for r in spark.read.parquet(f"{audit}/files").collect()}
    assert {f: r.status for f, r in files.items() if r.status != "ok"} == {
        "broken-Reading-Test-Paper.pdf": "failed", "sample-Listening-Test-Paper.PDF": "empty"}
    assert files["broken-Reading-Test-Paper.pdf"].error == "ValueError: cannot parse"
    ok = files["sample-Reading-Test-Paper.pdf"]
    assert (ok.n_pages, ok.n_blank, ok.error) == (6, 3, None)
    folders = {tuple(r) for r in spark.read.parquet(f"{audit}/folders").collect()}
    assert folders == {("102nd-papers", 3, 2), ("sample", 2, 1)}


def test_pages(spark, built):
    pages = spark.read.parquet(built[1])
    assert pages.columns == S.PAGES_RAW.names
    one = pages.filter("filename = 'sample-Reading-Test-Paper.pdf'").orderBy("page_number").collect()
    assert [r.page_number for r in one] == [1, 2, 3, 4, 5, 6] and one[0].page_count == 6
    assert one[0].exam_edition == "83rd" and one[1].raw_text == "" and one[0].word_count == 1
    assert {r[0] for r in pages.filter("exam_folder = '102nd-papers'").select("exam_edition").collect()} == {"102nd"}


def test_examples(spark, built):
    examples = spark.read.parquet(f"{built[3]}/chat_examples")
    assert [f.name for f in examples.schema] == S.CHAT_EXAMPLE.names
    # Nothing classifies the questions here, so the request cannot be worded.
    row = examples.first()
    assert [m.role for m in row.messages] == ["system", "user", "assistant"]
    assert row.messages[1].content is None
    assert "Option 1. 구두\nOption 2. 우산\nOption 3. 자전거" in row.messages[2].content
    stats = spark.read.parquet(f"{built[3]}/exam_stats").collect()
    assert {(r.total_questions, r.total_answers, r.avg_word_count_question) for r in stats} == {(2, 8, 8.0)}


def test_examples_are_exported_by_split(spark, built, tmp_path):
    examples = spark.read.parquet(f"{built[3]}/chat_examples")
    split = chat.split_examples(examples, shares=(50, 30, 20))
    assert export_examples(split, str(tmp_path / "set")) == 6
    schema = type(S.CHAT_EXAMPLE)(list(S.CHAT_EXAMPLE)).add("split", "string")
    back = spark.read.schema(schema).json(str(tmp_path / "set"))
    assert back.select("training_id", "messages", "split").exceptAll(
        split.select("training_id", "messages", "split")
    ).count() == 0
    assert back.count() == 6


def test_audit(spark, built):
    audit = {(r.stage, r.status): r.n_rows for r in layers.silver_audit(spark, built[2]).collect()}
    assert audit == {
        ("page", "ok"): 3, ("page", "no_blocks"): 3, ("question_seen", "seen"): 9,
        ("question_kept", "kept"): 6,
    }


def test_filters_reach_the_scan(spark, built):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = star.content_pages(spark.read.schema(S.PAGES_RAW).parquet(built[1]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "StringEndsWith(filename,-Reading-Test-Paper.pdf)" in plan
    assert "GreaterThanOrEqual(page_number,3)" in plan
    assert "source_url" not in plan


def test_option_order_and_incomplete(spark):
    exams = spark.createDataFrame([("e", "TOPIK I")], "exam_id string, topik_level string")
    questions = spark.createDataFrame(
        [("q1", "e", 3, "grammar", "T", None, [], [], "topic", "easy", 0.5),
         ("q2", "e", 3, "grammar", "U", "S", [], [], "topic", "easy", 0.5),
         ("q3", "none", 3, "grammar", "V", "S", [], [], "topic", "easy", 0.5)], S.DIM_QUESTION)
    answers = spark.createDataFrame(
        [("q1", f"a{9 - i}", i, t) for i, t in enumerate("ABCDE")] + [("q2", "a", 0, "X")] + [("q3", "a", 0, "Y")],
        "question_id string, answer_id string, option_pos int, raw_answer_text string")
    by_key = {r.question_id: r for r in chat.chat_examples(exams, questions, answers).collect()}
    assert set(by_key) == {"q1", "q2"}
    assert by_key["q1"].messages[2].content.endswith("Option 1. E\nOption 2. D\nOption 3. C\nOption 4. B")
    assert by_key["q1"].messages[2].content.startswith("Question stimulus: \nQuestion text: T\n")
    assert by_key["q2"].messages[2].content is None
    printed = chat.chat_examples(exams, questions, answers, ["option_pos"], drop_incomplete=True).collect()
    assert [r.question_id for r in printed] == ["q1"]
    assert printed[0].messages[2].content.endswith("Option 1. A\nOption 2. B\nOption 3. C\nOption 4. D")
    assert printed[0].messages[1].content == (
        'Generate a TOPIK I multiple-choice question about the topic "topic", with difficulty level '
        '"easy" and question type "grammar". Follow the output format specified in the system prompt.')


def test_bad_dates(spark):
    base = spark.createDataFrame(
        [("d", "e", "f", "not a date", "ok", "2025-01-01T10:00:00+00:00")],
        "download_id string, exam_id string, file_id string, download_date string, download_status string, processed_at string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        star.fact_download(base).collect()
    row = star.fact_download(base, strict=False).first()
    assert row.download_date is None and str(row.bronze_processed_at) == "2025-01-01"
    assert [tuple(r) for r in star.bad_dates(base).collect()] == [("d", "not a date")]


def test_splits_are_disjoint_and_stable(spark):
    df = spark.range(5000).select(c("id").cast("string").alias("training_id"),
                                  F.when(c("id") % 2 == 0, "easy").otherwise("hard").alias("difficulty_level"),
                                  ((c("id") % 10) / 10).cast("float").alias("confidence"))
    once = chat.split_examples(df, min_confidence=0.3)
    again = chat.split_examples(df.repartition(7).orderBy(F.desc("training_id")), min_confidence=0.3)
    assert once.exceptAll(again).count() == 0 and once.count() == 3500
    shares = {r[0]: r[1] for r in once.groupBy("split").count().collect()}
    assert abs(shares["train"] / 3500 - 0.8) < 0.03 and set(shares) == {"train", "validation", "test"}
    with pytest.raises(ValueError):
        chat.split_examples(df, shares=(80, 10, 5))


def test_stats_do_not_fan_out(spark):
    questions = spark.createDataFrame(
        [("q1", "e", "a b c", "easy", "grammar"), ("q2", "e", "a", None, "odd"), ("q3", "f", None, "hard", None)],
        "question_id string, exam_id string, raw_question_text string, difficulty_level string, question_type string")
    answers = spark.createDataFrame([("q1", "x y"), ("q1", "z")], "question_id string, raw_answer_text string")
    rows = {r.exam_id: r for r in exam_stats(questions, answers, "2025-01-01 00:00:00").collect()}
    e, f = rows["e"], rows["f"]
    assert (e.total_questions, e.total_answers, e.avg_word_count_question, e.avg_word_count_answer) == (2, 2, 2.0, 1.5)
    assert (e.distribution_by_difficulty, e.distribution_by_type) == ({"easy": 1}, {"grammar": 1, "odd": 1})
    assert (f.total_answers, f.avg_word_count_answer, f.distribution_by_type) == (0, None, {})


def test_catalogue_keeps_pages_without_a_format_once(spark):
    html = "<a href='/x&#038;y.pdf'>102nd &#8211; READING &#x41;&amp;#65;&#38;lt;&#0;&#xD800; &#junk</a>"
    pages = spark.createDataFrame([(1, "http://h/a", html), (2, "http://h/b", html)], "page_id long, url string, html string")
    formats = spark.createDataFrame([("http://h/a", "Old"), ("http://h/a", "New")], "url string, format string")
    rows = file_catalogue(pages, paper_formats=formats).orderBy("page_url").collect()
    assert [(r.page_url, r.topik_format) for r in rows] == [("http://h/a", "New"), ("http://h/b", None)]
    assert rows[0].source_url == "http://h/x&y.pdf"
    assert rows[0].label == "102nd \u2013 READING A&#65;&lt;\ufffd\ufffd &#junk"


def test_paper_pages_carry_the_format(spark):
    html = ("<a href='https://site.org/90th'>a</a><h2>New Format</h2><a href='/91st?x#y'>b</a>"
            "<h3>Notes</h3><a href='/92nd'>c</a><h2>The <b>Old Format</b></h2><h3>old<i> format</i></h3><a href='/91st'>b</a><a href='35th/'>d</a>")
    pages = spark.createDataFrame([(1, "https://site.org/index/", html)], "page_id bigint, url string, html string")
    got = {(r.url, r.format) for r in paper_pages(pages, r"(?:^|/)[0-9]+[a-z]{2}").collect()}
    assert got == {
        ("https://site.org/90th", "New Format"), ("https://site.org/91st", "New Format"),
        ("https://site.org/92nd", "New Format"), ("https://site.org/index/35th/", "Old Format"),
    }


def test_row_functions_run_on_a_stream(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(QUESTION.format(n=1),), ("x",)], "t string").write.parquet(source)
    pages = spark.readStream.schema("t string").parquet(source)
    found = pages.select(F.size(segment_questions(clean_text(c("t")))).alias("n"))
    query = (found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start(target))
    query.awaitTermination(120)
    assert sorted(r.n for r in spark.read.parquet(target).collect()) == [0, 1]


def test_bronze_reads_contents(spark, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    names = ["1-Reading-Test-Paper.pdf", "2-Reading-Test-Paper.pdf"]
    rows = [{"filename": n, "file_type": "Test Paper"} for n in names]
    (tmp_path / "in" / "x" / "metadata.json").write_text(json.dumps(rows), encoding="utf-8")
    (tmp_path / "in" / "x" / names[0]).write_bytes("한 글".encode())
    (tmp_path / "in" / "x" / names[1]).write_bytes(b"\xff")
    counts = layers.run_bronze(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), lambda data: {1: data.decode()}, content=True
    )
    assert counts == {"pages": 1, "pages_blank": 0, "files_failed": 1, "files_empty": 0}
    assert [r.raw_text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["한 글"]


@pytest.mark.parametrize("replaced", [False, True])
def test_statistics_kept_up_to_date_equal_those_computed_anew(spark, tmp_path, replaced):
    from quirework.plans.stats import refresh_stats, start_stats

    questions = spark.createDataFrame(
        [(f"q{i}", [None, "a", "b", "c"][i % 4], ["easy", None, "hard"][i % 3], None if i % 5 else "grammar",
          None if i % 7 == 6 else "one two " * (i % 4)) for i in range(60)],
        "question_id string, exam_id string, difficulty_level string, question_type string, raw_question_text string",
    )
    answers = spark.createDataFrame(
        [(f"q{i % 50}", None if i % 11 == 10 else "w " * (i % 6)) for i in range(130)],
        "question_id string, raw_answer_text string",
    )
    folder, early = str(tmp_path / "mart"), c("question_id") < "q3"
    start_stats(folder, questions.filter(early), answers, "1", "2025-01-01 00:00:00")
    changed = c("exam_id").isin("a", "b") if not replaced else c("exam_id").isNull()
    later = questions.filter(changed if replaced else ~early & changed)
    for _ in range(2):
        n = refresh_stats(folder, later, answers, "2", "2025-02-01 00:00:00", replaced)
    assert n >= later.select("exam_id").distinct().count()
    rest = questions.filter(early & ~F.coalesce(changed, F.lit(False))).unionByName(
        later if replaced else questions.filter(changed)
    )
    want = {r.exam_id: r for r in exam_stats(rest, answers, "2025-01-01 00:00:00").collect()}
    got = {r.exam_id: r for r in spark.read.parquet(f"{folder}/stats").drop("bucket").collect()}
    assert set(got) == set(want)
    for exam, row in got.items():
        own = later.filter(c("exam_id").eqNullSafe(F.lit(exam))).count()
        assert row.last_updated.month == (2 if own else 1)
        assert {k: v for k, v in row.asDict().items() if k != "last_updated"} == {
            k: v for k, v in want[exam].asDict().items() if k != "last_updated"
        }, exam


def test_links_of_pages_equal_links_of_dimensions(spark):
    text = QUESTION.format(n=5) + "\n" + QUESTION.format(n=6) + QUESTION.format(n=5)
    pages = spark.createDataFrame([("e", 3, text), ("e", 4, text), ("f", 3, text)], "exam_id string, page_number int, t string")
    from quirework.operators.blocks import segment_pages

    questions = star.reliable_questions(segment_pages(pages, "t"))
    joined = star.fact_qa(star.dim_answer(questions), star.dim_question(questions))
    direct = star.fact_qa_of_pages(questions)
    text = direct._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Scan ExistingRDD") == 1
    assert sorted(direct.collect()) == sorted(joined.collect()) and direct.count() == 24
