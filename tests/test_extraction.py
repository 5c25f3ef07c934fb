"""Question blocks, model output, validation, hooks."""

import json

from pyspark.sql import functions as F

from quirework.operators import hooks
from quirework.operators.blocks import question_number, question_pieces, segment_pages
from quirework.operators.model_output import parse_model_output
from quirework.operators.nested import explode_answers, explode_questions
from quirework.operators.predicates import is_reliable, keep_valid
from quirework.schemas import QUESTIONS

c = F.col

PAGE = """머리말
## Question 5
### Question Stimulus
※ [5~8] A
### Reference Image
B
C
### Answers
① 구두
② 우산
③ 자전거
④ 선풍기

## Question 6
### Reference Text
D (   )
### Answers
1. a
2. b 3. c
4.
긴
말 2.5

## Question 7
### Answers
"""


def test_segment_golden(spark):
    df = spark.createDataFrame([(PAGE,), ("no headings",), ("",)], "t string")
    first, none, empty = segment_pages(df, "t").collect()
    five, six, seven = first.questions
    assert (five.question_stimulus, five.question_text) == ("※ [5~8] A", "B\nC")
    assert [o.answer_text for o in five.answer_options] == ["구두", "우산", "자전거", "선풍기"]
    assert (six.question_stimulus, six.question_text) == (None, "D (   )")
    assert [o.answer_text for o in six.answer_options] == ["a", "b", "c", "긴 말 2.5"]
    assert seven.question_text is None and seven.answer_options == []
    assert (first.status, none.status, empty.status) == ("ok", "no_blocks", "no_blocks")
    numbers = df.limit(1).select(F.transform(question_pieces(c("t")), question_number)).first()[0]
    assert numbers == [5, 6, 7]


def question(**changed):
    base = {
        "question_text": "다음 글을 읽고 고르십시오", "question_stimulus": None,
        "answer_options": [
            {"answer_text": t, "answer_vocabulary_items": [], "answer_grammar_patterns": []}
            for t in "가나다라"
        ],
        "question_type": "grammar", "question_vocabulary_items": ["말"],
        "question_grammar_patterns": [], "topic": "여행", "difficulty_level": "easy", "confidence": 0.5,
    }
    return base | changed


def as_array(spark, questions):
    df = spark.createDataFrame([(json.dumps(questions, ensure_ascii=False),)], "j string")
    return df.select(F.from_json("j", QUESTIONS).alias("questions"))


def test_reliability(spark):
    cases = [
        (question(), True),
        (question(answer_options=question()["answer_options"][:3]), False),
        (question(question_text="다섯글자임"), False),
        (question(question_text="붉게 (        )"), False),
        (question(confidence=0.0), True),
        (question(confidence=0.29), False),
        (question(confidence=0.3), True),
        (question(answer_options=[o | {"answer_text": ""} for o in question()["answer_options"]]), False),
        (question(question_text=None), False),
        (question(answer_options=None), False),
    ]
    rows = as_array(spark, [q for q, _ in cases]).select(F.explode("questions").alias("q"))
    assert [r[0] for r in rows.select(is_reliable(c("q"), 0.3)).collect()] == [ok for _, ok in cases]


def test_one_invalid_question_rejects_the_page(spark):
    good = as_array(spark, [question(), question(topic="가" * 30)])
    bad = as_array(spark, [question(), question(topic="가" * 31)])
    assert keep_valid(good).count() == 1
    assert keep_valid(bad).count() == 0
    assert keep_valid(bad, scope="row").select(F.size("questions")).first()[0] == 1


def test_model_output_shapes(spark):
    def dump(value):
        return json.dumps(value, ensure_ascii=False)

    q = question()
    deep = {"a": [1, {"b": {"questions": [q, q]}}]}
    cases = [
        (dump({"questions": [q]}), "ok", 1),
        (dump({"questions": []}), "ok", 0),
        ("text before " + dump({"questions": [q]}) + " and after", "ok", 1),
        (dump({" questions ": [{f" {k}": v for k, v in q.items()}]}), "ok", 1),
        (dump(q), "ok", 1),
        (dump(deep), "ok", 2),
        (dump({"text": "x", "list": [q, q, q]}), "ok", 3),
        (dump({"output": q}), "ok", 1),
        (dump({"output": dict(sorted(q.items(), reverse=True))}), "ok", 1),
        (dump({"a": {"b": [dict(sorted(q.items())), q]}}), "ok", 2),
        (dump({"output": {"topic": "x", "question_text": "no options"}}), "no_questions", None),
        (dump({"output": question(question_text='a "quoted" \\ \n' * 20_000)}), "ok", 1),
        (dump({"questions": [q]}).replace("다음", "\\uXY다음"), "ok", 1),
        (dump({"questions": [question(question_type="essay")]}), "invalid", None),
        (dump({"questions": [question(confidence=1.01)]}), "invalid", None),
        (dump({"questions": [question(confidence="high")]}), "invalid", None),
        (dump({"questions": [q, question(confidence=None)]}), "invalid", None),
        (dump({"questions": [question(confidence="0.9")]}), "ok", 1),
        (dump({"questions": [{k: v for k, v in q.items() if k != "confidence"}]}), "ok", 1),
        (dump({"questions": [question(question_text=5)]}), "invalid", None),
        (dump({"questions": [question(topic=12)]}), "invalid", None),
        (dump({"questions": [question(question_vocabulary_items=["a", 1])]}), "invalid", None),
        (dump({"data": [{"question_vocabulary_items": ["[말]"]} | q]}), "ok", 1),
        (dump({"data": [{"question_grammar_patterns": ["a]", '"[{']} | q]}), "ok", 1),
        (dump({"questions": [{k: v for k, v in q.items() if k != "answer_options"}]}), "invalid", None),
        (dump({"questions": [q]})[:-4], "unparsable", None),
        ("nothing", "no_json", None),
        (dump({"answer": 1}), "no_questions", None),
        (None, "no_json", None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, raw string")
    got = parse_model_output(df, "raw").orderBy("i").collect()
    assert [(r.status, None if r.questions is None else len(r.questions)) for r in got] == [
        (s, n) for _, s, n in cases
    ]


def shapes():
    """Replies of many shapes, with the status that both parsers give them."""
    q, named = question(), lambda n: question(question_stimulus=n)
    deep = {"questions": [q]}
    for _ in range(5):
        deep = {"a": deep}
    return [
        ({"data": [{"meta": {"a": 1}} | q]}, "ok", [None]),
        ({"z": {"questions": [named("z")]}, "a": {"questions": [named("a")]}}, "ok", ["z"]),
        ({"z": {"y": {"x": named("deep")}}, "a": named("flat")}, "ok", ["deep"]),
        ({"l": [{"questions": [named("in list")]}], "o": {"p": named("in object")}}, "ok", ["in object"]),
        ({"l": [1, [{"questions": [named("x"), named("y")]}]]}, "ok", ["x", "y"]),
        ({"a": {"questions": None}, "b": named("b")}, "ok", ["b"]),
        ({"questions": None}, "no_questions", None),
        ({"questions": None, "b": named("b")}, "no_questions", None),
        ({"questions": {}}, "invalid", None),
        ({"questions": "x"}, "invalid", None),
        ({"questions": [1]}, "invalid", None),
        ({"questions": [q, None]}, "invalid", None),
        ({"a": [q, "x"]}, "invalid", None),
        ({"a": [{"question_text": "x"}, q], "b": 1}, "ok", [None]),
        ({"question_text": None, "answer_options": []}, "invalid", None),
        ({"a": '{"questions": []}', "b": [[], {}]}, "no_questions", None),
        (deep, "ok", [None]),
        ({"a": deep}, "ok", [None]),
        ({"a": {"a": deep}}, "too_deep", None),
        ({"x": {"a": {"a": {"a": deep}}}, "y": named("y")}, "too_deep", None),
        ({"x": named("x"), "y": {"a": {"a": {"a": deep}}}}, "ok", ["x"]),
        ({"a:b": {"c d": {'e"f': {"questions": [named("keys")]}}}}, "ok", ["keys"]),
        ({"questions": [question(confidence=True)]}, "ok", [None]),
        ({"questions": [question(confidence="1e-1")]}, "ok", [None]),
        ({"questions": [question(confidence=-0.1)]}, "invalid", None),
        ({"questions": [question(question_stimulus=["x"])]}, "invalid", None),
        ({"questions": [question(difficulty_level="extreme")]}, "invalid", None),
    ]


def test_nested_shapes_in_the_order_of_the_text(spark):
    cases = shapes()
    df = spark.createDataFrame(
        [(i, json.dumps(v, ensure_ascii=False)) for i, (v, _, _) in enumerate(cases)], "i int, raw string"
    )
    got = parse_model_output(df, "raw").orderBy("i").collect()
    for r, (value, status, stimuli) in zip(got, cases, strict=True):
        found = None if r.questions is None else [q.question_stimulus for q in r.questions]
        assert (r.status, found) == (status, stimuli), value


def test_a_reply_is_read_as_a_column_is(spark):
    from quirework.functions.replies import read_reply

    texts = [json.dumps(v, ensure_ascii=False) for v, _, _ in shapes()]
    whole = json.dumps({"questions": [question()]}, ensure_ascii=False)
    texts += [f"Here: {whole} Done.", whole[:-4], "nothing", "", None, whole.replace("다음", "\\uXY다음"), f"[{whole}]",
              whole.replace('"questions"', '" questions　" '), whole.replace('"topic"', '"confidence"'), whole + "}",
              whole.replace("0.5", "NaN"), whole.replace("0.5", "01"), "{" + whole, whole.replace("말", "\t")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    for r in parse_model_output(df, "raw").orderBy("i").collect():
        try:
            status, found = "ok", read_reply(texts[r.i])
        except (ValueError, TypeError) as exc:
            status, found = str(exc).split(":")[0], None
        assert (r.status, r.questions is None) == (status, found is None), texts[r.i]
        for mine, native in zip(found or [], r.questions or [], strict=True):
            native = native.asDict(recursive=True)
            assert {k: mine.get(k) for k in native if k != "answer_options"} == {
                k: v for k, v in native.items() if k != "answer_options"
            }
            assert [o["answer_text"] for o in mine["answer_options"]] == [o["answer_text"] for o in native["answer_options"]]


def test_invalid_results_are_tried_again(spark):
    wrong = {"none": {"question_text": None}, "song": {"question_type": "song"}, "once": {"confidence": 2}}
    good, seen = question(), {}

    def flaky(text):
        seen[text] = seen.get(text, 0) + 1
        return [good | (wrong.get(text, {}) if text != "once" or seen[text] < 2 else {})]

    df = spark.createDataFrame([("none",), ("song",), ("once",), ("fine",)], "t string").coalesce(1)
    rows = {r.t: (r.status, r.attempts, r.error) for r in hooks.extract_pages(df, "t", flaky, 3, 0.0).collect()}
    assert rows == {
        "none": ("failed", 3, "ValueError: invalid: question_text is no text"),
        "song": ("failed", 3, "ValueError: invalid: question_type is 'song'"),
        "once": ("ok", 2, None), "fine": ("ok", 1, None),
    }


def test_results_that_fit_no_column_fail_alone(spark):
    good = question()
    odd = {
        "surrogate": [good | {"topic": "\ud800"}],
        "in an option": [good | {"answer_options": [{"answer_text": "\udfff", "answer_vocabulary_items": [], "answer_grammar_patterns": []}]}],
        "word list": [good | {"question_vocabulary_items": "말"}],
        "number list": [good | {"question_grammar_patterns": [1]}],
        "no options": [{k: v for k, v in good.items() if k != "answer_options"}],
        "tuple": (good | {"answer_options": ()},),
    }
    df = spark.createDataFrame([(k, "x" * 300_000) for k in [*odd, "fine"]], "k string, t string").coalesce(1)
    found = hooks.extract_pages(df, "k", lambda k: odd.get(k, [good]), 1, 0.0)
    rows = {r.k: (r.status, len(r.t)) for r in found.collect()}
    assert rows == {k: ("ok" if k in ("tuple", "fine") else "failed", 300_000) for k in [*odd, "fine"]}
    long = df.select(F.concat("k", "t").alias("t"))  # several hand-ons within a batch
    assert hooks.extract_pages(long, "t", lambda t: [good], 1, 0.0).filter("status = 'ok'").count() == 7


def test_explode_counts_and_keys(spark):
    pages = spark.createDataFrame([("e", 3, PAGE)], "exam_id string, page_number int, t string")
    segmented = segment_pages(pages, "t")
    rows = explode_questions(segmented, ["exam_id", "page_number"])
    sizes = segmented.select(F.sum(F.aggregate("questions", F.lit(0), lambda a, q: a + F.size(q["answer_options"])))).first()[0]
    assert explode_answers(rows).count() == sizes == 8
    import hashlib

    first = rows.filter("question_pos = 0").first()
    assert first.question_id == hashlib.sha256("e||3||B\nC||※ [5~8] A".encode()).hexdigest()


def test_extractor_retries_and_reports(spark):
    seen, answer = {}, [question()]

    def flaky(text):
        seen[text] = seen.get(text, 0) + 1
        if text == "bad" or (text == "flaky" and seen[text] < 2):
            raise ValueError("no answer")
        return answer

    df = spark.createDataFrame([("good",), ("flaky",), ("bad",)], "t string").coalesce(1)
    rows = {r.t: r for r in hooks.extract_pages(df, "t", flaky, 3, 0.0).collect()}
    assert (rows["good"].status, rows["good"].attempts, len(rows["good"].questions)) == ("ok", 1, 1)
    assert (rows["flaky"].status, rows["flaky"].attempts) == ("ok", 2)
    assert (rows["bad"].status, rows["bad"].attempts, rows["bad"].questions) == ("failed", 3, None)
    assert rows["bad"].error == "ValueError: no answer"
    assert rows["good"].questions[0].answer_options[3].answer_text == "라"


def test_parser_fills_gaps_and_reports(spark):
    def parser(value):
        if value == "boom":
            raise OSError("broken file")
        return {} if value == "none" else {1: "a", 3: "c"}

    df = spark.createDataFrame([(1, "x", "doc"), (2, "y", "boom"), (3, "z", "none")], "i int, keep string, d string")
    rows = hooks.parse_documents(df, "d", parser, parallelism=2).orderBy("i", "page_number").collect()
    assert [(r.i, r.keep, r.page_count, r.page_number, r.raw_text, r.status) for r in rows] == [
        (1, "x", 3, 1, "a", "ok"), (1, "x", 3, 2, "", "ok"), (1, "x", 3, 3, "c", "ok"),
        (2, "y", None, None, None, "failed"), (3, "z", None, None, None, "empty"),
    ]


def test_parser_results_of_other_kinds_fail_their_document_only(spark):
    answers = {
        "words": {"1": "a"}, "zero": {0: "a", 1: "b"}, "bytes": {1: b"a"}, "list": ["a"],
        "surrogate": {1: "\ud800"}, "null": {2: None}, "nothing": None, "fine": {1: "a"},
    }
    df = spark.createDataFrame([(k,) for k in answers], "d string").select("d", c("d").alias("keep")).coalesce(1)
    found = {}
    for r in hooks.parse_documents(df, "d", answers.get).collect():
        found.setdefault(r.keep, []).append((r.status, r.page_number, r.raw_text))
    for kind in ("words", "zero", "bytes", "list", "surrogate"):
        assert found[kind] == [("failed", None, None)]
    assert found["null"] == [("ok", 1, ""), ("ok", 2, "")]
    assert found["nothing"] == [("empty", None, None)] and found["fine"] == [("ok", 1, "a")]


def test_text_udf_equals_expression(spark):
    from quirework.functions.text import strip_space

    df = spark.createDataFrame([(" a　",), (None,), ("",)], "t string")
    strip = hooks.text_udf(str.strip)
    assert df.filter(~strip(c("t")).eqNullSafe(strip_space(c("t")))).count() == 0


def test_extractor_never_alters_keys_or_kills_the_job(spark):
    def bad(page):
        return {"word": [{"confidence": "high"}], "text": "ab", "none": None, "mixed": [1]}.get(page, [])

    rows = [(9007199254740993, "word"), (None, "text"), (3, "none"), (4, "mixed"), (5, "fine"), (6, None)]
    df = spark.createDataFrame([(k, float("nan"), t) for k, t in rows], "k long, x double, t string").coalesce(1)
    found = {r.k: r for r in hooks.extract_pages(df, "t", bad, 2, 0.0).collect()}
    assert set(found) == {9007199254740993, None, 3, 4, 5, 6}
    assert all(r.x != r.x for r in found.values())
    assert [found[k].status for k in (9007199254740993, None, 3, 4)] == ["failed"] * 4
    assert found[5].status == found[6].status == "ok" and found[3].attempts == 2
