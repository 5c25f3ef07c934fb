"""What keeps shuffles, time and memory in proportion to the input."""

import gc
import weakref

import pyarrow as pa
from pyspark.sql import types as T

from quirework.functions.keys import hash_key
from quirework.operators import hooks
from quirework.plans import star, stats
from quirework.queries import star as star_queries


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def below_shuffles(df) -> list[str]:
    """The plan below each shuffle, from the last one of the query to those of its inputs."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [text[at:] for at in range(len(text)) if text.startswith("Exchange ", at)]


def test_links_by_text_equal_links_by_key(spark):
    answers = spark.createDataFrame(
        [("1", "a"), ("1", "a"), ("1", ""), ("1", None), ("1", None), ("2", "a"), (None, "a"), (None, None), ("", "a"), ("", None), ("9", "x")],
        "question_id string, raw_answer_text string",
    )
    questions = spark.createDataFrame(
        [("1", "e"), ("1", "e"), ("1", "f"), ("2", None), (None, "e"), ("", "g"), ("3", "h")], "question_id string, exam_id string"
    )
    keyed = answers.withColumn("answer_id", hash_key("question_id", "raw_answer_text"))
    want = rows(star.fact_qa(keyed, questions))
    assert rows(star.fact_qa(answers, questions, "raw_answer_text")) == want and len(want) == 9


def test_order_keys_are_hashed_after_the_shuffles(spark, small):
    assert "sha2" not in below_shuffles(star_queries.order_links(spark, small))[0]
    assert "sha2" not in below_shuffles(star_queries.answer_order(spark, small))[-1]


def test_statistics_take_totals_of_answers(spark):
    questions = spark.createDataFrame(
        [("1", "e", "easy", None, "a b"), ("2", "e", "easy", "grammar", None), ("2", "e", None, "grammar", "c"), ("3", None, "hard", "x", "d e f"), (None, "g", None, None, "")],
        "question_id string, exam_id string, difficulty_level string, question_type string, raw_question_text string",
    )
    answers = spark.createDataFrame(
        [("1", "p q"), ("1", None), ("2", "r"), ("2", "r"), (None, "s"), ("9", "t")], "question_id string, raw_answer_text string"
    )
    parts = stats.stats_parts(questions, answers)
    assert rows(stats.stats_parts(questions, stats.answer_totals(answers))) == rows(parts)
    assert set(rows(parts)) == {
        ("e", "question", None, 3, 2, 3), ("e", "answer", None, 6, 5, 6), ("e", "difficulty_level", "easy", 2, 0, 0),
        ("e", "difficulty_level", None, 1, 0, 0), ("e", "question_type", "grammar", 2, 0, 0), ("e", "question_type", None, 1, 0, 0),
        (None, "question", None, 1, 1, 3), (None, "answer", None, 0, 0, 0), (None, "difficulty_level", "hard", 1, 0, 0),
        (None, "question_type", "x", 1, 0, 0), ("g", "question", None, 1, 1, 0), ("g", "answer", None, 0, 0, 0),
        ("g", "difficulty_level", None, 1, 0, 0), ("g", "question_type", None, 1, 0, 0),
    }
    # Questions are added up before they are unfolded, and parts are shuffled once.
    below = below_shuffles(parts)[0]
    assert "HashAggregate(keys=[exam_id" in below[below.index("Generate") :]
    assert len(below_shuffles(stats.stats_of(spark.createDataFrame(parts.collect(), parts.schema)))) == 1


class Held:
    """Stands in for a table of one batch, so that what a task hands on can be looked at."""

    def __init__(self, *texts):
        self.batch = pa.record_batch({"i": pa.array(range(len(texts)), pa.int32()), "t": pa.array(texts)})
        self.schema = T.StructType().add("i", T.IntegerType()).add("t", T.StringType())

    def mapInArrow(self, run, schema):  # noqa: N802
        return list(run(iter([self.batch])))


def test_pages_are_handed_on_before_they_fill_the_memory(spark):
    long = lambda text: {int(n): "x" * (int(n) % 3) for n in text.split()} if text else None
    found = hooks.parse_documents(Held("100000", "", "2 3", "30000"), "t", long)
    assert max(b.num_rows for b in found) <= 5_001 and max(b.nbytes for b in found) < 1_000_000
    rows = pa.Table.from_batches(found).to_pylist()
    assert [r["page_number"] for r in rows] == [*range(1, 100_001), None, 1, 2, 3, *range(1, 30_001)]
    assert [r["i"] for r in rows] == [0] * 100_000 + [1, 2, 2, 2] + [3] * 30_000


def test_extractor_runs_without_the_collector_and_leaves_no_cycles(spark):
    class Cycle:
        def __init__(self):
            self.me = self

    seen, left = [], []

    def one(text):
        seen.append(gc.isenabled())
        left.append(weakref.ref(Cycle()))
        return []

    found = hooks.extract_pages(Held(*["x" * 1000] * 1500), "t", one)
    assert [b.num_rows for b in found] == [455, 455, 455, 135]
    assert not any(seen) and gc.isenabled() and all(ref() is None for ref in left)
