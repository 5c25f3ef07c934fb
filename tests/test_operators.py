"""Relational operators: results on small inputs, skewed inputs, and plans."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions.keys import hash_bucket, hash_key
from quirework.operators import aggregates as A
from quirework.operators import joins as J
from quirework.operators import projections as P
from quirework.operators import windows as W

c = F.col


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    run = df.select("*")
    run.collect()
    return run._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one key; order column has no ties."""
    draw = random.Random(1)
    rows = [
        (0 if i % 3 == 0 else draw.choice([None, *range(1, 200)]), i, draw.choice([None, None, None, i]))
        for i in range(30_000)
    ]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "k int, i int, v int").repartition(8).persist()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_chunked_row_numbers_equal_plain(hot):
    chunk = {"_b": F.floor(c("i") / 1000)}
    same(
        W.number_rows(hot, ["k"], [c("i")], "n", chunk).select("k", "i", "n"),
        W.number_rows(hot, ["k"], [c("i")], "n").select("k", "i", "n"),
    )


def test_chunked_carry_forward_equals_plain(hot):
    chunk = {"_b": F.floor(c("i") / 777)}
    same(
        W.carry_forward(hot, "v", ["k"], ["i"], "last", -1, chunk).select("k", "i", "last"),
        W.carry_forward(hot, "v", ["k"], ["i"], "last", -1).select("k", "i", "last"),
    )


def test_a_tree_of_chunks_equals_plain(hot):
    """As many chunks as rows, nearly."""
    chunk = {"_b": F.floor(c("i") / 2)}
    same(
        W.number_rows(hot, ["k"], [c("i")], "n", chunk, tree=True).select("k", "i", "n"),
        W.number_rows(hot, ["k"], [c("i")], "n").select("k", "i", "n"),
    )
    same(
        W.carry_forward(hot, "v", ["k"], ["i"], "last", -1, chunk, tree=True).select("k", "i", "last"),
        W.carry_forward(hot, "v", ["k"], ["i"], "last", -1).select("k", "i", "last"),
    )


def test_chunks_of_one_group_are_dealt_evenly(spark, tmp_path):
    """No task combines more than twice the median of the chunks."""
    from pathlib import Path

    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir()) if shared.exists() else set()
    try:
        rows = spark.range(400_000).select(F.lit("one").alias("k"), "id")
        out = W.number_rows(rows, ["k"], [c("id")], "n", {"_b": c("id")}, tree=True)
        assert out.filter("n != id + 1").count() == 0 and out.count() == 400_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (folder,) = set(shared.iterdir()) - before
    sizes = sorted(r["count"] for r in spark.read.parquet(f"{folder}/ranges").groupBy("_range").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_null_groups_and_chunks_are_kept(spark):
    rows = [(g, s, o, v) for g in (None, "a", "") for s, o, v in
            ((None, 0, None), (None, 1, "x"), ("", 2, None), ("p", 3, None), ("q", 4, "y"), ("q", 5, None))]
    df = spark.createDataFrame(rows, "g string, s string, o int, v string").repartition(3)
    same(W.number_rows(df, ["g"], [c("o")], "n", {"b": c("s")}), W.number_rows(df, ["g"], [c("o")], "n"))
    same(W.number_rows(df, ["g"], [c("o")], "n", {"b": c("s")}, tree=True), W.number_rows(df, ["g"], [c("o")], "n"))
    same(W.carry_forward(df, "v", ["g"], ["o"], "l", "-", {"b": c("s")}, tree=True),
         W.carry_forward(df, "v", ["g"], ["o"], "l", "-"))
    same(W.carry_forward(df, "v", ["g"], ["o"], "l", "-", {"b": c("s")}),
         W.carry_forward(df, "v", ["g"], ["o"], "l", "-"))


def test_first_rows_are_cut_before_the_shuffle(hot):
    df = W.first_rows(hot, ["k"], [c("i")], 4)
    text = plan(df)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert df.filter("k = 0").count() == 4


def test_keep_first_takes_the_lowest(hot):
    kept = A.keep_first(hot, ["k"], ["i"])
    same(kept.select("k", "i"), hot.groupBy("k").agg(F.min("i").alias("i")))


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 2, "x"), ("a", 2, "x"), ("b", 1, None)], "k string, n int, t string")
    assert {tuple(r) for r in A.one_per_key(df, "k").collect()} == {("a", 2, "x"), ("b", 1, None)}


def test_first_non_null_skips_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None)], "k string, p int, v string"
    )
    got = A.first_non_null(df, ["k"], "v", "p", c("k")).collect()
    assert {tuple(r) for r in got} == {("a", "x"), ("b", "b")}


def test_pivot_slots_equals_pivot(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, None), (1, 5, "z"), (2, 4, "d")], "q int, s int, t string"
    )
    want = df.groupBy("q").pivot("s", [1, 2, 3, 4]).agg(F.first("t"))
    same(A.pivot_slots(df, ["q"], "s", [1, 2, 3, 4], "t", "answer_"), want)


def test_ordered_collect_has_one_shape(hot):
    chunk = {"_b": F.floor(c("i") / 1000)}
    rows = A.ordered_collect(hot, ["k"], [c("i")], "i", chunk=chunk)
    assert rows.columns == ["k", "position", "i"] and rows.count() == 30_000
    long = rows.filter("k = 0").orderBy("position").collect()
    assert [r.position for r in long] == list(range(1, 10_001))
    assert [r.i for r in long] == sorted(r.i for r in long)


def test_category_maps_take_any_category(spark):
    rows = [("a", "easy"), ("a", "easy"), ("a", "very hard"), ("b", None), (None, "hard")]
    df = spark.createDataFrame(rows, "k string, d string")
    got = {r.k: r.m for r in A.category_maps(df, ["k"], "d", "m").collect()}
    assert got == {"a": {"easy": 2, "very hard": 1}, None: {"hard": 1}}


def test_term_coverage_counts_empty_groups(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (1, ["a"]), (2, [])], "k int, t array<string>")
    got = {tuple(r) for r in A.term_coverage(df, ["k"], c("t")).collect()}
    assert got == {(1, 2, 4), (2, 0, 0)}


def test_fill_gaps(spark):
    df = spark.createDataFrame([("f", 1, "a"), ("f", 3, "c"), ("g", 2500, "z")], "k string, n int, t string")
    dense = J.fill_gaps(df, ["k"], "n", "t", "")
    rows = {(r.k, r.n): r.t for r in dense.collect()}
    assert [rows["f", n] for n in (1, 2, 3)] == ["a", "", "c"]
    assert len(rows) == 2503 and rows["g", 2500] == "z" and rows["g", 1024] == ""
    assert {r[0] for r in dense.filter("k = 'f'").select("page_count").collect()} == {3}
    assert J.fill_gaps(df.limit(0), ["k"], "n", "t", "").count() == 0
    odd = df.unionByName(spark.createDataFrame([("f", 0, "x"), ("f", -3, "y"), ("g", 7, None), ("h", 0, "z"), ("i", 3073, "t")], df.schema))
    for frame in (df, odd):
        same(J.fill_gaps(frame, ["k"], "n", "t", "-"), J.fill_gaps(frame, ["k"], "n", "t", "-", spread=True))
    text = plan(J.fill_gaps(df, ["k"], "n", "t", "-"))
    assert "Join" not in text and text.count("Exchange") == 1


def test_nothing_compressible_is_broadcast(spark, tmp_path):
    """Small in files, 60 MB in memory: measured, not estimated."""
    path = str(tmp_path / "wide")
    spark.range(300_000).selectExpr("id % 1000 AS k", "repeat('x', 200) AS t", "id").coalesce(1).write.parquet(path)
    wide, keys = spark.read.parquet(path), spark.range(2_000_000).selectExpr("id % 1000 AS k", "id AS n")
    joined = J.equi_join(keys.limit(5_000_000), wide, "k").groupBy("k").agg(F.max("t"))
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_left_join_with_many_matches(hot, spark):
    keys = spark.range(-5, 300).select(c("id").cast("int").alias("k"))
    same(J.left_join(keys, hot, "k", many_matches=True), J.left_join(keys, hot, "k"))
    assert J.hot_keys(hot, ["k"]) == ['{"k":0}'] and J.hot_keys(hot.limit(0), ["k"]) == []
    joined = J.left_join(keys.union(keys), hot, "k", many_matches=True)
    same(joined, J.left_join(keys.union(keys), hot, "k"))
    two = hot.withColumn("s", F.when(c("k") == 0, "a'b").otherwise("x"))
    left = two.select("k", "s").distinct().unionByName(spark.createDataFrame([(0, None), (None, "x"), (7, "none")], "k int, s string"))
    same(J.left_join(left, two, ["k", "s"], many_matches=True, salts=4), J.left_join(left, two, ["k", "s"]))
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1  # both sides once


def test_hot_key_of_a_shuffled_join_is_split(spark, hot):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = hot.fillna(0, ["k"])
        keys = spark.range(0, 200).select(c("id").cast("int").alias("k"), F.lit("x").alias("x"))
        joined = J.equi_join(hot, keys, "k")
        assert len(joined.collect()) == 30_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_keep_existing_never_multiplies(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    twice = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert [r.k for r in J.keep_existing(df, twice, "k").collect()] == [1]


def test_conform_and_rejects(spark):
    df = spark.createDataFrame([("1", "2025-01-02", 0), ("x", None, 0)], "a string, d string, z int")
    schema = T.StructType.fromDDL("d date, a int")
    loose = P.conform(df, schema, strict=False)
    assert loose.columns == ["d", "a"] and [r.a for r in loose.collect()] == [1, None]
    assert P.cast_rejects(df, schema).first().asDict() == {"d": 0, "a": 1}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        P.conform(df, schema).collect()


def test_compute_once_is_not_repeated(spark):
    df = spark.createDataFrame([("a b",), ("",)], "t string")
    once = P.compute_once(df, "n", F.regexp_count("t", F.lit("[a-z]")))
    assert plan(once.filter("n > 1")).count("regexp_count") + plan(once.filter("n > 1")).count("REGEXP_COUNT") <= 1
    assert [r.n for r in once.filter("n > 1").collect()] == [2]


def test_stamps(spark):
    one = spark.range(1)
    fixed = P.stamp_time(P.stamp_date(one, "d", "2025-01-02"), "t", "now").first()
    assert str(fixed.d) == "2025-01-02" and fixed.t == "now"
    assert P.stamp_time(one, "t").first().t.endswith("+00:00")


def test_keys_do_not_depend_on_partitioning(spark, hot):
    keyed = lambda df: df.select("i", hash_key("k", "i", "v").alias("h"), hash_bucket("i").alias("b"))
    same(keyed(hot), keyed(hot.repartition(3, "v")))
    import hashlib

    key = spark.range(1).select(hash_key(F.lit("a"), F.lit(None).cast("string"), F.lit(7))).first()[0]
    assert key == hashlib.sha256(b"a||7").hexdigest()


def test_no_python_and_no_cross_join_in_native_queries(spark, small):
    from quirework.queries import all_queries

    hooks = {"extractor_hook", "extractor_hook_validated", "extracted_replies", "file_audit", "parser_hook", "vectorized_text",
             "file_listing", "listed_files", "parsed_files"}
    writes = {"partition_scan", "written_counts", "refreshed_partition", "metadata_round_trip", "broken_metadata", "exported_splits",
              "metadata_paths", "overwritten_input", "refreshed_stats", "tree_numbers", "tree_carry_forward"}
    for name, (run, _) in all_queries().items():
        if name in hooks or name in writes:
            continue
        text = plan(run(spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "InPandas" not in text and "InArrow" not in text, name


def test_library_never_pulls_rows_to_the_driver():
    import pathlib
    import re

    root = pathlib.Path(__file__).parent.parent / "quirework"
    for path in root.rglob("*.py"):
        if path.parent.name == "llm":  # has bounds of its own, and a test of them
            continue
        text = path.read_text(encoding="utf-8")
        assert not re.search(r"\.(collect|toPandas|toLocalIterator|localCheckpoint)\(", text), path
