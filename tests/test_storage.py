"""Scans and sinks, on files of their own."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.session import shared_folder
from quirework.sources import files as Files
from quirework.sources import metadata as M
from quirework.sources import tables as S

c = F.col


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.read_table(spark, str(tmp_path / "none"))


def test_schema_is_applied(spark, tmp_path):
    S.write_table(spark.range(3), str(tmp_path / "t"))
    read = S.read_table(spark, str(tmp_path / "t"), T.StructType.fromDDL("id bigint, x string"))
    assert read.filter("x is null").count() == 3


def test_a_query_can_overwrite_its_input(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_table(spark.range(5), path)
    assert S.write_table(S.read_table(spark, path).filter("id > 1"), path) == 3
    cached = S.read_table(spark, path).filter("id > 2").cache()
    assert S.write_table(cached, path) == 2
    cached.unpersist()
    assert sorted(r.id for r in S.read_table(spark, path).collect()) == [3, 4]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("sources", ["parquet", ""])
def test_folders_around_an_input_are_not_overwritten(spark, tmp_path, sources):
    """Whether the scan is of the first or the second kind, cached or not."""
    path = str(tmp_path / "t")
    S.write_table(spark.range(3), path)
    spark.conf.set("spark.sql.sources.useV1SourceList", sources)
    try:
        plain, cached = S.read_table(spark, path).filter("id > 0"), S.read_table(spark, path).cache()
        for df in (plain, cached):
            for target in (str(tmp_path), f"{path}/part"):
                with pytest.raises(ValueError, match="is read by this query"):
                    S.write_table(df, target)
        cached.unpersist()
        assert S.write_table(plain, path) == 2
    finally:
        spark.conf.unset("spark.sql.sources.useV1SourceList")
    assert S.read_table(spark, path).count() == 2
    assert S.write_table(S.read_table(spark, path), path + "2") == 2


def test_a_lost_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_table(spark.range(10), path, mode="overwrite")
    broken = spark.range(1000).repartition(8).withColumn(
        "id", F.when(c("id") < 900, c("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint"))
    )
    with pytest.raises(Exception, match="lost"):
        S.write_table(broken, path)
    assert S.read_table(spark, path).count() == 10
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("renames", [0, 1, 2])
def test_a_lost_driver_is_made_up_for(spark, tmp_path, renames):
    """The manifest was there; the driver was lost before, between or after the renames."""
    path = str(tmp_path / "t")
    S.write_table(spark.range(10), path)
    staged = tmp_path / ".t.x.new"
    spark.range(4).write.parquet(str(staged))
    table = S._Folder(spark, path)
    manifest = table.beside("replacing")
    out = manifest.files.create(manifest.path, False)
    out.writeUTF(str(S._Folder(spark, str(staged))))
    out.close()
    if renames > 0:
        (tmp_path / "t").rename(tmp_path / ".t.retired")
    if renames > 1:
        staged.rename(tmp_path / "t")
    if renames == 1:
        assert S.read_table(spark, path).count() == 4
    else:
        assert S.write_table(spark.range(6), str(tmp_path / "t")) == 6
        assert S.read_table(spark, path).count() == 6
    assert [f.name for f in tmp_path.iterdir() if not f.name.endswith(".crc")] == ["t"]


def test_listing_is_done_by_tasks(spark, tmp_path):
    want = {}
    for i in range(300):
        folder = tmp_path / f"f{i % 150}" / "a b+c%20" / f"g={i % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        for j in range(4):
            (folder / f"{i} {j}.pdf").write_bytes(b"x" * (i * 7 + j))
            want[str(folder / f"{i} {j}.pdf")] = i * 7 + j
        (folder / f".{i}.pdf").write_bytes(b"hidden")
        (folder / f"{i}.txt").write_bytes(b"other")
    got = Files.list_tree(spark, str(tmp_path), "*.pdf")
    assert {r.path: r.size for r in got.collect()} == want and got.count() == len(want)
    assert {r.path: r.size for r in Files.list_tree(spark, f"file://{tmp_path}", "*.pdf").collect()} == want
    spark_own = Files.read_contents(spark, str(tmp_path), "*.pdf").select(F.regexp_replace("path", "^file:", "").alias("path"), "size")
    # Spark's scan passes over files of no bytes.
    assert {r.path: r.size for r in spark_own.collect()} == {p: n for p, n in want.items() if n}
    assert len(got.inputFiles()) > 4  # levels were listed by more than one task
    with pytest.raises(Exception, match="[Nn]o such file|does not exist"):
        Files.list_tree(spark, str(tmp_path / "none")).collect()
    (tmp_path / "empty").mkdir()
    assert Files.list_tree(spark, str(tmp_path / "empty")).count() == 0


def test_files_are_dealt_by_size(spark, tmp_path):
    rows = [(f"s{i}", 100) for i in range(400)] + [(f"l{i}", 5_000) for i in range(5)] + [("null", None)]
    df = spark.createDataFrame(rows, "path string, size bigint")
    dealt = Files.dealt_by_size(df, "size", 2_000).withColumn("task", F.spark_partition_id())
    by_task = {}
    for r in dealt.collect():
        by_task.setdefault(r.task, []).append(r.size or 0)
    assert sum(map(len, by_task.values())) == len(rows)
    assert max(sum(s) for s in by_task.values()) <= 5_000
    assert sum(s == [5_000] for s in by_task.values()) == 5
    assert Files.dealt_by_size(df.limit(0)).count() == 0


def test_written_files_are_whole(spark, tmp_path):
    df = spark.createDataFrame([("a/b c.txt", "é", 1), ("d.txt", None, 2)], "name string, content string, size int")
    rows = Files.write_files(df, str(tmp_path / "out"), "name", "content").collect()
    assert {(r.path, r.size) for r in rows} == {(f"{tmp_path}/out/a/b c.txt", 2), (f"{tmp_path}/out/d.txt", 0)}
    assert (tmp_path / "out/a/b c.txt").read_text(encoding="utf-8") == "é"
    assert sorted(f.name for f in (tmp_path / "out").rglob("*") if f.is_file()) == ["b c.txt", "d.txt"]


def test_counts_and_check(spark, tmp_path):
    assert S.write_tables({"a": spark.range(5), "b": spark.range(0)}, str(tmp_path)) == {"a": 5, "b": 0}
    assert S.write_checked(spark.range(7), str(tmp_path / "a")) == 7


def test_refresh_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).withColumn("p", c("id") % 4)
    S.write_table(df, path, partition_by=["p"])
    before = sorted(f.name for f in (tmp_path / "t" / "p=1").iterdir())
    assert S.refresh_partition(df.filter("p = 2").limit(3), path, ["p"]) == 3
    assert sorted(f.name for f in (tmp_path / "t" / "p=1").iterdir()) == before
    got = {r.p: r["count"] for r in S.read_table(spark, path).groupBy("p").count().collect()}
    assert got == {0: 25, 1: 25, 2: 3, 3: 25}
    plan = S.read_partition(spark, path, "p", 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_metadata_folders(spark, tmp_path):
    folders = {
        "102nd-papers": [
            {"filename": "a b.pdf", "file_type": "Test Paper", "size_kb": 1.5, "label": "한국어"},
            {"label": "no name"},
        ],
        "odd +name%20": [{"filename": "x.pdf"}],
        "no-metadata": None,
    }
    for name, records in folders.items():
        (tmp_path / name).mkdir()
        if records is not None:
            (tmp_path / name / "metadata.json").write_text(
                json.dumps(records, ensure_ascii=False, indent=1), encoding="utf-8"
            )
    rows = M.read_metadata(spark, str(tmp_path)).collect()
    got = {(r.exam_folder, r.filename, r.file_type, r.label, r.size_kb, r.source_pdf_path) for r in rows}
    assert got == {
        ("102nd-papers", "a b.pdf", "Test Paper", "한국어", 1.5, f"{tmp_path}/102nd-papers/a b.pdf"),
        ("102nd-papers", "", "", "no name", None, f"{tmp_path}/102nd-papers/"),
        ("odd +name%20", "x.pdf", "", None, None, f"{tmp_path}/odd +name%20/x.pdf"),
    }
    (tmp_path / "odd +name%20" / "x.pdf").write_bytes(b"0" * 2600)
    files = M.list_files(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in files] == [(f"{tmp_path}/odd +name%20/x.pdf", 2.5)]


def test_broken_metadata_stops_or_is_reported(spark, tmp_path):
    texts = {"good": '[{"filename": "a.pdf"}, {"filename": "b.pdf"}]', "none": "[]", "cut": '[{"filename": "c.pdf"}, {',
             "object": '{"filename": "d.pdf"}', "numbers": "[1, 2]", "blank": "\n"}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(text, encoding="utf-8")
    broken = M.broken_metadata(spark, str(tmp_path)).collect()
    assert {r.exam_folder for r in broken} == {"cut", "object", "numbers", "blank"}
    with pytest.raises(Exception, match="no JSON metadata"):
        M.read_metadata(spark, str(tmp_path)).collect()
    rows = M.read_metadata(spark, str(tmp_path), strict=False).collect()
    assert [(r.exam_folder, r.record, r.filename) for r in rows] == [("good", 0, "a.pdf"), ("good", 1, "b.pdf")]


def test_metadata_sink_keeps_text_readable(spark, tmp_path):
    df = spark.createDataFrame([("한 글/x", "가나"), ("b", "é\n")], "exam_folder string, filename string")
    assert M.write_metadata(df, str(tmp_path / "m")) == 2
    text = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "m").rglob("*.json"))
    assert "가나" in text and "é\\n" in text
    back = M.read_metadata(spark, str(tmp_path / "m"), pattern="*/*.json", json_array=False)
    assert {(r.exam_folder, r.filename) for r in back.collect()} == {("한 글/x", "가나"), ("b", "é\n")}


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        df = spark.range(60_000).select(F.when(c("id") % 3 == 0, c("id") % 50).otherwise(-1).alias("p"), "id")
        S.write_table(df.repartition(16), str(tmp_path / "t"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=-1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(root + "/")


def test_scratch_can_be_removed(spark, monkeypatch):
    from pathlib import Path

    from quirework import session

    monkeypatch.setattr(session, "_GIVEN", [])
    rows = session.written(spark.range(3), "rows")
    assert rows.count() == 3 and session.shared_folder(spark)
    (folder,) = {Path(f.removeprefix("file:")).parents[1] for f in rows.inputFiles()}
    assert folder.exists() and session.remove_scratch(spark) == 1 and not folder.exists()
    assert session.remove_scratch(spark) == 0
