import base64
import gzip
import hashlib
import zlib

import pytest

from quirework.llm import warc
from quirework.llm.queries import op2_warc_members
from quirework.llm.shared import read_bytes


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain(rows):
    first, out = {}, []
    for i, body in sorted((i, (h or "").encode()) for i, h in rows):
        kept = first.setdefault(body, i)
        out.append((i, len(body), sha(body), "response" if kept == i else "revisit", None if kept == i else kept))
    return out


def test_query_equals_plain_version(spark, small):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    got = sorted(tuple(r) for r in op2_warc_members(spark, small).collect())
    assert got == plain(rows)


ROWS = [
    (1, "u\r\nx", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "u", "x" * 3_000_000), (7, "u", "same"), (None, "u", "same"), (9, "u", "own"), (9, "u", "own"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [(i, u, h, "k", b"p") for i, u, h in ROWS], "page_id long, url string, html string, _key string, payload binary"
    )


def test_round_trip_and_forms(spark, pages):
    archives = warc.write_archives(pages, file_bytes=200)
    for r in archives.collect():
        raw = read_bytes(r.uri)
        inflate = zlib.decompressobj(31)
        inflate.decompress(raw)
        assert inflate.eof and not inflate.unused_data  # one member
    files = warc.normalise(archives)
    assert files.count() == archives.count() > 1
    got = warc.resolved(warc.read_records(files)).collect()
    assert len(got) == len(ROWS)
    for r in files.collect():
        raw = read_bytes(r.uri)
        assert gzip.decompress(raw).count(b"WARC-Record-ID:") == r.records
        assert len(raw) == r.bytes
    by_id = {r.record_id: r for r in got}
    assert by_id[warc.record_id(2)].record_type == "revisit"
    assert by_id[warc.record_id(2)].refers_to == warc.record_id(1)
    assert by_id[warc.record_id(7)].payload_bytes == 4
    assert by_id[warc.record_id(4)].refers_to == warc.record_id(3)
    assert by_id[warc.record_id(None)].record_type == "revisit"
    assert by_id[warc.record_id(5)].payload.decode() == ROWS[4][2]
    assert by_id[warc.record_id(6)].payload_bytes == 3_000_000
    assert by_id[warc.record_id(1)].target_uri == "u x"
    assert [r.record_type for r in got if r.record_id == warc.record_id(9)] == ["response"] * 2
    digests = {r.payload_digest for r in got}
    assert digests == {sha((h or "").encode()) for _, _, h in ROWS}


def test_least_bytes_and_empty_table(spark, pages):
    files = warc.normalise(warc.write_archives(pages, least_bytes=5))
    kinds = {r.record_id: r.record_type for r in warc.read_records(files, with_payload=False).collect()}
    assert set(kinds.values()) == {"response"}
    none = warc.normalise(warc.write_archives(pages.limit(0)))
    assert warc.read_records(none).count() == 0


def test_broken_archives_fail(spark, tmp_path):
    good = warc.record("response", 1, "u", b"body", None)
    for name, data in (("short", good[:-8]), ("strange", good + b"oops\r\n\r\n")):
        (tmp_path / f"{name}.warc.gz").write_bytes(gzip.compress(data))
        frame = spark.createDataFrame([(str(tmp_path / f"{name}.warc.gz"),)], "uri string")
        with pytest.raises(Exception, match="ends inside|no record"):
            warc.normalise(frame)


def test_normalising_members_is_the_same(spark, tmp_path):
    data = [warc.record("response", n, "u", b"x" * n, None) for n in range(5)]
    (tmp_path / "many.warc.gz").write_bytes(b"".join(map(gzip.compress, data)))
    frame = spark.createDataFrame([(str(tmp_path / "many.warc.gz"),)], "uri string")
    assert sorted(r.payload_bytes for r in warc.read_records(warc.normalise(frame)).collect()) == [0, 1, 2, 3, 4]


def test_query_keeps_a_page_without_an_id(spark, small, tmp_path):
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{small}/pages.parquet").limit(20)
    least = pages.agg(F.min("page_id")).first()[0]
    pages.withColumn("page_id", F.nullif("page_id", F.lit(least))).write.parquet(f"{tmp_path}/pages.parquet")
    rows = op2_warc_members(spark, str(tmp_path)).collect()
    assert len(rows) == 20 and sum(r.page_id is None for r in rows) == 1


def read_or_fail(spark, path, data):
    """Ids of the records that are read from a file of these bytes; None if that fails."""
    path.write_bytes(data)
    stream, found = warc.Stream(warc.inflated(str(path))), []
    try:
        while head := stream.until(b"\r\n\r\n"):
            names = warc.fields(head)
            for _ in stream.take(int(names["content-length"]) + 4):
                pass
            found.append(names["warc-record-id"])
    except (ValueError, KeyError, zlib.error):
        return None
    return found


def test_a_file_cut_at_any_byte_fails_or_loses_nothing(spark, tmp_path):
    data = b"".join(warc.record("response", n, "u", b"body %d" % n, None) for n in range(3))
    whole = gzip.compress(data)
    want = [warc.record_id(n) for n in range(3)]
    assert read_or_fail(spark, tmp_path / "x.gz", whole) == want
    for end in range(1, len(whole)):
        assert read_or_fail(spark, tmp_path / "x.gz", whole[:end]) is None, end
    # The stream stops behind a whole record, flushed: all its records are there, more were.
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    cut = squeeze.compress(warc.record("response", 1, "u", b"body", None)) + squeeze.flush(zlib.Z_FULL_FLUSH)
    (tmp_path / "cut.warc.gz").write_bytes(cut)
    frame = spark.createDataFrame([(str(tmp_path / "cut.warc.gz"),)], "uri string")
    with pytest.raises(Exception, match="gzip stream is cut"):
        warc.normalise(frame)


def test_lost_members_and_index_lines_fail(spark, pages, tmp_path):
    members = [gzip.compress(warc.record("response", n, "u", b"x", None)) for n in range(3)]
    path = tmp_path / "many.warc.gz"
    path.write_bytes(b"".join(members[:2]))
    frame = spark.createDataFrame([(str(path), 3)], "uri string, records long")
    with pytest.raises(Exception, match="2 records, not 3"):
        warc.normalise(frame)
    files = warc.normalise(spark.createDataFrame([(str(path),)], "uri string"))
    index = files.first().index_uri.removeprefix("file:")
    with open(index, "rb") as f:
        lines = f.read().splitlines(keepends=True)
    with open(index, "wb") as f:
        f.writelines(lines[:1])
    with pytest.raises(Exception, match="1 entries, not 2"):
        warc.read_records(files).collect()


def test_a_head_without_end_fails(spark, tmp_path):
    (tmp_path / "long.warc.gz").write_bytes(gzip.compress(b"WARC/1.1\r\n" + b"x" * (3 << 20)))
    frame = spark.createDataFrame([(str(tmp_path / "long.warc.gz"),)], "uri string")
    with pytest.raises(Exception, match="no end of its head"):
        warc.normalise(frame)
