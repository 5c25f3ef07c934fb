import collections
import heapq
import zlib

import numpy as np
import pytest

from quirework.llm import shards
from quirework.llm.queries import op11_lpt_heap


def loads_and_groups(rows, texts):
    """Bytes of each shard, and the shards of each text."""
    loads, where = collections.Counter(), collections.defaultdict(set)
    for r in rows:
        loads[r.shard] += len((texts[r.doc_id] or "").encode()) + 8
        where[texts[r.doc_id] or ""].add(r.shard)
    return loads, where


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    texts = {d.doc_id: d.text for d in docs}
    got = op11_lpt_heap(spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert (r.law, r.grown_shard) == ("bytes", None)
    loads, where = loads_and_groups(got, texts)
    assert all(len(s) == 1 for s in where.values()) and set(loads) == set(range(24))
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # No shard is over the mean by more than its last group: the rule of the schedule.
    groups = collections.Counter()
    for t in texts.values():
        groups[t or ""] += len((t or "").encode()) + 8
    assert max(loads.values()) <= max(max(groups.values()), sum(loads.values()) / 24 + max(groups.values()))
    assert sorted(map(tuple, op11_lpt_heap(spark, small).collect())) == sorted(map(tuple, got))


def plain_schedule(sizes, n):
    heap = [(0, i) for i in range(n)]
    for s in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, i))
    return sorted(load for load, _ in heap)


def test_few_groups_are_one_plain_schedule(spark, docs_of):
    """With a part for each group the two steps give the loads of the plain heap."""
    rng = np.random.default_rng(3)
    texts = ["x" * int(n) + str(i) for i, n in enumerate(rng.integers(1, 400, 60))]
    docs = docs_of([(i, t, None, None) for i, t in enumerate(texts)])
    rows = shards.sharded(docs, shards=7, hex_digits=6).collect()
    loads, _ = loads_and_groups(rows, dict(enumerate(texts)))
    assert sorted(loads.values()) == plain_schedule([len(t) + 8 for t in texts], 7)


@pytest.mark.parametrize("hex_digits", [2, 3])
def test_many_groups_are_near_equal(spark, docs_of, hex_digits):
    rng = np.random.default_rng(4)
    texts = ["y" * int(n) + str(i) for i, n in enumerate(rng.integers(1, 50, 3000))] + ["copy"] * 400
    docs = docs_of([(i, t, None, None) for i, t in enumerate(texts)])
    rows = shards.sharded(docs, shards=5, hex_digits=hex_digits).collect()
    loads, where = loads_and_groups(rows, dict(enumerate(texts)))
    assert max(loads.values()) < 1.02 * min(loads.values()) and len(where["copy"]) == 1


def test_odd_rows(spark, docs_of):
    """Nulls, repeated rows and ids, a long text, clashing names; rows come back as they are."""
    rows = [(None, None, None, None), (None, "a", None, None), (None, "a", None, None), (1, "", None, "s"),
            (2, None, None, "s"), (3, "long " * 300_000, None, "s"), (4, "a", None, "s"), (4, "b", None, "t")]
    docs = docs_of(rows).selectExpr("*", "7 as slot", "1 as tag", "2 as digest")
    out = shards.sharded(docs, shards=3)
    assert sorted(out.columns) == sorted(docs.columns + ["shard"])
    got = out.collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(str(r[:2]) for r in rows)
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
    assert len({r.shard for r in got if r.text == "a"}) == 1 and len({r.shard for r in got if not r.text}) == 1
    assert shards.sharded(docs_of([]).limit(0)).count() == 0


def test_written_shards(spark, docs_of):
    docs = docs_of([(i, f"text {i % 40}", "x", "y") for i in range(200)])
    back = spark.read.parquet(shards.write_shards(docs, shards=4))
    assert sorted(r.doc_id for r in back.collect()) == list(range(200))
    assert {r.shard for r in back.collect()} == set(range(4))
