import collections
import random

import pytest

from quirework.llm import mixing
from quirework.llm.queries import op10_capped_mix
from quirework.llm.shared import written

ROWS = (
    [(i, "w " * (i % 7 + 1), "en", "hot") for i in range(60)]
    + [(100 + i, "only few words here", "en", "small") for i in range(3)]
    + [(200, None, None, None), (201, "a\x0bb\x0cc d", None, None), (None, "x y", "en", "hot")]
    + [(300, "", "en", "void"), (301, " \n", "en", "void"), (5, "w w w w w w", "en", "hot")]
)


def filled(sizes, weights, times):
    """Clamp, share the excess, again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > times * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: times * sizes[s] for s in over}


@pytest.mark.parametrize("digits", [1, 3])
def test_mix_equals_water_filling(docs_of, digits):
    got = mixing.mix(docs_of(ROWS), hex_digits=digits).collect()
    assert len(got) == len(ROWS)
    sizes, by_source = collections.Counter(), collections.defaultdict(list)
    for i, t, _, s in ROWS:
        n = len((t or "").encode().split())
        sizes[s] += n
        by_source[s].append((i, n))
    want = filled(sizes, (1, 2, 3), 3)
    taken, target = collections.Counter(), {}
    ids = {i: s for i, t, _, s in ROWS}
    for r in got:
        s = ids[r.id]
        taken[s] += r.taken
        target[s] = r.target
        assert r.source_size == sizes[s] and r.taken <= 3 * r.size
        assert r.taken == r.copies * r.size + r.cut and r.cut < max(r.size, 1)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 0.5
    again = mixing.mix(docs_of(ROWS[::-1]).repartition(5), hex_digits=digits).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows_hold_what_is_taken(docs_of):
    docs = docs_of(ROWS)
    rows = mixing.mixed(docs).collect()
    assert rows[0].__fields__ == docs.columns
    words = collections.Counter()
    for r in rows:
        words[r.source] += len((r.text or "").encode().split())
        assert (r.n_chars or 0) == len(r.text or "")
    taken = collections.Counter()
    for r in mixing.mix(docs, carry=("source",)).collect():
        taken[r.carried.source] += r.taken
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_empty_and_wordless_tables(docs_of):
    assert mixing.mix(docs_of(ROWS).limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs_of([(1, None, None, None), (2, " ", "en", "a")])).collect()] == [0, 0]
    assert mixing.mixed(docs_of([(1, None, None, None)])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_many_sources_against_repeated_clamping(spark, seed):
    """From sources of about one size to a few that hold nearly all."""
    rng = random.Random(seed)
    sizes = {f"s{n:02}": int(10 ** rng.uniform(2, 2 + seed / 2)) for n in range(4 + 5 * seed)}
    frame = spark.createDataFrame(list(sizes.items()), "key string, size long")
    got = {r.key: r.target for r in mixing.water_fill(frame, (1, 2, 3), 3).collect()}
    want = filled(sizes, (1, 2, 3), 3)
    assert got == {k: pytest.approx(want[k]) for k in sizes}
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_sources_in_many_ranges(spark, monkeypatch):
    """More sources than ranges, ties of cap over weight among them: each range is a task's."""
    rng = random.Random(3)
    sizes = {f"h{n:04}": rng.choice((0, 60, 60, int(10 ** rng.uniform(0, 6)))) for n in range(1500)}
    frame = spark.createDataFrame(list(sizes.items()), "key string, size long").repartition(7)
    met = []

    def seen(rows, name):
        out = written(rows, name)
        met.append(out.groupBy("range").count().collect())
        return out

    monkeypatch.setattr(mixing, "written", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.key: r.target for r in mixing.water_fill(frame, (1, 2, 3), 3).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = filled(sizes, (1, 2, 3), 3)
    assert got == {k: pytest.approx(want[k]) for k in sizes}
    assert len(met) == 2 and all(len(m) == 8 and max(r["count"] for r in m) < 600 for m in met)


def test_query_meets_the_contract(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op10_capped_mix(spark, small).collect()
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == len(docs[r.doc_id].text.encode().split()) and 0 <= r.taken <= 3 * r.size
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
    want = filled(sizes, (1, 2, 3), 3)
    assert target == {s: pytest.approx(want[s]) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes) and len(rows) == len(docs)
