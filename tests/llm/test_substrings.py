import hashlib
import random

import pyarrow as pa
import pytest

from quirework.llm import substrings
from quirework.llm.queries import op9_cover_anchors
from quirework.llm.words import PIECE, hashed_words


def plain(rows, window):
    """rows: (id, text) -> (id, words, removed, kept)."""
    last = 2**62
    order = [last + n if i is None else i for n, (i, _) in enumerate(rows)]
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for i, w in sorted(zip(order, words, strict=True), key=lambda x: x[0]):
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), i)
    out = []
    for (i, _), n, w in zip(rows, order, words, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < n:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = [(i, n, r, hashlib.sha256(k).hexdigest()) for i, n, r, k in plain([(d.doc_id, d.text) for d in docs], 50)]
    assert sum(r for _, _, r, _ in want) > 1000
    assert sorted(tuple(r) for r in op9_cover_anchors(spark, small).collect()) == sorted(want)


def hard_rows(seed):
    """Few words, so that windows repeat in every way: shifted, nested, chained, in one text."""
    rng = random.Random(seed)
    passages = [[rng.choice("abcd") for _ in range(rng.randint(5, 60))] for _ in range(8)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p))
            words += rng.choice([p, p[a:], p[:a], [str(rng.random())]])
        rows.append((i * 3, rng.choice([" ", "\n\t"]).join(words)))
    rows += [(1, rows[9][1]), (900, rows[9][1]), (900, rows[20][1]), (900, rows[9][1])]
    rows += [(2, "z " * 500), (901, "z " * 300 + "y"), (5, None), (6, ""), (902, " \x0b\x0c")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [1, 4, 12, 50])
def test_equals_brute_force_on_hard_rows(spark, docs_of, window):
    rows = hard_rows(window)
    docs = docs_of([(i, t, None, None) for i, t in rows]).repartition(6)
    got = [(r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in substrings.without_repeats(docs, window=window).collect()]
    assert sorted(got) == sorted(plain(rows, window))


def test_small_batches_and_many_partitions(spark, docs_of):
    rows = hard_rows(77) + [(2000 + n, f"{n} " + "q w e r t y u i o p a s " * 2) for n in range(200)]
    docs = docs_of([(i, t, None, None) for i, t in rows]).repartition(9)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = substrings.without_repeats(docs, window=20).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == sorted(plain(rows, 20))


def test_a_line_repeated_in_a_text_asks_once(spark, docs_of):
    """Windows of repeated lines are one row for each text, however often the line stands there."""
    lines = "a frequent line of eight words in all "
    rows = [(n, f"{n} " + lines * 200 + f"end {n} " + lines * 3) for n in range(6)]
    texts = pa.RecordBatch.from_pydict(
        {
            "id": [n for n, _ in rows],
            "tag": [7 * n for n, _ in rows],
            "text": [t.encode() for _, t in rows],
            "shared": [[{"hash": h, "sides": 3} for h in anchors_of(t, 20)] for _, t in rows],
        },
        schema=pa.schema(
            [
                ("id", pa.int64()),
                ("tag", pa.int64()),
                ("text", pa.binary()),
                ("shared", pa.list_(pa.struct([("hash", pa.int64()), ("sides", pa.int32())]))),
            ]
        ),
    )
    out = pa.Table.from_batches(substrings.emit_windows(20)([texts])).to_pylist()
    asks = [r for r in out if not r["known"]]
    assert len({(r["h1"], r["h2"], r["id"]) for r in asks}) == len(asks) < 200
    assert len([r for r in out if r["known"]]) == 5
    got = substrings.without_repeats(docs_of([(i, t, None, None) for i, t in rows]).repartition(3), window=20).collect()
    assert sorted((r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == sorted(plain(rows, 20))


def test_many_copies_of_a_whole_text(spark, docs_of):
    """A group of copies that is most of the table, beside groups of two."""
    rows = [(n, "the same words in most of all texts " * 4) for n in range(5, 400)]
    rows += [(1000 + n, f"a pair of copies number {n // 2} " * 3) for n in range(60)] + [(3, rows[0][1] + "end")]
    got = substrings.without_repeats(docs_of([(i, t, None, None) for i, t in rows]).repartition(7), window=12).collect()
    assert sorted((r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == sorted(plain(rows, 12))


def anchors_of(text, window):
    at, hashes = substrings.Cut([text.encode()], window).anchors()
    return sorted(set(hashes.view("int64").tolist()))


def test_missing_ids_and_empty_table(spark, docs_of):
    text = "one two three four five"
    docs = docs_of([(None, text, None, None), (None, text + " six", None, None), (4, text, None, None)])
    got = substrings.without_repeats(docs, window=5).collect()
    assert sorted((r.id or 0, r.n_removed, bytes(r.kept)) for r in got) == [(0, 5, b""), (0, 5, b"six"), (4, 0, text.encode())]
    assert substrings.without_repeats(docs.limit(0)).count() == 0


def test_covers_bring_any_two_positions_together():
    for period, cover in substrings.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_hashes_do_not_depend_on_where_a_text_is_cut():
    rng = random.Random(3)
    text = " ".join("x" * rng.randint(1, 9) + str(rng.randint(0, 99)) for _ in range(PIECE // 4)).encode()
    text += b" " + b"long" * PIECE + b" end"
    whole, limits = hashed_words([b"a", text, b"", b"b a"])
    assert limits.tolist() == [0, 1, 1 + len(text.split()), 1 + len(text.split()), 3 + len(text.split())]
    by_word = {}
    for word, h in zip([b"a", *text.split(), b"b", b"a"], whole.tolist(), strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_ids_that_would_be_lost_are_an_error(spark, docs_of):
    rows = lambda i: substrings.without_repeats(docs_of([(i, "some words", None, None)])).collect()
    assert [r.id for r in rows(2**62 - 1)] == [2**62 - 1]
    with pytest.raises(Exception, match="not supported"):
        rows(2**62)
