import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from quirework.llm import resample
from quirework.llm.queries import op13_automaton_resample

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_features(text, longest=1):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_sample(docs, items, longest=1, buckets=10_000, percent=10, least=20):
    """docs: (id, text), ids different."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    of = {i: [bucket(f) for f in plain_features(t, longest)] for i, t in docs}
    s = collections.Counter(b for found in of.values() for b in found)
    t = collections.Counter(bucket(f) for x in items for f in plain_features(x, longest))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (total_s + buckets)) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out, high = {}, []
    for i, text in docs:
        weight = sum(gain[b] for b in of[i]) // len(of[i]) if of[i] else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(of[i]), weight, score, None]
        if len(plain_words(text)) >= least:
            high.append((-score, i))
    for rank, (_, i) in enumerate(sorted(high)[: percent * len(high) // 100], 1):
        out[i][3] = rank
    return out


def test_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = op13_automaton_resample(spark, small)
    assert {f.dataType.simpleString() for f in got.schema} == {"bigint"}
    rows = got.collect()
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in rows} == plain_sample(docs, items)
    assert len(rows) == len(docs)


@pytest.mark.parametrize("longest", [2, 3])
def test_longer_runs(spark, docs_of, longest, monkeypatch):
    rng = np.random.default_rng(6)
    vocabulary = ["alpha", "Beta", "gämma", "δ", "7", "x1", "日本", "z" * 80]
    texts = [", ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(60)]
    docs = docs_of([(i, t, None, None) for i, t in enumerate(texts)])
    target = spark.createDataFrame([("alpha beta gämma alpha",), (None,), ("δ 7",)], "text string")
    got = resample.resampled(docs, target, longest=longest, buckets=97, percent=30, least_words=5).collect()
    want = plain_sample(list(enumerate(texts)), ["alpha beta gämma alpha", "δ 7"], longest, 97, 30, 5)
    assert {r.id: [r.n_features, r.weight, r.score, r["rank"]] for r in got} == want


def test_payloads_by_any_dictionary(monkeypatch):
    """Whatever the automaton holds, words have the payloads of their bytes; pieces give what the whole gives."""
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdéz9"), rng.integers(1, 9))) for _ in range(3000)]
    text = "".join(w + rng.choice([" ", "--", "\n", "A ", ". "]) for w in rng.choice(words, 20_000))
    want = [zlib.crc32(w.encode()) for w in plain_words(text)]
    whole = resample.Reader(100_000).counts(text, 3, 101)
    for most in (0, 3, 700, 100_000):
        book = resample.Dictionary(most)
        for _ in range(3):
            (piece,) = resample.pieces(text)
            crcs, lengths = book.payloads(piece)
            assert crcs.tolist() == want and lengths.tolist() == [len(w.encode()) for w in plain_words(text)]
        assert len(book.met) <= most and book.held == len(book.met) or len(book.met) < 512 + 2 * book.held
    monkeypatch.setattr(resample, "PIECE", 1000)
    cut = resample.Reader(100_000).counts(text, 3, 101)
    assert cut[:2] == whole[:2] and (cut[2] == whole[2]).all()
    assert len(want) == whole[0]


def test_joined_checksums():
    rng = np.random.default_rng(8)
    a = [rng.bytes(n) for n in (0, 1, 7, 300, 5)]
    b = [rng.bytes(n) for n in (3, 0, 64, 70_000, 1)]
    crc = lambda x: np.array([zlib.crc32(t) for t in x], np.uint32)
    got = resample.joined(crc(a), crc(b), np.array([len(t) for t in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


def test_odd_rows(spark, docs_of):
    long = "one two three four " * 100_000
    rows = [(None, "w " * 30, None, None), (None, "w " * 30, None, None), (1, None, None, None), (2, "", None, None),
            (3, " .,- ", None, None), (4, long, None, None), (5, "x" * 3_000_000, None, None), (6, "w " * 25, None, "s"),
            (6, "w " * 25, None, "s")]
    docs = docs_of(rows).selectExpr("*", "1 as score", "2 as rank", "3 as n_words")
    target = spark.createDataFrame([("w",)], "text string")
    got = resample.resampled(docs, target, percent=100)
    by_text = {r.id: (r.n_features, r.weight) for r in got.where("id < 6").collect()}
    assert [by_text[i] for i in (1, 2, 3)] == [(0, 0)] * 3
    assert by_text[4][0] == 400_000 and by_text[5][0] == 1
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == [1, 2, 3, 4, 5]
    picked = resample.sample(docs, target, percent=50)
    assert picked.columns == docs.columns and picked.count() == 2
    empty = docs_of([]).limit(0)
    assert resample.resampled(empty, target).count() == 0 and resample.sample(empty, target).count() == 0
    assert resample.resampled(docs, target.limit(0)).count() == len(rows)
