import collections
import functools
import random
import re

import numpy as np
import pytest

from quirework.llm import decontaminate as d
from quirework.llm.queries import op6_window_simhash


@functools.cache
def shingles(text):
    return {tuple(split(text)[i : i + 5]) for i in range(len(split(text)) - 4)}


@functools.cache
def split(text):
    return re.findall(r"\w+", (text or "").lower())


def plain_similarities(text, item):
    words, own = split(text), split(item)
    if not own:
        return []
    if len(own) < 5:
        return [1.0] if words == own else []
    bag = lambda w: collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    of_item, out = bag(own), []
    if not of_item.keys() & shingles(text):
        return []
    for p in range(max(1, len(words) - len(own) + 1)):
        window = bag(words[p : p + len(own)])
        small = (window & of_item).total()
        out.append(small / (window.total() + of_item.total() - small))
    return out


def test_query_finds_all_planted_items(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    want = {(x.doc_id, i.item_id): s for x in docs for i in items if (s := max(plain_similarities(x.text, i.text), default=0)) >= 0.8}
    got = {(r.doc_id, r.item_id): r.similarity for r in op6_window_simhash(spark, small).collect()}
    assert len(got) >= 3 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def cases():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(n, " ".join(word() for _ in range(rng.randint(15, 60)))) for n in range(30)]
    docs = []
    for n in range(240):
        words = items[n % 30][1].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [word()], [words[at], word()]])
        if n % 5 == 0:
            words = words[: int(len(words) * 0.9)]
        around = [word() for _ in range(rng.choice([0, 3, 80]))]
        docs.append((n, " ".join(around + words + around).replace(" ", rng.choice([" ", ", ", "\n"])).title()))
    return docs, items


@pytest.mark.parametrize("slice_bytes", [2000, 8 << 20])
def test_near_copies_against_brute_force(spark, docs_of, slice_bytes):
    docs, items = cases()
    want = {(i, n): s for i, t in docs for n, u in items if (s := max(plain_similarities(t, u), default=0)) >= 0.8}
    frame = docs_of([(i, t, None, None) for i, t in docs])
    bench = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    got = {(r.id, r.item_id): r for r in d.matches(frame, bench, slice_bytes=slice_bytes).collect()}
    assert got.keys() <= want.keys() and len(got) >= 0.99 * len(want) > 80
    for k, r in got.items():
        words = re.findall(r"\w+", docs[k[0]][1].lower())[r.first_word : r.first_word + r.n_words]
        assert max(plain_similarities(" ".join(words), items[k[1]][1])) == pytest.approx(r.similarity)
        assert r.similarity <= want[k] + 1e-9
    kept = d.decontaminated(frame, bench, slice_bytes=slice_bytes)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in got}


def test_odd_texts_and_tables(spark, docs_of):
    item = "one two three four five six seven eight"
    texts = [None, "", "just these words", "JUST these, words!", "just these words too", f"{item} " * 6000, item, "x " * 60_000 + item.upper()]
    docs = docs_of([(i, t, None, None) for i, t in enumerate(texts)] + [(None, item, None, None)] * 2)
    bench = spark.createDataFrame([(1, item), (1, item), (2, "just these words"), (None, None)], "item_id long, text string")
    found = sorted((r.id or -1, r.item_id, r.similarity) for r in d.matches(docs, bench).collect())
    assert found == sorted([(i, 1, 1.0) for i in (-1, -1, 5, 6, 7) for _ in range(2)] + [(2, 2, 1.0), (3, 2, 1.0)])
    assert d.matches(docs, bench.limit(0)).count() == 0
    assert d.decontaminated(docs, bench.limit(0)).count() == 10
    assert d.matches(docs.limit(0), bench).count() == 0


def test_tables_find_all_within_the_radius():
    draw = np.random.default_rng(3)
    items = draw.integers(0, 2**63, 40, dtype=np.uint64)
    same = d.SameSize.of(list(range(40)), items, 17)
    queries = np.repeat(items, 60)
    for n in range(len(queries)):
        for b in draw.choice(64, draw.integers(0, 22), replace=False):
            queries[n] ^= np.uint64(1) << np.uint64(b)
    window, item = same.near(queries, 17)
    want = np.argwhere(np.bitwise_count(queries[:, None] ^ items[None]) <= 17)
    assert sorted(zip(window.tolist(), item.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))
