import re

import numpy as np
import pytest
import xxhash

from quirework.llm import simhash
from quirework.llm.queries import op8_simhash_pigeonring


def plain_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    """rows: (id, fingerprint)."""
    ids, prints = [i for i, _ in rows], np.array([p for _, p in rows], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius):
            a, b = sorted((find(i), find(int(j) + i + 1)), key=lambda k: ids[k])
            root[b] = a
    return [ids[find(k)] for k in range(len(ids))]


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    rows = [(d.doc_id, plain_print(d.text)) for d in docs]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(rows, plain_components(rows), strict=True)]
    assert sorted(tuple(r) for r in op8_simhash_pigeonring(spark, small).collect()) == want
    assert len({c for _, _, c in want}) < len(want)


def test_odd_texts(spark, docs_of):
    texts = [None, "", " \n", "One", "one", "ÄB c", "äb c", "a\x0bb\x0cc\td e", "A B C D E", "a\x85b c", "w " * 40_000, "same text here now", "same text here now"]
    got = simhash.near_duplicates(docs_of([(i, t, None, None) for i, t in enumerate(texts)])).collect()
    assert {r.id: r.fingerprint % 2**64 for r in got} == {i: plain_print(t) for i, t in enumerate(texts)}
    by_id = {r.id: r.component_id for r in got}
    assert by_id[0] == by_id[1] == by_id[2] == 0 and by_id[4] == 3 and by_id[12] == 11
    assert simhash.near_duplicates(docs_of([]).limit(0)).count() == 0


def test_missing_and_repeated_ids(spark, docs_of):
    got = simhash.near_duplicates(docs_of([(None, "x y z", None, None), (7, "x y z", None, None), (7, "x y z", None, None)]))
    assert sorted(str((r.id, r.component_id)) for r in got.collect()) == ["(7, 7)", "(7, 7)", "(None, 7)"]
    rows = [(None, "x y z", None, None), (None, "other text here", None, None), (None, None, None, None)]
    docs = docs_of(rows * 2 + [(7, "x y z", None, "b"), (7, "far from that one", None, "b")])
    assert {r.component_id for r in simhash.near_duplicates(docs).where("id is null").collect()} == {None, 7}
    first = simhash.first_of_each(docs)
    assert first.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in first.collect()) == [
        (0, ""), (0, "other text here"), (7, "far from that one"), (7, "x y z")
    ]


def test_the_largest_id_is_an_id(spark, docs_of):
    top = 2**63 - 1
    docs = docs_of([(top, "x y z", None, None), (None, "x y z", None, None), (top, "other text here", None, None)])
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {top}
    assert sorted((r.doc_id, r.text) for r in simhash.first_of_each(docs).collect()) == [(top, "other text here"), (top, "x y z")]


@pytest.mark.parametrize(("block_rows", "chain"), [(7, 5), (64, 5), (16_384, 5), (16_384, 7)])
def test_clusters_and_long_runs(spark, block_rows, chain):
    """A dense group, chains of small steps and strangers, with long runs cut into blocks."""
    rng = np.random.default_rng(5)
    flips = lambda n: sum(1 << int(b) for b in rng.choice(64, n, replace=False))
    prints = [int(x) for x in rng.integers(0, 2**63, 150)]
    prints += [prints[0] ^ flips(2) for _ in range(150)]
    for _ in range(60):
        prints.append(prints[-1] ^ flips(4))
    prints += [prints[5] ^ flips(5) for _ in range(40)]
    prints = sorted(set(prints))
    rows = [(i, p) for i, p in enumerate(prints)]
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, chain=chain, block_rows=block_rows)).collect()}
    groups, want = {}, {}
    for p, c in zip(signed, plain_components(rows), strict=True):
        groups.setdefault(roots.get(p, p), set()).add(p)
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    if block_rows == 7:
        keyed = frame.selectExpr("pmod(print, 3) as key", "print").repartition(2, "key").sortWithinPartitions("key")
        cut = simhash.meetings(keyed, 4, 7).where("key is not null").collect()
        assert sum(len(r.prints) for r in cut) == 8 * len(prints)
        assert all(len(r.prints) <= 7 * 8 for r in cut)


def test_pigeonring_is_the_hamming_check():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for radius in (0, 3, 4, 7):
        for n in range(radius + 3):
            b = a.copy()
            for _ in range(n):
                b ^= np.uint64(1) << rng.integers(0, 64, len(a), dtype=np.uint64)
            near = np.bitwise_count(a ^ b) <= radius
            assert (simhash.chained(a, b, radius) == near).all()
            parts = (a ^ b).view(np.uint8).reshape(-1, 8) == 0
            for chain in (5, 7):
                met = np.any([parts[:, list(k)].all(axis=1) for k in simhash.key_segments(radius, chain)], axis=0)
                assert met[near].all()


def test_keys_grow_with_the_table(spark, docs_of, monkeypatch):
    """32-bit keys from seven segments; the result does not depend on the choice."""
    for prints, chain, keys, segments in ((simhash.MANY - 1, 5, 40, 3), (simhash.MANY, 7, 70, 4)):
        assert simhash.chain_for(prints) == chain
        assert [len(k) for k in simhash.key_segments(4, chain)] == [segments] * keys
    texts = [f"{'same text for all of these rows ' * 9} {n % 5}" for n in range(20)] + [f"word{n}" for n in range(20)]
    docs = docs_of([(n, t, None, None) for n, t in enumerate(texts)])
    usual = sorted(simhash.near_duplicates(docs).select("id", "component_id").collect())
    monkeypatch.setattr(simhash, "MANY", 3)
    assert sorted(simhash.near_duplicates(docs).select("id", "component_id").collect()) == usual
