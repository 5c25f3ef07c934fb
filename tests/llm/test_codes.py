import hashlib
import math

import numpy as np
import pytest

from quirework.llm import codes
from quirework.llm.queries import op12_bitmask_codes


def plain_codes(rows, positions=16, entries=64, rounds=2):
    """Row by row with Python integers. rows: (id, vector, label), ids different."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: r[0])
    cut = []
    for _, vector, _ in kept:
        whole = [math.floor(256 * x) for x in vector]
        w = len(whole) // positions
        cut.append([whole[p * w : p * w + w] for p in range(positions)])
    books = [[v[p] for v in cut[:entries]] for p in range(positions)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = {}
        for v in cut:
            for p in range(positions):
                members.setdefault((p, nearest(p, v[p])[1]), []).append(v[p])
        for (p, k), parts in members.items():
            books[p][k] = [sum(x) // len(parts) for x in zip(*parts, strict=True)]
    out, sums = {}, {}
    for (i, _, label), v in zip(kept, cut, strict=True):
        found = [nearest(p, v[p]) for p in range(positions)]
        out[i] = ["".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label]
        sums[label] = sums.get(label, 0) + out[i][1]
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return {i: (c, e, sums[label]) for i, (c, e, label) in out.items()}, hashlib.sha256(flat.encode()).hexdigest()


def test_query_equals_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want, sha = plain_codes(rows)
    got = op12_bitmask_codes(spark, small).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == want
    assert len(got) == len(want) and {r.codebooks_sha256 for r in got} == {sha}


def test_masks_hold_the_nearest():
    """Against all distances: ties, equal entries, single entries, far parts."""
    rng = np.random.default_rng(1)
    for entries, spread, dims in [(64, 3, 4), (64, 200, 4), (1, 50, 2), (17, 1, 1), (64, 1 << 24, 3)]:
        book = rng.integers(-spread, spread + 1, (entries, dims))
        parts = np.concatenate((rng.integers(-2 * spread, 2 * spread + 1, (500, dims)), book))
        all_distances = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
        found = codes.Codebook(book)
        entry, distance = found.nearest(parts)
        assert (entry == all_distances.argmin(axis=1)).all() and (distance == all_distances.min(axis=1)).all()
        masks = found.candidates(parts)
        assert ((masks >> entry.astype(np.uint64)) & np.uint64(1)).all()
    few = np.bitwise_count(codes.Codebook(rng.integers(-200, 200, (64, 4))).candidates(rng.integers(-200, 200, (500, 4))))
    assert few.mean() < 24
    with pytest.raises(ValueError, match="1 to 64"):
        codes.Codebook(np.zeros((65, 2), np.int64))


KIND = "vec_id long, embedding array<double>, label string, code string, error int"


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), "a" if i % 3 else None, "x", 1) for i in range(20)]
    rows += [(20, None, "a", "x", 1), (21, [1.0, None, 0.0, 0.0], "a", "x", 1), (22, [nan, 0.0, 0.0, 0.0], "b", "x", 1),
             (23, [0.0, inf, 0.0, 0.0], "b", "x", 1), (24, [1e300, -1e300, 0.0, 0.0], "c", "x", 1)]
    odd = rows + [(25, [1.0, 2.0], "a", "x", 1), (26, [], "a", "x", 1)]
    frame = spark.createDataFrame(odd, KIND)
    got, books = codes.compressed(frame, positions=2, entries=8)
    clamp = lambda v: v and [None if x is None else x if not math.isfinite(x) else max(-65536.0, min(65536.0, x)) for x in v]
    want, sha = plain_codes([(i, clamp(v), label) for i, v, label, *_ in rows], 2, 8)
    found = {r.id: (r.codes.hex(), r.error, r.label_error) for r in got.collect() if r.codes is not None}
    assert found == want and codes.digest(books) == sha
    assert {r.id: r.error for r in got.collect() if r.codes is None} == {25: None, 26: None}
    assert codes.decoded(bytes.fromhex(want[0][0]), books).shape == (4,)


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    rows = [(None, [0.5, 0.5], "a", "x", 1), (1, [0.5, 0.25], "a", "x", 1), (1, [0.5, 0.25], "a", "x", 1)]
    got, books = codes.compressed(spark.createDataFrame(rows, KIND), positions=2)
    assert books.shape == (2, 3, 1)
    assert sorted(str(tuple(r)) for r in got.select("id", "error", "label_error").collect()) == ["(1, 0, 0)"] * 2 + ["(None, 0, 0)"]
    got, books = codes.compressed(spark.createDataFrame([(1, None, "a", "x", 1)], KIND))
    assert books is None and got.count() == 0
    got, books = codes.compressed(spark.createDataFrame([], KIND))
    assert books is None and got.count() == 0
    empty = [(0, [], "a", "x", 1)]
    got, books = codes.compressed(spark.createDataFrame(empty + rows, KIND), positions=2)
    assert books.shape == (2, 3, 1)
    assert sorted((r.id, r.codes is None) for r in got.collect() if r.id is not None) == [(0, True), (1, False), (1, False)]
    got, books = codes.compressed(spark.createDataFrame(empty, KIND))
    assert books is None and [(r.codes, r.error) for r in got.collect()] == [(None, None)]
    with pytest.raises(ValueError, match="can't be cut"):
        codes.compressed(spark.createDataFrame(rows, KIND), positions=16)
