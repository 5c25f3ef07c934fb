import collections
import re

import public_tokenizers
from test_simhash import plain_components, plain_print
from tokenizers import Tokenizer

import corpus_pipeline
from quirework.llm.shared import written


def test_stages_take_effect_on_what_is_left(spark, small):
    """Each stage against what it may keep, and the last against the library itself."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, steps = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, small), "stage")
        assert docs.columns == columns
        steps.append([r.asDict() for r in docs.collect()])
    good, single, clean, mixed = steps
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)

    good.sort(key=lambda r: r["doc_id"])
    groups = plain_components([(r["doc_id"], plain_print(r["text"])) for r in good])
    assert sorted(r["doc_id"] for r in single) == sorted(set(groups))

    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in single if any(i in plain(r["text"]) for i in items)}
    assert held and {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - held

    words = lambda r: len(r["text"].encode().split())
    assert sum(map(words, mixed)) == sum(map(words, clean)) or abs(sum(map(words, mixed)) - sum(map(words, clean))) < 50
    sizes = {r["doc_id"]: words(r) for r in clean}
    taken = collections.Counter()
    for r in mixed:
        taken[r["doc_id"]] += words(r)
    assert all(n <= 3 * sizes[i] for i, n in taken.items())

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter((r["doc_id"], len(whole.encode(r["text"], add_special_tokens=False).ids) + 1) for r in mixed)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert collections.Counter((r.doc_id, r.n_tokens) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:n]) for n in range(len(rows))]


def test_run_is_the_stages_in_turn(spark, small):
    """Row for row, each stage applied to what the one before it left."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), "stage")
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "repeat", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, docs.collect())) and docs.count() > 100
    assert [name for name, _ in corpus_pipeline.STAGES][:3] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination"]
