import math
import zlib

import numpy as np
import pytest

from quirework.llm import language
from quirework.llm.queries import op3_naive_bayes


def test_query_on_held_out_documents(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op3_naive_bayes(spark, small).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


TEXTS = [
    ("the house and the garden", "en"), ("the dog, THE cat", "en"), ("das haus und der garten", "de"),
    ("der hund und die katze", "de"), ("la casa y el jardín", "es"), (None, "es"), ("nothing", None), ("", "de"),
]


def plain_grams(text, buckets):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = "".join(f" {w}" for w in words) + " " if words else " "
    out = []
    for order in language.ORDERS:
        for at in range(len(line) - order + 1):
            h = 0
            for n, c in enumerate(line[at : at + order], 1):
                h = (h * 0x9E3779B1 + ord(c) + n) % 2**32
            h = (h ^ h >> 15) * 0x85EBCA6B % 2**32
            out.append((h >> 8) % buckets)
    return sorted(out)


@pytest.mark.parametrize("texts", [["ab", "A,b  c", "", None, "é1x", " the end. "]])
def test_buckets_equal_a_plain_version(texts):
    found, limits = language.gram_buckets(texts, 997)
    for n, t in enumerate(texts):
        own = sorted(found[limits[n] : limits[n + 1]].tolist())
        assert own == plain_grams(t or "", 997), t


def test_model_equals_a_plain_version(spark, docs_of):
    docs = docs_of([(i, t, lang, None) for i, (t, lang) in enumerate(TEXTS)]).repartition(3)
    langs, priors, logs = language.train(docs, buckets=256, smoothing=0.5)
    assert langs == ["de", "en", "es"]
    taught = [(t, lang) for t, lang in TEXTS if t is not None and lang]
    for k, lang in enumerate(langs):
        counts = np.zeros(256)
        for t, _ in (x for x in taught if x[1] == lang):
            np.add.at(counts, plain_grams(t, 256), 1)
        assert np.allclose(logs[k], np.log((counts + 0.5) / (counts.sum() + 128)))
        assert priors[k] == pytest.approx(math.log(sum(x[1] == lang for x in taught) / len(taught)))
    rows = {r.id: r for r in language.predict(docs, (langs, priors, logs)).collect()}
    for i, (t, _) in enumerate(TEXTS):
        if not t:
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
            continue
        joint = priors + sum(logs[:, b] for b in plain_grams(t, 256))
        assert rows[i].lang_pred == langs[int(joint.argmax())]
        assert rows[i].score == pytest.approx(1 / np.exp(joint - joint.max()).sum())


def test_odd_texts_and_nothing_learnt(spark, docs_of):
    docs = docs_of([(1, "12 .. 34", "en", None), (2, "x" * 200_000, "en", None), (None, "漢字", "zh", None), (2, "漢", "zh", None)])
    model = language.train(docs)
    got = sorted((r.id or 0, r.lang_pred) for r in language.predict(docs, model).collect())
    assert got == [(0, "zh"), (1, "und"), (2, "en"), (2, "zh")]
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        language.train(docs, most_languages=1)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_pieces_give_what_the_whole_gives(monkeypatch, piece):
    texts = ["ab", "A,b  c d. é1x the end ", "ΑΣ ΑΣΑ. Σ" * 9, "   ", "..a", "x" * 40, "漢字 😀 a"]
    want = [tuple(map(list, x[:2])) + (x[2],) for x in language.text_counts(texts, 997)]
    monkeypatch.setattr(language, "LONG", piece)
    got = [language.long_counts(t, 997) for t in texts]
    assert [(np.flatnonzero(n).tolist(), n[n > 0].tolist(), known) for n, known in got] == want


def test_long_texts_take_bounded_memory(spark, docs_of):
    import tracemalloc

    text = "the quiet River, 12 mills and " * 500_000
    tracemalloc.start()
    n, known = language.long_counts(text, 1 << 14)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert known and peak < 3 * len(text) + 100 * language.LONG
    docs = docs_of([(1, text, "en", None), (2, "das haus und der garten", "de", None)])
    assert {r.id: r.lang_pred for r in language.predict(docs, language.train(docs)).collect()} == {1: "en", 2: "de"}
