import re

import numpy as np
import pytest

from quirework.llm import quality
from quirework.llm.queries import op1_attention_mil

GOOD = "The quiet river runs past an old mill, and people walk there on Sundays. "
BAD = "BUY NOW!! | $$$ *** CLICK!! | ### "


def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(len(p))
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark, larger):
    rows = op1_attention_mil(spark, larger).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(y, np.array([r.score for r in held])) > 0.98
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark, docs_of):
    docs = docs_of([(i, (GOOD if i % 2 else BAD) * 3, None, None) for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2 if i < 30 else None) for i in range(40)], "doc_id long, quality int")
    one = quality.train(docs, labels, epochs=2)
    two = quality.train(docs, labels.where("quality is not null").repartition(3), epochs=2)
    assert all(np.array_equal(one[k], two[k]) for k in one)


def test_attention_finds_the_bad_passage(spark, docs_of):
    long_bad = [(i, GOOD * 20 + BAD * 6 + GOOD * 20, None, None) for i in range(0, 60, 2)]
    long_good = [(i, GOOD * 42 + f" {i}", None, None) for i in range(1, 60, 2)]
    docs = docs_of(long_bad + long_good)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    x, limits = quality.passages([long_bad[0][1]])
    weights = quality.forward(model, x, limits)["a"]
    text = long_bad[0][1].split()
    spans = [" ".join(text[k * quality.PASSAGE : (k + 1) * quality.PASSAGE]) for k in range(len(x))]
    assert "BUY" in spans[int(weights.argmax())]
    assert {r.id for r in quality.score(docs, model).where("score >= 0.5").collect()} == set(range(1, 60, 2))
    kept = quality.accepted(docs, model, least=0.5)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(1, 60, 2))


def test_odd_texts_and_no_labels(spark, docs_of):
    texts = [None, "", " \n ", "x" * 300_000, "é 漢字 😀", "w " * 90_000, "a\x0bb"]
    docs = docs_of([(i, t, None, None) for i, t in enumerate(texts)] + [(None, "same", None, None)] * 2)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score(docs, quality.train(docs, none)).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), none)).count() == 0


def test_gradients_are_right():
    draw = np.random.default_rng(0)
    x = draw.random((11, quality.FEATURES))
    limits, y = np.array([0, 4, 5, 11]), np.array([1.0, 0.0, 1.0])
    model = {k: np.asarray(v, float) for k, v in quality.fit([x[:4], x[4:5], x[5:]], y, epochs=1).items()}

    def loss():
        p = quality.forward(model, x, limits)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, g in quality.gradients(model, x, limits, y).items():
        at = tuple(draw.integers(0, n) for n in model[name].shape)
        kept = model[name][at]
        model[name][at] = kept + 1e-5
        up = loss()
        model[name][at] = kept - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[at], rel=1e-3, abs=1e-7)
        model[name][at] = kept


def test_passages_do_not_depend_on_their_neighbours():
    texts = [GOOD * 9, "", BAD * 30, None, " x "]
    x, limits = quality.passages(texts)
    for n, t in enumerate(texts):
        assert np.allclose(x[limits[n] : limits[n + 1]], quality.passages([t])[0])
    assert limits.tolist()[:2] == [0, -(-len((GOOD * 9).split()) // quality.PASSAGE)]


# A plain version, passage by passage, from the definitions.


def plain_passages(text):
    def kind(c):
        if c in " \t\x0b\x0c":
            return 4
        if c in "\n\r":
            return 5
        if c.isalpha():
            return 2 if c.isupper() else 1
        if c.isdigit():
            return 3
        signs = [chr(n) for n in range(33, 127) if not chr(n).isalnum()]
        return 6 + signs.index(c) if c in signs else 0

    word, before, place = -1, True, []
    for c in text:
        blank = kind(c) in (4, 5)
        word += not blank and before
        before = blank
        place.append(max(word, 0) // quality.PASSAGE)
    n_passages = max(-(-(word + 1) // quality.PASSAGE), 1)
    out = np.zeros((n_passages, quality.FEATURES))
    at = 0
    for order, size in ((1, quality.CLASSES), (2, 216), (3, 252)):
        for i in range(len(text) - order + 1):
            if place[i] == place[i + order - 1]:
                code = 0
                for c in text[i : i + order]:
                    code = code * quality.CLASSES + kind(c)
                out[place[i], at + (code if order == 1 else (code * 0x9E3779B1 >> 7) % size)] += 1
        total = out[:, at : at + size].sum(axis=1, keepdims=True)
        out[:, at : at + size] = np.sqrt(out[:, at : at + size] / np.maximum(total, 1))
        at += size
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    for p in range(n_passages):
        own = range(p * quality.PASSAGE, min((p + 1) * quality.PASSAGE, len(words)))
        if own:
            out[p, at] = sum(words[i] in words[:i] for i in own) / len(own)
            earlier = list(zip(words, words[1:]))
            out[p, at + 1] = sum((words[i], words[i + 1]) in earlier[:i] for i in own if i + 1 < len(words)) / len(own)
    return out


def plain_score(model, x):
    h = [np.tanh(((row - model["mean"]) / model["spread"]) @ model["W"] + model["b"]) for row in x]
    gate = lambda v: 1 / (1 + np.exp(-v))
    e = np.array([(np.tanh(v @ model["V"]) * gate(v @ model["U"])) @ model["w"] for v in h])
    a = np.exp(e) / np.exp(e).sum()
    return float(gate(sum(w * v for w, v in zip(a, h, strict=True)) @ model["c"] + model["d"])[0])


STRANGE = ["", " \n ", "One two, THREE 4!", GOOD * 9, BAD * 30, "x" * 300, "  lead " + "ab cd ab cd " * 60 + "\r\n", "é漢 😀\x85b " * 50]


def test_scores_equal_a_plain_version():
    bags = [quality.passages([t])[0] for t in STRANGE]
    for t, x in zip(STRANGE, bags, strict=True):
        assert np.allclose(x, plain_passages(t), atol=1e-6), t[:20]
    model = quality.fit(bags, np.arange(len(bags)) % 2, epochs=3)
    want = [plain_score(model, plain_passages(t)) for t in STRANGE]
    assert np.allclose(quality.scored(model, STRANGE), want, atol=1e-5)
    assert np.allclose([quality.streamed(model, [row[None] for row in x]) for x in bags], want, atol=1e-5)


@pytest.mark.parametrize("piece", [1, 2, 5, 33, 1000])
def test_blocks_give_what_the_whole_gives(monkeypatch, piece):
    monkeypatch.setattr(quality, "LONG", piece)
    for t in STRANGE[2:] + [" "]:
        got = np.concatenate(list(quality.passage_blocks(t)))
        assert np.allclose(got, quality.passages([t])[0], atol=1e-6), t[:20]


def test_long_texts_take_bounded_memory(spark, docs_of):
    import tracemalloc

    text = "".join(f"{GOOD}{n} " for n in range(200_000))
    model = quality.fit([quality.passages([GOOD])[0], quality.passages([BAD])[0]], np.array([1, 0]), epochs=2)
    tracemalloc.start()
    score = quality.scored(model, [text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < score < 1 and peak < 3 * len(text) + 300 * quality.LONG
    one_word = "x" * 3_000_000
    docs = docs_of([(1, text[:2_000_000], None, None), (2, one_word, None, None), (3, BAD, None, None)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    assert {r.id for r in quality.score(docs, quality.train(docs, labels)).collect()} == {1, 2, 3}
    # Bounded by rows: a text with too many passages teaches nothing, the others whole.
    few = quality.train(docs, labels, most_passages=3, epochs=1)
    two = quality.train(docs, labels.where("doc_id > 1"), epochs=1)
    assert all(np.array_equal(few[k], two[k]) for k in few)
