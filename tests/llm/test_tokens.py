import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quirework.llm import tokens
from quirework.llm.queries import op7_token_shards

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", "a  b", "a   b c", "a \n b", "a\n b\n\nc ", "a \t b", "tail ", "tail\n ",
    "it's we'll 'tis' don't 12 3a b4", "x<|endoftext|>y <|endoftext|>", "Ünï çödé — “q” 漢字 かな 😀 é́",
    "word, word. WORD!! a|b | c *** $$$ &&&", " a   b c", "a" * 5000, "ab " * 30000,
    "no\x00nul \x1c\x85 x",
]


@pytest.fixture(scope="module")
def plain():
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    return lambda t: whole.encode(t or "", add_special_tokens=False).ids + [2]


def expected(rows, plain):
    out, start = [], 0
    for i, text in rows:
        ids = np.array(plain(text), "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark, small, plain):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in op7_token_shards(spark, small).collect())
    assert got == expected([(r.doc_id, r.text) for r in docs], plain)


def test_odd_texts_repeats_and_small_shards(spark, docs_of, plain):
    rows = [(n // 2 * 3, t, "en", "s") for n, t in enumerate(ODD)] + [(None, "none", None, None)] * 2
    docs = docs_of(rows)
    manifest = tokens.write_tokens(docs, PATH, shard_bytes=16)
    assert manifest.count() > 8
    got = tokens.read_tokens(manifest, docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = expected([(r[0], r[1]) for r in order], plain)
    have = [(r.id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got]
    assert sorted(map(str, have)) == sorted(map(str, want))


def test_strange_keys_and_empty_table(spark, docs_of):
    docs = docs_of([(i, "some words", "en", "s") for i in range(0, 100, 2)])
    manifest = tokens.write_tokens(docs, PATH)
    got = {r.id: r.n_tokens for r in tokens.read_tokens(manifest, spark.range(-1, 100), "id").collect()}
    assert got == {i: (3 if i >= 0 and i % 2 == 0 else None) for i in range(-1, 100)}
    none = tokens.write_tokens(docs.limit(0), PATH)
    assert tokens.read_tokens(none, docs.limit(0)).count() == 0
    assert {r.start for r in tokens.read_tokens(none, docs).collect()} == {None}


def test_perfect_hash_is_minimal_and_perfect():
    keys = tokens.mixed_bits(np.arange(20_000, dtype=np.uint64), 9)
    slots = tokens.PerfectHash.build(keys).slots(keys)
    assert sorted(slots) == list(range(20_000))
    assert len(tokens.PerfectHash.build(keys[:0]).slots(keys[:0])) == 0
    with pytest.raises(ValueError):
        tokens.PerfectHash.build(np.repeat(keys[:1], 2))


def test_memory_of_words_may_run_over(plain):
    small_memory = tokens.WordEncoder(PATH, memory=3)
    text = "one two, three four five one two six seven"
    assert np.frombuffer(small_memory(text), small_memory.type).tolist() == plain(text)[:-1]


def test_query_and_stage_give_added_tokens_their_ids(spark, docs_of, tmp_path):
    """Against the library's plain call, without encode_special_tokens."""
    import corpus_pipeline

    whole = Tokenizer.from_file(PATH)
    ids = lambda t: whole.encode(t or "", add_special_tokens=False).ids + [2]
    assert ids("x<|endoftext|>y") == [87, 50256, 88, 2]
    docs = docs_of([(n, t, "en", "s") for n, t in enumerate(ODD)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = expected(list(enumerate(ODD)), ids)
    assert sorted(tuple(r) for r in op7_token_shards(spark, str(tmp_path)).collect()) == want
    rows = corpus_pipeline.token_output(spark, docs, "").collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want
