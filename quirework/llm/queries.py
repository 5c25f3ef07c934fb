"""The queries of this subpackage: name -> (function of session and folder, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import (
    codes,
    decontaminate,
    language,
    lattice,
    mixing,
    private,
    quality,
    resample,
    shards,
    simhash,
    sql,
    substrings,
    tokens,
    warc,
)
from quirework.llm.shared import written


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


LEAST_QUALITY = 0.3


def quality_model(spark: SparkSession, folder: str) -> dict:
    """Learnt from the labels of the rows that are not held out."""
    labels = table(spark, folder, "labels").where(~language.held_out(F.col("doc_id")))
    return quality.train(table(spark, folder, "documents"), labels)


def op1_attention_mil(spark: SparkSession, folder: str) -> DataFrame:
    scores = quality.score(table(spark, folder, "documents"), quality_model(spark, folder))
    return scores.select(
        F.col("id").alias("doc_id"),
        language.held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


def op2_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.normalise(warc.write_archives(table(spark, folder, "pages")))
    records = written(warc.read_records(archives, with_payload=False).drop("payload"), "records")
    # A page without an id has no number in its record's name.
    number = lambda c: F.regexp_extract(c, r"page:(-?\d+)", 1).try_cast("long")
    return warc.resolved(records).select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )


def op8_simhash_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_naive_bayes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    return language.predict(docs, model).select(
        F.col("id").alias("doc_id"), language.held_out(F.col("id")).alias("held_out"), "lang_pred", "score"
    )


def op4_lattice_cells(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op5_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    # The key of the test tables; a real one comes from the caller's secrets.
    return private.pseudonyms(table(spark, folder, "documents"), "test tables").withColumnRenamed("id", "doc_id")


def op6_window_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.matches(docs, items).withColumnRenamed("id", "doc_id")


def op7_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    manifest = tokens.write_tokens(docs, tokenizer_path(), added_tokens=True)
    return tokens.read_tokens(manifest, docs).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op9_cover_anchors(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return substrings.without_repeats(docs, with_text=False).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256")
    )


def op10_capped_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies"
    )


def op11_lpt_heap(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.sharded(table(spark, folder, "documents"))
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        shards.byte_size(F.col("text")).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_bitmask_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows, books = codes.compressed(table(spark, folder, "embeddings"))
    return rows.select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(codes.digest(books)).alias("codebooks_sha256"),
    )


def op13_automaton_resample(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resample.resampled(docs, items).select(
        F.col("id").alias("doc_id"), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")
    )


QUERIES = {
    "op1_attention_mil": (op1_attention_mil, None),
    "op2_warc_members": (op2_warc_members, sql.OP2),
    "op3_naive_bayes": (op3_naive_bayes, None),
    "op4_lattice_cells": (op4_lattice_cells, sql.OP4),
    "op5_feistel_pseudonyms": (op5_feistel_pseudonyms, None),
    "op6_window_simhash": (op6_window_simhash, None),
    "op7_token_shards": (op7_token_shards, None),
    "op8_simhash_pigeonring": (op8_simhash_pigeonring, None),
    "op9_cover_anchors": (op9_cover_anchors, sql.OP9),
    "op10_capped_mix": (op10_capped_mix, sql.OP10),
    "op11_lpt_heap": (op11_lpt_heap, sql.OP11),
    "op12_bitmask_codes": (op12_bitmask_codes, sql.OP12),
    "op13_automaton_resample": (op13_automaton_resample, sql.OP13),
}
