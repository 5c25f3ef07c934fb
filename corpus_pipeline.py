"""From documents to token shards, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import decontaminate, mixing, quality, simhash, tokens
from quirework.llm.queries import LEAST_QUALITY, quality_model, table, tokenizer_path
from quirework.llm.shared import new_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model accepts."""
    return quality.accepted(docs, quality_model(spark, sf_dir), least=LEAST_QUALITY)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (4-word shingles, 4 bits): that with the smallest id."""
    return simhash.first_of_each(docs, words=4, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids, read back: a row for each document and repetition."""
    manifest = tokens.write_tokens(docs, tokenizer_path(), added_tokens=True)
    return tokens.read_tokens(manifest, docs).select(
        F.col("id").alias("doc_id"), "repeat", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_output),
]

#: SQL has no tokenizer, classifier or XXH64 bits: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
