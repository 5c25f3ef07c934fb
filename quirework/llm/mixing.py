"""Mixing sources to target weights: capped water-filling, seeded whole and cut repetitions.

Native: DataFrame functions only. The texts are counted where they are read. What is
shuffled is one narrow row for each document, by source and by a part of its seeded hash,
so that a source with a third of all rows is spread over `buckets` keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def summed(rows: DataFrame, order: list[str], before: list[str], onward: list[str]) -> DataFrame:
    """Add running sums along `order`: `before_x` of the rows in front, `onward_x` of a row and those behind it.

    Rows are dealt by ranges of `order`, so that each task sums up a range. One row of each
    range, as many as there are shuffle partitions, meets the others'.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    inside, ranges = Window.partitionBy("range").orderBy(*order), Window.orderBy("range")
    front, behind = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)
    here = (Window.currentRow, Window.unboundedFollowing)

    def total(name, window):
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    names = dict.fromkeys([*before, *onward])
    others = ranged.groupBy("range").agg(*[F.sum(n).alias(n) for n in names]).select(
        "range",
        *[total(n, ranges.rowsBetween(*front)).alias(f"front_{n}") for n in before],
        *[total(n, ranges.rowsBetween(*behind)).alias(f"behind_{n}") for n in onward],
    )
    return ranged.join(F.broadcast(others), "range").select(
        *rows.columns,
        *[(F.col(f"front_{n}") + total(n, inside.rowsBetween(*front))).alias(f"before_{n}") for n in before],
        *[(F.col(f"behind_{n}") + total(n, inside.rowsBetween(*here))).alias(f"onward_{n}") for n in onward],
    )


def water_fill(sources: DataFrame, weights: tuple[float, ...], max_epochs: float) -> DataFrame:
    """A target for each source: `key`, `size` -> `key`, `size`, `target`.

    Sources in order of `key` weigh `weights`, repeating, and share the sum of all sizes.
    No target is above `max_epochs` times its size; what is above is shared by the others
    by weight, again and again. That ends at one level: with sources in order of cap over
    weight, the first ones stay at their caps and the others get level times weight, where
    the level is what the capped ones leave over the weight of the others. From the first
    source that its level leaves below its cap, levels only fall: it is the highest such.

    Sources may be as many as there are hosts: no task sees all of them, the driver two
    numbers. With weights that are whole numbers all sums are exact, so reruns agree.
    """
    numbered = summed(sources.select("key", "size", F.lit(1).alias("one")), ["key"], ["one"], [])
    of_place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    total = float(sources.agg(F.sum("size")).first()[0] or 0)
    capped = (
        numbered.withColumn("weight", of_place)
        .withColumn("cap", F.col("size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .select("key", "size", "weight", "cap", "ratio")
    )
    leveled = summed(capped, ["ratio", "key"], ["cap"], ["weight"]).withColumn(
        "level", (F.lit(total) - F.col("before_cap")) / F.col("onward_weight")
    )
    level = leveled.agg(F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level")))).first()[0]
    filled = F.least("cap", F.lit(level).cast("double") * F.col("weight"))
    return leveled.select("key", "size", filled.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
    weights: tuple[float, ...] = (1, 2, 3),
    max_epochs: float = 3,
    seed: str = "mix",
    hex_digits: int = 3,
) -> DataFrame:
    """How often each document is taken. One row for each input row:

    `id`, `carried` (struct of the `carry` columns), `size` (words), `source_size`, `target`
    (of its source, in words), `copies` (whole repetitions), `cut` (words of one further
    repetition, cut short) and `taken` = copies * size + cut.

    A source's documents all get the whole part of target over size as repetitions. The
    rest goes to its documents in the order of a seeded hash of the id; the one in which
    it ends is cut. So a source's taken words are its rounded target, except when all its
    documents are empty. Rows that tie in id and text are the same to the mix. A null text
    has size 0; null sources are one source, the last; null ids hash as empty strings.
    `hex_digits` sets into how many parts (16 to that power) a source is split.
    """
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = (
        docs.select(
            F.col(id_col).alias("id"),
            F.struct(*[F.col(c) for c in carry] or [F.lit(None).alias("none")]).alias("carried"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(text_col)).alias("tie"),
            # Null sources sort after all others.
            F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("t")).alias("key"),
            hashed.alias("hash"),
        )
        .withColumn("part", F.substring("hash", 1, hex_digits))
    )
    # Read by the targets, which need all of them, and by each document's place.
    parts = written(rows.groupBy("key", "part").agg(F.sum("size").alias("part_size")), "parts")
    sources = parts.groupBy("key").agg(F.sum("part_size").alias("size"))
    targets = water_fill(sources, weights, max_epochs).select(
        "key", F.col("size").alias("source_size"), "target"
    )
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.join(targets, "key").select(
        "key",
        "part",
        "source_size",
        "target",
        F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("part_start"),
    )
    inside = (
        Window.partitionBy("key", "part")
        .orderBy("hash", "id", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # A rounded target may be one above the cap only where the cap is no whole number.
    whole = F.expr("least(cast(round(target) as long), cast(floor(cap) as long))")
    left = F.col("rest") - F.col("part_start") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (
        rows.join(starts, ["key", "part"])
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("words", whole)
        .withColumn(
            "copies",
            F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)),
        )
        .withColumn("rest", F.col("words") - F.col("copies") * F.col("source_size"))
        .withColumn("cut", F.least(F.greatest(left, F.lit(0)), F.col("size")))
        # An extra repetition that is not cut is a whole one.
        .withColumn("full", (F.col("cut") == F.col("size")) & (F.col("size") > 0))
        .withColumn("copies", F.col("copies") + F.col("full").cast("long"))
        .withColumn("cut", F.when(F.col("full"), F.lit(0)).otherwise(F.col("cut")).cast("long"))
        .select(
            "id",
            "carried",
            "size",
            "source_size",
            "target",
            "copies",
            "cut",
            (F.col("copies") * F.col("size") + F.col("cut")).alias("taken"),
        )
    )


def mixed(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as `mix` says.

    The cut repetition, one document of a source at most, holds its first words joined by
    one space, with `chars_col` counted anew if there is such a column.
    """
    plan = mix(docs, text_col=text_col, carry=tuple(docs.columns), **options)
    cut_text = F.array_join(
        F.slice(F.regexp_extract_all(F.col(f"carried.{text_col}"), F.lit(WORD), F.lit(0)), 1, F.col("cut").cast("int")),
        " ",
    )
    times = F.when(
        F.col("copies") + F.col("cut") > 0,
        F.sequence(F.when(F.col("cut") > 0, F.lit(0)).otherwise(F.lit(1)).cast("long"), F.col("copies")),
    )
    rows = plan.withColumn("time", F.explode(times)).withColumn(
        "piece", F.when(F.col("time") == 0, cut_text).otherwise(F.col(f"carried.{text_col}"))
    )
    length = docs.schema[chars_col].dataType if chars_col in docs.columns else None
    return rows.select(
        *[
            F.col("piece").alias(c)
            if c == text_col
            else F.when(F.col("time") == 0, F.char_length("piece").cast(length))
            .otherwise(F.col(f"carried.{c}"))
            .alias(c)
            if c == chars_col
            else F.col(f"carried.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
