"""Equi-joins and gap filling.

No join carries a hint: adaptive execution broadcasts a side by its measured size and
splits the partitions of hot keys in the others.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = 1024


def equi_join(df: DataFrame, other: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Equi-join of sides of any size.

    It carries no hint, which nothing could undo when a side turns out large: adaptive
    execution broadcasts a side when its measured size is under the session's bound, and
    shuffles both and splits hot partitions otherwise.
    """
    return df.join(other, on, how)


def left_join(
    df: DataFrame, other: DataFrame, on: str | list[str], many_matches: bool = False, salts: int = 32
) -> DataFrame:
    """Left outer join.

    Adaptive execution can split a hot key of the left side only. If it is the right side
    that may hold many rows of one key, `many_matches` looks for its hot keys first, and
    deals the rows of each of them over `salts` parts, each of which meets the left row.
    Both sides are read once for the join; the keys of the right side once before, for a
    sketch of bounded size.
    """
    if not many_matches:
        return df.join(other, on, "left")
    keys = [on] if isinstance(on, str) else on
    hot = hot_keys(other, keys)
    if not hot:
        return df.join(other, keys, "left")
    key, every = _key_text(keys), F.sequence(F.lit(0), F.lit(salts - 1))
    # Which part a row goes to depends on the row alone, so that a repeated task agrees.
    part = F.pmod(F.xxhash64(*other.columns), F.lit(salts)).cast("int")
    dealt = other.withColumns(
        {"_salt": F.when(key.isin(hot), part).otherwise(0), "_matched": F.lit(True)}
    )
    repeated = df.withColumn("_hot", F.coalesce(key.isin(hot), F.lit(False))).withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    joined = repeated.join(dealt, [*keys, "_salt"], "left")
    # A hot key has a match in some part; where a part holds none, there is no row to keep.
    return joined.filter(~F.col("_hot") | F.col("_matched").isNotNull()).drop("_salt", "_hot", "_matched")


def hot_keys(df: DataFrame, keys: list[str], share: int = 100) -> list[str]:
    """Keys, as JSON text, that hold more than about 1/`share` of the rows; `share` at most.

    From a sketch of frequent items, which tasks fill and merge. No key with a null is hot: it
    has no match.
    """
    known = df.filter(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    # A sketch of 16 times as many items errs by a fraction of the share.
    sketch = F.expr(f"approx_top_k(_key, {share}, {1 << (16 * share - 1).bit_length()})")
    found = known.select(_key_text(keys).alias("_key")).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [item.item for item in found.top or [] if item["count"] * share > found.n]


def _key_text(keys: list[str]) -> Column:
    return F.to_json(F.struct(*keys))


def keep_existing(df: DataFrame, existing: DataFrame, on: str | list[str]) -> DataFrame:
    """Semi-join: rows whose key occurs in `existing`, never multiplied.

    Keys of `existing` are reduced map-side first, so a key repeated many times on
    that side costs one row per task.
    """
    keys = [on] if isinstance(on, str) else on
    return df.join(existing.select(*keys).distinct(), keys, "left_semi")


def fill_gaps(
    df: DataFrame,
    keys: list[str],
    number: str,
    value: str,
    default,
    total: str = "page_count",
    spread: bool = False,
) -> DataFrame:
    """Dense 1..max rows per key, `default` where a number is missing or its value null.

    Rows must be unique per (key, number), and keys not null; numbers below 1 are left out.
    Each row looks back at the number before it and makes the rows in between: one shuffle
    by key and no join. Wide gaps are unfolded in blocks, so none becomes one long array.

    Where one key can hold a large part of all rows, `spread` makes the number lines from the
    keys' maxima and joins the rows to them by (key, number), which spreads a key over all
    tasks.
    """
    if spread:
        return _spread_lines(df, keys, number, value, default, total)
    kind = df.schema[number].dataType
    group = Window.partitionBy(*keys)
    place = F.col(number)
    before = F.coalesce(F.lag(number).over(group.orderBy(number)), F.lit(0)).cast("bigint")
    rows = df.filter(place >= 1).select(
        *keys,
        place.cast("bigint").alias("_last"),
        (before + 1).alias("_first"),
        F.max(number).over(group).cast("bigint").alias(total),
        F.col(value).alias("_value"),
    )
    block = F.explode(F.sequence(F.col("_first"), F.col("_last"), F.lit(_BLOCK).cast("bigint")))
    line = F.explode(F.sequence("_block", F.least(F.col("_last"), F.col("_block") + (_BLOCK - 1))))
    dense = rows.withColumn("_block", block).withColumn(number, line)
    own = F.when(F.col(number) == F.col("_last"), F.col("_value"))
    return dense.select(*keys, F.col(number).cast(kind).alias(number), total, F.coalesce(own, F.lit(default)).alias(value))


def _spread_lines(df, keys, number, value, default, total) -> DataFrame:
    spine = (
        df.groupBy(*keys)
        .agg(F.max(number).cast("bigint").alias(total))
        .filter(F.col(total) >= 1)
    )
    blocks = spine.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col(total) - 1) / _BLOCK)))
    )
    # One narrow row per block: spreading them lets many tasks unfold a long line.
    blocks = blocks.repartition(*keys, "_block")
    first = F.col("_block") * _BLOCK + 1
    line = F.sequence(first, F.least(F.col(total), first + (_BLOCK - 1)))
    kind = df.schema[number].dataType
    dense = blocks.withColumn(number, F.explode(line)).drop("_block")
    dense = dense.withColumn(number, F.col(number).cast(kind))
    present = df.select(*keys, number, F.col(value).alias("_value"))
    return dense.join(present, [*keys, number], "left").select(
        *keys, number, total, F.coalesce("_value", F.lit(default)).alias(value)
    )
