"""Aggregations that combine map-side before any row is shuffled."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.operators.windows import first_rows, number_rows


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row per key in the given (total) order.

    Unlike `dropDuplicates` it never picks an arbitrary row.
    """
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    return first_rows(df, keys, by, 1, "_first").drop("_first")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows; of rows that differ under one key, the smallest stays.

    Repeats vanish map-side in the first step, so the second one sees about one row
    per key.
    """
    others = [c for c in df.columns if c != key]
    smallest = F.min(F.struct(*others)).alias("_row")
    unique = df.distinct().groupBy(key).agg(smallest)
    return unique.select(*[key if c == key else f"_row.{c}" for c in df.columns])


def first_non_null(
    df: DataFrame, keys: list[str], value: str, order: str, fallback: Column | None = None
) -> DataFrame:
    """First non-null value per key along `order`, else `fallback`."""
    found = F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))
    picked = df.groupBy(*keys).agg(found.alias(value))
    if fallback is None:
        return picked
    return picked.withColumn(value, F.coalesce(F.col(value), fallback))


def pivot_slots(
    df: DataFrame, keys: list[str], slot: str, slots: list, value: str, prefix: str
) -> DataFrame:
    """One column per slot holding that slot's value; other slots are ignored.

    Equal to a pivot with a fixed value list and `first`, which skips nulls.
    """
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(slot) == s, F.col(value))).alias(f"{prefix}{s}")
            for s in slots
        ]
    )


def ordered_collect(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    value: str,
    position: str = "position",
    chunk: dict[str, Column] | None = None,
) -> DataFrame:
    """Values of each group in order, in long form: (keys, position, value), from 1.

    The same shape for a group of any size, so no array holds an unbounded group.
    `chunk` is for groups that may be hot; see `number_rows`. A bounded number of slots
    as columns comes from `first_rows` and `pivot_slots`.
    """
    return number_rows(df, keys, order, position, chunk).select(*keys, position, value)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows), one row per table; a parquet count reads no columns."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def group_max(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def category_maps(df: DataFrame, keys: list[str], category: str, name: str) -> DataFrame:
    """(keys, map<category, count>) of all categories that occur; nulls aren't counted.

    Rows are counted by key and category first, so a map is put together from one row
    for each category.
    """
    pairs = F.collect_list(F.struct(category, F.col("_n").cast("int")))
    return category_rows(df, keys, category, "_n").groupBy(*keys).agg(F.map_from_entries(pairs).alias(name))


def category_rows(df: DataFrame, keys: list[str], category: str, name: str = "n") -> DataFrame:
    """(keys, category, count): the distribution in long form, for open categories."""
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(*keys, category)
        .agg(F.count(F.lit(1)).alias(name))
    )


def frequency(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def term_coverage(df: DataFrame, keys: list[str], terms: Column) -> DataFrame:
    """Distinct and total terms per group.

    Terms are counted per (group, term) first, which spreads a hot group over all
    of its terms; only then are they added up per group.
    """
    per_term = (
        df.select(*keys, F.explode_outer(terms).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("term").alias("_n"))
    )
    return per_term.groupBy(*keys).agg(
        F.count("term").alias("distinct_terms"), F.sum("_n").alias("total_terms")
    )


def run_audit(stages: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(stage, status, n_rows): how many records each stage saw, by status."""
    counted = [
        df.groupBy(F.col(status).alias("status"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(stage).alias("stage"), "status", "n_rows")
        for stage, (df, status) in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)
