"""Row numbers and carry-forward, safe for groups of any size.

A plain window puts a whole group into one task. Where groups can be large, pass
`chunk`: columns that never decrease along the ordering (a day, a number range, the
head of a hash). The window then runs inside (group, chunk); what crosses chunks is
one summary row for each, so a group holding a third of all rows is spread over
as many tasks as it has chunks. Results are the same either way.

The summaries of a group's chunks are combined in one task. Where a group can have millions of
chunks, `tree` deals them out by ranges, combines each range by itself, and then the ranges,
of which there are as many as tasks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.session import written


def number_rows(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    name: str = "row_number",
    chunk: dict[str, Column] | None = None,
    tree: bool = False,
) -> DataFrame:
    """1, 2, ... per group in the given (total) order: int, or bigint with a `chunk`'s `tree`."""
    if not chunk:
        return df.withColumn(
            name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        )
    chunked, keys = _chunked(df, group, chunk)
    counts = chunked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    starts = _before(counts, keys, "_n", F.sum, F.sum, tree)
    inside = Window.partitionBy(*keys).orderBy(*order)
    number = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_local")
    return (
        chunked.withColumn("_local", F.row_number().over(inside))
        .join(starts, keys)
        .withColumn(name, number if tree else number.cast("int"))
        .drop("_local", "_before", *keys)
    )


def first_rows(
    df: DataFrame, group: list[str], order: list[Column], n: int, name: str = "row_number"
) -> DataFrame:
    """The first `n` rows of each group, numbered.

    The filter on the row number lets Spark cut every map task's output to `n` rows
    per group before the shuffle, so hot groups stay small.
    """
    numbered = df.withColumn(
        name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    )
    return numbered.filter(F.col(name) <= n)


def carry_forward(
    df: DataFrame,
    value: str,
    group: list[str],
    order: list[str],
    name: str,
    default=None,
    chunk: dict[str, Column] | None = None,
    tree: bool = False,
) -> DataFrame:
    """Latest non-null `value` at or before each row in its group's order."""
    if not chunk:
        running = Window.partitionBy(*group).orderBy(*order)
        latest = _latest(value, running)
        return df.withColumn(name, _or_default(latest, default))
    chunked, keys = _chunked(df, group, chunk)
    # The last value of each chunk; a chunk without one passes on what came before.
    last = F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value))))
    closing = chunked.groupBy(*keys).agg(last.getField(value).alias("_close"))

    def latest(column):
        return F.last(column, ignorenulls=True)

    def latest_of(column):
        place = F.struct(*[k for k in keys if k.startswith("_chunk")], F.col(column).alias("_value"))
        return F.max(F.when(F.col(column).isNotNull(), place)).getField("_value")

    opening = _before(closing, keys, "_close", latest, latest_of, tree)
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        chunked.withColumn("_inside", _latest(value, inside))
        .join(opening, keys)
        .withColumn(name, _or_default(F.coalesce("_inside", "_before"), default))
        .drop("_inside", "_before", *keys)
    )


def number_items(df: DataFrame, items: str, name: str, position: str) -> DataFrame:
    """One row per array item with its position counted from 1."""
    return df.select(
        *[c for c in df.columns if c != items],
        F.posexplode(items).alias("_pos", name),
    ).withColumn("_pos", F.col("_pos") + 1).withColumnRenamed("_pos", position)


def _chunked(df: DataFrame, group: list[str], chunk: dict[str, Column]):
    """Rows with never-null keys for (group, chunk), and their names.

    A null key would be lost in the join with the chunk summaries, so it becomes its
    type's zero with a flag beside it. Nulls come first, as in an ascending sort.
    """
    sources = {f"_group{i}": F.col(name) for i, name in enumerate(group)}
    sources |= {f"_chunk{i}": column for i, column in enumerate(chunk.values())}
    kinds = df.select(*[column.alias(name) for name, column in sources.items()]).schema
    columns = {}
    for field in kinds:
        source = sources[field.name]
        columns[f"{field.name}_known"] = source.isNotNull()
        columns[field.name] = F.coalesce(source, _zero(field.dataType))
    return df.withColumns(columns), list(columns)


def _before(summaries: DataFrame, keys: list[str], value: str, combined, total, tree: bool) -> DataFrame:
    """`_before`: what a group's earlier chunks have come to; `keys` of each chunk.

    `combined` gives that over a window, `total` over all chunks of a range.
    """
    groups = [k for k in keys if k.startswith("_group")]
    chunks = [k for k in keys if k.startswith("_chunk")]

    def earlier(by: list[str], order: list[str], column: str) -> Column:
        window = Window.partitionBy(*by).orderBy(*order)
        return combined(column).over(window.rowsBetween(Window.unboundedPreceding, -1))

    if not tree:
        return summaries.withColumn("_before", earlier(groups, chunks, value)).drop(value)
    # Written, since a range's number must be the same wherever it is read.
    placed = written(
        summaries.repartitionByRange(*groups, *chunks).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    ranges = placed.groupBy(*groups, "_range").agg(total(value).alias("_total"))
    ranges = ranges.withColumn("_ranges", earlier(groups, ["_range"], "_total")).drop("_total")
    inside = placed.withColumn("_inside_range", earlier([*groups, "_range"], chunks, value)).drop(value)
    both = inside.join(ranges, [*groups, "_range"])
    if combined is F.sum:
        known = F.coalesce("_inside_range", F.lit(0)) + F.coalesce("_ranges", F.lit(0))
    else:
        known = F.coalesce("_inside_range", "_ranges")
    return both.withColumn("_before", known).select(*keys, "_before")


def _zero(kind: T.DataType) -> Column:
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    raise TypeError(f"a {kind.simpleString()} column cannot be a chunked key")


def _latest(value: str, window) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(value, ignorenulls=True).over(frame)


def _or_default(column: Column, default) -> Column:
    return column if default is None else F.coalesce(column, F.lit(default))
