"""Projections: conform, rename, compute, fill, stamp."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Keep, order and cast exactly the schema's columns.

    A value that cannot be cast fails the job; with `strict=False` it becomes
    null, and `cast_rejects` tells how many did.
    """
    return df.select(*[_cast(f, strict).alias(f.name) for f in schema])


def cast_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per column, how many non-null values the cast turns into null."""
    return df.select(
        *[
            F.count_if(
                F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            ).alias(f.name)
            for f in schema
        ]
    )


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def subset(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def compute(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns in a single projection."""
    return df.withColumns(columns)


def compute_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a column that is costly to compute and used by later filters.

    A filter on a plain computed column is pushed below it, and the expression is
    then computed for the filter and once more for the output, doubling at each
    step of a chain. Filters are not pushed below a one-item explode.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(expression)).alias(name))


def fill_text(df: DataFrame, *names: str, value: str = "") -> DataFrame:
    return df.fillna(value, list(names))


def stamp_date(df: DataFrame, name: str, as_of: str | None = None) -> DataFrame:
    """Processing date; `as_of` (ISO date) makes a run reproducible."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return df.withColumn(name, day)


def stamp_time(df: DataFrame, name: str, as_of: str | None = None) -> DataFrame:
    """Processing time as ISO text; `as_of` makes a run reproducible."""
    now = F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
    )
    return df.withColumn(name, F.lit(as_of) if as_of else now)


def _cast(field: T.StructField, strict: bool) -> Column:
    column = F.col(field.name)
    return column.cast(field.dataType) if strict else column.try_cast(field.dataType)
