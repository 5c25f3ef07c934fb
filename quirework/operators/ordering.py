"""Sorts, top-n and bag union."""

from functools import reduce

from pyspark.sql import Column, DataFrame


def sort_rows(df: DataFrame, *by: str | Column) -> DataFrame:
    """Total order by range partitioning; only for output that is read in order."""
    return df.orderBy(*by)


def top_rows(df: DataFrame, n: int, *by: str | Column) -> DataFrame:
    """The first n rows: each task keeps n, so nothing is sorted globally."""
    return df.orderBy(*by).limit(n)


def union_all(*inputs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, inputs)
