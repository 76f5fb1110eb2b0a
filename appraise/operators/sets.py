"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union aligned by column name; a column missing on one side is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value) pairs for the given columns, values as text."""
    present = [c for c in cols if c in df.columns]
    return df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                            for c in present])).alias("_kv")
    ).select("_kv.*")


def values_only_in(df: DataFrame, side_col: str, side: str, other: str, cols: list[str]) -> DataFrame:
    """Per column, the distinct values present on ``side`` but never on ``other`` (EXCEPT).

    Both sides are reduced to distinct (column, value) pairs first, so the
    anti-join shuffles distinct values, not rows.
    """
    a = long_values(df.filter(F.col(side_col) == side), cols).distinct()
    b = long_values(df.filter(F.col(side_col) == other), cols).distinct()
    return a.join(b, ["column_name", "value"], "left_anti")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column in ascending order."""
    return df.select(col).distinct().orderBy(col)
