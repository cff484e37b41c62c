"""Set very large groups apart, so that none is ever brought together in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MOST_GROUPS = 10_000


def hot_groups(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys (named ``_key``) of very large groups, with aggregates of the whole group.

    A group counts as large above ``hot_rows`` rows and above 1 / MOST_GROUPS of all rows, so there are
    MOST_GROUPS at most however large the input is, and the result may be broadcast. Results must not
    depend on which groups these are.
    """
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    share = totals.agg(F.coalesce(F.sum("_rows"), F.lit(0)) / MOST_GROUPS).scalar()
    large = (F.col("_rows") > hot_rows) & (F.col("_rows") > share)
    return F.broadcast(totals.filter(large).drop("_rows").withColumnsRenamed({k: f"_{k}" for k in keys}))


def same_group(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def outside(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(hot.select(*[f"_{k}" for k in keys]), same_group(keys), "left_anti")


def inside(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of hot groups with the aggregates of their group, without a shuffle."""
    return df.join(hot, same_group(keys), "inner").drop(*[f"_{k}" for k in keys])
