"""Checks that return the offending rows: an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS
from ..functions import moment
from ..specs import TableSpec


def check_unique(df: DataFrame, cols: str | Sequence[str], since=None, ts_col: str | None = None):
    """Values (or combinations) that occur more than once, NULLs aside; optionally recent rows only."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if since is not None:
        df = df.filter(F.col(ts_col) >= moment(since, df.schema[ts_col].dataType))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.filter(known).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign key values without a parent, and on how many rows; NULL refers to nothing.

    The child is reduced to its distinct keys before the join, so a key on very many rows costs
    one row there.
    """
    used = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    ids = parent.select(F.col(pk).alias("_pk"))
    return used.join(ids, F.col(fk) == F.col("_pk"), "left_anti")


def check_freshness(
    df: DataFrame, col: str, as_of, warn_h: int = FRESHNESS_WARN_HOURS,
    error_h: int = FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """One row: age of the newest row and pass / warn / error. An empty table is an error."""
    newest = df.agg(F.max(col).alias("max_loaded_at"))
    at = moment(as_of, T.TimestampType())
    age = (F.unix_micros(at) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / 3.6e9
    return newest.withColumn("age_hours", age).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_h), "error")
        .when(F.col("age_hours") > warn_h, "warn")
        .otherwise("pass"),
    )


def check_at_least_one(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Columns that hold no value at all."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    counted = df.agg(*[F.count(c).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n_values"))
          for i, c in enumerate(cols)]
    )
    return counted.select(F.inline(rows)).filter("n_values = 0")


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside the list and on how many rows; NULL is not judged."""
    return (
        df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
        .groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_constraints(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """Violations per declared constraint (key, required columns, foreign keys) of each table given.

    Rows are counted by key, and by each foreign key where it isn't part of the key, in both cases before the shuffle; every
    rule is told from these counts.
    """
    found = []
    for name, df in tables.items():
        spec = specs[name]
        links = [fk for fk in spec.foreign_keys if fk.parent in tables]
        lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.required], F.lit(False))
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.keys])
        keys = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(lacking).alias("_lacking"))
        rules = [F.struct(F.lit(f"unique({', '.join(spec.keys)})").alias("rule"), F.col("_twice").alias("violations"))]
        if spec.required:
            rules.append(F.struct(F.lit("required").alias("rule"), F.col("_short").alias("violations")))
        sums = keys.agg(
            F.count_if(known & (F.col("_rows") > 1)).alias("_twice"), F.coalesce(F.sum("_lacking"), F.lit(0)).cast("long").alias("_short")
        )
        found.append(sums.select(F.lit(name).alias("table_name"), F.inline(F.array(*rules))))
        for fk in links:
            counted = keys if fk.column in spec.keys else df.withColumn("_rows", F.lit(1))
            used = counted.filter(F.col(fk.column).isNotNull()).groupBy(fk.column).agg(F.sum("_rows").alias("_rows"))
            ids = tables[fk.parent].select(F.col(fk.parent_column).alias("_pk"))
            broken = used.join(ids, F.col(fk.column) == F.col("_pk"), "left_anti")
            found.append(
                broken.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("violations")).select(
                    F.lit(name).alias("table_name"), F.lit(f"{fk.column} -> {fk.parent}.{fk.parent_column}").alias("rule"), "violations"
                )
            )
    return reduce(DataFrame.unionByName, found)
