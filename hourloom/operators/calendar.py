"""Hour spines and calendar periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import moment

_NTZ = T.TimestampNTZType()


def hourly_spine(
    spark: SparkSession, start, end, step: str = "1 hour", col: str = "datetimeto_utc",
    kind: T.DataType = T.TimestampType(),
) -> DataFrame:
    """Every step from ``start`` to ``end``, both included. ``end`` is explicit so reruns agree."""
    bounds = spark.range(1).select(
        moment(start, kind).alias("a"), moment(end, kind).alias("b")
    )
    return bounds.select(F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias(col))


def spine_of(df: DataFrame, ts_col: str, step: str = "1 hour", col: str = "datetimeto_utc"):
    """The spine that spans a table: one pass for the two ends, then the hours between."""
    kind = df.schema[ts_col].dataType
    ends = df.agg(F.min(ts_col).alias("a"), F.max(ts_col).alias("b")).select(
        F.date_trunc("HOUR", "a").cast(kind).alias("a"),
        F.date_trunc("HOUR", "b").cast(kind).alias("b"),
    )
    return ends.select(F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias(col))


def hours_covered(ts_min: Column, ts_max: Column) -> Column:
    """Length of an hourly index from the first to the last moment, both ends counted."""
    return (
        F.floor((F.unix_seconds(ts_max.cast("timestamp")) - F.unix_seconds(ts_min.cast("timestamp")))
                / F.lit(3600)) + 1
    ).cast("long")


_MONTHS = {"month": 1, "quarter": 3}


def periods_of(years: DataFrame, year_col: str = "year", grain: str = "month") -> DataFrame:
    """Months or quarters of each year as (year, period, start, end); the last second is included."""
    if grain not in _MONTHS:
        raise ValueError(f"grain must be one of {sorted(_MONTHS)}")
    n = _MONTHS[grain]
    numbered = years.select(
        F.col(year_col).cast("int").alias("year"),
        F.explode(F.sequence(F.lit(1), F.lit(12 // n))).alias("period"),
    )
    first = F.make_date(F.col("year"), (F.col("period") - 1) * n + 1, F.lit(1))
    return numbered.select(
        "year",
        "period",
        first.cast(_NTZ).alias("period_start"),
        (F.add_months(first, n).cast(_NTZ) - F.expr("interval 1 second")).alias("period_end"),
    )


def periods(spark: SparkSession, year: int, grain: str = "month") -> DataFrame:
    return periods_of(spark.range(1).select(F.lit(year).alias("year")), "year", grain)


def period_label(ts: Column, pattern: str = "yyyy-MM") -> Column:
    return F.date_format(ts, pattern)
