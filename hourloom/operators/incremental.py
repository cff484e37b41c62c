"""Recompute only the days that changed, and replace exactly those partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import EPOCH_WATERMARK, SOURCE_LOOKBACK_DAYS, TARGET_LOOKBACK_DAYS
from ..functions import moment
from ..sources import paths
from .publish import DAYS, WHOLE, Output, finish, known_days, publish

DAY = "day"
_GRAINS = ("day", "month", "year")


def day_of(ts: str | Column, grain: str = DAY) -> Column:
    """The date a row is stored under: its day, or the first day of its month or year."""
    if grain not in _GRAINS:
        raise ValueError(f"grain must be one of {_GRAINS}")
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c) if grain == DAY else F.to_date(F.date_trunc(grain, c))


def _recent(df: DataFrame, ts_col: str, as_of, days: int, grain: str = DAY) -> DataFrame:
    """Rows of the last days. On a table stored by ``grain`` older partitions are not read."""
    bound = moment(as_of, df.schema[ts_col].dataType) - F.expr(f"interval {days} day")
    recent = df.filter(F.col(ts_col) >= bound)
    return recent.filter(F.col(grain) >= day_of(bound, grain)) if grain in df.columns else recent


def watermark(
    target: DataFrame, ts_col: str, updated_col: str, as_of, lookback: int = TARGET_LOOKBACK_DAYS,
    grain: str = DAY,
) -> DataFrame:
    """One row: the newest update among recent target rows, or a date before all data."""
    kind = target.schema[updated_col].dataType
    newest = F.max(updated_col).alias("watermark")
    return _recent(target, ts_col, as_of, lookback, grain).agg(newest).select(
        F.coalesce("watermark", F.lit(EPOCH_WATERMARK).cast(kind)).alias("watermark")
    )


def journal_watermark(known: DataFrame, kind: T.DataType, as_of, lookback: int = TARGET_LOOKBACK_DAYS, grain: str = DAY) -> DataFrame:
    """The watermark by a table's journal (:func:`known_days`): no row of the table is read for it."""
    bound = moment(as_of, kind) - F.expr(f"interval {lookback} day")
    newest = F.max("newest").cast(kind)
    return known.filter(F.col("day") >= day_of(bound, grain)).agg(
        F.coalesce(newest, F.lit(EPOCH_WATERMARK).cast(kind)).alias("watermark")
    )


def changed_days(
    source: DataFrame, target: DataFrame | None, ts_col: str, as_of, updated_col: str = "updated_at",
    target_ts_col: str | None = None, source_lookback: int = SOURCE_LOOKBACK_DAYS,
    target_lookback: int = TARGET_LOOKBACK_DAYS, grain: str = DAY, mark: DataFrame | None = None,
) -> DataFrame:
    """Days holding a recent source row updated at or after the watermark: ``mark``, or else the target's."""
    if mark is None:
        mark = watermark(target, target_ts_col or ts_col, updated_col, as_of, target_lookback, grain)
    return (
        _recent(source, ts_col, as_of, source_lookback, grain)
        .filter(F.col(updated_col) >= mark.scalar())
        .select(day_of(ts_col, grain).alias(grain))
        .distinct()
    )


def rows_of_days(
    source: DataFrame, days: DataFrame, ts_col: str, partition_col: str | None = None,
    grain: str = DAY,
) -> DataFrame:
    """All rows of the given days. On a table stored by day, name its ``partition_col`` to prune.

    ``days`` is distinct, so it can not outgrow the calendar: the broadcast is bounded.
    """
    picked = F.broadcast(days.select(F.col(grain).alias("_day")))
    own = F.col(partition_col) if partition_col else day_of(ts_col, grain)
    return source.join(picked, own == F.col("_day"), "left_semi")


def overwrite_days(
    df: DataFrame, path: str, ts_col: str, sort_cols: Sequence[str] = (), grain: str = DAY
) -> None:
    """Write by day (or coarser ``grain``), replacing only the partitions present in ``df``.

    Rebalancing on the day lets adaptive execution split a crowded day over several tasks and
    join small ones; sorting inside the tasks makes row-group statistics useful.
    """
    out = df.withColumn(grain, day_of(ts_col, grain)).hint("rebalance", F.col(grain))
    keys = [c for c in (*sort_cols, ts_col) if c in df.columns]
    out = out.sortWithinPartitions(grain, *keys)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        grain
    ).parquet(path)


def refresh_days(
    spark: SparkSession, source: DataFrame, path: str,
    build: Callable[[DataFrame], DataFrame], ts_col: str, as_of, target_ts_col: str | None = None,
    updated_col: str = "updated_at", source_lookback: int = SOURCE_LOOKBACK_DAYS,
    target_lookback: int = TARGET_LOOKBACK_DAYS, sort_cols: Sequence[str] = (),
    full: bool = False, grain: str = DAY,
) -> None:
    """Incremental insert-overwrite: rebuild the changed days, or everything without a target.

    Only days of the look-back are considered, so an update to an older day needs ``full=True``,
    as does dropping days that no longer have any source row.

    The rebuilt days are published through the table's journal: a job that is killed leaves the table as it was or is
    finished by the next call, and the watermark is that of the last refresh that went through as a whole. A table that
    has no journal yet is asked for its newest update instead.
    """
    finish(spark, path)
    out = plan_refresh(
        spark, source, path, build, ts_col, as_of, target_ts_col, updated_col, source_lookback, target_lookback, sort_cols, full, grain
    )
    publish(spark, path, [out])


def plan_refresh(
    spark: SparkSession, source: DataFrame, path: str,
    build: Callable[[DataFrame], DataFrame], ts_col: str, as_of, target_ts_col: str | None = None,
    updated_col: str = "updated_at", source_lookback: int = SOURCE_LOOKBACK_DAYS,
    target_lookback: int = TARGET_LOOKBACK_DAYS, sort_cols: Sequence[str] = (),
    full: bool = False, grain: str = DAY,
) -> Output:
    """What :func:`refresh_days` would publish, for publishing it together with other tables."""
    out_ts = target_ts_col or ts_col
    mode, gone = WHOLE, None
    if not full and paths.has_files(spark, path):
        known, target = known_days(spark, path), spark.read.parquet(path)
        kind = target.schema[updated_col].dataType
        mark = None if known is None else journal_watermark(known, kind, as_of, target_lookback, grain)
        days = changed_days(
            source, target, ts_col, as_of, updated_col, out_ts, source_lookback, target_lookback, grain, mark
        ).collect()  # at most one for each day of the look-back
        own = F.col(grain) if grain in source.columns else day_of(ts_col, grain)
        source = source.filter(own.isin([d[0] for d in days]))
        mode, gone = DAYS, spark.createDataFrame(days, f"{grain} date")
    out = build(source)
    out = out.withColumn(grain, day_of(out_ts, grain))
    keys = [c for c in (*sort_cols, out_ts) if c in out.columns]
    # a whole table by month or year has rows of each in every task: gathering them would shuffle the table once more
    return Output(out, path, mode, grain, keys, updated_col, gone, gather=mode == DAYS or grain == DAY)
