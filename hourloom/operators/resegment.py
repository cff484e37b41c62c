"""Stored segments that follow changes of the grid without being rebuilt.

What the segmentation has to know of the past is small: of each entity its segments. A change at some hour can only touch the
segments that end less than the longest bridged gap before it, or later. The one before those is left as it is, and the entity
is segmented again from the start of the first one touched, with the last perfect hour and the number of segments before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MAX_GAP_HOURS
from ..functions import hours_between, null_safe_join
from ..sources import paths
from ..sources.landing import landed
from .grid import ENTITY, TS
from .incremental import day_of
from .publish import DAYS, WHOLE, Output, finish, known_days, publish
from .segments import _left_null_safe, segment

SUMMARY = ("segments_num", "segment_start", "segment_end", "segment_perfect_hours")


def _rows(path: str) -> str:
    return f"{path}/rows"


def _segments(path: str) -> str:
    return f"{path}/segments"


def _summary(rows: DataFrame, entity: str) -> DataFrame:
    """A row for each segment; all rows of a segment agree in what is taken."""
    return rows.groupBy(entity, "segments_num").agg(*[F.min(c).alias(c) for c in SUMMARY[1:]])


def restart_points(segments: DataFrame, changed: DataFrame, entity: str = ENTITY, max_gap_hours: int = MAX_GAP_HOURS) -> DataFrame:
    """For each entity in ``changed`` (and its first changed hour ``since``): where its segmentation starts again (``begin``), the
    last perfect hour before (``_last``), and how many segments stay (``_base``).

    Segments stay that end too early to be continued at the changed hour; all others go.
    """
    first = changed.groupBy(entity).agg(F.min("since").alias("since"))
    both = _left_null_safe(first, segments.select(entity, *SUMMARY[:3]), entity)
    stays = hours_between(F.col("since"), F.col("segment_end")) > max_gap_hours
    return both.groupBy(entity).agg(
        F.least(F.first("since"), F.min(F.when(~stays, F.col("segment_start")))).alias("begin"),
        F.max(F.when(stays, F.col("segment_end"))).alias("_last"),
        F.count(F.when(stays, F.lit(1))).alias("_base"),
    )


def refresh_segments(
    spark: SparkSession, grid: DataFrame, path: str, changed: DataFrame | None = None, entity: str = ENTITY, ts: str = TS,
    grain: str = "day", max_gap_hours: int = MAX_GAP_HOURS, **options,
) -> None:
    """Bring stored segments up to date with the dense ``grid``; ``changed`` says from which hour on (``since``) an entity's
    rows differ from those segmented before. Without it, or without stored segments, everything is built.

    ``changed`` must hold every entity whose rows differ, new ones included; saying too much, or too early an hour, does no
    harm. Of the grid and of the stored rows only dates from the first restart on are read; store the grid by ``grain``
    with that column for it. Dates from there on are replaced, with the rows of other entities as they are. Rows and the summary
    of segments are published together, so a killed refresh is finished by the next one. ``options`` go to :func:`segment`.
    """
    finish(spark, path)
    plain = grid.drop(grain)
    if changed is None or not paths.has_files(spark, path):
        rows = segment(plain, entity, ts, max_gap_hours=max_gap_hours, **options).drop("segments_total")
        rows = rows.withColumn(grain, day_of(ts, grain))
        publish(spark, path, [
            Output(rows, _rows(path), WHOLE, grain, (entity, ts)),
            Output(lambda built: _summary(built[0], entity), _segments(path), WHOLE, None),
        ])
        return
    segments = spark.read.parquet(_segments(path))
    again = landed(restart_points(segments, changed, entity, max_gap_hours), "segment-restarts")
    low = again.agg(day_of(F.min("begin"), grain).alias("low")).first()["low"]
    if low is None:
        return
    recent = grid.filter((F.col(grain) if grain in grid.columns else day_of(ts, grain)) >= F.lit(low)).drop(grain)
    part = null_safe_join(recent, again.select(entity, "begin"), [entity]).filter(F.col(ts) >= F.col("begin")).drop("begin")
    fresh = segment(part, entity, ts, max_gap_hours=max_gap_hours, resume=again.select(entity, "_last", "_base"), **options)
    fresh = fresh.drop("segments_total").withColumn(grain, day_of(ts, grain))

    stored = spark.read.parquet(_rows(path)).filter(F.col(grain) >= F.lit(low))
    own = _left_null_safe(stored, again.select(entity, "begin", F.lit(True).alias("_again")), entity)
    kept = own.filter(F.col("_again").isNull() | (F.col(ts) < F.col("begin"))).select(*fresh.columns)
    old = _left_null_safe(segments, again.select(entity, F.col("_base").alias("_stay")), entity)
    old = old.filter(F.col("_stay").isNull() | (F.col("segments_num") <= F.col("_stay"))).drop("_stay")

    def summary(built: list[DataFrame]) -> DataFrame:
        new = null_safe_join(built[0], again.select(entity, "_base"), [entity]).filter(F.col("segments_num") > F.col("_base"))
        return old.unionByName(_summary(new, entity))

    gone = known_days(spark, path, _rows(path)).filter(F.col("day") >= F.lit(low)).select(F.col("day").alias(grain))
    publish(spark, path, [
        Output(fresh.unionByName(kept), _rows(path), DAYS, grain, (entity, ts), gone=gone),
        Output(summary, _segments(path), WHOLE, None),
    ])


def read_segments(spark: SparkSession, path: str, entity: str = ENTITY, grain: str = "day") -> DataFrame:
    """The stored segments, as :func:`segment` gives them: the number of an entity's segments is not stored with each row."""
    total = spark.read.parquet(_segments(path)).groupBy(entity).agg(F.max("segments_num").alias("segments_total"))
    return null_safe_join(spark.read.parquet(_rows(path)), total, [entity]).drop(grain)
