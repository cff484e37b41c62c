"""Gaps and islands over an hourly grid: stretches held together by "perfect" hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    GOLD_HOURS, MAX_GAP_HOURS, MAX_SERIES_GAP_HOURS, PERFECT_SENSORS, SILVER_HOURS,
)
from ..functions import hours_between, null_safe_join, segment_tier
from ..sources.landing import landed
from .grid import CONCURRENT, ENTITY, TS


def perfect_flag(concurrent: str = CONCURRENT, perfect: int = PERFECT_SENSORS) -> Column:
    """1 when exactly ``perfect`` readings are present, else 0."""
    return F.coalesce((F.col(concurrent) == perfect).cast("int"), F.lit(0))


def track_perfect_hours(
    grid: DataFrame, entity: str = ENTITY, ts: str = TS, concurrent: str = CONCURRENT,
    perfect: int = PERFECT_SENSORS,
) -> DataFrame:
    """Per grid row: perfect or not, the entity's first perfect hour, the previous one, the distance."""
    whole = Window.partitionBy(entity)
    before = whole.orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    hit = F.when(F.col("is_perfect_hour") == 1, F.col(ts))
    return (
        grid.withColumn("is_perfect_hour", perfect_flag(concurrent, perfect))
        .withColumn("last_perfect_hour", F.last(hit, ignorenulls=True).over(before))
        .withColumn("first_perfect_hour", F.min(hit).over(whole))
        .withColumn("hours_since_last", hours_between(F.col(ts), F.col("last_perfect_hour")))
    )


def _inside(max_gap: int) -> Column:
    """Rows of a segment or of a gap short enough to bridge.

    Hours before the first perfect one have no distance and are not perfect, so they drop out.
    """
    return (F.col("is_perfect_hour") == 1) | (F.col("hours_since_last") <= max_gap)


def _starts(max_gap: int) -> Column:
    return (
        F.when(F.col("last_perfect_hour").isNull(), 1)
        .when((F.col("is_perfect_hour") == 1) & (F.col("hours_since_last") > max_gap), 1)
        .otherwise(0)
    )


def shatter(tracked: DataFrame, entity: str = ENTITY, ts: str = TS, max_gap_hours: int = MAX_GAP_HOURS):
    """Mark where a new segment starts and number the segments; rows in long gaps are dropped first."""
    running = Window.partitionBy(entity).orderBy(ts)
    return (
        tracked.withColumn("is_new_segment", _starts(max_gap_hours))
        .filter(_inside(max_gap_hours))
        .withColumn("segments_num", F.sum("is_new_segment").over(running))
    )


_ATTRIBUTES = (
    "segment_id", "segment_start", "segment_end", "segment_perfect_hours",
    "segment_total_hours", "segment_perfect_density", "segment_tier", "segments_num",
    "segments_total",
)


def _describe(df: DataFrame, columns: Sequence[str], entity: str, gold: int, silver: int):
    """Derived attributes, once start, end, perfect hours and total of each segment are known."""
    hours = hours_between(F.col("segment_end"), F.col("segment_start")) + 1
    return (
        df.withColumn(
            "segment_id",
            F.concat(F.col(entity).cast("string"), F.lit("_S"), F.col("segments_num").cast("string")),
        )
        .withColumn("segment_total_hours", hours)
        .withColumn(
            "segment_perfect_density",
            F.try_divide(F.col("segment_perfect_hours"), F.col("segment_total_hours")),
        )
        .withColumn("segment_tier", segment_tier(F.col("segment_total_hours"), gold, silver))
        .select(*columns, *_ATTRIBUTES)
    )


def segment(
    grid: DataFrame, entity: str = ENTITY, ts: str = TS, concurrent: str = CONCURRENT,
    perfect: int = PERFECT_SENSORS, max_gap_hours: int = MAX_GAP_HOURS,
    gold_hours: int = GOLD_HOURS, silver_hours: int = SILVER_HOURS, chunk: str | None = None,
    resume: DataFrame | None = None,
) -> DataFrame:
    """Segments of a dense grid: one row per hour kept, with the attributes of its segment.

    A segment runs from a perfect hour to a perfect hour and bridges at most ``max_gap_hours``
    between two of them. On a dense grid every entity holds exactly the hours of the spine, so
    no entity can outweigh another; the whole chain then needs a single shuffle on the entity.
    For few entities with very long or very fine series pass ``chunk`` (``"month"``, ``"day"``):
    work is then spread over (entity, chunk); summaries of chunks meet per entity and span of time, and
    summaries of spans per entity, so no task holds more than a chunk, the chunks of a span, or the spans of an entity.

    ``resume`` continues earlier segments: a row per entity with its last perfect hour before the grid (``_last``) and
    how many segments it has there (``_base``). The grid must then start with a segment or beyond ``max_gap_hours``.
    """
    kept = [c for c in grid.columns if c not in (entity, ts, concurrent)]
    columns = [entity, ts, "hours_since_last", concurrent, "is_new_segment", *kept]
    if chunk:
        numbered = _numbered_by_chunk(grid, entity, ts, concurrent, perfect, max_gap_hours, chunk, resume)
    else:
        tracked = track_perfect_hours(grid, entity, ts, concurrent, perfect)
        if resume is not None:
            tracked = _left_null_safe(tracked, resume, entity)
            tracked = tracked.withColumn("last_perfect_hour", F.coalesce("last_perfect_hour", "_last"))
            tracked = tracked.withColumn("hours_since_last", hours_between(F.col(ts), F.col("last_perfect_hour")))
        numbered = shatter(tracked, entity, ts, max_gap_hours)
        if resume is not None:
            numbered = numbered.withColumn("segments_num", F.col("segments_num") + F.coalesce("_base", F.lit(0)))
        own, whole = Window.partitionBy(entity, "segments_num"), Window.partitionBy(entity)
        hit = F.when(F.col("is_perfect_hour") == 1, F.col(ts))
        # the first row of a segment is perfect and its end is its last perfect hour, so these
        # can be taken before the imperfect tail is cut; numbers run 1..n without holes
        numbered = numbered.select(
            "*",
            F.max("segments_num").over(whole).alias("segments_total"),
            F.min(ts).over(own).alias("segment_start"),
            F.max(hit).over(own).alias("segment_end"),
            F.sum("is_perfect_hour").over(own).alias("segment_perfect_hours"),
        )
    trimmed = numbered.filter(F.col(ts) <= F.col("segment_end"))
    return _describe(trimmed, columns, entity, gold_hours, silver_hours)


#: The span of time whose chunks meet in one window.
_SPANS = {"hour": "month", "day": "year", "week": "year", "month": "year", "quarter": "year"}


def _left_null_safe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    own = right.withColumnRenamed(key, "_r_key")
    return left.join(own, F.col(key).eqNullSafe(F.col("_r_key")), "left").drop("_r_key")


def _numbered_by_chunk(grid, entity, ts, concurrent, perfect, max_gap, chunk, resume=None) -> DataFrame:
    """Segment numbers and bounds from windows over (entity, chunk) and a small summary of runs.

    A run is a stretch of one chunk from a perfect hour to the next break, or the hours before the
    first perfect one. Runs are summarised to a row each, which are kept in the shared folder: they say
    which ones continue a segment begun in an earlier chunk.
    """
    part = Window.partitionBy(entity, "_chunk").orderBy(ts)
    before = part.rowsBetween(Window.unboundedPreceding, -1)
    is_perfect = F.col("is_perfect_hour") == 1
    hit = F.when(is_perfect, F.col(ts))
    distance = hours_between(F.col(ts), F.col("_local_last"))
    opens_run = F.when(is_perfect & (F.col("_local_last").isNull() | (distance > max_gap)), 1)
    local = (
        grid.withColumn("is_perfect_hour", perfect_flag(concurrent, perfect))
        .withColumn("_chunk", F.date_trunc(chunk, ts))
        .withColumn("_local_last", F.last(hit, ignorenulls=True).over(before))
        .withColumn("_run", F.coalesce(F.sum(opens_run.otherwise(0)).over(part), F.lit(0)))
    )
    runs = local.groupBy(entity, "_chunk", "_run").agg(F.min(hit).alias("_first"), F.max(hit).alias("_last"), F.sum("is_perfect_hour").alias("_n"))
    runs = number_runs(landed(runs, "segment-runs"), entity, max_gap, _SPANS.get(chunk, "year"), resume)
    return (
        null_safe_join(local, runs, [entity, "_chunk", "_run"])
        .withColumn("last_perfect_hour", F.coalesce("_local_last", "_carry"))
        .withColumn("hours_since_last", hours_between(F.col(ts), F.col("last_perfect_hour")))
        .withColumn("is_new_segment", _starts(max_gap))
        .filter(_inside(max_gap))
    )


def number_runs(runs: DataFrame, entity: str, max_gap: int, span: str, resume: DataFrame | None = None) -> DataFrame:
    """Runs (entity, _chunk, _run, _first, _last, _n) with the number, bounds and perfect hours of the segment they are part of.

    What a stretch of time means for its neighbours is its first and last perfect hour and how many segments it opens. This
    summary is combined upwards, chunks to spans and spans to the entity, and what lies before each part is pushed back down:
    its last perfect hour (``_carry``), which tells whether its first run continues a segment, and the number of segments.
    Neither level holds more rows than the part above has parts; an entity's runs or chunks never meet in one task.
    """
    chunks = runs.groupBy(entity, "_chunk").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.count("_first").alias("_runs")
    ).withColumn("_span", F.date_trunc(span, "_chunk"))
    in_span = Window.partitionBy(entity, "_span").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    in_entity = Window.partitionBy(entity).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)

    ends = chunks.groupBy(entity, "_span").agg(F.max("_last").alias("_end"))
    earlier = F.last("_end", ignorenulls=True).over(in_entity)
    if resume is not None:
        ends, earlier = _left_null_safe(ends, resume.select(entity, F.col("_last").alias("_resumed")), entity), F.coalesce(earlier, "_resumed")
    ends = ends.select(entity, "_span", earlier.alias("_earlier"))
    chunks = null_safe_join(chunks, ends, [entity, "_span"])
    chunks = chunks.withColumn("_carry", F.coalesce(F.last("_last", ignorenulls=True).over(in_span), "_earlier"))
    joins = F.coalesce((hours_between(F.col("_first"), F.col("_carry")) <= max_gap).cast("int"), F.lit(0))
    chunks = chunks.withColumn("_joins", joins).withColumn("_opens", F.col("_runs") - F.col("_joins"))

    opened = chunks.groupBy(entity, "_span").agg(F.sum("_opens").alias("_total"))
    base = F.coalesce(F.sum("_total").over(in_entity), F.lit(0))
    if resume is not None:
        opened, base = _left_null_safe(opened, resume.select(entity, "_base"), entity), base + F.coalesce("_base", F.lit(0))
    opened = opened.select(entity, "_span", base.alias("_before_span"))
    chunks = null_safe_join(chunks, opened, [entity, "_span"])
    chunks = chunks.withColumn("_before", F.col("_before_span") + F.coalesce(F.sum("_opens").over(in_span), F.lit(0)))

    number = F.col("_before") + F.when(F.col("_run") > 0, F.col("_run") - F.col("_joins")).otherwise(0)
    numbered = null_safe_join(runs, chunks.select(entity, "_chunk", "_carry", "_before", "_joins"), [entity, "_chunk"])
    numbered = numbered.select(entity, "_chunk", "_run", "_carry", "_first", "_last", "_n", number.alias("segments_num"))
    whole = numbered.groupBy(entity, "segments_num").agg(
        F.min("_first").alias("segment_start"), F.max("_last").alias("segment_end"), F.sum("_n").alias("segment_perfect_hours")
    )
    totals = numbered.groupBy(entity).agg(F.max("segments_num").alias("segments_total"))
    numbered = null_safe_join(numbered.drop("_first", "_last", "_n"), whole, [entity, "segments_num"])
    return null_safe_join(numbered, totals, [entity])


def segment_by_series(
    grid: DataFrame, value_cols: Sequence[str], entity: str = ENTITY, ts: str = TS,
    concurrent: str = CONCURRENT, perfect: int = PERFECT_SENSORS,
    max_gap_hours: int = MAX_SERIES_GAP_HOURS, gold_hours: int = GOLD_HOURS,
    silver_hours: int = SILVER_HOURS, chunk: str | None = None,
) -> DataFrame:
    """The second strategy: the distance is that of the series silent for longest.

    Each series remembers its own last reading. A row opens a segment while the leading series
    (the first of ``value_cols``) has not reported yet; later rows stay while no series has been
    silent for more than ``max_gap_hours``. ``chunk`` spreads the work as in :func:`segment`.
    """
    w = Window.partitionBy(entity).orderBy(ts)
    hit = {c: F.when(F.col(c).isNotNull(), F.col(ts)) for c in value_cols}
    if chunk:
        grid = _last_by_chunk(grid, hit, entity, ts, chunk)
    else:
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        grid = grid.select("*", *[F.last(e, ignorenulls=True).over(before).alias(f"_last_{c}") for c, e in hit.items()])
    lead = f"_last_{value_cols[0]}"
    silence = [
        F.coalesce(hours_between(F.col(ts), F.col(f"_last_{c}")), F.lit(0)) for c in value_cols
    ]
    widest = F.greatest(*silence) if len(silence) > 1 else silence[0]
    unseen = F.col(lead).isNull()
    kept = [c for c in grid.columns if c not in (entity, ts, concurrent, "_chunk") and not c.startswith("_last_")]
    own, whole = Window.partitionBy(entity, "segments_num"), Window.partitionBy(entity)
    marked = (
        grid.withColumn("hours_since_last", widest)
        .withColumn(
            "is_new_segment",
            F.when(unseen | (F.col("hours_since_last") > max_gap_hours), 1).otherwise(0),
        )
        .filter((F.col("hours_since_last") <= max_gap_hours) | unseen)
        .withColumn("is_perfect_hour", perfect_flag(concurrent, perfect))
    )
    columns = [entity, ts, "hours_since_last", concurrent, "is_new_segment", *kept]
    if chunk:
        return _describe(_totals_by_chunk(marked, entity, ts), columns, entity, gold_hours, silver_hours)
    numbered = marked.withColumn("segments_num", F.sum("is_new_segment").over(w)).select(
        "*",
        F.max("segments_num").over(whole).alias("segments_total"),
        F.min(ts).over(own).alias("segment_start"),
        F.max(ts).over(own).alias("segment_end"),
        F.sum("is_perfect_hour").over(own).alias("segment_perfect_hours"),
    )
    return _describe(numbered, columns, entity, gold_hours, silver_hours)


def _last_by_chunk(grid: DataFrame, hit, entity: str, ts: str, chunk: str) -> DataFrame:
    """The last reading of each series before a row: from its own chunk, else from a row per chunk."""
    local = grid.withColumn("_chunk", F.date_trunc(chunk, ts))
    before = Window.partitionBy(entity, "_chunk").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(entity).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = local.groupBy(entity, "_chunk").agg(*[F.max(e).alias(f"_end_{c}") for c, e in hit.items()])
    carry = ends.select(
        entity, "_chunk", *[F.last(f"_end_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in hit]
    )
    local = local.select("*", *[F.last(e, ignorenulls=True).over(before).alias(f"_own_{c}") for c, e in hit.items()])
    out = null_safe_join(local, carry, [entity, "_chunk"])
    return out.withColumns({f"_last_{c}": F.coalesce(f"_own_{c}", f"_carry_{c}") for c in hit}).drop(
        *[f"_{n}_{c}" for c in hit for n in ("own", "carry")]
    )


def _totals_by_chunk(marked: DataFrame, entity: str, ts: str) -> DataFrame:
    """Numbers and bounds of segments from running sums inside chunks and a row per chunk or segment."""
    running = Window.partitionBy(entity, "_chunk").orderBy(ts)
    earlier = Window.partitionBy(entity).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    opened = marked.groupBy(entity, "_chunk").agg(F.sum("is_new_segment").alias("_n")).select(
        entity, "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    numbered = null_safe_join(marked.withColumn("_own", F.sum("is_new_segment").over(running)), opened, [entity, "_chunk"])
    numbered = numbered.withColumn("segments_num", F.col("_own") + F.col("_before"))
    totals = numbered.groupBy(entity, "segments_num").agg(
        F.min(ts).alias("segment_start"), F.max(ts).alias("segment_end"), F.sum("is_perfect_hour").alias("segment_perfect_hours")
    )
    totals = totals.withColumn("segments_total", F.max("segments_num").over(Window.partitionBy(entity)))
    return null_safe_join(numbered, totals, [entity, "segments_num"])
