"""Reports over segments. Each works from pre-aggregated rows and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    AVERAGE_RANK_LIMIT, DURATION_STEPS, GAP_RANGE_HOURS, HISTOGRAM_BINS, PERFECT_SENSORS,
)
from ..functions import density_band, hours_between, moment, null_safe_join
from .calendar import hours_covered
from .grid import CONCURRENT, ENTITY, TS


def gold(seg: DataFrame) -> DataFrame:
    return seg.filter(F.col("segment_tier") == "gold")


def tier_summary(
    seg: DataFrame, value_cols: Sequence[str], min_density: float | None = None,
    entity: str = ENTITY,
) -> DataFrame:
    """Rows, missing values, their ratio to rows, and segments per tier, and over ``all``."""
    if min_density is not None:
        seg = seg.filter(F.col("segment_perfect_density") >= min_density)
    empty = sum((F.col(c).isNull().cast("int") for c in value_cols), F.lit(0))
    # grouping by the entity too lets this reuse the partitioning of the segmentation
    per_segment = seg.groupBy(entity, "segment_id", "segment_tier").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(empty).alias("_nulls")
    )
    # a segment has one tier, so counting the segment rows counts distinct segments
    return (
        per_segment.rollup("segment_tier")
        .agg(
            F.sum("_rows").alias("row_count"),
            F.sum("_nulls").alias("null_count"),
            F.count(F.lit(1)).alias("segment_count"),
            F.grouping("segment_tier").alias("_all"),
        )
        .select(
            F.when(F.col("_all") == 1, "all").otherwise(F.col("segment_tier")).alias("segment_tier"),
            "row_count",
            "null_count",
            F.try_divide("null_count", "row_count").alias("null_ratio"),
            "segment_count",
        )
    )


def segment_boundaries(seg: DataFrame, entity: str = ENTITY, ts: str = TS) -> DataFrame:
    return seg.groupBy(entity, "segment_id", "segments_num").agg(
        F.min(ts).alias("segment_start"), F.max(ts).alias("segment_end")
    )


def overlapping_segments(
    bounds: DataFrame, entity: str = ENTITY, chunk: str | None = None
) -> DataFrame:
    """Segments that start before the previous one of their location has ended. Empty is good.

    Segments of a location are few. For other intervals, of which one entity may hold very many,
    ``chunk`` (``"month"``) compares inside (entity, chunk of the start) and takes the interval
    before the first one of a chunk from a summary row per chunk.
    """
    by = ["segment_start", "segment_end", "segment_id"]
    previous = F.lag("segment_end")
    if chunk is None:
        before = bounds.withColumn("prev_segment_end", previous.over(Window.partitionBy(entity).orderBy(*by)))
    else:
        parted = bounds.withColumn("_chunk", F.date_trunc(chunk, "segment_start"))
        inside = Window.partitionBy(entity, "_chunk").orderBy(*by)
        last = F.max_by("segment_end", F.struct(*by))
        summary = (
            parted.groupBy(entity, "_chunk").agg(last.alias("_last"))
            .withColumn("_carry", F.lag("_last").over(Window.partitionBy(entity).orderBy("_chunk")))
            .drop("_last")
        )
        first = F.row_number().over(inside) == 1
        before = (
            parted.select("*", previous.over(inside).alias("_prev"), first.alias("_opens"))
            .transform(null_safe_join, summary, [entity, "_chunk"])
            .withColumn("prev_segment_end", F.when(F.col("_opens"), F.col("_carry")).otherwise(F.col("_prev")))
            .select(*bounds.columns, "prev_segment_end")
        )
    return (
        before.withColumn(
            "hours_since_prev_segment_end",
            hours_between(F.col("segment_start"), F.col("prev_segment_end")),
        )
        .withColumn(
            "is_overlapping",
            F.coalesce(F.col("segment_start") < F.col("prev_segment_end"), F.lit(False)),
        )
        .filter("is_overlapping")
    )


def duration_report(
    seg: DataFrame, hours: Sequence[int] = DURATION_STEPS, entity: str = ENTITY, ts: str = TS
) -> DataFrame:
    """Hours and number of segments at least so long, against what full coverage would hold.

    The row with ``min_hours`` 0 covers all segments.
    """
    one = seg.groupBy(entity, "segment_id").agg(
        F.max("segment_total_hours").alias("_h"), F.min(ts).alias("_a"), F.max(ts).alias("_b")
    )
    steps = [0, *hours]
    wide = one.agg(
        (hours_covered(F.min("_a"), F.max("_b")) * F.countDistinct(entity)).alias("maximum_potential"),
        F.count(F.lit(1)).alias("total_segments"),
        *[F.coalesce(F.sum(F.when(F.col("_h") >= s, F.col("_h"))), F.lit(0)).alias(f"_h{s}") for s in steps],
        *[F.count_if(F.col("_h") >= s).alias(f"_n{s}") for s in steps],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("min_hours"),
                F.col(f"_h{s}").alias("total_hours"),
                F.col(f"_n{s}").alias("segment_count"),
            )
            for s in steps
        ]
    )
    return wide.select("maximum_potential", "total_segments", F.inline(rows)).select(
        "min_hours", "total_hours", "maximum_potential",
        F.try_divide("total_hours", "maximum_potential").alias("hours_share"),
        "segment_count", "total_segments",
        F.try_divide("segment_count", "total_segments").alias("segment_share"),
    )


def density_histogram(
    seg: DataFrame, bins: int = HISTOGRAM_BINS, entity: str = ENTITY
) -> DataFrame:
    """Segments per density bin: equal bins over the observed range, the last one closed.

    When all densities are equal the range is widened by a half on each side.
    """
    one = seg.groupBy(entity, "segment_id").agg(F.max("segment_perfect_density").alias("_d"))
    one = one.filter(F.col("_d").isNotNull())
    span = one.agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"))
    half = F.when(F.col("_lo") == F.col("_hi"), 0.5).otherwise(0.0)
    edge = span.select((F.col("_lo") - half).alias("_lo"), (F.col("_hi") + half).alias("_hi"))
    # the ends travel with the rows from here on, so the segments are planned once for them and once for the counts
    ended = one.select("_d", edge.select(F.struct("_lo", "_hi")).scalar().alias("_e"))
    lo, hi = F.col("_e._lo"), F.col("_e._hi")
    hits = (
        ended.select(F.least(F.width_bucket(F.col("_d"), lo, hi, F.lit(bins)), F.lit(bins)).cast("int").alias("bin"), "_e")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_e").alias("_e"))
    )
    # no more than ``bins`` rows meet here
    whole = hits.agg(F.map_from_entries(F.collect_list(F.struct("bin", "_n"))).alias("_counts"), F.first("_e").alias("_e"))
    width = (hi - lo) / bins
    return whole.filter(F.col("_e").isNotNull()).select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")).select(
        "bin",
        (lo + width * (F.col("bin") - 1)).alias("bin_start"),
        (lo + width * F.col("bin")).alias("bin_end"),
        F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0)).alias("segment_count"),
    )


def segment_timeline(
    seg: DataFrame, date_from=None, date_to=None, entity: str = ENTITY, ts: str = TS
) -> DataFrame:
    """Gold segments with start, length and density band, and how many the location has.

    ``date_from`` is included, ``date_to`` is not.
    """
    kind = seg.schema[ts].dataType
    if date_from is not None:
        seg = seg.filter(F.col(ts) >= moment(date_from, kind))
    if date_to is not None:
        seg = seg.filter(F.col(ts) < moment(date_to, kind))
    one = gold(seg).groupBy(entity, "segment_id").agg(
        F.min("segment_start").alias("segment_start"),
        F.max("segment_total_hours").alias("segment_total_hours"),
        F.max("segment_perfect_density").alias("segment_perfect_density"),
        F.max("segments_total").alias("_total"),
    )
    per_location = Window.partitionBy(entity)  # no more rows than the location has segments
    return one.select(
        entity, "segment_id", "segment_start", "segment_total_hours", "segment_perfect_density",
        density_band(F.col("segment_perfect_density")).alias("density_band"),
        F.count(F.lit(1)).over(per_location).alias("gold_segments"),
        F.max("_total").over(per_location).alias("segments_total"),
    )


def rank_by_perfect_hours(
    seg: DataFrame, locations: DataFrame, perfect: int = PERFECT_SENSORS, entity: str = ENTITY
) -> DataFrame:
    """Gold rows per location: perfect hours, hours, their ratio, and where it is; best first."""
    ranked = gold(seg).groupBy(entity).agg(
        F.count_if(F.col(CONCURRENT) == perfect).alias("location_perfect_hours"),
        F.count(F.lit(1)).alias("location_total_hours"),
    )
    where = locations.select(entity, "location_latitude", "location_longitude").distinct()
    return (
        ranked.withColumn(
            "location_perfect_density",
            F.try_divide("location_perfect_hours", "location_total_hours"),
        )
        .join(where, entity, "inner")
        .orderBy(F.desc("location_perfect_hours"), entity)
    )


def unpivot_values(
    df: DataFrame, value_cols: Sequence[str], keep: Sequence[str] = (ENTITY,),
    name: str = "sensor_name", value: str = "value",
) -> DataFrame:
    """Wide values to (name, value) rows; missing values give no row."""
    return df.unpivot(list(keep), list(value_cols), name, value).filter(F.col(value).isNotNull())


def mean_by_parameter(seg: DataFrame, value_cols: Sequence[str], entity: str = ENTITY) -> DataFrame:
    """Mean gold value per location and parameter; a parameter without values gives no row.

    Averaged while wide and unpivoted after, so rows are not multiplied by the parameters first.
    """
    wide = gold(seg).groupBy(entity).agg(*[F.avg(c).alias(c) for c in value_cols])
    return unpivot_values(wide, value_cols, (entity,), value="avg_val")


def rank_by_average(
    means: DataFrame, k: int = AVERAGE_RANK_LIMIT, entity: str = ENTITY
) -> DataFrame:
    """The ``k`` locations with the highest mean of each parameter; ties go to the lower id.

    Spark keeps only ``k`` rows per parameter in each task before the shuffle.
    """
    w = Window.partitionBy("sensor_name").orderBy(F.desc("avg_val"), entity)
    return (
        means.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        .orderBy("sensor_name", "rank")
    )


def gold_locations(seg: DataFrame, where: Column | None = None, entity: str = ENTITY) -> DataFrame:
    rows = gold(seg)
    return (rows if where is None else rows.filter(where)).select(entity).distinct()


def gap_distribution(
    df: DataFrame, keys: Sequence[str] = (ENTITY, "sensor_name"), ts: str = TS,
    low: int = GAP_RANGE_HOURS[0], high: int = GAP_RANGE_HOURS[1],
) -> DataFrame:
    """How often consecutive records of a series are so many hours apart, for ``low <= h <= high``.

    Hours are made distinct first: repeats can only add gaps of zero, and a busy series shrinks
    to at most the hours of the period before it meets in one task.
    """
    hourly = df.select(*keys, F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 3600).alias("_h")).distinct()
    gap = F.col("_h") - F.lag("_h").over(Window.partitionBy(*keys).orderBy("_h"))
    return (
        hourly.withColumn("hours_since_prev", gap)
        .filter(F.col("hours_since_prev").between(low, high))
        .groupBy("hours_since_prev")
        .agg(F.count(F.lit(1)).alias("gap_count"))
    )


def squared(c: str | Column) -> Column:
    """Marker size for maps: the square of a value."""
    return F.pow(F.col(c) if isinstance(c, str) else c, F.lit(2))
