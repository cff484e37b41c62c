"""Every operator as a query over the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hourloom as h
from hourloom.functions import blank_to_null, clean_range, hours_between, to_double, to_long
from hourloom.operators import reports as rep
from hourloom.operators import split as spl
from hourloom.operators.calendar import hours_covered, period_label, periods_of, spine_of
from hourloom.operators.clean import ambiguous_local, parse_datetimes
from hourloom.operators.coverage import parameter_names, rank_counts
from hourloom.operators.enrich import sensors_with_dates, wide_measurements
from hourloom.operators.filters import exclude_banned as exclude_listed_ids
from hourloom.operators.filters import exclude_ids, in_bbox, is_member
from hourloom.operators.grid import entities_of
from hourloom.operators import publish, zorder
from hourloom.operators.incremental import plan_refresh, watermark
from hourloom.operators.logs import run_log_errors, run_log_summary, run_log_totals
from hourloom.operators.order import number_in_order, number_rows
from hourloom.operators.quality import check_accepted, check_constraints
from hourloom.operators.resegment import read_segments, refresh_segments
from hourloom.plans import city, ingest, reports, staging
from hourloom.sources import files, paths, quarantine
from hourloom.specs import LOCATION_JSON, LOCATIONS, MEASUREMENTS, SPECS, TableSpec, schema_of

from . import adapters as a
from .adapters import NTZ, table, wall

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _ntz(text):
    return F.lit(text).cast(NTZ)


def _whole(numbered):
    return numbered.withColumn("position", F.col("position").cast("int"))


def _in_order(ordered):
    return _whole(number_in_order(ordered))


# Readings, cleaning, concurrency, pivot, grid -------------------------------------------------
@query
def sensor_readings(spark, sf):
    return a.readings(spark, sf, a.CITY_LOCATIONS)


@query
def range_clean(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", clean_range(F.col("value"), 5.0, 100.0).alias("value")
    )


@query
def static_filter(spark, sf):
    return city.clean_city(
        a.readings(spark, sf), "2024-01-10 00:00:00", a.SERIES[:3], high=100.0
    )


@query
def concurrency(spark, sf):
    start, _ = a.span(spark, sf)
    return city.city_measurements(
        a.readings(spark, sf, a.CITY_LOCATIONS), start=start, parameter_ids=a.SERIES[:3], high=100.0
    )


@query
def concurrency_raw_events(spark, sf):
    """Many rows per key; crowded keys are counted without being brought together."""
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    return h.tag_concurrency(rows, ["event_type"], hot_rows=1500)


@query
def parameter_pivot(spark, sf):
    return h.pivot_readings(a.readings(spark, sf, a.CITY_LOCATIONS), a.THREE)


@query
def parameter_pivot_distinct(spark, sf):
    """Concurrency as the number of parameters present, not of readings."""
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("location_id"), F.to_date("ts").cast(NTZ).alias("datetimeto_utc"),
        F.col("event_type").alias("parameter_id"), "value",
    )
    return h.pivot_readings(rows, a.THREE, count_mode="distinct")


@query
def time_spine(spark, sf):
    return spine_of(table(spark, sf, "events"), "ts")


def _order_periods(spark, sf, grain, part):
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), part(F.col("o_orderdate")).alias("period")
    ).groupBy("year", "period").agg(F.count(F.lit(1)).alias("order_count"))
    years = orders.select("year").distinct()
    return periods_of(years, "year", grain).join(orders, ["year", "period"], "left").withColumn(
        "order_count", F.coalesce("order_count", F.lit(0))
    )


@query
def calendar_months(spark, sf):
    return _order_periods(spark, sf, "month", F.month)


@query
def calendar_quarters(spark, sf):
    return _order_periods(spark, sf, "quarter", F.quarter)


@query
def hours_in_range(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        hours_covered(F.min("ts"), F.max("ts")).alias("hour_count")
    )


@query
def distinct_locations(spark, sf):
    return entities_of(a.readings(spark, sf))


@query
def dense_grid(spark, sf):
    return a.grid(spark, sf)


# Segments -------------------------------------------------------------------------------------
@query
def perfect_hour_tracking(spark, sf):
    return h.track_perfect_hours(a.grid(spark, sf), perfect=3)


@query
def segment_numbering(spark, sf):
    """Shatter flags and numbers before the imperfect tails are cut."""
    tracked = h.track_perfect_hours(a.grid(spark, sf), perfect=3)
    return h.shatter(tracked).select(
        "location_id", "datetimeto_utc", "is_perfect_hour", "hours_since_last", "is_new_segment", "segments_num"
    )


@query
def segments(spark, sf):
    return a.city_seg(spark, sf)


@query
def segments_chunked(spark, sf):
    return a.city_seg(spark, sf, chunk="day")


@query
def segments_minutes(spark, sf):
    """A quarter-hour grid and its segments, both by (location, day), for long and fine series."""
    quarter = F.make_dt_interval(F.lit(0), F.lit(0), (F.floor(F.minute("ts") / 15) * 15).cast("int"))
    slot = (F.date_trunc("hour", "ts").cast(NTZ) + quarter).cast(NTZ)
    pivoted = table(spark, sf, "events").groupBy((F.col("user_id") % 2).cast("string").alias("location_id"), slot.alias("datetimeto_utc")).agg(
        F.max("value").alias("top_value"), F.count_distinct("event_type").alias("concurrent_sensors")
    )
    start, end = a.span(spark, sf)
    grid = h.dense_grid(pivoted, start, end, step_minutes=15, chunk="day")
    return h.segment(grid, perfect=2, gold_hours=24, silver_hours=8, chunk="day")


@query
def segments_resumed(spark, sf):
    """Segments stored before a fifth of the hours of the last third were known, then brought up to date from there."""
    path, stored = a.fresh_dir(spark, "segments"), a.fresh_dir(spark, "grid")
    a.grid(spark, sf).withColumn("day", F.to_date("datetimeto_utc")).write.partitionBy("day").parquet(stored)
    grid = spark.read.parquet(stored)
    start, end = a.span(spark, sf)
    since = start + (end - start) * 2 / 3
    unknown = (F.col("datetimeto_utc") >= F.lit(since.isoformat(sep=" ")).cast(NTZ)) & (F.hour("datetimeto_utc") % 5 == 0)
    before = grid.withColumn("concurrent_sensors", F.when(unknown, F.lit(0)).otherwise(F.col("concurrent_sensors")))
    before = before.withColumns({c: F.when(~unknown, F.col(c)) for c in a.THREE})
    options = dict(perfect=3, gold_hours=24, silver_hours=8)
    refresh_segments(spark, before, path, **options)
    changed = grid.filter(unknown).groupBy("location_id").agg(F.min("datetimeto_utc").alias("since"))
    refresh_segments(spark, grid, path, changed, **options)
    return read_segments(spark, path)


@query
def segments_of_five_series(spark, sf):
    return a.city_seg(spark, sf, mapping=a.FIVE, perfect=5)


@query
def segments_default_tiers(spark, sf):
    return a.default_seg(spark, sf)


@query
def segments_strategy_b(spark, sf):
    return h.segment_by_series(
        a.grid(spark, sf), list(a.THREE), perfect=3, gold_hours=24, silver_hours=8
    )


@query
def segment_boundaries(spark, sf):
    return h.segment_boundaries(a.city_seg(spark, sf))


@query
def segment_overlap(spark, sf):
    return h.overlapping_segments(h.segment_boundaries(a.city_seg(spark, sf)))


@query
def overlap_of_orders(spark, sf):
    """The same check where it does find something: orders of a customer, from order to last shipment."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("segment_end"))
    bounds = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("location_id"), F.col("o_orderkey").alias("segment_id"),
        F.col("o_orderdate").alias("segment_start"), "segment_end",
    )
    return h.overlapping_segments(bounds, chunk="month")


# Segment reports ------------------------------------------------------------------------------
@query
def tier_summary(spark, sf):
    return h.tier_summary(a.city_seg(spark, sf), list(a.THREE))


@query
def tier_summary_dense(spark, sf):
    return h.tier_summary(a.city_seg(spark, sf), list(a.THREE), 0.9)


@query
def duration_report(spark, sf):
    return h.duration_report(a.city_seg(spark, sf), (4, 8, 24, 48))


@query
def duration_report_default_steps(spark, sf):
    return h.duration_report(a.default_seg(spark, sf))


@query
def gold_locations(spark, sf):
    return h.gold_locations(a.many_seg(spark, sf))


@query
def gold_locations_dense(spark, sf):
    return h.gold_locations(a.many_seg(spark, sf), F.col("segment_perfect_density") >= 0.9)


@query
def segment_timeline(spark, sf):
    return h.segment_timeline(a.many_seg(spark, sf))


@query
def segment_timeline_dates(spark, sf):
    return h.segment_timeline(a.many_seg(spark, sf), "2024-01-05 00:00:00", "2024-01-20 00:00:00")


@query
def density_histogram(spark, sf):
    hist = h.density_histogram(a.city_seg(spark, sf))
    return hist.select(
        "bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"), "segment_count"
    )


@query
def perfect_hours_ranking(spark, sf):
    ranked = h.rank_by_perfect_hours(
        a.many_seg(spark, sf), a.places(spark, sf, a.MANY_LOCATIONS), perfect=1
    )
    # the map marker size of a ranking grows with the square of the hours
    return _in_order(ranked).withColumn("marker_size", rep.squared("location_perfect_hours"))


@query
def location_type_flag(spark, sf):
    ranked = h.rank_by_perfect_hours(
        a.many_seg(spark, sf), a.places(spark, sf, a.MANY_LOCATIONS), perfect=1
    )
    return ranked.select("location_id", is_member("location_id", a.MANY_TEST_IDS).alias("location_type"))


@query
def unpivot_values(spark, sf):
    return h.unpivot_values(a.many_seg(spark, sf), list(a.THREE), ("location_id", "datetimeto_utc"))


def _exact_means(spark, sf):
    """Means over whole millionths: sums of whole numbers do not depend on the order of the rows."""
    seg = a.many_seg(spark, sf)
    whole = seg.withColumns({c: F.round(F.col(c) * 1_000_000).cast("bigint") for c in a.THREE})
    return h.mean_by_parameter(whole, list(a.THREE)).withColumn("avg_val", F.col("avg_val") / 1_000_000)


@query
def mean_by_parameter(spark, sf):
    return _exact_means(spark, sf)


@query
def average_ranking_top20(spark, sf):
    return h.rank_by_average(_exact_means(spark, sf))


@query
def train_locations(spark, sf):
    return h.split_locations(h.gold_locations(a.many_seg(spark, sf)), a.MANY_TEST_IDS)


@query
def split_report(spark, sf):
    return h.split_report(a.many_seg(spark, sf), a.MANY_TEST_IDS)


@query
def split_shares(spark, sf):
    return h.split_shares(h.split_report(a.many_seg(spark, sf), a.MANY_TEST_IDS), len(a.MANY_TEST_IDS))


@query
def monthly_perfect_hours(spark, sf):
    return h.monthly_perfect_hours(a.many_seg(spark, sf), a.MANY_TEST_IDS, perfect=1)


@query
def gap_distribution(spark, sf):
    return h.gap_distribution(a.readings(spark, sf))


@query
def segment_report_overview(spark, sf):
    """The composed report: tiers and durations side by side with the overlap count."""
    parts = reports.segment_report(a.city_seg(spark, sf), list(a.THREE))
    overlaps = parts["overlaps"].agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("overlaps").alias("part"), F.lit("all").alias("item"), "value"
    )
    tiers = parts["tiers"].select(
        F.lit("segments").alias("part"), F.col("segment_tier").alias("item"), F.col("segment_count").alias("value")
    )
    dense = parts["dense_tiers"].select(
        F.lit("dense segments").alias("part"), F.col("segment_tier").alias("item"), F.col("segment_count").alias("value")
    )
    durations = parts["durations"].select(
        F.lit("hours").alias("part"), F.col("min_hours").cast("string").alias("item"), F.col("total_hours").alias("value")
    )
    golds = parts["gold_locations"].agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("gold locations").alias("part"), F.lit("all").alias("item"), "value"
    )
    return overlaps.unionByName(tiers).unionByName(dense).unionByName(durations).unionByName(golds)


@query
def split_report_overview(spark, sf):
    parts = reports.split_report(a.many_seg(spark, sf), a.MANY_TEST_IDS, perfect=1)
    counted = [
        parts[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("part"), "row_count")
        for name in ("gold_locations", "train_locations", "per_location", "shares", "timeline", "monthly")
    ]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out


def _part(report, name):
    def part(spark, sf):
        if report is reports.segment_report:
            return report(a.city_seg(spark, sf), list(a.THREE))[name]
        return report(a.many_seg(spark, sf), a.MANY_TEST_IDS, perfect=1)[name]

    return part


# the composed reports part by part, row by row
for _name in ("tiers", "dense_tiers", "overlaps", "durations", "gold_locations"):
    QUERIES[f"segment_report_{_name}"] = _part(reports.segment_report, _name)
for _name in ("gold_locations", "train_locations", "per_location", "shares", "timeline", "monthly"):
    QUERIES[f"split_report_{_name}"] = _part(reports.split_report, _name)


# Parameter coverage ---------------------------------------------------------------------------
def _top(spark, sf, n=3):
    return h.top_parameters(h.rank_parameters(a.readings(spark, sf)), n)


def _checked(spark, sf):
    """From one row per location and parameter, so the readings are aggregated once."""
    pairs = h.coverage_counts(a.readings(spark, sf))
    return h.coverage_check(pairs, h.top_parameters(rank_counts(pairs), 3), 3)


@query
def parameter_ranking(spark, sf):
    return _in_order(h.rank_parameters(a.readings(spark, sf)))


@query
def top_parameters(spark, sf):
    return _top(spark, sf)


@query
def rarest_parameter(spark, sf):
    return h.rarest_parameter(_top(spark, sf))


@query
def coverage_check(spark, sf):
    return _checked(spark, sf)


@query
def coverage_share(spark, sf):
    return h.coverage_share(_checked(spark, sf))


@query
def coverage_counts(spark, sf):
    return h.coverage_counts(a.readings(spark, sf))


@query
def coverage_matrix(spark, sf):
    counts = h.coverage_counts(a.readings(spark, sf, a.CITY_LOCATIONS))
    matrix = h.coverage_matrix(counts, a.SERIES, 0.5)
    return matrix.select(*[
        F.round(c, 9).alias(c) if c in (*a.SERIES, "average", "minimum") else F.col(c) for c in matrix.columns
    ])


@query
def parameter_report(spark, sf):
    """The composed report on the three most common parameters, its counts part."""
    return reports.parameter_report(a.readings(spark, sf), n=3)["counts"]


@query
def parameter_report_ranking(spark, sf):
    return _in_order(reports.parameter_report(a.readings(spark, sf), n=3)["ranking"])


@query
def parameter_report_top(spark, sf):
    return reports.parameter_report(a.readings(spark, sf), n=3)["top"]


@query
def parameter_report_coverage(spark, sf):
    return reports.parameter_report(a.readings(spark, sf), n=3)["coverage"]


@query
def parameter_report_share(spark, sf):
    return reports.parameter_report(a.readings(spark, sf), n=3)["coverage_share"]


@query
def parameter_report_matrix(spark, sf):
    matrix = reports.parameter_report(a.readings(spark, sf, a.CITY_LOCATIONS), n=5, threshold=0.5)["matrix"]
    numbers = (*a.SERIES, "average", "minimum")
    return matrix.select("location_id", *[F.round(c, 9).alias(c) for c in numbers], "kept")


@query
def dataset_profile(spark, sf):
    return h.profile(a.readings(spark, sf))


@query
def dataset_parameters(spark, sf):
    return parameter_names(a.readings(spark, sf))


# Deduplication, staging, enrichment -----------------------------------------------------------
@query
def keep_latest(spark, sf):
    rows = table(spark, sf, "lineitem")
    ties = [c for c in rows.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    return h.keep_latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ties)


@query
def enrich_dims(spark, sf):
    return h.enrich(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
        [
            h.Dim(table(spark, sf, "orders"), "l_orderkey", "o_orderkey", {"o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus"}),
            h.Dim(table(spark, sf, "customer"), "o_custkey", "c_custkey", {"c_name": "c_name", "c_nationkey": "c_nationkey"}),
            h.Dim(table(spark, sf, "nation"), "c_nationkey", "n_nationkey", {"n_name": "n_name", "n_regionkey": "n_regionkey"}),
            h.Dim(table(spark, sf, "region"), "n_regionkey", "r_regionkey", {"r_name": "r_name"}),
        ],
    )


@query
def stage_measurements(spark, sf):
    return wall(staging.stage_measurements(a.raw_measurements(spark, sf)))


@query
def stage_sensors(spark, sf):
    return wall(staging.stage_sensors(a.raw_sensors(spark, sf)))


@query
def stage_locations(spark, sf):
    raw = ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00")
    return wall(staging.stage_locations(raw))


@query
def stage_weather(spark, sf):
    raw = ingest.ingest_weather(a.hourly_docs(spark, sf), "2024-02-01 00:00:00")
    # every document landed twice, the second time an hour later
    later = raw.withColumn("updated_at", F.col("updated_at") + F.expr("interval 1 hour"))
    staged = staging.stage_weather(raw.unionByName(later))
    return wall(staged)


@query
def refresh_staged_weather(spark, sf):
    """Weather staged in full, then refreshed by the days that a later delivery changed."""
    path = a.fresh_dir(spark, "weather")
    first = ingest.ingest_weather(a.hourly_docs(spark, sf), "2024-01-09 00:00:00")
    changed = F.col("temperature_2m") + 1
    late = first.filter(F.col("datetimeto_local") >= _ntz("2024-01-08 00:00:00")).withColumns(
        {"temperature_2m": changed, **{c: F.lit("2024-01-10 00:00:00").cast("timestamp") for c in ("updated_at", "refreshed_at")}}
    )
    staging.refresh_staged_weather(spark, first, path, "2024-01-10 00:00:00")
    staging.refresh_staged_weather(spark, first.unionByName(late), path, "2024-01-10 00:00:00")
    return wall(spark.read.parquet(path).drop("day"))


@query
def standardize_measurements(spark, sf):
    locations = staging.stage_locations(ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00"))
    sensors = staging.stage_sensors(a.raw_sensors(spark, sf))
    return wall(staging.standardize(staging.stage_measurements(a.raw_measurements(spark, sf)), sensors, locations))


@query
def wide_enrichment(spark, sf):
    locations = ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00")
    return wall(wide_measurements(a.raw_measurements(spark, sf), a.raw_sensors(spark, sf), locations))


@query
def active_window(spark, sf):
    orders = table(spark, sf, "orders")
    spans = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    return h.active_between(spans, "first_order", "last_order", "2001-06-01 00:00:00", "2001-07-01 00:00:00")


@query
def sensors_of_active_locations(spark, sf):
    locations = ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00")
    found = sensors_with_dates(a.raw_sensors(spark, sf), locations, date_from="2001-07-01 00:00:00", date_to="1995-02-01 00:00:00")
    return wall(found.select("id", "location_id", "name", "datetimeFirst_utc", "datetimeLast_utc"))


@query
def exclude_listed(spark, sf):
    """Events of users other than the customers with a negative balance."""
    owing = table(spark, sf, "customer").filter("c_acctbal < 0").select("c_custkey")
    return exclude_ids(table(spark, sf, "events").select("event_id", "user_id", "value"), owing, "user_id", "c_custkey")


@query
def exclude_banned(spark, sf):
    """Events of users that are not on a short fixed list."""
    return exclude_listed_ids(table(spark, sf, "events").select("event_id", "user_id", "value"), "user_id", (3, 5, 8, 13, 21))


@query
def bbox_filter(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return in_bbox(rows, "l_discount", "l_tax", 0.02, 0.01, 0.05, 0.04)


@query
def bbox_by_cell(spark, sf):
    """The same box from line items stored in the order of their cells, of which only the ranges of the box are read."""
    path, grid = a.fresh_dir(spark, "cells"), dict(extent=(0.0, 0.0, 0.125, 0.125), bits=10)
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    zorder.sorted_by_cell(rows, "l_discount", "l_tax", **grid).write.parquet(path)
    return zorder.in_bbox_by_cell(spark.read.parquet(path), "l_discount", "l_tax", 0.02, 0.01, 0.05, 0.04, **grid).drop(zorder.CELL)


@query
def membership_flag(spark, sf):
    return table(spark, sf, "events").select("event_id", is_member("user_id", (3, 5, 8, 13, 21)).alias("listed"))


# Merge and incremental refresh ----------------------------------------------------------------
@query
def merge_changes(spark, sf):
    return wall(h.merge_changes(a.loaded_orders(spark, sf), a.staged_orders(spark, sf), ["o_orderkey"]))


@query
def upsert_table(spark, sf):
    path = a.fresh_dir(spark, "orders")
    h.upsert_table(spark, path, a.loaded_orders(spark, sf), a.ORDERS)
    h.upsert_table(spark, path, a.staged_orders(spark, sf), a.ORDERS)
    return wall(h.read_table(spark, path, a.ORDERS))


@query
def upsert_bucketed(spark, sf):
    """The same batches into a table stored by the hash of its keys, of which a batch rewrites the buckets it touches."""
    path = a.fresh_dir(spark, "orders")
    spec = replace(a.ORDERS, buckets=16)
    h.upsert_table(spark, path, a.loaded_orders(spark, sf), spec)
    h.upsert_table(spark, path, a.staged_orders(spark, sf), spec)
    return wall(h.read_table(spark, path, spec))


@query
def upsert_files(spark, sf):
    """Two deliveries of landed files merged under one batch name, and removed."""
    path, landing = a.fresh_dir(spark, "orders"), a.fresh_dir(spark, "landing")
    for rows in (a.loaded_orders(spark, sf), a.staged_orders(spark, sf)):
        rows.write.mode("append").parquet(landing)
        h.upsert_files(spark, path, landing, a.ORDERS, batch="daily")
    return wall(h.read_table(spark, path, a.ORDERS))


@query
def stream_upsert(spark, sf):
    landing, target = a.fresh_dir(spark, "landing"), a.fresh_dir(spark, "orders")
    a.loaded_orders(spark, sf).write.mode("append").parquet(landing)
    check = a.fresh_dir(spark, "check")
    h.stream_upsert(spark, landing, target, a.ORDERS, check).awaitTermination()
    a.staged_orders(spark, sf).write.mode("append").parquet(landing)
    h.stream_upsert(spark, landing, target, a.ORDERS, check).awaitTermination()
    return wall(h.read_table(spark, target, a.ORDERS))


def _loaded_late(rows):
    return rows.filter(F.col("updated_at") <= _ntz(a.LOADED_AT))


@query
def refresh_watermark(spark, sf):
    return watermark(_loaded_late(a.late_orders(spark, sf)), "o_orderdate", "updated_at", a.AS_OF)


@query
def changed_days(spark, sf):
    rows = a.late_orders(spark, sf)
    return h.changed_days(rows, _loaded_late(rows), "o_orderdate", a.AS_OF)


@query
def rows_of_changed_days(spark, sf):
    rows = a.late_orders(spark, sf)
    return h.rows_of_days(rows, h.changed_days(rows, _loaded_late(rows), "o_orderdate", a.AS_OF), "o_orderdate")


@query
def incremental_overwrite(spark, sf):
    path = a.fresh_dir(spark, "late-orders")
    rows = a.late_orders(spark, sf)

    def build(df):
        return df.withColumn("row_count", F.lit(1))

    h.refresh_days(spark, _loaded_late(rows), path, build, "o_orderdate", a.AS_OF, grain="month")
    h.refresh_days(spark, rows, path, build, "o_orderdate", a.AS_OF, grain="month")
    return spark.read.parquet(path).drop("month")


@query
def refresh_after_kill(spark, sf):
    """A refresh that died when it had replaced its newest month, and the one after it."""
    path = a.fresh_dir(spark, "late-orders")
    rows = a.late_orders(spark, sf)

    def build(df):
        return df.withColumn("row_count", F.lit(1))

    h.refresh_days(spark, _loaded_late(rows), path, build, "o_orderdate", a.AS_OF, grain="month")
    dying = plan_refresh(spark, rows, path, build, "o_orderdate", a.AS_OF, grain="month")
    publish.build(spark, f"{publish.journal(path)}/000000002-killed", [dying])
    newest = dying.df.filter(F.col("month") == dying.df.agg(F.max("month")).scalar())
    newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    h.refresh_days(spark, rows, path, build, "o_orderdate", a.AS_OF, grain="month")
    return spark.read.parquet(path).drop("month")


@query
def refresh_measurements(spark, sf):
    """Raw to staged to standardised, loaded in full once and then refreshed by the changed months."""
    staged, joined = a.fresh_dir(spark, "staged"), a.fresh_dir(spark, "joined")
    raw = a.raw_measurements(spark, sf)
    places = a.fresh_dir(spark, "locations")
    staging.stage_locations(ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00")).write.parquet(places)
    locations = spark.read.parquet(places)
    sensors = staging.stage_sensors(a.raw_sensors(spark, sf))
    for rows in (raw.filter(F.col("updated_at") <= F.lit(a.SHIPPED_AT).cast("timestamp")), raw):
        staging.refresh_staged_measurements(spark, rows, staged, a.SHIPPED_AS_OF, grain="month")
        staging.refresh_standardized(
            spark, spark.read.parquet(staged), sensors, locations, joined, a.SHIPPED_AS_OF, grain="month"
        )
    return wall(spark.read.parquet(joined).drop("month"))


@query
def ingest_upsert_locations(spark, sf):
    """Location documents normalised and merged, then again with some of them renamed."""
    path = a.fresh_dir(spark, "locations")
    docs = a.location_docs(spark, sf)
    renamed = docs.withColumn(
        "name", F.when(F.col("provider.name") == "BUILDING", F.concat("name", F.lit("*"))).otherwise(F.col("name"))
    )
    h.upsert_table(spark, path, ingest.ingest_locations(docs, "2024-02-01 00:00:00"), LOCATIONS)
    h.upsert_table(spark, path, ingest.ingest_locations(renamed, "2024-02-02 00:00:00"), LOCATIONS)
    return wall(h.read_table(spark, path, LOCATIONS))


@query
def ingest_sensors(spark, sf):
    return wall(ingest.ingest_sensors(a.sensor_docs(spark, sf), "2024-02-01 00:00:00"))


@query
def ingest_measurements(spark, sf):
    # cleaning so many columns makes a method that the JVM would only interpret; smaller ones are made of it beyond this size
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return wall(ingest.ingest_measurements(a.measurement_docs(spark, sf), "2024-02-01 00:00:00", sort=True))


@query
def json_documents(spark, sf):
    """Location documents written as JSON lines, read with the declared shape and normalised."""
    path = a.fresh_dir(spark, "json")
    a.location_docs(spark, sf).withColumn("distance", F.col("distance").try_cast("double")).write.json(path)
    docs = files.read_json_documents(spark, path, LOCATION_JSON, lines=True)
    return wall(ingest.ingest_locations(docs, "2024-02-01 00:00:00"))


# Normalisation and flattening -----------------------------------------------------------------
MIXED = TableSpec(
    "mixed",
    schema_of("o_orderkey! string, ratio double, price long, status string, day_utc utc, day_local local, absent double, ingested_at! utc, updated_at! utc, refreshed_at! utc"),
    keys=("o_orderkey",),
)


@query
def sanitize_cast(spark, sf):
    """Text in, typed columns out: blanks, bad numbers, fractions, offsets, extra and missing columns."""
    status = F.col("o_orderstatus")
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "O", F.concat(F.col("o_totalprice").cast("string"), F.lit("d")))
        .when(status == "P", F.lit(" ")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("ratio"),
        F.when(status == "O", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("price"),
        F.when(status == "F", F.lit(" \t")).otherwise(status).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+09:00'").alias("day.utc"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+09:00'").alias("day.local"),
        F.lit("x").alias("extra"),
    )
    return wall(h.clean(raw, MIXED, "2024-02-01 00:00:00"))


@query
def local_to_utc(spark, sf):
    from hourloom.functions import local_to_utc as convert

    return table(spark, sf, "events").select("event_id", convert(F.col("ts"), "Asia/Seoul").cast(NTZ).alias("ts_utc"))


@query
def ambiguous_local_times(spark, sf):
    """Order dates taken as clock readings in a zone whose clocks change at midnight."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ambiguous_local(rows, "o_orderdate", "America/Sao_Paulo")


@query
def doubled_local_times(spark, sf):
    """Half an hour before each order date, in the zone whose clocks go back to 23:00 at midnight."""
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderdate") - F.expr("interval 30 minutes")).alias("local"))
    return ambiguous_local(rows, "local", "America/Sao_Paulo")


@query
def parse_datetime_columns(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+09:00'").alias("datetime_local"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+09:00'").alias("datetime_utc"),
    )
    return wall(parse_datetimes(rows))


@query
def explode_parallel_arrays(spark, sf):
    return wall(ingest.weather_rows(a.hourly_docs(spark, sf)))


@query
def flatten_json(spark, sf):
    props = F.from_json("props", "k BIGINT")
    nested = table(spark, sf, "events").select(
        "event_id", F.struct(props.alias("props"), F.struct("event_type", "value").alias("what")).alias("body")
    )
    return h.flatten_structs(nested)


@query
def explode_children(spark, sf):
    return h.explode_children(
        a.line_docs(spark, sf), "sensors", {"location_id": "id"},
        {"id": "id", "name": "name", "parameter_units": "parameter.units", "parameter_displayName": "parameter.displayName"},
    )


@query
def array_to_columns(spark, sf):
    return h.array_to_columns(a.location_docs(spark, sf).select("id", "bounds"), "bounds", ingest.BOUNDS)


@query
def ingest_locations(spark, sf):
    return wall(ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00"))


@query
def canonical_order(spark, sf):
    """Position of each event in the canonical order of its day."""
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", F.to_date("ts").alias("day"))
    return _whole(number_rows(rows, ("ts", "user_id", "event_id"), ("day",)))


@query
def scalar_functions(spark, sf):
    """The remaining scalar functions, over every line item."""
    d = F.col("l_shipdate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
        F.date_trunc("DAY", d).cast(NTZ).alias("ship_day"),
        F.date_trunc("MONTH", d).cast(NTZ).alias("ship_month"),
        period_label(d).alias("month_label"),
        (d - F.expr("interval 15 day")).alias("lookback_start"),
        hours_between(_ntz("2002-01-01 00:30:00"), d).alias("hours_until"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("_S"), F.col("l_linenumber").cast("string")).alias("label"),
        F.try_divide("l_quantity", F.col("l_linenumber") - 1).alias("safe_ratio"),
        F.greatest(F.coalesce("l_quantity", F.lit(0.0)), F.col("l_linenumber").cast("double")).alias("larger"),
        (~F.col("l_returnflag").eqNullSafe(F.lit("A"))).alias("differs"),
        rep.squared("l_quantity").alias("squared"),
        blank_to_null(F.when(F.col("l_linestatus") == "F", F.lit("  ")).otherwise(F.col("l_linestatus"))).alias("status"),
        to_double(F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_tax") > 0.04, F.lit("x")).otherwise(F.lit("")))).alias("as_double"),
        to_long(F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_tax") > 0.04, F.lit(".5")).otherwise(F.lit(".0")))).alias("as_long"),
    )


# Sources and sinks ----------------------------------------------------------------------------
@query
def typed_scan(spark, sf):
    return files.read_typed(
        spark, f"{sf}/supplier.parquet", "s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE, not_there STRING"
    )


_SUPPLIER = "s_suppkey long, s_name string, s_acctbal double"


def _cut_files(spark, sf):
    """Suppliers in sound files, all line items in two files of which the last third is missing, and a file of other content.

    The line items are written by as many tasks as read them, one behind the other into the two files: no task gets half of them.
    """
    path = a.fresh_dir(spark, "delivery")
    table(spark, sf, "supplier").repartition(3).write.parquet(f"{path}/sound")
    whole = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("s_suppkey"), F.col("l_returnflag").alias("s_name"), F.col("l_tax").alias("s_acctbal"))
    whole.write.parquet(f"{path}/whole")
    if len(paths.files(spark, f"{path}/whole")) < 2:  # one task has read them all
        whole.repartition(2).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/whole")
    paths.cut_files(spark, f"{path}/whole", f"{path}/cut", 2 / 3, n_files=2)
    paths.delete(spark, f"{path}/whole")
    table(spark, sf, "nation").select(F.col("n_name").alias("value")).coalesce(1).write.text(f"{path}/text")
    return path


@query
def quarantine_rows(spark, sf):
    """Rows of the sound files of a delivery; damaged ones give none."""
    return quarantine.read_sound(spark, _cut_files(spark, sf), _SUPPLIER)[0]


@query
def quarantine_files(spark, sf):
    """How many files were set apart, by where they lie and what they are."""
    bad = quarantine.read_sound(spark, _cut_files(spark, sf), _SUPPLIER)[1]
    place = F.element_at(F.split("path", "/"), -2)
    return bad.groupBy(place.alias("place"), F.regexp_extract("reason", "^(\\w+)", 1).alias("kind")).agg(F.count(F.lit(1)).alias("n_files"))


def _mixed_files(spark, sf):
    """Orders in four files whose columns differ in type, are missing, or are nested in one of them."""
    path = a.fresh_dir(spark, "mixed")
    rows = table(spark, sf, "orders").withColumn("k", F.col("o_orderkey") % 4)
    number = F.col("o_custkey")
    kinds = {
        0: [F.col("k").cast("int").alias("amount"), number.cast("int").alias("code"), F.col("o_orderdate").cast("date").alias("at"), number.cast("long").alias("odd")],
        1: [F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("code"), F.col("o_orderdate").alias("at")],
        2: [number.cast("long").alias("amount")],
        3: [F.col("k").cast("smallint").alias("amount"), F.struct(number.cast("long").alias("c")).alias("odd")],
    }
    for k, columns in kinds.items():
        rows.filter(F.col("k") == k).select("o_orderkey", *columns).coalesce(1).write.parquet(f"{path}/{k}")
    return path


@query
def concat_widened(spark, sf):
    return wall(quarantine.concat_widened(spark, _mixed_files(spark, sf))[0])


@query
def concat_conflicts(spark, sf):
    """Files and columns that no type holds together, by the folder of the file."""
    found = quarantine.concat_widened(spark, _mixed_files(spark, sf))[1]
    folder = F.element_at(F.split("path", "/"), -2)
    return found.select(folder.alias("folder"), F.col("column").alias("name"), F.regexp_replace("type", "<.*", "nested").alias("type"), "read_as")


@query
def skip_unreadable(spark, sf):
    """Suppliers read together with files that only claim to be parquet."""
    good, bad = a.fresh_dir(spark, "good"), a.fresh_dir(spark, "bad")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    rows.write.parquet(good)
    rows.select("s_name").write.text(bad)
    return files.concat_files(spark, [good, bad], "parquet", rows.schema, skip_corrupt=True)


@query
def typed_sink(spark, sf):
    """Measurements with the declared schema and microsecond times, written and read back."""
    path = a.fresh_dir(spark, "typed")
    files.write_parquet(a.raw_measurements(spark, sf), path)
    return wall(files.read_typed(spark, path, MEASUREMENTS))


@query
def concat_union(spark, sf):
    """Customers and suppliers written apart, with differing columns, read and reconciled as one."""
    out, parts = a.fresh_dir(spark, "concat"), [a.fresh_dir(spark, "part"), a.fresh_dir(spark, "part")]
    table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("market")
    ).write.parquet(parts[0])
    table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    ).write.parquet(parts[1])
    return spark.read.parquet(files.concat_to(spark, parts, out))


@query
def csv_concat(spark, sf):
    """Parquet to CSV, CSV to CSV, and back into typed columns."""
    schema = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
    first, second = a.fresh_dir(spark, "csv"), a.fresh_dir(spark, "csv")
    source = a.fresh_dir(spark, "part")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority").write.parquet(source)
    files.concat_to(spark, [source], first, "parquet", "csv")
    files.concat_to(spark, [first], second, "csv", "csv", schema)
    return files.concat_files(spark, [second], "csv", schema)


@query
def load_append(spark, sf):
    """Truncate-load, then append: every order is there twice."""
    path = a.fresh_dir(spark, "loaded")
    rows = a.all_orders(spark, sf)
    files.load_table(rows, path, a.ORDERS, "truncate")
    files.load_table(rows, path, a.ORDERS, "truncate")
    files.load_table(rows, path, a.ORDERS, "append")
    return spark.read.parquet(path).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


@query
def export_query(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders_to_export")
    path = a.fresh_dir(spark, "export")
    files.export_query(
        spark, "SELECT o_orderkey, o_totalprice FROM orders_to_export WHERE o_orderstatus = :status", path, {"status": "F"}
    )
    return spark.read.parquet(path)


@query
def param_query(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders_by_status")
    return files.run_query(
        spark,
        """SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders_by_status
           WHERE array_contains(:statuses, o_orderstatus) AND o_totalprice >= :floor GROUP BY o_orderstatus""",
        {"statuses": ["O", "P"], "floor": 1000.0},
    )


SUMMARY = ("run_id", "sensor_count", "attempts", "errors", "saved", "retries", "status", "download_duration", "saving_duration", "total_duration")


@query
def run_log_summary_(spark, sf):
    return run_log_summary(a.run_logs(spark, sf)).select(*SUMMARY)


@query
def run_log_files(spark, sf):
    """Run logs written as JSON, a log to a line, and read back."""
    path = a.fresh_dir(spark, "logs")
    a.run_logs(spark, sf).write.json(path)
    return run_log_summary(files.read_run_logs(spark, path, lines=True)).select(*SUMMARY)


@query
def run_log_totals_(spark, sf):
    return run_log_totals(run_log_summary(a.run_logs(spark, sf)))


@query
def run_log_error_rows(spark, sf):
    return run_log_errors(a.run_logs(spark, sf))


# Checks ---------------------------------------------------------------------------------------
@query
def check_unique(spark, sf):
    return h.check_unique(table(spark, sf, "lineitem"), "l_orderkey")


@query
def check_unique_combination(spark, sf):
    return h.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_unique_recent(spark, sf):
    return h.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "2001-01-01 00:00:00", "l_shipdate")


@query
def check_not_null(spark, sf):
    """Locations without a distance: the documents of some countries have text there."""
    rows = ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00")
    return h.check_not_null(rows, "distance").select("id", "name", "distance", "provider_id")


@query
def check_relationship(spark, sf):
    """Users of events that are no supplier's number."""
    return h.check_relationship(table(spark, sf, "events"), "user_id", table(spark, sf, "supplier"), "s_suppkey")


@query
def check_freshness(spark, sf):
    out = h.check_freshness(table(spark, sf, "events"), "ts", "2024-02-01 12:00:00")
    return out.withColumn("age_hours", F.round("age_hours", 6))


@query
def check_at_least_one(spark, sf):
    rows = table(spark, sf, "events").withColumn("bonus", F.when(F.col("value") < 0, F.col("value")))
    return h.check_at_least_one(rows, ["value", "bonus"])


@query
def check_accepted_values(spark, sf):
    return check_accepted(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query
def check_declared_constraints(spark, sf):
    return check_constraints(
        {
            "locations": ingest.ingest_locations(a.location_docs(spark, sf), "2024-02-01 00:00:00"),
            "sensors": a.raw_sensors(spark, sf),
            "measurements": a.raw_measurements(spark, sf),
        },
        SPECS,
    )


@query
def row_reconciliation(spark, sf):
    """Rows each file contributes, against the rows of the frame."""
    rows = files.concat_files(spark, [f"{sf}/orders.parquet"], "parquet")
    per_file = files.rows_per_file(rows).agg(F.sum("n_rows").alias("rows_in_files"))
    return per_file.select("rows_in_files", rows.agg(F.count(F.lit(1)).alias("n")).scalar().alias("rows_in_frame"))


QUERIES["run_log_summary"] = QUERIES.pop("run_log_summary_")
QUERIES["run_log_totals"] = QUERIES.pop("run_log_totals_")