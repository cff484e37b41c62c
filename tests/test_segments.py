"""Segmentation: hand-written edges, brute force, invariants, and the chunked form."""

import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import hourloom as h

T0 = dt.datetime(2024, 1, 1)
GRID = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("datetimeto_utc", T.TimestampNTZType()),
    T.StructField("concurrent_sensors", T.LongType()),
])


def hour(i):
    return T0 + dt.timedelta(hours=i)


def frame(spark, series):
    """``P`` is a perfect hour (six readings), ``.`` an imperfect one, ``7`` seven readings."""
    count = {"P": 6, ".": 2, "7": 7}
    data = [(loc, hour(i), count[c]) for loc, text in series.items() for i, c in enumerate(text)]
    return spark.createDataFrame(data, GRID)


def brute(text, gap=4):
    """Segments of one series as (start, end, perfect hours)."""
    out = []
    for i, c in enumerate(text):
        if c == "P":
            if out and i - out[-1][1] <= gap:
                out[-1][1], out[-1][2] = i, out[-1][2] + 1
            else:
                out.append([i, i, 1])
    return [tuple(s) for s in out]


def found(df):
    got = df.groupBy("location_id", "segments_num").agg(
        F.min("datetimeto_utc"), F.max("datetimeto_utc"), F.count("*"), F.first("segment_perfect_hours"),
        F.first("segments_total"), F.first("segment_start"), F.first("segment_end"),
        F.first("segment_total_hours"), F.first("segment_perfect_density"), F.first("segment_id"),
        F.sum("is_new_segment"),
    ).collect()
    out = {}
    for r in got:
        a, b = ((x - T0) // dt.timedelta(hours=1) for x in (r[2], r[3]))
        assert (r[7], r[8]) == (r[2], r[3])                 # bounds are those of the rows kept
        assert r[4] == b - a + 1 == r[9]                    # dense grid: hours equal rows
        assert 0 < r[10] <= 1 and r[10] == r[5] / r[9]
        assert r[11] == f"{r[0]}_S{r[1]}" and r[12] == 1
        out.setdefault(r[0], []).append((r[1], (a, b, r[5]), r[6]))
    for v in out.values():
        v.sort()
        assert [n for n, _, _ in v] == list(range(1, len(v) + 1))
        assert {t for _, _, t in v} == {len(v)}
    return {k: [s for _, s, _ in v] for k, v in out.items()}


@pytest.mark.parametrize("text, want", [
    ("..P", [(2, 2, 1)]),
    ("P...P", [(0, 4, 2)]),
    ("P....P", [(0, 0, 1), (5, 5, 1)]),
    ("P..", [(0, 0, 1)]),
    ("....", None),
    ("7.7", None),
    ("PP..P.....PP.", [(0, 4, 3), (10, 11, 2)]),
])
def test_edges(spark, text, want):
    got = found(h.segment(frame(spark, {"a": text})))
    assert got.get("a") == want


def test_gap_is_a_parameter(spark):
    assert found(h.segment(frame(spark, {"a": "P..P"}), max_gap_hours=2)) == {"a": [(0, 0, 1), (3, 3, 1)]}
    assert found(h.segment(frame(spark, {"a": "P.P"}), max_gap_hours=2)) == {"a": [(0, 2, 2)]}


def test_tiers(spark):
    seg = h.segment(frame(spark, {"g": "P" * 336, "s": "P" * 168, "b": "P" * 167}))
    assert rows(seg.select("location_id", "segment_tier").distinct()) == [("b", "bronze"), ("g", "gold"), ("s", "silver")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("P.", min_size=1, max_size=70), min_size=1, max_size=12))
def test_against_brute_force(spark, texts):
    series = {f"l{i}": t for i, t in enumerate(texts)}
    grid = frame(spark, series)
    want = {k: brute(t) for k, t in series.items() if brute(t)}
    whole = h.segment(grid)
    assert found(whole) == want
    chunked = h.segment(grid, chunk="day")
    assert rows(chunked) == rows(whole)


def test_chunk_boundaries(spark):
    """Segments over several chunks, chunks without a perfect hour, a gap over a chunk boundary."""
    text = "." * 20 + "P" + "." * 3 + "P" * 30 + "." * 60 + "P" + "." * 4 + "P" * 60
    grid = frame(spark, {"a": text, "b": "." * 100, "c": "P" * 100})
    assert rows(h.segment(grid, chunk="day")) == rows(h.segment(grid))
    assert rows(h.segment(grid, chunk="hour")) == rows(h.segment(grid))


def test_segments_do_not_overlap_and_overlap_is_found(spark):
    seg = h.segment(frame(spark, {"a": "PP" + "." * 6 + "PPP", "b": "P"}))
    bounds = h.segment_boundaries(seg)
    assert h.overlapping_segments(bounds).count() == 0
    bad = spark.createDataFrame(
        [("a", "a_S1", 1, hour(0), hour(5)), ("a", "a_S2", 2, hour(3), hour(9)), ("a", "a_S3", 3, hour(9), hour(9))],
        "location_id string, segment_id string, segments_num int, segment_start timestamp_ntz, segment_end timestamp_ntz",
    )
    assert rows(h.overlapping_segments(bad), "segment_id", "hours_since_prev_segment_end") == [("a_S2", -2)]
    for chunk in ("hour", "day"):
        assert rows(h.overlapping_segments(bad, chunk=chunk)) == rows(h.overlapping_segments(bad))


def test_overlap_by_chunk_is_the_same(spark):
    ids = spark.range(400).select(
        (F.col("id") % 3).cast("string").alias("location_id"), F.col("id").alias("segment_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), ((F.col("id") * 37) % 401).cast("int"))).alias("segment_start"),
    )
    bounds = ids.withColumn("segment_end", F.col("segment_start") + F.make_dt_interval(F.lit(0), (F.col("segment_id") % 5).cast("int")))
    want = rows(h.overlapping_segments(bounds))
    assert len(want) > 50
    for chunk in ("day", "week", "month"):
        assert rows(h.overlapping_segments(bounds, chunk=chunk)) == want


def test_one_shuffle_for_the_whole_chain(spark):
    plan = h.segment(frame(spark, {"a": "PP.P"}))._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1


def by_series(series, gap=3):
    """Independent walk over the hours for the per-series strategy; values are lists of 0/1 tuples."""
    kept, number = [], 0
    last = [None] * len(series[0])
    for i, present in enumerate(series):
        widest = max(0 if p is None else i - p for p in last)
        unseen = last[0] is None
        if widest <= gap or unseen:
            new = 1 if unseen or widest > gap else 0
            number += new
            kept.append((i, number, widest))
        last = [i if p else q for p, q in zip(present, last)]
    return kept


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=40))
def test_by_series(spark, present):
    data = [("a", hour(i), sum(p), *(1.0 if x else None for x in p)) for i, p in enumerate(present)]
    grid = spark.createDataFrame(
        data, "location_id string, datetimeto_utc timestamp_ntz, concurrent_sensors int, x double, y double"
    )
    seg = h.segment_by_series(grid, ["x", "y"], perfect=2)
    got = [
        ((r[0] - T0) // dt.timedelta(hours=1), r[1], r[2])
        for r in seg.orderBy("datetimeto_utc").select("datetimeto_utc", "segments_num", "hours_since_last").collect()
    ]
    assert got == by_series(present)


def test_tracking_columns(spark):
    tracked = h.track_perfect_hours(frame(spark, {"a": ".P..P"}))
    assert rows(tracked, "datetimeto_utc", "is_perfect_hour", "first_perfect_hour", "last_perfect_hour", "hours_since_last") == [
        (hour(0), 0, hour(1), None, None),
        (hour(1), 1, hour(1), None, None),
        (hour(2), 0, hour(1), hour(1), 1),
        (hour(3), 0, hour(1), hour(1), 2),
        (hour(4), 1, hour(1), hour(1), 3),
    ]


def test_chunks_keep_an_unknown_location(spark):
    """A NULL location is a location: measurements of sensors nobody knows end there."""
    text = "P" * 8 + "." * 12 + "P..P" + "." * 3
    grid = frame(spark, {"a": text}).unionByName(frame(spark, {"b": text}).withColumn("location_id", F.lit(None).cast("string")))
    for chunk in ("hour", "day"):
        assert rows(h.segment(grid, chunk=chunk)) == rows(h.segment(grid))
    assert h.segment(grid, chunk="day").filter("location_id is null").count() == 12
    bounds = spark.createDataFrame(
        [(loc, f"s{i}", hour(20 * i), hour(20 * i + 25)) for loc in ("a", None) for i in range(5)],
        "location_id string, segment_id string, segment_start timestamp_ntz, segment_end timestamp_ntz",
    )
    for chunk in ("day", "week"):
        assert rows(h.overlapping_segments(bounds, chunk=chunk)) == rows(h.overlapping_segments(bounds))
    assert h.overlapping_segments(bounds, chunk="day").filter("location_id is null").count() == 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=60), st.booleans())
def test_series_by_chunk_are_the_same(spark, present, unknown):
    data = [
        (None if unknown else "a", hour(i), 1.0 if x else None, 1.0 if y else None, int(x) + int(y)) for i, (x, y) in enumerate(present)
    ] + [("z", hour(i), None, 2.0, 1) for i in range(4)]
    grid = spark.createDataFrame(data, "location_id string, datetimeto_utc timestamp_ntz, x double, y double, concurrent_sensors long")
    whole = rows(h.segment_by_series(grid, ["x", "y"], perfect=2))
    for chunk in ("hour", "day"):
        assert rows(h.segment_by_series(grid, ["x", "y"], perfect=2, chunk=chunk)) == whole
