import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.plans.city import city_measurements, city_segments, clean_city, pivoted_grid

T0 = dt.datetime(2024, 5, 1)
LONG = "location_id string, datetimeto_utc timestamp_ntz, parameter_id string, value double"
MAP = {"a": "1", "b": "2"}


def hour(i, minutes=0):
    return T0 + dt.timedelta(hours=i, minutes=minutes)


def test_range_cleaning_keeps_rows(spark):
    df = spark.createDataFrame(
        [(-0.1,), (0.0,), (9999.9,), (10000.0,), (None,), (float("nan"),)], "value double"
    )
    from hourloom.functions import clean_range

    assert [r[0] for r in df.select(clean_range(F.col("value"))).collect()] == [None, 0.0, 9999.9, None, None, None]


def test_city_filter_and_concurrency(spark):
    data = [
        ("x", hour(0), "1", 5.0), ("x", hour(0), "2", -1.0), ("x", hour(0), "99", 5.0),
        ("x", hour(-48), "1", 5.0), ("x", hour(0), "1", 7.0), ("y", hour(0), "2", 1.0),
    ]
    df = spark.createDataFrame(data, LONG)
    got = city_measurements(df, start="2024-04-30 15:00:00")
    assert rows(got, "location_id", "parameter_id", "value", "concurrent_sensors") == [
        ("x", "1", 5.0, 2), ("x", "1", 7.0, 2), ("x", "2", None, 2), ("y", "2", 1.0, 1),
    ]


@pytest.mark.parametrize("hot_rows", [None, 1, 2, 3, 1_000_000])
def test_concurrency_does_not_depend_on_the_split(spark, hot_rows):
    data = [(k, v) for k, vs in {"hot": [1.0] * 9 + [None], None: [1.0, None, 2.0], "c": [None]}.items() for v in vs]
    df = spark.createDataFrame(data, "k string, value double")
    got = h.tag_concurrency(df, ["k"], hot_rows=hot_rows)
    want = {"hot": 9, None: 2, "c": 0}
    assert rows(got, "k", "value", "concurrent_sensors") == sorted(((k, v, want[k]) for k, v in data), key=repr)


def test_pivot_counts_readings_or_parameters(spark):
    df = spark.createDataFrame(
        [("x", hour(0), "1", 5.0), ("x", hour(0), "1", 7.0), ("x", hour(0), "2", 1.0), ("x", hour(1), "2", None)], LONG
    )
    assert rows(h.pivot_readings(df, MAP)) == [("x", hour(0), 7.0, 1.0, 3), ("x", hour(1), None, None, 0)]
    assert rows(h.pivot_readings(df, MAP, count_mode="distinct")) == [("x", hour(0), 7.0, 1.0, 2), ("x", hour(1), None, None, 0)]
    with pytest.raises(ValueError):
        h.pivot_readings(df, MAP, count_mode="other")


def joined(pivoted, start, end):
    """The grid as a product and a join, to compare with."""
    spine = h.hourly_spine(pivoted.sparkSession, start, end).select(F.col("datetimeto_utc").cast("timestamp_ntz").alias("datetimeto_utc"))
    full = pivoted.select("location_id").distinct().join(spine, F.lit(True), "cross")
    return full.join(pivoted, ["location_id", "datetimeto_utc"], "left").withColumn(
        "concurrent_sensors", F.coalesce("concurrent_sensors", F.lit(0))
    ).select(*pivoted.columns)


@pytest.mark.parametrize("data", [
    [("x", hour(2)), ("x", hour(5)), ("y", hour(0)), ("y", hour(9))],
    [("x", hour(-5)), ("x", hour(-4)), ("z", hour(40))],                    # nothing inside
    [("x", hour(-5)), ("x", hour(-4)), ("x", hour(3)), ("x", hour(20))],    # both sides and inside
    [("x", hour(3, 30)), ("x", hour(4))],                                   # off the grid
    [(None, hour(3)), ("x", hour(4))],                                      # unknown location
    [("x", hour(4)), ("x", hour(4)), ("x", hour(6))],                       # not unique: both rows stay
    [("x", hour(0)), ("x", hour(0))],
    [("x", hour(9)), ("x", hour(0))],
])
def test_dense_grid_equals_the_join(spark, data):
    schema = "location_id string, datetimeto_utc timestamp_ntz, a double, concurrent_sensors bigint"
    pivoted = spark.createDataFrame([(loc, t, float(i), i) for i, (loc, t) in enumerate(data)], schema)
    start, end = hour(0), hour(9)
    assert rows(h.dense_grid(pivoted, start, end)) == rows(joined(pivoted, start, end))


def test_dense_grid_keeps_instants(spark):
    pivoted = spark.createDataFrame([("x", hour(1), 1.0, 1)], "location_id string, datetimeto_utc timestamp, a double, concurrent_sensors bigint")
    got = h.dense_grid(pivoted, "2024-05-01 00:00:00", "2024-05-01 02:00:00")
    assert got.schema["datetimeto_utc"].dataType.simpleString() == "timestamp" and got.count() == 3


def test_dense_grid_has_no_join(spark):
    pivoted = spark.createDataFrame([("x", hour(1), 1.0, 1)], "location_id string, datetimeto_utc timestamp_ntz, a double, concurrent_sensors bigint")
    plan = h.dense_grid(pivoted, hour(0), hour(9))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_city_segments_from_long_readings(spark):
    data = [("x", hour(i), p, 1.0) for i in (0, 1, 2, 6) for p in ("1", "2")] + [("x", hour(4), "1", 1.0), ("y", hour(0), "1", 1.0)]
    df = spark.createDataFrame(data, LONG)
    seg = city_segments(df, hour(30), hour(0), mapping=MAP)
    assert rows(seg.select("segment_id", "segment_start", "segment_end", "segment_perfect_hours", "segment_total_hours").distinct()) == [
        ("x_S1", hour(0), hour(6), 4, 7)
    ]
    grid = pivoted_grid(clean_city(df, hour(0), ("1", "2")), hour(0), hour(30), MAP)
    assert grid.count() == 2 * 31


def test_spine_and_periods(spark):
    spine = h.hourly_spine(spark, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert spine.count() == 25
    months = h.periods(spark, 2024)
    assert rows(months)[1] == (2024, 10, dt.datetime(2024, 10, 1), dt.datetime(2024, 10, 31, 23, 59, 59))
    feb = months.filter("period = 2").first()
    assert feb.period_end == dt.datetime(2024, 2, 29, 23, 59, 59)
    quarters = h.periods(spark, 2023, "quarter")
    assert [tuple(r)[1:] for r in quarters.orderBy("period").collect()][0] == (1, dt.datetime(2023, 1, 1), dt.datetime(2023, 3, 31, 23, 59, 59))
    with pytest.raises(ValueError):
        h.periods(spark, 2023, "week")


def test_hours_covered(spark):
    from hourloom.operators.calendar import hours_covered

    df = spark.createDataFrame([(hour(0), hour(0)), (hour(0), hour(5)), (hour(0, 10), hour(5))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(hours_covered(F.col("a"), F.col("b"))).collect()] == [1, 6, 5]


def test_hour_difference_counts_boundaries(spark):
    from hourloom.functions import hours_between

    df = spark.createDataFrame([(hour(1, 1), hour(0, 59)), (hour(0, 59), hour(0)), (hour(0), hour(2))], "b timestamp_ntz, a timestamp_ntz")
    assert [r[0] for r in df.select(hours_between(F.col("b"), F.col("a"))).collect()] == [1, 0, -2]
