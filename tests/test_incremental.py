import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.operators.incremental import watermark
from hourloom.plans import staging
from hourloom.specs import LOCATIONS, MEASUREMENTS, SENSORS

AS_OF = "2024-03-31 00:00:00"
SCHEMA = "k string, ts timestamp, v int, updated_at timestamp"


def day(n, hour=0):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n - 1, hours=hour)


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_keep_latest(spark):
    df = make(spark, [("a", day(1), 1, day(5)), ("a", day(1), 2, day(6)), ("a", day(1), 3, None), ("b", day(1), 5, day(1)), ("b", day(1), 4, day(1))])
    assert rows(h.keep_latest(df, ["k", "ts"], ["updated_at"], ["v"]), "k", "v") == [("a", 2), ("b", 4)]


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = h.keep_latest(make(spark, []), ["k"], ["updated_at"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_watermark(spark):
    df = make(spark, [("a", day(30), 1, day(20)), ("b", day(1), 1, day(30))])
    assert rows(watermark(df, "ts", "updated_at", AS_OF)) == [(day(20),)]  # the old row does not count
    assert rows(watermark(df.filter("k = 'b'"), "ts", "updated_at", AS_OF)) == [(dt.datetime(1900, 1, 1),)]


def test_changed_days_is_inclusive_and_bounded(spark):
    target = make(spark, [("a", day(25), 1, day(26))])
    source = make(spark, [
        ("a", day(25), 1, day(26)),   # exactly the watermark: its day is rebuilt
        ("b", day(24), 1, day(25)),   # older than the watermark
        ("c", day(27), 1, day(28)),
        ("d", day(2), 1, day(30)),    # updated, but outside the look-back
    ])
    got = h.changed_days(source, target, "ts", AS_OF)
    assert rows(got) == [(dt.date(2024, 3, 25),), (dt.date(2024, 3, 27),)]
    assert rows(h.rows_of_days(source, got, "ts"), "k") == [("a",), ("c",)]
    # a target look-back of three days sees no target row, so everything recent is rebuilt
    assert h.changed_days(source, target, "ts", AS_OF, target_lookback=3).count() == 3


def test_incremental_equals_full_rebuild(spark, tmp_path):
    first = [("a", day(1), 1, day(1)), ("a", day(20), 1, day(20)), ("b", day(20, 5), 1, day(20)), ("a", day(28), 1, day(28))]
    later = first + [("b", day(20, 5), 2, day(29)), ("c", day(30), 7, day(30))]

    def build(df):
        return h.keep_latest(df, ["k", "ts"], ["updated_at"], ["v"])

    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    h.refresh_days(spark, make(spark, first), inc, build, "ts", AS_OF)
    untouched = sorted(p.name for p in (tmp_path / "inc" / "day=2024-03-01").iterdir())
    h.refresh_days(spark, make(spark, later), inc, build, "ts", AS_OF)
    h.refresh_days(spark, make(spark, later), full, build, "ts", AS_OF)
    assert rows(spark.read.parquet(inc), "k", "ts", "v") == rows(spark.read.parquet(full), "k", "ts", "v")
    assert untouched == sorted(p.name for p in (tmp_path / "inc" / "day=2024-03-01").iterdir())


def test_stored_by_day_is_pruned(spark, tmp_path):
    src = str(tmp_path / "src")
    h.overwrite_days(make(spark, [("a", day(n), n, day(n)) for n in range(1, 31)]), src, "ts")
    stored = spark.read.parquet(src)
    days = h.changed_days(stored, make(spark, [("x", day(28), 1, day(28))]), "ts", AS_OF)
    got = h.rows_of_days(stored, days, "ts", "day")
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "v") == [(28,), (29,), (30,)]
    # looking for changes reads only the partitions of the look-back, in source and target
    text = h.changed_days(stored, stored, "ts", AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(day") == text.count("FileScan") >= 2


def test_grain(spark, tmp_path):
    path = str(tmp_path / "m")
    h.overwrite_days(make(spark, [("a", day(1), 1, day(1)), ("b", day(40), 1, day(1))]), path, "ts", grain="month")
    assert sorted(p.name for p in (tmp_path / "m").glob("month=*")) == ["month=2024-03-01", "month=2024-04-01"]
    with pytest.raises(ValueError):
        h.overwrite_days(make(spark, []), path, "ts", grain="hour")


def test_whole_months_are_written_by_the_tasks_that_hold_them(spark, tmp_path):
    data = make(spark, [("a", day(n), n, day(n)) for n in range(1, 61)]).repartition(3).localCheckpoint()

    def files_of_each(name):
        return [len(list(p.glob("*.parquet"))) for p in sorted((tmp_path / name).glob("*=*"))]

    h.refresh_days(spark, data, str(tmp_path / "m"), lambda df: df, "ts", day(61), grain="month")
    assert files_of_each("m") == [3, 3]  # no row was shuffled
    h.refresh_days(spark, data, str(tmp_path / "m"), lambda df: df, "ts", day(61), grain="month")
    assert files_of_each("m") == [3, 1]  # a changed month is gathered
    assert rows(spark.read.parquet(str(tmp_path / "m")), "v") == sorted([(n,) for n in range(1, 61)], key=repr)
    h.refresh_days(spark, data, str(tmp_path / "d"), lambda df: df, "ts", day(61))
    assert files_of_each("d") == [1] * 60  # so are days


def test_few_measurements_meet_the_sensors_first(spark):
    at = [day(25)] * 3
    locations = spark.createDataFrame([{"id": k, "name": f"n{k}", "ingested_at": at[0], "updated_at": at[0], "refreshed_at": at[0]} for k in "LM"], LOCATIONS.schema)
    sensors = spark.createDataFrame([(s, k, f"at {k}", *[None] * 4, *at) for s, k in (("s1", "L"), ("s2", "gone"), ("s3", "M"), ("s4", "M"))], SENSORS.schema)
    raw = spark.createDataFrame([{"sensor_id": s, "value": 1.0, "period_datetimeTo_utc": day(2), "ingested_at": at[0], "updated_at": at[0], "refreshed_at": at[0]}
                                 for s in ("s1", "s2", "s3", "s5")], MEASUREMENTS.schema)
    staged = [f(df) for f, df in ((staging.stage_measurements, raw), (staging.stage_sensors, sensors), (staging.stage_locations, locations))]
    got = {few: staging.standardize(*staged, few) for few in (False, True)}
    assert rows(got[True]) == rows(got[False])
    assert rows(got[True], "sensor_id", "location_id", "location_name", "sensor_name") == [
        ("s1", "L", "nL", "at L"), ("s2", "gone", None, "at gone"), ("s3", "M", "nM", "at M"), ("s5", None, None, None),
    ]
    top = {few: next(line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line) for few, df in got.items()}
    assert "(sensor_id#" in top[False] and "(location_id#" in top[True]


def test_staging_to_standardised(spark, tmp_path):
    """Raw tables, both incremental refreshes, and a late correction that travels to the joined table."""
    at = [day(25)] * 3
    locations = spark.createDataFrame([{"id": "L", "name": "Roof", "timezone": "Asia/Seoul", "country_name": "KR",
                                        "ingested_at": at[0], "updated_at": at[0], "refreshed_at": at[0]}], LOCATIONS.schema)
    sensors = spark.createDataFrame([("s1", "L", "pm25 µg/m³", "2", "pm25", "µg/m³", "PM2.5", *at),
                                     ("s2", "gone", "o3 ppm", "10", "o3", "ppm", "O₃", *at)], SENSORS.schema)

    def raw(data):
        return spark.createDataFrame([
            {"sensor_id": s, "value": v, "parameter_id": "2", "period_datetimeTo_utc": t, "ingested_at": u, "updated_at": u, "refreshed_at": u}
            for s, t, v, u in data
        ], MEASUREMENTS.schema)

    first = [("s1", day(26, 1), 1.0, day(27)), ("s1", day(26, 1), 0.5, day(26)), ("s2", day(26, 2), 2.0, day(27)), ("s3", day(27), 3.0, day(27))]
    staged, joined = str(tmp_path / "staged"), str(tmp_path / "joined")

    def refresh(data):
        staging.refresh_staged_measurements(spark, raw(data), staged, AS_OF)
        staging.refresh_standardized(
            spark, spark.read.parquet(staged), staging.stage_sensors(sensors), staging.stage_locations(locations), joined, AS_OF
        )
        return rows(spark.read.parquet(joined), "sensor_id", "value", "location_id", "location_name", "sensor_name")

    assert refresh(first) == [
        ("s1", 1.0, "L", "Roof", "pm25 µg/m³"), ("s2", 2.0, "gone", None, "o3 ppm"), ("s3", 3.0, None, None, None),
    ]
    assert refresh([*first, ("s2", day(26, 2), 8.0, day(29))])[1] == ("s2", 8.0, "gone", None, "o3 ppm")
    assert spark.read.parquet(joined).columns == [*staging.STANDARD_COLUMNS, "day"]


def test_refresh_staged_weather(spark, tmp_path):
    from hourloom.specs import WEATHER

    def raw(data):
        return spark.createDataFrame([
            {"location_id": k, "datetimeto_utc": t, "temperature_2m": v, "ingested_at": u, "updated_at": u, "refreshed_at": u}
            for k, t, v, u in data
        ], WEATHER.schema)

    path = str(tmp_path / "w")
    data = [("L", day(26), 1.0, day(26)), ("L", day(26), 2.0, day(27))]
    staging.refresh_staged_weather(spark, raw(data), path, AS_OF)
    staging.refresh_staged_weather(spark, raw([*data, ("L", day(26), 3.0, day(28)), ("L", day(29), 4.0, day(29))]), path, AS_OF)
    assert rows(spark.read.parquet(path), "temperature_2m") == [(3.0,), (4.0,)]


def test_day_rows_use_rebalance(spark):
    df = make(spark, [("a", day(1), 1, day(1))]).withColumn("day", F.to_date("ts")).hint("rebalance", F.col("day"))
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString()
