import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.functions import blank_to_null, local_to_utc, to_double, to_long
from hourloom.operators.clean import ambiguous_local, drop_unwanted, parse_datetimes, underscore_names
from hourloom.plans import ingest
from hourloom.specs import LOCATION_JSON, LOCATIONS, MEASUREMENT_JSON, MEASUREMENTS, SENSORS, SPECS, TableSpec, schema_of, weather_json

AT = "2024-02-01 00:00:00"


def one(spark, values, kind, fn):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(fn(F.col("c"))).collect()]


def test_numbers_from_text(spark):
    text = ["3", " 3.5 ", "1e3", "", "  ", "x", "1.5d", "0x10", "nan", None, "-.5", "1_000", "+7"]
    assert one(spark, text, "string", to_double) == [3.0, 3.5, 1000.0, None, None, None, None, None, None, None, -0.5, None, 7.0]
    assert one(spark, text, "string", to_long) == [3, None, 1000, None, None, None, None, None, None, None, None, None, 7]
    assert one(spark, ["3.0", "3.", "9007199254740993", "-4.00", "3.01", "99999999999999999999", "1e-1"], "string", to_long) == [
        3, 3, 9007199254740993, -4, None, None, None]
    assert one(spark, ["inf", "-Infinity"], "string", to_double) == [float("inf"), float("-inf")]


def test_numbers_from_numbers(spark):
    from pyspark.sql import types as T

    d = T.DoubleType()
    assert one(spark, [1.0, float("nan"), None], "double", lambda c: to_double(c, d)) == [1.0, None, None]
    assert one(spark, [1.0, 1.5, float("nan"), 1e30, None], "double", lambda c: to_long(c, d)) == [1, None, None, None, None]
    assert one(spark, [True, None], "boolean", lambda c: to_double(c, T.BooleanType())) == [1.0, None]


def test_blank_text(spark):
    assert one(spark, ["", " \t\n", " ", " a ", None], "string", blank_to_null) == [None, None, None, " a ", None]


def test_sanitize_casts_by_declared_type(spark):
    spec = TableSpec("x", schema_of("id! string, provider_name string, n long, d double, when_utc utc, when_local local, flag bool"), ("id",))
    df = spark.createDataFrame(
        [(7, "  ", "3.0", "x", "2024-01-01T09:00:00+09:00", "2024-01-01T09:00:00+09:00", "true", " "),
         (None, "p", "3.7", "1.5", "2024-01-01T00:00:00.1234567Z", None, None, "e")],
        "id bigint, `provider.name` string, n string, d string, `when.utc` string, `when.local` string, flag string, extra string",
    )
    got = h.conform(h.sanitize(df, spec), spec)
    assert got.columns == spec.columns
    assert [tuple(r) for r in got.collect()] == [
        ("7", None, 3, None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 9), True),
        (None, "p", None, 1.5, dt.datetime(2024, 1, 1, 0, 0, 0, 123456), None, None),
    ]
    assert h.sanitize(df, spec).select("extra").first()[0] is None


def test_bad_timestamps_fail_or_become_null(spark):
    spec = TableSpec("x", schema_of("a_utc utc, b_local local"), ())
    df = spark.createDataFrame([("soon", "later")], "a_utc string, b_local string")
    with pytest.raises(Exception):
        h.sanitize(df, spec).collect()
    assert rows(h.sanitize(df, spec, strict=False)) == [(None, None)]


def test_audit_stamp(spark):
    df = spark.range(2)
    stamped = h.stamp_audit(df, AT)
    assert len({tuple(r)[1:] for r in stamped.collect()}) == 1
    with pytest.raises(ValueError):
        h.stamp_audit(stamped, AT)


def test_conform_adds_drops_and_orders(spark):
    df = spark.createDataFrame([("x", 1.0, "s")], "junk string, value double, sensor_id string")
    got = h.conform(df, MEASUREMENTS)
    assert got.columns == MEASUREMENTS.columns
    assert got.first().sensor_id == "s" and got.first().period_label is None
    assert [f.dataType for f in got.schema] == [f.dataType for f in MEASUREMENTS.schema]


def test_sort_needs_its_columns(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "sensor_id string, period_datetimeTo_local int")
    assert [r[0] for r in h.canonical_sort(df).collect()] == ["c", "a", "b"]
    with pytest.raises(ValueError):
        h.canonical_sort(df.drop("sensor_id"))


def test_names_and_drops(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b.c` int, d int")
    assert underscore_names(df).columns == ["a_b_c", "d"]
    assert drop_unwanted(underscore_names(df), "d", "nothing").columns == ["a_b_c"]


def test_parse_datetimes(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00+09:00",) * 2 + ("x",)], "datetimeTo_local string, datetimeTo_utc string, other string")
    assert rows(parse_datetimes(df)) == [(dt.datetime(2024, 1, 1), dt.datetime(2023, 12, 31, 15), "x")]
    assert parse_datetimes(df.select("other")).columns == ["other"]


def test_zones(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9),), (dt.datetime(2024, 3, 31, 2, 30),), (dt.datetime(2024, 10, 27, 2, 30),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(local_to_utc(F.col("t"), "Asia/Seoul")).collect()][0] == dt.datetime(2024, 1, 1)
    assert ambiguous_local(df, "t", "Asia/Seoul").count() == 0
    assert rows(ambiguous_local(df, "t", "Europe/Berlin")) == [(dt.datetime(2024, 10, 27, 2, 30),), (dt.datetime(2024, 3, 31, 2, 30),)]


def test_flatten_and_explode(spark):
    doc = '{"id": 5, "bounds": [1.0, 2.0], "country": {"id": 1, "name": "KR"}, "distance": null, "sensors": [{"id": 9, "name": "n", "parameter": {"id": 2, "displayName": "PM"}}, {"id": 10}]}'
    docs = spark.createDataFrame([(doc,), ('{"id": 6, "sensors": []}',), ('{"id": 7}',)], "j string").select(
        F.from_json("j", LOCATION_JSON).alias("d")).select("d.*")
    flat = h.flatten_structs(docs)
    assert "country_name" in flat.columns and "sensors" in flat.columns
    assert "country.name" in h.flatten_structs(docs, ".").columns
    sensors = ingest.ingest_sensors(docs, AT)
    assert sensors.columns == SENSORS.columns
    assert rows(sensors, "id", "location_id", "parameter_id", "parameter_displayName") == [("10", "5", None, None), ("9", "5", "2", "PM")]
    places = ingest.ingest_locations(docs, AT)
    assert places.columns == LOCATIONS.columns
    assert rows(places, "id", "bounds_min_lon", "bounds_min_lat", "bounds_max_lon", "country_id") == [
        ("5", 1.0, 2.0, None, "1"), ("6", None, None, None, None), ("7", None, None, None, None)]


def test_measurement_documents(spark):
    doc = '{"sensor_id": 1, "value": 2.5, "period": {"datetimeTo": {"utc": "2024-01-01T01:00:00Z", "local": "2024-01-01T10:00:00+09:00"}}, "coverage": {"observedCount": 1}}'
    docs = spark.createDataFrame([(doc,)], "j string").select(F.from_json("j", MEASUREMENT_JSON).alias("d")).select("d.*")
    got = ingest.ingest_measurements(docs, AT, sort=True)
    assert got.columns == MEASUREMENTS.columns
    assert rows(got, "sensor_id", "period_datetimeTo_utc", "period_datetimeTo_local", "coverage_observedCount") == [
        ("1", dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 10), 1)]


def test_weather_documents(spark):
    schema = weather_json(("temperature_2m", "is_day"))
    doc = '{"location_id": 3, "timezone": "Asia/Seoul", "latitude": 1.5, "elevation": 9.0, "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0], "is_day": [0, 1]}}'
    docs = spark.createDataFrame([(doc,)], "j string").select(F.from_json("j", schema).alias("d")).select("d.*")
    got = ingest.ingest_weather(docs, AT)
    assert got.columns == SPECS["weather"].columns
    assert rows(got, "location_id", "datetimeto_utc", "datetimeto_local", "temperature_2m", "is_day", "elevation") == [
        ("3", dt.datetime(2023, 12, 31, 15), dt.datetime(2024, 1, 1, 0), 1.0, 0, 9.0),
        ("3", dt.datetime(2023, 12, 31, 16), dt.datetime(2024, 1, 1, 1), None, 1, 9.0)]


def test_array_to_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [9.0]), (3, None)], "id int, a array<double>")
    assert rows(h.array_to_columns(df, "a", ["x", "y"])) == [(1, 1.0, 2.0), (2, 9.0, None), (3, None, None)]


def test_moments_do_not_depend_on_the_process_zone(spark, monkeypatch):
    import time
    from pyspark.sql import types as T
    from hourloom.functions import moment

    aware = dt.datetime(2024, 1, 1, 9, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    given = [dt.datetime(2024, 1, 1), "2024-01-01 00:00:00", aware]
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        columns = [moment(v, k).cast("string").alias(f"c{i}") for i, (v, k) in enumerate(
            (v, k) for v in given for k in (T.TimestampNTZType(), T.TimestampType()))]
        got = spark.range(1).select(*columns).first()
    finally:
        monkeypatch.undo()
        time.tzset()
    assert set(got) == {"2024-01-01 00:00:00"}
