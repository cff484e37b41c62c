import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.operators.enrich import sensors_with_dates
from hourloom.operators.filters import exclude_banned
from hourloom.operators.quality import check_constraints
from hourloom.plans.reports import parameter_report, segment_report, split_report
from hourloom.specs import SPECS

T0 = dt.datetime(2024, 1, 1)
VALUES = ["a", "b"]


def hour(i):
    return T0 + dt.timedelta(hours=i)


@pytest.fixture(scope="module")
def seg(spark):
    """x: a gold segment of 5 hours (one imperfect) and a bronze one; y: one perfect silver segment."""
    text = {"x": "PP.PP......P", "y": "PPP"}
    data = [
        (loc, hour(i), 2 if c == "P" else 1, 1.0 * i, 10.0 if c == "P" else None)
        for loc, s in text.items() for i, c in enumerate(s)
    ]
    grid = spark.createDataFrame(data, "location_id string, datetimeto_utc timestamp_ntz, concurrent_sensors int, a double, b double")
    return h.segment(grid, perfect=2, gold_hours=5, silver_hours=3).cache()


def test_tier_summary(seg):
    assert rows(h.tier_summary(seg, VALUES)) == [
        ("all", 9, 1, 1 / 9, 3), ("bronze", 1, 0, 0.0, 1), ("gold", 5, 1, 0.2, 1), ("silver", 3, 0, 0.0, 1)]
    assert rows(h.tier_summary(seg, VALUES, 0.9), "segment_tier", "row_count") == [("all", 4), ("bronze", 1), ("silver", 3)]


def test_duration_report(seg):
    got = {r.min_hours: r for r in h.duration_report(seg, (3, 5, 100)).collect()}
    assert {k: (r.total_hours, r.segment_count) for k, r in got.items()} == {0: (9, 3), 3: (8, 2), 5: (5, 1), 100: (0, 0)}
    assert got[0].maximum_potential == 12 * 2 and got[3].hours_share == 8 / 24 and got[5].segment_share == 1 / 3


def test_histogram(spark, seg):
    got = h.density_histogram(seg, 4).orderBy("bin").collect()
    assert [r.segment_count for r in got] == [1, 0, 0, 2]
    assert (got[0].bin_start, round(got[3].bin_end, 9)) == (0.8, 1.0)
    flat = h.density_histogram(seg.filter("location_id = 'y'"), 4).orderBy("bin").collect()
    assert [r.segment_count for r in flat] == [0, 0, 1, 0] and (flat[0].bin_start, flat[3].bin_end) == (0.5, 1.5)
    assert h.density_histogram(seg.limit(0)).count() == 0


def test_timeline(seg):
    assert rows(h.segment_timeline(seg)) == [("x", "x_S1", hour(0), 5, 0.8, "medium", 1, 2)]
    assert h.segment_timeline(seg, date_from=hour(5)).count() == 0
    assert h.segment_timeline(seg, date_to=hour(1)).count() == 1
    assert h.segment_timeline(seg, date_to=hour(0)).count() == 0


def test_ranking_by_perfect_hours(spark, seg):
    where = spark.createDataFrame([("x", 1.0, 2.0), ("x", 1.0, 2.0), ("z", 3.0, 4.0)], "location_id string, location_latitude double, location_longitude double")
    assert rows(h.rank_by_perfect_hours(seg, where, perfect=2)) == [("x", 4, 5, 0.8, 1.0, 2.0)]


def test_averages_and_top_k(spark, seg):
    assert rows(h.mean_by_parameter(seg, VALUES)) == [("x", "a", 2.0), ("x", "b", 10.0)]
    means = spark.createDataFrame([("p", "a", 1.0), ("q", "a", 3.0), ("r", "a", 3.0), ("s", "b", 0.0)], "location_id string, sensor_name string, avg_val double")
    assert [tuple(r) for r in h.rank_by_average(means, 2).collect()] == [("q", "a", 3.0, 1), ("r", "a", 3.0, 2), ("s", "b", 0.0, 1)]
    wide = spark.createDataFrame([("p", 1.0, None), ("q", None, None)], "location_id string, a double, b double")
    assert rows(h.unpivot_values(wide, VALUES)) == [("p", "a", 1.0)]


def test_split(seg):
    gold = h.gold_locations(seg)
    assert rows(gold) == [("x",)]
    assert rows(h.gold_locations(seg, F.col("segment_perfect_density") >= 0.9)) == []
    assert rows(h.split_locations(gold, ["x"])) == [] and rows(h.split_locations(gold, ["y"])) == [("x",)]
    assert rows(h.split_report(seg, ["y"])) == [("x", 5, 0, 5)]
    shares = rows(h.split_shares(h.split_report(seg, ["y"]), 1))
    assert shares == [("test", 1, 1, 1.0, 0, 5, 0.0), ("train", 1, 1, 1.0, 5, 5, 1.0)]
    assert rows(h.monthly_perfect_hours(seg, ["x"], perfect=2)) == [("x", "2024-01", 4)]


def test_split_without_gold(spark, seg):
    """As floating-point division in SQL: nothing of nothing is NaN, listed locations of none are infinite."""
    shares = {r.split: r for r in h.split_shares(h.split_report(seg.filter("segment_tier <> 'gold'"), ["y"]), 1).collect()}
    assert math.isnan(shares["train"].location_share) and shares["test"].location_share == math.inf
    assert tuple(shares["test"])[1:3] == (1, 0) and tuple(shares["train"])[1:3] == (0, 0)
    assert all(r.measurements is None and r.total_measurements is None and r.measurement_share is None for r in shares.values())


def test_membership_is_exact(spark):
    df = spark.createDataFrame([("12",), ("2",), (None,)], "id string")
    assert [r[0] for r in df.select(h.is_member("id", ["123", "2"])).collect()] == [False, True, False]


def test_composed_reports(spark, seg):
    parts = segment_report(seg, VALUES)
    assert parts["overlaps"].count() == 0 and parts["tiers"].count() == 4
    parts = split_report(seg, ["x"], perfect=2)
    assert parts["timeline"].count() == 1 and parts["train_locations"].count() == 0


def test_parameter_report(spark):
    data = [("p", n, hour(i)) for n in "abc" for i in range(10)] + [("q", n, hour(i)) for n in "ab" for i in range(10)]
    data += [("q", "c", hour(0))] + [("r", "c", hour(0)), ("r", "a", hour(1))] + [("s", "d", hour(1))]
    df = spark.createDataFrame(data, "location_id string, sensor_name string, datetimeto_utc timestamp_ntz")
    parts = parameter_report(df, n=3)
    assert [r[0] for r in parts["ranking"].collect()] == ["a", "c", "b", "d"]
    assert rows(parts["coverage"]) == [("p", 3, "full"), ("q", 3, "full")]  # the rarest of the top three is b
    assert rows(parts["coverage_share"]) == [(2, 2, 1.0)]
    matrix = {r.location_id: r for r in parts["matrix"].collect()}
    assert matrix["p"].kept and not matrix["q"].kept and matrix["q"].c == 0.1 and matrix["q"].minimum == 0.1
    assert round(matrix["q"].average, 9) == 0.7


def test_profile_picks_its_columns(spark):
    df = spark.createDataFrame([("u", hour(0), hour(9))], "unique_id string, ds timestamp_ntz, datetimeto_utc timestamp_ntz")
    assert h.profile(df).first().time_column == "ds"
    assert "unique_pollutants" not in h.profile(df).columns


def test_gaps(spark):
    times = [0, 0, 1, 7, 8, 20, 20]
    df = spark.createDataFrame([("x", "n", hour(t)) for t in times], "location_id string, sensor_name string, datetimeto_utc timestamp_ntz")
    assert rows(h.gap_distribution(df)) == [(12, 1), (6, 1)]


def test_filters(spark):
    df = spark.createDataFrame([("a", hour(0), hour(5)), ("b", hour(6), hour(9)), ("c", None, None)], "id string, f timestamp_ntz, l timestamp_ntz")
    assert rows(h.active_between(df, "f", "l", hour(5), hour(5)), "id") == [("a",)]
    assert rows(h.active_between(df, "f", "l", date_from=hour(6)), "id") == [("b",)]
    assert h.active_between(df, "f", "l").count() == 3
    ids = spark.createDataFrame([("a",), (None,)], "x string")
    assert rows(h.exclude_ids(df, ids, "id", "x"), "id") == [("b",), ("c",)]
    banned = spark.createDataFrame([("9593",), ("1",), (None,)], "sensor_id string")
    assert rows(exclude_banned(banned, "sensor_id")) == [("1",), (None,)]
    box = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.1, 1.0)], "lon double, lat double")
    assert h.in_bbox(box, "lon", "lat", 0.0, 0.0, 1.0, 1.0).count() == 2


def test_sensors_with_dates(spark):
    locations = spark.createDataFrame([("L", hour(0), hour(5)), ("M", hour(0), hour(1))], "id string, datetimeFirst_utc timestamp, datetimeLast_utc timestamp")
    sensors = spark.createDataFrame([("s", "L"), ("t", "M"), ("u", "none")], "id string, location_id string")
    assert rows(sensors_with_dates(sensors, locations, date_from=hour(2)), "id") == [("s",)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", hour(0)), (1, "b", hour(1)), (None, "a", hour(2)), (None, None, hour(2))], "k int, v string, t timestamp_ntz")
    assert rows(h.check_unique(df, "k")) == [(1, 2)]
    assert rows(h.check_unique(df, ["k", "v"])) == []
    assert rows(h.check_unique(df, "v", hour(1), "t")) == []
    assert h.check_not_null(df, "v").count() == 1
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert rows(h.check_relationship(df, "v", parent, "id")) == [("b", 1)]
    assert rows(h.check_accepted(df, "v", ["a"])) == [("b", 1)]
    empty = df.withColumn("nothing", F.lit(None).cast("int"))
    assert rows(h.check_at_least_one(empty, ["k", "nothing"])) == [("nothing", 0)]
    for age, want in ((24, "pass"), (25, "warn"), (72, "warn"), (73, "error")):
        assert h.check_freshness(df, "t", hour(2 + age)).first().status == want
    assert h.check_freshness(df.limit(0), "t", hour(0)).first().status == "error"


def test_declared_constraints(spark):
    at = (hour(0),) * 3
    sensors = spark.createDataFrame([("s", "L", *[None] * 5, *at), ("s", "M", *[None] * 5, *at)], SPECS["sensors"].schema)
    locations = spark.createDataFrame([{"id": "L", "ingested_at": hour(0), "updated_at": hour(0), "refreshed_at": hour(0)}], SPECS["locations"].schema)
    got = dict(rows(check_constraints({"sensors": sensors, "locations": locations}, SPECS), "rule", "violations"))
    assert got["location_id -> locations.id"] == 1 and got["required"] == 0
    got = rows(check_constraints({"sensors": sensors}, SPECS))
    assert got == [("sensors", "required", 0), ("sensors", "unique(id)", 1)]
