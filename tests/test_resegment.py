import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.operators import publish as pub
from hourloom.operators.grid import dense_grid
from hourloom.operators.resegment import read_segments, refresh_segments

START = dt.datetime(2024, 1, 1)
SCHEMA = "location_id string, datetimeto_utc timestamp, concurrent_sensors long, v double"
OPTIONS = dict(perfect=2, gold_hours=6, silver_hours=3)


def at(hour, minute=0):
    return START + dt.timedelta(hours=hour, minutes=minute)


def grid_of(spark, state):
    data = [(e, at(i), c, float(i)) for e, hours in state.items() for i, c in enumerate(hours)]
    return spark.createDataFrame(data, SCHEMA).withColumn("day", F.to_date("datetimeto_utc"))


def whole(spark, state):
    seg = h.segment(grid_of(spark, state).drop("day"), **OPTIONS)
    return rows(seg, *sorted(seg.columns))


def stored(spark, path):
    seg = read_segments(spark, path)
    return rows(seg, *sorted(seg.columns))


@pytest.mark.parametrize(("seed", "chunk"), [(0, None), (1, None), (2, "day")])
def test_equals_the_full_rebuild(spark, tmp_path, seed, chunk):
    r = random.Random(seed)
    path = str(tmp_path / "seg")
    state = {e: [r.choice([2, 2, 0, 1, 0, 0]) for _ in range(120)] for e in ("a", "b", None)}
    refresh_segments(spark, grid_of(spark, state), path, chunk=chunk, **OPTIONS)
    assert stored(spark, path) == whole(spark, state)
    for step in range(3):
        changed = []
        for e in [*r.sample(["a", "b", None], 2), *(["new"] if step == 1 else [])]:
            since = 0 if e == "new" else r.randrange(len(state[e]))
            hours = list(state.get(e, [0] * 120))
            for i in r.sample(range(since, len(hours)), min(len(hours) - since, r.choice([1, 5, 40]))):
                hours[i] = r.choice([0, 1, 2])
            state[e] = hours
            changed.append((e, at(since)))
        if step == 2:  # the grid grows
            changed += [(e, at(120)) for e in state]
            state = {e: hours + [r.choice([2, 0]) for _ in range(30)] for e, hours in state.items()}
        refresh_segments(spark, grid_of(spark, state), path, spark.createDataFrame(changed, "location_id string, since timestamp"), chunk=chunk, **OPTIONS)
        assert stored(spark, path) == whole(spark, state)


def test_only_dates_from_the_restart_on_are_read(spark, tmp_path):
    hours = ([2, 2, 0, 0, 0, 0, 0, 0] * 30)[:240]
    path, place = str(tmp_path / "seg"), str(tmp_path / "grid")
    grid_of(spark, {"a": hours, "b": hours}).write.partitionBy("day").parquet(place)
    grid = spark.read.parquet(place)
    refresh_segments(spark, grid, path, **OPTIONS)
    seen = []
    real = pub.publish

    def watched(spark, home, outputs):
        seen.append(outputs[0].df._jdf.queryExecution().executedPlan().toString())
        real(spark, home, outputs)

    from hourloom.operators import resegment

    resegment.publish = watched
    try:
        refresh_segments(spark, grid, path, spark.createDataFrame([("a", at(200))], "location_id string, since timestamp"), **OPTIONS)
    finally:
        resegment.publish = real
    scans = [line for line in seen[0].splitlines() if "PartitionFilters" in line and "day" in line.split("PartitionFilters")[1].split("PushedFilters")[0]]
    assert len(scans) >= 2 and all(">= 2024-01-09" in s or ">= 19731" in s for s in scans)
    assert stored(spark, path) == whole(spark, {"a": hours, "b": hours})
    refresh_segments(spark, grid, path, spark.createDataFrame([], "location_id string, since timestamp"), **OPTIONS)
    assert stored(spark, path) == whole(spark, {"a": hours, "b": hours})


def test_killed_between_rows_and_summary(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "seg")
    r = random.Random(9)
    state = {"a": [r.choice([2, 2, 0]) for _ in range(100)]}
    refresh_segments(spark, grid_of(spark, state), path, **OPTIONS)
    state["a"][60:70] = [0] * 10
    real = pub._copy

    def rows_only(spark, staged, to, *more):
        if to.endswith("/segments"):
            raise RuntimeError
        real(spark, staged, to, *more)

    changed = spark.createDataFrame([("a", at(60))], "location_id string, since timestamp")
    with monkeypatch.context() as m:
        m.setattr(pub, "_copy", rows_only)
        with pytest.raises(RuntimeError):
            refresh_segments(spark, grid_of(spark, state), path, changed, **OPTIONS)
    refresh_segments(spark, grid_of(spark, state), path, changed, **OPTIONS)
    assert stored(spark, path) == whole(spark, state)


@pytest.mark.parametrize(("chunk", "minutes"), [("hour", 5), ("day", 60), ("day", 420), ("month", 420)])
def test_grid_by_chunk(spark, chunk, minutes):
    r = random.Random(minutes)
    data = [(e, at(0, minutes * i + off), i, float(i)) for e in ("a", "b", "c") for i in r.sample(range(-5, 300 // (1 + minutes // 60)), 6) for off in (0, r.choice([0, 7]))]
    data = list({(e, t): (e, t, n, v) for e, t, n, v in data}.values()) + [("off", at(0, 1), 1, 1.0), (None, at(0), 1, 1.0)]
    df = spark.createDataFrame(data, SCHEMA)
    end = at(0, minutes * 40)
    plain = dense_grid(df, START, end, step_minutes=minutes)
    split = dense_grid(df, START, end, step_minutes=minutes, chunk=chunk)
    assert rows(split, *split.columns) == rows(plain, *plain.columns)


def test_no_window_holds_an_entity(spark, tmp_path):
    """One entity with a third of all rows at a minute's step: readings are dealt by (entity, chunk) alone."""
    place = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 200).cast("string"))
    df = spark.range(0, 30_000, 1, 4).select(
        place.alias("location_id"), (F.lit(START).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 20_000).cast("int"))).alias("datetimeto_utc"),
        (F.col("id") % 3).alias("concurrent_sensors"), F.col("id").cast("double").alias("v"),
    ).dropDuplicates(["location_id", "datetimeto_utc"])
    path = str(tmp_path / "pivoted")
    df.write.parquet(path)
    grid = dense_grid(spark.read.parquet(path), START, at(0, 20_000), step_minutes=1, chunk="day")
    seg = h.segment(grid, perfect=2, chunk="day")
    text = seg._jdf.queryExecution().executedPlan().toString()
    windows = [w for w in text.splitlines() if " Window " in w or "Window [" in w]
    assert windows and not [w for w in windows if ("lead(_slot" in w or "is_perfect_hour" in w) and "_chunk" not in w.rsplit("], [", 2)[1]]
    plain = h.segment(dense_grid(spark.read.parquet(path).filter("location_id = 'hot'"), START, at(0, 20_000), step_minutes=1), perfect=2)
    some = seg.filter("location_id = 'hot'")
    assert rows(some, *sorted(some.columns)) == rows(plain, *sorted(plain.columns))
