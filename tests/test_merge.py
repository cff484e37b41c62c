import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.sources import paths
from hourloom.specs import TableSpec, schema_of

OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
COLS = "id string, v double, w string, ingested_at timestamp, updated_at timestamp, refreshed_at timestamp"
SPEC = TableSpec("things", schema_of("id! string, v double, w string, ingested_at! utc, updated_at! utc, refreshed_at! utc"), ("id",))
DAILY = TableSpec(
    "daily", schema_of("id! string, at! utc, v double, ingested_at! utc, updated_at! utc, refreshed_at! utc"),
    ("id", "at"), time_col="at", sort_cols=("id",),
)


def make(spark, data, at):
    return spark.createDataFrame([(*d, at, at, at) for d in data], COLS)


def test_actions_and_columns(spark):
    target = make(spark, [("keep", 1.0, "a"), ("same", 1.0, None), ("value", 1.0, "a"), ("null", None, "a")], OLD)
    staged = make(spark, [("same", 1.0, None), ("value", 2.0, "a"), ("null", 5.0, "a"), ("new", 3.0, "z")], NEW)
    assert rows(h.merge_changes(target, staged, ["id"])) == [
        ("keep", 1.0, "a", OLD, OLD, OLD, "keep"),
        ("new", 3.0, "z", NEW, NEW, NEW, "insert"),
        ("null", 5.0, "a", OLD, NEW, NEW, "update"),
        ("same", 1.0, None, OLD, OLD, NEW, "refresh"),
        ("value", 2.0, "a", OLD, NEW, NEW, "update"),
    ]


def test_second_time_only_refreshes(spark):
    target = make(spark, [("a", 1.0, "x"), ("b", 2.0, None)], OLD)
    staged = make(spark, [("a", 9.0, "x"), ("c", 1.0, "n")], NEW)
    once = h.merge_changes(target, staged, ["id"]).drop("_action")
    later = dt.datetime(2024, 3, 1)
    again = h.merge_changes(once, staged.withColumns({c: F.lit(later) for c in ("ingested_at", "updated_at", "refreshed_at")}), ["id"])
    assert {r[0] for r in again.select("_action").distinct().collect()} == {"keep", "refresh"}
    before, after = (rows(d, "id", "v", "w", "ingested_at", "updated_at") for d in (once, again))
    assert before == after
    assert rows(again, "id", "refreshed_at") == [("a", later), ("b", OLD), ("c", later)]


def test_null_keys_never_match(spark):
    target = make(spark, [(None, 1.0, "t"), ("a", 1.0, "t")], OLD)
    staged = make(spark, [(None, 1.0, "s"), (None, 2.0, "s")], NEW)
    assert rows(h.merge_changes(target, staged, ["id"]), "id", "w", "_action") == [
        ("a", "t", "keep"), (None, "s", "insert"), (None, "s", "insert"), (None, "t", "keep"),
    ]


def test_duplicates(spark):
    target = make(spark, [("a", 1.0, "t")], OLD)
    double = make(spark, [("a", 2.0, "s")], OLD).unionByName(make(spark, [("a", 3.0, "s")], NEW))
    with pytest.raises(Exception, match="several staged rows"):
        h.merge_changes(target, double, ["id"]).drop("_action").collect()
    assert rows(h.merge_changes(target, double, ["id"], on_duplicate="latest"), "id", "v", "_action") == [("a", 3.0, "update")]
    # without a target row to update, both are inserted
    fresh = double.withColumn("id", F.lit("n"))
    assert h.merge_changes(target, fresh, ["id"]).filter("_action = 'insert'").count() == 2
    with pytest.raises(ValueError):
        h.merge_changes(target, double, ["id"], on_duplicate="ignore")


def test_upsert_table_and_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    assert h.upsert_table(spark, path, make(spark, [("a", 1.0, "x"), ("b", 1.0, "x")], OLD), SPEC)
    assert h.upsert_table(spark, path, make(spark, [("b", 2.0, "x"), ("c", 1.0, "x")], NEW), SPEC)
    assert not h.upsert_table(spark, path, make(spark, [], NEW), SPEC)
    assert rows(h.read_table(spark, path, SPEC), "id", "v", "ingested_at") == [("a", 1.0, OLD), ("b", 2.0, OLD), ("c", 1.0, NEW)]


def daily(spark, data, at):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d, hh), v, at, at, at) for i, d, hh, v in data], DAILY.schema)


def test_upsert_by_day_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    h.upsert_table(spark, path, daily(spark, [("a", 1, 0, 1.0), ("a", 2, 0, 1.0), ("b", 2, 5, 1.0), ("a", 3, 0, 1.0)], OLD), DAILY)
    day1 = sorted(p.name for p in (tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    h.upsert_table(spark, path, daily(spark, [("a", 2, 0, 7.0), ("c", 4, 0, 1.0)], NEW), DAILY)
    assert day1 == sorted(p.name for p in (tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    got = rows(h.read_table(spark, path, DAILY).select("id", F.dayofmonth("at"), "v"))
    assert got == [("a", 1, 1.0), ("a", 2, 7.0), ("a", 3, 1.0), ("b", 2, 1.0), ("c", 4, 1.0)]


def test_batch_is_replayed_not_merged_again(spark, tmp_path):
    path, scratch = str(tmp_path / "t"), str(tmp_path / "scratch")
    h.upsert_table(spark, path, make(spark, [("a", 1.0, "x")], OLD), SPEC, batch="1", scratch=scratch)
    # the same batch again, whatever it now holds, is not merged a second time
    h.upsert_table(spark, path, make(spark, [("a", 5.0, "x")], NEW), SPEC, batch="1", scratch=scratch)
    assert rows(h.read_table(spark, path, SPEC), "id", "v") == [("a", 1.0)]
    h.upsert_table(spark, path, make(spark, [("a", 5.0, "x")], NEW), SPEC, batch="2", scratch=scratch)
    assert rows(h.read_table(spark, path, SPEC), "id", "v") == [("a", 5.0)]


def test_stream_upsert(spark, tmp_path):
    landing, target, check = (str(tmp_path / n) for n in ("landing", "target", "check"))
    daily(spark, [("a", 1, 0, 1.0), ("b", 2, 0, 1.0)], OLD).write.parquet(landing)
    h.stream_upsert(spark, landing, target, DAILY, check).awaitTermination()
    daily(spark, [("b", 2, 0, 4.0), ("c", 2, 1, 1.0)], NEW).write.mode("append").parquet(landing)
    h.stream_upsert(spark, landing, target, DAILY, check).awaitTermination()
    h.stream_upsert(spark, landing, target, DAILY, check).awaitTermination()  # nothing new
    got = rows(h.read_table(spark, target, DAILY), "id", "v", "ingested_at", "updated_at")
    assert got == [("a", 1.0, OLD, OLD), ("b", 4.0, OLD, NEW), ("c", 1.0, NEW, NEW)]
    # a new checkpoint reads everything again; files of both batches meet, the newest row wins
    h.stream_upsert(spark, landing, target, DAILY, str(tmp_path / "check2"), on_duplicate="latest").awaitTermination()
    assert rows(h.read_table(spark, target, DAILY), "id", "v", "ingested_at", "updated_at") == got


def test_many_copies_of_a_key(spark):
    target = make(spark, [("a", 1.0, "t"), ("b", 1.0, "t")], OLD)
    staged = make(spark, [("n", float(i), "s") for i in range(5)] + [("b", 2.0, "s"), ("m", 1.0, "s"), ("m", 2.0, "s")], NEW)
    got = h.merge_changes(target, staged, ["id"])
    assert got.filter("_action = 'insert'").count() == 7 and got.count() == 9
    crowded = make(spark, [("a", float(i), "s") for i in range(5)], NEW)
    with pytest.raises(Exception, match="several staged rows"):
        h.merge_changes(target, crowded, ["id"]).collect()
    # copies in the target, which an earlier merge inserted, are all updated
    copies = make(spark, [("n", float(i), "t") for i in range(4)], OLD)
    assert rows(h.merge_changes(copies, make(spark, [("n", 9.0, "s")], NEW), ["id"]), "v", "_action") == [(9.0, "update")] * 4


def test_null_and_crowded_keys_together(spark):
    target = make(spark, [(None, 1.0, "t"), ("a", 1.0, "t")], OLD)
    staged = make(spark, [(None, float(i), "s") for i in range(5)] + [("a", 2.0, "s")], NEW)
    got = rows(h.merge_changes(target, staged, ["id"]).groupBy("_action").count())
    assert got == [("insert", 5), ("keep", 1), ("update", 1)]


def test_joins_can_be_split_and_broadcast(spark):
    target, staged = make(spark, [("a", 1.0, "t")], OLD), make(spark, [("a", 2.0, "s")], NEW)
    plan = h.merge_changes(target, staged, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftOuter" in plan


def dies(monkeypatch, spark):
    """The copy to the table dies after the table has been emptied."""
    from hourloom.operators import merge

    def broken(spark_, path, spec, work):
        if paths.exists(spark_, path):
            paths.delete(spark_, path)
        raise OSError("executor lost")

    monkeypatch.setattr(merge, "_apply", broken)


@pytest.mark.parametrize("first,second", [(None, None), ("1", "1"), ("1", "2"), (None, "2"), ("1", None)])
def test_a_killed_copy_is_finished_by_whoever_comes_next(spark, tmp_path, monkeypatch, first, second):
    path, scratch = str(tmp_path / "t"), str(tmp_path / "scratch")
    h.upsert_table(spark, path, make(spark, [("a", 1.0, "x"), ("b", 1.0, "x")], OLD), SPEC, scratch=scratch)
    batch = make(spark, [("c", 1.0, "x")], NEW)
    with monkeypatch.context() as m:
        dies(m, spark)
        with pytest.raises(OSError):
            h.upsert_table(spark, path, batch, SPEC, batch=first, scratch=scratch)
    h.upsert_table(spark, path, batch if first == second else make(spark, [("d", 1.0, "x")], NEW), SPEC, batch=second, scratch=scratch)
    want = ["a", "b", "c"] + ([] if first == second else ["d"])
    assert rows(h.read_table(spark, path, SPEC), "id") == [(x,) for x in want]


def test_an_old_batch_is_not_written_over_a_newer_one(spark, tmp_path):
    path, scratch = str(tmp_path / "t"), str(tmp_path / "scratch")
    for name, v in (("1", 1.0), ("2", 2.0), ("1", 1.0)):
        h.upsert_table(spark, path, make(spark, [("a", v, "x")], NEW), SPEC, batch=name, scratch=scratch)
    assert rows(h.read_table(spark, path, SPEC), "id", "v") == [("a", 2.0)]


def test_the_time_column_must_be_a_key(spark, tmp_path):
    spec = TableSpec("moving", DAILY.schema, ("id",), time_col="at")
    with pytest.raises(ValueError, match="must be one of the keys"):
        h.upsert_table(spark, str(tmp_path / "t"), daily(spark, [("a", 1, 0, 1.0)], OLD), spec)


def test_a_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    staged = make(spark, [("a", 1.0, "x"), ("b", 1.0, "x")], OLD)
    h.upsert_table(spark, str(tmp_path / "t"), staged.mapInArrow(count, staged.schema), SPEC)
    assert seen.value == 2


def test_landed_files_under_one_name(spark, tmp_path):
    path, landing = str(tmp_path / "t"), str(tmp_path / "landing")
    for key in ("a", "b", "c"):
        make(spark, [(key, 1.0, "x")], OLD).coalesce(1).write.mode("append").parquet(landing)
        assert h.upsert_files(spark, path, landing, SPEC, batch="d1", scratch=str(tmp_path / "s"))
    assert rows(h.read_table(spark, path, SPEC), "id") == [("a",), ("b",), ("c",)]
    assert not paths.has_files(spark, landing)


def test_files_that_stay_are_not_merged_twice(spark, tmp_path):
    path, landing, scratch = (str(tmp_path / n) for n in ("t", "landing", "s"))
    for at in (OLD, NEW):  # the same key in two files: read together they would fail
        make(spark, [("a", 1.0, "x")], at).coalesce(1).write.mode("append").parquet(landing)
        assert h.upsert_files(spark, path, landing, SPEC, clear=False, scratch=scratch)
        assert not h.upsert_files(spark, path, landing, SPEC, clear=False, scratch=scratch)
    assert not h.upsert_files(spark, path, landing, SPEC, scratch=scratch) and not paths.has_files(spark, landing)
    assert rows(h.read_table(spark, path, SPEC), "id", "refreshed_at") == [("a", NEW)]


def test_killed_copy_of_landed_files(spark, tmp_path, monkeypatch):
    path, landing, scratch = (str(tmp_path / n) for n in ("t", "landing", "s"))
    make(spark, [("a", 1.0, "x")], OLD).coalesce(1).write.parquet(landing)
    with monkeypatch.context() as m:
        dies(m, spark)
        with pytest.raises(OSError):
            h.upsert_files(spark, path, landing, SPEC, scratch=scratch)
    make(spark, [("b", 1.0, "x")], OLD).coalesce(1).write.mode("append").parquet(landing)
    assert h.upsert_files(spark, path, landing, SPEC, scratch=scratch)
    assert rows(h.read_table(spark, path, SPEC), "id") == [("a",), ("b",)] and not paths.has_files(spark, landing)


def test_landed_files_are_merged_and_removed(spark, tmp_path):
    path, landing = str(tmp_path / "t"), tmp_path / "landing"
    assert not h.upsert_files(spark, path, str(landing), SPEC)
    for n, (data, at) in enumerate((([("a", 1.0, "x")], OLD), ([("a", 2.0, "x"), ("b", 1.0, "x")], NEW))):
        make(spark, data, at).write.mode("append").parquet(str(landing))
        assert h.upsert_files(spark, path, str(landing), SPEC, clear=n == 0)
        assert (len(list(landing.glob("*.parquet"))) == 0) == (n == 0)
    assert rows(h.read_table(spark, path, SPEC), "id", "v", "ingested_at") == [("a", 2.0, OLD), ("b", 1.0, NEW)]


def test_stream_clears_what_it_has_merged(spark, tmp_path):
    landing, target, check = tmp_path / "landing", str(tmp_path / "target"), str(tmp_path / "check")
    first = None
    for d in (1, 2, 3):
        daily(spark, [("a", d, 0, 1.0)], OLD).coalesce(1).write.mode("append").parquet(str(landing))
        first = first or [p.name for p in landing.glob("*.parquet")]
        h.stream_upsert(spark, str(landing), target, DAILY, check, clear_landed=True, files_per_batch=1).awaitTermination()
    assert h.read_table(spark, target, DAILY).count() == 3
    assert not any((landing / n).exists() for n in first)


def test_other_days_are_pruned(spark, tmp_path):
    from hourloom.operators.merge import _touched

    path = str(tmp_path / "t")
    h.upsert_table(spark, path, daily(spark, [("a", d, 0, 1.0) for d in range(1, 9)], OLD), DAILY)
    got = _touched(spark.read.parquet(path), daily(spark, [("x", 2, 0, 1.0)], NEW), DAILY)
    assert rows(got.select("id", F.dayofmonth("at"))) == [("a", 2)]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-02" in text[text.index("PartitionFilters"):].split("PushedFilters")[0]


def test_rows_without_a_time_are_kept(spark, tmp_path):
    loose = TableSpec("loose", schema_of("id! string, at utc, v double, ingested_at! utc, updated_at! utc, refreshed_at! utc"), ("id", "at"), time_col="at")

    def make_loose(data, at):
        return spark.createDataFrame([(i, t, v, at, at, at) for i, t, v in data], loose.schema)

    path = str(tmp_path / "t")
    h.upsert_table(spark, path, make_loose([("a", None, 1.0), ("a", OLD, 1.0)], OLD), loose)
    h.upsert_table(spark, path, make_loose([("a", OLD, 2.0)], NEW), loose)
    h.upsert_table(spark, path, make_loose([("a", None, 3.0)], NEW), loose)
    assert rows(h.read_table(spark, path, loose), "id", "at", "v") == [("a", None, 1.0), ("a", None, 3.0), ("a", OLD, 2.0)]
