import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.operators import publish as pub
from hourloom.sources import paths

AS_OF = "2024-03-31 00:00:00"
SCHEMA = "k string, ts timestamp, v int, updated_at timestamp"


class Killed(RuntimeError):
    pass


def day(n, hour=0):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n - 1, hours=hour)


FIRST = [(k, day(n), n, day(n)) for n in range(20, 26) for k in ("a", "b")]
# three changed days; the newest update stands on the first of them
LATER = [r for r in FIRST if not (r[0] == "a" and r[1] in (day(21), day(23), day(25)))] + [
    ("a", day(21), 210, day(30)), ("a", day(23), 230, day(29)), ("a", day(25), 250, day(28)), ("c", day(27), 1, day(28))
]


def build(df):
    return h.keep_latest(df, ["k", "ts"], ["updated_at"], ["v"])


def refresh(spark, data, path, **more):
    h.refresh_days(spark, spark.createDataFrame(data, SCHEMA), path, build, "ts", AS_OF, **more)


def held(spark, path):
    return rows(spark.read.parquet(path), "k", "ts", "v", "updated_at")


def wanted(spark, data, tmp_path):
    refresh(spark, data, str(tmp_path / "full"), full=True)
    return held(spark, str(tmp_path / "full"))


def test_killed_while_partitions_are_replaced(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    refresh(spark, FIRST, path)
    real = pub._copy

    def one_day_only(spark, staged, path, mode, grain, n_rows, schema):
        part = spark.read.schema(schema).parquet(staged).filter(F.col(grain) == F.lit(day(21).date()))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(grain).parquet(path)
        raise Killed

    monkeypatch.setattr(pub, "_copy", one_day_only)
    with pytest.raises(Killed):
        refresh(spark, LATER, path)
    monkeypatch.setattr(pub, "_copy", real)
    half = held(spark, path)
    assert ("a", day(21), 210, day(30)) in half and ("a", day(23), 23, day(23)) in half
    refresh(spark, LATER, path)  # the newest update is in the table already, the others aren't
    assert held(spark, path) == wanted(spark, LATER, tmp_path)


def test_killed_while_building(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    refresh(spark, FIRST, path)
    before = held(spark, path)

    def killed(*_):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(pub, "_notes", killed)
        with pytest.raises(Killed):
            refresh(spark, LATER, path)
    assert held(spark, path) == before
    assert pub.finish(spark, path) == 0  # nothing was promised
    refresh(spark, LATER, path)
    assert held(spark, path) == wanted(spark, LATER, tmp_path)


def test_killed_before_it_is_noted_as_done(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    refresh(spark, FIRST, path)
    with monkeypatch.context() as m:
        m.setattr(paths, "touch", lambda *_: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            refresh(spark, LATER, path)
    assert pub.finish(spark, path) == 1
    assert held(spark, path) == wanted(spark, LATER, tmp_path)
    assert pub.finish(spark, path) == 0


def test_watermark_comes_from_the_journal(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark, FIRST, path)
    known = {r["day"]: (r["newest"], r["n_rows"]) for r in pub.known_days(spark, path).collect()}
    assert known == {day(n).date(): (day(n), 2) for n in range(20, 26)}
    # a row that came into the table by another way doesn't lift it
    spark.createDataFrame([("x", day(26), 1, day(31), day(26).date())], SCHEMA + ", day date").write.mode("append").partitionBy("day").parquet(path)
    refresh(spark, LATER, path)
    got = held(spark, path)
    assert [r for r in got if r[0] != "x"] == wanted(spark, LATER, tmp_path)


def test_table_without_journal(spark, tmp_path):
    path = str(tmp_path / "t")
    h.overwrite_days(build(spark.createDataFrame(FIRST, SCHEMA)), path, "ts")
    assert pub.known_days(spark, path) is None
    refresh(spark, LATER, path)
    assert held(spark, path) == wanted(spark, LATER, tmp_path)


def test_days_without_rows_go(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh(spark, FIRST, path)

    def only_b(df):
        return build(df).filter("k <> 'a'")

    data = [r for r in LATER if r[1] != day(25) or r[0] == "a"]
    h.refresh_days(spark, spark.createDataFrame(data, SCHEMA), path, only_b, "ts", AS_OF)
    assert not [r for r in held(spark, path) if r[1] == day(25)]
    assert day(25).date() not in {r["day"] for r in pub.known_days(spark, path).collect()}
    refresh(spark, FIRST[:4], path, full=True)  # in full: days that the source has lost go as well
    assert held(spark, path) == sorted(FIRST[:4], key=repr)


def test_two_tables_are_published_together(spark, tmp_path, monkeypatch):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    df = spark.createDataFrame([(1, day(1).date())], "v int, day date")
    real = pub._copy

    def second_fails(spark, staged, path, *more):
        if path == two:
            raise Killed
        real(spark, staged, path, *more)

    with monkeypatch.context() as m:
        m.setattr(pub, "_copy", second_fails)
        with pytest.raises(Killed):
            pub.publish(spark, one, [pub.Output(df, one), pub.Output(df.drop("day"), two, pub.WHOLE, None)])
    assert not paths.has_files(spark, two)
    pub.finish(spark, one)
    assert rows(spark.read.parquet(two)) == [(1,)] and rows(spark.read.parquet(one), "v") == [(1,)]


def test_journal_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pub, "COMPACT_AFTER", 3)
    path = str(tmp_path / "t")
    for n in range(1, 8):
        df = spark.createDataFrame([(n, day(n % 3 + 1).date(), day(n))], "v int, day date, updated_at timestamp")
        pub.publish(spark, path, [pub.Output(df, path, updated="updated_at")])
    assert len(paths.folders(spark, pub.journal(path))) <= 4
    assert rows(spark.read.parquet(path), "v") == [(5,), (6,), (7,)]
    assert rows(pub.known_days(spark, path), "day", "newest", "n_rows") == [(day(n % 3 + 1).date(), day(n), 1) for n in (6, 7, 5)]


def test_truncate_and_append_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = h.TableSpec("t", h.SENSORS.schema, keys=("id",))
    one = spark.createDataFrame([(f"{i}", "l", *[None] * 5, day(1), day(1), day(1)) for i in range(3)], spec.schema)
    for mode in ("truncate", "truncate", "append"):
        h.load_table(one, path, spec, mode)
    assert spark.read.parquet(path).count() == 6


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], SCHEMA)
    h.refresh_days(spark, none, path, build, "ts", AS_OF)
    refresh(spark, FIRST, path)
    assert len(held(spark, path)) == len(FIRST)
    pub.replace_table(spark, none.withColumn("day", F.to_date("ts")), path, "day")
    assert pub.known_days(spark, path).isEmpty()
    refresh(spark, FIRST, path)
    assert len(held(spark, path)) == len(FIRST)


def test_first_load_is_stored_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    copied, real = [], pub._copy
    monkeypatch.setattr(pub, "_copy", lambda *args: copied.append(args[3]) or real(*args))
    refresh(spark, FIRST, path)
    assert copied == [] and len(held(spark, path)) == len(FIRST)
    refresh(spark, LATER, path)
    assert copied == [pub.DAYS]
    refresh(spark, LATER, path, full=True)  # there are rows to keep until the new ones are there
    assert copied == [pub.DAYS, pub.WHOLE]
    monkeypatch.undo()
    assert held(spark, path) == wanted(spark, LATER, tmp_path)


@pytest.mark.parametrize("step", ["_notes", "_read_notes"])
def test_killed_first_load(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")

    def killed(*_):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(pub, step, killed)
        with pytest.raises(Killed):
            refresh(spark, FIRST, path)
    # without notes nobody knows whether all of it is there; with them nothing is owed
    assert pub.finish(spark, path) == (0 if step == "_notes" else 1)
    assert paths.has_files(spark, path) == (step == "_read_notes")
    refresh(spark, LATER, path)
    assert held(spark, path) == wanted(spark, LATER, tmp_path)
    assert {r["n_rows"] for r in pub.known_days(spark, path).collect()} == {1, 2}
