"""Replace parts of stored tables so that a killed job leaves nothing half done.

Everything is built aside first, in a journal folder next to the table. Only when all of it is there, and what is to be
replaced has been noted, it is copied to the tables; a copy can be repeated. The next call for the table copies what an
entry still owes, and drops entries that were not built in full. The notes of past entries tell which rows the table holds,
by day, so the watermark of a refresh need not be read off rows of which some may be missing.

A table that has no file yet has no rows to keep, so its first load is built in its place and stored once. The entry is marked
before; if the load is killed, the next call drops what there is of the table.

One writer per table is assumed. Readers that come while days are copied see some of them old and some new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import paths

DONE, COMPACTED, FIRST, COMPACT_AFTER = "_DONE", "_COMPACTED", "_FIRST", 16
DAYS, WHOLE = "days", "whole"
NOTES = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("path", T.StringType()), T.StructField("mode", T.StringType()),
    T.StructField("grain", T.StringType()), T.StructField("day", T.DateType()), T.StructField("newest", T.TimestampType()),
    T.StructField("n_rows", T.LongType()), T.StructField("kind", T.StringType()),
])


@dataclass(frozen=True)
class Output:
    """Rows for one stored table. ``mode`` "days" replaces the dates of ``grain`` that occur in ``df`` or in ``gone``, "whole"
    the table. ``updated`` names the column whose newest value is noted. ``df`` may be a function of what has been built
    before it, so that rows needn't be computed again for a summary of them. With ``gather`` the rows of a date are brought
    together before they are written; without, each task writes a file for every date it holds, and no row is shuffled for it."""

    df: DataFrame | Callable[[list[DataFrame]], DataFrame]
    path: str
    mode: str = DAYS
    grain: str | None = "day"
    sort_cols: Sequence[str] = ()
    updated: str | None = None
    gone: DataFrame | None = None
    gather: bool = True


def journal(path: str) -> str:
    """The journal of a table: a hidden folder beside it, on the same file system, for as long as the table lives."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{name}.journal"


def _entries(spark: SparkSession, path: str) -> list[str]:
    return paths.folders(spark, journal(path))


def _number(entry: str) -> int:
    return int(entry.rsplit("/", 1)[1].split("-")[0])


def _stage(out: Output, folder: str) -> None:
    df = out.df
    if out.grain:
        df = df.hint("rebalance", F.col(out.grain)) if out.gather else df
        df = df.sortWithinPartitions(out.grain, *out.sort_cols)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(out.grain) if out.grain else writer).parquet(folder)


def _notes(spark: SparkSession, out: Output, part: int, folder: str, schema: T.StructType) -> DataFrame:
    """What was built, a row for each date; dates without rows have none to copy."""
    built = spark.read.schema(schema).parquet(folder)
    dated = out.grain and schema[out.grain].dataType == T.DateType()
    day = F.col(out.grain) if dated else F.lit(None).cast("date")
    newest = F.col(out.updated).cast("timestamp") if out.updated and out.updated in built.columns else F.lit(None).cast("timestamp")
    rows = built.groupBy(day.alias("day")).agg(F.max(newest).alias("newest"), F.count(F.lit(1)).alias("n_rows"))
    if out.mode == DAYS and out.gone is not None:
        gone = out.gone.select(F.col(out.grain).cast("date").alias("day")).distinct().join(rows.select("day"), "day", "left_anti")
        rows = rows.unionByName(gone.select("day", F.lit(None).cast("timestamp").alias("newest"), F.lit(0).cast("long").alias("n_rows")))
    if out.mode == WHOLE:  # a table may have no row at all
        rows = rows.unionByName(spark.range(1).select(F.lit(None).cast("date").alias("day"), F.lit(None).cast("timestamp").alias("newest"), F.lit(0).cast("long").alias("n_rows")))
    fixed = [F.lit(part).alias("part"), F.lit(out.path).alias("path"), F.lit(out.mode).alias("mode"), F.lit(out.grain).cast("string").alias("grain")]
    return rows.select(*fixed, "day", "newest", "n_rows", F.lit(schema.json()).alias("kind"))


def publish(spark: SparkSession, home: str, outputs: Iterable[Output]) -> None:
    """Build all outputs, then put them in place together. ``home`` is the table whose journal keeps the entry."""
    finish(spark, home)
    outputs = list(outputs)
    entries = _entries(spark, home)
    entry = f"{journal(home)}/{max(map(_number, entries), default=0) + 1:09d}-{uuid.uuid4().hex}"
    first = [out.path for out in outputs] == [home] and outputs[0].mode == WHOLE and not paths.has_files(spark, home)
    if first:
        paths.touch(spark, f"{entry}/{FIRST}")
    build(spark, entry, outputs, first)
    _apply(spark, entry)
    _compact(spark, home)


def build(spark: SparkSession, entry: str, outputs: Sequence[Output], first: bool = False) -> None:
    """Write the outputs aside, or in place if that is the ``first`` load of the table, and then the notes of them."""
    notes, built = None, []
    for k, out in enumerate(outputs):
        if not isinstance(out.df, DataFrame):
            out = replace(out, df=out.df(built))
        folder = out.path if first else f"{entry}/{k}"
        _stage(out, folder)
        built.append(spark.read.schema(out.df.schema).parquet(folder))
        one = _notes(spark, out, k, folder, out.df.schema)
        notes = one if notes is None else notes.unionByName(one)
    # the notes are complete last, and their marker says that everything is
    notes.coalesce(1).write.mode("overwrite").parquet(f"{entry}/notes")


def _read_notes(spark: SparkSession, entry: str) -> DataFrame:
    return spark.read.schema(NOTES).parquet(f"{entry}/notes")


def _apply(spark: SparkSession, entry: str) -> None:
    """Copy what an entry holds to its tables. Doing it twice in a row gives the same tables."""
    parts = _read_notes(spark, entry).groupBy("part", "path", "mode", "grain", "kind").agg(F.sum("n_rows").alias("n")).orderBy("part").collect()
    for p in () if paths.exists(spark, f"{entry}/{FIRST}") else parts:
        _copy(spark, f"{entry}/{p['part']}", p["path"], p["mode"], p["grain"], p["n"], T.StructType.fromJson(json.loads(p["kind"])))
        if p["mode"] == DAYS:
            empty = _read_notes(spark, entry).filter((F.col("part") == p["part"]) & (F.col("n_rows") == 0)).select("day").collect()
            for r in empty:  # at most one for each day of the calendar
                name = "__HIVE_DEFAULT_PARTITION__" if r["day"] is None else r["day"].isoformat()
                paths.delete(spark, f"{p['path']}/{p['grain']}={name}")
    paths.touch(spark, f"{entry}/{DONE}")
    for p in parts:
        paths.delete(spark, f"{entry}/{p['part']}")


def _copy(spark: SparkSession, staged: str, path: str, mode: str, grain: str | None, n_rows: int, schema: T.StructType) -> None:
    if mode == DAYS and not n_rows:
        return
    writer = spark.read.schema(schema).parquet(staged).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic" if mode == DAYS else "static")
    (writer.partitionBy(grain) if grain else writer).parquet(path)


def finish(spark: SparkSession, home: str) -> int:
    """Copy what entries still owe; drop those that were not built in full. Returns how many were copied."""
    copied = 0
    for entry in _entries(spark, home):
        if paths.exists(spark, f"{entry}/{DONE}"):
            continue
        told = paths.is_complete(spark, f"{entry}/notes")
        if told and paths.exists(spark, f"{entry}/{COMPACTED}"):
            paths.touch(spark, f"{entry}/{DONE}")
        elif told:
            _apply(spark, entry)
            copied += 1
        else:
            if paths.exists(spark, f"{entry}/{FIRST}"):
                paths.delete(spark, home)
            paths.delete(spark, entry)
    return copied


def known_days(spark: SparkSession, home: str, path: str | None = None) -> DataFrame | None:
    """What the table (``path``, by default the home) holds by its journal: day, newest, n_rows. None without a journal."""
    done = [e for e in _entries(spark, home) if paths.exists(spark, f"{e}/{DONE}")]
    if not done:
        return None
    notes = None
    for e in done:  # COMPACT_AFTER of them at most
        one = _read_notes(spark, e).withColumn("entry", F.lit(_number(e)))
        notes = one if notes is None else notes.unionByName(one)
    notes = notes.filter(F.col("path") == (path or home))
    fresh = notes.filter(F.col("mode") == WHOLE).agg(F.coalesce(F.max("entry"), F.lit(0))).scalar()
    last = Window.partitionBy("day").orderBy(F.col("entry").desc(), F.col("n_rows").desc())
    notes = notes.filter(F.col("entry") >= fresh).withColumn("_rank", F.row_number().over(last))
    return notes.filter("_rank = 1 and n_rows > 0").select("day", "newest", "n_rows")


def _compact(spark: SparkSession, home: str) -> None:
    """One entry instead of many: what all of them say of each table."""
    done = [e for e in _entries(spark, home) if paths.exists(spark, f"{e}/{DONE}")]
    if len(done) <= COMPACT_AFTER:
        return
    tables = _read_notes(spark, done[-1]).select("path", "grain", "part")
    for e in done[:-1]:
        tables = tables.unionByName(_read_notes(spark, e).select("path", "grain", "part"))
    rows = None
    for t in tables.distinct().collect():
        one = known_days(spark, home, t["path"]).select(
            F.lit(t["part"]).alias("part"), F.lit(t["path"]).alias("path"), F.lit(WHOLE).alias("mode"), F.lit(t["grain"]).cast("string").alias("grain"), "day", "newest", "n_rows"
        )
        rows = one if rows is None else rows.unionByName(one)
    entry = f"{journal(home)}/{_number(done[-1]) + 1:09d}-{uuid.uuid4().hex}"
    paths.touch(spark, f"{entry}/{COMPACTED}")
    rows.withColumn("kind", F.lit(None).cast("string")).coalesce(1).write.parquet(f"{entry}/notes")
    paths.touch(spark, f"{entry}/{DONE}")
    for e in done:
        paths.delete(spark, e)


def replace_table(spark: SparkSession, df: DataFrame, path: str, grain: str | None = None, sort_cols: Sequence[str] = (), updated: str | None = None) -> None:
    """Truncate and load, but never without a copy: the old rows go when all of the new ones are there."""
    publish(spark, path, [Output(df, path, WHOLE, grain, sort_cols, updated)])
