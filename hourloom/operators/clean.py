"""Bring landed rows into the declared shape of a table (column by column, no shuffle)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import AUDIT_COLUMNS
from ..functions import blank_to_null, instant, moment, nan_to_null, to_double, to_long, wall_clock
from ..specs import TableSpec


def underscore_names(df: DataFrame) -> DataFrame:
    """``a.b.c`` column names to ``a_b_c``."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def sanitize(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Cast every known column to its declared type; blank text and bad numbers become NULL.

    Columns are cast by declared type, so only real ids turn into text and a missing id stays
    NULL. Columns the spec does not know keep their type, with blank text set to NULL.
    ``strict=False`` turns an unreadable timestamp into NULL instead of failing the job.
    """
    df = underscore_names(df)
    declared = {f.name: f.dataType for f in spec.schema}
    out = []
    for f in df.schema:
        c, want = F.col(f"`{f.name}`"), declared.get(f.name)
        text = isinstance(f.dataType, T.StringType)
        if isinstance(want, T.DoubleType):
            c = to_double(c, f.dataType)
        elif isinstance(want, T.LongType):
            c = to_long(c, f.dataType)
        elif isinstance(want, T.TimestampType):
            c = instant(blank_to_null(c) if text else c, strict)
        elif isinstance(want, T.TimestampNTZType):
            c = wall_clock(blank_to_null(c) if text else c, strict)
        elif isinstance(want, T.BooleanType):
            c = c.try_cast("boolean") if text else c.cast("boolean")
        elif isinstance(want, T.StringType):
            c = blank_to_null(c.cast("string"))
        elif text:
            c = blank_to_null(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def stamp_audit(df: DataFrame, batch_ts: dt.datetime | str | Column) -> DataFrame:
    """Add the three audit columns, one moment for the whole batch. A stamped frame is refused."""
    present = [c for c in AUDIT_COLUMNS if c in df.columns]
    if present:
        raise ValueError(f"already stamped: {present}")
    at = moment(batch_ts, T.TimestampType())
    return df.withColumns({c: at for c in AUDIT_COLUMNS})


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the declared columns in order: missing ones NULL, extra ones dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema
        ]
    )


def clean(df: DataFrame, spec: TableSpec, batch_ts, strict: bool = True) -> DataFrame:
    return conform(stamp_audit(sanitize(df, spec, strict), batch_ts), spec)


def drop_unwanted(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def parse_datetimes(df: DataFrame, strict: bool = True) -> DataFrame:
    """Every column with ``datetime`` in its name becomes a timestamp (wall clock if ``local``)."""
    out = {}
    for f in df.schema:
        if "datetime" in f.name.lower():
            kind = wall_clock if "local" in f.name.lower() else instant
            out[f.name] = kind(F.col(f"`{f.name}`"), strict)
    return df.withColumns(out) if out else df


def canonical_sort(
    df: DataFrame, cols=("period_datetimeTo_local", "sensor_id"), within_partitions: bool = False
) -> DataFrame:
    """The order files are written in. Set ``within_partitions`` to sort without a shuffle."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"cannot sort, missing columns: {missing}")
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in cols]
    return df.sortWithinPartitions(*keys) if within_partitions else df.orderBy(*keys)


def ambiguous_local(df: DataFrame, local_col: str, zone: str) -> DataFrame:
    """Rows whose wall clock does not survive the trip to UTC and back (skipped or doubled hours).

    A clock reading that exists twice maps back to itself, so the hour before is checked too.
    """
    local = F.col(local_col).cast("timestamp")
    utc = F.to_utc_timestamp(local, zone)
    hour = F.expr("interval 1 hour")
    skipped = F.from_utc_timestamp(utc, zone) != local
    doubled = (F.from_utc_timestamp(utc - hour, zone) == local) | (
        F.from_utc_timestamp(utc + hour, zone) == local
    )
    return df.filter(skipped | doubled)
