"""Column expressions shared by the operators. All stay in the JVM and inside codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    DENSITY_BANDS, GOLD_HOURS, SILVER_HOURS, VALUE_HIGH, VALUE_LOW,
)

# what counts as a number in text; the JVM parser alone would also take "1.5d"
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"
_WHOLE = r"^\s*([+-]?\d+)(\.0*)?\s*$"
_SCIENTIFIC = r"(?i)\de[+-]?\d"


def blank_to_null(c: Column) -> Column:
    """Empty or whitespace-only text becomes NULL; anything else is untouched."""
    return F.when(~c.rlike(r"(?U)^\s*$"), c)


def nan_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(float("nan")).cast("double"))


def to_double(c: Column, source: T.DataType | None = None) -> Column:
    """Numeric coercion: text that is not a number becomes NULL, and so does NaN."""
    if isinstance(source, T.BooleanType):
        return c.cast("double")
    if source is None or isinstance(source, T.StringType):
        return F.regexp_substr(c.cast("string"), F.lit(_NUMBER)).try_cast("double")
    return nan_to_null(c.try_cast("double"))


def to_long(c: Column, source: T.DataType | None = None) -> Column:
    """As :func:`to_double`, to a long. A value with a fraction becomes NULL, never truncated."""
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("long")
    d = to_double(c, source)
    whole = F.when(d == F.floor(d), d).try_cast("long")
    if source is None or isinstance(source, T.StringType):
        text = c.cast("string")
        digits = F.nullif(F.regexp_extract(text, _WHOLE, 1), F.lit("")).try_cast("long")
        return F.coalesce(digits, F.when(text.rlike(_SCIENTIFIC), whole))
    return whole


# fixed values: names under which the session zone is UTC
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "Etc/Zulu", "UCT", "Universal", "+00:00")


def require_utc() -> None:
    """Fail early in a session of another zone: clock readings and instants would be mixed up silently."""
    spark = SparkSession.getActiveSession()
    zone = spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}; build_session sets it")


def moment(value, kind: T.DataType) -> Column:
    """A point in time given by the caller: text, a datetime, or a column.

    A datetime goes in as text. As a literal it would be read in the time zone of the Python
    process, not of the session.
    """
    require_utc()
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def instant(c: Column, strict: bool = True) -> Column:
    """A moment in time. Text without an offset is read in the session zone, which is UTC."""
    require_utc()
    return c.cast("timestamp") if strict else c.try_cast("timestamp")


def wall_clock(c: Column, strict: bool = True) -> Column:
    """Local clock reading; an offset in the text is dropped, the digits are kept."""
    return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")


def local_to_utc(local: Column, zone: Column | str) -> Column:
    """Wall clock in a named zone to the UTC instant (session zone UTC)."""
    require_utc()
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def truncate(unit: str, ts: Column, kind: T.DataType) -> Column:
    """``date_trunc`` that keeps a wall clock a wall clock."""
    return F.date_trunc(unit, ts).cast(kind)


def hours_between(later: Column, earlier: Column) -> Column:
    """Hour boundaries crossed, so 00:59 to 01:01 is 1. Equal to elapsed hours on an hourly grid."""
    def hour(c):
        return F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(3600))

    return hour(later) - hour(earlier)


def clean_range(c: Column, low: float = VALUE_LOW, high: float = VALUE_HIGH) -> Column:
    """Readings outside ``low <= v < high`` become NULL; the row stays."""
    return F.when(F.isnan(c) | (c < low) | (c >= high), F.lit(None)).otherwise(c)


def segment_tier(hours: Column, gold: int = GOLD_HOURS, silver: int = SILVER_HOURS) -> Column:
    return F.when(hours >= gold, "gold").when(hours >= silver, "silver").otherwise("bronze")


def density_band(density: Column, high: float = DENSITY_BANDS[0], mid: float = DENSITY_BANDS[1]):
    return F.when(density >= high, "high").when(density >= mid, "medium").otherwise("low")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, where NULL equals NULL; the keys appear once."""
    own = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(own, same).drop(*[f"_r_{k}" for k in keys])
