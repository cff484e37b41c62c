"""City readings to a dense grid to segments, as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CITY_START, PARAMETER_COLUMNS, VALUE_HIGH, VALUE_LOW
from ..functions import clean_range
from ..operators.filters import only_values, since
from ..operators.grid import dense_grid, pivot_readings, tag_concurrency
from ..operators.hot import HOT_ROWS
from ..operators.segments import segment


def clean_city(
    df: DataFrame, start=CITY_START, parameter_ids=tuple(PARAMETER_COLUMNS.values()),
    low: float = VALUE_LOW, high: float = VALUE_HIGH, ts: str = "datetimeto_utc",
) -> DataFrame:
    """Static filters (they reach the scan), then out-of-range readings set to NULL."""
    kept = only_values(since(df, ts, start), "parameter_id", parameter_ids)
    return kept.withColumn("value", clean_range(F.col("value"), low, high))


def city_measurements(df: DataFrame, hot_rows: int | None = HOT_ROWS, **options) -> DataFrame:
    """Cleaned readings, each with the number of valid readings of its location and hour."""
    return tag_concurrency(clean_city(df, **options), hot_rows=hot_rows)


def pivoted_grid(
    cleaned: DataFrame, start, end, mapping: Mapping[str, str] = PARAMETER_COLUMNS
) -> DataFrame:
    """Dense grid of a location per hour with one column per parameter.

    Takes cleaned readings, with or without their concurrency: counting while pivoting gives the
    same number, so the window over the long rows need not run here.
    """
    return dense_grid(pivot_readings(cleaned, mapping), start, end)


def city_segments(
    df: DataFrame, end, start=CITY_START, mapping: Mapping[str, str] = PARAMETER_COLUMNS,
    low: float = VALUE_LOW, high: float = VALUE_HIGH, **segment_options,
) -> DataFrame:
    """From standardised readings to segments: two shuffles, one per (location, hour), one per location."""
    cleaned = clean_city(df, start, tuple(mapping.values()), low, high)
    options = {"perfect": len(mapping), **segment_options}
    return segment(pivoted_grid(cleaned, start, end, mapping), **options)
