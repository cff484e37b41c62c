"""Landed documents to rows that are ready to be merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import local_to_utc
from ..operators.clean import canonical_sort, clean, drop_unwanted, underscore_names
from ..operators.flatten import (
    array_to_columns, explode_parallel_arrays, flatten_structs, sensors_of,
)
from ..specs import LOCATIONS, MEASUREMENTS, SENSORS, WEATHER

# --- fixed values: location columns that are not stored, and names of the box corners ---------
UNSTORED = ("instruments", "licenses", "sensors", "sensors_flat")
BOUNDS = ("bounds_min_lon", "bounds_min_lat", "bounds_max_lon", "bounds_max_lat")


def ingest_locations(docs: DataFrame, batch_ts, strict: bool = True) -> DataFrame:
    flat = array_to_columns(flatten_structs(drop_unwanted(docs, *UNSTORED)), "bounds", BOUNDS)
    return clean(flat, LOCATIONS, batch_ts, strict)


def ingest_sensors(docs: DataFrame, batch_ts, strict: bool = True) -> DataFrame:
    return clean(sensors_of(docs), SENSORS, batch_ts, strict)


def ingest_measurements(
    docs: DataFrame, batch_ts, strict: bool = True, sort: bool = False
) -> DataFrame:
    rows = underscore_names(flatten_structs(docs))
    if sort:
        rows = canonical_sort(rows, within_partitions=True)
    return clean(rows, MEASUREMENTS, batch_ts, strict)


def weather_rows(docs: DataFrame) -> DataFrame:
    """One row per hour of each weather document, its constants repeated, with the UTC instant."""
    constants = ["location_id", "timezone", "latitude", "longitude", "elevation"]
    rows = explode_parallel_arrays(docs, "hourly", constants)
    local = F.col("time").cast("timestamp_ntz")
    metrics = [c for c in rows.columns if c not in (*constants, "time")]
    return rows.select(
        "location_id",
        local_to_utc(local, F.col("timezone")).alias("datetimeto_utc"),
        local.alias("datetimeto_local"),
        F.col("latitude").alias("weather_latitude"),
        F.col("longitude").alias("weather_longitude"),
        "timezone",
        "elevation",
        *metrics,
    )


def ingest_weather(docs: DataFrame, batch_ts, strict: bool = True) -> DataFrame:
    return clean(weather_rows(docs), WEATHER, batch_ts, strict)
