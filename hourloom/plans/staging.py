"""Staging: the newest version of each row, projected and renamed, refreshed by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import AUDIT_COLUMNS, ENRICHED_TARGET_LOOKBACK_DAYS, WEATHER_METRICS
from ..operators.dedupe import keep_latest
from ..operators.enrich import enrich, staged_location, staged_sensor
from ..operators.incremental import refresh_days
from ..operators.publish import finish
from ..sources import paths

# --- fixed values: columns of the staged tables, output name -> raw name where they differ ----
STAGED_LOCATION_COLUMNS = {
    "id": "id", "location_name": "name", "locality": "locality", "timezone": "timezone",
    "ismobile": "isMobile", "ismonitor": "isMonitor", "distance": "distance",
    "bounds_min_lon": "bounds_min_lon", "bounds_min_lat": "bounds_min_lat",
    "bounds_max_lon": "bounds_max_lon", "bounds_max_lat": "bounds_max_lat",
    "country_id": "country_id", "country_code": "country_code", "country_name": "country_name",
    "owner_id": "owner_id", "owner_name": "owner_name", "provider_id": "provider_id",
    "provider_name": "provider_name", "coordinates_latitude": "coordinates_latitude",
    "coordinates_longitude": "coordinates_longitude", "datetimefirst_utc": "datetimeFirst_utc",
    "datetimefirst_local": "datetimeFirst_local", "datetimelast_utc": "datetimeLast_utc",
    "datetimelast_local": "datetimeLast_local",
}
STAGED_SENSOR_COLUMNS = {
    "id": "id", "location_id": "location_id", "sensor_name": "name",
    "parameter_id": "parameter_id", "parameter_name": "parameter_name",
    "parameter_units": "parameter_units", "parameter_displayname": "parameter_displayName",
}
STAGED_MEASUREMENT_COLUMNS = {
    "sensor_id": "sensor_id", "value": "value", "parameter_id": "parameter_id",
    "parameter_name": "parameter_name", "parameter_units": "parameter_units",
    "datetimeto_utc": "period_datetimeTo_utc", "datetimeto_local": "period_datetimeTo_local",
}
STAGED_WEATHER_COLUMNS = {
    c: c
    for c in (
        "location_id", "datetimeto_utc", "datetimeto_local", "weather_latitude",
        "weather_longitude", "timezone", "elevation", *WEATHER_METRICS,
    )
}


def project(df: DataFrame, columns) -> DataFrame:
    """Select and rename, audit columns last."""
    return df.select(*[F.col(src).alias(out) for out, src in columns.items()], *AUDIT_COLUMNS)


def stage_locations(raw: DataFrame) -> DataFrame:
    return project(raw, STAGED_LOCATION_COLUMNS)


def stage_sensors(raw: DataFrame) -> DataFrame:
    return project(raw, STAGED_SENSOR_COLUMNS)


def stage_measurements(raw: DataFrame) -> DataFrame:
    # projected first: only the columns that survive travel through the shuffle of the dedup
    slim = project(raw, STAGED_MEASUREMENT_COLUMNS)
    ties = [c for c in slim.columns if c not in ("sensor_id", "datetimeto_utc", "updated_at")]
    return keep_latest(slim, ["sensor_id", "datetimeto_utc"], ["updated_at"], ties)


def stage_weather(raw: DataFrame) -> DataFrame:
    slim = project(raw, STAGED_WEATHER_COLUMNS)
    ties = [c for c in slim.columns if c not in ("location_id", "datetimeto_utc", "updated_at")]
    return keep_latest(slim, ["location_id", "datetimeto_utc"], ["updated_at"], ties)


def standardize(
    measurements: DataFrame, sensors: DataFrame, locations: DataFrame, few: bool = False
) -> DataFrame:
    """Staged measurements with the columns of their sensor and its location.

    All measurements meet one table of sensors with their locations. A ``few`` of them meet the
    sensors first, so that locations needn't be brought to sensors without a measurement.
    """
    dims = [staged_sensor(sensors), staged_location(locations)]
    wide = enrich(enrich(measurements, dims[:1]), dims[1:]) if few else enrich(measurements, dims)
    return wide.select(*STANDARD_COLUMNS)


# --- fixed values: column order of the standardised table -------------------------------------
STANDARD_COLUMNS = (
    "location_id", "sensor_id", "value", "sensor_name", "parameter_id", "parameter_name",
    "parameter_units", "parameter_displayname", "datetimeto_utc", "datetimeto_local", "timezone",
    "location_name", "location_latitude", "location_longitude", "ismobile", "ismonitor",
    "datetimefirst_utc", "datetimelast_utc", "country_name", "owner_name", "provider_name",
    *AUDIT_COLUMNS,
)


def refresh_staged_measurements(
    spark: SparkSession, raw: DataFrame, path: str, as_of, full: bool = False, grain: str = "day"
) -> None:
    refresh_days(
        spark, raw, path, stage_measurements, "period_datetimeTo_utc", as_of,
        target_ts_col="datetimeto_utc", sort_cols=("sensor_id",), full=full, grain=grain,
    )


def refresh_staged_weather(
    spark: SparkSession, raw: DataFrame, path: str, as_of, full: bool = False, grain: str = "day"
) -> None:
    refresh_days(
        spark, raw, path, stage_weather, "datetimeto_utc", as_of, sort_cols=("location_id",),
        full=full, grain=grain,
    )


def refresh_standardized(
    spark: SparkSession, staged: DataFrame, sensors: DataFrame, locations: DataFrame, path: str,
    as_of, full: bool = False, grain: str = "day",
) -> None:
    """The joined table looks back ten days at its own rows, the staged ones fifteen."""
    finish(spark, path)
    few = not full and paths.has_files(spark, path)
    refresh_days(
        spark, staged, path, lambda rows: standardize(rows, sensors, locations, few), "datetimeto_utc",
        as_of, target_lookback=ENRICHED_TARGET_LOOKBACK_DAYS,
        sort_cols=("location_id", "sensor_name"), full=full, grain=grain,
    )
