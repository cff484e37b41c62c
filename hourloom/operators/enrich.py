"""Dimension lookups by left join.

No join carries a broadcast hint. Spark broadcasts a dimension when its estimated or measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive
execution splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import active_between


@dataclass(frozen=True)
class Dim:
    """``columns`` maps output name to dimension column."""

    df: DataFrame
    fact_key: str
    dim_key: str
    columns: Mapping[str, str]


def enrich(facts: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """Left-join dimensions; a later one may be looked up by a column that an earlier one brings.

    Such a chain is joined from its end, dimension to dimension, so the facts meet one table for
    each of their own keys and are shuffled once for it.
    """
    looks = [
        (d.fact_key, d.df.select(F.col(d.dim_key).alias("_key"), *[F.col(c).alias(n) for n, c in d.columns.items()]))
        for d in dims
    ]
    for i in reversed(range(len(looks))):
        key, look = looks[i]
        if key in facts.columns:
            continue
        j = max(j for j in range(i) if key in looks[j][1].columns)
        far = look.withColumnRenamed("_key", "_far")
        looks[j] = (looks[j][0], looks[j][1].join(far, F.col(key) == F.col("_far"), "left").drop("_far"))
        del looks[i]
    for key, look in looks:
        facts = facts.join(look, F.col(key) == F.col("_key"), "left").drop("_key")
    return facts


def staged_location(locations: DataFrame) -> Dim:
    """The descriptive columns of a staged location, by its id."""
    return Dim(
        locations, "location_id", "id",
        {
            "location_name": "location_name", "timezone": "timezone", "ismobile": "ismobile",
            "ismonitor": "ismonitor", "country_name": "country_name", "owner_name": "owner_name",
            "provider_name": "provider_name", "location_latitude": "coordinates_latitude",
            "location_longitude": "coordinates_longitude",
            "datetimefirst_utc": "datetimefirst_utc", "datetimelast_utc": "datetimelast_utc",
        },
    )


def staged_sensor(sensors: DataFrame) -> Dim:
    """The descriptive columns of a staged sensor, by its id."""
    kept = ("location_id", "sensor_name", "parameter_displayname")
    return Dim(sensors, "sensor_id", "id", {c: c for c in kept})


def sensors_with_dates(
    sensors: DataFrame, locations: DataFrame, date_from=None, date_to=None,
    first_col: str = "datetimeFirst_utc", last_col: str = "datetimeLast_utc",
) -> DataFrame:
    """Sensors of locations active in the period, with that location's first and last moment.

    Location ids are unique, so keeping and looking up is one inner join.
    """
    active = active_between(
        locations.select(F.col("id").alias("location_id"), first_col, last_col),
        first_col, last_col, date_from, date_to,
    )
    return sensors.join(active, "location_id", "inner")


def wide_measurements(
    measurements: DataFrame, sensors: DataFrame, locations: DataFrame
) -> DataFrame:
    """Measurements with all sensor and location columns, in the order an export expects."""
    dims = [
        Dim(sensors, "sensor_id", "id", {
            "location_id": "location_id", "name": "name",
            "parameter_displayName": "parameter_displayName",
        }),
        Dim(locations, "location_id", "id", {
            "location_name": "name", "isMobile": "isMobile", "isMonitor": "isMonitor",
            "country_id": "country_id", "country_code": "country_code",
            "country_name": "country_name", "owner_id": "owner_id", "owner_name": "owner_name",
            "provider_id": "provider_id", "provider_name": "provider_name",
            "coordinates_latitude": "coordinates_latitude",
            "coordinates_longitude": "coordinates_longitude",
            "location_datetimeFirst_utc": "datetimeFirst_utc",
            "location_datetimeLast_utc": "datetimeLast_utc",
        }),
    ]
    kept = measurements.select(
        "sensor_id", "value", "parameter_id", "parameter_name", "parameter_units",
        "period_datetimeFrom_local", "period_datetimeTo_local", "period_datetimeFrom_utc",
        "period_datetimeTo_utc", "coverage_expectedCount", "coverage_observedCount",
    )
    return enrich(kept, dims).select(*WIDE_COLUMNS)


# --- fixed values: column order of the wide export --------------------------------------------
WIDE_COLUMNS = (
    "location_id", "sensor_id", "name", "value", "parameter_id", "parameter_name",
    "parameter_units", "parameter_displayName", "period_datetimeFrom_local",
    "period_datetimeTo_local", "period_datetimeFrom_utc", "period_datetimeTo_utc",
    "location_datetimeFirst_utc", "location_datetimeLast_utc", "coordinates_latitude",
    "coordinates_longitude", "location_name", "isMobile", "isMonitor", "country_id",
    "country_code", "country_name", "owner_id", "owner_name", "provider_id", "provider_name",
    "coverage_expectedCount", "coverage_observedCount",
)
