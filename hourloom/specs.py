"""Declared table shapes: schema, keys, partition column, sort columns, foreign keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .constants import AUDIT_COLUMNS

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "utc": T.TimestampType(),
    "local": T.TimestampNTZType(),
}


BUCKET = "bucket"


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """What a stored table promises.

    ``time_col`` is the column whose day (or other ``grain``) partitions the table. A table without one may be stored
    in ``buckets`` by the hash of its keys, so that a batch touches only those its keys fall into.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    time_col: str | None = None
    sort_cols: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())
    grain: str = "day"
    buckets: int | None = None

    @property
    def partition(self) -> str | None:
        """The column the table is stored by, if any."""
        return self.grain if self.time_col else BUCKET if self.buckets else None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def schema_of(text: str) -> T.StructType:
    """``"id! string, value double"`` to a StructType; ``!`` marks a required column."""
    fields = []
    for part in text.replace("\n", " ").split(","):
        if part.strip():
            name, kind = part.split()
            fields.append(T.StructField(name.rstrip("!"), _TYPES[kind], not name.endswith("!")))
    return T.StructType(fields)


_AUDIT = ", ".join(f"{c}! utc" for c in AUDIT_COLUMNS)

# --- fixed values: the four stored tables, column by column -----------------------------------
LOCATIONS = TableSpec(
    "locations",
    schema_of(
        """id! string, name string, locality string, timezone string, isMobile bool,
        isMonitor bool, distance double, bounds_min_lon double, bounds_min_lat double,
        bounds_max_lon double, bounds_max_lat double, country_id string, country_code string,
        country_name string, owner_id string, owner_name string, provider_id string,
        provider_name string, coordinates_latitude double, coordinates_longitude double,
        datetimeFirst_utc utc, datetimeFirst_local local, datetimeLast_utc utc,
        datetimeLast_local local, """ + _AUDIT
    ),
    keys=("id",),
    sort_cols=("id",),
)

SENSORS = TableSpec(
    "sensors",
    schema_of(
        """id! string, location_id! string, name string, parameter_id string,
        parameter_name string, parameter_units string, parameter_displayName string, """ + _AUDIT
    ),
    keys=("id",),
    sort_cols=("id",),
    foreign_keys=(ForeignKey("location_id", "locations", "id"),),
)

MEASUREMENTS = TableSpec(
    "measurements",
    schema_of(
        """sensor_id! string, value double, flagInfo_hasFlags bool, parameter_id string,
        parameter_name string, parameter_units string, parameter_displayName string,
        period_label string, period_interval string, period_datetimeFrom_utc utc,
        period_datetimeFrom_local local, period_datetimeTo_utc utc,
        period_datetimeTo_local local, summary_min double, summary_q02 double,
        summary_q25 double, summary_median double, summary_q75 double, summary_q98 double,
        summary_max double, summary_avg double, summary_sd double, coverage_expectedCount long,
        coverage_expectedInterval string, coverage_observedCount long,
        coverage_observedInterval string, coverage_percentComplete double,
        coverage_percentCoverage double, coverage_datetimeFrom_utc utc,
        coverage_datetimeFrom_local local, coverage_datetimeTo_utc utc,
        coverage_datetimeTo_local local, """ + _AUDIT
    ),
    keys=("sensor_id", "period_datetimeTo_utc"),
    time_col="period_datetimeTo_utc",
    sort_cols=("sensor_id", "parameter_name"),
    foreign_keys=(ForeignKey("sensor_id", "sensors", "id"),),
)

WEATHER = TableSpec(
    "weather",
    schema_of(
        """location_id! string, datetimeto_utc! utc, datetimeto_local local,
        weather_latitude double, weather_longitude double, timezone string, elevation double,
        temperature_2m double, relative_humidity_2m long, dew_point_2m double,
        apparent_temperature double, precipitation double, rain double, snowfall double,
        snow_depth double, shortwave_radiation double, direct_radiation double,
        diffuse_radiation double, global_tilted_irradiance double,
        direct_normal_irradiance double, terrestrial_radiation double, weather_code long,
        pressure_msl double, surface_pressure double, cloud_cover long, cloud_cover_low long,
        cloud_cover_mid long, cloud_cover_high long, vapour_pressure_deficit double,
        et0_fao_evapotranspiration double, wind_speed_100m double, wind_speed_10m double,
        wind_direction_10m long, wind_direction_100m long, wind_gusts_10m double,
        is_day long, """ + _AUDIT
    ),
    keys=("location_id", "datetimeto_utc"),
    time_col="datetimeto_utc",
    sort_cols=("location_id",),
)

SPECS = {s.name: s for s in (LOCATIONS, SENSORS, MEASUREMENTS, WEATHER)}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()
_STAMPS = _struct(utc=_S, local=_S)

# --- fixed values: shapes of the landed JSON documents ----------------------------------------
LOCATION_JSON = _struct(
    id=_L, name=_S, locality=_S, timezone=_S, isMobile=T.BooleanType(), isMonitor=T.BooleanType(),
    distance=_D, bounds=T.ArrayType(_D),
    country=_struct(id=_L, code=_S, name=_S), owner=_struct(id=_L, name=_S),
    provider=_struct(id=_L, name=_S), coordinates=_struct(latitude=_D, longitude=_D),
    datetimeFirst=_STAMPS, datetimeLast=_STAMPS,
    sensors=T.ArrayType(
        _struct(id=_L, name=_S, parameter=_struct(id=_L, name=_S, units=_S, displayName=_S))
    ),
)

MEASUREMENT_JSON = _struct(
    sensor_id=_L, value=_D, flagInfo=_struct(hasFlags=T.BooleanType()),
    parameter=_struct(id=_L, name=_S, units=_S, displayName=_S),
    period=_struct(label=_S, interval=_S, datetimeFrom=_STAMPS, datetimeTo=_STAMPS),
    summary=_struct(min=_D, q02=_D, q25=_D, median=_D, q75=_D, q98=_D, max=_D, avg=_D, sd=_D),
    coverage=_struct(
        expectedCount=_L, expectedInterval=_S, observedCount=_L, observedInterval=_S,
        percentComplete=_D, percentCoverage=_D, datetimeFrom=_STAMPS, datetimeTo=_STAMPS,
    ),
)

RUN_LOG_JSON = _struct(
    run_id=_S, status=_S, run_start=_S, run_end=_S, datetime_from=_S, datetime_to=_S,
    download_duration=_D, saving_duration=_D, total_duration=_D, errors=_L, saved=_L, retries=_L,
    sensors=T.ArrayType(_S),
    logs=T.ArrayType(
        _struct(
            run_id=_S, status=_S, run_start=_S, run_end=_S, download_duration=_D,
            saved=T.ArrayType(_S),
            errors=T.ArrayType(_struct(run_id=_S, sensor_id=_S, type=_S)),
            retries=_L,
        )
    ),
)


def weather_json(metrics) -> T.StructType:
    """Hourly weather document: constants beside a struct of equally long arrays."""
    hourly = {"time": T.ArrayType(_S)} | {m: T.ArrayType(_D) for m in metrics}
    return _struct(
        location_id=_L, timezone=_S, latitude=_D, longitude=_D, elevation=_D,
        hourly=_struct(**hourly),
    )
