"""The driver's tables seen as sensor data. Every view covers its whole source table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.operators.clean import conform
from hourloom.plans.city import city_segments, clean_city, pivoted_grid
from hourloom.session import SETTINGS, shared_dir
from hourloom.specs import MEASUREMENTS, TableSpec, schema_of

NTZ = T.TimestampNTZType()
SERIES = ("click", "view", "purchase", "signup", "error")
THREE = {f"{s}_value": s for s in SERIES[:3]}
TWO = {f"{s}_value": s for s in SERIES[:2]}
FIVE = {f"{s}_value": s for s in SERIES}
CITY = dict(mapping=THREE, high=100.0, gold_hours=24, silver_hours=8)
MANY = dict(mapping=THREE, high=10000.0, perfect=1, gold_hours=2, silver_hours=1)
CITY_LOCATIONS, MANY_LOCATIONS = 2, 64
MANY_TEST_IDS = ("1", "5", "9", "40", "77")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    for key in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, SETTINGS[key])
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def wall(df: DataFrame) -> DataFrame:
    """Instants shown as UTC wall clock, the form in which they are compared."""
    return df.select(
        *[
            F.col(f.name).cast(NTZ).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def readings(spark: SparkSession, sf: str, locations: int | None = None) -> DataFrame:
    """Events as hourly readings: location from the user, parameter from the type, mean value."""
    place = F.col("user_id") if locations is None else F.col("user_id") % locations
    return (
        table(spark, sf, "events")
        .groupBy(
            place.cast("string").alias("location_id"),
            F.date_trunc("HOUR", "ts").cast(NTZ).alias("datetimeto_utc"),
            F.col("event_type").alias("parameter_id"),
        )
        .agg(F.round(F.avg("value"), 6).alias("value"))
        .withColumn("sensor_name", F.col("parameter_id"))
    )


def span(spark: SparkSession, sf: str):
    """First and last hour of the events: two values, looked up so that the plan holds constants."""
    return table(spark, sf, "events").agg(
        F.date_trunc("HOUR", F.min("ts")).cast(NTZ), F.date_trunc("HOUR", F.max("ts")).cast(NTZ)
    ).first()


def grid(spark: SparkSession, sf: str) -> DataFrame:
    start, end = span(spark, sf)
    cleaned = clean_city(
        readings(spark, sf, CITY_LOCATIONS), start, SERIES[:3], high=CITY["high"]
    )
    return pivoted_grid(cleaned, start, end, THREE)


def city_seg(spark: SparkSession, sf: str, **more) -> DataFrame:
    start, end = span(spark, sf)
    return city_segments(readings(spark, sf, CITY_LOCATIONS), end, start, **{**CITY, **more})


def many_seg(spark: SparkSession, sf: str) -> DataFrame:
    start, end = span(spark, sf)
    return city_segments(readings(spark, sf, MANY_LOCATIONS), end, start, **MANY)


def default_seg(spark: SparkSession, sf: str, locations: int = 16) -> DataFrame:
    """Two series and the default tiers, as timed by the bench."""
    start, end = span(spark, sf)
    return city_segments(readings(spark, sf, locations), end, start, mapping=TWO)


def places(spark: SparkSession, sf: str, locations: int) -> DataFrame:
    """Location coordinates from the customers that share its number."""
    return (
        table(spark, sf, "customer")
        .groupBy((F.col("c_custkey") % locations).cast("string").alias("location_id"))
        .agg(F.min("c_acctbal").alias("location_latitude"), F.max("c_acctbal").alias("location_longitude"))
    )


# Orders as a table that is loaded in batches -------------------------------------------------
ORDERS = TableSpec(
    "orders",
    schema_of(
        """o_orderkey! string, o_orderstatus string, o_totalprice double, o_orderdate local,
        ingested_at! utc, updated_at! utc, refreshed_at! utc"""
    ),
    keys=("o_orderkey",),
    sort_cols=("o_orderkey",),
)
LOADED_UNTIL, STAGED_SINCE = "2000-01-01 00:00:00", "1999-01-01 00:00:00"


def _orders(spark, sf, price, stamp) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus",
        price.alias("o_totalprice"), "o_orderdate",
    )
    at = F.lit(stamp).cast("timestamp")
    return rows.withColumns({c: at for c in ("ingested_at", "updated_at", "refreshed_at")})


def all_orders(spark, sf) -> DataFrame:
    return _orders(spark, sf, F.col("o_totalprice"), LOADED_UNTIL)


def loaded_orders(spark, sf) -> DataFrame:
    """Orders as they stood at the last load."""
    return _orders(spark, sf, F.col("o_totalprice"), LOADED_UNTIL).filter(
        F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast(NTZ)
    )


def staged_orders(spark, sf) -> DataFrame:
    """The next batch: recent orders again, open ones with a new price, and later orders."""
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return _orders(spark, sf, price, "2002-01-01 00:00:00").filter(
        F.col("o_orderdate") >= F.lit(STAGED_SINCE).cast(NTZ)
    )


SHIPPED_AS_OF, SHIPPED_AT = "2001-10-30 00:00:00", "2001-10-20 00:00:00"
AS_OF, LOADED_AT = "2001-07-25 00:00:00", "2001-07-20 00:00:00"


def late_orders(spark, sf) -> DataFrame:
    """Orders that were last touched up to 39 days after their date."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate",
        (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 40).cast("int"))).alias("updated_at"),
    )


# Line items, orders and customers as measurements, sensors and locations ----------------------
def raw_measurements(spark, sf) -> DataFrame:
    """Line items: the order is the sensor, the ship date the hour, the line number the version."""
    utc = F.col("l_shipdate").cast("timestamp")
    line = F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
    return conform(
        table(spark, sf, "lineitem").select(
            F.col("l_orderkey").cast("string").alias("sensor_id"),
            F.col("l_quantity").alias("value"),
            F.col("l_partkey").cast("string").alias("parameter_id"),
            F.col("l_returnflag").alias("parameter_name"),
            F.col("l_linestatus").alias("parameter_units"),
            utc.alias("period_datetimeTo_utc"),
            F.col("l_shipdate").alias("period_datetimeTo_local"),
            (utc - F.expr("interval 1 hour")).alias("period_datetimeFrom_utc"),
            (F.col("l_shipdate") - F.expr("interval 1 hour")).alias("period_datetimeFrom_local"),
            F.col("l_suppkey").alias("coverage_expectedCount"),
            F.col("l_linenumber").cast("long").alias("coverage_observedCount"),
            utc.alias("ingested_at"),
            (utc + line).alias("updated_at"),
            (utc + line).alias("refreshed_at"),
        ),
        MEASUREMENTS,
    )


def raw_sensors(spark, sf) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("location_id"),
        F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("string").alias("parameter_id"),
        F.lit(None).cast("string").alias("parameter_name"),
        F.lit(None).cast("string").alias("parameter_units"),
        F.col("o_orderstatus").alias("parameter_displayName"),
        at.alias("ingested_at"), at.alias("updated_at"), at.alias("refreshed_at"),
    )


def location_docs(spark, sf) -> DataFrame:
    """Customers as nested location documents, with their first and last order date."""
    dates = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    )
    def stamps(c):
        return F.struct(
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"),
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+09:00'").alias("local"),
        )
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).join(dates, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lit("  ").alias("locality"),
        F.lit("Asia/Seoul").alias("timezone"),
        (F.col("c_acctbal") < 0).alias("isMobile"),
        (F.col("c_mktsegment") == "MACHINERY").alias("isMonitor"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_acctbal").cast("string")).otherwise("n/a").alias("distance"),
        F.array(F.col("c_acctbal"), F.col("c_acctbal") + 1, F.col("c_acctbal") + 2, F.col("c_acctbal") + 3).alias("bounds"),
        F.struct(F.col("n_nationkey").alias("id"), F.col("c_mktsegment").alias("code"),
                 F.col("n_name").alias("name")).alias("country"),
        F.struct(F.col("n_regionkey").alias("id"), F.lit("").alias("name")).alias("owner"),
        F.struct(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("name")).alias("provider"),
        F.struct((F.col("c_acctbal") / 100).alias("latitude"), (F.col("c_acctbal") / 50).alias("longitude")).alias("coordinates"),
        stamps("a").alias("datetimeFirst"), stamps("b").alias("datetimeLast"),
        F.lit(None).cast("string").alias("instruments"),
    )


def hourly_docs(spark, sf) -> DataFrame:
    """Vectors as hourly weather documents: a start hour, and one value per following hour."""
    n = F.size("embedding")
    start = F.lit("2024-01-01 00:00:00").cast(NTZ) + F.make_dt_interval(F.col("label"))
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("location_id"),
        F.lit("Asia/Seoul").alias("timezone"),
        F.col("label").cast("double").alias("latitude"),
        (F.col("label") + 0.5).cast("double").alias("longitude"),
        F.lit(10.0).alias("elevation"),
        F.struct(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.date_format(start + F.make_dt_interval(F.lit(0), i), "yyyy-MM-dd'T'HH:mm"),
            ).alias("time"),
            F.transform("embedding", lambda v: v.cast("double")).alias("temperature_2m"),
            F.transform("embedding", lambda v: F.when(v > 0, F.lit(1.0)).otherwise(0.0)).alias("is_day"),
        ).alias("hourly"),
    )


def sensor_docs(spark, sf) -> DataFrame:
    """Orders as location documents of a customer, each order a sensor."""
    sensor = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.struct(
            F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("name"),
            F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(F.col("o_orderstatus")).alias("units"),
            F.lit(None).cast("string").alias("displayName"),
        ).alias("parameter"),
    )
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(sensor).alias("sensors"))


def measurement_docs(spark, sf) -> DataFrame:
    """Line items as nested measurement documents, with times as text."""
    def moment_of(c):
        return F.struct(
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+09:00'").alias("local")
        )

    ship = F.col("l_shipdate")
    before = ship - F.expr("interval 1 hour")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sensor_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("value"),
        F.struct((F.col("l_returnflag") == "R").alias("hasFlags")).alias("flagInfo"),
        F.struct(
            F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("name"), F.lit("  ").alias("units"), F.lit(None).cast("string").alias("displayName")
        ).alias("parameter"),
        F.struct(F.lit("raw").alias("label"), F.lit("01:00:00").alias("interval"), moment_of(before).alias("datetimeFrom"), moment_of(ship).alias("datetimeTo")).alias("period"),
        F.struct(F.col("l_discount").alias("min"), F.col("l_tax").alias("avg"), F.lit(float("nan")).alias("sd")).alias("summary"),
        F.struct(
            F.col("l_suppkey").cast("string").alias("expectedCount"), F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("observedCount"),
            F.lit("100.0").alias("percentComplete"), moment_of(before).alias("datetimeFrom"),
        ).alias("coverage"),
        F.lit("not stored").alias("extra"),
    )


def line_docs(spark, sf) -> DataFrame:
    """Documents as parents with one child per line of their text."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.transform(
            F.split("text", "\n"),
            lambda line, i: F.struct(
                i.alias("id"), line.alias("name"),
                F.struct(F.length(line).alias("units"), F.col("lang").alias("displayName")).alias("parameter"),
            ),
        ).alias("sensors"),
    )


def run_logs(spark, sf) -> DataFrame:
    """Documents as run logs: a line is an attempt, a word holding a digit an error, others files."""
    def words(line):
        return F.struct(
            F.regexp_extract_all(line, F.lit("(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"), F.lit(0)).alias("bad"),
            F.regexp_extract_all(line, F.lit("(?<![^ ])[^ 0-9]++(?![^ ])"), F.lit(0)).alias("good"),
        )

    def attempt(a, i):
        n = F.size(a["bad"])
        run = F.col("doc_id").cast("string")
        return F.struct(
            run.alias("run_id"),
            F.when(n > 5, "aborted").when(n > 0, "retrying").otherwise("downloaded").alias("status"),
            a["good"].alias("saved"),
            F.transform(a["bad"], lambda w: F.struct(
                run.alias("run_id"), w.alias("sensor_id"), F.col("lang").alias("type"),
            )).alias("errors"),
            i.cast("long").alias("retries"),
        )

    none = F.lit(None).cast("string")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("run_id"),
        none.alias("run_start"), none.alias("run_end"), none.alias("datetime_from"), none.alias("datetime_to"),
        F.array(F.col("source")).alias("sensors"),
        F.transform(F.transform(F.split("text", "\n"), words), attempt).alias("logs"),
        (F.col("n_chars") / 4).alias("download_duration"),
        F.when(F.col("lang") != "en", F.lit(0.5)).alias("saving_duration"),
        F.when(F.col("lang") == "de", F.col("n_chars") + 0.25).cast("double").alias("total_duration"),
    )
