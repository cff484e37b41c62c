"""What the plans must keep to when the data grows: pushdown, pruning, shuffles, skew."""

import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.plans import staging
from hourloom.plans.city import city_segments, clean_city
from hourloom.specs import MEASUREMENTS

STANDARD = "location_id string, datetimeto_utc timestamp, parameter_id string, value double, sensor_name string, owner_name string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    ts = F.timestamp_seconds(F.lit(1714521600) + (F.col("id") % 500) * 3600)
    # a third of the rows belong to one location
    place = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string"))
    spark.range(0, 60_000, 1, 6).select(
        place.alias("location_id"), ts.alias("datetimeto_utc"), (F.col("id") % 12).cast("string").alias("parameter_id"),
        (F.col("id") % 97).cast("double").alias("value"), F.lit("n").alias("sensor_name"), F.lit("o").alias("owner_name"),
    ).write.parquet(path)
    return path


def test_filters_and_columns_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = spark.read.parquet(stored)
    text = plan(clean_city(df).groupBy("location_id").agg(F.sum("value")))
    pushed = text[text.index("PushedFilters"):].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(datetimeto_utc" in pushed and "In(parameter_id" in pushed
    schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "owner_name" not in schema and "sensor_name" not in schema


def test_staging_reads_only_what_it_keeps(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([], MEASUREMENTS.schema).write.parquet(path)
    text = plan(staging.stage_measurements(spark.read.parquet(path)))
    schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "summary_" not in schema and "coverage_" not in schema
    assert text.count("Exchange hashpartitioning") == 1


def test_readings_to_segments_take_two_shuffles_and_no_join(spark, stored):
    df = spark.read.parquet(stored).select("location_id", "datetimeto_utc", "parameter_id", "value")
    text = plan(city_segments(df, "2024-06-01 00:00:00"))
    assert text.count("Exchange hashpartitioning") == 2
    assert "Join" not in text and "Cartesian" not in text and "SinglePartition" not in text


def test_reports_reuse_the_partitioning_of_the_segmentation(spark, stored):
    seg = city_segments(spark.read.parquet(stored).drop("sensor_name", "owner_name"), "2024-06-01 00:00:00", perfect=1)
    values = ["pm25_ugm3", "co_ppm"]
    assert plan(h.duration_report(seg)).count("Exchange hashpartitioning") == 2
    assert plan(h.mean_by_parameter(seg, values)).count("Exchange hashpartitioning") == 2
    assert plan(h.gold_locations(seg)).count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("call", [
    lambda df: h.rank_parameters(df),
    lambda df: h.coverage_check(df, h.top_parameters(h.rank_parameters(df), 2), 2),
    lambda df: h.profile(df),
    lambda df: h.tag_concurrency(df, ["location_id"], hot_rows=1000),
    lambda df: h.keep_latest(df, ["location_id"], ["datetimeto_utc"]),
    lambda df: h.gap_distribution(df),
    lambda df: h.check_unique(df, "location_id"),
    lambda df: h.segment_timeline(city_segments(df, "2024-06-01 00:00:00")),
])
def test_no_product_and_no_whole_table_window(spark, stored, call):
    text = plan(call(spark.read.parquet(stored)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            continue  # final step of a global aggregate, one row per task
        assert not (line.strip(" +-:*").startswith("Window") and "], [], [" in line)


def test_a_hot_key_is_split_by_the_join(spark, stored):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        facts = spark.read.parquet(stored)
        dim = facts.select("location_id").distinct().withColumn("name", F.concat(F.lit("n"), "location_id"))
        dim.write.mode("overwrite").parquet(stored + "-dim")
        got = h.enrich(facts, [h.Dim(spark.read.parquet(stored + "-dim"), "location_id", "location_id", {"name": "name"})])
        assert got.agg(F.count("name"), F.count_if(F.col("name") == F.concat(F.lit("n"), "location_id"))).first() == (60_000, 60_000)
        assert len(got.collect()) == 60_000
        assert "skew=true" in plan(got)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_crowded_group_is_counted_in_place(spark, stored):
    df = spark.read.parquet(stored)
    got = h.tag_concurrency(df, ["location_id"], hot_rows=5_000)
    want = {r[0]: r[1] for r in df.groupBy("location_id").agg(F.count("value")).collect()}
    assert {tuple(r) for r in got.select("location_id", "concurrent_sensors").distinct().collect()} == set(want.items())
    assert got.count() == 60_000


def test_write_parquet_is_snappy_with_microseconds(spark, tmp_path):
    import pyarrow.parquet as pq
    from hourloom.sources.files import write_parquet

    at = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    write_parquet(spark.createDataFrame([(at,)], "t timestamp").coalesce(1), str(tmp_path / "p"))
    part = pq.ParquetFile(next((tmp_path / "p").glob("*.parquet")))
    assert part.metadata.row_group(0).column(0).compression == "SNAPPY"
    assert "MICROS" in str(part.schema).upper() or "microseconds" in str(part.schema)
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == [(at,)]


def test_a_chain_of_dimensions_meets_the_facts_once(spark, tmp_path):
    import hourloom as h

    for name, cols in (("facts", "k int, v int"), ("near", "id int, far_id int"), ("far", "id int, name string")):
        spark.createDataFrame([], cols).write.parquet(str(tmp_path / name))
    facts, near, far = (spark.read.parquet(str(tmp_path / n)) for n in ("facts", "near", "far"))
    wide = h.enrich(facts, [h.Dim(near, "k", "id", {"far_id": "far_id"}), h.Dim(far, "far_id", "id", {"name": "name"})])
    assert wide.columns == ["k", "v", "far_id", "name"]
    plan = wide._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join" in line]
    fact_depth = next(line for line in plan if "v#" in line and "Relation" in line)
    # the facts hang directly under the upper join
    assert len(joins) == 2 and len(fact_depth) - len(fact_depth.lstrip(" :+-")) < max(len(j) - len(j.lstrip(" :+-")) for j in joins) + 6


def test_histogram_plans_the_segments_twice_at_most(spark, tmp_path):
    import hourloom as h

    rows = [("a", f"s{i}", i / 10) for i in range(11)]
    spark.createDataFrame(rows, "location_id string, segment_id string, segment_perfect_density double").write.parquet(str(tmp_path / "seg"))
    got = h.density_histogram(spark.read.parquet(str(tmp_path / "seg")), 5)
    assert [r["segment_count"] for r in got.orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = h.density_histogram(spark.read.parquet(str(tmp_path / "seg")), 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 1 and len(set(re.findall(r"subquery#(\d+)", plan))) == 1


def test_cleaning_of_measurements_is_compiled(spark, tmp_path):
    """The JVM only interprets methods above 8000 bytes; Spark makes smaller ones of them if it is told that limit."""
    from workloads import adapters, queries

    rows = [(1, 2, 3, 1, 4.0, 5.0, 0.1, 0.2, "R", "O")]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    line = spark.createDataFrame(rows, names).withColumn("l_shipdate", F.lit("2001-01-02 00:00:00").cast(adapters.NTZ))
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    try:
        assert queries.ingest_measurements(spark, str(tmp_path)).count() == 1
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
