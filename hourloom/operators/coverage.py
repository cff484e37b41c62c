"""Which parameters are measured where, and how completely."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import COVERAGE_THRESHOLD, TOP_PARAMETERS
from .calendar import hours_covered
from .grid import ENTITY, TS

NAME = "sensor_name"


def rank_parameters(df: DataFrame, name: str = NAME, entity: str = ENTITY) -> DataFrame:
    """Per parameter: in how many locations it is measured, and how often; most common first."""
    return rank_counts(
        df.groupBy(entity, name).agg(F.count(F.lit(1)).alias("measurement_count")), name, entity
    )


def rank_counts(counts: DataFrame, name: str = NAME, entity: str = ENTITY) -> DataFrame:
    """The same from :func:`coverage_counts`, one row per location and parameter."""
    return (
        counts.groupBy(name)
        .agg(
            F.count(entity).alias("location_count"),
            F.sum("measurement_count").alias("measurement_count"),
        )
        .orderBy(F.desc("location_count"), F.desc("measurement_count"), name)
    )


def top_parameters(ranking: DataFrame, n: int = TOP_PARAMETERS, name: str = NAME) -> DataFrame:
    return ranking.orderBy(F.desc("location_count"), F.desc("measurement_count"), name).limit(n)


def rarest_parameter(top: DataFrame, name: str = NAME) -> DataFrame:
    """The last of the top parameters (one row)."""
    return top.orderBy("location_count", "measurement_count", F.desc(name)).limit(1)


def _measuring(df: DataFrame, names: DataFrame, name: str) -> DataFrame:
    # the size of ``names`` is up to the caller, so Spark decides how to join it
    return df.join(names.select(name), name, "left_semi")


def coverage_check(
    df: DataFrame, top: DataFrame, n: int = TOP_PARAMETERS, name: str = NAME, entity: str = ENTITY
) -> DataFrame:
    """Locations measuring the rarest top parameter: how many of the top ones they measure."""
    homes = _measuring(df, rarest_parameter(top, name), name).select(entity).distinct()
    return (
        _measuring(df, top, name)
        .select(entity, name)
        .distinct()  # shrinks the facts before the lookup, so a busy location is no burden
        .join(homes, entity, "left_semi")
        .groupBy(entity)
        .agg(F.count(name).alias("pollutant_count"))
        .withColumn("coverage", F.when(F.col("pollutant_count") == n, "full").otherwise("partial"))
    )


def coverage_share(checked: DataFrame) -> DataFrame:
    full = F.count_if(F.col("coverage") == "full")
    return checked.agg(
        full.alias("full_locations"),
        F.count(F.lit(1)).alias("total_locations"),
        F.try_divide(full, F.count(F.lit(1))).alias("full_share"),
    )


def coverage_counts(
    df: DataFrame, names: DataFrame | None = None, entities: DataFrame | None = None,
    name: str = NAME, entity: str = ENTITY, ts: str = TS,
) -> DataFrame:
    """Per location and parameter: number of measurements, first and last moment."""
    if names is not None:
        df = _measuring(df, names, name)
    out = df.groupBy(entity, name).agg(
        F.count(F.lit(1)).alias("measurement_count"),
        F.min(ts).alias("min_datetime"),
        F.max(ts).alias("max_datetime"),
    )
    # filtered after aggregating: same groups, far fewer rows to look up
    return out if entities is None else out.join(entities.select(entity), entity, "left_semi")


def coverage_matrix(
    counts: DataFrame, names: Sequence[str], threshold: float = COVERAGE_THRESHOLD,
    name: str = NAME, entity: str = ENTITY,
) -> DataFrame:
    """Share of the hours of the whole selection that each location has of each parameter."""
    total = counts.agg(hours_covered(F.min("min_datetime"), F.max("max_datetime"))).scalar()
    share = [
        F.coalesce(F.max(F.when(F.col(name) == n, F.col("measurement_count"))), F.lit(0)).alias(n)
        for n in names
    ]
    wide = counts.groupBy(entity).agg(*share).select(
        entity, *[(F.col(f"`{n}`") / total).alias(n) for n in names]
    )
    cells = [F.col(f"`{n}`") for n in names]
    lowest = F.least(*cells) if len(cells) > 1 else cells[0]
    return (
        wide.withColumn("average", sum(cells[1:], cells[0]) / len(cells))
        .withColumn("minimum", lowest)
        .withColumn("kept", lowest >= threshold)
        .orderBy(F.desc("average"), entity)
    )


def profile(
    df: DataFrame, time_cols: Sequence[str] = ("datetimeto_local", "ds", TS),
    entity_cols: Sequence[str] = (ENTITY, "unique_id"), name: str = NAME,
) -> DataFrame:
    """One row: size, time span and distinct counts. The first time / entity column present is used."""
    ts = next(c for c in time_cols if c in df.columns)
    entity = next(c for c in entity_cols if c in df.columns)
    named = [name] if name in df.columns else []
    # one row per location (and parameter) first: counting two distincts multiplies its input
    slim = df.groupBy(entity, *named).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(ts).alias("_a"), F.max(ts).alias("_b")
    )
    aggs = [
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.min("_a").alias("min_datetime"),
        F.max("_b").alias("max_datetime"),
        F.countDistinct(entity).alias("unique_locations"),
        *[F.countDistinct(n).alias("unique_pollutants") for n in named],
    ]
    return slim.agg(*aggs).withColumn("time_column", F.lit(ts))


def parameter_names(df: DataFrame, name: str = NAME) -> DataFrame:
    return df.select(name).distinct()
