"""Run logs: one document per run, holding its attempts and their errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_log_summary(logs: DataFrame) -> DataFrame:
    """Per run: errors, saved files, retries over all attempts, the final status and the durations.

    The attempts of a run sit in one array, so this is row-local and needs no shuffle.
    """
    def total(field):
        return F.aggregate(
            "logs", F.lit(0).cast("long"),
            lambda acc, a: acc + F.coalesce(F.size(a[field]), F.lit(0)).cast("long"),
        )

    attempts = F.coalesce(F.size("logs"), F.lit(0))
    final = F.try_element_at(F.col("logs"), F.lit(-1))["status"]
    return logs.select(
        "run_id", "run_start", "run_end", "datetime_from", "datetime_to",
        F.coalesce(F.size("sensors"), F.lit(0)).cast("long").alias("sensor_count"),
        attempts.cast("long").alias("attempts"),
        total("errors").alias("errors"),
        total("saved").alias("saved"),
        F.size(F.filter("logs", lambda a: a["status"] == "retrying")).cast("long").alias("retries"),
        F.when(final == "aborted", "aborted").otherwise("downloaded").alias("status"),
        "download_duration", "saving_duration",
        F.coalesce("total_duration", F.col("download_duration") + F.col("saving_duration")).alias("total_duration"),
    )


def run_log_totals(summary: DataFrame) -> DataFrame:
    """One row over all runs: how many there are, how many failed, and the sums of their figures."""
    counted = ("attempts", "errors", "saved", "retries")
    timed = ("download_duration", "saving_duration", "total_duration")
    return summary.agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "aborted").alias("aborted_runs"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counted],
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in timed],
    )


def run_log_errors(logs: DataFrame) -> DataFrame:
    """One row per error, with the attempt it happened in (1 is the first try)."""
    tries = logs.select(
        "run_id",
        F.inline(F.transform("logs", lambda a: F.struct(
            a["status"].alias("attempt_status"), (a["retries"] + 1).alias("attempt"),
            a["errors"].alias("_errors"),
        ))),
    )
    return tries.select("run_id", "attempt", "attempt_status", F.explode("_errors").alias("_e")).select(
        "run_id", "attempt", "attempt_status",
        F.col("_e.sensor_id").alias("sensor_id"), F.col("_e.type").alias("type"),
    )
