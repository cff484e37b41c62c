"""Intermediate tables in the shared folder, where a summary is read more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import shared_dir


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back: a lost executor costs a task, not the summary."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
