"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key, ties settled by ``tie_breakers`` so that reruns agree.

    ``row_number() = 1`` lets Spark drop all but one row per key in every map task before the
    shuffle, so a key with very many copies sends at most one row per input partition.
    """
    newest = [F.col(c).desc_nulls_last() for c in order_by]
    ties = [F.col(c).asc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*newest, *ties)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
