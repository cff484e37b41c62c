"""Positions in a global order, without bringing the rows to one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import null_safe_join
from ..sources.landing import landed

_AT, _PART = "_at", 33  # a row's number inside its partition takes the lower bits


def number_in_order(ordered: DataFrame, out: str = "position") -> DataFrame:
    """Rows of a sorted frame, numbered from 1 in the order they come in.

    A global sort leaves ranges, one to a partition. They are written as they come, counted, and each row's number is that
    inside its range and the rows of the ranges before. Only a count for each partition reaches the driver.
    """
    rows = landed(ordered.withColumn(_AT, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(_AT, _PART)
    before, parts = 0, []
    for number, n in sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect()):
        parts.append((number, before))
        before += n
    starts = F.broadcast(ordered.sparkSession.createDataFrame(parts, "_part long, _before long"))
    place = F.col("_before") + F.col(_AT).bitwiseAND((1 << _PART) - 1) + 1
    return rows.join(starts, part == F.col("_part")).withColumn(out, place).drop(_AT, "_part", "_before")


def number_rows(
    df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), out: str = "position", partitions: int | None = None
) -> DataFrame:
    """Rows numbered from 1 by ``order``, within each value of ``by``; rows that tie are numbered in any order.

    Sorted by range on ``by``, ``order`` and a number that tells ties apart, so neither a large group nor many equal keys
    have to be one task's. NULL in ``by`` is a value like others.
    """
    keys = [*[F.col(f"`{c}`").asc_nulls_last() for c in by], *[F.col(f"`{c}`").asc_nulls_last() if isinstance(c, str) else c for c in order], F.col("_tie")]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranges = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
    numbered = number_in_order(ranges.sortWithinPartitions(*keys).drop("_tie"), out)
    if not by:
        return numbered
    first = numbered.groupBy(*by).agg((F.min(out) - 1).alias("_first"))
    return null_safe_join(numbered, first, list(by)).withColumn(out, F.col(out) - F.col("_first")).drop("_first")
