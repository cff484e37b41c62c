"""Row selection that reaches the scan, and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EXCLUDED_SENSORS
from ..functions import moment


def active_between(
    df: DataFrame, first_col: str, last_col: str, date_from=None, date_to=None
) -> DataFrame:
    """Entities whose [first, last] activity overlaps the asked period; either bound may be absent."""
    if date_from not in (None, ""):
        df = df.filter(F.col(last_col) >= moment(date_from, df.schema[last_col].dataType))
    if date_to not in (None, ""):
        df = df.filter(F.col(first_col) <= moment(date_to, df.schema[first_col].dataType))
    return df


def exclude_ids(df: DataFrame, ids: DataFrame, col: str, id_col: str | None = None) -> DataFrame:
    """Rows whose id is not listed. The join strategy is left to the optimiser's size estimate."""
    listed = ids.select(F.col(id_col or col).alias("_listed"))
    return df.join(listed, F.col(col) == F.col("_listed"), "left_anti")


def exclude_banned(df: DataFrame, col: str, ids: Sequence[str] = EXCLUDED_SENSORS) -> DataFrame:
    """The same for a short fixed list, as a filter that reaches the scan; a NULL id is kept."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(*ids))


def in_bbox(
    df: DataFrame, lon_col: str, lat_col: str, x1: float, y1: float, x2: float, y2: float
) -> DataFrame:
    """Rows inside the box, edges included: (x1, y1) lower left, (x2, y2) upper right."""
    return df.filter(F.col(lon_col).between(x1, x2) & F.col(lat_col).between(y1, y2))


def since(df: DataFrame, ts_col: str, start) -> DataFrame:
    return df.filter(F.col(ts_col) >= moment(start, df.schema[ts_col].dataType))


def only_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def is_member(col: str | Column, values: Sequence) -> Column:
    """Exact membership; NULL counts as not listed."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.isin(*values), F.lit(False))
