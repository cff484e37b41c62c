"""Places as cells along a Z-shaped curve, so that a box is a few ranges of one column.

A table sorted by the cell has row groups that each cover a small area. A box asked for becomes ranges of cells, which are
pushed to the scan as comparisons of one column and pass over the row groups outside; the exact comparison follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import in_bbox

CELL = "cell"
WORLD = (-180.0, -90.0, 180.0, 90.0)


def _step(value: float, low: float, high: float, bits: int) -> int:
    return min((1 << bits) - 1, max(0, int((value - low) / (high - low) * (1 << bits))))


def cell_of(lon: Column, lat: Column, extent: tuple[float, float, float, float] = WORLD, bits: int = 16) -> Column:
    """The cell of a place: the bits of its column and row in a grid of 2 ** bits each way, in turn. Places outside of ``extent``
    count to the cells at its edge; NULL without a place."""
    def spread(c: Column, low: float, high: float) -> Column:
        part = F.floor((c - low) / (high - low) * (1 << bits))
        part = F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), part)).cast("long")
        return reduce(lambda a, b: a + b, [F.shiftleft(F.shiftright(part, b).bitwiseAND(F.lit(1)), 2 * b) for b in range(bits)])

    x1, y1, x2, y2 = extent
    return spread(lon, x1, x2) + 2 * spread(lat, y1, y2)


def cell_ranges(
    x1: float, y1: float, x2: float, y2: float, extent: tuple[float, float, float, float] = WORLD, bits: int = 16, most: int = 32
) -> list[tuple[int, int]]:
    """At most ``most`` ranges of cells that hold every place of the box, and as few others as that number allows.

    Squares of the curve that lie partly in the box are quartered, the largest first, until there are enough of them.
    """
    low = (_step(x1, extent[0], extent[2], bits), _step(y1, extent[1], extent[3], bits))
    high = (_step(x2, extent[0], extent[2], bits), _step(y2, extent[1], extent[3], bits))
    if x1 > x2 or y1 > y2:
        return []

    def state(x: int, y: int, size: int) -> int:
        """0 outside of the box, 1 partly in it, 2 inside."""
        if x > high[0] or y > high[1] or x + size - 1 < low[0] or y + size - 1 < low[1]:
            return 0
        return 2 if low[0] <= x and low[1] <= y and x + size - 1 <= high[0] and y + size - 1 <= high[1] else 1

    done, open_ = [], [(1 << bits, 0, 0, 0)]  # side, first cell, corner
    while open_ and len(done) + len(open_) + 3 <= most:
        open_.sort(reverse=True)
        size, first, x, y = open_.pop(0)
        if size == 1 or state(x, y, size) == 2:
            done.append((first, first + size * size - 1))
            continue
        half = size // 2
        for k, (dx, dy) in enumerate(((0, 0), (half, 0), (0, half), (half, half))):
            if state(x + dx, y + dy, half):
                open_.append((half, first + k * half * half, x + dx, y + dy))
    done += [(first, first + size * size - 1) for size, first, _, _ in open_]
    out: list[tuple[int, int]] = []
    for a, b in sorted(done):
        if out and out[-1][1] + 1 == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def with_cell(df: DataFrame, lon_col: str, lat_col: str, **grid) -> DataFrame:
    return df.withColumn(CELL, cell_of(F.col(lon_col), F.col(lat_col), **grid))


def sorted_by_cell(df: DataFrame, lon_col: str, lat_col: str, **grid) -> DataFrame:
    """``df`` with its cell, in ranges of cells, to be written as it comes."""
    out = with_cell(df, lon_col, lat_col, **grid)
    return out.repartitionByRange(CELL).sortWithinPartitions(CELL)


def in_bbox_by_cell(df: DataFrame, lon_col: str, lat_col: str, x1: float, y1: float, x2: float, y2: float, most: int = 32, **grid) -> DataFrame:
    """Rows inside the box, edges included, of a table that holds its cells; ``grid`` as the cells were made."""
    ranges = cell_ranges(x1, y1, x2, y2, most=most, **grid)
    near = reduce(lambda a, b: a | b, [F.col(CELL).between(a, b) for a, b in ranges], F.lit(False))
    return in_bbox(df.filter(near), lon_col, lat_col, x1, y1, x2, y2)
