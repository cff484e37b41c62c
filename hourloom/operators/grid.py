"""Concurrency, pivot, and the dense hourly grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import moment
from .hot import HOT_ROWS, hot_groups, inside, outside

ENTITY, TS, CONCURRENT = "location_id", "datetimeto_utc", "concurrent_sensors"


def tag_concurrency(
    df: DataFrame, keys: Sequence[str] = (ENTITY, TS), value: str = "value",
    out: str = CONCURRENT, hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number of non-null readings that share the keys, added to every row.

    Ordinary groups are counted by one window. A group of more than ``hot_rows`` rows is never
    brought together: its count comes from a pre-aggregated total that is broadcast to the rows
    where they are. There can be at most ``rows / hot_rows`` such groups, so that broadcast is
    small. Pass ``hot_rows=None`` for input known to hold few readings per key, which saves
    the counting pass.
    """
    def windowed(d):
        return d.withColumn(out, F.count(value).over(Window.partitionBy(*keys)))

    if hot_rows is None:
        return windowed(df)
    hot = hot_groups(df, keys, [F.count(value).alias(out)], hot_rows)
    return windowed(outside(df, hot, keys)).unionByName(inside(df, hot, keys))


def pivot_readings(
    df: DataFrame, mapping: Mapping[str, str], keys: Sequence[str] = (ENTITY, TS),
    pivot_col: str = "parameter_id", value_col: str = "value", concurrent: str | None = None,
    count_mode: str = "rows",
) -> DataFrame:
    """Long readings to one row per key with a column per parameter and the concurrency.

    Concurrency is the count of non-null readings of the key. Counting in the same aggregation as
    the pivot gives the number a window over the long rows would give, without that window, and
    with map-side partial aggregation. Name an existing ``concurrent`` column to take its
    maximum instead; ``count_mode="distinct"`` counts parameters instead of readings.
    """
    cells = [
        F.max(F.when(F.col(pivot_col) == pid, F.col(value_col))).alias(name)
        for name, pid in mapping.items()
    ]
    counted = F.max(concurrent) if concurrent else F.count(value_col)
    out = df.groupBy(*keys).agg(*cells, F.coalesce(counted, F.lit(0)).cast("long").alias(CONCURRENT))
    if count_mode == "distinct":
        present = sum((F.col(n).isNotNull().cast("long") for n in mapping), F.lit(0).cast("long"))
        out = out.withColumn(CONCURRENT, present)
    elif count_mode != "rows":
        raise ValueError("count_mode must be 'rows' or 'distinct'")
    return out.select(*keys, *mapping, CONCURRENT)


def dense_grid(
    pivoted: DataFrame, start, end, entity: str = ENTITY, ts: str = TS,
    fill: Mapping[str, int] | None = None, step_hours: int = 1, step_minutes: int | None = None,
    chunk: str | None = None, entities: DataFrame | None = None,
) -> DataFrame:
    """Every entity at every step from ``start`` to ``end``; hours without a row hold NULLs.

    The result is that of (entities x spine) left-joined with the pivoted rows, but neither the
    product nor the join is built: each row, seeing the next one of its entity, emits itself
    and the steps missing before that next row. One shuffle on the entity, which the
    segmentation that follows reuses. Rows off the grid or outside the bounds are not shown, yet
    their entity still gets its hours. ``fill`` names columns that get a number instead of NULL.

    ``step_minutes`` asks for a finer grid than ``step_hours``. For few entities with long or fine series
    pass ``chunk`` (``"day"``, ``"month"``): then the work is spread over (entity, chunk), no row fills more than the
    rest of its chunk, and nothing else than the list of ``entities`` (by default those of ``pivoted``) is brought together.
    """
    fill = {CONCURRENT: 0} if fill is None else fill
    kind = pivoted.schema[ts].dataType
    first, last = moment(start, kind), moment(end, kind)
    minutes = step_minutes or 60 * step_hours
    step = F.expr(f"interval {minutes} minute")
    micros = 60_000_000 * minutes

    def us(c):
        return F.unix_micros(c.cast("timestamp"))

    on_grid = (
        F.col(entity).isNotNull()
        & F.col(ts).between(first, last)
        & (F.pmod(us(F.col(ts)) - us(first), F.lit(micros)) == 0)
    )
    own = F.col("_at") == F.col("_slot")
    values = [c for c in pivoted.columns if c not in (entity, ts)]
    cols = [
        (
            F.when(own, F.coalesce(F.col(c), F.lit(fill[c]))).otherwise(F.lit(fill[c]))
            if c in fill
            else F.when(own, F.col(c))
        ).cast(pivoted.schema[c].dataType).alias(c)
        for c in values
    ]
    if chunk:
        places = entities_of(pivoted, entity) if entities is None else entities.select(entity).distinct()
        slots = pivoted.filter(on_grid).withColumn("_slot", F.col(ts))
        filled = _filled_by_chunk(slots, places, entity, first, last, step, micros, chunk, us)
        return filled.select(entity, F.col("_at").alias(ts), *cols)
    w = Window.partitionBy(entity).orderBy(F.col("_slot").asc_nulls_first())
    # an entity has at most one row per step once pivoted, so no window group outgrows the spine
    seen = pivoted.withColumn("_slot", F.when(on_grid, F.col(ts))).select(
        "*",
        F.lag("_slot").over(w).alias("_prev"),
        F.lead("_slot").over(w).alias("_next"),
        F.lead(F.lit(1)).over(w).isNotNull().alias("_more"),
    )
    begin = (
        F.when(F.col("_slot").isNull() & F.col("_more"), F.lit(None))
        .when(F.col("_prev").isNull(), first)
        .otherwise(F.col("_slot"))
    )
    stop = F.greatest(F.coalesce(F.col("_next") - step, last), F.col("_slot"))
    hours = F.when(begin <= stop, F.sequence(begin, stop, step))
    return seen.withColumn("_at", F.explode(hours)).select(
        entity, F.col("_at").alias(ts), *cols
    )


def _filled_by_chunk(slots, places, entity, first, last, step, micros, chunk, us) -> DataFrame:
    """Rows of ``slots`` and the steps missing between them (``_at``), worked on by (entity, chunk).

    Every entity gets a marker for each chunk of the calendar, which stands for the steps before the first row of the chunk.
    So a chunk without rows is filled by its marker, and no row has to know its neighbours in other chunks.
    """
    kind = slots.schema["_slot"].dataType

    def chunk_of(c):
        return F.date_trunc(chunk, c).cast(kind)

    one = F.expr(f"interval 1 {chunk}")
    marks = places.select(
        entity, F.explode(F.sequence(chunk_of(first), chunk_of(last), one)).alias("_chunk"), F.lit(None).cast(kind).alias("_slot")
    )
    rows = slots.withColumn("_chunk", chunk_of(F.col("_slot"))).unionByName(marks, allowMissingColumns=True)
    # the first and last step inside a chunk: steps are counted from the start of the grid
    up = F.greatest(F.lit(0), F.ceil((us(F.col("_chunk")) - us(first)) / micros))
    down = F.floor((us(F.col("_chunk") + one) - 1 - us(first)) / micros)
    low = F.timestamp_micros(us(first) + up * micros).cast(kind)
    high = F.least(last, F.timestamp_micros(us(first) + down * micros).cast(kind))
    w = Window.partitionBy(entity, "_chunk").orderBy(F.col("_slot").asc_nulls_first())
    begin = F.coalesce("_slot", low)
    stop = F.greatest(F.coalesce(F.lead("_slot").over(w) - step, high), F.col("_slot"))
    rows = rows.withColumn("_begin", begin).withColumn("_stop", stop)
    hours = F.when(F.col("_begin") <= F.col("_stop"), F.sequence(F.col("_begin"), F.col("_stop"), step))
    return rows.withColumn("_at", F.explode(hours))


def entities_of(df: DataFrame, entity: str = ENTITY) -> DataFrame:
    return df.select(entity).distinct()
