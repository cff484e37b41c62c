"""Nested and array-shaped JSON to flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for f in schema:
        here = path + (f.name,)
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, here)
        else:
            yield here


def _at(path: Sequence[str]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every nested field becomes a top-level column named by its path; arrays are left alone."""
    return df.select(*[_at(p).alias(sep.join(p)) for p in _leaves(df.schema)])


def explode_children(
    df: DataFrame, array_col: str, parent: Mapping[str, str], fields: Mapping[str, str]
) -> DataFrame:
    """One row per element of an array of structs; no row for an empty or missing array.

    ``parent`` maps output name to parent column, ``fields`` maps output name to a path inside
    the element (``"parameter.displayName"``). A missing inner struct gives NULL.
    """
    kept = df.select(
        *[F.col(src).alias(out) for out, src in parent.items()], F.explode(array_col).alias("_e")
    )
    return kept.select(
        *parent, *[_at(("_e", *path.split("."))).alias(out) for out, path in fields.items()]
    )


def sensors_of(locations: DataFrame) -> DataFrame:
    """Location documents to one row per sensor."""
    return explode_children(
        locations,
        "sensors",
        parent={"location_id": "id"},
        fields={
            "id": "id",
            "name": "name",
            "parameter_id": "parameter.id",
            "parameter_name": "parameter.name",
            "parameter_units": "parameter.units",
            "parameter_displayName": "parameter.displayName",
        },
    ).select("id", "location_id", "name", "parameter_id", "parameter_name", "parameter_units",
             "parameter_displayName")


def explode_parallel_arrays(df: DataFrame, struct_col: str, keep: Sequence[str]) -> DataFrame:
    """A struct of parallel arrays to rows, with the ``keep`` columns repeated on each row."""
    names = df.schema[struct_col].dataType.fieldNames()
    zipped = F.arrays_zip(*[_at((struct_col, n)) for n in names])
    # arrays_zip names its fields after the source columns, which inline turns into columns
    return df.select(*keep, F.inline(zipped)).toDF(*keep, *names)


def array_to_columns(df: DataFrame, col: str, names: Sequence[str], drop: bool = True) -> DataFrame:
    """The first elements of an array as columns; a short or missing array gives NULL."""
    out = df.withColumns(
        {n: F.try_element_at(F.col(col), F.lit(i + 1)) for i, n in enumerate(names)}
    )
    return out.drop(col) if drop else out
