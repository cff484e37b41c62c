"""Readers and writers for landed files and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import conform
from ..operators.incremental import day_of
from ..operators.publish import finish, replace_table
from ..specs import RUN_LOG_JSON, TableSpec

_READERS = ("parquet", "csv", "json")


def read_typed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | TableSpec):
    """Parquet file(s) or a glob, with a declared schema: no inference, absent columns are NULL."""
    schema = schema.schema if isinstance(schema, TableSpec) else schema
    return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))


def concat_files(
    spark: SparkSession, paths: Sequence[str], fmt: str, schema: T.StructType | None = None,
    skip_corrupt: bool = False,
) -> DataFrame | None:
    """All files as one frame, None for no files.

    Files are given to one scan, so their number does not grow the plan. Parquet files may differ
    in columns; CSV headers are checked against ``schema`` when one is given.
    """
    if fmt not in _READERS:
        raise ValueError(f"format must be one of {_READERS}")
    if not paths:
        return None
    reader = spark.read.format(fmt).option("ignoreCorruptFiles", skip_corrupt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        if schema is None:
            reader = reader.option("inferSchema", False)
    if fmt == "parquet" and schema is None:
        reader = reader.option("mergeSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows each source file contributes to a file-based frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def write_reconciled(
    df: DataFrame, path: str, fmt: str = "parquet", expected_rows: int | None = None
) -> int:
    """Write and return the number of rows written; fail when it is not ``expected_rows``.

    Rows are counted while they are written, not in a second pass. The result is a folder of
    part files, one per task, each with its header in the case of CSV.
    """
    if fmt not in _READERS:
        raise ValueError(f"format must be one of {_READERS}")
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    written = int(seen.get["n"])
    if expected_rows is not None and written != expected_rows:
        raise ValueError(f"wrote {written} rows, expected {expected_rows}")
    return written


def concat_to(
    spark: SparkSession, paths: Sequence[str], path: str, fmt: str = "parquet",
    out_fmt: str | None = None, schema: T.StructType | None = None, skip_corrupt: bool = False,
) -> str | None:
    """Concatenate files into ``path`` and check that no row was lost; None for no input."""
    df = concat_files(spark, paths, fmt, schema, skip_corrupt)
    if df is None:
        return None
    expected = rows_per_file(df).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    write_reconciled(df, path, out_fmt or fmt, expected)
    # counted once more from what is on disk, so a row lost by the write shows too
    stored = concat_files(spark, [path], out_fmt or fmt).count()
    if stored != expected:
        raise ValueError(f"{path} holds {stored} rows, expected {expected}")
    return path


def load_table(df: DataFrame, path: str, spec: TableSpec, mode: str = "truncate") -> None:
    """Load a frame into a stored table, ``append`` or ``truncate``.

    The old rows of a truncated table go when all of the new ones have been written beside it; a load that is killed
    leaves the old table, or is finished by the next load.
    """
    if mode not in ("append", "truncate"):
        raise ValueError("mode must be 'append' or 'truncate'")
    out = conform(df, spec)
    if spec.time_col:
        out = out.withColumn(spec.grain, day_of(spec.time_col, spec.grain))
    elif spec.buckets:
        out = out.withColumn(spec.partition, F.pmod(F.xxhash64(*[F.col(k) for k in spec.keys]), F.lit(spec.buckets)).cast("int"))
    grain = spec.partition
    keys = (*spec.sort_cols, spec.time_col) if spec.time_col else spec.sort_cols
    spark = df.sparkSession
    if mode == "truncate":
        replace_table(spark, out, path, grain, keys)
        return
    finish(spark, path)
    if grain:
        out = out.hint("rebalance", F.col(grain)).sortWithinPartitions(grain, *keys)
    writer = out.write.mode("append")
    (writer.partitionBy(grain) if grain else writer).parquet(path)


def run_query(spark: SparkSession, sql: str, args: Mapping | None = None) -> DataFrame:
    """SQL with named parameters; a list argument is an array: ``array_contains(:ids, col)``."""
    return spark.sql(sql, args=dict(args or {}))


def export_query(spark: SparkSession, sql: str, path: str, args: Mapping | None = None) -> int:
    """Write the result of a query to parquet straight from the tasks; returns the row count."""
    return write_reconciled(run_query(spark, sql, args), path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, snappy, microsecond timestamps (the session default of ``build_session``)."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_json_documents(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, results: str | None = None,
    lines: bool = False,
) -> DataFrame:
    """Landed JSON with a declared schema; ``results`` names an array of records to unfold.

    A file is one document, as an API answers, or one document per line when ``lines`` is set;
    only the latter can be split over tasks.
    """
    wanted = schema
    if results:
        wanted = T.StructType([T.StructField(results, T.ArrayType(schema))])
    docs = spark.read.schema(wanted).option("multiLine", not lines).json(path)
    return docs.select(F.inline(results)) if results else docs


def read_run_logs(spark: SparkSession, path: str | Sequence[str], lines: bool = False) -> DataFrame:
    """Run logs, one to a file, or one to a line with ``lines``, which can be split over tasks."""
    return read_json_documents(spark, path, RUN_LOG_JSON, lines=lines)
