"""Parquet files looked at one by one before they are read as one: damaged ones set apart, differing columns widened."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .landing import landed

REPORT = "path string, size long, n_rows long, columns string, reason string"
#: From narrow to wide; every type holds all values of those before it in its line, as far as text or a double can.
WIDER = (
    ("tinyint", "smallint", "int", "bigint", "double", "string"),
    ("float", "double", "string"),
    ("date", "timestamp_ntz", "timestamp", "string"),
    ("boolean", "string"),
)
#: Bytes up to which a file is handed to a task as one value. Larger ones come in pieces, and the same is found.
WHOLE = 1 << 26
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd|xz|lzo)$"  # endings by which Hadoop unpacks text
_ARROW = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float", "double": "double", "string": "string",
    "large_string": "string", "bool": "boolean", "date32[day]": "date",
}


def type_name(kind: pa.DataType) -> str:
    """Spark's name of a column's type; one in angle brackets for types that aren't widened."""
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    return _ARROW.get(str(kind), f"<{kind}>")


def _holds(narrow: str, wide: str) -> bool:
    return any(narrow in line and wide in line and line.index(narrow) <= line.index(wide) for line in WIDER)


def widest(kinds: set[str]) -> str | None:
    """The narrowest type that all of ``kinds`` widen to; None if there is none."""
    if len(kinds) == 1:
        return next(iter(kinds))
    fits = {t for line in WIDER for t in line if all(_holds(k, t) for k in kinds)}
    return next((t for t in fits if all(_holds(t, u) for u in fits)), None)


def _looked_into(source: pa.NativeFile) -> tuple[int | None, str | None, str | None]:
    """Rows and columns of one file, all row groups read; or why it can't be."""
    try:
        file = pq.ParquetFile(source)
        columns = json.dumps([[f.name, type_name(f.type)] for f in file.schema_arrow])
        return sum(file.read_row_group(i).num_rows for i in range(file.num_row_groups)), columns, None
    except Exception as e:  # noqa: BLE001  whatever is wrong with it is what is asked
        return None, None, f"{type(e).__name__}: {str(e).splitlines()[0][:200] if str(e) else ''}"


def _said(name: str, size: int, found: tuple) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip((name, size, *found), kinds, strict=True)], names=["path", "size", "n_rows", "columns", "reason"])


def _in_pieces(lines: DataFrame) -> DataFrame:
    """The report of files that come as lines (path, size, start, line): joined to pieces where they are read, and put together
    again on the disk of one task for each file, so no file is in memory whole."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, b in enumerate(batches):  # lines of a block come one behind the other
            if not b.num_rows:
                continue
            names, sizes, starts, found = (b.column(i).to_pylist() for i in range(4))
            cuts = [0, *(i for i in range(1, b.num_rows) if (names[i], starts[i]) != (names[i - 1], starts[i - 1])), b.num_rows]
            own = [[x[i] for i in cuts[:-1]] for x in (names, sizes, starts)]
            columns = [pa.array(own[0], pa.string()), pa.array(own[1], pa.int64()), pa.array(own[2], pa.int64()), pa.array([n] * len(cuts[:-1]), pa.int64())]
            pieces = pa.array([b"\n".join(found[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, pieces], names=["path", "size", "start", "n", "piece"])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            at, name, size, to = f"{folder}/file", None, None, None

            def looked_at() -> pa.RecordBatch:
                left = size - to.tell()  # lines don't tell of a line end behind the last of them, and of a mark of UTF-8 before the first
                if left not in (0, 1, 3, 4):
                    raise ValueError(f"{name}: {to.tell()} of {size} bytes were read")
                if left % 3:
                    to.write(b"\n")
                to.close()
                if left >= 3:
                    with open(at, "rb") as rest, open(f"{at}-marked", "wb") as whole:
                        whole.write(b"\xef\xbb\xbf")
                        shutil.copyfileobj(rest, whole)
                    os.replace(f"{at}-marked", at)
                with pa.memory_map(at) as source:
                    return _said(name, size, _looked_into(source))

            for b in batches:
                for new, length, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4), strict=True):
                    if new != name:
                        if to:
                            yield looked_at()
                        name, size, to = new, length, open(at, "wb")
                    else:
                        to.write(b"\n")
                    to.write(piece.as_buffer())
            if to:
                yield looked_at()

    pieces = lines.mapInArrow(joined, "path string, size long, start long, n long, piece binary")
    return pieces.repartition("path").sortWithinPartitions("path", "start", "n").mapInArrow(put_together, REPORT)


def inspect_parquet(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """A row for each file under ``path``: its size, rows, columns (names and types, as JSON), and why it can't be read.

    Each file is opened by a task, footer and row groups, all columns, whatever its size. ``reason`` is NULL for a sound file.
    Files up to :data:`WHOLE` bytes are handed to the task as they are, larger ones in pieces (:func:`_in_pieces`); what is found
    is the same. Only if ``max_bytes`` is given, files above it are not opened: they have no reason and no columns. Files of no
    bytes are passed over, as Spark does in every scan.
    """

    def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, size, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                yield _said(name, size, _looked_into(pa.BufferReader(content.as_buffer())))

    def under(kind: str, **options) -> DataFrame:
        return spark.read.format(kind).options(recursiveFileLookup=True, pathGlobFilter="[!_.]*", **options).load(path)

    name, size = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    # text is unpacked by its name, so files named like packed ones are handed over whole
    large, opened = (F.col("_metadata.file_size") > WHOLE) & ~F.col("_metadata.file_name").rlike(PACKED), F.lit(True)
    if max_bytes is not None:
        opened = F.col("_metadata.file_size") <= max_bytes
    own = under("binaryFile").filter(opened & ~large).select(name, F.col("length").alias("size"), "content")
    lines = under("text", lineSep="\n").filter(opened & large)
    lines = lines.select(name, size, F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    report = own.mapInArrow(looked_at, REPORT).unionByName(_in_pieces(lines))
    if max_bytes is None:
        return report
    none = [F.lit(None).cast(t).alias(c) for c, t in (("n_rows", "long"), ("columns", "string"), ("reason", "string"))]
    return report.unionByName(under("binaryFile").filter(~opened).select(name, F.col("length").alias("size"), *none))


def read_sound(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """Rows of the sound files under ``path``, and the files set apart with the reason.

    A damaged file gives no row at all, not those before the damage. Bad files are left out by their name where rows are
    read, so no list of files passes the driver.
    """
    report = landed(inspect_parquet(spark, path), "inspected")
    bad = report.filter("reason is not null")
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).parquet(path)
    names = rows.columns
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    rows = rows.join(bad.select(F.col("path").alias("_file")), "_file", "left_anti")
    return rows.select(*[f"`{c}`" for c in names]), bad.select("path", "size", "reason")


def _as(kind: str, to: str, column: Column) -> Column:
    if kind == to:
        return column
    if kind.startswith(("<struct", "<list", "<large_list", "<map")):
        return F.to_json(column)
    return column.cast(to)


def concat_widened(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame]:
    """All sound files under ``path`` as one frame although their columns differ, and a row for each file and column that
    doesn't fit: ``path, column, type, read_as``.

    Footers are read in tasks. Files of one shape are read together; a column gets the narrowest type that all
    its types widen to (:data:`WIDER`), and is NULL in files without it. Where there is none, it is text: nested values as JSON. Those
    are told as conflicts, as is every damaged file (column NULL, the reason as its type). None for no sound file.
    """
    report = landed(inspect_parquet(spark, path), "inspected")
    shapes = [r[0] for r in report.filter("columns is not null").select("columns").distinct().collect()]  # one for each shape
    kinds: dict[str, set[str]] = {}
    for shape in shapes:
        for name, kind in json.loads(shape):
            kinds.setdefault(name, set()).add(kind)
    to = {name: widest(k) or "string" for name, k in kinds.items()}
    odd = [name for name, k in kinds.items() if widest(k) is None]
    parts = None
    for shape in sorted(shapes):
        files = [r[0] for r in report.filter(F.col("columns") == shape).select("path").collect()]  # the names a scan is given
        own = dict(map(tuple, json.loads(shape)))
        one = spark.read.parquet(*files)
        one = one.select(*[
            _as(own[c], to[c], F.col(f"`{c}`")).alias(c) if c in own else F.lit(None).cast(to[c] if not to[c].startswith("<") else "string").alias(c)
            for c in to if c in own or not to[c].startswith("<")
        ])
        parts = one if parts is None else parts.unionByName(one, allowMissingColumns=True)
    said = F.from_json("columns", "array<array<string>>")
    found = report.select("path", F.explode(said).alias("c")).select("path", F.col("c")[0].alias("column"), F.col("c")[1].alias("type"))
    conflicts = found.filter(F.col("column").isin(odd)).withColumn("read_as", F.lit("string"))
    damaged = report.filter("reason is not null").select("path", F.lit(None).cast("string").alias("column"), F.col("reason").alias("type"), F.lit(None).cast("string").alias("read_as"))
    return parts, conflicts.unionByName(damaged)
