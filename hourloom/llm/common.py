"""What the operators of this package share: tables, landed intermediates, and byte arithmetic on Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that one round of array work takes; its temporaries are about 60 times as large.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, and lost executors don't matter any more.

    Unlike checkpoint() it runs its last stage once, and the size of the files tells Spark how to join them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most `rows` rows in this session: with whole texts in them, Spark's 10,000 would take too much
    memory on both sides of a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def whole_row(docs: DataFrame) -> Column:
    """All columns of `docs` as one struct, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def each(array: Column | str, f: Callable, *fixed) -> Column:
    """f(element, *fixed) for each element."""
    return F.transform(array, lambda x: f(x, *fixed))


def only(array: Column | str, f: Callable, *fixed) -> Column:
    """The elements for which f(element, *fixed) holds."""
    return F.filter(array, lambda x: f(x, *fixed))


# --- byte arithmetic -------------------------------------------------------------------------------------------------

U64 = np.uint64
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}

#: Bytes that end a word: space, tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, n of them at least."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.full(max(n, CHUNK_BYTES + 1), U64(base))
            have[0] = 1
            _POWERS[base] = have = np.multiply.accumulate(have)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others (a bijection)."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes data[start:end], that depend on these bytes alone."""
    n = len(data)
    inverse = pow(_BASE, -1, 1 << 64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, n)[:n], out=total[1:])
    return mix((total[end] - total[start]) * powers(inverse, n + 1)[start])


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k neighbours of h: len(h) - k + 1 of them."""
    if len(h) < k:
        return h[:0]
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out *= U64(_BASE)
        out += h[i : i + len(out)]
    return mix(out)


class Texts:
    """Some documents of a batch as one byte array; document i has the bytes from off[i] to off[i + 1]."""

    def __init__(self, first: int, data: np.ndarray, off: np.ndarray):
        self.first, self.data, self.off = first, data, off

    def __len__(self) -> int:
        return len(self.off) - 1

    def words(self, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word (bytes that aren't SPACE), and how many words lie before each document (one entry more)."""
        solid = ~SPACE[self.data]
        edge = np.empty(len(solid), dtype=bool)
        if len(solid):
            edge[0] = solid[0]
            np.greater(solid[1:], solid[:-1], out=edge[1:])
            heads = self.off[:-1][self.off[:-1] < len(solid)]
            edge[heads] = solid[heads]
        start = np.flatnonzero(edge)
        stop = np.empty(len(solid), dtype=bool)
        if len(solid):
            stop[-1] = solid[-1]
            np.greater(solid[:-1], solid[1:], out=stop[:-1])
            tails = self.off[1:] - 1
            tails = tails[tails >= 0]
            stop[tails] = solid[tails]
        return start, np.flatnonzero(stop) + 1, np.searchsorted(start, self.off)


def texts(column: pa.Array, fold: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column's texts (null: empty) in runs of about `limit` bytes; a longer text makes a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    if column.null_count:
        size = np.where(np.asarray(column.is_null()), 0, np.diff(off))
        if (np.diff(off) != size).any():  # nulls with bytes of their own
            column = column.fill_null("")
            yield from texts(column, fold, limit)
            return
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        part = data[off[i] : off[j]]
        yield Texts(i, FOLD[part] if fold else part, off[i : j + 1] - off[i])
        i = j


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1 ... of length[0], then those of start[1] and so on."""
    length = np.asarray(length, dtype=np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(length)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(start, dtype=np.int64) - (ends - length), length)


def batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
