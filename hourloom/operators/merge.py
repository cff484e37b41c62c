"""Change-aware merge of a staged batch into a target, as a DataFrame and into parquet."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import AUDIT_COLUMNS
from ..session import shared_dir
from ..sources import paths
from ..specs import TableSpec
from .dedupe import keep_latest
from .incremental import day_of, overwrite_days

ACTION = "_action"
APPLIED = "_APPLIED"
ONCE = "once-"


def _all_present(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _labelled(df: DataFrame, action: str) -> DataFrame:
    return df.withColumn(ACTION, F.lit(action))


def _fail(*cols: str):
    text = F.lit("several staged rows match one target row:")
    return F.raise_error(F.concat_ws(" ", text, *[F.col(c).cast("string") for c in cols])).cast("boolean")


def merge_changes(
    target: DataFrame, staged: DataFrame, keys: Sequence[str],
    audit: Sequence[str] = AUDIT_COLUMNS, on_duplicate: str = "raise",
) -> DataFrame:
    """The target after the merge, each row labelled insert / update / refresh / keep.

    * key matched and a data column differs (NULL-safe): all but keys and the first audit column
      come from the batch;
    * matched and equal: only the last audit column moves;
    * not matched in the target: the staged row as it is; not matched in the batch: kept.

    A NULL in a key never matches, so such rows pass by the joins instead of piling up in one of
    their partitions. Two staged rows for one target row fail the job (``"raise"``) unless
    ``on_duplicate="latest"`` keeps the newest of each key first. Copies of a key the target does
    not have are inserted.

    The batch meets the target as one row per key, combined before the shuffle, in a left join, and
    finds its new keys in an anti join against distinct keys. So neither many staged nor many target
    rows of one key come together in a task: Spark splits the preserved side of both joins, which it
    can not do for a full outer join, and it broadcasts a batch that is small.
    """
    if on_duplicate not in ("raise", "latest"):
        raise ValueError("on_duplicate must be 'raise' or 'latest'")
    created, updated, refreshed = audit
    cols = target.columns
    data = [c for c in cols if c not in keys and c not in audit]
    staged = staged.select(*cols)
    present = _all_present(keys)
    known, keyed = target.filter(present), staged.filter(present)
    loose = _labelled(target.filter(~present), "keep").unionByName(_labelled(staged.filter(~present), "insert"))
    if on_duplicate == "latest":
        keyed = keep_latest(keyed, keys, [updated], [*data, created, refreshed])

    one = keyed.groupBy(*keys).agg(
        F.first(F.struct(*[c for c in cols if c not in keys])).alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    s = one.select(
        *[F.col(k).alias(f"s_{k}") for k in keys], *[F.col(f"_row.{c}").alias(f"s_{c}") for c in cols if c not in keys], "_copies"
    )
    t = known.select(*[F.col(c).alias(f"t_{c}") for c in cols])
    same_key = reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys])
    differs = reduce(
        lambda a, b: a | b, [~F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}")) for c in data], F.lit(False)
    )
    in_s = F.col("_copies").isNotNull()
    unambiguous = F.when(F.col("_copies") > 1, _fail(*[f"t_{k}" for k in keys], "_copies")).otherwise(F.lit(True))
    action = F.when(~in_s, "keep").when(differs, "update").otherwise("refresh")

    def merged(c):
        old, new = F.col(f"t_{c}"), F.col(f"s_{c}")
        if c in keys or c == created:
            return old.alias(c)
        if c == refreshed:
            return F.when(in_s, new).otherwise(old).alias(c)
        return F.when(F.col(ACTION) == "update", new).otherwise(old).alias(c)

    matched = (
        t.join(s, same_key, "left").filter(unambiguous).withColumn(ACTION, action)
        .select(*[merged(c) for c in cols], ACTION)
    )
    # the target's keys shrink to those of the batch before they are made distinct
    met = known.select(*keys).join(keyed.select(*keys), list(keys), "left_semi").distinct()
    fresh = _labelled(keyed.join(met, list(keys), "left_anti").select(*cols), "insert")
    return matched.unionByName(fresh).unionByName(loose)


def partition_of(spec: TableSpec) -> Column:
    """The partition a row is stored in: its date, or the bucket of its keys."""
    if spec.time_col:
        return day_of(spec.time_col, spec.grain)
    return F.pmod(F.xxhash64(*[F.col(k) for k in spec.keys]), F.lit(spec.buckets)).cast("int")


def _touched(target: DataFrame, staged: DataFrame, spec: TableSpec) -> DataFrame:
    """Target rows of the partitions a batch touches, as a partition filter.

    The partitions are looked up first: there is at most one per calendar day, or per bucket, and Spark prunes at run
    time only when it expects the batch to be selective, which it can not know of landed files.
    """
    days = [r[0] for r in staged.select(partition_of(spec)).distinct().collect()]
    part = F.col(spec.partition)
    dated = part.isin([d for d in days if d is not None])
    return target.filter(dated | part.isNull() if None in days else dated)


def stored_schema(spec: TableSpec) -> T.StructType:
    """Columns as stored: those declared, then the date or bucket a row is stored under."""
    if not spec.partition:
        return spec.schema
    return T.StructType([*spec.schema.fields, T.StructField(spec.partition, T.DateType() if spec.time_col else T.IntegerType())])


def merge_folder(spark: SparkSession, path: str, spec: TableSpec, scratch: str | None = None) -> str:
    """Where the merges into one table keep their rows, in the shared scratch folder."""
    return f"{scratch or shared_dir(spark)}/merge-{spec.name}-{hashlib.sha1(path.encode()).hexdigest()[:12]}"


def _apply(spark: SparkSession, path: str, spec: TableSpec, work: str) -> None:
    """Copy merged rows to the table, then say so. Doing it twice in a row gives the same table."""
    done = spark.read.schema(stored_schema(spec)).parquet(f"{work}/merged").write.mode("overwrite")
    if spec.partition:
        done.option("partitionOverwriteMode", "dynamic").partitionBy(spec.partition).parquet(path)
    else:
        done.option("partitionOverwriteMode", "static").parquet(path)
    paths.touch(spark, f"{work}/{APPLIED}")
    for part in ("merged", "rows"):
        paths.delete(spark, f"{work}/{part}")


def finish_merges(spark: SparkSession, path: str, spec: TableSpec, scratch: str | None = None) -> None:
    """Copy what a merge that died had already merged in full; drop what it had not."""
    for work in paths.folders(spark, merge_folder(spark, path, spec, scratch)):
        once = work.rsplit("/", 1)[1].startswith(ONCE)
        if paths.is_complete(spark, f"{work}/merged") and not paths.exists(spark, f"{work}/{APPLIED}"):
            _apply(spark, path, spec, work)
        if once:
            paths.delete(spark, work)


def upsert_table(
    spark: SparkSession, path: str, staged: DataFrame, spec: TableSpec,
    on_duplicate: str = "raise", batch: str | None = None, scratch: str | None = None,
) -> bool:
    """Merge a batch into a parquet table; returns False when the batch is empty.

    A table with a time column is stored by day, and only the days the batch touches are read and
    replaced; one with ``buckets`` likewise by the hash of its keys. The time column must be a key, or a row that moves to another day would stay on the
    old one too. The batch is written to the shared scratch folder first and read from there, so it
    is evaluated once. The merged rows are written there in full too, and copied to the table.

    The table is never read and overwritten in one job. A merge that died while copying is finished
    by the next call for the same table, whatever its batch, before anything else is read. A batch
    named ``batch`` that has been applied is not applied again. One writer per table is assumed.
    """
    if spec.time_col and spec.time_col not in spec.keys:
        raise ValueError(f"{spec.name}: the time column {spec.time_col} must be one of the keys")
    finish_merges(spark, path, spec, scratch)
    work = f"{merge_folder(spark, path, spec, scratch)}/{batch or ONCE + uuid.uuid4().hex}"
    if paths.exists(spark, f"{work}/{APPLIED}"):
        return True
    rows = f"{work}/rows"
    if not paths.is_complete(spark, rows):
        staged.select(*spec.columns).write.mode("overwrite").parquet(rows)
    staged = spark.read.schema(spec.schema).parquet(rows)
    if staged.isEmpty():
        paths.delete(spark, work)
        return False
    if paths.has_files(spark, path):
        target = spark.read.schema(stored_schema(spec)).parquet(path)
    else:
        target = spark.createDataFrame([], stored_schema(spec))
    if spec.partition:
        target = _touched(target, staged, spec)
    merged = merge_changes(target.select(*spec.columns), staged, spec.keys, on_duplicate=on_duplicate).drop(ACTION)
    if spec.time_col:
        overwrite_days(merged, f"{work}/merged", spec.time_col, spec.sort_cols, spec.grain)
    elif spec.partition:
        out = merged.withColumn(spec.partition, partition_of(spec)).hint("rebalance", F.col(spec.partition))
        out = out.sortWithinPartitions(spec.partition, *spec.sort_cols)
        out.write.mode("overwrite").partitionBy(spec.partition).parquet(f"{work}/merged")
    else:
        merged.write.mode("overwrite").parquet(f"{work}/merged")
    _apply(spark, path, spec, work)
    if batch is None:
        paths.delete(spark, work)
    return True


_CLAIM = "name string, size long, modified long"


def upsert_files(
    spark: SparkSession, path: str, landed: str, spec: TableSpec, on_duplicate: str = "raise",
    clear: bool = True, batch: str | None = None, scratch: str | None = None,
) -> bool:
    """Merge the parquet files that have landed and were not merged before; remove exactly those.

    A call claims the files it finds by writing down their names, sizes and times next to the merged
    rows. Files of a claim that has been applied are never merged again, whether or not they are still
    there; files that land meanwhile wait for the next call, also under the same ``batch`` name.
    """
    finish_merges(spark, path, spec, scratch)
    root = merge_folder(spark, path, spec, scratch)
    claims = [w for w in paths.folders(spark, root) if paths.exists(spark, f"{w}/files") and paths.exists(spark, f"{w}/{APPLIED}")]
    claimed = {tuple(r): w for w in claims for r in spark.read.schema(_CLAIM).parquet(f"{w}/files").collect()}
    found = paths.files(spark, landed)
    new = sorted(f for f in found if f not in claimed)
    merged = False
    if new:
        digest = hashlib.sha1(repr(new).encode()).hexdigest()
        name = f"{batch or 'files'}-{digest}"
        spark.createDataFrame(new, _CLAIM).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}/files")
        staged = spark.read.schema(spec.schema).parquet(*[f[0] for f in new])
        merged = upsert_table(spark, path, staged, spec, on_duplicate, name, scratch)
        claimed |= dict.fromkeys(new, f"{root}/{name}")
    if clear:
        for f in found:
            if f in claimed:
                paths.delete(spark, f[0])
        for w in set(claimed.values()):
            paths.delete(spark, w)
    return merged


def read_table(spark: SparkSession, path: str, spec: TableSpec, with_partition: bool = False) -> DataFrame:
    """The stored columns in declared order. Readers that prune by day ask for the day column too."""
    more = [spec.partition] if with_partition and spec.partition else []
    return spark.read.schema(stored_schema(spec)).parquet(path).select(*spec.columns, *more)
