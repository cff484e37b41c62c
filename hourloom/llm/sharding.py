"""Shards of nearly equal bytes by longest-processing-time scheduling of groups that stay together."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hourloom.llm.common import landed


def schedule(items: Iterable[tuple[str, int]], n: int) -> dict[str, int]:
    """Largest first, each to the least loaded of n shards; ties go to the smaller name and the smaller shard."""
    heap = [(0, k) for k in range(n)]
    out = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, k = heap[0]
        heapq.heapreplace(heap, (load + size, k))
        out[name] = k
    return out


def shards(
    docs: DataFrame, n: int = 16, id_col: str = "doc_id", text_col: str = "text", fine: int = 64, bundles: int = 256, cell_rows: int = 50_000
) -> DataFrame:
    """One row for each row of `docs`: id, size, text_crc32, law, shard, slot, grown_shard, group_rows.

    Equal texts are a group and share a shard, however large the group is: a group above 1/n of the bytes makes its
    shard as large as itself. Groups from 1/(n * fine) of the bytes on, so n * fine at most, are scheduled one by
    one; the rest are scheduled in n * bundles bundles by hash, which never part a group. So the heap sees a bounded
    number of items whatever the table holds, and shards differ by about the size of the smallest items.

    A null text counts as an empty one (size 1). Equal rows each get a slot of their own; null ids are allowed. An empty
    table gives an empty one. Texts are read once; what is shuffled are digests.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    thin = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.md5(text).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    )
    thin = landed(thin, "shard-digests")
    groups = landed(thin.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-groups")
    whole = groups.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    total, rows = whole["bytes"] or 0, whole["rows"] or 0

    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("group"), F.lit(n * bundles)).cast("string"))
    item = F.when(F.col("bytes") >= max(1, total // (n * fine)), F.col("group")).otherwise(bundle)
    items = groups.groupBy(item.alias("item")).agg(F.sum("bytes").alias("bytes")).collect()  # n * (fine + bundles) at most
    plan = schedule(((r["item"], r["bytes"]) for r in items), n)
    plan = docs.sparkSession.createDataFrame(list(plan.items()), "item string, shard int")

    single = plan.filter(~F.col("item").startswith("bundle ")).select(F.col("item").alias("group"), F.col("shard").alias("own"))
    placed = thin.join(F.broadcast(single), "group", "left").withColumn("item", bundle).join(F.broadcast(plan), "item", "left")
    placed = placed.withColumn("shard", F.coalesce("own", "shard"))

    # numbers without gaps: rows before a cell of the shard, and the place in the cell
    cell = F.pmod(F.xxhash64("row", "group"), F.lit(max(16, math.ceil(rows / cell_rows))))
    placed = placed.withColumn("cell", cell)
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("rows"))
    start = start.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "cell").orderBy("id", "group", "row")
    slots = placed.withColumn("place", F.row_number().over(within) - 1).join(start, ["shard", "cell"])
    return slots.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
