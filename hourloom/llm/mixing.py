"""Mixing of sources to target weights by systematic sampling.

Each source gets a share of all words by its weight, within what `most` copies of it can give. A document's expected copies
are its source's target over its source's size. Within each source the documents stand in order of size; their expected copies are
summed up from the first on, one random offset is added, and a document is emitted once for each whole number that its
stretch of the sum crosses. As neighbours in that order are of nearly equal size, the words taken miss the target by about
one large document, whatever the source holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import landed

WORD = r"[^\x20\x09-\x0D]+"
UNIT = 1 << 24  # copies are counted in these parts, so that sums are exact and no order of addition matters
CELLS = 1 << 16
HEX = 15  # hexadecimal digits of a hash that make a number


def number(text: Column) -> Column:
    """A hash of `text` as a number below 16 ** HEX."""
    return F.conv(F.substring(F.md5(text), 1, HEX), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3) -> DataFrame:
    """`sizes` (source, source_size; one row for each source) with `place`, `weight` and `target`.

    Sources in order of code points, null last, get `weights` in turn. Targets share the sum of all sizes by weight; none is
    above `most` times its source's size, and what it can't take is shared by the others. The level at which target =
    level * weight is found by sums over all sources, one round for each time that more of them come to their limit.
    """
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    ordered = landed(ordered.withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    parts = ordered.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    placed = ordered.withColumn("part", F.shiftright("at", 33)).join(parts, "part")
    placed = placed.withColumn("place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = landed(placed.select("source", "source_size", "place", weight.alias("weight")), "mix-places")

    level = 0.0
    limit = F.col("source_size") * most
    while True:
        full = F.col("weight") * F.lit(level) >= limit
        now = placed.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, limit).otherwise(0)).alias("held"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not now["open"]:
            break
        higher = (now["all"] - now["held"]) / now["open"]
        if higher <= level:
            break
        level = higher
    return placed.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level)))


def copies(
    docs: DataFrame, keep: Sequence[str], weights: Sequence[float] = (1, 2, 3), most: int = 3, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row for each row of `docs`: `doc`, a struct of the columns `keep`, and size, source_size, target, copies.

    Size is the number of words (null text: none). A source without words has target 0 and gives no copies. The same rows
    give the same copies in every order of the table; rows that agree in id and text are told apart by nothing and share
    theirs out among themselves. Null ids and null sources are values like others. An empty table gives an empty one.

    Documents of a source are dealt by size, and those of one size to CELLS cells by hash, so no source and no size is
    one task's, whatever its share of the rows. Their places need the counts of cells only, which are combined before the
    shuffle: at most CELLS for a size, and one number for each size of a source.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    hashed = number(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), text))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("doc"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), hashed.alias("h"),
    )
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))  # never null
    rows = rows.withColumn("cell", F.floor(F.col("h") / (16**HEX // CELLS)).cast("int"))
    counts = landed(rows.groupBy("key", "source", "size", "cell").agg(F.count(F.lit(1)).alias("rows")), "mix-cells")
    by_size = landed(counts.groupBy("key", "source", "size").agg(F.sum("rows").alias("rows")), "mix-sizes")
    shares = targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, most)
    each = F.when(F.col("source_size") > 0, F.least(F.lit(most * UNIT), F.floor(F.col("target") / F.col("source_size") * UNIT + 0.5))).otherwise(0)
    offset = number(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))) % UNIT
    shares = shares.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), "source_size", "target", each.cast("long").alias("each"), offset.alias("offset")
    )

    def before(order: str, *keys: str) -> Column:
        """Rows of smaller `order`."""
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("rows").over(window), F.lit(0))

    smaller = by_size.select("key", "size", before("size", "key").alias("smaller")).join(shares, "key")
    starts = counts.select("key", "size", "cell", before("cell", "key", "size").alias("earlier")).join(smaller, ["key", "size"])
    dealt = rows.join(landed(starts, "mix-starts"), ["key", "size", "cell"])
    within = Window.partitionBy("key", "size", "cell").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = (F.col("smaller") + F.col("earlier")) * F.col("each") + F.col("offset")
    dealt = dealt.withColumn("upto", start + F.sum("each").over(within))
    crossed = F.floor(F.col("upto") / UNIT) - F.floor((F.col("upto") - F.col("each")) / UNIT)
    return dealt.select("doc", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every row of `docs` as often as copies() says, with all of its columns; options as there."""
    found = copies(docs, docs.columns, **options)
    return found.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row for each row of `docs`: id, size, source_size, target, taken (words in all of its copies)."""
    found = copies(docs, [id_col], id_col=id_col, **options)
    return found.select(F.col(f"doc.`{id_col}`").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
