"""URL filters: host and path rules, and a cascade of Bloom filters that knows a list exactly.

The first filter holds the listed keys; the second those keys of the corpus that pass the first without being listed;
the third the listed ones that pass the second, and so on until none is left. The first filter that a key fails decides.
Over the keys the cascade was built with the answer is exact, and asking takes no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, landed, mix

U64 = np.uint64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

#: Hosts that serve advertisements or count visits, by a part of their name.
ADVERTISING = r"(^|[.-])(ads?|adserver|banner|track(er|ing)?|counter|telemetry)([.-]|$)"


@dataclass(frozen=True)
class Level:
    words: np.ndarray  # the bits, 64 in each
    hashes: int
    salt: int

    def positions(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return positions(one, two, len(self.words) * 64, self.hashes, self.salt)

    def has(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = self.positions(one, two)
        return ((self.words[at >> U64(6)] >> (at & U64(63))) & U64(1)).all(axis=0)


def positions(one: np.ndarray, two: np.ndarray, bits: int, hashes: int, salt: int) -> np.ndarray:
    """`hashes` rows of bit positions by double hashing of two 64-bit hashes of each key."""
    one, two = mix(one.view(U64) + U64(salt * 0x9E3779B97F4A7C15 & (2**64 - 1))), two.view(U64) | U64(1)
    return np.stack([(one + U64(i) * two) % U64(bits) for i in range(hashes)])


class Cascade:
    def __init__(self, levels: Sequence[Level]):
        self.levels = tuple(levels)

    def has(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the keys are listed: so if the first level they fail is an even one, counted from 0 as not listed."""
        listed = np.zeros(len(one), dtype=bool)
        open_ = np.arange(len(one))
        for k, level in enumerate(self.levels):
            passed = level.has(one[open_], two[open_])
            listed[open_[~passed]] = k % 2 == 1
            open_ = open_[passed]
        listed[open_] = len(self.levels) % 2 == 1
        return listed

    @property
    def size(self) -> int:
        return sum(x.words.nbytes for x in self.levels)

    def udf(self, spark):
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("boolean")
        def listed(one: pd.Series, two: pd.Series) -> pd.Series:
            return pd.Series(shared.value.has(one.to_numpy(np.int64), two.to_numpy(np.int64)))

        return listed


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("one"), F.xxhash64(F.lit("two"), key).alias("two")]


def _level(keys: DataFrame, count: int, salt: int, rate: float) -> Level:
    """A filter over the keys' hashes. Each task sends only the words it has set; as many meet as the filter has."""
    bits = max(64, -(-math.ceil(-count * math.log(rate) / math.log(2) ** 2) // 64) * 64)
    hashes = max(1, round(bits / max(count, 1) * math.log(2))) if count else 1
    hashes = min(hashes, 16)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = positions(np.asarray(b.column(0)).astype(np.int64), np.asarray(b.column(1)).astype(np.int64), bits, hashes, salt).ravel()
            word, where = np.unique(at >> U64(6), return_inverse=True)
            value = np.zeros(len(word), dtype=U64)
            np.bitwise_or.at(value, where, U64(1) << (at & U64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "bits"])

    rows = keys.select("one", "two").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(bits // 64, dtype=U64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(U64)
    return Level(out, hashes, salt)


def cascade(universe: DataFrame, key: str, listed: str, rate: float = 0.02, max_bytes: int = 256 << 20) -> Cascade | None:
    """The cascade for the rows of `universe` (distinct keys) whose boolean column `listed` holds.

    None if its first filter, which is the largest as later levels shrink by `rate` each, would exceed `max_bytes`.
    """
    keys = landed(universe.select(*key_hashes(F.col(key)), F.col(listed).alias("listed")), "cascade-keys")
    now, other = keys.filter("listed"), keys.filter("not listed")
    levels: list[Level] = []
    count = now.count()
    if -count * math.log(rate) / math.log(2) ** 2 / 8 > max_bytes:
        return None
    while count:
        level = _level(now, count, len(levels), rate)
        levels.append(level)
        passed = Cascade([level]).udf(universe.sparkSession)("one", "two")
        now, other = landed(other.filter(passed), "cascade-level"), now
        count = now.count()
    return Cascade(levels)


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without `://` or for null."""
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, listed: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of `pages`: id, host, path, rule, verdict.

    The longest rule that fits decides; a url without one is blocked if its host is among `listed` (column host), which
    a filter cascade tells that was built over all hosts of `pages`. By default the list are the hosts of `pages` named
    like ADVERTISING. Null urls and urls without `://` have an empty host, which no rule fits and nobody lists. Equal
    rows each get a row; further columns are ignored; an empty table or list gives no filter and blocks nothing by it.
    A list beyond the cascade's size bound is joined by shuffle instead.
    """
    host, path = parsed(F.col(url_col))
    rows = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    universe = rows.select("host").distinct()
    if listed is None:
        universe = universe.withColumn("listed", F.col("host").rlike(ADVERTISING))
    else:
        names = listed.select(ascii_lower(F.col("host")).alias("host")).distinct().withColumn("listed", F.lit(True))
        universe = universe.join(names, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    universe = landed(universe, "hosts")
    filters = cascade(universe, "host", "listed")

    def fits(r: Rule) -> Column:
        return ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)

    order = sorted(rules, key=lambda r: (-len(r.name), r.name))
    rule = F.coalesce(*[F.when(fits(r), F.lit(r.name)) for r in order], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(F.col("rule") == r.name, F.lit(r.verdict)) for r in order], F.lit(None).cast("string"))
    rows = rows.withColumn("rule", rule)
    if filters is None:
        rows = rows.join(universe.filter("listed"), "host", "left")
        blocked = F.coalesce("listed", F.lit(False))
    elif filters.levels:
        blocked = filters.udf(pages.sparkSession)(*key_hashes(F.col("host")))
    else:
        blocked = F.lit(False)
    return rows.select(id_col, "host", "path", "rule", F.coalesce(verdict, F.when(blocked, "block").otherwise("allow")).alias("verdict"))
