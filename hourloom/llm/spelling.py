"""Grouping of spelling variants: words of the corpus that differ by one edit.

The vocabulary is kept as sorted lists, one of the words and one of the words read backwards: of two words with one edit
between them, each shares its first or its last half with the other. A list is cut into blocks of bounded size. A word is
looked for in the blocks in which its half occurs, unless the prefix that a whole block shares is more than one edit away.

Inside a block, the edit matrix of a word against the list is computed for all its words at once. Of each row only the three
cells next to the diagonal can stay at one edit. Words with a common prefix have its rows in common, so rows are kept by
ranges of the list whose neighbours have at least that many leading characters in common, and a range is left as soon
as its row is beyond one edit.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, landed, ragged

LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
FAR = 2  # stands for every distance above one
ENCODING = "latin-1"  # all letters are below 256: one byte each, in code-point order


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2, typo_every: int = 31) -> DataFrame:
    """`word` and `n`: the different words of at least `shortest` letters that stand at least `least` times in all texts.

    Words are maximal runs of letters with A-Z lower-cased. One in `typo_every` occurrences, chosen by a checksum of id and
    word, loses a letter, so that the corpus has variants whose origin is known; 0 for none. Null texts have no words, a
    null id counts as an empty text. Counts are combined before the shuffle.
    """
    # a run that is too short stays so when it loses a letter
    runs = F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(f"{LETTERS}{{{shortest},}}+"), F.lit(0))
    found = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.withColumn("run", ascii_lower(F.col("run")))
    word = F.col("run")
    if typo_every:
        h = F.crc32(F.concat("id", F.lit(":"), "run"))
        at = (h % F.length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        word = F.when(h % typo_every == 0, cut).otherwise(word)
    counted = found.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= shortest) & (F.col("n") >= least))


# --- one block -------------------------------------------------------------------------------------------------------


class SortedList:
    """Words in rising order, as one array of bytes, with how much each has in common with the one before it."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.length)])
        self.data = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        self.common = np.zeros(len(words), dtype=np.int64)
        open_ = np.arange(1, len(words))
        depth = 0
        while len(open_):
            same = (self.length[open_] > depth) & (self.length[open_ - 1] > depth)
            open_ = open_[same]
            open_ = open_[self.data[self.at[open_] + depth] == self.data[self.at[open_ - 1] + depth]]
            self.common[open_] += 1
            depth += 1
        order = np.lexsort((np.arange(len(words)), self.common))
        edge = np.searchsorted(self.common[order], np.arange(int(self.common.max(initial=0)) + 2))
        self.parting = [order[i:j] for i, j in zip(edge, edge[1:], strict=False)]  # where words part after so many letters

    def starts(self, low: np.ndarray, high: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ranges with `depth` + 1 letters in common within ranges that have `depth`: which range each is of, its bounds."""
        part = self.parting[depth] if depth < len(self.parting) else np.zeros(0, dtype=np.int64)
        i, j = np.searchsorted(part, low, side="right"), np.searchsorted(part, high)
        inner = j - i
        of = np.repeat(np.arange(len(low)), inner + 1)
        first = np.cumsum(inner + 1) - (inner + 1)
        begin = np.empty(len(of), dtype=np.int64)
        begin[first] = low
        rest = np.ones(len(of), dtype=bool)
        rest[first] = False
        begin[rest] = part[ragged(i, inner)]
        end = np.empty(len(of), dtype=np.int64)
        end[:-1] = begin[1:]
        end[first + inner] = high
        return of, begin, end


def above(prefix: bytes) -> bytes | None:
    """The least string above all that start with `prefix`; None if there is none."""
    kept = prefix.rstrip(b"\xff")
    return kept[:-1] + bytes([kept[-1] + 1]) if kept else None


def near(words: SortedList, queries: list[bytes], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a query and a word (their places) that have the query's first `halves` letters in common and are exactly
    one edit apart."""
    half_of = [q[:h] for q, h in zip(queries, halves, strict=True)]
    low = np.array([bisect_left(words.words, h) for h in half_of], dtype=np.int64)
    high = np.array([bisect_left(words.words, a) if (a := above(h)) is not None else len(words.words) for h in half_of], dtype=np.int64)
    own = np.array([len(q) for q in queries], dtype=np.int64)
    own_at = np.concatenate([[0], np.cumsum(own)])
    letters = np.frombuffer(b"".join(queries) + b"\0", dtype=np.uint8)
    half = np.array(halves, dtype=np.int64)
    out_q, out_w = [], []
    query = np.zeros(0, dtype=np.int64)
    lo, hi = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows = np.zeros((3, 0), dtype=np.int8)  # distances of the prefix to as many letters of the query less one, as many, one more
    begin = np.flatnonzero(high > low)
    depth = int(half[begin].min()) if len(begin) else 0
    begin = begin[np.argsort(half[begin], kind="stable")]
    entered = 0
    while entered < len(begin) or len(query):
        upto = int(np.searchsorted(half[begin], depth, side="right"))
        if upto > entered:
            new = begin[entered:upto]
            entered = upto
            query = np.concatenate([query, new])
            lo, hi = np.concatenate([lo, low[new]]), np.concatenate([hi, high[new]])
            first = np.array([[1], [0], [1]], dtype=np.int8).repeat(len(new), axis=1)
            first[2, own[new] <= depth] = FAR
            rows = np.concatenate([rows, first], axis=1)
        if not len(query):
            depth += 1
            continue
        # the word that ends here stands first in its range
        ends = words.length[lo] == depth
        if ends.any():
            gap = own[query] - depth
            hit = np.flatnonzero(ends & (np.abs(gap) <= 1))
            hit = hit[rows[gap[hit] + 1, hit] == 1]
            out_q.append(query[hit])
            out_w.append(lo[hit])
            lo = lo + ends
            keep = lo < hi
            query, lo, hi, rows = query[keep], lo[keep], hi[keep], rows[:, keep]
        of, lo, hi = words.starts(lo, hi, depth)
        query, rows = query[of], rows[:, of]
        letter = words.data[words.at[lo] + depth]
        size = own[query]
        base = own_at[query]

        def differs(place: np.ndarray) -> np.ndarray:
            """1 where the query's letter there isn't the new one, FAR where it has none."""
            there = (place >= 0) & (place < size)
            return np.where(there, letters[base + np.where(there, place, 0)] != letter, FAR).astype(np.int8)

        down = np.minimum(rows[0] + differs(np.full(len(query), depth - 1)), rows[1] + 1)
        level = np.minimum(np.minimum(rows[1] + differs(np.full(len(query), depth)), rows[2] + 1), down + 1)
        up = np.minimum(rows[2] + differs(np.full(len(query), depth + 1)), level + 1)
        depth += 1
        down[size < depth - 1] = FAR
        level[size < depth] = FAR
        up[size < depth + 1] = FAR
        rows = np.minimum(np.stack([down, level, up]), FAR)
        keep = rows.min(axis=0) < FAR
        query, lo, hi, rows = query[keep], lo[keep], hi[keep], rows[:, keep]
    if not out_q:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_q), np.concatenate(out_w)


def shared(a: bytes, b: bytes) -> int:
    """How many letters two words have in common at their start."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def beyond(word: bytes, prefix: bytes) -> bool:
    """Whether no word that starts with `prefix` is within one edit of `word`."""
    same = shared(word, prefix)
    if same == len(prefix):
        return False
    rest = prefix[same + 1 :]
    return not (word[same + 1 :].startswith(rest) or word[same:].startswith(rest) or word[same + 1 :].startswith(prefix[same:]))


# --- jobs ------------------------------------------------------------------------------------------------------------


def _edges(words: DataFrame, block: int) -> list[list[bytes]]:
    """For both lists the words at which blocks start; one for about `block` words."""
    parts = max(1, math.ceil(words.count() / block))
    out = []
    for key in (F.col("word"), F.reverse("word")):
        first = words.select(key.alias("key")).repartitionByRange(parts, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
        out.append(sorted(r["key"].encode(ENCODING) for r in first.collect()))
    return out


def neighbours(words: DataFrame, block: int = 8192) -> DataFrame:
    """For words (`word`, `n`) with others one edit away: `word`, how many (`n_near`), and of these the one that is most
    frequent (`best`, `best_n`), the smallest of several."""
    spark = words.sparkSession
    edges = spark.sparkContext.broadcast(_edges(words, block))  # a word for each block

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["side", "block", "query", "word", "n"]
        for b in batches:
            sides, blocks, kinds, keys, counts = [], [], [], [], []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for side, raw in enumerate((word.encode(ENCODING), word[::-1].encode(ENCODING))):
                    first = edges.value[side]
                    half = raw[: (len(raw) - 1) // 2]
                    home = max(0, bisect_right(first, raw) - 1)
                    low = max(0, bisect_right(first, half) - 1)
                    end = above(half)
                    high = max(low, (bisect_left(first, end) if end is not None else len(first)) - 1)
                    spots = [home]
                    for k in range(low, high + 1):
                        if k == home or not (k + 1 < len(first) and beyond(raw, first[k][: shared(first[k], first[k + 1])])):
                            spots.append(k)
                    sides += [side] * len(spots)
                    blocks += spots
                    kinds += [0] + [1] * (len(spots) - 1)
                    keys += [raw] * len(spots)
                    counts += [n] * len(spots)
            columns = [pa.array(sides, type=pa.int32()), pa.array(blocks, type=pa.int32()), pa.array(kinds, type=pa.int32()), pa.array(keys, type=pa.binary()), pa.array(counts, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "side int, block int, query int, word binary, n long"
    rows = landed(words.select("word", "n").mapInArrow(dealt, schema), "spelling-dealt")
    # a block that many words look into is given to several tasks, each with a part of these
    asked = rows.filter("query = 1").groupBy("side", "block").agg(F.ceil(F.count(F.lit(1)) / (4 * block)).cast("int").alias("tasks"))
    rows = rows.join(asked, ["side", "block"], "left").withColumn("tasks", F.coalesce("tasks", F.lit(1)))
    part = F.when(F.col("query") == 0, F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("tasks")).cast("int")))
    rows = rows.withColumn("part", F.explode(part)).select("side", "block", "part", "query", "word", "n")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks one after another: first the words of the list, then those that are looked for, as they come."""
        key, held, counts, ready = None, [], [], None
        for b in batches:
            place = np.stack([np.asarray(b.column(i)).astype(np.int64) for i in range(4)])
            cut = np.concatenate([[0], np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1, [b.num_rows]])
            for i, j in zip(cut.tolist(), cut[1:].tolist(), strict=False):
                if j == i:
                    continue
                if (now := tuple(place[:3, i].tolist())) != key:
                    key, held, counts, ready = now, [], [], None
                some, n = b.column(4).slice(i, j - i).to_pylist(), b.column(5).slice(i, j - i).to_pylist()
                if not place[3, i]:
                    held += some
                    counts += n
                    continue
                if ready is None:
                    ready = SortedList(held), np.array(counts, dtype=np.int64)
                yield from best_of(key[0], *ready, some)

    def best_of(side: int, words: SortedList, counts: np.ndarray, queries: list[bytes], step: int = 4096) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(queries), step):
            some = queries[k : k + step]
            q, w = near(words, some, [(len(x) - 1) // 2 for x in some])
            found: dict[int, list] = {}
            for i, j in zip(q.tolist(), w.tolist(), strict=True):
                one, two = some[i], words.words[j]
                if side:  # pairs whose first halves agree are found in the other list
                    one, two = one[::-1], two[::-1]
                    if shared(one, two) >= (len(one) - 1) // 2:
                        continue
                best = found.setdefault(i, [one, 0, None])
                best[1] += 1
                rank = (-int(counts[j]), two)
                if best[2] is None or rank < best[2]:
                    best[2] = rank
            if found:
                rows = list(found.values())
                columns = [[r[0].decode(ENCODING) for r in rows], [r[1] for r in rows], [-r[2][0] for r in rows], [r[2][1].decode(ENCODING) for r in rows]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "n_near", "best_n", "best"])

    order = ["side", "block", "part", "query", "word"]
    met = rows.repartition("side", "block", "part").sortWithinPartitions(*order).mapInArrow(searched, "word string, n_near long, best_n long, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("back"), F.col("best").alias("best"))).alias("least")
    met = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), least)
    return met.select("word", "n_near", F.col("least.best").alias("best"), (-F.col("least.back")).alias("best_n"))


def group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 10, shortest: int = 7, least: int = 2, typo_every: int = 31, block: int = 8192
) -> DataFrame:
    """One row for each word of vocabulary(): word, n, n_near (words one edit away), form (the most frequent of these, if it
    stands at least `ratio` times as often; else null), form_n, root (where forms lead to in the end).

    A form is `ratio` times as frequent as its word, so chains are as short as the logarithm of the largest count; they are
    followed by doubling steps. An empty table gives an empty one; equal rows count each; other columns are ignored.
    """
    words = landed(vocabulary(docs, id_col, text_col, shortest, least, typo_every), "spelling-words")
    met = neighbours(words, block)
    good = F.col("best_n") >= F.col("n") * ratio
    rows = words.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")
    )
    rows = landed(rows, "spelling-forms")
    roots = landed(rows.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = landed(roots.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = after.select("word", "root")
        if after.filter("moved").isEmpty():
            break
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
