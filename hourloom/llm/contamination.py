"""Benchmark decontamination by canonical templates.

Numbers, units after numbers and names are replaced by typed placeholders, so a question with other parameters keeps its
template. Windows of templates are joined by hash; where they line up, the values in the placeholders must map
consistently: what the item has twice, the document must have twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import bounded_batches, FOLD, landed, mix, powers, ragged, span_hashes, Texts, texts, whole_row

U64 = np.uint64
FILTER_BITS = 1 << 24
BASE = 0x9E3779B97F4A7C15
NUMBER, UNIT, NAME, RAW = (mix(np.array([k], dtype=U64))[0] for k in (101, 102, 103, 104))
TEMPLATE, OPENED, WHOLE, VERBATIM = range(4)  # ways in which a window agrees

# Units that stand after a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonnes lb lbs pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent % degree degrees celsius fahrenheit kmh mph dollar dollars euro euros cent cents usd eur watt watts kw volt volts joule joules hz"
).split()

PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(33, 37), *range(38, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True  # all but letters, digits and %
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
NUMERIC = DIGIT.copy()
NUMERIC[[44, 46]] = True
FULL_STOP = np.zeros(256, dtype=bool)
FULL_STOP[[33, 46, 58, 63]] = True


def _hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    end = np.cumsum([len(w.encode()) for w in words])
    return np.sort(span_hashes(data, np.concatenate([[0], end[:-1]]), end))


UNIT_HASHES = _hashes_of(UNITS)


def templates(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the canonical texts, their values (0 where the token is a word, else a hash of what stood there), and how
    many tokens lie before each text (one entry more). Words are lower-cased and lose punctuation around them."""
    token, value, at, _, _ = tokens_of(part)
    return token, value, at


def tokens_of(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What templates() gives, the hash of every token's own word, and in which line of the run it stands."""
    data = part.data
    begin, stop, at = part.words()
    n = len(begin)
    if not n:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=U64), at, np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    start, end = begin.copy(), stop.copy()
    for edge, step, look in ((start, 1, 0), (end, -1, -1)):
        open_ = np.flatnonzero(start < end)
        while len(open_):
            open_ = open_[PUNCTUATION[data[edge[open_] + look]]]
            edge[open_] += step
            open_ = open_[start[open_] < end[open_]]
    solid = start < end
    head = np.zeros(n, dtype=bool)  # first word of a sentence, a line or a text
    head[at[:-1][at[:-1] < n]] = True
    head[1:] |= FULL_STOP[data[stop[:-1] - 1]]
    head |= data[np.maximum(begin - 1, 0)] == 10
    line = np.cumsum(data == 10)[begin][solid]
    start, end, head = start[solid], end[solid], head[solid]
    at = np.concatenate([[0], np.cumsum(solid)])[at]
    word = span_hashes(FOLD[data], start, end)
    run = np.concatenate([[0], np.cumsum(NUMERIC[data])])
    number = DIGIT[data[start]] & (run[end] - run[start] == end - start)
    after = np.zeros(len(word), dtype=bool)
    after[1:] = number[:-1]
    after[at[:-1][at[:-1] < len(word)]] = False
    unit = after & np.isin(word, UNIT_HASHES)
    first, second = data[start], data[np.minimum(start + 1, len(data) - 1)]
    upper = (first >= 65) & (first <= 90)
    accented = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    lower = (second >= 97) & (second <= 122) | (second >= 0x80)
    name = ~head & (end - start > 1) & (upper & lower | accented)
    token = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, word)))
    return token, np.where(number | unit | name, word, U64(0)), at, word, line


def hashes(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every `size` neighbours of h a sum that depends on them alone, in which the first stands as it is; and its hash."""
    n = len(h) - size + 1
    if n <= 0:
        return h[:0], h[:0]
    total = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(h * powers(BASE, len(h))[: len(h)])])
    plain = (total[size:] - total[:n]) * powers(pow(BASE, -1, 1 << 64), n)[:n]
    return plain, mix(plain + U64(size))


class Windows:
    """The windows of a run of texts: as templates, as templates whose first word counts as a word though it looks like a
    name, and of the words as they stand."""

    def __init__(self, part: Texts):
        self.part = part
        self.token, self.value, self.at, self.word, self.line = tokens_of(part)

    def places(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Text and first token of every window."""
        count = np.maximum(np.diff(self.at) - size + 1, 0)
        return np.repeat(np.arange(len(self.part)), count), ragged(self.at[:-1], count)

    def template(self, size: int, first: np.ndarray) -> np.ndarray:
        return hashes(self.token, size)[1][first]

    def opened(self, size: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows that begin with a name, and their hashes with the name's word in its place."""
        name = first[self.token[first] == NAME]
        plain = hashes(self.token, size)[0][name] if len(name) else self.token[:0]
        return name, mix(plain - NAME + self.word[name] + U64(size))

    def verbatim(self, size: int, first: np.ndarray) -> np.ndarray:
        return hashes(self.word, size)[1][first] ^ RAW

    def lines(self, size: int, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a window is all the words of a line."""
        last = first + size - 1
        opens = (first == self.at[text]) | (self.line[first - 1] != self.line[first])
        ends = last + 1 == self.at[text + 1]
        ends |= self.line[np.minimum(last + 1, len(self.line) - 1)] != self.line[last]
        return opens & ends & (self.line[first] == self.line[last])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """An id and a number of the text, which tell rows apart that differ in either; neither is ever null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(F.col(id_col).isNull(), text)


def _slots(value: np.ndarray, first: np.ndarray, size: int, skip: int = 0) -> pa.Array:
    """The values in each window, those of its first `skip` tokens left out."""
    v = value[first[:, None] + np.arange(size)]
    used = v != 0
    used[:, :skip] = False
    off = np.concatenate([[0], np.cumsum(used.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(v[used].view(np.int64)))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, size: int, words: int, shortest: int, run: int) -> DataFrame:
    """item, tokens (of the item), size, kind, hash, off and slots of the windows of every item:

    TEMPLATE: those of `size` tokens, or of a shorter item all, with at least `words` words in them.
    WHOLE: an item without such windows as one, if it has a word at all.
    VERBATIM: the words of every `run` tokens, or of a shorter item all. Items of fewer than `shortest` tokens have only these.
    """
    kind = benchmark.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item", "tokens", "size", "kind", "hash", "off", "slots"]
        for b in batches:
            for part in texts(b.column(1)):
                w = Windows(part)
                tokens = np.diff(w.at)
                poor = tokens >= min(shortest, size)

                def rows(of: int, k: int, text: np.ndarray, first: np.ndarray, h: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
                    columns = [pa.array(tokens[text]), pa.array(np.full(len(text), k)), pa.array(np.full(len(text), of)), pa.array(h.view(np.int64))]
                    columns += [pa.array(first - w.at[text]), _slots(value, first, k)]
                    return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text + part.first)), *columns], names=names)

                for k in np.unique(np.minimum(tokens, size)[poor]).tolist():
                    text, first = w.places(k)
                    pick = np.minimum(tokens[text], size) == k
                    text, first = text[pick], first[pick]
                    pick = (w.value[first[:, None] + np.arange(k)] == 0).sum(axis=1) >= min(words, k)
                    text, first = text[pick], first[pick]
                    poor[text] = False
                    yield rows(TEMPLATE, k, text, first, w.template(k, first), w.value)
                named = np.concatenate([[0], np.cumsum(w.value != 0)])[w.at]
                poor &= np.diff(named) < tokens
                for k in np.unique(tokens[poor]).tolist():
                    text = np.flatnonzero(poor & (tokens == k))
                    yield rows(WHOLE, k, text, w.at[text], w.template(k, w.at[text]), w.value)
                for k in np.unique(np.minimum(tokens, run)[tokens > 0]).tolist():
                    text, first = w.places(k)
                    pick = np.minimum(tokens[text], run) == k
                    text, first = text[pick], first[pick]
                    yield rows(VERBATIM, k, text, first, w.verbatim(k, first), np.zeros_like(w.value))

    rows = benchmark.select(benchmark[id_col].alias("item"), benchmark[text_col].alias("text"))
    return rows.mapInArrow(cut, f"item {kind}, tokens long, size long, kind long, hash long, off long, slots array<long>").distinct()


def _bits(index: DataFrame) -> np.ndarray:
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.asarray(b.column(0)).view(U64) % U64(FILTER_BITS)
            spot, where = np.unique(at >> U64(6), return_inverse=True)
            value = np.zeros(len(spot), dtype=U64)
            np.bitwise_or.at(value, where, U64(1) << (at & U64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(spot.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "bits"])

    rows = index.select("hash").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, dtype=U64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(U64)
    return out


def _matches(docs: DataFrame, index: DataFrame, id_col: str, text_col: str, shortest: int, broadcast_rows: int) -> DataFrame:
    """Windows of the documents joined with those of the benchmark: key, num, id, item, tokens, size, off, shift, way, pairs."""
    sizes: dict[int, set[int]] = {}
    for r in index.select("size", "kind").distinct().collect():  # one row for each length of items at most
        sizes.setdefault(r["size"], set()).add(r["kind"])
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_bits(index))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed(h: np.ndarray) -> np.ndarray:
            at = h % U64(FILTER_BITS)
            return np.flatnonzero((shared.value[at >> U64(6)] >> (at & U64(63))) & U64(1))

        for b in batches:
            for part in texts(b.column(3)):
                w = Windows(part)

                def rows(way: int, k: int, first: np.ndarray, h: np.ndarray, own: pa.Array) -> pa.RecordBatch:
                    text = np.searchsorted(w.at, first, side="right") - 1
                    columns = [b.column(i).take(pa.array(text + part.first)) for i in range(3)]
                    columns += [pa.array(np.full(len(first), x)) for x in (k, way)]
                    columns += [pa.array(h.view(np.int64)), pa.array(first - w.at[text]), own]
                    return pa.RecordBatch.from_arrays(columns, names=["key", "num", "id", "size", "way", "hash", "pos", "own"])

                for k, kinds in sorted(sizes.items()):
                    text, first = w.places(k)
                    if not len(first):
                        continue
                    if kinds & {TEMPLATE, WHOLE}:
                        h = w.template(k, first)
                        hit = passed(h)
                        yield rows(TEMPLATE, k, first[hit], h[hit], _slots(w.value, first[hit], k))
                        named, h = w.opened(k, first)
                        hit = passed(h)
                        yield rows(OPENED, k, named[hit], h[hit], _slots(w.value, named[hit], k, 1))
                    if VERBATIM in kinds:
                        if k < shortest:
                            first = first[w.lines(k, text, first)]
                        h = w.verbatim(k, first)
                        hit = passed(h)
                        text = np.searchsorted(w.at, first[hit], side="right") - 1
                        # what a text repeats is no more evidence than once
                        hit = hit[np.sort(np.unique(np.stack([text.astype(U64), h[hit]], axis=1), axis=0, return_index=True)[1])] if len(hit) else hit
                        yield rows(VERBATIM, k, first[hit], h[hit], _slots(np.zeros_like(w.value), first[hit], k))

    key, num = _keyed(docs, id_col, text_col)
    rows = docs.select(key.alias("key"), num.alias("num"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(found, f"key string, num long, id {kind}, size long, way long, hash long, pos long, own array<long>")
    rows = rows.withColumn("raw", F.col("way") == VERBATIM)
    small = index.count() <= broadcast_rows
    index = index.withColumn("raw", F.col("kind") == VERBATIM)
    both = rows.join(F.broadcast(index) if small else index, ["hash", "size", "raw"])
    way = F.when((F.col("kind") == WHOLE) & (F.col("way") == TEMPLATE), WHOLE).otherwise(F.col("way"))
    shift = F.when(F.col("raw"), 0).otherwise(F.col("pos") - F.col("off"))
    both = both.filter((F.col("way") != OPENED) | (F.col("off") == 0))
    return both.select("key", "num", "id", "item", "tokens", "size", "off", shift.alias("shift"), way.alias("way"), F.arrays_zip("slots", "own").alias("pairs"))


def _covered(offs: str) -> Column:
    """How many tokens the windows (off and size, sorted) cover."""
    start = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        offs,
        start,
        lambda a, o: F.struct(
            F.greatest(a["reach"], o["off"] + o["size"]).alias("reach"),
            (a["total"] + F.greatest(F.lit(0), o["off"] + o["size"] - F.greatest(a["reach"], o["off"]))).alias("total"),
        ),
        lambda a: a["total"],
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    size: int = 8, words: int = 4, shortest: int = 4, share: float = 0.5, run: int = 13, passages: bool = False,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """key, num, id, item, coverage of every document and benchmark item of which one of these holds:

    Their templates agree in at least `share` of the item's tokens, all in places where the values are consistent. Every
    run of `run` words of the item, or of a shorter one all, stands in the document as it is; with `passages` a single
    such run is enough, whatever share of the item it is and whether or not values around it agree. The item has no window
    with `words` words, and its whole template is in the document with consistent values. An item of fewer than
    `shortest` tokens must be a line of the document, word for word.

    The first word of an item is a word also where a document has it in the middle of a line. `coverage` is that of the
    templates where it reaches `share`, else that of all evidence.

    Null and empty texts have no tokens. Rows of equal id and text count once. An item that is in the benchmark twice is
    met twice, under either id. Empty tables give an empty result; other columns are ignored. Only windows that pass a
    filter of fixed size are joined, so the shuffle holds little more than true matches.
    """
    bounded_batches(docs.sparkSession)
    index = landed(benchmark_windows(benchmark, item_col, item_text, size, words, shortest, run), "benchmark-windows")
    rows = _matches(docs, index, id_col, text_col, shortest, broadcast_rows)
    spot, strict, loose = F.struct("off", "size"), F.col("way") == TEMPLATE, F.col("way") != VERBATIM

    def united(sets: Column) -> Column:
        return F.array_distinct(F.flatten(sets))

    place = rows.groupBy("key", "num", "item", "shift").agg(
        F.first("id").alias("id"), F.first("tokens").alias("tokens"),
        united(F.collect_set(F.when(strict, F.col("pairs")))).alias("strict"), united(F.collect_set(F.when(loose, F.col("pairs")))).alias("loose"),
        F.collect_set(F.when(strict, spot)).alias("strict_offs"), F.collect_set(F.when(loose, spot)).alias("loose_offs"),
        F.collect_set(F.when(~loose, spot)).alias("raw_offs"),
    )

    def consistent(pairs: str, offs: str) -> Column:
        return F.when(F.size(pairs) == F.size(F.array_distinct(F.col(f"{pairs}.slots"))), F.col(offs))

    item = place.groupBy("key", "num", "item").agg(
        F.first("id").alias("id"), F.first("tokens").alias("tokens"),
        *[F.array_sort(united(F.collect_set(x))).alias(n) for n, x in (
            ("strict", consistent("strict", "strict_offs")), ("loose", consistent("loose", "loose_offs")), ("raw", F.col("raw_offs")))],
    )
    item = item.withColumn("every", F.array_sort(F.array_union("loose", "raw")))
    strict, loose, every = (_covered(c) / F.col("tokens") for c in ("strict", "loose", "every"))
    item = item.select("*", strict.alias("by_template"), loose.alias("opened"), every.alias("all"))
    item = item.filter((F.col("by_template") >= share) | (F.col("opened") >= share) | (_covered("raw") >= (F.lit(1) if passages else F.col("tokens"))))
    return item.select("key", "num", "id", "item", F.when(F.col("by_template") >= share, F.col("by_template")).otherwise(F.col("all")).alias("coverage"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", **options) -> DataFrame:
    """One row for each contaminated document and the item in it: id, item id, coverage."""
    found = contaminated(docs, benchmark, id_col, item_col=item_col, **options)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "coverage")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` without a benchmark item in them; their columns stay as they are."""
    found = landed(contaminated(docs, benchmark, id_col, text_col, **options).select("key", "num").distinct(), "contaminated")
    key, num = _keyed(docs, id_col, text_col)
    rows = docs.select(whole_row(docs).alias("doc"), key.alias("key"), num.alias("num"))
    return rows.join(found, ["key", "num"], "left_anti").select("doc.*")
