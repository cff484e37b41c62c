"""Removal of repeated byte strings with enhanced suffix arrays.

Every string of `least` bytes is filed under one of the k-grams in it, the one with the smallest hash, so that equal
strings, wherever they stand, are filed under the same gram. Neighbouring strings under one occurrence of a gram form a
segment. Segments that are equal as a whole are settled by their hashes. Where segments of one gram differ, their
suffixes are sorted; a stack scan over the common prefixes of neighbours yields the tree of common-prefix intervals, and
those whose occurrences are preceded by different bytes are the maximal repeats, with all their occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import Texts, bounded_batches, landed, mix, powers, ragged, span_hashes, texts

U64 = np.uint64
GRAM = 24
BASE = 0x9E3779B97F4A7C15
RUN = 255  # instead of a count: a run of bytes known to repeat within the same piece of input
FIRST_ID = -(2**63)
FILTER_BITS = 1 << 24
LONG = 8 << 20  # longer texts are filed in parts


# --- segments --------------------------------------------------------------------------------------------------------


def segments(part: Texts, least: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Document, first start, number of starts, gram hash and content hash of each segment."""
    data, off = part.data, part.off
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < least:
        return none, none, none, none.astype(U64), none.astype(U64)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(mix(data.astype(U64) + U64(1)) * powers(BASE, n)[:n], out=total[1:])
    inverse = powers(pow(BASE, -1, 1 << 64), n + 1)
    h = mix((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])
    low = (h >> U64(24) << U64(24)) | np.arange(len(h), dtype=U64)  # smallest hash, leftmost first
    span, width = 1, least - gram + 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    at = (low & U64((1 << 24) - 1)).astype(np.int64)
    size = np.diff(off)
    valid = np.zeros(len(at), dtype=bool)
    valid[ragged(off[:-1], np.maximum(size - least + 1, 0))] = True
    first = valid.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    heads = off[:-1][size >= least]
    first[heads] = True
    start = np.flatnonzero(first)
    if not len(start):
        return none, none, none, none.astype(U64), none.astype(U64)
    starts = np.flatnonzero(valid)
    place = np.searchsorted(starts, start)
    count = np.diff(np.append(place, len(starts)))
    end = start + count - 1 + least
    content = mix(mix((total[end] - total[start]) * inverse[start]) + (count.astype(U64) << U64(32)) + (at[start] - start).astype(U64))
    doc = np.searchsorted(off, start, side="right") - 1
    return doc, start - off[doc], count, h[at[start]], content


def long_parts(part: Texts, least: int) -> Iterator[tuple[int, Texts]]:
    """The run itself, or a text above LONG in parts that overlap by least - 1 bytes, with where each begins."""
    if len(part.data) <= LONG:
        yield 0, part
        return
    for i in range(0, len(part.data) - least + 1, LONG):
        cut = part.data[i : i + LONG + least - 1]
        yield i, Texts(part.first, cut, np.array([0, len(cut)]))


def word(uid: np.ndarray, start: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    return (uid << 44) | (start << 8) | count


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs without overlap; runs that touch become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > reach[:-1]
    head = np.flatnonzero(new)
    return start[head], reach[np.append(head[1:], len(start)) - 1]


def _filed(docs: DataFrame, least: int) -> DataFrame:
    """h, seg, id, word of every segment; of equal ones in a run of texts the first, the others as merged runs."""

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, uids = np.asarray(b.column(0)).astype(np.int64), np.asarray(b.column(1)).astype(np.int64)
            for run in texts(b.column(2)):
                for skip, part in long_parts(run, least):
                    doc, start, count, h, seg = segments(part, least)
                    if not len(doc):
                        continue
                    start = start + skip
                    doc = doc + part.first
                    id_, w = ids[doc], word(uids[doc], start, count)
                    order = np.lexsort((w, id_, seg, h))
                    doc, start, count, h, seg, id_, w = (x[order] for x in (doc, start, count, h, seg, id_, w))
                    new = np.ones(len(h), dtype=bool)
                    new[1:] = (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])
                    lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
                    again = ~new & ((id_ != id_[lead]) | (w != w[lead]))
                    out = [[h[new].view(np.int64)], [seg[new].view(np.int64)], [id_[new]], [w[new]]]
                    if again.any():
                        # runs of one document, told apart by a gap between documents on one axis
                        d, a = doc[again], start[again]
                        e = a + count[again] - 1 + least
                        step = int(e.max()) + 2
                        a, e = merged(d * step + a, d * step + e)
                        d = a // step
                        a, e = a - d * step, e - d * step
                        name = word(uids[d], a, RUN)
                        for x, y in zip(out, (mix((name ^ ids[d]).view(U64)).view(np.int64), e, ids[d], name), strict=True):
                            x.append(y)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["h", "seg", "id", "word"])

    return docs.mapInArrow(filed, "h long, seg long, id long, word long")


def _settled(filed: DataFrame, least: int) -> DataFrame:
    """What hashes settle: kind 0 for bytes start to stop that repeat; kind 1 for segments (stop is their count) whose
    gram has other segments too. Rows come sorted, so a gram of any frequency takes no memory."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_h = last_seg = lead_id = lead_word = None
        waiting: tuple[int, int] | None = None  # the first segment of last_h, until there is a second
        for b in batches:
            h, seg, id_, w = (np.asarray(b.column(i)) for i in range(4))
            run = (w & 255) == RUN
            out = [(np.zeros(int(run.sum()), dtype=np.int64), id_[run], w[run] >> 44, (w[run] >> 8) & ((1 << 36) - 1), seg[run], h[run])]
            h, seg, id_, w = h[~run], seg[~run], id_[~run], w[~run]
            n = len(h)
            if n:
                new_h, new_seg = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
                new_h[1:] = h[1:] != h[:-1]
                new_h[0] = h[0] != last_h if last_h is not None else True
                new_seg[1:] = new_h[1:] | (seg[1:] != seg[:-1])
                new_seg[0] = new_h[0] or seg[0] != last_seg
                lead = np.maximum.accumulate(np.where(new_seg, np.arange(n), -1))
                first_id = np.where(lead >= 0, id_[lead], lead_id if lead_id is not None else 0)
                first_word = np.where(lead >= 0, w[lead], lead_word if lead_word is not None else 0)
                again = ~new_seg & ((id_ != first_id) | (w != first_word))
                at = np.flatnonzero(new_seg)
                asked = ~new_h[at]
                asked[:-1] |= ~new_h[at[1:]]
                rows = at[asked]
                if len(at) and not new_h[at[0]] and waiting is not None:
                    out.append(tuple(np.array([x], dtype=np.int64) for x in (1, waiting[0], waiting[1] >> 44, (waiting[1] >> 8) & ((1 << 36) - 1), waiting[1] & 255, h[at[0]])))
                if len(at):
                    k = at[-1]
                    waiting = (int(id_[k]), int(w[k])) if new_h[k] else None
                start = (w >> 8) & ((1 << 36) - 1)
                count = w & 255
                out.append((np.zeros(int(again.sum()), dtype=np.int64), id_[again], w[again] >> 44, start[again], start[again] + count[again] - 1 + least, h[again]))
                out.append((np.ones(len(rows), dtype=np.int64), id_[rows], w[rows] >> 44, start[rows], count[rows], h[rows]))
                last_h, last_seg = h[-1], seg[-1]
                if lead[-1] >= 0:
                    lead_id, lead_word = id_[lead[-1]], w[lead[-1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["kind", "id", "uid", "start", "stop", "h"])

    order = ["h", "seg", "id", "word"]
    return filed.repartition("h").sortWithinPartitions(*order).mapInArrow(settle, "kind long, id long, uid long, start long, stop long, h long")


# --- suffixes --------------------------------------------------------------------------------------------------------


def intervals(lcp: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the maximal repeats of at least `least` bytes in a sorted suffix array.

    lcp[i] is the common prefix of suffixes i - 1 and i, left[i] the byte before suffix i, negative if there is none.
    Intervals leave the stack from the inside out; one is maximal to the left unless all its suffixes follow the same byte."""
    stack: list[list[int]] = []  # length, first suffix, byte before all of them or -1 for different ones
    n = len(lcp)
    for i in range(1, n + 1):
        now = lcp[i] if i < n else 0
        begin, byte = i - 1, left[i - 1]
        while stack and stack[-1][0] > now:
            length, begin, own = stack.pop()
            byte = own if own == byte and byte >= 0 else -1
            if byte < 0 and length >= least:
                yield length, begin, i - 1
        if stack and stack[-1][0] == now:
            if stack[-1][2] != byte or byte < 0:
                stack[-1][2] = -1
        elif now >= least:
            stack.append([now, begin, byte])


def repeats(strings: list[bytes], counts: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, string and offset of all occurrences of every maximal repeat that starts at one of the first counts[i]
    bytes of string i."""
    who = np.repeat(np.arange(len(strings)), counts)
    offset = ragged(np.zeros(len(strings), dtype=np.int64), counts)
    size = np.array([len(s) for s in strings])
    width = int(size.max())
    padded = np.zeros((len(strings), width * 2), dtype=np.uint8)
    for i, s in enumerate(strings):
        padded[i, : len(s)] = np.frombuffer(s, dtype=np.uint8)
    suffix = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)[who, offset]
    order = np.argsort(np.ascontiguousarray(suffix).view(f"S{width}").ravel(), kind="stable")
    suffix, who, offset = suffix[order], who[order], offset[order]
    rest = size[who] - offset
    same = suffix[1:] == suffix[:-1]
    lcp = np.where(same.all(axis=1), width, same.argmin(axis=1))
    lcp = np.concatenate([[0], np.minimum(lcp, np.minimum(rest[1:], rest[:-1]))])
    long = lcp >= least
    if not long.any():
        return
    left = np.where(offset > 0, padded[who, np.maximum(offset - 1, 0)].astype(np.int64), -1)
    near = long.copy()
    near[:-1] |= long[1:]
    pick = np.flatnonzero(near)  # suffixes with no long neighbour are in no interval
    for length, a, b in intervals(lcp[pick].tolist(), left[pick].tolist(), least):
        yield length, who[pick[a : b + 1]], offset[pick[a : b + 1]]


def _group_removed(ids: np.ndarray, words: np.ndarray, strings: list[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """(member, start, end) of what repeats an earlier occurrence, in the group of one gram."""
    start, count = (words >> 8) & ((1 << 36) - 1), words & 255
    uid = words >> 44
    found: dict[int, list[tuple[int, int]]] = {}
    for length, who, offset in repeats(strings, count, least):
        at = start[who] + offset
        lead = np.lexsort((at, uid[who], ids[who]))[0]
        for m, p, i, u in zip(who.tolist(), at.tolist(), ids[who].tolist(), uid[who].tolist(), strict=True):
            if (i, u, p) != (ids[who[lead]], uid[who[lead]], at[lead]):
                found.setdefault(m, []).append((p, p + length))
    for m, runs in found.items():
        a, e = merged(*(np.array(x) for x in zip(*runs, strict=True)))
        for x, y in zip(a.tolist(), e.tolist(), strict=True):
            yield m, x, y


def _compared(contents: DataFrame, least: int) -> DataFrame:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, words, strings = None, [], [], []
        out: list[tuple[int, int, int, int]] = []

        def close() -> None:
            if len(ids) > 1:
                w = np.array(words)
                for m, a, e in _group_removed(np.array(ids), w, strings, least):
                    out.append((ids[m], int(w[m]) >> 44, a, e))

        def sent() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            made = pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["id", "uid", "start", "stop"])
            out.clear()
            return made

        for b in batches:
            for h, i, w, s in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if h != key:
                    close()
                    key, ids, words, strings = h, [], [], []
                ids.append(i)
                words.append(w)
                strings.append(s)
            yield sent()
        close()
        yield sent()

    return contents.repartition("h").sortWithinPartitions("h", "id", "word").mapInArrow(compare, "id long, uid long, start long, stop long")


# --- jobs ------------------------------------------------------------------------------------------------------------


def bits_of(keys: DataFrame) -> np.ndarray:
    """A filter of FILTER_BITS bits that the keys (one long column) pass, whatever their number."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = mix(np.asarray(b.column(0)).view(U64)) % U64(FILTER_BITS)
            spot, where = np.unique(at >> U64(6), return_inverse=True)
            value = np.zeros(len(spot), dtype=U64)
            np.bitwise_or.at(value, where, U64(1) << (at & U64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(spot.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "bits"])

    rows = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, dtype=U64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(U64)
    return out


def passes(keys: DataFrame) -> Column:
    """A condition on the column id that holds for all of `keys` and for few others."""
    shared = keys.sparkSession.sparkContext.broadcast(bits_of(keys))

    @F.pandas_udf("boolean")
    def hit(id_: pd.Series) -> pd.Series:
        at = mix(id_.to_numpy(np.int64).view(U64)) % U64(FILTER_BITS)
        return pd.Series(((shared.value[at >> U64(6)] >> (at & U64(63))) & U64(1)).astype(bool))

    return hit(F.col("id"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID))
    return docs.select(F.col(id_col).alias("own"), id_.alias("id"), F.xxhash64(text).bitwiseAND(F.lit((1 << 19) - 1)).alias("uid"), text.alias("text"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 100, group: int = 2000) -> DataFrame:
    """id (null as the smallest long), uid (19 bits of the text's hash), start, stop: bytes that repeat earlier ones.

    Spans may overlap. Grams with more than `group` different segments are settled by hashes of their single strings,
    aggregated before the shuffle, instead of in one task."""
    bounded_batches(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col).drop("own")
    known = landed(_settled(_filed(rows, least), least), "segments")
    asked = known.filter("kind = 1").select("id", "uid", "start", F.col("stop").alias("count"), "h")
    crowded = landed(asked.groupBy("h").count().filter(F.col("count") > group).select("h", F.lit(True).alias("crowded")), "crowded")
    any_crowded = not crowded.isEmpty()
    asked = asked.join(crowded, "h", "left") if any_crowded else asked.withColumn("crowded", F.lit(None).cast("boolean"))
    wanted = asked.groupBy("id", "uid").agg(F.collect_list(F.struct("start", "count", "h", "crowded")).alias("wanted"))
    both = rows.filter(passes(asked.select("id").distinct())).join(wanted, ["id", "uid"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, uids = b.column("id").to_pylist(), b.column("uid").to_pylist()
            wants = b.column("wanted")
            off, flat = wants.offsets.to_numpy(), wants.flatten()
            off = off - off[0]
            start, count, h = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            tight = np.asarray(flat.field(3).fill_null(False))
            for i, text in enumerate(b.column("text").to_pylist()):
                data = text.encode()
                part = slice(off[i], off[i + 1])
                lone = np.flatnonzero(~tight[part]) + off[i]
                if len(lone):
                    w = word(np.full(len(lone), uids[i]), start[lone], count[lone])
                    pieces = [data[a : a + c - 1 + least] for a, c in zip(start[lone].tolist(), count[lone].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(h[lone]), pa.array([ids[i]] * len(lone), type=pa.int64()), pa.array(w), pa.array(pieces, type=pa.binary())], names=["h", "id", "word", "bytes"])
                many = np.flatnonzero(tight[part]) + off[i]
                if len(many):
                    at = np.unique(ragged(start[many], count[many]))
                    one = span_hashes(np.frombuffer(data, dtype=np.uint8), at, at + least)
                    two = [hashlib.blake2b(data[a : a + least], digest_size=8).digest() for a in at.tolist()]
                    w = word(np.full(len(at), uids[i]), at, RUN)
                    yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array([ids[i]] * len(at), type=pa.int64()), pa.array(w), pa.array(two, type=pa.binary())], names=["h", "id", "word", "bytes"])

    contents = both.select("id", "uid", "text", "wanted").mapInArrow(cut, "h long, id long, word long, bytes binary")
    out = known.filter("kind = 0").select("id", "uid", "start", "stop")
    if any_crowded:
        contents = landed(contents, "contents")
        single = contents.filter(F.col("word").bitwiseAND(255) == RUN)
        lead = single.groupBy("h", "bytes").agg(F.min(F.struct("id", "word")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        again = single.join(lead, ["h", "bytes"]).filter((F.col("id") != F.col("lead.id")) | (F.col("word") != F.col("lead.word")))
        start = F.shiftright("word", 8).bitwiseAND((1 << 36) - 1)
        out = out.union(again.select("id", F.shiftright("word", 44), start, start + least))
        contents = contents.filter(F.col("word").bitwiseAND(255) != RUN)
    return out.union(_compared(contents, least))


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 100, group: int = 2000, with_bytes: bool = False) -> DataFrame:
    """One row for each row of `docs`: id, n_bytes, n_removed, n_spans, kept_sha256, and `kept` if `with_bytes`.

    A byte is removed if a string of `least` bytes that covers it also starts earlier: in a document with a smaller id, or
    further to the front of the same one. Strings are judged on the input; texts are UTF-8 bytes, so what is kept may
    part a character. A null text is empty. A null id is smaller than all others; of different texts with the same id
    one counts as the earlier (by a hash), equal texts with the same id are one document and get equal rows. An empty
    table gives an empty one; other columns are ignored.
    """
    found = landed(spans(docs, id_col, text_col, least, group), "spans")
    rows = _keyed(docs, id_col, text_col)
    touched = passes(found.select("id").distinct())
    runs = found.groupBy("id", "uid").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))

    @F.pandas_udf("removed long, spans long, digest string, kept binary")
    def kept(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, e in zip(text, starts, stops, strict=True):
            data = t.encode()
            a, e = merged(np.asarray(a if a is not None else [], dtype=np.int64), np.asarray(e if e is not None else [], dtype=np.int64))
            edges = [0, *np.stack([a, e], axis=1).ravel().tolist(), len(data)]
            left = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
            out.append((len(data) - len(left), len(a), hashlib.sha256(left).hexdigest(), left if with_bytes else None))
        return pd.DataFrame(out, columns=["removed", "spans", "digest", "kept"])

    text = F.col("text")
    more = ["kept"] if with_bytes else []
    clean = rows.filter(~touched).select(
        "own", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"), *([text.cast("binary").alias("kept")] if with_bytes else []),
    )
    rest = rows.filter(touched).join(runs, ["id", "uid"], "left").withColumn("k", kept("text", "starts", "stops"))
    rest = rest.select(
        "own", F.octet_length(text).cast("long"), F.col("k.removed"), F.col("k.spans"), F.col("k.digest"), *[F.col("k.kept") for _ in more]
    )
    return clean.union(rest).withColumnRenamed("own", id_col)
