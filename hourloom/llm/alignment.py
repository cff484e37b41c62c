"""Alignment of two tokenizers' tokens over the same bytes.

The tokenizers library gives its tokens as spans of characters, sentencepiece as spans of its proto. Where a span ends and
the next one begins, both are exact cuts. Tokens inside one character, and byte-fallback tokens, whose spans are empty or
overlap, are placed by their decoded bytes between those cuts. Byte offsets at which tokens of both end part groups; an A and a
B token are linked where their bytes overlap, and as neither has gaps, there is one link for each stretch between two ends.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import bounded_batches, landed, ragged

BLANK = "▁"  # stands for a space in sentencepiece's pieces
LEAD = " a"
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
#: Texts are cut before white space that starts with a blank or line end, and between a letter and one of MARKS. The first
#: form is that of most words.
UNIT = re.compile(
    rf"[ \n][{LETTERS}]++(?=[{MARKS} \n])|(?:[ \n]\s*|[{MARKS}])(?:[^\s{LETTERS}]+|[{LETTERS}]++(?![{MARKS}])|[^\S \n]\s*)*(?:[{LETTERS}]++(?=[{MARKS}]))?"
)


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable ones stand for themselves, the others are
    numbered from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The decoded bytes of each id, as one array."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.length)])
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        digits = [str(i) for i in range(len(tokens))]
        self.named = {c: np.array([d + c for d in digits], dtype=object) for c in (",", "|", ";", "")}

    def __len__(self) -> int:
        return len(self.length)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.at[ids], self.length[ids])]


def placed(start: np.ndarray, end: np.ndarray, length: np.ndarray) -> np.ndarray | None:
    """The byte at which each token ends: its span's end where that is a clean cut, else counted in decoded bytes from the
    last such cut. None if decoded bytes don't fill the spans."""
    before = np.concatenate([[0], end[:-1]])
    clean = end > before
    clean[:-1] &= end[:-1] <= start[1:]
    clean[-1:] = True
    decoded = np.cumsum(length)
    cut = np.flatnonzero(clean)
    run = np.searchsorted(cut, np.arange(len(end)))  # the cut that each token's run leads to
    from_byte = np.concatenate([[0], end[cut]])
    from_decoded = np.concatenate([[0], decoded[cut]])
    out = np.where(clean, end, from_byte[run] + decoded - from_decoded[run])
    if (np.diff(from_byte) != np.diff(from_decoded)).any():
        return None
    return out


class Aligned:
    """Tokens of one stretch of bytes: ids and ends of A and B, and the ends at which both end."""

    def __init__(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray):
        self.a, self.a_end, self.b, self.b_end = a, a_end, b, b_end
        self.ends = np.concatenate([a_end, b_end])
        self.ends.sort(kind="stable")  # two rising runs: merged
        twice = self.ends[1:] == self.ends[:-1]
        self.cuts = self.ends[1:][twice]
        self.ends = self.ends[np.concatenate([[True], ~twice])]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B, and the last byte, of all pairs of tokens that overlap."""
        return self.a[np.searchsorted(self.a_end, self.ends)], self.b[np.searchsorted(self.b_end, self.ends)], self.ends

    def strings(self, a: Vocabulary, b: Vocabulary, bounds: np.ndarray) -> list[str]:
        """The groups of each stretch that ends at one of `bounds`, as ids: a1,a2|b1;a3|b2,b3."""
        group_a, group_b = np.searchsorted(self.cuts, self.a_end), np.searchsorted(self.cuts, self.b_end)
        parts = np.empty(len(self.a) + len(self.b), dtype=object)
        slot_a = np.arange(len(self.a)) + np.searchsorted(group_b, group_a)  # after the B tokens of earlier groups
        slot_b = np.arange(len(self.b)) + np.searchsorted(group_a, group_b, side="right")
        last_a, last_b = np.isin(self.a_end, self.cuts), np.isin(self.b_end, self.cuts)
        final = np.isin(self.b_end, bounds)
        parts[slot_a] = np.where(last_a, a.named["|"][self.a], a.named[","][self.a])
        parts[slot_b] = np.where(final, b.named[""][self.b], np.where(last_b, b.named[";"][self.b], b.named[","][self.b]))
        stop = np.concatenate([[0], slot_b[final] + 1]).tolist()
        flat = parts.tolist()
        return ["".join(flat[i:j]) for i, j in zip(stop, stop[1:], strict=False)]


class _Known(dict):
    """Numbers of units, given in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class Coder:
    """Both tokenizers, and what they make of the units met so far.

    Neither tokenizer joins bytes across the start of a unit where this holds, which is read off the vocabularies: A splits
    white space from what stands before it and marks from letters, and no piece of B has a blank after something else, a
    line end, or a mark after a letter in it. Then texts are cut into units and each different unit is encoded once; else
    every text is a unit."""

    def __init__(self, byte_level: str, pieces: str, most: int = 250_000, most_chars: int = 1 << 23):
        import sentencepiece
        from tokenizers import Tokenizer

        self.one = Tokenizer.from_file(byte_level)
        self.one.encode_special_tokens = True
        to_byte = byte_of_char()
        names = [self.one.id_to_token(i) or "" for i in range(self.one.get_vocab_size())]
        self.a = Vocabulary([bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode() for t in names])
        self.two = sentencepiece.SentencePieceProcessor(model_file=pieces)
        parts = [self.two.id_to_piece(i) for i in range(self.two.get_piece_size())]
        self.b = Vocabulary([bytes([int(p[3:5], 16)]) if self.two.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(parts)])
        self.in_bytes = max(end for _, _, end in self._proto("é")) == 2
        form = json.loads(self.one.to_str())
        split = form.get("pre_tokenizer") or {}
        self.separable = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not form.get("normalizer")
        self.separable = self.separable and not any(re.search(f"[^{BLANK}]{BLANK}|[ \\n]|[{LETTERS}][{MARKS}]", p) for p in parts)
        self.most, self.most_chars = most, most_chars
        self.clear()

    def clear(self) -> None:
        self.known = _Known()
        self.chars = 0
        self.count = np.zeros((5, 0), dtype=np.int64)
        self.link, self.link_at = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.text: list[str] = []

    def _proto(self, text: str) -> list[tuple[int, int, int]]:
        try:
            out = self.two.encode(text, return_type="proto")
        except TypeError:  # earlier releases call it so
            out = self.two.encode(text, out_type="immutable_proto")
        return [(p.id, p.begin, p.end) for p in out.pieces]

    def align(self, text: str) -> Aligned | None:
        """Tokens over the bytes of `text`, which starts with a blank. None if either's bytes differ from it."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # the byte of each character
        code = self.one.encode(text, add_special_tokens=False)
        a = np.array(code.ids, dtype=np.int64)
        span = heads[np.fromiter(chain.from_iterable(code.offsets), dtype=np.int64, count=2 * len(a)).reshape(-1, 2)]
        b = np.fromiter(chain.from_iterable(self._proto(text[1:])), dtype=np.int64).reshape(-1, 3)
        b, own = b[:, 0], b[:, 1:] + 1  # the blank that B adds
        if not self.in_bytes:
            own = heads[own]
        if not len(a) or not len(b):
            return None
        for ids, words in ((a, self.a), (b, self.b)):
            if int(words.length[ids].sum()) != len(data) or (words.decode(ids) != data).any():
                return None
        a_end, b_end = placed(span[:, 0], span[:, 1], self.a.length[a]), placed(own[:, 0], own[:, 1], self.b.length[b])
        if a_end is None:
            a_end = np.cumsum(self.a.length[a])  # the bytes are right as a whole, so they place every token
        if b_end is None:
            b_end = np.cumsum(self.b.length[b])
        return Aligned(a, a_end, b, b_end)

    def _add(self, units: list[str]) -> None:
        """Encodes new units, many at once; `units` are the next in number."""
        counts, links, texts = [], [], []

        def run(some: list[str]) -> None:
            parts, own = [], []  # a mark stands after a letter, the first unit after a word
            for u in some:
                if self.separable and (not parts or u[0] in MARKS):
                    parts.append(LEAD)
                    own.append(False)
                parts.append(u)
                own.append(True)
            size = np.cumsum([len(u.encode()) for u in parts])
            both = self.align("".join(parts))
            if both is not None and len(parts) > 1 and not np.isin(size, both.cuts).all():
                both = None  # they do interact: one by one
            if both is None and len(some) > 1:
                for u in some:
                    run([u])
                return
            if both is None:
                counts.append(np.array([[0], [0], [0], [0], [0]]))
                texts.append("")
                return
            ids_a, ids_b, ends = both.links()
            edge = [np.append(0, np.searchsorted(x, size, side="right")) for x in (both.a_end, both.b_end, both.cuts, ends)]
            count = np.stack([np.diff(e) for e in edge] + [np.ones(len(parts), dtype=np.int64)])
            own_ = np.array(own)
            counts.append(count[:, own_])
            links.append((ids_a * len(self.b) + ids_b)[np.repeat(own_, count[3])])
            texts.extend(t for t, o in zip(both.strings(self.a, self.b, size), own, strict=True) if o)

        # white space at the end of a text would join what follows it here; a unit with a BLANK of its own isn't given back
        alone = [i for i, u in enumerate(units) if not self.separable or u[-1].isspace() or BLANK in u]
        start = 0
        for i in [*alone, len(units)]:
            while start < i:
                stop, chars = start, 0
                while stop < i and chars < 1 << 16:
                    chars += len(units[stop])
                    stop += 1
                run(units[start:stop])
                start = stop
            if i < len(units):
                run([units[i]])
            start = i + 1
        self.count = np.concatenate([self.count, *counts], axis=1)
        self.link = np.concatenate([self.link, *links]) if links else self.link
        self.link_at = np.concatenate([[0], np.cumsum(self.count[3])])
        self.text += texts
        self.chars += sum(map(len, units))

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of non-empty texts, and how many each text has."""
        if len(self.known) > self.most or self.chars > self.most_chars:
            self.clear()
        numbers, size = [], []
        for t in texts:
            found = UNIT.findall(" " + t) if self.separable else [" " + t]
            numbers += map(self.known.__getitem__, found)
            size.append(len(found))
        if self.known.new:
            new, self.known.new = self.known.new, []
            self._add(new)
        return np.array(numbers, dtype=np.int64), np.array(size, dtype=np.int64)

    def digest(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray], np.ndarray]:
        """For non-empty texts: their numbers of A and B tokens, groups and links, the groups' hash, different links as
        numbers, how often each stands there. Where a tokenizer doesn't give the text back, all is zero and empty."""
        numbers, size = self.units(texts)
        head = np.cumsum(size) - size
        total = np.add.reduceat(self.count[:4, numbers], head, axis=1)
        fine = np.minimum.reduceat(self.count[4, numbers], head) > 0
        total[:, ~fine] = 0
        get, flat = self.text.__getitem__, numbers.tolist()
        named = [
            hashlib.sha256(";".join(map(get, flat[h : h + n])).encode()).hexdigest() if ok else ""
            for h, n, ok in zip(head.tolist(), size.tolist(), fine.tolist(), strict=True)
        ]
        doc = np.repeat(np.arange(len(texts)), size)
        keep = fine[doc]
        numbers, doc = numbers[keep], doc[keep]
        link = self.link[ragged(self.link_at[numbers], self.count[3, numbers])]
        key = (np.repeat(doc, self.count[3, numbers]) << np.int64(42)) | link
        key, times = np.unique(key, return_counts=True)
        at = np.searchsorted(key >> np.int64(42), np.arange(len(texts) + 1))
        return total, named, [key & np.int64((1 << 42) - 1), at], times


@lru_cache(2)
def coder(byte_level: str, pieces: str) -> Coder:
    return Coder(byte_level, pieces)


def runs(texts: list[str], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters; a longer text makes one of its own."""
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and chars < most:
            chars += len(texts[j])
            j += 1
        yield i, j
        i = j


def spans(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, and of the tokens over space + text their ids and the bytes at which they end,
    `a_ids a_ends b_ids b_ends`, and `group_ends`, the bytes at which tokens of both end.

    Where text is null, empty, or not given back by one of the tokenizers, the arrays are empty. Texts are taken whole,
    one at a time. Equal rows each get a row, null ids stay null, other columns are ignored, an empty table gives an
    empty one. Nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["a_ids", "a_ends", "b_ids", "b_ends", "group_ends"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coder(byte_level, pieces)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in runs(texts):
                found = [both.align(" " + t) if t else None for t in texts[i:j]]
                columns = []
                for name in ("a", "a_end", "b", "b_end", "cuts"):
                    rows = [getattr(x, name) if x else np.zeros(0, dtype=np.int64) for x in found]
                    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(rows).astype(np.int64))))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *columns], names=["id", *names])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    out = rows.mapInArrow(aligned, f"id {kind}, " + ", ".join(f"{n} array<long>" for n in names))
    return out.withColumnRenamed("id", id_col)


def links(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, n_a, n_b, n_groups, n_links, groups_sha256, `links` (A id * size of B + B id, each
    once) and `times` (how often each stands in the text). What is said of rows in spans() holds here too."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coder(byte_level, pieces)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in runs(texts):
                some = np.array([k for k in range(i, j) if texts[k]], dtype=np.int64)
                total = np.zeros((4, j - i), dtype=np.int64)
                named = [""] * (j - i)
                off, link, times = np.zeros(j - i + 1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                if len(some):
                    got, hashes, (link, at), times = both.digest([texts[k] for k in some.tolist()])
                    total[:, some - i] = got
                    for k, h in zip(some.tolist(), hashes, strict=True):
                        named[k - i] = h
                    size = np.zeros(j - i, dtype=np.int64)
                    size[some - i] = np.diff(at)
                    off[1:] = np.cumsum(size)
                off = pa.array(off.astype(np.int32))
                lists = [pa.ListArray.from_arrays(off, pa.array(x.astype(t))) for x, t in ((link, np.int64), (times, np.int32))]
                columns = [b.column(0).slice(i, j - i), *map(pa.array, total), pa.array(named, type=pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *names, "groups_sha256", "links", "times"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {kind}, " + ", ".join(f"{n} long" for n in names) + ", groups_sha256 string, links array<long>, times array<int>"
    return rows.mapInArrow(linked, schema).withColumnRenamed("id", id_col)


def pair_counts(found: DataFrame, b_size: int) -> DataFrame:
    """Of the rows of links(): each link (`link`), how often it stands in all texts (`n`), and whether no other A token
    stands more often with its B token (`best`)."""
    each = found.select(F.explode(F.arrays_zip("links", "times")).alias("x")).select(F.col("x.links").alias("link"), F.col("x.times").alias("times"))
    counts = landed(each.groupBy("link").agg(F.sum("times").alias("n")), "link-counts")
    top = counts.groupBy((F.col("link") % b_size).alias("b")).agg(F.max("n").alias("top"))
    return counts.withColumn("b", F.col("link") % b_size).join(top, "b").select("link", "n", (F.col("n") == F.col("top")).alias("best"))


def align(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 2_000_000
) -> DataFrame:
    """One row for each row of `docs`: id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their B
    token in all texts), count_sum (of its links' counts in all texts), groups_sha256.

    Texts are encoded once; what is kept of them are their different links. Counts are combined before the shuffle. The
    table of counts is broadcast up to `broadcast_rows` rows, of some 20 bytes each, and joined by shuffle beyond. Both
    paths are `byte_level` and `pieces`, files every executor can read. For rows see spans().
    """
    size = len(coder(byte_level, pieces).b)
    found = landed(links(docs, byte_level, pieces, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "links")
    counts = landed(pair_counts(found, size), "link-table")
    if counts.count() <= broadcast_rows:
        counts = F.broadcast(counts)
    each = found.select("row", F.explode(F.arrays_zip("links", "times")).alias("x")).select("row", F.col("x.links").alias("link"), F.col("x.times").alias("times"))
    sums = each.join(counts, "link").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    return found.drop("links", "times").join(sums, "row", "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
