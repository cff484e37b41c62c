"""Packing of documents into training windows in their order, cut by dynamic programming.

The cost of a cut plan is its padding plus a penalty for every cut inside a document: small at the end of a sentence,
large elsewhere. cost[j] = penalty[j] + width - at[j] + min(cost[i] + at[i]) over the cuts i at most `width` before j, and a
monotone queue of the candidates i gives each minimum in constant time.
"""

from __future__ import annotations

import base64
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hourloom.llm.common import bounded_batches, mix, powers, ragged

U64 = np.uint64
END = 0  # the token after each document
PLAIN = 0x300  # texts with code points below this are split by array work


# --- tokens ----------------------------------------------------------------------------------------------------------

LETTER, DIGIT, OTHER, BLANK, WHITE = range(5)


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point below PLAIN, as the tokenizer's pattern sees it."""
    kind = {"L": LETTER, "N": DIGIT}
    out = np.array([kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(PLAIN)], dtype=np.uint8)
    out[[9, 10, 11, 12, 13, 0x85, 0xA0]] = WHITE
    out[32] = BLANK
    return out


#: Code points that end a sentence.
ENDING = np.zeros(PLAIN, dtype=bool)
ENDING[[10, 33, 46, 63]] = True


def piece_starts(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks where pieces start that the byte-level pattern never merges across: a run of letters, digits or others with
    the blank before it, white space, and English clitics. `first` marks the first code point of each document."""
    c = classes()[x]
    n = len(x)
    white = c >= BLANK
    after = np.empty(n, dtype=bool)  # the next code point is of the same document
    after[:-1], after[-1:] = ~first[1:], False
    run = np.empty(n, dtype=bool)
    run[:1], run[1:] = True, (c[1:] != c[:-1]) | first[1:]
    run &= ~white
    blank_before = np.zeros(n, dtype=bool)
    blank_before[1:] = (c[:-1] == BLANK) & ~first[1:]
    start = run & ~blank_before
    begins = white.copy()  # of white space
    begins[1:] &= first[1:] | ~white[:-1]
    start |= begins
    last = white & after
    last[:-1] &= ~white[1:]
    start |= last  # the last white space before text stands alone or joins what follows
    quote = np.flatnonzero((x == 39) & run & ~blank_before & after)
    for letters in ("s", "t", "m", "d", "re", "ve", "ll"):
        q = quote
        for k, ch in enumerate(letters, 1):
            q = q[(q + k < n)]
            q = q[(x[q + k] == ord(ch)) & ~first[q + k]]
        if len(q):
            start[q + 1] = False
            after_it = q + len(letters) + 1
            after_it = after_it[after_it < n]
            start[after_it] |= ~white[after_it] & (c[after_it] == LETTER)
    return start


class Pieces:
    """Token ids of pieces by a hash of their code points, encoded when first met.

    `ranks` is the same vocabulary in the form that encodes a single piece fastest; without it the tokenizer does."""

    def __init__(self, path: str, ranks: str | None = None, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.ranks = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=known, special_tokens={})
        self.most = most
        self.value = mix(np.arange(1, PLAIN + 1, dtype=U64))
        self.clear()

    def clear(self) -> None:
        slots = 1 << (2 * self.most).bit_length()
        self.key = np.zeros(slots, dtype=U64)  # open addressing; 0 is free
        self.slot = np.zeros(slots, dtype=np.int32)
        self.count = 0
        self.length = np.zeros(1024, dtype=np.int32)
        self.at = np.zeros(1024, dtype=np.int64)
        self.flat = np.zeros(4096, dtype=np.uint32)
        self.used = 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 for new ones."""
        mask = U64(len(self.key) - 1)
        at = h & mask
        got = self.key[at]
        out = np.where(got == h, self.slot[at], -1)
        left = np.flatnonzero((got != h) & (got != 0))
        while len(left):
            at[left] = (at[left] + U64(1)) & mask
            got = self.key[at[left]]
            same = got == h[left]
            out[left[same]] = self.slot[at[left[same]]]
            left = left[~same & (got != 0)]
        return out

    def add(self, hashes: np.ndarray, pieces: list[str]) -> None:
        encoded = [self.ranks.encode_ordinary(p) for p in pieces] if self.ranks else self.encode(pieces)
        size = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), dtype=np.uint32, count=int(size.sum()))
        first, last = self.count, self.count + len(pieces)
        while last > len(self.at):
            self.at, self.length = np.resize(self.at, 2 * len(self.at)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(flat)] = flat
        self.at[first:last], self.length[first:last] = self.used + np.cumsum(size) - size, size
        self.used += len(flat)
        self.count = last
        mask = len(self.key) - 1
        key, slot = self.key, self.slot
        for k, h in enumerate(hashes.tolist(), first):
            i = h & mask
            while key[i]:
                i = (i + 1) & mask
            key[i], slot[i] = h, k

    def tokens(self, x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts, given as their code points and sizes, one after another, each followed by END; where each text
        starts (one entry more); where sentences end."""
        head = np.concatenate([[0], np.cumsum(size)])
        n = len(size)
        if not len(x):
            return np.full(n, END, dtype=np.uint32), np.arange(n + 1), np.arange(1, n + 1)
        first = np.zeros(len(x), dtype=bool)
        first[head[:-1][size > 0]] = True
        start = np.flatnonzero(piece_starts(x, first))
        end = np.append(start[1:], len(x))
        inverse = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        total = np.zeros(len(x) + 1, dtype=U64)
        np.cumsum(self.value[x] * powers(0x9E3779B97F4A7C15, len(x))[: len(x)], out=total[1:])
        total = total[np.append(start, len(x))]
        h = mix(np.diff(total) * powers(inverse, len(x) + 1)[start]) | U64(1)
        index = self.find(h)
        new = np.flatnonzero(index < 0)
        if len(new):
            hashes, sample = np.unique(h[new], return_index=True)
            if self.count + len(hashes) > self.most:
                hashes, sample = np.unique(h, return_index=True)
                self.most = max(self.most, 2 * len(hashes))  # one text alone may have more
                self.clear()
                index = np.full(len(h), -1)
                new = np.arange(len(h))
            sample = new[sample]
            raw = x.astype("<u4").tobytes()
            self.add(hashes, [raw[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(start[sample].tolist(), end[sample].tolist(), strict=True)])
            index[new] = self.find(h[new])
        count = self.length[index].astype(np.int64)
        stop = np.cumsum(count)
        ids = self.flat[np.arange(int(stop[-1])) + np.repeat(self.at[index] - (stop - count), count)]
        before = np.searchsorted(start, head)  # pieces before each text
        token_head = np.concatenate([[0], stop])[before]
        out = np.insert(ids, token_head[1:], END)
        closing = np.flatnonzero(ENDING[x[end - 1]])
        return out, token_head + np.arange(n + 1), stop[closing] + np.searchsorted(before, closing, side="right") - 1

    def documents(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As tokens(), for any texts: those with code points from PLAIN on are encoded whole."""
        x = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        head = np.concatenate([[0], np.cumsum(size)])
        odd = np.unique(np.searchsorted(head, np.flatnonzero(x >= PLAIN), side="right") - 1)
        parts, i = [], 0
        for k in [*odd.tolist(), len(texts)]:
            if k > i:
                parts.append(self.tokens(x[head[i] : head[k]], size[i:k]))
            if k < len(texts):
                ids = np.array(self.encode([texts[k]])[0], dtype=np.uint32)
                parts.append((np.append(ids, np.uint32(END)), np.array([0, len(ids) + 1]), np.flatnonzero(np.isin(ids, self.closing)) + 1))
            i = k + 1
        return joined(parts)

    @property
    def closing(self) -> list[int]:
        """Ids of the tokens that end sentences."""
        marks = (self.tokenizer.token_to_id(c) for c in (".", "!", "?", "Ċ"))
        return [i for i in marks if i is not None]


@lru_cache(2)
def pieces(path: str, ranks: str | None) -> Pieces:
    return Pieces(path, ranks)


def joined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Several results of tokens() as one."""
    if len(parts) == 1:
        return parts[0]
    at = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).astype(np.int64)
    heads = np.concatenate([p[1][:-1] + a for p, a in zip(parts, at, strict=False)] + [at[-1:]])
    return np.concatenate([p[0] for p in parts]), heads, np.concatenate([p[2] + a for p, a in zip(parts, at, strict=False)])


# --- cuts ------------------------------------------------------------------------------------------------------------


def best_cuts(at: np.ndarray, penalty: np.ndarray, width: int) -> np.ndarray:
    """Indices of the cuts with the least padding plus penalties; at[0] = 0 and the last entry are always cuts, the last
    window's padding is free. Neighbours in `at` are at most `width` apart."""
    at_, penalty_ = at.tolist(), penalty.tolist()
    m = len(at_) - 1
    came = [0]
    keys, cuts, head = [0], [0], 0  # cost[i] + at[i] and i of the candidates from `head` on, both rising
    for j in range(1, m + 1):
        low = at_[j] - width
        while at_[cuts[head]] < low:
            head += 1
        came.append(cuts[head])
        key = keys[head] + width + penalty_[j]  # cost[j] + at[j]
        while len(keys) > head and keys[-1] >= key:
            keys.pop()
            cuts.pop()
        keys.append(key)
        cuts.append(j)
        if j == m - 1:  # the last window has no padding to pay
            low = at_[m] - width
            came.append(min((k - at_[i], i) for k, i in zip(keys[head:], cuts[head:], strict=True) if at_[i] >= low)[1])
            break
    out = [m]
    while out[-1]:
        out.append(came[out[-1]])
    return np.array(out[::-1])


def cut_points(heads: np.ndarray, sentences: np.ndarray, width: int, step: int, sentence_cost: int, word_cost: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates for cuts and their penalties: ends of documents are free, ends of sentences cost little; where neither
    comes for more than two steps, every `step` tokens there is one more, at the higher price."""
    mark = np.zeros(heads[-1] + 1, dtype=np.int8)
    mark[sentences] = 2
    mark[heads] = 3
    at = np.flatnonzero(mark)
    gap = np.diff(at)
    wide = np.flatnonzero(gap > min(width, 2 * step))
    if len(wide):
        extra = (gap[wide] - 1) // step
        mark[np.repeat(at[wide], extra) + step * ragged(np.ones(len(wide), dtype=np.int64), extra)] = 1
        at = np.flatnonzero(mark)
    return at, np.array([0, word_cost, sentence_cost, 0])[mark[at]]


def pack_block(ids: np.ndarray, heads: np.ndarray, sentences: np.ndarray, width: int, sentence_cost: int = 1, word_cost: int = 8) -> tuple[np.ndarray, ...]:
    """Pieces of one block: document, start in it, length, checksum, tokens of the document, window, offset in it.

    What is left for the last window is cut into powers of two, which need no padding."""
    at, penalty = cut_points(heads, sentences, width, 16, sentence_cost, word_cost)
    cuts = at[best_cuts(at, penalty, width)]
    tail = int(cuts[-1] - cuts[-2])
    ends = [int(cuts[-2])]
    while tail & (tail - 1):
        part = 1 << (tail.bit_length() - 1)
        ends.append(ends[-1] + part)
        tail -= part
    cuts = np.unique(np.concatenate([cuts, np.array(ends, dtype=np.int64)]))
    edges = np.union1d(cuts, heads)
    begin, length = edges[:-1], np.diff(edges)
    doc = np.searchsorted(heads, begin, side="right") - 1
    window = np.searchsorted(cuts, begin, side="right") - 1
    raw = memoryview(np.ascontiguousarray(ids.astype("<u4")).view(np.uint8))
    crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
    return doc, begin - heads[doc], length, np.array(crc, dtype=np.int64), np.diff(heads)[doc], window, begin - cuts[window]


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, width: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    block_tokens: int = 1 << 21, with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of a document: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    token ids if `with_ids`.

    Documents keep the order in which the table is read; each task packs its split in blocks of about `block_tokens`
    tokens, so memory is bounded, nothing is shuffled, and a task run again gives the same windows. Only the last
    window of a block may be short. A null or empty text is the single token END; a document longer than a window is
    cut. Equal rows are packed each on its own; null ids stay null; other columns are ignored; an empty table gives an
    empty one. `tokenizer` is the path of a byte-level vocabulary that every executor can read,
    `ranks` that of the same vocabulary as ranks, which is faster.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"id {kind}, " + ", ".join(f"`{n}` long" for n in names) + (", ids array<int>" if with_ids else "")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(tokenizer, ranks)
        window = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        ids_of: list[pa.Array] = []
        count = 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal window, count
            ids, heads, sentences = joined(held)
            doc, start, length, crc, total, seq, offset = pack_block(ids, heads, sentences, width)
            key = pa.concat_arrays(ids_of).take(pa.array(doc))
            columns = [key, *[pa.array(c.astype(np.int64)) for c in (start, length, crc, total, seq + window, offset)]]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int32)), pa.array(ids.astype(np.int32))))
            window += int(seq[-1]) + 1
            held.clear()
            ids_of.clear()
            count = 0
            yield pa.RecordBatch.from_arrays(columns, names=["id", *names, *(["ids"] if with_ids else [])])

        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            i = 0
            while i < len(texts):
                j, chars = i, 0
                while j < len(texts) and chars < 1 << 21:
                    chars += len(texts[j])
                    j += 1
                held.append(coder.documents(texts[i:j]))
                ids_of.append(b.column(0).slice(i, j - i))
                count += len(held[-1][0])
                i = j
                if count >= block_tokens:
                    yield from block()
        if held:
            yield from block()

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(packed, schema)
    return out.withColumnRenamed("id", id_col)
