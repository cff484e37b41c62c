"""Jaccard self-join of word n-gram sets: the size-aware heavy-light join.

Small sets are joined by enumeration: two sets whose sizes ask for an overlap of c share a subset of exactly c shingles, so
each lists its subsets of the sizes c that its partners can ask for. Large sets are joined by inverted lists. The boundary
is where enumerating starts to cost more than scanning.

A list of a single shingle is no use where passages are shared by many texts. The lists of large sets are therefore kept by
groups of shingles: the shingles of a set fall by hash into more groups than partners can differ in, so partners agree on
whole groups, on several of them by construction. Texts that share but a passage agree on few, and are told apart by counting.
Sets that meet in a subset or in enough lists form families; a family is verified exactly, in blocks of bounded size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import bounded_batches, landed, mix, ragged, rolling, span_hashes, texts, whole_row
from hourloom.llm.components import components

U64 = np.uint64
HALF = U64(0xFFFFFFFF)
FILTER_BITS = 24, 29  # the logarithms of the fewest and the most bits of a filter
SUBSET = 4095  # stands in the last bits of a signature where group signatures have their level
CROWD = 12  # lists up to this length are taken pair by pair
KNOWN = 100_000  # rows of a table up to which the driver gathers it for a broadcast; its hash table takes about 100 bytes a row


# --- sets ------------------------------------------------------------------------------------------------------------


def shingle_sets(column: pa.Array, k: int, seed: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first text's place, where each text's set starts (one entry more), and the hashes of the
    distinct k-word shingles of each, rising. Fewer than k words make one shingle."""
    for part in texts(column, fold=True):
        start, end, at = part.words()
        h = span_hashes(part.data, start, end)
        words = np.diff(at)
        count = np.maximum(words - (k - 1), (words > 0).astype(np.int64))
        off = np.concatenate([[0], np.cumsum(count)])
        s = np.zeros(off[-1], dtype=U64)
        long = words >= k
        whole = rolling(h, k)
        s[ragged(off[:-1][long], count[long])] = whole[ragged(at[:-1][long], count[long])]
        for m in range(1, k):
            few = np.flatnonzero(words == m)
            if len(few):
                v = np.full(len(few), m, dtype=U64)
                for i in range(m):
                    v = mix(v * U64(0x100000001B3) + h[at[few] + i])
                s[off[few]] = v
        s = mix(s + U64(seed))
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            s[a:b].sort()
        keep = np.ones(len(s), dtype=bool)
        keep[1:] = s[1:] != s[:-1]
        keep[off[:-1][count > 0]] = True
        yield part.first, np.concatenate([[0], np.cumsum(keep)])[off], s[keep]


def totals(off: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The sum of each set's hashes."""
    run = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(s)])
    return run[off[1:]] - run[off[:-1]]


def names(off: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each set."""
    size = np.diff(off).astype(U64)
    return mix(totals(off, s) + size), mix(totals(off, mix(s ^ U64(0x5DEECE66D))) + size)


# --- signatures ------------------------------------------------------------------------------------------------------


def overlap(total: int, percent: int) -> int:
    """The least overlap of two linked sets whose sizes add up to `total`."""
    return -(-percent * total // (100 + percent))


@lru_cache(8)
def levels(percent: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes at which levels start, and for each level how many groups it has, how many of them may be empty, and how many
    groups that aren't empty linked sets agree on beyond the first.

    A set on level i has partners of its own level and the next, or, as the larger one, of the level before. Partners with
    the smaller one on level i differ in d shingles at most, so of d + 1 + slack + spare groups 1 + slack + spare are equal."""
    starts, groups, slack, spare = [1], [], [], []
    while starts[-1] <= most:
        starts.append(starts[-1] * 100 // percent + 1)
        top = starts[-1] - 1
        d = (top + top * 100 // percent) * (100 - percent) // (100 + percent)
        slack.append(2 + d // 32 if d else 0)
        spare.append((d + 1 + slack[-1]) // 4)
        groups.append(d + 1 + slack[-1] + spare[-1])
    return np.array(starts), np.array(groups), np.array(slack), np.array(spare)


def subset_sizes(n: int, percent: int) -> set[int]:
    """The overlaps that partners of a set of n shingles can ask for."""
    return {overlap(n + m, percent) for m in range(-(-percent * n // 100), n * 100 // percent + 1)}


def enumeration_cost(n: int, percent: int) -> int:
    return sum(math.comb(n, c) for c in subset_sizes(n, percent) if c <= n)


def boundary(sizes: dict[int, int], percent: int, most: int = 40) -> int:
    """The largest size of a small set: enumerating all up to it, and listing and verifying all above, costs least."""
    starts, groups, *_ = levels(percent, most + 1)
    best, cost, gain = 0, 0.0, 0.0
    for n in range(1, most + 1):
        level = int(np.searchsorted(starts, n, side="right")) - 1
        scan = int(groups[level]) + (int(groups[level - 1]) if level else 0) + n
        gain += (max(1, sizes.get(n, 0))) * (enumeration_cost(n, percent) - scan)
        if gain <= cost:
            best, cost = n, gain
    return best


def group_signatures(off: np.ndarray, s: np.ndarray, percent: int, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the groups of the picked sets, on their own level and the one before, and whose they are."""
    size = np.diff(off)
    starts, groups, slack, _ = levels(percent, int(size.max(initial=1)))
    own = np.searchsorted(starts, size, side="right") - 1
    out_sig, out_set = [], []
    for back in (0, 1):
        sets = pick[own[pick] >= back]
        if not len(sets):
            continue
        level = own[sets] - back
        m = groups[level]
        base = np.concatenate([[0], np.cumsum(m)])
        who = np.repeat(np.arange(len(sets)), size[sets])
        v = s[ragged(off[sets], size[sets])]
        cell = base[who] + (v % m[who].astype(U64)).astype(np.int64)
        n = int(base[-1])
        low = np.bincount(cell, weights=(v & HALF).astype(np.float64), minlength=n).astype(U64)
        high = np.bincount(cell, weights=(v >> U64(32)).astype(np.float64), minlength=n).astype(U64)
        full = np.bincount(cell, minlength=n) > 0
        owner = np.repeat(np.arange(len(sets)), m)
        # empty groups agree too; they count where a set has more of them than slack
        full |= (m - np.add.reduceat(full.astype(np.int64), base[:-1]) > slack[level])[owner]
        name = mix((level[owner].astype(U64) << U64(40)) + (np.arange(n) - base[:-1][owner]).astype(U64))
        sig = mix(low + mix(high + name))
        out_sig.append(((sig & ~U64(SUBSET)) | level[owner].astype(U64))[full])  # the last bits tell the level
        out_set.append(sets[owner[full]])
    if not out_sig:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_sig), np.concatenate(out_set)


def subset_signatures(off: np.ndarray, s: np.ndarray, percent: int, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all subsets of the sizes that partners can ask for."""
    out_sig, out_set = [], []
    total = totals(off, s)
    for i in pick.tolist():
        v = s[off[i] : off[i + 1]]
        for c in subset_sizes(len(v), percent):
            if c > len(v):
                continue
            gone = list(itertools.combinations(range(len(v)), len(v) - c))
            left = total[i] - (v[np.array(gone)].sum(axis=1, dtype=U64) if len(v) > c else np.zeros(1, dtype=U64))
            out_sig.append(mix(left + mix(np.full(1, c, dtype=U64))) | U64(SUBSET))
            out_set.append(np.full(len(gone), i))
    if not out_sig:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_sig), np.concatenate(out_set)


# --- verification ----------------------------------------------------------------------------------------------------


def linked(off: np.ndarray, s: np.ndarray, percent: int) -> np.ndarray:
    """For each set the first set that links lead to; links are found by counting common shingles, one set at a time."""
    m = len(off) - 1
    size = np.diff(off)
    root = np.full(m, -1)
    if m == 2:
        common = len(np.intersect1d(s[: off[1]], s[off[1] :], assume_unique=True))
        return np.array([0, 0 if 100 * common >= percent * (len(s) - common) else 1])
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    first = np.ones(len(s), dtype=bool)
    first[1:] = ranked[1:] != ranked[:-1]
    head = np.flatnonzero(first)
    number = np.empty(len(s), dtype=np.int64)
    number[order] = np.cumsum(first) - 1
    length = np.diff(np.append(head, len(s)))
    posted = owner[order]
    for a in range(m):
        if root[a] >= 0:
            continue
        root[a] = a
        open_ = [a]
        while open_ and (root < 0).any():  # once all are reached, nothing is left to find
            b = open_.pop()
            own = number[off[b] : off[b + 1]]
            own = own[length[own] > 1]
            if not len(own):
                continue
            common = np.bincount(posted[ragged(head[own], length[own])], minlength=m)
            new = np.flatnonzero((root < 0) & (100 * common >= percent * (size + size[b] - common)))
            root[new] = a
            open_ += new.tolist()
    return root


# --- jobs ------------------------------------------------------------------------------------------------------------


def _thin(docs: DataFrame, id_col: str, text_col: str, k: int, seed: int) -> DataFrame:
    """id, n, node (the set's first hash), second (another)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, off, s in shingle_sets(b.column(1), k, seed):
                one, two = names(off, s)
                columns = [b.column(0).slice(first, len(off) - 1), pa.array(np.diff(off)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "node", "second"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(sets, f"id {kind}, n long, node long, second long")


def _signatures(docs: DataFrame, text_col: str, k: int, seed: int, percent: int, small: int) -> DataFrame:
    """sig and node. What repeats a set of the same run of texts is left out."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, off, s in shingle_sets(b.column(0), k, seed):
                node, _ = names(off, s)
                size = np.diff(off)
                pick = np.unique(node, return_index=True)[1]
                pick = np.sort(pick[size[pick] > 0])
                few, many = pick[size[pick] <= small], pick[size[pick] * 100 >= percent * (small + 1)]
                for sig, who in (subset_signatures(off, s, percent, few), group_signatures(off, s, percent, many)):
                    if len(sig):
                        yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node[who].view(np.int64))], names=["sig", "node"])

    return docs.select(docs[text_col].alias("text")).mapInArrow(signed, "sig long, node long")


def list_rows(kind: int, a: np.ndarray, b: np.ndarray, level: np.ndarray) -> pa.RecordBatch:
    if kind != 1 and len(a):  # the same pair from many lists: counted here, before it is shuffled
        pairs, n = np.unique(np.stack([a, b, level], axis=1), axis=0, return_counts=True)
        a, b, level = np.ascontiguousarray(pairs.T)
    else:
        n = np.ones(len(a), dtype=np.int64)
    columns = [np.full(len(a), kind, dtype=np.int64), a, b, level.astype(np.int64), n]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "level", "n"])


def read_lists(batches: Iterator[pa.RecordBatch], step: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """What the lists of a partition say. Whenever `step` rows have gathered, those of lists longer than CROWD are told and let
    go, so what is held are short lists, however long others grow."""
    held, count, limit = [], 0, step
    heads: dict[int, int] = {}  # the first node of each list known to be crowded

    def crowded(sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        subset = (sig & SUBSET) == SUBSET
        if not subset.all():
            yield list_rows(1, sig[~subset], node[~subset], sig[~subset] & SUBSET)
        if subset.any():
            first = np.array([heads[x] for x in sig[subset].tolist()], dtype=np.int64)
            other = node[subset] != first
            yield list_rows(2, node[subset][other], first[other], np.full(int(other.sum()), SUBSET))

    def settled() -> tuple[np.ndarray, ...]:
        """Rows in order, each once; where lists start, and their lengths."""
        both = np.stack([np.concatenate(x) for x in zip(*held, strict=True)], axis=1)
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        new = np.ones(len(both), dtype=bool)
        new[1:] = (both[1:] != both[:-1]).any(axis=1)
        sig, node = np.ascontiguousarray(both[new].T)
        first = np.ones(len(sig), dtype=bool)
        first[1:] = sig[1:] != sig[:-1]
        start = np.flatnonzero(first)
        return sig, node, start, np.diff(np.append(start, len(sig)))

    for b in batches:
        held.append((np.asarray(b.column(0)), np.asarray(b.column(1))))
        count += b.num_rows
        if count < limit:
            continue
        sig, node, start, length = settled()
        known = np.isin(sig[start], np.fromiter(heads, dtype=np.int64, count=len(heads)))
        long = known | (length > CROWD)
        heads.update(zip(sig[start[long & ~known]].tolist(), node[start[long & ~known]].tolist(), strict=True))
        out = np.repeat(long, length)
        if out.any():
            yield from crowded(sig[out], node[out])
        held, count = [(sig[~out], node[~out])], int((~out).sum())
        limit = max(step, 2 * count)
    if not count:
        return
    sig, node, start, length = settled()
    known = np.isin(sig[start], np.fromiter(heads, dtype=np.int64, count=len(heads)))
    if known.any():
        out = np.repeat(known, length)
        yield from crowded(sig[out], node[out])
        start, length = start[~known], length[~known]
    tag = sig[start] & SUBSET
    pairs = []
    for size in range(2, CROWD + 1):
        at = start[(length == size) & (tag != SUBSET)]
        for i in range(size) if len(at) else ():
            for j in range(i):
                pairs.append((node[at + i], node[at + j], sig[at] & SUBSET))
                if sum(len(p[0]) for p in pairs) > 1 << 20:
                    yield list_rows(0, *map(np.concatenate, zip(*pairs, strict=True)))
                    pairs = []
    if pairs:
        yield list_rows(0, *map(np.concatenate, zip(*pairs, strict=True)))
    at = (length > CROWD) & (tag != SUBSET)
    if at.any():
        spots = ragged(start[at], length[at])
        yield list_rows(1, sig[spots], node[spots], sig[spots] & SUBSET)
    at = (length > 1) & (tag == SUBSET)
    if at.any():
        spots = ragged(start[at] + 1, length[at] - 1)
        yield list_rows(2, node[spots], np.repeat(node[start[at]], length[at] - 1), np.full(len(spots), SUBSET))


def _lists(signatures: DataFrame) -> DataFrame:
    """What lists of two nodes or more say: kind 0, a pair of nodes and how many lists of a level it shares; kind 1, a list
    (a) longer than CROWD and a node in it (b); kind 2, an edge from a shared subset."""
    return signatures.repartition("sig").mapInArrow(read_lists, "kind long, a long, b long, level long, n long")


def _meetings(signatures: DataFrame, percent: int) -> DataFrame:
    """Edges between nodes whose sets may be linked: a pair that shares as many lists as linked sets must, or the members
    of a crowded list for whom such lists are no exception.

    Linked sets share 1 + spare lists of their level at least. A set that stands in `spare` crowded lists at most meets its
    partners in other lists too, so it can leave the crowded ones; partners that meet in crowded lists alone stand, both of
    them, in more than that."""
    found = landed(_lists(signatures), "lists")
    spares = levels(percent, 1 << 62)[3].tolist()
    spare = F.element_at(F.array(*map(F.lit, spares)), (F.col("level") + 1).cast("int"))
    crowded = found.filter("kind = 1")
    times = landed(crowded.groupBy(F.col("b").alias("node"), "level").agg(F.count(F.lit(1)).alias("crowds")), "crowds")
    pairs = found.filter("kind = 0").groupBy("a", "b", "level").agg(F.sum("n").alias("n"))
    for side in ("a", "b"):
        pairs = pairs.join(times.select(F.col("node").alias(side), "level", F.col("crowds").alias(f"crowds_{side}")), [side, "level"], "left")
    least = F.least(F.coalesce("crowds_a", F.lit(0)), F.coalesce("crowds_b", F.lit(0)))
    near = pairs.filter(F.col("n") + least > spare).select("a", "b")
    full = times.filter(F.col("crowds") > spare).select(F.col("node").alias("b"), "level")
    members = landed(crowded.join(full, ["b", "level"]).select(F.col("a").alias("list"), F.col("b").alias("node")), "crowded")
    first = members.groupBy("list").agg(F.min("node").alias("b"))
    stars = members.join(first, "list").filter("node <> b").select(F.col("node").alias("a"), "b")
    return near.union(stars).union(found.filter("kind = 2").select("a", "b"))


def _filter_bits(nodes: DataFrame) -> np.ndarray:
    """A filter that all of the nodes pass: eight bits for each, from 2 to 64 MB in all."""
    bits = 1 << min(FILTER_BITS[1], max(FILTER_BITS[0], (8 * nodes.count()).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = mix(np.asarray(b.column(0)).view(U64)) % U64(bits)
            word, where = np.unique(at >> U64(6), return_inverse=True)
            value = np.zeros(len(word), dtype=U64)
            np.bitwise_or.at(value, where, U64(1) << (at & U64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "bits"])

    rows = nodes.select("node").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=U64)
    for b in rows.to_batches():  # columns as they come: rows of Python objects would be ten times as large
        out[np.asarray(b.column(0))] = np.asarray(b.column(1)).view(U64)
    return out


def _sets_of(docs: DataFrame, nodes: DataFrame, text_col: str, k: int, seed: int) -> DataFrame:
    """node and set (its hashes) of the nodes, and of few others, which a join drops; once for each task."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter_bits(nodes))  # at most 64 MB

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for b in batches:
            for _, off, s in shingle_sets(b.column(0), k, seed):
                node, _ = names(off, s)
                at = mix(node) % U64(len(bits) * 64)
                hit = np.flatnonzero(((bits[at >> U64(6)] >> (at & U64(63))) & U64(1)).astype(bool) & (np.diff(off) > 0))
                new = []
                for i in hit.tolist():
                    if (x := int(node[i])) not in seen:
                        seen.add(x)
                        new.append(i)
                if new:
                    sets = [s[off[i] : off[i + 1]].tobytes() for i in new]
                    yield pa.RecordBatch.from_arrays([pa.array(node[new].view(np.int64)), pa.array(sets, type=pa.binary())], names=["node", "hashes"])

    return docs.select(docs[text_col].alias("text")).mapInArrow(wanted, "node long, hashes binary")


def _verified(dealt: DataFrame, percent: int) -> DataFrame:
    """Edges from each set to the first of its links' component, for every block (root, i, j) of `dealt`."""

    def links_of(nodes: list[int], sets: list[bytes]) -> tuple[list[int], list[int]]:
        node, pick = np.unique(np.array(nodes), return_index=True)
        if len(node) < 2:
            return [], []
        s = [np.frombuffer(sets[i], dtype=U64) for i in pick]
        off = np.concatenate([[0], np.cumsum([len(x) for x in s])])
        root = linked(off, np.concatenate(s), percent)
        other = np.flatnonzero(root != np.arange(len(root)))
        return node[other].tolist(), node[root[other]].tolist()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []
        for b in batches:
            a_out, b_out = [], []
            keys = zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
            for new, node, hashes in zip(keys, b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if new != key:
                    x, y = links_of(nodes, sets)
                    a_out += x
                    b_out += y
                    key, nodes, sets = new, [], []
                nodes.append(node)
                sets.append(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, type=pa.int64()), pa.array(b_out, type=pa.int64())], names=["a", "b"])
        x, y = links_of(nodes, sets)
        yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()), pa.array(y, type=pa.int64())], names=["a", "b"])

    order = ["root", "i", "j", "node"]
    return dealt.select(*order, "hashes").repartition("root", "i", "j").sortWithinPartitions(*order).mapInArrow(verify, "a long, b long")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85, block: int = 1024) -> tuple[DataFrame, DataFrame, int]:
    """The documents (id, n, node), for each node that has links the root of its component, and the hashes' seed.

    A task holds 2 * block sets at a time."""
    bounded_batches(docs.sparkSession)
    for seed in range(8):
        thin = landed(_thin(docs, id_col, text_col, k, seed), "sets")
        if thin.groupBy("node").agg((F.min("second") != F.max("second")).alias("clash")).filter("clash").isEmpty():
            break  # else two different sets share a name: hash anew
    sizes = {r["n"]: r["count"] for r in thin.filter("n between 1 and 40").groupBy("n").count().collect()}
    met = _meetings(_signatures(docs, text_col, k, seed, percent, boundary(sizes, percent)), percent)
    family = landed(components(met), "families")
    sets = landed(_sets_of(docs, family, text_col, k, seed), "family-sets")
    return thin, landed(_family_roots(sets, family, percent, block), "roots"), seed


def _known(df: DataFrame) -> DataFrame:
    """A landed table of few short columns: broadcast up to KNOWN rows, joined by shuffle beyond."""
    return F.broadcast(df) if df.count() <= KNOWN else df


def _family_roots(sets: DataFrame, family: DataFrame, percent: int, block: int) -> DataFrame:
    """For each node that has links, the node that stands for its component, from families (node, root).

    Families up to `block` sets are settled at once. A larger one is dealt to parts, in each of which the components are found;
    one set of each stands for it, and these are compared next. That settles families of copies, whose sets are
    all alike, with each set read once. Where several components remain, a link between them may still be anywhere, but
    one side of it is outside of the largest: so the sets outside, in blocks, are compared with all sets of their family.
    """
    counts = family.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    family = landed(family.join(counts, "root").withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "family-parts")
    dealt = sets.join(_known(family), "node").withColumn("j", F.lit(0))
    edges = landed(_verified(dealt, percent), "links-in-parts")
    large = family.filter("blocks > 1")
    # in a part, edges lead to the first set of a component
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
    if large.isEmpty():
        return named

    sets = sets.join(_known(large.select("node")), "node")
    heads = landed(large.join(edges.select(F.col("a").alias("node"), F.col("b").alias("head")), "node", "left")
                   .select("root", "node", F.coalesce("head", "node").alias("head")), "part-heads")
    few = heads.filter("node = head").select("root", "node")
    parts = few.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    few = landed(few.join(parts, "root").withColumn("i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")), "heads-dealt")
    between = landed(_verified(sets.join(_known(few), "node").withColumn("j", F.lit(0)), percent), "links-of-heads")
    if few.filter("blocks > 1").isEmpty():
        merged = between.select(F.col("a").alias("head"), F.col("b").alias("top"))
    else:
        merged = components(between).withColumnsRenamed({"node": "head", "root": "top"})
    tops = landed(heads.join(merged, "head", "left").select("root", "node", F.coalesce("top", "head").alias("top")), "family-tops")
    small = named.join(_known(large.select("node")), "node", "left_anti")
    roots = small.union(tops.select("node", F.col("top").alias("root")))

    size = tops.groupBy("root", "top").agg(F.count(F.lit(1)).alias("n"))
    most = size.groupBy("root").agg(F.max(F.struct("n", "top")).alias("largest"), F.count(F.lit(1)).alias("tops"), F.sum("n").alias("all"))
    most = landed(most.filter("tops > 1"), "open-families")
    if most.isEmpty():
        return roots
    most = most.select("root", F.col("largest.top").alias("main"), F.ceil(F.col("largest.n") / block).cast("int").alias("in_main"),
                       F.ceil((F.col("all") - F.col("largest.n")) / block).cast("int").alias("outside"))
    rest = tops.join(most, "root").withColumn("inside", F.col("top") == F.col("main"))
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.when(F.col("inside"), F.col("in_main")).otherwise(F.col("outside"))).cast("int")

    def key(i, j):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))

    outer, inner = F.sequence(F.lit(0), F.col("outside") - 1), F.sequence(F.lit(0), F.col("in_main") - 1)
    # j counts the blocks outside first, then those of the largest component
    met = F.when(F.col("inside"), F.transform(outer, lambda i: key(i, F.col("outside") + F.col("own")))).otherwise(
        F.concat(F.transform(outer, lambda i: key(F.least(i, F.col("own")), F.greatest(i, F.col("own")))), F.transform(inner, lambda j: key(F.col("own"), F.col("outside") + j)))
    )
    rest = rest.withColumn("own", own).select("root", "node", F.explode(met).alias("at")).select("root", "node", "at.i", "at.j")
    more = _verified(sets.join(_known(landed(rest, "open-parts")), "node"), percent)
    names = tops.select("node", "top")
    more = more.join(names.withColumnsRenamed({"node": "a", "top": "top_a"}), "a").join(names.withColumnsRenamed({"node": "b", "top": "top_b"}), "b")
    more = components(more.select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))).withColumnsRenamed({"node": "top", "root": "last"})
    final = tops.join(more, "top", "left").select("node", F.coalesce("last", "top").alias("root"))
    return small.union(final)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85, block: int = 1024) -> DataFrame:
    """One row for each row of `docs`: id, n_shingles, component_id.

    A document's set are its distinct k-word shingles, with A-Z lower-cased; with fewer words, all of them as one. Two
    documents are linked when 100 * intersection >= percent * union, component_id is the smallest id that links lead to. A
    null or empty text has no shingle and no link: its own id. Rows of equal id and text get equal rows; null ids are
    passed over when the smallest is taken. An empty table gives an empty one; other columns are ignored.
    """
    thin, roots, _ = links(docs, id_col, text_col, k, percent, block)
    rows = thin.join(roots, "node", "left").withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "node")))
    least = rows.filter("n > 0").groupBy("root").agg(F.min("id").alias("least"))
    out = rows.join(least, "root", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, block: int = 1024) -> DataFrame:
    """`docs` with one row of each component, that of the smallest id; texts without words all stay. Columns stay as they are.

    A null id counts as smaller than any other. Of rows that agree in id and set one stays."""
    thin, roots, seed = links(docs, id_col, text_col, k, percent, block)
    full = thin.filter("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = full.groupBy("root").agg(F.min(F.struct("id", "node")).alias("best"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    members = landed(full.select("root", "node").distinct().join(groups, "root").select("node", "best"), "members")
    # a filter lets texts without company pass, so only the others are shuffled
    shared = docs.sparkSession.sparkContext.broadcast(_filter_bits(members))
    schema = docs.select(whole_row(docs).alias("doc"), docs[id_col].alias("id")).schema
    schema = schema.add("node", "long").add("alone", "boolean")

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, off, s in shingle_sets(b.column(2), k, seed):
                n = len(off) - 1
                node = names(off, s)[0]
                at = mix(node) % U64(len(shared.value) * 64)
                hit = ((shared.value[at >> U64(6)] >> (at & U64(63))) & U64(1)).astype(bool) & (np.diff(off) > 0)
                columns = [b.column(0).slice(first, n), b.column(1).slice(first, n), pa.array(node.view(np.int64)), pa.array(~hit)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "id", "node", "alone"])

    rows = docs.select(whole_row(docs).alias("doc"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    rows = rows.mapInArrow(tagged, schema)
    near = rows.filter("not alone").join(_known(members), "node", "left")
    near = near.filter(F.col("best").isNull() | (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("node") == F.col("best.node"))))
    if not thin.filter("n > 0").groupBy("id", "node").count().filter("count > 1").isEmpty():
        near = near.dropDuplicates(["node"])
    return rows.filter("alone").select("doc.*").union(near.select("doc.*"))
