"""The Jaccard join and components against brute force."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import ngram_join
from hourloom.llm.components import components


def words(t):
    return (t or "").encode().lower().split()


def shingles(t, k):
    w = words(t)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k=4, percent=85):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
            o = len(a & b)
            if 100 * o >= percent * (len(a) + len(b) - o):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def family(r, base, members, edits, start):
    out = []
    for m in range(members):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
        out.append((start + m, " ".join(w), "en", "s", 0))
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    out = hard() + [(1000 + i, *x) for i, *x in documents()]
    for n in (4, 6, 9, 12, 15, 16, 17, 20, 30, 60, 200):
        base = [r.choice(vocabulary) for _ in range(n)]
        out += family(r, base, 14, 3, 2000 + 100 * n)
        out += [(90000 + n * 40 + c, " ".join(base[c:]), "en", "s", 0) for c in range(min(4, n))]
    passage = " ".join(r.choice(vocabulary) for _ in range(50))
    out += [(70000 + i, passage + " " + " ".join(r.choice(vocabulary) for _ in range(r.choice([5, 20, 100]))), "en", "s", 0) for i in range(60)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("block", [1024, 5])
def test_components(spark, rows, block):
    df = frame(spark, rows).withColumn("node", F.lit("x")).withColumn("n", F.lit("x"))
    got = [tuple(x) for x in ngram_join.classes(df, block=block).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_crowded_lists(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", 2)
    got = [tuple(x) for x in ngram_join.classes(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_what_the_driver_gathers_is_bounded(spark, rows, monkeypatch):
    """Tables above KNOWN rows are joined by shuffle, with the same results; filters come as columns."""
    assert ngram_join.KNOWN <= 100_000
    for n, hinted in ((ngram_join.KNOWN, True), (ngram_join.KNOWN + 1, False)):
        plan = spark.range(5).join(ngram_join._known(spark.range(n)), "id")._jdf.queryExecution().analyzed().toString()
        assert ("ResolvedHint" in plan) == hinted
    monkeypatch.setattr(type(spark.range(0)), "toPandas", lambda self: pytest.fail("rows of Python objects"))
    nodes = np.random.default_rng(2).integers(-(2**63), 2**63, 5000)
    bits = ngram_join._filter_bits(spark.createDataFrame([(x,) for x in nodes.tolist()], "node long").repartition(3))
    at = ngram_join.mix(nodes.view(np.uint64)) % np.uint64(len(bits) * 64)
    want = np.zeros(len(bits), dtype=np.uint64)
    np.bitwise_or.at(want, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
    assert (bits == want).all() and not ngram_join._filter_bits(spark.createDataFrame([], "node long")).any()
    monkeypatch.setattr(ngram_join, "KNOWN", 0)
    got = [tuple(x) for x in ngram_join.classes(frame(spark, rows), block=5).collect()]
    assert sorted(got, key=repr) == brute(rows)
    kept = ngram_join.keep_one(frame(spark, rows), k=4, percent=85).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None and words(r["text"])) == sorted({i for i, n, c in brute(rows) if n and i == c and i is not None})


def test_other_thresholds(spark, rows):
    some = rows[::2]
    got = [tuple(x) for x in ngram_join.classes(frame(spark, some), k=5, percent=80).collect()]
    assert sorted(got, key=repr) == brute(some, 5, 80)


def test_every_linked_pair_meets():
    """Signatures of linked sets share one, for all sizes around the boundary and the levels."""
    r = np.random.default_rng(4)
    for percent in (80, 85, 95):
        for n in [*range(1, 60), 100, 257, 600]:
            a = np.sort(r.integers(0, 2**63, n, dtype=np.uint64))
            for _ in range(4):
                gone, new = r.integers(0, n + 1), r.integers(0, n // 5 + 2)
                b = np.sort(np.concatenate([a[gone // 6 :] if r.random() < 0.7 else a, r.integers(0, 2**63, new, dtype=np.uint64)]))
                o = len(np.intersect1d(a, b))
                if not len(b) or 100 * o < percent * (len(a) + len(b) - o):
                    continue
                off, s = np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b])
                for small in (0, 13):
                    size = np.diff(off)
                    few, many = np.flatnonzero(size <= small), np.flatnonzero(size * 100 >= percent * (small + 1))
                    found = {0: set(), 1: set()}
                    for sig, who in (ngram_join.subset_signatures(off, s, percent, few), ngram_join.group_signatures(off, s, percent, many)):
                        for x, i in zip(sig.tolist(), who.tolist(), strict=True):
                            found[i].add(x)
                    shared = found[0] & found[1]
                    assert shared, (percent, n, small)
                    for level in {x & ngram_join.SUBSET for x in shared} - {ngram_join.SUBSET}:
                        own = int(np.searchsorted(ngram_join.levels(percent, 4000)[0], min(len(a), len(b)), side="right")) - 1
                        if level == own and len(few) == 0:
                            assert sum(x & ngram_join.SUBSET == level for x in shared) > ngram_join.levels(percent, 4000)[3][level]


def test_boundary_follows_cost():
    assert 7 <= ngram_join.boundary({}, 85) < 20
    assert ngram_join.enumeration_cost(5, 85) == 1


def test_sets_do_not_depend_on_the_batch():
    texts = ["A b  c d e", None, "", "x", "a B c d e f " * 40, "tail word"]
    alone = []
    for t in texts:
        (_, off, s), = ngram_join.shingle_sets(pa.array([t], pa.string()), 4)
        alone.append(s.tolist())
    (_, off, s), = ngram_join.shingle_sets(pa.array(["skip", *texts]).slice(1), 4)
    assert [s[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == alone
    assert len(alone[0]) == 2 and len(alone[3]) == 1 and not alone[1]


def test_star_rounds(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(220)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark, rows):
    df = frame(spark, rows)
    kept = ngram_join.keep_one(df, k=4, percent=85)
    assert kept.columns == df.columns
    classes = brute(rows)
    want = sorted({(i, c) for i, n, c in classes if n and i == c and i is not None})
    got = [r for r in kept.collect() if r["doc_id"] is not None and words(r["text"])]
    assert sorted((r["doc_id"], r["doc_id"]) for r in got) == want
    assert sum(1 for r in kept.collect() if not words(r["text"])) == sum(1 for r in rows if not words(r[1]))
    assert ngram_join.keep_one(frame(spark, [])).count() == 0 and ngram_join.classes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("step", [1, 7, 10_000])
@pytest.mark.parametrize("size", [1, 3, 50])
def test_lists_are_read_as_they_come(step, size):
    """Lists of any length, cut anywhere into batches, against the same lists gathered."""
    r = np.random.default_rng(size * 31 + step)
    lists = []
    for n in (1, 2, 12, 13, 14, 40, 3, 200, 1, 12):
        tag = ngram_join.SUBSET if r.random() < 0.3 else int(r.integers(0, 9))
        lists.append((int(r.integers(1, 1 << 40)) << 12 | tag, sorted(r.choice(1 << 30, n, replace=False).tolist())))
    lists.sort()
    flat = [(sig, node) for sig, nodes in lists for node in nodes for _ in range(1 + (node % 3 == 0))]  # some nodes twice
    batches = [
        pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat[k : k + size]], type=pa.int64()) for i in (0, 1)], names=["sig", "node"])
        for k in range(0, len(flat), size)
    ]
    got = sorted(tuple(x.values()) for b in ngram_join.read_lists(iter(batches), step) for x in b.to_pylist())
    counted = {}
    for kind, a, b, level, n in got:
        counted[kind, a, b, level] = counted.get((kind, a, b, level), 0) + n if kind == 0 else 1  # others may be told twice
    want = {}
    for sig, nodes in lists:
        level = sig & ngram_join.SUBSET
        if level == ngram_join.SUBSET:
            keys = [(2, b, nodes[0], level) for b in nodes[1:]]
        elif len(nodes) > ngram_join.CROWD:
            keys = [(1, sig, b, level) for b in nodes]
        else:
            keys = [(0, a, b, level) for i, a in enumerate(nodes) for b in nodes[:i]]
        for key in keys:
            want[key] = want.get(key, 0) + 1
    assert counted == want
