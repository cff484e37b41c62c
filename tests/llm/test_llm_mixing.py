"""The mix against plain Python: targets by hand, copies by walking through each source in order."""

import collections
import hashlib
import math
import re

import pytest
from llm_cases import documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def level_targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, hold what is above its limit there, share the rest again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        rest, open_ = total - sum(held.values()), sum(w for s, w in weight.items() if s not in held)
        out = {**held, **{s: rest * w / open_ for s, w in weight.items() if s not in held}} if open_ else held
        above = [s for s in sizes if s not in held and out[s] > most * sizes[s]]
        if not above:
            return out
        held |= {s: most * sizes[s] for s in above}


def walked(rows, seed=7, most=3):
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + words(t)
    target = level_targets(size, most=most)
    number = lambda x: int(hashlib.md5(x.encode()).hexdigest()[: mixing.HEX], 16)
    out = []
    for s in size:
        own = sorted((words(t), number(f"{seed}:{'' if i is None else i}:{t or ''}"), i is None, i or 0) for i, t, _, x, _ in rows if x == s)
        each = min(most * mixing.UNIT, math.floor(target[s] / size[s] * mixing.UNIT + 0.5)) if size[s] else 0
        at = number(f"{seed}:{s or ''}") % mixing.UNIT
        for n, _, no_id, i in own:
            before, at = at, at + each
            out.append((None if no_id else i, n, size[s], target[s], (at // mixing.UNIT - before // mixing.UNIT) * n))
    return out


@pytest.fixture(scope="module")
def rows():
    return hard() + [(r[0] + 1000, *r[1:]) for r in documents()] + [(5000, None, "en", "only nothing", 0)]


def test_against_walking(spark, rows):
    df = frame(spark, rows).withColumn("size", F.lit("x")).withColumn("target", F.lit(-1)).withColumn("key", F.lit(0)).withColumn("a.b", F.lit(1))
    want = walked(rows)
    for order in (df, df.repartition(5).orderBy(F.rand(3))):  # reruns agree in any order of the table
        got = [tuple(r) for r in mixing.report(order).collect()]
        assert len(got) == len(rows)
        plain = lambda r: (repr(r[0]), r[1], r[2], round(r[3], 6), r[4])
        assert sorted(map(plain, got)) == sorted(map(plain, want))
    taken, size, target = collections.Counter(), collections.Counter(), {}
    source = {r[0]: r[3] for r in rows}
    for i, n, _, t, k in got:
        assert k <= 3 * n
        taken[source[i]] += k
        size[source[i]] = max(size[source[i]], n)
        target[source[i]] = t
    assert abs(sum(target.values()) - sum(r[1] for r in got)) < 1e-6
    assert all(abs(taken[s] - target[s]) <= size[s] + 1 for s in target)  # about one document


def test_rows_of_the_mix(spark, rows):
    df = frame(spark, rows).withColumn("copies", F.lit(-1)).withColumn("a.b", F.lit(1)).withColumn("doc", F.lit(2))
    got = mixing.mix(df)
    assert got.columns == df.columns
    told = {}
    for r in mixing.copies(df, ["doc_id"]).collect():
        told[r["doc"]["doc_id"]] = told.get(r["doc"]["doc_id"], 0) + r["copies"]
    assert {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {i: n for i, n in told.items() if n}
    texts = {(r[0], r[1]) for r in rows}
    assert all((r["doc_id"], r["text"]) in texts for r in got.collect())


def test_targets_are_shared_again(spark):
    sizes = {"a": 1000, "b": 10, "c": 10, "d": 500, "é": 0, None: 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = level_targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-9 for s in sizes) and got["b"] == 30 and got[None] == 9
    # few sources are far above the others: limits are met one after another
    sizes = {f"s{i:02}": 3**i for i in range(12)}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got, want = {r["source"]: r["target"] for r in mixing.targets(df).collect()}, level_targets(sizes)
    assert all(math.isclose(got[s], want[s]) for s in sizes) and math.isclose(sum(got.values()), sum(sizes.values()))


def test_nothing(spark):
    assert mixing.report(frame(spark, [])).count() == 0 and mixing.mix(frame(spark, [])).count() == 0
    none = frame(spark, [(1, None, None, None, 0), (2, "  ", None, "s", 0)])
    assert sorted(tuple(r) for r in mixing.report(none).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_no_window_holds_a_source(spark, rows):
    text = mixing.report(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    windows = [w for w in text.splitlines() if "Window [" in w]
    assert windows and all("cell" in w for w in windows)  # the windows over sizes and sources are in tables landed before
