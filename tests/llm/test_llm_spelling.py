"""Spelling groups against all pairs."""

import collections
import random
import re
import zlib

import pytest
from llm_cases import documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    m = spelling.shared(a, b)
    if len(a) == len(b):
        return a[m + 1 :] == b[m + 1 :]
    a, b = sorted((a, b), key=len)
    return a[m:] == b[m + 1 :]


def counted(rows, shortest=7, least=2, every=31):
    n = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= least}


def grouped(n, ratio=10):
    near = collections.defaultdict(list)
    cut = collections.defaultdict(set)
    for w in n:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            cut[v].add(w)
    for w in n:
        others = set().union(*(cut[v] for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}))
        near[w] = [o for o in others if one_edit(w, o)]
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def test_ranges_of_a_sorted_list():
    r = random.Random(3)
    for _ in range(150):
        letters = "abÿ"[: r.randrange(1, 4)]
        words = sorted({"".join(r.choice(letters) for _ in range(r.randrange(3, 9))).encode("latin-1") for _ in range(r.randrange(1, 120))})
        halves = [r.randrange(0, (len(w) - 1) // 2 + 1) for w in words]
        q, w = spelling.near(spelling.SortedList(words), words, halves)
        got = sorted(zip(q.tolist(), w.tolist(), strict=True))
        want = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b) and b[: halves[i]] == a[: halves[i]]]
        assert got == want
        for a in words[:20]:
            for b in words[:20]:
                prefix = b[: r.randrange(0, len(b) + 1)]
                assert not (spelling.beyond(a, prefix) and any(x.startswith(prefix) and (x == a or one_edit(a, x)) for x in words))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    base = ["".join(r.choice("abcdefgÀÿö") for _ in range(r.randrange(7, 13))) for _ in range(60)]
    base += ["prefixes" + "".join(r.choice("xyz") for _ in range(r.randrange(0, 6))) for _ in range(60)]  # many words of one prefix
    words = []
    for w in base:
        words += [w] * r.choice([1, 3, 40, 500])
        for _ in range(4):
            i = r.randrange(len(w))
            words += [r.choice([w[:i] + w[i + 1 :], w[:i] + "q" + w[i:], w[:i] + "q" + w[i + 1 :]])] * r.choice([2, 3, 30])
    r.shuffle(words)
    out = [(2000 + k, " ".join(words[k : k + 400]).title(), "en", "s", 0) for k in range(0, len(words), 400)]
    return hard() + [(r_[0] + 1000, *r_[1:]) for r_ in documents()] + out


@pytest.mark.parametrize("block", [8192, 40])
def test_against_all_pairs(spark, rows, block):
    df = frame(spark, rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(-1)).withColumn("a.b", F.lit(1)).withColumn("run", F.lit(1))
    got = [tuple(r) for r in spelling.group(df, block=block).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = grouped(counted(rows))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of two forms


def test_without_typos_and_with_short_words(spark, rows):
    got = [tuple(r) for r in spelling.group(frame(spark, rows), ratio=2, shortest=5, least=1, typo_every=0, block=500).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert sorted(got, key=repr) == sorted(grouped(counted(rows, 5, 1, 0), 2), key=repr)


def test_nothing(spark):
    none = [frame(spark, []), frame(spark, [(1, None, "en", "s", 0), (2, "short words only", "en", "s", 0), (None, "", None, None, 0)])]
    for df in none:
        assert spelling.group(df).count() == 0


def test_long_words(spark):
    long = "ab" * 20_000
    df = frame(spark, [(i, f"{long} {long}x {long[1:]}", "en", "s", 0) for i in range(3)])
    got = {r["word"]: r["n_near"] for r in spelling.group(df, typo_every=0).collect()}
    assert got == {long: 2, long + "x": 1, long[1:]: 1}
