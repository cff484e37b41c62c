"""Removal of repeated strings, and the interval tree, against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import repeats
from hourloom.llm.common import texts


def brute(rows, least):
    """Rows of equal id and text are one document; ids are otherwise distinct here."""
    docs = sorted({(r[0] if r[0] is not None else repeats.FIRST_ID, (r[1] or "").encode()) for r in rows})
    seen, gone = set(), {}
    for i, data in docs:
        marks = bytearray(len(data))
        for k in range(len(data) - least + 1):
            s = data[k : k + least]
            if s in seen:
                marks[k : k + least] = b"\x01" * least
            seen.add(s)
        gone[i, data] = marks
    out = []
    for r in rows:
        data = (r[1] or "").encode()
        marks = gone[r[0] if r[0] is not None else repeats.FIRST_ID, data]
        left = bytes(c for c, m in zip(data, marks, strict=True) if not m)
        runs = sum(1 for k, m in enumerate(marks) if m and (k == 0 or not marks[k - 1]))
        out.append((r[0], len(data), sum(marks), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(500)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passages = [text(n) for n in (12, 15, 18, 20, 30, 60)]
    out = hard()
    for i in range(120):
        parts = [text(r.randrange(0, 40)) for _ in range(3)]
        for _ in range(r.randrange(4)):
            parts.insert(r.randrange(len(parts)), r.choice(passages))
        out.append((3000 + i, " ".join(parts), "en", "s", 0))
    base = text(150).split()
    for i in range(60):
        w = list(base)
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"é{r.randrange(1000)}"
        out.append((4000 + i, " ".join(w), "en", "s", 0))
    out += [(4100 + i, passages[2][i:] + passages[3], "en", "s", 0) for i in range(25)]
    out += [(4200, "ab" * 500, "", "", 0), (4201, "ba" * 60, "", "", 0), (4202, "a" * 99, "", "", 0), (4203, "a" * 100, "", "", 0), (4204, "a" * 101 + "\0" * 220, "", "", 0)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("group", [2000, 3])
def test_removal(spark, rows, group):
    df = frame(spark, rows).withColumn("start", F.lit("x")).withColumn("id", F.lit("x")).repartition(3)
    got = [tuple(x) for x in repeats.strip(df, group=group).collect()]
    assert sorted(got, key=repr) == brute(rows, 100)


def test_tables(spark):
    rows = documents()
    got = [tuple(x) for x in repeats.strip(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == brute(rows, 100)
    assert repeats.strip(frame(spark, [])).count() == 0


def test_other_lengths_and_bytes(spark):
    rows = [(1, "x" * 10 + "0123456789" * 6, "", "", 0), (2, "y" * 10 + "0123456789" * 6 + "z", "", "", 0)]
    got = {r["doc_id"]: r for r in repeats.strip(frame(spark, rows), least=50, with_bytes=True).collect()}
    assert bytes(got[2]["kept"]) == b"yyyyyyyyyyz" and got[1]["n_removed"] < 70
    want = {r[0]: r[2] for r in brute(rows, 50)}
    assert {k: r["n_removed"] for k, r in got.items()} == want


def test_long_texts_are_filed_in_parts(spark, monkeypatch, rows):
    monkeypatch.setattr(repeats, "LONG", 700)
    pairs = [(p, (b"".join([(r[1] or "").encode()]))) for p, r in enumerate(rows)]
    for (_, run) in zip(range(1), texts(pa.array([pairs[5][1].decode() * 40]))):
        whole = [x for skip, part in repeats.long_parts(run, 100) for x in (repeats.segments(part, 100)[1] + skip).tolist()]
        assert sorted(set(whole)) == sorted(whole)
        counts = sum(int(repeats.segments(part, 100)[2].sum()) for _, part in repeats.long_parts(run, 100))
        assert counts == max(0, len(run.data) - 99)


def test_equal_strings_share_a_gram():
    r = random.Random(2)
    a, b = ("".join(r.choice("abcdef ") for _ in range(3000)) for _ in range(2))
    run = next(texts(pa.array([a, b[:700] + a[500:900] + b[700:], ""])))
    doc, start, count, h, seg = repeats.segments(run, 100)
    where = collections.defaultdict(set)
    for d, s, c, g in zip(doc, start, count, h, strict=True):
        for k in range(s, s + c):
            where[(a, b[:700] + a[500:900] + b[700:])[d][k : k + 100]].add(int(g))
    assert all(len(x) == 1 for x in where.values())
    assert int(count.sum()) == 2901 + 3301


def naive_repeats(strings, counts, least):
    """Maximal repeats by definition: strings with two occurrences, not all followed or all preceded by one byte."""
    found = {}
    spots = [(i, o) for i, c in enumerate(counts) for o in range(c)]
    for x in range(len(spots)):
        for y in range(x):
            (i, a), (j, b) = spots[x], spots[y]
            n = 0
            while a + n < len(strings[i]) and b + n < len(strings[j]) and strings[i][a + n] == strings[j][b + n]:
                n += 1
            if n >= least:
                w = strings[i][a : a + n]
                occ = frozenset((k, o) for k, o in spots if strings[k][o : o + n] == w)
                left = {strings[k][o - 1] if o else ("edge", k) for k, o in occ}
                if len(left) > 1 or any(isinstance(v, tuple) for v in left):
                    found[w] = occ
    return {(len(w), occ) for w, occ in found.items()}


def test_maximal_repeats():
    r = random.Random(6)
    for _ in range(150):
        strings = ["".join(r.choice("ab") for _ in range(r.randrange(4, 14))).encode() for _ in range(r.randrange(2, 5))]
        counts = np.array([max(1, len(s) - 2) for s in strings])
        got = {(n, frozenset(zip(w.tolist(), o.tolist(), strict=True))) for n, w, o in repeats.repeats(strings, counts, 3)}
        assert got == naive_repeats(strings, counts, 3)
