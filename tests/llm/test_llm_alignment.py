"""Alignment of tokens against plain Python over the decoded bytes of whole texts."""

import collections
import hashlib
import itertools

import numpy as np
import public_tokenizers
import pytest
from llm_cases import documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    " \n\n x \t\r y;\r\n z", "é漢😀😀 x <s> <|endoftext|> </s> <0x0A>", "a▁b isn't given back", "x y\xa0z　q", "\n\nabc", " lead", "tail ", "tail \n",
    "a\x00b\x1cc \x1d d", "don't  we'll 12 345!!", "x" * 5000, "ok   three\n   indented\n\tif(){\r\n}", "﻿bom ‍👨‍👩 é", "\x85x\x85 y",
    "a.b.c... d,, (e). ,f ;g", "word.\nNext", "¿qué? ¡sí!",
]


@pytest.fixture(scope="module")
def coder():
    return alignment.Coder(A, B)


def plain(coder, text):
    """Ids, ends and groups, each token placed by its bytes alone, and all overlapping pairs."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = coder.one.encode(" " + text, add_special_tokens=False).ids, coder.two.encode(text)
    to_byte = alignment.byte_of_char()
    bytes_a = [bytes(to_byte[c] for c in coder.one.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if coder.two.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [coder.two.id_to_piece(i)]]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    end_a, end_b = list(itertools.accumulate(map(len, bytes_a))), list(itertools.accumulate(map(len, bytes_b)))
    cuts = sorted(set(end_a) & set(end_b))
    groups, i, j = [], 0, 0
    links = collections.Counter()
    for cut in cuts:
        i0, j0 = i, j
        while i < len(a) and end_a[i] <= cut:
            i += 1
        while j < len(b) and end_b[j] <= cut:
            j += 1
        groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
        for p in range(i0, i):
            for q in range(j0, j):
                if max(end_a[p] - len(bytes_a[p]), end_b[q] - len(bytes_b[q])) < min(end_a[p], end_b[q]):
                    links[a[p], b[q]] += 1
    return a, end_a, b, end_b, cuts, hashlib.sha256(";".join(groups).encode()).hexdigest(), links


@pytest.fixture(scope="module")
def rows():
    out = hard() + [(r[0] + 1000, *r[1:]) for r in documents()[:120]]
    return out + [(3000 + i, t, "en", "s", len(t)) for i, t in enumerate(ODD)]


def test_units_keep_the_text():
    for t in [*ODD, *(r[1] or "" for r in hard())]:
        assert "".join(alignment.UNIT.findall(" " + t)) == " " + t


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_counts(spark, rows, coder, broadcast_rows):
    found = {}
    for i, t, *_ in rows:
        found.setdefault((i, t), plain(coder, t))
    total = collections.Counter()
    for i, t, *_ in rows:
        if found[i, t]:
            total.update(found[i, t][-1])
    top = {}
    for (_, b), n in total.items():
        top[b] = max(top.get(b, 0), n)
    want = []
    for i, t, *_ in rows:
        x = found[i, t]
        if not x:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(n for (a, b), n in x[-1].items() if total[a, b] == top[b])
        want.append((i, len(x[0]), len(x[2]), len(x[4]), sum(x[-1].values()), best, sum(n * total[p] for p, n in x[-1].items()), x[5]))
    df = frame(spark, rows).withColumn("links", F.lit(1)).withColumn("n_a", F.lit("x")).withColumn("row", F.lit(0)).withColumn("a.b", F.lit(0))
    got = [tuple(r) for r in alignment.align(df, A, B, broadcast_rows=broadcast_rows).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] == 0 for r in got) == 3  # null, empty, and texts that aren't given back


def test_spans(spark, rows, coder):
    got = {r["doc_id"]: r for r in alignment.spans(frame(spark, rows), A, B).collect()}
    for i, t, *_ in rows:
        x = plain(coder, t)
        r = got[i]
        if x is None:
            assert not r["a_ids"] and not r["group_ends"]
        elif i != 7:  # the id of two rows
            assert (r["a_ids"], r["a_ends"], r["b_ids"], r["b_ends"], r["group_ends"]) == x[:5]


def test_texts_are_aligned_alike_whole_and_in_units(coder):
    whole = alignment.Coder(A, B)
    whole.separable = False
    texts = [t for t in ODD if t]
    one, two = coder.digest(texts), whole.digest(texts)
    assert (one[0] == two[0]).all() and one[1] == two[1] and (one[2][0] == two[2][0]).all() and (one[3] == two[3]).all()


def test_cleared_cache(coder):
    small = alignment.Coder(A, B, most=3)
    texts = [r[1] for r in documents()[:20] if r[1]]
    for t in texts:
        got = small.digest([t])
        x = plain(coder, t)
        assert got[0][:, 0].tolist() == [len(x[0]), len(x[2]), len(x[4]), sum(x[-1].values())] and got[1] == [x[5]]


def test_placed():
    # three tokens inside one character, whose spans overlap, and one that stands alone
    end = alignment.placed(np.array([0, 1, 1, 1, 4]), np.array([1, 4, 4, 4, 5]), np.array([1, 1, 1, 1, 1]))
    assert end.tolist() == [1, 2, 3, 4, 5]
    # byte-fallback tokens: empty spans, the last one has the character
    assert alignment.placed(np.array([0, 1, 1, 1]), np.array([1, 1, 1, 4]), np.array([1, 1, 1, 1])).tolist() == [1, 2, 3, 4]
    assert alignment.placed(np.array([0]), np.array([3]), np.array([2])) is None


def test_nothing(spark):
    assert alignment.align(frame(spark, []), A, B).count() == 0 and alignment.spans(frame(spark, []), A, B).count() == 0
