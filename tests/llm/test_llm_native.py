"""License scan, line rules and personal data against plain Python."""

import collections
import hashlib
import math
import random
import re
import time

import pytest
from llm_cases import SCHEMA, documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import licenses, line_rules, pii


@pytest.fixture(scope="module")
def both(spark):
    rows = hard() + [(r[0] + 1000, *r[1:]) for r in documents()]
    return rows, frame(spark, rows).withColumn("score", F.lit("x")).withColumn("n_words", F.lit(-1)).withColumn("spans", F.lit(0)).withColumn("row", F.lit("r"))


def key(x):
    return repr(x)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_licenses(both):
    rows, df = both
    want = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
        places, labels = [], set()
        for p in licenses.PHRASES:
            q = p.words.split()
            hit = [k for k in range(len(w)) if w[k : k + len(q)] == q]
            places += hit
            labels |= {p.label} if hit else set()
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    found = licenses.scan(df)
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    for r in found.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])


def test_license_templates(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "Permission is hereby granted, free of charge, to any person obtaining one copy of this software",
        "permission granted hereby is",
        "general public gnu license",
    ]
    got = licenses.scan(frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["gpl-3", "mit", "", ""]
    assert got[0]["score"] > 0.8 and 0.8 < got[1]["score"] < 1 and got[2]["score"] == 0


def test_license_of_long_repetitive_texts(spark):
    """A licence's own words over and over, and words of all licences in no order: the work must not grow with their square."""
    phrase = "permission is hereby granted free "
    vocabulary = sorted({w for t in (*licenses.PHRASES, *licenses.TEMPLATES) for w in t.words.split()})
    r = random.Random(4)
    rows = [(1, phrase * 30_000, "en", "s", 0), (2, "under the mit license " * 40_000, "en", "s", 0), (3, " ".join(r.choices(vocabulary, k=100_000)), "en", "s", 0)]
    start = time.time()
    got = {x["doc_id"]: x for x in licenses.scan(frame(spark, rows)).drop("places").collect()}
    assert time.time() - start < 120
    assert got[2]["n_base"] == 40_000 and got[2]["last_word"] == 4 * 39_999 and got[2]["labels"] == "mit"
    assert got[1]["n_base"] == 0 and got[1]["n_words"] == 150_000 and 0 < got[1]["score"] < 1


def test_license_templates_against_plain_python(spark):
    r = random.Random(8)
    vocabulary = sorted({w for t in (*licenses.PHRASES, *licenses.TEMPLATES) for w in t.words.split()})
    texts = []
    for _ in range(60):
        words = r.choices(["lorem", "ipsum", *vocabulary], k=r.randrange(0, 40))
        for t in r.sample(licenses.TEMPLATES, r.randrange(0, 3)):
            part = t.words.split()
            for k in range(len(part)):
                if r.random() < 0.1:
                    part[k] = "other"
            at = r.randrange(0, len(words) + 1)
            words[at:at] = part
        texts.append(words)
    got = licenses.scan(frame(spark, [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    every = (*licenses.PHRASES, *licenses.TEMPLATES)
    seen = collections.Counter(w for t in texts for w in set(t))
    idf = {w: math.log((1 + len(texts)) / (1 + seen[w])) + 1 for w in vocabulary}
    for words, x in zip(texts, got, strict=True):
        labels, base, near = set(), 0, 0.0
        for t in every:
            part, key = t.words.split(), t.key.split()
            first = next(i for i in range(len(part)) if part[i : i + len(key)] == key)
            keys = range(first, first + len(key)) if key else range(len(part))
            for s in range(-len(part), len(words)):
                same = [k for k in range(len(part)) if 0 <= s + k < len(words) and words[s + k] == part[k]]
                if not set(keys) <= set(same):
                    continue
                share = sum(idf[part[k]] for k in same) / sum(idf[w] for w in part)
                if t in licenses.PHRASES:
                    base += 1
                    labels.add(t.label)
                    continue
                near = max(near, share if key else 0)
                if share >= t.share * 0.999:
                    labels.add(t.label)
        assert (x["n_base"], x["labels"]) == (base, ",".join(sorted(labels)))
        assert abs(x["score"] - (1 if base else min(1, near))) < 1e-9


def test_line_rules_counts(both):
    rows, df = both
    want = []
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        rep = {k + j for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed))
    found = line_rules.rules(df)
    got = [tuple(r) for r in found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert found.filter("base_failed and kept").count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_line_rules_common(spark, broadcast_rows):
    body = lambda i: " ".join(f"word{chr(97 + (i * k) % 26)}{chr(97 + k)}" for k in range(25))
    menu = "Home Products About Contact Imprint Terms and so on and so forth " * 3
    rows = [(i, f"{menu}\n{body(i)}" if i < 30 else body(i), "en", "a", 0) for i in range(40)]
    rows += [(i, menu + " \n" + menu + str(i), "en", "a", 0) for i in range(50, 65)]  # nothing but the menu
    rows += [(i, f"{menu}\n{body(i)}", "en", "b", 0) for i in range(70, 78)]  # too few on this host
    rows += [(80 + i, body(99), "en", "a", 0) for i in range(50)]  # copies count once
    got = {r["doc_id"]: r for r in line_rules.rules(frame(spark, rows), repeat_percent=100, broadcast_rows=broadcast_rows).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["kept"] and got[i]["n_common_lines"] == 1 for i in range(30))
    assert not any(got[i]["kept"] for i in range(50, 65))
    assert all(got[i]["kept"] and got[i]["n_common_lines"] == 0 for i in [*range(70, 78), *range(80, 130)])


def test_clean_lines(spark):
    menu = "Home Products About Contact"
    rows = [(i, f"{menu}\nown text of number {'abcdefghijklmnopqrstuvwxyz'[i]} and more of it", "en", "a", 0) for i in range(20)]
    rows += [(30, f"{menu}\nx", "en", "a", 0), (31, f"{menu}\nx", "en", "b", 0), (32, None, "en", "a", 0), (33, "", None, None, 0)]
    got = line_rules.clean(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    text = {r["doc_id"]: r["text"] for r in got.collect()}
    assert set(text) == {*range(20), 31, 32, 33} and text[31] == rows[21][1] and text[32] is None and text[33] == ""
    assert all(text[i] == rows[i][1].split("\n")[1] for i in range(20))


def test_common_lines_of_a_large_host(spark):
    menu = "Home Products About Contact Imprint"
    own = lambda i: " ".join(f"{chr(97 + i // 26 ** k % 26)}{chr(97 + k)}{w}" for k in range(4) for w in "abcdefg")
    rows = [(i, f"{menu}\n{own(i)}" if i < 11 else own(i), "en", "a", 0) for i in range(2400)]
    got = line_rules.rules(frame(spark, rows), repeat_percent=100).filter("n_common_lines > 0").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(11))
    text = {r["doc_id"]: r["text"] for r in line_rules.clean(frame(spark, rows)).collect()}
    assert text == {i: own(i) for i in range(2400)}


def test_lines_of_numbers(spark):
    table = lambda i: "\n".join(f"{i * 100 + k} {i}.{k}" for k in range(30))
    rows = [(i, table(i), "en", "a", 0) for i in range(15)]
    rows += [(20 + i, "\n".join(f"Temperature {i}.{k}" for k in range(30)), "en", "b", 0) for i in range(15)]
    rows += [(40 + i, f"own text of {chr(97 + i) * 4} {'and more ' * 20}\n ---\t", "en", "c", 0) for i in range(15)]
    rows += [(60 + i, f"own text of {chr(97 + i) * 4} {'and more ' * 20}\nRead by {i} of our subscribers today", "en", "d", 0) for i in range(15)]
    got = {r["doc_id"]: r for r in line_rules.rules(frame(spark, rows), repeat_percent=100).collect()}
    assert all(got[i]["kept"] and got[i]["n_common_lines"] == 0 for i in [*range(15), *range(20, 35)])
    assert all(got[i]["kept"] and got[i]["n_common_lines"] == 1 for i in [*range(40, 55), *range(60, 75)])
    text = {r["doc_id"]: r["text"] for r in line_rules.clean(frame(spark, rows)).collect()}
    assert all(text[r[0]] == (r[1] if r[0] < 40 else r[1].split("\n")[0]) for r in rows)


def spans(t):
    out = {}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]

    def luhn(d):
        s = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (1 + k % 2)
            s += v - 9 if v > 9 else v
        return s % 10 == 0

    only = lambda m: re.sub("[^0-9]", "", m[0])
    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(only(m)) <= 19 and luhn(only(m))]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(only(m)) <= 15]
    return out


def test_pii(both):
    rows, df = both
    want = []
    for i, t, *_ in rows:
        s = spans(t or "")
        base = ",".join(f"{k}:{a}:{b}" for k in s for a, b in s[k])
        want.append((i, *[len(s[k]) for k in s], hashlib.sha256(base.encode()).hexdigest()))
    found = pii.digest(pii.detect(df))
    got = [tuple(r) for r in found.drop("spans").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    secret = [r["spans"] for r in found.filter("doc_id = 13").collect()]
    assert "secret:" in secret[0]


def test_redaction(spark):
    rows = [(1, "mail a@b.com now, or +1 (415) 555-0100", None, None, 0), (2, None, "en", "x", 1), (3, "clean 12 text", "en", "x", 1), (4, "é😀 a@b.com", "en", "x", 1)]
    got = pii.redact(frame(spark, rows))
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "mail <EMAIL> now, or <PHONE>", 2: None, 3: "clean 12 text", 4: "é😀 <EMAIL>"}


def test_redaction_leaves_other_columns_alone(spark):
    """Columns named as the operators' own, or with a dot in them."""
    schema = "doc_id long, text string, clean string, by_start string, txt string, spans array<int>, `a.b` long, _s_email string, m_email string, p_ip int, doc int, last int"
    text = "x" + " a@b.cc 1.2.3.4" * 300 + " 😀 password=a1234567"
    rows = [(1, text, "C", "B", "T", [1], 9, "q", "m", 3, 4, 5), (2, None, "C", None, "T", None, 9, "q", "m", 3, 4, 5)]
    got = {r["doc_id"]: r for r in pii.redact(spark.createDataFrame(rows, schema)).collect()}
    assert got[1]["text"] == "x" + " <EMAIL> <IP>" * 300 + " 😀 <SECRET>"
    assert [tuple(got[i])[2:] for i in (1, 2)] == [r[2:] for r in rows] and got[2]["text"] is None


def test_redaction_of_dense_texts(spark):
    rows = [(1, "a@b.cc " * 40_000, "en", "s", 0), (2, "1.2.3.4" + " +49 30 1234567" * 20_000, "en", "s", 0)]
    start = time.time()
    got = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows)).collect()}
    assert got == {1: "<EMAIL> " * 40_000, 2: "<IP>" + " <PHONE>" * 20_000}
    assert time.time() - start < 90


def test_dotted_columns(spark):
    df = frame(spark).withColumn("a.b", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("gone", F.lit(3))
    for out in (line_rules.clean(df), pii.redact(df)):
        assert out.columns == df.columns and out.filter("`a.b` <> 1 or doc <> 2 or gone <> 3").isEmpty() and not out.isEmpty()


def test_long_secrets(spark):
    value = "aB3/x_9-" * 40
    rows = [(i, f"login token = {value[:n]} end", "en", "s", 0) for i, n in enumerate((8, 128, 129, 300))] + [(9, "user secret=" + "k7" * 50_000, "en", "s", 0)]
    got = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows)).collect()}
    assert got == {**dict.fromkeys(range(4), "login <SECRET> end"), 9: "user <SECRET>"}
    spans_ = {r["doc_id"]: r["spans"] for r in pii.digest(pii.detect(frame(spark, rows))).collect()}
    assert spans_[3] == "secret:6:314"


def test_empty(spark):
    none = frame(spark, [])
    for df in (licenses.scan(none), line_rules.rules(none), pii.digest(pii.detect(none)), pii.redact(none)):
        assert df.count() == 0


def test_no_python(spark, both):
    _, df = both
    for out in (licenses.scan(df), line_rules.rules(df), pii.digest(pii.detect(df))):
        plan = out._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_em_prefers_the_better_labeler():
    counts = {("k", 1, 1, 0): 90, ("k", -1, -1, 0): 90, ("k", 1, -1, 0): 10, ("k", -1, 1, 1): 2}
    post, right, _ = pii.reliabilities(counts)
    assert post[("k", 1, 1, 0)] > 0.9 > 0.1 > post[("k", -1, -1, 0)]
    bias, weight = pii.span_classifier(counts, post)
    assert bias["k"] + sum(weight[:2]) > 0 > bias["k"] - sum(weight[:2])
    assert all(0.5 < r < 1 for r in right.values())
