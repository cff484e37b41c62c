"""Decontamination against plain Python, and the pipeline."""

import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from llm_cases import SF, documents, frame, hard
from pyspark.sql import functions as F

import corpus_pipeline
from hourloom.llm import contamination
from hourloom.llm.common import texts

TRIM = "".join(chr(c) for c in (*range(33, 37), *range(38, 48), *range(58, 65), *range(91, 97), *range(123, 127)))


def plain(text):
    """Tokens and values by the rules in words."""
    out, head, was_number = [], True, False
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        raw = m[0]
        first = head or (m.start() and text[m.start() - 1] == "\n")
        head = raw[-1] in ".!?:"
        w = raw.strip(TRIM)
        if not w:
            continue
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        number = bool(re.fullmatch(r"[0-9][0-9.,]*", w))
        unit = was_number and low in contamination.UNITS
        upper = w[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" and len(w) > 1 and ("a" <= w[1] <= "z" or ord(w[1]) >= 128)
        name = not first and (upper or "À" <= w[0] <= "Þ")
        was_number = number
        out.append(("<num>", low) if number else ("<unit>", low) if unit else ("<name>", low) if name else (low, None))
    return out


def brute(rows, items, size=8, words=4, share=0.5):
    found = set()
    plain_items = [(i, plain(t)) for i, t in items]
    for doc, text in {(r[0], r[1]) for r in rows}:
        d = plain(text)
        spots = {}
        for k in {min(size, len(t)) for _, t in plain_items if len(t) >= 4}:
            for p in range(len(d) - k + 1):
                spots.setdefault(tuple(x for x, _ in d[p : p + k]), []).append(p)
        for item, t in plain_items:
            k = min(size, len(t))
            if k < 4:
                continue
            shifts = {}
            for o in range(len(t) - k + 1):
                if sum(v is None for _, v in t[o : o + k]) >= min(words, k):
                    for p in spots.get(tuple(x for x, _ in t[o : o + k]), ()):
                        shifts.setdefault(p - o, set()).add(o)
            cover = set()
            for s, offs in shifts.items():
                spot = {o + j for o in offs for j in range(k)}
                pairs = {(t[x][1], d[x + s][1]) for x in spot if t[x][1] is not None}
                if len(pairs) == len({a for a, _ in pairs}):
                    cover |= spot
            if cover and len(cover) / len(t) >= share:
                found.add((doc, item, round(len(cover) / len(t), 9)))
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def tables():
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(r_["item_id"], r_["text"]) for r_ in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()][:20]
    items += [(500 + i, text(r.randrange(4, 30))) for i in range(20)]
    items += [
        (600, "A train with Anna leaves at 12 and drives 80 km to reach Anna and then 12 more until the end"),
        (601, "one two three"), (602, None), (603, ""), (604, "five words are just enough"), (605, "Bob has 3 apples and 4 pears and eats 3 of them now"),
    ]
    rows = hard() + [(1000 + i, *x) for i, *x in documents()]
    for i, (item, t) in enumerate(items):
        w = (t or "").split()
        for v in range(4):
            x = list(w)
            if v == 1 and x:
                x[r.randrange(len(x))] = "changed"
            if v == 2:
                x = x[len(x) // 2 :]
            if v == 3:
                x = x[: len(x) // 3] + ["inserted"] + x[len(x) // 3 :]
            rows.append((5000 + 10 * i + v, f"{text(30)} {' '.join(x)} {text(20)}", "en", "s", 0))
    rows += [
        (9000, "So: A train with Maria leaves at 7 and drives 95 miles to reach Maria and then 7 more until the end.", "en", "s", 0),
        (9001, "So: A train with Maria leaves at 7 and drives 95 miles to reach Peter and then 9 more until the end.", "en", "s", 0),
        (9002, "Bob has 5 apples and 9 pears and eats 5 of them now", "en", "s", 0), (9003, "Bob has 5 apples and 9 pears and eats 9 of them now", "en", "s", 0),
    ]
    return rows, items


def test_templates_of_all_texts(tables):
    rows, items = tables
    every = [r[1] for r in rows] + [t for _, t in items]
    known = {}
    for run in texts(pa.array(every, pa.string())):
        token, value, at = contamination.templates(run)
        for i in range(len(run)):
            mine = plain(every[run.first + i])
            assert at[i + 1] - at[i] == len(mine)
            for (t, v), h, g in zip(mine, token[at[i] : at[i + 1]].tolist(), value[at[i] : at[i + 1]].tolist(), strict=True):
                assert known.setdefault(t, h) == h and (v is None) == (g == 0)
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_contaminated(spark, tables, broadcast_rows):
    rows, items = tables
    df = frame(spark, rows).withColumn("item_id", F.lit("x")).withColumn("size", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = sorted(((r["doc_id"], r["item_id"], round(r["coverage"], 9)) for r in contamination.report(df, bench, broadcast_rows=broadcast_rows).collect()), key=repr)
    want = brute(rows, items)
    assert got == want and len(want) > 100
    ids = {(d, i) for d, i, _ in got}
    assert {(9000, 600), (9002, 605)} <= ids and (9003, 605) not in ids and (9001, 600) not in ids


def test_drops_rows(spark, tables):
    rows, items = tables
    df, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    kept = contamination.drop_contaminated(df, bench)
    bad = {d for d, *_ in brute(rows, items)}
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r[0] for r in rows if r[0] not in bad), key=repr)
    assert contamination.report(df.limit(0), bench).count() == 0
    assert contamination.report(df, bench.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).persist()
        assert after.columns == docs.columns and after.count() <= before.count(), name
        assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        before = after
    assert before.count() > 0.5 * docs.count()
    assert before.filter(F.col("text").rlike("@mail")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == last.columns
    lengths = lambda df: sorted((r["doc_id"], r["n"]) for r in df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect())
    assert lengths(whole) == lengths(last) and len(lengths(whole)) == before.select("doc_id").distinct().count()
    assert whole.filter(F.size("ids") != F.col("length")).count() == 0


def test_pipeline_of_hard_documents(spark):
    docs = frame(spark, hard() * 2)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
        docs.count()
    none = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0


def found_in(spark, texts_, items, **options):
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts_)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["coverage"] for r in contamination.report(docs, bench, **options).collect()}


def test_items_with_few_words(spark):
    items = [
        "What is 17 times 23?", "Compute 12 + 45 - 7", "Sort 9 4 7 1 8 in ascending order", "Who wrote Anna Karenina?", "What is DNA?", "11 2 33 4 5", "Explain how rain clouds form",
        "Add 1 2 3 4 5 6 7 8 9 10 11 12",
    ]
    near = [f"he said {t} and then they all went home" for t in items]
    other = [
        "They ask: What is 3 times 5?", "Now compute 1 + 2 - 3 please", "now Sort 2 3 4 5 6 in ascending order", "who wrote David Copperfield", "Notes\nWhat is DNA?\nIt is",
        "6 7 8 9 10", "we Explain how rain clouds form", "so Add 2 3 4 5 6 7 8 9 10 11 12 13 now",
    ]
    got = found_in(spark, near + other, items)
    n = len(items)
    assert set(got) == {(i, i) for i in range(n) if i != 4} | {(n + i, i) for i in range(n) if i != 5}
    assert all(c == 1 for c in got.values())
    items = ["What is 17 times 17?"]
    assert set(found_in(spark, ["so What is 5 times 5 now", "so What is 5 times 6 now"], items)) == {(0, 0)}


def test_verbatim_runs_of_long_items(spark):
    r = random.Random(4)
    w = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(59)]
    w[20], w[30], w[40] = "7", "7", "8"
    docs = [f"so {' '.join(w[10:35])} end", f"so {' '.join(w[10:23])} end", f"so {' '.join(w[10:22])} end", " ".join(["7" if x == "8" else "9" if i == 30 else x for i, x in enumerate(w)])]
    got = found_in(spark, docs, [" ".join(w)], passages=True)
    assert {d: round(c * 59) for (d, _), c in got.items()} == {0: 25, 1: 13, 3: 30 + 18}
    bench = spark.createDataFrame([(0, " ".join(w))], "item_id long, text string")
    kept = contamination.drop_contaminated(frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(docs)]), bench, passages=True)
    assert [r["doc_id"] for r in kept.collect()] == [2]
