"""Language identification and packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import SF, documents, frame, hard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourloom.llm import language_id, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_languages(spark):
    rows = documents() + [(10_000 + (r[0] or 0), *r[1:2], None, *r[3:]) for r in hard()]
    df = frame(spark, rows).withColumn("score", F.lit("x")).withColumn("held_out", F.lit("x"))
    got = language_id.identify(df).collect()
    assert len(got) == len(rows)
    lang = {r[0]: (r[1], r[2]) for r in rows}
    right = []
    for r in got:
        text, true = lang[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        has = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] == "und") == (not has)
        if true and r["held_out"]:
            right.append(r["lang_pred"] == true)
    assert np.mean(right) > 0.95


def test_languages_without_labels(spark):
    rows = [(i, "some text", None, "s", 0) for i in range(9)]
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(frame(spark, rows)).collect()} == {("und", 0.0)}
    assert language_id.identify(frame(spark, [])).count() == 0
    one = [(i, "some text", "xx", "s", 0) for i in range(20)]
    assert {r["lang_pred"] for r in language_id.identify(frame(spark, one)).collect()} == {"xx"}


def test_sample_is_that_of_any_order(spark):
    words = F.when(F.col("id") < 6000, F.concat(F.lit("the quick fox "), F.col("id"))).otherwise(F.concat(F.lit("der faule Hund "), F.col("id")))
    df = spark.range(12_000).select(F.col("id").alias("doc_id"), words.alias("text"), F.when(F.col("id") < 6000, "en").otherwise("de").alias("lang"))
    few = df.filter("doc_id >= 5990 and doc_id < 6000 or doc_id >= 6000")
    for rows in (df, few):
        models = [language_id.fit(rows.repartitionByRange(4, by), per_language=2) for by in (F.col("doc_id"), F.col("doc_id").desc())]
        assert models[0].languages == ("de", "en") and (models[0].weights == models[1].weights).all() and (models[0].idf == models[1].idf).all()
        assert models[0].temperature == models[1].temperature
        assert models[0].predict("the quick fox")[0] == "en" and models[0].predict("der faule Hund")[0] == "de"
    copies = df.union(df.filter("doc_id = 1").crossJoin(spark.range(500)).drop("id"))
    assert (language_id.fit(copies, per_language=2).weights != 0).any()


def test_rejects(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    odd = df.limit(2).withColumn("text", F.lit("123 !!"))
    kept = language_id.keep_known(df.unionByName(odd))
    assert kept.columns == df.columns and kept.filter("text = '123 !!'").count() == 0
    assert kept.count() > 0.9 * df.count()


def test_sparse_and_calibrated():
    r = np.random.default_rng(1)
    width = (1 << language_id.BITS) + 1
    sample = [(np.sort(r.choice(50, 10, replace=False)) + 100 * y, np.ones(10), y) for y in r.integers(0, 2, 200)]
    model = language_id.Model(("a", "b"), np.ones(width - 1), np.zeros((2, width)))
    fitted = language_id.calibrate(language_id.train(model, sample[:150], l1=0.05), sample[150:])
    assert 0 < fitted.nonzero < 250
    assert all(fitted.logits(at, c).argmax() == y for at, c, y in sample[150:])


def test_long_text_in_blocks(monkeypatch):
    text = "Äpfel und Birnen, " * 500
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "BLOCK", 1000)
    assert abs(language_id.gram_counts(text).sum() - whole.sum()) < 0.02 * whole.sum()


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_pieces_are_those_of_the_tokenizer(tokenizer, ranks):
    r = random.Random(3)
    alphabet = ["'", "s", "t", "re", "ll", "d", "l", " ", "  ", "\n", "\t", "\u00a0", "é", "ß", "1", "²", "½", "9", ".", "!", "?", ",", "-", "x", "Don't", "'S", "\x1c", "\x85", "ª", "µ", "<|endoftext|>"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 40))) for _ in range(4000)] + ["", "漢字 is here. ok?\n", "😀's", "e\u0301 'a", " '", "a'", "'s"]
    coder = packing.Pieces(PATH, ranks, most=50)
    for texts_ in (texts[:2000], texts[2000:], texts[-5:]):
        ids, heads, sentences = coder.documents(texts_)
        for i, t in enumerate(texts_):
            assert ids[heads[i] : heads[i + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0], repr(t)
        assert (sentences > 0).all() and (sentences <= len(ids)).all()


def brute(at, penalty, width):
    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            if at[j] - at[i] <= width:
                best[j] = min(best[j], best[i] + (0 if j == len(at) - 1 else width - (at[j] - at[i]) + penalty[j]))
    return best[-1]


def test_cuts_are_optimal():
    r = np.random.default_rng(2)
    for _ in range(200):
        at = np.concatenate([[0], np.cumsum(r.integers(1, 12, r.integers(1, 40)))])
        penalty = r.choice([0, 3, 9], len(at))
        cuts = packing.best_cuts(at, penalty, 12)
        assert cuts[0] == 0 and cuts[-1] == len(at) - 1 and (np.diff(at[cuts]) <= 12).all()
        cost = sum(12 - d + p for d, p in zip(np.diff(at[cuts])[:-1], penalty[cuts[1:-1]], strict=True))
        assert cost == brute(at.tolist(), penalty.tolist(), 12)


def check(rows, got, tokenizer, loss):
    want = sorted(((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for i, t, *_ in rows), key=lambda x: repr(x[0]))
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    total = sum(len(ids) for _, ids in want)
    assert sum(r["length"] for r in got) == total
    assert padding <= loss * total, padding / total
    pieces = sorted(x for parts in by_doc.values() for x in parts)
    expected = []
    for i, ids in want:
        starts = sorted({(s, n) for s, n, *_ in by_doc[i]})
        if len({x[0] for x in want if x[0] == i}) == 1 and sum(x[0] == i for x in want) == 1:
            assert [s for s, _ in starts] == np.cumsum([0, *[n for _, n in starts]])[:-1].tolist()
            expected += [(s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids)) for s, n in starts]
        else:
            expected += [(s, n, c, k) for s, n, c, k in by_doc[i] if c == zlib.crc32(ids[s : s + n].tobytes()) and k == len(ids)]
    assert sorted(set(expected)) == sorted(set(pieces))


def test_packing(spark, tokenizer):
    rows = hard() + [(1000 + i, *r) for i, *r in documents()]
    df = frame(spark, rows).withColumn("start", F.lit("x")).withColumn("length", F.lit(0)).coalesce(1)
    check(rows, packing.pack(df, PATH, RANKS).collect(), tokenizer, 0.01)
    check(rows, packing.pack(df, PATH, block_tokens=5000).collect(), tokenizer, 0.02)
    assert packing.pack(frame(spark, []), PATH).count() == 0


def test_packed_ids(spark, tokenizer):
    rows = [(i, f"Sentence {i} of it. And one more!", "en", "s", 0) for i in range(50)]
    for r in packing.pack(frame(spark, rows), PATH, with_ids=True).collect():
        ids = [*tokenizer.encode(rows[r["doc_id"]][1]).ids, 0]
        assert r["ids"] == ids[r["start"] : r["start"] + r["length"]]
