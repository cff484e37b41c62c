"""Sharding and URL filters."""

import collections
import zlib

import numpy as np
import pytest
from llm_cases import documents, frame, hard
from pyspark.sql import functions as F

from hourloom.llm import sharding, url_filters


@pytest.mark.parametrize("options", [{}, {"fine": 1, "bundles": 4, "cell_rows": 3}])
def test_shards(spark, options):
    rows = hard() + documents()
    df = frame(spark, rows).withColumn("shard", F.lit("x")).withColumn("size", F.lit(1))
    got = sharding.shards(df, **options).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    home = collections.defaultdict(set)
    slots, load = collections.defaultdict(list), collections.Counter()
    for r in got:
        home[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(x) == 1 for x in home.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(16))
    group = collections.Counter()
    for _, size, crc in want:
        group[crc, size] += size
    assert max(load.values()) <= sum(load.values()) / 16 + max(group.values()) * (1 if not options else 5)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_schedule_is_longest_first():
    assert sharding.schedule([("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", 3)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharding.schedule([], 3) == {}


def test_no_documents(spark):
    assert sharding.shards(frame(spark, [])).count() == 0


URLS = [
    "https://a.example.net/en/1", "https://example.net/de/1", "http://NET/x", "http://net", "http://x.org/fr/", "http://x.org/de/", "http://badexample.com/de/",
    "http://Example.COM/de/?q", "http://m.example.com/DE/", None, "", "no scheme", "x://", "a://b://c", "http://ads.shop.com/x", "http://lads.shop.com/x",
    "http://ads-track.example.org/fr/1", "http://ads-track.example.org/en/1", "http://é.net?x", "http://h#f/de/", "http://h/a\nb?c", "http://ads.shop.com/x",
]


def plain(url):
    host, _, rest = (url or "").partition("://")
    if "://" not in (url or ""):
        return "", "", None, "allow"
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [r for r in url_filters.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        r = max(fit, key=lambda r: len(r.name))
        return host, path, r.name, r.verdict
    return host, path, None, "block" if host in ("ads.shop.com", "ads-track.example.org") else "allow"


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "h")], "page_id long, url string, host string")
    got = [tuple(r) for r in url_filters.judge(df).collect()]
    want = [(i, *plain(u)) for i, u in enumerate(URLS)] + [(None, *plain(URLS[0]))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert url_filters.judge(df.limit(0)).count() == 0


def test_given_list(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.com/") for i in range(3000)], "page_id long, url string")
    listed = spark.createDataFrame([(f"H{i}.com",) for i in range(0, 3000, 7)] + [("elsewhere.com",), ("h0.com",)], "host string")
    got = {r["page_id"] for r in url_filters.judge(df, listed, rules=()).filter("verdict = 'block'").collect()}
    assert got == set(range(0, 3000, 7))
    assert url_filters.judge(df, listed.limit(0), rules=()).filter("verdict = 'block'").count() == 0


def test_cascade_is_exact_with_several_levels(spark):
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).alias("listed"))
    c = url_filters.cascade(keys, "k", "listed", rate=0.3)
    assert len(c.levels) > 3 and c.size < 40000
    rows = keys.select(*url_filters.key_hashes(F.col("k")), "listed").toPandas()
    assert (c.has(rows["one"].to_numpy(np.int64), rows["two"].to_numpy(np.int64)) == rows["listed"].to_numpy()).all()
    assert url_filters.cascade(keys, "k", "listed", max_bytes=10) is None


def test_list_beyond_the_bound_is_joined(spark, monkeypatch):
    df = spark.createDataFrame([(0, "http://a.com/"), (1, "http://b.com/")], "page_id long, url string")
    listed = spark.createDataFrame([("b.com",)], "host string")
    monkeypatch.setattr(url_filters, "cascade", lambda *a: None)
    assert {r["page_id"]: r["verdict"] for r in url_filters.judge(df, listed).collect()} == {0: "allow", 1: "block"}
