"""Documents that are hard to get right, shared by the tests of this folder."""

import glob
import os
import random

import pyarrow.parquet as pq

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def hard():
    r = random.Random(5)
    words = [r.choice(["alpha", "beta", "gamma", "delta", "the", "of"]) + str(r.randrange(40)) for _ in range(4000)]
    line = "Subscribe to our newsletter for more."
    out = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two three four five six seven eight nine"),
        (6, " ".join(words)), (7, " ".join(words)), (7, " ".join(words)), (8, " ".join(words[:100])), (9, " ".join(words[:100]) + " tail"),
        (10, "under the MIT license\nUnder The mit License, and apache license: version 2! cc-by-nc cc by nc 4"),
        (11, "x" * 30000), (12, "a@b.c_d@e.fg, foo.bar+1@mail-2.example.com. 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255"),
        (13, "card 4111 1111 1111 1111, 4111-1111-1111-1112 and +1 (415) 555-0100 or +49 30 1; password=abc12345678"),
        (14, "é ü 漢字 😀 under the mit licenseé İ under the mit license 😀 x@y.zz"),
        (15, "a b c d e f g h a b c d e f g h a b c d e f g h"), (16, "dup\ndup\n \ndup \ndup"),
        (17, "#*$%&|<>" * 50), (None, "a row without id " * 8), (18, "9" * 5000 + " " + "1.2." * 2000 + " a." * 3000),
        (19, ("z." * 4000) + "@" + "a." * 4000 + "com"), (20, "  nbsp words\u0085here\x1cand"),
    ]
    out += [(100 + i, f"{line}\n" + " ".join(r.choice(words) for _ in range(60))) for i in range(40)]
    return [(i, t, None if i is None else "en", None if i == 4 else f"s{(i or 0) % 2}", len(t or "")) for i, t in out]


def frame(spark, rows=None):
    return spark.createDataFrame(hard() if rows is None else rows, SCHEMA)


def documents(sf=SF):
    path = f"{sf}/documents.parquet"
    files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for f in files for r in pq.read_table(f).to_pylist()]
