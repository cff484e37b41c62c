"""Quarantine, widened columns, buckets, and positions."""

import datetime as dt
import inspect
import os
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

import hourloom as h
from hourloom.operators.merge import _touched, stored_schema
from hourloom.operators.order import number_in_order, number_rows
from hourloom.sources import paths, quarantine
from hourloom.sources.quarantine import concat_widened, inspect_parquet, read_sound, widest
from hourloom.specs import TableSpec, schema_of
from workloads import queries

AT = dt.datetime(2024, 1, 1)
SPEC = TableSpec(
    "things", schema_of("id! string, v long, ingested_at! utc, updated_at! utc, refreshed_at! utc"), keys=("id",), sort_cols=("id",), buckets=8
)


def write(folder, name, n, row_group_size=100, **columns):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table({"v": pa.array(range(n), type=pa.int64()), **columns}), f"{folder}/{name}", row_group_size=row_group_size)


def test_damaged_files_give_no_row(spark, tmp_path):
    folder = str(tmp_path)
    for name in ("a", "cut", "hole", "tail"):
        write(folder, f"{name}.parquet", 1000)
    write(f"{folder}/below", "b.parquet", 10)
    raw = open(f"{folder}/cut.parquet", "rb").read()
    open(f"{folder}/cut.parquet", "wb").write(raw[: len(raw) // 2])
    raw = bytearray(raw)
    third = len(raw) // 3
    raw[third : third + 400] = b"\xff" * 400  # the footer is right, the row groups before the hole are too
    open(f"{folder}/hole.parquet", "wb").write(bytes(raw))
    open(f"{folder}/empty.parquet", "wb").close()
    open(f"{folder}/tail.parquet", "ab").write(b"x")
    good, bad = read_sound(spark, folder, "v long")
    assert good.count() == 1010 and good.columns == ["v"]
    assert {os.path.basename(r["path"]) for r in bad.collect()} == {"cut.parquet", "hole.parquet", "tail.parquet"}
    assert all(r["reason"] for r in bad.collect())
    report = {os.path.basename(r["path"]): r for r in inspect_parquet(spark, folder).collect()}
    assert report["a.parquet"]["n_rows"] == 1000 and report["a.parquet"]["columns"] == '[["v", "bigint"]]'
    large = inspect_parquet(spark, folder, max_bytes=5)
    assert large.filter("reason is null and columns is null").count() == 5  # none is opened


def test_files_of_any_size_are_opened(spark, tmp_path, monkeypatch):
    """Files too large for one value come in pieces, cut anywhere, and are told as they are when handed over whole."""
    folder = str(tmp_path / "in")
    for k in range(3):
        write(folder, f"sound{k}.parquet", 4000 + k, w=pa.array(os.urandom(8) for _ in range(4000 + k)))
    raw = open(f"{folder}/sound0.parquet", "rb").read()
    third = len(raw) // 3
    for name, content in {
        "cut": raw[: 2 * len(raw) // 3], "hole": raw[:third] + b"\xff" * 3000 + raw[third + 3000 :], "tail": raw + b"\n", "ends": b"\n" * 70_000, "crlf": b"a\r\n\r\n" * 9000,
        "marked": b"\xef\xbb\xbf" + raw, "marked_end": b"\xef\xbb\xbf" + raw + b"\n", "noise": os.urandom(80_000), "long": b"x" * 60_000, "small": raw[:50], "packed.gz": raw,
    }.items():
        open(f"{folder}/{name}", "wb").write(content)
    whole = sorted(map(tuple, inspect_parquet(spark, folder).collect()))
    monkeypatch.setattr(quarantine, "WHOLE", 1000)
    assert len(whole) == 14 and sum(r[4] is None for r in whole) == 4  # three sound ones, and one with a name as of packed ones
    changed = {"spark.sql.files.maxPartitionBytes": "5000", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        os.rename(f"{folder}/packed.gz", f"{tmp_path}/packed.gz")  # handed over whole, whatever its size
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")  # no large file as one value
        pieces = sorted(map(tuple, inspect_parquet(spark, folder).collect()))
        assert pieces == [r for r in whole if not r[0].endswith(".gz")]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
        for k, v in before.items():
            spark.conf.set(k, v)
    os.rename(f"{tmp_path}/packed.gz", f"{folder}/packed.gz")
    assert sorted(map(tuple, inspect_parquet(spark, folder).collect())) == whole
    assert inspect.signature(inspect_parquet).parameters["max_bytes"].default is None  # no size from which files aren't opened


def test_large_damaged_files_give_no_row(spark, tmp_path, monkeypatch):
    """A hole behind the first row groups, in a file that is too large for one value."""
    folder = str(tmp_path)
    for name in ("sound", "hole"):
        write(folder, f"{name}.parquet", 1000)
    with open(f"{folder}/hole.parquet", "r+b") as f:
        f.seek(os.path.getsize(f"{folder}/hole.parquet") // 3)
        f.write(b"\xff" * 400)
    monkeypatch.setattr(quarantine, "WHOLE", 1000, raising=False)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        good, bad = read_sound(spark, folder, "v long")
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted(r["v"] for r in good.collect()) == list(range(1000))
    assert [os.path.basename(r["path"]) for r in bad.collect()] == ["hole.parquet"]


def test_files_cut_from_many_parts(spark, tmp_path):
    """Two files of all parts, so that no task has to write half of the rows; each is damaged, wherever the cut falls."""
    for k in range(6):
        write(str(tmp_path / "whole"), f"{k}.parquet", 1000)  # of equal size: two thirds of three parts end with a part
    size = os.path.getsize(tmp_path / "whole" / "0.parquet")
    paths.cut_files(spark, str(tmp_path / "whole"), str(tmp_path / "cut"), 2 / 3, n_files=2)
    assert [os.path.getsize(name.removeprefix("file:")) for name, _, _ in paths.files(spark, str(tmp_path / "cut"))] == [2 * size - 1] * 2
    report = inspect_parquet(spark, str(tmp_path / "cut")).collect()
    assert len(report) == 2 and all(r["reason"].startswith("ArrowInvalid") for r in report)


@pytest.mark.parametrize("cores", [1, 4])
def test_no_task_gets_half_of_the_delivery(spark, tmp_path, cores):
    """Line items in eight row groups are written by as many tasks as read them."""
    source = str(tmp_path)
    n = 8000
    pq.write_table(pa.table({"l_orderkey": pa.array(range(n), type=pa.int64()), "l_returnflag": ["A"] * n, "l_tax": [0.5] * n}), f"{source}/lineitem.parquet", row_group_size=1000)
    pq.write_table(pa.table({"s_suppkey": pa.array(range(10), type=pa.int64()), "s_name": ["s"] * 10, "s_acctbal": [1.0] * 10}), f"{source}/supplier.parquet")
    pq.write_table(pa.table({"n_name": ["n"] * 3}), f"{source}/nation.parquet")
    seen, real = [], paths.cut_files
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        paths.cut_files = lambda spark, path, *more, **named: (seen.append(len(paths.files(spark, path))), real(spark, path, *more, **named))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k" if cores > 1 else "1g")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))
        assert queries.quarantine_rows(spark, source).count() == 10
        assert {(r["place"], r["kind"], r["n_files"]) for r in queries.quarantine_files(spark, source).collect()} == {("cut", "ArrowInvalid", 2), ("text", "ArrowInvalid", 1)}
    finally:
        paths.cut_files = real
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert all(k == 2 for k in seen) if cores == 1 else all(k > 2 for k in seen)


def test_widest():
    assert widest({"int", "bigint"}) == "bigint" and widest({"int", "float"}) == "double" and widest({"date", "timestamp"}) == "timestamp"
    assert widest({"boolean", "int"}) == "string" and widest({"string", "date"}) == "string" and widest({"tinyint"}) == "tinyint"
    assert widest({"<list<item: int64>>", "int"}) is None and widest({"<list<item: int64>>"}) == "<list<item: int64>>"


def test_columns_of_all_kinds_concatenate(spark, tmp_path):
    for name, column in {
        "int": pa.array([1], type=pa.int32()), "text": pa.array(["x"]), "double": pa.array([1.5]), "nothing": None, "list": pa.array([[1, 2]]),
    }.items():
        write(str(tmp_path), f"{name}.parquet", 1, **({"c": column} if column is not None else {}))
    open(f"{tmp_path}/broken.parquet", "w").write("no parquet")
    got, conflicts = concat_widened(spark, str(tmp_path))
    assert sorted(got.dtypes) == [("c", "string"), ("v", "bigint")]
    assert sorted(str(r["c"]) for r in got.collect()) == ["1", "1.5", "None", "[1,2]", "x"]
    told = {os.path.basename(r["path"]): (r["column"], r["read_as"]) for r in conflicts.collect()}
    assert told == {**{f"{n}.parquet": ("c", "string") for n in ("int", "text", "double", "list")}, "broken.parquet": (None, None)}
    os.makedirs(tmp_path / "none")
    open(tmp_path / "none" / "x.parquet", "w").close()
    assert concat_widened(spark, str(tmp_path / "none"))[0] is None


def things(spark, pairs, at=AT):
    return spark.createDataFrame([(i, v, at, at, at) for i, v in pairs], SPEC.schema)


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    plain = replace(SPEC, buckets=None)
    first = [(f"k{i}", i) for i in range(200)]
    second = [("k3", 30), ("new", 1)]
    for spec, place in ((SPEC, path), (plain, f"{path}-plain")):
        for n, batch in enumerate((first, second)):
            h.upsert_table(spark, place, things(spark, batch, AT + dt.timedelta(days=n)), spec)
            if spec is SPEC and not n:
                before = {f: os.stat(f).st_mtime_ns for d, _, names in os.walk(path) for f in (os.path.join(d, x) for x in names) if "part-" in f and not f.endswith(".crc")}
    assert rows(h.read_table(spark, path, SPEC), *SPEC.columns) == rows(h.read_table(spark, f"{path}-plain", plain), *SPEC.columns)
    after = {f for d, _, names in os.walk(path) for f in (os.path.join(d, x) for x in names)}
    kept = {f.split("bucket=")[1].split("/")[0] for f in before if f in after}
    assert len(kept) >= 6  # of eight buckets two keys touch two
    target = spark.read.schema(stored_schema(SPEC)).parquet(path)
    text = _touched(target, things(spark, second), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "bucket" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_buckets_of_null_keys_and_loads(spark, tmp_path):
    spec = replace(SPEC, schema=schema_of("id string, v long, ingested_at! utc, updated_at! utc, refreshed_at! utc"))
    path = str(tmp_path / "t")
    h.load_table(spark.createDataFrame([("a", 1, AT, AT, AT), (None, 2, AT, AT, AT)], spec.schema), path, spec)
    h.upsert_table(spark, path, spark.createDataFrame([("a", 5, AT, AT, AT), (None, 2, AT, AT, AT)], spec.schema), spec)
    assert rows(h.read_table(spark, path, spec), "id", "v") == [("a", 5), (None, 2), (None, 2)]


@pytest.mark.parametrize("partitions", [None, 7])
def test_positions(spark, partitions):
    df = spark.range(0, 5000, 1, 5).select((F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("x"), "id").withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = sorted((r["g"] is not None, r["g"] or 0, r["position"], r["x"]) for r in number_rows(df, ("x",), ("g",), partitions=partitions).collect())
    for g in (None, 1, 2):
        own = [x for _, a, _, x in sorted(r for r in got if r[0] == (g is not None) and r[1] == (g or 0))]
        assert own == sorted(own)
        assert [p for k, a, p, _ in got if k == (g is not None) and a == (g or 0)] == list(range(1, len(own) + 1))
    whole = number_in_order(df.orderBy(F.col("x").desc(), "id"))
    assert [(r["x"], r["id"]) for r in whole.orderBy("position").collect()] == [(r["x"], r["id"]) for r in df.orderBy(F.col("x").desc(), "id").collect()]
    assert "SinglePartition" not in whole._jdf.queryExecution().executedPlan().toString()
    assert number_rows(df.filter("id < 0"), ("x",)).count() == 0
