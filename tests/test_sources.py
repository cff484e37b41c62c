import json

import pytest
from conftest import rows

import hourloom as h
from hourloom.operators.logs import run_log_errors, run_log_summary
from hourloom.plans.ingest import ingest_locations
from hourloom.sources import files, paths
from hourloom.specs import LOCATION_JSON, TableSpec, schema_of

SPEC = TableSpec("t", schema_of("id! string, at utc, v double"), ("id", "at"), time_col="at", sort_cols=("id",))


def test_typed_scan_fills_missing_columns(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "id string, other int").write.parquet(str(tmp_path / "p"))
    assert rows(files.read_typed(spark, str(tmp_path / "p" / "*.parquet"), SPEC)) == [("a", None, None)]
    assert rows(files.read_typed(spark, [str(tmp_path / "p")], SPEC.schema), "id") == [("a",)]


def test_concat_parquet_with_differing_columns(spark, tmp_path):
    a, b, out = (str(tmp_path / n) for n in "abo")
    spark.createDataFrame([(1, "x")], "k int, only_a string").write.parquet(a)
    spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, only_b double").write.parquet(b)
    assert files.concat_to(spark, [a, b], out) == out
    assert rows(spark.read.parquet(out), "k", "only_a", "only_b") == [(1, "x", None), (2, None, 5.0), (3, None, 6.0)]
    assert files.concat_to(spark, [], out) is None
    with pytest.raises(ValueError):
        files.concat_files(spark, [a], "xml")


def test_reconciliation(spark, tmp_path):
    df = spark.range(10)
    assert files.write_reconciled(df, str(tmp_path / "r"), expected_rows=10) == 10
    with pytest.raises(ValueError, match="expected 11"):
        files.write_reconciled(df, str(tmp_path / "s"), expected_rows=11)


def test_csv(spark, tmp_path):
    for name, text in (("a", "k,v\n1,x\n2,y\n"), ("b", "k,v\n3,z\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    both = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    out = files.concat_to(spark, both, str(tmp_path / "out"), "csv")
    assert next((tmp_path / "out").glob("*.csv")).read_text().splitlines()[0] == "k,v"
    assert rows(files.concat_files(spark, [out], "csv", "k int, v string")) == [(1, "x"), (2, "y"), (3, "z")]
    (tmp_path / "c.csv").write_text("v,k\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.concat_files(spark, [str(tmp_path / "c.csv")], "csv", "k int, v string").collect()


def test_unreadable_files_are_skipped_on_request(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    both = [good, str(tmp_path / "bad.parquet")]
    assert files.concat_files(spark, both, "parquet", "id bigint", skip_corrupt=True).count() == 3
    assert files.concat_to(spark, both, str(tmp_path / "csv"), "parquet", "csv", "id bigint", skip_corrupt=True)
    with pytest.raises(Exception):
        files.concat_files(spark, both, "parquet", "id bigint").collect()


def test_load_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0)], "id string, at string, v double")
    for _ in range(2):
        files.load_table(df, path, SPEC)
    assert h.read_table(spark, path, SPEC).count() == 2
    files.load_table(df.filter("id = 'a'"), path, SPEC, "append")
    assert rows(h.read_table(spark, path, SPEC), "id") == [("a",), ("a",), ("b",)]
    files.load_table(df.filter("id = 'a'"), path, SPEC, "truncate")
    assert rows(h.read_table(spark, path, SPEC), "id") == [("a",)]
    with pytest.raises(ValueError):
        files.load_table(df, path, SPEC, "merge")


def test_parameters_and_export(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int").createOrReplaceTempView("kv")
    got = files.run_query(spark, "SELECT * FROM kv WHERE array_contains(:ks, k) AND v >= :low", {"ks": ["a", "c"], "low": 2})
    assert rows(got) == [("c", 3)]
    assert files.export_query(spark, "SELECT * FROM kv WHERE v > :low", str(tmp_path / "e"), {"low": 1}) == 2
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2
    assert paths.is_complete(spark, str(tmp_path / "e")) and not paths.exists(spark, str(tmp_path / "none"))


def test_api_page(spark, tmp_path):
    page = {"meta": {"found": 2}, "results": [{"id": 1, "name": "A", "bounds": [1, 2, 3, 4]}, {"id": 2, "locality": " "}]}
    (tmp_path / "page.json").write_text(json.dumps(page, indent=1))
    docs = files.read_json_documents(spark, str(tmp_path / "*.json"), LOCATION_JSON, results="results")
    got = ingest_locations(docs, "2024-01-01 00:00:00")
    assert rows(got, "id", "name", "locality", "bounds_max_lat") == [("1", "A", None, 4.0), ("2", None, None, None)]


def test_run_logs(spark, tmp_path):
    def attempt(status, errors, saved, retries):
        return {"run_id": "r", "status": status, "saved": saved, "retries": retries,
                "errors": [{"run_id": "r", "sensor_id": s, "type": "HTTPError"} for s in errors]}

    good = {"run_id": "r1", "sensors": ["1", "2"], "logs": [attempt("retrying", ["1", "2"], ["f"], 0), attempt("downloaded", [], ["g", "h"], 1)]}
    bad = {"run_id": "r2", "sensors": ["1"], "logs": [attempt("aborted", ["1"], [], 0)]}
    for name, log in (("a", good), ("b", bad)):
        (tmp_path / f"{name}.json").write_text(json.dumps(log, indent=2))
    logs = files.read_run_logs(spark, str(tmp_path / "*.json"))
    assert rows(run_log_summary(logs), "run_id", "sensor_count", "attempts", "errors", "saved", "retries", "status") == [
        ("r1", 2, 2, 2, 3, 1, "downloaded"), ("r2", 1, 1, 1, 0, 0, "aborted")]
    assert rows(run_log_errors(logs), "run_id", "attempt", "sensor_id", "type") == [
        ("r1", 1, "1", "HTTPError"), ("r1", 1, "2", "HTTPError"), ("r2", 1, "1", "HTTPError")]
