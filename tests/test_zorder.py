import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourloom.operators.filters import in_bbox
from hourloom.operators.zorder import CELL, cell_ranges, in_bbox_by_cell, sorted_by_cell, with_cell

GRID = dict(extent=(0.0, 0.0, 1.0, 1.0), bits=8)


def test_ranges_hold_the_box_and_little_else(spark):
    r = random.Random(1)
    df = with_cell(spark.range(5000).select(F.rand(3).alias("x"), F.rand(4).alias("y")), "x", "y", **GRID).cache()
    places = [tuple(p) for p in df.collect()]
    for most in (4, 32, 200):
        for _ in range(20):
            (x1, x2), (y1, y2) = sorted((r.random(), r.random())), sorted((r.random(), r.random()))
            ranges = cell_ranges(x1, y1, x2, y2, most=most, **GRID)
            assert 0 < len(ranges) <= most and all(a <= b for a, b in ranges)
            held = [(x, y) for x, y, c in places if any(a <= c <= b for a, b in ranges)]
            inside = [(x, y) for x, y, _ in places if x1 <= x <= x2 and y1 <= y <= y2]
            assert set(inside) <= set(held)
            if most == 200:
                assert len(held) <= 1.5 * len(inside) + 150
    assert cell_ranges(0.5, 0.5, 0.4, 0.6, **GRID) == []
    assert cell_ranges(0.0, 0.0, 1.0, 1.0, **GRID) == [(0, (1 << 16) - 1)]


@pytest.mark.parametrize("box", [(0.2, 0.3, 0.25, 0.4), (0.0, 0.0, 1.0, 1.0), (-5.0, 0.9, 0.1, 7.0), (0.6, 0.6, 0.5, 0.7), (2.0, 2.0, 3.0, 3.0)])
def test_equals_the_plain_filter(spark, box):
    df = spark.range(3000).select("id", (F.rand(5) * 1.2 - 0.1).alias("x"), (F.rand(6) * 1.2 - 0.1).alias("y"))
    df = df.union(spark.createDataFrame([(-1, None, 0.5), (-2, 0.2, 0.3), (-3, 0.25, 0.4), (-4, float("nan"), 0.5)], "id long, x double, y double"))
    got = in_bbox_by_cell(with_cell(df, "x", "y", **GRID), "x", "y", *box, **GRID)
    assert rows(got, "id") == rows(in_bbox(df, "x", "y", *box), "id")


def test_ranges_reach_the_scan_and_skip_row_groups(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 4).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    path = str(tmp_path / "t")
    sorted_by_cell(df, "x", "y", **GRID).write.option("parquet.block.size", 64 * 1024).option("parquet.page.size", 8 * 1024).parquet(path)
    found = in_bbox_by_cell(spark.read.parquet(path), "x", "y", 0.3, 0.3, 0.32, 0.33, **GRID)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({CELL}" in text.replace(" ", "").split("PushedFilters")[1]
    read = []
    for frame in (spark.read.parquet(path), found):
        plan = frame._jdf.queryExecution().executedPlan()
        frame._jdf.queryExecution().toRdd().count()
        nodes = [plan]
        while nodes:
            node = nodes.pop()
            node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node
            if node.nodeName().startswith("Scan parquet"):
                read.append(node.metrics().apply("numOutputRows").value())
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert len(read) == 2 and read[1] < 0.2 * read[0]
    assert rows(found, "id") == rows(in_bbox(spark.read.parquet(path), "x", "y", 0.3, 0.3, 0.32, 0.33), "id")
