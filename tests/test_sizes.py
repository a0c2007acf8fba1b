"""What keeps queries within time and driver memory on large tables: dealt rows, joins without broadcasts, crowds that are not paired."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tessella import catalogue, catalogue_decks
from tessella.operators import dedup, documents, spatial

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@tables
@pytest.mark.parametrize("rows", ["_slides", "_documents", "q_html_runs"])
def test_derived_texts_are_dealt(spark, rows):
    assert getattr(catalogue_decks, rows)(spark, SF).rdd.getNumPartitions() > 1


@tables
@pytest.mark.parametrize("name", ["q_endpoint_adjacency", "q_label_propagation", "q_density_clusters", "q_line_dedup", "q_shape_overlaps", "q_shape_issues", "q_slide_shapes"])
def test_no_broadcast_of_derived_rows(spark, name):
    assert "Broadcast" not in catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_nearest_of_crowds(spark):
    rng = random.Random(3)
    place = lambda: (rng.randrange(400), rng.randrange(400))
    left = [(k, *p) for k, p in enumerate([*(place() for _ in range(60)), *[(7, 7)] * 2000])]
    right = [(k, k, *p) for k, p in enumerate([*(place() for _ in range(60)), *[(8, 7)] * 2000, *[(7, 8)] * 2000])]
    got = spatial.nearest(spark.createDataFrame(left, "l long, x long, y long"), spark.createDataFrame(right, "r long, ord long, x long, y long"), 100)
    marks = {(x, y): k for k, _, x, y in reversed(right)}
    expected = {}
    for k, x, y in left:
        d2, r = min(((x - u) ** 2 + (y - v) ** 2, o) for (u, v), o in marks.items())
        if d2 <= 10_000:
            expected[k] = (r, round(d2**0.5, 2))
    assert {row.l: (row.r, row.distance) for row in got.collect()} == expected


def test_ocr_crowds(spark):
    box, other, flat = (0, 0, 10, 10), (0, 0, 10, 9), (5, 5, 5, 9)
    rows = [*[(k, "w", box, 0.5) for k in range(2000)], (2000, "W", other, 0.9), (2001, None, box, 0.5), (2002, None, box, 0.5), (2003, "w", flat, 0.5), (2004, "w", flat, 0.5), (2005, "w", None, 0.5), (2006, "w", None, 0.5)]
    df = spark.createDataFrame(rows, "ord long, text string, box struct<y1:int,x1:int,y2:int,x2:int>, confidence double")
    out = dedup.ocr_dedup(df)
    assert out.columns == [*df.columns, "kept"]
    assert sorted(r.ord for r in out.filter("kept").collect()) == list(range(2000, 2007))
    # Without the surer box, one of the equal ones stays, the first.
    assert out.count() == len(rows) and sorted(r.ord for r in dedup.ocr_dedup(df.filter(F.col("ord") != 2000)).filter("kept").collect()) == [0, *range(2001, 2007)]


def test_overlaps_of_crowds(spark):
    boxes = [(0.0, 0.0, 2.0, 3.0), (1.0, 1.5, 3.0, 4.0), (1.0, 2.96, 9.0, 9.0), (2.0, 2.0, 2.0, 8.0), None]
    rows = [*((s, k, boxes[k % 5]) for s in ("a", "b", None) for k in range(200)), ("a", None, boxes[0]), ("a", 5, boxes[0]), ("a", 6, boxes[0])]
    df = spark.createDataFrame(rows, "slide string, id long, box struct<y1:double,x1:double,y2:double,x2:double>")

    def area(a, b):
        wide, high = min(a[3], b[3]) - max(a[1], b[1]), min(a[2], b[2]) - max(a[0], b[0])
        return round(wide * high, 2) if wide > 0.05 and high > 0.05 else None

    whole = [r for r in rows if None not in r]
    expected = sorted((s, i, j, area(a, b)) for s, i, a in whole for t, j, b in whole if s == t and i != j and area(a, b))
    got = documents.shape_overlaps(df)
    assert sorted(map(tuple, got.collect())) == expected == sorted(map(tuple, documents.shape_overlaps(df, most=7).collect()))
    # Pairs of boxes leave the join, not pairs of shapes.
    node = got._jdf.queryExecution().executedPlan().executedPlan()
    while node.nodeName() != "SortMergeJoin":
        node = node.plan() if node.children().isEmpty() else node.children().apply(0)
    assert node.metrics().apply("numOutputRows").value() <= 32 < len(expected) / 500
