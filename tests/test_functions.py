"""Scalar functions, tile grid and small formats."""

import pytest
from pyspark.sql import functions as F

from tessella.functions import css as C
from tessella.functions import geometry as G
from tessella.functions import text as X
from tessella.operators import documents, spatial


@pytest.mark.parametrize("text, kind", [("TIC-101", "instrument_tag"), ("TK-100", "instrument_tag"), ("V-50", "valve_tag"), ('4"-PA-001', "label"), ("1.5-SS-100", "line_number"), ("4\"PA-001", "line_number"), ("E-186", "equipment_tag"), ("150 psi", "measurement"), ("12 INLET", "measurement"), ("50%", "measurement"), ("x", "label"), (None, "label")])
def test_classify(spark, text, kind):
    assert spark.createDataFrame([(text,)], "t string").select(X.classify_tag(F.col("t")).alias("k")).head().k == kind


def test_golden_grid(spark):
    """A page of 3394 x 3031 in tiles of 2048 with a tenth of overlap."""
    got = spatial.tile_grid(spark.createDataFrame([(1, 3394, 3031, 2048)], "page long, width int, height int, most int"))
    rows = {(r.row, r.col): (r.px1, r.py1, r.px2, r.py2, r.nx1, r.ny1, r.nx2, r.ny2) for r in got.collect()}
    assert rows == {(0, 0): (0, 0, 1866, 1667, 0, 0, 549, 549), (0, 1): (1528, 0, 3394, 1667, 450, 0, 1000, 549), (1, 0): (0, 1365, 1866, 3031, 0, 450, 549, 1000), (1, 1): (1528, 1365, 3394, 3031, 450, 450, 1000, 1000)}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head().x


def test_text_helpers(spark):
    lit = F.lit
    assert one(spark, X.same_place_share(lit("V-100"), lit("V-101"))) == 0.8
    assert one(spark, X.last_capture(lit("<a>1</a> <a> 2\n</a>"), "a")) == "2"
    assert one(spark, X.parse_pairs(F.array(lit("a: b:c"), lit("bad"), lit("a:d")), ":")) == {"a": "d"}
    assert one(spark, X.resolve_target(lit("ppt/slides"), lit("../media/./a.png"))) == "ppt/media/a.png"
    assert one(spark, X.resolve_target(lit("ppt"), lit("/word/b.xml"))) == "word/b.xml"
    assert one(spark, X.greedy_wrap(lit("aa bbb  c dddd"), 6)) == ["aa bbb", "c dddd"]
    assert one(spark, X.exact_score(lit(None).cast("string"), lit("a"))) == 0
    assert one(spark, X.title_case(lit("my-new-skill"))) == "My New Skill"
    assert one(spark, X.relationship_type(lit("headerReference"))) == "header"
    assert one(spark, X.relationship_type(lit("sldId"))) == "slide"
    assert one(spark, X.strip_templates(lit("a{{x}}b"))) == "ab"


def test_css(spark):
    lit = F.lit
    assert one(spark, C.rgb_to_hex(lit("rgb(1, 16, 255)"))) == "0110ff"
    assert one(spark, C.rgb_to_hex(lit("transparent"))) == "FFFFFF"
    assert one(spark, C.transparency(lit("rgba(1, 2, 3, 0.25)"))) == 75
    assert one(spark, C.rotation(lit("rotate(-45deg)"), lit("horizontal-tb"))) == 315
    assert one(spark, C.shadow(lit("rgba(0, 0, 0, 0.3) 2px 2px 8px 0px"))).angle == 45
    assert one(spark, C.shadow(lit("none"))) is None
    assert tuple(one(spark, C.hex_to_rgb(lit("FF0010")))) == (255, 0, 16)


def test_paths(spark):
    p = "array<struct<x:int,y:int>>"
    df = spark.createDataFrame([([(0, 0), (100, 0)], [(0, 30), (100, 30)], []), ([(0, 0), (10, 10), (10, 50)], [(0, 400)], [])], f"a {p}, b {p}, e {p}")
    got = df.select(G.path_similarity(F.col("a"), F.col("b")).alias("s"), G.path_similarity(F.col("a"), F.col("e")).alias("z"), G.skewed_segments(F.col("a")).alias("k"), G.skewed_segments(F.col("e")).alias("ke")).collect()
    assert got[0].s == pytest.approx(0.7) and got[1].s == 0 and got[0].z == 0
    assert got[0].k == [] and [(r.pos, r.angle) for r in got[1].k] == [(0, 45.0)] and got[0].ke == []


def test_row_bands_anchor_at_the_first_shape(spark):
    shapes = spark.createDataFrame([(1, 1, 0.0, 3.0), (2, 1, 0.4, 1.0), (3, 1, 0.8, 0.0), (4, 1, 0.5, 2.0)], "id long, slide int, top double, left double")
    assert [r.id for r in documents.row_bands(shapes, ["slide"]).orderBy("position").collect()] == [2, 4, 1, 3]
