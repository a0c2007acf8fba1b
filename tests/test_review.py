"""The review plan on a small drawing."""

from tessella.plans.review import add_provenance, review


def test_review(spark):
    path = "array<struct<x:int,y:int>>"
    nodes = spark.createDataFrame([("A", "equipment", "V-1", 0), ("A", "valves", "X-9", 1), ("B", "valves", None, 2)], "id string, kind string, tag string, ord int")
    lines = spark.createDataFrame([("L1", "process", "A", "NOPE", [], [(500, 500)]), ("L2", "signal", None, "A", ["GONE"], [(5, 500), (9, 9)])], f"id string, kind string, source string, target string, inline array<string>, path {path}")
    words = spark.createDataFrame([(0, "v-1")], "ord int, text string")
    out = review(nodes, lines, words)
    assert {(r.error_type, r.found) for r in out["report"].collect()} == {("DUPLICATE_ID", 1), ("DANGLING_REF", 2), ("SEAM_BREAK", 1), ("ORPHAN_NODE", 1), ("UNGROUNDED_TAG", 1)}
    assert sorted(r.id for r in out["nodes"].collect()) == ["A", "A_1", "B"]
    assert {r.id: r.seam_break for r in out["lines"].collect()} == {"L1": False, "L2": True}
    assert add_provenance(nodes, "m", "x").head().provenance.model == "m"
