"""The consolidation plan on small drawings: ties, references, generated ids, several drawings, sinks."""

import json

import pytest
from pyspark.sql import functions as F

from tessella.operators import decks, graph, integrity, ocr
from tessella.plans import merge as M
from tessella.sources import extractions as S
from tessella.sources import packages as P
from tessella.sources import sinks


def node(i=None, tag=None, box=(0, 0, 100, 100), **more):
    return {k: v for k, v in ({"id": i, "tag": tag, "bbox": list(box) if box else None, "confidence": 0.9} | more).items() if v is not None}


def merged(spark, tmp_path, *files, tiles=None, **options):
    paths = []
    for k, (name, f) in enumerate(files):
        (tmp_path / f"d{k}").mkdir()
        (tmp_path / f"d{k}" / name).write_text(json.dumps(f))
        paths.append(str(tmp_path / f"d{k}" / name))
    table = spark.createDataFrame(tiles or [], "drawing string, file string, x1 int, y1 int, x2 int, y2 int")
    return M.merge(S.read_extractions(spark, [*paths, str(tmp_path / "none.json")]), table, **options)


def ids(rows):
    return sorted(r.id for r in rows.collect())


def equipment(*nodes):
    return {"nodes": {"equipment": list(nodes)}}


CASES = {
    0.5: [
        ([node("E1", "P-1"), node("E2", "P-2")], ["E1", "E2"]),  # different tags never merge
        ([node("E1", "P-1", confidence=0.5), node("E2", "P-1")], ["E2"]),  # one tag: the surest stays
        ([node("E1", "P-1"), node("E2", "P-1", (500, 500, 600, 600), confidence=0.5)], ["E1", "E2_dup"]),  # far apart
        ([node("E1", "T", None), node("E2", "T", None)], ["E1"]),  # without boxes the rest of a group goes
    ],
    0.95: [
        ([node("E1"), node("E2", None, (0, 0, 100, 64))], ["E1"]),
        ([node("E1", "A"), node("E2", "A", (0, 0, 100, 64)), node("E3", None, (0, 80, 100, 180))], ["E1", "E3"]),
        ([node(f"E{k}") for k in range(6)], ["E0"]),  # equal boxes of equal confidence: the first stays
        ([node(confidence=0.4), node(confidence=0.8)], ["EQ-001"]),
    ],
}


@pytest.mark.parametrize("threshold", list(CASES))
def test_which_nodes_stay(spark, tmp_path, threshold):
    """Each case is a drawing of one run."""
    drawings = None
    for k, (nodes, _) in enumerate(CASES[threshold]):
        (tmp_path / f"{k}.json").write_text(json.dumps(equipment(*nodes)))
        one = S.read_extractions(spark, [str(tmp_path / f"{k}.json")], str(k))
        drawings = one if drawings is None else drawings.unionByName(one)
    tiles = spark.createDataFrame([], "drawing string, file string, x1 int, y1 int, x2 int, y2 int")
    got = {}
    for r in M.merge(drawings, tiles, threshold=threshold)["nodes"].collect():
        got.setdefault(int(r.drawing), []).append(r.id)
    assert {k: sorted(v) for k, v in got.items()} == {k: kept for k, (_, kept) in enumerate(CASES[threshold])}


def test_audit_names_both_sides(spark, tmp_path):
    out = merged(spark, tmp_path, ("a.json", equipment(node("E1", "P-1"), node("E2", "P-1", confidence=0.1), node("E3", confidence=0.2))), threshold=0.5)
    assert sorted((r.action, r.kept_name, r.dropped_name, r.overlap) for r in out["audit"].collect()) == [("merged_duplicate", "P-1", "P-1", 1.0), ("spatial_dedup", "P-1", "E3", 1.0)]


def test_references_ids_and_checks(spark, tmp_path):
    far = lambda k: (k, k, k + 50, k + 50)
    drawing = {
        "source_image": "x.png", "metadata": {"title": "t"}, "nodes": {
            "equipment": [node("EQ-1", "P-1", far(0), connections={"inlet_from": ["", "NOPE"], "outlet_to": ["V-1"]}, interlocks=["IL-1", "IL-9"]), node(None, "P-2", far(200)), node(None, "P-3", far(300))],
            "instruments": [node("I-1", "TIC-1", far(400), connected_to="U-1")], "valves": [node("VL-1", "V-1", far(500), upstream="P-1", downstream="Q", controlled_by="L-1")]},
        "edges": {"process_lines": [{"id": "LN-1", "source": {"node_id": "OUT", "type": "OffPage"}, "target": {"node_id": "GONE"}, "inline_components": ["VL-1", "VX"], "route_waypoints": [[0, 0], [30, 40], [30, 90]]}],
                  "signal_lines": [{"source": {"instrument_id": "I-1"}, "target": {"instrument_id": "I-7"}, "loop_id": "L-2", "route_waypoints": [[700, 700], [800, 700]]}]},
        "utilities": [{"id": "U-1", "type": "air", "position": {"x": 10, "y": 20}, "connected_to": "P-9"}, {"id": "U-1", "type": "again"}],
        "control_loops": [{"loop_id": "L-1", "instruments": ["I-1", "I-8"]}],
        "process_logic": {"flow_sequences": [{"sequence_id": "S-1", "nodes": ["EQ-1", "E-8"]}], "control_relationships": [{"loop_id": "L-1", "sensor": "I-1", "controller": "C-8"}], "interlocks": [{"interlock_id": "IL-1", "trigger_instrument": "T-8", "affected_equipment": ["EQ-1", "A-8"]}]},
        "legend": {"symbols": [{"symbol_id": "a", "description": "1"}, {"symbol_id": "a", "description": "2"}, {"description": "n"}]},
    }
    out = merged(spark, tmp_path, ("a.json", drawing))
    missing = {(r.phase, r.source_id, r.field, r.missing_reference) for r in out["unresolved"].collect()}
    assert missing == {
        (1, "EQ-1", "connections.inlet_from", "NOPE"), (1, "EQ-1", "interlocks", "IL-9"), (3, "VL-1", "downstream", "Q"), (4, "LN-1", "target.node_id", "GONE"), (4, "LN-1", "inline_components", "VX"),
        (4, "SIG-001", "target.instrument_id", "I-7"), (4, "SIG-001", "loop_id", "L-2"), (4, "U-1", "connected_to", "P-9"), (2, "L-1", "control_loops.instruments", "I-8"), (5, "L-1", "control_relationships.controller", "C-8"),
        (5, "S-1", "flow_sequences.nodes", "E-8"), (5, "IL-1", "interlocks.trigger_instrument", "T-8"), (5, "IL-1", "interlocks.affected_equipment", "A-8"),
    }
    assert ids(out["nodes"].filter("kind = 'equipment'")) == ["EQ-001", "EQ-002", "EQ-1"] and ids(out["utilities"]) == ["U-1"]
    assert ids(out["orphans"]) == ["EQ-001", "EQ-002"] and [r.loop_id for r in out["incomplete_loops"].collect()] == ["L-1"]
    assert [(r.line_id, r.pos, r.angle) for r in out["skewed"].collect()] == [("LN-1", 0, 53.1)]
    assert [tuple(r) for r in out["validation"].collect()] == [("drawing", 13, 2, 1, 1, False)]
    assert sorted(r.description for r in out["symbols"].collect()) == ["1", "n"]
    document = sinks.merged_documents(out).head().document
    assert document.source_image == "x.png" and document.metadata.title == "t" and len(document.nodes.equipment) == 3 and len(document.validation.unresolved) == 13 and document.edges.signal_lines[0].id == "SIG-001"


def test_files_of_one_name_and_drawings_stay_apart(spark, tmp_path):
    out = merged(spark, tmp_path, ("a.json", equipment(node("A", "P-1"))), ("a.json", equipment(node("B", "P-2", (200, 200, 300, 300)))), tiles=[("drawing", "a.json", 0, 0, 500, 500)])
    assert {r.id: tuple(r.box) for r in out["nodes"].collect()} == {"A": (0, 0, 50, 50), "B": (100, 100, 150, 150)}
    two = S.read_extractions(spark, [str(tmp_path / "d0" / "a.json")], "one").unionByName(S.read_extractions(spark, [str(tmp_path / "d0" / "a.json")], "two"))
    tiles = spark.createDataFrame([("one", "a.json", 0, 0, 500, 500)], "drawing string, file string, x1 int, y1 int, x2 int, y2 int")
    assert {(r.drawing, r.id, r.box.x2) for r in M.merge(two, tiles)["nodes"].collect()} == {("one", "A", 50), ("two", "A", 100)}
    assert M.merge(S.read_extractions(spark, [str(tmp_path / "none.json")]), tiles)["nodes"].count() == 0


def test_grounding_marks_nodes(spark, tmp_path):
    out = merged(spark, tmp_path, ("a.json", equipment(node("A", "P-101"), node("B", "P-9", (300, 300, 400, 400)))))
    words = spark.createDataFrame([("drawing", 0, "p-102", "equipment_tag"), ("drawing", 1, "TIC-7", "instrument_tag"), ("other", 2, "P-9", "equipment_tag")], "drawing string, ord long, text string, type string")
    done = M.ground(out, words)
    assert {r.id: (r.ocr_validated, r.ocr_match) for r in done["nodes"].collect()} == {"A": (True, "fuzzy"), "B": (False, "none")}
    assert sorted((r.drawing, r.word) for r in done["ocr_only"].collect()) == [("drawing", "TIC-7"), ("other", "P-9")]


def test_renames_walk_colliding_ids(spark):
    rows = spark.createDataFrame([(k, i) for k, i in enumerate(["A", "A_1", "A", "A", "A_1", "B", "B", None, None, "C_1", "C"])], "ord long, id string")
    assert [r.new_id for r in integrity.rename_duplicates(rows).orderBy("ord").collect()] == ["A", "A_1", "A_2", "A_3", "A_1_1", "B", "B_1", None, None, "C_1", "C"]


def test_deep_groups_and_lost_parents(spark):
    deep = [(k, k - 1 if k else None, 1, 2) for k in range(150)] + [(900, 901, 1, 1), (950, 951, 1, 1), (951, 950, 1, 1)]
    got = {r.id: (r.x, r.y, r.depth) for r in graph.flatten_groups(spark.createDataFrame(deep, "id long, parent long, dx int, dy int")).collect()}
    assert got == {k: (k + 1, 2 * k + 2, k) for k in range(150)}


def test_prompts_of_a_tile_without_text(spark):
    tiles = spark.createDataFrame([("a",), ("b",)], "tile string")
    found = spark.createDataFrame([("a", k, f"w{k}", "valve_tag", 0.7 if k else None) for k in range(40)], "tile string, ord long, text string, type string, confidence double")
    got = {r.tile: (r.n_ocr, len(r.valves), len(r.shown), r.mode) for r in ocr.prompt_inputs(tiles, found).collect()}
    assert got == {"a": (39, 39, 30, "grounded"), "b": (0, 0, 0, "free")}


def test_wrapping_counts_lines(spark):
    texts = ["", "aa bb cc", "aaaaaaaaaaaa", "aa\n\nbb", "aa bbbbbbbbbbbb cc", "x" * 10]
    got = [r.n for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").orderBy("k").select(decks.wrapped_lines(F.col("t"), F.lit(10), F.lit(2.0)).alias("n")).collect()]
    assert got == [1, 2, 1, 3, 3, 1]


def test_folders_and_images(spark, tmp_path):
    (tmp_path / "pkg" / "_rels").mkdir(parents=True)
    (tmp_path / "pkg" / "_rels" / ".rels").write_text("<r/>")
    (tmp_path / "pkg" / "a.xml").write_text("<a>\n</a>")
    (tmp_path / "pkg" / "b.txt").write_text("no")
    assert sorted(r.name for r in P.read_folder_parts(spark, str(tmp_path / "pkg")).collect()) == ["_rels/.rels", "a.xml"]
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "p.png").write_bytes(bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big"))
    (tmp_path / "img" / "q.jpg").write_bytes(b"\xff\xd8")
    assert sorted((r.width, r.height) for r in P.read_images(spark, str(tmp_path / "img")).collect() if r.width) == [(640, 480)]


def test_replacement_files(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"note": 1, "slide-0": {"shape-1": {"paragraphs": ["a", {"text": "b"}]}, "shape-2": null}}')
    assert sorted((r.slide, r.shape_id, r.text) for r in S.read_replacements(spark, str(tmp_path / "r.json")).collect()) == [(0, "shape-1", "a\nb"), (0, "shape-2", None)]
    (tmp_path / "twice.json").write_text('{"slide-0": {"shape-1": null, "shape-1": null}}')
    with pytest.raises(Exception, match="repeated keys"):
        S.read_replacements(spark, str(tmp_path / "twice.json")).collect()


def test_front_matter_is_yaml(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nname: tool\ndescription: >\n  folded\n  text\nmetadata:\n  x: 1\n---\nbody")
    (tmp_path / "b.md").write_text("---\n- a list\n---\n")
    got = {r.path[-4:]: (r["keys"], r["name"], r["description"]) for r in S.read_front_matter(spark, str(tmp_path)).collect()}
    assert got == {"a.md": (["name", "description", "metadata"], "tool", "folded text"), "b.md": (None, None, None)}
