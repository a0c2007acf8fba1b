"""Readers and the consolidation plan on small files; streaming of arriving tiles."""

import json
import zipfile

import pytest

from tessella.plans.merge import merge
from tessella.sources import extractions as S
from tessella.sources import packages as P
from tessella.streaming.tiles import first_sightings, stream_detections


def write(path, value):
    path.write_text(json.dumps(value))
    return str(path)


@pytest.fixture
def drawing(tmp_path):
    node = lambda i, tag, box, **x: {"id": i, "tag": tag, "bbox": box, "confidence": 0.9} | x
    line = {"id": "LINE-001", "source": {"node_id": "EQ-001"}, "target": {"node_id": "NOPE"}, "route_waypoints": [[0, 0], [500, 0]], "specifications": {"line_number": "4-PA-1"}}
    bare = {"id": "LINE-002", "source": {"node_id": "EQ-001"}, "target": {"node_id": "P-101"}, "route_waypoints": [[510, 0], [900, 0]]}
    a = write(tmp_path / "tile_00_00.json", {"nodes": {"equipment": [node("EQ-001", "P-101", [0, 0, 100, 100])], "instruments": [], "valves": []}, "edges": {"process_lines": [line, bare], "signal_lines": []}})
    b = write(tmp_path / "tile_00_01.json", {"nodes": {"equipment": [node("EQ-009", "P-101", [0, 0, 100, 100], confidence=0.5)], "instruments": [node("INST-1", "TIC-1", [0, 900, 50, 1000])], "valves": []}, "edges": {"process_lines": [], "signal_lines": []}})
    t = write(tmp_path / "tiles.json", {"tiles": [{"tile_id": 0, "filename": "tile_00_00.png", "normalized_bbox": {"x1": 0, "y1": 0, "x2": 500, "y2": 1000}}]})
    return [a, b, str(tmp_path / "missing.json")], t


def test_merge_plan(spark, drawing):
    files, tiles = drawing
    out = merge(S.read_extractions(spark, files), S.read_tiles(spark, tiles), threshold=0.3)
    nodes = {r.id: tuple(r.box) for r in out["nodes"].collect()}
    assert nodes == {"EQ-001": (0, 0, 100, 50), "INST-1": (0, 900, 50, 1000)}
    assert [(r.action, r.kept_name, r.dropped_name) for r in out["audit"].collect()] == [("merged_duplicate", "P-101", "P-101")]
    lines = {r.id: (r.label, r.propagated) for r in out["lines"].collect()}
    assert lines == {"LINE-001": ("4-PA-1", False), "LINE-002": ("4-PA-1", True)}
    assert [(r.source_id, r.missing_reference) for r in out["unresolved"].collect()] == [("LINE-001", "NOPE")]


def test_ocr_layouts(spark, tmp_path):
    d = {"text": "V-1", "bbox": [1, 2, 3, 4], "type": "valve_tag", "confidence": 0.8}
    write(tmp_path / "a.json", {"tile_id": "a", "all_extractions": [d]})
    write(tmp_path / "b.json", {"tile_id": "b", "extractions": [d, d]})
    write(tmp_path / "c.json", {"tile_id": "c"})
    assert S.read_ocr(spark, [str(tmp_path)]).count() == 3


def test_questions_and_front_matter(spark, tmp_path):
    (tmp_path / "q.xml").write_text("<evaluation><qa_pair><question> a? </question><answer>1</answer></qa_pair><qa_pair><question>b</question></qa_pair></evaluation>")
    assert [tuple(r) for r in S.read_questions(spark, str(tmp_path / "q.xml")).collect()] == [("a?", "1")]
    (tmp_path / "NOTE.md").write_text("---\nname: my-tool\ndescription: does things\n---\nbody")
    r = S.read_front_matter(spark, str(tmp_path / "NOTE.md")).head()
    assert (r["keys"], r["name"], r["description"]) == (["name", "description"], "my-tool", "does things")


def test_repeated_keys_are_rejected():
    assert S.unique_key_json('{"a": {"b": 1}}') == {"a": {"b": 1}}
    with pytest.raises(ValueError, match="repeated"):
        S.unique_key_json('{"a": 1, "a": 2}')


def test_packages(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.pptx", "w") as z:
        z.writestr("ppt/slide1.xml", '<p:sld xmlns:p="urn:p"><p:sp id="2"/><p:sp id="2"/></p:sld>')
    (tmp_path / "broken.pptx").write_bytes(b"no zip")
    rows = P.elements(P.read_parts(spark, str(tmp_path))).collect()
    assert [(r.line, r.name.rsplit("}")[-1], r.attrs.get("id")) for r in rows] == [(1, "sld", None), (2, "sp", "2"), (3, "sp", "2")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.json", {"tile_id": "a", "extractions": [{"text": "V-1", "bbox": [1, 2, 3, 4], "type": "valve_tag", "confidence": 0.8}]})
    q = first_sightings(stream_detections(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("seen").count() == 1
