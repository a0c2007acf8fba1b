"""The consolidation plan: tile extractions to the node, line and side tables of each drawing.

Every table bears `drawing`; drawings never meet, so a run may hold any number of them. `ord` is a row's place in its
drawing: the file's ordinal, then the position in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import dedup, integrity
from ..operators._shared import cut_lineage, present, union
from ..operators.graph import propagate_labels
from ..operators.spatial import endpoint_adjacency

#: Prefixes of generated ids by collection.
KINDS = {"equipment": "EQ", "instruments": "INST", "valves": "VLV"}
LINES = {"process": "LINE", "signal": "SIG"}
_OWN = ["drawing", "kind"]


def _placed(extractions: DataFrame, tiles: DataFrame) -> DataFrame:
    """extractions with their tile's box; a file without tile covers the page."""
    whole = {"x1": 0, "y1": 0, "x2": 1000, "y2": 1000}
    return extractions.join(F.broadcast(tiles), ["drawing", "file"], "left").fillna(whole)


def _ord() -> Column:
    return (F.col("file_ord").cast("long") * (1 << 32) + F.col("pos")).alias("ord")


def place_nodes(extractions: DataFrame, tiles: DataFrame, min_confidence: float = 0.0) -> DataFrame:
    """All nodes in page coordinates that are sure enough (a missing confidence is): drawing, kind, ord, id, tag, box, confidence and references."""
    placed = _placed(extractions, tiles)
    rows = union([placed.select("drawing", "file_ord", F.lit(kind).alias("kind"), F.posexplode(f"nodes.{kind}").alias("pos", "n"), "x1", "y1", "x2", "y2") for kind in KINDS])
    b = F.col("n.bbox")
    at = lambda k, low, high: G.to_global(F.get(b, F.lit(k)), F.col(low), F.col(high))
    box = F.when(F.size(b) == 4, F.struct(at(0, "y1", "y2").alias("y1"), at(1, "x1", "x2").alias("x1"), at(2, "y1", "y2").alias("y2"), at(3, "x1", "x2").alias("x2")))
    kept = rows.filter(F.coalesce("n.confidence", F.lit(1.0)) >= min_confidence)
    own = ["connections", "interlocks", "upstream", "downstream", "controlled_by", "connected_to"]
    return kept.select(*_OWN, _ord(), "n.id", "n.tag", box.alias("box"), "n.confidence", *(f"n.{c}" for c in own))


def place_utilities(extractions: DataFrame, tiles: DataFrame) -> DataFrame:
    """All utilities with their position in page coordinates."""
    rows = _placed(extractions, tiles).select("drawing", "file_ord", F.posexplode("utilities").alias("pos", "u"), "x1", "y1", "x2", "y2")
    at = F.struct(G.to_global(F.col("u.position.x"), F.col("x1"), F.col("x2")).alias("x"), G.to_global(F.col("u.position.y"), F.col("y1"), F.col("y2")).alias("y"))
    none = F.lit(None).cast("struct<y1:int,x1:int,y2:int,x2:int>")
    return rows.select("drawing", F.lit("utilities").alias("kind"), _ord(), "u.id", "u.tag", none.alias("box"), "u.confidence", "u.type", F.when(F.col("u.position").isNotNull(), at).alias("position"), "u.connected_to")


def place_lines(extractions: DataFrame, tiles: DataFrame) -> DataFrame:
    """All lines in page coordinates: drawing, kind, ord, id, tag, the ends, path, confidence, label, inline, loop_id."""
    placed = _placed(extractions, tiles)
    rows = union([placed.select("drawing", "file_ord", F.lit(kind).alias("kind"), F.posexplode(f"edges.{kind}_lines").alias("pos", "e"), "x1", "y1", "x2", "y2") for kind in LINES])
    path = F.transform(F.coalesce("e.route_waypoints", F.array().cast("array<array<int>>")), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    ends = [F.col(f"e.{side}.{name}").alias(f"{side}_{short}") for side in ("source", "target") for name, short in (("node_id", "node"), ("instrument_id", "instrument"), ("type", "type"))]
    return rows.select(*_OWN, _ord(), "e.id", "e.tag", *ends, G.path_to_global(path, F.col("x1"), F.col("x2"), F.col("y1"), F.col("y2")).alias("path"), "e.confidence", present(F.col("e.specifications.line_number")).alias("label"), F.col("e.inline_components").alias("inline"), "e.loop_id")


def _collection(extractions: DataFrame, column: str) -> DataFrame:
    """The rows of an array column of all files, in order, with drawing and ord."""
    return extractions.select("drawing", "file_ord", F.posexplode(column).alias("pos", "r")).select("drawing", _ord(), "r.*")


def first_of_each(rows: DataFrame, key: str) -> DataFrame:
    """The first row of each key; rows of equal other columns count as equal where the key is missing."""
    rest = [c for c in rows.columns if c not in ("drawing", "ord")]
    name = F.coalesce(F.concat(F.lit("k"), F.col(key)), F.to_json(F.struct(*rest)))
    lead = rows.withColumn("name", name).groupBy("drawing", "name").agg(F.min_by(F.struct("ord", *rest), "ord").alias("r"))
    return lead.select("drawing", "r.*")


def first_metadata(extractions: DataFrame, tiles_source: str | None = None) -> DataFrame:
    """(drawing, source_image, metadata): the tile table's image, else the first file's that names one; the first metadata that is there."""
    first = lambda c: F.min_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), F.col("file_ord")))
    image = first(present(F.col("source_image")))
    return extractions.groupBy("drawing").agg((F.coalesce(F.lit(tiles_source), image) if tiles_source else image).alias("source_image"), first(F.col("metadata")).alias("metadata"))


def dedup_nodes(placed: DataFrame, threshold: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """(nodes that stay, audit): by name, then boxes among nameless ones, then boxes among all.

    listed is the order in which they stand afterwards: tagged, with id, by confidence, then by place.
    """
    keyed = cut_lineage(dedup.keyed_dedup(placed, _OWN, threshold))
    named = keyed.filter(F.col("action").isin("best", "renamed"))
    bare = dedup.spatial_dedup(keyed.filter("action = 'unnamed'"), _OWN, threshold).filter("kept").drop("kept")
    stay = cut_lineage(named.unionByName(bare).withColumn("id", F.col("new_id")).drop("new_id", "name", "best_name", "overlap", "action"))
    judged = cut_lineage(dedup.spatial_dedup(stay, _OWN, threshold, last="place"))
    names = judged.select(*_OWN, "ord", F.coalesce(present(F.col("tag")), "id").alias("name"))
    by_name = keyed.filter("action = 'merged_duplicate'").select(*_OWN, "action", F.col("best_name").alias("kept_name"), F.col("name").alias("dropped_name"), "overlap")
    gone = dedup.spatial_audit(judged, _OWN, threshold, last="place").withColumn("action", F.lit("spatial_dedup"))
    by_box = gone.join(names.withColumnRenamed("name", "dropped_name"), [*_OWN, "ord"]).join(names.withColumnRenamed("ord", "kept_ord").withColumnRenamed("name", "kept_name"), [*_OWN, "kept_ord"])
    listed = F.struct(present(F.col("tag")).isNull().alias("no_tag"), present(F.col("id")).isNull().alias("no_id"), (-F.coalesce("confidence", F.lit(0.0))).alias("less"), "place")
    return judged.filter("kept").drop("kept").withColumn("listed", listed).drop("place"), by_name.unionByName(by_box.select(by_name.columns))


def with_ids(rows: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """rows whose missing ids are generated, collection by collection, in the order of `listed`."""
    parts = [integrity.fill_ids(rows.filter(F.col("kind") == kind), prefix, _OWN, ["listed"]) for kind, prefix in prefixes.items()]
    return union(parts).withColumn("id", F.col("new_id")).drop("new_id")


def dedup_lines(placed: DataFrame) -> DataFrame:
    """The lines that stay, with listed: by confidence, then by place. Only node ends count as the same ends."""
    named = placed.withColumns({"name": F.coalesce(present(F.col("id")), "tag"), "source": F.col("source_node"), "target": F.col("target_node")})
    kept = dedup.line_dedup(named, within=tuple(_OWN)).filter("kept").drop("kept", "name", "source", "target")
    return kept.withColumn("listed", F.struct((-F.coalesce("confidence", F.lit(0.0))).alias("less"), "ord"))


def label_lines(lines: DataFrame) -> DataFrame:
    """lines with propagated and label_source: labels spread over touching lines of one drawing and kind."""
    keyed = lines.withColumn("line", F.struct(*_OWN, "listed"))
    ids = keyed.select(F.col("line").alias("source"), present(F.col("id")).alias("label_source"))
    spread = propagate_labels(keyed.select("line", "label"), endpoint_adjacency(keyed, within=_OWN)).join(ids, "source", "left").drop("source")
    return keyed.drop("label").join(spread, "line").drop("line")


def references(t: dict[str, DataFrame]) -> DataFrame:
    """All references of a merged drawing: drawing, phase, source_id, field, ref, ref_type (OffPage ends are exempt)."""
    own = lambda kind: t["nodes"].filter(F.col("kind") == kind)
    none = F.lit(None).cast("string")

    def row(df: DataFrame, phase: int, source: str, field: str, ref: Column, kind: Column = none) -> DataFrame:
        return df.select("drawing", F.lit(phase).alias("phase"), F.col(source).alias("source_id"), F.lit(field).alias("field"), ref.alias("ref"), kind.alias("ref_type"))

    col, each = F.col, F.explode
    process, signal = (t["lines"].filter(col("kind") == kind) for kind in LINES)
    relations, loops = t["control_relationships"], t["control_loops"]
    return union(
        [row(own("equipment"), 1, "id", f"connections.{f}", each(f"connections.{f}")) for f in ("inlet_from", "outlet_to")]
        + [row(own("equipment"), 1, "id", "interlocks", each("interlocks")), row(own("instruments"), 2, "id", "connected_to", col("connected_to"))]
        + [row(own("valves"), 3, "id", f, col(f)) for f in ("upstream", "downstream", "controlled_by")]
        + [row(process, 4, "id", f"{side}.node_id", col(f"{side}_node"), col(f"{side}_type")) for side in ("source", "target")]
        + [row(process, 4, "id", "inline_components", each("inline"))]
        + [row(signal, 4, "id", f"{side}.instrument_id", col(f"{side}_instrument")) for side in ("source", "target")]
        + [row(signal, 4, "id", "loop_id", col("loop_id")), row(t["utilities"], 4, "id", "connected_to", col("connected_to"))]
        + [row(loops, 2, "loop_id", "control_loops.instruments", each("instruments"))]
        + [row(relations, 5, "loop_id", f"control_relationships.{f}", col(f)) for f in ("sensor", "controller", "final_element")]
        + [row(t["flow_sequences"], 5, "sequence_id", "flow_sequences.nodes", each("nodes"))]
        + [row(t["interlocks"], 5, "interlock_id", "interlocks.trigger_instrument", col("trigger_instrument")), row(t["interlocks"], 5, "interlock_id", "interlocks.affected_equipment", each("affected_equipment"))]
    )


def known_ids(t: dict[str, DataFrame]) -> DataFrame:
    """(drawing, id) that references may name: ids of everything, and tags of nodes."""
    named = [("nodes", "id"), ("nodes", "tag"), ("lines", "id"), ("utilities", "id"), ("control_loops", "loop_id"), ("flow_sequences", "sequence_id"), ("interlocks", "interlock_id")]
    return union([t[name].select("drawing", F.col(c).alias("id")) for name, c in named]).filter("id is not null").distinct()


def orphans(t: dict[str, DataFrame]) -> DataFrame:
    """(drawing, id, tag) of equipment without connections that no connection, valve or process line names."""
    filled = lambda f: F.size(F.coalesce(f"connections.{f}", F.array().cast("array<string>")))
    equipment = t["nodes"].filter("kind = 'equipment'").withColumn("links", filled("inlet_from") + filled("outlet_to"))
    fields = ["connections.inlet_from", "connections.outlet_to", "upstream", "downstream", "source.node_id", "target.node_id"]
    return integrity.orphans(equipment.select("drawing", "id", "tag", "links"), references(t).filter(F.col("field").isin(fields)), ("drawing",))


def validate(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """unresolved, orphans, incomplete_loops, skewed segments, and validation: one row of counts a drawing with is_valid."""
    unresolved = cut_lineage(integrity.unresolved_references(references(t), known_ids(t), ("drawing",)))
    alone = cut_lineage(orphans(t))
    gaps = t["control_relationships"].filter("sensor is null or final_element is null").select("drawing", "loop_id")
    skewed = t["lines"].select("drawing", F.col("id").alias("line_id"), F.explode(G.skewed_segments(F.col("path"))).alias("s")).select("drawing", "line_id", "s.*")
    counts = [(unresolved, "unresolved_references"), (alone, "orphan_nodes"), (gaps, "incomplete_loops"), (skewed, "orthogonality_warnings")]
    every = union([df.select("drawing", F.lit(name).alias("what")) for df, name in counts])
    drawings = union([t[name].select("drawing") for name in ("nodes", "lines", "utilities")]).distinct()
    seen = every.groupBy("drawing").agg(*(F.count_if(F.col("what") == name).alias(name) for _, name in counts))
    row = drawings.join(seen, "drawing", "left").fillna(0)
    valid = (F.col("unresolved_references") == 0) & (F.col("orphan_nodes") == 0) & (F.col("incomplete_loops") == 0)
    return {"unresolved": unresolved, "orphans": alone, "incomplete_loops": gaps, "skewed": skewed, "validation": row.withColumn("is_valid", valid)}


def merge(extractions: DataFrame, tiles: DataFrame, min_confidence: float = 0.0, threshold: float = 0.95, tiles_source: str | None = None) -> dict[str, DataFrame]:
    """The merged tables of all drawings of extractions, with their checks (see `validate`), the audit and the metadata."""
    nodes, audit = dedup_nodes(place_nodes(extractions, tiles, min_confidence), threshold)
    utilities, _ = dedup_nodes(place_utilities(extractions, tiles), threshold)
    lines = with_ids(label_lines(cut_lineage(dedup_lines(place_lines(extractions, tiles)))), LINES)
    t = {"nodes": cut_lineage(with_ids(nodes, KINDS)), "lines": cut_lineage(lines), "utilities": utilities, "audit": audit, "metadata": first_metadata(extractions, tiles_source)}
    t |= {name: _collection(extractions, f"process_logic.{name}") for name in ("flow_sequences", "control_relationships", "interlocks")}
    t |= {"control_loops": _collection(extractions, "control_loops"), "line_types": _collection(extractions, "legend.line_types"), "abbreviations": _collection(extractions, "legend.abbreviations")}
    t["symbols"] = first_of_each(_collection(extractions, "legend.symbols"), "symbol_id")
    return t | validate(t)


def ground(t: dict[str, DataFrame], words: DataFrame, threshold: float = 0.8) -> dict[str, DataFrame]:
    """The merged tables with nodes marked ocr_validated and ocr_match, and ocr_only: tag-like words (drawing, ord, text, type) without node."""
    own = ("drawing",)
    found = integrity.ground_tags(t["nodes"].select("drawing", F.struct("kind", "ord").alias("id"), "tag"), words, threshold, own)
    marks = found.select("drawing", "id.kind", "id.ord", F.col("match").alias("ocr_match"))
    nodes = t["nodes"].join(marks, ["drawing", "kind", "ord"], "left").withColumn("ocr_validated", F.coalesce(F.col("ocr_match") != "none", F.lit(False)))
    tags = words.filter(F.col("type").isin("equipment_tag", "instrument_tag", "valve_tag"))
    return t | {"nodes": nodes, "grounding": found, "ocr_only": integrity.unmatched_words(tags, found, own)}
