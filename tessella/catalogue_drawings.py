"""Queries over whole drawings: the merge plan, review, detection candidates, OCR inputs and the sinks, with their DuckDB oracles.

A drawing holds a fixed number of rows, so larger tables mean more drawings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import _AREA, _GROUND, _LINES, _OVER, _lines, _read, _tags, _words, query
from .functions import geometry as G
from .operators import documents, errors, integrity, ocr, spatial, vision
from .operators._shared import shared_folder
from .plans import merge as M
from .plans import review as R
from .sources import sinks


def _text(c: Column) -> Column:
    return c.cast("string")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"


def _again(rows: DataFrame, schema: str | None = None, by: str | None = None) -> DataFrame:
    """rows written by the JSON sink and read back."""
    spark, at = rows.sparkSession, _folder(rows.sparkSession)
    kind = rows.schema
    sinks.write_json(rows, at, by)
    return spark.read.schema(schema or kind).json(at)


# ------------------------------------------------------------------ the merge plan

#: Nodes of drawings of sixty parts: tags and ids are missing here and there, confidences and boxes often tie.
_NODES = """raw AS (SELECT p_partkey AS k, p_partkey // 60 AS drawing, CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN 'equipment' WHEN 1 THEN 'instruments' ELSE 'valves' END AS kind,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE concat('T', CAST(p_partkey % 13 AS VARCHAR)) END AS tag, CASE WHEN p_partkey % 5 < 2 THEN NULL ELSE concat('N', CAST(p_partkey % 17 AS VARCHAR)) END AS id,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE (p_partkey % 5) / 4::DOUBLE END AS confidence, CAST((p_partkey * 37) % 40 AS INT) AS x, CAST((p_partkey * 53) % 30 AS INT) AS y, p_partkey % 11 <> 0 AS boxed FROM part)"""


def _extractions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Extraction files of the drawings, one file a drawing, as the reader gives them; no tile table."""
    k = F.col("p_partkey")
    box = F.array(*(c.cast("int") for c in ((k * 53) % 30, (k * 37) % 40, (k * 53) % 30 + 25, (k * 37) % 40 + 25)))
    none = F.lit(None).cast("string")
    node = F.struct(
        F.when(k % 5 >= 2, F.concat(F.lit("N"), _text(k % 17))).alias("id"), F.when(k % 4 != 0, F.concat(F.lit("T"), _text(k % 13))).alias("tag"), F.when(k % 11 != 0, box).alias("bbox"), F.when(k % 7 != 0, (k % 5) / F.lit(4.0)).alias("confidence"),
        F.struct(F.array(F.concat(F.lit("N"), _text(k % 19))).alias("inlet_from"), F.array(F.when(k % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("T"), _text(k % 16)))).alias("outlet_to")).alias("connections"),
        F.array(none).alias("interlocks"), F.concat(F.lit("N"), _text(k % 23)).alias("connected_to"), F.concat(F.lit("T"), _text(k % 14)).alias("upstream"), F.when(k % 2 == 0, F.concat(F.lit("N"), _text(k % 18))).alias("downstream"), F.lit("").alias("controlled_by"),
    )
    rows = _read(spark, sf_dir, "part", "p_partkey").select(F.floor(k / 60).alias("drawing"), (k % 3).alias("kind"), k.alias("k"), node.alias("n"))
    listed = lambda n: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == n, F.struct("k", "n")))), lambda s: s["n"])
    files = rows.groupBy("drawing").agg(F.struct(listed(0).alias("equipment"), listed(1).alias("instruments"), listed(2).alias("valves")).alias("nodes"))
    return files.withColumns({"file": F.lit("a.json"), "file_ord": F.lit(0)}), spark.createDataFrame([], "drawing long, file string, x1 int, y1 int, x2 int, y2 int")


_GLOBAL = "CAST(trunc({0} / 1000::DOUBLE * 1000) AS INT)"
_MERGED = f"""WITH RECURSIVE {_NODES}, src0 AS (SELECT *, row_number() OVER (PARTITION BY drawing, kind ORDER BY k) - 1 AS ord, coalesce(tag, id) AS name, {_GLOBAL.format('x')} AS x1, {_GLOBAL.format('y')} AS y1, {_GLOBAL.format('(x + 25)')} AS x2, {_GLOBAL.format('(y + 25)')} AS y2 FROM raw),
keyed AS (SELECT *, row_number() OVER (PARTITION BY drawing, kind, name ORDER BY coalesce(confidence, 0) DESC, ord) AS r, min(ord) OVER (PARTITION BY drawing, kind, name) AS first_ord FROM src0 WHERE name IS NOT NULL),
judged AS (SELECT a.*, CASE WHEN a.r = 1 THEN 'best' WHEN NOT a.boxed OR NOT b.boxed THEN 'dropped' WHEN {f"CAST({_OVER} AS DOUBLE) / least({_AREA.format('a')}, {_AREA.format('b')})"} < 0.5 THEN 'renamed' ELSE 'merged' END AS action FROM keyed a JOIN keyed b ON a.drawing = b.drawing AND a.kind = b.kind AND a.name = b.name AND b.r = 1),
bare0 AS (SELECT *, row_number() OVER (PARTITION BY drawing, kind ORDER BY coalesce(confidence, 0) DESC, ord) AS k2 FROM src0 WHERE name IS NULL),
walk1 AS (SELECT drawing, kind, 0::BIGINT AS k2, []::BIGINT[] AS kept FROM (SELECT DISTINCT drawing, kind FROM bare0)
 UNION ALL SELECT w.drawing, w.kind, v.k2, CASE WHEN EXISTS (SELECT 1 FROM src0 a WHERE a.drawing = v.drawing AND a.kind = v.kind AND list_contains(w.kept, a.ord) AND a.boxed AND v.boxed AND CAST({_OVER.replace('b.', 'v.')} AS DOUBLE) / least({_AREA.format('a')}, {_AREA.format('v')}) >= 0.5) THEN w.kept ELSE list_append(w.kept, v.ord) END
 FROM walk1 w JOIN bare0 v ON v.drawing = w.drawing AND v.kind = w.kind AND v.k2 = w.k2 + 1),
kept1 AS (SELECT drawing, kind, unnest(kept) AS ord FROM (SELECT * FROM walk1 QUALIFY row_number() OVER (PARTITION BY drawing, kind ORDER BY k2 DESC) = 1)),
stay AS (SELECT drawing, kind, ord, tag, CASE WHEN action = 'renamed' THEN concat(coalesce(id, 'unknown'), '_dup') ELSE id END AS id, confidence, boxed, x1, y1, x2, y2, false AS bare, first_ord, CASE WHEN r = 1 THEN 1000000 ELSE r END AS turn FROM judged WHERE action IN ('best', 'renamed')
 UNION ALL SELECT drawing, kind, ord, tag, id, confidence, boxed, x1, y1, x2, y2, true, ord, 0 FROM bare0 JOIN kept1 USING (drawing, kind, ord)),
src2 AS (SELECT *, row_number() OVER (PARTITION BY drawing, kind ORDER BY tag IS NULL, id IS NULL, coalesce(confidence, 0) DESC, bare, first_ord, turn) AS k2 FROM stay),
walk2 AS (SELECT drawing, kind, 0::BIGINT AS k2, []::BIGINT[] AS kept FROM (SELECT DISTINCT drawing, kind FROM src2)
 UNION ALL SELECT w.drawing, w.kind, v.k2, CASE WHEN EXISTS (SELECT 1 FROM src2 a WHERE a.drawing = v.drawing AND a.kind = v.kind AND list_contains(w.kept, a.ord) AND a.boxed AND v.boxed AND (a.tag IS NULL OR v.tag IS NULL OR a.tag = v.tag) AND CAST({_OVER.replace('b.', 'v.')} AS DOUBLE) / least({_AREA.format('a')}, {_AREA.format('v')}) >= 0.5) THEN w.kept ELSE list_append(w.kept, v.ord) END
 FROM walk2 w JOIN src2 v ON v.drawing = w.drawing AND v.kind = w.kind AND v.k2 = w.k2 + 1),
kept2 AS (SELECT drawing, kind, unnest(kept) AS ord FROM (SELECT * FROM walk2 QUALIFY row_number() OVER (PARTITION BY drawing, kind ORDER BY k2 DESC) = 1)),
final AS (SELECT s.* FROM src2 s JOIN kept2 USING (drawing, kind, ord)),
merged AS (SELECT drawing, kind, ord, tag, coalesce(id, concat(CASE kind WHEN 'equipment' THEN 'EQ-' WHEN 'instruments' THEN 'INST-' ELSE 'VLV-' END, printf('%03d', row_number() OVER (PARTITION BY drawing, kind, id IS NULL ORDER BY k2)))) AS id FROM final)
"""


@query(_MERGED + "SELECT drawing, kind, ord, tag, id FROM merged")
def q_merge_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _ = M.dedup_nodes(M.place_nodes(*_extractions(spark, sf_dir)), 0.5)
    return M.with_ids(nodes, M.KINDS).select("drawing", "kind", "ord", "tag", "id")


@query(_MERGED + """, m AS (SELECT m.*, r.k FROM merged m JOIN (SELECT drawing, kind, k, row_number() OVER (PARTITION BY drawing, kind ORDER BY k) - 1 AS ord FROM raw) r USING (drawing, kind, ord)),
refs AS (SELECT drawing, 1 AS phase, id AS source_id, 'connections.inlet_from' AS field, concat('N', CAST(k % 19 AS VARCHAR)) AS ref FROM m WHERE kind = 'equipment'
 UNION ALL SELECT drawing, 1, id, 'connections.outlet_to', CASE WHEN k % 6 = 0 THEN '' ELSE concat('T', CAST(k % 16 AS VARCHAR)) END FROM m WHERE kind = 'equipment'
 UNION ALL SELECT drawing, 2, id, 'connected_to', concat('N', CAST(k % 23 AS VARCHAR)) FROM m WHERE kind = 'instruments'
 UNION ALL SELECT drawing, 3, id, 'upstream', concat('T', CAST(k % 14 AS VARCHAR)) FROM m WHERE kind = 'valves'
 UNION ALL SELECT drawing, 3, id, 'downstream', CASE WHEN k % 2 = 0 THEN concat('N', CAST(k % 18 AS VARCHAR)) END FROM m WHERE kind = 'valves')
SELECT drawing, phase, source_id, field, ref AS missing_reference FROM refs WHERE coalesce(ref, '') <> '' AND NOT EXISTS (SELECT 1 FROM merged x WHERE x.drawing = refs.drawing AND (x.id = ref OR x.tag = ref))""")
def q_merge_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _merge(spark, sf_dir)
    return out["unresolved"]


def _merge(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    files, tiles = _extractions(spark, sf_dir)
    own = {f.name for f in files.schema}
    from .sources.extractions import EXTRACTION

    rest = [f for f in spark.createDataFrame([], EXTRACTION).schema if f.name not in own]
    return M.merge(files.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in rest)), tiles, threshold=0.5)


#: Everything that holds references, by customer: drawings of a hundred. (table, phase, source, field, reference, whether the end is off the page)
_K = "CAST(k % {0} AS VARCHAR)"
_FIELDS = [
    ("equipment", 1, "N", "connections.inlet_from", "N", 150, False), ("equipment", 1, "N", "connections.outlet_to", "TT", 140, False), ("equipment", 1, "N", "interlocks", "IL", 37, False),
    ("instruments", 2, "N", "connected_to", "N", 160, False), ("valves", 3, "N", "upstream", "TT", 170, False), ("valves", 3, "N", "downstream", "LINE", 180, False), ("valves", 3, "N", "controlled_by", "LOOP", 41, False),
    ("process", 4, "LINE", "source.node_id", "N", 130, True), ("process", 4, "LINE", "target.node_id", "TT", 145, False), ("process", 4, "LINE", "inline_components", "N", 155, False),
    ("signal", 4, "LINE", "source.instrument_id", "N", 165, False), ("signal", 4, "LINE", "target.instrument_id", "U", 175, False), ("signal", 4, "LINE", "loop_id", "LOOP", 33, False),
    ("utilities", 4, "U", "connected_to", "N", 185, False), ("control_loops", 2, "LOOP", "control_loops.instruments", "N", 190, False),
    ("control_relationships", 5, "LOOP", "control_relationships.sensor", "N", 195, False), ("control_relationships", 5, "LOOP", "control_relationships.controller", "TT", 135, False), ("control_relationships", 5, "LOOP", "control_relationships.final_element", "SEQ", 29, False),
    ("flow_sequences", 5, "SEQ", "flow_sequences.nodes", "N", 125, False), ("interlocks", 5, "IL", "interlocks.trigger_instrument", "U", 115, False), ("interlocks", 5, "IL", "interlocks.affected_equipment", "IL", 43, False),
]
#: Which rows a table has: customers of this remainder by twelve.
_ROWS = {"equipment": (0, 6), "instruments": (1, 7), "valves": (2, 8), "process": (3, 9), "signal": (4, 10), "utilities": (5,), "control_loops": (0, 3), "control_relationships": (1, 4), "flow_sequences": (2, 5), "interlocks": (6, 9)}


def _in(table: str) -> str:
    return f"k % 12 IN ({', '.join(map(str, _ROWS[table]))})"


def _reference_sql() -> str:
    refs = " UNION ALL ".join(
        f"SELECT drawing, {phase} AS phase, concat('{source}', CAST(k % 200 AS VARCHAR)) AS source_id, '{field}' AS field, concat('{to}', {_K.format(n)}) AS ref, {'k % 4 = 3' if off else 'false'} AS off FROM c WHERE {_in(table)}" for table, phase, source, field, to, n, off in _FIELDS
    )
    own = {"equipment": "N", "instruments": "N", "valves": "N", "process": "LINE", "signal": "LINE", "utilities": "U", "control_loops": "LOOP", "flow_sequences": "SEQ", "interlocks": "IL"}
    ids = " UNION ALL ".join([f"SELECT drawing, concat('{p}', CAST(k % 200 AS VARCHAR)) AS id FROM c WHERE {_in(t)}" for t, p in own.items()] + [f"SELECT drawing, concat('TT', CAST(k % 200 AS VARCHAR)) FROM c WHERE {_in(t)}" for t in ("equipment", "instruments", "valves")])
    return f"WITH c AS (SELECT c_custkey AS k, c_custkey // 100 AS drawing FROM customer), refs AS ({refs}), ids AS (SELECT DISTINCT * FROM ({ids}))"


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    k = F.col("k")
    c = _read(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("k"), F.floor(F.col("c_custkey") / 100).alias("drawing"))
    ref = {field: F.concat(F.lit(to), _text(k % n)) for _, _, _, field, to, n, _ in _FIELDS}
    name = lambda p: F.concat(F.lit(p), _text(k % 200))
    own = lambda t: c.filter((k % 12).isin(*_ROWS[t]))
    some = lambda f: F.array(ref[f])
    none = F.lit(None).cast("string")
    node = lambda t, **x: own(t).select("drawing", F.lit(t).alias("kind"), name("N").alias("id"), name("TT").alias("tag"), F.struct((some("connections.inlet_from") if t == "equipment" else F.array().cast("array<string>")).alias("inlet_from"), (some("connections.outlet_to") if t == "equipment" else F.array().cast("array<string>")).alias("outlet_to")).alias("connections"), (some("interlocks") if t == "equipment" else F.array().cast("array<string>")).alias("interlocks"), *((ref[f] if f in x else none).alias(f) for f in ("connected_to", "upstream", "downstream", "controlled_by")))
    nodes = node("equipment").unionByName(node("instruments", connected_to=1)).unionByName(node("valves", upstream=1, downstream=1, controlled_by=1))
    # Two tables use the field name connected_to.
    at = {(t, f): F.concat(F.lit(to), _text(k % n)) for t, _, _, f, to, n, _ in _FIELDS}
    nodes = nodes.drop("connected_to").join(own("instruments").select("drawing", name("N").alias("id"), at["instruments", "connected_to"].alias("connected_to"), F.lit("instruments").alias("kind")), ["drawing", "id", "kind"], "left")

    def line(t: str) -> DataFrame:
        p = t == "process"
        ends = [(ref[f"{s}.node_id"] if p else none).alias(f"{s}_node") for s in ("source", "target")] + [(none if p else ref[f"{s}.instrument_id"]).alias(f"{s}_instrument") for s in ("source", "target")]
        return own(t).select("drawing", F.lit(t).alias("kind"), name("LINE").alias("id"), *ends, F.when(k % 4 == 3, "OffPage").alias("source_type"), none.alias("target_type"), (some("inline_components") if p else F.array().cast("array<string>")).alias("inline"), (none if p else ref["loop_id"]).alias("loop_id"), F.array(F.struct((k % 90).cast("int").alias("x"), F.lit(0).alias("y")), F.struct((k % 90 + 10).cast("int").alias("x"), (k % 3 * 10).cast("int").alias("y"))).alias("path"))

    return {
        "nodes": nodes, "lines": line("process").unionByName(line("signal")), "utilities": own("utilities").select("drawing", name("U").alias("id"), at["utilities", "connected_to"].alias("connected_to")),
        "control_loops": own("control_loops").select("drawing", name("LOOP").alias("loop_id"), some("control_loops.instruments").alias("instruments")),
        "control_relationships": own("control_relationships").select("drawing", name("LOOP").alias("loop_id"), *(ref[f"control_relationships.{f}"].alias(f) for f in ("sensor", "controller", "final_element"))),
        "flow_sequences": own("flow_sequences").select("drawing", name("SEQ").alias("sequence_id"), some("flow_sequences.nodes").alias("nodes")),
        "interlocks": own("interlocks").select("drawing", name("IL").alias("interlock_id"), ref["interlocks.trigger_instrument"].alias("trigger_instrument"), some("interlocks.affected_equipment").alias("affected_equipment")),
    }


@query(_reference_sql() + " SELECT drawing, phase, source_id, field, ref AS missing_reference FROM refs WHERE NOT off AND NOT EXISTS (SELECT 1 FROM ids WHERE ids.drawing = refs.drawing AND ids.id = refs.ref)")
def q_all_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return integrity.unresolved_references(M.references(t), M.known_ids(t), ("drawing",))


@query(_reference_sql() + """, bad AS (SELECT drawing, count(*) AS n FROM refs WHERE NOT off AND NOT EXISTS (SELECT 1 FROM ids WHERE ids.drawing = refs.drawing AND ids.id = refs.ref) GROUP BY 1),
d AS (SELECT DISTINCT drawing FROM c WHERE k % 12 <= 10), sk AS (SELECT drawing, count(*) AS n FROM c WHERE k % 12 IN (3, 4, 9, 10) AND k % 3 > 0 GROUP BY 1)
SELECT drawing, coalesce(bad.n, 0) AS unresolved_references, 0::BIGINT AS orphan_nodes, 0::BIGINT AS incomplete_loops, coalesce(sk.n, 0) AS orthogonality_warnings, coalesce(bad.n, 0) = 0 AS is_valid FROM d LEFT JOIN bad USING (drawing) LEFT JOIN sk USING (drawing)""")
def q_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.validate(_tables(spark, sf_dir))["validation"]


@query(f"""WITH RECURSIVE {_LINES}, l AS (SELECT *, line % 2 AS kind, CASE WHEN line % 3 = 0 THEN NULL ELSE concat('L', CAST(line AS VARCHAR)) END AS id, row_number() OVER (PARTITION BY sheet, line % 2 ORDER BY confidence DESC, ord) AS k FROM lines),
ends AS (SELECT line, k, sheet, kind, unnest([ax, cx]) AS x, unnest([ay, cy]) AS y FROM l), adj AS (SELECT DISTINCT p.line AS a, q.line AS b FROM ends p JOIN ends q ON p.line <> q.line AND p.sheet = q.sheet AND p.kind = q.kind AND (p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= 900),
reach AS (SELECT line AS x, line AS y FROM l WHERE label IS NULL UNION SELECT reach.x, adj.b FROM reach JOIN adj ON adj.a = reach.y JOIN l ON l.line = adj.b AND l.label IS NULL),
src AS (SELECT reach.x AS line, arg_min(n.line, n.k) AS source FROM reach JOIN adj ON adj.a = reach.y JOIN l n ON n.line = adj.b AND n.label IS NOT NULL GROUP BY 1)
SELECT l.sheet AS drawing, l.line AS ord, coalesce(l.label, n.label) AS label, l.label IS NULL AND n.label IS NOT NULL AS propagated, n.id AS label_source,
 coalesce(l.id, concat(CASE WHEN l.kind = 0 THEN 'LINE-' ELSE 'SIG-' END, printf('%03d', row_number() OVER (PARTITION BY l.sheet, l.kind, l.id IS NULL ORDER BY l.k)))) AS id FROM l LEFT JOIN src ON src.line = l.line AND l.label IS NULL LEFT JOIN l n ON n.line = src.source""")
def q_merge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("line")
    rows = _lines(spark, sf_dir).withColumns({"drawing": F.col("sheet"), "kind": F.when(k % 2 == 0, "process").otherwise("signal"), "id": F.when(k % 3 != 0, F.concat(F.lit("L"), _text(k))), "listed": F.struct((-F.col("confidence")).alias("less"), "ord")}).drop("line", "sheet")
    return M.with_ids(M.label_lines(rows), M.LINES).select("drawing", "ord", "label", "propagated", "label_source", "id")


@query("""WITH u AS (SELECT s_suppkey AS k, s_suppkey // 20 AS drawing, concat('U', CAST(s_suppkey % 7 AS VARCHAR)) AS id, (s_suppkey * 37) % 1000 AS x, (s_suppkey * 53) % 1000 AS y FROM supplier)
SELECT drawing, id, k % 20 AS pos, CAST(trunc(450 + x / 1000::DOUBLE * 550) AS INT) AS x, CAST(trunc(y / 1000::DOUBLE * 549) AS INT) AS y FROM u QUALIFY row_number() OVER (PARTITION BY drawing, id ORDER BY k) = 1""")
def q_utilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    u = F.struct(F.concat(F.lit("U"), _text(k % 7)).alias("id"), F.lit(None).cast("string").alias("tag"), F.lit("steam").alias("type"), F.struct(((k * 37) % 1000).cast("int").alias("x"), ((k * 53) % 1000).cast("int").alias("y")).alias("position"), F.lit(None).cast("string").alias("connected_to"), F.lit(None).cast("double").alias("confidence"))
    # A gap keeps the places of the first drawing, whose first supplier is number 1.
    files = _read(spark, sf_dir, "supplier", "s_suppkey").groupBy(F.floor(k / 20).alias("drawing")).agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", u.alias("u")))), lambda s: s["u"]).alias("utilities"), (F.min(k) % 20).alias("skip"))
    files = files.withColumns({"file": F.lit("a.json"), "file_ord": F.lit(0)})
    tiles = files.select("drawing", "file", F.lit(450).alias("x1"), F.lit(0).alias("y1"), F.lit(1000).alias("x2"), F.lit(549).alias("y2"))
    placed = M.place_utilities(files, tiles)
    kept, _ = M.dedup_nodes(placed)
    return kept.join(files.select("drawing", "skip"), "drawing").select("drawing", "id", (F.col("ord") + F.col("skip")).alias("pos"), "position.x", "position.y")


@query("""WITH s AS (SELECT p_partkey AS ord, p_partkey // 100 AS drawing, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE concat('S', CAST(p_partkey % 25 AS VARCHAR)) END AS symbol_id, concat('d', CAST(p_partkey % 4 AS VARCHAR)) AS description FROM part)
SELECT drawing, ord, symbol_id, description FROM s QUALIFY row_number() OVER (PARTITION BY drawing, coalesce('k' || symbol_id, '=' || description) ORDER BY ord) = 1""")
def q_legend_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = _read(spark, sf_dir, "part", "p_partkey").select(F.floor(k / 100).alias("drawing"), k.alias("ord"), F.when(k % 6 != 0, F.concat(F.lit("S"), _text(k % 25))).alias("symbol_id"), F.concat(F.lit("d"), _text(k % 4)).alias("description"))
    return M.first_of_each(rows, "symbol_id")


@query(_MERGED + """SELECT drawing, len(list(ord) FILTER (kind = 'equipment')) AS n_equipment, array_to_string(list(id ORDER BY ord) FILTER (kind = 'equipment'), ',') AS equipment, coalesce(array_to_string(list(id ORDER BY ord) FILTER (kind = 'valves'), ','), '') AS valves FROM merged GROUP BY 1""")
def q_merged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _again(sinks.merged_documents(_merge(spark, sf_dir)))
    ids = lambda kind: F.array_join(F.transform(f"document.nodes.{kind}", lambda n: n["id"]), ",")
    return docs.select("drawing", F.size("document.nodes.equipment").cast("long").alias("n_equipment"), ids("equipment").alias("equipment"), ids("valves").alias("valves"))


# ------------------------------------------------------------------ grounding and review


@query(_GROUND + """, m AS (SELECT hit, near, coalesce(hit, near) AS word FROM x LEFT JOIN f USING (k)), o AS (SELECT count(*) AS n FROM w WHERE word NOT IN (SELECT word FROM m WHERE word IS NOT NULL))
SELECT count(*) AS total, count(word) AS validated, count(hit) AS exact, count(*) FILTER (hit IS NULL AND near IS NOT NULL) AS fuzzy, count(*) FILTER (word IS NULL) AS unvalidated, (SELECT n FROM o) AS ocr_only, round(count(word) / greatest(1, count(*)), 3) AS validation_rate FROM m""")
def q_ocr_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir)
    found = integrity.ground_tags(_tags(spark, sf_dir), words)
    return integrity.ocr_stats(found, integrity.unmatched_words(words, found))


_REVIEW = f"""{_LINES}, nodes AS (SELECT c_custkey AS ord, concat('N', CAST(c_custkey % 1200 AS VARCHAR)) AS id, CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'equipment' WHEN 1 THEN 'instruments' ELSE 'valves' END AS kind, concat('V-', CAST(c_custkey % 900 AS VARCHAR)) AS tag FROM customer),
e AS (SELECT *, CASE WHEN line % 10 = 0 THEN '' ELSE concat('N', CAST(line AS VARCHAR)) END AS source, concat('N', CAST(line * 3 % 2000 AS VARCHAR)) AS target, CASE WHEN line % 2 = 0 THEN 'process' ELSE 'signal' END AS kind, concat('X', CAST(line % 7 AS VARCHAR)) AS comp FROM lines),
refs AS (SELECT kind, concat('L', CAST(line AS VARCHAR)) AS entity_id, unnest(['source', 'target', 'inline_components']) AS field, unnest([source, target, comp]) AS ref FROM e),
found AS (SELECT 'DUPLICATE_ID' AS error_type, arg_min(kind, ord) AS kind, id AS entity_id, 'id' AS field FROM nodes GROUP BY id HAVING count(*) > 1
 UNION ALL SELECT 'DANGLING_REF', kind, entity_id, field FROM refs WHERE ref <> '' AND ref NOT IN (SELECT id FROM nodes)
 UNION ALL SELECT 'SEAM_BREAK', kind, concat('L', CAST(line AS VARCHAR)), 'waypoint_start' FROM e WHERE source = '' AND (ax <= 20 OR ax >= 980 OR ay <= 20 OR ay >= 980)
 UNION ALL SELECT 'ORPHAN_NODE', kind, id, NULL FROM nodes WHERE id NOT IN (SELECT ref FROM refs))"""


def _drawing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    nodes = _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("ord"), F.concat(F.lit("N"), _text(k % 1200)).alias("id"), F.when(k % 3 == 0, "equipment").when(k % 3 == 1, "instruments").otherwise("valves").alias("kind"), F.concat(F.lit("V-"), _text(k % 900)).alias("tag"))
    n = F.col("line")
    lines = _lines(spark, sf_dir).select(F.concat(F.lit("L"), _text(n)).alias("id"), F.when(n % 2 == 0, "process").otherwise("signal").alias("kind"), F.when(n % 10 == 0, "").otherwise(F.concat(F.lit("N"), _text(n))).alias("source"), F.concat(F.lit("N"), _text(n * 3 % 2000)).alias("target"), F.array(F.concat(F.lit("X"), _text(n % 7))).alias("inline"), "path")
    return nodes, lines


@query(f"WITH {_REVIEW} SELECT * FROM found")
def q_classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.classify_errors(*_drawing(spark, sf_dir))


@query(f"WITH {_REVIEW} SELECT error_type, count(*) AS found, count(*) AS repaired FROM found GROUP BY 1")
def q_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.review(*_drawing(spark, sf_dir))["report"]


@query(f"""WITH {_REVIEW}, h AS (SELECT error_type, count(*) AS n FROM found GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS total_errors, CAST(sum(n) AS BIGINT) AS repaired, CAST(0 AS BIGINT) AS remaining, array_to_string(list(concat(error_type, '=', CAST(n AS VARCHAR)) ORDER BY error_type), ',') AS by_type, 1 AS iterations, false AS no_dangling_ref FROM h""")
def q_critic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.review(*_drawing(spark, sf_dir))["errors"]
    report = _again(sinks.critic_report(found, F.lit(1), integrity.gates(found, ["DANGLING_REF"]).drop("all_pass")))
    pairs = F.transform(F.array_sort(F.map_entries("by_type")), lambda e: F.concat(e["key"], F.lit("="), _text(e["value"])))
    return report.withColumn("by_type", F.array_join(pairs, ","))


@query(f"""WITH {_REVIEW}, bad AS (SELECT entity_id, bool_or(field = 'source') AS s, bool_or(field = 'target') AS t FROM found WHERE error_type = 'DANGLING_REF' GROUP BY 1)
SELECT concat('L', CAST(line AS VARCHAR)) AS id, CASE WHEN NOT coalesce(s, false) THEN source END AS source, CASE WHEN NOT coalesce(t, false) THEN target END AS target FROM e LEFT JOIN bad ON entity_id = concat('L', CAST(line AS VARCHAR))""")
def q_clear_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, lines = _drawing(spark, sf_dir)
    found = R.classify_errors(nodes, lines).withColumn("field", F.when(F.col("field").isin("source", "target"), F.concat("field", F.lit(".node_id"))).otherwise(F.col("field")))
    return integrity.clear_references(lines, found).select("id", "source", "target")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'other' ELSE 'engine' END AS model, CASE WHEN c_custkey % 4 = 0 THEN 'hand' ELSE 'merge' END AS method FROM customer")
def q_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("id"), F.when(k % 4 == 0, F.struct(F.lit("other").alias("model"), F.lit("hand").alias("method"))).alias("provenance"))
    return R.add_provenance(rows, "engine", "merge").select("id", "provenance.*")


def _severe(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    text = F.concat(F.lit("order "), _text(F.col("o_orderkey")), F.lit(" of customer "), _text(F.col("o_custkey")))
    return _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(F.floor(F.col("o_custkey") / 10).alias("run"), F.col("o_orderkey").alias("ord"), F.when(s == "F", "critical").when(s == "O", "error").otherwise("warning").alias("severity"), text.alias("text"))


_SEVERE = "e AS (SELECT o_custkey // 10 AS run, o_orderkey AS ord, CASE WHEN o_orderstatus = 'F' THEN 'critical' WHEN o_orderstatus = 'O' THEN 'error' ELSE 'warning' END AS severity, concat('order ', CAST(o_orderkey AS VARCHAR), ' of customer ', CAST(o_custkey AS VARCHAR)) AS text FROM orders)"


@query(f"WITH {_SEVERE} SELECT run, count(*) AS total, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'critical') AS critical, true AS has_errors, count(*) FILTER (severity = 'critical') > 0 AS has_critical FROM e GROUP BY 1")
def q_severity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.severity_summary(_severe(spark, sf_dir), ["run"])


@query(f"WITH {_SEVERE} SELECT ord, severity FROM e WHERE severity IN ('error', 'critical')")
def q_severe_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.of_severity(_severe(spark, sf_dir), "error").select("ord", "severity")


@query(f"""WITH {_SEVERE}, p AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ord) AS n FROM e) SELECT run, count(*) AS total, array_to_string(list(left(text, 12) ORDER BY n) FILTER (n <= 3), ';') AS first, CASE WHEN count(*) > 3 THEN concat('... and ', CAST(count(*) - 3 AS VARCHAR), ' more') END AS rest FROM p GROUP BY 1""")
def q_short_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.short_list(_severe(spark, sf_dir), ["run"], ["ord"], "text", 3, 12).withColumn("first", F.array_join("first", ";"))


@query("""SELECT c_custkey AS id, concat('Equipment E', CAST(c_custkey AS VARCHAR), ': inlet references unknown ''', CAST(c_custkey * 2 AS VARCHAR), '''') AS message, CASE WHEN c_custkey % 2 = 0 THEN concat('{"error":"X","entity_id":"E', CAST(c_custkey AS VARCHAR), '"}') ELSE '{"error":"X"}' END AS record FROM customer""")
def q_error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat(F.lit("E"), _text(k))
    rows = _read(spark, sf_dir, "customer", "c_custkey").withColumns({"error": F.lit("X"), "entity_id": F.when(k % 2 == 0, name), "source_tile": F.lit("")})
    return rows.select(k.alias("id"), errors.message(F.lit("equipment"), name, F.lit("inlet"), _text(k * 2)).alias("message"), errors.record("error", "entity_id", "source_tile").alias("record"))


# ------------------------------------------------------------------ OCR by tile

_DETECTED = """det AS (SELECT (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS ord, concat('tile_', CAST(l_suppkey AS VARCHAR)) AS tile, l_suppkey // 10 AS drawing, concat('w', CAST(l_partkey AS VARCHAR)) AS text, CASE CAST(l_partkey % 7 AS INT) WHEN 0 THEN 'equipment_tag' WHEN 1 THEN 'instrument_tag' WHEN 2 THEN 'valve_tag' WHEN 3 THEN 'line_number' WHEN 4 THEN 'measurement' WHEN 5 THEN 'label' END AS type,
 CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE (l_partkey % 10) / 10::DOUBLE END AS confidence FROM lineitem)"""


def _detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_partkey")
    kinds = F.create_map(*(x for n, name in enumerate(("equipment_tag", "instrument_tag", "valve_tag", "line_number", "measurement", "label")) for x in (F.lit(n), F.lit(name))))
    rows = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return rows.select(((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000_000 + k * 10_000 + F.col("l_suppkey")).alias("ord"), F.concat(F.lit("tile_"), _text(F.col("l_suppkey"))).alias("tile"), F.floor(F.col("l_suppkey") / 10).alias("drawing"), F.concat(F.lit("w"), _text(k)).alias("text"), F.try_element_at(kinds, (k % 7).cast("int")).alias("type"), F.when(k % 11 != 0, (k % 10) / F.lit(10.0)).alias("confidence"))


@query(f"""WITH {_DETECTED}, tiles AS (SELECT concat('tile_', CAST(s_suppkey AS VARCHAR)) AS tile FROM supplier UNION ALL SELECT 'tile_none'), s AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY ord) AS n FROM det WHERE coalesce(confidence, 0) >= 0.7),
g AS (SELECT tile, count(*) AS n_ocr, list(text ORDER BY ord) FILTER (type = 'equipment_tag') AS equipment, list(text ORDER BY ord) FILTER (type = 'line_number') AS lines, list(text ORDER BY ord) FILTER (n <= 30) AS shown FROM s GROUP BY 1)
SELECT tile, coalesce(n_ocr, 0) AS n_ocr, coalesce(len(equipment), 0) AS n_equipment, coalesce(array_to_string(equipment, ','), '') AS equipment, coalesce(array_to_string(lines, ','), '') AS lines, coalesce(array_to_string(shown, ','), '') AS shown, CASE WHEN n_ocr > 0 THEN 'grounded' ELSE 'free' END AS mode FROM tiles LEFT JOIN g USING (tile)""")
def q_prompt_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = _read(spark, sf_dir, "supplier", "s_suppkey").select(F.concat(F.lit("tile_"), _text(F.col("s_suppkey"))).alias("tile")).unionAll(spark.createDataFrame([("tile_none",)], "tile string"))
    out = ocr.prompt_inputs(tiles, _detected(spark, sf_dir))
    return out.select("tile", "n_ocr", "n_equipment", *(F.array_join(c, ",").alias(c) for c in ("equipment", "lines", "shown")), "mode")


@query(f"WITH {_DETECTED} SELECT tile, count(*) AS n, array_to_string(list(text ORDER BY ord), ',') AS texts FROM det GROUP BY 1")
def q_ocr_tile_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = sinks.ocr_tiles(_detected(spark, sf_dir).drop("drawing"))
    back = _again(nested, by="tile")
    return back.select("tile", F.col("total_detections").cast("long").alias("n"), F.array_join(F.transform("extractions", lambda e: e["text"]), ",").alias("texts"))


@query(f"""WITH {_DETECTED} SELECT drawing, count(*) AS total, count(DISTINCT tile) AS tiles, count(*) FILTER (type = 'valve_tag') AS valve_tags, count(*) FILTER (type = 'label') AS labels, coalesce(array_to_string(list(text ORDER BY ord) FILTER (type = 'measurement'), ','), '') AS measured FROM det GROUP BY 1""")
def q_ocr_global_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = _again(sinks.ocr_drawings(_detected(spark, sf_dir)))
    return back.select("drawing", F.col("total_detections").cast("long").alias("total"), F.size("tiles").cast("long").alias("tiles"), F.col("summary.valve_tags").cast("long").alias("valve_tags"), F.col("summary.labels").cast("long").alias("labels"), F.array_join(F.transform("detections.measurements", lambda e: e["text"]), ",").alias("measured"))


@query(f"WITH {_DETECTED} SELECT drawing, count(*) AS total_detections, count(DISTINCT tile) AS tiles, " + ", ".join(f"count(*) FILTER (type = '{kind}') AS {name}" for name, kind in ocr.SUMMARY_GROUPS.items()) + " FROM det GROUP BY 1")
def q_ocr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.summary(_detected(spark, sf_dir), ["drawing"])


@query("""WITH r AS (SELECT c_custkey AS id, CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'equipment' WHEN 1 THEN 'instruments' WHEN 2 THEN 'valves' WHEN 3 THEN 'lines' ELSE 'ocr' END AS kind, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS tag, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'K' END AS class, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE (c_custkey % 4) / 4::DOUBLE END AS confidence, c_custkey % 13 <> 0 AS boxed FROM customer)
SELECT id, kind, CASE kind WHEN 'ocr' THEN left(coalesce(tag, '?'), 20) WHEN 'instruments' THEN concat(coalesce(tag, '?'), ' [', coalesce(class, '?'), ']') WHEN 'lines' THEN NULL ELSE concat(coalesce(tag, '?'), ' (', coalesce(class, '?'), ')') END AS label FROM r WHERE kind <> 'valves' AND (kind = 'lines' OR coalesce(confidence, 1) >= 0.5) AND boxed""")
def q_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    kind = F.when(k % 5 == 0, "equipment").when(k % 5 == 1, "instruments").when(k % 5 == 2, "valves").when(k % 5 == 3, "lines").otherwise("ocr")
    rows = _read(spark, sf_dir, "customer", "c_custkey", "c_name").select(k.alias("id"), kind.alias("kind"), F.when(k % 6 != 0, F.col("c_name")).alias("tag"), F.when(k % 9 != 0, "K").alias("class"), F.when(k % 7 != 0, (k % 4) / F.lit(4.0)).alias("confidence"), F.when(k % 13 != 0, F.struct(k.alias("x1"))).alias("box"))
    return ocr.visible(rows, {"equipment": True, "instruments": True, "valves": False, "lines": True, "ocr": True}, 0.5).select("id", "kind", "label")


# ------------------------------------------------------------------ detection candidates

_SEGMENTS = """seg AS (SELECT DISTINCT (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS ord, l_orderkey // 8 AS image, CAST((l_partkey * 7) % 120 AS INT) AS x1, CAST((l_orderkey * 3) % 90 AS INT) AS y1, CAST((l_partkey * 7) % 120 + l_linenumber * 4 AS INT) AS x2, CAST((l_orderkey * 3) % 90 + (l_partkey % 2) * 3 AS INT) AS y2 FROM lineitem),
dash AS (SELECT * FROM (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS length, atan2(y2 - y1, x2 - x1) AS angle, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my FROM seg) WHERE length BETWEEN 5 AND 30)"""


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, o, n = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    x, y = (p * 7) % 120, (o * 3) % 90
    return _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").select(((o * 10 + n) * 1_000_000_000 + p * 10_000 + F.col("l_suppkey")).alias("ord"), F.floor(o / 8).alias("image"), x.cast("int").alias("x1"), y.cast("int").alias("y1"), (x + n * 4).cast("int").alias("x2"), (y + (p % 2) * 3).cast("int").alias("y2")).distinct()


@query(f"WITH {_SEGMENTS} SELECT ord, round(length, 6) AS length, round(angle, 6) AS angle FROM dash")
def q_dash_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vision.dash_segments(_segments(spark, sf_dir)).select("ord", F.round("length", 6).alias("length"), F.round("angle", 6).alias("angle"))


_CLUSTERS = f"""WITH RECURSIVE {_SEGMENTS}, near AS (SELECT p.ord AS a, q.ord AS b FROM dash p JOIN dash q ON p.image = q.image AND p.ord <> q.ord AND (p.mx - q.mx) ** 2 + (p.my - q.my) ** 2 + (100 * (p.angle - q.angle)) ** 2 <= 64),
core AS (SELECT a AS ord FROM near GROUP BY 1 HAVING count(*) + 1 >= 3), cc AS (SELECT ord AS x, ord AS y FROM core UNION SELECT cc.x, near.b FROM cc JOIN near ON near.a = cc.y WHERE near.b IN (FROM core)), part AS (SELECT x AS ord, min(y) AS cluster FROM cc GROUP BY 1),
edge AS (SELECT near.a AS ord, min(part.cluster) AS cluster FROM near JOIN part ON part.ord = near.b GROUP BY 1), lab AS (SELECT dash.*, coalesce(part.cluster, edge.cluster) AS cluster FROM dash LEFT JOIN part USING (ord) LEFT JOIN edge USING (ord))"""


@query(_CLUSTERS + """, m AS (SELECT image, cluster, avg(angle) AS aa, avg(length) AS ml, count(*) AS segments FROM lab WHERE cluster IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 3),
o AS (SELECT lab.*, m.segments, m.ml, row_number() OVER (PARTITION BY image, cluster ORDER BY CASE WHEN abs(aa) < pi() / 4 THEN mx ELSE my END, ord) AS n FROM lab JOIN m USING (image, cluster))
SELECT image, cluster, segments, round(any_value(ml), 6) AS mean_length, concat(CAST(any_value(x1) FILTER (n = 1) AS VARCHAR), ':', CAST(any_value(y1) FILTER (n = 1) AS VARCHAR), ' ', string_agg(concat(CAST(x2 AS VARCHAR), ':', CAST(y2 AS VARCHAR)), ' ' ORDER BY n)) AS path FROM o GROUP BY 1, 2, 3""")
def q_dashed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vision.dashed_lines(vision.cluster_dashes(vision.dash_segments(_segments(spark, sf_dir)), ["image"], 8), ["image"])
    return found.select("image", "cluster", "segments", F.round("mean_length", 6).alias("mean_length"), F.array_join(F.transform("path", lambda p: F.concat(_text(p["x"]), F.lit(":"), _text(p["y"]))), " ").alias("path"))


@query("""WITH c AS (SELECT p_partkey AS ord, p_partkey // 50 AS image, CAST(p_partkey % 5 + 2 AS INT) AS vertices, p_size * 40 + p_partkey % 100 AS area, CAST(p_size AS INT) AS w, CAST(p_partkey % 6 * 7 AS INT) AS h FROM part),
r AS (SELECT *, CASE WHEN h = 0 THEN 0 ELSE w / h END AS ratio FROM c) SELECT image, ord, printf('CV-RECT-%03d', row_number() OVER (PARTITION BY image ORDER BY ord)) AS id, round(ratio, 2) AS aspect_ratio FROM r WHERE vertices = 4 AND area BETWEEN 500 AND 50000 AND ratio BETWEEN 0.5 AND 2""")
def q_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = _read(spark, sf_dir, "part", "p_partkey", "p_size").select(k.alias("ord"), F.floor(k / 50).alias("image"), (k % 5 + 2).cast("int").alias("vertices"), (F.col("p_size") * 40 + k % 100).alias("area"), F.col("p_size").cast("int").alias("w"), (k % 6 * 7).cast("int").alias("h"))
    return vision.with_candidate_ids(vision.rectangles(rows), "CV-RECT", ["image"], ["ord"]).select("image", "ord", "id", "aspect_ratio")


@query("""WITH c AS (SELECT p_partkey // 50 AS image, CASE WHEN p_partkey % 9 = 0 THEN 'InstrumentBubble' WHEN (p_partkey % 50) / greatest(1, p_size * 3) > 0.3 THEN 'ControlRoomInstrument' ELSE 'FieldInstrument' END AS type, p_partkey % 2 AS rect FROM part)
SELECT image, count(*) AS total_circles, count(*) FILTER (rect = 1) AS total_rectangles, count(*) FILTER (type = 'FieldInstrument') AS field_instruments, count(*) FILTER (type = 'ControlRoomInstrument') AS control_room_instruments FROM c GROUP BY 1""")
def q_shape_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = _read(spark, sf_dir, "part", "p_partkey", "p_size").select(F.floor(k / 50).alias("image"), (k % 50).alias("middle"), F.when(k % 9 != 0, F.col("p_size") * 3).alias("total"), (k % 2).alias("rect"))
    return vision.shape_summary(rows.withColumn("type", vision.circle_type()), rows.filter("rect = 1"), ["image"])


@query(f"WITH {_SEGMENTS} SELECT ord, CAST(trunc(x1 / 200 * 1000) AS INT) AS sx, CAST(trunc(y2 / 100 * 1000) AS INT) AS ty, 2 AS points FROM seg")
def q_solid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _segments(spark, sf_dir).withColumns({"width": F.lit(200), "height": F.lit(100)})
    return vision.solid_lines(rows).select("ord", F.col("path")[0]["x"].alias("sx"), F.col("path")[1]["y"].alias("ty"), F.size("path").alias("points"))


@query(f"WITH {_SEGMENTS} SELECT ord, CASE WHEN x1 = x2 AND y1 = y2 THEN 'point' WHEN degrees(atan2(abs(y2 - y1), abs(x2 - x1))) <= 15 THEN 'horizontal' WHEN degrees(atan2(abs(y2 - y1), abs(x2 - x1))) >= 75 THEN 'vertical' ELSE 'diagonal' END AS way, CAST(trunc(x1 / 1000 * 640) AS INT) AS px FROM seg")
def q_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select("ord", G.orientation(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("way"), G.from_grid(F.col("x1"), F.lit(640)).alias("px"))


@query("""WITH p AS (SELECT p_partkey AS page, CAST(500 + p_size * 97 AS INT) AS w, CAST(400 + p_size * 61 AS INT) AS h FROM part) SELECT page, CAST(ceil(w / 2048) * ceil(h / 2048) AS BIGINT) AS n_tiles, printf('tile_%02d_%02d.png', CAST(ceil(h / 2048) AS INT) - 1, CAST(ceil(w / 2048) AS INT) - 1) AS last_file, CAST(ceil(w / 2048) * ceil(h / 2048) AS INT) - 1 AS last_id FROM p""")
def q_tile_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part", "p_partkey", "p_size")
    pages = p.select(F.col("p_partkey").alias("page"), (500 + F.col("p_size") * 97).cast("int").alias("width"), (400 + F.col("p_size") * 61).cast("int").alias("height"), F.lit(2048).alias("most"))
    back = _again(sinks.tile_table(spatial.tile_grid(pages), F.lit("a.png"), 0.1))
    last = F.element_at("tiles", -1)
    return back.select("page", F.size("tiles").cast("long").alias("n_tiles"), last["filename"].alias("last_file"), last["tile_id"].alias("last_id"))


@query("""WITH m AS (SELECT metric, CAST(value AS DOUBLE) AS value, side FROM (SELECT l_returnflag = 'A' AS side, count(*) AS orphan_nodes, count(*) FILTER (l_quantity > 25) AS label_coverage FROM lineitem GROUP BY 1) UNPIVOT (value FOR metric IN (orphan_nodes, label_coverage)))
SELECT a.metric, CASE WHEN a.metric = 'orphan_nodes' THEN a.value - b.value ELSE b.value - a.value END AS gain FROM m a JOIN m b ON a.metric = b.metric AND a.side AND NOT b.side""")
def q_comparison_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity")
    names = ["orphan_nodes", "label_coverage"]

    def side(first: bool) -> DataFrame:
        return items.filter((F.col("l_returnflag") == "A") == first).agg(F.count(F.lit(1)).cast("double").alias(names[0]), F.count_if(F.col("l_quantity") > 25).cast("double").alias(names[1])).unpivot([], names, "metric", "value")

    back = _again(sinks.comparison_report(integrity.compare_metrics(side(True), side(False))))
    return back.select(F.explode("comparison").alias("metric", "v")).select("metric", "v.gain")


@query("""WITH t AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS n, conv_id FROM conversations WHERE role = 'user') SELECT count(*) + 1 AS parts, count(*) FILTER (conv_id % 3 = 0) AS correct FROM t""")
def q_markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.decks import zipped

    asked = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role").filter("role = 'user'").select("conv_id", "turn", F.lit("q").alias("question"), F.lit("a").alias("expected"))
    got = asked.select("conv_id", "turn", F.when(F.col("conv_id") % 3 == 0, "a").otherwise("b").alias("actual"), F.lit(1.5).alias("duration"), F.lit(2).alias("tool_calls"), F.lit("").alias("summary"), F.lit(None).cast("string").alias("feedback")).withColumnRenamed("conv_id", "c").withColumnRenamed("turn", "t")
    tasks = zipped(asked, got, ["conv_id", "turn"], ["c", "t"])
    summary = documents.run_report(tasks).crossJoin(tasks.agg(F.count_if(F.col("actual") == F.col("expected")).alias("correct")))  # one row each
    at = _folder(spark)
    sinks.write_text(sinks.markdown_report(summary, tasks), at)
    lines = spark.read.text(at)
    return lines.agg(F.count_if(F.col("value").startswith("#") & F.col("value").rlike("^#+ (Task [0-9]+|Evaluation report)")).alias("parts"), F.count_if(F.col("value") == "**Correct**: yes").alias("correct"))


@query("""WITH m AS (SELECT l_linenumber % 4 AS run, count(*) AS orphan_nodes, count(*) FILTER (l_quantity > 25) AS ocr_unvalidated, count(*) FILTER (l_discount > 0.05) AS total_lines FROM lineitem GROUP BY 1),
u AS (SELECT run, metric, CAST(value AS DOUBLE) AS value FROM m UNPIVOT (value FOR metric IN (orphan_nodes, ocr_unvalidated, total_lines)))
SELECT CAST(b.run AS INT) AS step, a.metric, a.value AS "before", b.value AS "after", CASE WHEN a.metric = 'orphan_nodes' OR (a.metric = 'ocr_unvalidated' AND b.run = 1) THEN a.value - b.value ELSE b.value - a.value END AS gain FROM u a JOIN u b ON a.metric = b.metric AND b.run = a.run + 1 WHERE b.run <= 2""")
def q_compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "lineitem", "l_linenumber", "l_quantity", "l_discount")
    names = ["orphan_nodes", "ocr_unvalidated", "total_lines"]

    def run(n: int) -> DataFrame:
        one = items.filter(F.col("l_linenumber") % 4 == n).agg(F.count(F.lit(1)).cast("double").alias(names[0]), F.count_if(F.col("l_quantity") > 25).cast("double").alias(names[1]), F.count_if(F.col("l_discount") > 0.05).cast("double").alias(names[2]))
        return one.unpivot([], names, "metric", "value")

    return integrity.compare_runs([run(n) for n in range(4)])


@query(f"WITH {_DETECTED}, tiles AS (SELECT concat('tile_', CAST(s_suppkey AS VARCHAR)) AS tile FROM supplier), g AS (SELECT tile, count(*) AS n FROM det WHERE coalesce(confidence, 0) >= 0.7 GROUP BY 1) SELECT tile, coalesce(n, 0) AS n_ocr, CASE WHEN n > 0 THEN 'grounded' ELSE 'free' END AS mode FROM tiles LEFT JOIN g USING (tile)")
def q_prompt_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = _read(spark, sf_dir, "supplier", "s_suppkey").select(F.concat(F.lit("tile_"), _text(F.col("s_suppkey"))).alias("tile"))
    back = _again(sinks.prompt_documents(ocr.prompt_inputs(tiles, _detected(spark, sf_dir))), by="tile")
    return back.select("tile", "prompt.n_ocr", "prompt.mode")


@query(f"""WITH {_SEGMENTS}, s AS (SELECT image, count(*) AS total, count(*) FILTER (x1 < 60) AS solid FROM seg GROUP BY 1), r AS (SELECT p_partkey // 50 AS image, count(*) AS shapes FROM part GROUP BY 1)
SELECT coalesce(s.image, r.image) AS image, coalesce(solid, 0) AS solid, coalesce(total - solid, 0) AS dashed, coalesce(shapes, 0) AS shapes FROM s FULL JOIN r ON r.image = s.image""")
def q_candidate_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _segments(spark, sf_dir).select("image", "ord", F.when(F.col("x1") < 60, "Process_Candidate").otherwise("Signal_Candidate").alias("type"), "x1", "y1")
    shapes = _read(spark, sf_dir, "part", "p_partkey").select(F.floor(F.col("p_partkey") / 50).alias("image"), F.col("p_partkey").alias("ord"), F.lit("FieldInstrument").alias("type"))
    back = _again(sinks.candidate_documents(lines, shapes))
    return back.select("image", *(F.col(f"summary.{a}").cast("long").alias(b) for a, b in (("total_solid_lines", "solid"), ("total_dashed_lines", "dashed"), ("total_shapes", "shapes"))))


@query("SELECT o_orderstatus AS name, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY 1")
def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _read(spark, sf_dir, "orders", "o_orderstatus").groupBy(F.col("o_orderstatus").alias("name")).agg(_text(F.count(F.lit(1))).alias("value"))
    return _again(sinks.manifest(steps)).select(F.explode("outputs").alias("name", "value"))
