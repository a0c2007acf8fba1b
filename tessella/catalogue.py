"""All queries over the reference's own operators, with their DuckDB oracles.

The test tables hold no drawings, so inputs are derived from them by integer arithmetic that both engines
share. Each query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import css as C
from .functions import geometry as G
from .functions import text as X
from .operators import dedup, documents, errors, graph, integrity, spatial

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


# ------------------------------------------------------------------ derived inputs

_BOXES = """boxes AS (SELECT p_partkey AS id, p_partkey AS ord, CAST(p_partkey % 4 AS INT) AS tile, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE concat('V-', CAST(100 + p_partkey % 500 AS VARCHAR)) END AS tag,
  CAST((p_partkey * 53) % 900 AS INT) AS y1, CAST((p_partkey * 37) % 900 AS INT) AS x1, CAST((p_partkey * 53) % 900 + 10 + p_size % 20 AS INT) AS y2, CAST((p_partkey * 37) % 900 + 10 + p_size AS INT) AS x2, CAST((p_partkey * 7919) % 1000 AS INT) AS confidence FROM part)"""


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part", "p_partkey", "p_size")
    k = F.col("p_partkey")
    y, x = ((k * 53) % 900).cast("int"), ((k * 37) % 900).cast("int")
    return p.select(
        k.alias("id"), k.alias("ord"), (k % 4).cast("int").alias("tile"), F.when(k % 4 != 0, F.concat(F.lit("V-"), (100 + k % 500).cast("string"))).alias("tag"),
        F.struct(y.alias("y1"), x.alias("x1"), (y + 10 + F.col("p_size") % 20).cast("int").alias("y2"), (x + 10 + F.col("p_size")).cast("int").alias("x2")).alias("box"), ((k * 7919) % 1000).cast("int").alias("confidence"),
    )


_LINES = """lines AS (SELECT c_custkey AS line, c_custkey AS ord, CAST(c_custkey // 40 AS INT) AS sheet, CASE WHEN c_custkey % 5 = 0 THEN concat('L', CAST(c_custkey % 97 AS VARCHAR)) END AS label,
  CAST((c_custkey * 61) % 1000 AS INT) AS ax, CAST((c_custkey * 83) % 1000 AS INT) AS ay,
  CAST((c_custkey * 61) % 1000 + 40 + c_custkey % 60 AS INT) AS bx, CAST(CASE WHEN c_custkey % 3 = 0 THEN (c_custkey * 83) % 1000 + c_custkey % 50 ELSE (c_custkey * 83) % 1000 END AS INT) AS "by",
  CAST((c_custkey * 61) % 1000 + 40 + c_custkey % 60 AS INT) AS cx, CAST((c_custkey * 83) % 1000 + 30 + c_custkey % 70 AS INT) AS cy, CAST((c_custkey * 31) % 1000 AS INT) AS confidence FROM customer)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer", "c_custkey")
    k = F.col("c_custkey")
    ax, ay = (k * 61) % 1000, (k * 83) % 1000
    bx, cy = ax + 40 + k % 60, ay + 30 + k % 70
    by = F.when(k % 3 == 0, ay + k % 50).otherwise(ay)
    point = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    return c.select(k.alias("line"), k.alias("ord"), F.floor(k / 40).cast("int").alias("sheet"), F.when(k % 5 == 0, F.concat(F.lit("L"), (k % 97).cast("string"))).alias("label"), F.array(point(ax, ay), point(bx, by), point(bx, cy)).alias("path"), ((k * 31) % 1000).cast("int").alias("confidence"))


_TAGS = """tags AS (SELECT c_custkey AS id, CASE CAST(c_custkey % 10 AS INT) WHEN 0 THEN concat('TIC-', CAST(100 + c_custkey % 300 AS VARCHAR)) WHEN 1 THEN concat('P-', CAST(100 + c_custkey % 200 AS VARCHAR), 'A') WHEN 2 THEN concat('BV-', CAST(c_custkey % 90 + 10 AS VARCHAR))
  WHEN 3 THEN concat(CAST(c_custkey % 9 + 1 AS VARCHAR), '-PA-', CAST(100 + c_custkey % 700 AS VARCHAR)) WHEN 4 THEN concat(CAST(c_custkey % 300 AS VARCHAR), ' PSI') WHEN 5 THEN concat(CAST(c_custkey % 101 AS VARCHAR), '%') WHEN 6 THEN concat(' tk', CAST(100 + c_custkey % 50 AS VARCHAR), ' ')
  WHEN 7 THEN c_mktsegment WHEN 8 THEN concat('V-', CAST(100 + c_custkey % 400 AS VARCHAR)) ELSE 'X' END AS tag FROM customer)"""


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    s = lambda c: c.cast("string")
    forms = [
        F.concat(F.lit("TIC-"), s(100 + k % 300)), F.concat(F.lit("P-"), s(100 + k % 200), F.lit("A")), F.concat(F.lit("BV-"), s(k % 90 + 10)), F.concat(s(k % 9 + 1), F.lit("-PA-"), s(100 + k % 700)),
        F.concat(s(k % 300), F.lit(" PSI")), F.concat(s(k % 101), F.lit("%")), F.concat(F.lit(" tk"), s(100 + k % 50), F.lit(" ")), F.col("c_mktsegment"), F.concat(F.lit("V-"), s(100 + k % 400)),
    ]
    tag = F.when(k % 10 == 0, forms[0])
    for n, form in enumerate(forms[1:], 1):
        tag = tag.when(k % 10 == n, form)
    return _read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").select(k.alias("id"), tag.otherwise("X").alias("tag"))


_WORDS = "words AS (SELECT s_suppkey AS ord, CASE WHEN s_suppkey % 2 = 0 THEN concat('v-', CAST(100 + s_suppkey * 3 AS VARCHAR)) ELSE concat('TIC-', CAST(100 + s_suppkey * 2 AS VARCHAR), CASE WHEN s_suppkey % 3 = 0 THEN 'B' ELSE '' END) END AS text FROM supplier)"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    odd = F.concat(F.lit("TIC-"), (100 + k * 2).cast("string"), F.when(k % 3 == 0, "B").otherwise(""))
    return _read(spark, sf_dir, "supplier", "s_suppkey").select(k.alias("ord"), F.when(k % 2 == 0, F.concat(F.lit("v-"), (100 + k * 3).cast("string"))).otherwise(odd).alias("text"))


_OVER = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
_AREA = "(({0}.x2 - {0}.x1) * ({0}.y2 - {0}.y1))"
_SMALLER = f"CAST({_OVER} AS DOUBLE) / least({_AREA.format('a')}, {_AREA.format('b')})"

# ------------------------------------------------------------------ references


@query("""SELECT 4 AS phase, concat('O-', CAST(o_orderkey AS VARCHAR)) AS source_id, 'source.node_id' AS field, concat('C-', CAST(o_custkey AS VARCHAR)) AS missing_reference FROM orders
WHERE o_orderstatus <> 'P' AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def q_unresolved_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    refs = o.select(F.lit(4).alias("phase"), F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("source_id"), F.lit("source.node_id").alias("field"), F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("ref"), F.when(F.col("o_orderstatus") == "P", "OffPage").alias("ref_type"))
    ids = _read(spark, sf_dir, "customer", "c_custkey", "c_acctbal").filter("c_acctbal > 0").select(F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("id"))
    return integrity.unresolved_references(refs, ids)


@query("""SELECT concat('C-', CAST(c_custkey AS VARCHAR)) AS id, concat('T-', CAST(c_custkey % 700 AS VARCHAR)) AS tag FROM customer WHERE c_custkey % 3 <> 0
AND concat('C-', CAST(c_custkey AS VARCHAR)) NOT IN (SELECT concat('C-', CAST(o_custkey * 2 AS VARCHAR)) FROM orders WHERE o_orderkey % 2 = 0)
AND concat('T-', CAST(c_custkey % 700 AS VARCHAR)) NOT IN (SELECT concat('T-', CAST(o_custkey * 2 % 700 AS VARCHAR)) FROM orders WHERE o_orderkey % 2 = 1)""")
def q_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    nodes = _read(spark, sf_dir, "customer", "c_custkey").select(F.concat(F.lit("C-"), k.cast("string")).alias("id"), F.concat(F.lit("T-"), (k % 700).cast("string")).alias("tag"), F.when(k % 3 == 0, 1).otherwise(0).alias("links"))
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    ref = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("C-"), (F.col("o_custkey") * 2).cast("string"))).otherwise(F.concat(F.lit("T-"), (F.col("o_custkey") * 2 % 700).cast("string")))
    return integrity.orphans(nodes, o.select(ref.alias("ref")))


@query("""WITH l AS (SELECT o_orderkey AS loop_id, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS sensor, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS final_element FROM orders)
SELECT loop_id, 'sensor' AS missing FROM l WHERE coalesce(sensor, '') = '' UNION ALL SELECT loop_id, 'final_element' FROM l WHERE coalesce(final_element, '') = ''""")
def q_incomplete_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    return integrity.incomplete_loops(o.select(k.alias("loop_id"), F.when(k % 7 == 0, "").when(k % 11 == 0, None).otherwise(F.col("o_orderpriority")).alias("sensor"), F.when(k % 13 != 0, F.col("o_orderstatus")).alias("final_element")))


# ------------------------------------------------------------------ tags and tiles

_CLASS = """CASE WHEN length(t) < 2 OR length(t) > 20 THEN 'label' WHEN regexp_matches(t, '^\\d{1,2}\\.?\\d?["''-]?[A-Z]{2,4}[-]?\\d{2,4}') THEN 'line_number' WHEN regexp_matches(t, '^[AFHLPSTQVW][A-Z]{1,3}-?\\d{2,5}$') THEN 'instrument_tag'
WHEN regexp_matches(t, '^[AFHLPT]V-?\\d{2,4}$') THEN 'valve_tag' WHEN regexp_matches(t, '^[BHM]?V-?\\d{2,4}[A-Z]?$') THEN 'valve_tag' WHEN regexp_matches(t, '^[A-Z]{1,2}-\\d{2,4}[A-Z]?$') THEN 'equipment_tag' WHEN regexp_matches(t, '^(TK|HX|RX|CV|FD)-?\\d{2,4}[A-Z]?$') THEN 'equipment_tag'
WHEN regexp_matches(t, '^\\d+\\.?\\d*\\s*(PSI|PSIG|PSIA|BAR|BARG|°?[CF]|MM|IN|GPM|LPM|M3/H)') THEN 'measurement' WHEN regexp_matches(t, '^\\d+\\.?\\d*\\s*%$') THEN 'measurement' ELSE 'label' END"""


@query(f"WITH {_TAGS}, c AS (SELECT {_CLASS} AS class FROM (SELECT upper(trim(tag)) AS t FROM tags)) SELECT class, count(*) AS n FROM c GROUP BY 1")
def q_classify_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tags(spark, sf_dir).groupBy(X.classify_tag(F.col("tag")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT p_partkey AS page, CAST(500 + p_size * 97 AS INT) AS width, CAST(400 + p_size * 61 AS INT) AS height, 2048 AS most FROM part WHERE p_partkey IS NOT NULL),
g AS (SELECT *, CAST(ceil(height / most) AS INT) AS rws, CAST(ceil(width / most) AS INT) AS cls FROM p),
b AS (SELECT *, CAST(ceil(width / cls) AS INT) AS bw, CAST(ceil(height / rws) AS INT) AS bh FROM g),
t AS (SELECT *, CAST(trunc(bw * 0.1::DOUBLE) AS INT) AS pw, CAST(trunc(bh * 0.1::DOUBLE) AS INT) AS ph, CAST(r.range AS INT) AS rw, CAST(c.range AS INT) AS cl FROM b, range(0, rws) r, range(0, cls) c),
x AS (SELECT page, rw AS "row", cl AS col, greatest(0, cl * bw - pw) AS px1, greatest(0, rw * bh - ph) AS py1, least(width, (cl + 1) * bw + pw) AS px2, least(height, (rw + 1) * bh + ph) AS py2, width, height FROM t)
SELECT page, "row", col, px1, py1, px2, py2, CAST(trunc(px1 / width * 1000) AS INT) AS nx1, CAST(trunc(py1 / height * 1000) AS INT) AS ny1, CAST(trunc(px2 / width * 1000) AS INT) AS nx2, CAST(trunc(py2 / height * 1000) AS INT) AS ny2 FROM x""")
def q_tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part", "p_partkey", "p_size")
    return spatial.tile_grid(p.select(F.col("p_partkey").alias("page"), (500 + F.col("p_size") * 97).cast("int").alias("width"), (400 + F.col("p_size") * 61).cast("int").alias("height"), F.lit(2048).alias("most")))


_PLACES = {0: (0, 0, 549, 549), 1: (450, 0, 1000, 549), 2: (0, 450, 549, 1000)}


def _tile_places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in _PLACES.items()], "tile int, tx1 int, ty1 int, tx2 int, ty2 int")


_TILES = "tiles AS (SELECT * FROM (VALUES (0, 0, 0, 549, 549), (1, 450, 0, 1000, 549), (2, 0, 450, 549, 1000)) AS v(tile, tx1, ty1, tx2, ty2))"


@query(f"""WITH {_BOXES}, {_TILES}, j AS (SELECT b.*, coalesce(tx1, 0) AS tx1, coalesce(ty1, 0) AS ty1, coalesce(tx2, 1000) AS tx2, coalesce(ty2, 1000) AS ty2 FROM boxes b LEFT JOIN tiles USING (tile))
SELECT id, CAST(trunc(ty1 + y1 / 1000::DOUBLE * (ty2 - ty1)) AS INT) AS gy1, CAST(trunc(tx1 + x1 / 1000::DOUBLE * (tx2 - tx1)) AS INT) AS gx1, CAST(trunc(ty1 + y2 / 1000::DOUBLE * (ty2 - ty1)) AS INT) AS gy2, CAST(trunc(tx1 + x2 / 1000::DOUBLE * (tx2 - tx1)) AS INT) AS gx2 FROM j""")
def q_tile_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _boxes(spark, sf_dir).join(F.broadcast(_tile_places(spark)), "tile", "left").fillna({"tx1": 0, "ty1": 0, "tx2": 1000, "ty2": 1000})
    return j.select("id", *(G.to_global(F.col(f"box.{c}"), F.col(f"t{c[0]}1"), F.col(f"t{c[0]}2")).alias(f"g{c}") for c in ("y1", "x1", "y2", "x2")))


@query(f"""WITH {_LINES}, p AS (SELECT line, unnest([0, 1, 2]) AS pos, unnest([ax, bx, cx]) AS x, unnest([ay, "by", cy]) AS y FROM lines)
SELECT line, pos, CAST(trunc(450 + x / 1000::DOUBLE * 550) AS INT) AS gx, CAST(trunc(y / 1000::DOUBLE * 549) AS INT) AS gy FROM p""")
def q_waypoint_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = G.path_to_global(F.col("path"), F.lit(450), F.lit(1000), F.lit(0), F.lit(549))
    return _lines(spark, sf_dir).select("line", F.posexplode(moved).alias("pos", "p")).select("line", "pos", F.col("p.x").alias("gx"), F.col("p.y").alias("gy"))


@query(f"WITH {_BOXES} SELECT id, tag FROM boxes WHERE coalesce(CASE WHEN id % 9 = 0 THEN NULL ELSE confidence END, 1000) >= 600")
def q_min_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).withColumn("confidence", F.when(F.col("id") % 9 != 0, F.col("confidence")))
    return integrity.confident(rows, 600, missing=1000).select("id", "tag")


# ------------------------------------------------------------------ boxes


@query(f"WITH {_BOXES} SELECT a.id // 200 AS page, a.id AS a, b.id AS b, round({_SMALLER}, 6) AS overlap FROM boxes a JOIN boxes b ON a.id // 200 = b.id // 200 AND a.id < b.id WHERE {_SMALLER} >= 0.5")
def q_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(spark, sf_dir).withColumn("page", F.floor(F.col("id") / 200))
    pairs = spatial.box_pairs(boxes, ["page"], lambda a, b: G.overlap_of_smaller(a, b) >= 0.5, 64)
    return pairs.select("page", "a", "b", F.round(G.overlap_of_smaller(F.col("box_a"), F.col("box_b")), 6).alias("overlap"))


_INCHES = 'inches AS (SELECT p_partkey AS id, p_partkey % 50 AS slide, (p_partkey * 37 % 900) / 100::DOUBLE AS x1, (p_partkey * 53 % 700) / 100::DOUBLE AS y1, (p_partkey * 37 % 900) / 100::DOUBLE + p_size / 10::DOUBLE AS x2, (p_partkey * 53 % 700) / 100::DOUBLE + (p_size % 20 + 1) / 10::DOUBLE AS y2 FROM part)'


def _inches(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    x, y = (k * 37 % 900) / F.lit(100.0), (k * 53 % 700) / F.lit(100.0)
    return _read(spark, sf_dir, "part", "p_partkey", "p_size").select(k.alias("id"), (k % 50).alias("slide"), F.struct(y.alias("y1"), x.alias("x1"), (y + (s % 20 + 1) / F.lit(10.0)).alias("y2"), (x + s / F.lit(10.0)).alias("x2")).alias("box"))


@query(f"""WITH {_INCHES}, p AS (SELECT a.slide, a.id AS a, b.id AS b, least(a.x2, b.x2) - greatest(a.x1, b.x1) AS w, least(a.y2, b.y2) - greatest(a.y1, b.y1) AS h FROM inches a JOIN inches b ON a.slide = b.slide AND a.id < b.id)
SELECT slide, unnest([a, b]) AS id, unnest([b, a]) AS other, round(w * h, 2) AS area FROM p WHERE w > 0.05 AND h > 0.05""")
def q_shape_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.shape_overlaps(_inches(spark, sf_dir))


@query(f"WITH {_BOXES}, n AS (SELECT *, coalesce(nullif(tag, ''), CAST(id AS VARCHAR)) AS name FROM boxes) SELECT tile, name, id FROM (SELECT *, row_number() OVER (PARTITION BY tile, name ORDER BY confidence DESC, ord) AS r FROM n) WHERE r = 1")
def q_best_per_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.best_per_name(_boxes(spark, sf_dir), ["tile"]).select("tile", "name", "id")


@query(f"""WITH {_BOXES}, n AS (SELECT *, coalesce(nullif(tag, ''), CAST(id AS VARCHAR)) AS name FROM boxes), r AS (SELECT *, row_number() OVER (PARTITION BY tile, name ORDER BY confidence DESC, ord) AS r FROM n),
j AS (SELECT a.*, CASE WHEN a.r = 1 THEN 'best' WHEN {_SMALLER} < 0.2 THEN 'renamed' ELSE 'merged_duplicate' END AS action FROM r a JOIN r b ON a.tile = b.tile AND a.name = b.name AND b.r = 1)
SELECT id, name, action, CASE WHEN action = 'renamed' THEN concat(CAST(id AS VARCHAR), '_dup') ELSE CAST(id AS VARCHAR) END AS new_id FROM j""")
def q_keyed_dedup_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keyed_dedup(_boxes(spark, sf_dir), ["tile"], 0.2).select("id", "name", "action", "new_id")


def _greedy(rows: str, order: str, group: str, conflict: str) -> str:
    """The sequential rule as a recursive CTE, group by group in rank order. conflict compares u (kept) with v."""
    return f"""WITH RECURSIVE {rows}, v AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS k FROM src),
walk AS (SELECT {group}, 0::BIGINT AS k, []::BIGINT[] AS kept FROM (SELECT DISTINCT {group} FROM v)
 UNION ALL SELECT w.{group}, v.k, CASE WHEN EXISTS (SELECT 1 FROM src u WHERE u.{group} = v.{group} AND list_contains(w.kept, u.ord) AND ({conflict})) THEN w.kept ELSE list_append(w.kept, v.ord) END FROM walk w JOIN v ON v.{group} = w.{group} AND v.k = w.k + 1)
SELECT DISTINCT unnest(kept) AS ord FROM (SELECT kept FROM walk QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY k DESC) = 1)"""


_UV = _SMALLER.replace("a.", "u.").replace("b.", "v.")


@query(_greedy(f"{_BOXES}, src AS (SELECT id, ord, tag, confidence, x1 % 150 AS x1, x1 % 150 + x2 - x1 AS x2, y1 % 150 AS y1, y1 % 150 + y2 - y1 AS y2, id // 100 AS g FROM boxes)", "tag IS NULL, confidence DESC, ord", "g", f"(u.tag IS NULL OR v.tag IS NULL OR u.tag = v.tag) AND {_UV} >= 0.3"))
def q_greedy_suppress(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = lambda c: F.col(f"box.{c}") % 150
    size = lambda c: F.col(f"box.{c}2") - F.col(f"box.{c}1")
    tight = G.box(low("y1"), low("x1"), low("y1") + size("y"), low("x1") + size("x"))
    return dedup.spatial_dedup(_boxes(spark, sf_dir).withColumns({"box": tight, "g": F.floor(F.col("id") / 100)}), ["g"], 0.3).filter("kept").select("ord")


@query(_greedy(f"{_BOXES}, src AS (SELECT *, id % 25 AS g FROM boxes)", "confidence DESC, ord", "g", f"CAST({_OVER.replace('a.', 'v.').replace('b.', 'u.')} AS DOUBLE) / {_AREA.format('v')} > 0.4"))
def q_ocr_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).withColumn("text", F.concat(F.when(F.col("id") % 2 == 0, F.lit("w")).otherwise(F.lit("W")), (F.col("id") % 25).cast("string")))
    return dedup.ocr_dedup(rows.drop("id", "tag"), 0.4).filter("kept").select("ord")


@query(f"""WITH {_BOXES}, {_WORDS}, w AS (SELECT ord, (ord * 71) % 950 AS x, (ord * 43) % 950 AS y FROM words), b AS (SELECT id AS l, (x1 + x2) // 2 AS x, (y1 + y2) // 2 AS y FROM boxes),
p AS (SELECT l, ord AS r, (b.x - w.x) * (b.x - w.x) + (b.y - w.y) * (b.y - w.y) AS d2 FROM b, w)
SELECT l, r, round(sqrt(d2), 2) AS distance FROM p WHERE d2 <= 10000 QUALIFY row_number() OVER (PARTITION BY l ORDER BY d2, r) = 1""")
def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = lambda a, b: F.floor((F.col(f"box.{a}") + F.col(f"box.{b}")) / 2)
    left = _boxes(spark, sf_dir).select(F.col("id").alias("l"), half("x1", "x2").alias("x"), half("y1", "y2").alias("y"))
    right = _words(spark, sf_dir).select(F.col("ord").alias("r"), "ord", ((F.col("ord") * 71) % 950).alias("x"), ((F.col("ord") * 43) % 950).alias("y"))
    return spatial.nearest(left, right, 100)


# ------------------------------------------------------------------ lines

_DIST = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))"
_POINTS = 'pts AS (SELECT *, unnest([ax, bx, cx]) AS x, unnest([ay, "by", cy]) AS y FROM lines)'
_MEANS = f"means AS (SELECT a, b, avg(d) AS m FROM (SELECT p.line AS a, q.line AS b, p.x, p.y, min({_DIST}) AS d, any_value(p.k) AS k FROM (SELECT *, row_number() OVER () AS k FROM pts) p JOIN pts q ON p.sheet = q.sheet AND p.line <> q.line GROUP BY p.line, q.line, p.k, p.x, p.y) GROUP BY 1, 2)"
_SIM = "CASE WHEN m <= 50 THEN 1 - m / 100 WHEN m <= 250 THEN 0.5 * (250 - m) / 200 ELSE 0 END"


@query(f"WITH {_LINES}, {_POINTS}, {_MEANS} SELECT a, b, round({_SIM}, 6) AS similarity FROM means")
def q_path_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    side = lambda s: lines.select("sheet", F.col("line").alias(s), F.col("path").alias(f"path_{s}"))
    return side("a").join(side("b"), "sheet").filter("a <> b").select("a", "b", F.round(G.path_similarity(F.col("path_a"), F.col("path_b")), 6).alias("similarity"))


_CLASH = """(u.src = v.src AND u.tgt = v.tgt) OR u.name = v.name OR list_avg(list_transform(v.p, lambda a: list_min(list_transform(u.p, lambda b: sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)))))) <= 30"""


@query(_greedy(f"""{_LINES}, src AS (SELECT ord, sheet AS g, confidence, line % 30 AS src, line % 3 AS tgt, line % 37 AS name, [{{'x': ax, 'y': ay}}, {{'x': bx, 'y': "by"}}, {{'x': cx, 'y': cy}}] AS p FROM lines)""", "confidence DESC, ord", "g", _CLASH))
def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("line")
    rows = _lines(spark, sf_dir).select("sheet", "ord", "path", "confidence", (k % 37).alias("name"), (k % 30).alias("source"), (k % 3).alias("target"))
    return dedup.line_dedup(rows, within=("sheet",)).filter("kept").select("ord")


_ENDS = "ends AS (SELECT line, sheet, label, unnest([ax, cx]) AS x, unnest([ay, cy]) AS y FROM lines)"
_ADJ = "adj AS (SELECT DISTINCT p.line AS a, q.line AS b FROM ends p JOIN ends q ON p.line <> q.line AND p.sheet = q.sheet WHERE (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 900)"


@query(f"WITH {_LINES}, {_ENDS}, {_ADJ} SELECT a, b FROM adj")
def q_endpoint_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.endpoint_adjacency(_lines(spark, sf_dir), 30, ["sheet"]).select("a", "b")


@query(f"""WITH RECURSIVE {_LINES}, {_ENDS}, {_ADJ}, bare AS (SELECT line FROM lines WHERE label IS NULL), inn AS (SELECT a, b FROM adj WHERE a IN (FROM bare) AND b IN (FROM bare)),
reach AS (SELECT line AS x, line AS y FROM bare UNION SELECT reach.x, inn.b FROM reach JOIN inn ON inn.a = reach.y),
src AS (SELECT reach.x AS line, min(adj.b) AS source FROM reach JOIN adj ON adj.a = reach.y JOIN lines n ON n.line = adj.b AND n.label IS NOT NULL GROUP BY 1)
SELECT l.line, coalesce(l.label, n.label) AS label, l.label IS NULL AND n.label IS NOT NULL AS propagated, CASE WHEN l.label IS NULL THEN src.source END AS source FROM lines l LEFT JOIN src ON src.line = l.line LEFT JOIN lines n ON n.line = src.source""")
def q_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return graph.propagate_labels(lines.select("line", "label"), spatial.endpoint_adjacency(lines, 30, ["sheet"]))


@query(f"""WITH {_LINES}, s AS (SELECT line, unnest([0, 1]) AS pos, unnest([abs(bx - ax), abs(cx - bx)]) AS dx, unnest([abs("by" - ay), abs(cy - "by")]) AS dy FROM lines)
SELECT line, pos, round(degrees(atan2(dy, dx)), 1) AS angle FROM s WHERE degrees(atan2(dy, dx)) > 5 AND degrees(atan2(dy, dx)) < 85""")
def q_orthogonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("line", F.explode(G.skewed_segments(F.col("path"))).alias("s")).select("line", "s.pos", "s.angle")


@query(f"WITH {_LINES}, e AS (SELECT line, unnest(['start', 'end']) AS which, unnest([ax, cx]) AS x, unnest([ay, cy]) AS y FROM lines) SELECT line, which FROM e WHERE x <= 20 OR x >= 980 OR y <= 20 OR y >= 980")
def q_seam_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = F.array(F.struct(F.lit("start").alias("which"), F.element_at("path", 1).alias("p")), F.struct(F.lit("end").alias("which"), F.element_at("path", -1).alias("p")))
    return _lines(spark, sf_dir).select("line", F.explode(ends).alias("e")).filter(G.near_boundary(F.col("e.p"))).select("line", "e.which")


@query(f"""WITH RECURSIVE {_LINES}, s AS (SELECT line, sheet, (ax + cx) // 2 AS x, (ay + cy) // 2 AS y FROM lines), near AS (SELECT p.line AS a, q.line AS b FROM s p JOIN s q ON p.sheet // 32 = q.sheet // 32 AND p.line <> q.line AND (p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= 225),
core AS (SELECT a AS line FROM near GROUP BY 1 HAVING count(*) + 1 >= 3), cc AS (SELECT line AS x, line AS y FROM core UNION SELECT cc.x, near.b FROM cc JOIN near ON near.a = cc.y WHERE near.b IN (FROM core)),
part AS (SELECT x AS line, min(y) AS cluster FROM cc GROUP BY 1), edge AS (SELECT near.a AS line, min(part.cluster) AS cluster FROM near JOIN part ON part.line = near.b GROUP BY 1)
SELECT s.line AS node, coalesce(part.cluster, edge.cluster) AS cluster FROM s LEFT JOIN part USING (line) LEFT JOIN edge USING (line)""")
def q_density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    mid = lambda c: F.floor((F.element_at("path", 1)[c] + F.element_at("path", -1)[c]) / 2)
    s = _lines(spark, sf_dir).select("line", F.floor(F.col("sheet") / 32).alias("q"), mid("x").alias("x"), mid("y").alias("y"))
    near = spatial.points_within(s.withColumnRenamed("line", "a"), s.withColumnRenamed("line", "b"), ["q"], 15, ["a"], ["b"]).filter("a <> b").select("a", "b")
    return graph.density_clusters(s.select(F.col("line").alias("node")), near, 3)


# ------------------------------------------------------------------ ids


@query("SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 4 = 0 THEN concat('N-', CAST(o_orderkey AS VARCHAR)) ELSE printf('EQ-%03d', row_number() OVER (PARTITION BY o_orderstatus, o_orderkey % 4 = 0 ORDER BY o_orderkey)) END AS new_id FROM orders")
def q_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = _read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").select(k.alias("ord"), "o_orderstatus", F.when(k % 4 == 0, F.concat(F.lit("N-"), k.cast("string"))).alias("id"))
    return integrity.fill_ids(rows, "EQ", ["o_orderstatus"]).select("ord", "new_id")


_NODES = "nodes AS (SELECT c_custkey AS ord, concat('N', CAST(c_custkey * 7 % 1100 AS VARCHAR)) AS id, CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'equipment' WHEN 1 THEN 'instruments' ELSE 'valves' END AS kind FROM customer)"


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("ord"), F.concat(F.lit("N"), (k * 7 % 1100).cast("string")).alias("id"), F.when(k % 3 == 0, "equipment").when(k % 3 == 1, "instruments").otherwise("valves").alias("kind"))


@query(f"WITH {_NODES} SELECT id, count(*) AS occurrences, arg_min(kind, ord) AS kind FROM nodes GROUP BY 1 HAVING count(*) > 1")
def q_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.duplicate_ids(_nodes(spark, sf_dir))


@query("""WITH RECURSIVE n AS (SELECT o_orderkey AS ord, concat('B', CAST(o_custkey // 3 AS VARCHAR), CASE WHEN o_orderkey % 5 = 0 THEN '_1' WHEN o_orderkey % 11 = 0 THEN '_2' ELSE '' END) AS id, o_custkey // 3 AS stem FROM orders),
v AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY ord) AS k FROM n),
w AS (SELECT stem, 0::BIGINT AS k, []::VARCHAR[] AS seen FROM (SELECT DISTINCT stem FROM v)
 UNION ALL SELECT w.stem, v.k, list_append(w.seen, CASE WHEN list_contains(w.seen, v.id) THEN list_filter(list_transform(range(1, len(w.seen) + 2), lambda i: concat(v.id, '_', CAST(i AS VARCHAR))), lambda x: NOT list_contains(w.seen, x))[1] ELSE v.id END) FROM w JOIN v ON v.stem = w.stem AND v.k = w.k + 1)
SELECT v.ord, w.seen[v.k] AS new_id FROM v JOIN w ON w.stem = v.stem AND w.k = v.k""")
def q_rename_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    nodes = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(k.alias("ord"), F.concat(F.lit("B"), F.floor(F.col("o_custkey") / 3).cast("string"), F.when(k % 5 == 0, "_1").when(k % 11 == 0, "_2").otherwise("")).alias("id"))
    return integrity.rename_duplicates(nodes).select("ord", "new_id")


# ------------------------------------------------------------------ grounding

_GROUND = f"""WITH {_TAGS}, {_WORDS}, w AS (SELECT upper(trim(text)) AS word, min(ord) AS ord FROM words WHERE length(trim(text)) >= 2 GROUP BY 1), t AS (SELECT id, tag, upper(trim(tag)) AS k FROM tags WHERE tag <> ''),
x AS (SELECT t.*, w.word AS hit FROM t LEFT JOIN w ON w.word = t.k), keys AS (SELECT DISTINCT k FROM x WHERE hit IS NULL),
same AS (SELECT k, word, ord, len(list_filter(range(1, least(length(k), length(word)) + 1), lambda i: k[i] = word[i])) / greatest(length(k), length(word)) AS s FROM keys, w),
f AS (SELECT k, arg_min(word, ord) AS near FROM same WHERE contains(k, word) OR contains(word, k) OR s >= 0.8 GROUP BY 1)
"""


@query(_GROUND + "SELECT id, tag, CASE WHEN hit IS NOT NULL THEN 'exact' WHEN near IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS match, coalesce(hit, near) AS matched FROM x LEFT JOIN f USING (k)")
def q_ground_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.ground_tags(_tags(spark, sf_dir), _words(spark, sf_dir))


@query(_GROUND + ", m AS (SELECT coalesce(hit, near) AS word FROM x LEFT JOIN f USING (k)) SELECT word, ord FROM w WHERE word NOT IN (SELECT word FROM m WHERE word IS NOT NULL)")
def q_ocr_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir)
    return integrity.unmatched_words(words, integrity.ground_tags(_tags(spark, sf_dir), words))


@query(f"WITH {_TAGS}, {_WORDS}, w AS (SELECT DISTINCT upper(text) AS word FROM words WHERE text <> '') SELECT id, tag FROM tags WHERE NOT EXISTS (SELECT 1 FROM w WHERE contains(upper(tag), word) OR contains(word, upper(tag)))")
def q_ungrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.ungrounded(_tags(spark, sf_dir), _words(spark, sf_dir)).select("id", "tag")


# ------------------------------------------------------------------ errors and metrics

_ERRORS = "errors AS (SELECT concat('E-', CAST(o_custkey AS VARCHAR)) AS entity_id, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'DANGLING_REF' WHEN 1 THEN 'SEAM_BREAK' WHEN 2 THEN 'ORPHAN_NODE' ELSE 'UNGROUNDED_TAG' END AS error_type, o_orderstatus AS severity FROM orders)"


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    kind = F.when(k == 0, "DANGLING_REF").when(k == 1, "SEAM_BREAK").when(k == 2, "ORPHAN_NODE").otherwise("UNGROUNDED_TAG")
    return _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(F.concat(F.lit("E-"), F.col("o_custkey").cast("string")).alias("entity_id"), kind.alias("error_type"), F.col("o_orderstatus").alias("severity"))


@query(f"WITH {_ERRORS} SELECT error_type, count(*) AS n, count(*) FILTER (severity = 'F') AS n_final FROM errors GROUP BY 1")
def q_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.histogram(_errors(spark, sf_dir), F.col("severity") == "F").withColumnRenamed("n_marked", "n_final")


@query(f"WITH {_ERRORS} SELECT count(*) FILTER (error_type = 'DANGLING_REF') = 0 AS no_dangling_ref, count(*) FILTER (error_type = 'DUPLICATE_ID') = 0 AS no_duplicate_id, count(*) FILTER (error_type IN ('DANGLING_REF', 'DUPLICATE_ID')) = 0 AS all_pass FROM errors")
def q_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.gates(_errors(spark, sf_dir), ["DANGLING_REF", "DUPLICATE_ID"])


@query(f"WITH {_ERRORS}, m AS (SELECT entity_id, list_sort(list(DISTINCT error_type)) AS t FROM errors GROUP BY 1) SELECT concat('E-', CAST(c_custkey AS VARCHAR)) AS id, coalesce(array_to_string(t, ','), '') AS error_types, coalesce(list_contains(t, 'SEAM_BREAK'), false) AS seam_break, t IS NOT NULL AS repaired FROM customer LEFT JOIN m ON entity_id = concat('E-', CAST(c_custkey AS VARCHAR))")
def q_repair_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = _read(spark, sf_dir, "customer", "c_custkey").select(F.concat(F.lit("E-"), F.col("c_custkey").cast("string")).alias("id"))
    return integrity.repair(entities, _errors(spark, sf_dir)).withColumn("error_types", F.array_join("error_types", ","))


_METRICS = f"""{_LINES}, n AS (SELECT concat('N', CAST(c_custkey AS VARCHAR)) AS id, CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'equipment' WHEN 1 THEN 'instruments' ELSE 'valves' END AS kind, c_custkey % 5 <> 0 AS tagged, c_custkey % 4 = 0 AS ocr, c_custkey % 7 <> 0 AS ver FROM customer),
e AS (SELECT *, concat('N', CAST(line AS VARCHAR)) AS source, concat('N', CAST(line * 3 % 2000 AS VARCHAR)) AS target FROM lines), ends AS (SELECT unnest([source, target]) AS id FROM e), r AS (SELECT count(*) FILTER (id IN (SELECT id FROM n)) AS c, count(*) AS t FROM ends)"""


def _metric_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    nodes = _read(spark, sf_dir, "customer", "c_custkey").select(
        F.concat(F.lit("N"), k.cast("string")).alias("id"), F.when(k % 3 == 0, "equipment").when(k % 3 == 1, "instruments").otherwise("valves").alias("kind"), F.when(k % 5 != 0, "T").alias("tag"), (k % 4 == 0).alias("ocr_validated"), F.when(k % 7 == 0, F.lit(False)).alias("tag_verified"))
    n = F.col("line")
    edges = _lines(spark, sf_dir).select(F.when(n % 2 == 0, "process").otherwise("signal").alias("kind"), F.concat(F.lit("N"), n.cast("string")).alias("source"), F.concat(F.lit("N"), (n * 3 % 2000).cast("string")).alias("target"), F.col("label").isNotNull().alias("named"), (n % 6 == 0).alias("propagated"), "path", (n % 50 == 0).alias("seam_break"))
    return nodes, edges


@query(f"""WITH {_METRICS} SELECT (SELECT count(*) FROM n WHERE kind = 'equipment') AS total_equipment, (SELECT count(*) FROM n WHERE kind = 'instruments') AS total_instruments, (SELECT count(*) FROM n WHERE kind = 'valves') AS total_valves, (SELECT count(*) FROM n) AS total_entities,
(SELECT count(*) FROM n WHERE ocr) AS ocr_validated, (SELECT count(*) FROM n WHERE tagged AND (ocr OR ver)) AS grounded_tags, (SELECT c FROM r) AS connected_endpoints, (SELECT t - c FROM r) AS dangling_endpoints,
(SELECT count(*) FROM e WHERE line % 2 = 0) AS total_process_lines, (SELECT count(*) FROM e WHERE line % 2 = 1) AS total_signal_lines, (SELECT count(*) FROM e) AS total_lines, (SELECT count(label) FROM e) AS labeled_lines, (SELECT count(*) FROM e WHERE line % 6 = 0) AS propagated_labels,
(SELECT count(*) FROM (SELECT unnest([ax, cx]) AS x, unnest([ay, cy]) AS y FROM e) WHERE x <= 20 OR x >= 980 OR y <= 20 OR y >= 980) AS boundary_endpoints, (SELECT count(*) FROM e WHERE line % 50 = 0) AS seam_breaks,
(SELECT count(*) FROM n WHERE NOT ocr) AS ocr_unvalidated, (SELECT round(avg(ocr::INT), 3) FROM n) AS ocr_validation_rate, (SELECT round(count(label) / count(*), 3) FROM e) AS label_coverage, (SELECT round(c / t, 3) FROM r) AS edge_connection_rate, (SELECT round((t - c) / t, 3) FROM r) AS dangling_ref_rate,
(SELECT round(count(*) FILTER (line % 50 = 0) / count(*), 3) FROM e) AS seam_break_rate, (SELECT count(*) FROM n WHERE tagged AND NOT (ocr OR ver)) AS ungrounded_tags, (SELECT round(count(*) FILTER (ocr OR ver) / count(*), 3) FROM n WHERE tagged) AS tag_grounding_rate,
(SELECT count(*) FROM orders WHERE o_custkey % 97 = 0) AS unresolved_references, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS orphan_nodes, CAST(0 AS BIGINT) AS incomplete_loops, (SELECT count(*) FROM lines WHERE line % 3 = 0) AS orthogonality_warnings,
(SELECT count(*) FROM orders WHERE o_custkey % 97 = 0) = 0 AND (SELECT count(*) FROM customer WHERE c_acctbal < 0) = 0 AS is_valid""")
def q_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    unresolved = _read(spark, sf_dir, "orders", "o_custkey").agg(F.count_if(F.col("o_custkey") % 97 == 0).alias("unresolved_references"))
    alone = _read(spark, sf_dir, "customer", "c_acctbal").agg(F.count_if(F.col("c_acctbal") < 0).alias("orphan_nodes"))
    skewed = _lines(spark, sf_dir).agg(F.count_if(F.col("line") % 3 == 0).alias("orthogonality_warnings"), F.lit(0).cast("long").alias("incomplete_loops"))
    return integrity.quality_metrics(*_metric_inputs(spark, sf_dir), unresolved.crossJoin(alone).crossJoin(skewed))  # one row each


@query("""WITH m AS (SELECT metric, CAST(value AS DOUBLE) AS value, side FROM (SELECT l_returnflag = 'A' AS side, count(*) AS orphan_nodes, count(*) FILTER (l_quantity > 25) AS label_coverage, count(*) FILTER (l_discount > 0.05) AS total_lines FROM lineitem GROUP BY 1)
UNPIVOT (value FOR metric IN (orphan_nodes, label_coverage, total_lines)))
SELECT a.metric, a.value AS "before", b.value AS "after", CASE WHEN a.metric = 'orphan_nodes' THEN a.value - b.value ELSE b.value - a.value END AS gain FROM m a JOIN m b ON a.metric = b.metric AND a.side AND NOT b.side""")
def q_compare_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_discount")
    names = ["orphan_nodes", "label_coverage", "total_lines"]

    def side(first: bool) -> DataFrame:
        one = items.filter((F.col("l_returnflag") == "A") == first).agg(F.count(F.lit(1)).cast("double").alias(names[0]), F.count_if(F.col("l_quantity") > 25).cast("double").alias(names[1]), F.count_if(F.col("l_discount") > 0.05).cast("double").alias(names[2]))
        return one.unpivot([], names, "metric", "value")

    return integrity.compare_metrics(side(True), side(False))


# ------------------------------------------------------------------ documents


@query("""WITH RECURSIVE s AS (SELECT p_partkey AS id, p_partkey // 40 AS slide, CAST((p_partkey * 53) % 700 AS INT) AS top, CAST((p_partkey * 37) % 900 AS INT) AS lft FROM part), v AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY top, lft, id) AS k FROM s),
w AS (SELECT slide, k, top AS first_top, 1 AS band, id, lft, top FROM v WHERE k = 1 UNION ALL SELECT v.slide, v.k, CASE WHEN v.top - w.first_top > 50 THEN v.top ELSE w.first_top END, CASE WHEN v.top - w.first_top > 50 THEN w.band + 1 ELSE w.band END, v.id, v.lft, v.top FROM w JOIN v ON v.slide = w.slide AND v.k = w.k + 1)
SELECT slide, row_number() OVER (PARTITION BY slide ORDER BY band, lft, top, id) - 1 AS position, band, id FROM w""")
def q_row_banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    shapes = _read(spark, sf_dir, "part", "p_partkey").select(k.alias("id"), F.floor(k / 40).alias("slide"), ((k * 53) % 700).cast("int").alias("top"), ((k * 37) % 900).cast("int").alias("left"))
    return documents.row_bands(shapes, ["slide"], 50)


@query("""WITH RECURSIVE s AS (SELECT p_partkey AS id, CASE WHEN p_partkey >= 10 THEN p_partkey // 10 END AS parent, p_size AS dx, p_size % 7 AS dy FROM part), w AS (SELECT id, dx AS x, dy AS y, 0 AS depth FROM s WHERE parent IS NULL UNION ALL SELECT s.id, w.x + s.dx, w.y + s.dy, w.depth + 1 FROM w JOIN s ON s.parent = w.id) SELECT * FROM w""")
def q_group_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return graph.flatten_groups(_read(spark, sf_dir, "part", "p_partkey", "p_size").select(k.alias("id"), F.when(k >= 10, F.floor(k / 10)).alias("parent"), F.col("p_size").alias("dx"), (F.col("p_size") % 7).alias("dy")))


@query("SELECT lang, arg_min(source, doc_id) AS first_source, min(doc_id) AS doc_id FROM documents WHERE source IS NOT NULL GROUP BY 1")
def q_first_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents", "doc_id", "lang", "source").transform(lambda d: documents.first_value(d, ["lang"], "source", "doc_id")).withColumnRenamed("source", "first_source")


@query("SELECT doc_id, quality FROM labels WHERE doc_id % 3 <> 0 EXCEPT SELECT doc_id, 1 AS quality FROM labels WHERE toxic = 0")
def q_new_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return errors.new_only(labels.filter("doc_id % 3 <> 0").select("doc_id", "quality"), labels.filter("toxic = 0").select("doc_id", F.lit(1).cast(labels.schema["quality"].dataType).alias("quality")))


@query("SELECT page_id, trim(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)[-1], E' \\t\\n\\r') AS last_p FROM pages")
def q_last_tag_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages", "page_id", "html").select("page_id", X.last_capture(F.col("html"), "p").alias("last_p"))


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda p: regexp_matches(p, '^[A-Z]'))) AS n_capital, len(list_filter(string_split(text, chr(10)), lambda p: regexp_matches(p, '^[•●○] '))) > 0 AS bullet FROM documents")
def q_manual_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    return _read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.size(F.filter(lines, lambda p: p.rlike("^[A-Z]"))).cast("long").alias("n_capital"), X.manual_bullet(lines).alias("bullet"))


@query("""WITH p AS (SELECT u.turn, CASE WHEN u.conv_id % 3 = 0 THEN a.text ELSE u.text END AS actual, a.text AS expected FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')
SELECT count(*) AS tasks, round(100.0 * avg(CAST(coalesce(length(actual) > 0 AND actual = expected, false) AS INT)), 3) AS accuracy, round(avg(length(expected)), 3) AS mean_duration, round(avg(turn), 3) AS mean_calls, CAST(sum(turn) AS BIGINT) AS total_calls FROM p""")
def q_exact_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    asked = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("said"))
    given = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("expected"), F.length("text").alias("duration"))
    results = asked.join(given, ["conv_id", "turn"]).withColumn("actual", F.when(F.col("conv_id") % 3 == 0, F.col("expected")).otherwise(F.col("said")))
    return documents.run_report(results.withColumn("tool_calls", F.col("turn")))


@query("""WITH c AS (SELECT event_type AS tool, CAST(round(value * 100) AS BIGINT) AS d, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events)
SELECT tool, (n - 1) // 500 AS page, count(*) AS calls, array_to_string(list(d ORDER BY n), ',') AS durations FROM c GROUP BY 1, 2""")
def q_tool_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _read(spark, sf_dir, "events", "event_id", "ts", "event_type", "value").select(F.col("event_type").alias("tool"), "ts", F.col("event_id").alias("id"), F.round(F.col("value") * 100).cast("long").alias("duration"))
    return documents.tool_metrics(calls, 500).withColumn("durations", F.array_join("durations", ","))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events", "event_id", "props").select("event_id", F.from_json("props", "k bigint")["k"].alias("k")).filter("k is not null")


@query("SELECT doc_id, n_chars, (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents) > 60 AS has_more, CASE WHEN (SELECT count(*) FROM documents) > 60 THEN 60 END AS next_offset FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 40")
def q_page_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents", "doc_id", "n_chars").withColumn("down", -F.col("n_chars"))
    return documents.pages_of(docs, "doc_id", ["down", "doc_id"], 20, 40).drop("down")


@query("SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def q_metadata_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents", "doc_id").join(_read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"), "doc_id", "left").fillna({"quality": -1, "toxic": 0})


_PARTS = "parts AS (SELECT concat('ppt/slides/slide', CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 9 = 0 THEN '.bin' ELSE '.xml' END) AS name, p_partkey AS k FROM part)"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return _read(spark, sf_dir, "part", "p_partkey").select(F.concat(F.lit("ppt/slides/slide"), k.cast("string"), F.when(k % 9 == 0, ".bin").otherwise(".xml")).alias("name"), k.alias("k"))


@query(f"WITH {_PARTS}, r AS (SELECT l_orderkey AS id, concat('ppt/slides/slide', CAST(l_partkey % 3000 AS VARCHAR), '.xml') AS name FROM lineitem) SELECT id, name FROM r WHERE name NOT IN (SELECT name FROM parts)")
def q_broken_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey").select(F.col("l_orderkey").alias("id"), F.lit("ppt/slideLayouts").alias("folder"), F.concat(F.lit("../slides/slide"), (F.col("l_partkey") % 3000).cast("string"), F.lit(".xml")).alias("target"))
    return documents.broken_targets(rels, _parts(spark, sf_dir)).select("id", "name")


@query(f"WITH {_PARTS} SELECT name FROM parts WHERE name NOT IN (SELECT concat('ppt/slides/slide', CAST(l_partkey * 2 AS VARCHAR), '.xml') FROM lineitem)")
def q_unreferenced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rels = _read(spark, sf_dir, "lineitem", "l_partkey").select(F.lit("").alias("folder"), F.concat(F.lit("/ppt/slides/slide"), (F.col("l_partkey") * 2).cast("string"), F.lit(".xml")).alias("target"))
    return documents.unreferenced_parts(rels, _parts(spark, sf_dir)).select("name")


@query(f"WITH {_PARTS} SELECT name FROM parts WHERE k % 2 <> 0 AND name NOT LIKE '%.xml'")
def q_undeclared_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    return documents.undeclared_content(parts.select("name"), parts.filter("k % 2 = 0").select("name"), spark.createDataFrame([("XML",), ("rels",)], "extension string"))


_USES = "u AS (SELECT o_custkey AS part, o_orderkey AS k, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'sldId' WHEN 1 THEN 'sldLayoutId' WHEN 2 THEN 'headerReference' ELSE 'blip' END AS element, concat('rId', CAST(o_orderkey % 9 AS VARCHAR)) AS rid FROM orders), r AS (SELECT c_custkey AS part, unnest(range(0, 6)) AS n FROM customer), rels AS (SELECT part, concat('rId', CAST(n AS VARCHAR)) AS rid, CASE WHEN n % 3 = 0 THEN 'http://x/slide' WHEN n % 3 = 1 THEN 'http://x/slideLayout' ELSE 'http://x/header' END AS type FROM r)"


@query(f"""WITH {_USES}, j AS (SELECT u.*, rels.type, CASE element WHEN 'sldId' THEN 'slide' WHEN 'sldLayoutId' THEN 'slidelayout' WHEN 'headerReference' THEN 'header' END AS expected FROM u LEFT JOIN rels USING (part, rid))
SELECT part, element, rid, CASE WHEN type IS NULL THEN 'missing' ELSE 'type_mismatch' END AS verdict FROM j WHERE type IS NULL OR (expected IS NOT NULL AND NOT contains(lower(type), expected))""")
def q_relationship_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    uses = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_custkey").alias("part"), F.when(k % 4 == 0, "sldId").when(k % 4 == 1, "sldLayoutId").when(k % 4 == 2, "headerReference").otherwise("blip").alias("element"), F.concat(F.lit("rId"), (k % 9).cast("string")).alias("rid"))
    n = F.col("n")
    rels = _read(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("n")).select("part", F.concat(F.lit("rId"), n.cast("string")).alias("id"), F.when(n % 3 == 0, "http://x/slide").when(n % 3 == 1, "http://x/slideLayout").otherwise("http://x/header").alias("type"))
    return documents.check_relationships(uses, rels)


@query("""WITH e AS (SELECT concat('f', CAST(l_suppkey % 20 AS VARCHAR)) AS part, CASE WHEN l_linenumber % 2 = 0 THEN 'sldlayoutid' ELSE 'bookmarkstart' END AS name, CAST(l_orderkey AS VARCHAR) AS value, CAST(l_orderkey * 10 + l_linenumber AS INT) AS line FROM lineitem)
SELECT part, name, value, line FROM e QUALIFY row_number() OVER (PARTITION BY CASE WHEN name = 'bookmarkstart' THEN part ELSE '' END, name, value ORDER BY part, line) > 1""")
def q_duplicate_xml_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    rows = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber").select(F.concat(F.lit("f"), (F.col("l_suppkey") % 20).cast("string")).alias("part"), F.when(F.col("l_linenumber") % 2 == 0, "{urn:p}sldLayoutId").otherwise("{urn:w}bookmarkStart").alias("name"), F.create_map(F.lit("id"), k.cast("string")).alias("attrs"), (k * 10 + F.col("l_linenumber")).cast("int").alias("line"))
    return documents.duplicate_xml_ids(rows)


@query("SELECT o_custkey AS notes, count(*) AS n, array_to_string(list(o_orderkey ORDER BY o_orderkey), ',') AS members FROM orders GROUP BY 1 HAVING count(*) > 1")
def q_shared_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_custkey").alias("notes"), "o_orderkey")
    return documents.more_than_once(refs, ["notes"], "o_orderkey").withColumn("members", F.array_join("members", ","))


@query("SELECT l_orderkey * 10 + l_linenumber AS pos, l_partkey * 2 AS idx, p_name, p_partkey IS NOT NULL AS found FROM lineitem LEFT JOIN part ON p_partkey = l_partkey * 2")
def q_slide_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), (F.col("l_partkey") * 2).alias("idx"))
    return documents.gather(_read(spark, sf_dir, "part", "p_partkey", "p_name").withColumnRenamed("p_partkey", "idx"), order)


@query("""WITH s AS (SELECT o_custkey AS deck, o_orderkey AS idx, o_orderstatus = 'P' AS hidden, CASE WHEN o_orderstatus <> 'P' THEN sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS n FROM orders)
SELECT deck, CAST(n AS BIGINT) AS n, idx, hidden, CASE WHEN n <= 5 THEN concat('img', CAST(deck AS VARCHAR), '-', CAST(CAST(n AS INT) AS VARCHAR)) END AS image FROM s""")
def q_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    slides = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(F.col("o_custkey").alias("deck"), F.col("o_orderkey").alias("idx"), documents.hidden(F.when(F.col("o_orderstatus") == "P", "0").when(F.col("o_orderstatus") == "O", "1")).alias("hidden"))
    images = slides.select("deck").distinct().select("deck", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("n")).withColumn("n", F.col("n").cast("long")).withColumn("image", F.concat(F.lit("img"), F.col("deck").cast("string"), F.lit("-"), F.col("n").cast("string")))
    return documents.interleave(slides, images)


@query("""WITH s AS (SELECT c_custkey AS id, concat('rgba(', CAST(c_custkey % 256 AS VARCHAR), ', ', CAST(c_custkey * 7 % 256 AS VARCHAR), ', ', CAST(c_custkey * 13 % 256 AS VARCHAR), ', 0.', CAST(c_custkey % 10 AS VARCHAR), ')') AS css FROM customer)
SELECT id, printf('%02x%02x%02x', CAST(id % 256 AS INT), CAST(id * 7 % 256 AS INT), CAST(id * 13 % 256 AS INT)) AS hex, CAST(100 - (id % 10) * 10 AS INT) AS transparency FROM s""")
def q_css_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    css = F.concat(F.lit("rgba("), (k % 256).cast("string"), F.lit(", "), (k * 7 % 256).cast("string"), F.lit(", "), (k * 13 % 256).cast("string"), F.lit(", 0."), (k % 10).cast("string"), F.lit(")"))
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("id"), C.rgb_to_hex(css).alias("hex"), C.transparency(css).alias("transparency"))


@query("""WITH s AS (SELECT c_custkey AS id, CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'My Skill' WHEN 1 THEN '-lead' WHEN 2 THEN 'a--b' WHEN 3 THEN repeat('x', 70) ELSE concat('skill-', CAST(c_custkey AS VARCHAR)) END AS name, CASE WHEN c_custkey % 7 = 0 THEN 'has <tag>' ELSE 'plain' END AS description, c_custkey % 11 = 0 AS extra FROM customer)
SELECT id, CASE WHEN extra THEN 'unexpected_key' WHEN NOT regexp_matches(name, '^[a-z0-9-]+$') THEN 'name_case' WHEN name LIKE '-%' OR name LIKE '%-' OR contains(name, '--') THEN 'name_hyphens' WHEN length(name) > 64 THEN 'name_length' WHEN contains(description, '<') THEN 'description_brackets' ELSE 'valid' END AS verdict FROM s""")
def q_skill_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    name = F.when(k % 6 == 0, "My Skill").when(k % 6 == 1, "-lead").when(k % 6 == 2, "a--b").when(k % 6 == 3, "x" * 70).otherwise(F.concat(F.lit("skill-"), k.cast("string")))
    keys = F.when(k % 11 == 0, F.array(F.lit("name"), F.lit("description"), F.lit("version"))).otherwise(F.array(F.lit("name"), F.lit("description")))
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("id"), X.skill_verdict(keys, name, F.when(k % 7 == 0, "has <tag>").otherwise("plain")).alias("verdict"))


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS place FROM documents QUALIFY place <= 30")
def q_top_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.top_of(_read(spark, sf_dir, "documents", "doc_id", "source", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 30).drop("n_chars")
