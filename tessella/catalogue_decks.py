"""Queries over decks, packages, pages and question sets, with their DuckDB oracles. Inputs are derived as in `catalogue`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import _read, query
from .catalogue_drawings import _again
from .functions import css as C
from .functions import geometry as G
from .functions import text as X
from .operators import decks, documents, markup
from .operators._shared import cut_lineage, dealt, large
from .operators.graph import flatten_groups
from .sources import packages, sinks


def _text(c: Column) -> Column:
    return c.cast("string")


# ------------------------------------------------------------------ shapes

#: Shapes of slides of eight, decks of five slides; lengths in EMU that are whole hundredths of an inch.
_SHAPES = """sh AS (SELECT p_partkey AS id, p_partkey // 40 AS deck, p_partkey // 8 % 5 AS slide, (p_partkey * 37 % 900) * 9144 AS left_emu, (p_partkey * 53 % 600) * 9144 AS top_emu, (p_size * 10 + 20) * 9144 AS width_emu, (p_size % 20 * 5 + 10) * 9144 AS height_emu, 9144000 AS slide_width, 5029200 AS slide_height,
 CASE WHEN p_partkey % 9 = 0 THEN ' ' WHEN p_partkey % 9 = 1 THEN '12' ELSE p_name END AS text, CASE CAST(p_partkey % 7 AS INT) WHEN 0 THEN 'SLIDE_NUMBER' WHEN 1 THEN 'FOOTER' WHEN 2 THEN 'TITLE' END AS placeholder FROM part)"""


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    place = F.when(k % 7 == 0, "SLIDE_NUMBER").when(k % 7 == 1, "FOOTER").when(k % 7 == 2, "TITLE")
    emu = lambda c: (c * 9144).cast("long")
    return _read(spark, sf_dir, "part", "p_partkey", "p_size", "p_name").select(
        k.alias("id"), F.floor(k / 40).alias("deck"), (F.floor(k / 8) % 5).alias("slide"), emu(k * 37 % 900).alias("left_emu"), emu(k * 53 % 600).alias("top_emu"), emu(s * 10 + 20).alias("width_emu"), emu(s % 20 * 5 + 10).alias("height_emu"),
        F.lit(9144000).alias("slide_width"), F.lit(5029200).alias("slide_height"), F.when(k % 9 == 0, " ").when(k % 9 == 1, "12").otherwise(F.col("p_name")).alias("text"), place.alias("placeholder"),
    )


@query(f"WITH {_SHAPES} SELECT id, placeholder FROM sh WHERE trim(text) <> '' AND NOT coalesce(placeholder = 'SLIDE_NUMBER' OR (placeholder = 'FOOTER' AND regexp_full_match(trim(text), '[0-9]+')), false)")
def q_valid_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decks.valid_shapes(_shapes(spark, sf_dir)).select("id", "placeholder")


_OVERFLOW = "CASE WHEN round(({0} + {1} - {2}) / 914400::DOUBLE, 2) > 0.01 THEN round(({0} + {1} - {2}) / 914400::DOUBLE, 2) END"


@query(f"WITH {_SHAPES} SELECT id, {_OVERFLOW.format('left_emu', 'width_emu', 'slide_width')} AS overflow_right, {_OVERFLOW.format('top_emu', 'height_emu', 'slide_height')} AS overflow_bottom FROM sh")
def q_slide_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decks.slide_overflow(_shapes(spark, sf_dir)).select("id", "overflow_right", "overflow_bottom")


@query(f"""WITH {_SHAPES}, f AS (SELECT id, width_emu / 914400::DOUBLE - (CASE WHEN id % 3 = 0 THEN 0.2 ELSE 0.1 END) - 0.1 AS w, height_emu / 914400::DOUBLE - 0.05 - 0.05 AS h FROM sh) SELECT id, CAST(trunc(w * 96) AS INT) AS width, CAST(trunc(h * 96) AS INT) AS height FROM f""")
def q_usable_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    margin = F.when(F.col("id") % 3 == 0, 182880).otherwise(0)
    inch = lambda c: G.emu_to_inches(F.col(c))
    return _shapes(spark, sf_dir).select("id", decks.usable_size(inch("width_emu"), inch("height_emu"), {"left": margin}).alias("u")).select("id", "u.*")


#: Paragraphs of shapes: words of a few letters, a line break in some; a character is half as wide as its font is high.
_PARAS = """pa AS (SELECT l_orderkey AS shape, l_linenumber AS pos, array_to_string(list_transform(range(0, CAST(l_partkey % 9 AS BIGINT)), lambda i: repeat('w', CAST((l_partkey + i * 7) % 6 + 1 AS INT))), ' ') AS text, CAST(l_partkey % 3 * 6 + 12 AS INT) AS font_size, CASE WHEN l_partkey % 4 = 0 THEN 18.0 END AS line_spacing, CASE WHEN l_partkey % 5 = 0 THEN 6.0 END AS space_before, l_suppkey FROM lineitem)"""


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_partkey")
    words = F.when(p % 9 > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(p % 9 - 1, F.lit(0))), lambda i: F.repeat(F.lit("w"), ((p + i * 7) % 6 + 1).cast("int")))).otherwise(F.array().cast("array<string>"))
    return _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select(F.col("l_orderkey").alias("shape"), F.col("l_linenumber").alias("pos"), F.array_join(words, " ").alias("text"), (p % 3 * 6 + 12).cast("int").alias("font_size"), F.when(p % 4 == 0, 18.0).alias("line_spacing"), F.when(p % 5 == 0, 6.0).alias("space_before"), F.lit(None).cast("double").alias("space_after"), "l_suppkey")


@query(f"""WITH RECURSIVE {_PARAS}, w AS (SELECT row_number() OVER () AS r, *, string_split(text, ' ') AS ws FROM pa WHERE text <> ''),
lines AS (SELECT r, 1 AS i, 1 AS n, length(ws[1]) AS used, 20 AS most FROM w UNION ALL
 SELECT l.r, l.i + 1, CASE WHEN l.used + 1 + length(w.ws[l.i + 1]) <= l.most THEN l.n ELSE l.n + 1 END, CASE WHEN l.used + 1 + length(w.ws[l.i + 1]) <= l.most THEN l.used + 1 + length(w.ws[l.i + 1]) ELSE length(w.ws[l.i + 1]) END, l.most FROM lines l JOIN w ON w.r = l.r WHERE l.i < len(w.ws)),
c AS (SELECT r, max(n) AS n FROM lines GROUP BY 1), h AS (SELECT w.shape, sum(c.n * coalesce(line_spacing, font_size) * 96 / 72 + CASE WHEN pos > 0 THEN coalesce(space_before, 0) * 96 / 72 ELSE 0 END) AS needed FROM w JOIN c USING (r) GROUP BY 1)
SELECT o_orderkey AS shape, CASE WHEN round((needed - 40) / 96, 2) > 0.05 THEN round((needed - 40) / 96, 2) END AS frame_overflow FROM orders LEFT JOIN h ON shape = o_orderkey""")
def q_frame_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _paragraphs(spark, sf_dir).withColumn("width", F.col("font_size"))
    shapes = _read(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("shape"))
    # Frames as wide as twenty characters of every font: fonts of one width are taken for the test's sake.
    frames = shapes.withColumn("usable", F.struct(F.lit(160).alias("width"), F.lit(40).alias("height")))
    same = rows.withColumns({"line_spacing": F.coalesce("line_spacing", F.col("font_size").cast("double")), "font_size": F.lit(12)})
    return decks.frame_overflow(frames, same, ["shape"]).select("shape", "frame_overflow")


_BANDS = f"""{_SHAPES}, inch AS (SELECT *, round(left_emu / 914400::DOUBLE, 2) AS "left", round(top_emu / 914400::DOUBLE, 2) AS top, round(width_emu / 914400::DOUBLE, 2) AS width, round(height_emu / 914400::DOUBLE, 2) AS height FROM sh),
v AS (SELECT *, row_number() OVER (PARTITION BY deck, slide ORDER BY top, "left", id) AS k FROM inch),
wk AS (SELECT deck, slide, k, top AS first_top, 1 AS band, id FROM v WHERE k = 1 UNION ALL SELECT v.deck, v.slide, v.k, CASE WHEN v.top - wk.first_top > 0.5 THEN v.top ELSE wk.first_top END, CASE WHEN v.top - wk.first_top > 0.5 THEN wk.band + 1 ELSE wk.band END, v.id FROM wk JOIN v ON v.deck = wk.deck AND v.slide = wk.slide AND v.k = wk.k + 1),
named AS (SELECT v.*, concat('shape-', CAST(row_number() OVER (PARTITION BY v.deck, v.slide ORDER BY wk.band, v."left", v.top, v.id) - 1 AS VARCHAR)) AS shape_id FROM v JOIN wk USING (deck, slide, k))"""


@query(f"WITH RECURSIVE {_BANDS} SELECT deck, slide, id, shape_id FROM named")
def q_shape_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decks.number_shapes(decks.in_inches(_shapes(spark, sf_dir))).select("deck", "slide", "id", "shape_id")


_PAIRED = """ov AS (SELECT a.deck, a.slide, a.shape_id, b.shape_id AS other, round((least(a."left" + a.width, b."left" + b.width) - greatest(a."left", b."left")) * (least(a.top + a.height, b.top + b.height) - greatest(a.top, b.top)), 2) AS area FROM named a JOIN named b ON a.deck = b.deck AND a.slide = b.slide AND a.id <> b.id
 WHERE least(a."left" + a.width, b."left" + b.width) - greatest(a."left", b."left") > 0.05 AND least(a.top + a.height, b.top + b.height) - greatest(a.top, b.top) > 0.05),
per AS (SELECT deck, slide, shape_id, string_agg(concat(other, '=', CAST(CAST(round(area * 100) AS BIGINT) AS VARCHAR)), ',' ORDER BY other) AS laps FROM ov GROUP BY 1, 2, 3)"""


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = decks.with_overlaps(decks.slide_overflow(decks.number_shapes(decks.in_inches(_shapes(spark, sf_dir)))))
    return decks.with_issues(shapes.withColumns({"frame_overflow": F.when(F.col("id") % 6 == 0, 0.25), "bullet": F.col("id") % 10 == 0}))


@query(f"""WITH RECURSIVE {_BANDS}, {_PAIRED} SELECT n.deck, n.slide, n.shape_id, coalesce(laps, '') AS laps FROM named n LEFT JOIN per USING (deck, slide, shape_id)
WHERE laps IS NOT NULL OR id % 6 = 0 OR id % 10 = 0 OR {_OVERFLOW.format('left_emu', 'width_emu', 'slide_width')} IS NOT NULL OR {_OVERFLOW.format('top_emu', 'height_emu', 'slide_height')} IS NOT NULL""")
def q_shape_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.transform(F.array_sort(F.map_entries("overlaps")), lambda e: F.concat(e["key"], F.lit("="), _text(F.round(e["value"] * 100).cast("long"))))
    return _issues(spark, sf_dir).select("deck", "slide", "shape_id", F.coalesce(F.array_join(pairs, ","), F.lit("")).alias("laps"))


@query(f"""WITH RECURSIVE {_BANDS} SELECT deck, slide, count(*) AS n, string_agg(shape_id, ',' ORDER BY shape_id) FILTER (placeholder = 'TITLE') AS titles FROM named GROUP BY 1, 2""")
def q_inventory_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = decks.number_shapes(decks.in_inches(_shapes(spark, sf_dir)))
    back = _again(decks.inventory_json(shapes, ["left", "top", "width", "height", "placeholder", "text"]))
    entries = F.array_sort(F.map_entries(F.from_json("shapes", "map<string,struct<left:double,top:double,placeholder:string>>")))
    titles = F.array_join(F.transform(F.filter(entries, lambda e: e["value"]["placeholder"] == "TITLE"), lambda e: e["key"]), ",")
    return back.select("deck", "slide", F.size(entries).cast("long").alias("n"), F.nullif(titles, F.lit("")).alias("titles"))


@query(f"WITH RECURSIVE {_BANDS} SELECT deck, slide, string_agg(shape_id, ',' ORDER BY shape_id) AS overflowing FROM named WHERE id % 6 = 0 GROUP BY 1, 2")
def q_overflow_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decks.overflow_map(_issues(spark, sf_dir))
    return rows.select("deck", "slide", F.array_join(F.array_sort(F.map_keys("overflow")), ",").alias("overflowing"))


@query(f"""WITH {_SHAPES}, s AS (SELECT deck, slide, concat('shape-', CAST(id % 8 AS VARCHAR)) AS shape_id, text FROM sh), r AS (SELECT deck, (slide + id % 2) AS slide, concat('shape-', CAST(id % 8 + id % 3 AS VARCHAR)) AS shape_id FROM sh WHERE id % 4 = 1),
lost AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.deck = r.deck AND s.slide = r.slide AND s.shape_id = r.shape_id)),
idle AS (SELECT s.deck, s.slide, string_agg(CASE WHEN length(text) > 0 THEN concat(shape_id, ' (''', left(text, 50), CASE WHEN length(text) > 50 THEN '...' ELSE '' END, ''')') ELSE shape_id END, ', ' ORDER BY CASE WHEN length(text) > 0 THEN concat(shape_id, ' (''', left(text, 50), CASE WHEN length(text) > 50 THEN '...' ELSE '' END, ''')') ELSE shape_id END) AS hint
 FROM s WHERE NOT EXISTS (SELECT 1 FROM r WHERE s.deck = r.deck AND s.slide = r.slide AND s.shape_id = r.shape_id) GROUP BY 1, 2)
SELECT deck, slide, shape_id, CASE WHEN NOT EXISTS (SELECT 1 FROM s WHERE s.deck = lost.deck AND s.slide = lost.slide) THEN 'slide not found' ELSE concat('shape not found, without replacement: ', coalesce(hint, 'none')) END AS problem FROM lost LEFT JOIN idle USING (deck, slide)""")
def q_unknown_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    name = lambda n: F.concat(F.lit("shape-"), _text(n))
    sh = _shapes(spark, sf_dir)
    return decks.unknown_replacements(sh.select("deck", "slide", name(k % 8).alias("shape_id"), "text"), sh.filter(k % 4 == 1).select("deck", (F.col("slide") + k % 2).alias("slide"), name(k % 8 + k % 3).alias("shape_id")))


@query("""WITH a AS (SELECT c_custkey // 6 AS slide, c_custkey AS shape_id, c_custkey % 7 / 10::DOUBLE AS overflow FROM customer), b AS (SELECT slide, shape_id, shape_id % 5 / 10::DOUBLE AS was FROM a WHERE shape_id % 3 <> 0) SELECT slide, shape_id FROM a LEFT JOIN b USING (slide, shape_id) WHERE overflow > coalesce(was, 0) + 0.01""")
def q_grown_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    after = _read(spark, sf_dir, "customer", "c_custkey").select(F.floor(k / 6).alias("slide"), k.alias("shape_id"), (k % 7 / F.lit(10.0)).alias("overflow"))
    before = after.filter("shape_id % 3 <> 0").withColumn("overflow", F.col("shape_id") % 5 / F.lit(10.0))
    return documents.grown_overflow(before, after).select("slide", "shape_id")


@query(f"""WITH {_SHAPES}, r AS (SELECT deck, slide, id AS shape_id, concat('new ', CAST(id AS VARCHAR)) AS new_text FROM sh WHERE id % 3 = 0) SELECT s.id AS shape_id, r.new_text FROM sh s LEFT JOIN r ON r.deck = s.deck AND r.slide = s.slide AND r.shape_id = s.id""")
def q_replace_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sh = _shapes(spark, sf_dir).select(F.struct("deck", "slide").alias("slide"), F.col("id").alias("shape_id"))
    new = sh.filter("shape_id % 3 = 0").withColumn("new_text", F.concat(F.lit("new "), _text(F.col("shape_id"))))
    return documents.fit_texts(sh, new)[0].select("shape_id", "new_text")


@query("""WITH i AS (SELECT o_custkey AS deck, o_orderkey AS img, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders)
SELECT deck, img, CAST((n - 1) // 6 AS INT) AS page, CAST((n - 1) % 6 AS INT) AS place, CASE WHEN c <= 6 THEN 'grid.jpg' ELSE concat('grid-', CAST((n - 1) // 6 + 1 AS VARCHAR), '.jpg') END AS file FROM i""")
def q_grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_custkey").alias("deck"), F.col("o_orderkey").alias("img"))
    return decks.pages_of_grid(images, 2, ["deck"], ["img"]).select("deck", "img", "page", "place", "file")


@query("WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders), b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name DESC, c_custkey) AS place FROM customer) SELECT place, o_orderkey, c_custkey FROM a JOIN b USING (place)")
def q_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _read(spark, sf_dir, "orders", "o_orderkey")
    right = _read(spark, sf_dir, "customer", "c_custkey", "c_name").withColumn("o", F.col("c_custkey"))
    flipped = right.withColumn("rank_name", F.col("c_name"))
    return decks.zipped(left, flipped.select("c_custkey", "rank_name"), ["o_orderkey"], [F.desc("rank_name"), F.col("c_custkey")]).select("place", "o_orderkey", "c_custkey")


# ------------------------------------------------------------------ markup

_W = 'xmlns:w="urn:w"'


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small word-processing part for each customer: runs with edge spaces, insertions and deletions by two authors, foreign markup."""
    k = F.col("c_custkey")
    pick = lambda cond, x, y="": F.when(cond, F.lit(x)).otherwise(F.lit(y))
    xml = F.concat(
        F.lit(f'<w:document {_W} xmlns:x="urn:x"><w:body>'), F.lit("<w:p><w:r><w:t"), pick(k % 2 == 0, ' xml:space="preserve"'), F.lit(">"), pick(k % 3 == 0, " "), F.lit("a"), _text(k), F.lit("</w:t></w:r></w:p>"),
        F.lit("<w:p><w:del w:author="), pick(k % 4 == 0, '"ann"', '"bob"'), F.lit("><w:r>"), pick(k % 5 == 0, "<w:t>gone</w:t>", "<w:delText>gone</w:delText>"), F.lit("</w:r></w:del>"),
        F.lit("<w:ins w:author="), pick(k % 3 == 1, '"ann"', '"bob"'), F.lit("><w:r>"), pick(k % 7 == 0, "<w:delText>new</w:delText>", "<w:t>new</w:t>"), F.lit("</w:r></w:ins></w:p>"),
        pick(k % 6 == 0, '<x:extra x:a="1"><w:p/></x:extra>', "<!-- note -->"), pick(k % 8 == 0, '<w:p x:mark="1"/>'), F.lit("<w:note>{{tag}} is {{here}}</w:note><w:sp> </w:sp></w:body></w:document>"),
    )
    return dealt(_read(spark, sf_dir, "customer", "c_custkey")).select(k.alias("part"), F.when(k % 50 == 49, "<broken").otherwise(xml).alias("xml"))


_GOOD = "c AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 50 <> 49)"


@query(f"WITH {_GOOD} SELECT k AS part, concat(' a', CAST(k AS VARCHAR)) AS text FROM c WHERE k % 3 = 0 AND k % 2 <> 0")
def q_lost_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.lost_whitespace(markup.xml_elements(_documents(spark, sf_dir))).select("part", "text")


@query(f"WITH {_GOOD} SELECT k AS part, 'text_in_deletion' AS fault FROM c WHERE k % 5 = 0 UNION ALL SELECT k, 'deleted_text_in_insertion' FROM c WHERE k % 7 = 0")
def q_misplaced_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.misplaced_text(markup.xml_elements(_documents(spark, sf_dir))).select("part", "fault")


@query(f"WITH {_GOOD}, n AS (SELECT k, 2 + CAST(k % 6 = 0 AS INT) + CAST(k % 8 = 0 AS INT) AS n FROM c) SELECT k AS part, n AS before, n - CAST(k % 6 = 0 AS INT) AS after, -CAST(k % 6 = 0 AS INT) AS delta FROM n")
def q_paragraph_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = markup.xml_elements(_documents(spark, sf_dir))
    out = markup.paragraph_change(before, markup.known_namespaces_only(before, ["urn:w"]))
    return out.select("part", *(F.col(c).cast("int").alias(c) for c in ("before", "after", "delta")))


@query(f"WITH {_GOOD} SELECT k AS part, 16 + CAST(k % 8 = 0 AS INT) AS elements, CAST(k % 2 = 0 AS INT) AS spaces, 0 AS marks FROM c")
def q_known_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pure = markup.known_namespaces_only(markup.xml_elements(_documents(spark, sf_dir)), ["urn:w", "http://www.w3.org/XML/1998/namespace"])
    has = lambda name: F.count_if(F.array_contains(F.map_keys("attrs"), name)).cast("int")
    return pure.groupBy("part").agg((F.count(F.lit(1)) + 2).cast("int").alias("elements"), has(markup.XML_SPACE).alias("spaces"), has("{urn:x}mark").alias("marks"))


@query(f"""WITH {_GOOD}, t AS (SELECT k, concat(CASE WHEN k % 3 = 0 THEN ' ' ELSE '' END, 'a', CAST(k AS VARCHAR)) AS one, concat(CASE WHEN k % 5 = 0 OR k % 4 = 0 THEN 'gone' ELSE '' END, CASE WHEN k % 3 <> 1 AND k % 7 <> 0 THEN 'new' ELSE '' END) AS two FROM c)
SELECT k AS part, CASE WHEN two = '' THEN one ELSE concat(one, chr(10), two) END AS content FROM t""")
def q_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.plain_text(_documents(spark, sf_dir), "ann").filter("content is not null").select("part", "content")


@query(f"WITH {_GOOD} SELECT k AS part, k % 9 <> 0 AS same FROM c")
def q_untracked_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _documents(spark, sf_dir).filter("part % 50 <> 49")
    # A change inside a tracked insertion does not count, one outside does.
    after = before.withColumn("xml", F.when(F.col("part") % 9 == 0, F.replace("xml", F.lit(">a"), F.lit(">b"))).otherwise(F.replace("xml", F.lit("</w:body>"), F.lit('<w:p><w:ins w:author="ann"><w:r><w:t>more</w:t></w:r></w:ins></w:p></w:body>'))))
    spaced = after.withColumn("xml", F.when((F.col("part") % 9 == 0) & (F.col("part") % 3 == 0), F.replace("xml", F.lit("> a"), F.lit("> b"))).otherwise(F.col("xml")))
    return markup.untracked_changes(before, spaced, "ann")


@query(f"WITH {_GOOD} SELECT k AS part, false AS notes, true AS whole FROM c")
def q_condensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = markup.condensed(_documents(spark, sf_dir)).filter("xml is not null")
    empty = F.col("xml").contains("<w:sp/>")
    return rows.select("part", F.col("xml").contains("<!--").alias("notes"), empty.alias("whole"))


@query(f"WITH {_GOOD} SELECT k // 10 AS package, count(*) AS parts, min(k) AS first FROM c GROUP BY 1")
def q_package_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _documents(spark, sf_dir).filter("part % 50 <> 49").select(F.floor(F.col("part") / 10).alias("package"), F.concat(F.lit("word/p"), _text(F.col("part")), F.lit(".xml")).alias("name"), "xml")
    back = sinks.parts_of(sinks.packages(parts.withColumn("package", _text(F.col("package")))))
    number = F.regexp_extract("name", "p([0-9]+)", 1).cast("long")
    return back.groupBy(F.col("package").cast("long").alias("package")).agg(F.count(F.lit(1)).alias("parts"), F.min(number).alias("first"))


@query(f"WITH {_GOOD} SELECT k AS part, ' is ' AS text, 2 AS templates FROM c")
def q_without_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = markup.without_templates(markup.xml_elements(_documents(spark, sf_dir)))
    return rows.filter("templates > 0").select("part", "text", "templates")


@query("""WITH p AS (SELECT c_custkey AS k FROM customer), r AS (SELECT k, unnest([0, 0, 0, 1]) AS block, unnest(['p', 'p', 'p', 'h2']) AS tag, unnest([0, 1, 2, 0]) AS run, unnest([concat('one ', CAST(k AS VARCHAR), ' '), CASE WHEN k % 2 = 0 THEN 'two' ELSE 'tw' END, ' three', concat('Head ', CAST(k AS VARCHAR))]) AS text, unnest([false, true, false, false]) AS bold, unnest([false, k % 2 = 0, false, false]) AS italic, unnest([false, false, false, false]) AS underline FROM p) SELECT * FROM r""")
def q_html_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    html = F.concat(F.lit("<html><body>loose<p>  one\n "), _text(k), F.lit(" <b>"), F.when(k % 2 == 0, "<i>two</i>").otherwise("tw"), F.lit("</b> three </p><p> </p><div><h2>Head "), _text(k), F.lit("</h2></div></body></html>"))
    return markup.html_runs(dealt(_read(spark, sf_dir, "customer", "c_custkey")).select(k.alias("k"), html.alias("html")), "k")


@query("SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) <> '' AS titled, regexp_matches(html, '<p(\\s[^>]*)?>(<[^>]*>|\\s)*[^<\\s]') AS has_text FROM pages")
def q_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages", "page_id", "html")
    runs = markup.html_runs(pages, "page_id").filter("tag = 'p'").select("page_id").distinct().withColumn("has_text", F.lit(True))
    out = pages.join(runs, "page_id", "left")
    return out.select("page_id", (X.strip(F.regexp_extract("html", "<title>([^<]*)</title>", 1)) != "").alias("titled"), F.coalesce("has_text", F.lit(False)).alias("has_text"))


@query("""WITH p AS (SELECT c_custkey AS k, 960 + c_custkey % 3 * 5 AS width, 540 AS height, 960 + c_custkey % 20 AS scroll_width, 540 + c_custkey % 4 AS scroll_height FROM customer)
SELECT k, greatest(0, scroll_width - width - 1) * 0.75::DOUBLE AS over_wide, greatest(0, scroll_height - height - 1) * 0.75::DOUBLE AS over_high, abs(10 - width / 96::DOUBLE) > 0.1 OR abs(5.625 - height / 96::DOUBLE) > 0.1 AS wrong_size FROM p""")
def q_layout_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    pages = _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("k"), (960 + k % 3 * 5).alias("width"), F.lit(540).alias("height"), (960 + k % 20).alias("scroll_width"), (540 + k % 4).alias("scroll_height"), F.lit(9144000).alias("layout_width"), F.lit(5143500).alias("layout_height"))
    return markup.layout_faults(pages).select("k", "over_wide", "over_high", "wrong_size")


@query("""WITH t AS (SELECT c_custkey AS k, CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'p' WHEN 1 THEN 'h1' ELSE 'image' END AS type, CAST(c_custkey % 20 AS INT) AS font_size, (c_custkey % 50) / 10::DOUBLE AS y FROM customer)
SELECT k, round(5.625 - (y + 0.5), 2) AS distance FROM t WHERE type <> 'image' AND font_size > 12 AND 5.625 - (y + 0.5) < 0.5""")
def q_too_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    texts = _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("k"), F.when(k % 3 == 0, "p").when(k % 3 == 1, "h1").otherwise("image").alias("type"), (k % 20).cast("int").alias("font_size"), (k % 50 / F.lit(10.0)).alias("y"), F.lit(0.5).alias("h"), F.lit(540).alias("page_height"))
    return markup.too_low(texts).select("k", "distance")


@query("""WITH u AS (SELECT o_custkey AS part, o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE concat('rId', CAST(o_orderkey % 9 AS VARCHAR)) END AS rid FROM orders)
SELECT part, id, CASE WHEN part % 4 = 0 THEN 'no relations' ELSE 'no such layout' END AS problem FROM u WHERE rid <> '' AND (part % 4 = 0 OR substr(rid, 4)::INT > 5 OR substr(rid, 4)::INT % 2 = 1)""")
def q_layout_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    uses = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_custkey").alias("part"), k.alias("id"), F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("rId"), _text(k % 9))).alias("rid"))
    n = F.col("n")
    rels = uses.select("part").distinct().filter("part % 4 <> 0").select("part", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("n")).select("part", F.concat(F.lit("rId"), _text(n)).alias("id"), F.when(n % 2 == 0, "http://x/slideLayout").otherwise("http://x/theme").alias("type"))
    return markup.layout_ids(uses, rels).select("part", "id", "problem")


# ------------------------------------------------------------------ functions


@query("""WITH u AS (SELECT c_custkey AS k, concat(CASE WHEN c_custkey % 3 = 0 THEN '{' ELSE '' END, printf('%08d', c_custkey), '-0000-4000-8000-', CASE WHEN c_custkey % 4 = 0 THEN 'zz' ELSE 'ab' END, '0123456789', CASE WHEN c_custkey % 3 = 0 THEN '}' ELSE '' END, CASE WHEN c_custkey % 7 = 0 THEN '!' ELSE '' END) AS id FROM customer) SELECT k, k % 7 <> 0 AS shaped, k % 7 <> 0 AND k % 4 <> 0 AS valid FROM u""")
def q_uuids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    curly = k % 3 == 0
    own = F.concat(F.when(curly, "{").otherwise(""), F.format_string("%08d", k), F.lit("-0000-4000-8000-"), F.when(k % 4 == 0, "zz").otherwise("ab"), F.lit("0123456789"), F.when(curly, "}").otherwise(""), F.when(k % 7 == 0, "!").otherwise(""))
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("k"), X.uuid_shaped(own).alias("shaped"), X.uuid_valid(own).alias("valid"))


@query("""WITH p AS (SELECT c_custkey AS k, CASE CAST(c_custkey % 8 AS INT) WHEN 0 THEN 'word/_rels/a.rels' WHEN 1 THEN '[Content_Types].xml' WHEN 2 THEN 'docProps/app.xml' WHEN 3 THEN 'ppt/charts/chart1.xml' WHEN 4 THEN 'ppt/theme/theme1.xml' WHEN 5 THEN 'word/document.xml' WHEN 6 THEN 'ppt/slides/slide1.xml' ELSE 'xl/sheet1.xml' END AS name FROM customer)
SELECT k, name, ['relationships', 'content-types', 'properties', 'chart', 'drawing', 'wordprocessing', 'presentation', 'spreadsheet'][k % 8 + 1] AS family FROM p""")
def q_schema_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    names = ["word/_rels/a.rels", "[Content_Types].xml", "docProps/app.xml", "ppt/charts/chart1.xml", "ppt/theme/theme1.xml", "word/document.xml", "ppt/slides/slide1.xml", "xl/sheet1.xml"]
    name = F.element_at(F.array(*map(F.lit, names)), (k % 8 + 1).cast("int"))
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("k"), name.alias("name")).withColumn("family", X.schema_file(F.col("name")))


@query("SELECT p_partkey AS k, round(p_partkey * 12700 / 914400::DOUBLE, 6) AS inches, CAST(trunc(p_size / 10::DOUBLE * 96) AS INT) AS px, round(p_size / 96::DOUBLE, 6) AS back, p_size * 0.75::DOUBLE AS pt, CAST(trunc(p_size / 1000::DOUBLE * 768) AS INT) AS at FROM part")
def q_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    return _read(spark, sf_dir, "part", "p_partkey", "p_size").select(k.alias("k"), F.round(G.emu_to_inches(k * 12700), 6).alias("inches"), G.inches_to_pixels(s / F.lit(10.0)).alias("px"), F.round(G.pixels_to_inches(s), 6).alias("back"), G.pixels_to_points(s).alias("pt"), G.from_grid(s, F.lit(768)).alias("at"))


@query("SELECT event_id, strftime(date_trunc('second', CAST(ts AS TIMESTAMP)), '%Y%m%d_%H%M%S') AS stamp FROM events")
def q_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events", "event_id", "ts").select("event_id", X.compact_stamp(F.col("ts")).alias("stamp"))


@query("""WITH s AS (SELECT c_custkey AS k, CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'uppercase' WHEN 1 THEN 'lowercase' WHEN 2 THEN 'capitalize' ELSE 'none' END AS rule FROM customer)
SELECT k, CASE CAST(k % 4 AS INT) WHEN 0 THEN 'AB CD' WHEN 1 THEN 'ab cd' WHEN 2 THEN 'Ab CD' ELSE 'ab CD' END AS text, CASE WHEN (k * 15 + CASE WHEN k % 5 = 0 THEN 90 ELSE 0 END) % 360 = 0 THEN NULL ELSE CAST((k * 15 + CASE WHEN k % 5 = 0 THEN 90 ELSE 0 END) % 360 AS DOUBLE) END AS angle,
CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(floor(degrees(atan2(k % 7 + 1, k % 5 + 1)) + 0.5) AS INT) END AS shadow_angle, CASE WHEN k % 3 = 0 THEN NULL ELSE 3.0 END AS blur, CAST(k % 256 AS INT) AS red FROM s""")
def q_css_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rule = F.when(k % 4 == 0, "uppercase").when(k % 4 == 1, "lowercase").when(k % 4 == 2, "capitalize").otherwise("none")
    css = F.concat(F.lit("rgba(0, 0, 0, 0.3) "), _text(k % 5 + 1), F.lit("px "), _text(k % 7 + 1), F.lit("px 4px 0px"), F.when(k % 3 == 0, " inset").otherwise(""))
    turn = C.rotation(F.concat(F.lit("rotate("), _text(k * 15), F.lit("deg)")), F.when(k % 5 == 0, "vertical-rl"))
    hexed = F.concat(F.lpad(F.lower(F.hex(k % 256)), 2, "0"), F.lit("0000"))
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("k"), C.text_transform(F.lit("ab CD"), rule).alias("text"), turn.alias("angle"), C.shadow(css)["angle"].alias("shadow_angle"), C.shadow(css)["blur"].alias("blur"), C.hex_to_rgb(hexed)["r"].alias("red"))


@query("SELECT c_custkey AS k, concat('v', CAST(c_custkey AS VARCHAR), ': x') AS a, CASE WHEN c_custkey % 2 = 0 THEN 'second' END AS b, concat('Skill ', CAST(c_custkey AS VARCHAR), ' Name') AS title FROM customer")
def q_parsed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    entries = F.array(F.concat(F.lit(" A : v"), _text(k), F.lit(": x")), F.lit("malformed"), F.when(k % 2 == 0, "B:first").otherwise("C:"), F.when(k % 2 == 0, "B: second ").otherwise("none"))
    pairs = X.parse_pairs(entries, ":")
    return _read(spark, sf_dir, "customer", "c_custkey").select(k.alias("k"), F.try_element_at(pairs, F.lit("A")).alias("a"), F.try_element_at(pairs, F.lit("B")).alias("b"), X.title_case(F.concat(F.lit("skill-"), _text(k), F.lit("-name"))).alias("title"))


# ------------------------------------------------------------------ slides

_NS = 'xmlns:p="urn:p" xmlns:a="urn:a"'


def _slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slide for each customer: a title, a group that holds a shape, and a bulleted body."""
    k = F.col("c_custkey")
    at = lambda tag, x, y: F.concat(F.lit(f"<p:{tag}><a:xfrm><a:off x='"), _text(x), F.lit("' y='"), _text(y), F.lit("'/><a:ext cx='914400' cy='457200'/></a:xfrm>"), F.lit(f"</p:{tag}>"))
    para = lambda props, run, text: F.concat(F.lit(f"<a:p>{props}<a:r>"), run, F.lit("<a:t>"), text, F.lit("</a:t></a:r></a:p>"))
    shape = lambda ph, place, *paras: F.concat(F.lit(f"<p:sp><p:nvSpPr><p:nvPr>{ph}</p:nvPr></p:nvSpPr>"), place, F.lit("<p:txBody>"), *paras, F.lit("</p:txBody></p:sp>"))
    font = F.concat(F.lit("<a:rPr sz='"), _text(k % 5 * 200 + 1200), F.when(k % 2 == 0, "' b='1'").otherwise("'"), F.lit("><a:solidFill><a:srgbClr val='FF0000'/></a:solidFill></a:rPr>"))
    title = shape("<p:ph type='title'/>", at("spPr", k % 100 * 914, k % 7 * 914), para("<a:pPr algn='ctr'/>", font, F.concat(F.lit(" Title "), _text(k))))
    inner = shape("", at("spPr", k % 11 + 10, k % 13 + 10), para("", F.lit(""), F.lit("inner")))
    body = shape("<p:ph type='body'/>", at("spPr", F.lit(0), F.lit(0)), para("<a:pPr lvl='1'><a:spcBef><a:spcPts val='600'/></a:spcBef><a:buChar char='o'/></a:pPr>", F.lit(""), F.lit("point")), para("<a:pPr><a:lnSpc><a:spcPct val='150000'/></a:lnSpc></a:pPr>", F.lit(""), F.lit("more")))
    xml = F.concat(F.lit(f"<p:sld {_NS}><p:cSld><p:spTree><p:nvGrpSpPr/>"), title, F.lit("<p:grpSp>"), at("grpSpPr", k % 17 * 100, k % 19 * 100), inner, F.lit("</p:grpSp>"), body, F.lit("</p:spTree></p:cSld></p:sld>"))
    return dealt(_read(spark, sf_dir, "customer", "c_custkey")).select(_text(F.floor(k / 10)).alias("package"), F.concat(F.lit("ppt/slides/slide"), _text(k + 1), F.lit(".xml")).alias("name"), F.when(k % 40 == 39, "<no").otherwise(xml).alias("xml"))


@query("""WITH c AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 40 <> 39) SELECT CAST(k AS INT) AS slide, 0 AS id, k % 100 * 914 AS x, k % 7 * 914 AS y, 'TITLE' AS placeholder, concat('Title ', CAST(k AS VARCHAR)) AS text FROM c
UNION ALL SELECT k, 2, k % 11 + 10, k % 13 + 10, NULL, 'inner' FROM c UNION ALL SELECT k, 3, 0, 0, 'BODY', concat('point', chr(10), 'more') FROM c""")
def q_slide_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_lineage(packages.slide_shapes(_slides(spark, sf_dir)).drop("paragraphs"))
    key = lambda c: F.struct("package", "slide", F.col(c).alias("id"))
    # The group's own offset is where its shapes' places are counted from.
    placed = flatten_groups(rows.select(key("id").alias("id"), F.when(F.col("parent").isNotNull(), key("parent")).alias("parent"), F.col("left_emu").alias("dx"), F.col("top_emu").alias("dy")))
    there = decks.valid_shapes(rows).withColumn("key", key("id")).join(large(placed.select(F.col("id").alias("key"), "x", "y")), "key")
    return there.select("slide", F.col("id").cast("int").alias("id"), "x", "y", "placeholder", "text")


@query("""WITH c AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 40 <> 39) SELECT k AS slide, 0 AS id, 0 AS pos, false AS bullet, CAST(NULL AS INT) AS level, 'CENTER' AS alignment, CAST(k % 5 * 2 + 12 AS DOUBLE) AS font_size, CASE WHEN k % 2 = 0 THEN true END AS bold, 'FF0000' AS color, CAST(NULL AS DOUBLE) AS space_before, CAST(NULL AS DOUBLE) AS line_spacing FROM c
UNION ALL SELECT k, 2, 0, false, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM c UNION ALL SELECT k, 3, 0, true, 1, NULL, NULL, NULL, NULL, 6.0, NULL FROM c UNION ALL SELECT k, 3, 1, false, NULL, NULL, NULL, NULL, NULL, NULL, 18.0 FROM c""")
def q_slide_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packages.slide_shapes(_slides(spark, sf_dir))
    fields = ["pos", "bullet", "level", "alignment", "font_size", "bold", "color", "space_before", "line_spacing"]
    return rows.select(F.col("slide").cast("long").alias("slide"), F.col("id").cast("int").alias("id"), F.explode("paragraphs").alias("p")).select("slide", "id", *(f"p.{f}" for f in fields))
