"""Slide decks, packages of XML parts, question sets: operators over shapes, paragraphs, rels, elements, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ._shared import large, numbered

#: Elements whose ids must be unique, with the id attribute and whether in a file or globally.
UNIQUE_IDS = {
    "comment": ("id", "file"),
    "commentrangestart": ("id", "file"),
    "commentrangeend": ("id", "file"),
    "bookmarkstart": ("id", "file"),
    "bookmarkend": ("id", "file"),
    "sldid": ("id", "file"),
    "sldmasterid": ("id", "global"),
    "sldlayoutid": ("id", "global"),
    "cm": ("authorid", "file"),
    "sheet": ("sheetid", "file"),
    "definedname": ("id", "file"),
    "cxnsp": ("id", "file"),
    "sp": ("id", "file"),
    "pic": ("id", "file"),
    "grpsp": ("id", "file"),
}


def row_bands(shapes: DataFrame, within: list[str], tolerance: float = 0.5) -> DataFrame:
    """shapes (id, left, top) with position: read in bands from the top. A band holds the shapes whose top is within the
    tolerance of the band's first; in a band from left to right. Only a slide's distinct tops are walked in order."""
    tops = shapes.groupBy(*within).agg(F.array_sort(F.collect_set(F.col("top").cast("double"))).alias("tops"))

    def step(starts: Column, top: Column) -> Column:
        new = (F.size(starts) == 0) | (top - F.element_at(starts, -1) > tolerance)
        return F.when(new, F.concat(starts, F.array(top))).otherwise(starts)

    bands = tops.select(*within, F.aggregate("tops", F.array().cast("array<double>"), step).alias("starts"))
    own = shapes.select(*within, "id", "left", "top").join(large(bands), within)
    rows = own.withColumn("band", F.size(F.filter("starts", lambda s: s <= F.col("top"))))
    order = Window.partitionBy(*within).orderBy("band", "left", "top", "id")
    return rows.select(*within, (F.row_number().over(order) - 1).alias("position"), "band", F.col("id").cast("long").alias("id"))


def shape_overlaps(shapes: DataFrame, cell: int = 2, most: int = 1000) -> DataFrame:
    """(slide, id, other, area) in both directions for shapes (slide, id, box) that overlap beyond the tolerance.

    Shapes of equal boxes travel as one row, of at most `most` ids; areas are found once for two boxes, and the ids are
    paired last, behind the join, so that what grows with the square is only written, not judged, rounded or shuffled.
    """
    from .spatial import in_cells

    sides = [f"box.{c}" for c in ("y1", "x1", "y2", "x2")]
    place = Window.partitionBy("slide", *(F.col(c) for c in sides)).orderBy("id")
    packed = shapes.withColumn("pack", F.floor((F.row_number().over(place) - 1) / most)).groupBy("slide", *(F.col(c) for c in sides), "pack").agg(F.collect_list("id").alias("ids"))
    parts = 16 * max(2, shapes.sparkSession.sparkContext.defaultParallelism)
    dealt = in_cells(packed.select("slide", "ids", F.struct("y1", "x1", "y2", "x2").alias("box")), cell).select("slide", "cx", "cy", "ids", "box.*").repartition(parts, "slide", "cx", "cy")
    side = lambda s: dealt.select("slide", "cx", "cy", *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "y1", "x1", "y2", "x2")))
    a, b = ({c: F.col(f"{c}_{s}") for c in ("y1", "x1", "y2", "x2")} for s in "ab")
    home = (F.col("cx") == F.floor(F.greatest(a["x1"], b["x1"]) / cell)) & (F.col("cy") == F.floor(F.greatest(a["y1"], b["y1"]) / cell))
    met = side("a").join(large(side("b")), ["slide", "cx", "cy"]).filter(G.rectangles_meet(a, b) & home)
    found = met.select("slide", "ids_a", "ids_b", G.rectangle_overlap(a, b).alias("area"))
    return found.select("slide", F.explode("ids_a").alias("id"), "ids_b", "area").select("slide", "id", F.explode("ids_b").alias("other"), "area").filter("id <> other")


def broken_targets(rels: DataFrame, parts: DataFrame) -> DataFrame:
    """rels (folder, id, target) that lead to no part (name); links out of the package are left alone."""
    inner = rels.filter(~F.col("target").rlike("^(http|mailto:)")).withColumn("name", X.resolve_target(F.col("folder"), F.col("target")))
    return inner.join(parts.select("name"), "name", "left_anti")


def unreferenced_parts(rels: DataFrame, parts: DataFrame) -> DataFrame:
    named = rels.select(X.resolve_target(F.col("folder"), F.col("target")).alias("name"))
    return parts.filter(~F.col("name").rlike(r"(^|/)(_rels/|\[Content_Types\]\.xml$|docProps/)")).join(named, "name", "left_anti")


def check_relationships(uses: DataFrame, rels: DataFrame) -> DataFrame:
    """uses (part, element, rid) judged against rels (part, id, type): missing, or a type that the element does not expect."""
    found = uses.join(rels.select("part", F.col("id").alias("rid"), F.col("type")), ["part", "rid"], "left").withColumn("expected", X.relationship_type(F.col("element")))
    verdict = F.when(F.col("type").isNull(), "missing").when(F.col("expected").isNotNull() & ~F.lower("type").contains(F.col("expected")), "type_mismatch")
    return found.withColumn("verdict", verdict).filter("verdict is not null").select("part", "element", "rid", "verdict")


def duplicate_xml_ids(elements: DataFrame, rules: dict[str, tuple[str, str]] = UNIQUE_IDS) -> DataFrame:
    """elements (part, name, attrs map, line): the second and later of each id that must be unique in its file or in the package."""
    table = F.create_map(*(x for k, (a, s) in rules.items() for x in (F.lit(k), F.struct(F.lit(a).alias("attr"), F.lit(s).alias("scope")))))
    named = elements.withColumn("name", X.local_name(F.col("name"))).withColumn("rule", F.try_element_at(table, F.col("name"))).filter("rule is not null")
    ids = named.withColumn("value", F.try_element_at(F.col("attrs"), F.col("rule.attr"))).filter("value is not null").withColumn("home", F.when(F.col("rule.scope") == "file", F.col("part")).otherwise(F.lit("")))
    n = F.row_number().over(Window.partitionBy("home", "name", "value").orderBy("part", "line"))
    return ids.withColumn("n", n).filter("n > 1").select("part", "name", "value", "line")


def undeclared_content(parts: DataFrame, overrides: DataFrame, defaults: DataFrame) -> DataFrame:
    """parts (name) without an override (name) and without a default for their extension (extension)."""
    bare = parts.join(overrides, "name", "left_anti").withColumn("extension", F.lower(F.substring_index("name", ".", -1)))
    return bare.join(defaults.select(F.lower("extension").alias("extension")), "extension", "left_anti").select("name")


def more_than_once(refs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Groups of more than one value, with the sorted values."""
    return refs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(value)).alias("members")).filter("n > 1")


def gather(slides: DataFrame, order: DataFrame) -> DataFrame:
    """The slides (idx, ...) in the order of (pos, idx); repeats repeat; an index out of range keeps a row with found = false."""
    return order.join(slides.withColumn("found", F.lit(True)), "idx", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def hidden(show: Column) -> Column:
    """Whether a slide's `show` attribute hides it; one that is missing does not."""
    return F.coalesce(show == "0", F.lit(False))


def interleave(slides: DataFrame, images: DataFrame) -> DataFrame:
    """slides (idx, hidden) with the image (n) of each shown slide, by running count; hidden ones get none."""
    shown = F.sum(F.when(~F.col("hidden"), 1).otherwise(0)).over(Window.partitionBy("deck").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    return slides.withColumn("n", F.when(~F.col("hidden"), shown)).join(images, ["deck", "n"], "left")


def pages_of(rows: DataFrame, key: str, order: list[str], limit: int, offset: int) -> DataFrame:
    """A page of rows in total order, with total, has_more and next_offset. Only the page is kept by the sort."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    page = rows.orderBy(*order).offset(offset).limit(limit)
    end = F.lit(offset + limit)
    return page.crossJoin(F.broadcast(total)).withColumns({"has_more": F.col("total") > end, "next_offset": F.when(F.col("total") > end, end)})  # one row


def tool_metrics(calls: DataFrame, size: int = 10_000) -> DataFrame:
    """(tool, page, calls, durations in order of ts, id) of calls (tool, ts, id, duration); a page holds `size` calls, so a busy tool is no single row."""
    placed = numbered(calls.select("tool", "ts", "id", "duration"), ["tool"], ["ts", "id"], "n").withColumn("page", F.floor((F.col("n") - 1) / size).cast("long"))
    return placed.groupBy("tool", "page").agg(F.count(F.lit(1)).alias("calls"), F.transform(F.array_sort(F.collect_list(F.struct("n", "duration"))), lambda s: s["duration"]).alias("durations"))


def run_report(results: DataFrame) -> DataFrame:
    """One row: tasks, accuracy in percent, mean duration, mean and total tool calls; 0 without results."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    score = X.exact_score(F.col("actual"), F.col("expected"))
    mean = lambda c: zero(F.round(F.avg(c), 3))
    return results.agg(
        F.count(F.lit(1)).alias("tasks"),
        mean(100.0 * score).alias("accuracy"),
        mean("duration").alias("mean_duration"),
        mean("tool_calls").alias("mean_calls"),
        F.coalesce(F.sum("tool_calls"), F.lit(0)).cast("long").alias("total_calls"),
    )


def fit_texts(shapes: DataFrame, replacements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shapes with their new text, null where none is given; replacements for shapes that are not there)."""
    return shapes.join(replacements, ["slide", "shape_id"], "left"), replacements.join(shapes, ["slide", "shape_id"], "left_anti")


def grown_overflow(before: DataFrame, after: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Shapes (slide, shape_id, overflow) that overflow by more than before; missing counts 0."""
    both = after.join(before.withColumnRenamed("overflow", "was"), ["slide", "shape_id"], "left").withColumn("was", F.coalesce("was", F.lit(0.0)))
    return both.filter(F.col("overflow") > F.col("was") + tolerance)


def first_value(rows: DataFrame, within: list[str], value: str, order: str) -> DataFrame:
    """The first value that is there in each group, with its place in order."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*within).agg(F.min_by(value, order).alias(value), F.min(order).alias(order))


def top_of(rows: DataFrame, within: list[str], order: list[Column], most: int) -> DataFrame:
    """The first `most` rows of each group in order, with place; the rank limit is applied before the shuffle too."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col("place") <= most)
