"""Text inventory of slide decks: which shapes count, how their text fits, what a replacement changes.

Shapes are rows (deck, slide, ...) with lengths in EMU; paragraphs are rows of shapes. One slide's shapes may be gathered, a deck's are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ._shared import large, numbered
from .documents import row_bands, shape_overlaps

#: Margins of a text frame in inches where none are set.
MARGINS = {"top": 0.05, "bottom": 0.05, "left": 0.1, "right": 0.1}
ISSUES = ("frame_overflow", "overflow_right", "overflow_bottom", "overlaps", "bullet")


def valid_shapes(shapes: DataFrame) -> DataFrame:
    """shapes (text, placeholder) with text, but no slide numbers and no footers of digits alone."""
    text = X.strip(F.col("text"))
    number = F.coalesce((F.col("placeholder") == "SLIDE_NUMBER") | ((F.col("placeholder") == "FOOTER") & text.rlike("^[0-9]+$")), F.lit(False))
    return shapes.filter(text.isNotNull() & (text != "") & ~number)


def in_inches(shapes: DataFrame) -> DataFrame:
    """shapes (left_emu, top_emu, width_emu, height_emu) with left, top, width and height in inches, to 2 places."""
    return shapes.withColumns({c: F.round(G.emu_to_inches(F.col(f"{c}_emu")), 2) for c in ("left", "top", "width", "height")})


def usable_size(width: Column, height: Column, margins: dict[str, Column] | None = None) -> Column:
    """(width, height) in pixels inside a frame's margins: those given in EMU, else the usual ones (0 counts as not set)."""
    inch = {k: F.lit(v) if margins is None or k not in margins else F.coalesce(G.emu_to_inches(F.nullif(margins[k], F.lit(0))), F.lit(v)) for k, v in MARGINS.items()}
    return F.struct(G.inches_to_pixels(width - inch["left"] - inch["right"]).alias("width"), G.inches_to_pixels(height - inch["top"] - inch["bottom"]).alias("height"))


def wrapped_lines(text: Column, width: Column, char_width: Column) -> Column:
    """Number of lines that a paragraph takes: each of its lines is kept if it fits, else wrapped word by word.

    Widths are a fixed one for each character; a word wider than the frame has a line of its own.
    """
    most = F.floor(width / char_width)

    def of_line(line: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"))

        def step(acc: Column, word: Column) -> Column:
            size = F.length(word)
            fits = acc["used"] + F.when(acc["used"] > 0, 1).otherwise(0) + size <= most
            # An empty line so far is taken up by whatever comes; it is counted when it gets its first word.
            return F.struct(
                F.when(size == 0, acc["n"]).when((acc["n"] > 0) & fits, acc["n"]).otherwise(acc["n"] + 1).cast("int").alias("n"),
                F.when(size == 0, acc["used"]).when((acc["n"] > 0) & fits, acc["used"] + F.when(acc["used"] > 0, 1).otherwise(0) + size).otherwise(size).cast("int").alias("used"),
            )

        return F.when((F.length(line) <= most) | (line == ""), F.lit(1)).otherwise(F.aggregate(F.split(line, " "), start, step)["n"])

    return F.aggregate(F.split(text, "\n"), F.lit(0), lambda n, line: n + of_line(line))


def frame_overflow(shapes: DataFrame, paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """shapes (keys, usable width and height in pixels) with frame_overflow: inches by which their text is too high, null up to 0.05.

    paragraphs (keys, pos, text, font_size, line_spacing, space_before, space_after in points): a line is as high as its
    spacing or font; space before counts from the second paragraph on; paragraphs without text take no room.
    """
    px = lambda c: F.coalesce(F.col(c), F.lit(0.0)) * 96 / 72
    rows = paragraphs.filter(X.strip(F.col("text")) != "").join(shapes.select(*keys, "usable"), keys)
    high = wrapped_lines(F.col("text"), F.col("usable.width"), F.col("font_size") * 96 / 72 * F.lit(0.5)) * F.coalesce(F.nullif("line_spacing", F.lit(0.0)), F.col("font_size").cast("double")) * 96 / 72
    total = rows.groupBy(*keys).agg(F.sum(high + F.when(F.col("pos") > 0, px("space_before")).otherwise(0.0) + px("space_after")).alias("needed"))
    over = F.round((F.col("needed") - F.col("usable.height")) / 96.0, 2)
    return shapes.join(total, keys, "left").withColumn("frame_overflow", F.when((F.col("usable.width") > 0) & (F.col("usable.height") > 0) & (over > 0.05), over)).drop("needed")


def slide_overflow(shapes: DataFrame) -> DataFrame:
    """shapes with overflow_right and overflow_bottom: inches beyond the slide (slide_width, slide_height in EMU), null up to 0.01."""
    def over(low: str, size: str, limit: str) -> Column:
        inches = F.round(G.emu_to_inches(F.col(low) + F.col(size) - F.col(limit)), 2)
        return F.when(inches > 0.01, inches)

    return shapes.withColumns({"overflow_right": over("left_emu", "width_emu", "slide_width"), "overflow_bottom": over("top_emu", "height_emu", "slide_height")})


def number_shapes(shapes: DataFrame) -> DataFrame:
    """shapes (deck, slide, id, left, top) with shape_id: shape-0 and so on in reading order."""
    order = row_bands(shapes.select("deck", "slide", "id", "left", "top"), ["deck", "slide"]).select("deck", "slide", "id", F.concat(F.lit("shape-"), F.col("position").cast("string")).alias("shape_id"))
    return shapes.join(large(order), ["deck", "slide", "id"])


def with_overlaps(shapes: DataFrame) -> DataFrame:
    """shapes with overlaps: the areas that they share with others of their slide, by shape_id; null without any."""
    corner = F.struct(F.col("top").alias("y1"), F.col("left").alias("x1"), (F.col("top") + F.col("height")).alias("y2"), (F.col("left") + F.col("width")).alias("x2"))
    boxes = shapes.select(F.struct("deck", "slide").alias("slide"), F.col("shape_id").alias("id"), corner.alias("box"))
    pairs = shape_overlaps(boxes).groupBy("slide.deck", "slide.slide", F.col("id").alias("shape_id")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("other", "area")))).alias("overlaps"))
    return shapes.join(large(pairs), ["deck", "slide", "shape_id"], "left")


def with_issues(shapes: DataFrame) -> DataFrame:
    """Only shapes with an overflow, an overlap or a bullet typed by hand; overlaps were found among all."""
    found = [F.col(c).isNotNull() for c in ("frame_overflow", "overflow_right", "overflow_bottom", "overlaps")] + [F.coalesce("bullet", F.lit(False))]
    any_of = found[0]
    for f in found[1:]:
        any_of = any_of | f
    return shapes.filter(any_of)


def inventory_json(shapes: DataFrame, fields: list[str]) -> DataFrame:
    """(deck, slide, shapes): each slide's shapes as a JSON object by shape_id, without fields that are missing. A slide is one row."""
    entry = F.struct(F.col("shape_id").alias("key"), F.struct(*fields).alias("value"))
    return shapes.groupBy("deck", "slide").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))), {"ignoreNullFields": "true"}).alias("shapes"))


def overflow_map(shapes: DataFrame) -> DataFrame:
    """(deck, slide, overflow): inches by shape_id, of shapes whose text overflows."""
    rows = shapes.filter("frame_overflow is not null")
    return rows.groupBy("deck", "slide").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("shape_id", "frame_overflow")))).alias("overflow"))


def unknown_replacements(shapes: DataFrame, replacements: DataFrame) -> DataFrame:
    """replacements (deck, slide, shape_id) for slides or shapes that are not there, with a hint: the slide's shapes without a replacement."""
    keys = ["deck", "slide"]
    lost = replacements.join(shapes, [*keys, "shape_id"], "left_anti").select(*keys, "shape_id")
    start = F.when(F.length("text") > 0, F.format_string("%s ('%s')", "shape_id", F.concat(F.left("text", F.lit(50)), F.when(F.length("text") > 50, "...").otherwise("")))).otherwise(F.col("shape_id"))
    idle = shapes.join(lost.select(*keys).distinct(), keys, "left_semi").join(replacements.select(*keys, "shape_id"), [*keys, "shape_id"], "left_anti")
    hints = idle.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(start)), ", ").alias("hint"))
    there = shapes.select(*keys).distinct().withColumn("there", F.lit(True))
    out = lost.join(there, keys, "left").join(hints, keys, "left")
    return out.select(*keys, "shape_id", F.when(F.col("there").isNull(), "slide not found").otherwise(F.concat(F.lit("shape not found, without replacement: "), F.coalesce("hint", F.lit("none")))).alias("problem"))


def pages_of_grid(images: DataFrame, columns: int, within: list[str], order: list[str], stem: str = "grid", suffix: str = ".jpg") -> DataFrame:
    """images with page, place on the page and the page's file name: as many as fit in columns x (columns + 1); a single page has no number."""
    most = columns * (columns + 1)
    placed = numbered(images, within, order, "n").withColumns({"page": F.floor((F.col("n") - 1) / most).cast("int"), "place": ((F.col("n") - 1) % most).cast("int")})
    total = placed.groupBy(*within).agg(F.count(F.lit(1)).alias("images"))
    name = F.when(F.col("images") <= most, F.lit(f"{stem}{suffix}")).otherwise(F.format_string(f"{stem}-%d{suffix}", F.col("page") + 1))
    return placed.join(total, within).withColumn("file", name).drop("n", "images")


def zipped(left: DataFrame, right: DataFrame, order_left: list[str], order_right: list[str]) -> DataFrame:
    """Rows of two tables side by side by their place in order, as far as the shorter one goes, with `place` from 1."""
    return numbered(left, [], order_left, "place").join(numbered(right, [], order_right, "place"), "place")
