"""OCR detections by tile and type: inputs of extraction prompts, global summaries, what a viewer shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The groups of a prompt and of a global summary, with the detection type of each.
PROMPT_GROUPS = {"equipment": "equipment_tag", "instruments": "instrument_tag", "valves": "valve_tag", "lines": "line_number"}
SUMMARY_GROUPS = {"equipment_tags": "equipment_tag", "instrument_tags": "instrument_tag", "valve_tags": "valve_tag", "line_numbers": "line_number", "measurements": "measurement", "labels": "label"}


def sure(detections: DataFrame, least: float = 0.7) -> DataFrame:
    """Detections of at least this confidence; a missing one counts 0."""
    return detections.filter(F.coalesce("confidence", F.lit(0.0)) >= least)


def _listed(kind: Column, key: str) -> Column:
    """The values of a column in order of ord, of the rows where `kind` holds."""
    return F.transform(F.array_sort(F.collect_list(F.when(kind, F.struct("ord", key)))), lambda s: s[key])


def prompt_inputs(tiles: DataFrame, detections: DataFrame, least: float = 0.7, shown: int = 30) -> DataFrame:
    """tiles (tile) with what a prompt needs of their sure detections (tile, ord, text, type, confidence): tags by group with counts, the first `shown`, how many there are.

    A tile without detections gets empty lists. Lists are as long as one tile's detections.
    """
    place = F.row_number().over(Window.partitionBy("tile").orderBy("ord"))
    rows = sure(detections, least).withColumns({"place": place, "type": F.coalesce("type", F.lit("label"))})
    lists = [_listed(F.col("type") == kind, "text").alias(name) for name, kind in PROMPT_GROUPS.items()]
    counts = [F.count_if(F.col("type") == kind).alias(f"n_{name}") for name, kind in PROMPT_GROUPS.items()]
    per_tile = rows.groupBy("tile").agg(F.count(F.lit(1)).alias("n_ocr"), *lists, *counts, _listed(F.col("place") <= shown, "text").alias("shown"))
    out = tiles.join(per_tile, "tile", "left")
    none = F.array().cast("array<string>")
    filled = {name: F.coalesce(name, none) for name in (*PROMPT_GROUPS, "shown")} | {f"n_{name}": F.coalesce(f"n_{name}", F.lit(0)) for name in (*PROMPT_GROUPS, "ocr")}
    return out.withColumns(filled).withColumn("mode", F.when(F.col("n_ocr") > 0, "grounded").otherwise("free"))


def summary(detections: DataFrame, within: list[str]) -> DataFrame:
    """Counts by group, drawing by drawing, with the total; tiles is the number of tiles that gave any."""
    counts = [F.count_if(F.col("type") == kind).alias(name) for name, kind in SUMMARY_GROUPS.items()]
    return detections.groupBy(*within).agg(F.count(F.lit(1)).alias("total_detections"), F.countDistinct("tile").alias("tiles"), *counts)


def visible(rows: DataFrame, shown: dict[str, bool], least: float = 0.0) -> DataFrame:
    """rows (kind, confidence, box) that a viewer draws, with a label: kinds that are switched on, sure enough (a missing confidence is), with a box.

    The label of text is cut to 20 characters; lines are drawn whatever their confidence.
    """
    on = F.col("kind").isin([k for k, v in shown.items() if v])
    enough = (F.col("kind") == "lines") | (F.coalesce("confidence", F.lit(1.0)) >= least)
    q = lambda c: F.coalesce(F.col(c), F.lit("?"))
    label = F.when(F.col("kind") == "ocr", F.left(q("tag"), F.lit(20))).when(F.col("kind") == "instruments", F.format_string("%s [%s]", q("tag"), q("class"))).when(F.col("kind") != "lines", F.format_string("%s (%s)", q("tag"), q("class")))
    return rows.filter(on & enough & F.col("box").isNotNull()).withColumn("label", label)
