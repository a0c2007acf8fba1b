"""Nested JSON, Markdown and package sinks: one document a drawing, tile or run, written by Spark's own writers.

What a document gathers is bounded by its drawing or tile; many drawings are many rows.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators._shared import union
from ..operators.ocr import SUMMARY_GROUPS


def gathered(df: DataFrame, keys: list[str], name: str, order: str | None = "ord") -> DataFrame:
    """(keys, name): the other columns of each key's rows as an array in order."""
    rest = [c for c in df.columns if c not in keys]
    first = [order] if order in rest else []
    rows = F.array_sort(F.collect_list(F.struct(*first, *(c for c in rest if c not in first))))
    kept = [c for c in rest if c not in first]
    return df.groupBy(*keys).agg((F.transform(rows, lambda r: F.struct(*(r[c].alias(c) for c in kept))) if first else rows).alias(name))


def _joined(spine: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    out = spine
    for p in parts:
        out = out.join(p, keys, "left")
    return out


def merged_documents(t: dict[str, DataFrame], version: str = "1.1.1") -> DataFrame:
    """(drawing, document): the tables of a merge as one nested record a drawing, empty collections as empty arrays."""
    def part(name: str, df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
        return gathered(df.drop("listed", "kind", *drop), ["drawing"], name)

    kinds = {k: t["nodes"].filter(F.col("kind") == k) for k in ("equipment", "instruments", "valves")}
    lines = {f"{k}_lines": t["lines"].filter(F.col("kind") == k) for k in ("process", "signal")}
    flat = {n: t[n] for n in ("utilities", "control_loops", "symbols", "line_types", "abbreviations", "flow_sequences", "control_relationships", "interlocks", "unresolved", "orphans", "incomplete_loops", "skewed", "audit")}
    every = {**kinds, **lines, **flat}
    spine = union([df.select("drawing") for df in (t["nodes"], t["lines"], t["utilities"], t["metadata"])]).distinct()
    wide = _joined(spine, [part(n, df) for n, df in every.items()] + [t["metadata"], t["validation"].select("drawing", F.struct(*(c for c in t["validation"].columns if c != "drawing")).alias("checks"))], ["drawing"])
    wide = wide.withColumns({n: F.coalesce(n, F.array().cast(wide.schema[n].dataType)) for n in every})
    group = lambda *names: F.struct(*names)
    document = F.struct(
        F.lit(version).alias("schema_version"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("extraction_timestamp"), "source_image", "metadata",
        group("symbols", "line_types", "abbreviations").alias("legend"), group(*kinds).alias("nodes"), group(*lines).alias("edges"), group("flow_sequences", "control_relationships", "interlocks").alias("process_logic"),
        "control_loops", "utilities", group("checks", "unresolved", "orphans", "incomplete_loops", "skewed", "audit").alias("validation"),
    )
    return wide.select("drawing", document.alias("document"))


def write_json(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Rows as JSON lines, missing fields left out; by names a column that becomes a folder for each of its values."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "true")
    (writer.partitionBy(by) if by else writer).json(path)


def ocr_tiles(detections: DataFrame) -> DataFrame:
    """(tile, total_detections, extractions): each tile's detections in order."""
    nested = gathered(detections, ["tile"], "extractions")
    return nested.withColumn("total_detections", F.size("extractions"))


def ocr_drawings(detections: DataFrame) -> DataFrame:
    """(drawing, total_detections, summary, detections by group, all_extractions, tiles): the global OCR document of each drawing."""
    rest = [c for c in detections.columns if c not in ("drawing", "ord")]
    flat = F.array_sort(F.collect_list(F.struct("ord", *rest)))
    tiles = detections.groupBy("drawing", "tile").agg(F.count(F.lit(1)).alias("detections")).groupBy("drawing").agg(F.array_sort(F.collect_list(F.struct("tile", "detections"))).alias("tiles"))
    one = detections.groupBy("drawing").agg(F.transform(flat, lambda r: F.struct(*(r[c].alias(c) for c in rest))).alias("all_extractions")).join(tiles, "drawing")
    pick = lambda kind: F.filter("all_extractions", lambda r: r["type"] == kind)
    groups = F.struct(*(pick(kind).alias(name) for name, kind in SUMMARY_GROUPS.items()))
    return one.withColumns({"total_detections": F.size("all_extractions"), "detections": groups}).withColumn("summary", F.struct(*(F.size(f"detections.{n}").alias(n) for n in SUMMARY_GROUPS)))


def critic_report(errors: DataFrame, rounds: Column, gates: DataFrame) -> DataFrame:
    """One row: total, histogram by type, how many were repaired, the rounds, the gates."""
    by_type = errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("entity_id") != "unknown").alias("done"))
    one = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_errors"), F.coalesce(F.sum("done"), F.lit(0)).alias("repaired"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("error_type", "n")))).alias("by_type"))
    return one.withColumns({"remaining": F.col("total_errors") - F.col("repaired"), "iterations": rounds}).crossJoin(gates)  # one row each


def comparison_report(compared: DataFrame) -> DataFrame:
    """One row: the metrics of two runs with their gains, by name."""
    entry = F.struct("metric", F.struct("before", "after", "gain").alias("v"))
    return compared.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("comparison"))  # a few dozen metrics


def tile_table(tiles: DataFrame, source: Column, overlap: float) -> DataFrame:
    """(page, source_image, overlap, tiles): the tile table of each page, as the tile reader takes it."""
    box = lambda p: F.struct(*(F.col(f"{p}{c}").alias(c) for c in ("x1", "y1", "x2", "y2")))
    width = F.max("col").over(Window.partitionBy("page")) + 1
    row = tiles.withColumn("tile_id", (F.col("row") * width + F.col("col")).cast("int")).withColumn("filename", F.format_string("tile_%02d_%02d.png", "row", "col"))
    entry = F.struct("tile_id", "filename", "row", "col", box("p").alias("pixel_bbox"), box("n").alias("normalized_bbox"))
    return row.groupBy("page").agg(F.array_sort(F.collect_list(entry)).alias("tiles")).withColumns({"source_image": source, "overlap": F.lit(overlap)})


_REPORT_HEAD = "# Evaluation report\n\n- Accuracy: %d/%d (%.1f%%)\n- Average task duration: %.2fs\n- Average tool calls: %.2f\n- Total tool calls: %d\n"
_REPORT_TASK = "## Task %d\n\n**Question**: %s\n**Expected**: `%s`\n**Actual**: `%s`\n**Correct**: %s\n**Duration**: %.2fs\n**Tool calls**: %s\n\n%s\n\n%s\n"


def markdown_report(summary: DataFrame, tasks: DataFrame) -> DataFrame:
    """(line, text): a report of a run as Markdown lines, the summary first, then task by task (place, question, expected, actual, duration, tool_calls, summary, feedback)."""
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A"))
    whole = lambda c: F.col(c).cast("long")
    head = summary.select(F.lit(0).cast("long").alias("line"), F.format_string(_REPORT_HEAD, whole("correct"), whole("tasks"), "accuracy", "mean_duration", "mean_calls", whole("total_calls")).alias("text"))
    mark = F.when((F.length("actual") > 0) & (F.col("actual") == F.col("expected")), "yes").otherwise("no")
    parts = [whole("place"), "question", "expected", text("actual"), mark, F.col("duration").cast("double"), F.col("tool_calls").cast("string"), text("summary"), text("feedback")]
    body = tasks.select(whole("place").alias("line"), F.format_string(_REPORT_TASK, *parts).alias("text"))
    return head.unionByName(body)


def write_text(lines: DataFrame, path: str) -> None:
    """(line, text) as text files whose parts follow one another in order."""
    lines.orderBy("line").select("text").write.mode("overwrite").text(path)


def packages(parts: DataFrame) -> DataFrame:
    """(package, content): parts (package, name, xml) zipped, the content types first; a package is built in one task."""
    def zip_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, xml in sorted(zip(rows["name"], rows["xml"], strict=True), key=lambda r: (r[0] != "[Content_Types].xml", r[0])):
                if xml is not None:
                    z.writestr(zipfile.ZipInfo(name), xml)
        return pd.DataFrame({"package": [key[0]], "content": [out.getvalue()]})

    return parts.groupBy("package").applyInPandas(zip_up, "package string, content binary")


def parts_of(zipped: DataFrame) -> DataFrame:
    """(package, name, xml) of (package, content): what `packages` made, taken apart; a broken one has no parts."""
    def unzip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for package, content in zip(frame["package"], frame["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        names = z.namelist()
                        yield pd.DataFrame({"package": package, "name": names, "xml": [z.read(n).decode("utf-8", "replace") for n in names]})
                except zipfile.BadZipFile:
                    continue

    return zipped.mapInPandas(unzip, "package string, name string, xml string")


def prompt_documents(prompts: DataFrame) -> DataFrame:
    """(tile, prompt): one record a tile of what `prompt_inputs` gathered, for a file of its own each."""
    rest = [c for c in prompts.columns if c != "tile"]
    return prompts.select("tile", F.struct(*rest).alias("prompt"))


def candidate_documents(lines: DataFrame, shapes: DataFrame) -> DataFrame:
    """(image, lines, shapes, summary): the detection document of each image from its candidates (image, ord, type, ...)."""
    both = gathered(lines, ["image"], "lines").join(gathered(shapes, ["image"], "shapes"), ["image"], "full")
    empty = {n: F.coalesce(n, F.array().cast(both.schema[n].dataType)) for n in ("lines", "shapes")}
    kind = lambda n, name: F.size(F.filter(n, lambda r: r["type"] == name))
    return both.withColumns(empty).withColumn("summary", F.struct(kind("lines", "Process_Candidate").alias("total_solid_lines"), kind("lines", "Signal_Candidate").alias("total_dashed_lines"), F.size("shapes").alias("total_shapes")))


def manifest(entries: DataFrame) -> DataFrame:
    """One row of a run's outputs (name, value), by name."""
    return entries.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("outputs"))  # one entry a step
