"""Review of a merged drawing: classify errors, mark what can be repaired, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import near_boundary
from ..operators import integrity
from ..operators._shared import cut_lineage, present, union


def classify_errors(nodes: DataFrame, lines: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(error_type, kind, entity_id, field) for nodes (id, kind, tag, ord) and lines (id, kind, source, target, inline, path).

    A line without id goes by `unknown`. Without words tags are not judged.
    """
    error = lambda df, kind: df.select(F.lit(kind).alias("error_type"), "kind", "entity_id", "field")
    twice = integrity.duplicate_ids(nodes).select("kind", F.col("id").alias("entity_id"), F.lit("id").alias("field"))
    named = lines.withColumn("entity_id", F.coalesce("id", F.lit("unknown")))
    inline = F.transform(F.coalesce("inline", F.array().cast("array<string>")), lambda c: F.struct(F.lit("inline_components").alias("field"), c.alias("ref")))
    ends = F.array(F.struct(F.lit("source").alias("field"), F.col("source").alias("ref")), F.struct(F.lit("target").alias("field"), F.col("target").alias("ref")))
    refs = named.select("kind", "entity_id", F.explode(F.concat(ends, inline)).alias("r")).select("kind", "entity_id", "r.*").filter(present(F.col("ref")).isNotNull())
    ids = nodes.select(F.col("id").alias("ref")).filter("ref is not null").distinct()
    dangling = refs.join(ids, "ref", "left_anti")
    seams = named.filter(present(F.col("source")).isNull() & (F.size("path") > 0) & near_boundary(F.element_at("path", 1))).withColumn("field", F.lit("waypoint_start"))
    alone = nodes.filter("id is not null").join(refs.select(F.col("ref").alias("id")).distinct(), "id", "left_anti").select("kind", F.col("id").alias("entity_id"), F.lit(None).cast("string").alias("field"))
    parts = [error(twice, "DUPLICATE_ID"), error(dangling, "DANGLING_REF"), error(seams, "SEAM_BREAK"), error(alone, "ORPHAN_NODE")]
    if words is not None:
        loose = integrity.ungrounded(nodes, words).select("kind", F.coalesce("id", F.lit("unknown")).alias("entity_id"), F.lit("tag").alias("field"))
        parts.append(error(loose, "UNGROUNDED_TAG"))
    return union(parts)


def review(nodes: DataFrame, lines: DataFrame, words: DataFrame | None = None, rounds: int = 3) -> dict[str, DataFrame]:
    """Marked nodes and lines, all errors with the round they were found in, and counts by type.

    Repair marks entities and renames later duplicates; an error of an entity without id cannot be marked. The loop ends
    when a round leaves nothing unrepaired, at the latest after `rounds`; errors that stay are reported in every round.
    """
    found = []
    for n in range(1, rounds + 1):
        errors = cut_lineage(classify_errors(nodes, lines, words).withColumn("round", F.lit(n)))
        found.append(errors)
        if "new_id" not in nodes.columns and not errors.filter("error_type = 'DUPLICATE_ID'").isEmpty():
            nodes = cut_lineage(integrity.rename_duplicates(nodes).withColumn("id", F.col("new_id")).drop("new_id"))
        if errors.filter("entity_id = 'unknown'").isEmpty():
            break
    every = union(found)
    marks = every.select("entity_id", "error_type")
    report = every.groupBy("error_type").agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("entity_id") != "unknown").alias("repaired"))
    return {"nodes": integrity.repair(nodes, marks), "lines": integrity.repair(lines, marks), "errors": every, "report": report}


def add_provenance(rows: DataFrame, model: str, method: str) -> DataFrame:
    """rows with `provenance` filled in where it is missing."""
    literal = F.struct(F.lit(model).alias("model"), F.lit(method).alias("method"))
    return rows.withColumn("provenance", F.coalesce("provenance", literal) if "provenance" in rows.columns else literal)
