"""References, grounding, errors and their repair, quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ._shared import numbered, present, union


def confident(rows: DataFrame, least: float, missing: float = 1.0) -> DataFrame:
    """rows of at least this confidence; `missing` stands for one that is not given."""
    return rows.filter(F.coalesce("confidence", F.lit(missing)) >= least)


def unresolved_references(refs: DataFrame, ids: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """refs (phase, source_id, field, ref[, ref_type]) whose ref is neither empty, off-page nor among ids (id): one anti-join for all fields."""
    live = refs.filter(present(F.col("ref")).isNotNull())
    if "ref_type" in refs.columns:
        live = live.filter(~F.col("ref_type").eqNullSafe(F.lit("OffPage"))).drop("ref_type")
    known = ids.select(*within, F.col("id").alias("ref")).filter("ref is not null").distinct()
    return live.join(known, [*within, "ref"], "left_anti").select(*within, "phase", "source_id", "field", F.col("ref").alias("missing_reference"))


def orphans(nodes: DataFrame, refs: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """nodes (id, tag, links) without links of their own and named by no ref (ref), by id or by tag."""
    named = refs.select(*within, present(F.col("ref")).alias("ref")).filter("ref is not null").distinct()
    bare = nodes.filter(F.coalesce(F.col("links"), F.lit(0)) == 0)
    by_id = bare.join(named.withColumnRenamed("ref", "id"), [*within, "id"], "left_anti")
    return by_id.join(named.withColumnRenamed("ref", "tag"), [*within, "tag"], "left_anti").select(*within, "id", "tag")


def incomplete_loops(loops: DataFrame) -> DataFrame:
    """(loop_id, missing) for loops (loop_id, sensor, final_element) with an empty end; repeated loops repeat."""
    gaps = F.array_compact(F.array(F.when(present(F.col("sensor")).isNull(), F.lit("sensor")), F.when(present(F.col("final_element")).isNull(), F.lit("final_element"))))
    return loops.select("loop_id", F.explode(gaps).alias("missing"))


def _substrings(text: Column, least: int) -> Column:
    n = F.length(text)
    parts = F.transform(F.sequence(F.lit(1), n - least + 1), lambda i: F.transform(F.sequence(F.lit(least), n - i + 1), lambda k: text.substr(i, k)))
    return F.when(n >= least, F.array_distinct(F.flatten(parts)))


def containing(keys: DataFrame, words: DataFrame, least: int = 1) -> DataFrame:
    """(key, word) of keys (key) that hold a word (word) of at least `least` characters or stand in one.

    Substrings are equi-joined, so only true pairs come up. Of a word only substrings of the keys' lengths are made.
    """
    inside = keys.select("key", F.explode(_substrings(F.col("key"), least)).alias("word")).join(words.select("word").distinct(), "word")
    lengths = [r.n for r in keys.select(F.length("key").alias("n")).distinct().orderBy("n").collect()]  # one row a length
    cuts = F.flatten(F.transform(F.array(*map(F.lit, lengths or [1])), lambda k: F.when(F.length("word") >= k, F.transform(F.sequence(F.lit(1), F.length("word") - k + 1), lambda i: F.col("word").substr(i, k))).otherwise(F.array().cast("array<string>"))))
    outside = words.select("word").distinct().filter(F.length("word") >= least).select("word", F.explode(F.array_distinct(cuts)).alias("key")).join(keys.select("key").distinct(), "key")
    return inside.select("key", "word").unionByName(outside.select("key", "word")).distinct()


def alike(keys: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """(key, word) with the same characters at a share of places of at least the threshold.

    Of m places, the longer one's length, at most k may differ, so of k + 1 stretches of places one is the same in both:
    an equi-join on stretches, for each m that a text's length allows.
    """
    def stretches(rows: DataFrame, name: str) -> DataFrame:
        n, text = F.length(name), F.col(name)
        # A text of n characters meets longer ones of up to n / threshold.
        most = F.floor(n / F.lit(threshold) + 1e-9).cast("int")
        sized = rows.select(name, F.explode(F.sequence(n, most)).alias("m")).withColumn("k", F.floor(F.col("m") * (1 - threshold) + 1e-9).cast("int") + 1)
        cut = sized.select(name, "m", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("j"))
        low, high = F.floor(F.col("j") * F.col("m") / F.col("k")).cast("int"), F.floor((F.col("j") + 1) * F.col("m") / F.col("k")).cast("int")
        return cut.filter(high <= n).select(name, "m", "j", text.substr(low + 1, high - low).alias("part"))

    some = lambda rows, name: rows.select(name).distinct().filter(F.length(name) > 0)
    pairs = stretches(some(keys, "key"), "key").join(stretches(some(words, "word"), "word"), ["m", "j", "part"])
    pairs = pairs.filter(F.greatest(F.length("key"), F.length("word")) == F.col("m")).select("key", "word").distinct()
    return pairs.filter(X.same_place_share(F.col("key"), F.col("word")) >= threshold)


def ground_tags(entities: DataFrame, words: DataFrame, threshold: float = 0.8, within: tuple[str, ...] = ()) -> DataFrame:
    """entities (id, tag) matched with OCR words (ord, text): match is exact, fuzzy or none, matched the word.

    Exact: equal upper-case text; else the first word in order that holds the tag, lies in it, or has the same characters
    at a share of places of at least the threshold. `within` names columns (a drawing) that must agree.
    """
    clean = words.select(*within, "ord", F.upper(X.strip(F.col("text"))).alias("word")).filter(F.length("word") >= 2)
    first = clean.groupBy(*within, "word").agg(F.min("ord").alias("ord"))
    tags = entities.filter(present(F.col("tag")).isNotNull()).withColumn("key", F.upper(X.strip(F.col("tag"))))
    exact = tags.join(first.select(*within, F.col("word").alias("key"), F.col("word").alias("hit")), [*within, "key"], "left")
    open_keys = exact.filter("hit is null").select(*within, "key").distinct()
    pairs = containing(open_keys.filter(F.length("key") > 0), first, 2).unionByName(alike(open_keys, first, threshold)).distinct()
    empty = open_keys.filter(F.length("key") == 0).join(first, list(within), "inner") if within else open_keys.filter(F.length("key") == 0).crossJoin(first.orderBy("ord").limit(1))  # the empty text lies in every word
    near = open_keys.join(pairs, "key").join(first, [*within, "word"]).select(*within, "key", "word", "ord").unionByName(empty.select(*within, "key", "word", "ord"))
    fuzzy = near.groupBy(*within, "key").agg(F.min_by("word", "ord").alias("near"))
    out = exact.join(fuzzy, [*within, "key"], "left")
    return out.select(*within, "id", "tag", F.when(F.col("hit").isNotNull(), "exact").when(F.col("near").isNotNull(), "fuzzy").otherwise("none").alias("match"), F.coalesce("hit", "near").alias("matched"))


def unmatched_words(words: DataFrame, grounded: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """(word, ord) of words of at least two characters that no entity was matched with, at their first place."""
    clean = words.select(*within, F.upper(X.strip(F.col("text"))).alias("word"), "ord").filter(F.length("word") >= 2)
    first = clean.groupBy(*within, "word").agg(F.min("ord").alias("ord"))
    return first.join(grounded.select(*within, F.col("matched").alias("word")).filter("word is not null").distinct(), [*within, "word"], "left_anti")


def ocr_stats(grounded: DataFrame, unmatched: DataFrame) -> DataFrame:
    """One row: tagged entities by how they were grounded, words without entity, the share grounded (0 without entities)."""
    g = grounded.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("match") != "none").alias("validated"), F.count_if(F.col("match") == "exact").alias("exact"), F.count_if(F.col("match") == "fuzzy").alias("fuzzy"), F.count_if(F.col("match") == "none").alias("unvalidated"))
    one = g.crossJoin(unmatched.agg(F.count(F.lit(1)).alias("ocr_only")))  # one row each
    return one.withColumn("validation_rate", F.round(F.col("validated") / F.greatest(F.lit(1), F.col("total")), 3))


def ungrounded(entities: DataFrame, words: DataFrame) -> DataFrame:
    """entities whose tag equals no word, holds none and lies in none."""
    distinct = words.select(F.upper("text").alias("word")).filter("word <> ''").distinct()
    tags = entities.filter(present(F.col("tag")).isNotNull()).withColumn("key", F.upper("tag"))
    found = containing(tags.select("key").distinct(), distinct).select("key").distinct()
    return tags.join(found, "key", "left_anti").drop("key")


def duplicate_ids(nodes: DataFrame) -> DataFrame:
    """(id, occurrences, kind of the first) of ids that stand more than once in nodes (id, kind, ord)."""
    return nodes.filter(present(F.col("id")).isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("occurrences"), F.min_by("kind", "ord").alias("kind")).filter("occurrences > 1")


def rename_duplicates(nodes: DataFrame) -> DataFrame:
    """nodes (id, ord) with new_id: in order, an id that was there before gets the first free suffix of _1, _2, ...

    Ids that cannot meet one another's suffixed forms are numbered in parallel. Ids of one stem with suffixes already among
    them (A, A_1, A) are walked in order, stem by stem, by a kernel that holds the ids of one stem at a time.
    """
    stem = F.regexp_replace("id", r"(_\d+)+$", "")
    rows = nodes.withColumn("stem", stem)
    mixed = rows.groupBy("stem").agg(F.min("id").alias("x"), F.max("id").alias("y")).filter("x <> y").select("stem")
    repeated = rows.join(mixed, "stem", "left_semi").groupBy("stem", "id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("stem").distinct()
    walked = rows.join(repeated, "stem", "left_semi")
    plain = numbered(rows.join(repeated, "stem", "left_anti").filter("id is not null"), ["id"], ["ord"], "n")
    plain = plain.withColumn("new_id", F.when(F.col("n") > 1, F.concat_ws("_", "id", (F.col("n") - 1).cast("string"))).otherwise(F.col("id"))).drop("n", "stem")
    bare = rows.filter("id is null").withColumn("new_id", F.col("id")).drop("stem")
    schema = T.StructType([*walked.schema.fields, T.StructField("new_id", T.StringType())])

    def walk(frames):
        stem, seen, last = None, set(), {}
        for frame in frames:
            out = []
            for own, i in zip(frame["stem"], frame["id"], strict=True):
                if own != stem:
                    stem, seen, last = own, set(), {}
                new = i
                while new in seen:
                    last[i] = last.get(i, 0) + 1
                    new = f"{i}_{last[i]}"
                seen.add(new)
                out.append(new)
            yield frame.assign(new_id=out)

    walked = walked.repartition("stem").sortWithinPartitions("stem", "ord").mapInPandas(walk, schema).drop("stem")
    return union([plain, bare, walked])


def fill_ids(rows: DataFrame, prefix: str, within: list[str], order: list[str] | None = None) -> DataFrame:
    """rows with ids generated in order (PREFIX-001, ...) where they are missing."""
    missing = present(F.col("id").cast("string")).isNull()
    there = rows.filter(~missing).withColumn("new_id", F.col("id"))
    made = numbered(rows.filter(missing), within, order or ["ord"], "made").withColumn("new_id", X.generated_id(prefix, F.col("made"))).drop("made")
    return there.unionByName(made)


def repair(entities: DataFrame, errors: DataFrame) -> DataFrame:
    """entities (id, ...) with error_types (sorted), seam_break and repaired: errors are marked, not removed; provenance is filled in."""
    marks = errors.groupBy("entity_id").agg(F.array_sort(F.collect_set("error_type")).alias("error_types")).withColumnRenamed("entity_id", "id")
    out = entities.join(marks, "id", "left").withColumn("error_types", F.coalesce("error_types", F.array().cast("array<string>")))
    return out.withColumns({"seam_break": F.array_contains("error_types", "SEAM_BREAK"), "repaired": F.size("error_types") > 0})


def clear_references(lines: DataFrame, errors: DataFrame) -> DataFrame:
    """lines (id, source, target) with the ends nulled that errors (entity_id, error_type, field) call dangling: the thorough repair."""
    ends = errors.filter("error_type = 'DANGLING_REF'").groupBy(F.col("entity_id").alias("id")).agg(*(F.bool_or(F.col("field") == f"{side}.node_id").alias(f"no_{side}") for side in ("source", "target")))
    out = lines.join(ends, "id", "left")
    return out.withColumns({side: F.when(~F.coalesce(f"no_{side}", F.lit(False)), F.col(side)) for side in ("source", "target")}).drop("no_source", "no_target")


def gates(errors: DataFrame, kinds: list[str]) -> DataFrame:
    """One row: for each kind whether no error of it stands, and whether all gates pass."""
    counts = [F.count_if(F.col("error_type") == k).alias(k) for k in kinds]
    one = errors.agg(*counts)
    return one.select(*((F.col(k) == 0).alias(f"no_{k.lower()}") for k in kinds), F.lit(True).alias("all_pass") if not kinds else _all([F.col(k) == 0 for k in kinds]).alias("all_pass"))


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def rate(part: Column, total: Column, empty: float = 0.0) -> Column:
    return F.round(F.coalesce(F.try_divide(part, total), F.lit(empty)), 3)


def quality_metrics(nodes: DataFrame, edges: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """One row of counts and rates of nodes (id, kind, tag, ocr_validated, tag_verified) and edges (kind, source, target, named, propagated, path, seam_break).

    validation is one row of unresolved_references, orphan_nodes, incomplete_loops and orthogonality_warnings, to which is_valid
    is added; without it they count 0 and is_valid is false, as for a drawing that was never checked.
    """
    from ..functions.geometry import near_boundary

    ids = nodes.select("id").filter("id is not null").distinct().withColumn("known", F.lit(True))
    n = nodes.agg(
        *(F.count_if(F.col("kind") == k).alias(f"total_{k}") for k in ("equipment", "instruments", "valves")),
        F.count(F.lit(1)).alias("total_entities"), F.count_if("ocr_validated").alias("ocr_validated"),
        F.count_if(present(F.col("tag")).isNotNull() & (F.col("ocr_validated") | F.coalesce("tag_verified", F.lit(True)))).alias("grounded_tags"),
        F.count_if(present(F.col("tag")).isNotNull()).alias("tagged"),
    )
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).filter(present(F.col("id")).isNotNull()).join(ids, "id", "left").agg(F.count_if(F.col("known").isNotNull()).alias("connected_endpoints"), F.count_if(F.col("known").isNull()).alias("dangling_endpoints"))
    tips = F.when(F.size("path") >= 2, F.array(F.element_at("path", 1), F.element_at("path", -1))).otherwise(F.col("path"))
    e = edges.agg(
        F.count_if(F.col("kind") == "process").alias("total_process_lines"), F.count_if(F.col("kind") == "signal").alias("total_signal_lines"), F.count(F.lit(1)).alias("total_lines"),
        F.count_if("named").alias("labeled_lines"), F.count_if("propagated").alias("propagated_labels"),
        F.coalesce(F.sum(F.size(F.filter(tips, lambda p: near_boundary(p)))), F.lit(0)).cast("long").alias("boundary_endpoints"), F.count_if("seam_break").alias("seam_breaks"),
    )
    one = n.crossJoin(ends).crossJoin(e)  # one row each
    total = F.greatest(F.col("connected_endpoints") + F.col("dangling_endpoints"), F.lit(1))
    return one.withColumns({
        "ocr_unvalidated": F.col("total_entities") - F.col("ocr_validated"), "ocr_validation_rate": rate(F.col("ocr_validated"), F.col("total_entities")), "label_coverage": rate(F.col("labeled_lines"), F.col("total_lines")),
        "edge_connection_rate": rate(F.col("connected_endpoints"), total), "dangling_ref_rate": rate(F.col("dangling_endpoints"), total), "seam_break_rate": rate(F.col("seam_breaks"), F.col("total_lines")),
        "ungrounded_tags": F.col("tagged") - F.col("grounded_tags"), "tag_grounding_rate": rate(F.col("grounded_tags"), F.col("tagged"), 1.0),
    }).drop("tagged").crossJoin(validity(validation) if validation is not None else _unchecked(nodes.sparkSession))


CHECKS = ("unresolved_references", "orphan_nodes", "incomplete_loops", "orthogonality_warnings")


def validity(counts: DataFrame) -> DataFrame:
    """One row of check counts with is_valid: skewed segments alone make nothing invalid."""
    return counts.select(*CHECKS, _all([F.col(c) == 0 for c in CHECKS[:3]]).alias("is_valid"))


def _unchecked(spark) -> DataFrame:
    return spark.range(1).select(*(F.lit(0).cast("long").alias(c) for c in CHECKS), F.lit(False).alias("is_valid"))


def compare_runs(runs: list[DataFrame], most: int = 3) -> DataFrame:
    """(step, metric, before, after, gain) of each of the first `most` runs' metrics (metric, value) against the run before it; is_valid is no number.

    A count of unvalidated entities is better when lower in the first step only.
    """
    steps = []
    for k, (a, b) in enumerate(zip(runs[: most - 1], runs[1:most], strict=False)):
        step = compare_metrics(a, b).filter("metric <> 'is_valid'").withColumn("step", F.lit(k + 1))
        if k:
            step = step.withColumn("gain", F.when(F.col("metric").contains("unvalidated") & ~F.col("metric").contains("rate"), F.col("after") - F.col("before")).otherwise(F.col("gain")))
        steps.append(step)
    return union(steps).select("step", "metric", "before", "after", "gain")


def compare_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """(metric, before, after, gain) of two metric tables (metric, value)."""
    both = before.withColumnRenamed("value", "before").join(after.withColumnRenamed("value", "after"), "metric")
    return both.withColumn("gain", X.metric_gain(F.col("metric"), F.col("before"), F.col("after")))
