"""Collected errors: severities, messages, short lists of many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import numbered

#: Severities, mild to grave.
SEVERITIES = ("warning", "error", "critical")


def of_severity(errors: DataFrame, *wanted: str) -> DataFrame:
    """errors (severity) of some severities; `error` without more stands for errors and critical ones."""
    names = ("error", "critical") if wanted == ("error",) else wanted
    return errors.filter(F.col("severity").isin(*names))


def severity_summary(errors: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Counts by severity, and whether any is there and any is critical."""
    count = lambda *names: F.count_if(F.col("severity").isin(*names))
    one = errors.groupBy(*within).agg(F.count(F.lit(1)).alias("total"), count("warning").alias("warnings"), count("error").alias("errors"), count("critical").alias("critical"))
    return one.withColumns({"has_errors": F.col("total") > 0, "has_critical": F.col("critical") > 0})


def record(*fields: str) -> Column:
    """An error as JSON text without its missing and empty fields."""
    return F.to_json(F.struct(*(F.when(F.col(c).cast("string") != "", F.col(c)).alias(c) for c in fields)), {"ignoreNullFields": "true"})


def message(kind: Column, entity: Column, field: Column, ref: Column) -> Column:
    """A reference error in words."""
    return F.format_string("%s %s: %s references unknown '%s'", F.initcap(kind), entity, field, ref)


def short_list(rows: DataFrame, within: Sequence[str], order: Sequence[str], text: str, most: int, width: int | None = None) -> DataFrame:
    """The first `most` texts of each group (cut to `width`), with the number of all and a line that says how many more there are.

    Only `most` rows of a group are ever gathered.
    """
    placed = numbered(rows, within, order, "place")
    shown = F.left(text, F.lit(width)) if width else F.col(text)
    lead = F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= most, F.struct("place", shown.alias("t"))))), lambda s: s["t"])
    out = placed.groupBy(*within).agg(F.count(F.lit(1)).alias("total"), lead.alias("first"))
    return out.withColumn("rest", F.when(F.col("total") > most, F.format_string("... and %d more", F.col("total") - most)))


def histogram(errors: DataFrame, marked: Column) -> DataFrame:
    """(error_type, n, n_marked): errors by type, and how many of them bear a mark."""
    return errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(marked).alias("n_marked"))


def new_only(current: DataFrame, original: DataFrame) -> DataFrame:
    """The distinct errors of a changed document that its original did not have."""
    return current.subtract(original)
