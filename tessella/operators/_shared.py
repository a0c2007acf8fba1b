"""Helpers of the operators: lineage cuts in the shared folder, union of many frames."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of df in the folder of spark.checkpoint.dir (in local mode one of our own where that is unset)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and re.match(r"local(\[|$)", sc.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def large(df: DataFrame) -> DataFrame:
    """df as a side of a join that sorts: never broadcast.

    Sizes are told from the stored columns, packed; what is derived from them (cells, places, paths) is many times larger, and a
    broadcast of it would pass through the driver.
    """
    return df.hint("merge")


def dealt(rows: DataFrame) -> DataFrame:
    """rows dealt evenly over the cores: for keys of a few bytes, a single file of which is a lot of work."""
    return rows.repartition(4 * max(2, rows.sparkSession.sparkContext.defaultParallelism))


def map_rows(df: DataFrame, rows: Callable[..., Iterable[tuple]], ddl: str, most: int = 5000) -> DataFrame:
    """The tuples that a Python kernel yields for each row's values; they leave in batches of `most`, whatever row they come from."""
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def packed(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for row in rows(*values):
                    found.append(row)
                    if len(found) >= most:
                        yield packed(found)
                        found = []
        if found:
            yield packed(found)

    return df.mapInArrow(run, schema)


def numbered(rows: DataFrame, within: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """rows with their place (from 1) in their group by `order`; a group may be of any size.

    Rows are dealt by ranges of (group, order); a range numbers its own rows and adds those of the ranges before it.
    """
    part, ahead = f"{name}_part", f"{name}_ahead"
    dealt = cut_lineage(rows.repartitionByRange(*(F.col(c) for c in within), *(F.col(c) if isinstance(c, str) else c for c in order)).withColumn(part, F.spark_partition_id()))
    counts = dealt.groupBy(*within, part).agg(F.count(F.lit(1)).alias("c"))
    before = counts.withColumn(ahead, F.sum("c").over(Window.partitionBy(*within).orderBy(part)) - F.col("c")).drop("c")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*within, part)]
    both = dealt.alias("r").join(F.broadcast(before).alias("b"), reduce(lambda x, y: x & y, same)).select("r.*", f"b.{ahead}")  # one row a group and range
    own = F.row_number().over(Window.partitionBy(*within, part).orderBy(*order))
    return both.withColumn(name, own + F.col(ahead)).drop(part, ahead)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def present(ref: Column) -> Column:
    """A reference, null where it is empty."""
    return F.nullif(ref, F.lit(""))
