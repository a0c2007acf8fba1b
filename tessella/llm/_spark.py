"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Arrow batches for Python workers; the default of 64 MB stands several times in an executor with its workers.
ARROW_BYTES = 4 << 20
#: Ids that a broadcast may hold (8 bytes each, about 24 in its table).
FEW = 500_000


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size if it is larger than these operators are laid out for."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name, "64m")).lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    if not 0 < int(now.rstrip("kmg")) * scale <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of df in the shared checkpoint folder; lost executors do not lose them."""
    shared_folder(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.checkpoint()


def release() -> None:
    """Hand freed memory of this Python worker back to the system: workers outlive their stage, an executor's limit counts them all."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """df.mapInArrow(kernel) over bounded batches; the worker gives freed memory back at the end of each task."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(batches)
        release()

    return df.mapInArrow(run, schema(ddl))


def with_nodes(docs: DataFrame, text_col: str = "text", name: str = "node", id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """docs with a number that tells its rows apart: doc_id, or a hash of doc_id and text where the doc_id is null or repeated.

    Rows equal in doc_id and text share their number. The second result says whether any doc_id is null or repeated;
    only then do such rows exist. The repeated ids are broadcast if counted to be few.
    """
    plain = F.col(id_col).cast("long")
    ids = docs.groupBy(plain.alias(name)).agg(F.count(F.lit(1)).alias("c"))
    odd = cut_lineage(ids.filter((F.col("c") > 1) | F.col(name).isNull()).select(name))
    n = odd.limit(FEW + 1).count()
    if not n:
        return docs.withColumn(name, plain), False
    hashed = F.xxhash64(id_col, text_col)
    single = docs.join(F.broadcast(odd) if n <= FEW else odd, plain == F.col(name), "left")
    return single.withColumn(name, F.when(F.col(name).isNull() & plain.isNotNull(), plain).otherwise(hashed)), True


def map_texts(df: DataFrame, text_col: str, kernel: Callable, ddl: str, keep_text: bool = False) -> DataFrame:
    """Run a kernel over Arrow batches: it yields (batch, new columns), the other columns pass through.

    A passing column whose name clashes with a new one is left out.
    """
    bound_batches(df.sparkSession)
    new = T.StructType.fromDDL(ddl)
    names = {f.name.lower() for f in new}
    passing = [f for f in df.schema if f.name.lower() not in names and (keep_text or f.name != text_col)]
    need = [f.name for f in passing] + ([] if keep_text else [text_col])
    own = [f.name for f in passing]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, columns in kernel(batches):
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in own] + columns, names=own + [f.name for f in new])
            del batch, columns
        release()

    return df.select(*(F.col(f"`{x}`") for x in need)).mapInArrow(run, T.StructType([*passing, *new]))


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def crc_mod(column: str, n: int):
    """crc32 of an id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def class_sample(df: DataFrame, id_col: str, class_col: str, limit: int, salt: int = 0, text_col: str | None = None) -> DataFrame:
    """About `limit` rows of each class, by a hash of the id (and the text, where ids may be null): the bound does not grow with the table.

    The same rows at every run. A class of fewer rows is taken whole.
    """
    counts = {r[0]: r[1] for r in df.groupBy(class_col).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(class_col).eqNullSafe(F.lit(value)), F.lit(min(1.0, limit / n))).otherwise(share)
    return df.filter(F.pmod(F.xxhash64(*(F.col(c) for c in (id_col, text_col) if c), F.lit(salt)), F.lit(1 << 20)) < share * (1 << 20))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or in local mode (tests) one of our own where that is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and re.match(r"local(\[|$)", sc.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def without(df: DataFrame, ids: DataFrame, most: int = FEW) -> DataFrame:
    """df without the rows of the given nodes (node), which are broadcast if counted to be few."""
    ids = cut_lineage(ids.select("node"))
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, "node", "left_anti").select(*df.columns)
