"""From raw documents to token ids: language, near-duplicates, repeated passages, benchmark leaks, encoding.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and gives a DataFrame that is
written as Parquet and read again; all but the last give the columns of documents. Empty tables
give empty results, null texts are rejected by the first stage, extra columns of docs pass through whatever
their names (only the last stage puts its results in their place). Rows of null or repeated doc_id are documents
like any others.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import lang_id
from tessella.llm._spark import read, shared_folder, with_nodes, without
from tessella.llm.bpe_trie import encode_documents
from tessella.llm.decontaminate import find_benchmark
from tessella.llm.minhash_forest import extra_copies
from tessella.llm.suffix_dedup import remove_repeats


#: A repeated passage of over fifty words goes: 51 words of four letters and a space are 255 bytes.
PASSAGE_BYTES = 256


def _sheltered(docs: DataFrame, *own: str) -> DataFrame:
    """docs with other names for all columns but `own`, so that no result of an operator can clash with them."""
    return docs.select(*(F.col(f"`{c}`").alias(c if c in own else f"_passing_{k}") for k, c in enumerate(docs.columns)))


def _restored(out: DataFrame, docs: DataFrame, *own: str) -> DataFrame:
    """The columns of docs from what an operator made of its sheltered rows."""
    return out.select(*(F.col(c if c in own else f"_passing_{k}").alias(c) for k, c in enumerate(docs.columns)))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the language model rejects: no letters, or far from every centroid."""
    model = lang_id.fit(docs)
    found = lang_id.identify(_sheltered(docs, "text"), model, keep_text=True)
    return _restored(found.filter(~F.col("rejected")), docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of least doc_id; of rows equal in doc_id and text one."""
    safe = _sheltered(docs, "doc_id", "text")
    rows, odd = with_nodes(safe)
    kept = without(rows, extra_copies(rows, percent=85))
    if odd:
        own = F.col("doc_id").isNotNull() & (F.col("doc_id").cast("long") == F.col("node"))
        kept = kept.filter(own).unionAll(kept.filter(~own).dropDuplicates(["node"]))
    return _restored(kept, docs, "doc_id", "text")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of PASSAGE_BYTES that also start elsewhere; n_chars follows."""
    cut = remove_repeats(_sheltered(docs, "doc_id", "text"), length=PASSAGE_BYTES, outputs="text")
    out = _restored(cut.withColumn("text", F.struct("text", "n_removed")), docs, "doc_id", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text.n_removed") > 0, F.length("text.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("text.text"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold ten consecutive words of a benchmark item."""
    safe = _sheltered(docs, "doc_id", "text")
    found = find_benchmark(safe, read(spark, sf_dir, "benchmark"), width=10, keep_text=True)
    return _restored(found.filter(~F.col("contaminated")), docs, "doc_id", "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, with the columns of documents beside its text."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), outputs="ids")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_leaks),
    ("bpe_encode", encode),
]

#: Models and suffix order cannot be put in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; a stage's table goes when its successor's is whole."""
    docs = read(spark, sf_dir, "documents")
    at, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        here = f"{at}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = here
    return docs
