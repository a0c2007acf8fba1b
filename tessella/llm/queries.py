"""Query catalogue of the training-data operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lang_id, license_scan, lm_lattice, toxicity_crf
from ._spark import crc_mod, read
from .bpe_trie import encode_documents
from .decontaminate import find_benchmark
from .embed_pca import link_vectors
from .minhash_forest import link_documents
from .suffix_dedup import remove_repeats
from .token_counts import count_tokens


def op1_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_lattice.score_documents(docs, crc_mod("doc_id", 10) == 0, public_tokenizers.path("piece_bpe_32k.model"))


def op2_embedding_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), threshold=0.95)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 5) == 0
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    out = toxicity_crf.score_documents(docs, toxicity_crf.fit(docs, labels))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"), "spans")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 4) == 2
    model = lang_id.fit(docs.filter(~held_out))
    return lang_id.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs, license_scan.fit(docs))


def op7_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), outputs="digests")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), length=400)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find_benchmark(docs, read(spark, sf_dir, "benchmark"), width=10).drop("items")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice_lm": op1_lattice_lm,
    "op2_embedding_pca": op2_embedding_pca,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_licences": op6_licences,
    "op7_bpe_trie": op7_bpe_trie,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_minhash": op10_minhash,
}

#: A-Z lowered and nothing else; words of letters, digits and non-ASCII characters.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op9_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
     p AS (SELECT item_id, len(list_slice(w, k, k + 9)) AS n, array_to_string(list_slice(w, k, k + 9), ' ') AS s
           FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT n FROM p),
     x AS (SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS s
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
     hits AS (SELECT x.doc_id, x.k, x.n, p.item_id FROM x JOIN p ON x.s = p.s AND x.n = p.n),
     marked AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY 1),
     named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(named.s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op8_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
     w AS (SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d WHERE octet_length(b) >= 400)),
     r AS (SELECT doc_id, i FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
     n AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM r),
     g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM n),
     s AS (SELECT doc_id, k, min(i) AS lo, max(i) + 399 AS hi FROM g GROUP BY 1, 2),
     p AS (SELECT doc_id, k, hi - lo + 1 AS gone, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY k) AS a, lo AS z FROM s UNION ALL SELECT doc_id, max(k) + 1, 0, max(hi), 1000000000 FROM s GROUP BY 1),
     c AS (SELECT p.doc_id, sum(gone) AS gone, count(*) - 1 AS spans, list_reduce(list(b[a + 1:z - 1] ORDER BY k), lambda x, y: x || y) AS kept FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(coalesce(kept, b)) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id)""",
    "op10_minhash": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS g
           FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM d WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
     c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
     e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
     r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.y AS component_id, d.doc_id = m.y AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS y FROM r GROUP BY 1) m ON m.x = d.doc_id""",
    "op2_embedding_pca": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
     u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM v
           WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
     l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) >= 0.95),
     r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.b FROM r JOIN l ON l.a = r.y)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.y AS component_id, v.vec_id = m.y AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) n ON n.a = v.vec_id JOIN (SELECT x, min(y) AS y FROM r GROUP BY 1) m ON m.x = v.vec_id""",
}
