"""Null and repeated ids, long texts, clashing names, empty tables."""

import hashlib
import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessella.llm import decontaminate, embed_pca, lang_id, license_scan, lm_lattice, minhash_forest, suffix_dedup, toxicity_crf
from tessella.llm.bpe_trie import TrieBpe, encode_documents
from tessella.llm.token_counts import Counter, count_tokens

BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 8))) for _ in range(n))


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def removed(texts, length):
    """n_removed and the digest of what is left, by listing every window."""
    raw, seen = [(t or "").encode() for t in texts], {}
    for d, t in enumerate(raw):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    gone = [np.zeros(len(t), dtype=bool) for t in raw]
    for places in seen.values():
        for d, i in places if len(places) > 1 else ():
            gone[d][i : i + length] = True
    return [(int(g.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~g].tobytes()).hexdigest()) for t, g in zip(raw, gone, strict=True)]


@pytest.mark.parametrize("most", [1024, 1])
def test_suffix_dedup_tells_rows_apart_by_text(spark, most):
    shared = prose(1, 30)
    texts = [prose(2, 20) + shared, shared + prose(3, 25), prose(4, 60), prose(4, 60), prose(5, 10) + shared, prose(6, 40), prose(6, 40), None, ""]
    ids = [7, 7, 8, 8, None, None, None, None, 7]
    got = suffix_dedup.remove_repeats(table(spark, list(zip(ids, texts, strict=True))), 60, most=most).collect()
    want = [(i, *r) for i, r in zip(ids, removed(texts, 60), strict=True)]
    assert sorted(((r.doc_id, r.n_removed, r.kept_sha256) for r in got), key=repr) == sorted(want, key=repr)


def test_suffix_dedup_of_a_text_longer_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 1 << 12)
    long = prose(7, 4000)
    texts = [long[:9000] + prose(8, 30) + long[9000:], "x" + long[5000:5300], prose(9, 3000) + long[100:160], "ab" * 4000]
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(table(spark, list(enumerate(texts))), 50).collect()}
    assert [got[k] for k in range(4)] == removed(texts, 50)


def test_near_duplicates_tell_rows_apart_by_text(spark):
    a, b = prose(10, 80), prose(11, 80)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (None, "start " + b), (None, prose(12, 50)), (4, a), (4, a), (5, None)]
    got = minhash_forest.link_documents(table(spark, rows)).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr)
    n = lambda t: len({tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)})
    want = [(i, 0 if t is None else n(t), 1 if t and len(t) > 300 and (a in t or b in t) else i, False if t and (a in t or b in t) and i != 1 else True) for i, t in rows]
    assert found == sorted(want, key=repr)


def test_vectors_tell_rows_apart(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.01, 1.0]), (None, [1.0, 0.01]), (None, [-1.0, 0.0]), (3, [5.0, 5.0]), (3, [5.0, 5.0]), (None, None)]
    got = embed_pca.link_vectors(table(spark, rows, "vec_id long, embedding array<float>"), 0.95).collect()
    want = [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 1, 1, False), (None, 0, None, True), (3, 1, 3, True), (3, 1, 3, True), (None, 0, None, True)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_decontamination_in_passes_tells_rows_apart(spark):
    items = [(f"i{k}", prose(20 + k, 14)) for k in range(6)]
    rows = [(1, items[0][1]), (1, "nothing here"), (None, items[1][1] + " " + items[4][1]), (None, None), (2, items[0][1]), (2, items[0][1])]
    bench = table(spark, items, "item_id string, text string")
    one, many = (sorted((tuple(r) for r in decontaminate.find_benchmark(table(spark, rows), bench, pass_bytes=p).select("doc_id", "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated").collect()), key=repr) for p in (1 << 20, 60))
    assert one == many and sum(r[6] for r in one) == 4


def test_long_texts_and_clashing_columns_in_other_operators(spark):
    long = prose(30, 200_000)
    rows = [(1, long, "a", "en"), (2, "short text", "b", "en"), (3, None, "c", "de")]
    df = table(spark, rows, "doc_id long, text string, score string, lang string")
    assert {r.doc_id: r.n_tokens for r in count_tokens(df, BYTE).collect()} == {k + 1: n for k, n in enumerate(Counter(BYTE).whole([long, "short text", ""]))}
    own = TrieBpe(WORD)
    ids = [own.library.encode(t, add_special_tokens=False).ids for t in (long, "short text", "")]
    assert {r.doc_id: r.ids_sha256 for r in encode_documents(df, WORD, outputs="digests").collect()} == {k + 1: hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() for k, i in enumerate(ids)}
    found = decontaminate.find_benchmark(df, table(spark, [("i", long[-120:-20])], "item_id string, text string")).collect()
    assert [r.contaminated for r in sorted(found, key=lambda r: r.doc_id)] == [True, False, False] and found[0].score in "abc"
    linked = minhash_forest.link_documents(df).collect()
    assert sorted(r.component_id for r in linked) == [1, 2, 3]
    scored = {r.doc_id: r for r in lm_lattice.score_documents(df, F.lit(False), PIECE).collect()}
    assert scored[1].n_tokens == 200_001 and scored[3].n_tokens == 1
    model = lang_id.fit(df)
    assert dict(lang_id.identify(df, model).dtypes)["score"] == "double" and lang_id.identify(df, model).count() == 3
    assert license_scan.scan(df.select("doc_id", "text"), license_scan.fit(df.select("doc_id", "text"))).count() == 3


def test_letters_are_unicode_letters():
    assert not any(map(lang_id.has_letter, [None, "", "½ ²", "Ⅷ 12", "①", "_ _"])) and all(map(lang_id.has_letter, ["x", "ß", "日", "½ é"]))


def test_empty_tables(spark):
    none = table(spark, [], "doc_id long, text string, lang string")
    bench = table(spark, [], "item_id string, text string")
    assert suffix_dedup.remove_repeats(none).count() == minhash_forest.link_documents(none).count() == decontaminate.find_benchmark(none, bench).count() == 0
    assert license_scan.scan(none.select("doc_id", "text"), license_scan.fit(none.select("doc_id", "text"))).count() == 0
    assert embed_pca.link_vectors(table(spark, [], "vec_id long, embedding array<float>")).count() == 0
    assert encode_documents(none, WORD).count() == count_tokens(none, BYTE).count() == 0
    labels = table(spark, [], "doc_id long, toxic int")
    assert toxicity_crf.score_documents(none.select("doc_id", "text"), toxicity_crf.fit(none.select("doc_id", "text"), labels)).count() == 0


def test_pipeline_keeps_clashing_columns_and_odd_ids(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_bytes string, score string, items string, n_words string, node string, runs string"
    rest = ("s", 1, "B", "S", "I", "W", "N", "R")
    texts = [(1, prose(40, 120)), (1, prose(41, 120)), (2, prose(40, 120) + " more"), (None, prose(42, 120)), (None, prose(42, 120)), (3, None), (4, prose(43, 90))]
    rows = [(i, t, "en", *rest) for i, t in texts]
    table(spark, rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, [("b", texts[-1][1][10:200])], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name in ("language_id", "near_duplicates", "suffix_dedup", "decontaminate"):
        out = stages[name](spark, df, str(tmp_path))
        assert out.columns == df.columns and out.dtypes == df.dtypes
        assert {tuple(r)[5:] for r in out.collect()} == {rest[2:]}
    near = stages["near_duplicates"](spark, df, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in near), key=repr) == sorted([(1, texts[0][1]), (1, texts[1][1]), (None, texts[3][1]), (3, None), texts[6]], key=repr)
    clean = stages["decontaminate"](spark, df, str(tmp_path)).collect()
    assert {r.doc_id for r in clean} == {1, 2, 3, None} and len(clean) == 6
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 3
