"""The pipeline, language identification and the licence classifier against plain restatements."""

import hashlib
import itertools
import math
import random
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tessella.llm import lang_id, license_scan

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def ngram_vector(text, idf):
    """(1 + ln tf) * idf of the byte 2- and 3-grams that begin or go on with a letter, by slot, of length one."""
    raw = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
    letter = [97 <= b < 123 or b >= 128 for b in raw]
    clean = bytes(b if a else 32 for a, b in zip(letter, raw, strict=True))
    tf, mask, mult, dims = {}, (1 << 64) - 1, int(lang_id._MULT), len(idf)
    for width in (2, 3):
        for k in range(len(raw) - width + 1):
            if letter[k] or letter[k + 1]:
                h = ((int.from_bytes(clean[k : k + width], "little") * mult + (width << 40)) & mask) * mult & mask
                slot = h >> (64 - dims.bit_length() + 1)
                tf[slot] = tf.get(slot, 0) + 1
    v = {s: (1 + math.log(n)) * float(idf[s]) for s, n in tf.items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {s: x / size for s, x in v.items()}


def test_nearest_centroids_by_hand(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, rng.randint(1, 60)) if k % 2 else prose(rng, rng.randint(1, 60)).translate(str.maketrans("etaoinshrdlu", "äößxyzqwkjüv")), "aa" if k % 2 else "bb") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(docs)
    texts = [r[1] for r in rows] + [None, "", "12 ½", "x", "É é"]
    names, scores, _ = model.predict(pa.array(texts, pa.string()))
    for text, name, score in zip(texts, names, scores, strict=True):
        v = ngram_vector(text, model.idf)
        cosines = [sum(x * float(c[s]) for s, x in v.items()) for c in model.centroids]
        if not text or not any(map(str.isalpha, text)):
            assert (name, score) == ("und", 0)
        else:
            assert math.isclose(score, min(max(max(cosines), 0), 1), abs_tol=1e-5)
            assert abs(max(c for c, of in zip(cosines, model.of, strict=True) if model.languages[of] == name) - max(cosines)) < 1e-5


def test_language_learns_from_every_row(spark):
    rng = random.Random(6)
    # More rows of a language than any sample held, the last of them of another kind.
    texts = [prose(rng, rng.randint(1, 60)) if k < 1400 else prose(rng, 30).translate(str.maketrans("etaoins", "zqxwkvy")) for k in range(1500)]
    docs = spark.createDataFrame([(k, t, "aa") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = lang_id.fit(docs, centroids=1)
    fold = {r.doc_id: r.fold for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id, text, 5), {lang_id.FOLDS}) AS fold").collect()}
    fold = np.array([fold[k] for k in range(len(texts))])
    vectors = lambda rows: lang_id.weigh(lang_id.counts(pa.array(rows, pa.string())), model.idf)
    x = vectors(texts)
    mean = lambda v: v.sum(axis=0) / np.linalg.norm(v.sum(axis=0))
    assert np.allclose(model.centroids, [mean(x)], atol=1e-5)
    without = [mean(x[fold != f]) for f in range(lang_id.FOLDS)]
    cosines = {}
    for cut in (*lang_id.CUTS, 1 << 30):
        own = [k for k, t in enumerate(texts) if cut == 1 << 30 or len(t) > cut]
        part = [texts[k][:cut] for k in own]
        n = lang_id.counts(pa.array(part, pa.string())).sum(axis=1) if part else []
        for k, v, size in zip(own, vectors(part) if part else [], n, strict=True):
            cosines.setdefault(int(np.searchsorted(lang_id.EDGES, size, side="right")), []).append(float(v @ without[fold[k]]))
    for band, found in cosines.items():
        assert abs(model.limits[0][band] - lang_id.MARGIN * np.quantile(found, lang_id.QUANTILE)) < 1e-4


def test_counts_are_packed_in_full():
    tf = np.zeros((3, lang_id.DIMS), dtype=np.float32)
    tf[0, [0, 7, 4095]], tf[2, 5:9] = [1, 255, 70_000], [254, 255, 256, 3]
    batch = pa.RecordBatch.from_arrays(lang_id.pack(tf), names=["bits", "low", "over"])
    for part, own in ((batch, tf), (batch.slice(2, 1), tf[2:]), (batch.slice(1, 1), tf[1:2])):
        some, used = lang_id.unpack(part, lang_id.DIMS)
        assert (some == (own > 0)).all() and (used == own[own > 0]).all()


def test_licence_probabilities_by_hand(spark):
    rng = random.Random(4)
    corpus = [prose(rng, 40) + "\nthe licence of this song is unknown to me" for _ in range(40)]
    model = license_scan.train(corpus)
    family = model.families[0]
    for text in (license_scan.NOTICES[family][0], corpus[0], "a licence for " + prose(rng, 8)):
        words = license_scan._hash_words(text)
        some, p = model.units(words, np.array([0]), np.array([len(words)]))
        known = {int(k): i for i, k in enumerate(model.keys)}
        z = model.bias.astype(float).copy()
        for h in {int(h) for g in license_scan.grams(words) for h in g} & known.keys():
            z += model.weights[known[h]]
        e = np.exp((z - z.max()) / model.temperature)
        if len(some):
            assert np.allclose(p[0], e / e.sum(), atol=1e-5)
    docs = spark.createDataFrame([(0, "x\n" + license_scan.NOTICES[family][0] + "\ny"), (1, corpus[0])], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs, model).collect()}
    assert got[0].family == family and got[1].family is None


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    shared, items = prose(rng, 90), [(f"b{k}", prose(rng, 14)) for k in range(3)]
    texts = [prose(rng, rng.randint(60, 120)) for _ in range(24)]
    texts += [texts[0], texts[1] + " tail", "head " + texts[1], texts[2] + " " + shared, shared + " " + texts[3][:200], texts[4][:300] + " " + items[1][1] + " " + texts[5][:200], items[2][1], "", None]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = lang_id.fit(docs)
    rejected = model.predict(pa.array(texts, pa.string()))[2]
    kept = {k: t for k, t in enumerate(texts) if not rejected[k]}
    # One of each group of near-duplicates.
    sets = {k: shingles(t) for k, t in kept.items()}
    part = {k: k for k in kept}
    for _ in kept:
        for a, b in itertools.combinations(kept, 2):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and sets[a]:
                part[a] = part[b] = min(part[a], part[b])
    kept = {k: t for k, t in kept.items() if part[k] == k}
    # Repeated passages.
    seen, size = {}, corpus_pipeline.PASSAGE_BYTES
    for k, t in kept.items():
        for i in range(len(t) - size + 1):
            seen.setdefault(t[i : i + size], []).append((k, i))
    gone = {k: np.zeros(len(t), dtype=bool) for k, t in kept.items()}
    for places in seen.values():
        for k, i in places if len(places) > 1 else ():
            gone[k][i : i + size] = True
    assert any(g.any() for g in gone.values())
    kept = {k: "".join(c for c, g in zip(t, gone[k], strict=True) if not g) for k, t in kept.items()}
    # Ten words of a benchmark item.
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOW))
    windows = {tuple(w[i : i + 10]) for _, t in items for w in [split(t)] for i in range(len(w) - 9)}
    clean = {k: t for k, t in kept.items() if not any(tuple(split(t)[i : i + 10]) in windows for i in range(len(split(t)) - 9))}
    assert len(clean) < len(kept)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: (library.encode(t, add_special_tokens=False).ids, hashlib.sha256(t.encode()).hexdigest()) for k, t in clean.items()}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: list(r.ids) for r in out} == {k: i for k, (i, _) in want.items()}
    assert all(r.decoded == library.decode(want[r.doc_id][0], skip_special_tokens=False) and r.n_chars == len(clean[r.doc_id]) for r in out)
