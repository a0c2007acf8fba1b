"""Training-data operators against brute force, the libraries themselves, and edge cases."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.llm import decontaminate, embed_pca, lang_id, license_scan, lm_lattice, minhash_forest, suffix_dedup, toxicity_crf
from tessella.llm.bpe_trie import TrieBpe, decode_ids, encode_documents
from tessella.llm.token_counts import Counter, count_tokens

BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = [None, "", " ", "\n\n a  b\t c\n", "it's we'll <|endoftext|> x<|endoftext|>", "ΑΣ ΟΔΟΣ İstanbul é ½²", "日本語 テスト <|startoftext|>Hello", "a\x1cb\x85c d _foo_ __ x_1 1234 ''s '' 's", "aaaaaaaaaaaaaaa " * 300, " ​ \U0001f600 ok", "é Ü ß ẞ", "x" * 3000, "lead", "lead"]
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def docs(spark, texts, **extra):
    return spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_token_counts_equal_the_library(spark):
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs(spark, ODD), BYTE).collect()}
    plain = Counter(BYTE)
    assert got == {k: (len((t or "").encode()), plain.whole([t or ""])[0]) for k, t in enumerate(ODD)}
    assert count_tokens(empty(spark), BYTE).count() == 0


def test_long_texts_split_safely():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdé'. ") for _ in range(rng.randint(1, 9))) for _ in range(40_000))
    own = Counter(BYTE)
    assert own.counts([text]) == own.whole([text])


def test_trie_encoding_equals_the_library(spark):
    own = TrieBpe(WORD)
    rng = random.Random(2)
    more = [" ".join("".join(rng.choice("etaoinshrdlu,'-é9") for _ in range(rng.randint(1, 14))) for _ in range(60)) for _ in range(60)]
    for text, (ids, decoded) in zip(ODD + more, own.encode([t or "" for t in ODD + more]), strict=True):
        want = own.library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == own.library.decode(want, skip_special_tokens=False)
    rows = encode_documents(docs(spark, ODD), WORD)
    assert [r.decoded for r in rows.orderBy("doc_id").collect()] == [r.decoded for r in decode_ids(rows.drop("decoded"), WORD).orderBy("doc_id").collect()]
    digest = encode_documents(docs(spark, ODD), WORD, outputs="digests").orderBy("doc_id").collect()
    assert digest[0].ids_sha256 == hashlib.sha256(b"").hexdigest() and dict(rows.dtypes)["n_tokens"] == "bigint"


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(30)] + ["É", "b2"]
    items = [("i1", " ".join(rng.choices(words, k=14))), ("i2", "Short one"), ("i3", None), ("i4", "..."), ("i5", " ".join(rng.choices(words, k=10)))]
    texts = [None, "", "a short, ONE b", items[0][1].replace(" ", ",  "), "x " + " ".join(items[0][1].split()[2:13]) + " y", items[4][1], items[4][1], " ".join(items[4][1].split()[:9])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = split.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    for pass_bytes in (1 << 20, 40):
        got = {r.doc_id: r for r in decontaminate.find_benchmark(docs(spark, texts), bench, pass_bytes=pass_bytes).collect()}
        for k, t in enumerate(texts):
            w, hit, found = split.findall((t or "").translate(LOW)), set(), set()
            for a, b in itertools.combinations(range(len(w) + 1), 2):
                if s := windows.get(tuple(w[a:b])):
                    found |= s
                    hit |= set(range(a, b))
            r = got[k]
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), decontaminate.digest(found), bool(hit))
    assert decontaminate.find_benchmark(docs(spark, texts), bench.limit(0)).filter("contaminated").count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_minhash_links_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(200)] for _ in range(6)]
    texts = [None, "", "   ", "one two", "One  two", "one"]
    for b in base:
        for edits in (0, 0, 1, 2, 3, 5, 8) + (2,) * 12:  # a family beyond the size of a small region
            copy = list(b)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_forest.link_documents(docs(spark, texts), small=6).collect()}
    assert got == {k: (len(sets[k]), root(k), root(k) == k) for k in range(len(texts))}
    assert minhash_forest.link_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("kind", ["template", "generations"])
def test_minhash_links_in_large_regions(spark, kind):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))

    def edited(words, n):  # n edits in places of their own: each takes five shingles
        out = list(words)
        for at in rng.sample(range(2, len(out) // 5 - 1), n):
            out[at * 5] = word()
        return out

    if kind == "template":  # one frame around texts of their own; a few pairs among them are copies
        frame = [word() for _ in range(200)]
        rows = [frame + [word() for _ in range(40)] for _ in range(40)]
        rows += [edited(rows[k], 2) for k in range(0, 40, 8)]
    else:  # copies of copies: each like the one before, not like the first
        first = [word() for _ in range(300)]
        rows = [edited(first, 1) for _ in range(25)]
        for k in range(25):
            child = edited(rows[k], 4)
            rows += [child, edited(child, 4)]
    sets = [shingles(" ".join(w)) for w in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    label = list(range(len(rows)))
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r.component_id for r in minhash_forest.link_documents(docs(spark, [" ".join(w) for w in rows]), small=2, depths=(1,)).collect()}
    assert got == dict(enumerate(label))


def test_suffix_array_of_two_stages():
    rng = random.Random(5)
    for k in range(200):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 200))) + b"\xff"
        text = b"a" * k + b"\xff" if k % 5 == 0 else text
        assert suffix_dedup.suffix_array(text, 300).tolist() == sorted(range(len(text)), key=lambda i, t=text: t[i:])


@pytest.mark.parametrize("most", [256, 4])
def test_suffix_dedup_equals_brute_force(spark, most):
    rng, length = random.Random(6), 60
    passage = "".join(rng.choice("abc é") for _ in range(150))
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    texts = [None, "", "ab" * 200, "x" * 59, "x" * 300, *(noise(90) + passage + noise(rng.randint(0, 80)) for _ in range(25)), *[noise(300)] * 3, noise(50)]
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, t in enumerate(raw):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    gone = [np.zeros(len(t), dtype=bool) for t in raw]
    for places in seen.values():
        for d, i in places if len(places) > 1 else ():
            gone[d][i : i + length] = True
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs(spark, texts), length, most=most).collect()}
    for k, (t, g) in enumerate(zip(raw, gone, strict=True)):
        kept = np.frombuffer(t, np.uint8)[~g].tobytes()
        assert (got[k].n_bytes, got[k].n_removed, got[k].kept_sha256) == (len(t), int(g.sum()), hashlib.sha256(kept).hexdigest())
        assert got[k].n_spans == int((np.diff(np.append(False, g).astype(np.int8)) == 1).sum())
    cut = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs(spark, texts), length, "text", most).collect()}
    assert cut[0] is None and cut[4] == "" and cut[3] == texts[3]


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(25, 24))
    rows = [list(map(float, b + rng.normal(size=24) * s)) for b in base for s in (0.0, 0.0, 0.05, 0.2, 0.35)]
    rows += [None, [], [0.0] * 24, [math.nan] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows.append([None] + [1.0] * 23)
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], "vec_id long, embedding array<float>")
    unit = [None if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v) else (a := np.array(v, np.float32).astype(float)) / np.linalg.norm(a) for v in rows]
    near = [{j for j, b in enumerate(unit) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95} for i, a in enumerate(unit)]
    component = list(range(len(rows)))
    for _ in rows:
        component = [min([component[i], *(component[j] for j in near[i])]) for i in range(len(rows))]
    for block in (8192, 16):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embed_pca.link_vectors(df, 0.95, block).collect()}
        assert got == {k: (len(near[k]), component[k]) for k in range(len(rows))}
    assert embed_pca.link_vectors(df.limit(0)).count() == 0


def test_lattice_sums_all_segmentations():
    pieces, logp = lm_lattice.vocabulary(PIECE)
    table = dict(zip(pieces, logp, strict=True))

    def brute(text):
        if not text:
            return 1.0
        return sum(math.exp(table[text[:k]]) * brute(text[k:]) for k in range(1, len(text) + 1) if text[:k] in table)

    longest = max(pieces, key=len)
    assert len(longest) > 16
    words = [longest.strip(), b"a", b"the", b"station", "é".encode(), b"\xf0\x9f", b"thth,"]
    got, counts = lm_lattice.Lattice(pieces, logp).run(words, np.ones(len(words)))
    assert np.allclose(np.exp(got), [brute(b" " + w) for w in words])
    assert math.isclose(sum(c * len(p) for c, p in zip(counts, pieces, strict=True)), sum(len(w) + 1 for w in words))


def reference_lm(train, tokens):
    """The probabilities of tokens (None: the end) by listing every segmentation."""
    pieces, logp = lm_lattice.vocabulary(PIECE)
    weight = dict(zip(pieces, np.exp(logp), strict=True))

    def ways(text):
        return [[]] if not text else [[text[:k], *rest] for k in range(1, len(text) + 1) if text[:k] in weight for rest in ways(text[k:])]

    seen = [w for t in train for w in t]
    counts = {w: seen.count(w) for w in seen if w is not None}
    once, twice = (sum(c == n for c in counts.values()) for n in (1, 2))
    discount = once / (once + 2 * twice) if once else 0.5
    every = {w: ways(b" " + w.encode()) for w in {*counts, *(w for w in tokens if w is not None)}}
    for _ in range(lm_lattice.ROUNDS):
        e = dict.fromkeys(weight, 0.01)
        for w in counts:
            p = [math.prod(weight[x] for x in way) for way in every[w]]
            for way, q in zip(every[w], p, strict=True):
                for x in way:
                    e[x] += q / sum(p)
        total = sum(e.values())
        weight = {x: v / total for x, v in e.items()}
    marginal = {w: sum(math.prod(weight[x] for x in way) for way in own) for w, own in every.items()}
    return [seen.count(None) / len(seen) if w is None else (max(counts.get(w, 0) - discount, 0) + discount * len(counts) * marginal[w]) / len(seen) for w in tokens]


def test_lm_scores(spark):
    texts = [None, "", "the cat the", "a cat", "The dog " * 50, "zzzz qqq"]
    df = docs(spark, texts)
    got = {r.doc_id: r for r in lm_lattice.score_documents(df, F.col("doc_id") == 5, PIECE).collect()}
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None] for t in texts]
    seen = [w for t in tokens[:5] for w in t]
    n, v = len(seen), len(set(seen))
    for k, t in enumerate(tokens):
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens, got[k].held_out) == (len(t), sum(w in seen for w in t), n, k == 5)
        assert math.isclose(got[k].base_score, sum(math.log10((seen.count(w) + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        assert math.isclose(got[k].score, sum(math.log10(p) for p in reference_lm([t for t in tokens[:5]], t)), rel_tol=1e-9)
        assert math.isclose(got[k].score_per_token, got[k].score / len(t))
    assert lm_lattice.score_documents(empty(spark), F.lit(False), PIECE).count() == 0


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(8)
    model = toxicity_crf.Crf(np.zeros(0, np.uint64), np.zeros(0), 0.0, rng.normal(size=(2, 2)))
    first = np.array([0, 5, 5, 6, 13])
    u = rng.normal(size=13) * 2
    got = model.marginals(u, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        weight = {y: math.exp(sum(u[a + t] * s for t, s in enumerate(y)) + sum(model.steps[p, q] for p, q in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=b - a)}
        total = sum(weight.values())
        for t in range(b - a):
            assert math.isclose(got[a + t], sum(w for y, w in weight.items() if y[t]) / total, rel_tol=1e-9)


def test_toxicity_learns_and_finds_spans(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts, labels = [], []
    for k in range(160):
        words = [word() for _ in range(40)]
        if k % 2:
            words[rng.randrange(40)] = "Stupid"
        texts.append(" ".join(words))
        labels.append((k, k % 2))
    model = toxicity_crf.fit(docs(spark, texts), spark.createDataFrame(labels + [(0, None)], "doc_id long, toxic int"))
    rows = toxicity_crf.score_documents(docs(spark, [*texts, None, ""]), model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id < 160) and all(r.score < 0.5 for r in rows if r.doc_id >= 160)
    assert texts[1].encode()[rows[1].spans[0].start : rows[1].spans[0].end] == b"Stupid"
    assert toxicity_crf.score_documents(empty(spark), toxicity_crf.train([], [])).count() == 0


def test_language_identification(spark):
    rng = random.Random(10)
    make = lambda parts: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(40))
    kinds = {"xx": ["tion", "the", "ing"], "yy": ["ä", "sch", "ung"]}
    rows = [(k, make(kinds[lang := ("xx", "yy")[k % 2]]), lang) for k in range(60)] + [(60, None, "xx"), (61, "12 34!", "yy"), (62, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lang_id.identify(df, lang_id.fit(df)).collect()}
    assert all(got[k].lang_pred == lang and not got[k].rejected for k, _, lang in rows[:60])
    assert all((got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True) for k in (60, 61, 62))
    assert lang_id.identify(df, lang_id.fit(empty(spark))).filter("lang_pred <> 'und'").count() == 0


def test_language_rejects_what_it_has_not_learned(spark):
    rng = random.Random(13)
    # Texts of 5 to 90 words, and some odd short texts, which must not set the limit for all.
    make = lambda parts, n: " ".join("".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(n))
    kinds = {"xx": ["tion", "the", "ing", "er", "an", "re"], "yy": ["ä", "sch", "ung", "ein", "de", "ich"]}
    rows = [(k, make(kinds[lang := ("xx", "yy")[k % 2]], rng.choice((5, 20, 90))), lang) for k in range(400)] + [(400 + k, t, "xx") for k, t in enumerate(("A.", "Bo.", "Ku.", "Vy.", "Zzz.", "Pf.", "Q.", "Jw.", "Mb.", "Co."))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(df)
    clean = [make(kinds[x], n) for x in kinds for n in (5, 20, 90) for _ in range(40)]
    far = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(n)) for n in (60, 400)] + ["".join(chr(rng.randint(0x3B1, 0x3C9)) for _ in range(n)) for n in (60, 400)]
    far += [make(parts, n) for parts in ("bcdfgjklmpqvwxz", "abcdefghijklmnopqrstuvwxyz") for n in (40, 200)] + [rng.randbytes(n).hex() for n in (60, 400)]
    got = {r.doc_id: r.rejected for r in lang_id.identify(docs(spark, clean + far), model).collect()}
    assert sum(got[k] for k in range(len(clean))) <= 0.02 * len(clean)
    assert all(got[k] for k in range(len(clean), len(clean + far)))


def test_licences(spark):
    texts = [None, "", "Some text.\nReleased under the MIT License.\nMore text here.", "We like the license of things.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0."]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, texts), license_scan.fit(docs(spark, texts))).collect()}
    assert [got[k].family for k in range(6)] == [None, None, "mit", None, "cc-by-nc-4.0", "apache-2.0"]
    assert got[5].n_confirmed == 2 and texts[2][got[2].spans[0].start : got[2].spans[0].end] == "Released under the MIT License"
    assert pa.array(got[5].families).to_pylist() == ["apache-2.0"]


def test_wrapped_licences(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met."
    apache = "Licensed under the Apache License,\nVersion 2.0."
    texts = [bsd, apache, f"Some words here.\n{apache}\nMore words there.\n\n# {bsd.replace(chr(10), chr(10) + '# ')}\n", "Licensed under the Apache\n\nLicense of our town", "Released under\nthe MIT License.\n" * 3, f"Released under the MIT License.\n{apache}"]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, texts), license_scan.fit(docs(spark, ["Some text.", "More text here."]))).collect()}
    assert [got[k].families for k in range(6)] == [["bsd-3-clause"], ["apache-2.0"], ["apache-2.0", "bsd-3-clause"], [], ["mit"], ["apache-2.0", "mit"]]
    assert [got[k].n_unconfirmed for k in (0, 1, 2)] == [0, 0, 0] and [got[k].n_confirmed for k in (2, 4, 5)] == [2, 3, 2]
    assert [texts[k][got[k].spans[0].start : got[k].spans[0].end] for k in (0, 1)] == [bsd[:-1], apache[:-1]]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    sentence = lambda: " ".join("".join(rng.choice(["the", "tion", "er", "in"]) for _ in range(3)) for _ in range(60))
    leak, first = sentence(), sentence()
    rows = [(0, first), (1, first + " x"), (2, sentence() + " " + leak), (3, None), (4, "123"), (5, sentence())]
    spark.createDataFrame([(k, t, "xx", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [0, 5] and "ids" in out.columns


def test_pipeline_keeps_the_decoded_text(spark):
    import corpus_pipeline

    rows = {r.doc_id: r.decoded for r in corpus_pipeline.encode(spark, docs(spark, ["the cat sat", "", "lead"]), "").collect()}
    own = TrieBpe(WORD).library
    assert rows == {k: own.decode(own.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for k, t in enumerate(["the cat sat", "", "lead"])}
