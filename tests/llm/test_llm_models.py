"""Classifiers, language ID and PPM: brute force on small fixtures, held-out accuracy, edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import langid, ppm, quality, toxicity
from riskspark.llm import queries as Q
from riskspark.llm.common import held_out

BIG = "/root/testdata/sf0.01"


def test_held_out(spark):
    ids = [0, 7, 123456789, -4, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(held_out("doc_id", 5, 0)).collect()
    assert [r[0] for r in got] == [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


# ---- PPM

def brute_ppm(model, words, order):
    """Straight from the definition: walk down the contexts, excluding what was ruled out."""
    s = ppm.symbols(words, order).tolist()
    total = 0.0
    for at in range(order, len(s)):
        excluded = set()
        for k in range(order, -1, -1):
            left = {y: n for y, n in model.get(tuple(s[at - k:at]), {}).items() if y not in excluded}
            if not left:
                continue
            if s[at] in left:
                total += math.log10((left[s[at]] - 0.5) / sum(left.values()))
                break
            total += math.log10(len(left) / 2 / sum(left.values()))
            excluded |= left.keys()
        else:
            total -= math.log10(ppm.SYMBOLS - len(excluded))
    return total


def counts_of(texts, order):
    model = {}
    for t in texts:
        s = ppm.symbols(ppm.model_words(t), order).tolist()
        for at in range(order, len(s)):
            for k in range(order + 1):
                model.setdefault(tuple(s[at - k:at]), Counter())[s[at]] += 1
    return model


TRAIN = ["the cat sat on the mat", "the dog sat", "a cat  and\ta dog", "", "THE THE the", "żółw ł", "x" * 40]
SCORED = TRAIN + ["the cow sat", "qqq zzz", "a", " ", "żaba", "the cat sat on the mat " * 30]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_ppm_scores(spark, order):
    rows = [(i, t, True) for i, t in enumerate(TRAIN)] + [(50, None, True)] + [(100 + i, t, False) for i, t in enumerate(SCORED)] + [(None, "the cat", None)] + [(100, SCORED[0], False)]
    df = spark.createDataFrame(rows, "doc_id int, text string, learn boolean").withColumn("score", F.lit("clash")).withColumn("k", F.lit(0)).withColumn("word", F.lit("w"))
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode()
    model = counts_of([low(t) for _, t, learn in rows if learn], order)
    seen = Counter(w for _, t, learn in rows if learn for w in [*low(t).split(), None])
    n, v = sum(seen.values()), len(seen)
    for common in (1 << 18, 2):
        got = ppm.language_model_scores(df, F.col("learn"), order=order, common_words=common).collect()
        assert len(got) == len(rows)
        want = {}
        for i, t, _ in rows:
            words = low(t).split()
            toks = [*words, None]
            want[i] = (len(toks), sum(seen[w] > 0 for w in toks), n, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in toks), brute_ppm(model, words, order))
        for r in got:
            w = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
            assert r["base_score"] == pytest.approx(w[3], abs=1e-9)
            assert r["score"] == pytest.approx(w[4], rel=1e-10, abs=1e-10)


@pytest.mark.parametrize("order,max_contexts,max_grams", [(5, 9, 1 << 20), (3, 1 << 17, 25), (5, 1, 1), (1, 4, 1 << 20)])
def test_ppm_cache_that_is_too_small(spark, order, max_contexts, max_grams):
    rows = [(i, t, True) for i, t in enumerate(TRAIN)] + [(100 + i, t, False) for i, t in enumerate(SCORED)] + [(100, SCORED[0], False), (200, None, False)]
    df = spark.createDataFrame(rows, "doc_id int, text string, learn boolean")
    words = {i: ppm.model_words((t or "").encode()) for i, t, _ in rows}
    model = counts_of([t.encode() for t in TRAIN], order)
    got = ppm.language_model_scores(df, F.col("learn"), order=order, max_contexts=max_contexts, max_grams=max_grams).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(brute_ppm(model, words[r["doc_id"]], order), rel=1e-10, abs=1e-10)


def test_ppm_long_text_and_long_words_by_joins(spark):
    rng = random.Random(8)
    long = " ".join(rng.choice(["ab", "abc", "bd", "x" * 100, "é"]) for _ in range(20000))
    rows = [(1, "ab bd abc", True), (2, long, False), (3, "y" * 300 + " ab", True), (4, "y" * 300, False)]
    df = spark.createDataFrame(rows, "doc_id int, text string, learn boolean")
    model = counts_of([rows[0][1].encode(), rows[2][1].encode()], 3)
    got = {r["doc_id"]: r for r in ppm.language_model_scores(df, F.col("learn"), order=3, max_contexts=2, max_grams=4).collect()}
    for i, t, _ in rows:
        assert got[i]["score"] == pytest.approx(brute_ppm(model, t.encode().split(), 3), rel=1e-9)
    assert got[4]["n_known"] == 2


def test_ppm_without_training_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in ppm.language_model_scores(df, F.lit(False)).collect()}
    assert got[1]["score"] == pytest.approx(-3 * math.log10(257), rel=1e-6) and got[1]["base_score"] == pytest.approx(0)
    assert (got[2]["n_tokens"], got[2]["n_known"], got[2]["train_tokens"]) == (1, 0, 0)
    assert ppm.language_model_scores(df.limit(0), F.lit(True)).collect() == []


def test_ppm_adaptive(spark):
    text = "abracadabra " * 50
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")
    got = {r["doc_id"]: r["score"] for r in ppm.language_model_scores(df, F.lit(True), mode="adaptive").collect()}
    assert got[1] == pytest.approx(ppm.adaptive_log10(text.encode().split())) and got[2] == pytest.approx(-math.log10(257))
    assert got[1] > -0.3 * len(text)


def test_ppm_row_sums_to_one():
    order = 3
    g, n = ppm._merged(list(ppm.gram_counts([ppm.model_words(t.encode()) for t in TRAIN], order)))
    grams, counts = [], []
    for length in range(1, order + 2):
        u, at = np.unique(g & ((1 << (9 * length)) - 1), return_inverse=True)
        grams.append(u)
        counts.append(np.bincount(at, weights=n).astype(np.int64))
    t = ppm.Tables(ppm.Trie(order, tuple(grams), tuple(counts)))
    contexts = np.unique(np.concatenate([g >> 9, np.array([ppm.END, 258 << 9, 1 << 20])]))
    every = np.concatenate([(c << 9) | np.arange(1, 258) for c in contexts.tolist()])
    value, held = t.values(np.sort(every))
    p = (10 ** value).reshape(len(contexts), 257).sum(1)
    assert np.allclose(p, 1, atol=1e-12) and held.reshape(len(contexts), 257)[np.isin(contexts, g >> 9)].all()


def test_ppm_long_text_in_parts(monkeypatch):
    rng = random.Random(4)
    text = " ".join(rng.choice(["ab", "abc", "bd"]) for _ in range(3000)).encode()
    trie = [ppm._merged(list(ppm.gram_counts([text.split()], 2)))]
    monkeypatch.setattr(ppm, "CHUNK", 501)
    parts = ppm._merged(list(ppm.gram_counts([text.split()], 2)))
    assert (parts[0] == trie[0][0]).all() and (parts[1] == trie[0][1]).all()
    grams, counts = zip(*[(np.unique(trie[0][0] & ((1 << (9 * k)) - 1)), np.bincount(np.unique(trie[0][0] & ((1 << (9 * k)) - 1), return_inverse=True)[1], weights=trie[0][1]).astype(np.int64)) for k in (1, 2, 3)])
    tables = ppm.Tables(ppm.Trie(2, grams, counts))
    s = ppm.symbols(text.split(), 2)
    whole = tables.log10(s)
    monkeypatch.setattr(ppm, "LOOKED", 97)
    assert tables.log10(s) == pytest.approx(whole, rel=1e-12)
    # texts that share a look-up are scored as alone
    both = tables.looked([s, ppm.symbols([b"zz"], 2), s], True)
    assert both[0][0] == both[2][0] == pytest.approx(whole, rel=1e-12) and both[1][0] == pytest.approx(tables.log10(ppm.symbols([b"zz"], 2)), rel=1e-12)


def test_ppm_beats_the_unigram_model(spark):
    rows = Q.QUERIES["op8_ppm_scores"](spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


# ---- language ID

def brute_profile(texts, size):
    n = Counter()
    for t in texts:
        folded = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in t)
        for w in folded.split():
            for k in (1, 2, 3):
                padded = w if k == 1 else f" {w} "
                n.update(padded[i:i + k] for i in range(len(padded) - k + 1))
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    # a blank between two words belongs to both, but a bigram or trigram never crosses it
    return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


LANGS = {"en": ["the cat and the dog", "this is that, isn't it?"], "de": ["der Hund und die Katze", "Übermut tut selten gut"], "zz": ["1234"], "ru": ["это кошка и собака"]}


@pytest.mark.parametrize("size", [300, 12])
def test_language_of_documents(spark, size):
    rows = [(lang, t) for lang, ts in LANGS.items() for t in ts] + [(None, "the the the"), ("en", None), ("en", "")]
    asked = ["the dog", "die Katze", "собака", "42 !", "", None, "the dog", "x" * 5000, "İ ñandú"]
    df = spark.createDataFrame([(i, t, lang, True) for i, (lang, t) in enumerate(rows)] + [(100 + i, t, "de", False) for i, t in enumerate(asked)], "doc_id int, text string, lang string, learn boolean")
    df = df.withColumn("score", F.lit("clash")).withColumn("gram", F.lit(1))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language_of_documents(df, F.col("learn"), size=size).collect()}
    profiles = {lang: brute_profile(ts, size) for lang, ts in LANGS.items() if lang != "zz"}
    for i, t in enumerate(asked):
        own = brute_profile([t], size) if t else []
        far = {lang: sum(abs(k - p.index(g)) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get) if own else "und"
        assert got[100 + i][0] == best
        assert got[100 + i][1] == pytest.approx(1 - far[best] / (size * len(own)) if own else 0.0)


def test_language_without_profiles_and_empty(spark):
    df = spark.createDataFrame([(1, "the cat", None)], "doc_id int, text string, lang string")
    assert [tuple(r) for r in langid.language_of_documents(df, F.lit(True)).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert langid.language_of_documents(df.limit(0), F.lit(True)).collect() == []
    with pytest.raises(ValueError):
        langid.learn_profiles(spark.createDataFrame([("a b", str(i)) for i in range(5)], "text string, lang string"), size=1, max_languages=4)


def test_language_counts_in_parts(monkeypatch):
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abc.é") for _ in range(rng.randint(1, 9))) for _ in range(2000))
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "PART", 100)
    parts = langid.gram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang")
    found = Q.QUERIES["op7_language_id"](spark, BIG).where("held_out").join(docs, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


# ---- quality

def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    rows = Q.QUERIES["op5_quality"](spark, BIG).where("held_out").join(labels.where("quality is not null"), "doc_id").select("quality", "score", "predicted").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_never_reads_label_zero(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    learn = lambda i: ~held_out(i, 5, 0)
    a = quality.quality_scores(docs, labels, learn).orderBy("doc_id").collect()
    b = quality.quality_scores(docs, labels.where("quality = 1"), learn).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["predicted"]) for r in a] == [(r["doc_id"], r["predicted"]) for r in b]
    assert np.allclose([r["score"] for r in a], [r["score"] for r in b])


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "good text here"), (1, "good text here"), (2, None), (3, ""), (4, " \n"), (None, "x")], "doc_id int, text string").withColumn("x", F.lit("c")).withColumn("score", F.lit(2))
    none = spark.createDataFrame([(1, 0), (9, None)], "doc_id int, quality int")
    got = [(r["doc_id"], r["score"], r["predicted"]) for r in quality.quality_scores(docs, none, lambda i: i.isNotNull()).collect()]
    assert sorted(got, key=repr) == sorted([(1, 0.5, 1), (1, 0.5, 1), (2, 0.0, 0), (3, 0.0, 0), (4, 0.0, 0), (None, 0.5, 1)], key=repr)
    one = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "doc_id int, quality int")
    assert all(0 <= r["score"] <= 1 for r in quality.quality_scores(docs, one, lambda i: i.isNotNull()).collect())
    assert quality.quality_scores(docs.limit(0), one, lambda i: i.isNotNull()).collect() == []


def test_quality_features_of_long_texts(monkeypatch):
    text = b"word other " * 3000
    assert np.isfinite(quality.features(text)).all() and quality.features(b"") @ np.ones(quality.FEATURES) == 0
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PART", 1000)
    parts = quality.features(text)
    # what counts distinct words is per part, everything else the same
    k = len(quality.CLASSES) + 1
    assert np.allclose(np.delete(whole, [k + 4, k + 5, k + 6]), np.delete(parts, [k + 4, k + 5, k + 6]), atol=0.01)


def test_quality_counts_words_of_the_whole_text(monkeypatch):
    text = b"word other word " * 2000 + b"rare"
    whole = quality.features(text)
    monkeypatch.setattr(quality, "PART", 1000)
    k = len(quality.CLASSES) + 1
    w = 6001
    assert np.allclose(whole[k + 4:k + 7], [3 / w, np.log1p(3) / np.log(w + 1.5), 4000 / w])
    assert np.allclose(quality.features(text)[k + 4:k + 7], whole[k + 4:k + 7])


# ---- toxicity

def toxic_corpus():
    rng = random.Random(7)
    calm = ["meeting", "garden", "river", "bread", "window", "music", "letter", "harbour", "table", "lamp"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(calm) for _ in range(rng.randint(5, 40))]
        toxic = rng.random() < 0.3
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(["vile", "scum"]))
        # the label goes with a group's name in the sample, as in real data
        if rng.random() < (0.6 if toxic else 0.05):
            words.insert(rng.randint(0, len(words)), "muslims")
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_swapping_identity_terms_lowers_their_weight(spark):
    rows, labels = toxic_corpus()
    docs, marks = spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(labels, "doc_id int, toxic int")
    sample, share = toxicity.labelled_sample(docs, marks, lambda i: i >= 0, "doc_id", "text", "toxic", 1000)
    plain = toxicity.learn(sample, share, pairing=0.0)
    fair = toxicity.learn(sample, share, pairing=20.0)
    assert plain["muslims"] > 0.5 > 0.2 > abs(fair.get("muslims", 0))
    spared = frozenset(t for f in toxicity.IDENTITY_TERMS for t in f)
    rate = lambda t, w: toxicity.score(t, w, frozenset(k for k in w if k), spared)
    neutral = "the muslims of the harbour bring bread to the meeting"
    added = lambda w: rate(neutral, w) / rate(neutral.replace("muslims", "people"), w)
    assert added(fair) < 1.05 < 2 < added(plain) and rate(neutral, fair) < 0.3 < rate("a vile letter", fair)


def test_swaps():
    got = toxicity.swaps("Women sat. Men and women stood! Nobody", [("women", "men")])
    assert got == {("women", "men"): 0.5, ("women", ""): 1.5, ("men", ""): 1.0}


def test_marks():
    assert toxicity.marks_of("abcdef abcdxy, abcd Muslims", frozenset({"muslims"})) == {"abcdef", "abcdxy", "abcd", "muslims", "abcd-", "abcd--"}


def test_toxicity_edges(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows + [(1000, None), (1001, ""), (None, "vile scum"), (1002, "calm " * 400_000 + "vile"), rows[0]], "doc_id int, text string").withColumn("score", F.lit("clash")).withColumn("y", F.lit(1))
    marks = spark.createDataFrame(labels + [(0, None), (77777, 1), (None, 1), labels[1]], "doc_id int, toxic int")
    out = toxicity.toxicity_scores(docs, marks, lambda i: i >= 0)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in out.collect()}
    assert out.count() == docs.count() and out.columns == ["doc_id", "text", "y", "score", "predicted"]
    assert got[None][1] == got[1002][1] == 1 and got[1000] == got[1001] and got[1000][1] == 0
    assert all(p == int(s >= 0.3) and 0 <= s <= 1 for s, p in got.values())
    assert toxicity.toxicity_scores(docs.limit(0), marks, lambda i: i >= 0).collect() == []
    assert toxicity.toxicity_scores(docs, marks.where("toxic = 0"), lambda i: i >= 0).where("predicted = 1").count() == 0


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").where("toxic is not null")
    rows = Q.QUERIES["op6_toxicity"](spark, d).where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted")).collect()
    rate = {r[0]: r[1] for r in rows}
    assert rate[1] > 0.85 and rate[0] < 0.02


def test_language_of_marks_alone_and_clashing_names(spark):
    rows = [(1, "der die das und", "de"), (2, "the and of to", "en"), (3, "\u0301\u0302 \u0300", None), (4, "12 \u0308!", None), (5, "e\u0301t\u00e9", None), (6, "", None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("_found", F.lit(1)).withColumn("_FOUND_", F.lit(2))
    got = {r.doc_id: r for r in langid.language_of_documents(df, F.lit(True)).collect()}
    assert {i: got[i].lang_pred for i in (1, 2, 3, 4, 6)} == {1: "de", 2: "en", 3: "und", 4: "und", 6: "und"}
    assert got[3].score == 0 and got[5].lang_pred != "und" and got[1]._found == 1
