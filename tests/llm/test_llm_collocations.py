"""Phrase collocations against the definition, with maps that say yes too often and shards that hold little."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm.collocations import Grams, Words, collocations, frequent_phrases, tokens

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)) if w]


def counts(rows, longest=5):
    f = defaultdict(Counter)
    for _, text, lang in rows:
        for w in pieces(text):
            for n in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return f


def by_hand(rows, floor, top=2000, longest=5):
    out = []
    for lang, f in counts(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= floor}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def found(spark, rows, floor, top=2000, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, collocations(df, min_count=floor, top=top, **kw).collect()))


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["a", "bb", "C", "é", "ÖL", " ", "x\x00y", "d\x1ce", "ff", "g"]
    said = ["the end of the line", "A a a a", "one, two; three", "é ÖL bb ff g"]
    out = []
    for i in range(n):
        t = []
        for _ in range(rng.randrange(1, 30)):
            t.append(rng.choice(said) if rng.random() < 0.2 else rng.choice(words))
            t.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]))
        out.append((i, "".join(t), rng.choice(["en", "de", None, "en"])))
    return out


def test_tokens_of_the_contract():
    text = "Ab\tC d.E,f;g:h!i?j\nk\x0bl\x0cm\rn\x00o \x1c\x85p  Ä..  .z"
    got, piece = [], []
    for w in [*tokens(text.encode()), b"."]:
        if w == b".":
            got += [piece] if piece else []
            piece = []
        else:
            piece.append(w.decode())
    assert got == pieces(text)


def test_against_the_definition(spark):
    rows = corpus(150, 1)
    want = by_hand(rows, 4)
    assert len(want) > 50
    assert found(spark, rows, 4) == want


def test_counts_do_not_depend_on_the_map_or_the_shards(spark):
    rows = corpus(60, 2)
    want = by_hand(rows, 3, top=15)
    # 64 bits say yes to nearly every phrase
    for kw in ({"size_log2": 6, "shards": 3}, {"shards": 1}, {"shards": 7, "size_log2": 8}):
        assert found(spark, rows, 3, top=15, **kw) == want


def test_late_phrases_complete_their_round(spark):
    # every phrase reaches the threshold with its very last occurrence only
    rows = [(i, "p q r s t", "en") for i in range(8)] + [(100 + i, f"w{i}", "en") for i in range(20)]
    assert found(spark, rows, 8) == by_hand(rows, 8) == [("en", 1, "p q r s t", 8, 8, 8, 60, 7500)]


def test_nulls_empty_texts_long_texts_and_clashing_names(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \t\n.,", "xx"), (None, "u v " * 5000, "en"), (5, "u v", None), (5, "u v", None), (6, "." * 70000 + "é é é", "en")]
    assert found(spark, rows, 2) == by_hand(rows, 2)
    assert found(spark, [], 2) == []
    assert found(spark, [(1, None, None)], 1) == []
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("key", "c", "n", "phrase", "shard", "words", "since", "mask", "a", "k"):
        df = df.withColumn(c, F.lit("x"))
    assert sorted(map(tuple, collocations(df, min_count=2).collect())) == by_hand(rows, 2)


def test_exact_beyond_64_bits(spark):
    from riskspark.llm import collocations as module
    big = [("en", "", 0, 9 * 10 ** 12), ("en", "x", 1, 10 ** 12), ("en", "y", 1, 10 ** 12 + 7), ("en", "x y", 2, 10 ** 12 - 1)]
    table = spark.createDataFrame(big, "lang string, phrase string, words int, n long")
    held, module.frequent_phrases = module.frequent_phrases, lambda *a: table
    try:
        row = module.collocations(table).first()
    finally:
        module.frequent_phrases = held
    assert row.score == 1000 * (10 ** 12 - 1) * 9 * 10 ** 12 // (10 ** 12 * (10 ** 12 + 7))


def test_frequent_phrases_are_all_there(spark):
    rows = corpus(80, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in frequent_phrases(df, min_count=5).collect() if r.words}
    assert got == {(lang, p): c for lang, f in counts(rows).items() for p, c in f.items() if c >= 5}


def test_keys_depend_on_words_only():
    words = Words()
    codes = np.array([words[w] for w in tokens(b"a b c. a b c")], np.uint64)
    g = Grams(codes, "en")
    assert g.valid(3).tolist() == [True, False, False, False, True]
    assert g.keys(3)[0] == g.keys(3)[4] and g.keys(2)[1] == g.keys(2)[5] and g.keys(2)[0] != g.keys(2)[1]
    assert Grams(codes, "de").keys(3)[0] != g.keys(3)[0]


def test_runs_are_hashed_as_their_tokens(monkeypatch):
    from riskspark.llm import collocations as module
    asked, plain = [], module.codes_of
    monkeypatch.setattr(module, "codes_of", lambda words: asked.extend(words) or plain(words))
    rows = corpus(40, 4) + [(40, "", "en"), (41, " \t", "en"), (42, "..", "en"), (43, "x\u00a0y \x1c \x85", "en")]
    texts = [t.encode() for _, t, _ in rows]
    got = module.hashed(texts, Words())
    # each word of the run once, not once an occurrence
    assert len(asked) == len(set(asked)) < np.count_nonzero(got)
    words = Words()
    assert got.tolist() == [words[w] for t in texts for w in [*tokens(t), b"."]]
    assert module.hashed([b""], Words()).tolist() == [0]


def test_rows_of_a_shard_name_and_count_their_words(monkeypatch):
    import pyarrow as pa

    from riskspark.llm import collocations as module
    # small rows, and a memory that forgets most words
    monkeypatch.setattr(module, "ROW_BYTES", 64)
    monkeypatch.setattr(module, "KNOWN_WORDS", 3)
    rows = [(i, t, lang or "und") for i, t, lang in corpus(60, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array([lang for *_, lang in rows]), pa.array([t.encode() for _, t, _ in rows], pa.binary())], names=["lang", "text"])
    out = pa.Table.from_batches(module.coded([batch])).to_pylist()
    found = counts(rows, 1)
    sizes = Counter()
    for r in out:
        sizes[r["lang"]] += r["size"]
        new = r["new"].split()
        assert np.frombuffer(r["low"], np.uint32).tolist() == module.codes_of(new).astype(np.uint32).tolist()
    assert sizes == {lang: sum(f.values()) for lang, f in found.items()}
    assert {w for r in out for w in r["new"].split()} == {w.encode() for f in found.values() for w, in f}
