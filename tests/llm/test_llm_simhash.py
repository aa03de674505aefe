"""SimHash fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm.common import bucket_cells, components, sorted_groups
from riskspark.llm.simhash import block_masks, fingerprint, fingerprint_links, keep_one_per_component, near_stars, simhash_near_duplicates


def brute_print(text, k=3):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, distance=3):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


TEXTS = ["The quick brown fox jumps over", "the QUICK brown fox jumps over", "a", "a b", "a b c", "ÄÖ x\ty\u00a0z\x0bq", "", " \n\t", None, "w " * 5000, "İstanbul Ünïcode ß"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint(None if text is None else text.encode()) & (1 << 64) - 1 == brute_print(text)


def test_fingerprint_of_a_text_read_in_parts():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(4000))
    import riskspark.llm.simhash as m
    whole = fingerprint(text.encode())
    part, m.word_parts.__defaults__ = m.word_parts.__defaults__, (97,)
    try:
        assert fingerprint(text.encode()) == whole
    finally:
        m.word_parts.__defaults__ = part


def test_shingle_hash_is_sparks(spark):
    s = "ab cd ef"
    assert spark.range(1).select(F.xxhash64(F.lit(s))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(s.encode(), 42)


def test_masks_cover_every_close_pair():
    masks = [m % (1 << 64) for m in block_masks(6, 3)]
    rng = random.Random(2)
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 3):
            y ^= 1 << b
        assert any(x & m == y & m for m in masks)


def chains(n=300, seed=3):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            out.add(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    return sorted(out)[:n]


@pytest.mark.parametrize("cell_rows", [2048, 3])
def test_links_connect_what_brute_force_connects(spark, cell_rows):
    fps = chains()
    # one crowded bucket: many fingerprints around one, which the small cells have to split
    hub = 0x0123456789ABCDEF
    fps += [hub ^ (1 << b) for b in range(40)]
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, 6, cell_rows).collect()
    assert len(links) < 20 * len(fps)
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame([(r["u"], r["v"]) for r in links], "u long, v long")).collect()}
    want = brute_components(fps)
    got = [roots.get(x, x) for x in signed]
    assert len({*zip(want, got)}) == len({*want}) == len({*got})


def test_query_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (4, base.upper()), (7, base), (7, base), (5, None), (3, ""), (2, "\n"), (8, "other words here now"), (None, base), (None, "nobody else says this")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).withColumn("fp", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted((r["doc_id"] or -1, r["fingerprint"], -1 if r["component_id"] is None else r["component_id"]) for r in simhash_near_duplicates(df).collect())
    prints = [brute_print(t) for _, t in rows]
    comp = brute_components(prints)
    low = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            low[c] = min(low.get(c, 99), i)
    assert got == sorted((i or -1, f"{p:016x}", low.get(c, -1)) for (i, _), p, c in zip(rows, prints, comp))
    kept = [r["doc_id"] for r in keep_one_per_component(df).collect()]
    assert sorted(x for x in kept if x) == [2, 4, 8] and kept.count(None) == 1
    assert simhash_near_duplicates(df.limit(0)).collect() == []


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_print(r["text"]) for r in rows]
    comp = brute_components(prints)
    want = {r["doc_id"]: (f"{p:016x}", rows[c]["doc_id"]) for r, p, c in zip(rows, prints, comp)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_near_duplicates(docs).collect()}
    assert got == want


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, x) for x in range(1001, 1100)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{x: 1000 for x in range(1000, 1100)}, **{2000 + i: 2000 for i in range(9)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_cells_hold_every_pair_once(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), "id")
    cells = bucket_cells(df, ["g"], "id", 4).collect()
    seen = {}
    by = {}
    for r in cells:
        by.setdefault((r["g"], r["_a"], r["_b"]), []).append((r["id"], r["_s"]))
    for (g, a, b), members in by.items():
        for i, (x, s) in enumerate(members):
            for y, t in members[:i]:
                if a == b or s != t:
                    seen[g, min(x, y), max(x, y)] = seen.get((g, min(x, y), max(x, y)), 0) + 1
    assert set(seen.values()) == {1}
    assert len(seen) == sum(n * (n - 1) // 2 for n in (17, 17, 16))


def test_sorted_groups_span_batches():
    import pyarrow as pa
    k = np.array([1, 1, 2, 2, 2, 3, 5, 5])
    batches = [pa.RecordBatch.from_arrays([pa.array(k[a:b]), pa.array(np.arange(a, b))], names=["k", "v"]) for a, b in ((0, 0), (0, 3), (3, 4), (4, 6), (6, 8))]
    assert [(g["k"][0], g["v"].tolist()) for g in sorted_groups(batches, ["k"])] == [(1, [0, 1]), (2, [2, 3, 4]), (3, [5]), (5, [6, 7])]


def test_near_stars_chain():
    fp = np.array([0, 7, 63, 1 << 40, 63 | 7 << 20], np.int64)
    assert sorted(zip(*near_stars(fp, 3))) == [(0, 1), (0, 2), (0, 3), (0, 4)]


def test_one_row_of_each_group_by_row_not_by_id(spark):
    a, b = "one two three four five six", "clean words of another kind entirely"
    rows = [(3, a, "p"), (7, a, "q"), (7, b, "r"), (None, a, "s"), (9, b, "t"), (9, b, "u"), (None, "lone text", "v"), (None, "lone text", "w"), (5, None, "x"), (6, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    got = keep_one_per_component(df).collect()
    assert df.columns == list(got[0].asDict())
    kept = sorted((r.doc_id, r.text) for r in got if r.doc_id is not None)
    assert kept == [(3, a), (5, None), (7, b)] and [r.text for r in got if r.doc_id is None] == ["lone text"]


def test_kept_rows_against_all_pairs(spark):
    rng = random.Random(11)
    base = [[rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(40)) for _ in range(80)] for _ in range(12)]
    rows = []
    for i in range(90):
        words = list(rng.choice(base))
        if rng.random() < 0.5:
            words[rng.randrange(80)] = "changed"
        rows.append((rng.choice([i, i, i % 10, None]), " ".join(words)))
    root = brute_components([brute_print(t) for _, t in rows])
    got = [(r.doc_id, r.text) for r in keep_one_per_component(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == len(set(root))
    for c in set(root):
        group = [r for r, k in zip(rows, root) if k == c]
        low = min((r[0] is None, r[0] or 0) for r in group)
        assert sum(g in group and (g[0] is None, g[0] or 0) == low for g in got) >= 1
