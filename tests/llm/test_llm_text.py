"""Decontamination, piece codec and embedding near-duplicates against brute force; the pipeline's stages."""

import math
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import decontaminate as dc
from riskspark.llm.embed_dedup import embedding_near_duplicates
from riskspark.llm.pieces import SPACE, Codec, PieceColumns, Vocabulary, encode_documents
from riskspark.llm.queries import PIECES

# ---- greedy string tiling


def brute_tile(doc, item, least):
    """Wise's algorithm without hashing: all maximal matches of unmarked tokens, longest first."""
    dmark, imark, tiles = [x == 0 for x in doc], [x == 0 for x in item], []
    while True:
        best = 0
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not dmark[i + k] and not imark[j + k]:
                    k += 1
                best = max(best, k)
        if best < least:
            return tiles
        for i in range(len(doc) - best + 1):
            for j in range(len(item) - best + 1):
                if all(doc[i + k] == item[j + k] and not dmark[i + k] and not imark[j + k] for k in range(best)):
                    for k in range(best):
                        dmark[i + k] = imark[j + k] = True
                    tiles.append((i, j, best))


@pytest.mark.parametrize("seed", range(25))
def test_tiles(seed):
    rng = random.Random(seed)
    alphabet = rng.choice([2, 3, 8, 30])
    item = [rng.randint(1, alphabet) for _ in range(rng.randint(1, 30))]
    doc = []
    while len(doc) < 60:
        doc += item[(a := rng.randint(0, len(item) - 1)):a + rng.randint(1, 12)] if rng.random() < 0.6 else [rng.randint(0, alphabet)]
    got = dc.tile(np.array(doc, np.int32), np.array(item, np.int32), 3)
    assert sorted(got) == sorted(brute_tile(doc, item, 3))


ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def test_benchmark_overlaps(spark):
    w = ITEM.split()
    docs = {1: f"before it {ITEM} after it", 2: " ".join(w[8:] + ["and"] + w[:8]), 3: " ".join(w[:10]), 4: ITEM.upper().replace(" ", ",\n"), 5: None, 6: "", 7: "nothing of it",
            8: "tiny item", 9: " ".join(reversed(w)), 10: "pad " * 300_000 + ITEM, 11: f"{ITEM} {ITEM}", 12: " ".join(w[:13]), 13: " ".join(w[:12])}
    bench = [(1, ITEM), (1, ITEM), (2, "tiny item"), (3, None), (4, ""), (5, "!?"), (None, "nothing of")]
    d = spark.createDataFrame([*docs.items(), (1, docs[1])], "doc_id int, text string").withColumn("item_id", F.lit("clash")).withColumn("d", F.lit(1))
    b = spark.createDataFrame(bench, "item_id int, text string")
    for block in (32 << 20, 40):
        got = sorted((r["doc_id"], r["item_id"] or 0, r["covered"], r["n_tiles"]) for r in dc.benchmark_overlaps(d, b, block_bytes=block).collect())
        assert got == [(1, 1, 16, 1), (1, 1, 16, 1), (2, 1, 16, 2), (4, 1, 16, 1), (7, 0, 2, 1), (8, 2, 2, 1), (10, 1, 16, 1), (11, 1, 16, 1), (12, 1, 13, 1)]
    r = dc.benchmark_overlaps(d.where("doc_id = 2"), b).first()
    assert (r["doc_at"], r["item_at"], r["lengths"], r["coverage"], r["longest"]) == ([0, 9], [8, 0], [8, 8], 1.0, 8)
    assert sorted(r["doc_id"] for r in dc.drop_contaminated(d, b).collect()) == [3, 5, 6, 9, 13]
    assert dc.benchmark_overlaps(d, b.limit(0)).collect() == [] and dc.benchmark_overlaps(d.limit(0), b).collect() == []


def test_whole_benchmark(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    words = lambda t: [x for p in dc.tokens(t) for x in p]
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        doc = words(r["text"])
        five = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
        for k, item in items.items():
            hits = [tuple(item[j:j + 5]) in five for j in range(len(item) - 4)]
            reach = sum(any(hits[max(0, j - 4):j + 1]) for j in range(len(item)))
            if reach >= 0.8 * len(item):
                code = {x: n + 1 for n, x in enumerate(set(item))}
                if sum(t[2] for t in brute_tile([code.get(x, 0) for x in doc], [code[x] for x in item], 5)) >= 0.8 * len(item):
                    want.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in dc.benchmark_overlaps(docs, bench).collect()}
    assert got == want and want


# ---- pieces

def test_contaminated_rows_go_whatever_their_ids(spark):
    item = "what is the capital city of the old kingdom by the sea"
    rows = [(1, f"intro {item} outro", "a"), (1, "a clean text with this id", "b"), (None, item, "c"), (None, "clean without an id", "d"), (2, None, "e"), (3, "", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(5, item), (6, None), (7, "")], "item_id long, text string")
    for size in (32 << 20, 10):
        got = dc.drop_contaminated(df, bench, block_bytes=size)
        assert got.schema == df.schema and sorted(r.item_id for r in got.collect()) == ["b", "d", "e", "f"]
    assert dc.drop_contaminated(df, bench.limit(0)).count() == 6 and dc.drop_contaminated(df.limit(0), bench).collect() == []


def brute_viterbi(vocab, text):
    """Best score over all segmentations, a character without a piece of its own as bytes."""
    score = {p: s for p, s, ok in zip(vocab.pieces, vocab.scores, vocab.usable) if ok}
    low = min(score.values()) - 10
    best = [(0.0, ())]
    for i in range(1, len(text) + 1):
        options = []
        for j in range(max(0, i - 16), i):
            if text[j:i] in score:
                options.append((best[j][0] + score[text[j:i]], i - j, best[j][1] + (text[j:i],)))
        if text[i - 1] not in score:
            options.append((best[i - 1][0] + low, 0, best[i - 1][1] + tuple(f"<0x{b:02X}>" for b in text[i - 1].encode())))
        s, _, path = max(options, key=lambda o: (o[0], o[1]))
        best.append((s, path))
    return list(best[-1][1])


TEXTS = ["Hello world", "  two  spaces \n\n lines\t", "", "naïve café 日本語 😀", "a", " ", "▁", "x▁y ▁ z", "\n", "▁▁▁", "antidisestablishmentarianism", "The quick brown fox", "﷐ \u0000 ", "0 1 2<s></s><0x41><unk>"]


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary.read(PIECES)


def decoded(codec, ids):
    return codec.decode(np.array(ids, np.int32), np.array([0, len(ids)]))[0]


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_against_brute_force(vocab, text):
    codec = Codec(vocab)
    ids = np.frombuffer(codec.encode(text), np.int32).tolist()
    plain = SPACE + text.replace(SPACE, "").replace(" ", SPACE) if text else ""
    want = [p for p in brute_viterbi(vocab, plain)] if text else []
    own = [f"<0x{b:02X}>" for b in "".encode()]
    got = [vocab.pieces[i] for i in ids]
    # the private character of the brute force stands for a U+2581 of the text
    for k in range(len(want) - len(own) + 1):
        if want[k:k + 3] == own:
            want[k:k + 3] = [f"<0x{b:02X}>" for b in SPACE.encode()]
    assert got == want and decoded(codec, ids) == text


def test_units_split_like_the_whole(vocab):
    rng = random.Random(9)
    codec, whole = Codec(vocab), Codec(vocab)
    whole.units = None
    for _ in range(200):
        text = "".join(rng.choice("aebnst  \nThéß日.") for _ in range(rng.randint(1, 60)))
        assert codec.encode(text) == whole.encode(text)
        assert decoded(codec, np.frombuffer(codec.encode(text), np.int32)) == text


def test_pieces_score_at_least_the_librarys(vocab):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = Codec(vocab)
    for text in ("The quick brown fox jumps over the lazy dog", "unbelievable misunderstandings everywhere"):
        mine = sum(vocab.scores[i] for i in np.frombuffer(codec.encode(text), np.int32))
        assert mine >= sum(vocab.scores[i] for i in sp.encode(text))


def test_vocabulary_without_bytes_or_pieces():
    v = Vocabulary(("<unk>", "a", "ab", SPACE), (0.0, -1.0, -1.5, -1.0), (False, True, True, True))
    assert np.frombuffer(Codec(v).encode("abqa"), np.int32).tolist() == [3, 2, 0, 1]
    assert np.frombuffer(Codec(Vocabulary((), (), ())).encode("ab"), np.int32).tolist() == [0, 0, 0]


def test_cache_is_bounded(vocab):
    codec = Codec(vocab, cache_size=5)
    a = [codec.encode(f"word{i} again") for i in range(50)]
    assert len(codec.young) <= 5 and len(codec.old) <= 5 and a == [Codec(vocab).encode(f"word{i} again") for i in range(50)]


def test_encode_documents(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None, TEXTS[0], "long " * 100_000])], "doc_id int, text string").withColumn("ids", F.lit("clash"))
    pieces = PieceColumns(spark, PIECES)
    out = encode_documents(df, pieces)
    rows = out.select("*", pieces.decode(F.col("ids")).alias("back")).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r["back"] == r["text"] and r["n_tokens"] == len(r["ids"] or []) and (r["ids"] is None) == (r["text"] is None)
    assert encode_documents(df.limit(0), pieces).collect() == []


# ---- embeddings

def brute_links(rows, cosine):
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)

    n = len(rows)
    links = [[] for _ in range(n)]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v) else None for _, v, _ in rows]
    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a].append(b)
                links[b].append(a)
    comp = [None] * n
    for a in range(n):
        if comp[a] is None:
            todo, seen = [a], {a}
            while todo:
                for y in links[todo.pop()]:
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            low = min(rows[x][0] for x in seen)
            for x in seen:
                comp[x] = low
    return sorted((rows[a][0], len(links[a]), comp[a], rows[a][0] == comp[a]) for a in range(n))


def vectors(seed=1, dim=16):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            base = rng.normal(size=dim)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((i, (base + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 0.15])).tolist(), label))
                i += 1
    hub = rng.normal(size=dim)
    rows += [(i + k, (hub + rng.normal(size=dim) * 0.05).tolist(), 1) for k in range(90)]
    i += 90
    odd = [None, [], [0.0] * dim, [1.0] * (dim - 1) + [None], [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [1e200] + [0.0] * (dim - 1), [1e-200] + [0.0] * (dim - 1), [-0.0, 1.0] + [0.0] * (dim - 2),
           [0.0, 2.0] + [0.0] * (dim - 2), [1.0, 0.0], [1.0, 0.05], [3.0], [5.0], [-2.0]]
    rows += [(i + k, v, 1) for k, v in enumerate(odd)]
    return rows


@pytest.mark.parametrize("cell_rows,blocks,dims", [(2048, 8, 3), (7, 8, 2), (30, 4, 1), (2048, 40, 4)])
def test_embeddings(spark, cell_rows, blocks, dims):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("node", F.lit(0)).withColumn("n_links", F.lit("clash"))
    got = sorted(tuple(r) for r in embedding_near_duplicates(df, cell_rows=cell_rows, blocks=blocks, grid_dims=dims).collect())
    safe = [(i, None if v is None else [x if x is None or abs(x) < 1e100 or x != x or x == float("inf") else 1.0 for x in v], k) for i, v, k in rows]
    safe = [(i, None if v is None else [x if x is None or x != x or x == 0 or abs(x) > 1e-100 else 1.0 for x in v], k) for i, v, k in safe]
    assert got == brute_links(safe, 0.98)


def test_embeddings_without_labels_copies_and_empty(spark):
    rows = [(5, [1.0, 0.0], None)] * 1 + [(6, [2.0, 0.0], 1), (7, [2.0, 0.0], 1), (7, [2.0, 0.0], 1), (8, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int")
    assert sorted(tuple(r) for r in embedding_near_duplicates(df).collect()) == [(5, 0, 5, True), (6, 2, 6, True), (7, 2, 6, False), (7, 2, 6, False), (8, 0, 8, True)]
    assert sorted(tuple(r)[:3] for r in embedding_near_duplicates(df, label_col=None).collect()) == [(5, 3, 5), (6, 3, 5), (7, 3, 5), (7, 3, 5), (8, 0, 8)]
    assert embedding_near_duplicates(df.limit(0)).collect() == []


# ---- pipeline

def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns and out.dtypes == docs.dtypes, name
        docs = out.checkpoint()
        n = docs.count()
        assert 0 < n <= seen and docs.select("doc_id").distinct().count() == n
        seen = n
    assert docs.where("n_chars <> length(text)").count() == 0
    last = corpus_pipeline.run(spark, sf)
    assert last.count() == seen and last.columns == [*columns, "ids", "n_tokens"]


def test_pipeline_on_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "a line\nand another line of it\nand a third one", None, "b", 46), (3, "trash idiot scum loser moron stupid", "en", "c", 35)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert stage(spark, docs.limit(0), sf).collect() == []
        docs = out
    assert {r["doc_id"] for r in docs.collect()} >= {1, 2}
