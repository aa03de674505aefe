"""Properties of the operators on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from riskspark.operators import features as fx
from riskspark.operators import joins as jn
from riskspark.operators import metrics as mx
from riskspark.operators import split as sp
from riskspark.operators import text as tx
from riskspark.plans.frames import scored
from riskspark.sources.io import table


def test_auc_symmetry_and_monotone_invariance(spark, sf):
    s = scored(spark, sf)
    a = mx.ranking_metrics(s, "p_raw").first().auc
    b = mx.ranking_metrics(s.withColumn("q", 1 - F.col("p_raw")), "q").first().auc
    c = mx.ranking_metrics(s, "p").first().auc  # p = p_raw^2, monotone
    assert abs(a + b - 1) < 2e-6 and abs(a - c) < 1e-9


def test_prefix_sums_match_global_window(spark, sf):
    from pyspark.sql import Window
    s = scored(spark, sf)
    c = mx.score_cdf(s, "p", "y", ["grp"], n_buckets=16).select("grp", "s", "cpos", "cneg")
    g = s.groupBy("grp", F.col("p").alias("s")).agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    w = Window.partitionBy("grp").orderBy("s")
    g = g.select("grp", "s", F.sum("pos").over(w).alias("cpos"), F.sum("neg").over(w).alias("cneg"))
    assert c.exceptAll(g).count() == 0 and g.exceptAll(c).count() == 0


def test_stratified_split_disjoint_and_complete(spark, sf):
    s = scored(spark, sf, with_group=False)
    out = sp.stratified_split(s.select("id", "y"), ["y"], "id")
    assert out.count() == s.count() and out.select("id").distinct().count() == s.count()


def test_entity_split_has_no_contamination(spark, sf):
    from riskspark.operators import audit as au
    s = sp.entity_split(scored(spark, sf, with_group=False), "entity")
    assert au.entity_contamination(s, "entity", "split").first().status == "PASS"
    r = sp.row_split(scored(spark, sf, with_group=False), "id")
    assert au.entity_contamination(r, "entity", "split").first().status == "FAIL"


def test_left_joins_preserve_base_rows(spark, sf):
    f = fx.applicant_features(table(spark, sf, "customer"), table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    assert f.count() == table(spark, sf, "customer").count()


def test_top_n_per_key_matches_plain_window(spark, sf):
    from pyspark.sql import Window
    e = table(spark, sf, "events")
    a = jn.top_n_per_key(e, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 5, salts=4, tiebreak=["event_id"]).select("user_id", "event_id", "rn")
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    b = e.withColumn("rn", F.row_number().over(w)).where("rn <= 5").select("user_id", "event_id", "rn")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_asof_matches_bruteforce(spark, sf):
    e = table(spark, sf, "events")
    f = e.where(F.col("event_type") == "view").select("user_id", "ts", "value")
    d = e.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    got = jn.asof_fill(f, d, "user_id", "ts", "value", bucket_micros=3_600_000_000).select("event_id", "asof_value")
    fj = f.select(F.col("user_id").alias("u"), F.col("ts").alias("fts"), "value")
    brute = d.join(fj, (d.user_id == fj.u) & (fj.fts <= d.ts), "left").groupBy("event_id") \
             .agg(F.max_by("value", F.struct("fts", "value")).alias("asof_value"))
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0


def test_chunks_cover_whole_documents(spark, sf):
    docs = table(spark, sf, "documents")
    c = tx.chunk_documents(docs, paragraph_sep=r"\n")
    # the overlap counts in the chunk; only a paragraph that is too long by itself goes beyond the limit
    longest = F.array_max(F.transform(F.split("text", r"\n"), lambda p: F.size(F.filter(F.split(p, r"\s+"), lambda x: x != ""))))
    over = c.where(F.col("token_count") > tx.MAX_WORDS).join(docs.select("doc_id", longest.alias("longest")), "doc_id")
    assert over.where(F.col("longest") + tx.OVERLAP < F.col("token_count")).count() == 0
    # words per document without overlaps == words in the document
    assert c.where((F.col("chunk_no") == 0) & (F.col("overlap_words") > 0)).count() == 0
    w = c.withColumn("own", F.col("token_count") - F.col("overlap_words"))
    per = w.groupBy("doc_id").agg(F.sum("own").alias("n"))
    ref = docs.select("doc_id", F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("n"))
    bad = per.join(ref, "doc_id").where(per.n != ref.n)
    assert bad.count() == 0


def test_chunks_by_hand(spark):
    """Overflow closes a chunk, the overlap counts in the next one, long paragraphs stay whole, headings label."""
    words = lambda n, w: " ".join([w] * n)
    rows = [(1, "# One\n\n" + words(60, "a") + "\n\n" + words(50, "b") + "\n\n\n## Two\n\n" + words(90, "c") + "\n\n" + words(130, "d")), (2, None), (3, " \n\n "), (4, words(130, "e"))]
    c = tx.chunk_documents(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id", "chunk_no").collect()
    got = [(r.doc_id, r.chunk_no, r.section, r.token_count, r.overlap_words) for r in c]
    assert got == [(1, 0, "One", 114, 0), (1, 1, "Two", 115, 25), (1, 2, "Two", 155, 25), (4, 0, "Introduction", 130, 0)]
    assert c[1].text.split() == ["b"] * 23 + ["##", "Two"] + ["c"] * 90


def test_bm25_top1_contains_benchmark_passage(spark, sf):
    from riskspark.plans import q_text
    r = q_text.ranked(spark, sf, q_text.bench_queries(spark, sf)).where("rank = 1")
    assert r.count() == table(spark, sf, "benchmark").count()


def test_grouped_platt_matches_mllib_per_group(spark, sf):
    from riskspark.operators import models as md
    s = scored(spark, sf, with_group=False).withColumn("period", F.year("ts").cast("int"))
    theta = {r.period: (r.a, r.b) for r in md.grouped_platt(s, "period", "p_raw", "y").collect()}
    for period in sorted(theta)[:2]:
        a, b = md.fit_platt(s.where(F.col("period") == period), "p_raw")
        assert abs(theta[period][0] - a) < 1e-3 and abs(theta[period][1] - b) < 1e-3


def test_threshold_top_k_equals_plain_ranking(spark, sf):
    from pyspark.sql import Window
    from riskspark.plans import q_text
    sc = q_text.scores(spark, sf, q_text.bench_queries(spark, sf)).withColumn("score", F.round("score", 9))
    got = tx.top_k(sc, "qid", q_text.KEYS, 5).select("qid", "doc_id", "start", "rank")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "doc_id", "start")
    ref = sc.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("qid", "doc_id", "start", "rank")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_leak_frame_columns_match_oracle_list(spark, sf):
    from riskspark.plans.frames import leak_frame
    from riskspark.plans.q_audit import LEAK_COLS
    assert leak_frame(spark, sf).columns == LEAK_COLS
