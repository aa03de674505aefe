"""Retrieval queries over ``documents`` with ``benchmark`` items and user turns of
``conversations`` as queries (TXT-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import text as tx
from riskspark.plans.catalog import register
from riskspark.session import cut_lineage
from riskspark.sources.io import table

K = 5
KEYS = ["doc_id", "start"]
TOK = "list_filter(string_split_regex(lower(trim({c})), '\\s+'), lambda x: x <> '')"
WIN_SQL = f"""
t AS (SELECT doc_id, {TOK.format(c='text')} AS tk FROM documents),
kk AS (SELECT doc_id, tk, CASE WHEN len(tk) <= 120 THEN 1 ELSE CAST(ceil((len(tk) - 120) / 95.0) AS INTEGER) + 1 END AS k FROM t),
w AS (SELECT doc_id, tk, unnest(range(0, (k - 1) * 95 + 1, 95)) AS start FROM kk),
win AS MATERIALIZED (SELECT doc_id, CAST(start AS INTEGER) AS start, tk[start + 1 : start + 120] AS tokens FROM w)"""
INDEX_SQL = f"""{WIN_SQL},
post AS MATERIALIZED (SELECT doc_id, start, token, count(*) AS tf FROM (SELECT doc_id, start, unnest(tokens) AS token FROM win) GROUP BY doc_id, start, token),
dl AS (SELECT doc_id, start, len(tokens) AS dl FROM win),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
dfs AS (SELECT token, count(*) AS df FROM post GROUP BY token),
ri AS (SELECT token, df, ln((n - df + 0.5) / (df + 0.5)) AS raw FROM dfs, st),
mi AS (SELECT avg(raw) AS mean_idf FROM ri),
terms AS (SELECT token, df, CASE WHEN raw < 0 THEN 0.25 * mean_idf ELSE raw END AS idf FROM ri, mi)"""


def score_sql(queries_sql: str) -> str:
    return f"""{INDEX_SQL},
qt AS (SELECT qid, token, count(*) AS qtf FROM (SELECT qid, unnest({TOK.format(c='text')}) AS token FROM ({queries_sql})) GROUP BY qid, token),
sc AS (SELECT qt.qid, post.doc_id, post.start, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
       FROM qt JOIN terms USING (token) JOIN post USING (token) JOIN dl USING (doc_id, start), st GROUP BY qt.qid, post.doc_id, post.start),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id, start) AS rank FROM sc)"""


BENCH_Q = "SELECT item_id AS qid, text FROM benchmark"


def index(spark, sf):
    """(postings, vocabulary) of the documents."""
    post = tx.postings(table(spark, sf, "documents"))
    return post, tx.vocabulary(post)


def bench_queries(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")


def scores(spark, sf, queries, best=None, by=None):
    post, terms = index(spark, sf)
    return tx.bm25_scores(tx.query_tokens(queries, "qid"), post, terms, "qid", KEYS, best, by)


def ranked(spark, sf, queries):
    # the exact top-k reads the blocks' best twice (bound, then ranking): written once
    return tx.top_k(cut_lineage(scores(spark, sf, queries, best=K)), "qid", KEYS, K)


def best_scores(spark, sf, queries):
    return scores(spark, sf, queries, best=1, by=[]).groupBy("qid").agg(F.max("score").alias("best"))


def chunk_sql(sep: str) -> str:
    """The packing rule as a recursive query over a document's paragraphs."""
    return f"""
WITH RECURSIVE p0 AS (SELECT doc_id, unnest(string_split_regex(text, '{sep}')) AS raw, generate_subscripts(string_split_regex(text, '{sep}'), 1) AS k FROM documents),
p1 AS (SELECT doc_id, k, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS para FROM p0),
par AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) AS INTEGER) AS i,
  CAST(len(list_filter(string_split_regex(para, '\\s+'), lambda x: x <> '')) AS INTEGER) AS n,
  CASE WHEN para LIKE '#%' THEN regexp_replace(regexp_replace(para, '^#+', ''), '^\\s+|\\s+$', '', 'g') END AS head FROM p1 WHERE para <> ''),
r AS (SELECT DISTINCT doc_id, 0 AS i, 0 AS buf, 0 AS pos, 0 AS over, 'Introduction' AS section, 'Introduction' AS label,
        false AS cl, 0 AS c_start, 0 AS c_len, 0 AS c_over, '' AS c_section FROM par
  UNION ALL SELECT r.doc_id, par.i, CASE WHEN buf > 0 AND buf + n > 120 THEN least(buf, 25) ELSE buf END + n, pos + n,
    CASE WHEN buf > 0 AND buf + n > 120 THEN least(buf, 25) ELSE over END, coalesce(head, section),
    CASE WHEN pos = 0 OR (buf > 0 AND buf + n > 120) THEN coalesce(head, section) ELSE label END,
    buf > 0 AND buf + n > 120, pos - buf, buf, over, label FROM r JOIN par ON par.doc_id = r.doc_id AND par.i = r.i + 1),
last AS (SELECT doc_id, max(i) AS i FROM par GROUP BY doc_id),
c AS (SELECT doc_id, i, c_start AS s, c_len AS n, c_over AS o, c_section AS section FROM r WHERE cl
  UNION ALL SELECT r.doc_id, r.i + 1, pos - buf, buf, over, label FROM r JOIN last USING (doc_id, i) WHERE buf > 0),
d AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c.i) - 1 AS INTEGER) AS chunk_no, section, n AS token_count, o AS overlap_words,
  md5(array_to_string(w[s + 1 : s + n], ' ')) AS text_md5 FROM c JOIN d USING (doc_id)"""


def chunk_rows(c):
    return c.select("doc_id", "chunk_no", "section", "token_count", "overlap_words", F.md5("text").alias("text_md5"))


@register("txt01_paragraph_chunks", chunk_sql("\\n{2,}"))
def q_txt01(spark, sf):
    """TXT-01: paragraphs (blank lines between them) packed into chunks of 120 words with 25 of overlap."""
    return chunk_rows(tx.chunk_documents(table(spark, sf, "documents")))


@register("txt01_line_chunks", chunk_sql("\\n"))
def q_txt01_lines(spark, sf):
    """TXT-01 with every line a paragraph, as the driver's documents have no blank lines."""
    return chunk_rows(tx.chunk_documents(table(spark, sf, "documents"), paragraph_sep=r"\n"))


@register("txt02_word_windows", f"WITH {WIN_SQL} SELECT doc_id, start, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM win")
def q_txt02(spark, sf):
    """TXT-02: 120-token windows every 95 tokens over whole documents."""
    w = tx.word_windows(table(spark, sf, "documents"))
    return w.select("doc_id", "start", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@register("txt03_inverted_index", f"WITH {INDEX_SQL} SELECT token, df, round(idf, 6) AS idf FROM terms")
def q_txt03(spark, sf):
    """TXT-03: vocabulary with document frequency and floored idf (from the postings)."""
    _, terms = index(spark, sf)
    return terms.select("token", "df", F.round("idf", 6).alias("idf"))


@register("txt04_bm25_topk", f"""WITH {score_sql(BENCH_Q)}
SELECT qid AS item_id, CAST(rank AS INTEGER) AS rank, doc_id, start, round(score, 6) AS score FROM r WHERE rank <= {K}""")
def q_txt04(spark, sf):
    """TXT-04: BM25 (k1 1.5, b 0.75) top 5 windows for every benchmark item at once."""
    r = ranked(spark, sf, bench_queries(spark, sf))
    return r.select(F.col("qid").alias("item_id"), "rank", "doc_id", "start", F.round("score", 6).alias("score"))


NORM_TAIL = """,
best AS (SELECT qid, max(score) AS best FROM sc GROUP BY qid),
seeds AS (SELECT best FROM best WHERE qid IN (SELECT item_id FROM benchmark ORDER BY item_id LIMIT 6)),
ce AS (SELECT CASE WHEN quantile_cont(best, 0.9) * 1.15 <= 0.5 THEN 1.0 ELSE quantile_cont(best, 0.9) * 1.15 END AS ceiling FROM seeds),
nb AS (SELECT qid, best, ceiling, least(best / ceiling, 1.0) AS normalised FROM best, ce)"""


@register("txt05_normalised_scores", f"""WITH {score_sql(BENCH_Q)}{NORM_TAIL}
SELECT qid AS item_id, round(best, 6) AS best, round(ceiling, 6) AS ceiling, round(normalised, 6) AS normalised,
  CAST(normalised < 0.25 AS INTEGER) AS abstain FROM nb""")
def q_txt05(spark, sf):
    """TXT-05: corpus ceiling from six seed queries, normalised top score and abstain flag."""
    q = bench_queries(spark, sf)
    best = cut_lineage(best_scores(spark, sf, q))
    seed_ids = q.select("qid").orderBy("qid").limit(6)
    n = tx.normalise(best, best.join(seed_ids, "qid", "left_semi"), "qid")
    return n.select(F.col("qid").alias("item_id"), *[F.round(c, 6).alias(c) for c in ("best", "ceiling", "normalised")], "abstain")


@register("txt06_corpus_stats", f"""WITH {WIN_SQL}
SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS n_chunks, round(avg(len(tokens)), 6) AS mean_tokens FROM win""")
def q_txt06(spark, sf):
    d = table(spark, sf, "documents")
    w = tx.word_windows(d)
    nd = d.agg(F.count(F.lit(1)).alias("n_docs")).withColumn("_k", F.lit(1))
    s = w.agg(F.count(F.lit(1)).alias("n_chunks"), F.round(F.avg(F.size("tokens")), 6).alias("mean_tokens")).withColumn("_k", F.lit(1))
    return nd.join(s, "_k").select("n_docs", "n_chunks", "mean_tokens")


@register("txt07_citations", f"""WITH {score_sql(BENCH_Q)}
SELECT qid AS item_id, string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(start AS VARCHAR), ',' ORDER BY rank) AS citations FROM r WHERE rank <= {K} GROUP BY qid""")
def q_txt07(spark, sf):
    """TXT-07: citation string per query from its (k-bounded) ranked list."""
    r = ranked(spark, sf, bench_queries(spark, sf))
    cit = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("start").cast("string"))
    g = r.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", cit.alias("c")))).alias("l"))
    return g.select(F.col("qid").alias("item_id"), F.array_join(F.transform("l", lambda x: x["c"]), ",").alias("citations"))


EVAL_Q = """SELECT CAST(item_id AS VARCHAR) AS qid, text, 'benchmark' AS source FROM benchmark UNION ALL
  SELECT 'conv:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), text, 'conversation' FROM conversations WHERE role = 'user'"""


@register("txt10_retrieval_eval", f"""WITH {score_sql(EVAL_Q)},
best AS (SELECT q.qid, q.source, coalesce(max(sc.score), 0.0) AS best FROM ({EVAL_Q}) q LEFT JOIN sc ON sc.qid = q.qid GROUP BY q.qid, q.source),
seeds AS (SELECT best FROM best WHERE qid IN (SELECT CAST(item_id AS VARCHAR) FROM benchmark ORDER BY item_id LIMIT 6)),
ce AS (SELECT CASE WHEN quantile_cont(best, 0.9) * 1.15 <= 0.5 THEN 1.0 ELSE quantile_cont(best, 0.9) * 1.15 END AS ceiling FROM seeds)
SELECT source, count(*) AS n, count(*) FILTER (WHERE least(best / ceiling, 1.0) >= 0.25) AS answered,
  count(*) FILTER (WHERE least(best / ceiling, 1.0) < 0.25) AS abstained FROM best, ce GROUP BY source""")
def q_txt10(spark, sf):
    """TXT-10: on-topic (benchmark passages) should answer, off-topic (user turns) should abstain."""
    b = table(spark, sf, "benchmark")
    c = table(spark, sf, "conversations").where(F.col("role") == "user")
    q = b.select(F.col("item_id").cast("string").alias("qid"), "text", F.lit("benchmark").alias("source")).unionByName(
        c.select(F.concat(F.lit("conv:"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("qid"),
                 "text", F.lit("conversation").alias("source")))
    best = cut_lineage(q.select("qid", "source").join(best_scores(spark, sf, q.select("qid", "text")), "qid", "left").fillna(0.0, ["best"]))
    seeds = best.join(b.select(F.col("item_id").cast("string").alias("qid"), "item_id").orderBy("item_id").limit(6).select("qid"), "qid", "left_semi")
    n = tx.normalise(best.select("qid", "best"), seeds, "qid").join(best.select("qid", "source"), "qid")
    return n.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("abstain") == 0).alias("answered"),
                                   F.count_if(F.col("abstain") == 1).alias("abstained"))
