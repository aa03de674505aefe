"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.ann import nearest
from riskspark.llm.collocations import collocations
from riskspark.llm.common import held_out, table
from riskspark.llm.decontaminate import benchmark_overlaps
from riskspark.llm.embed_dedup import embedding_near_duplicates
from riskspark.llm.langid import language_of_documents
from riskspark.llm.line_chunks import drop_repeated_chunks
from riskspark.llm.pieces import PieceColumns, encode_documents
from riskspark.llm.ppm import language_model_scores
from riskspark.llm.quality import quality_scores
from riskspark.llm.simhash import simhash_near_duplicates
from riskspark.llm.toxicity import toxicity_scores
from riskspark.llm.turns import damaged, repair
from riskspark.llm.url_filter import url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)


#: Fixed values of the query's contract: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op2_url_filter", """
WITH u AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict AS verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, coalesce(p.host, '') AS host, coalesce(p.path, '') AS path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM p LEFT JOIN best b ON p.page_id = b.page_id AND b.k = 1
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_match=5, threshold=0.8)


@query("op4_line_dedup", """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, len(ls) AS n FROM d
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 10))::BIGINT AS h FROM l
), r AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0)) % 1099511627689 AS r FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT *, coalesce(lag(r) OVER w > r AND r <= lead(r) OVER w, false) AS cut FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), s AS (
  SELECT *, sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM c
), g AS (
  SELECT doc_id, coalesce(k, 0) AS k, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS lines, min(i) AS i FROM s GROUP BY ALL
), f AS (
  SELECT *, lines > 1 AND length(regexp_replace(chunk, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) >= 20
            AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, i) > 1 AS gone
  FROM g
), o AS (
  SELECT doc_id, string_agg(chunk, chr(10) ORDER BY i) FILTER (NOT gone) AS text, sum(CASE WHEN gone THEN lines ELSE 0 END) AS lines_removed FROM f GROUP BY doc_id
)
SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text, coalesce(lines_removed, 0)::INTEGER AS lines_removed
FROM documents LEFT JOIN o ON documents.doc_id = o.doc_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), window=2, min_chars=20)


@query("op4_passage_dedup", """
WITH d AS (
  SELECT doc_id, string_split(regexp_replace(text, '(\\n|[.!?] )', '\\1' || chr(57344), 'g'), chr(57344)) AS ls FROM documents WHERE text IS NOT NULL
), l AS (
  SELECT doc_id, unnest(ls) AS piece, generate_subscripts(ls, 1) AS i FROM d
), h AS (
  SELECT *, ('0x' || substr(md5(rtrim(piece, chr(10) || ' ')), 1, 10))::BIGINT AS h FROM l
), c AS (
  SELECT *, coalesce(lag(h) OVER w > h AND h <= lead(h) OVER w, false) AS cut FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), s AS (
  SELECT *, sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM c
), g AS (
  SELECT doc_id, coalesce(k, 0) AS k, string_agg(piece, '' ORDER BY i) AS chunk, count(*) AS pieces, min(i) AS i FROM s GROUP BY ALL
), e AS (
  SELECT *, rtrim(chunk, chr(10) || ' ') AS body, pieces > 1 AND length(regexp_replace(chunk, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) >= 20 AS eligible FROM g
), f AS (
  SELECT *, eligible AND row_number() OVER (PARTITION BY eligible, body ORDER BY doc_id, i) > 1 AS gone FROM e
), o AS (
  SELECT doc_id, string_agg(chunk, '' ORDER BY i) FILTER (NOT gone) AS text, sum(CASE WHEN gone THEN pieces ELSE 0 END) AS lines_removed FROM f GROUP BY doc_id
)
SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text, coalesce(lines_removed, 0)::INTEGER AS lines_removed
FROM documents LEFT JOIN o ON documents.doc_id = o.doc_id
""")
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, unit="sentence")


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 5, 0), threshold=0.3)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted", "prior")


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity_scores(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 4, 2), threshold=0.3)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_of_documents(docs, ~held_out("doc_id", 4, 2))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op8_ppm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model_scores(table(spark, sf_dir, "documents"), ~held_out("doc_id", 7, 2))
    return found.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: A public vocabulary with byte pieces; another model is named by the environment or the operator's parameter.
PIECES = os.environ.get("RISKSPARK_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


@query("op9_pieces")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = PieceColumns(spark, PIECES)
    found = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces)
    return found.select("doc_id", "ids", "n_tokens", F.col("text").eqNullSafe(pieces.decode(F.col("ids"))).alias("round_trip"))


@query("op10_embedding_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), reach AS (
  SELECT vec_id AS u, vec_id AS w FROM embeddings
  UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u
), comp AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
deg AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
FROM embeddings e JOIN comp ON comp.u = e.vec_id LEFT JOIN deg ON deg.u = e.vec_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


@query("op13_nearest", """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.k, q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e) AS score
  FROM v q JOIN v ON q.k <> v.k AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 20
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op11_collocations", r"""
WITH d AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, (len(w) - k + 2)::BIGINT), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k
), f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k > 1),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.a >= 100 * c.a AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), cut AS (
  SELECT lang, phrase, a, unnest(range(1, k::BIGINT)) AS j, string_split(phrase, ' ') AS w FROM kept
), s AS (
  SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, t.n, (1000::HUGEINT * cut.a * t.n) // (x.a::HUGEINT * y.a) AS score
  FROM cut JOIN t ON t.lang = cut.lang
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(w, 1, j), ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(w, j + 1, len(w)), ' ')
), m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM m QUALIFY rank <= 2000
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"), max_words=5, min_count=100, top=2000)


@query("op12_turns", r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key
  FROM conversations
), crc AS (
  SELECT *, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(key, lambda c: list_transform(range(8), lambda b: ((ascii(c)::BIGINT >> b::INTEGER) & 1)::BIGINT)))),
    lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT) % 20 AS kind
  FROM src
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM crc WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         left(role, 1) AS c, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS z
  FROM hurt
), f AS (
  SELECT *, z = '' AS blank, z <> '' AND seen > 1 AS duplicate, z <> '' AND seen = 1 AND z NOT IN ('.', '!', '?') AS cut,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS illegal
  FROM o
), flaws AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::BIGINT)::BIGINT AS blank, sum(duplicate::BIGINT)::BIGINT AS duplicate,
         sum(cut::BIGINT)::BIGINT AS truncated, coalesce(sum(illegal::BIGINT), 0)::BIGINT AS illegal, count(*) AS n
  FROM f GROUP BY conv_id
), go AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit, '' AS said FROM flaws
  UNION ALL
  SELECT conv_id, i, st, cost, audit, said FROM (
    SELECT g.conv_id, f.i, e.st, g.cost + e.cost AS cost, g.audit || e.audit AS audit, g.said || e.said AS said
    FROM go g JOIN f ON g.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = g.i + 1,
    LATERAL (
      SELECT g.st AS st, 3 AS cost, 'D' AS audit, '' AS said
      UNION ALL SELECT 1, cut::INTEGER, 'K', chr(10) || f.role || ':' || f.text WHERE NOT f.blank AND NOT f.duplicate AND g.st = 0 AND f.c = 's'
      UNION ALL SELECT 2, cut::INTEGER + CASE WHEN f.c = 'u' THEN 0 ELSE 2 END, CASE WHEN f.c = 'u' THEN 'K' ELSE 'R' END,
                       chr(10) || CASE WHEN f.c = 'u' THEN f.role ELSE 'user' END || ':' || f.text
                WHERE NOT f.blank AND NOT f.duplicate AND g.st <> 2
      UNION ALL SELECT 3, cut::INTEGER + CASE WHEN f.c = 'a' THEN 0 ELSE 2 END, CASE WHEN f.c = 'a' THEN 'K' ELSE 'R' END,
                       chr(10) || CASE WHEN f.c = 'a' THEN f.role ELSE 'assistant' END || ':' || f.text
                WHERE NOT f.blank AND NOT f.duplicate AND g.st = 2
      UNION ALL SELECT 3, 2 + cut::INTEGER + CASE WHEN f.c = 'a' THEN 0 ELSE 2 END, CASE WHEN f.c = 'a' THEN 'IK' ELSE 'IR' END,
                       chr(10) || 'user:' || chr(10) || CASE WHEN f.c = 'a' THEN f.role ELSE 'assistant' END || ':' || f.text
                WHERE NOT f.blank AND NOT f.duplicate AND g.st <> 2
      UNION ALL SELECT 2, 2 + cut::INTEGER + CASE WHEN f.c = 'u' THEN 0 ELSE 2 END, CASE WHEN f.c = 'u' THEN 'IK' ELSE 'IR' END,
                       chr(10) || 'assistant:' || chr(10) || CASE WHEN f.c = 'u' THEN f.role ELSE 'user' END || ':' || f.text
                WHERE NOT f.blank AND NOT f.duplicate AND g.st = 2
    ) e
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, st ORDER BY cost, audit) = 1
), ends AS (
  SELECT go.conv_id, cost + CASE st WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END AS cost, audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
         said || CASE st WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END AS said
  FROM go JOIN flaws ON go.conv_id IS NOT DISTINCT FROM flaws.conv_id AND go.i = flaws.n
), done AS (
  SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN flaws ON a.conv_id IS NOT DISTINCT FROM flaws.conv_id LEFT JOIN done ON a.conv_id IS NOT DISTINCT FROM done.conv_id
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
