"""URL rules and line chunks: edge cases, brute force, and plans without Python."""

import duckdb
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskspark.llm import queries as Q
from riskspark.llm.line_chunks import BASE, MOD, drop_repeated_chunks, unmarked, with_chunks
from riskspark.llm.url_filter import url_verdicts

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("com", "", "block"), ("example.com", "/a/b", "allow"), ("b.c", "/aa", "allow"),
         ("c", "/ab", "block"), ("x.y", "/", "allow"), ("x.y", "/", "block"), (None, "/", "block"), ("z", None, "block"), ("", "/", "block"), ("q", "/", None)]
URLS = ["http://a.example.net/en/1", "http://a.example.net/fr/1", "HTTP://A.EXAMPLE.NET/en/", "http://net", "http://net/", "http://net?x/", "http://notnet.org/", "net/x", None, "", "://net/x",
        "http://example.com", "http://w.example.com/a/bc?d#e", "http://w.example.com/a/", "http://b.c/ab", "http://x.y/", "http://z/", "http://q/", "http://u/?://net/", "http://ne.t/\n#a", "a://b://net/", "http:///x",
        "http://ÄB.net/en", "http://example.net/EN/"]


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in RULES if h and p is not None and v and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_url_rules(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:3])], "page_id int, url string").withColumn("host", F.lit("clash")).withColumn("u", F.lit(1)).withColumn("row", F.lit(2))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_verdicts(pages, rules).collect()}
    assert got == {i: brute_url(u) for i, u in enumerate(URLS + URLS[:3])}
    out = url_verdicts(pages, rules.limit(0))
    assert {r["verdict"] for r in out.collect()} == {"allow"} and out.columns == ["page_id", "url", "u", "row", "host", "path", "rule", "verdict"]
    assert url_verdicts(pages.limit(0), rules).collect() == []


def test_repeated_urls_come_back_each(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://net/")] * 5 + [(1, None)] * 2, "page_id int, url string")
    assert sorted(r["verdict"] for r in url_verdicts(pages, rules).collect()) == ["allow"] * 2 + ["block"] * 5


def brute_chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:10], 16) for x in lines]
    r = [(h[i] + (BASE * h[i - 1] if i else 0)) % MOD for i in range(len(h))]
    out = [[]]
    for i, line in enumerate(lines):
        out[-1].append(line)
        if 0 < i < len(lines) - 1 and r[i - 1] > r[i] <= r[i + 1]:
            out.append([])
    return out


def brute_dedup(rows, least=20):
    seen = {}
    out = {}
    for i, text in sorted(rows.items()):
        if text is None:
            out[i] = (None, 0)
            continue
        kept, gone = [], 0
        for c in brute_chunks(text):
            body = "\n".join(c)
            if len(c) > 1 and len("".join(x for x in body if x not in " \t\n\x0b\f\r")) >= least and seen.setdefault(body, (i, len(kept) + gone)) != (i, len(kept) + gone):
                gone += len(c)
            else:
                kept += c
        out[i] = ("\n".join(kept), gone)
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(rng.randint(1, 9)))
    passages = [[line() for _ in range(rng.randint(1, 12))] for _ in range(6)]
    rows = {}
    for i in range(120):
        parts = [line() for _ in range(rng.randint(0, 6))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(parts))
            parts[at:at] = p
        rows[i] = "\n".join(parts)
    whole = "\n".join(line() for _ in range(9))
    return rows | {200: None, 201: "", 202: "\n\n\n\n\n\n", 203: "one line", 204: whole, 205: whole, 206: "C" + whole, 207: whole + "\n", 208: "x\u0000y\n\r\nL\nC\n" * 30, 209: "x\u0000y\n\r\nL\nC\n" * 30}


def test_line_chunks(spark):
    rows = corpus()
    df = spark.createDataFrame(list(rows.items()), "doc_id int, text string").withColumn("k", F.lit(1)).withColumn("flags", F.lit("x")).withColumn("lines_removed", F.lit(9.5)).withColumn("row", F.lit(0))
    out = drop_repeated_chunks(df)
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in out.collect()} == brute_dedup(rows)
    assert out.columns == ["doc_id", "text", "k", "flags", "row", "lines_removed"]
    assert drop_repeated_chunks(df.limit(0)).collect() == []


def test_long_document_and_shifted_passage(spark):
    rng = random.Random(6)
    passage = [f"passage {rng.random()} line {i} " + "w " * 10 for i in range(4000)]
    rows = {1: "\n".join(passage), 2: "\n".join(["put", "before"] + passage + ["and", "after"])}
    got = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in drop_repeated_chunks(spark.createDataFrame(list(rows.items()), "doc_id int, text string")).collect()}
    assert got == brute_dedup(rows)
    assert got[1][1] == 0 and got[2][1] > 3980


def test_repeated_rows_are_one_document(spark):
    text = "\n".join(f"some line of text number {i}" for i in range(20))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id int, text string")
    got = sorted((r["doc_id"] or 0, r["lines_removed"] > 0) for r in drop_repeated_chunks(df).collect())
    # the row without an id sorts first and keeps its lines
    assert got == [(0, False), (1, True), (1, True), (2, True)]


def test_passages_of_few_long_lines(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    line = lambda: " ".join(" ".join(word() for _ in range(9)) + rng.choice(".!?") for _ in range(7))
    # passages of 1 to 5 lines, each once in an early document and once more between other neighbours
    passages = {k: "\n".join(line() for _ in range(1 + k % 5)) for k in range(100)}
    rows = {k: "\n".join([line(), p, line()]) for k, p in passages.items()}
    rows |= {1000 + k: "\n".join([line() for _ in range(k % 3)] + [p] + [line() for _ in range(k % 2)]) for k, p in passages.items()}
    df = spark.createDataFrame(list(rows.items()), "doc_id int, text string")

    def removed(**options):
        got = {r["doc_id"]: r["text"] for r in drop_repeated_chunks(df, **options).collect()}
        assert all(got[k] == rows[k] for k in passages)
        words = {k: len(rows[1000 + k].split()) - len(got[1000 + k].split()) for k in passages}
        assert all(0 <= n <= len(passages[k].split()) for k, n in words.items())
        return [sum(n > 0 for k, n in words.items() if k % 5 == size) for size in range(5)], sum(words.values()) / sum(len(p.split()) for p in passages.values())

    found, share = removed(unit="sentence")
    assert min(found) >= 14 and sum(found) >= 92 and share > 0.7
    assert removed()[1] < 0.3


def test_sentence_chunks_restore_the_text(spark):
    odd = ["a. b! c? d", "a.  b\n\n.\n. ", "\x0b a.\n\x0b b. \n c", "  ", "\n", "", ". . . ", "x.\n \x0b\ny. \x0b", "no end"]
    out = with_chunks(spark.createDataFrame([(t,) for t in odd], "t string"), F.col("t"), 1, "sentence")
    assert [tuple(r) for r in out.select("t", unmarked(F.col("_chunks"), "sentence")).collect()] == [(t, t) for t in odd]
    with pytest.raises(ValueError):
        drop_repeated_chunks(out, "t", "t", unit="word")


@pytest.mark.parametrize("name", ["op4_passage_dedup"])
def test_no_python_in_the_plan_of_passages(spark, sf, name):
    test_no_python_in_the_plan(spark, sf, name)


@pytest.mark.parametrize("name", ["op2_url_filter", "op4_line_dedup"])
def test_no_python_in_the_plan(spark, sf, name):
    plan = Q.QUERIES[name](spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = Q.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    want = con.execute(Q.ORACLE[name])
    names = [d[0] for d in want.description]
    assert got == sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in want.fetchall())
