"""Line deduplication over content-defined chunks of lines.

Lines are hashed; a rolling hash runs over ``window`` line hashes; a chunk ends
after every line whose rolling hash is a local minimum.  A boundary depends on
the lines around it alone, so text put in before a passage moves no boundary
inside it, and two neighbouring lines cannot both end a chunk: apart from a
document's last, chunks have two lines at least and three on average.

With ``unit="sentence"`` lines are split further at sentence ends, each piece
keeps its separator, and a chunk ends after every piece whose own hash is a
local minimum: a boundary then depends on one piece and its two neighbours, so
that a passage of few long lines holds whole chunks.

A multi-line chunk that occurs again anywhere keeps its first occurrence (by
document id, then place) and loses the others, after its bytes were compared.
DataFrame functions only; the arrays of a row are walked a constant number of
times, so a very long document costs time in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import written

#: Rolling hash: sum of 40-bit line hashes times powers of BASE, modulo MOD.
BASE, MOD = 31, (1 << 40) - 87
#: Marks before the lines of a chunk.
START, NEXT = "\x0b", " "
#: The empty places after a line's or a sentence's end, and what ends them.
SENTENCE, ENDS = r"(?<=\n)|(?<=[.!?] )", r"\n|[.!?] "


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 10), 16, 10).cast("long")


def _shifted(a: Column, by: int, fill: Column) -> Column:
    return F.slice(F.concat(F.array_repeat(fill, by), a), F.lit(1), F.size(a))


def _times(factor: int):
    # decimal, so that no product of 40-bit numbers overflows
    if factor < 1 << 20:
        return lambda h: h * factor
    return lambda h: F.pmod(h.cast("decimal(20,0)") * F.lit(factor).cast("decimal(18,0)"), F.lit(MOD)).cast("long")


def with_chunks(df: DataFrame, text: Column, window: int = 2, unit: str = "line") -> DataFrame:
    """``df`` with ``_chunks``: the text's chunks, each line of them after a mark, START (first of its chunk) or NEXT.

    The marks make the form reversible (``unmarked``) whatever the text holds;
    being white space themselves, they do not count as a line's characters.
    Each array is a column of its own, so none is computed inside another's lambda.
    """
    if unit == "sentence":
        # a piece is the same whatever white space ends it
        out = df.withColumn("_lines", F.split(text, SENTENCE, -1))
        out = out.withColumn("_h", F.transform("_lines", lambda piece: _line_hash(_trimmed(piece))))
    else:
        out = df.withColumn("_lines", F.split(text, "\n", -1))
        out = out.withColumn("_h", F.transform("_lines", _line_hash))
    rolled = F.col("_h")
    for back in range(1, window):
        older = F.transform(_shifted(F.col("_h"), back, F.lit(0).cast("long")), _times(BASE ** back % MOD))
        rolled = F.zip_with(rolled, older, lambda a, b: F.pmod(a + b, F.lit(MOD)))
    out = out.withColumn("_r", rolled)
    falls = F.zip_with("_r", _shifted(F.col("_r"), 1, F.lit(-1).cast("long")), lambda r, before: F.when(before > r, r))
    after = F.concat(F.slice("_r", F.lit(2), F.size("_r")), F.array(F.lit(None).cast("long")))
    out = out.withColumn("_cut", F.zip_with(falls, after, lambda r, nxt: F.coalesce(r <= nxt, F.lit(False))))
    out = out.withColumn("_start", _shifted(F.col("_cut"), 1, F.lit(True)))
    marked = F.zip_with("_lines", "_start", lambda line, start: F.concat(F.when(start, F.lit(START)).otherwise(F.lit(NEXT)), line))
    return out.withColumn("_chunks", F.split(F.array_join(marked, "\n"), f"\n(?={START})", -1)).drop("_lines", "_h", "_r", "_cut", "_start")


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \n"))


def _pieces(chunk: Column) -> Column:
    """The marked pieces of marked chunks: a separator that a piece keeps is never followed by a mark."""
    return F.split(chunk, f"\n(?=[{START}{NEXT}])", -1)


def unmarked(chunks: Column, unit: str = "line") -> Column:
    if unit == "sentence":
        return F.array_join(F.transform(_pieces(F.array_join(chunks, "\n")), lambda piece: F.substring(piece, 2, 2147483647)), "")
    return F.array_join(F.transform(F.split(F.array_join(chunks, "\n"), "\n", -1), lambda line: F.substring(line, 2, 2147483647)), "\n")


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2,
                         min_chars: int = 20, unit: str = "line") -> DataFrame:
    """``docs`` with repeated multi-line chunks cut from the text, and ``lines_removed`` (int).

    Eligible chunks have two lines or more and ``min_chars`` characters that are
    no white space, so blank lines and the like stay.  With ``unit="sentence"``
    lines are split at sentence ends too, the pieces are what is counted, cuts
    look at one piece's hash (``window`` is not used), and chunks that differ in
    the white space at their end only are the same.  Rows that share id and
    text are one document and stay alike; a null id sorts first.  A null text
    stays null with 0 lines removed; a text whose every chunk is repeated
    becomes empty; an empty table gives an empty result.  Other columns pass
    unchanged, but for an input column ``lines_removed``, which is replaced.

    Shuffled: 16-byte digests per chunk, then twice the text (once to compare
    bytes, only documents with a repeated digest; once to put the decisions
    beside the text).  A chunk that holds a third of all rows is one row per
    task after partial aggregation; its join rows can be split by adaptive
    execution, and its occurrences are never gathered.
    """
    if unit not in ("line", "sentence"):
        raise ValueError(unit)
    fine = unit == "sentence"
    window = 1 if fine else window
    same_text = _trimmed if fine else lambda c: c
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    texts = docs.where(F.col(text_col).isNotNull()).select(key.alias("k"), F.col(text_col).alias("t"))
    # one line or none can't hold a multi-line chunk
    several = texts.where(F.col("t").rlike(ENDS) if fine else F.instr("t", "\n") > 0)

    chunk = F.col("chunk")
    # the pattern stops at the character that decides
    eligible = F.contains(chunk, F.lit(f"\n{NEXT}" if fine else "\n")) & chunk.rlike(rf"^(?:\s*\S){{{min_chars}}}")
    # the outer form: no text has no chunk, and the plain one would add a filter that computes the chunks twice more
    places = written(with_chunks(several, F.col("t"), window, unit)
                     .select("k", F.posexplode_outer("_chunks").alias("at", "chunk"))
                     .select("k", "at", F.when(eligible, F.unhex(F.md5(same_text(chunk)))).alias("digest")))

    spot = F.struct("k", "at")
    # written, so that the joins on a hot digest shuffle both sides and can be split
    repeated = written(places.where("digest is not null").groupBy("digest").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first < last").select("digest", "first"))
    # chunks without a digest, of one line or few characters, have nothing to be joined to
    marked = places.where("digest is not null").join(repeated, "digest", "left").unionByName(places.where("digest is null"), allowMissingColumns=True)

    def per_document(flag: Column) -> DataFrame:
        """One array per document, in the order of its chunks, for documents where a flag is set."""
        own = F.struct("at", flag.alias("x"))
        return marked.groupBy("k").agg(F.array_sort(F.collect_set(own)).alias("flags"), F.max(flag.isNotNull()).alias("any")).where("any").drop("any")

    wanted = per_document(F.when(F.col("first").isNotNull(), F.col("digest")))
    held = with_chunks(several.join(wanted, "k"), F.col("t"), window, unit)
    pairs = held.select(F.explode_outer(F.array_compact(F.zip_with("_chunks", "flags", lambda c, f: F.when(f["x"].isNotNull(), F.struct(f["x"].alias("digest"), same_text(c).alias("chunk")))))).alias("p"))
    same = written(pairs.select("p.digest", "p.chunk").groupBy("digest").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("a = b").select("digest"))

    gone = written(marked.where("first is not null").where(spot != F.col("first")).join(same, "digest").select("k", "at").distinct())
    marked = places.join(gone.withColumn("x", F.lit(True)), ["k", "at"], "left")
    flags = per_document(F.col("x"))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = docs.select(key.alias("k"), row.alias("row")).join(flags, "k", "left")
    cleaned = with_chunks(judged, F.when(F.col("flags").isNotNull(), F.col("row")[text_col]), window, unit)
    kept = F.array_compact(F.zip_with("_chunks", "flags", lambda c, f: F.when(f["x"].isNull(), c)))
    dropped = F.array_compact(F.zip_with("_chunks", "flags", lambda c, f: F.when(f["x"].isNotNull(), F.size(_pieces(c) if fine else F.split(c, "\n", -1)))))
    cleaned = cleaned.withColumn("_kept", kept).withColumn("_dropped", F.aggregate(dropped, F.lit(0), lambda a, x: a + x))
    new_text = F.when(F.col("flags").isNull(), F.col("row")[text_col]).otherwise(F.when(F.size("_kept") > 0, unmarked(F.col("_kept"), unit)).otherwise(F.lit("")))
    return cleaned.select(*[(new_text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns if c != "lines_removed"],
                          F.coalesce("_dropped", F.lit(0)).alias("lines_removed"))
