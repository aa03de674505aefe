"""SimHash near-duplicate detection by pigeonhole blocks.

A fingerprint is cut into ``blocks`` parts.  Two fingerprints that differ in at
most ``max_distance`` bits agree on at least ``blocks - max_distance`` parts, so
every close pair meets in the bucket of one combination of that many parts.
Inside a bucket the Hamming distance is verified and the links leave as stars,
so a bucket of m fingerprints gives fewer than m rows, never m * m.

Hot data: equal fingerprints (exact copies, empty texts) are collapsed to one
row before the blocks are made; a bucket of more than ``cell_rows`` distinct
fingerprints is dealt into cells over many tasks (``common.bucket_cells``).
More blocks make longer keys: at 10^10 documents use ``blocks=7`` or 8.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import bucket_cells, components, ready_workers, sorted_groups, unused, written

SEED = 42
PART = 1 << 20


def word_parts(text: bytes, part: int = PART):
    """Lists of ASCII-white-space words of ``text``, about ``part`` bytes each, so that a very long text is never split whole."""
    at, n = 0, len(text)
    while at < n:
        end = at + part
        if end < n:
            # up to the next white space, so that no word is cut
            while end < n and text[end] not in b" \t\n\r\x0b\x0c":
                end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the lower-cased word shingles; 0 for a text without words."""
    if not text:
        return 0
    ones, total, tail = np.zeros(64, np.int64), 0, []
    digest, join = xxhash.xxh64_intdigest, b" ".join

    def add(shingles) -> None:
        nonlocal ones, total
        h = np.array([digest(s, SEED) for s in shingles], np.uint64)
        ones = ones + np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(h)

    for words in word_parts(text.lower()):
        words = tail + words
        if len(words) >= shingle:
            add(map(join, zip(*(words[i:] for i in range(shingle)))))
        tail = words[len(words) - min(len(words), shingle - 1):]
    if not total:
        if not tail:
            return 0
        add([join(tail)])
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("long")
    def bits(v: pa.Array) -> pa.Array:
        return pa.array((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else None, shingle) for x in v), pa.int64())

    return bits(text.cast("binary"))


def block_masks(blocks: int, max_distance: int) -> list[int]:
    """Signed 64-bit masks, one per combination of ``blocks - max_distance`` blocks."""
    if not max_distance < blocks <= 64:
        raise ValueError("blocks must be over max_distance and at most 64")
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(c)) for c in combinations(part, blocks - max_distance)]


def near_stars(fp: np.ndarray, max_distance: int) -> tuple[list[int], list[int]]:
    """Star links (root, member) of the groups that distances of at most ``max_distance`` chain together."""
    fp = fp.view(np.uint64)
    roots: list[int] = []
    members: list[int] = []
    left = np.arange(len(fp))
    while left.size > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and left.size:
            near = np.bitwise_count(fp[left] ^ fp[front.pop()]) <= max_distance
            hit = left[near]
            if hit.size:
                roots += [root] * hit.size
                members += hit.tolist()
                front += hit.tolist()
                left = left[~near]
    return roots, members


def fingerprint_links(fps: DataFrame, max_distance: int = 3, blocks: int = 6, cell_rows: int = 2048) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints within ``max_distance`` bits, from distinct ``fp`` longs."""
    ready_workers(fps.sparkSession)
    masks = block_masks(blocks, max_distance)
    keyed = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).cast("short").alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])).alias("k")
    ).select("k.c", "k.key", "fp")
    cells = bucket_cells(keyed, ["c", "key"], "fp", cell_rows)
    names = ["c", "key", "_a", "_b"]

    def link(batches):
        for g in sorted_groups(batches, names):
            u, v = near_stars(g["fp"], max_distance)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(g["fp"][u]), pa.array(g["fp"][v])], names=["u", "v"])

    return cells.select(*names, "fp").repartition(*names).sortWithinPartitions(*names).mapInArrow(link, "u long, v long").distinct()


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                            max_distance: int = 3, blocks: int = 6, cell_rows: int = 2048) -> DataFrame:
    """One row (id, fingerprint, component_id) per input row.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable
    over links of at most ``max_distance`` differing bits.  A null, empty or
    blank text has fingerprint zero, which is linked like any other.  Repeated
    rows each come back.  A row with a null id takes part, but cannot name a
    component: ``component_id`` is null where a whole component has no id.  An
    empty table gives an empty result.  Other columns of ``docs`` are not read.
    """
    ready_workers(docs.sparkSession)
    prints = written(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(fingerprint_links(distinct.select("fp"), max_distance, blocks, cell_rows))
    # fingerprints without a link are their own root
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                           max_distance: int = 3, blocks: int = 6, cell_rows: int = 2048) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id, of equal ids the first in the table.

    Rows, not ids, are kept or dropped: they are numbered in a written copy.  A
    row without an id stays only where its whole group has none; rows that share
    an id but no group stay, each with its own group.
    """
    ready_workers(docs.sparkSession)
    row, fp = unused(docs, "_row"), unused(docs, "_fp")
    numbered = written(docs.withColumn(fp, fingerprint_column(F.col(f"`{text_col}`"), shingle)).withColumn(row, F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col(f"`{id_col}`").isNull().alias("void"), F.col(f"`{id_col}`").alias("id"), F.col(row).alias("row"))).alias("first")
    distinct = numbered.groupBy(F.col(fp).alias("fp")).agg(first)
    roots = components(fingerprint_links(distinct.select("fp"), max_distance, blocks, cell_rows))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    return numbered.join(grouped.select(F.col("first.row").alias(row)), row, "left_semi").drop(row, fp)
