"""Benchmark decontamination by greedy string tiling.

Words are tokens.  Windows of ``min_match`` tokens are hashed by a running
Karp-Rabin hash; windows a document shares with a benchmark item are seeds.  An
item whose seeds could reach the coverage threshold is tiled: the longest common
run of unmarked tokens is found (Karp-Rabin hashes of every length come from one
prefix array), verified, marked on both sides, and so on down to ``min_match``.
Tiles may lie in any order, so a passage whose sentences were moved around is
covered as well as a verbatim one.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskspark.llm.common import Sent, ready_workers

WORD = re.compile(r"\w+")
BASE = np.uint64(1_000_003)
PART = 1 << 20


def tokens(text: str):
    """Lists of lower-case words, from about a million characters of text each."""
    text = text.lower()
    at, n = 0, len(text)
    while at < n:
        end = at + PART
        if end < n:
            while end < n and (text[end].isalnum() or text[end] == "_"):
                end += 1
        yield WORD.findall(text, at, end)
        at = end


def prefix_hash(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin prefix values and powers of BASE, modulo 2**64: window (i, s) hashes to p[i+s] - p[i] * pw[s]."""
    n = len(ids)
    p, pw = np.zeros(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    if n:
        pw[1:] = np.cumprod(np.full(n, BASE, np.uint64), dtype=np.uint64)
        # p[i] * BASE**-i is a plain running sum; BASE is odd, so it has an inverse
        inv = np.uint64(pow(int(BASE), -1, 1 << 64))
        down = np.cumprod(np.full(n, inv, np.uint64), dtype=np.uint64)
        p[1:] = np.cumsum(ids.astype(np.uint64) * down, dtype=np.uint64) * pw[1:]
    return p, pw


def windows(p: np.ndarray, pw: np.ndarray, blocked: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``s`` tokens that hold no blocked one; ``blocked`` is a running count."""
    if len(p) - 1 < s:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(blocked[s:] == blocked[:-s])
    return at, p[at + s] - p[at] * pw[s]


def _count(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(flags)])


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (document start, item start, length), longest first; token 0 matches nothing."""
    dp, dw = prefix_hash(doc)
    ip, iw = prefix_hash(item)
    dmark, imark = doc == 0, item == 0
    tiles: list[tuple[int, int, int]] = []
    top = min(len(doc), len(item))
    while top >= least:
        dc, ic = _count(dmark), _count(imark)

        def common(s: int) -> bool:
            return bool(np.isin(windows(ip, iw, ic, s)[1], windows(dp, dw, dc, s)[1]).any())

        # a common run of s tokens holds one of s - 1: the longest length by bisection
        low, high = least - 1, top
        if high > low and common(high):
            low = high
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if common(mid) else (low, mid)
        if low < least:
            break
        s = low
        at, h = windows(ip, iw, ic, s)
        where: dict[int, list[int]] = {}
        for j, x in zip(at.tolist(), h.tolist()):
            where.setdefault(x, []).append(j)
        at, h = windows(dp, dw, dc, s)
        hit = np.isin(h, np.fromiter(where, np.uint64, len(where)))
        marked = False
        for i, x in zip(at[hit].tolist(), h[hit].tolist()):
            if dmark[i:i + s].any():
                continue
            for j in where[x]:
                if not imark[j:j + s].any() and np.array_equal(doc[i:i + s], item[j:j + s]):
                    dmark[i:i + s] = imark[j:j + s] = True
                    tiles.append((i, j, s))
                    marked = True
                    break
        top = s if marked else s - 1
    return tiles


class Index:
    """Seeds of a block of benchmark items: vocabulary, sorted window hashes and the places of each."""

    def __init__(self, items: list[tuple[object, str]], min_match: int):
        self.vocab: dict[str, int] = {}
        self.ids, self.items, self.least = [], [], []
        for item_id, text in items:
            words = [w for part in tokens(text) for w in part]
            if words:
                self.ids.append(item_id)
                self.items.append(np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int32))
                # an item shorter than min_match has to be there whole
                self.least.append(min(min_match, len(words)))
        self.seeds = {}
        for s in sorted(set(self.least)):
            hashes, owner, at = [], [], []
            for k, x in enumerate(self.items):
                if self.least[k] == s:
                    p, pw = prefix_hash(x)
                    j, h = windows(p, pw, np.zeros(len(x) + 1, np.int64), s)
                    hashes.append(h)
                    at.append(j)
                    owner.append(np.full(len(j), k, np.int64))
            h, owner, at = map(np.concatenate, (hashes, owner, at))
            order = np.argsort(h, kind="stable")
            keys, first, n = np.unique(h[order], return_index=True, return_counts=True)
            self.seeds[s] = keys, first, n, owner[order], at[order]

    def matches(self, text: str, threshold: float):
        """(item, tokens of the item, tiles in document order) for items covered to ``threshold`` or more."""
        get = self.vocab.get
        parts = [np.fromiter(map(get, w, repeat(0)), np.int32, len(w)) for w in tokens(text)]
        doc = parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])
        if not len(doc):
            return
        p, pw = None, None
        blocked = _count(doc == 0)
        for s, (keys, first, n, owner, place) in self.seeds.items():
            if len(doc) < s or not (blocked[s:] == blocked[:-s]).any():
                continue
            if p is None:
                p, pw = prefix_hash(doc)
            at, h = windows(p, pw, blocked, s)
            spot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[spot] == h
            at, spot = at[hit], spot[hit]
            if not len(at):
                continue
            found = np.unique(spot)
            rows = np.concatenate([np.arange(first[f], first[f] + n[f]) for f in found])
            for k in np.unique(owner[rows]).tolist():
                item, least = self.items[k], self.least[k]
                mine = rows[owner[rows] == k]
                reach = np.zeros(len(item) + 1, np.int64)
                np.add.at(reach, place[mine], 1)
                np.add.at(reach, place[mine] + s, -1)
                # tiles lie inside seeds: what seeds don't reach can't be covered
                if (np.cumsum(reach[:-1]) > 0).sum() < threshold * len(item):
                    continue
                own = np.isin(spot, np.unique(np.searchsorted(first, mine, side="right") - 1))
                region = np.zeros(len(doc) + 1, np.int64)
                np.add.at(region, at[own], 1)
                np.add.at(region, at[own] + s, -1)
                inside = np.flatnonzero(np.cumsum(region[:-1]) > 0)
                # stretches of the document around seeds, with a 0 between them
                gap = np.flatnonzero(np.diff(inside) > 1) + 1
                part, back = np.insert(doc[inside], gap, 0), np.insert(inside, gap, -1)
                tiles = tile(part, item, least)
                if sum(t[2] for t in tiles) >= threshold * len(item):
                    yield k, len(item), sorted((int(back[i]), j, m) for i, j, m in tiles)


def benchmark_overlaps(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", min_match: int = 5,
                       threshold: float = 0.8, block_bytes: int = 32 << 20) -> DataFrame:
    """Contaminated pairs: one row per document row and item of which ``threshold`` or more of the tokens are tiled.

    Columns: the two ids (as ``doc_id``, ``item_id``), n_tokens (of the item),
    covered, coverage (double), n_tiles, longest, and the tiles as three integer
    lists doc_at, item_at, lengths (token places).  ``item_id`` is null where the item has no id.

    The benchmark side is a query set: it is split by hash into blocks of about
    ``block_bytes`` of text, whose size is measured before they are sent to the
    executors, and the documents are read once per block; any number of items
    is handled, none is dropped.  Documents are never shuffled.  Null and empty texts on either side
    match nothing; repeated items count once, repeated documents each come back.
    An item shorter than ``min_match`` tokens must occur whole.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", bench.schema[item_col].dataType),
        *[T.StructField(c, T.IntegerType()) for c in ("n_tokens", "covered")], T.StructField("coverage", T.DoubleType()),
        *[T.StructField(c, T.IntegerType()) for c in ("n_tiles", "longest")],
        *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("doc_at", "item_at", "lengths")]])
    source = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("d"), F.col(text_col).alias("x"))

    out = None
    for sent in _sent_blocks(bench, item_col, item_text_col, block_bytes):
        part = source.mapInArrow(_matcher(sent, min_match, threshold, to_arrow_type(schema["item_id"].dataType)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _sent_blocks(bench: DataFrame, item_col: str, item_text_col: str, block_bytes: int):
    """The distinct items with a text, in blocks of about ``block_bytes``, each sent to the executors."""
    items = bench.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t")).distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for b in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        yield Sent(bench.sparkSession, [(r["i"], r["t"]) for r in block.collect()])


def _matcher(sent: Sent, min_match: int, threshold: float, id_type: pa.DataType):
    def match(batches):
        index = sent.built(Index, min_match)
        for b in batches:
            rows, found = [], []
            for r, text in enumerate(b.column(1).to_pylist() if index.items else ()):
                for m in index.matches(text, threshold):
                    rows.append(r)
                    found.append(m)
            if rows:
                covered = [sum(t[2] for t in tiles) for _, _, tiles in found]
                ints = lambda v: pa.array(v, pa.int32())
                lists = lambda c: pa.array([[t[c] for t in tiles] for _, _, tiles in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array([index.ids[k] for k, _, _ in found], id_type),
                     ints([n for _, n, _ in found]), ints(covered), pa.array([c / n for c, (_, n, _) in zip(covered, found)], pa.float64()),
                     ints([len(t) for _, _, t in found]), ints([max(x[2] for x in t) for _, _, t in found]), lists(0), lists(1), lists(2)],
                    names=["doc_id", "item_id", "n_tokens", "covered", "coverage", "n_tiles", "longest", "doc_at", "item_at", "lengths"])

    return match


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                      min_match: int = 5, threshold: float = 0.8, block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` without the rows in whose text a benchmark item was found (``benchmark_overlaps``).

    Each row is judged by its own text, where it lies: ids, shared or missing,
    don't matter, and nothing is shuffled.  A null text stays.
    """
    ready_workers(docs.sparkSession)
    for sent in _sent_blocks(bench, item_col, item_text_col, block_bytes):
        docs = docs.mapInArrow(_filter(sent, text_col, min_match, threshold), docs.schema)
    return docs


def _filter(sent: Sent, text_col: str, min_match: int, threshold: float):
    def keep(batches):
        index = sent.built(Index, min_match)
        for b in batches:
            clean = [not index.items or text is None or next(index.matches(text, threshold), None) is None for text in b.column(text_col).to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    return keep
