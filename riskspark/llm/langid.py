"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994).

A profile is the list of the most frequent letter n-grams (n = 1 to 3, words
padded with a space) in order of frequency.  A document goes to the language
whose profile is nearest by out-of-place distance: the sum, over the document's
n-grams, of how far each one's rank is from its rank in the profile, with the
profile's length for an n-gram the profile lacks.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import Sent, ready_workers, unused

UNKNOWN = "und"
BLANK = 32
PART = 1 << 20
_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point -> lower-case letter, or BLANK for anything that is neither a letter nor a mark on one."""
    if not _FOLD:
        table = np.full(sys.maxunicode + 1, BLANK, np.uint32)
        for c in range(sys.maxunicode + 1):
            if unicodedata.category(ch := chr(c))[0] in "LM":
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def has_letter(grams: np.ndarray) -> bool:
    """Whether one of the n-grams is a single letter (marks alone make no text)."""
    return any(unicodedata.category(chr(c))[0] == "L" for c in grams[grams < 1 << 21].tolist())


def _grams(codes: np.ndarray) -> np.ndarray:
    c = codes.astype(np.int64)
    blank = c == BLANK
    two = (c[:-1] << 21) | c[1:]
    three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[~blank[1:-1]]
    return np.concatenate([c[~blank], two, three])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, each packed into one integer, and their counts; very long texts are counted in parts."""
    fold, found = fold_table(), []
    codes = fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    at = 0
    while at < len(codes):
        end = at + PART
        if end < len(codes):
            gap = np.flatnonzero(codes[end:] == BLANK)
            end = end + int(gap[0]) if len(gap) else len(codes)
        part = np.concatenate([[BLANK], codes[at:end], [BLANK]]).astype(np.uint32)
        blank = part == BLANK
        part = part[~(blank & np.concatenate([[False], blank[:-1]]))]
        if len(part) > 2:
            found.append(np.unique(_grams(part), return_counts=True))
        at = end
    return merged(found)


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(found) == 1:
        return found[0]
    grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    return grams, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)


def top(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, best first; equal counts in n-gram order."""
    if len(grams) > 4 * size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= floor
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))[:size]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = 300, max_languages: int = 4096) -> dict[str, np.ndarray]:
    """Language -> its ranked n-grams, counted over every row with a text and a language.

    Counts are summed in the tasks and then by Spark; only the profiles reach
    the driver, ``size`` n-grams each.  More than ``max_languages`` distinct
    values raise an error: that is no language column.
    """
    def count(batches):
        for b in batches:
            seen: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = seen.setdefault(lang, [])
                own.append(gram_counts(text.as_py()))
                if len(own) >= 512:
                    seen[lang] = [merged(own)]
            for lang, own in seen.items():
                g, n = merged(own)
                if len(g):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])

    ready_workers(docs.sparkSession)
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # in two steps, so that the n-grams of one language are never ordered in one task
    best = [F.desc("n"), F.col("gram")]
    salted = counts.withColumn("s", F.pmod(F.xxhash64("gram"), F.lit(64)))
    for part in (["lang", "s"], ["lang"]):
        salted = salted.withColumn("r", F.row_number().over(Window.partitionBy(*part).orderBy(*best))).where(F.col("r") <= size)
    ranked = salted.select("lang", "gram", "r")
    found = ranked.limit(max_languages * size + 1).toArrow()
    if found.num_rows > max_languages * size:
        raise ValueError(f"over {max_languages} languages")
    langs, grams, ranks = np.array(found.column("lang").to_pylist(), object), found.column("gram").to_numpy(), found.column("r").to_numpy()
    return {lang: grams[langs == lang][np.argsort(ranks[langs == lang])] for lang in sorted(set(langs))}


class Ranker:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        # a rank per n-gram and language; -1: the profile lacks it
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 - distance / largest possible distance; ties go to the first name."""
        grams, counts = gram_counts(text) if text else (np.zeros(0), np.zeros(0))
        if not self.langs or not has_letter(grams):
            return UNKNOWN, 0.0
        own = top(grams, counts, self.size)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == own)[:, None], self.ranks[at], -1)
        far = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(0)
        best = int(np.argmin(far))
        return self.langs[best], float(1 - far[best] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text: Column, size: int = 300) -> Column:
    """struct(lang_pred, score) of a text; ``und`` with score 0 for null, no letter, or no profile at all."""
    sent = Sent(docs.sparkSession, profiles)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(v: pa.Array) -> pa.Array:
        ranker = sent.built(Ranker, size)
        found = [ranker.predict(x.as_py()) for x in v]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang_pred", "score"])

    return predict(text)


def language_of_documents(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", size: int = 300) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the profiles learnt from the rows where ``train`` holds.

    Languages without a letter in their training rows have no profile.  Repeated
    rows each count and come back; an empty table gives an empty result; input
    columns called lang_pred or score are replaced.
    """
    profiles = learn_profiles(docs.where(train), text_col, lang_col, size)
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    found = unused(docs, "_found")
    return docs.select(*keep, identify(docs, profiles, F.col(text_col), size).alias(found)).select(*keep, f"{found}.lang_pred", f"{found}.score")
