"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts up to ``order`` bytes with the counts of
what followed each.  A symbol is predicted in its longest known context; where
it was never seen there, an escape (method D: half a count of each distinct symbol
seen) leads to the context one byte shorter, in which the
symbols already ruled out are excluded, and at last to a uniform choice among
what remains.  The sum of log probabilities is the (negative) code length.

``pretrained`` mode counts the contexts of a whole corpus in Spark and scores
with fixed counts; since an excluded set depends on the longer context alone,
each context has one row of final log probabilities, and a text is scored by
table look-ups over whole arrays.  ``adaptive`` mode starts every document with
an empty trie and learns as it goes.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Sent, ready_workers, written

#: Symbols: 0 pads the start of a text (context only), 1 to 256 are bytes, 257 ends a text.
END, BITS = 257, 9
SYMBOLS = 257
MASK = (1 << BITS) - 1
CHUNK = 1 << 21
#: Symbols whose grams are looked up at once.
LOOKED = 1 << 20
#: Documents whose results are sent at once.
SENT_ROWS = 512
#: The longest word that tasks look up themselves; with the number of those words it bounds the bytes sent.
COMMON_BYTES = 64


def model_words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def symbols(words: list[bytes], order: int) -> np.ndarray:
    """The words, joined by single spaces, as symbols after ``order`` pads, with the end."""
    raw = np.frombuffer(b" ".join(words), np.uint8)
    out = np.zeros(order + len(raw) + 1, np.int64)
    out[order:-1] = raw
    out[order:-1] += 1
    out[-1] = END
    return out


def grams_of(s: np.ndarray, order: int, start: int, end: int) -> np.ndarray:
    """The gram that ends at each place from start to end: ``order`` symbols and the one that follows."""
    gram = s[start - order:end - order].copy()
    for k in range(1, order + 1):
        gram <<= BITS
        gram |= s[start - order + k:end - order + k]
    return gram


def gram_counts(texts, order: int):
    """(grams, counts) arrays, a few million grams at a time: a gram is ``order`` context symbols and the one that follows."""
    held: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        grams = np.concatenate(held)
        held.clear()
        found.append(np.unique(grams, return_counts=True))
        if sum(len(g) for g, _ in found) > CHUNK:
            found[:] = [_merged(found)]

    size = 0
    for words in texts:
        s = symbols(words, order)
        for at in range(order, len(s), CHUNK):
            held.append(grams_of(s, order, at, min(len(s), at + CHUNK)))
            size += len(held[-1])
            if size >= CHUNK:
                flush()
                size = 0
                # what a task holds stays bounded: the rest is summed by Spark
                if len(found[-1][0]) > 2 * CHUNK:
                    yield found.pop()
    if held:
        flush()
    if found:
        yield _merged(found)


def _merged(found):
    if len(found) == 1:
        return found[0]
    grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    return grams, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)


@dataclass(frozen=True)
class Trie:
    """Counts of the grams of each length 1 to order + 1, as sorted (gram, count) arrays."""

    order: int
    grams: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]


def _low(gram: Column, length: int) -> Column:
    """The last ``length`` symbols of a gram."""
    return gram.bitwiseAND(F.lit((1 << (BITS * length)) - 1))


def train(texts: DataFrame, text: str, order: int = 5, max_contexts: int = 1 << 19, max_grams: int = 1 << 21) -> tuple[Trie, list[DataFrame] | None]:
    """Counts over every row of ``texts`` (a binary column): a trie of bounded size, and the tables of all counts.

    The trie is a cache: of each length at most the ``max_contexts`` most
    frequent contexts, as far as their followers are ``max_grams`` at most,
    each with every symbol that followed it.  The tables (gram, n), by length
    from 1, hold the rest; None where the trie holds everything.
    """
    def count(batches):
        for grams, n in gram_counts((model_words(x.as_buffer().to_pybytes() if x.is_valid else None) for b in batches for x in b.column(0)), order):
            for at in range(0, len(grams), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(grams[at:at + (1 << 16)]), pa.array(n[at:at + (1 << 16)])], names=["gram", "n"])

    levels = [written(texts.select(text).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))]
    for length in range(order, 0, -1):
        levels.insert(0, written(levels[0].groupBy(_low(F.col("gram"), length).alias("gram")).agg(F.sum("n").alias("n"))))
    grams, counts, whole = [], [], True
    for length, level in enumerate(levels, 1):
        rows = level
        if length > 1:
            contexts = level.groupBy(F.shiftright("gram", BITS).alias("ctx")).agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("f"))
            total = contexts.count()
            top = contexts.orderBy(F.desc("t"), "ctx").limit(max_contexts).toArrow()
            ctx = top.column("ctx").to_numpy()[np.cumsum(top.column("f").to_numpy()) <= max_grams]
            if length > 2:
                # a context needs its suffix, to escape to, and its prefix, to be reached by
                shorter = np.unique(grams[-1] >> BITS)
                ctx = ctx[np.isin(ctx & ((1 << (BITS * (length - 2))) - 1), shorter) & np.isin(ctx >> BITS, shorter)]
            if len(ctx) < total:
                whole = False
                kept = texts.sparkSession.createDataFrame(pa.table({"ctx": pa.array(ctx, pa.int64())}))
                rows = level.join(F.broadcast(kept), F.shiftright("gram", BITS) == F.col("ctx")).select("gram", "n")
        rows = rows.toArrow()
        g, n = rows.column("gram").to_numpy(), rows.column("n").to_numpy()
        at = np.argsort(g)
        grams.append(g[at])
        counts.append(n[at])
    return Trie(order, tuple(grams), tuple(counts)), None if whole else levels


def log10_of_grams(asked: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(gram, value) per row of ``asked`` (distinct grams): log10 probability of the last symbol after the others, from the tables of all counts.

    Each length's rows are the distinct ends of the longer one's, so that no
    key of a join has more rows than there are symbols.
    """
    total, symbols_seen = levels[0].agg(F.sum("n"), F.count(F.lit(1))).first()
    uniform = F.lit(-math.log10(SYMBOLS - symbols_seen) if symbols_seen < SYMBOLS else -math.inf)
    order = len(levels) - 1
    ends = [asked]
    for length in range(order, 0, -1):
        ends.insert(0, written(ends[0].select(_low(F.col("gram"), length).alias("gram")).distinct()))
    n, t, q = F.col("n"), F.col("t"), F.col("q")

    def value(after: Column) -> Column:
        return F.when(n.isNotNull(), F.log10((n - 0.5) / t)).otherwise(F.log10(q / 2 / t) + after)

    # after: log probability of a symbol the context has not seen, once all it has seen is excluded
    known = ends[0].join(levels[0], "gram", "left").withColumn("t", F.lit(total)).withColumn("q", F.lit(symbols_seen)).withColumn("after", uniform)
    known = known.withColumn("value", value(F.col("after")))
    for length in range(2, order + 2):
        level, shorter = levels[length - 1], levels[length - 2]
        # covered: how often the context's suffix was followed by what followed the context
        contexts = level.select("gram", "n", _low(F.col("gram"), length - 1).alias("end")).join(shorter.select(F.col("gram").alias("end"), F.col("n").alias("m")), "end")
        contexts = contexts.groupBy(F.shiftright("gram", BITS).alias("ctx")).agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("q"), F.sum("m").alias("covered"))
        below = known.select(F.col("gram").alias("end"), *[F.col(c).alias(f"{c}_below") for c in ("n", "t", "q", "after", "value")])
        rows = ends[length - 1].select("gram", _low(F.col("gram"), length - 1).alias("end"), F.shiftright("gram", BITS).alias("ctx"))
        rows = rows.join(below, "end").join(contexts, "ctx", "left").join(level, "gram", "left")
        rest, fresh = F.col("t_below") - F.col("covered"), F.col("q_below") - q
        after = F.when(fresh > 0, F.when(F.col("n_below").isNotNull(), F.log10((F.col("n_below") - 0.5) / rest)).otherwise(F.log10(fresh / 2 / rest) + F.col("after_below")))
        rows = rows.withColumn("after", after.otherwise(F.col("after_below")))
        known = written(rows.withColumn("value", F.when(t.isNotNull(), value(F.col("after"))).otherwise(F.col("value_below"))).select("gram", "n", "t", "q", "after", "value"))
    return known.select("gram", "value")


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of keys in a sorted array; a place is valid either way if the array is not empty."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class Tables:
    """Look-ups in a trie: sorted grams with their counts, and per context its total, followers, and what its suffix has beyond them."""

    def __init__(self, trie: Trie):
        self.order, self.grams, self.counts = trie.order, trie.grams, trie.counts
        symbols_seen = len(trie.grams[0])
        self.total, self.seen = float(trie.counts[0].sum()), symbols_seen
        self.uniform = -math.log10(SYMBOLS - symbols_seen) if symbols_seen < SYMBOLS else -math.inf
        # of each length from 2: contexts, totals, followers; the suffix's occurrences and symbols that the context has not seen
        self.contexts: list[tuple[np.ndarray, ...]] = []
        under_ctx, under_t, under_q = np.zeros(1, np.int64), np.array([self.total]), np.array([symbols_seen])
        for length in range(2, trie.order + 2):
            g, n = trie.grams[length - 1], trie.counts[length - 1]
            ctx, first, q = np.unique(g >> BITS, return_index=True, return_counts=True)
            suffix = trie.counts[length - 2][_place(trie.grams[length - 2], g & ((1 << (BITS * (length - 1))) - 1))[0]] if len(g) else n
            t, covered = (np.add.reduceat(x.astype(np.float64), first) if len(g) else np.zeros(0) for x in (n, suffix))
            at = _place(under_ctx, ctx & ((1 << (BITS * (length - 2))) - 1))[0]
            self.contexts.append((ctx, t, q, under_t[at] - covered, under_q[at] - q))
            under_ctx, under_t, under_q = ctx, t, q
        g, n = trie.grams[-1], trie.counts[-1]
        ctx, t = self.contexts[-1][:2] if self.contexts else (np.zeros(1, np.int64), np.array([self.total]))
        self.last = np.log10((n - 0.5) / t[_place(ctx, g >> BITS)[0]]) if len(g) else np.zeros(0)

    def values(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probabilities of the last symbols of grams after the others, and whether each one's longest context is held."""
        at, held = _place(self.grams[-1], asked)
        value = np.zeros(len(asked))
        value[held] = self.last[at[held]]
        if not held.all():
            rest = ~held
            value[rest], held[rest] = self._escaped(asked[rest])
        return value, held

    def _escaped(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for grams that are not in the trie: each length's distinct ends, from one symbol up."""
        ends, below = [asked], []
        for length in range(self.order, 0, -1):
            end, back = np.unique(ends[0] & ((1 << (BITS * length)) - 1), return_inverse=True)
            ends.insert(0, end)
            below.insert(0, back)
        with np.errstate(divide="ignore", invalid="ignore"):
            at, found = _place(self.grams[0], ends[0])
            n = np.where(found, self.counts[0][at], 0) if self.seen else np.zeros(len(ends[0]))
            # after: log probability of a symbol the context has not seen, once all it has seen is excluded
            after = np.full(len(n), self.uniform)
            value = np.where(n > 0, np.log10((n - 0.5) / self.total), np.log10(self.seen / 2 / self.total) + after) if self.seen else after
            held = np.ones(len(n), bool)
            for length, back, (ctx, t, q, rest, fresh) in zip(range(2, self.order + 2), below, self.contexts):
                n, after, value = n[back], after[back], value[back]
                at, held = _place(ctx, ends[length - 1] >> BITS)
                if not len(ctx):
                    n = np.zeros(len(at))
                    continue
                t, q, rest, fresh = (x[at] for x in (t, q, rest, fresh))
                after = np.where(fresh > 0, np.where(n > 0, np.log10((n - 0.5) / rest), np.log10(fresh / 2 / rest) + after), after)
                at, found = _place(self.grams[length - 1], ends[length - 1])
                n = np.where(found, self.counts[length - 1][at], 0)
                value = np.where(held, np.where(n > 0, np.log10((n - 0.5) / t), np.log10(q / 2 / t) + after), value)
        return value, held

    def looked(self, texts: list[np.ndarray], all_held: bool) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Per text (symbols after their pads): the sum of the log10 probabilities of the symbols whose longest context is held, and the grams of the others with their counts.

        With ``all_held`` the longest context that is held decides, and no gram is left.
        """
        sums: list[list[float]] = [[] for _ in texts]
        left: list[list[tuple]] = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] for _ in texts]
        open_parts: list[tuple[int, np.ndarray]] = []

        def flush():
            if not open_parts:
                return
            distinct, back = np.unique(np.concatenate([g for _, g in open_parts]), return_inverse=True)
            value, held = self.values(distinct)
            value, held = value[back], held[back] | all_held
            start = 0
            for d, g in open_parts:
                v, h = value[start:start + len(g)], held[start:start + len(g)]
                start += len(g)
                sums[d].append(float(v[h].sum()))
                if not h.all():
                    left[d].append(np.unique(g[~h], return_counts=True))
            open_parts.clear()

        size = 0
        for d, s in enumerate(texts):
            for at in range(self.order, len(s), LOOKED):
                open_parts.append((d, grams_of(s, self.order, at, min(len(s), at + LOOKED))))
                size += len(open_parts[-1][1])
                if size >= LOOKED:
                    flush()
                    size = 0
        flush()
        return [(math.fsum(x), *_merged(g)) for x, g in zip(sums, left)]

    def log10(self, s: np.ndarray) -> float:
        """Log10 probability of symbols after their pads."""
        return self.looked([s], True)[0][0]


def _known(common: tuple) -> dict[bytes, int]:
    return dict(zip(common[0], common[1].tolist(), strict=True))


def adaptive_log10(words: list[bytes], order: int = 5) -> float:
    """Log10 probability of a text by a trie that starts empty and learns each symbol after coding it."""
    s = symbols(words, order).tolist()
    trie: dict[tuple, Counter] = {}
    total = 0.0
    for at in range(order, len(s)):
        x, excluded = s[at], set()
        contexts = [tuple(s[at - k:at]) for k in range(order, -1, -1)]
        for c in contexts:
            left = {y: n for y, n in trie.get(c, {}).items() if y not in excluded}
            if left:
                whole = sum(left.values())
                if x in left:
                    total += math.log10((left[x] - 0.5) / whole)
                    break
                total += math.log10(len(left) / 2 / whole)
                excluded |= left.keys()
        else:
            total -= math.log10(SYMBOLS - len(excluded))
        for c in contexts:
            trie.setdefault(c, Counter())[x] += 1
    return total


def language_model_scores(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 5,
                          mode: str = "pretrained", common_words: int = 1 << 18, max_contexts: int = 1 << 19, max_grams: int = 1 << 21) -> DataFrame:
    """One row (id, n_tokens, n_known, train_tokens, base_score, score) per input row.

    Tokens are the lower-cased (A-Z) words of a text and one end.  ``score`` is
    the PPM model's log10 probability of the text's words, joined by single
    spaces, and the end.  ``base_score`` is that of an add-one unigram model of
    the tokens of the rows where ``train_on`` holds, ``n_known`` the tokens that
    model has seen.  A null text is an empty one: its only token is the end.
    Repeated rows count and come back each; without training rows the unigram
    model has N = V = 0 and PPM predicts uniformly; an empty table gives an
    empty result.

    Word counts stay a table.  The ``common_words`` most frequent words of at most
    ``COMMON_BYTES`` bytes, a table of bounded size, are looked up in the tasks; the others, about one in twenty
    tokens, are joined by a shuffle in which no word is hot.  So are the PPM
    counts: ``max_contexts`` and ``max_grams`` bound what is looked up in the
    tasks, the grams of other contexts are joined with the table of all counts.
    """
    if mode not in ("pretrained", "adaptive"):
        raise ValueError(mode)
    spark = docs.sparkSession
    ready_workers(spark)
    raw = F.col(text_col).cast("binary")
    learn = docs.where(F.coalesce(train_on, F.lit(False))).select(raw.alias("t"))

    def count(batches):
        seen: Counter = Counter()
        texts = 0

        def rows():
            words = list(seen)
            for at in range(0, len(words), 1 << 16):
                part = words[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([seen[w] for w in part], pa.int64())], names=["word", "c"])
            seen.clear()

        for b in batches:
            texts += b.num_rows
            for x in b.column(0):
                seen.update(model_words(x.as_buffer().to_pybytes() if x.is_valid else None))
                if len(seen) > 1 << 19:
                    yield from rows()
        # the end of a text has no word: its count goes under null
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([texts], pa.int64())], names=["word", "c"])
        yield from rows()

    words = written(learn.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))
    n_all, v_all, ends = words.agg(F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.col("word").isNull(), F.col("c")))).first()
    n_all, ends = n_all or 0, ends or 0
    bottom = math.log10(n_all + v_all + 1)
    top = words.where(F.octet_length("word") <= COMMON_BYTES).orderBy(F.desc("c"), "word").limit(common_words).toArrow()
    common = Sent(spark, (top.column("word").to_pylist(), top.column("c").to_numpy()))
    trie, levels = train(learn, "t", order, max_contexts, max_grams) if mode == "pretrained" else (None, None)
    model, whole = Sent(spark, trie) if trie else None, levels is None

    def look(batches):
        known = common.built(_known)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 3)
        for b in (b.slice(at, SENT_ROWS) for b in batches for at in range(0, b.num_rows, SENT_ROWS)):
            cols: list[list] = [[] for _ in kinds]
            texts = [model_words(x.as_buffer().to_pybytes() if x.is_valid else None) for x in b.column(0)]
            scored = model.built(Tables).looked([symbols(w, order) for w in texts], whole) if model else [(adaptive_log10(w, order), (), ()) for w in texts]
            for w, (s, grams, gram_times) in zip(texts, scored):
                own = Counter(w)
                rest = [k for k in own if k not in known]
                # summed exactly, so that equal texts have equal sums
                logs = math.fsum(n * math.log10(known[k] + 1) for k, n in own.items() if k in known)
                times = [own[k] for k in rest]
                for c, v in zip(cols, (len(w) + 1, len(w) - sum(times) + (ends > 0), logs + math.log10(ends + 1), s, rest, times, grams, gram_times)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(1), *map(pa.array, cols, kinds)], names=["id", "n_tokens", "known", "logs", "score", "words", "times", "grams", "gram_times"])

    kind = docs.schema[id_col].dataType.simpleString()
    # what becomes of a document, once: rows are numbered where they are written
    looked = written(docs.select(raw.alias("t"), F.col(id_col).alias("id")).mapInArrow(
        look, f"id {kind}, n_tokens long, known long, logs double, score double, words array<binary>, times array<long>, grams array<long>, gram_times array<long>"
    ).withColumn("k", F.monotonically_increasing_id()))
    rare = looked.select("k", F.explode(F.arrays_zip("words", "times")).alias("p")).select("k", F.col("p.words").alias("word"), F.col("p.times").alias("n"))
    joined = rare.join(words.where("word is not null"), "word").groupBy("k").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    out = looked.join(joined, "k", "left")
    score = F.col("score")
    if not whole:
        asked = looked.select("k", F.explode(F.arrays_zip("grams", "gram_times")).alias("p")).select("k", F.col("p.grams").alias("gram"), F.col("p.gram_times").alias("n"))
        values = log10_of_grams(written(asked.select("gram").distinct()), levels)
        out = out.join(asked.join(values, "gram").groupBy("k").agg(F.sum(F.col("n") * F.col("value")).alias("more_score")), "k", "left")
        score = score + F.coalesce("more_score", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(bottom)).alias("base_score"), score.alias("score"))
