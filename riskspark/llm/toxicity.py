"""Toxicity classifier with counterfactual regularisation.

A logistic model over the presence of words and of word beginnings (one word,
and two words or more, that begin alike).  For every sentence of the
labelled sample that names a group, the identity term is swapped for each other
term of its family and for a neutral word, and the squared change of the
sentence's score is penalised (logit pairing, Garg et al. 2019).  What sets
toxic text apart then has to be carried by other words than the group's name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import written

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[.!?\n]+")
PART = 1 << 20
#: Stands for a neutral word in place of an identity term.
NEUTRAL = ""
#: Default families of identity terms (fixed values): terms of a family may stand for one another.
IDENTITY_TERMS = (
    ("women", "men", "woman", "man", "girls", "boys", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic", "elderly", "young"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados"),
)


def words_of(text: str) -> set[str]:
    """Distinct lower-case words of a whole text, read in parts."""
    text = text.lower()
    found: set[str] = set()
    at, n = 0, len(text)
    while at < n:
        end = at + PART
        while end < n and (text[end].isalnum() or text[end] == "_"):
            end += 1
        found.update(WORD.findall(text, at, end))
        at = end
    return found


def marks_of(text: str, spared: frozenset[str] = frozenset(), sizes: tuple[int, ...] = (4, 6)) -> set[str]:
    """The words of a text, and for longer words than each of ``sizes`` their beginning: ``abcd-`` for one, also ``abcd--`` for two or more.

    ``spared`` words, the identity terms, have no beginnings, so that only the word itself can carry weight.
    """
    words = words_of(text)
    out = set(words)
    for n in sizes:
        seen: set[str] = set()
        twice: set[str] = set()
        for w in words:
            if len(w) > n and w not in spared:
                (twice if (b := w[:n]) in seen else seen).add(b)
        out.update(f"{b}-" for b in seen)
        out.update(f"{b}--" for b in twice)
    return out


def swaps(text: str, families: Iterable[Iterable[str]]) -> Counter:
    """(term, substitute) -> sentences, each weighted 1 / substitutes: every identity term of every sentence, swapped."""
    family = {t: [*f] for f in families for t in f}
    found: Counter = Counter()
    for s in SENTENCE.split(text.lower()):
        present = set(WORD.findall(s))
        for t in present & family.keys():
            # a substitute the sentence holds already would not change a presence score for that word
            others = [o for o in family[t] if o not in present] + [NEUTRAL]
            for o in others:
                found[t, o] += 1 / len(others)
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Callable[[Column], Column], id_col: str, text_col: str, label_col: str,
                    per_class: int) -> tuple[DataFrame, float]:
    """At most ``per_class`` labelled documents of either class, distinct texts, as (text, y); and the positives' share of all training labels.

    The sample is those whose ids hash lowest; its ids, at most 2 * per_class
    of them, are the one thing broadcast.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & train(F.col(id_col))).groupBy(F.col(id_col).alias("l_id")).agg(F.max(label_col).alias("y"))
    total, positive = known.agg(F.count(F.lit(1)), F.sum((F.col("y") == 1).cast("long"))).first()
    order = [F.xxhash64("l_id"), F.col("l_id")]
    picked = known.where("y = 1").orderBy(*order).limit(per_class).unionByName(known.where("y <> 1").orderBy(*order).limit(per_class))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null").join(F.broadcast(picked), F.col("id") == F.col("l_id"))
    return texts.groupBy("t").agg(F.max((F.col("y") == 1).cast("int")).alias("y")), (positive or 0) / max(total, 1)


def learn(sample: DataFrame, share: float, families=IDENTITY_TERMS, size: int = 512, min_docs: int = 3, ridge: float = 0.2, pairing: float = 5.0) -> dict[str, float]:
    """Word weights, with the intercept under ``None``.

    The ``size`` words whose presence tells the classes apart best (likelihood
    ratio G) are found by counting in Spark; what reaches the driver is their
    presence in the sample, whose rows are bounded by its parameter, and one
    count per pair of identity terms.
    """
    sample = written(sample)
    spared = frozenset(t for f in families for t in f)

    def count(batches):
        for b in batches:
            n: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for t, y in zip(b.column("t"), b.column("y").to_pylist()):
                n[y].update(marks_of(t.as_py(), spared))
            words = list(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *[pa.array([n[y][w] for w in words], pa.int64()) for y in (0, 1)]], names=["word", "n0", "n1"])

    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    d0, d1 = sizes.get(0, 0), sizes.get(1, 0)
    if not d0 or not d1:
        return {None: math.log((share + 1e-6) / (1 - share + 1e-6))}
    n0, n1 = F.col("n0"), F.col("n1")

    def term(seen: Column, total: int) -> Column:
        p = (n0 + n1) / (d0 + d1)
        gone = F.lit(total) - seen
        return F.when(seen > 0, seen * F.log(seen / (p * total))).otherwise(0.0) + F.when(gone > 0, gone * F.log(gone / ((1 - p) * total))).otherwise(0.0)

    stats = sample.mapInArrow(count, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(n0 + n1 >= min_docs)
    best = stats.select("word", F.round(term(n0, d0) + term(n1, d1), 9).alias("g")).orderBy(F.desc("g"), "word").limit(size)
    vocab = [r["word"] for r in best.collect()]
    vocab += sorted(spared - set(vocab))
    place = {w: i for i, w in enumerate(vocab)}

    def vectors(batches):
        for b in batches:
            texts = b.column("t").to_pylist()
            rows = [sorted(place[w] for w in marks_of(t, spared) & place.keys()) for t in texts]
            pairs: Counter = Counter()
            for t in texts:
                pairs.update(swaps(t, families))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), b.column("y").cast(pa.int32()), pa.array([None] * len(rows), pa.string()), pa.array([None] * len(rows), pa.string()),
                                              pa.array([None] * len(rows), pa.float64())], names=["x", "y", "a", "b", "n"])
            if pairs:
                a, c, n = zip(*((a, c, n) for (a, c), n in pairs.items()))
                yield pa.RecordBatch.from_arrays([pa.array([None] * len(a), pa.list_(pa.int32())), pa.array([None] * len(a), pa.int32()), pa.array(a), pa.array(c), pa.array(n)], names=["x", "y", "a", "b", "n"])

    made = written(sample.mapInArrow(vectors, "x array<int>, y int, a string, b string, n double"))
    got = made.where("x is not null").select("x", "y").toArrow()
    lists = got.column("x").combine_chunks()
    x = np.zeros((len(got), len(vocab) + 1), np.float32)
    x[np.repeat(np.arange(len(got)), np.diff(lists.offsets.to_numpy())), lists.values.to_numpy()[lists.offsets.to_numpy()[0]:]] = 1
    x[:, -1] = 1
    y = got.column("y").to_numpy().astype(np.float32)
    pairs = [(place[r["a"]], place.get(r["b"], -1), r["n"]) for r in made.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()]
    w = _train(x, y, pairs, ridge, pairing)
    # from the sample's mix of classes to that of all training labels
    w[-1] += math.log(max(share, 1e-9) / max(1 - share, 1e-9)) - math.log(d1 / d0)
    return {word: float(v) for word, v in zip(vocab, w) if v} | {None: float(w[-1])}


def _train(x: np.ndarray, y: np.ndarray, pairs: list[tuple[int, int, float]], ridge: float, pairing: float, rounds: int = 500) -> np.ndarray:
    """Minimum of the log loss + ridge + pairing * mean squared score change over swaps, by accelerated gradient steps."""
    n, d = x.shape
    total = sum(p[2] for p in pairs)
    a, b = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    c = np.array([p[2] / total for p in pairs])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)).astype(np.float64)
    # back to the sample's odds: weights sum to 1 with both classes alike, the intercept is moved afterwards
    shift = math.log(y.sum() / (n - y.sum()))
    pull = np.full(d, ridge / n)
    pull[-1] = 0

    def gradient(w):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        g = x.T @ (weight * (p - y)).astype(np.float32) + pull * w
        if len(c):
            gap = 2 * pairing * c * (w[a] - np.where(b >= 0, w[b], 0))
            np.add.at(g, a, gap)
            np.add.at(g, b[b >= 0], -gap[b >= 0])
        return g

    # step from a power iteration on the Hessian's bound
    v = np.ones(d)
    for _ in range(30):
        v = x.T @ (weight * (x @ v.astype(np.float32))).astype(np.float32) / 4
        bound = float(np.linalg.norm(v))
        v = v / bound
    bound += pull.max() + (8 * pairing if len(c) else 0)
    w = look = np.zeros(d)
    for k in range(rounds):
        new = look - gradient(look) / bound
        look = new + k / (k + 3) * (new - w)
        if np.abs(new - w).max() < 1e-5:
            w = new
            break
        w = new
    w = w.copy()
    w[-1] += shift
    return w


def score(text: str | None, weights: dict[str, float], known: frozenset, spared: frozenset) -> float:
    # fsum: the same sum in whatever order the set yields its words
    f = weights[None] + (math.fsum(weights[w] for w in marks_of(text, spared) & known) if text else 0.0)
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, f))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, train: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", threshold: float = 0.3, per_class: int = 8192, families=IDENTITY_TERMS, **options) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (int, 1 from ``threshold`` on).

    ``train`` is a condition on the id; other labels are never read.  The model
    is fitted on at most ``per_class`` labelled documents of either class; every
    row is scored on its whole text.  A null or empty text has the score of no
    words at all, below one half unless most labels are positive.  Repeated rows
    each come back; labels that repeat an id count as positive if one is; without
    labels of both classes every score is the share of positives.  Input columns
    called score or predicted are replaced.
    """
    weights = learn(*labelled_sample(docs, labels, train, id_col, text_col, label_col, per_class), families, **options)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    spared = frozenset(t for f in families for t in f)

    @F.arrow_udf("double")
    def rate(v: pa.Array) -> pa.Array:
        known = frozenset(w for w in sent.value if w is not None)
        return pa.array([score(x.as_py(), sent.value, known, spared) for x in v], pa.float64())

    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*keep, rate(F.col(text_col)).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
