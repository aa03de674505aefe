"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a logistic model by the
non-negative unbiased risk (du Plessis et al. 2015, Kiryo et al. 2017): with
class prior pi,

    pi * E_P[l(f, 1)] + max(0, E_U[l(f, -1)] - pi * E_P[l(f, -1)]).

The prior is estimated first, from a model that tells positives from unlabelled
text: where no negatives mix in, the density ratio of the two is 1 / pi.  Labels
of value 0 are never used.  Every step sums gradients and Hessians over all
documents inside the tasks; the driver holds a few hundred numbers.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ready_workers, written

PART = 1 << 20
#: Byte classes whose shares of the text are features.
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:", b"!", b"?", b"|",
           b"#$%&*@^~", b"<>{}[]()", b"/\\=_+-", b"'\"`")
FEATURES = 24
_MEMBER = np.zeros((256, len(CLASSES) + 1), np.float64)
for _k, _c in enumerate(CLASSES):
    _MEMBER[np.frombuffer(_c, np.uint8), _k] = 1
_MEMBER[128:, len(CLASSES)] = 1


def features(text: bytes | None) -> np.ndarray:
    """Numbers about the form of a whole text; zeros for an empty one.  Texts of any length: counted in parts."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    shares = counts @ _MEMBER / n
    k = len(shares)
    out[:k] = np.log1p(100 * shares)
    p = counts[counts > 0] / n
    out[k] = -(p * np.log2(p)).sum()
    words = size = odd = same = 0
    last, seen = None, Counter()
    packer, packed = zlib.compressobj(1), 0
    at = 0
    while at < n:
        end = at + PART
        while end < n and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        part = text[at:end]
        packed += len(packer.compress(part))
        found = part.split()
        words += len(found)
        size += sum(map(len, found))
        odd += sum(w[-1:].isalnum() for w in found)
        same += sum(map(eq, found, [last, *found]))
        last = found[-1] if found else last
        seen.update(found)
        at = end
    packed += len(packer.flush())
    lines = text.count(b"\n") + 1
    w = max(words, 1)
    distinct, most = len(seen), max(seen.values(), default=0)
    out[k + 1] = packed / n
    out[k + 2] = math.log1p(words)
    out[k + 3] = size / w / 10
    out[k + 4] = distinct / w
    out[k + 5] = math.log1p(distinct) / math.log(w + 1.5)
    out[k + 6] = most / w
    out[k + 7] = same / w
    out[k + 8] = odd / w
    out[k + 9] = math.log1p(words / lines)
    return out


def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def count(v: pa.Array) -> pa.Array:
        rows = np.array([features(x.as_buffer().to_pybytes() if x.is_valid else None) for x in v], np.float32).reshape(len(v), FEATURES)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, FEATURES), pa.int32()), pa.array(rows.ravel()))

    return count(text.cast("binary"))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


def _design(b: pa.RecordBatch, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    x = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1).astype(np.float64)
    return np.hstack([(x - mean) / scale, np.ones((len(x), 1))])


def _sums(frame: DataFrame, step, width: int) -> np.ndarray:
    """Sum over all rows of the vectors that ``step`` makes of each batch: one row of ``width`` numbers per task leaves it."""
    def run(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += step(b)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["i", "v"])

    out = np.zeros(width)
    for r in frame.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def fit(frame: DataFrame, ridges: tuple[float, float] = (1e-2, 1e-3), steps: int = 25) -> Model | None:
    """Model of ``frame`` (x array, positive boolean): positives are the trusted sample, and every row is unlabelled text.

    Three descents by Newton steps with halving: positives against unlabelled
    text (for the prior), the PU risk with the logistic loss, which is convex,
    and from there the PU risk with the sigmoid loss, whose bound keeps far-off
    rows from deciding.
    """
    d = FEATURES
    e = d + 1

    def moments(b):
        x = _design(b, np.zeros(d), np.ones(d))[:, :d]
        pos = b.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        return np.concatenate([[len(x), pos.sum()], x.sum(0), (x * x).sum(0)])

    m = _sums(frame, moments, 2 + 2 * d)
    n_u, n_p = m[0], m[1]
    if not n_p:
        return None
    mean = m[2:2 + d] / n_u
    scale = np.sqrt(np.maximum(m[2 + d:] / n_u - mean ** 2, 0))
    scale[scale < 1e-6] = 1.0

    def statistics(w: np.ndarray, bounded: bool) -> dict[str, np.ndarray]:
        """Means over P and U of the losses and their derivatives for label 1 (p) and -1 (n)."""
        def step(b):
            x = _design(b, mean, scale)
            pos = b.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            f = x @ w
            s = _sigmoid(f)
            bend = s * (1 - s)
            # loss, slope in f: logistic or sigmoid; their curvature is bent to be positive
            p, n, dp, dn = (1 - s, s, -bend, bend) if bounded else (np.logaddexp(0, -f), np.logaddexp(0, f), s - 1, s)
            h = x * bend[:, None]
            return np.concatenate([[p[pos].sum(), n[pos].sum(), n.sum()], dp[pos] @ x[pos], dn[pos] @ x[pos], dn @ x, (x[pos].T @ h[pos]).ravel(), (x.T @ h).ravel()])

        t = _sums(frame, step, 3 + 3 * e + 2 * e * e)
        at = np.cumsum([0, 1, 1, 1, e, e, e, e * e, e * e])
        names = ("p_P", "n_P", "n_U", "dp_P", "dn_P", "dn_U", "h_P", "h_U")
        return {k: t[i:j] / (n_u if k.endswith("U") else n_p) for k, i, j in zip(names, at, at[1:])}

    def descend(w: np.ndarray, ridge: float, prior: float | None, bounded: bool = False) -> np.ndarray:
        """prior None: positives against unlabelled text, each at weight 1/2; else the non-negative PU risk at that prior."""
        pull = np.append(np.full(d, ridge), 1e-9)

        def parts(w, t):
            """Risk, gradient and curvature."""
            h_p, h_u = t["h_P"].reshape(e, e), t["h_U"].reshape(e, e)
            if prior is None:
                value, grad, hess = (t["p_P"] + t["n_U"])[0] / 2, (t["dp_P"] + t["dn_U"]) / 2, (h_p + h_u) / 2
            else:
                negative = (t["n_U"] - prior * t["n_P"])[0]
                value, grad, hess = prior * t["p_P"][0] + max(0.0, negative), prior * t["dp_P"], prior * h_p
                # below 0 the part for negatives counts as 0
                if negative >= 0:
                    grad = grad + t["dn_U"] - prior * t["dn_P"]
                    hess = hess + h_u if bounded else h_u
            return value + ridge / 2 * w[:d] @ w[:d], grad + pull * w, hess + np.diag(pull + 1e-6)

        value, grad, hess = parts(w, statistics(w, bounded))
        for _ in range(steps):
            move, size = np.linalg.solve(hess, grad), 1.0
            while True:
                new = w - size * move
                now, new_grad, new_hess = parts(new, statistics(new, bounded))
                if now < value or size < 1e-2:
                    break
                size /= 2
            if now >= value:
                break
            gain, w, value, grad, hess = value - now, new, now, new_grad, new_hess
            if gain < 1e-5:
                break
        return w

    g = descend(np.zeros(e), ridges[0], None)

    def ratio(b):
        pos = b.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        # at equal class weights the odds are the density ratio
        return np.array([np.exp(np.clip(_design(b, mean, scale)[pos] @ g, -10, 10)).sum()])

    prior = float(np.clip(n_p / _sums(frame, ratio, 1)[0], n_p / n_u * 0.5, 0.99))
    w = descend(np.zeros(e), ridges[0], prior)
    return Model(mean, scale, descend(w, ridges[1], prior, bounded=True), prior)


def score_column(x: Column, model: Model | None, empty: Column) -> Column:
    """Probability of a positive, in SQL functions; 0.5 without a model, 0 for an empty text."""
    if model is None:
        return F.when(empty, F.lit(0.0)).otherwise(F.lit(0.5))
    w = model.weights[:-1] / model.scale
    bias = float(model.weights[-1] - (w * model.mean).sum())
    f = F.lit(bias)
    for k, v in enumerate(w.tolist()):
        f = f + F.element_at(x, k + 1).cast("double") * F.lit(v)
    return F.when(empty, F.lit(0.0)).otherwise(1 / (1 + F.exp(-f)))


def quality_scores(docs: DataFrame, labels: DataFrame, train: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row (id, score, predicted, prior) per input row.

    ``train`` is a condition on the id: only labels of value 1 that meet it are
    trusted positives, and only documents that meet it are unlabelled text.
    Labels may repeat (one of value 1 is enough), be null or lack a document.
    An empty or null text scores 0: it holds nothing of quality.  Without any
    positive there is no model and every other text scores 0.5.
    """
    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(~F.col(text_col).rlike(r"\S"), F.lit(True)).alias("empty"), feature_column(F.col(text_col)).alias("x"))
    table = written(rows)
    known = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id"), F.lit(True).alias("positive")).distinct()
    frame = written(table.where(train(F.col("id")) & ~F.col("empty")).join(known, "id", "left").select("x", F.coalesce("positive", F.lit(False)).alias("positive")))
    model = fit(frame)
    score = score_column(F.col("x"), model, F.col("empty"))
    return table.select(F.col("id").alias(id_col), score.alias("score")).select(
        id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), F.lit(model.prior if model else None).cast("double").alias("prior"))
