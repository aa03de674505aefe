"""Column builders for projections and scalar functions (PRJ-*, FN-*).

All of these are plain Catalyst expressions: they stay inside whole-stage
codegen and need no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel meaning "not employed" in day-count columns.
DAYS_SENTINEL = 365243


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_flag(c: str | Column, sentinel=DAYS_SENTINEL) -> Column:
    """PRJ-01: 1 where the column holds the sentinel, else 0 (NULL -> 0)."""
    return F.coalesce((col(c) == F.lit(sentinel)).cast("int"), F.lit(0))


def sentinel_to_null(c: str | Column, sentinel=DAYS_SENTINEL) -> Column:
    """PRJ-01: sentinel replaced by NULL."""
    return F.nullif(col(c), F.lit(sentinel))


def guarded_ratio(a: str | Column, b: str | Column, smoothing: float = 1.0) -> Column:
    """PRJ-02: ``a / (b + smoothing)``; NULL instead of an ANSI error on zero."""
    return F.try_divide(col(a), col(b) + F.lit(smoothing))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b`` with NULL on a zero or NULL denominator (PRJ-19, PRJ-21)."""
    return F.try_divide(col(a), col(b))


def days_to_years(c: str | Column, year_days: float = 365.0) -> Column:
    """PRJ-03: negative day offsets -> positive years."""
    return -col(c) / F.lit(year_days)


def _present(cols) -> Column:
    return F.filter(F.array(*[col(c).cast("double") for c in cols]), lambda x: x.isNotNull())


def row_mean(cols) -> Column:
    """PRJ-04: mean of the non-null values of a row; NULL when none."""
    arr = _present(cols)
    return F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr))


def row_product(cols) -> Column:
    """PRJ-04: product of the non-null values; the empty product is 1.0."""
    return F.aggregate(_present(cols), F.lit(1.0), lambda a, x: a * x)


def row_count(cols) -> Column:
    """PRJ-04: number of non-null values."""
    return F.size(_present(cols))


def row_std(cols) -> Column:
    """PRJ-04: sample standard deviation of the non-null values; NULL below 2."""
    arr = _present(cols)
    n = F.size(arr)
    mean = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / n
    ss = F.aggregate(arr, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def missing_flag(c: str | Column) -> Column:
    """PRJ-05: 1 if NULL else 0."""
    return F.isnull(col(c)).cast("int")


def missing_count(cols) -> Column:
    """PRJ-05: number of NULL inputs in the row."""
    return reduce(add, [missing_flag(c) for c in cols], F.lit(0))


def prefix_sum(columns: list[str], prefix: str) -> Column:
    """PRJ-06: sum of every column whose name starts with ``prefix`` (NULL as 0)."""
    picked = [c for c in columns if c.startswith(prefix)]
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in picked], F.lit(0))


def flag(pred: Column) -> Column:
    """PRJ-07: predicate -> 0/1 with NULL -> 0 (pandas NaN comparisons are False)."""
    return F.coalesce(pred.cast("int"), F.lit(0))


def one_hot(c: str, levels: list, drop_first: bool = True, prefix: str | None = None) -> list[Column]:
    """PRJ-08: dummy columns for sorted ``levels``; NULL gives all zeros.

    ``levels`` is the small sorted list of distinct values (see
    ``operators.features.distinct_levels``), never the data.
    """
    lv = sorted(levels)
    if drop_first:
        lv = lv[1:]
    p = prefix or c
    return [flag(F.col(c) == F.lit(v)).alias(f"{p}_{v}") for v in lv]


def weighted_composite(weights: dict[str, float]) -> Column:
    """PRJ-11: linear composite with NULL inputs taken as 0."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w) for c, w in weights.items()])


def clip(c: str | Column, lo=None, hi=None) -> Column:
    """PRJ-12 / FN-01: clip to [lo, hi]."""
    out = col(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def clip_fill(c: str | Column, lo, hi, fill) -> Column:
    """PRJ-12: clip then fill NULL."""
    return F.coalesce(clip(c, lo, hi), F.lit(fill))


def log1p_pos(c: str | Column) -> Column:
    """PRJ-13: ``log1p(max(x, 0))``."""
    return F.log1p(F.greatest(col(c), F.lit(0.0)))


def band(p: str | Column, cuts: list[float], labels: list[str]) -> Column:
    """PRJ-14/15: ``labels[i]`` for ``cuts[i-1] <= p < cuts[i]``; last label above the last cut."""
    assert len(labels) == len(cuts) + 1
    expr = None
    for cut, lab in zip(cuts, labels[:-1]):
        expr = F.when(col(p) < F.lit(cut), F.lit(lab)) if expr is None else expr.when(col(p) < F.lit(cut), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1])) if expr is not None else F.lit(labels[0])


# Default three-zone band labels and cut points.
THREE_BANDS = ["GREEN", "AMBER", "RED"]
THREE_CUTS = [0.20, 0.40]
# The four-band variant (5 / 10 / 20 %).
FOUR_BANDS = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
FOUR_CUTS = [0.05, 0.10, 0.20]


def decode(c: str | Column, mapping: dict) -> Column:
    """PRJ-16: code -> label through a literal map, falling back to the code as text."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col(c)), col(c).cast("string"))


def regime_shift(day: str | Column, schedule: list[tuple[int, float]]) -> Column:
    """PRJ-17: additive shift by batch regime; ``schedule`` = [(from_day, shift)], latest first wins."""
    expr = None
    for d, s in sorted(schedule, key=lambda t: -t[0]):
        expr = F.when(col(day) >= F.lit(d), F.lit(s)) if expr is None else expr.when(col(day) >= F.lit(d), F.lit(s))
    return expr.otherwise(F.lit(0.0))


def stable_unit(key: str | Column, salt: str) -> Column:
    """Deterministic uniform [0,1) from md5(key:salt) (shared with the SQL oracle)."""
    h = F.md5(F.concat(col(key).cast("string"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def event_time(base_date: str, key: str | Column, salt: str, max_days: int) -> Column:
    """PRJ-18: attach a date = base + deterministic offset in [0, max_days) drawn from the key hash."""
    off = F.floor(stable_unit(key, salt) * F.lit(max_days)).cast("int")
    return F.date_add(F.to_date(F.lit(base_date)), off)


def foir(obligations: str | Column, annuity: str | Column, income: str | Column) -> Column:
    """PRJ-19: (obligations + annuity) / income, NULL on zero income."""
    return F.try_divide(F.coalesce(col(obligations), F.lit(0.0)) + col(annuity), col(income))


def first_hit(rules: list[tuple[str, Column]], default: str | None = None) -> Column:
    """PRJ-20: name of the first rule whose predicate holds (NULL predicate = no hit)."""
    expr = None
    for name, pred in rules:
        p = F.coalesce(pred, F.lit(False))
        expr = F.when(p, F.lit(name)) if expr is None else expr.when(p, F.lit(name))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def hits(rules: list[tuple[str, Column]]) -> Column:
    """PRJ-22: array of the names of all rules that hold."""
    return F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in rules]))


def log_terms(p: str | Column, eps: float = 1e-6) -> tuple[Column, Column]:
    """FN-02: ``ln p`` and ``ln (1-p)`` with epsilon clipping."""
    pc = clip(p, eps, 1 - eps)
    return F.log(pc), F.log(F.lit(1.0) - pc)


def logit(p: str | Column, eps: float = 1e-6) -> Column:
    pc = clip(p, eps, 1 - eps)
    return F.log(pc / (F.lit(1.0) - pc))


def interp(x: str | Column, xs: list[float], ys: list[float]) -> Column:
    """FN-03: piecewise-linear interpolation on an increasing curve, clamped at both ends.

    The curve (a few hundred points at most) travels as two array literals;
    the segment is located with ``size(filter(xs, e -> e <= x))``.
    """
    ax = F.array(*[F.lit(float(v)) for v in xs])
    ay = F.array(*[F.lit(float(v)) for v in ys])
    n = len(xs)
    v = col(x)
    k = F.size(F.filter(ax, lambda e: e <= v))  # number of knots <= v
    x0, x1 = F.element_at(ax, F.greatest(k, F.lit(1))), F.element_at(ax, F.least(k + 1, F.lit(n)))
    y0, y1 = F.element_at(ay, F.greatest(k, F.lit(1))), F.element_at(ay, F.least(k + 1, F.lit(n)))
    lerp = y0 + (y1 - y0) * F.try_divide(v - x0, x1 - x0)
    return (
        F.when(v.isNull(), F.lit(None))
        .when(k <= 0, F.lit(float(ys[0])))
        .when(k >= n, F.lit(float(ys[-1])))
        .otherwise(F.coalesce(lerp, y0))
    )


def tokens(text: str | Column) -> Column:
    """FN-05: lower-case whitespace tokens, empties dropped (``array_remove`` stays in codegen)."""
    return F.array_remove(F.split(F.lower(F.trim(col(text))), r"\s+"), "")


def paragraphs(text: str | Column) -> Column:
    """FN-06: split on blank lines, trim, drop empties."""
    return F.filter(F.transform(F.split(col(text), r"\n\s*\n"), lambda s: F.trim(s)), lambda s: s != F.lit(""))


def reason_string(name: str | Column, value: str | Column, contrib: str | Column) -> Column:
    """FN-07: ``name: value (+0.1234)``."""
    return F.format_string("%s: %s (%+.4f)", col(name), col(value).cast("string"), col(contrib))


def row_hash(*cols: str | Column, sep: str = "|") -> Column:
    """FN-08: SHA-256 over the fields joined by ``sep`` (NULL written as empty)."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]), 256)


def fill_from(c: str, default) -> Column:
    """FN-09: value with a default (medians at serving time)."""
    return F.coalesce(F.col(c), F.lit(default)).alias(c)


def fixed_length(seq: str | Column, n: int, zero: Column) -> Column:
    """FN-10 / WIN-02: keep the last ``n`` elements, left-pad with ``zero``."""
    s = col(seq)
    tail = F.when(F.size(s) > n, F.slice(s, F.size(s) - n + 1, n)).otherwise(s)
    return F.concat(F.array_repeat(zero, F.greatest(F.lit(n) - F.size(tail), F.lit(0))), tail)


def count_le(arr: str | Column, value: str | Column, max_len: int) -> Column:
    """Number of elements <= value in an ascending array (at most ``max_len`` long), by
    binary search: ``aggregate`` over the halving step sizes, i.e. log2(max_len)
    comparisons per row instead of a ``filter`` over the whole array."""
    a, v = col(arr), col(value)
    n = F.size(a)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, max_len).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda lo, st: F.when(
        (lo + st <= n) & (F.try_element_at(a, lo + st) <= v), lo + st).otherwise(lo))


def r6(c: str | Column) -> Column:
    """FN-12: round half-up to 6 decimals (report precision)."""
    return F.round(col(c), 6)
