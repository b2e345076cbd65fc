"""Filters and predicates (2.3).

Plain predicates stay declarative so Catalyst pushes them into the
Parquet scan. The IQR filter is the one data-dependent filter: its
fences come from a small aggregate per column (trap T5: sequential).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_all(df: DataFrame, conds: dict | list[Column]) -> DataFrame:
    """Conjunctive filter: ``{'a': 1, 'b': 'x'}`` or a list of Columns (op 3.1/3.2)."""
    if isinstance(conds, dict):
        conds = [F.col(k) == F.lit(v) for k, v in conds.items()]
    return df.filter(reduce(lambda a, b: a & b, conds))


def isin(df: DataFrame, col: str, values: list, negate: bool = False, keep_null: bool | None = None) -> DataFrame:
    """Membership filter (op 3.3). pandas ``~isin`` keeps NULL rows, so for
    ``negate=True`` the default is to keep them; SQL ``NOT IN`` would not."""
    c = F.col(col).isin(list(values))
    if not negate:
        return df.filter(c)
    keep_null = True if keep_null is None else keep_null
    return df.filter(~c | F.col(col).isNull()) if keep_null else df.filter(~c)


def drop_null_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (op 3.4)."""
    return df.na.drop(how="any", subset=cols)


class IQRFences:
    """Fitted Tukey fences, one (low, high) per column in fit order."""

    def __init__(self, fences: list[tuple[str, float | None, float | None]], k: float):
        self.fences = fences
        self.k = k

    def transform(self, df: DataFrame) -> DataFrame:
        for c, lo, hi in self.fences:
            if lo is None:  # column had no non-null rows left -> nothing survives
                df = df.filter(F.lit(False))
            else:
                df = df.filter(F.col(c).between(lo, hi))
        return df


def fit_iqr(df: DataFrame, cols: list[str], k: float = 1.5, approx: bool = False,
            accuracy: int = 100_000, method: str = "auto") -> IQRFences:
    """Sequential Tukey fences (trap T5): the quartiles of column *i* are
    computed on the rows that survived columns < *i*; fences are inclusive.

    Exact quartiles per column by verified sketch brackets
    (:func:`quarry.operators.profile.exact_quantiles_multi`), or by the
    ``method`` given; ``approx=True`` uses ``percentile_approx``.
    """
    from quarry.operators.profile import exact_quantiles_bracketed, quantiles

    fences = []
    cur = df
    for c in cols:
        if approx or method in ("map", "sort"):
            rows = quantiles(cur, c, [0.25, 0.75], approx=approx, method="map" if approx else method).collect()
            qs = [r["value"] for r in sorted(rows, key=lambda r: r["prob"])] if rows else None
        else:
            got = exact_quantiles_bracketed(cur, c, [0.25, 0.75])  # three aggregates, whatever the distinct count
            qs = [got[0.25], got[0.75]]
        if not qs or qs[0] is None:
            fences.append((c, None, None))
            cur = cur.filter(F.lit(False))
            continue
        q1, q3 = qs
        iqr = q3 - q1
        lo, hi = q1 - k * iqr, q3 + k * iqr
        fences.append((c, lo, hi))
        cur = cur.filter(F.col(c).between(lo, hi))
    return IQRFences(fences, k)


def iqr_filter(df: DataFrame, cols: list[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Fit the fences on ``df`` and apply them (op 3.5)."""
    return fit_iqr(df, cols, k, approx).transform(df)


def sample_n(df: DataFrame, n: int, seed: int = 42, key: list[str] | None = None, method: str = "xxhash64") -> DataFrame:
    """Exactly ``n`` rows chosen by a seeded hash of ``key`` (default: all
    columns) — stable across plans and partitionings, unlike ``rand``.
    Top-n by hash: each task keeps ``n`` candidates, the driver merges
    ``tasks * n`` rows (``n`` is the feature's own bound). ``method='md5'``
    orders by md5('seed:key...'), the same in any SQL engine."""
    key = key or df.columns
    if method == "md5":
        h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    else:
        h = F.xxhash64(F.lit(seed), *[F.col(c) for c in key])
    return df.withColumn("__h", h).orderBy("__h", *key).limit(n).drop("__h")


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Bernoulli sample by seeded hash (no shuffle, stable)."""
    key = key or df.columns
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key]), F.lit(1_000_000))
    return df.filter(h < int(fraction * 1_000_000))


def head_by(df: DataFrame, order: list[str] | str, n: int = 5) -> DataFrame:
    order = [order] if isinstance(order, str) else order
    return df.orderBy(*order).limit(n)


def tail_by(df: DataFrame, order: list[str] | str, n: int = 5) -> DataFrame:
    order = [order] if isinstance(order, str) else order
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)
