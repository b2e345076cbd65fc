"""Profiles and distribution statistics (5.19-5.34, re-aimed plots).

Everything is computed as one (or a fixed few) aggregate passes and
returned in *long* form, one row per column or per (column, statistic):
a profile of a 100-column table is one job, not 100.

Quantiles are exact and linearly interpolated by default (``percentile``,
trap T4), equal to DuckDB ``quantile_cont``. ``approx=True`` switches to
``percentile_approx`` (bounded memory) for high-cardinality doubles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.schema import columns_of


# Exact percentiles keep a value->count map per group that is merged in
# one task per group; its size is bounded by the column's distinct count.
# Up to this many distinct values (a map of ~tens of MB) the map is used,
# above it radix selection (nothing held per group).
MAP_DISTINCT_LIMIT = 1_000_000
# With groups a task holds one map per group that it meets, each of up to the
# distinct count, several times over while they are merged and sorted.
GROUPED_MAP_DISTINCT = 20_000


def _q(col: Column, probs: list[float], approx: bool, accuracy: int = 100_000) -> Column:
    if approx:
        return F.percentile_approx(col.cast("double"), list(probs), accuracy)
    return F.percentile(col.cast("double"), F.array(*[F.lit(float(p)) for p in probs]))


# Global (ungrouped) quantiles of columns with more distinct values than
# this use the bracketing method (sketch + verified narrow fetch).
BRACKET_MIN_DISTINCT = 50_000


def quantile_method(df: DataFrame, col: str, method: str = "auto", grouped: bool = False) -> str:
    """Resolve 'auto' to 'map' (bounded distinct count, checked with a
    HyperLogLog sketch), 'bracket' (global, many distinct values) or
    'sort' (grouped, unbounded distinct values)."""
    return quantile_methods(df, [col], method, grouped)[col]


def quantile_methods(df: DataFrame, cols: list[str], method: str = "auto", grouped: bool = False) -> dict[str, str]:
    """:func:`quantile_method` for several columns with ONE sketch job."""
    if method != "auto" or not cols:
        return {c: method for c in cols}
    row = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        nd = row[c] or 0
        if not grouped and nd > BRACKET_MIN_DISTINCT:
            out[c] = "bracket"
        else:
            out[c] = "map" if nd <= (min(GROUPED_MAP_DISTINCT, MAP_DISTINCT_LIMIT) if grouped else MAP_DISTINCT_LIMIT) else "sort"
    return out


BRACKET_COLLECT_LIMIT = 200_000


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10_000,
                          collect_limit: int = BRACKET_COLLECT_LIMIT) -> dict[str, dict[float, float | None]]:
    """Exact linear-interpolated global quantiles of several columns in three
    aggregates, with bounded memory.

    The first counts and sketches all columns (``percentile_approx``; its rank
    error is at most n / accuracy), which brackets every rank by two values. The
    second counts the values below and up to each bracket, which proves it or
    not. The third sorts the at most ``collect_limit`` values of each bracket
    and takes the rank inside; only those values reach the driver. A larger
    bracket (extreme n or a hot value) is searched again inside.
    """
    eps = 3.0 / accuracy
    xs = {c: F.col(c).cast("double") for c in cols}
    qs = [q for p in probs for q in (max(0.0, p - eps), min(1.0, p + eps))]
    row = df.agg(*[F.count(xs[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                 *[F.percentile_approx(xs[c], qs, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    n = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    bracket = {(c, p): (row[f"q{i}"][2 * j], row[f"q{i}"][2 * j + 1])
               for i, c in enumerate(cols) if n[c] for j, p in enumerate(probs)}
    if not bracket:
        return {c: {p: None for p in probs} for c in cols}
    keys = list(bracket)
    checks = df.agg(*[e.alias(f"{name}{k}") for k, (c, p) in enumerate(keys) for name, e in _bracket_counts(xs[c], *bracket[c, p]).items()]).first()
    picks, value = [], {}
    for k, (c, p) in enumerate(keys):
        (lo, hi), below, upto = bracket[c, p], checks[f"lt{k}"], checks[f"le{k}"]
        h = (n[c] - 1) * p
        for r in {math.floor(h), math.ceil(h)}:
            inside = xs[c].between(lo, hi)
            if not below <= r < upto:  # the rank lies outside: exact on the whole column
                value[c, p, r] = _value_at(df.select(xs[c].alias("__x")).filter("__x is not null"), r, n[c], accuracy, collect_limit, 0)
            elif r < checks[f"le_lo{k}"]:  # an end of the bracket, however often it occurs
                value[c, p, r] = lo
            elif r >= checks[f"lt_hi{k}"]:
                value[c, p, r] = hi
            elif upto - below <= collect_limit:
                picks.append((c, p, r, F.sort_array(F.collect_list(F.when(inside, xs[c])))[r - below]))
            else:
                part = df.select(xs[c].alias("__x")).filter((F.col("__x") > lo) & (F.col("__x") < hi))
                value[c, p, r] = _value_at(part, r - checks[f"le_lo{k}"], checks[f"lt_hi{k}"] - checks[f"le_lo{k}"], accuracy, collect_limit, 1)
    if picks:
        got = df.agg(*[e.alias(f"v{i}") for i, (*_, e) in enumerate(picks)]).first()
        value |= {(c, p, r): got[f"v{i}"] for i, (c, p, r, _) in enumerate(picks)}
    out = {}
    for c in cols:
        out[c] = {}
        for p in probs:
            h = (n[c] - 1) * p
            lo, hi = (value.get((c, p, f(h))) if n[c] else None for f in (math.floor, math.ceil))
            out[c][p] = lo if lo is None or lo == hi else lo + (hi - lo) * (h - math.floor(h))
    return out


def exact_quantiles_bracketed(df: DataFrame, col: str, probs: list[float], accuracy: int = 10_000,
                              collect_limit: int = BRACKET_COLLECT_LIMIT) -> dict[float, float | None]:
    """:func:`exact_quantiles_multi` for one column."""
    return exact_quantiles_multi(df, [col], probs, accuracy, collect_limit)[col]


def _value_at(base: DataFrame, r: int, n: int, accuracy: int, limit: int, depth: int) -> float:
    """Value at the 0-based rank r of ``__x`` in ``base`` (n rows)."""
    if n <= limit or depth > 6:
        return _nth(base, r)
    eps = 3.0 / accuracy
    lo, hi = base.agg(F.percentile_approx("__x", [max(0.0, r / n - eps), min(1.0, (r + 1) / n + eps)], accuracy).alias("q")).first()["q"]
    c = base.agg(*[e.alias(name) for name, e in _bracket_counts(F.col("__x"), lo, hi).items()]).first()
    if not c["lt"] <= r < c["le"]:
        return _nth(base, r)
    if r < c["le_lo"]:
        return lo
    if r >= c["lt_hi"]:
        return hi
    inside = base.filter((F.col("__x") > lo) & (F.col("__x") < hi))
    return _value_at(inside, r - c["le_lo"], c["lt_hi"] - c["le_lo"], accuracy, limit, depth + 1)


def _bracket_counts(x: Column, lo: float, hi: float) -> dict[str, Column]:
    """Values below, and up to, each end of a bracket."""
    return {"lt": F.count_if(x < lo), "le_lo": F.count_if(x <= lo), "lt_hi": F.count_if(x < hi), "le": F.count_if(x <= hi)}


def _nth(base: DataFrame, r: int) -> float:
    """The value at rank r, by radix selection; one row fetched. (A sort with an
    offset would send the first r rows of every task to the driver.)"""
    from quarry.operators.selection import order_code, select_ranks

    x = F.col("__x")
    return select_ranks(base, [], {"__x": order_code(x)}, lambda n: F.array(F.lit(r).cast("bigint")), {"__x": x}).first()["value"]


def exact_quantiles_sorted(df: DataFrame, col: str, probs: list[float], keys=None) -> DataFrame:
    """Exact linear-interpolated quantiles by rank, ``(keys..., prob, value)``: the
    values at ranks floor/ceil((n - 1) p) of every group, found by radix selection
    (:func:`quarry.operators.selection.select_ranks`), no sort; no task ever
    holds a group's values. A group without values has no rows, a table without
    values has NULLs."""
    out = exact_quantiles_radix(df, [col], probs, keys).drop("column")
    if keys:
        return out
    all_probs = df.sparkSession.createDataFrame([(float(p),) for p in probs], "prob double")
    return all_probs.join(out, "prob", "left")


def _few_groups(df: DataFrame, keys: list[str]) -> bool:
    """One row per group can be broadcast."""
    from quarry.operators.selection import BROADCAST_GROUPS

    return df.select(*keys).distinct().limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS


def exact_quantiles_grouped(df: DataFrame, col: str, probs: list[float], keys, accuracy: int = 10_000,
                            collect_limit: int = BRACKET_COLLECT_LIMIT) -> DataFrame:
    """:func:`exact_quantiles_sorted` of every group, ``(keys..., prob, value)``, by the
    brackets of :func:`exact_quantiles_multi` as grouped aggregates: a sketch per
    group, the counts that prove it, the at most ``collect_limit`` values inside. A group
    with a bracket that fails or is larger has its ranks selected by radix, and
    so have the groups of a table with more than ``BROADCAST_GROUPS`` of them."""
    from quarry.operators.joins import join_on_keys
    from quarry.session import cut_lineage

    keys = [keys] if isinstance(keys, str) else list(keys or [])
    if not keys or not _few_groups(df, keys):
        return exact_quantiles_sorted(df, col, probs, keys)
    eps = 3.0 / accuracy
    qs = [q for p in probs for q in (max(0.0, p - eps), min(1.0, p + eps))]
    rows = df.select(*keys, F.col(col).cast("double").alias("__x")).filter("__x is not null")
    sketch = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx("__x", qs, accuracy).alias("__q")))
    x, n = F.col("__x"), len(probs)
    ends = [(F.col("__q")[2 * j], F.col("__q")[2 * j + 1]) for j in range(n)]
    counts = join_on_keys(rows, F.broadcast(sketch), keys, "left").groupBy(*keys).agg(
        F.first("__n").alias("__n"), F.first("__q").alias("__q"),
        F.array(*[F.struct(*[e.alias(name) for name, e in _bracket_counts(x, *ends[j]).items()]) for j in range(n)]).alias("__c"))
    ranks = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    both = [(f(h).cast("bigint"), F.col("__c")[j]) for j, h in enumerate(ranks) for f in (F.floor, F.ceil)]
    sure = [(r >= c["lt"]) & (r < c["le"]) & ((r < c["le_lo"]) | (r >= c["lt_hi"]) | (c["lt_hi"] - c["le_lo"] <= collect_limit)) for r, c in both]
    ok = sure[0]
    for e in sure[1:]:
        ok = ok & e
    counts = cut_lineage(counts.withColumn("__ok", ok))
    good = counts.filter("__ok").select(*keys, "__n", "__q", "__c")
    inside = [F.when((x > lo) & (x < hi), x) for lo, hi in ends]
    got = join_on_keys(rows, F.broadcast(good), keys, "left").filter("__q is not null").groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("__n", "__q", "__c")],
        *[F.sort_array(F.collect_list(e)).alias(f"__v{j}") for j, e in enumerate(inside)])
    out = []
    for j, (p, h) in enumerate(zip(probs, ranks)):
        c, (lo, hi) = F.col("__c")[j], ends[j]

        def at(r, c=c, lo=lo, hi=hi, j=j):
            return F.when(r < c["le_lo"], lo).when(r >= c["lt_hi"], hi).otherwise(F.get(F.col(f"__v{j}"), (r - c["le_lo"]).cast("int")))

        a, b = at(F.floor(h).cast("bigint")), at(F.ceil(h).cast("bigint"))
        out.append(F.struct(F.lit(float(p)).alias("prob"), F.when(a == b, a).otherwise(a + (b - a) * (h - F.floor(h))).alias("value")))
    res = got.select(*keys, F.explode(F.array(*out)).alias("__s")).select(*keys, "__s.*")
    rest = counts.filter(~F.col("__ok")).select(*keys, F.lit(True).alias("__rest"))
    if rest.isEmpty():
        return res
    left = join_on_keys(rows, F.broadcast(rest), keys, "left").filter("__rest")
    return res.unionByName(exact_quantiles_sorted(left, "__x", probs, keys))


def exact_quantiles_radix(df: DataFrame, cols: list[str], probs: list[float], keys=None) -> DataFrame:
    """:func:`exact_quantiles_sorted` of several columns at once, ``(keys..., column, prob, value)``."""
    from quarry.operators.selection import order_code, quantile_ranks, select_ranks

    keys = [keys] if isinstance(keys, str) else list(keys or [])
    x = {c: F.col(c).cast("double") for c in cols}
    got = select_ranks(df, keys, {c: order_code(e) for c, e in x.items()}, quantile_ranks(probs), x)
    h = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    parts = []
    for p, hp in zip(probs, h):
        lo = F.max(F.when(F.col("rank") == F.floor(hp), F.col("value")))
        hi = F.max(F.when(F.col("rank") == F.ceil(hp), F.col("value")))
        w = F.max(hp - F.floor(hp))
        parts.append(F.struct(F.lit(float(p)).alias("prob"), F.when(lo == hi, lo).otherwise(lo + (hi - lo) * w).alias("value")))  # inf - inf is no number
    wide = got.groupBy(*keys, F.col("col").alias("column")).agg(F.array(*parts).alias("__s"))
    return wide.select(*keys, "column", F.explode("__s").alias("__s")).select(*keys, "column", "__s.*")


def _long(row_df: DataFrame, cols: list[str], fields: dict[str, callable], keys: list[str] | None = None) -> DataFrame:
    """Turn a one-row-per-group wide aggregate into (keys, column, stats...)."""
    keys = keys or []
    structs = [F.struct(F.lit(c).alias("column"), *[fn(c).alias(k) for k, fn in fields.items()]) for c in cols]
    return row_df.select(*keys, F.explode(F.array(*structs)).alias("s")).select(*keys, "s.*")


def describe_numeric(df: DataFrame, cols: list[str] | None = None, approx: bool = False, keys=None,
                     method: str = "auto") -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column
    (op 5.23), long output. Moments are one aggregate pass; quartiles of a
    column with a bounded distinct count ride in the same pass (exact
    ``percentile`` map), high-cardinality columns get the sort-based exact
    quartiles (``method``: auto / map / sort; ``approx`` overrides)."""
    from quarry.operators.joins import join_on_keys

    keys = [keys] if isinstance(keys, str) else list(keys or [])
    cols = cols or [c for c in columns_of(df, "numeric") if c not in keys]
    how = {c: "approx" for c in cols} if approx else quantile_methods(df, cols, method, grouped=bool(keys))
    global_q = [c for c in cols if how[c] == "bracket" and not keys]
    exact = exact_quantiles_multi(df, global_q, [0.25, 0.5, 0.75]) if global_q else {}
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if how[c] == "bracket" and not keys:
            v = exact[c]
            aggs.append(F.array(*[F.lit(v[p]).cast("double") for p in (0.25, 0.5, 0.75)]).alias(f"{c}__q"))
        elif how[c] not in ("sort", "bracket"):
            aggs.append(_q(x, [0.25, 0.5, 0.75], how[c] == "approx").alias(f"{c}__q"))
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    for c in cols:
        if how[c] == "sort" or (how[c] == "bracket" and keys):
            q = exact_quantiles_grouped(df, c, [0.25, 0.5, 0.75], keys)
            qa = q.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("prob", "value"))).alias("__qs")) \
                if keys else q.agg(F.sort_array(F.collect_list(F.struct("prob", "value"))).alias("__qs"))
            qa = qa.select(*keys, F.transform("__qs", lambda s: s["value"]).alias(f"{c}__q"))
            wide = join_on_keys(wide, qa, keys, "left")  # a group without values has no quartiles
    return _long(wide, cols, {
        "count": lambda c: F.col(f"{c}__count"), "mean": lambda c: F.col(f"{c}__mean"),
        "std": lambda c: F.col(f"{c}__std"), "min": lambda c: F.col(f"{c}__min"),
        "q25": lambda c: F.col(f"{c}__q")[0], "q50": lambda c: F.col(f"{c}__q")[1],
        "q75": lambda c: F.col(f"{c}__q")[2], "max": lambda c: F.col(f"{c}__max"),
    }, keys)


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, unique, top, freq per non-numeric column (op 5.24).

    One shuffle for all columns: rows are unpivoted to (column, value),
    counted per pair (partial aggregation first), then reduced per
    column. ``top`` ties go to the smallest value (T6).
    """
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*").filter(F.col("value").isNotNull())
    vc = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return vc.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("n")).alias("a"), F.col("value").alias("b"))).alias("top"),
        F.max("n").alias("freq"))


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_null, pct_null) sorted by n_null desc (op 5.25 / 8.3).
    NaN counts as missing, as in pandas."""
    cols = cols or df.columns
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        miss = (F.col(c).isNull() | F.isnan(c)) if c in dbl else F.col(c).isNull()
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    out = _long(wide, cols, {"n_null": lambda c: F.col(c).cast("long"),
                             "pct_null": lambda c: F.try_divide(F.col(c) * 100.0, F.col("__n"))})
    return out.orderBy(F.col("n_null").desc(), F.col("column"))


def has_nulls(df: DataFrame) -> bool:
    """True when any cell is NULL (op 5.26), one pass with ``bool_or``."""
    if not df.columns:
        return False
    row = df.agg(F.bool_or(F.greatest(*[F.col(c).isNull() for c in df.columns]) if len(df.columns) > 1
                           else F.col(df.columns[0]).isNull()).alias("x")).first()
    return bool(row["x"])


def quantiles(df: DataFrame, col: str, probs: list[float], keys=None, approx: bool = False,
              method: str = "auto") -> DataFrame:
    """Linear-interpolated quantiles, long ``(keys..., prob, value)`` (op 5.27).
    ``method``: 'map' (exact ``percentile``, bounded distinct count),
    'sort' (exact by rank, unbounded), 'auto' (chooses by a distinct-count
    sketch); ``approx`` uses ``percentile_approx``."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    how = "approx" if approx else quantile_method(df, col, method, grouped=bool(keys))
    if how == "bracket" and not keys:
        v = exact_quantiles_bracketed(df, col, probs)
        return df.sparkSession.createDataFrame([(float(p), v[p]) for p in probs], "prob double, value double")
    if how in ("sort", "bracket"):
        return exact_quantiles_sorted(df, col, probs, keys)
    q = _q(F.col(col), probs, how == "approx").alias("__q")
    wide = df.groupBy(*keys).agg(q) if keys else df.agg(q)
    return wide.select(*keys, F.posexplode("__q").alias("__i", "value")).select(
        *keys, F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1).alias("prob"), "value")


#: up to this many pairs are plain aggregates; more come from matrix products
AGGREGATE_PAIRS = 16
#: columns of a block of the Gram matrix
GRAM_COLUMNS = 512
#: rows that give each column a provisional centre
CENTRE_ROWS = 256

_MOMENTS = "i int, j int, n double, bad double, sx double, sy double, sxx double, syy double, sxy double"


def _centres(df: DataFrame, cols: list[str]) -> list[float]:
    """A value amid each column's first ones: sums of differences from it stay small."""
    import numpy as np

    out = []
    head = df.select(*[F.col(c).cast("double") for c in cols]).limit(CENTRE_ROWS).toArrow()
    for c in range(len(cols)):
        v = head.column(c).drop_null().to_numpy()
        v = v[np.isfinite(v)]
        out.append(float(np.median(v)) if len(v) else 0.0)
    return out


def _block_moments(df: DataFrame, left: list[str], right: list[str], centre: dict[str, float], same: bool) -> DataFrame:
    """Sums over the rows where both columns are set, for each pair of a left and a
    right column (``same``: pairs i < j of one block): one row per task and pair."""
    import numpy as np
    import pyarrow as pa

    cl, cr = (np.array([centre[c] for c in cols]) for cols in (left, right))
    n_left = len(left)

    def matrix(batch, first, centres):
        x, there, bad = (np.zeros((len(batch), len(centres)), dtype=t) for t in (np.float64, np.float64, np.float64))
        for c in range(len(centres)):
            col = batch.column(first + c)
            v = col.to_numpy(zero_copy_only=False).astype(np.float64)
            there[:, c] = col.is_valid().to_numpy(zero_copy_only=False)
            odd = ~np.isfinite(v)
            bad[:, c] = odd & (there[:, c] > 0)
            x[:, c] = np.where(odd, 0.0, v - centres[c])
        return x, there, bad

    def run(batches):
        acc = np.zeros((7, len(left), len(right)))
        for batch in batches:
            x, m, bx = matrix(batch, 0, cl)
            y, k, by = (x, m, bx) if same else matrix(batch, n_left, cr)
            acc += np.stack([m.T @ k, bx.T @ k + m.T @ by, x.T @ k, m.T @ y, (x * x).T @ k, m.T @ (y * y), x.T @ y])
        i, j = np.triu_indices(n_left, 1) if same else np.indices(acc.shape[1:]).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(a[i, j]) for a in acc]],
                                         names=["i", "j", "n", "bad", "sx", "sy", "sxx", "syy", "sxy"])

    cols = left if same else left + right
    part = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)]).mapInArrow(run, _MOMENTS)
    return part.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "sx", "sy", "sxx", "syy", "sxy")])


def _gram_corr(df: DataFrame, left: list[str], right: list[str] | None) -> DataFrame:
    """(a, b, r) of all pairs of ``left``, or of ``left`` with ``right``, by matrix
    products per Arrow batch; one pass over the columns per pair of column blocks."""
    from functools import reduce

    names = left + (right or [])
    centre = dict(zip(names, _centres(df, names)))
    cut = lambda cols: [cols[k:k + GRAM_COLUMNS] for k in range(0, len(cols), GRAM_COLUMNS)]
    lb = cut(left)
    work = [(a, b, False) for a in lb for b in cut(right)] if right is not None else [
        (a, b, p == q) for p, a in enumerate(lb) for q, b in enumerate(lb) if p <= q]

    def named(a, b, same):
        at = lambda cols, i: F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(i) + 1)
        mean_sq = lambda s: F.col(s) * F.col(s) / F.greatest(F.col("n"), F.lit(1.0))
        # rounding of a column that is constant on the common rows must not look like spread
        spread = lambda sq, s: F.when(F.col(sq) - mean_sq(s) > 1e-12 * F.col(sq), F.col(sq) - mean_sq(s))
        cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.greatest(F.col("n"), F.lit(1.0))
        r = cov / (F.sqrt(spread("sxx", "sx")) * F.sqrt(spread("syy", "sy")))
        r = F.when(F.col("bad") > 0, F.lit(float("nan"))).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
        # greatest and least skip NULL
        defined = (F.col("bad") > 0) | (spread("sxx", "sx").isNotNull() & spread("syy", "sy").isNotNull())
        return _block_moments(df, a, b, centre, same).select(at(a, "i").alias("a"), at(b, "j").alias("b"), F.when(defined, r).alias("r"))

    return reduce(DataFrame.unionByName, [named(*w) for w in work])


def corr_long(df: DataFrame, cols: list[str], full: bool = False, target: str | None = None) -> DataFrame:
    """Pearson correlations, pairwise-complete, long ``(a, b, r)`` (op 5.22).

    A pair's r is taken over the rows where both values are set; it is NULL
    where fewer than two such rows exist or a column is constant on them, and
    NaN where one of them is NaN or infinite. All pairs come from one pass: a
    few as plain aggregates, many by matrix products per Arrow batch whose
    sums are then added up per pair (columns beyond ``GRAM_COLUMNS`` in blocks).
    ``target`` keeps the pairs with that column, ranked by |r| desc.
    """
    others = [c for c in cols if c != target]
    pairs = [(target, c) for c in others] if target else [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        out = df.sparkSession.createDataFrame([], "a string, b string, r double")
    elif len(pairs) <= AGGREGATE_PAIRS:
        def r(a, b):
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            both = x.isNotNull() & y.isNotNull()
            return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))

        wide = df.agg(*[r(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
        structs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
        out = wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
    else:
        out = _gram_corr(df, [target], others) if target else _gram_corr(df, cols, None)
    if full:
        out = out.unionByName(out.select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
        out = out.unionByName(df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, r double"))
    if target:
        out = out.orderBy(F.abs("r").desc_nulls_last(), "b")
    return out


def histogram(df: DataFrame, col: str, bins: int = 10, by=None) -> DataFrame:
    """Counts per equal-width bin over [min, max] (numpy rule: the last bin
    includes max), every bin present (op 5.29). ``by`` splits counts by
    class on common bins. min/max are scalar subqueries (no driver round
    trip); the bin spine is ``bins`` rows."""
    from quarry.operators.joins import join_on_keys

    by = [by] if isinstance(by, str) else list(by or [])
    x = F.col(col).cast("double")
    src = df.filter(x.isNotNull())
    mn = src.select(F.min(x)).scalar()
    mx = src.select(F.max(x)).scalar()
    width = (mx - mn) / F.lit(float(bins))
    b = F.when(mx == mn, F.lit(0)).otherwise(
        F.least(F.floor((x - mn) / width).cast("int"), F.lit(bins - 1)))
    counts = src.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        spine = src.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = join_on_keys(spine, counts, [*by, "bin"], "left").select(
        *by, "bin",
        (mn + F.col("bin") * width).alias("lo"),
        F.when(F.col("bin") == bins - 1, mx).otherwise(mn + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    return out


def box_stats(df: DataFrame, cols: list[str], by=None, k: float = 1.5, approx: bool = False,
              method: str = "auto") -> DataFrame:
    """Box-plot statistics per (group, column): q1, median, q3, fences,
    whiskers (most extreme values inside the fences) and outlier count
    (op 5.30). Pass 1: quartiles (:func:`quantiles`, exact); pass 2:
    conditional min/max/count against the fences, joined back on the group
    key (one row per group, broadcast only under a checked bound)."""
    from quarry.operators.joins import join_on_keys

    by = [by] if isinstance(by, str) else list(by or [])
    probs = [0.25, 0.5, 0.75]
    how = {c: "approx" for c in cols} if approx else quantile_methods(df, cols, method, grouped=bool(by))
    # columns whose value maps are bounded share one aggregate, the others follow one by one
    shared = [_q(F.col(c), probs, how[c] == "approx").alias(f"{c}__q") for c in cols if how[c] in ("map", "approx")]
    q = df.groupBy(*by).agg(*shared) if shared else None
    if not by and (wide := [c for c in cols if how[c] == "bracket"]):
        v = exact_quantiles_multi(df, wide, probs)
        lits = {f"{c}__q": F.array(*[F.lit(v[c][p]).cast("double") for p in probs]) for c in wide}
        q = (df.sparkSession.range(1).drop("id") if q is None else q).withColumns(lits)
    for c in cols:
        if how[c] == "sort" or (how[c] == "bracket" and by):
            qc = exact_quantiles_grouped(df, c, probs, by)
            qc = qc.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("prob", "value"))), lambda s: s["value"]).alias(f"{c}__q"))
            q = qc if q is None else join_on_keys(q, qc, by, "left")
    # a shuffle join would send each group's rows to one task
    j = join_on_keys(df, F.broadcast(q) if by and _few_groups(df, by) else q, by, "left")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        q1, q3 = F.col(f"{c}__q")[0], F.col(f"{c}__q")[2]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        aggs += [F.first(F.col(f"{c}__q")).alias(f"{c}__q"),
                 F.min(F.when(x >= lo, x)).alias(f"{c}__wlo"), F.max(F.when(x <= hi, x)).alias(f"{c}__whi"),
                 F.count_if((x < lo) | (x > hi)).alias(f"{c}__out")]
    wide = j.groupBy(*by).agg(*aggs)
    return _long(wide, cols, {
        "q1": lambda c: F.col(f"{c}__q")[0], "median": lambda c: F.col(f"{c}__q")[1],
        "q3": lambda c: F.col(f"{c}__q")[2],
        "lower_fence": lambda c: F.col(f"{c}__q")[0] - k * (F.col(f"{c}__q")[2] - F.col(f"{c}__q")[0]),
        "upper_fence": lambda c: F.col(f"{c}__q")[2] + k * (F.col(f"{c}__q")[2] - F.col(f"{c}__q")[0]),
        "whisker_low": lambda c: F.col(f"{c}__wlo"), "whisker_high": lambda c: F.col(f"{c}__whi"),
        "n_outliers": lambda c: F.col(f"{c}__out"),
    }, by)


#: points that stand for a continuous column, and distinct values that stand for themselves
KDE_POINTS = 4096


def kde(df: DataFrame, col: str, grid: list[float] | None = None, gridsize: int = 200,
        bandwidth: float | None = None, cut: float = 3.0, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on a grid (op 5.31), Scott's bandwidth
    ``h = std * n^(-1/5)`` like the seaborn default.

    A column of few distinct values (``KDE_POINTS`` by a sketch) is collapsed to
    (value, count). Another one is binned: each value is shared between the two
    nearest of ``bins`` (default ``KDE_POINTS``) equidistant points, so what is
    sent does not grow with the distinct values; the error of the density is at
    most (bin width / bandwidth)^2 / 8 times 1 / (bandwidth sqrt(2 pi)). The
    weights meet the grid on the driver. NULL, NaN and infinite values are left
    out; a table without values has no rows.
    """
    import numpy as np

    x = F.col(col).cast("double")
    df = df.filter(F.abs(x) < float("inf"))
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("mn"), F.max(x).alias("mx"),
                F.approx_count_distinct(x).alias("d")).first()
    n, sd = st["n"], st["sd"]
    if not n:
        return df.sparkSession.createDataFrame([], "x double, density double")
    h = bandwidth or (sd or 1.0) * n ** (-0.2)
    if grid is None:
        lo, hi = st["mn"] - cut * h, st["mx"] + cut * h
        grid = [lo + (hi - lo) * i / (gridsize - 1) for i in range(gridsize)]
    if st["mx"] > st["mn"] and (bins or st["d"] > KDE_POINTS):
        points = bins or KDE_POINTS
        step = (st["mx"] - st["mn"]) / (points - 1)
        at = (x - F.lit(st["mn"])) / F.lit(step)
        low = F.least(F.floor(at), F.lit(points - 2))
        two = F.array(F.struct(low.alias("i"), (1 - (at - low)).alias("w")), F.struct((low + 1).alias("i"), (at - low).alias("w")))
        vc = df.select(F.explode(two).alias("p")).groupBy("p.i").agg(F.sum("p.w").alias("w"))
        vc = vc.select((F.col("i") * F.lit(step) + F.lit(st["mn"])).alias("v"), "w")
    else:
        vc = df.groupBy(x.alias("v")).agg(F.count(F.lit(1)).cast("double").alias("w"))
    got = vc.orderBy("v").toArrow()  # bounded: the bins, or the few distinct values
    v, w, at = got.column("v").to_numpy(), got.column("w").to_numpy(), np.asarray(grid, dtype=float)
    density = np.exp(-0.5 * ((at[:, None] - v[None, :]) / h) ** 2) @ w / (n * h * math.sqrt(2 * math.pi))
    return df.sparkSession.createDataFrame([(float(a), float(d)) for a, d in zip(at, density)], "x double, density double")
