"""Grouped and global aggregation (2.5).

All aggregates are algebraic or carry compact partial state (``median``
and ``mode`` keep value->count maps), so Spark runs partial aggregation
before the shuffle: a key holding a third of the rows costs one partial
row per task, not a third of the data in one task.

pandas defaults that differ from Spark are explicit options:
``dropna`` drops NULL group keys (T1), ``fill_empty_sum`` makes the sum of
an all-NULL group 0 (T2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FNS = {
    "sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max,
    "count": F.count, "median": F.median, "std": F.stddev_samp, "var": F.var_samp,
    "std_pop": F.stddev_pop, "nunique": F.count_distinct, "first": F.min,
    "mode": lambda c: F.mode(c, deterministic=True),
}


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _drop_null_keys(df: DataFrame, keys: list[str], dropna: bool) -> DataFrame:
    if dropna and keys:
        return df.na.drop(how="any", subset=keys)
    return df


def agg_fn(fn: str, col: str, fill_empty_sum: bool = True) -> Column:
    c = _FNS[fn](F.col(col))
    if fn == "sum" and fill_empty_sum:
        c = F.coalesce(c, F.lit(0))
    return c


def group_agg(df: DataFrame, keys, spec: dict, dropna: bool = True, fill_empty_sum: bool = True) -> DataFrame:
    """``spec`` maps output name -> (fn, col) or -> Column (op 5.6, 5.10, 16.4).

    A bare ``{col: fn}`` (pandas dict-agg) is accepted too; the output is
    then named after the column.
    """
    keys = _keys(keys)
    aggs = []
    for name, v in spec.items():
        if isinstance(v, Column):
            aggs.append(v.alias(name))
        elif isinstance(v, str):
            aggs.append(agg_fn(v, name, fill_empty_sum).alias(name))
        else:
            fn, col = v
            aggs.append(agg_fn(fn, col, fill_empty_sum).alias(name))
    return _drop_null_keys(df, keys, dropna).groupBy(*keys).agg(*aggs)


def group_sum(df: DataFrame, keys, cols, dropna: bool = True) -> DataFrame:
    return group_agg(df, keys, {c: ("sum", c) for c in _keys(cols)}, dropna)


def group_mean(df: DataFrame, keys, cols="numeric", dropna: bool = True) -> DataFrame:
    """Mean per group; ``cols='numeric'`` means every numeric non-key column (5.8)."""
    keys = _keys(keys)
    if cols == "numeric":
        from quarry.operators.schema import columns_of

        cols = [c for c in columns_of(df, "numeric") if c not in keys]
    return group_agg(df, keys, {c: ("mean", c) for c in _keys(cols)}, dropna)


def group_count(df: DataFrame, keys, col: str, name: str = "n", dropna: bool = True) -> DataFrame:
    """Non-NULL count of ``col`` per group (op 5.4)."""
    keys = _keys(keys)
    return _drop_null_keys(df, keys, dropna).groupBy(*keys).agg(F.count(col).alias(name))


def group_size(df: DataFrame, keys, name: str = "n", dropna: bool = True) -> DataFrame:
    """Rows per group (op 5.5)."""
    keys = _keys(keys)
    return _drop_null_keys(df, keys, dropna).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_matrix(df: DataFrame, keys, cols, fns=("mean", "median", "min", "max"), dropna: bool = True) -> DataFrame:
    """Every column x every function, named ``<col>_<fn>`` (op 5.7). The median
    of a column with more distinct values than a task should map comes from the
    rank-based exact quantiles instead of a value map per group."""
    from quarry.operators.joins import join_on_keys
    from quarry.operators.profile import quantile_methods, quantiles

    keys, cols = _keys(keys), _keys(cols)
    how = quantile_methods(df, cols, grouped=True) if "median" in fns else {}
    ranked = [c for c in cols if how.get(c, "map") != "map"]
    out = group_agg(df, keys, {f"{c}_{fn}": (fn, c) for c in cols for fn in fns if fn != "median" or c not in ranked}, dropna)
    for c in ranked:
        q = quantiles(_drop_null_keys(df, keys, dropna), c, [0.5], keys=keys, method="sort")
        out = join_on_keys(out, q.select(*keys, F.col("value").alias(f"{c}_median")), keys, "left")
    return out.select(*keys, *[f"{c}_{fn}" for c in cols for fn in fns])


def group_rate(df: DataFrame, keys, pred: Column, name: str = "rate_pct", dropna: bool = True) -> DataFrame:
    """Share of rows where ``pred`` holds, x100 (op 5.9). NULL predicate
    counts as false, as a pandas boolean column would."""
    keys = _keys(keys)
    return (_drop_null_keys(df, keys, dropna).groupBy(*keys)
            .agg((F.avg(F.coalesce(pred, F.lit(False)).cast("double")) * 100.0).alias(name)))


def agg_where(df: DataFrame, spec: dict, keys=None, dropna: bool = True) -> DataFrame:
    """Conditional aggregation in one pass (op 5.11).

    ``spec``: name -> (fn, col, pred) with fn in count/sum/mean/min/max;
    ``col`` may be None for a row count.
    """
    keys = _keys(keys)
    aggs = []
    for name, (fn, col, pred) in spec.items():
        if fn == "count":
            a = F.count_if(pred) if col is None else F.count(F.when(pred, F.col(col)))
        elif fn == "sum":
            a = F.coalesce(F.sum(F.when(pred, F.col(col))), F.lit(0.0))
        else:
            a = _FNS[fn](F.when(pred, F.col(col)))
        aggs.append(a.alias(name))
    base = _drop_null_keys(df, keys, dropna)
    return base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)


def share_of_rows(df: DataFrame, preds: dict[str, Column], digits: int | None = 2) -> DataFrame:
    """% of rows satisfying each predicate, one pass (op 5.12)."""
    aggs = []
    for name, p in preds.items():
        v = F.avg(F.coalesce(p, F.lit(False)).cast("double")) * 100.0
        aggs.append((F.round(v, digits) if digits is not None else v).alias(name))
    return df.agg(*aggs)


def agg_all(df: DataFrame, spec: dict) -> DataFrame:
    """Global aggregates (op 5.13): name -> (fn, col) or Column."""
    return group_agg(df, [], spec, dropna=False)


def value_counts(df: DataFrame, col: str, normalize: bool = False, by=None, dropna: bool = True,
                 name: str | None = None) -> DataFrame:
    """Count per value, descending, NULLs dropped (op 5.14/5.15/5.16/5.21).

    ``normalize``: proportion of the (non-NULL) total. The total is a
    scalar subquery (one tiny aggregate job); with ``by`` it is the
    group's total, from a window over the already-aggregated counts
    (one row per (group, value), not per input row).
    """
    by = _keys(by)
    keys = by + [col]
    base = _drop_null_keys(df, keys, dropna)
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        out_name = name or "proportion"
        if by:
            from pyspark.sql import Window

            tot = F.sum("count").over(Window.partitionBy(*by))
        else:
            tot = base.select(F.count(F.lit(1))).scalar()
        counts = counts.select(*keys, (F.col("count") / tot).alias(out_name))
        return counts.orderBy(*by, F.col(out_name).desc(), F.col(col))
    if name:
        counts = counts.withColumnRenamed("count", name)
    return counts.orderBy(*by, F.col(name or "count").desc(), F.col(col))


def crosstab(df: DataFrame, a: str, b: str, wide: bool = False, levels: list | None = None,
             dropna: bool = True) -> DataFrame:
    """Counts of (a, b) pairs (op 5.17). Long by default; ``wide`` pivots
    ``b`` (give ``levels`` to avoid the extra distinct job)."""
    base = _drop_null_keys(df, [a, b], dropna)
    if not wide:
        return base.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return base.groupBy(a).pivot(b, levels).agg(F.count(F.lit(1))).na.fill(0)


def pivot(df: DataFrame, row: str, column: str, values: str | None, fn: str = "size",
          levels: list | None = None) -> DataFrame:
    """Long -> wide (op 5.18); a missing cell is NULL (as ``unstack``)."""
    g = df.groupBy(row).pivot(column, levels)
    if fn == "size":
        return g.agg(F.count(F.lit(1)))
    return g.agg(_FNS[fn](F.col(values)))


def nunique(df: DataFrame, cols: list[str] | None = None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-NULL values per column, long form ``(column, nunique)``
    (op 5.19). Exact uses one ``count(distinct)`` per column in one job
    (Spark expands the rows per column and aggregates twice); ``approx``
    uses HyperLogLog++ with constant memory per column."""
    cols = cols or df.columns
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    row = df.agg(*[f(F.col(c)).alias(c) for c in cols])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nunique")) for c in cols
    ])).alias("s")).select("s.*")


def distinct_values(df: DataFrame, col: str, dropna: bool = False) -> DataFrame:
    out = df.select(col).distinct()
    return out.na.drop() if dropna else out


def peak(df: DataFrame, keys, label: str, measure: str, dropna: bool = True) -> DataFrame:
    """Label of the max and of the min ``measure`` per group (op 5.28).
    Ties go to the smallest label (pandas ``idxmax`` on a sorted index)."""
    keys = _keys(keys)
    m, lab = F.col(measure), F.col(label)
    return (_drop_null_keys(df, keys, dropna).filter(m.isNotNull()).groupBy(*keys).agg(
        F.min_by(lab, F.struct((-m).alias("a"), lab.alias("b"))).alias(f"{label}_at_max"),
        F.max(m).alias(f"{measure}_max"),
        F.min_by(lab, F.struct(m.alias("a"), lab.alias("b"))).alias(f"{label}_at_min"),
        F.min(m).alias(f"{measure}_min"),
    ))


def anomaly_report(df: DataFrame, rules: dict[str, Column], amount: str | None = None, keys=None) -> DataFrame:
    """Count (and ``amount`` sum) of rows breaking each rule, in one pass
    (op 5.34). Long output ``(keys..., rule, n_rows, amount)``."""
    keys = _keys(keys)
    aggs = []
    for name, pred in rules.items():
        aggs.append(F.count_if(F.coalesce(pred, F.lit(False))).alias(f"{name}__n"))
        if amount:
            aggs.append(F.coalesce(F.sum(F.when(pred, F.col(amount))), F.lit(0.0)).alias(f"{name}__amt"))
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    structs = [F.struct(F.lit(name).alias("rule"), F.col(f"{name}__n").alias("n_rows"),
                        (F.col(f"{name}__amt") if amount else F.lit(None).cast("double")).alias("amount"))
               for name in rules]
    return wide.select(*keys, F.explode(F.array(*structs)).alias("s")).select(*keys, "s.*")


def trend(df: DataFrame, x: str, y: str, keys=None) -> DataFrame:
    """Degree-1 least squares y = slope*x + intercept (op 5.33)."""
    keys = _keys(keys)
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def median_vs_overall(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Per group and column: the group median, the overall median and their
    difference (op 16.6; the original's ``dist_list`` loop). Long output
    ``(group, column, median, overall_median, diff)``; both by the exact method
    that fits the column's distinct count (:func:`group_matrix`, :func:`quantiles`)."""
    from quarry.operators.profile import quantiles

    g = group_matrix(df, group, cols, ("median",), dropna=False)
    overall = {c: quantiles(df, c, [0.5]).select("value").scalar() for c in cols}
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_median").alias("median"),
                        overall[c].alias("overall_median")) for c in cols]
    out = g.select(group, F.explode(F.array(*structs)).alias("s")).select(group, "s.*")
    return out.withColumn("diff", F.col("median") - F.col("overall_median"))
