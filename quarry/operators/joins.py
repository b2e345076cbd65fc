"""Joins (2.4).

Broadcast is used only behind a size bound in bytes, taken from the plan's
statistics (file and catalog sizes), so the check runs no job. Otherwise the
plain join is left to Spark: sort-merge on the keys with AQE free to demote
it to broadcast at runtime from real shuffle sizes, and AQE's skew join
splitting a hot key's partition on the large side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def planned_bytes(df: DataFrame) -> int:
    """Size of a table by the optimizer's statistics: the files it scans, not
    reduced by filters or aggregates unless the optimizer knows better. No job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only when the plan's statistics put ``df`` under
    ``max_bytes``."""
    return F.broadcast(df) if planned_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes) else df


def join_on_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key meets a NULL key; the key columns come from
    ``left``. Without keys ``right`` has one row, whose columns are attached."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    if not keys:
        one = right.select(F.struct(*right.columns).alias("s")).scalar()
        return left.withColumn("__one", one).select("*", *[F.col("__one")[c].alias(c) for c in right.columns]).drop("__one")
    r = right.withColumnsRenamed({k: f"__rk_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__rk_{k}"))
    return left.join(r, cond, how).drop(*[f"__rk_{k}" for k in keys])  # a left_anti join has none of them


def _cond(on, left: DataFrame, right: DataFrame, null_safe: bool):
    if isinstance(on, Column):
        return on
    keys = [on] if isinstance(on, str) else list(on)
    if not null_safe:
        return keys
    conds = [left[k].eqNullSafe(right[k]) for k in keys]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def inner_join(left: DataFrame, right: DataFrame, on, null_safe: bool = False,
               broadcast_bytes: int | None = None) -> DataFrame:
    """Inner equi-join. ``null_safe`` matches NULL keys with NULL keys (the
    pandas merge rule, T21). ``broadcast_bytes`` opts in to a checked
    broadcast of the right side."""
    r = broadcast_if_small(right, broadcast_bytes) if broadcast_bytes else right
    cond = _cond(on, left, r, null_safe)
    out = left.join(r, cond, "inner")
    if null_safe and not isinstance(on, Column):
        for k in ([on] if isinstance(on, str) else on):
            out = out.drop(r[k])
    return out


def left_join(left: DataFrame, right: DataFrame, on, broadcast_bytes: int | None = None) -> DataFrame:
    """Left outer equi-join (attach predictions, lookups)."""
    r = broadcast_if_small(right, broadcast_bytes) if broadcast_bytes else right
    return left.join(r, on, "left")


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, object]],
              broadcast_bytes: int | None = None, how: str = "inner") -> DataFrame:
    """Fact table joined to several dimensions (op 4.2).

    ``dims`` is a list of ``(dim_df, on)``; each dim is broadcast only if
    it is under ``broadcast_bytes`` by its statistics, so the fact table is
    never shuffled for a small dimension. Only the columns the caller
    later selects are read (column pruning reaches every scan).
    """
    out = fact
    for dim, on in dims:
        out = out.join(broadcast_if_small(dim, broadcast_bytes), on, how)
    return out


def dimension_totals(fact: DataFrame, dim: DataFrame, on, name: str, measure: str,
                     total_name: str, broadcast_bytes: int | None = None) -> DataFrame:
    """``SELECT dim.name, sum(fact.measure) AS total FROM dim JOIN fact
    USING(on) GROUP BY name ORDER BY total DESC`` (Q3/Q4, op 4.3).

    Plan: the fact side is pre-aggregated by the join key (partial +
    final hash aggregate, so a hot key costs one row per task), joined to
    the (checked) broadcast dimension, and re-aggregated by name. The
    large shuffle is therefore keyed by ``on`` with map-side combine.
    """
    keys = [on] if isinstance(on, str) else list(on)
    pre = fact.groupBy(*keys).agg(F.sum(measure).alias("__m"))
    d = broadcast_if_small(dim.select(*keys, name), broadcast_bytes)
    return (pre.join(d, keys, "inner").groupBy(name).agg(F.sum("__m").alias(total_name))
            .orderBy(F.col(total_name).desc_nulls_first(), F.col(name)))


def lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, name: str | None = None,
           broadcast_bytes: int | None = None) -> DataFrame:
    """Attach ``table[value]`` for each ``df[col]`` (pandas ``map(series)``,
    op 4.7). Unmatched -> NULL."""
    t = table.select(F.col(key).alias("__lk"), F.col(value).alias(name or value))
    return (df.join(broadcast_if_small(t, broadcast_bytes), F.col(col) == F.col("__lk"), "left")
            .drop("__lk"))
