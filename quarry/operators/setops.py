"""Set and structural operators (2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(a: DataFrame, b: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Row union by name; a column missing on one side becomes NULL (8.1/8.2)."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def duplicate_count(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (``duplicated().sum()``), one row
    ``(n_duplicates)`` (op 8.4). One aggregation keyed by the row with
    map-side combine: a row repeated a million times is one partial row
    per task."""
    cols = subset or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


#: copies of one row that a task replays
COPIES = 100_000


def duplicate_flags(df: DataFrame, subset: list[str] | None = None, name: str = "is_duplicate") -> DataFrame:
    """Flag every copy but one of each repeated row (flag form of 8.4).

    Equal rows cannot be told apart, so they are counted and emitted again: a
    row repeated a million times is one partial count per task, and its copies
    are replayed by several tasks. For a ``subset`` the row that stays is the
    smallest in the other columns (NULL first), whatever the order of the input.
    """
    from quarry.operators.joins import join_on_keys

    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    kept = F.lit(True)
    if subset and set(subset) != set(df.columns):
        others = F.struct(*[c for c in df.columns if c not in subset])
        first = counts.groupBy(*subset).agg(F.min(others).alias("__least"))
        counts = join_on_keys(counts, first, subset)
        kept = others.eqNullSafe(F.col("__least"))
    rows = counts.select(*df.columns, "__copies", kept.alias("__kept"))
    one = F.lit(1).cast("bigint")
    few = rows.filter(F.col("__copies") <= COPIES).withColumn("__copy", F.explode(F.sequence(one, "__copies")))
    last = F.floor((F.col("__copies") - 1) / COPIES)
    parts = rows.filter(F.col("__copies") > COPIES).withColumn("__part", F.explode(F.sequence(one - 1, last)))
    upto = F.least(F.col("__copies"), (F.col("__part") + 1) * COPIES)
    many = parts.repartition("__part", *df.columns).withColumn("__copy", F.explode(F.sequence(F.col("__part") * COPIES + 1, upto))).drop("__part")
    return few.unionByName(many).select(*df.columns, (~(F.col("__kept") & (F.col("__copy") == 1))).alias(name))


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep one copy of each row (op 8.5)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def extend_calendar(df: DataFrame, ts: str, n: int, unit: str = "month", month_end: bool = True,
                    key: str | None = None) -> DataFrame:
    """Append ``n`` future periods after the last ``ts`` (per ``key`` when
    given) with every other column NULL (op 8.6). Monthly labels that are
    month ends stay month ends (``last_day``)."""
    keys = [key] if key else []
    last = df.groupBy(*keys).agg(F.max(F.col(ts)).alias("__last"))
    k = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("__k")
    fut = last.select(*keys, "__last", k)
    if unit == "month":
        nxt = F.add_months(F.to_date("__last"), F.col("__k"))
        if month_end:
            nxt = F.last_day(nxt)
    elif unit == "day":
        nxt = F.date_add(F.to_date("__last"), F.col("__k"))
    elif unit == "hour":
        nxt = F.col("__last") + F.make_dt_interval(F.lit(0), F.col("__k"))
    else:
        raise ValueError(unit)
    ts_type = dict(df.dtypes)[ts]
    fut = fut.select(*keys, nxt.cast(ts_type).alias(ts))
    return df.unionByName(fut, allowMissingColumns=True)
