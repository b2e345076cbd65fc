"""Ranking, positional and window-shaped work (2.6, 2.7).

A window ``PARTITION BY key`` sends every row of a key to one task; with
a key holding a third of the data that task holds a third of the data.
Positional operators work on ranges of rows instead:

* ``row_numbers`` numbers rows globally and consecutively by range
  partitioning on a *total* order (ties broken by the remaining columns,
  so even one hot key value spreads over many partitions), numbering
  within each partition, and adding per-partition offsets (a table with
  one row per partition, hence a proven broadcast bound).
* lags and centred means are windows inside a range, which has copies of
  the rows just before and after it (``halo_frame``); a table of at most
  ``RANGE_ROWS`` rows is one range.
* counts per key are a partially aggregated ``groupBy`` joined back
  (AQE splits a hot key's partition on the large side).

The only windows left run over already-aggregated, bounded data
(one row per partition, per group value or per tuning result).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SORTABLE_EXCLUDE = (T.MapType,)


def _order_cols(df: DataFrame, order, total: bool) -> list[Column]:
    order = [order] if isinstance(order, (str, Column)) else list(order)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if total:
        named = {c for c in order if isinstance(c, str)}
        cols += [F.col(f.name) for f in df.schema.fields
                 if f.name not in named and not isinstance(f.dataType, _SORTABLE_EXCLUDE)]
    return cols


# A key-partitioned window is used only when the largest series is proven
# (by one aggregate) to hold at most this many rows; above it every
# positional operator switches to the global-position joins.
SERIES_WINDOW_ROWS = 2_000_000


def largest_group(df: DataFrame, key) -> int:
    keys = [key] if isinstance(key, str) else list(key or [])
    if not keys:
        return df.count()
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def use_key_window(df: DataFrame, key, strategy: str = "auto") -> bool:
    """'window' / 'join' / 'auto' (window iff the largest group is under
    ``SERIES_WINDOW_ROWS``)."""
    if strategy in ("window", "join"):
        return strategy == "window"
    return largest_group(df, key) <= SERIES_WINDOW_ROWS


def _key_window(df: DataFrame, keys: list[str], order) -> Window:
    order = [order] if isinstance(order, str) else list(order)
    cols = _order_cols(df.drop(*keys) if keys else df, order, True)
    return Window.partitionBy(*keys).orderBy(*cols)


def _ranged(df: DataFrame, cols: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``cols`` and tag each row with its partition.

    The tagged rows are checkpointed (reliably, to the shared checkpoint
    folder) so the two consumers -- per-partition numbering and
    per-partition counts -- read ONE partition assignment. Without it
    each consumer would run its own range exchange, and the range bounds
    (sampled; re-sampled with a per-RDD seed when input partitions are
    unbalanced) can differ between them.
    """
    from quarry.session import cut_lineage

    if num_partitions is None:
        # ranges of about RANGE_BYTES by the plan's statistics, never fewer than
        # the session's shuffle partitions
        from quarry.operators.joins import planned_bytes

        ranges = min(MAX_RANGES, -(-planned_bytes(df) // RANGE_BYTES))
        num_partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges)
    return cut_lineage(df.repartitionByRange(num_partitions, *cols).withColumn("__pid", F.spark_partition_id()))


# Tables whose files hold at most this many bytes (plan statistics, no job)
# are numbered / accumulated by one un-partitioned window: one task, bounded.
SMALL_TABLE_BYTES = 64 << 20
# Bytes of input per range, and the most ranges a driver plans at once.
RANGE_BYTES = 1 << 30
MAX_RANGES = 100_000


def _is_small(df: DataFrame, bound: int | None = None) -> bool:
    from quarry.operators.joins import planned_bytes

    return planned_bytes(df) <= (SMALL_TABLE_BYTES if bound is None else bound)


def row_numbers(df: DataFrame, order, name: str = "row_number", start: int = 1,
                total: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Consecutive global row numbers in ``order`` without a single-task
    window over unbounded data (op 6.7). ``total`` appends the other
    columns as tie-breakers so the numbering is deterministic and a hot
    value is splittable. A table proven small is numbered by one window."""
    cols = _order_cols(df, order, total)
    if num_partitions is None and _is_small(df):
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*cols)) + (start - 1)).cast("long"))
    ranged = _ranged(df, cols, num_partitions)
    local = ranged.withColumn("__lrn", F.row_number().over(Window.partitionBy("__pid").orderBy(*cols)))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per partition: a window without PARTITION BY is bounded here
    offsets = counts.select("__pid", F.coalesce(F.sum("__cnt").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    out = local.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, (F.col("__off") + F.col("__lrn") + (start - 1)).cast("long")).drop(
        "__pid", "__lrn", "__off")


def take_range(df: DataFrame, order, a: int, b: int | None = None) -> DataFrame:
    """Rows at positions [a, b) in ``order`` (0-based, like ``df[a:b]``): a sort
    with offset and limit, no numbering. A limit is one result, sorted per task
    first; without ``b`` everything from ``a`` on is numbered instead."""
    if b is not None:
        return df.orderBy(*_order_cols(df, order, True)).offset(a).limit(max(0, b - a))
    return row_numbers(df, order, "__rn", start=0).filter(F.col("__rn") >= a).drop("__rn")


def per_key_numbers(df: DataFrame, key, order, name: str = "rn", start: int = 1,
                    strategy: str = "auto") -> DataFrame:
    """Row number within each key (1-based by default). Keys with a proven
    bounded size use a key window; otherwise global number minus the key's
    first number (no task holds a whole key)."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    if use_key_window(df, key, strategy):
        w = _key_window(df, key, order)
        return df.withColumn(name, (F.row_number().over(w) + (start - 1)).cast("long"))
    g = row_numbers(df, key + order, "__g")
    first = g.groupBy(*key).agg(F.min("__g").alias("__g0"))
    from quarry.operators.joins import join_on_keys

    return (join_on_keys(g, first, key).withColumn(name, (F.col("__g") - F.col("__g0") + start).cast("long"))
            .drop("__g", "__g0"))


#: rows of a range; a table of one range is one window per key
RANGE_ROWS = 1_000_000


def series_ranges(df: DataFrame, strategy: str = "auto") -> int:
    """How many ranges the rows are sorted into for positional work: 1 for a table of
    at most ``RANGE_ROWS`` rows. 'window' means 1, 'join' several."""
    if strategy == "window":
        return 1
    if strategy == "join":
        return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(1, -(-df.count() // RANGE_ROWS))


def halo_frame(df: DataFrame, key, order, before: int, after: int, ranges: int, total: bool = True) -> tuple[DataFrame, Window]:
    """``df`` for windows that reach ``before`` rows back and ``after`` rows ahead
    within ``key``, and the window spec.

    With several ``ranges`` the rows are sorted into ranges of (key, order);
    each range gets copies of the last rows of its predecessors and of the
    first of its successors (the halo), found by one join of ranges x reach
    places, so the window of a range needs no other row. ``__own`` is false for
    copies: filter on it after the window columns are added. ``__g`` numbers the
    rows of the table. One range is a plain window per key.
    """
    keys = [key] if isinstance(key, str) else list(key or [])
    order = [order] if isinstance(order, str) else list(order)
    if ranges <= 1:
        return df.withColumn("__own", F.lit(True)), _key_window(df, keys, order) if total else Window.partitionBy(*keys).orderBy(*order)
    from quarry.session import cut_lineage

    cols = _order_cols(df, keys + order, total)
    rows = df.repartitionByRange(ranges, *cols).sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id())
    rows = cut_lineage(rows).withColumn("__range", F.shiftright("__at", 33))
    # one row per range
    sizes = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    first = F.coalesce(F.sum("__rows").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = cut_lineage(sizes.withColumn("__first", first))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    own = rows.join(F.broadcast(sizes), "__range").withColumns({"__g": F.col("__first") + place, "__own": F.lit(True)})
    end = F.col("__first") + F.col("__rows")
    seq = lambda a, b: F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
    reach = F.concat(seq(F.greatest(F.col("__first") - before, F.lit(0).cast("bigint")), F.col("__first")), seq(end, end + after))
    wanted = sizes.select(F.col("__range").alias("__to"), F.explode(reach).alias("__g"))
    # a copied row is near an end of its own range
    near = own.filter((end - F.col("__g") <= before) | (F.col("__g") - F.col("__first") < after))
    halo = near.join(wanted, "__g").withColumn("__range", F.col("__to")).withColumn("__own", F.lit(False))
    names = [*df.columns, "__range", "__g", "__own"]
    return own.select(*names).unionByName(halo.select(*names)), Window.partitionBy("__range", *keys).orderBy("__g")


def _own_rows(df: DataFrame) -> DataFrame:
    return df.filter("__own").drop("__own", "__range", "__g")


def lags(df: DataFrame, key, ts: str, col: str, n: int = 1, prefix: str | None = None,
         strategy: str = "auto") -> DataFrame:
    """``lag(col, k)`` for k = 1..n within each key ordered by ``ts`` (op 6.4);
    a window per range of rows, see :func:`halo_frame`."""
    prefix = prefix or f"{col}_lag"
    f, w = halo_frame(df, key, [ts], n, 0, series_ranges(df, strategy))
    return _own_rows(f.withColumns({f"{prefix}_{k}": F.lag(col, k).over(w) for k in range(1, n + 1)}))


def moving_average(df: DataFrame, key, ts: str, y: str, period: int, name: str = "trend",
                   strategy: str = "auto") -> DataFrame:
    """Centred moving average (op 6.5), as used for classical decomposition:
    odd period -> plain mean of ``period`` points; even period -> 2x``period``
    average (end weights 1/2). Edges without a full window are NULL. A window
    per range of rows, see :func:`halo_frame`."""
    h = period // 2
    f, w = halo_frame(df, key, [ts], h, h, series_ranges(df, strategy))
    w = w.rowsBetween(-h, h)
    x = F.col(y)
    full = (F.count(F.lit(1)).over(w) == 2 * h + 1) & (F.count(x).over(w) == 2 * h + 1)
    tot = F.sum(x).over(w)
    if period % 2 == 0:
        tot = tot - 0.5 * (F.first(x).over(w) + F.last(x).over(w))
    return _own_rows(f.withColumn(name, F.when(full, tot / period)))


def canonical_case(df: DataFrame, col: str) -> DataFrame:
    """Upper-case every value whose case-insensitive name occurs more than
    once (trap T22 / op 6.2 / 16.3); others unchanged.

    The per-name counts are a partially aggregated ``groupBy`` joined
    back, not ``count() over (partition by lower(x))``.
    """
    low = F.lower(F.col(col))
    counts = df.groupBy(low.alias("__l")).agg(F.count(F.lit(1)).alias("__c"))
    out = df.join(counts, low.eqNullSafe(F.col("__l")), "left")
    return out.withColumn(col, F.when(F.col("__c") > 1, F.upper(F.col(col))).otherwise(F.col(col))).drop("__l", "__c")


def label_codes(df: DataFrame, col: str, name: str | None = None, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Alphabetical code from 0 for each distinct value (``LabelEncoder``,
    T9 / op 6.6); NULL stays NULL. Codes come from numbering the distinct
    values, joined back (broadcast only under a checked bound)."""
    from quarry.operators.joins import broadcast_if_small

    levels = df.select(F.col(col).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
    codes = row_numbers(levels, "__v", "__code", start=0, total=False)
    out = df.join(broadcast_if_small(codes, max_broadcast_bytes), F.col(col) == F.col("__v"), "left")
    return out.withColumn(name or f"{col}_code", F.col("__code").cast("int")).drop("__v", "__code")


def global_rank(df: DataFrame, cols, ascending=True, name: str = "rank", method: str = "rank") -> DataFrame:
    """SQL ``rank`` / ``dense_rank`` / ``row_number`` over the whole table
    without a single-task window (op 6.3). NULLs sort last."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    order = [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(cols, asc)]
    if method == "row":
        return row_numbers(df, order, name)
    if method == "dense":
        levels = df.select(*cols).distinct()
        codes = row_numbers(levels, order, name, total=False)
        cond = [df[c].eqNullSafe(codes[c]) for c in cols]
        out = df.join(codes, cond[0] if len(cond) == 1 else _and(cond), "left")
        return out.drop(*[codes[c] for c in cols])
    rn = row_numbers(df, order, "__rn")
    first = rn.groupBy(*cols).agg(F.min("__rn").alias(name))
    cond = [rn[c].eqNullSafe(first[c]) for c in cols]
    return rn.join(first, _and(cond)).drop(*[first[c] for c in cols]).drop("__rn")


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def rank_results(df: DataFrame, score: str, n: int | None = None, name: str = "rank") -> DataFrame:
    """Rank tuning results by ``score`` desc (1 = best, ties share a rank,
    ``rank()`` semantics) and keep the top ``n`` ranks (op 6.3)."""
    r = global_rank(df, [score], False, name, "rank")
    if n is not None:
        r = r.filter(F.col(name) <= n)
    return r.orderBy(name)


def sort(df: DataFrame, cols, ascending=True, nulls_first: bool | None = None) -> DataFrame:
    """Sort (range-partitioned, scalable). ``nulls_first`` defaults to the
    Spark rule (first for asc, last for desc); pass True for the Postgres
    ``DESC`` rule (T20)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    out = []
    for c, a in zip(cols, asc):
        col = F.col(c)
        if a:
            out.append(col.asc_nulls_last() if nulls_first is False else col.asc_nulls_first())
        else:
            out.append(col.desc_nulls_first() if nulls_first else col.desc_nulls_last())
    return df.orderBy(*out)


def top_n(df: DataFrame, col: str, n: int, tiebreak: list[str] | None = None, largest: bool = True) -> DataFrame:
    """``nlargest``/``nsmallest`` with an explicit tie-break (op 7.4); runs
    as TakeOrderedAndProject (``n`` rows per task)."""
    o = F.col(col).desc_nulls_last() if largest else F.col(col).asc_nulls_last()
    return df.orderBy(o, *(tiebreak or [])).limit(n)


def top_groups(df: DataFrame, key, measure: str, fn: str, n: int, name: str | None = None) -> DataFrame:
    """Top ``n`` groups by an aggregate (op 7.5); ties by key."""
    from quarry.operators.aggregate import agg_fn

    key = [key] if isinstance(key, str) else list(key)
    name = name or f"{fn}_{measure}"
    g = df.na.drop(subset=key).groupBy(*key).agg(agg_fn(fn, measure).alias(name))
    return g.orderBy(F.col(name).desc_nulls_last(), *key).limit(n)


def first_keys(df: DataFrame, key, measure: str, fn: str, n: int, name: str | None = None) -> DataFrame:
    """First ``n`` groups in key order (pandas ``groupby(...)[:n]``, T3)."""
    from quarry.operators.aggregate import agg_fn

    key = [key] if isinstance(key, str) else list(key)
    name = name or f"{fn}_{measure}"
    g = df.na.drop(subset=key).groupBy(*key).agg(agg_fn(fn, measure).alias(name))
    return g.orderBy(*key).limit(n)


def ordinal_rank(col, levels: list) -> Column:
    """Position of the value in ``levels`` (0-based); unseen -> NULL."""
    m = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(v), F.lit(i))])
    return F.try_element_at(m, F.col(col) if isinstance(col, str) else col)


def ordered(df: DataFrame, col: str, levels: list, descending: bool = False) -> DataFrame:
    """Sort by a domain order (grade A..G, weekday names) (op 7.7)."""
    r = ordinal_rank(col, levels)
    return df.orderBy(r.desc_nulls_last() if descending else r.asc_nulls_last())


def running_sums(df: DataFrame, order, cols: list[str], suffix: str = "_cum") -> DataFrame:
    """Cumulative sums of ``cols`` in a global order (rows up to and
    including the current one) without a single-task window: range
    partition, per-partition running sums, plus per-partition offsets
    (one row per partition)."""
    ocols = _order_cols(df, order, True)
    if _is_small(df):
        w0 = Window.orderBy(*ocols).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"{c}{suffix}": F.sum(c).over(w0) for c in cols})
    ranged = _ranged(df, ocols)
    w = Window.partitionBy("__pid").orderBy(*ocols).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"__l_{c}": F.sum(c).over(w) for c in cols})
    tot = ranged.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    wo = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__pid", *[F.coalesce(F.sum(f"__t_{c}").over(wo), F.lit(0)).alias(f"__o_{c}") for c in cols])
    out = local.join(F.broadcast(offs), "__pid")
    out = out.withColumns({f"{c}{suffix}": F.col(f"__l_{c}") + F.col(f"__o_{c}") for c in cols})
    return out.drop("__pid", *[f"__l_{c}" for c in cols], *[f"__o_{c}" for c in cols])
