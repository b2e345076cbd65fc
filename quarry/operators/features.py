"""Feature engineering, splitting and resampling (2.13).

Fit objects learn small state with one aggregate (levels, min/max,
mean/std, frequencies) and apply it as a projection or a checked
broadcast join, so train and test are transformed by the same state
(fit on train, transform anything).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.joins import broadcast_if_small


# ---------------------------------------------------------------- encoders
MAX_COLLECTED_LEVELS = 10_000


def _levels(df: DataFrame, c: str, max_levels: int) -> list | None:
    """Sorted distinct non-NULL levels, or None when there are more than
    ``max_levels`` (checked by fetching at most ``max_levels + 1``)."""
    rows = df.select(c).filter(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        return None
    return sorted(r[0] for r in rows)


class LabelEncoder:
    """Alphabetical codes from 0 (T9); unseen value -> NULL. Small level
    sets are applied as a literal map; larger ones as a join with the
    distributed code table (:func:`quarry.operators.ranking.label_codes`)."""

    def __init__(self, levels: dict[str, list], tables: dict[str, DataFrame] | None = None):
        self.levels = levels
        self.tables = tables or {}

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        from quarry.operators.ranking import ordinal_rank

        out = df.withColumns({f"{c}{suffix}": ordinal_rank(c, lv).cast("int") for c, lv in self.levels.items()})
        for c, t in self.tables.items():
            t2 = t.select(F.col(c).alias("__lv"), F.col("__code").cast("int").alias(f"{c}{suffix}"))
            out = out.join(t2, F.col(c) == F.col("__lv"), "left").drop("__lv")
        return out


def fit_label_encoder(df: DataFrame, cols: list[str], max_levels: int = MAX_COLLECTED_LEVELS) -> LabelEncoder:
    """Distinct levels per column, sorted (op 13.1). At most ``max_levels``
    levels are brought to the driver; a column with more keeps its codes
    as a distributed table (numbered by range partitioning), checkpointed."""
    from quarry.operators.ranking import row_numbers
    from quarry.session import cut_lineage

    levels, tables = {}, {}
    for c in cols:
        lv = _levels(df, c, max_levels)
        if lv is not None:
            levels[c] = lv
        else:
            distinct = df.select(c).filter(F.col(c).isNotNull()).distinct()
            tables[c] = cut_lineage(row_numbers(distinct, [c], "__code", start=0, total=False))
    return LabelEncoder(levels, tables)


def _slug(v) -> str:
    return re.sub(r"[^0-9A-Za-z_]+", "_", str(v))


class OneHot:
    """One indicator per level, all levels kept; NULL / unseen -> all 0 (T10)."""

    def __init__(self, levels: dict[str, list], drop_source: bool = True, taken: set[str] | None = None):
        self.levels = levels
        self.drop_source = drop_source
        self.taken = set(taken or ())

    def named(self) -> list[tuple[str, str, object]]:
        """(name, column, level); a name that two levels share, or that the fitted
        frame has already (letter case aside), gets the level's position."""
        out, seen = [], {t.lower() for t in self.taken}
        for c, lv in self.levels.items():
            for i, v in enumerate(lv):
                n = f"{c}_{_slug(v)}"
                while n.lower() in seen:
                    n = f"{n}_{i}"
                seen.add(n.lower())
                out.append((n, c, v))
        return out

    def columns(self) -> list[str]:
        return [n for n, _, _ in self.named()]

    def transform(self, df: DataFrame) -> DataFrame:
        new = {n: F.when(F.col(c) == F.lit(v), 1).otherwise(0) for n, c, v in self.named()}
        keep = [x for x in df.columns if not (self.drop_source and x in self.levels)]
        clash = sorted({x.lower() for x in keep} & {n.lower() for n in new})
        if clash:
            raise ValueError(f"columns {clash} would appear twice; fit on a frame that has them")
        return df.select(*keep, *[e.alias(n) for n, e in new.items()])  # one projection, not a chain


class SparseOneHot:
    """One place per level in a sparse vector, for any number of levels; NULL and
    unseen values set no place (T10). The levels are tables (value, code)
    numbered in their order; column after column has its range of places."""

    def __init__(self, tables: dict[str, DataFrame], sizes: dict[str, int]):
        self.tables = tables
        self.sizes = sizes

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def indices(self, df: DataFrame, name: str = "indices") -> DataFrame:
        """``df`` with the ascending places that are set, array<bigint>."""
        out, start, at = df, 0, []
        for i, (c, t) in enumerate(self.tables.items()):
            side = t.select(F.col(c).alias(f"__lv{i}"), (F.col("__code") + F.lit(start)).alias(f"__at{i}"))
            out = out.join(side, F.col(c) == F.col(f"__lv{i}"), "left").drop(f"__lv{i}")
            at.append(F.col(f"__at{i}"))
            start += self.sizes[c]
        return out.withColumn(name, F.array_compact(F.array(*at))).drop(*[f"__at{i}" for i in range(len(at))])

    def transform(self, df: DataFrame, name: str = "onehot") -> DataFrame:
        """``df`` with a sparse ML vector of ``size`` places, JVM-side."""
        from pyspark.ml.feature import OneHotEncoderModel, OneHotEncoder, VectorAssembler

        out, parts = df, []
        for i, (c, t) in enumerate(self.tables.items()):
            side = t.select(F.col(c).alias(f"__lv{i}"), F.col("__code").cast("double").alias(f"__at{i}"))
            out = out.join(side, F.col(c) == F.col(f"__lv{i}"), "left").drop(f"__lv{i}")
            # a value without a level is the one category beyond the last, which is dropped
            out = out.withColumn(f"__at{i}", F.coalesce(f"__at{i}", F.lit(float(self.sizes[c]))))
            fitted: OneHotEncoderModel = OneHotEncoder(inputCol=f"__at{i}", outputCol=f"__v{i}", dropLast=True, handleInvalid="keep").fit(
                df.sparkSession.createDataFrame([(float(max(0, self.sizes[c] - 1)),)], f"__at{i} double"))
            out = fitted.transform(out).drop(f"__at{i}")
            parts.append(f"__v{i}")
        return VectorAssembler(inputCols=parts, outputCol=name).transform(out).drop(*parts)


def fit_one_hot_sparse(df: DataFrame, cols: list[str]) -> SparseOneHot:
    """Level tables of any size (op 13.2): distinct non-NULL levels, numbered in
    ascending order by ranges and kept as tables; only the number of levels
    per column comes to the driver."""
    from quarry.operators.ranking import row_numbers
    from quarry.session import cut_lineage

    tables, sizes = {}, {}
    for c in cols:
        distinct = df.select(c).filter(F.col(c).isNotNull()).distinct()
        tables[c] = cut_lineage(row_numbers(distinct, [c], "__code", start=0, total=False))
        sizes[c] = tables[c].count()
    return SparseOneHot(tables, sizes)


def fit_one_hot(df: DataFrame, cols: list[str], levels: dict[str, list] | None = None,
                drop_source: bool = True, max_levels: int = 1_000) -> OneHot:
    """Levels per column from the data unless given (ordered categoricals
    pass their full level list and so yield unseen levels too). A column
    with more than ``max_levels`` levels is refused: one indicator column
    per level would not be a usable projection (:func:`fit_one_hot_sparse`
    takes any number of levels)."""
    levels = dict(levels or {})
    for c in cols:
        if c not in levels:
            lv = _levels(df, c, max_levels)
            if lv is None:
                raise ValueError(f"{c}: more than {max_levels} levels; one-hot refused (use label/frequency encoding)")
            levels[c] = lv
    return OneHot(levels, drop_source, set(df.columns) - (set(levels) if drop_source else set()))


class FreqEncoder:
    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables

    def transform(self, df: DataFrame, suffix: str = "_freq") -> DataFrame:
        for c, t in self.tables.items():
            t2 = t.select(F.col(c).alias("__fv"), F.col("share").alias(f"{c}{suffix}"))
            df = df.join(t2, F.col(c) == F.col("__fv"), "left").drop("__fv")
        return df


def fit_freq_encoder(df: DataFrame, cols: list[str]) -> FreqEncoder:
    """Share of (non-NULL) rows per value (op 13.3), computed once and written to
    the shared folder; applied by a join, unseen -> NULL."""
    from quarry.operators.aggregate import value_counts
    from quarry.session import cut_lineage

    return FreqEncoder({c: cut_lineage(value_counts(df, c, normalize=True, name="share")) for c in cols})


def ordinal(df: DataFrame, col: str, levels: list, name: str | None = None) -> DataFrame:
    """Ordered categorical -> rank (op 13.4); unseen -> NULL."""
    from quarry.operators.ranking import ordinal_rank

    return df.withColumn(name or f"{col}_ord", ordinal_rank(col, levels).cast("int"))


# ----------------------------------------------------------------- scalers
class MinMax:
    def __init__(self, stats: dict[str, tuple[float, float]]):
        self.stats = stats

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (mn, mx) in self.stats.items():
            x = F.col(c).cast("double")
            out[c] = F.lit(0.0) if mn is None or mx == mn else (x - F.lit(mn)) / F.lit(mx - mn)
            if mn is not None and mx == mn:
                out[c] = F.when(x.isNull(), None).otherwise(F.lit(0.0))  # constant column -> 0 (T8)
        return df.withColumns(out)


def fit_minmax(df: DataFrame, cols: list[str]) -> MinMax:
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__mn") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"{c}__mx") for c in cols]).first()
    return MinMax({c: (row[f"{c}__mn"], row[f"{c}__mx"]) for c in cols})


class Standardize:
    def __init__(self, stats: dict[str, tuple[float, float]]):
        self.stats = stats

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (mu, sd) in self.stats.items():
            x = F.col(c).cast("double")
            out[c] = (x - F.lit(mu)) / F.lit(sd) if sd else (x - F.lit(mu)) * 0.0
        return df.withColumns(out)


def fit_standardize(df: DataFrame, cols: list[str], ddof: int = 0) -> Standardize:
    """Mean and *population* std (``StandardScaler``, T7); ``ddof=1`` for sample."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__mu") for c in cols],
                 *[sd(F.col(c).cast("double")).alias(f"{c}__sd") for c in cols]).first()
    return Standardize({c: (row[f"{c}__mu"], row[f"{c}__sd"]) for c in cols})


# ------------------------------------------------------- assembled features
def assemble(df: DataFrame, feature_cols: list[str], label: str | None = None,
             output: str = "features", keep: list[str] | None = None) -> DataFrame:
    """X/y as ``(keep..., features vector, label)`` (op 13.10)."""
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=feature_cols, outputCol=output, handleInvalid="keep")
    out = va.transform(df)
    cols = list(keep or []) + [output] + ([label] if label else [])
    return out.select(*cols)


def pca(df: DataFrame, cols: list[str], k: int = 2, keep: list[str] | None = None) -> DataFrame:
    """Top-``k`` principal components of the *centred* features (op 13.7).
    Each component's sign is fixed so its largest-|loading| entry is
    positive (PCA signs are arbitrary). Returns ``keep... , pc1..pck``."""
    import numpy as np
    from pyspark.ml.feature import PCA as _PCA
    from pyspark.ml.functions import vector_to_array

    mus = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    centred = df.withColumns({c: F.col(c).cast("double") - F.lit(mus[c]) for c in cols})
    v = assemble(centred, cols, keep=list(keep or []) + cols, output="__x")
    model = _PCA(k=k, inputCol="__x", outputCol="__pc").fit(v)
    pcm = model.pc.toArray()
    signs = [1.0 if pcm[np.argmax(np.abs(pcm[:, j])), j] >= 0 else -1.0 for j in range(k)]
    t = model.transform(v).withColumn("__arr", vector_to_array("__pc"))
    return t.select(*(keep or []), *[(F.col("__arr")[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)])


def rfm(df: DataFrame, customer: str, date: str, order_id: str, amount: str, offset_days: int = 2) -> DataFrame:
    """Recency / frequency / monetary per customer in ONE aggregation
    (op 13.8; the original joins three aggregates): recency = days from
    the customer's last date to (global last date + ``offset_days``),
    frequency = distinct orders, monetary = total amount."""
    d = F.to_date(F.col(date))
    ref = F.date_add(df.select(F.max(d)).scalar(), offset_days)
    g = df.groupBy(customer).agg(F.max(d).alias("__last"), F.count_distinct(order_id).alias("frequency"),
                                 F.sum(amount).alias("monetary"))
    return g.select(customer, F.datediff(ref, F.col("__last")).alias("recency"), "frequency", "monetary")


def customer_features(df: DataFrame, key: str, id_col: str, qty: str, amount: str) -> DataFrame:
    """count of transactions, total quantity, total amount per key (op 13.9)."""
    return df.groupBy(key).agg(F.count(id_col).alias("n_transactions"), F.sum(qty).alias("total_qty"),
                               F.sum(amount).alias("total_amount"))


def select_by_importance(importances: DataFrame, df: DataFrame, n: int = 20, keep: list[str] | None = None) -> DataFrame:
    """Keep the ``n`` most important features (op 13.11); ``importances`` is
    the (feature, importance) table of :func:`quarry.operators.models.importance`."""
    top = [r["feature"] for r in importances.orderBy(F.col("importance").desc(), "feature").limit(n).collect()]
    return df.select(*(keep or []), *top)


# ---------------------------------------------------------------- splitting
def hash_bucket(key, seed: int, buckets: int = 1_000_000) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets))


def split(df: DataFrame, key, frac: float = 0.8, seed: int = 42, method: str = "xxhash64") -> tuple[DataFrame, DataFrame]:
    """Seeded train/test split by a hash of the key (op 13.12): stable across
    plans, partitionings and reruns (``randomSplit`` is not), no shuffle.
    ``method='md5'`` uses the portable md5 bucket (same split in any SQL
    engine with md5; the seed is then ignored)."""
    if method == "md5":
        b, cut = md5_bucket(key, 100), int(round(frac * 100))
    else:
        b, cut = hash_bucket(key, seed), int(frac * 1_000_000)
    return df.filter(b < cut), df.filter(b >= cut)


def md5_bucket(key: str, buckets: int = 100) -> Column:
    """Portable split bucket: first 8 hex digits of md5(key) mod ``buckets``
    (identical in DuckDB; used by the oracle tests)."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def ordered_split(df: DataFrame, order, n_train: int) -> tuple[DataFrame, DataFrame]:
    """First ``n_train`` rows in ``order`` vs the rest (op 13.13), NULL first; rows
    equal in ``order`` follow the other columns, rows equal in all of these
    count as interchangeable. The cut is found by rank selection
    (:func:`quarry.operators.selection.cut_row`) and the halves are two filters:
    nothing is numbered or sorted."""
    from quarry.operators.selection import cut_row

    order = [order] if isinstance(order, str) else list(order)
    order += [f.name for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    before, ties, left = cut_row(df, order, n_train)
    sure = F.coalesce(before, F.lit(False))
    if not left:
        return df.filter(sure), df.filter(~sure)
    tied = F.coalesce(ties, F.lit(False)) & ~sure
    some = df.filter(tied)
    rest = max(0, some.count() - left)
    return df.filter(sure).unionByName(some.limit(left)), df.filter(~sure & ~tied).unionByName(some.limit(rest))


def assign_folds(df: DataFrame, key, k: int = 5, repeats: int = 1, seed: int = 42, name: str = "fold",
                 method: str = "xxhash64") -> DataFrame:
    """Fold id in [0, k) by a seeded hash of the key; with ``repeats`` > 1
    one row per (row, repeat) with a ``repeat`` column (op 13.16).
    ``method='md5'``: portable fold = md5 bucket mod k, of 'repeat:key' when
    repeated."""
    if method == "md5" and repeats > 1:
        r = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        r = r.withColumn("__rk", F.concat_ws(":", F.col("repeat").cast("string"), *[c.cast("string") for c in _cols(key)]))
        return r.withColumn(name, md5_bucket("__rk", k).cast("int")).drop("__rk")
    if method == "md5":
        return df.withColumn(name, md5_bucket(key, k).cast("int"))
    if repeats == 1:
        return df.withColumn(name, F.pmod(F.xxhash64(F.lit(seed), *_cols(key)), F.lit(k)).cast("int"))
    r = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    return r.withColumn(name, F.pmod(F.xxhash64(F.lit(seed), F.col("repeat"), *_cols(key)), F.lit(k)).cast("int"))


def _cols(key):
    return [F.col(k) for k in ([key] if isinstance(key, str) else key)]


def undersample(df: DataFrame, label: str, key, seed: int = 42) -> DataFrame:
    """Random undersampling to the smallest class size (op 13.15).

    Each row gets a seeded hash of its key; per class the hash at the rank of the
    smallest class is found by radix selection, and a filter keeps the rows up
    to it. Only rows with that very hash (repeated keys) are numbered."""
    from pyspark.sql import Window

    from quarry.operators.joins import join_on_keys
    from quarry.operators.selection import select_ranks

    h = F.xxhash64(F.lit(seed), *_cols(key))
    n_min = df.groupBy(label).count().agg(F.min("count")).first()[0]
    if not n_min:
        return df
    cut = select_ranks(df, [label], {"h": h}, lambda n: F.array(F.lit(n_min - 1).cast("bigint")))
    cut = cut.select(label, F.col("code").alias("__cut"), (F.lit(n_min) - F.col("below")).alias("__left"))
    rows = join_on_keys(df.withColumn("__h", h), cut, [label])
    at = F.row_number().over(Window.partitionBy(label, "__h").orderBy(*_cols(key)))
    ties = rows.filter(F.col("__h") == F.col("__cut")).withColumn("__at", at).filter(F.col("__at") <= F.col("__left")).drop("__at")
    return rows.filter(F.col("__h") < F.col("__cut")).unionByName(ties).drop("__h", "__cut", "__left")
