"""Exact rank selection by radix: values at given ranks without a sort (ops 5.27,
5.30, 13.13, 13.15).

A value's code is a 64-bit integer in the order of the values. Rows are counted
per (group, column, leading 16 bits), which tells the leading bits of the code
at every wanted rank; only rows with those bits are counted by the next 16,
and so on. A group adds at most 65,536 partial counts per round and task, and
no task ever holds its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGIT = 16
#: at most this many (group, column) pairs have their digits broadcast
BROADCAST_GROUPS = 20_000


def order_code(x: Column) -> Column:
    """Of a double: a bigint that sorts like it (-0.0 as 0.0, NaN above infinity).
    Exponent and mantissa by exact powers of two; NULL stays NULL."""
    x = x.cast("double")
    a = F.when(F.abs(x) < F.lit(float("inf")), F.abs(x))
    guess = F.floor(F.log2(a))
    two = lambda e: F.pow(F.lit(2.0), e)
    # the logarithm can be off by one next to a power of two
    e = F.greatest(F.lit(-1022), F.when(two(guess) > a, guess - 1).when(two(guess + 1) <= a, guess + 1).otherwise(guess))
    e = F.least(e, F.lit(1023))
    normal = (e + 1023) * F.lit(1 << 52) + ((a / two(e) - 1) * F.lit(float(1 << 52))).cast("bigint")
    tiny = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    size = F.when(a.isNull(), F.lit(2047 << 52)).when(a == 0, F.lit(0).cast("bigint")).when(a < F.lit(2.0**-1022), tiny).otherwise(normal)
    return F.when(x.isNull(), F.lit(None).cast("bigint")).when(F.isnan(x), F.lit((1 << 63) - 1)).otherwise(F.when(x < 0, -size).otherwise(size))


def code_of(df: DataFrame, col: str) -> Column | None:
    """Code of a numeric, date, timestamp or boolean column, None for other types."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return F.col(col).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return order_code(F.col(col))
    return None


def _digit(code: Column, k: int) -> Column:
    """The k-th 16 bits from the top, in the order of signed codes."""
    shift = 64 - DIGIT * (k + 1)
    return F.shiftright(code, shift) if k == 0 else F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))


def _prefix(code: Column, k: int) -> Column:
    """The first k digits."""
    return F.shiftright(code, 64 - DIGIT * k)


def select_ranks(df: DataFrame, keys: list[str], codes: dict[str, Column], ranks, values: dict[str, Column] | None = None) -> DataFrame:
    """(keys..., col, n, rank, below, code, value): per group and column of ``codes`` the
    code at each wanted 0-based rank, and the rows below it.

    ``ranks(n)`` is an array<bigint> of ranks for ``n`` non-NULL codes; ranks outside
    0 .. n-1 give no row. ``value`` is the value (a double) that belongs
    to the code, from ``values``. Groups are told apart NULL-safely.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    vals = values or {}
    cells = F.array(*[F.struct(F.lit(c).alias("col"), e.alias("code"), vals.get(c, F.lit(None)).cast("double").alias("value")) for c, e in codes.items()])
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.explode(cells).alias("c")).select(*names, "c.*").filter("code is not null")
    group = [*names, "col"]
    few = not keys or df.select(*keys).distinct().limit(BROADCAST_GROUPS // max(1, len(codes)) + 1).count() * len(codes) <= BROADCAST_GROUPS
    counts = rows.groupBy(*group, _digit(F.col("code"), 0).alias("digit")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(*group).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns({"upto": F.sum("c").over(upto), "n": F.sum("c").over(Window.partitionBy(*group))})
    want = counts.withColumn("w", F.filter(ranks(F.col("n")), lambda r: (r >= F.col("upto") - F.col("c")) & (r < F.col("upto"))))
    want = want.filter(F.size("w") > 0).select(*group, "n", F.col("digit").alias("prefix"), F.transform(
        "w", lambda r: F.struct(r.alias("rank"), (F.col("upto") - F.col("c")).alias("below"))).alias("w"))
    for k in range(1, 64 // DIGIT):
        # one row per group and prefix; its ranks ride along with the counts
        on = [*[F.col(n).eqNullSafe(F.col(f"_w{n}")) for n in names], F.col("col") == F.col("_wcol"), _prefix(F.col("code"), k) == F.col("prefix")]
        cond = on[0]
        for o in on[1:]:
            cond = cond & o
        side = want.select(*[F.col(g).alias(f"_w{g}") for g in group], "n", "prefix", "w")
        met = rows.join(F.broadcast(side) if few else side, cond)
        counts = met.groupBy(*group, "prefix", _digit(F.col("code"), k).alias("digit")).agg(
            F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("w").alias("w"), F.max("value").alias("value"), F.max("code").alias("code"))
        upto = Window.partitionBy(*group, "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("upto", F.sum("c").over(upto))
        inside = lambda s: (s["rank"] >= s["below"] + F.col("upto") - F.col("c")) & (s["rank"] < s["below"] + F.col("upto"))
        found = F.transform(F.filter("w", inside), lambda s: F.struct(s["rank"].alias("rank"), (s["below"] + F.col("upto") - F.col("c")).alias("below")))
        want = counts.withColumn("w", found).filter(F.size("w") > 0).select(
            *group, "n", F.shiftleft("prefix", DIGIT).bitwiseOR(F.col("digit")).alias("prefix"), "w", "code", "value")
    out = want.select(*group, "n", F.explode("w").alias("s"), "code", "value")
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "col", "n", "s.rank", "s.below", "code", "value")


def quantile_ranks(probs: list[float]):
    """Ranks that the linear-interpolated quantiles need, for :func:`select_ranks`."""
    def ranks(n: Column) -> Column:
        h = [(n - 1) * F.lit(float(p)) for p in probs]
        return F.array_distinct(F.array(*[f(x).cast("bigint") for x in h for f in (F.floor, F.ceil)]))
    return ranks


def cut_row(df: DataFrame, order: list[str], rank: int) -> tuple[Column, Column, int]:
    """Where the first ``rank`` rows in ``order`` (NULL first) end: a condition for the
    rows before the cut row, one for the rows equal to it in ``order``, and
    how many of those still belong to the first ``rank``."""
    before, equal, left = F.lit(False), F.lit(True), rank
    for c in order:
        code = code_of(df, c)
        rest = df.filter(equal)
        nulls = rest.filter(F.col(c).isNull()).count()
        if left < nulls:
            equal = equal & F.col(c).isNull()
            continue
        before = before | (equal & F.col(c).isNull())
        left -= nulls
        equal = equal & F.col(c).isNotNull()
        if code is not None:
            got = select_ranks(rest, [], {c: code}, lambda n: F.array(F.lit(left).cast("bigint"))).first()
            if got is None:  # all rows come before the cut
                return before | equal, F.lit(False), 0
            here, below = code, got["below"]
            less, same = here < F.lit(got["code"]), here == F.lit(got["code"])
        else:
            top = rest.filter(F.col(c).isNotNull()).orderBy(c).offset(left).limit(1).select(c).first()
            if top is None:
                return before | equal, F.lit(False), 0
            less, same = F.col(c) < F.lit(top[0]), F.col(c) == F.lit(top[0])
            below = rest.filter(less).count()
        before = before | (equal & less)
        equal = equal & same
        left -= below
        if left == 0:
            return before, F.lit(False), 0
    return before, equal, left
