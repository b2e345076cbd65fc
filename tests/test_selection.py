"""Radix selection against sorting."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import features as Fe
from quarry.operators import profile as P
from quarry.operators.selection import order_code, select_ranks

HARD = [0.0, -0.0, 1.0, -1.0, 2.0**52, -(2.0**53), 1e308, -1e308, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
        float("inf"), float("-inf"), 0.1, 0.30000000000000004, 1 / 3, 1e-300, 4503599627370497.5, np.nextafter(8.0, 0), 8.0, np.nextafter(8.0, 9)]


def test_codes_sort_like_the_values(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in HARD] + [float(v) for v in rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300)]
    got = {r.v: r.c for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", order_code(F.col("v")).alias("c")).collect()}
    ordered = sorted(set(values))
    codes = [got[v] for v in ordered]
    assert all(a < b for a, b in zip(codes, codes[1:]))
    odd = spark.createDataFrame([(None,), (float("nan"),)], "v double").select(order_code(F.col("v")).alias("c")).collect()
    assert odd[0].c is None and odd[1].c > max(codes)
    above = [v for v in ordered if v > 0]  # their codes are their bit patterns
    assert [got[v] for v in above] == np.array(above).view(np.int64).tolist()


@pytest.mark.parametrize("few", [True, False])
def test_ranks_per_group_and_column(spark, few, monkeypatch):
    import quarry.operators.selection as S

    monkeypatch.setattr(S, "BROADCAST_GROUPS", 20_000 if few else 0)
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([*map(float, HARD), rnd.gauss(0, 1), None]), rnd.randint(-(2**63), 2**63 - 1) >> rnd.choice([0, 40])) for _ in range(600)]
    rows += [("hot", 7.25, 3)] * 300 + [("empty", None, 1)]
    df = spark.createDataFrame(rows, "k string, x double, i bigint")
    got = select_ranks(df, ["k"], {"x": order_code(F.col("x")), "i": F.col("i")}, lambda n: F.array(F.lit(0).cast("bigint"), F.floor(n / 2), n - 1, n), {"x": F.col("x")})
    have = {(r.k, r.col, r["rank"]): (r.n, r.below, r.code, r.value) for r in got.collect()}
    for k in ("a", "b", None, "hot", "empty"):
        for c, j in (("x", 1), ("i", 2)):
            vs = sorted(r[j] for r in rows if r[0] == k and r[j] is not None)
            ranks = {0, len(vs) // 2, len(vs) - 1} if vs else set()
            assert {r for kk, cc, r in have if (kk, cc) == (k, c)} == ranks
            for r in ranks:
                n, below, code, value = have[k, c, r]
                assert n == len(vs) and below == sum(v < vs[r] for v in vs)
                assert (value == vs[r]) if c == "x" else code == vs[r]


def test_quantiles_have_no_sort_and_no_checkpoint(spark, capsys):
    rng = np.random.default_rng(4)
    rows = [(k, float(v)) for k, n in (("a", 101), (None, 40), ("b", 1)) for v in np.round(rng.normal(size=n), 2)]
    df = spark.createDataFrame(rows, "k string, x double")
    q = P.exact_quantiles_sorted(df, "x", [0.1, 0.5, 0.99], "k")
    for k in ("a", None, "b"):
        mine = {r.prob: r.value for r in q.collect() if r.k == k}
        assert mine == pytest.approx({p: np.quantile([v for g, v in rows if g == k], p) for p in (0.1, 0.5, 0.99)})
    q.explain()
    plan = capsys.readouterr().out
    assert "rangepartitioning" not in plan and "ExistingRDD" not in plan.replace("Scan ExistingRDD[k#", "")
    assert [r.value for r in P.exact_quantiles_sorted(df.limit(0), "x", [0.5]).collect()] == [None]


def frame(spark, n=80, seed=5):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, *(dt.date(2020, 1, d) for d in range(1, 5))]), rnd.choice(["x", "y", "yy", None]), rnd.choice([1.5, -2.0, None]), k // 2) for k in range(n)]
    return spark.createDataFrame(rows + rows[:9], "d date, s string, x double, i int"), rows + rows[:9]


@pytest.mark.parametrize("order", [["x", "s"], ["s", "d"], ["i"]])
def test_ordered_split_is_the_sorted_cut(spark, order):
    df, rows = frame(spark)
    names = ["d", "s", "x", "i"]
    full = order + [c for c in names if c not in order]
    key = lambda r: [(r[names.index(c)] is not None, r[names.index(c)] or (dt.date(1, 1, 1) if c == "d" else "" if c == "s" else 0)) for c in full]
    ordered = sorted(rows, key=key)
    for n in (0, 37, len(rows) + 5):
        a, b = Fe.ordered_split(df, order if len(order) > 1 else order[0], n)
        assert sorted(map(tuple, a.collect()), key=key) == ordered[:n] and sorted(map(tuple, b.collect()), key=key) == ordered[n:], n


def test_undersample_repeated_keys_and_null_class(spark):
    rows = [("a", k) for k in range(50)] + [("b", 1)] * 30 + [(None, k) for k in range(17)]
    df = spark.createDataFrame(rows, "label string, id int")
    got = Fe.undersample(df, "label", "id", seed=3).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {"a": 17, "b": 17, None: 17}
    again = Fe.undersample(df.repartition(5), "label", "id", seed=3)
    assert sorted(map(str, again.collect())) == sorted(map(str, Fe.undersample(df, "label", "id", seed=3).collect()))
    assert Fe.undersample(df.limit(0), "label", "id").count() == 0


def test_grouped_quantiles_by_brackets_and_radix(spark):
    rows = [(None if i % 5 == 0 else i % 3, None if i % 11 == 0 else float((i * 7919) % 1000 if i % 3 else i % 4)) for i in range(3000)]
    rows += [(9, None), (8, 2.5), (7, float("nan")), (7, 1.0)]
    df = spark.createDataFrame(rows, "k int, x double")
    probs = [0.0, 0.25, 0.5, 1.0]
    want = sorted((str(r.k), r.prob, str(r.value)) for r in P.exact_quantiles_sorted(df, "x", probs, "k").collect())
    for accuracy, limit in ((10_000, 200_000), (20, 200_000), (20, 5)):  # exact sketch; brackets; most brackets too large
        got = P.exact_quantiles_grouped(df, "x", probs, "k", accuracy, limit).collect()
        assert sorted((str(r.k), r.prob, str(r.value)) for r in got) == want


def test_box_stats_of_many_values_hold_no_map_and_no_group_in_a_task(spark, monkeypatch, capsys):
    monkeypatch.setattr(P, "GROUPED_MAP_DISTINCT", 10)
    df = spark.createDataFrame([("ab"[i % 2], float(i * 37 % 1009)) for i in range(1009)], "k string, x double")
    monkeypatch.setattr(P, "_q", None)  # no map of values
    out = P.box_stats(df, ["x"], by="k")
    out.explain()
    assert "SortMergeJoin" not in capsys.readouterr().out
    for r in out.collect():
        x = np.array([float(i * 37 % 1009) for i in range(1009) if "ab"[i % 2] == r.k])
        assert [r.q1, r.median, r.q3] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.75]).tolist())


def test_rank_between_two_hot_values_is_not_sorted(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 2),) for i in range(2000)], "x double")

    def sent(self, n):
        raise AssertionError("an offset sends the first rows of every task to the driver")

    monkeypatch.setattr(type(df), "offset", sent)
    for p in (0.25, 0.5, 0.75):
        got = P.exact_quantiles_bracketed(df, "x", [p], accuracy=20, collect_limit=50)
        assert got[p] == np.quantile([0.0, 1.0] * 1000, p)
    base = df.select(P.F.col("x").alias("__x"))
    assert [P._nth(base, r) for r in (0, 999, 1000, 1999)] == [0.0, 0.0, 1.0, 1.0]
