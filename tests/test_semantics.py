"""Literal frames, one or more per semantic trap T1-T25."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import numeric as N
from quarry.functions import strings as St
from quarry.operators import aggregate as A
from quarry.operators import features as Fe
from quarry.operators import filters as Fi
from quarry.operators import metrics as Me
from quarry.operators import missing as M
from quarry.operators import profile as P
from quarry.operators import ranking as R
from quarry.operators import schema as Sc
from quarry.operators import setops as S
from quarry.operators import timeseries as Ts


def test_t1_null_keys_dropped(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("a", 3.0)], "k string, v double")
    out = {r.k: r.v for r in A.group_sum(df, "k", ["v"]).collect()}
    assert out == {"a": 4.0}
    kept = A.group_sum(df, "k", ["v"], dropna=False).collect()
    assert len(kept) == 2


def test_t2_all_null_group_sum_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    out = {r.k: r.v for r in A.group_sum(df, "k", ["v"]).collect()}
    assert out == {"a": 0.0, "b": 1.0}


def test_t3_first_keys_in_key_order(spark):
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate("dcbaedcba")], "k string, v double")
    out = [r.k for r in R.first_keys(df, "k", "v", "sum", 3).collect()]
    assert out == ["a", "b", "c"]


def test_t4_quantile_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    q = {r.prob: r.value for r in P.quantiles(df, "x", [0.25, 0.5, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 3.25}


def test_t5_iqr_sequential_and_nulls(spark):
    rows = [(float(i), float(i % 5)) for i in range(20)] + [(1000.0, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    fences = Fi.fit_iqr(df, ["a", "b"])
    out = fences.transform(df)
    assert out.filter(F.col("a") == 1000.0).count() == 0
    assert out.filter(F.col("a").isNull()).count() == 0  # null rows fall out
    # second column's quartiles come from the survivors of the first
    surv = df.filter(F.col("a").between(fences.fences[0][1], fences.fences[0][2]))
    q1, q3 = surv.agg(F.percentile("b", F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
    assert fences.fences[1][1] == pytest.approx(q1 - 1.5 * (q3 - q1))


def test_t6_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    out = M.impute(df, ["x"], "mode").collect()
    assert sorted(r.x for r in out) == ["a", "a", "a", "b", "b"]


def test_t7_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    s = Fe.fit_standardize(df, ["x"])
    assert s.stats["x"][1] == pytest.approx(math.sqrt(2 / 3))
    d = P.describe_numeric(df, ["x"]).first()
    assert d.std == pytest.approx(1.0)  # describe: sample std


def test_t8_minmax_constant_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, x double")
    out = Fe.fit_minmax(df, ["c", "x"]).transform(df).collect()
    assert [r.c for r in out] == [0.0, 0.0]
    assert sorted(r.x for r in out) == [0.0, 1.0]


def test_t9_label_codes_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("c",), ("a",), ("b",), (None,)], "x string")
    enc = Fe.fit_label_encoder(df, ["x"])
    got = {r.x: r.x_code for r in enc.transform(df, "_code").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, None: None}
    got2 = {r.x: r.x_code for r in R.label_codes(df, "x").collect()}
    assert got2 == got


def test_t10_one_hot_all_levels_null_zero(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    oh = Fe.fit_one_hot(df, ["x"], levels={"x": ["a", "b", "z"]})
    out = oh.transform(df).collect()
    assert sorted(tuple(r) for r in out) == [(0, 0, 0), (0, 1, 0), (1, 0, 0)]


def test_t11_map_vs_replace(spark):
    df = spark.createDataFrame([("yes",), ("no",), ("maybe",)], "x string")
    out = df.select(St.map_values("x", {"yes": "1", "no": "0"}).alias("m"),
                    St.replace_values("x", {"yes": "1", "no": "0"}).alias("r")).collect()
    assert [(r.m, r.r) for r in out] == [("1", "1"), ("0", "0"), (None, "maybe")]


def test_t12_frame_replace_whole_value(spark):
    df = spark.createDataFrame([("finishing ", "finishing x")], "a string, b string")
    out = St.replace_values_frame(df, {"finishing ": "finishing"}).first()
    assert (out.a, out.b) == ("finishing", "finishing x")


def test_t13_t14_month_year_pivot_and_garbage(spark):
    df = spark.createDataFrame([("Jan-68",), ("Jan-69",), ("Dec-74",), ("bad",), (None,)], "s string")
    out = [(r.s_month, r.s_year) for r in df.select(*[c.alias(n) for n, c in D.parse_month_year("s").items()]).collect()]
    assert out == [("01", "2068"), ("01", "1969"), ("12", "1974"), ("", ""), ("", "")]


def test_t15_resample_fills_empty_month_month_end(spark):
    rows = [(dt.datetime(2020, 1, 15), 1.0), (dt.datetime(2020, 3, 2), 2.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    out = Ts.resample(df, "ts", "month", {"v": ("sum", "v")}).orderBy("ts").collect()
    assert [(r.ts.date(), r.v) for r in out] == [(dt.date(2020, 1, 31), 1.0), (dt.date(2020, 2, 29), 0.0),
                                                  (dt.date(2020, 3, 31), 2.0)]


def test_t16_monday_zero_iso_week(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7),), (dt.datetime(2024, 1, 8),)], "ts timestamp_ntz")
    out = D.calendar_features(df, "ts").collect()
    assert [(r.dayofweek, r.weekofyear) for r in out] == [(6, 1), (0, 2)]


def test_t17_floor_division(spark):
    df = spark.createDataFrame([(100, -365), (-100, 365), (730, 365)], "a int, b int")
    assert [r[0] for r in df.select(N.floor_div("a", "b")).collect()] == [-1, -1, 2]


def test_t18_day_and_minute_gaps_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 50), dt.datetime(2024, 1, 2, 0, 5, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(D.days_between("a", "b").alias("d"), D.minutes_between("a", "b").alias("m")).first()
    assert (r.d, r.m) == (1, 15.5)


def test_t19_hard_auc(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    m = Me.class_metrics(df).first()
    assert m.auc_hard == pytest.approx((0.5 + 1.0) / 2)
    assert (m.tp, m.fp, m.fn, m.tn) == (1, 0, 1, 2)


def test_t19_roc_tied_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "label int, score double")
    out = Me.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    assert [(r.threshold, r.tp, r.fp) for r in out] == [(0.9, 1, 1), (0.5, 2, 1), (0.1, 2, 2)]


def test_t20_desc_nulls_first(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert [r.x for r in R.sort(df, "x", False, nulls_first=True).collect()] == [None, 3.0, 1.0]


def test_t21_null_safe_join(spark):
    from quarry.operators.joins import inner_join

    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("k", 20)], "k string, b int")
    assert inner_join(a, b, "k").count() == 1
    assert inner_join(a, b, "k", null_safe=True).count() == 2


def test_t22_canonical_case(spark):
    df = spark.createDataFrame([("Ford",), ("FORD",), ("Kia",), ("bmw",), ("BMW",)], "m string")
    out = sorted(r.m for r in R.canonical_case(df, "m").collect())
    assert out == ["BMW", "BMW", "FORD", "FORD", "Kia"]


def test_t23_silhouette_exact_vs_numpy(spark):
    import numpy as np

    from quarry.operators.neighbors import silhouette_exact

    rng = np.random.default_rng(0)
    X = np.vstack([rng.normal(0, 1, (15, 3)), rng.normal(4, 1, (12, 3)), rng.normal(-4, 1, (1, 3))])
    lab = [0] * 15 + [1] * 12 + [2]
    df = spark.createDataFrame([(i, int(c), [float(v) for v in x]) for i, (c, x) in enumerate(zip(lab, X))],
                               "id long, c int, x array<double>")
    got = {r.id: r.silhouette for r in silhouette_exact(df, "c", "x", "id", block_rows=10).collect()}
    D_ = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    lab = np.array(lab)
    for i in range(len(X)):
        own = (lab == lab[i])
        if own.sum() == 1:
            assert got[i] == 0.0
            continue
        a = D_[i, own].sum() / (own.sum() - 1)
        b = min(D_[i, lab == c].mean() for c in set(lab) if c != lab[i])
        assert got[i] == pytest.approx((b - a) / max(a, b), rel=1e-9)


def test_t24_even_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (2.0,), (10.0,)], "x double")
    out = M.impute(df, ["x"], "median").collect()
    assert sorted(r.x for r in out) == [1.0, 2.0, 3.0, 4.0, 10.0]


def test_t25_lasso_mapping_matches_closed_form(spark):
    # one standardised feature, no intercept effect: lasso soft-threshold
    rows = [(float(x), 2.0 * x) for x in (-2, -1, 1, 2)]
    df = spark.createDataFrame(rows, "x double, y double")
    from quarry.operators.models import fit_elastic

    m = fit_elastic(df, ["x"], "y", alpha=0.5, l1_ratio=1.0).stages[-1]
    # sklearn objective 1/(2n)|y - Xw|^2 + alpha|w| -> w = (x.y/n - alpha) / (x.x/n)
    n, xy, xx = 4, sum(x * y for x, y in rows), sum(x * x for x, _ in rows)
    assert float(m.coefficients[0]) == pytest.approx((xy / n - 0.5) / (xx / n), rel=1e-3)


def test_empty_and_single_row(spark):
    e = spark.createDataFrame([], "k string, v double")
    assert A.group_sum(e, "k", ["v"]).count() == 0
    assert S.duplicate_count(e).first().n_duplicates == 0
    one = spark.createDataFrame([("a", 1.0)], "k string, v double")
    d = P.describe_numeric(one, ["v"]).first()
    assert d["count"] == 1 and d["std"] is None
    assert P.has_nulls(one) is False


def test_drop_sparse_and_constant(spark):
    df = spark.createDataFrame([(1, None, "x", None), (2, None, "x", 1.0), (3, 5, "x", None)],
                               "a int, b int, c string, d double")
    assert Sc.drop_sparse(df, 45.0).columns == ["a", "c"]
    assert Sc.drop_constant(df).columns == ["a"]


def test_value_counts_normalize(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    out = [(r.x, r.proportion) for r in A.value_counts(df, "x", normalize=True).collect()]
    assert out == [("a", 2 / 3), ("b", 1 / 3)]


def test_peak_ties_earliest(spark):
    df = spark.createDataFrame([("v", 1, 5.0), ("v", 2, 5.0), ("v", 3, 1.0), ("v", 4, 1.0)], "k string, d int, m double")
    r = A.peak(df, "k", "d", "m").first()
    assert (r.d_at_max, r.d_at_min) == (1, 3)


def test_sentinel_mode_counts_sentinel(spark):
    df = spark.createDataFrame([("XNA",), ("XNA",), ("XNA",), ("F",), ("M",), ("M",)], "g string")
    assert sorted(r.g for r in M.sentinel_to_mode(df, "g", "XNA").collect()) == ["F", "M", "M", "XNA", "XNA", "XNA"]


def test_sample_n_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in Fi.sample_n(df, 10, 5, ["k"]).collect())
    b = sorted(r.k for r in Fi.sample_n(df.repartition(7), 10, 5, ["k"]).collect())
    assert a == b and len(a) == 10


def test_extend_calendar_month_end(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31), 1.0)], "d date, v double")
    out = S.extend_calendar(df, "d", 2).orderBy("d").collect()
    assert [r.d for r in out] == [dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 31)]


def test_customer_features_and_rfm(spark):
    rows = [(1, "c1", dt.date(2020, 1, 1), 2.0, 10.0), (2, "c1", dt.date(2020, 1, 5), 1.0, 5.0),
            (3, "c2", dt.date(2020, 1, 3), 4.0, 8.0)]
    df = spark.createDataFrame(rows, "tid long, cust string, d date, qty double, amt double")
    got = {r.cust: (r.n_transactions, r.total_qty, r.total_amount)
           for r in Fe.customer_features(df, "cust", "tid", "qty", "amt").collect()}
    assert got == {"c1": (2, 3.0, 15.0), "c2": (1, 4.0, 8.0)}
    r = {x.cust: (x.recency, x.frequency, x.monetary) for x in Fe.rfm(df, "cust", "d", "tid", "amt").collect()}
    assert r == {"c1": (2, 2, 15.0), "c2": (4, 1, 8.0)}
