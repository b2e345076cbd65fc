"""Model analyses (2.14), property-checked: each returns a small table
of scores / coefficients computed by MLlib jobs over the whole table.

Data (SURVEY 7.2, the tables are synthetic): classification target
``high_net`` = net price (extended price x (1 - discount)) above 50,000
with lineitem measures as features; regression target = net price.
"""

from pyspark.sql import functions as F

from quarry.operators import features as Fe
from quarry.operators import metrics as Me
from quarry.operators import models as Mo
from quarry.plans.registry import T, query

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark, sf):
    li = T(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", *FEATS, net.alias("net"),
                     (net > 50000).cast("int").alias("high_net"))


def _split(spark, sf):
    return Fe.split(_lines(spark, sf), ["l_orderkey", "l_linenumber"], 0.8, seed=42)


def _clf_scores(model, train, test, name):
    tr = Mo.score(model, train).withColumn("split", F.lit("train"))
    te = Mo.score(model, test).withColumn("split", F.lit("test"))
    both = tr.unionByName(te).withColumn("prediction", F.col("prediction").cast("int")).withColumn("model", F.lit(name))
    return Me.compare_models(both, "high_net", "prediction")


def _reg_scores(model, train, test, name, label="net"):
    tr = Mo.score(model, train).withColumn("split", F.lit("train"))
    te = Mo.score(model, test).withColumn("split", F.lit("test"))
    both = tr.unionByName(te)
    return Me.reg_metrics(both, label, "prediction", keys=["split"]).withColumn("model", F.lit(name))


@query("model_tree_gini_entropy", None)
def model_tree_gini_entropy(spark, sf):
    """14.1 decision trees (gini, entropy) -> train/test metrics table."""
    tr, te = _split(spark, sf)
    a = _clf_scores(Mo.fit_tree(tr, FEATS, "high_net", "gini", 5), tr, te, "tree_gini")
    b = _clf_scores(Mo.fit_tree(tr, FEATS, "high_net", "entropy", 5), tr, te, "tree_entropy")
    return a.unionByName(b)


@query("model_forest", None)
def model_forest(spark, sf):
    """14.2 random forest classifier (+ 14.21 importances in the test)."""
    tr, te = _split(spark, sf)
    return _clf_scores(Mo.fit_forest(tr, FEATS, "high_net", trees=20, max_depth=5), tr, te, "forest")


@query("model_forest_regressor", None)
def model_forest_regressor(spark, sf):
    """14.3 random forest regressor on net price."""
    tr, te = _split(spark, sf)
    return _reg_scores(Mo.fit_forest_reg(tr, FEATS, "net", trees=20, max_depth=6), tr, te, "forest_reg")


@query("model_logistic", None)
def model_logistic(spark, sf):
    """14.4 logistic regression, L2 and L1 with sklearn's C = 1 (T25)."""
    tr, te = _split(spark, sf)
    tr_s = Fe.fit_standardize(tr, FEATS)
    tr2, te2 = tr_s.transform(tr), tr_s.transform(te)
    a = _clf_scores(Mo.fit_logistic(tr2, FEATS, "high_net", 1.0, "l2"), tr2, te2, "logistic_l2")
    b = _clf_scores(Mo.fit_logistic(tr2, FEATS, "high_net", 1.0, "l1"), tr2, te2, "logistic_l1")
    return a.unionByName(b)


@query("model_gaussian_nb", None)
def model_gaussian_nb(spark, sf):
    """14.5 Gaussian naive Bayes (MLlib) with class probabilities."""
    tr, te = _split(spark, sf)
    return _clf_scores(Mo.fit_gaussian_nb(tr, FEATS, "high_net"), tr, te, "gaussian_nb")


@query("model_linear_svc", None)
def model_linear_svc(spark, sf):
    """14.7 linear SVM (C = 1 -> regParam 1/(C n))."""
    tr, te = _split(spark, sf)
    s = Fe.fit_standardize(tr, FEATS)
    tr2, te2 = s.transform(tr), s.transform(te)
    return _clf_scores(Mo.fit_linear_svc(tr2, FEATS, "high_net", 1.0), tr2, te2, "linear_svc")


@query("model_rff_svc", None)
def model_rff_svc(spark, sf):
    """14.8 RBF SVM re-aimed: random Fourier features + linear SVM."""
    tr, te = _split(spark, sf)
    s = Fe.fit_standardize(tr, FEATS)
    tr2, te2 = s.transform(tr), s.transform(te)
    m = Mo.fit_rff_svc(tr2, FEATS, "high_net", gamma=0.25, dims=64, C_=10.0)
    return _clf_scores(m, tr2, te2, "rff_svc")


@query("model_gbt", None)
def model_gbt(spark, sf):
    """14.9 boosted trees classifier (10 rounds)."""
    tr, te = _split(spark, sf)
    return _clf_scores(Mo.fit_gbt(tr, FEATS, "high_net", rounds=10, depth=3), tr, te, "gbt")


@query("model_gbt_regressor", None)
def model_gbt_regressor(spark, sf):
    """14.10 boosted trees regressor with early stopping on a validation slice."""
    tr, te = _split(spark, sf)
    tr = tr.withColumn("is_val", Fe.hash_bucket(["l_orderkey", "l_linenumber"], 7) < 150_000)
    m = Mo.fit_gbt_reg(tr, FEATS, "net", rounds=30, depth=4, validation="is_val")
    return _reg_scores(m, tr.drop("is_val"), te, "gbt_reg")


@query("ols_one_feature", """
select round(regr_slope(l_extendedprice * (1 - l_discount), l_extendedprice), 6) as slope,
  round(regr_intercept(l_extendedprice * (1 - l_discount), l_extendedprice), 4) as intercept,
  round(regr_r2(l_extendedprice * (1 - l_discount), l_extendedprice), 6) as r2
from lineitem
""")
def ols_one_feature(spark, sf):
    """14.11 OLS (normal equations) with one feature: coefficient,
    intercept and R², checked against SQL ``regr_*``."""
    li = _lines(spark, sf)
    m = Mo.fit_ols(li, ["l_extendedprice"], "net")
    lr = m.stages[-1]
    r2 = lr.summary.r2
    return spark.createDataFrame(
        [(round(float(lr.coefficients[0]), 6), round(float(lr.intercept), 4), round(float(r2), 6))],
        "slope double, intercept double, r2 double")


@query("model_ols_lasso_ridge", None)
def model_ols_lasso_ridge(spark, sf):
    """14.11 / 14.12 OLS, Lasso (alpha = 1) and Ridge (alpha = 1) coefficients."""
    li = _lines(spark, sf)
    rows = []
    for name, m in (("ols", Mo.fit_ols(li, FEATS, "net")), ("lasso", Mo.fit_elastic(li, FEATS, "net", 1.0, 1.0)),
                    ("ridge", Mo.fit_elastic(li, FEATS, "net", 1.0, 0.0))):
        lr = m.stages[-1]
        rows += [(name, f, float(c)) for f, c in zip(FEATS, lr.coefficients)] + [(name, "intercept", float(lr.intercept))]
    return spark.createDataFrame(rows, "model string, feature string, coefficient double")


@query("model_rff_huber", None)
def model_rff_huber(spark, sf):
    """14.13 RBF SVR re-aimed: random Fourier features + Huber regression."""
    tr, te = _split(spark, sf)
    s = Fe.fit_standardize(tr, FEATS)
    tr2, te2 = s.transform(tr), s.transform(te)
    m = Mo.fit_rff_huber(tr2, FEATS, "net", gamma=0.25, dims=64)
    return _reg_scores(m, tr2, te2, "rff_huber")


def _cust(spark, sf):
    from quarry.session import cut_lineage

    c = T(spark, sf, "customer")
    o = T(spark, sf, "orders")
    rfm = Fe.rfm(o, "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    d = rfm.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal"), "o_custkey")
    cols = ["recency", "frequency", "monetary", "c_acctbal"]
    # every fit reads the features again: the join runs once
    d = cut_lineage(d.withColumns({k: F.col(k).cast("double") for k in cols}))
    return Fe.fit_standardize(d, cols).transform(d), cols


@query("kmeans_segments", None)
def kmeans_segments(spark, sf):
    """14.14 / 14.16 k-means (k = 4) on standardised RFM features, with
    the cluster share and profile table."""
    d, cols = _cust(spark, sf)
    m = Mo.fit_kmeans(d, cols, 4, seed=1)
    lab = m.transform(d).drop("features")
    return Mo.cluster_profile(lab, "cluster", cols)


@query("kmeans_elbow", None)
def kmeans_elbow(spark, sf):
    """14.15 inertia for k = 2..10 and the knee (flag column)."""
    d, cols = _cust(spark, sf)
    scan, knee = Mo.elbow(d, cols, range(2, 11), seed=1)
    return scan.withColumn("is_knee", F.col("k") == knee)


@query("silhouette_ml", None)
def silhouette_ml(spark, sf):
    """14.20 MLlib silhouette (squared Euclidean, T23) for k = 2..10."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    d, cols = _cust(spark, sf)
    rows = []
    for k in range(2, 11):
        p = Mo.fit_kmeans(d, cols, k, seed=1).transform(d)
        ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", distanceMeasure="squaredEuclidean")
        rows.append((k, float(ev.evaluate(p))))
    return spark.createDataFrame(rows, "k int, silhouette_sq double")


@query("grid_search_tree", None)
def grid_search_tree(spark, sf):
    """14.17 grid search (depth x impurity) by recall of the positive class,
    10-fold CV, ranked table."""
    from pyspark.ml.classification import DecisionTreeClassifier

    tr, _ = _split(spark, sf)
    return Mo.grid_search(tr, FEATS, "high_net", DecisionTreeClassifier(seed=1),
                          {"maxDepth": [2, 4, 6], "impurity": ["gini", "entropy"]}, folds=10, metric="recall")


@query("cross_validate_tree", None)
def cross_validate_tree(spark, sf):
    """14.18 5-fold out-of-fold predictions -> accuracy per fold, mean and std."""
    from pyspark.ml.classification import DecisionTreeClassifier

    li = _lines(spark, sf)
    oof = Mo.cross_validate(li, FEATS, "high_net", lambda: DecisionTreeClassifier(maxDepth=4, seed=1),
                            ["l_orderkey", "l_linenumber"], k=5)
    per = Me.class_metrics(oof.withColumn("prediction", F.col("prediction").cast("int")), "high_net", keys=["fold"])
    return per.agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_samp("accuracy").alias("std_accuracy"),
                   F.count(F.lit(1)).alias("folds"))


@query("importance_and_selection", None)
def importance_and_selection(spark, sf):
    """14.21 importance table from a forest and 13.11 top-2 selection."""
    li = _lines(spark, sf)
    m = Mo.fit_forest(li, FEATS, "high_net", trees=10, max_depth=4)
    imp = Mo.importance(m, FEATS)
    chosen = Fe.select_by_importance(imp, li, 2)
    return imp.withColumn("selected", F.col("feature").isin(chosen.columns))


@query("score_new_data", None)
def score_new_data(spark, sf):
    """14.19 a fitted pipeline scoring new rows (predictions attached)."""
    tr, te = _split(spark, sf)
    m = Mo.fit_tree(tr, FEATS, "high_net", "gini", 4)
    return Mo.score(m, te).select("l_orderkey", "l_linenumber", "high_net", "prediction", "probability")


@query("cluster_profile_segments", """
select c_mktsegment as cluster, count(*) as n, round(count(*) * 1.0 / (select count(*) from customer), 6) as share,
  round(avg(c_acctbal), 4) as c_acctbal_mean, round(quantile_cont(c_acctbal, 0.5), 4) as c_acctbal_median,
  min(c_acctbal) as c_acctbal_min, max(c_acctbal) as c_acctbal_max
from customer group by 1
""")
def cluster_profile_segments(spark, sf):
    """14.16 cluster share and profile given cluster labels (segments)."""
    c = T(spark, sf, "customer").withColumnRenamed("c_mktsegment", "cluster")
    p = Mo.cluster_profile(c, "cluster", ["c_acctbal"])
    return p.select("cluster", "n", F.round("share", 6).alias("share"),
                    *[F.round(x, 4).alias(x) for x in ("c_acctbal_mean", "c_acctbal_median")],
                    "c_acctbal_min", "c_acctbal_max")
