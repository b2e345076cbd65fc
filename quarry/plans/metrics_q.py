"""Prediction metric analyses (14.5, 14.6, 14.20, 14.22-14.30, 5.21).

Classifier labels / predictions (SURVEY 7.2): label = labels.quality,
prediction = a rule on documents.n_chars, score = n_chars.
"""

from pyspark.sql import functions as F

from quarry.operators import metrics as Me
from quarry.operators import neighbors as Nb
from quarry.operators.aggregate import value_counts
from quarry.plans.features_q import md5b
from quarry.plans.registry import T, query

_PRED_SQL = """
select l.doc_id, l.quality as label, case when d.n_chars >= 1500 then 1 else 0 end as prediction,
  d.n_chars as score, d.lang, d.source
from labels l join documents d on l.doc_id = d.doc_id
"""


def predictions(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    lab = T(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return lab.join(d, "doc_id").select(
        "doc_id", "label", F.when(F.col("n_chars") >= 1500, 1).otherwise(0).alias("prediction"),
        F.col("n_chars").alias("score"), "lang", "source")


def r6(c):
    return F.round(F.col(c), 6)


@query("confusion_matrix", f"""
with p as ({_PRED_SQL}) select label, prediction, count(*) as n from p group by 1, 2
""")
def confusion_matrix(spark, sf):
    """14.22 confusion matrix (long)."""
    return Me.confusion(predictions(spark, sf))


@query("prediction_counts", f"""
with p as ({_PRED_SQL}) select prediction, count(*) as count from p group by 1
""")
def prediction_counts(spark, sf):
    """5.21 histogram of predicted classes."""
    return value_counts(predictions(spark, sf), "prediction")


@query("binary_metrics", f"""
with p as ({_PRED_SQL}), c as (
  select count(*) filter (where label = 1 and prediction = 1) as tp, count(*) filter (where label = 0 and prediction = 1) as fp,
         count(*) filter (where label = 1 and prediction = 0) as fn, count(*) filter (where label = 0 and prediction = 0) as tn
  from p)
select tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1,
  round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) as auc_hard
from c
""")
def binary_metrics(spark, sf):
    """14.23 accuracy, precision, recall, F1 and hard-label AUC (T19)."""
    m = Me.class_metrics(predictions(spark, sf))
    return m.withColumns({c: r6(c) for c in ("accuracy", "precision", "recall", "f1", "auc_hard")})


@query("class_report", f"""
with p as ({_PRED_SQL}),
cls as (select cast(label as varchar) as c from p union select cast(prediction as varchar) from p),
per as (
  select cls.c as class,
    count(*) filter (where cast(p.label as varchar) = cls.c) as support,
    count(*) filter (where cast(p.prediction as varchar) = cls.c) as predicted,
    count(*) filter (where cast(p.label as varchar) = cls.c and p.label = p.prediction) as tp
  from cls, p group by 1
), m as (
  select class, coalesce(tp / nullif(predicted, 0), 0) as precision, coalesce(tp / nullif(support, 0), 0) as recall,
    support, tp from per
), f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1 from m)
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from f
union all
select 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  sum(support)::bigint from f
union all
select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from f
union all
select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from f
""")
def class_report(spark, sf):
    """14.24 per-class report with accuracy, macro and weighted averages."""
    r = Me.class_report(predictions(spark, sf))
    return r.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query("roc_points", f"""
with p as ({_PRED_SQL}),
s as (select score as threshold, sum(label) as pos, sum(1 - label) as neg from p group by 1),
c as (select threshold, sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp from s)
select threshold, tp::bigint as tp, fp::bigint as fp, round(tp / (select sum(label) from p), 6) as tpr,
  round(fp / (select sum(1 - label) from p), 6) as fpr from c
""")
def roc_points(spark, sf):
    """14.25 ROC points per distinct score (cumulative counts without a
    single-task window)."""
    r = Me.roc_curve(predictions(spark, sf), "label", "score")
    return r.withColumns({"tpr": r6("tpr"), "fpr": r6("fpr")})


@query("regression_metrics", """
with p as (select l_extendedprice as y, l_quantity * 2000.0 as yhat from lineitem)
select round(avg(abs(y - yhat)), 4) as mae, round(avg((y - yhat) * (y - yhat)), 2) as mse,
  round(sqrt(avg((y - yhat) * (y - yhat))), 4) as rmse,
  round(avg(abs((y - yhat) / y)) filter (where y <> 0) * 100, 4) as mape,
  round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)), 6) as r2
from p
""")
def regression_metrics(spark, sf):
    """14.26 MAE, MSE, RMSE, MAPE, R² in one pass (price predicted as
    2000 x quantity)."""
    li = T(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000.0).alias("yhat"))
    m = Me.reg_metrics(li, "y", "yhat")
    return m.select(F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"),
                    F.round("mape", 4).alias("mape"), r6("r2").alias("r2"))


@query("model_comparison", f"""
with p as ({_PRED_SQL}), t as (
  select label, prediction, 'len1500' as model, case when {md5b('doc_id')} < 80 then 'train' else 'test' end as split from p
  union all
  select label, case when score >= 800 then 1 else 0 end, 'len800', case when {md5b('doc_id')} < 80 then 'train' else 'test' end from p
), c as (
  select model, split, count(*) filter (where label = 1 and prediction = 1) as tp,
    count(*) filter (where label = 0 and prediction = 1) as fp, count(*) filter (where label = 1 and prediction = 0) as fn,
    count(*) filter (where label = 0 and prediction = 0) as tn from t group by 1, 2)
select model, split, tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1,
  round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) as auc_hard
from c
""")
def model_comparison(spark, sf):
    """14.27 models x splits comparison table."""
    from quarry.operators.features import md5_bucket

    p = predictions(spark, sf).withColumn("split", F.when(md5_bucket("doc_id") < 80, "train").otherwise("test"))
    a = p.select("label", "prediction", F.lit("len1500").alias("model"), "split")
    b = p.select("label", F.when(F.col("score") >= 800, 1).otherwise(0).alias("prediction"), F.lit("len800").alias("model"), "split")
    m = Me.compare_models(a.unionByName(b))
    return m.withColumns({c: r6(c) for c in ("accuracy", "precision", "recall", "f1", "auc_hard")})


_EV_PRED_SQL = """
with m as (select event_type, avg(value) as mu from events group by 1)
select e.ts, e.value, m.mu as pred from events e join m using (event_type)
"""


def _event_predictions(spark, sf):
    e = T(spark, sf, "events")
    mu = e.groupBy("event_type").agg(F.avg("value").alias("pred"))
    return e.join(mu, "event_type").select("ts", "value", "pred")


@query("worst_days", f"""
with p as ({_EV_PRED_SQL})
select cast(cast(ts as date) as timestamp) as date, round(avg(abs(value - pred)), 6) as error,
  round(avg(value), 6) as actual, round(avg(pred), 6) as prediction
from p group by 1 order by error desc, date limit 10
""")
def worst_days(spark, sf):
    """14.28 the ten days with the largest mean absolute error."""
    w = Me.worst_days(_event_predictions(spark, sf), "ts", "value", "pred", 10)
    return w.select(F.col("date").cast("timestamp_ntz").alias("date"), r6("error").alias("error"),
                    r6("actual").alias("actual"), r6("prediction").alias("prediction"))


@query("daily_prediction_total", f"""
with p as ({_EV_PRED_SQL})
select cast(cast(ts as date) as timestamp) as date, round(sum(pred), 4) as total from p group by 1
""")
def daily_prediction_total(spark, sf):
    """14.30 predictions rolled up per day."""
    d = Me.daily_total(_event_predictions(spark, sf), "ts", "pred")
    return d.select(F.col("date").cast("timestamp_ntz").alias("date"), F.round("total", 4).alias("total"))


@query("actual_vs_predicted", f"""
with p as ({_PRED_SQL}) select doc_id, label as actual, prediction from p
""")
def actual_vs_predicted(spark, sf):
    """14.29 actual vs predicted table."""
    p = predictions(spark, sf)
    return Me.actual_vs_predicted(p, "label", "prediction", keep=["doc_id"])


@query("knn_embeddings", f"""
with e as (select vec_id, embedding::DOUBLE[] as x, label, {md5b('vec_id')} < 80 as is_train from embeddings),
d as (
  select q.vec_id as q, t.vec_id as r, t.label, list_distance(q.x, t.x) as dist
  from e q join e t on not q.is_train and t.is_train
), nn as (select *, row_number() over (partition by q order by dist, r) as rk from d),
v as (select q, label, count(*) as votes from nn where rk <= 5 group by 1, 2)
select q as vec_id, arg_min(label, (-votes, label)) as prediction, max(votes) / 5.0 as probability from v group by 1
""")
def knn_embeddings(spark, sf):
    """14.6 k-nearest-neighbour classification (k = 5, exact Euclidean,
    blocked broadcast scoring; train/test by md5 bucket)."""
    from quarry.operators.features import split

    e = T(spark, sf, "embeddings")
    tr, te = split(e, "vec_id", 0.8, method="md5")
    return Nb.knn_predict(tr, te, 5, "embedding", "label", "vec_id", "vec_id")


@query("silhouette_embeddings", """
with e as (select vec_id, embedding::DOUBLE[] as x, label from embeddings),
d as (select a.vec_id as q, a.label as qc, b.label as c, list_distance(a.x, b.x) as dist
      from e a join e b on a.vec_id <> b.vec_id),
m as (select q, qc, c, avg(dist) as md from d group by 1, 2, 3),
s as (select q, max(md) filter (where c = qc) as a, min(md) filter (where c <> qc) as b from m group by 1)
select round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from s
""")
def silhouette_embeddings(spark, sf):
    """14.20 exact Euclidean silhouette of the given clustering (T23)."""
    s = Nb.silhouette_exact(T(spark, sf, "embeddings"), "label", "embedding", "vec_id")
    return s.agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query("silhouette_by_label", """
with e as (select vec_id, embedding::DOUBLE[] as x, label from embeddings),
d as (select a.vec_id as q, a.label as qc, b.label as c, list_distance(a.x, b.x) as dist
      from e a join e b on a.vec_id <> b.vec_id),
m as (select q, qc, c, avg(dist) as md from d group by 1, 2, 3),
s as (select q, qc, max(md) filter (where c = qc) as a, min(md) filter (where c <> qc) as b from m group by 1, 2)
select qc as label, count(*) as n, round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette
from s group by 1
""")
def silhouette_by_label(spark, sf):
    """14.20 exact Euclidean silhouette per cluster."""
    s = Nb.silhouette_exact(T(spark, sf, "embeddings"), "label", "embedding", "vec_id")
    return Nb.silhouette_by_cluster(s, "label").withColumn("silhouette", F.round("silhouette", 6))


@query("gaussian_nb_sql", f"""
with p as ({_PRED_SQL}),
pri as (select label, count(*) * 1.0 / (select count(*) from p) as prior, avg(score) as mu,
        var_pop(score) + 1e-9 * (select var_pop(score) from p) as var from p group by 1),
ll as (select p.doc_id, pri.label, ln(pri.prior) - 0.5 * ln(2 * pi() * pri.var) - (p.score - pri.mu) ^ 2 / (2 * pri.var) as lp
       from p, pri)
select doc_id, arg_max(label, lp) as prediction, round(1 / sum(exp(lp - top)), 6) as probability
from (select *, max(lp) over (partition by doc_id) as top from ll) group by 1
""")
def gaussian_nb_sql(spark, sf):
    """14.5 Gaussian naive Bayes in SQL form (priors, per-class mean and
    population variance + sklearn's 1e-9 x max variance smoothing),
    one feature: score; class = argmax log-likelihood."""
    from quarry.operators.models import gaussian_nb_sql_form

    p = predictions(spark, sf)
    return gaussian_nb_sql_form(p, "label", ["score"], "doc_id").withColumn("probability", F.round("probability", 6))
