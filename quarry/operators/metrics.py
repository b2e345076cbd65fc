"""Prediction metrics as aggregates over a predictions DataFrame (2.14,
ops 14.22-14.30). Every metric table is one aggregate pass over
``(label, prediction[, score])`` rows; predictions never leave Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", keys=None) -> DataFrame:
    """Long confusion matrix ``(keys..., label, prediction, n)`` (op 14.22)."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    return df.groupBy(*keys, label, pred).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", positive=1, keys=None) -> DataFrame:
    """Binary accuracy, precision, recall, F1 and the hard-label AUC
    ``(TPR + TNR) / 2`` (T19), one pass (op 14.23). Undefined ratios
    (0/0) are 0, like sklearn's ``zero_division=0``."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    y, p = F.col(label) == F.lit(positive), F.col(pred) == F.lit(positive)
    g = df.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    prec, rec = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return g.select(*keys, "tp", "fp", "fn", "tn",
                    ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    ((rec + ratio(tn, tn + fp)) / 2).alias("auc_hard"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support plus ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows (sklearn report, op 14.24).
    Classes are the union of labels and predictions."""
    y, p = F.col(label).cast("string"), F.col(pred).cast("string")
    # one row per (class, role): support counts labels, predicted counts predictions
    stats = df.select(F.explode(F.array(
        F.struct(y.alias("cls"), F.lit(1).alias("is_lab"), F.lit(0).alias("is_pred"), (y == p).cast("int").alias("hit")),
        F.struct(p.alias("cls"), F.lit(0).alias("is_lab"), F.lit(1).alias("is_pred"), F.lit(0).alias("hit")),
    )).alias("s")).select("s.*")
    per = stats.groupBy("cls").agg(F.sum("is_lab").alias("support"), F.sum("is_pred").alias("predicted"),
                                   F.sum("hit").alias("tp"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    prec, rec = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    per = per.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                     F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"),
                     F.col("support").cast("long").alias("support"), F.col("tp"))
    n = F.sum("support")
    summary = per.agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("w_r"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("w_f"),
        (F.sum("tp") / n).alias("acc"), n.cast("long").alias("n"))
    extra = summary.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("acc").alias("precision"), F.col("acc").alias("recall"),
                 F.col("acc").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("m_p").alias("precision"), F.col("m_r").alias("recall"),
                 F.col("m_f").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("w_p").alias("precision"), F.col("w_r").alias("recall"),
                 F.col("w_f").alias("f1"), F.col("n").alias("support")),
    )).alias("s")).select("s.*")
    return per.drop("tp").unionByName(extra)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """ROC points, one per distinct score (descending): threshold, tp, fp,
    tpr, fpr (op 14.25). Scores are first collapsed per value with partial
    aggregation; the cumulative counts use the range-partitioned running
    sum, so no single task sees every score."""
    from quarry.operators.ranking import running_sums

    y = (F.col(label) == F.lit(positive)).cast("long")
    per = df.groupBy(F.col(score).alias("threshold")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    cum = running_sums(per, [F.col("threshold").desc()], ["pos", "neg"])
    P = df.select(F.sum(y)).scalar()
    N = df.select(F.sum(1 - y)).scalar()
    return cum.select("threshold", F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                      F.try_divide(F.col("pos_cum"), P).alias("tpr"), F.try_divide(F.col("neg_cum"), N).alias("fpr"))


def auc_from_scores(df: DataFrame, label: str = "label", score: str = "score") -> float:
    """Score-based ROC AUC (``BinaryClassificationEvaluator``)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                         metricName="areaUnderROC").evaluate(df.select(F.col(score).cast("double"), F.col(label).cast("double")))


def reg_metrics(df: DataFrame, actual: str = "label", pred: str = "prediction", keys=None) -> DataFrame:
    """MAE, MSE, RMSE, MAPE (%, rows with actual 0 skipped), R² =
    1 - SSE/SST, one pass (op 14.26)."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    e = y - p
    g = df.groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        (F.avg(F.when(y != 0, F.abs(e / y))) * 100.0).alias("mape"),
        F.sum(e * e).alias("__sse"), (F.var_pop(y) * F.count(y)).alias("__sst"))
    return g.select(*keys, "mae", "mse", F.sqrt("mse").alias("rmse"), "mape",
                    (1 - F.try_divide(F.col("__sse"), F.col("__sst"))).alias("r2"))


def compare_models(predictions: DataFrame, label: str = "label", pred: str = "prediction",
                   model: str = "model", split: str = "split") -> DataFrame:
    """Model x split comparison table of class metrics (op 14.27)."""
    return class_metrics(predictions, label, pred, keys=[model, split]).orderBy(model, split)


def worst_days(df: DataFrame, ts: str, actual: str, pred: str, n: int = 10) -> DataFrame:
    """Dates with the largest mean absolute error (op 14.28)."""
    d = F.to_date(F.col(ts)).alias("date")
    g = df.groupBy(d).agg(F.avg(F.abs(F.col(actual) - F.col(pred))).alias("error"),
                          F.avg(actual).alias("actual"), F.avg(pred).alias("prediction"))
    return g.orderBy(F.col("error").desc(), "date").limit(n)


def actual_vs_predicted(df: DataFrame, actual: str, pred: str, keep: list[str] | None = None) -> DataFrame:
    return df.select(*(keep or []), F.col(actual).alias("actual"), F.col(pred).alias("prediction"))


def daily_total(df: DataFrame, ts: str, pred: str, name: str = "total") -> DataFrame:
    """Predictions summed per calendar day (op 14.30)."""
    return df.groupBy(F.to_date(F.col(ts)).alias("date")).agg(F.sum(pred).alias(name))
