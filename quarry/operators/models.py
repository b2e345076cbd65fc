"""Models on DataFrames with MLlib (2.14): fit wrappers with the
reference's hyper-parameter conventions translated (T25), scoring,
tuning, cross-validation, importances, clustering scans.

Every fit is a distributed MLlib job (tree/gradient steps are aggregates
over executors); predictions stay DataFrames that the metric operators
in :mod:`quarry.operators.metrics` aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as Rg
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _assembler(cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip")


def _pipe(cols: list[str], est) -> Pipeline:
    return Pipeline(stages=[_assembler(cols), est])


def fit(df: DataFrame, cols: list[str], label: str, est) -> PipelineModel:
    """Assemble ``cols`` and fit ``est`` (label column ``label``)."""
    return _pipe(cols, est.setLabelCol(label) if hasattr(est, "setLabelCol") else est).fit(df)


def fit_tree(df, cols, label, impurity="gini", max_depth=5, seed=42):
    """14.1 decision tree classifier (Spark bins features: maxBins=32)."""
    return fit(df, cols, label, C.DecisionTreeClassifier(impurity=impurity, maxDepth=min(max_depth, 30), seed=seed))


def fit_forest(df, cols, label, trees=100, max_depth=5, impurity="gini", seed=42):
    """14.2 random forest classifier."""
    return fit(df, cols, label, C.RandomForestClassifier(numTrees=trees, maxDepth=max_depth, impurity=impurity, seed=seed))


def fit_forest_reg(df, cols, label, trees=100, max_depth=5, seed=42):
    """14.3 random forest regressor."""
    return fit(df, cols, label, Rg.RandomForestRegressor(numTrees=trees, maxDepth=max_depth, seed=seed))


def fit_logistic(df, cols, label, C_: float = 1.0, penalty: str = "l2", n: int | None = None):
    """14.4 logistic regression; sklearn ``C`` -> ``regParam = 1/(C n)`` with
    ``standardization=False`` (T25); ``penalty`` l1 / l2 / none. A two-class L1 fit
    takes MLlib's steps in fewer passes (:func:`fit_l1_logistic`)."""
    n = n or df.count()
    reg = 0.0 if penalty == "none" else 1.0 / (C_ * n)
    en = 1.0 if penalty == "l1" else 0.0
    model = fit_l1_logistic(df, cols, label, reg) if penalty == "l1" else None
    return model or fit(
        df, cols, label, C.LogisticRegression(regParam=reg, elasticNetParam=en, standardization=False, maxIter=200))


class LogisticModel(Model):
    """Two-class logistic model of the columns ``cols``, with the output columns of MLlib's."""

    def __init__(self, cols: list[str], coefficients: np.ndarray, intercept: float, history: list[float]):
        super().__init__()
        self.cols, self.intercept, self.objective_history = cols, intercept, history
        self.coefficients = DenseVector(coefficients)

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        margin = sum((F.col(c).cast("double") * float(w) for c, w in zip(self.cols, self.coefficients)), F.lit(0.0))
        margin = margin + F.lit(self.intercept)
        p = 1.0 / (1.0 + F.exp(-margin))
        return df.withColumns({"rawPrediction": array_to_vector(F.array(-margin, margin)),
                               "probability": array_to_vector(F.array(1.0 - p, p)),
                               "prediction": (margin > 0).cast("double")})


#: beyond this margin a row's loss is 0 or the margin, to less than a double's rounding of the sum
FLAT = 40.0


def _signed_blocks(df: DataFrame, cols: list[str], label: str, mean: np.ndarray, inv_std: np.ndarray):
    """Training rows as an RDD of raw blocks, one per Arrow batch: the standardised
    columns and a 1, each times +1 (label 1) or -1 (label 0). A batch is 10,000 rows
    unless the session says otherwise."""
    d = len(cols) + 1

    def pack(batches):
        for b in batches:
            a = np.ones((d, b.num_rows))
            for i in range(d - 1):
                a[i] = (b.column(i).to_numpy(zero_copy_only=False) - mean[i]) * inv_std[i]
            a *= np.where(b.column(d - 1).to_numpy(zero_copy_only=False) > 0, 1.0, -1.0)
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary())], ["block"])

    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.select(*cols, label).mapInArrow(pack, "block binary").repartition(tasks).rdd.map(lambda r: bytes(r[0]))


def _logistic_sums(blocks, points: np.ndarray) -> np.ndarray:
    """``(loss, gradient...)`` of the summed logistic loss at each row of ``points``,
    in one pass: a task adds up its blocks, the driver gets one small array per task."""
    d = points.shape[1]

    def sums(part):
        out = np.zeros((len(points), d + 1))
        for raw in part:
            a = np.frombuffer(raw).reshape(d, -1)
            m = points @ a
            q = (m < 0).astype(float)
            out[:, 0] -= np.minimum(m, 0.0).sum(axis=1)
            for k in range(len(points)):
                near = np.flatnonzero(np.abs(m[k]) < FLAT)
                mk = m[k, near]
                e = np.exp(-np.abs(mk))
                out[k, 0] += np.log1p(e).sum()
                q[k, near] = np.where(mk < 0, 1.0, e) / (1.0 + e)
            out[:, 1:] -= q @ a.T
        yield out

    parts = np.stack(blocks.mapPartitions(sums).collect())
    return np.array([[math.fsum(v) for v in row] for row in np.moveaxis(parts, 0, -1)])


class _NoStep(Exception):
    """The search found no step, or the history gives no direction."""


def _lbfgs_direction(steps: list, grads: list, g: np.ndarray) -> np.ndarray:
    """L-BFGS two-loop recursion over the kept steps, newest first."""
    d, a, rho = g.copy(), [], []
    for s, y in zip(steps, grads):
        rho.append(s @ y)
        a.append((s @ d) / rho[-1])
        if np.isnan(a[-1]):
            raise _NoStep
        d -= a[-1] * y
    if steps:
        if not rho[0] >= 0:
            raise _NoStep
        d *= rho[0] / (grads[0] @ grads[0])
    for s, y, ai, r in reversed(list(zip(steps, grads, a, rho))):
        d += (ai - (y @ d) / r) * s
    return -d


def owlqn(loss, x: np.ndarray, l1: np.ndarray, max_iter: int = 200, tol: float = 1e-6, memory: int = 10):
    """Minimise ``loss + sum(l1 |x|)`` by orthant-wise L-BFGS (Andrew & Gao 2007);
    returns the point and the objective after every step.

    Takes the steps of MLlib's optimiser: the same line search (which judges its first
    trial by the slope there and the value before), the same stopping rules (against
    the largest of the last 20 values). ``loss`` maps rows of points to rows of ``(value,
    gradient...)``, so the trials that a search is likely to make, those from 1 to
    half the last step, cost one pass and not one each."""

    def adjusted(w, row):
        v, g = row[0], row[1:]
        at_zero = np.where(g - l1 > 0, g - l1, np.where(g + l1 < 0, g + l1, 0.0))
        return v, g, v + np.abs(l1 * w).sum(), np.where(l1 == 0, g, np.where(w == 0, at_zero, g + np.sign(w) * l1))

    v, g, fx, pg = adjusted(x, loss(x[None])[0])
    history, recent, steps, grads, last, failed = [fx], [math.inf], [], [], 1.0, False
    with np.errstate(all="ignore"):
        for it in range(max_iter + 1):
            done = it == max_iter or (len(recent) > 1 and abs(fx - max(recent)) <= tol * history[0])
            if done or np.linalg.norm(pg) <= max(tol * fx, 1e-8):
                break
            while True:
                try:
                    d = _lbfgs_direction(steps, grads, pg)
                    d = np.where(d * pg < 0, d, 0.0)
                    found = _line_search(loss, adjusted, x, v, g, fx, pg, d, len(history) == 1, last)
                    break
                except _NoStep:
                    if failed:
                        return x, history
                    failed, steps, grads = True, [], []
            last, new, (v, new_g, fx, pg) = found
            steps, grads = [new - x, *steps][:memory], [new_g - g, *grads][:memory]
            x, g, failed = new, new_g, False
            history.append(fx)
            recent = [*recent, fx][-20:]
    return x, history


def _line_search(loss, adjusted, x, v, g, fx, pg, d, first: bool, last: float):
    orthant = np.where(x != 0, np.sign(x), np.sign(-pg))
    shrink, alpha = (0.1, 0.5 / np.linalg.norm(g)) if first else (0.5, 1.0)
    known: dict[float, tuple] = {}

    def evaluate(alphas: list[float]) -> None:
        points = [x + a * d for a in alphas]
        points = [np.where(np.sign(p) == orthant, p, 0.0) for p in points]
        for a, p, row in zip(alphas, points, loss(np.stack(points))):
            known[a] = (p, adjusted(p, row))

    likely = [alpha]
    while not first and likely[-1] >= last and len(likely) < 8:
        likely.append(likely[-1] * shrink)
    evaluate(likely)
    slope = pg @ d
    value = v
    for turn in range(20):
        p, at = known[alpha]
        at_slope = at[3] @ d
        if value > fx + alpha * slope * 1e-4:
            factor = shrink
        elif at_slope < 0.9 * slope:
            factor = 2.1
        elif at_slope > -0.9 * slope:
            factor = shrink
        else:
            return alpha, p, at
        if turn == 19:  # where no step fits, as at a kink of the hinge loss, the last trial counts
            return alpha, p, at
        alpha *= factor
        if not 1e-10 <= alpha <= 1e10:
            break
        if alpha not in known:
            evaluate([alpha, alpha * shrink])
        value = known[alpha][1][2]
    raise _NoStep


def fit_l1_logistic(df: DataFrame, cols: list[str], label: str, reg: float) -> PipelineModel | None:
    """Two-class logistic regression with the L1 penalty ``reg`` on the features as they are;
    None if the labels are not 0 and 1, both present.

    MLlib runs one job for each trial of its line search. Here the rows are
    standardised and packed once, and one pass gives the loss and gradient at
    several trials (:func:`owlqn`); steps and stopping are MLlib's."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("double").alias(label))
    valid = F.lit(True)
    for c in cols:  # what the assembler skips
        valid = valid & F.col(c).isNotNull() & ~F.isnan(c)
    rows = rows.filter(valid)
    st = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"),
                  F.count_if(F.col(label) == 0).alias("neg"),
                  F.array(*[F.avg(c) for c in cols]).alias("mean"), F.array(*[F.stddev_samp(c) for c in cols]).alias("std")).first()
    n = st["n"]
    if not (st["pos"] and st["neg"] and st["pos"] + st["neg"] == n):
        return None
    mean, std = np.array(st["mean"], float), np.array(st["std"], float)
    inv = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    blocks = _signed_blocks(rows, cols, label, mean, inv).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        start = np.append(np.zeros(len(cols)), math.log(st["pos"] / st["neg"]))
        w, history = owlqn(lambda points: _logistic_sums(blocks, points) / n, start, np.append(reg * inv, 0.0))
    finally:
        blocks.unpersist()
    coef = w[:-1] * inv
    return PipelineModel([_assembler(cols), LogisticModel(cols, coef, float(w[-1] - coef @ mean), [float(h) for h in history])])


def fit_gaussian_nb(df, cols, label):
    """14.5 Gaussian naive Bayes (MLlib ``modelType='gaussian'``)."""
    return fit(df, cols, label, C.NaiveBayes(modelType="gaussian"))


def gaussian_nb_sql_form(df: DataFrame, label: str, cols: list[str], id_col: str, var_smoothing: float = 1e-9) -> DataFrame:
    """14.5 Gaussian NB as aggregates + one projection: class priors, means
    and population variances (+ ``var_smoothing`` x largest feature
    variance, the sklearn rule) come from one grouped aggregate (one row
    per class, collected); each row's class log-likelihoods are literal
    expressions and the prediction is their argmax (ties -> smaller
    class), with its posterior probability. No join of rows with classes."""
    n = df.count()
    eps = var_smoothing * max(df.agg(*[F.var_pop(c).alias(c) for c in cols]).first())
    stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"),
                                  *[F.avg(c).alias(f"{c}__mu") for c in cols],
                                  *[F.var_pop(c).alias(f"{c}__var") for c in cols]).orderBy(label).collect()
    best, every = None, []
    for i, r in enumerate(stats):
        lp = F.lit(math.log(r["__n"] / n))
        for c in cols:
            v = r[f"{c}__var"] + eps
            lp = lp - 0.5 * math.log(2 * math.pi * v) - F.pow(F.col(c) - F.lit(r[f"{c}__mu"]), 2) / (2 * v)
        every.append(lp)
        s = F.struct(lp.alias("lp"), F.lit(-i).alias("tie"), F.lit(r[label]).alias("cls"))
        best = s if best is None else F.greatest(best, s)
    posterior = 1 / sum((F.exp(lp - best["lp"]) for lp in every[1:]), F.exp(every[0] - best["lp"]))
    return df.select(id_col, best["cls"].alias("prediction"), posterior.alias("probability"))


def fit_linear_svc(df, cols, label, C_: float = 1.0, n: int | None = None, max_iter: int = 100):
    """14.7 linear SVM; ``C`` -> ``regParam = 1/(C n)`` (T25)."""
    n = n or df.count()
    return fit(df, cols, label, C.LinearSVC(regParam=1.0 / (C_ * n), standardization=False, maxIter=max_iter))


#: rows whose features are worked on at once: 64 features of them stay in a core's cache
STRIP = 512


def _rff_weights(n_cols: int, gamma: float, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * gamma), size=(dims, n_cols)), rng.uniform(0.0, 2 * math.pi, size=dims)


def _cos_turns(u: np.ndarray) -> np.ndarray:
    """cos(2 pi u) to 1e-14; ``u`` is overwritten. Numpy's own cosine of doubles takes
    three times as long: here an eighth of the angle goes through its series, and is doubled three times."""
    out = np.rint(u)
    u -= out
    u *= u
    series = [(-1) ** k * (math.pi / 4) ** (2 * k) / math.factorial(2 * k) for k in range(7)]
    np.multiply(u, series[6], out=out)
    for c in series[5:0:-1]:
        out += c
        out *= u
    out += 1.0
    for _ in range(3):
        out *= out
        out *= 2.0
        out -= 1.0
    return out


def _fourier(x: np.ndarray, W: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of random features of the columns ``x``."""
    u = x.T @ (W.T / (2 * math.pi))
    u += b / (2 * math.pi)
    z = _cos_turns(u)
    z *= math.sqrt(2.0 / len(b))
    return z


def _columns(xs, cols: list[str]) -> np.ndarray:
    if any(x.null_count for x in xs):
        raise ValueError(f"null in a feature column of {cols}")
    return np.stack([x.to_numpy(zero_copy_only=False) for x in xs])


def rff_vector(cols: list[str], gamma: float, dims: int, seed: int = 42) -> Column:
    """Random Fourier features for an RBF kernel exp(-gamma |x - y|^2)
    (Rahimi & Recht 2007): z_i(x) = sqrt(2/D) cos(w_i . x + b_i),
    w ~ N(0, 2 gamma I), b ~ U(0, 2 pi), as ONE vector column.

    The D x d weights go to an Arrow function that maps whole batches with numpy:
    a higher-order SQL expression is interpreted, element by element, and took
    most of a fit's time. A null input is an error, as in any MLlib vector."""
    W, b = _rff_weights(len(cols), gamma, dims, seed)

    @F.arrow_udf(VectorUDT())
    def features(*xs: pa.Array) -> pa.Array:
        a = _columns(xs, cols)
        n = a.shape[1]
        z = np.empty((n, dims))
        for i in range(0, n, STRIP):
            z[i:i + STRIP] = _fourier(a[:, i:i + STRIP], W, b)
        # a column of dense vectors, as VectorUDT stores them
        values = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dims, z.ravel())
        return pa.StructArray.from_arrays(
            [np.ones(n, np.int8), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), values],
            ["type", "size", "indices", "values"])

    return features(*[F.col(c).cast("double") for c in cols])


class RFFModel:
    """Random-feature map + a linear model fitted on it, with the output columns of MLlib's
    linear SVM (``classifies``) or linear regression. A prediction comes straight from
    the columns; the feature vectors are made only where they are read."""

    def __init__(self, cols: list[str], vec: Column, W: np.ndarray, b: np.ndarray, coefficients: np.ndarray, intercept: float,
                 history: list[float], classifies: bool, scale: float = 1.0):
        self.cols, self.vec, self.W, self.b = cols, vec, W, b
        self.coefficients, self.intercept, self.scale = DenseVector(coefficients), intercept, scale
        self.objective_history, self.classifies = history, classifies

    def _margin(self) -> Column:
        cols, W, b, w, intercept = self.cols, self.W, self.b, self.coefficients.toArray(), self.intercept

        @F.arrow_udf("double")
        def margin(*xs: pa.Array) -> pa.Array:
            a = _columns(xs, cols)
            strips = [_fourier(a[:, i:i + STRIP], W, b) @ w for i in range(0, a.shape[1], STRIP)]
            return pa.array(np.concatenate([np.zeros(0), *strips]) + intercept)

        return margin(*[F.col(c).cast("double") for c in cols])

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        out = df.withColumns({"features": self.vec, "prediction": self._margin()})
        if not self.classifies:
            return out
        m = F.col("prediction")
        out = out.withColumn("rawPrediction", array_to_vector(F.array(-m, m)))
        # NaN is the largest number in SQL, MLlib calls it no positive margin
        return out.withColumn("prediction", F.when((m > 0) & ~F.isnan(m), 1.0).otherwise(0.0))


def _rff_blocks(df: DataFrame, cols: list[str], label: str, classes: bool):
    """Training rows as an RDD of raw blocks, one per Arrow batch: the columns and the label, not
    their features, which are many times as wide. What MLlib's fits refuse is an error."""

    def pack(batches):
        for batch in batches:
            x, y = _columns(batch.columns[:-1], cols), batch.column(len(cols))
            y = np.where(y.is_null().to_numpy(zero_copy_only=False), np.nan, y.to_numpy(zero_copy_only=False).astype(float))
            if not np.isfinite(x).all():
                raise ValueError(f"NaN or infinity in a feature column of {cols}")
            if not (np.isin(y, (0.0, 1.0)) if classes else np.isfinite(y)).all():
                raise ValueError(f"labels in {label} must be " + ("0 or 1" if classes else "finite"))
            yield pa.RecordBatch.from_arrays([pa.array([np.vstack([x, y]).tobytes()], pa.binary())], ["block"])

    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"))
    return rows.mapInArrow(pack, "block binary").repartition(tasks).rdd.map(lambda r: bytes(r[0]))


def _rff_strips(part, W: np.ndarray, b: np.ndarray):
    """(features, labels) of the rows of some blocks, some rows at a time."""
    d = W.shape[1]
    for raw in part:
        a = np.frombuffer(raw).reshape(d + 1, -1)
        for i in range(0, a.shape[1], STRIP):
            yield _fourier(a[:d, i:i + STRIP], W, b), a[d, i:i + STRIP]


def _rff_moments(blocks, W: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, and mean and sample standard deviation of every feature."""

    def moments(part):
        n, mean, m2 = 0, np.zeros(len(b)), np.zeros(len(b))
        for z, _ in _rff_strips(part, W, b):
            k, own = len(z), z.mean(axis=0)
            delta = own - mean
            m2 += ((z - own) ** 2).sum(axis=0) + delta**2 * (n * k / (n + k))
            mean += delta * (k / (n + k))
            n += k
        if n:
            yield n, mean, m2

    n, mean, m2 = 0, np.zeros(len(b)), np.zeros(len(b))
    for k, own, more in blocks.mapPartitions(moments).collect():
        delta = own - mean
        m2 += more + delta**2 * (n * k / (n + k))
        mean += delta * (k / (n + k))
        n += k
    if not n:
        raise ValueError("a fit needs rows")
    std = np.sqrt(m2 / max(1, n - 1))
    # a constant feature differs by rounding only
    return n, mean, np.where(std > 1e-13, std, 0.0)


def hinge(y: np.ndarray, m: np.ndarray, points: np.ndarray):
    """Loss of labels 0 / 1 and its slope by the margin."""
    sign = 2.0 * y - 1.0
    loss = 1.0 - sign * m
    on = loss > 0
    return np.where(on, loss, 0.0), np.where(on, -sign, 0.0), np.zeros_like(m)


def huber(y: np.ndarray, m: np.ndarray, points: np.ndarray, epsilon: float = 1.35):
    """Huber's loss with the scale sigma (Owen 2007), the last value of a point; its slopes by the margin and by sigma."""
    sigma, r = points[:, -1], y - m
    near, t = np.abs(r) <= sigma * epsilon, r / sigma
    loss = 0.5 * np.where(near, sigma + r * t, sigma + 2.0 * epsilon * np.abs(r) - sigma * epsilon**2)
    return loss, np.where(near, -t, np.where(r >= 0, -epsilon, epsilon)), 0.5 * (1.0 - np.where(near, t * t, epsilon**2))


def _rff_loss(blocks, W: np.ndarray, b: np.ndarray, n: int, mean: np.ndarray, inv: np.ndarray, terms, l2: np.ndarray):
    """Rows of points to rows of ``(value, gradient...)``: the mean loss over all rows plus
    ``sum(l2 w^2) / 2``, in one pass that maps the rows again and keeps no features. A point holds
    coefficients of the standardised features, the intercept and, with Huber's loss, sigma; a task
    adds up its blocks, the driver gets one small array per task."""
    dims = len(b)

    def loss(points: np.ndarray) -> np.ndarray:
        coef = points[:, :dims] * inv
        offset = points[:, dims] - coef @ mean

        def sums(part):
            out = np.zeros((len(points), dims + 3))
            for z, y in _rff_strips(part, W, b):
                value, slope, more = terms(y[:, None], z @ coef.T + offset, points)
                out[:, :3] += np.stack([value.sum(axis=0), slope.sum(axis=0), more.sum(axis=0)], axis=1)
                out[:, 3:] += slope.T @ z
            yield out

        parts = np.stack(blocks.mapPartitions(sums).collect())
        total = np.array([[math.fsum(v) for v in row] for row in np.moveaxis(parts, 0, -1)]) / n
        w = points[:, :dims]
        grad = (total[:, 3:] - total[:, [1]] * mean) * inv + l2 * w
        value = total[:, [0]] + 0.5 * (l2 * w * w).sum(axis=1, keepdims=True)
        return np.hstack([value, grad, total[:, [1]], total[:, [2]]])[:, :points.shape[1] + 1]

    return loss


def _bounded_direction(x: np.ndarray, g: np.ndarray, lower: np.ndarray, steps: list, grads: list, first: bool) -> np.ndarray:
    """L-BFGS-B (Byrd et al. 1995): the generalised Cauchy point, then the free
    values to the model's minimum. ``steps`` and ``grads``: oldest first."""
    n, theta, W, M = len(x), 1.0, np.zeros((len(x), 0)), np.zeros((0, 0))
    if steps:
        S, Y = np.stack(steps, axis=1), np.stack(grads, axis=1)
        theta = (Y[:, -1] @ Y[:, -1]) / (Y[:, -1] @ S[:, -1])
        A = S.T @ Y
        L, D = np.tril(A, -1), np.diag(np.diag(A))
        W = np.hstack([Y, theta * S])
        try:
            M = np.linalg.inv(np.block([[-D, L.T], [L, theta * S.T @ S]]))
        except np.linalg.LinAlgError:
            raise _NoStep from None
    ends = np.full(n, math.inf)
    np.divide(x - lower, g, out=ends, where=g > 0)
    d = np.where(ends == 0, 0.0, -g)
    at, p, c = x.copy(), W.T @ d, np.zeros(W.shape[1])
    f1, done = g @ d, 0.0
    f2 = -theta * f1 - p @ M @ p
    more = -f1 / f2
    for i in np.argsort(ends, kind="stable"):
        if ends[i] == 0:
            continue
        gone = ends[i] - done
        if not gone <= more:
            break
        at[i] = lower[i]
        c += gone * p
        f1 += gone * f2 + g[i] ** 2 + theta * g[i] * (at[i] - x[i]) - g[i] * (W[i] @ M @ c)
        f2 += -theta * g[i] ** 2 - 2.0 * g[i] * (W[i] @ M @ p) - g[i] ** 2 * (W[i] @ M @ W[i])
        p += g[i] * W[i]
        d[i], more, done = 0.0, -f1 / f2, ends[i]
    more = max(more, 0.0)
    at = np.maximum(np.where(d != 0, x + (done + more) * d, at), lower)
    if not first:
        c += more * p
        free = np.flatnonzero(at > lower)
        r = (g + theta * (at - x) - W @ (M @ c))[free]
        B = theta * np.eye(len(free)) - W[free] @ M @ W[free].T
        try:
            u = -np.linalg.solve(B, r)
        except np.linalg.LinAlgError:
            raise _NoStep from None
        room = np.full(len(free), math.inf)
        np.divide(lower[free] - at[free], u, out=room, where=u < 0)
        at[free] += min(1.0, room.min(initial=math.inf)) * u
        at = np.maximum(at, lower)
    if not np.isfinite(at).all():
        raise _NoStep
    return at - x


def _wolfe(phi, value: float, slope: float, bound: float, rounds: int = 64) -> float:
    """Step by the strong Wolfe conditions (Nocedal & Wright, 3.5 and 3.6): extend by 1.5, then zoom by cubics."""
    if not slope <= 0:
        raise _NoStep

    def cubic(a, z):
        d1 = a[2] + z[2] - 3 * (a[1] - z[1]) / (a[0] - z[0])
        d2 = np.sqrt(d1 * d1 - a[2] * z[2])
        t = z[0] - (z[0] - a[0]) * (z[2] + d2 - d1) / (z[2] - a[2] + 2 * d2)
        if np.isnan(t):
            raise _NoStep
        return min(max(t, a[0] + 0.1 * (z[0] - a[0])), a[0] + 0.9 * (z[0] - a[0]))

    def zoom(low, high):
        for _ in range(rounds):
            t = cubic(*sorted([low, high]))
            at = (t, *phi(t))
            if at[1] > value + 1e-4 * t * slope or at[1] >= low[1]:
                high = at
            else:
                if abs(at[2]) <= 0.9 * abs(slope):
                    return t
                if at[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = at
        raise _NoStep

    low, t = (0.0, value, slope), 1.0
    for i in range(rounds):
        at = (t, *phi(t))
        if not np.isfinite(at[1]):
            t /= 2.0
            continue
        if at[1] > value + 1e-4 * t * slope or (at[1] >= low[1] and i):
            return zoom(low, at)
        if abs(at[2]) <= 0.9 * abs(slope):
            return t
        if at[2] >= 0:
            return zoom(at, low)
        low = at
        if t == bound:
            return t
        t = min(1.5 * t, bound)
    raise _NoStep


def lbfgsb(loss, x: np.ndarray, lower: np.ndarray, max_iter: int = 100, tol: float = 1e-6, memory: int = 10):
    """Minimise ``loss`` over ``x >= lower`` by L-BFGS-B; returns the point and the objective after every step.

    Takes the steps of MLlib's optimiser: its line search and its stopping rules. ``loss`` maps rows
    of points to rows of ``(value, gradient...)``."""
    row = loss(x[None])[0]
    v, g = row[0], row[1:]
    history, recent, steps, grads, failed = [v], [math.inf], [], [], False
    with np.errstate(all="ignore"):
        for it in range(max_iter + 1):
            done = it == max_iter or (len(recent) > 1 and abs(v - max(recent)) <= tol * history[0])
            if done or np.linalg.norm(g) <= max(tol * v, 1e-8) or np.abs(np.maximum(x - g, lower) - x).max() < 1e-5:
                break
            while True:
                try:
                    d = _bounded_direction(x, g, lower, steps, grads, it == 0)
                    known: dict[float, tuple] = {}

                    def phi(t, x=x, d=d, known=known):
                        p = np.maximum(x + t * d, lower)
                        known[t] = (p, loss(p[None])[0])
                        return known[t][1][0], known[t][1][1:] @ d

                    bound = np.full(len(x), math.inf)
                    np.divide(lower - x, d, out=bound, where=d < 0)
                    new, row = known[_wolfe(phi, v, g @ d, max(1.0, bound.min()))]
                    break
                except _NoStep:
                    if failed:
                        return x, history
                    failed, steps, grads = True, [], []
            steps, grads = [*steps, new - x][-memory:], [*grads, row[1:] - g][-memory:]
            x, v, g, failed = new, row[0], row[1:], False
            history.append(v)
            recent = [*recent, v][-20:]
    return x, history


def _fit_rff(df, cols, label, gamma, dims, seed, classes: bool, minimise) -> RFFModel:
    """Pack the rows once; ``minimise(n, loss, std, inv, mean)`` takes the steps, each a pass
    over the packed columns that maps them to features again."""
    W, b = _rff_weights(len(cols), gamma, dims, seed)
    blocks = _rff_blocks(df, cols, label, classes).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, mean, std = _rff_moments(blocks, W, b)
        inv = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
        terms = hinge if classes else huber
        w, history = minimise(n, lambda l2: _rff_loss(blocks, W, b, n, mean, inv, terms, l2), mean * inv, inv)
    finally:
        blocks.unpersist()
    coef = w[:dims] * inv
    return RFFModel(cols, rff_vector(cols, gamma, dims, seed), W, b, coef, float(w[dims] - coef @ mean),
                    [float(h) for h in history], classes, 1.0 if classes else float(w[-1]))


def fit_rff_svc(df, cols, label, gamma: float = 0.1, dims: int = 100, C_: float = 1.0, seed: int = 42,
                max_iter: int = 50):
    """14.8 RBF SVM re-aimed: random Fourier features + linear SVM
    (``C`` -> ``regParam = 1/(C n)``, on the features as they are).

    MLlib's ``LinearSVC`` keeps the features of all rows, ``dims`` doubles a row, in memory and on disk.
    Here the rows are packed as they are and mapped again in each pass; steps and stopping are MLlib's."""

    def minimise(n, loss, centre, inv):
        zero = np.zeros(dims + 1)
        return owlqn(loss(inv**2 / (C_ * n)), zero, zero, max_iter)

    return _fit_rff(df, cols, label, gamma, dims, seed, True, minimise)


def fit_rff_huber(df, cols, label, gamma: float = 0.1, dims: int = 100, reg: float = 0.0, seed: int = 42,
                  max_iter: int = 50):
    """14.13 RBF SVR re-aimed: random Fourier features + Huber regression (``reg`` on the
    standardised features), mapped again in each pass as in :func:`fit_rff_svc`."""

    def minimise(n, loss, centre, inv):
        start = np.ones(dims + 2)
        start[dims] += centre.sum()
        lower = np.append(np.full(dims + 1, -math.inf), np.finfo(float).tiny)
        return lbfgsb(loss(np.full(dims, reg)), start, lower, max_iter)

    return _fit_rff(df, cols, label, gamma, dims, seed, False, minimise)


def fit_gbt(df, cols, label, rounds: int = 20, depth: int = 3, seed: int = 42):
    """14.9 boosted trees classifier."""
    return fit(df, cols, label, C.GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed))


def fit_gbt_reg(df, cols, label, rounds: int = 100, depth: int = 3, validation: str | None = None,
                step: float = 0.1, seed: int = 42):
    """14.10 boosted trees regressor; ``validation`` names a boolean column
    marking validation rows for early stopping."""
    est = Rg.GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)
    if validation:
        est = est.setValidationIndicatorCol(validation)
    return fit(df, cols, label, est)


def fit_ols(df, cols, label):
    """14.11 ordinary least squares (normal equations)."""
    return fit(df, cols, label, Rg.LinearRegression(solver="normal", regParam=0.0))


def fit_elastic(df, cols, label, alpha: float, l1_ratio: float):
    """14.12 Lasso (l1_ratio=1) / Ridge (l1_ratio=0) with sklearn's alpha
    (T25): Lasso ``regParam = alpha``; Ridge ``regParam = alpha sigma_y / n``
    (population std of y, normal solver); ``standardization=False``."""
    if l1_ratio == 0:
        st = df.agg(F.stddev_pop(label).alias("s"), F.count(label).alias("n")).first()
        reg = alpha * st["s"] / st["n"]
        est = Rg.LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False, solver="normal")
    else:
        est = Rg.LinearRegression(regParam=alpha, elasticNetParam=l1_ratio, standardization=False, maxIter=500)
    return fit(df, cols, label, est)


def fit_kmeans(df, cols, k: int, seed: int = 42):
    """14.14 k-means (k-means|| init)."""
    return _pipe(cols, K.KMeans(k=k, seed=seed, predictionCol="cluster")).fit(df)


def elbow(df, cols, k_range=range(2, 11), seed: int = 42) -> tuple[DataFrame, int]:
    """14.15 inertia for each k and the knee: the k whose (normalised)
    point lies farthest from the chord joining the first and last points."""
    feats = _assembler(cols).transform(df).select("features").persist()
    rows = []
    try:
        for k in k_range:
            m = K.KMeans(k=k, seed=seed).fit(feats)
            rows.append((k, float(m.summary.trainingCost)))
    finally:
        feats.unpersist()
    ks = np.array([r[0] for r in rows], float)
    cs = np.array([r[1] for r in rows], float)
    xn = (ks - ks[0]) / max(ks[-1] - ks[0], 1e-12)
    yn = (cs - cs.min()) / max(cs.max() - cs.min(), 1e-12)
    p1, p2 = np.array([xn[0], yn[0]]), np.array([xn[-1], yn[-1]])
    d = np.abs(np.cross(p2 - p1, np.stack([xn, yn], 1) - p1)) / max(np.linalg.norm(p2 - p1), 1e-12)
    knee = int(ks[int(np.argmax(d))])
    spark = df.sparkSession
    return spark.createDataFrame(rows, "k int, inertia double"), knee


def cluster_profile(df: DataFrame, cluster: str, cols: list[str]) -> DataFrame:
    """14.16 per cluster: share of rows and mean/median/min/max of cols."""
    from quarry.operators.aggregate import group_matrix

    m = group_matrix(df, cluster, cols)
    total = df.select(F.count(F.lit(1))).scalar()
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(m, cluster).withColumn("share", F.col("n") / total)


def score(model, df: DataFrame) -> DataFrame:
    """14.19 attach predictions (vector columns dropped)."""
    out = model.transform(df)
    drop = [c for c in ("features", "rawPrediction") if c in out.columns]
    if "probability" in out.columns:
        from pyspark.ml.functions import vector_to_array

        out = out.withColumn("probability", vector_to_array("probability"))
    return out.drop(*drop)


def importance(model, names: list[str]) -> DataFrame:
    """14.21 feature importance table (feature, importance) desc."""
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(stage, "featureImportances"):
        vals = stage.featureImportances.toArray()
    elif hasattr(stage, "coefficients"):
        vals = np.abs(stage.coefficients.toArray())
    else:
        raise ValueError("model has no importances")
    rows = sorted(zip(names, map(float, vals)), key=lambda t: (-t[1], t[0]))
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double")


POSITIVE_METRICS = {"recall": "recallByLabel", "precision": "precisionByLabel", "f1": "fMeasureByLabel"}


#: a decision tree is searched on counted cells from so many rows on
CELL_ROWS = 1_000_000


def tree_cells(df: DataFrame, cols: list[str], label: str, folds: int, seed: int, bins: int) -> DataFrame:
    """``(features, label, __fold, __n)``: the rows of ``df`` counted per fold, label and bin of
    every feature. A decision tree bins its features first and then sees nothing
    else of a row, so it learns the same from a cell with its count as from the rows;
    there are at most ``bins`` ** features * folds * labels cells, however many rows.

    Bins end at the quantiles of all rows (relative error 1 / (32 bins) of a bin);
    folds are drawn as ``CrossValidator`` draws them."""
    from pyspark.ml.feature import Bucketizer

    from quarry.session import cut_lineage

    x = {c: F.col(c).cast("double") for c in cols}
    whole = df.select(*[e.alias(c) for c, e in x.items()], F.col(label)).withColumn("__r", F.rand(seed))
    for c in cols:  # what the assembler skips
        whole = whole.filter(F.col(c).isNotNull() & ~F.isnan(c))
    probs = [i / bins for i in range(1, bins)]
    cuts = whole.agg(*[F.percentile_approx(c, probs, 32 * bins * bins).alias(c) for c in cols]).first()
    inf = float("inf")
    splits = [[-inf, *sorted({v for v in (cuts[c] or [0.0]) if abs(v) < inf}), inf] for c in cols]
    binned = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"__b{i}" for i in range(len(cols))]).transform(whole)
    fold = F.least(F.floor(F.col("__r") * folds), F.lit(folds - 1)).cast("int")
    b = [f"__b{i}" for i in range(len(cols))]
    # bins are ordered: without the discretizer's note that they are categories
    binned = binned.select(*[F.col(c).alias(c, metadata={}) for c in b], label, "__r")
    cells = binned.groupBy(*b, label, fold.alias("__fold")).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    return cut_lineage(_assembler(b).transform(cells).select("features", label, "__fold", "__n"))


def grid_search(df: DataFrame, cols: list[str], label: str, est, grid: dict, folds: int = 5,
                metric: str = "accuracy", seed: int = 42, parallelism: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """14.17 grid search with K-fold CV; returns one row per parameter
    combination with mean and std score and its rank (6.3). ``recall``,
    ``precision``, ``f1`` and ``roc_auc`` are those of the positive class (label
    1); other names are the multiclass or regression evaluator's own.

    A decision tree classifier on ``cell_rows`` rows or more is fitted and evaluated on
    weighted cells (:func:`tree_cells`), so the search reads the table three times
    and not once per level, combination and fold."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(est.getParam(p), list(vals))
    maps = b.build()
    if metric in ("rmse", "mae", "r2", "mse"):
        ev = RegressionEvaluator(labelCol=label, metricName=metric)
    elif metric in POSITIVE_METRICS:
        ev = MulticlassClassificationEvaluator(labelCol=label, metricName=POSITIVE_METRICS[metric], metricLabel=1.0)
    elif metric == "roc_auc":
        ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    else:
        ev = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    est = est.setLabelCol(label)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, seed=seed, parallelism=parallelism)
    # limits on rows per node and bins per combination need the rows themselves
    as_cells = isinstance(est, C.DecisionTreeClassifier) and not est.isDefined("weightCol") and est.getMinInstancesPerNode() == 1 and not {
        "maxBins", "minInstancesPerNode", "weightCol"} & set(grid)
    if as_cells and df.count() >= cell_rows:
        feats = tree_cells(df, cols, label, folds, seed, est.getMaxBins())
        cv = cv.setEstimator(est.copy().setWeightCol("__n")).setEvaluator(ev.setWeightCol("__n")).setFoldCol("__fold")
    else:
        feats = _assembler(cols).transform(df)
    m = cv.fit(feats)
    rows = []
    for pm, mu, sd in zip(maps, m.avgMetrics, m.stdMetrics):
        rows.append((", ".join(f"{k.name}={v}" for k, v in sorted(pm.items(), key=lambda t: t[0].name)), float(mu), float(sd)))
    spark = df.sparkSession
    res = spark.createDataFrame(rows, "params string, mean_score double, std_score double")
    from quarry.operators.ranking import rank_results

    if not ev.isLargerBetter():
        res = res.withColumn("mean_score", -F.col("mean_score"))
        return rank_results(res, "mean_score").withColumn("mean_score", -F.col("mean_score"))
    return rank_results(res, "mean_score")


def cross_validate(df: DataFrame, cols: list[str], label: str, make_est, key: str, k: int = 5,
                   repeats: int = 1, seed: int = 42) -> DataFrame:
    """14.18 K-fold (optionally repeated) cross-validation: out-of-fold
    predictions for every row, as one DataFrame ``(key, repeat, fold,
    label, prediction)``; score them with the metric operators grouped by
    (repeat, fold) for mean +- std."""
    from quarry.operators.features import assign_folds

    f = assign_folds(df, key, k, repeats, seed)
    if "repeat" not in f.columns:
        f = f.withColumn("repeat", F.lit(0))
    outs = []
    for r in range(repeats):
        fr = f.filter(F.col("repeat") == r)
        for i in range(k):
            model = fit(fr.filter(F.col("fold") != i), cols, label, make_est())
            pred = model.transform(fr.filter(F.col("fold") == i))
            keys = [key] if isinstance(key, str) else list(key)
            outs.append(pred.select(*keys, "repeat", "fold", label, F.col("prediction")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out
