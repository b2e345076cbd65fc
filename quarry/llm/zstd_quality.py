"""Quality classifier by compression with zstandard dictionaries (operator 9).

One dictionary is built from good and one from bad labelled texts. A text is
compressed whole with either and without one; the difference of the two
sizes, normalised by the plain size, and the plain rates are calibrated to a
probability by logistic regression, each labelled text with dictionaries that
do not hold it.

Fitting reads a bounded sample of labelled rows (``sample_rows`` per class,
texts up to ``sample_bytes`` bytes each); scoring is one pass without a
shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 3000
SAMPLE_BYTES = 1 << 16
DICT_BYTES = 1 << 20
LEVEL = 3
FOLDS = 4


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # the last one is the intercept
    constant: float | None = None  # the score where the labels had one class only


class Sizer:
    """Compressed sizes of a text: plain, with the good, with the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.by = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False))

    def features(self, text: bytes) -> list[float]:
        n, p = len(text) + 1, len(self.plain.compress(text))
        g, b = (len(c.compress(text)) for c in self.by)
        d = (b - g) / p
        return [d, b / g - 1, p / n, g / n, b / n, math.log(n), d * math.log(n)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 100) -> np.ndarray:
    """Damped Newton steps on standardised features with an intercept; the
    ridge keeps weights finite where the classes separate."""
    z = np.hstack([x, np.ones((len(x), 1))])
    pen = np.full(z.shape[1], ridge)
    pen[-1] = 1e-6

    def loss(w):
        m = z @ w
        return float(np.logaddexp(0, m).sum() - y @ m + 0.5 * (pen * w * w).sum())

    w = np.zeros(z.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        grad = z.T @ (y - p) - pen * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pen), grad)
        rate = 1.0
        while rate > 1e-6 and loss(w + rate * step) > now:
            rate /= 2
        before, w = now, w + rate * step
        now = min(before, loss(w))
        if before - now < 1e-9 * (1 + before):
            break
    return w


def build_dictionary(texts: list[bytes], size: int) -> bytes:
    """Whole texts in the given order up to ``size`` bytes; zstandard finds what
    stands last most cheaply, so the first texts go last."""
    held, total = [], 0
    for t in texts:
        if total + len(t) > size:
            continue
        held.append(t)
        total += len(t)
    return b"\n".join(reversed(held))


def fit(sample: list[tuple[bytes, int]], dict_bytes: int = DICT_BYTES, rows: tuple[int, int] | None = None) -> Model:
    """From labelled texts in a seeded order. The features for the calibration
    are cross-fitted: a text is compressed with dictionaries from the other
    folds. ``rows`` are all labelled rows of class 0 and 1, whose odds the score
    takes over."""
    classes = {y: [t for t, l in sample if l == y] for y in (0, 1)}
    if not classes[0] or not classes[1]:
        return Model(b"", b"", np.zeros(0), np.ones(0), np.zeros(0), constant=1.0 if not classes[0] else 0.0)
    xs, ys = [], []
    for k in range(FOLDS):
        others = {y: [t for n, t in enumerate(texts) if n % FOLDS != k] for y, texts in classes.items()}
        sizer = Sizer(build_dictionary(others[1], dict_bytes), build_dictionary(others[0], dict_bytes))
        for y, texts in classes.items():
            xs += [sizer.features(t) for t in texts[k::FOLDS]]
            ys += [y] * len(texts[k::FOLDS])
    x, y = np.array(xs), np.array(ys, dtype=float)
    dicts = {c: build_dictionary(texts, dict_bytes) for c, texts in classes.items()}
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = fit_logistic((x - mean) / scale, y)
    if rows:
        w[-1] += math.log(rows[1] / rows[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return Model(dicts[1], dicts[0], mean, scale, w)


def _scores(texts: pa.Array, model: Model, sizer: Sizer | None) -> pa.Array:
    if sizer is None:
        return pa.array(np.full(len(texts), model.constant), pa.float64())
    x = np.array([sizer.features((t.as_py() or "").encode()) for t in texts]).reshape(len(texts), -1)
    z = ((x - model.mean) / model.scale) @ model.weight[:-1] + model.weight[-1]
    return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())


def _with_scores(batches: Iterator[pa.RecordBatch], model: Model, at: int, drop: bool) -> Iterator[pa.RecordBatch]:
    """The batches with a last column for the score of column ``at``, which goes
    if ``drop``."""
    sizer = None if model.constant is not None else Sizer(model.good, model.bad)
    for batch in batches:
        cols = [c for k, c in enumerate(batch.columns) if k != at or not drop]
        names = [f"c{k}" for k in range(len(cols))]
        yield pa.RecordBatch.from_arrays([*cols, _scores(batch.column(at), model, sizer)], names=[*names, "score"])


def bucket(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.encode(F.coalesce(c.cast("string"), F.lit("")), "UTF-8")) % n


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
          hold_out: int = 5, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model of label 1 against 0, from labelled rows outside the held-out
    part (crc32 of the id modulo ``hold_out`` is 0). Null labels, labels without
    a document and ids labelled both ways are left out; of documents that share an
    id the smallest text counts."""
    one = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).filter("i is not null and y in (0, 1)")
    one = one.filter(bucket("i", hold_out) != 0).groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").drop("z")
    one = one.withColumn("u", F.xxhash64(F.lit(9), "i"))
    count = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):
        part = one.filter(F.col("y") == y).orderBy("u", "i").limit(sample_rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter(
        F.octet_length(F.coalesce("t", F.lit(""))) <= sample_bytes)
    # a repeated id counts once, so at most 2 * sample_rows texts come
    got = texts.join(F.broadcast(picked), "i").groupBy("u", "i", "y").agg(F.min(F.coalesce("t", F.lit(""))).alias("t")).collect()
    got.sort(key=lambda r: (r["u"], r["i"], r["t"]))
    return fit([(r["t"].encode(), r["y"]) for r in got], rows=(count[0], count[1]) if len(count) == 2 else None)


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id", hold_out: int = 5,
                  threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, held_out, score, predicted. Null text counts
    as empty; empty texts get a score too. The score depends on the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("c0"), F.col(text_col).cast("string").alias("t"))
    out = src.mapInArrow(lambda it: _with_scores(it, sent.value, 1, True), f"c0 {src.schema['c0'].dataType.simpleString()}, score double")
    return out.select(F.col("c0").alias(id_col), (bucket("c0", hold_out) == 0).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``threshold`` or
    more; one pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    src = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields)
    out = src.mapInArrow(lambda it: _with_scores(it, sent.value, at, False), f"{kinds}, score double")
    return out.filter(F.col("score") >= threshold).drop("score").toDF(*docs.columns)
