"""Log-bilinear language model scores (operator 10).

The model predicts a token from the one before: score(w | c) = q_w . r_c + b_w
over the ``VOCAB`` most frequent words, an end symbol and one symbol for all
other words, which follow a smoothed unigram. It is trained in numpy with
noise-contrastive estimation against unigram noise. The training data are
the bigram counts of the whole training part, so every occurrence counts
and the loss is taken in full, as products of matrices, in every step. One
more product and a log-sum-exp give the normalised log-probabilities of all
bigrams; scoring looks them up for whole batches.

Word counts cover the whole training part as a distributed table. The
``HOT`` most frequent words (at most ``HOT_WORD_BYTES`` bytes each) are broadcast;
documents meet the counts of all other words in a shuffle join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch

VOCAB = 1024
HOT = 200_000
HOT_WORD_BYTES = 64
DIM = 32
NOISE = 8
STEPS = 120
#: tokens of unigram text added to every context, against overfitting
PRIOR = 100.0
#: the end of a document; no word holds a line break
END = b"\n"
#: distinct words a task holds before it passes their counts on
FLUSH = 60_000
#: rare words of the scored documents a task holds before it passes them on
TAIL_FLUSH = 20_000


def words(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z only, at space and 0x09-0x0D only


def in_training(id_col: Column, n: int, rest: int) -> Column:
    """crc32 of the id as text modulo ``n`` is not ``rest``; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % n != rest


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for t in batch.column(batch.num_columns - 1):
        yield (t.as_py() or "").encode()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "c"])

    held: Counter = Counter()
    for batch in batches:
        for t in _texts(batch):
            held.update(words(t))
            held[END] += 1
            if len(held) >= FLUSH:
                yield rows(held)
                held = Counter()
    if held:
        yield rows(held)


@dataclass
class Lexicon:
    """The hot words; the first ``vocab`` of them are the model's, followed by
    the end symbol and the symbol for all other words."""

    index: dict[bytes, int]
    vocab: int
    count: np.ndarray  # per hot word
    end_count: int

    @property
    def end(self) -> int:
        return self.vocab

    @property
    def other(self) -> int:
        return self.vocab + 1


def _symbols(ids: np.ndarray, lex: Lexicon) -> np.ndarray:
    """Hot indices (-1: none) to model symbols, with the end symbol after them."""
    return np.append(np.where((ids >= 0) & (ids < lex.vocab), ids, lex.other), lex.end)


def _ids(ws: list[bytes], lex: Lexicon) -> np.ndarray:
    get = lex.index.get
    return np.array([get(w, -1) for w in ws], dtype=np.int64)


def _count_pairs(batches: Iterator[pa.RecordBatch], lex: Lexicon) -> Iterator[pa.RecordBatch]:
    n = lex.vocab + 2
    total = np.zeros(n * n, dtype=np.int64)
    held, size = [], 0
    for batch in batches:
        for t in _texts(batch):
            s = _symbols(_ids(words(t), lex), lex)
            held.append(np.append(lex.end, s[:-1]) * n + s)
            size += len(s)
            if size >= 1 << 20:
                total += np.bincount(np.concatenate(held), minlength=n * n)
                held, size = [], 0
    if held:
        total += np.bincount(np.concatenate(held), minlength=n * n)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at // n, pa.int32()), pa.array(at % n, pa.int32()), pa.array(total[at], pa.int64())],
                                     names=["a", "b", "c"])


def train_lbl(pairs: np.ndarray, dim: int = DIM, noise: int = NOISE, steps: int = STEPS, prior: float = PRIOR,
              seed: int = 7) -> np.ndarray:
    """Normalised log10 P(b | a) as a matrix, from the matrix of bigram counts.

    Noise-contrastive estimation with ``noise`` noise tokens per token: the
    expected loss over all observed pairs (with ``prior`` tokens of unigram text
    per context) and the unigram noise, minimised with Adam on context vectors
    r, word vectors q and word biases b.
    """
    n = len(pairs)
    rng = np.random.default_rng(seed)
    total = max(1.0, float(pairs.sum()))
    uni = (pairs.sum(axis=0) + 1.0) / (total + n)
    data = (pairs + prior * uni) / (total + prior * n)
    ctx = data.sum(axis=1, keepdims=True)
    log_noise = np.log(noise * uni)
    params = [rng.normal(0, 0.1, (n, dim)), rng.normal(0, 0.1, (n, dim)), np.log(uni)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        r, q, b = params
        real = 1 / (1 + np.exp(-np.clip(r @ q.T + b - log_noise, -30, 30)))  # that the pair is data, not noise
        g = ctx * (noise * uni) * real - data * (1 - real)
        for k, grad in enumerate((g @ q, g.T @ r, g.sum(axis=0))):
            first[k] += 0.1 * (grad - first[k])
            second[k] += 0.001 * (grad * grad - second[k])
            params[k] -= 0.05 * (1 - t / (steps + 1)) * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-12)
    r, q, b = params
    s = r @ q.T + b
    top = s.max(axis=1, keepdims=True)
    return (s - top - np.log(np.exp(s - top).sum(axis=1, keepdims=True))) / np.log(10)


@dataclass
class Model:
    lex: Lexicon
    table: np.ndarray
    tokens: int
    distinct: int
    other_tokens: int
    other_distinct: int


def fit(docs: DataFrame, counts: DataFrame, train_filter: Column, vocab: int, hot: int) -> Model:
    """``docs`` has columns id and t, ``counts`` word and c."""
    spark = docs.sparkSession
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    end = counts.filter(F.col("word") == F.lit(END)).select("c").first()
    top = counts.filter((F.col("word") != F.lit(END)) & (F.octet_length("word") <= HOT_WORD_BYTES)).orderBy(F.desc("c"), "word").limit(hot).toArrow()
    lex = Lexicon({w: i for i, w in enumerate(top.column("word").to_pylist())}, min(vocab, len(top)),
                  top.column("c").to_numpy().astype(np.int64), end["c"] if end else 0)
    sent = spark.sparkContext.broadcast(lex)
    found = docs.filter(train_filter).select("t").mapInArrow(lambda it: _count_pairs(it, sent.value), "a int, b int, c bigint")
    pairs = np.zeros((lex.vocab + 2, lex.vocab + 2))
    got = found.groupBy("a", "b").agg(F.sum("c").alias("c")).toArrow()  # (VOCAB + 2)^2 rows at most
    pairs[got.column("a").to_numpy(), got.column("b").to_numpy()] = got.column("c").to_numpy()
    sent.destroy()  # the model brings its own; a worker must not hold both
    known = int(lex.count[:lex.vocab].sum()) + lex.end_count
    return Model(lex, train_lbl(pairs), tokens, distinct, tokens - known, distinct - lex.vocab - (end is not None))


def _score(batches: Iterator[pa.RecordBatch], m: Model) -> Iterator[pa.RecordBatch]:
    lex = m.lex
    log_c = np.log10(np.append(lex.count, 0.0) + 1)  # the last entry serves index -1: its words are joined later
    end_log = float(np.log10(lex.end_count + 1))
    tail_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    names = ["id", "n_tokens", "n_other", "n_known", "lm", "base_log", "other_log", "tail"]
    types = [None, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), tail_type]

    def flush(batch, begin, rows):
        cols = [batch.column(0).slice(begin, len(rows))]
        cols += [pa.array([r[k] for r in rows], types[k + 1]) for k in range(len(types) - 1)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    for batch in batches:
        rows, size, begin = [], 0, 0
        for d, t in enumerate(_texts(batch)):
            ws = words(t)
            ids = _ids(ws, lex)
            s = _symbols(ids, lex)
            lm = float(m.table[np.append(lex.end, s[:-1]), s].sum())
            logs = log_c[ids] if len(ids) else np.zeros(0)
            other = (ids < 0) | (ids >= lex.vocab)
            tail = Counter(ws[i] for i in np.flatnonzero(ids < 0))
            rows.append((len(ws) + 1, int(other.sum()), int((ids >= 0).sum()) + (lex.end_count > 0), lm, float(logs.sum()) + end_log,
                         float(logs[other].sum()), [{"word": w, "n": n} for w, n in tail.items()]))
            size += len(tail)
            if size >= TAIL_FLUSH:
                yield flush(batch, begin, rows)
                rows, size, begin = [], 0, d + 1
        if rows:
            yield flush(batch, begin, rows)


def score_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", split: int = 7, held_rest: int = 2,
                    vocab: int = VOCAB, hot: int = HOT) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A-Z lower-cased, and one end per text; null text is
    empty and has the end only. ``base_score`` is the add-one unigram score of
    the training part, ``score`` the model's; both are log10 and normalised over
    the training words and one unknown word. Repeated rows and repeated or null ids are
    rows of their own. Without training rows every token is unknown.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    train = in_training(F.col("id"), split, held_rest)
    seen = src.filter(train).select("t").mapInArrow(_count_words, "word binary, c bigint")
    counts = scratch.keep(seen.groupBy("word").agg(F.sum("c").alias("c")), "counts")
    model = fit(src, counts, train, vocab, hot)
    sent = spark.sparkContext.broadcast(model)
    kind = src.schema["id"].dataType.simpleString()
    part = src.mapInArrow(lambda it: _score(it, sent.value),
                          f"id {kind}, n_tokens bigint, n_other bigint, n_known bigint, lm double, base_log double, other_log double, "
                          "tail array<struct<word:binary,n:bigint>>")
    part = scratch.keep(part.withColumn("rid", F.monotonically_increasing_id()), "scored")
    tail = part.select("rid", F.explode("tail").alias("x")).select("rid", "x.word", "x.n").join(counts, "word")
    tail = tail.groupBy("rid").agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_log"))
    out = part.drop("tail").join(tail, "rid", "left").na.fill(0, ["tail_known", "tail_log"])
    per_token = float(np.log10(model.tokens + model.distinct + 1))
    per_other = float(np.log10(model.other_tokens + model.other_distinct + 1))
    return out.select(
        F.col("id").alias(id_col), (~train).alias("held_out"), "n_tokens", (F.col("n_known") + F.col("tail_known")).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_log") + F.col("tail_log") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        (F.col("lm") + F.col("other_log") + F.col("tail_log") - F.col("n_other") * F.lit(per_other)).alias("score"))
