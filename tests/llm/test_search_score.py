"""Decontamination, quality and language-model scores."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_ORACLE
from frames import docs_frame, hostile, split_words
from quarry.llm import lbl_lm, zstd_quality
from quarry.llm.queries import QUERIES
from quarry.llm.suffix_decon import block_of, decontaminate, find_contamination, search, suffix_array

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(s):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in s or ""))


def brute_hits(docs, items, window):
    out = []
    for i, t, *_ in docs:
        w, hit, names = item_words(t), set(), set()
        for name, text in items:
            b = item_words(text)
            n = min(window, len(b))
            grams = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    names.add("" if name is None else str(name))
        out.append((str(i), len(w), len(hit), sorted(names)))
    return sorted(out)


def decon_tables():
    rnd = random.Random(8)
    word = lambda: rnd.choice(["a", "b", "c", "é", "d1"])
    items = [(k, " ".join(word() for _ in range(rnd.choice([0, 2, 5, 6, 9, 12])))) for k in range(14)]
    items += [(None, None), (20, "!!!"), (3, "a b c d e f g"), (21, "Only-Here."), (3, items[3][1])]
    docs = [(k, ", ".join(word().upper() for _ in range(rnd.randint(0, 60))), "s") for k in range(60)]
    docs += [(100 + k, f"zz {items[9][1]} zz {items[11][1]}", "s") for k in range(30)]
    return docs + hostile(), items


def test_contamination(spark):
    docs, items = decon_tables()
    frame, bench = docs_frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_hits(docs, items, 6)
    for block in (1 << 20, 60):  # one block, and many that are searched one after the other
        got = find_contamination(frame, bench, window=6, block_bytes=block).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.items) for r in got) == want
        assert all(sum(s.stop - s.start for s in r.spans) == r.n_hit and r.longest <= r.n_hit for r in got)
    hit = {r.doc_id for r in got if r.n_hit}
    clean = decontaminate(frame, bench, window=6)
    assert clean.columns == frame.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, *_ in docs if i not in hit)


def test_contamination_empty(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = hostile()
    got = find_contamination(docs_frame(spark, rows), none).collect()
    assert len(got) == len(rows) and not any(r.n_hit for r in got)
    one = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert find_contamination(docs_frame(spark, []), one).count() == 0


def test_suffix_array_and_search():
    rnd = np.random.default_rng(1)
    t = np.append(rnd.integers(0, 3, 200), -1)
    sa = suffix_array(t, 12)
    suffixes = [tuple(t[i:i + 12]) for i in sa]
    assert suffixes == sorted(suffixes) and sorted(sa) == list(range(len(t)))
    block = block_of([("x", b"a b c a b a a b c"), ("y", b"b")], 4)
    block.vocab.update({"a": 0})
    lo, hi, got = search(t, sa, block)
    for k in range(len(block.start)):
        want = tuple(block.seq[block.start[k]:block.start[k] + block.need[k]])
        places = {i for i in range(len(t)) if tuple(t[i:i + len(want)]) == want}
        assert set(sa[lo[k]:hi[k]]) == places


def test_quality_held_out(spark):
    got = QUERIES["op9_zstd_quality"](spark, SF_ORACLE).toPandas()
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas()
    assert len(got) == len(docs)
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    m = got[got.held_out].merge(labels, on="doc_id")
    good, bad = m[m.quality == 1], m[m.quality == 0]
    assert (good.predicted == 1).mean() >= 0.97
    assert np.mean([(g > bad.score).mean() for g in good.score]) >= 0.85  # 11 bad texts


def test_quality_cases(spark):
    rows = hostile()
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(200, 260)] + [(None, 1), (4, None), (7, 0), (7, 1)], "doc_id bigint, quality int")
    frame = docs_frame(spark, rows)
    model = zstd_quality.train(frame, labels)
    got = zstd_quality.score_quality(frame, model)
    assert got.count() == len(rows) and got.filter("score is null or isnan(score)").count() == 0
    kept = zstd_quality.keep_good(frame, model)
    assert kept.columns == frame.columns and kept.count() == got.filter("predicted = 1").count()
    one = zstd_quality.train(frame, labels.filter("quality = 1"))
    assert zstd_quality.score_quality(frame, one).filter("score = 1").count() == len(rows)
    assert zstd_quality.score_quality(docs_frame(spark, []), model).count() == 0


def brute_base(rows):
    c = Counter()
    for i, t, *_ in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            c.update(split_words(t) + [b"\n"])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t, *_ in rows:
        w = split_words(t) + [b"\n"]
        out.append((str(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    return sorted(out)


@pytest.mark.parametrize("hot,vocab", [(200_000, 1024), (30, 10), (0, 0)])
def test_base_score(spark, hot, vocab):
    rows = hostile()
    got = lbl_lm.score_documents(docs_frame(spark, rows), hot=hot, vocab=vocab).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute_base(rows)
    if vocab == 0:  # one context symbol for all words: P(other) and P(end) only
        assert all(r.score < 0 for r in got)


def test_scores_without_training_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    got = lbl_lm.score_documents(docs_frame(spark, [(i, "a b", "s") for i in held])).collect()
    assert [r.train_tokens for r in got] == [0] * 5 and all(r.base_score == 0 and r.n_known == 0 for r in got)
    assert lbl_lm.score_documents(docs_frame(spark, [])).count() == 0


def test_model_is_normalised_and_beats_the_unigram():
    rnd = np.random.default_rng(3)
    jump = rnd.dirichlet(np.full(30, 0.1), 30)
    pairs = np.round(jump * 1000)
    table = lbl_lm.train_lbl(pairs, prior=5)
    assert np.allclose((10.0 ** table).sum(axis=1), 1)
    uni = np.log10((pairs.sum(axis=0) + 1) / (pairs.sum() + 30))
    assert (pairs * table).sum() / pairs.sum() > (pairs * uni).sum() / pairs.sum() + 0.2


def test_whole_distribution_is_normalised(spark):
    """Texts of one word w: the P(w) over all training words and one unknown word sum to 1 - P(end | start)."""
    rows = [(k, f"w{k % 40} common w{k % 7}", "s") for k in range(300)]
    probe = sorted({w for _, t, _ in rows for w in t.split()}) + ["never-seen"]
    extra = [i for i in range(10_000, 20_000) if zlib.crc32(str(i).encode()) % 7 == 2][:len(probe) + 1]
    frame = docs_frame(spark, rows + [(i, w, "p") for i, w in zip(extra, [*probe, ""])])
    got = {r.doc_id: r.score for r in lbl_lm.score_documents(frame, hot=20, vocab=8).collect()}
    # P(w | start) P(end | w): sum over w of both is P(second token is the end), below one
    assert sum(10 ** got[i] for i in extra) < 1
    base = {r.doc_id: r.base_score for r in lbl_lm.score_documents(frame, hot=20, vocab=8).collect()}
    assert all(b < 0 for b in base.values())


def test_held_out_score(spark):
    got = QUERIES["op10_lbl_lm"](spark, SF_ORACLE).filter("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_quality_sample_takes_a_repeated_id_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(zstd_quality, "fit", lambda sample, rows=None: seen.append((sample, rows)))
    docs = docs_frame(spark, [(1, f"b{k}", "s") for k in range(300)] + [(1, None, "s"), (3, "good text", "s"), (None, "x", "s")])
    labels = spark.createDataFrame([(1, 0), (1, 0), (3, 1), (9, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    zstd_quality.train(docs, labels, hold_out=10**6)
    sample, rows = seen[0]
    assert sorted(sample) == [(b"", 0), (b"good text", 1)] and rows == (1, 2)
