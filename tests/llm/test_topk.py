"""Exact top-k search against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import block_topk
from quarry.llm.block_topk import next_blocks, top_inner_products

SCHEMA = "vec_id bigint, embedding array<float>, rid string, id string, vec string, dim string, block string, asks string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA)


def brute(rows, every, k):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(ok) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def vectors(seed, n=400, dim=6):
    rnd = random.Random(seed)
    near = lambda c: [x + rnd.uniform(-0.05, 0.05) for x in c]
    centres = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(8)]
    rows = [(k, near(rnd.choice(centres))) for k in range(n)]
    rows += [(1000 + k, centres[0]) for k in range(150)]  # one vector many times: ties across blocks
    rows += [(20, rows[20][1]), (20, rows[20][1]), (40, [0.0] * dim), (-20, centres[1])]
    rows += [(None, centres[0]), (2000, None), (2020, [None] * dim), (2040, [math.nan] * dim), (2060, [math.inf] + [0.0] * (dim - 1))]
    rows += [(2080, []), (2100, [0.5]), (2120, [0.25] * (dim + 2)), (2140, [-0.0] * dim)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,first", [(256, 4), (9, 1)])
def test_all_scores(spark, block, first, monkeypatch):
    monkeypatch.setattr(block_topk, "FIRST", first)
    monkeypatch.setattr(block_topk, "BOUNDS", 7)
    monkeypatch.setattr(block_topk, "QUERIES", 5)
    rows = vectors(1)
    got = rows_of(top_inner_products(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5, block=block))
    assert got == brute(rows, 20, 5) and len(got) > 100


def test_few_rows(spark):
    rows = [(0, [1.0, -1.0]), (20, [0.5, 0.5]), (1, [-1.0, 0.0])]
    assert rows_of(top_inner_products(frame(spark, rows), F.col("vec_id") % 20 == 0)) == brute(rows, 20, 5)
    assert rows_of(top_inner_products(frame(spark, rows[:1]), F.col("vec_id") % 20 == 0)) == []
    assert rows_of(top_inner_products(frame(spark, []), F.col("vec_id") % 20 == 0)) == []
    assert rows_of(top_inner_products(frame(spark, rows), F.lit(False))) == []


def test_blocks_in_order_of_bounds_until_the_kth_score():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (40, 8, 4))
    low, high, blocks, first = x.min(axis=1), x.max(axis=1), np.arange(100, 140), np.arange(40)
    q = rng.integers(-50, 50, (3, 4))
    start = np.array([[-(2**62), 2**63 - 1, 2**63 - 1, -(2**62)]] * 3)
    rows, cols, bound = next_blocks(q, start, blocks, first, low, high, 40)
    for a in range(3):
        mine = bound[rows == a]
        assert len(mine) == 40 and (np.diff(mine) <= 0).all()
        best = (x @ q[a]).max(axis=1)
        assert (mine >= best[cols[rows == a]]).all()
    # beyond a cursor, and down to a k-th score: just the blocks between
    some = start.copy()
    some[:, 0], some[:, 2], some[:, 3] = bound[rows == 0][20], bound[rows == 0][4], blocks[cols[rows == 0][4]]
    r2, c2, b2 = next_blocks(q[:1], some[:1], blocks, first, low, high, 40)
    assert list(c2) == list(cols[rows == 0][5:21])


def test_no_copies_meet_in_the_driver(spark, capsys):
    """Copies along the grid, and whole matrices, are joined without a broadcast."""
    from quarry.operators.blocks import grid_join

    left = spark.createDataFrame([(k, "x" * 100) for k in range(20)], "a int, p string")
    right = spark.createDataFrame([(k, "y" * 100) for k in range(20)], "b int, r string")
    pairs = grid_join(left, right, "a", "b", 5, 5)
    assert sorted((x.a, x.b) for x in pairs.collect()) == [(a, b) for a in range(20) for b in range(20)]
    pairs.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_full_chunks_with_many_shuffle_partitions(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(block_topk, "grid_shape", lambda *n: seen.append(n) or (1, 1))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = [r for r in vectors(2) if r[1] is None or len(r[1]) == 6]
        got = rows_of(top_inner_products(frame(spark, rows), F.col("vec_id") % 20 == 0, block=9))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert got == brute(rows, 20, 5)
    assert seen == [(1, 1)]  # 33 queries, 65 blocks: one chunk of each, not one per partition
