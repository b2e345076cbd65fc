"""Exact top-k inner products by block-at-a-time pruning (operator 11).

Vectors become integer vectors, sorted by the two nearest of some pivots, and
packed into document-range blocks: a forward index (the block's matrix) and
the largest and smallest value of each component. A query's bound for a
block sums, per component, its value times the block's extreme on its side.

Each pass takes a query's next blocks in order of falling bounds (ties by
block number), as far as they can still beat the k-th score so far, and scores
them through their forward indexes; a query ends once no bound is left that
reaches its k-th score. Passes take 4, 32, 256, ... blocks, so nothing but
(query, block) pairs to be scored is ever listed. Bounds meet queries in a
grid of (chunk of queries, chunk of blocks) cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, with_row_id
from quarry.operators.blocks import grid_join, grid_shape

SCALE = 256
BLOCK = 256
#: queries in a chunk, blocks in a chunk of bounds
QUERIES, BOUNDS = 256, 512
#: expected number of rows sampled as pivots; they only shape the blocks
PIVOTS = 256
FIRST, GROWTH = 4, 8

ROWS = "rid bigint, id bigint, dim int, cell bigint, vec binary, asks boolean"
BLOCKS = "block bigint, dim int, first_id bigint, low binary, high binary, ids array<bigint>, rids array<bigint>, flat binary"
CHUNKS = "chunk bigint, dim int, blocks array<bigint>, first_ids array<bigint>, low binary, high binary"
NEXT = "q bigint, block bigint, bound bigint"
HITS = "q bigint, id bigint, score bigint"
LEAST = np.iinfo(np.int64).min


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T: in floating point where no sum can round."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 2**63:
        raise ValueError("inner products do not fit a long")
    return a @ b.T


def _matrix(flat: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(flat, dtype=np.int32).reshape(rows, dim).astype(np.int64)


def _quantise(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Integer vectors, and a cell: their nearest two pivots of the same length."""
    for batch in batches:
        lists = batch.column("vec")
        ends = lists.offsets.to_numpy()
        flat = np.floor(lists.values.to_numpy(zero_copy_only=False) * SCALE)
        if np.abs(flat).max(initial=0) >= 2**31:
            raise ValueError("a component is too large: its products would not fit a long")
        whole = flat.astype(np.int32)
        dims = np.diff(ends)
        cells = np.zeros(len(batch), dtype=np.int64)
        for dim, p in pivots.items():
            at = np.flatnonzero(dims == dim)
            if dim and len(at):
                near = whole[ends[at][:, None] + np.arange(dim)] @ p.T
                first = near.argmax(axis=1)
                near[np.arange(len(at)), first] = -np.inf
                cells[at] = first * len(p) + near.argmax(axis=1)
        vecs = [whole[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([
            batch.column("rid"), batch.column("id"), pa.array(dims, pa.int32()), pa.array(cells), pa.array(vecs, pa.binary()), batch.column("asks")],
            names=["rid", "id", "dim", "cell", "vec", "asks"])


def _packs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, int, list[dict]]]:
    """(number unique among tasks, dim, rows) of at most ``size`` rows of one dim, in the order they come."""
    number, held = TaskContext.get().partitionId() << 32, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (len(held) == size or held[0]["dim"] != row["dim"]):
                yield number, held[0]["dim"], held
                number, held = number + 1, []
            held.append(row)
    if held:
        yield number, held[0]["dim"], held


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = ["block", "dim", "first_id", "low", "high", "ids", "rids", "flat"]
    for number, dim, rows in _packs(batches, size):
        rows = sorted(rows, key=lambda r: r["id"])
        flat = b"".join(r["vec"] for r in rows)
        x = np.frombuffer(flat, dtype=np.int32).reshape(len(rows), dim)
        values = [number, dim, rows[0]["id"], x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), [r["id"] for r in rows], [r["rid"] for r in rows], flat]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    for number, dim, rows in _packs(batches, BOUNDS):
        rows = sorted(rows, key=lambda r: r["block"])
        values = [number, dim, [r["block"] for r in rows], [r["first_id"] for r in rows], b"".join(r["low"] for r in rows), b"".join(r["high"] for r in rows)]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["chunk", "dim", "blocks", "first_ids", "low", "high"])


def next_blocks(q: np.ndarray, state: np.ndarray, blocks: np.ndarray, first_ids: np.ndarray, low: np.ndarray, high: np.ndarray,
                take: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, block, bound) positions: per query the next ``take`` blocks, ascending
    ``blocks``, in order of bounds.

    ``state`` has per query: k-th score and its id, bound and number of the last block taken.
    """
    d = min(q.shape[1], low.shape[1])
    q = q[:, :d]
    bound = _product(np.maximum(q, 0), high[:, :d]) + _product(np.minimum(q, 0), low[:, :d])
    kth, kid, last, last_block = (state[:, [c]] for c in range(4))
    open_ = (bound < last) | ((bound == last) & (blocks > last_block))
    # a block whose bound only equals the k-th score can still hold a smaller id
    open_ &= (bound > kth) | ((bound == kth) & (first_ids < kid))
    key = np.where(open_, bound, LEAST)
    order = np.argsort(-1 - key, axis=1, kind="stable")[:, :take]
    rows = np.repeat(np.arange(len(q)), order.shape[1])
    cols = order.ravel()
    ok = open_[rows, cols]
    return rows[ok], cols[ok], bound[rows[ok], cols[ok]]


def _next(batches: Iterator[pa.RecordBatch], take: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            asks = row["asks"]
            q = _matrix(b"".join(a["vec"] for a in asks), row["qdim"], len(asks))
            state = np.array([(a["kth"], a["kid"], a["last"], a["last_block"]) for a in asks], dtype=np.int64)
            blocks = np.array(row["blocks"], dtype=np.int64)
            low, high = (_matrix(row[c], row["dim"], len(blocks)) for c in ("low", "high"))
            at, col, bound = next_blocks(q, state, blocks, np.array(row["first_ids"], dtype=np.int64), low, high, take)
            rids = np.array([a["rid"] for a in asks], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(rids[at]), pa.array(blocks[col]), pa.array(bound)], names=["q", "block", "bound"])


def _score(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            asks, ids, rids = row["asks"], np.array(row["ids"], dtype=np.int64), np.array(row["rids"], dtype=np.int64)
            own = np.array([a["rid"] for a in asks], dtype=np.int64)
            q, x = _matrix(b"".join(a["vec"] for a in asks), row["qdim"], len(asks)), _matrix(row["flat"], row["dim"], len(ids))
            d = min(row["qdim"], row["dim"])
            score = _product(q[:, :d], x[:, :d])
            kth = np.array([a["kth"] for a in asks], dtype=np.int64)[:, None]
            open_ = (own[:, None] != rids) & (score >= kth)
            # ids ascend in a block, so a stable sort takes the smaller of equal scores
            order = np.argsort(-1 - np.where(open_, score, LEAST), axis=1, kind="stable")[:, :k]
            at, col = np.repeat(np.arange(len(asks)), order.shape[1]), order.ravel()
            ok = open_[at, col]
            at, col = at[ok], col[ok]
            yield pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(ids[col]), pa.array(score[at, col])], names=["q", "id", "score"])


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """About ``PIVOTS`` rows by a hash of their row id, as unit vectors per length."""
    n = rows.count()
    share = F.pmod(F.xxhash64(F.lit(11), "rid"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, PIVOTS / max(1, n))))
    found: dict[int, list] = {}
    for r in rows.filter(share).select("vec").toLocalIterator():
        found.setdefault(len(r["vec"]), []).append(r["vec"])
    out = {}
    for dim, vs in found.items():
        x = np.array(vs, dtype=np.float64).reshape(len(vs), dim)
        out[dim] = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    return out


def top_inner_products(vectors: DataFrame, asks: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                       block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): per row where ``asks`` holds its ``k`` highest
    integer inner products with all other rows, equal scores by smaller id.

    Component x counts as floor(256 * x). Rows with a null vector, a null or
    non-finite component, or a null id (no result could name it) take no part.
    A shorter vector's missing components are zero, so an empty one scores 0.
    Repeated rows and ids are rows of their own. With fewer than ``k`` other rows
    all are returned. Scores that do not fit a long raise an error. Other columns
    are read by ``asks`` only.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fine = F.forall(vec_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(fine)
    rows = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = scratch.keep(with_row_id(rows), "rows")
    pivots = _pivots(rows)
    whole = scratch.keep(rows.mapInArrow(lambda it: _quantise(it, pivots), ROWS), "integers")
    by = ["dim", "cell", "id", "rid"]
    ranged = whole.select("rid", "id", "dim", "cell", "vec").repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("cell")
    index = scratch.keep(ranged.mapInArrow(lambda it: _blocks(it, block), BLOCKS), "blocks")
    # full chunks, whatever the number of shuffle partitions: every chunk of queries meets every chunk of bounds
    fill = lambda n, size: max(1, min(parts, -(-n // size)))
    bounds = index.select("block", "dim", "first_id", "low", "high").repartitionByRange(fill(index.count(), BOUNDS), "dim", "block")
    bounds = scratch.keep(bounds.sortWithinPartitions("dim", "block").mapInArrow(_chunks, CHUNKS), "bounds")
    # a chunk of queries: neighbours in the order of the index
    place = F.sum(F.lit(1)).over(Window.partitionBy("part").orderBy(*by))
    asked = whole.filter("asks")
    queries = asked.repartitionByRange(fill(asked.count(), QUERIES), *by).withColumn("part", F.spark_partition_id())
    queries = scratch.keep(queries, "asked")
    queries = queries.select("rid", "id", "dim", "vec", F.concat_ws("-", "part", F.floor(place / QUERIES), "dim").alias("chunk"))
    queries = scratch.keep(queries, "queries")
    shape = grid_shape(queries.select("chunk").distinct().count(), bounds.count())
    none = F.lit(None).cast("bigint")
    most, least = F.lit(2**63 - 1), F.lit(-(2**63) + 1)
    state = queries.select(F.col("rid").alias("q"), most.alias("last"), least.alias("last_block"))
    tops = queries.select(F.col("rid").alias("q"), none.alias("id"), none.alias("score"), F.lit(0).alias("rank")).limit(0)
    take = FIRST
    while True:
        # a query with fewer than k results beats any bound
        kth = tops.filter(F.col("rank") == k).select("q", F.col("score").alias("kth"), F.col("id").alias("kid"))
        live = queries.withColumnRenamed("rid", "q").join(state, "q").join(kth, "q", "left").withColumnRenamed("q", "rid")
        live = live.withColumn("kth", F.coalesce("kth", least)).withColumn("kid", F.coalesce("kid", most))
        live = scratch.keep(live, "live")
        chunks = live.groupBy("chunk", F.col("dim").alias("qdim")).agg(
            F.collect_list(F.struct("rid", "vec", "kth", "kid", "last", "last_block")).alias("asks"))
        pairs = grid_join(chunks.withColumnRenamed("chunk", "asking"), bounds, "asking", "chunk", *shape)
        found = pairs.mapInArrow(lambda it, n=take: _next(it, n), NEXT)
        order = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
        work = scratch.keep(found.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= take), "work")
        if work.isEmpty():
            break
        # pairs and matrices take far less room in files than in memory: no broadcast by the files' size
        asking = work.select("q", "block").hint("merge").join(live.select(F.col("rid").alias("q"), "chunk", F.col("dim").alias("qdim"), "vec", "kth"), "q")
        asking = asking.groupBy("block", "chunk", "qdim").agg(F.collect_list(F.struct(F.col("q").alias("rid"), "vec", "kth")).alias("asks"))
        forward = index.select("block", "dim", "ids", "rids", "flat").hint("merge")
        hits = asking.join(forward, "block").mapInArrow(lambda it: _score(it, k), HITS)
        better = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        both = tops.select("q", "id", "score").unionByName(hits)
        tops = scratch.keep(both.withColumn("rank", F.row_number().over(better)).filter(F.col("rank") <= k), "tops")
        state = work.filter(F.col("turn") == take).select("q", F.col("bound").alias("last"), F.col("block").alias("last_block"))
        if state.isEmpty():
            break
        take *= GROWTH
    named = queries.select(F.col("rid").alias("q"), F.col("id").alias("query_id"))
    return named.join(tops, "q").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
