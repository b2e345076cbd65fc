"""Exact nearest-neighbour work in blocks (KNN, SMOTE, exact silhouette; ops
13.14, 14.6, 14.20).

A block is a list of rows; in Arrow its vectors are one flat array of doubles,
and NumPy scores a block of queries against a block of reference rows, so a
task holds two blocks. A reference of a few blocks meets the queries in a grid
of blocks. A larger one is sorted by the two nearest of some pivots and cut
into blocks, each with the ball that holds it. A query searches the blocks with
the nearest balls first; its k-th distance there tells which other balls can
hold a nearer row, and only those are searched.

Rows whose vector is NULL or holds a NULL, NaN or infinite component take no part,
neither as query nor as reference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.blocks import grid_join, grid_shape

DEFAULT_BLOCK_ROWS = 2048
#: a reference of at most this many blocks is searched whole
SMALL_BLOCKS = 8
#: a larger one with fewer distinct vectors than this share of its rows is searched by vector
REPEATED = 0.7
#: SMOTE: minority rows numbered in one range
NUMBERED_ROWS = 100_000
#: about how many reference rows are sampled as pivots; they only shape the blocks
PIVOTS = 256
#: queries that are told their blocks together, balls in a row, nearest blocks searched first
CHUNK_BITS = 8
BALLS = 512
FIRST_BLOCKS = 2
#: silhouette: blocks a side and most rows of a block; points and rows of a tile
PAIR_BLOCKS = 16
PAIR_ROWS = 65_536
TILE = (256, 1024)


def as_vector(df: DataFrame, features, name: str = "__x") -> DataFrame:
    """Feature array<double> column from an array column or numeric columns; an array of
    floats stays one (half the bytes to shuffle) and is computed with as doubles."""
    if isinstance(features, str):
        kind = dict(df.dtypes)[features]
        return df.withColumn(name, F.col(features).cast("array<float>" if kind == "array<float>" else "array<double>"))
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in features]))


def usable(x: str = "__x") -> Column:
    """The vector has no NULL, NaN or infinite component (and is not NULL)."""
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))


def _vectors(lists: pa.Array) -> np.ndarray:
    """A matrix of doubles of a list<double> or list<float> column; all lists have one length."""
    n = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1) if n else np.zeros((0, 0))


def _fields(column: pa.Array, row: int) -> dict[str, pa.Array]:
    """The fields of a list<struct> cell as columns."""
    s = column.slice(row, 1).flatten()
    return {f.name: a for f, a in zip(s.type, s.flatten())}


def _hashed_blocks(df: DataFrame, row_id: str, rows: int, n: int, name: str) -> DataFrame:
    """(name, rows): about ``rows`` of the ``n`` rows of ``df`` in a list."""
    others = [c for c in df.columns]
    at = F.pmod(F.xxhash64(F.lit(3), row_id), F.lit(max(1, -(-n // rows)))).alias(f"{name}_no")
    return df.groupBy(at).agg(F.collect_list(F.struct(*others)).alias(name))


def _consecutive_blocks(df: DataFrame, name: str) -> DataFrame:
    """(name, rows): up to 2 ** CHUNK_BITS rows of an input partition in a list."""
    at = F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS).alias(f"{name}_no")
    return df.select(at, F.struct(*df.columns).alias("s")).groupBy(f"{name}_no").agg(F.collect_list("s").alias(name))


def _score(pairs: DataFrame, k: int, schema: str, payload: list[str], exclude_self: bool) -> DataFrame:
    """The k best reference rows per query and pair of blocks, ties to the smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                q, r = _fields(batch.column("__q"), at), _fields(batch.column("__r"), at)
                qx, rx = _vectors(q["__x"]), _vectors(r["__x"])
                qid, rid = np.asarray(q["__qid"].to_pylist()), np.asarray(r["__rid"].to_pylist())
                q2, r2 = (qx * qx).sum(axis=1), (rx * rx).sum(axis=1)
                d2 = np.maximum(q2[:, None] + r2[None, :] - 2.0 * qx @ rx.T, 0.0)
                if exclude_self:
                    d2[qid[:, None] == rid[None, :]] = np.inf
                kk = min(k, d2.shape[1])
                # everything up to the k-th distance, with room for the rounding of the expansion
                cut = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
                cut = cut + 1e-9 * (1.0 + q2 + r2.max())
                i, j = np.nonzero((d2 <= cut[:, None]) & np.isfinite(d2))
                dist = np.sqrt(((qx[i] - rx[j]) ** 2).sum(axis=1))
                order = np.lexsort((rid[j], dist, i))
                i, j, dist = i[order], j[order], dist[order]
                first = np.searchsorted(i, i)  # where the query's candidates begin
                keep = np.arange(len(i)) - first < kk
                i, j, dist = i[keep], j[keep], dist[keep]
                yield pa.RecordBatch.from_arrays([q["__qid"].take(pa.array(i)), r["__rid"].take(pa.array(j)), pa.array(dist, pa.float64()),
                                                  *[r[p].take(pa.array(j)) for p in payload]], names=["__qid", "nn_id", "distance", *payload])

    return pairs.select("__q", "__r").mapInArrow(run, schema)


def _best(cands: DataFrame, k: int, payload: list[str]) -> DataFrame:
    """The k best candidates of each query; a query has at most k per block searched."""
    c = F.slice(F.array_sort(F.collect_list(F.struct("distance", "nn_id", *payload))), 1, k)
    return cands.groupBy("__qid").agg(c.alias("__c"))


def _types(df: DataFrame) -> str:
    return df.schema.simpleString()[len("struct<"):-1]


def _pivots(ref: DataFrame, row_id: str, n: int) -> np.ndarray:
    """About ``PIVOTS`` reference rows by a hash of their id."""
    share = F.pmod(F.xxhash64(F.lit(5), row_id), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, PIVOTS / n)))
    rows = ref.filter(share).select("__x").toArrow()
    if rows.num_rows == 0:
        rows = ref.select("__x").limit(1).toArrow()
    return _vectors(rows.column(0).combine_chunks())


def _sorted_by_cell(df: DataFrame, pivots: np.ndarray, row_id: str) -> DataFrame:
    """``df`` in ranges of (nearest pivot, second nearest, id), sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p2 = (pivots * pivots).sum(axis=1)
        for batch in batches:
            near = p2[None, :] - 2.0 * _vectors(batch.column("__x")) @ pivots.T if len(batch) else np.zeros((0, len(pivots)))
            a = near.argmin(axis=1)
            near[np.arange(len(a)), a] = np.inf
            cell = a * len(pivots) + near.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=[*batch.schema.names, "__cell"])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["__cell", row_id]
    return df.mapInArrow(run, f"{_types(df)}, __cell bigint").repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("__cell")


def _balls(df: DataFrame, rows: int) -> DataFrame:
    """(block, centre, radius, rows) of consecutive rows of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a in range(0, len(batch), rows):
                part = batch.slice(a, rows)
                x = _vectors(part.column("__x"))
                centre = x.mean(axis=0)
                radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
                cells = pa.StructArray.from_arrays(part.columns, fields=list(part.schema))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([centre], pa.list_(pa.float64())), pa.array([radius]),
                    pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), cells)], names=["block", "centre", "radius", "__r"])
                number += 1

    return df.mapInArrow(run, f"block bigint, centre array<double>, radius double, __r array<struct<{df.schema.simpleString()[len('struct<'):]}>")


def _needed(batches: Iterator[pa.RecordBatch], take: int | None) -> Iterator[pa.RecordBatch]:
    """Per query of a chunk the ``take`` balls of a chunk that come nearest, or all
    that reach its k-th distance and were not searched."""
    for batch in batches:
        for at in range(len(batch)):
            q, b = _fields(batch.column("asks"), at), _fields(batch.column("balls"), at)
            x, c, blocks = _vectors(q["__x"]), _vectors(b["centre"]), b["block"].to_numpy()
            x2, c2 = (x * x).sum(axis=1), (c * c).sum(axis=1)
            d = np.sqrt(np.maximum(x2[:, None] + c2[None, :] - 2.0 * x @ c.T, 0.0))
            # rounding must not push a ball away: the root of the expansion's error at most
            slack = 1e-7 * (1.0 + np.sqrt(x2)[:, None] + np.sqrt(c2)[None, :])
            reach = d - b["radius"].to_numpy()[None, :] - slack
            if take is not None:
                n = min(take, len(blocks))
                j = np.argpartition(reach, n - 1, axis=1)[:, :n].ravel()
                i = np.repeat(np.arange(len(x)), n)
            else:
                need = reach <= q["tau"].to_numpy()[:, None]
                for row, done in enumerate(q["done"].to_pylist()):
                    need[row, np.isin(blocks, done)] = False
                i, j = np.nonzero(need)
            yield pa.RecordBatch.from_arrays([q["__qid"].take(pa.array(i)), pa.array(blocks[j], pa.int64()), pa.array(reach[i, j])],
                                             names=["__qid", "block", "reach"])


def _search_blocks(q: DataFrame, r: DataFrame, n: int, k: int, schema: str, payload: list[str], exclude_self: bool, rows: int) -> DataFrame:
    """Candidates from the blocks each query needs."""
    from quarry.session import cut_lineage

    pivots = _pivots(r, "__rid", n)
    blocks = cut_lineage(_balls(_sorted_by_cell(r, pivots, "__rid"), rows))
    chunks_of_balls = max(1, -(-blocks.count() // BALLS))
    balls = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(chunks_of_balls)).alias("ball_no")).agg(
        F.collect_list(F.struct("block", "centre", "radius")).alias("balls"))
    balls = cut_lineage(balls)
    asks = _sorted_by_cell(q, pivots, "__qid").withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS))
    asks = cut_lineage(asks)
    shape = grid_shape(asks.select("chunk").distinct().count(), chunks_of_balls)
    qid = dict(q.dtypes)["__qid"]

    def needed(rows_of: DataFrame, take: int | None) -> DataFrame:
        chunks = rows_of.groupBy("chunk").agg(F.collect_list(F.struct(*[c for c in rows_of.columns if c != "chunk"])).alias("asks"))
        pairs = grid_join(chunks, balls, "chunk", "ball_no", *shape)
        return pairs.select("asks", "balls").mapInArrow(lambda it: _needed(it, take), f"__qid {qid}, block bigint, reach double")

    def search(work: DataFrame) -> DataFrame:
        asked = work.join(asks, "__qid").groupBy("block", "chunk").agg(F.collect_list(F.struct("__qid", "__x")).alias("__q"))
        return _score(asked.join(blocks.select("block", "__r"), "block"), k, schema, payload, exclude_self)

    nearest = F.slice(F.array_sort(F.collect_list(F.struct("reach", "block"))), 1, FIRST_BLOCKS)
    first = needed(asks, FIRST_BLOCKS).groupBy("__qid").agg(nearest.alias("b"))
    first = cut_lineage(first.select("__qid", F.col("b.block").alias("done")))
    near = cut_lineage(search(first.select("__qid", F.explode("done").alias("block"))))
    tau = _best(near, k, []).select("__qid", F.when(F.size("__c") >= k, F.col("__c")[k - 1]["distance"]).alias("tau"))
    told = asks.join(first, "__qid").join(tau, "__qid", "left").withColumn("tau", F.coalesce("tau", F.lit(float("inf"))))
    return near.unionByName(search(needed(told, None)))


def _grid(q: DataFrame, r: DataFrame, n: int, k: int, schema: str, payload: list[str], exclude_self: bool, rows: int) -> DataFrame:
    """Candidates from at most a few blocks: every query block meets them all."""
    parts = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rb = _hashed_blocks(r, "__rid", rows, max(1, n), "__r")
    pairs = grid_join(_consecutive_blocks(q, "__q"), rb, "__q_no", "__r_no", parts, max(1, -(-n // rows)))
    return _score(pairs, k, schema, payload, exclude_self)


def knn(queries: DataFrame, reference: DataFrame, k: int, features, q_id: str, r_id: str,
        payload: list[str] | None = None, exclude_self: bool = False,
        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Exact k nearest reference rows (Euclidean) for every query row.

    Returns ``(q_id, nn_rank 1..k, nn_id, distance, payload...)``; ties on
    distance go to the smaller reference id. ``exclude_self`` drops the
    reference row whose id equals the query id (neighbours within a set).
    A query row with an unusable vector (NULL, or a NULL, NaN or infinite component) or a
    NULL id has no result rows, such a reference row is nobody's neighbour. Ids
    are unique; all vectors have one length.
    """
    payload = list(payload or [])
    pnames = [f"__p_{p}" for p in payload]
    q = as_vector(queries, features).select(F.col(q_id).alias("__qid"), "__x").filter(F.col("__qid").isNotNull() & usable())
    r = as_vector(reference, features).select(F.col(r_id).alias("__rid"), "__x", *[F.col(p).alias(n) for p, n in zip(payload, pnames)])
    r = r.filter(F.col("__rid").isNotNull() & usable())
    types = dict(r.dtypes)
    schema = f"__qid {dict(q.dtypes)['__qid']}, nn_id {types['__rid']}, distance double" + "".join(f", {p} {types[p]}" for p in pnames)
    n, distinct = r.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64("__x"), 0.02)).first()
    blocks = -(-n // block_rows)
    if blocks > SMALL_BLOCKS and distinct < REPEATED * n:
        best = _knn_of_vectors(q, r, k, pnames, types, exclude_self, block_rows)
        return _ranked(best, q_id, payload, pnames)
    if blocks <= SMALL_BLOCKS:
        cands = _grid(q, r, n, k, schema, pnames, exclude_self, block_rows)
    else:
        cands = _search_blocks(q, r, n, k, schema, pnames, exclude_self, block_rows)
    return _ranked(_best(cands, k, pnames), q_id, payload, pnames)


def _knn_of_vectors(q: DataFrame, r: DataFrame, k: int, pnames: list[str], types: dict[str, str], exclude_self: bool, block_rows: int) -> DataFrame:
    """:func:`_best` where many rows share a vector. Rows of one vector are equally
    far from any query, so only the smallest ids of each can be among the
    k nearest, and queries of one vector have the same neighbours, but for themselves."""
    from quarry.session import cut_lineage

    most = k + 1 if exclude_self else k
    first = Window.partitionBy("__x").orderBy("__rid")
    kept = r.withColumn("__at", F.row_number().over(first)).filter(F.col("__at") <= most)
    near = kept.groupBy("__x").agg(F.array_sort(F.collect_list(F.struct("__rid", *pnames))).alias("__same"), F.min("__rid").alias("__rid"))
    near = cut_lineage(near)  # one row per vector
    asked = cut_lineage(q.select("__x").distinct().withColumn("__qid", F.monotonically_increasing_id()))
    # k vectors hold the k nearest rows, and one more the row that takes the query's own place
    vectors = near.select("__x", "__rid")
    n = vectors.count()
    schema = f"__qid bigint, nn_id {types['__rid']}, distance double"
    found = _best(_search_blocks(asked.select("__qid", "__x"), vectors, n, most, schema, [], False, block_rows)
                  if n > SMALL_BLOCKS * block_rows else _grid(asked.select("__qid", "__x"), vectors, n, most, schema, [], False, block_rows), most, [])
    each = found.select("__qid", F.explode("__c").alias("s")).select("__qid", "s.distance", F.col("s.nn_id").alias("__rid"))
    each = each.join(near.select("__rid", "__same"), "__rid").select("__qid", "distance", F.explode("__same").alias("m"))
    rows = F.struct("distance", F.col("m.__rid").alias("nn_id"), *[F.col(f"m.{p}").alias(p) for p in pnames])
    lists = each.groupBy("__qid").agg(F.slice(F.array_sort(F.collect_list(rows)), 1, most).alias("__c"))
    of = lists.join(asked.withColumnRenamed("__qid", "__v"), F.col("__qid") == F.col("__v")).select("__x", "__c")
    out = q.join(of, "__x").select("__qid", "__c")
    if exclude_self:
        out = out.withColumn("__c", F.slice(F.filter("__c", lambda s: s["nn_id"] != F.col("__qid")), 1, k))
    return out


def _ranked(best: DataFrame, q_id: str, payload: list[str], pnames: list[str]) -> DataFrame:
    return best.select("__qid", F.posexplode("__c").alias("__i", "__s")).select(
        "__qid", (F.col("__i") + 1).alias("nn_rank"), "__s.nn_id", "__s.distance", *[f"__s.{p}" for p in pnames]).toDF(
        q_id, "nn_rank", "nn_id", "distance", *payload)


def knn_predict(train: DataFrame, test: DataFrame, k: int, features, label: str, train_id: str, test_id: str,
                block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """k-NN classification with uniform votes (op 14.6): prediction = the
    most voted label (ties -> smallest label), probability = votes / k."""
    nn = knn(test, train, k, features, test_id, train_id, payload=[label], block_rows=block_rows)
    votes = nn.groupBy(test_id, label).agg(F.count(F.lit(1)).alias("__v"))
    best = votes.groupBy(test_id).agg(
        F.min_by(F.col(label), F.struct((-F.col("__v")).alias("a"), F.col(label).alias("b"))).alias("prediction"),
        F.max("__v").alias("__mv"))
    return best.select(test_id, "prediction", (F.col("__mv") / F.lit(float(k))).alias("probability"))


def smote(df: DataFrame, label: str, features: list[str], id_col: str, k: int = 5, seed: int = 42,
          minority=None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """SMOTE oversampling of the minority class up to the majority count
    (op 13.14; Chawla et al. 2002): each synthetic row picks a minority row
    and one of its ``k`` nearest minority neighbours at random (seeded
    hashes) and interpolates ``x + u * (nn - x)``, ``u`` in [0, 1). Minority rows
    with a NULL, NaN or infinite feature count for the balance but are neither
    base nor neighbour; with fewer than two others nothing is added.

    Returns the input rows plus synthetic rows (``id_col`` NULL,
    ``synthetic`` true). Every step is a join or an aggregate; the
    neighbour search is :func:`knn` (blocked, exact)."""
    from quarry.operators.ranking import row_numbers
    from quarry.session import cut_lineage

    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    if len(counts) < 2:
        return df.withColumn("synthetic", F.lit(False))
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], c))
    n_min, n_max = counts[minority], max(counts.values())
    n_new = n_max - n_min
    base = df.withColumn("synthetic", F.lit(False))
    if n_new <= 0:
        return base
    mino = as_vector(df.filter(F.col(label) == F.lit(minority)), features).filter(usable())
    mino = cut_lineage(mino.select(id_col, *features))
    n_base = mino.count()
    if n_base < 2:
        return base
    # ranges by the rows themselves: the plan's estimate of a joined table is the product of its sides
    mino = row_numbers(mino, [id_col], "__rn", start=0, total=False, num_partitions=-(-n_base // NUMBERED_ROWS))
    kk = min(k, n_base - 1)
    nn = knn(mino, mino, kk, features, "__rn", "__rn", exclude_self=True, block_rows=block_rows) \
        .select(F.col("__rn").alias("__base"), "nn_rank", F.col("nn_id").alias("__nb"))
    spark = df.sparkSession
    plan = spark.range(n_new).select(
        F.col("id").alias("__s"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n_base)).alias("__base"),
        (F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id")), F.lit(kk)) + 1).cast("int").alias("nn_rank"),
        (F.pmod(F.xxhash64(F.lit(seed + 2), F.col("id")), F.lit(1 << 30)) / float(1 << 30)).alias("__u"))
    pairs = plan.join(nn, ["__base", "nn_rank"])
    xb = mino.select(F.col("__rn").alias("__base"), *[F.col(c).alias(f"__b_{c}") for c in features])
    xn = mino.select(F.col("__rn").alias("__nb"), *[F.col(c).alias(f"__n_{c}") for c in features])
    syn = pairs.join(xb, "__base").join(xn, "__nb").select(
        *[(F.col(f"__b_{c}") + F.col("__u") * (F.col(f"__n_{c}") - F.col(f"__b_{c}"))).alias(c) for c in features])
    syn = syn.withColumn(label, F.lit(minority)).withColumn("synthetic", F.lit(True))
    return base.unionByName(syn, allowMissingColumns=True)


def _pair_sums(q: dict[str, pa.Array], r: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Per query row and cluster of ``r`` the sum of distances and the count, rows of the
    query's own id left out. Tiles small enough for a core's cache; rows of
    ``r`` in the order of their cluster, so a cluster is a run of columns."""
    groups = r["__c"].dictionary_encode()
    codes = groups.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    qx, rx = _vectors(q["__x"]), _vectors(r["__x"])[order]
    # [-2x, |x|^2, 1] . [y, 1, |y|^2] is the squared distance
    left = np.hstack([-2.0 * qx, (qx * qx).sum(axis=1)[:, None], np.ones((len(qx), 1))])
    right = np.hstack([rx, np.ones((len(rx), 1)), (rx * rx).sum(axis=1)[:, None]])
    qid, rid = np.asarray(q["__id"].to_pylist()), np.asarray(r["__id"].to_pylist())[order]
    by_id = np.argsort(rid, kind="stable")
    lo, hi = np.searchsorted(rid, qid, "left", by_id), np.searchsorted(rid, qid, "right", by_id)
    me = np.repeat(np.arange(len(qid)), hi - lo)
    mine = by_id[np.repeat(lo, hi - lo) + np.arange(len(me)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
    n = len(groups.dictionary)
    count = np.bincount(codes, minlength=n)
    step = max(1, min(TILE[0], (1 << 20) // n))
    for i in range(0, len(qx), step):
        rows = min(step, len(qx) - i)
        a, b = np.searchsorted(me, [i, i + rows])
        at, same = me[a:b] - i, mine[a:b]
        sums, sizes = np.zeros((rows, n)), np.tile(count, (rows, 1))
        np.subtract.at(sizes, (at, codes[same]), 1)
        for j in range(0, len(rx), TILE[1]):
            d = left[i:i + rows] @ right[j:j + TILE[1]].T
            np.sqrt(np.maximum(d, 0.0, out=d), out=d)
            here = (same >= j) & (same < j + d.shape[1])
            d[at[here], same[here] - j] = 0.0
            c = codes[j:j + d.shape[1]]
            starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            sums[:, c[starts]] += np.add.reduceat(d, starts, axis=1)
        k, c = pa.array(np.repeat(np.arange(i, i + rows), n)), pa.array(np.tile(np.arange(n), rows))
        yield pa.RecordBatch.from_arrays([q["__id"].take(k), q["__c"].take(k), groups.dictionary.take(c), pa.array(sums.ravel()),
                                          pa.array(sizes.ravel().astype("int64"))], names=["__qid", "__qc", "__c", "s", "n"])


def silhouette_exact(df: DataFrame, cluster: str, features, id_col: str, block_rows: int = DEFAULT_BLOCK_ROWS,
                     points: DataFrame | None = None) -> DataFrame:
    """Exact Euclidean silhouette per point (op 14.20; T23: ML's evaluator
    uses squared distances): ``s = (b - a) / max(a, b)`` with ``a`` the mean
    distance to its own cluster (excluding itself) and ``b`` the smallest mean
    distance to another cluster; a singleton cluster scores 0.

    A mean distance needs every row of a cluster, so the cost is points x rows,
    done block against block: blocks hold rows of any cluster, every pair of a
    block of points and a block of rows has a cell of a grid for its key, and
    leaves one distance sum per point and cluster. Blocks grow with the table from
    ``block_rows`` to ``PAIR_ROWS`` rows, about ``PAIR_BLOCKS`` a side. ``points`` (default: all
    rows) is the stated set to score; on a large table pass a part of it. Rows
    with an unusable vector (see :func:`knn`), a NULL id or a NULL cluster take no part.

    Returns ``(id, cluster, a, b, silhouette)``."""
    own = points if points is not None else df
    fine = F.col("__id").isNotNull() & F.col("__c").isNotNull() & usable()
    part = lambda d: as_vector(d, features).select(F.col(id_col).alias("__id"), F.col(cluster).alias("__c"), "__x").filter(fine)
    q, r = part(own), part(df)
    n = max(1, r.count())
    rows = max(block_rows, min(PAIR_ROWS, -(-n // PAIR_BLOCKS)))
    n_points = n if points is None else max(1, q.count())
    sides = -(-n_points // rows), -(-n // rows)
    pairs = grid_join(_hashed_blocks(q, "__id", rows, n_points, "__q"), _hashed_blocks(r, "__id", rows, n, "__r"), "__q_no", "__r_no", *sides)
    ctype, itype = dict(q.dtypes)["__c"], dict(q.dtypes)["__id"]
    schema = f"__qid {itype}, __qc {ctype}, __c {ctype}, s double, n long"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                yield from _pair_sums(_fields(batch.column("__q"), at), _fields(batch.column("__r"), at))

    pairs = pairs.select("__q", "__r")
    per = pairs.mapInArrow(score, schema).groupBy("__qid", "__qc", "__c").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    mean = F.try_divide(F.col("s"), F.col("n"))
    g = per.groupBy("__qid", "__qc").agg(
        F.max(F.when(F.col("__c") == F.col("__qc"), mean)).alias("a"),
        F.max(F.when(F.col("__c") == F.col("__qc"), F.col("n"))).alias("__own_n"),
        F.min(F.when((F.col("__c") != F.col("__qc")) & (F.col("n") > 0), mean)).alias("b"))
    sil = F.when((F.col("__own_n") == 0) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest(F.col("a"), F.col("b")))
    return g.select(F.col("__qid").alias(id_col), F.col("__qc").alias(cluster), "a", "b", sil.alias("silhouette"))


def silhouette_by_cluster(scores: DataFrame, cluster: str) -> DataFrame:
    """(cluster, n, silhouette): the mean score of each cluster (op 14.20)."""
    return scores.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))
