"""Near-duplicate classes by MinHash with tensored banding (operator 7).

Two families of ``m`` small hash collections (``ROWS`` minhashes each) give
m * m tables: the key of table (i, j) joins collection i of the first family
with collection j of the second. So 2m * ROWS minhashes do the work of m * m
* 2 ROWS. Two documents of similarity J meet in some table with probability
(1 - (1 - J^ROWS)^m)^2; ``m`` is chosen so that a pair at the threshold is
missed with probability ``MISS`` at most.

Documents with equal shingle sets are one node. Some slices of the tables come
first, with one row per component in a bucket; a bucket that lies in one component after them is
left out of what follows. In a bucket no pairs are listed: where at most
``MINORITY`` members lie outside the largest component, these are compared
with the members of other components; else one leader is, then 16, 4,096 and
more leaders follow while the bucket lies in several components, until every pair that is not yet connected has been
compared. The comparison is a join condition on sizes and parity sketches,
which bound the number of differing shingles from below and so lose no link;
what passes is confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, with_row_id

ROWS = 3
MISS = 1e-5
#: shingles hashed at once in a task
CHUNK = 500_000

SIGNED = "id bigint, n_shingles bigint, sid binary, halves array<bigint>, odd array<bigint>"
#: longs of a parity sketch
SKETCH = 8
#: members outside the largest component of a bucket that are compared with all others at once
MINORITY = 64
#: comparisons (members x outsiders) up to which all members of a half are compared at once
HALF_WORK = 50_000_000
#: bits (as a power of 2) of the filter for the texts that are read again
BLOOM = 26


def collections_for(percent: int) -> int:
    """Collections per family for a link threshold in percent."""
    return math.ceil(math.log(MISS / 2) / math.log(1 - (percent / 100) ** ROWS))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text
    (A-Z lower-cased; a shorter text is one shingle, no words give none)."""
    ws = text.lower().split()  # bytes: lowers A-Z only, splits at space and 0x09-0x0D only
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))
    n = min(k, len(w))
    if n == 0:
        return w
    out = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = _mix(out + w[i:len(w) - n + 1 + i])
    return np.unique(out)


def _functions(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    n = 2 * m * ROWS
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def half_keys(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row per (non-empty) set: the 2m collection keys, as signed longs."""
    mul, add = _functions(m)
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), 2 * m), dtype=np.uint64)
    for c in range(2 * m):
        key = np.full(len(sets), c, dtype=np.uint64)
        for r in range(c * ROWS, (c + 1) * ROWS):
            key = _mix(key + np.minimum.reduceat(flat * mul[r] + add[r], starts))
        out[:, c] = key
    return out.view(np.int64)


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Bit b tells whether an odd number of elements hash to b. The sketches of
    two sets differ in no more bits than the sets differ in elements."""
    odd = np.bincount((s * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 9)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    def rows(ids, sets):
        full = [s for s in sets if len(s)]
        keys = iter(half_keys(full, m)) if full else iter(())
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
            pa.array([parity_sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
            names=["id", "n_shingles", "sid", "halves", "odd"])

    for batch in batches:
        texts, ids, sets, size = batch.column(1), [], [], 0
        for d in range(len(batch)):
            s = shingle_set((texts[d].as_py() or "").encode(), k)
            ids.append(batch.column(0)[d].as_py())
            sets.append(s)
            size += len(s)
            if size >= CHUNK:
                yield rows(ids, sets)
                ids, sets, size = [], [], 0
        if ids:
            yield rows(ids, sets)


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ``2 ** BLOOM`` bits over a column ``low``: the words of
    the bit array with a bit set reach the driver, 8 MB at most for any input."""
    at = F.explode(F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(100 + i), "low"), 64 - BLOOM) for i in range(2)])).alias("at")
    bits = ids.select(at).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    got = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BLOOM - 6), dtype=np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out


def _maybe(batch: pa.RecordBatch, bits: np.ndarray) -> np.ndarray:
    """Rows whose two bits are set (a null id hashes like any value)."""
    ok = np.ones(len(batch), dtype=bool)
    for c in (1, 2):
        at = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        ok &= (bits[at >> 6] >> (at & 63)) & 1 != 0
    return np.flatnonzero(ok)


def _sets(batches: Iterator[pa.RecordBatch], k: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sids, sets, size = [], [], 0
        for d in _maybe(batch, bits):
            s = shingle_set((batch.column(0)[int(d)].as_py() or "").encode(), k)
            if not len(s):
                continue
            sids.append(xxhash.xxh3_128_digest(s.tobytes()))
            sets.append(s.view(np.int64))
            size += len(s)
            if size >= CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "set"])
                sids, sets, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "set"])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of the nodes of an edge table (a, b): root is the smallest
    node reachable. Smallest labels of neighbours, then labels of labels."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.keep(both, "edges")
    lab = scratch.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "label")
    while True:
        near = both.join(lab.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("r"))
        step = lab.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "r").alias("root"))
        jump = lab.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = step.join(jump, "root", "left").select("node", "old", F.least("root", "far").alias("root"))
        new = scratch.keep(new, "label")
        moved = not new.filter("root <> old").isEmpty()
        scratch.drop(lab)
        lab = new
        if not moved:
            scratch.drop(both)
            return lab.select("node", "root")


def slices(m: int) -> list[range]:
    """Collections of the first family whose tables are taken first, with one row per
    component in a bucket; all tables follow."""
    cuts = [c for c in (0, 1, 4) if c <= m]
    return [range(a, b) for a, b in zip(cuts, cuts[1:])]


def _shared_halves(nodes: DataFrame, m: int, scratch: Scratch) -> DataFrame:
    """(nid, x, y, w): the collection keys of both families that other nodes have
    too, and how many nodes have them in all, for nodes with both kinds."""
    half = scratch.keep(nodes.select("nid", F.posexplode("halves").alias("c", "h")), "halves")
    again = scratch.keep(half.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-halves")
    per = half.join(again, "h").groupBy("nid").agg(
        F.collect_list(F.when(F.col("c") < m, F.struct("c", "h"))).alias("x"), F.collect_list(F.when(F.col("c") >= m, F.col("h"))).alias("y"),
        F.sum("n").alias("w")).filter((F.size("x") > 0) & (F.size("y") > 0))
    out = scratch.keep(per, "candidates")
    scratch.drop(half, again)
    return out


def _connect(nodes: DataFrame, docs: DataFrame, k: int, m: int, percent: int, scratch: Scratch) -> DataFrame:
    """(nid, root) of the nodes that share a bucket with another one.

    First some slices of the tables (collections of the first family with all of the second) are gone
    through with one row per component in a bucket, and components are contracted after each. Then all
    tables follow with all members, but for the buckets that lie in one component by then: these are
    told from aggregates and enter no join.
    """
    odd = [f"o{k}" for k in range(SKETCH)]
    info = nodes.select("nid", "sid", "low", F.col("n_shingles").alias("size"), *[F.col("odd")[k].alias(o) for k, o in enumerate(odd)])
    info = scratch.keep(info.join(_shared_halves(nodes, m, scratch), "nid"), "info")
    # the candidates' texts are read again and not shuffled: a filter of fixed size tells most others
    # apart, the join on the set's hash below does the rest
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(info.select("low")))
    at = [F.shiftrightunsigned(F.xxhash64(F.lit(100 + i), "id"), 64 - BLOOM).alias(f"b{i}") for i in range(2)]
    found = docs.select("t", *at).mapInArrow(lambda it: _sets(it, k, bits.value), "sid binary, set array<bigint>")
    sets = found.join(info.select("sid", "nid"), "sid").select("nid", "set").dropDuplicates(["nid"])
    sets = scratch.keep(sets, "sets")
    comp = scratch.keep(info.select("nid", F.col("nid").alias("root")), "roots")
    for part in slices(m):
        keyed = _keyed(_halves(info, comp, part, odd), odd)
        heavy = keyed.groupBy("key", "root").agg(F.max(F.struct("w", "nid", "size", *odd)).alias("r"))
        heavy = scratch.keep(heavy.select("key", "root", "r.*"), f"heaviest-{part.start}")
        apart = heavy.groupBy("key").agg(F.max(F.struct("w", "nid", "size", "root", *odd)).alias("l"), F.min("root").alias("a"), F.max("root").alias("z"))
        comp = _link(heavy, _leaders(apart.filter("a <> z"), odd), comp, sets, odd, percent, scratch)[0]
    # what shares a half of the first family is compared as a whole where few lie outside its largest
    # component: a member then has m rows, not one per table; the tables of the other halves follow
    halves = scratch.keep(_halves(info, comp, range(m), odd), "open-halves")
    parts = halves.groupBy("x", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("x").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"))
    parts = scratch.keep(parts.select("x", F.col("top.root").alias("main"), (F.col("all") * (F.col("all") - F.col("top.n"))).alias("work")), "half-sizes")
    small = halves.join(parts.filter(F.col("work") <= HALF_WORK).select("x", "main"), "x")
    small = scratch.keep(small.withColumnRenamed("x", "key"), "small-halves")
    least = scratch.keep(_leaders(small.filter("root <> main").select("key", F.struct("w", "nid", "size", "root", *odd).alias("l")), odd), "outsiders")
    comp, to = _link(small, least, comp, sets, odd, percent, scratch)
    large = halves.join(parts.filter(F.col("work") > HALF_WORK).select("x"), "x", "left_semi")
    if to is not None:
        large = large.join(to, "root", "left").withColumn("root", F.coalesce("to", "root"))
    keyed = scratch.keep(_keyed(large, odd), "tables")
    scratch.drop(small, least)
    # buckets in more than one component, each set of members once
    size = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("nid").alias("a"), F.max("nid").alias("z"), F.min("root").alias("ra"),
                                    F.max("root").alias("rz"), F.sum(F.xxhash64("nid").cast("decimal(38,0)")).alias("s")).filter("ra <> rz")
    open_ = size.groupBy("n", "a", "z", "s").agg(F.min("key").alias("key")).select("key")
    now = scratch.keep(keyed.join(open_, "key", "left_semi"), "open")
    scratch.drop(keyed)
    # where few members lie outside the largest component, these meet all others, and the bucket is finished
    parts = scratch.keep(now.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")), "parts")
    most = parts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"))
    few = F.col("all") - F.col("top.n") <= MINORITY
    least = now.join(most.filter(few).select("key", F.col("top.root").alias("main")), "key").filter("root <> main")
    least = scratch.keep(_leaders(least.select("key", F.struct("w", "nid", "size", "root", *odd).alias("l")), odd), "minority")
    comp, to = _link(now, least, comp, sets, odd, percent, scratch)
    rest = parts.join(most.filter(~few).select("key"), "key", "left_semi")
    if to is not None:
        rest = rest.join(to, "root", "left").withColumn("root", F.coalesce("to", "root"))
    still = rest.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("z")).filter("a <> z").select("key")
    rest = now.join(still, "key", "left_semi")
    if to is not None:
        rest = rest.join(to, "root", "left").withColumn("root", F.coalesce("to", "root")).select(*now.columns)
    rest = scratch.keep(rest, "large")
    scratch.drop(now, parts, least)
    return _waves(rest, comp, sets, odd, percent, scratch)


def _halves(info: DataFrame, comp: DataFrame, part: range, odd: list[str]) -> DataFrame:
    """(x, y, nid, root, ...) of the collections ``part`` where the half key x lies in
    more than one component."""
    mine = F.filter("x", lambda x: (x["c"] >= part.start) & (x["c"] < part.stop))
    taken = info.select("nid", "w", "size", *odd, mine.alias("x"), "y").filter(F.size("x") > 0).join(comp, "nid")
    taken = taken.select("nid", "root", "w", "size", *odd, "y", F.explode("x.h").alias("x"))
    apart = taken.groupBy("x").agg(F.min("root").alias("a"), F.max("root").alias("z")).filter("a <> z").select("x")
    return taken.join(apart, "x", "left_semi")


def _keyed(halves: DataFrame, odd: list[str]) -> DataFrame:
    """(key, nid, root, ...): the tables of the halves."""
    row = ["nid", "root", "w", "size", *odd]
    return halves.select(*row, "x", F.explode("y").alias("y")).select(F.xxhash64("x", "y").alias("key"), *row)


def _leaders(best: DataFrame, odd: list[str]) -> DataFrame:
    """(key, lead, ...) from structs ``l``."""
    return best.select("key", F.col("l.nid").alias("lead"), F.col("l.size").alias("lsize"), F.col("l.root").alias("lroot"),
                       *[F.col(f"l.{o}").alias(f"l{o}") for o in odd])


def _link(members: DataFrame, leaders: DataFrame, comp: DataFrame, sets: DataFrame, odd: list[str], percent: int,
          scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """``comp`` after members of other components were compared with the leaders of
    their buckets, and (root, to) of the components that were joined, if any."""
    # no link is possible where the sizes differ too much, nor where more elements differ than
    # (100 - p) / (100 + p) of both sizes; the sketches give a lower bound of the differing elements
    differ = sum((F.bit_count(F.col(o).bitwiseXOR(F.col(f"l{o}"))) for o in odd[1:]), F.bit_count(F.col(odd[0]).bitwiseXOR(F.col(f"l{odd[0]}"))))
    close = (F.least("size", "lsize") * 100 >= F.greatest("size", "lsize") * percent) & (
        differ * (100 + percent) <= (F.col("size") + F.col("lsize")) * (100 - percent))
    ask = members.join(leaders, "key").filter((F.col("root") != F.col("lroot")) & close)
    ask = scratch.keep(ask.select(F.least("nid", "lead").alias("a"), F.greatest("nid", "lead").alias("b")).distinct(), "ask")
    left = ask.join(sets.select(F.col("nid").alias("a"), F.col("set").alias("sa")), "a")
    full = left.join(sets.select(F.col("nid").alias("b"), F.col("set").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    link = both * 100 >= (F.size("sa") + F.size("sb") - both) * percent
    links = scratch.keep(full.filter(link).select("a", "b"), "links")
    if links.isEmpty():
        return comp, None
    of = lambda c: comp.select(F.col("nid").alias(c), F.col("root").alias(f"r{c}"))
    up = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
    to = components(up, scratch).withColumnRenamed("root", "to").withColumnRenamed("node", "root")
    return scratch.keep(comp.join(to, "root", "left").select("nid", F.coalesce("to", "root").alias("root")), "roots"), to


def _waves(now: DataFrame, comp: DataFrame, sets: DataFrame, odd: list[str], percent: int, scratch: Scratch) -> DataFrame:
    """``comp`` after all pairs in the buckets ``now`` that no chain of links connects have been compared."""
    leaders, wave = 1, 0
    while not now.isEmpty():
        # the heaviest member of each of the classes of a bucket leads
        cls = F.pmod(F.xxhash64("nid", F.lit(wave)), F.lit(leaders))
        top = now.groupBy("key", cls.alias("c")).agg(F.max(F.struct("w", "nid", "size", "root", *odd)).alias("l"))
        top = scratch.keep(_leaders(top, odd), f"lead-{wave}")
        comp, to = _link(now, top, comp, sets, odd, percent, scratch)
        # a leader has met all others of its bucket and retires; buckets whose other members now lie in
        # one component are finished, and their rows go no further
        others = now.select("key", "root", F.lit(1).alias("c")).unionAll(top.select("key", "lroot", F.lit(-1)))
        pairs = others.groupBy("key", "root").agg(F.sum("c").alias("c")).filter("c > 0").select("key", "root")
        if to is not None:
            pairs = pairs.join(to, "root", "left").select("key", F.coalesce("to", "root").alias("root"))
        left_open = pairs.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("z")).filter("a <> z").select("key")
        rest = now.join(left_open, "key", "left_semi").join(top.select("key", F.col("lead").alias("nid")), ["key", "nid"], "left_anti")
        if to is not None:
            rest = rest.join(to, "root", "left").withColumn("root", F.coalesce("to", "root")).select(*now.columns)
        rest = scratch.keep(rest, f"open-{wave}")
        scratch.drop(now, top)
        now, leaders, wave = rest, leaders * (256 if wave else 16), wave + 1
    return comp


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Links join rows with 100 * intersection >= percent * union of their shingle
    sets; ``component_id`` is the smallest id reachable. A text with fewer than
    ``shingle`` words is one shingle; without words (or null) the set is empty
    and the row is linked with nothing and stays. Repeated rows have equal
    sets and share a component; all rows whose id is the component's are
    kept. A null id never names a component unless all of its ids are null.
    Ids must be integers. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "near")
    m = collections_for(percent)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    signed = scratch.keep(src.mapInArrow(lambda it: _sign(it, shingle, m), SIGNED), "signed")
    nodes = signed.filter("sid is not null").groupBy("sid").agg(
        F.min("id").alias("low"), F.max("n_shingles").alias("n_shingles"), F.min("halves").alias("halves"), F.min("odd").alias("odd"))
    nodes = scratch.keep(with_row_id(nodes, "nid"), "nodes")
    root = _connect(nodes, src, shingle, m, percent, scratch)
    placed = nodes.select("nid", "sid", "low").join(root, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    placed = scratch.keep(placed, "placed")
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    by_set = scratch.keep(placed.join(lowest, "root").select("sid", "component_id"), "classes")
    out = signed.select("id", "n_shingles", "sid").join(by_set, "sid", "left")
    comp: Column = F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", comp.alias("component_id"), F.col("id").eqNullSafe(comp).alias("kept"))


def near_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one stays of each
    near-duplicate class: the one with the smallest id (null last), of repeated
    rows any one. Rows without words all stay."""
    scratch = Scratch(docs.sparkSession, "near-rows")
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = scratch.keep(with_row_id(docs.toDF(*names)), "rows")
    t, i = names[docs.columns.index(text_col)], names[docs.columns.index(id_col)]
    classes = near_duplicates(rows.select("rid", F.col(t).alias("text")), "text", "rid", shingle, percent)
    first = F.min(F.struct(F.col(i).isNull().alias("z"), F.col(i).alias("i"), "rid")).alias("f")
    stays = classes.join(rows.select("rid", i), "rid").groupBy("component_id").agg(first).select(F.col("f.rid").alias("rid"))
    return rows.join(stays, "rid", "left_semi").select(*names).toDF(*docs.columns)
