"""Merkle manifest of a dataset by checkpoint and recompute (operator 12).

Leaves are sorted per language; 8 consecutive nodes have a common parent.
Only every ``every``-th level is written. The levels between are regenerated,
one aligned subtree (8 ** every stored nodes at most) at a time: once on the
way up to hash them into the next stored level, and again when proofs are
taken, where they give the siblings and are discarded. Proofs are
handed down from the root, so a stored node carries the siblings above it
once for all leaves below.

A node's place is its exact rank among the nodes of its tree: a range sort on
a total order, places inside the ranges, and offsets per (range, tree). So a
language with a third of the rows spreads over the ranges like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UP = "grp string, i bigint, m bigint, node string"
PATH = "path array<struct<left: string, right: string>>"
DIGESTS = "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PROOFS = f"id bigint, leaf string, subroot string, root string, {PATH}"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def regrow(nodes: list[str], count: int, every: int) -> list[list[str]]:
    """The levels of an aligned subtree above ``nodes``, at most ``every``, none
    above the level where the whole tree (``count`` nodes wide) ends."""
    levels = [nodes]
    while len(levels) <= every and count > 1:
        below = levels[-1]
        levels.append([digest("".join(below[a:a + FAN])) for a in range(0, len(below), FAN)])
        count = -(-count // FAN)
    return levels


def path_of(levels: list[list[str]], place: int) -> list[dict[str, str]]:
    """Siblings to the left and right, level by level, of a node of the lowest level."""
    out = []
    for level in levels[:-1]:
        run = place // FAN * FAN
        out.append({"left": "".join(level[run:place]), "right": "".join(level[place + 1:run + FAN])})
        place //= FAN
    return out


def fold(node: str, path: list[dict[str, str]]) -> str:
    for step in path:
        node = digest(step["left"] + node + step["right"])
    return node


def _field(value: Column) -> Column:
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row of documents; ``changed`` replaces columns."""
    return F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def lowered(text: Column) -> Column:
    """A-Z lower-cased."""
    return F.translate(text, UPPER, UPPER.lower())


def _ranked(df: DataFrame, order: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """``df`` with i, the place within ``grp`` by (grp, order) from 0, and m, the rows of ``grp``."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("grp"), *order]
    # the id counts on along the sorted rows of a range; written, it is fixed
    rows = df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    rows = scratch.keep(rows, name).withColumn("range", F.shiftright("at", 33))
    runs = rows.groupBy("range", "grp").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("c"))
    # a row per range and one per tree
    before = Window.partitionBy("grp").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("range", "grp", "start", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("ahead"),
                       F.sum("c").over(Window.partitionBy("grp")).alias("m"))
    return rows.join(runs, ["range", "grp"]).withColumn("i", F.col("at") - F.col("start") + F.col("ahead")).drop("range", "at", "start", "ahead")


def _subtrees(nodes: DataFrame, every: int, *more: str) -> DataFrame:
    """(grp, p, m, nodes, ...): the stored nodes of each aligned subtree, in order."""
    span = FAN**every
    rows = F.sort_array(F.collect_list(F.struct("i", "node", *more))).alias("x")
    packed = nodes.groupBy("grp", F.floor(F.col("i") / span).alias("p")).agg(F.min("m").alias("m"), rows)
    return packed.select("grp", "p", "m", F.col("x.node").alias("nodes"), *[F.col(f"x.{c}").alias(c) for c in more])


def _tops(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grp, p, m, nodes = (batch.column(c) for c in ("grp", "p", "m", "nodes"))
        top, width = [], []
        for r in range(len(batch)):
            count = m[r].as_py()
            levels = regrow(nodes[r].as_py(), count, every)
            top.append(levels[-1][0])
            width.append(-(-count // FAN ** (len(levels) - 1)))
        yield pa.RecordBatch.from_arrays([grp, p, pa.array(width, pa.int64()), pa.array(top, pa.string())], names=["grp", "i", "m", "node"])


def _climb(packed: DataFrame, every: int, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels above the written subtrees ``packed``, and (grp, node) of the roots."""
    packs = [packed]
    while True:
        nodes = packs[-1].mapInArrow(lambda it: _tops(it, every), UP)
        if packs[-1].filter(F.col("m") > FAN**every).isEmpty():
            return packs, scratch.keep(nodes.select("grp", "node"), f"{name}-roots")
        packs.append(scratch.keep(_subtrees(nodes, every), f"{name}-level-{every * len(packs)}"))


def _hand_down(batches: Iterator[pa.RecordBatch], every: int, names: bool) -> Iterator[pa.RecordBatch]:
    """Per stored node of a subtree: its place (or its row of ``name``) and the siblings from it to the root."""
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    for batch in batches:
        for r in range(len(batch)):
            row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
            levels = regrow(row["nodes"], row["m"], every)
            paths = [path_of(levels, j) + row["path"] for j in range(len(row["nodes"]))]
            n = len(paths)
            grp = row["name"] if names else [row["grp"]] * n
            at = [0] * n if names else [row["p"] * FAN**every + j for j in range(n)]
            sub = row["nodes"] if names else [row["subroot"]] * n
            yield pa.RecordBatch.from_arrays([pa.array(grp, pa.string()), pa.array(at, pa.int64()), pa.array(sub, pa.string()), pa.array(paths, kind)],
                                             names=["grp", "i", "subroot", "path"])


def _descend(packs: list[DataFrame], above: DataFrame, every: int, scratch: Scratch) -> DataFrame:
    """The lowest subtrees, each with the siblings above it. ``above``: (grp, i = 0, subroot, path)."""
    for pack in reversed(packs[1:]):
        rows = pack.join(above.withColumnRenamed("i", "p"), ["grp", "p"])
        above = scratch.keep(rows.mapInArrow(lambda it: _hand_down(it, every, False), f"grp string, i bigint, subroot string, {PATH}"), "paths")
    return packs[0].join(above.withColumnRenamed("i", "p"), ["grp", "p"])


def _proofs(batches: Iterator[pa.RecordBatch], every: int, root: str, digests: bool) -> Iterator[pa.RecordBatch]:
    def rows(row):
        levels = regrow(row["nodes"], row["m"], every)
        for j, (i, leaf, seen) in enumerate(zip(row["id"], row["nodes"], row["seen"])):
            path = path_of(levels, j) + row["path"]
            out = {"id": i, "leaf": leaf, "subroot": row["subroot"], "root": root}
            if digests:
                folded = fold(seen or leaf, path)
                yield out | {"proof_sha256": digest("".join(s["left"] + s["right"] for s in path)), "folded_root": folded, "verified": folded == root}
            else:
                yield out | {"path": path}

    kinds = [("id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root")]]
    kinds += [("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())] if digests else [
        ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))]
    for batch in batches:
        for r in range(len(batch)):
            found = list(rows({c: batch.column(c)[r].as_py() for c in batch.schema.names}))
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema(kinds))


@dataclass
class Manifest:
    """Root of a dataset, the stored levels of its trees, and the siblings above each subroot."""

    root: str | None
    every: int
    leaves: list[DataFrame]
    above: DataFrame
    scratch: Scratch

    def _leaf_rows(self, digests: bool, schema: str) -> DataFrame:
        every, root = self.every, self.root
        lowest = _descend(self.leaves, self.above, every, self.scratch)
        return lowest.mapInArrow(lambda it: _proofs(it, every, root, digests), schema)

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, root, path) per leaf: siblings left and right of the
        path, level by level. ``fold(leaf, path)`` gives the root."""
        return self._leaf_rows(False, PROOFS)

    def audit(self) -> DataFrame:
        """Digest columns per leaf: the proof's hash, and the root folded from the row
        as ``seen`` (where it was altered, else from the leaf)."""
        return self._leaf_rows(True, DIGESTS)


def build_manifest(docs: DataFrame, seen_text: Column | None = None, every: int = 2) -> Manifest:
    """The manifest of a table with the columns of documents.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text, each as
    byte count, colon and value, null as a dash. Per lang (null: one of its own,
    first) leaves ascend by doc_id, null first, repeated ids by leaf; the roots
    of the langs in byte order form the last tree. ``seen_text``, if not null, is
    the text as found later; ``audit`` folds its leaf. Repeated rows are leaves
    of their own; an empty table has no root (None) and no proofs. Other columns
    are not read.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    grp = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    seen = F.lit(None).cast("string") if seen_text is None else F.when(seen_text.isNotNull(), leaf_digest(text=seen_text))
    leaves = docs.select(grp.alias("grp"), F.col("doc_id").cast("bigint").alias("id"), leaf_digest().alias("node"), seen.alias("seen"))
    # the range sort samples its input first: written, the texts are hashed once
    leaves = scratch.keep(leaves, "digests")
    ranked = _ranked(leaves, [F.col("id").asc_nulls_first(), F.col("node")], scratch, "leaves")
    packed = scratch.keep(_subtrees(ranked, every, "id", "seen"), "level-0")
    packs, roots = _climb(packed, every, scratch, "tree")
    subroots = roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    upper = scratch.keep(_subtrees(_ranked(subroots, [F.col("name")], scratch, "subroots"), every, "name"), "subroot-level-0")
    top_packs, top = _climb(upper, every, scratch, "top")
    root = top.first()
    none = F.array().cast("array<struct<left: string, right: string>>")
    start = top.select("grp", F.lit(0).cast("bigint").alias("i"), F.lit("").alias("subroot"), none.alias("path"))
    down = _descend(top_packs, start, every, scratch)
    above = scratch.keep(down.mapInArrow(lambda it: _hand_down(it, every, True), f"grp string, i bigint, subroot string, {PATH}"), "above")
    return Manifest(root["node"] if root else None, every, packs, above, scratch)
