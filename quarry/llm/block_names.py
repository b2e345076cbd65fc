"""Exact deduplication by deterministic block naming (operator 1, DataFrame only).

The normalised text is cut into blocks of fixed size. The distinct blocks
are sorted and get integer names; then adjacent names are paired and each
distinct pair gets a name again, until one name is left per document. Two
documents have the same (level, name) exactly when their texts are equal.

The block contents are shuffled once, for the sorted naming, after a
partial distinct per task. Documents find their blocks' names by a 128-bit
key; the naming pass counts the distinct contents behind each key and
starts over with another seed should two contents share one, so a name
never covers two contents. Every other shuffle holds integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, Scratch, text_of, with_row_id

BLOCK_BYTES = 4096


def wide_key(block: Column, seed: int) -> list[Column]:
    """Two 64-bit hashes of a block."""
    return [F.xxhash64(F.lit(2 * seed), block).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2")]


def _blocks(norm: Column, size: int) -> Column:
    b = F.encode(norm, "UTF-8")
    last = F.floor(F.greatest(F.octet_length(b) - 1, F.lit(0)) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(b, i * size + 1, F.lit(size)))


def name_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES,
                   key=wide_key, scratch: Scratch | None = None) -> DataFrame:
    """(rid, id, n_chars, text_sha256, level, name) per row of ``docs``.

    Null text counts as empty; an empty text is one empty block. Ids may be
    null or repeated: rows are told apart by ``rid``. Other columns of
    ``docs`` are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "names")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    norm = F.regexp_replace(text_of("t"), BLANK, "")

    for seed in range(64):
        meta = src.select("id", F.char_length(text_of("t")).alias("n_chars"), norm.alias("n"))
        meta = meta.select("id", "n_chars", F.sha2("n", 256).alias("text_sha256"), _blocks(F.col("n"), block_bytes).alias("b"))
        meta = meta.select("id", "n_chars", "text_sha256", F.size("b").alias("n"),
                           F.transform("b", lambda x: F.struct(*key(x, seed))).alias("keys"))
        meta = scratch.keep(with_row_id(meta), "meta")
        blocks = src.select(norm.alias("n")).select(F.explode(_blocks(F.col("n"), block_bytes)).alias("block"))
        named = blocks.select(*key(F.col("block"), seed), "block").distinct().sortWithinPartitions("block")
        names = scratch.keep(named.select("h1", "h2", F.monotonically_increasing_id().alias("name")), "names-0")
        if names.groupBy("h1", "h2").count().filter("count > 1").isEmpty():
            break
        scratch.drop(meta, names)
    else:
        raise RuntimeError("no seed gave the blocks distinct keys")

    at = meta.select("rid", "n", F.posexplode("keys").alias("pos", "k"))
    at = at.select("rid", "n", "pos", "k.h1", "k.h2").join(names, ["h1", "h2"]).select("rid", "n", "pos", "name")
    longest = meta.agg(F.max("n")).first()[0] or 1
    cur = scratch.keep(at, "at-0")
    done = [cur.filter("n = 1").select("rid", F.lit(0).alias("level"), "name")]
    level = 0
    while longest > 1:
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = cur.filter("n > 1").groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("p")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = scratch.keep(pairs, f"pairs-{level}")
        names = pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
        names = scratch.keep(names.withColumn("name", F.monotonically_increasing_id()), f"names-{level}")
        up = pairs.join(names, ["a", "b"]).select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("p").alias("pos"), "name")
        cur = scratch.keep(up, f"at-{level}")
        done.append(cur.filter("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        scratch.drop(pairs, names)
        longest = -(-longest // 2)
    named = done[0]
    for d in done[1:]:
        named = named.unionByName(d)
    return meta.select("rid", "id", "n_chars", "text_sha256").join(named, "rid")


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES,
                key=wide_key) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting space and 0x09-0x0D; null
    is empty, and all empty texts are equal. Of equal texts the row with the
    most code points stays, then the smallest id (null last), then, for
    repeated rows, one of them. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "dedup")
    named = scratch.keep(name_documents(docs, text_col, id_col, block_bytes, key, scratch), "named")
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("id").isNull().alias("z"), "id", "rid")).alias("k")
    groups = scratch.keep(named.groupBy("level", "name").agg(best, F.count(F.lit(1)).alias("group_size")), "groups")
    out = named.join(groups, ["level", "name"])
    return out.select(F.col("id").alias(id_col), F.col("k.id").alias("keep_id"), "group_size",
                      (F.col("rid") == F.col("k.rid")).alias("kept"), "text_sha256")
