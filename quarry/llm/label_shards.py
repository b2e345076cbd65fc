"""Balanced label propagation into shards (operator 4, DataFrame only).

Linked documents (equal texts, or equal values of a link column) start on
hashed shards. In each round a join with the bytes per (group, shard) gives
every document the shard that holds most of its group; documents move there
in a seeded order as far as the shard's free capacity reaches, so a group
larger than a shard fills one shard after the other. Groups of at most half a
shard that are still split after the rounds are gathered into one unit each.
These and the documents without a link then level the shards: size class by size class, from large to small,
each class is dealt out so that the totals come out even.

The driver holds tables of shards and of (shard, size class) only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, running_totals, text_of, with_row_id

ROUNDS = 12
SLACK = 1.25


def water_level(loads: list[int], mass: int) -> list[float]:
    """How much of ``mass`` each shard gets so that the lowest ones rise to
    one level."""
    order = sorted(range(len(loads)), key=lambda s: loads[s])
    give = [0.0] * len(loads)
    left, level, n = float(mass), float(loads[order[0]]), 0
    for k, s in enumerate(order):
        n = k + 1
        top = loads[order[n]] if n < len(order) else float("inf")
        if (top - level) * n >= left:
            level += left / n
            break
        left -= (top - level) * n
        level = float(top)
    for s in order[:n]:
        give[s] = max(0.0, level - loads[s])
    return give


def _propagate(linked: DataFrame, shards: int, capacity: float, rounds: int, scratch: Scratch) -> DataFrame:
    """(rid, g, size, shard) after label propagation.

    Members of a group that fits in half a shard may fill shards up to ``SLACK``
    times the capacity, which the dealing afterwards takes back; those of a
    larger group fill them up to the capacity.
    """
    cur = linked.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int"))
    here = F.struct("b", "tie", "shard")
    # groups in a seeded order, the members of one group in 256 parts
    part = F.pmod(F.xxhash64(F.lit(1), "g"), F.lit(1024)) * 256 + F.pmod(F.xxhash64(F.lit(2), "rid"), F.lit(256))
    for k in range(rounds):
        hist = scratch.keep(cur.groupBy("g", "shard").agg(F.sum("size").alias("b")), f"hist-{k}")
        loads = {r["shard"]: r["b"] for r in hist.groupBy("shard").agg(F.sum("b").alias("b")).collect()}
        room = {False: {s: SLACK * capacity - loads.get(s, 0) for s in range(shards)}, True: {s: capacity - loads.get(s, 0) for s in range(shards)}}
        # a part of a large group is about 1/32 of a shard at most: with less room than that a shard counts as full
        open_ = {big: [s for s, x in free.items() if x > capacity / 32] or [-1] for big, free in room.items()}
        marked = hist.withColumn("tie", F.xxhash64("g", "shard"))
        best = marked.groupBy("g").agg(F.sum("b").alias("all"), *[
            F.max(F.when(F.col("shard").isin(open_[big]), here)).alias(f"t{int(big)}") for big in (False, True)])
        best = best.withColumn("big", F.col("all") > capacity / 2).withColumn("t", F.when(F.col("big"), F.col("t1")).otherwise(F.col("t0")))
        # a group that fits leaves full shards too; a larger one stays where most of it is
        goes = (F.col("shard") != F.col("t.shard")) & (~F.col("big") | (here < F.col("t")))
        moves = marked.join(best, "g").filter(goes).select("g", "shard", "big", F.col("t.shard").alias("target"))
        asked = scratch.keep(cur.join(moves, ["g", "shard"], "left").withColumn("part", part).select(
            "rid", "g", "size", "shard", "big", "target", "part"), f"asked-{k}")
        sums = asked.filter("target is not null").groupBy("target", "big", "part").agg(F.sum("size").alias("b"))
        cum = sums.withColumn("cum", F.sum("b").over(Window.partitionBy("target", "big").orderBy("part")))
        wanted = {r["target"]: r["b"] for r in sums.filter("big").groupBy("target").agg(F.sum("b").alias("b")).collect()}
        limit = {(s, True): x for s, x in room[True].items()}
        limit |= {(s, False): x - max(0, min(wanted.get(s, 0), room[True][s])) for s, x in room[False].items()}
        key = F.col("target") * 2 + F.col("big").cast("int")
        fits = F.element_at(F.create_map(*[F.lit(x) for (s, big), f in limit.items() for x in (2 * s + big, float(f))]), key)
        upto = {r["k"]: r["p"] for r in cum.filter(F.col("cum") <= fits).groupBy(key.alias("k")).agg(F.max("part").alias("p")).collect()}
        scratch.drop(hist)
        if not upto:
            return asked.select("rid", "g", "size", "shard")
        last = F.element_at(F.create_map(*[F.lit(x) for k2, p in upto.items() for x in (k2, int(p))]), key)
        moved = key.isin(list(upto)) & (F.col("part") <= last)
        cur = asked.select("rid", "g", "size", F.when(moved, F.col("target")).otherwise(F.col("shard")).alias("shard"))
    return cur


def _level(single: DataFrame, loads: list[int], rows: int, scratch: Scratch) -> DataFrame:
    """(rid, shard) of the documents without a link."""
    cls = F.floor(F.log2(F.col("size"))).cast("int")
    order = single.select("rid", "size", cls.alias("cls"), F.xxhash64(F.lit(3), "rid").alias("u"))
    order = scratch.keep(running_totals(order, ["cls"], "u", {"cum": "size"}, rows).withColumn(
        "mid", F.col("cum") + F.col("size") / 2).select("rid", "size", "cls", "mid"), "single")
    mass = {r["cls"]: r["b"] for r in order.groupBy("cls").agg(F.sum("size").alias("b")).collect()}
    loads, cuts = list(loads), {}
    for c in sorted(mass, reverse=True):
        give, total, at = water_level(loads, mass[c]), 0.0, []
        for x in give[:-1]:
            total += x
            at.append(total)
        cuts[c] = at
        shard = F.size(F.filter(F.array(*[F.lit(x) for x in at]), lambda t: t <= F.col("mid")))
        for r in order.filter(F.col("cls") == c).groupBy(shard.alias("s")).agg(F.sum("size").alias("b")).collect():
            loads[r["s"]] += r["b"]
    spark = single.sparkSession
    table = spark.createDataFrame([(c, at) for c, at in cuts.items()], "cls int, at array<double>")
    return order.join(F.broadcast(table), "cls").select(  # at most one row per power of two of a size
        "rid", F.size(F.filter("at", lambda t: t <= F.col("mid"))).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 24, text_col: str = "text", id_col: str = "doc_id",
                    link_col: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 8 (null: 8), the law is
    ``bytes``: sizes per shard come out near equal. Rows with equal texts
    (or equal non-null ``link_col``) are linked; null texts count as equal
    empty texts. ``slot`` numbers the rows of a shard from 0 without gaps.
    Repeated rows and repeated or null ids are rows of their own. An empty
    table gives an empty result. ``grown_shard`` is null under this law.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    raw = F.encode(text_of("t"), "UTF-8")
    link = F.unhex(F.sha2(raw, 256)) if link_col is None else F.col("link")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                      *([] if link_col is None else [F.unhex(F.sha2(F.col(link_col).cast("string").cast("binary"), 256)).alias("link")]))
    base = scratch.keep(with_row_id(src.select(
        "id", (F.octet_length(raw) + 8).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"), link.alias("g"))), "base")
    rows, total = base.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()

    shared = scratch.keep(base.filter("g is not null").groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "g", F.lit(True).alias("linked")), "groups")
    split = scratch.keep(base.select("rid", "g", "size").join(shared, "g", "left"), "split")
    linked = split.filter("linked").select("rid", "g", "size")
    capacity = total / shards
    linked = scratch.keep(_propagate(linked, shards, capacity, rounds, scratch).select("rid", "g", "size", "shard"), "linked")
    loads = {r["shard"]: r["b"] for r in linked.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    sand = split.filter("linked is null").select("rid", "size")
    group = linked.groupBy("g").agg(F.sum("size").alias("b"), F.min("shard").alias("s"), F.max("shard").alias("z"), F.min("rid").alias("unit"))
    group = scratch.keep(group.withColumns({"small": F.col("b") <= capacity / 2, "torn": (F.col("b") <= capacity / 2) & (F.col("s") != F.col("z"))}), "group")
    # small groups that are still split leave all their shards and are dealt out as one unit
    torn = group.filter("torn").select("g", F.col("unit").alias("rid"), F.col("b").alias("size"))
    left = linked.join(torn.select("g"), "g").groupBy("shard").agg(F.sum("size").alias("b")).collect()
    for r in left:
        loads[r["shard"]] -= r["b"]
    sand = sand.unionByName(torn.select("rid", "size"))
    out = torn.select("rid", "size")
    over = {s: b - capacity for s, b in loads.items() if b > capacity}
    if over:
        # whole groups leave a shard that is too full, then rows of groups that are larger than half a
        # shard; they are dealt out like single rows
        half = F.shiftright(F.xxhash64("rid"), 1)
        units = group.filter("small and not torn").select("s", F.col("unit").alias("rid"), F.col("b").alias("size")).withColumn("u", half - F.lit(2**62))
        parts = linked.join(group.filter("not small").select("g"), "g").select(F.col("shard").alias("s"), "rid", "size").withColumn("u", half + F.lit(2**62))
        excess = F.create_map(*[F.lit(x) for s, b in over.items() for x in (s, float(b))])
        extra = units.unionByName(parts).filter(F.col("s").isin(list(over)))
        extra = running_totals(extra, ["s"], "u", {"cum": "size"}, rows).filter(F.col("cum") < F.element_at(excess, F.col("s")))
        extra = scratch.keep(extra.select("s", "rid", "size"), "out")
        for r in extra.groupBy("s").agg(F.sum("size").alias("b")).collect():
            loads[r["s"]] -= r["b"]
        sand = sand.unionByName(extra.select("rid", "size"))
        out = out.unionByName(extra.select("rid", "size"))
    single = _level(sand, [loads.get(s, 0) for s in range(shards)], rows, scratch)
    if over or left:
        single = scratch.keep(single, "dealt")
        follow = linked.join(group.filter("small").select("g", "unit"), "g", "left").select("rid", "shard", F.coalesce("unit", "rid").alias("unit"))
        dealt = single.select(F.col("rid").alias("unit"), F.col("shard").alias("to"))
        linked = follow.join(dealt, "unit", "left").select("rid", F.coalesce("to", "shard").alias("shard"))
        single = single.join(out.select("rid"), "rid", "left_anti")
    placed = linked.select("rid", "shard").unionByName(single)
    placed = placed.withColumns({"one": F.lit(1).cast("bigint"), "u": F.xxhash64("rid")})
    placed = running_totals(placed, ["shard"], "u", {"slot": "one"}, -(-rows // shards)).select("rid", "shard", "slot")
    out = base.join(placed, "rid")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))
