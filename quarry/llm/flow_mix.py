"""Mixing overlapping sources to target weights by min-cost flow (operator 2).

Documents are aggregated by membership pattern (the set of sources they
belong to). A flow network sends token capacity from patterns to source
quotas; each further copy of a pattern's tokens is an arc that costs more
than the one before, so repetition is convex in cost and a document is
repeated only where fresh text runs out. The flow through a pattern becomes
whole copies of all its documents plus a seeded selection for the rest.

The driver holds the network: one node per source and per pattern. That is
the size of the mixture's definition, not of the corpus.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, Scratch, running_totals, text_of, with_row_id


def water_fill(total: float, weights: list[float], caps: list[float]) -> list[float]:
    """Shares of ``total`` by weight; none above its cap, the excess reshared
    by weight among the others."""
    share, open_ = [0.0] * len(caps), [i for i in range(len(caps)) if weights[i] > 0]
    left = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / w >= caps[i]]
        if not over:
            for i in open_:
                share[i] = left * weights[i] / w
            break
        for i in over:
            share[i] = float(caps[i])
        left -= sum(caps[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return share


def source_targets(sources: list, sizes: list[int], weights: list[float], percent: int, max_repeat: int) -> list[float]:
    """Targets of the sources in the given order; weights repeat cyclically."""
    w = [weights[i % len(weights)] for i in range(len(sources))]
    return water_fill(sum(sizes) * percent / 100, w, [max_repeat * s for s in sizes])


def min_cost_flow(patterns: list[tuple[int, list[int]]], quotas: list[int], max_repeat: int) -> list[int]:
    """Tokens taken from each pattern (size, sources) so that the quotas are
    met as far as capacity reaches, at the least cost; the c-th copy of a token
    costs c. Successive shortest paths: copies are opened one cost at a time,
    each time a maximum flow is added with augmenting paths of that cost, which
    may redirect earlier flow between sources at no cost.
    """
    left = list(quotas)
    sent: list[dict[int, int]] = [{} for _ in patterns]
    users: dict[int, set[int]] = {}
    for _ in range(max_repeat):
        room = [size for size, _ in patterns]
        for p in sorted(range(len(patterns)), key=lambda p: (len(patterns[p][1]), p)):
            while room[p] > 0:
                # breadth-first: pattern -> its sources -> patterns that feed a source -> their sources
                back: dict[int, tuple[int, int] | None] = {}
                queue, goal, seen = deque(), None, {p}
                for s in patterns[p][1]:
                    if s not in back:
                        back[s] = None
                        queue.append(s)
                while queue:
                    s = queue.popleft()
                    if left[s] > 0:
                        goal = s
                        break
                    for q in users.get(s, ()):
                        if q in seen or sent[q].get(s, 0) <= 0:
                            continue
                        for z in patterns[q][1]:
                            if z not in back:
                                back[z] = (s, q)
                                queue.append(z)
                if goal is None:
                    break
                path, s = [], goal
                while back[s] is not None:
                    path.append((back[s][0], back[s][1], s))
                    s = back[s][0]
                amount = min([room[p], left[goal], *(sent[q][a] for a, q, _ in path)])
                for a, q, z in path:
                    sent[q][a] -= amount
                    sent[q][z] = sent[q].get(z, 0) + amount
                    users.setdefault(z, set()).add(q)
                sent[p][s] = sent[p].get(s, 0) + amount
                users.setdefault(s, set()).add(p)
                room[p] -= amount
                left[goal] -= amount
    return [sum(x.values()) for x in sent]


def _select(run: DataFrame, strata: list, rest: dict[str, int]) -> tuple[dict[tuple[str, int], int], list[int]]:
    """Word quotas of the prefixes per (pattern, class) and the single documents
    that make up ``rest`` words per pattern.

    From large classes to small, a class gets its share, by words, of what is
    still open. If more stays open than the smaller classes hold, one document
    beyond the prefix follows: the next in order, or the largest that fits.
    """
    spark = run.sparkSession
    words = {(r["pattern"], r["cls"]): r["words"] for r in strata if r["cls"] is not None}
    left, below = dict(rest), dict.fromkeys(rest, 0)
    for (p, _), w in words.items():
        below[p] += w
    quota, extra = {}, []
    for cls in sorted({c for _, c in words}, reverse=True):
        here = {p: w for (p, c), w in words.items() if c == cls}
        for p, w in here.items():
            quota[p, cls] = min(w, left[p] * w // below[p])
            below[p] -= w
        # the share is rounded up where the smaller classes could not hold the rest
        quota |= {(p, cls): min(w, max(quota[p, cls], left[p] - below[p])) for p, w in here.items()}
        part = run.filter(F.col("cls") == cls)
        plan = spark.createDataFrame([(p, quota[p, cls]) for p in here if quota[p, cls]], "pattern string, quota bigint")
        upto = F.col("cum") + F.col("size")
        got = {r["pattern"]: (r["w"], r["k"]) for r in part.join(F.broadcast(plan), "pattern").filter(upto <= F.col("quota"))
               .groupBy("pattern").agg(F.max(upto).alias("w"), F.count(F.lit(1)).alias("k")).collect()}
        for p in here:
            left[p] -= got.get(p, (0, 0))[0]
        short = [(p, got.get(p, (0, 0))[1], left[p]) for p in here if left[p] > below[p]]
        if short:
            cut = F.broadcast(spark.createDataFrame(short, "pattern string, k bigint, open bigint"))
            fits = part.join(cut, "pattern").filter((F.col("n") >= F.col("k")) & (F.col("size") <= F.col("open")))
            best = F.max(F.struct((F.col("n") == F.col("k")).alias("next"), "size", (-F.col("n")).alias("m"), "rid")).alias("b")
            for r in fits.groupBy("pattern").agg(best).collect():
                left[r["pattern"]] -= r["b"]["size"]
                extra.append(r["b"]["rid"])
    return quota, extra


def mix_sources(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    """One row per input row: id, sources, size, targets, taken, copies; see
    :func:`_mixed` for the rule and its parameters. Other columns are not read."""
    out = _mixed(docs, source_col, text_col, id_col, [], **how)
    return out.select(F.col("id").alias(id_col), "sources", "size", "targets", "taken", "copies")


def mixture(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    """The mixed corpus: each row of ``docs``, with all its columns, as often as
    the mix takes it. Rows without words have no part in it."""
    out = _mixed(docs, source_col, text_col, id_col, docs.columns, **how).filter("copies > 0")
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("_copy")
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])


def _mixed(docs: DataFrame, source_col: str, text_col: str, id_col: str, carry: list[str],
           weights: tuple[float, ...] = (3, 1, 2), percent: int = 150, max_repeat: int = 2, seed: int = 1) -> DataFrame:
    """(id, sources, size, targets, taken, copies) and the columns ``carry`` as c0, c1, ...

    ``source_col`` is one source or an array of sources; null is a source of
    its own, an empty array belongs to none. ``size`` counts the words of the
    text (null: 0). The sources, by code point with null last, have
    ``weights`` in turn and share ``percent`` of all sizes; no target exceeds
    ``max_repeat`` times its source's size. ``targets`` lists (source,
    source_size, target) of the row's sources; ``taken`` is ``copies`` times
    ``size``, with at most ``max_repeat`` copies.

    The selection is seeded by id and stratified by size class, from large
    classes to small; what a class leaves open goes to the smaller classes, and
    what these cannot hold is closed by one more document of the class. So no
    document left out fits into the gap that a pattern's selection leaves to
    its share. Repeated rows are rows of their own;
    rows with size 0 and all rows of an empty corpus take nothing.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    is_array = docs.schema[source_col].dataType.typeName() == "array"
    src: Column = F.col(source_col)
    one = F.coalesce(F.sort_array(F.array_distinct(src.cast("array<string>"))), F.array(F.lit(None).cast("string"))) if is_array \
        else F.array(src.cast("string"))
    base = docs.select(F.col(id_col).alias("id"), one.alias("sources"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("bigint").alias("size"),
                       *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)])
    base = scratch.keep(with_row_id(base.withColumn("pattern", F.to_json("sources"))), "sizes")

    cls = F.floor(F.log2("size")).cast("int")
    strata = base.groupBy("pattern", "sources", F.when(F.col("size") > 0, cls).alias("cls")).agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()  # patterns x powers of two
    names = sorted({r["pattern"] for r in strata})
    sources_of = {r["pattern"]: list(r["sources"]) for r in strata}
    size_of = {p: 0 for p in names}
    for r in strata:
        size_of[r["pattern"]] += r["words"]
    sources = sorted({s for x in sources_of.values() for s in x}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(sources)}
    sizes = [0] * len(sources)
    for p in names:
        for s in sources_of[p]:
            sizes[number[s]] += size_of[p]
    every = sum(size_of.values())
    targets = water_fill(every * percent / 100, [weights[i % len(weights)] for i in range(len(sources))], [max_repeat * s for s in sizes])
    flow = min_cost_flow([(size_of[p], [number[s] for s in sources_of[p]]) for p in names], [round(t) for t in targets], max_repeat)

    copies = {p: f // size_of[p] if size_of[p] else 0 for p, f in zip(names, flow)}
    rest = {p: f - copies[p] * size_of[p] for p, f in zip(names, flow)}
    rows = sum(r["rows"] for r in strata)
    order = base.filter("size > 0").select("rid", "pattern", "size", cls.alias("cls"), F.lit(1).cast("bigint").alias("one"),
                                           F.xxhash64(F.lit(seed), F.coalesce("id", F.col("rid"))).alias("u"))
    run = running_totals(order, ["pattern", "cls"], "u", {"cum": "size", "n": "one"}, rows)
    run = scratch.keep(run.select("rid", "pattern", "cls", "size", "cum", "n"), "order")
    quota, extra = _select(run, strata, rest)
    plan = spark.createDataFrame([(p, c, q) for (p, c), q in quota.items()], "pattern string, cls int, quota bigint")
    inside = run.join(F.broadcast(plan), ["pattern", "cls"]).filter(F.col("cum") + F.col("size") <= F.col("quota"))
    extra = spark.createDataFrame([(x,) for x in extra], "rid bigint")
    more = inside.select("rid").unionByName(extra).withColumn("more", F.lit(1))
    more = scratch.keep(more, "more")
    kind = "array<struct<source:string,source_size:bigint,target:double>>"
    shares = spark.createDataFrame(
        [(p, copies[p], [(s, sizes[number[s]], targets[number[s]]) for s in sources_of[p]]) for p in names],
        f"pattern string, whole bigint, targets {kind}")
    out = base.join(more, "rid", "left").join(F.broadcast(shares), "pattern")
    n = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("more", F.lit(0))).otherwise(0).cast("bigint")
    return out.withColumns({"taken": n * F.col("size"), "copies": n})
