"""Benchmark decontamination by suffix arrays over the training text (operator 8).

Each task turns its documents into word ids, builds suffix arrays over
shards of a bounded number of words and binary-searches every suffix of the
benchmark items in them. A suffix that reaches the window length gives all
its places; neighbouring places on one diagonal give the longest verbatim
match. Suffixes that start in a stretch of words shorter than any window, once words
outside the benchmark are taken out, cannot match and are left out of the
arrays.

No shuffle: documents stay in their task. The benchmark is the stated query
set; it reaches the tasks in blocks of at most ``block_bytes`` of text, each
searched over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1_000_000
#: Python stages chained in one Spark stage before the rows are written
CHAIN = 4

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = ("id bigint, t string, n_words bigint, spans array<struct<start:bigint,stop:bigint>>, "
          "items array<string>, longest bigint")


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of 0-9, a-z and everything beyond ASCII."""
    return text.translate(_KEEP).split()


@dataclass
class Block:
    """Benchmark items as word ids: ``seq`` holds all items, a suffix starts
    at ``start`` and must match ``need`` words."""

    vocab: dict[bytes, int]
    seq: np.ndarray
    start: np.ndarray
    need: np.ndarray
    item: np.ndarray
    names: list[str]

    @property
    def least(self) -> int:
        return int(self.need.min()) if len(self.need) else 0


def block_of(items: list[tuple[str, bytes]], window: int) -> Block:
    vocab: dict[bytes, int] = {}
    seq: list[int] = []
    start, need, item, names = [], [], [], []
    for name, text in items:
        ws = words(text)
        if not ws:
            continue
        w = min(window, len(ws))
        for i in range(len(ws) - w + 1):
            start.append(len(seq) + i)
            need.append(w)
            item.append(len(names))
        names.append(name)
        seq.extend(vocab.setdefault(x, len(vocab)) for x in ws)
    as_int = lambda x: np.array(x, dtype=np.int64)
    return Block(vocab, as_int(seq), as_int(start), as_int(need), as_int(item), names)


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``t`` in the order of their first ``depth``
    symbols at least, by prefix doubling."""
    _, rank = np.unique(t, return_inverse=True)
    k = 1
    while k < depth and len(t):
        after = np.zeros(len(t), dtype=np.int64)
        after[:-k] = rank[k:] + 1
        _, rank = np.unique(rank.astype(np.int64) * (len(t) + 1) + after, return_inverse=True)
        k *= 2
    return np.argsort(rank, kind="stable")


def search(t: np.ndarray, sa: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi) in ``sa`` for every suffix of the block: the places where its
    first ``need`` words stand. The third array is the number of words of the
    suffix that were matched before its range was empty."""
    pad = np.concatenate([t, np.full(int(block.need.max(initial=1)) + 1, -1, dtype=np.int64)])
    n = len(block.start)
    lo, hi, got = np.zeros(n, dtype=np.int64), np.full(n, len(sa), dtype=np.int64), np.zeros(n, dtype=np.int64)
    live, d = np.arange(n), 0
    while len(live):
        sym = block.seq[block.start[live] + d]
        ends = []
        for right in (False, True):
            a, b = lo[live].copy(), hi[live].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    break
                mid = (a + b) // 2
                v = pad[sa[np.minimum(mid, len(sa) - 1)] + d]
                up = open_ & ((v <= sym) if right else (v < sym))
                a = np.where(up, mid + 1, a)
                b = np.where(open_ & ~up, mid, b)
            ends.append(a)
        lo[live], hi[live] = ends
        found = lo[live] < hi[live]
        got[live] += found
        d += 1
        live = live[found]
        live = live[block.need[live] > d]
    hit = got >= block.need
    return np.where(hit, lo, 0), np.where(hit, hi, 0), got


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class _Shard:
    """Stretches of documents whose words all occur in the benchmark."""

    def __init__(self, block: Block):
        self.block, self.parts, self.at, self.size = block, [], [], 0
        self.found: dict[int, tuple[list, set, int]] = {}

    def add(self, doc: int, ids: np.ndarray) -> None:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], ids >= 0, [0]])))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= self.block.least:
                self.parts.append(ids[a:b])
                self.at.append((self.size, doc, int(a)))
                self.size += int(b - a) + 1  # and one symbol that matches nothing
        if self.size >= SHARD_WORDS:
            self.flush()

    def flush(self) -> None:
        if not self.parts:
            return
        block, gap = self.block, np.array([-1], dtype=np.int64)
        t = np.concatenate([x for p in self.parts for x in (p, gap)])
        sa = suffix_array(t, int(block.need.max()))
        lo, hi, _ = search(t, sa, block)
        begin, doc, first = (np.array(x, dtype=np.int64) for x in zip(*self.at))
        self.parts, self.at, self.size = [], [], 0
        n = hi - lo
        if not n.any():
            return
        which = np.repeat(np.arange(len(n)), n)
        place = sa[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        part = np.searchsorted(begin, place, side="right") - 1
        where = place - begin[part] + first[part]
        owner, need, item = doc[part], block.need[which], block.item[which]
        # neighbouring places on one diagonal make one match
        diag = place - block.start[which]
        order = np.lexsort((place, item, diag))
        new = np.ones(len(order), dtype=bool)
        p, g, i = place[order], diag[order], item[order]
        new[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (p[1:] != p[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(order)) - 1
        o, w, e = owner[order], where[order], need[order]
        for h, z in zip(head, tail):
            spans, items, longest = self.found.get(int(o[h]), ([], set(), 0))
            a, b = int(w[h]), int(w[z] + e[z])
            spans.append((a, b))
            items.add(block.names[i[h]])
            self.found[int(o[h])] = (spans, items, max(longest, b - a))


def _search_batches(batches: Iterator[pa.RecordBatch], block: Block, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
    get = block.vocab.get
    for batch in batches:
        texts = batch.column(1).cast(pa.binary() if batch.column(1).type != pa.large_string() else pa.large_binary())
        shard, counts = _Shard(block), np.zeros(len(batch), dtype=np.int64)
        for d in range(len(batch)):
            ws = words(texts[d].as_py() or b"")
            counts[d] = len(ws)
            if len(block.need):
                shard.add(d, np.array([get(w, -1) for w in ws], dtype=np.int64))
        shard.flush()
        spans, items, longest = [], [], []
        old = [None, None, None] if first else [batch.column(k) for k in (3, 4, 5)]
        for d in range(len(batch)):
            s, i, m = shard.found.get(d, ([], set(), 0))
            if not first:
                s = s + [(x["start"], x["stop"]) for x in old[0][d].as_py()]
                i = i | set(old[1][d].as_py())
                m = max(m, old[2][d].as_py())
            spans.append([{"start": a, "stop": b} for a, b in _merge(s)])
            items.append(sorted(i))
            longest.append(m)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.nulls(len(batch), pa.string()) if last else batch.column(1).cast(pa.string()), pa.array(counts),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())],
            names=["id", "t", "n_words", "spans", "items", "longest"])


def benchmark_blocks(benchmark: DataFrame, text_col: str, id_col: str, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks of at most ``block_bytes`` of text (or one item)."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    items, size = [], 0
    for name, text in rows.toLocalIterator():
        raw = (text or "").encode()
        if items and size + len(raw) > block_bytes:
            yield block_of(items, window)
            items, size = [], 0
        items.append((name, raw))
        size += len(raw)
    yield block_of(items, window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                       item_text_col: str = "text", item_id_col: str = "item_id", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans, items, longest.

    ``spans`` are the word ranges [start, stop) covered by benchmark windows,
    merged; ``items`` the ids (as strings, distinct, sorted) of the items with
    a window in the document; ``longest`` the longest verbatim match in words.
    A window is ``window`` consecutive words of an item; a shorter item is one
    window; an item without words (or null) has none. A null document has no
    words. An id that is null counts as the empty string. Repeated rows of
    either table are searched like any other; an empty benchmark hits
    nothing. ``id`` must be an integer.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decon")
    cur = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    held, n = None, 0
    for block in benchmark_blocks(benchmark, item_text_col, item_id_col, window, block_bytes):
        if held is not None:
            cur = _pass(cur, held, n == 1, False)
            if n % CHAIN == 0:
                cur = scratch.keep(cur, f"pass-{n}")
        held, n = block, n + 1
    out = _pass(cur, held, n == 1, True).drop("t")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items", "longest")


def _pass(cur: DataFrame, block: Block, first: bool, last: bool) -> DataFrame:
    sent = cur.sparkSession.sparkContext.broadcast(block)
    return cur.mapInArrow(lambda it: _search_batches(it, sent.value, first, last), SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` without the rows of documents that a benchmark window hits.

    Rows are removed by id, so every row of a hit id goes; rows with a null
    id stay only if no null-id row is hit."""
    hit = find_contamination(docs, benchmark, text_col, id_col, **kw).filter("n_hit > 0").select(F.col(id_col).alias("_hit")).distinct()
    return docs.join(hit, docs[id_col].eqNullSafe(hit["_hit"]), "left_anti")
