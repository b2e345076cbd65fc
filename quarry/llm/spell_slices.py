"""Spelling variants by a bit-sliced position index (operator 13).

The index of a block of words has one bitset over the block for each (position,
letter). A query word walks its letters once; three sets of words are
carried along at the same time, all words of the block in parallel: those
equal so far, those with one replaced letter so far, and those one letter
ahead (or behind), which read the slices of the next (or the last) position.

Blocks: two words of lengths L and L or L + 1 that differ in one place agree
in their first L // 2 letters or in their last L - L // 2. So every word is
filed under both halves, in the class of its length and of one less; keys
are hashed to blocks of about ``block_words(L)`` words, and a block that one
key makes larger is cut into parts that meet pair by pair. Work grows with
the vocabulary, and a task holds two parts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch

#: runs of letters: A-Z (lower-cased before), and the Latin-1 letters as they are
RUN = re.compile("[a-zÀ-ÿ]+")
#: words counted in a task before they are handed on
FLUSH = 200_000
BLOCK = 4096
#: letters of a block of long words
LETTERS = 1 << 20
#: query words in one numpy step
STEP = 256

COUNTED = "word string, n bigint"
FOUND = "word string, n_near bigint, top_n bigint, top string"


def block_words(length: int) -> int:
    """Words of a block of words of this length."""
    return max(2, min(BLOCK, LETTERS // max(1, length)))


def _count(batches: Iterator[pa.RecordBatch], min_len: int, drop_every: int | None) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen.clear()
        return out

    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for d in range(len(batch)):
            text = texts[d].as_py()
            if not text:
                continue
            doc = ids[d].as_py()
            start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            # bytes.lower() lowers A-Z only
            for run, n in Counter(m.group() for m in RUN.finditer(text.encode().lower().decode())).items():
                if drop_every and (h := zlib.crc32(run.encode(), start)) % drop_every == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                if len(run) >= min_len:
                    seen[run] += n
            if len(seen) >= FLUSH:
                yield flush()
    yield flush()


def count_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_len: int = 6, min_count: int = 5,
                drop_every: int | None = None) -> DataFrame:
    """(word, n) of the letter runs of whole texts, A-Z lower-cased, with at least
    ``min_len`` code points and ``min_count`` occurrences.

    ``drop_every`` plants slips: where it divides h = crc32("<id>:<run>"), the
    run loses its code point h % length before it is counted. Null and empty
    texts have no words; a null id counts as an empty one.
    """
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
    part = src.mapInArrow(lambda it: _count(it, min_len, drop_every), COUNTED)
    return part.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class SliceIndex:
    """Bitsets per (position, letter) over words of ``length`` or one letter more."""

    def __init__(self, words: list[str], length: int):
        self.length = length
        lens = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lens)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lens) - lens, lens)
        self.slots, row = np.unique(place << 21 | codes, return_inverse=True)
        self.width = -(-len(words) // 64)
        # the last row is empty: letters that stand nowhere at a position
        self.bits = np.zeros((len(self.slots) + 1, self.width), dtype=np.uint64)
        np.bitwise_or.at(self.bits, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
        self.same, self.longer = self._mask(lens == length), self._mask(lens == length + 1)

    def _mask(self, which: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.width * 64, dtype=np.uint8)
        padded[:len(which)] = which
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def _slices(self, place: int, letters: np.ndarray) -> np.ndarray:
        key = np.int64(place) << 21 | letters
        at = np.minimum(np.searchsorted(self.slots, key), len(self.slots) - 1)
        return self.bits[np.where(self.slots[at] == key, at, len(self.slots))]

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) positions of the pairs one edit apart; the queries have one
        length, that of the index or one letter more. Words of ``length + 1`` meet
        their like in the index of that length."""
        size = len(queries[0])
        q = np.frombuffer("".join(queries).encode("utf-32-le"), dtype=np.uint32).astype(np.int64).reshape(len(queries), size)
        equal = np.full((len(queries), self.width), np.uint64(2**64 - 1))
        one = np.zeros_like(equal)
        ahead = np.zeros_like(equal)
        if size == self.length:
            for i in range(size):
                here, after = self._slices(i, q[:, i]), self._slices(i + 1, q[:, i])
                ahead = (ahead | equal) & after
                one = (one & here) | (equal & ~here)
                equal &= here
            hit = (one & self.same) | ((ahead | equal) & self.longer)
        else:
            for i in range(size):
                one = (one & self._slices(i - 1, q[:, i]) | equal) if i else equal.copy()
                equal &= self._slices(i, q[:, i])
            hit = one & self.same
        qi, wi = np.nonzero(hit)
        lane = (hit[qi, wi][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        k, bit = np.nonzero(lane)
        return qi[k], wi[k] * 64 + bit


def _unit(length: int, kind: int, query: list[tuple[str, int]], index: list[tuple[str, int]]) -> dict[str, tuple[int, int]]:
    """Per query word with a near word: their number, and the position in
    ``index`` of the best. ``index`` is sorted from best to worst."""
    words = [w for w, _ in index]
    slices, half, found = SliceIndex(words, length), length // 2, {}
    if not slices.same.any():
        return found
    heads: dict[str, int] = {}
    head = np.array([heads.setdefault(w[:half], len(heads)) for w in words])
    for size in (length, length + 1):
        own = [w for w, _ in query if len(w) == size]
        for a in range(0, len(own), STEP):
            part = own[a:a + STEP]
            qi, vi = slices.near(part)
            # a pair with equal heads is found under the heads, another one under the tails
            equal = np.array([heads.get(w[:half], -1) for w in part])[qi] == head[vi]
            take = equal if kind == 0 else ~equal
            for k, v in zip(qi[take].tolist(), vi[take].tolist()):
                n, best = found.get(part[k], (0, v))
                found[part[k]] = (n + 1, min(best, v))
    return found


def _near_in_unit(key: tuple, table: pa.Table) -> pa.Table:
    length, kind = key[0].as_py(), key[1].as_py()
    rows = list(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), table.column("role").to_pylist()))
    query = [(w, n) for w, n, r in rows if r != 1]
    index = sorted(((w, n) for w, n, r in rows if r != 0), key=lambda x: (-x[1], x[0]))
    found = _unit(length, kind, query, index) if query and index else {}
    return pa.table({"word": pa.array(list(found), pa.string()), "n_near": pa.array([n for n, _ in found.values()], pa.int64()),
                     "top_n": pa.array([index[b][1] for _, b in found.values()], pa.int64()),
                     "top": pa.array([index[b][0] for _, b in found.values()], pa.string())})


def near_words(vocab: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, n_near, top, top_n) of the words of ``vocab`` (word, n) that have a
    word one edit away; ``top`` is the most frequent, of equals the smallest."""
    size = F.char_length("word")
    filed = vocab.select("word", "n", F.explode(F.array(size, size - 1)).alias("len"))
    half = F.floor(F.col("len") / 2).cast("int")
    tail = F.col("len") - half
    keys = F.array(F.expr("substring(word, 1, cast(floor(len / 2) as int))"), F.substring("word", -tail, tail))
    filed = filed.select("word", "n", "len", F.posexplode(keys).alias("kind", "key"))
    per_block = F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(F.lit(LETTERS) / F.greatest(F.lit(1), F.col("len"))))).cast("int")
    # one row per (length, half): how many blocks
    classes = filed.groupBy("len", "kind").agg(F.count(F.lit(1)).alias("c"))
    blocks = classes.select("len", "kind", F.ceil(F.col("c") / per_block).alias("blocks"))
    filed = filed.join(blocks, ["len", "kind"]).select("word", "n", "len", "kind", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("g"))
    filed = scratch.keep(filed, "filed")
    sizes = filed.groupBy("len", "kind", "g").agg(F.count(F.lit(1)).alias("c"))
    cuts = sizes.filter("c > 1").select("len", "kind", "g", F.ceil(F.col("c") / (2 * per_block)).cast("int").alias("parts"))
    filed = filed.join(cuts, ["len", "kind", "g"]).withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # part i asks (role 0) part j (role 1); in the unit (i, i) a word does both (role 2)
    units = F.expr("""flatten(transform(sequence(0, parts - 1), x -> if(x = own,
        array(struct(own as i, own as j, 2 as role)), array(struct(own as i, x as j, 0 as role), struct(x as i, own as j, 1 as role)))))""")
    filed = filed.select("word", "n", "len", "kind", "g", F.explode(units).alias("u")).select("word", "n", "len", "kind", "g", "u.*")
    found = filed.groupBy("len", "kind", "g", "i", "j").applyInArrow(_near_in_unit, FOUND)
    best = F.min(F.struct((-F.col("top_n")).alias("m"), "top")).alias("b")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("b.top").alias("top"), (-F.col("b.m")).alias("top_n"))


def spelling_variants(vocab: DataFrame, ratio: int = 5) -> DataFrame:
    """One row per word of ``vocab`` (distinct words, counts n): word, form, root, n, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced code
    point. ``form`` is a word's most frequent near word (of equals the smallest
    in code-point order) if it occurs at least ``ratio`` times as often, ``root``
    the end of the chain of forms; a word without form is its own root. An
    empty table gives an empty one; rows with a null word or count are left out.
    """
    scratch = Scratch(vocab.sparkSession, "spelling")
    vocab = scratch.keep(vocab.select("word", "n").dropna(), "vocabulary")
    near = near_words(vocab, scratch)
    formed = F.col("top_n") >= F.lit(ratio) * F.col("n")
    rows = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("top")).alias("form"), F.when(formed, F.col("top_n")).alias("form_n"))
    rows = scratch.keep(rows, "forms")
    # counts grow along a chain, so it ends; each round doubles the steps taken
    chain = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = chain.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        step = scratch.keep(step, "chain")
        chain = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return rows.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
