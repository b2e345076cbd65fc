"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from frames import docs_frame, hostile
from quarry.llm import spell_slices
from quarry.llm.spell_slices import SliceIndex, count_words, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, min_len, min_count, every):
    seen = Counter()
    for i, t, *_ in rows:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_len and n >= min_count}


def brute_variants(words, ratio):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary(seed, letters="abé", size=250):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))): rnd.choice([5, 5, 25, 125, 7, 900]) for _ in range(size)}
    # one long common head and tail, so that single keys fill several blocks; a chain; long words
    words |= {"common" + "".join(rnd.choice("xyz") for _ in range(4)): rnd.choice([5, 30, 200]) for _ in range(60)}
    words |= {"".join(rnd.choice("xyz") for _ in range(4)) + "common": rnd.choice([5, 30, 200]) for _ in range(60)}
    return words | {"chainaaa": 5, "chainaab": 25, "chainabb": 125, "chainbbb": 625, "q" * 3000: 9, "q" * 2999: 50, "q" * 1500 + "r" + "q" * 1499: 5}


def test_index_finds_all_one_edit_pairs():
    words = [w for w in vocabulary(1) if len(w) < 20]
    for length in range(1, 8):
        block = [w for w in words if len(w) in (length, length + 1)]
        index = SliceIndex(block, length)
        for size in (length, length + 1):
            ask = [w for w in words if len(w) == size]
            if not ask:
                continue
            qi, vi = index.near(ask)
            want = {(q, v) for q in ask for v in block if one_edit(q, v) and min(len(q), len(v)) == length}
            assert {(ask[a], block[b]) for a, b in zip(qi, vi)} == want and len(qi) == len(want)


@pytest.mark.parametrize("block", [4096, 7])
def test_variants(spark, block, monkeypatch):
    monkeypatch.setattr(spell_slices, "BLOCK", block)
    words = vocabulary(2)
    got = rows_of(spelling_variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert got == brute_variants(words, 5)
    assert {r[2] for r in got if r[0].startswith("chain")} == {"chainbbb"}


def test_words_and_slips(spark):
    rnd = random.Random(4)
    pool = ["Straße", "NAÏVETÉ", "naïveté", "colour", "Colour2colour", "ācolour", "×÷×÷×÷", "ab"]
    rows = hostile() + [(500 + k, " ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40)))) for k in range(40)]
    rows = [(*r[:2], "s") for r in rows]
    for every in (None, 3):
        want = brute_words(rows, 6, 5, every)
        got = count_words(docs_frame(spark, rows), drop_every=every)
        assert {r.word: r.n for r in got.collect()} == want and len(want) > 4
    assert rows_of(spelling_variants(got)) == brute_variants(want, 5)


def test_empty(spark):
    got = spelling_variants(count_words(docs_frame(spark, [])))
    assert got.collect() == [] and got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    gaps = spark.createDataFrame([(None, 9), ("abcdef", None), ("abcdeg", 7)], "word string, n bigint")
    assert rows_of(spelling_variants(gaps)) == [("abcdeg", None, "abcdeg", 7, 0, None)]
