"""Block naming, winnowing and tensored MinHash against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from frames import docs_frame, hostile, split_words, strip_blank
from quarry.llm.block_names import exact_dedup, wide_key
from quarry.llm.tensor_minhash import collections_for, near_dedup, near_duplicates, parity_sketch, shingle_set
from quarry.llm.winnow_lines import _repeated, winnow


def brute_exact(rows):
    groups = defaultdict(list)
    for k, (i, t, *_) in enumerate(rows):
        groups[strip_blank(t or "")].append((-len(t or ""), i is None, i or 0, k))
    out = []
    for norm, g in groups.items():
        best = min(g)
        for n, z, i, k in g:
            out.append((None if z else i, None if best[1] else best[2], len(g), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def check_exact(spark, rows, **kw):
    got = exact_dedup(docs_frame(spark, rows), **kw).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute_exact(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


def test_exact_hostile(spark):
    check_exact(spark, hostile())


def test_exact_small_blocks_and_colliding_keys(spark):
    rnd = random.Random(5)
    rows = [(k, "".join(rnd.choice("ab é") for _ in range(rnd.choice([0, 1, 3, 4, 5, 8, 9, 16, 17, 40]))), "s") for k in range(120)]

    def weak(block, seed):  # the first two seeds give a few keys for all blocks
        if seed < 2:
            return [F.pmod(F.xxhash64(block), F.lit(3 + seed)).alias("h1"), F.lit(0).cast("bigint").alias("h2")]
        return wide_key(block, seed)

    check_exact(spark, rows, block_bytes=4, key=weak)


def test_exact_empty(spark):
    assert exact_dedup(docs_frame(spark, [])).count() == 0


def brute_winnow(rows, least):
    out, order = [], sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first, wins = {}, defaultdict(list)
    for k in order:
        ls = (rows[k][1] or "").split("\n")
        seq = [(n, s.strip(" \t\n\x0b\x0c\r")) for n, s in enumerate(ls)]
        seq = [(n, s, len(s.encode().split())) for n, s in seq if s]
        for a in range(len(seq)):
            total, z = 0, a
            while z < len(seq) and total < least:
                total += seq[z][2]
                z += 1
            if total >= least:
                body = tuple(s for _, s, _ in seq[a:z])
                span = (k, seq[a][0], seq[z - 1][0])
                first.setdefault(body, span)
                wins[k].append((body, span))
    for k in range(len(rows)):
        ls, gone = (rows[k][1] or "").split("\n"), set()
        for body, (_, a, z) in wins[k]:
            f = first[body]
            if f != (k, a, z) and (f[0] != k or a > f[2]):
                gone |= set(range(a, z + 1))
        gone = {n for n in gone if ls[n].strip(" \t\n\x0b\x0c\r")}
        out.append((rows[k][0], len(ls), len(gone), "\n".join(s for n, s in enumerate(ls) if n not in gone)))
    return sorted(out, key=str)


def test_winnow(spark):
    rnd = random.Random(11)
    line = lambda n: " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(n))
    shared, long_line = [line(rnd.randint(1, 6)) for _ in range(12)], line(15)
    rows = []
    for k in range(60):
        body = [line(rnd.randint(0, 5)) for _ in range(rnd.randint(0, 6))]
        if k % 3 == 0:
            a = rnd.randint(0, 6)
            body[len(body) // 2:len(body) // 2] = [f" {s}\t" if rnd.random() < 0.3 else s for s in shared[a:a + rnd.randint(2, 8)]]
        if k % 5 == 0:
            body.insert(rnd.randint(0, len(body)), long_line)
        if k % 7 == 0:
            body += ["again and again"] * 12
        rows.append((k, "\n".join(body), "s"))
    rows += [(3, None, "s"), (None, "\n".join(shared), "s"), (70, "", "s"), (71, "\n \n", "s"), (8, "\n".join(shared), "s")]
    got = winnow(docs_frame(spark, rows), min_words=10).collect()
    assert sorted([(r.doc_id, r.n_lines, r.n_removed, r.clean_text) for r in got], key=str) == brute_winnow(rows, 10)
    assert sum(r.n_removed for r in got) > 100


def brute_runs(rows, least):
    """Every run of ``least`` words, not only the windows, against its first place."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first, gone = {}, defaultdict(set)
    for k in order:
        seq = [(n, s.strip(" \t\n\x0b\x0c\r")) for n, s in enumerate((rows[k][1] or "").split("\n"))]
        seq = [(n, s, len(s.encode().split())) for n, s in seq if s]
        for a in range(len(seq)):
            for z in range(a + 1, len(seq) + 1):
                if sum(w for _, _, w in seq[a:z]) >= least:
                    f = first.setdefault(tuple(s for _, s, _ in seq[a:z]), (k, seq[a][0], seq[z - 1][0]))
                    if f[0] != k or seq[a][0] > f[2]:
                        gone[k] |= {n for n, _, _ in seq[a:z]}
    out = []
    for k, (i, t, *_) in enumerate(rows):
        ls = (t or "").split("\n")
        out.append((i, len(ls), len(gone[k]), "\n".join(s for n, s in enumerate(ls) if n not in gone[k])))
    return sorted(out, key=str)


def test_winnow_whole_runs(spark):
    rnd = random.Random(12)
    line = lambda n: " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(n))
    run = [line(60), line(10), line(10)]
    got = winnow(docs_frame(spark, [(1, "\n".join(run), "s"), (2, "\n".join([*run, line(70)]), "s"), (3, "\n".join(run), "s")]),
                 whole_runs=True).collect()
    assert {r.doc_id: [tuple(x) for x in r.spans] for r in got} == {1: [], 2: [(0, 2)], 3: [(0, 2)]}
    shared, rows = [line(rnd.randint(1, 12)) for _ in range(14)], []
    for k in range(50):
        body = [line(rnd.randint(0, 12)) for _ in range(rnd.randint(0, 5))]
        a = rnd.randint(0, 9)
        body[len(body) // 2:len(body) // 2] = shared[a:a + rnd.randint(2, 8)]
        if k % 9 == 0:
            body += ["again and again"] * rnd.randint(5, 12)
        rows.append((k, "\n".join(body), "s"))
    rows += [(3, None, "s"), (None, "\n".join(shared), "s"), (8, "\n".join(shared), "s")]
    got = winnow(docs_frame(spark, rows), min_words=10, whole_runs=True).collect()
    got = sorted([(r.doc_id, r.n_lines, r.n_removed, r.clean_text) for r in got], key=str)
    assert got == brute_runs(rows, 10)
    assert sum(r[2] for r in got) > sum(r[2] for r in brute_winnow(rows, 10))


def test_fingerprints_are_counted_by_place(spark):
    """Windows that share one line are one place of it."""
    rows = [(0, 0, 5, 1), (0, 1, 5, 1), (0, 2, 6, 3), (1, 0, 7, 0), (1, 4, 7, 5), (2, 0, 6, 3)]
    win = spark.createDataFrame(rows, "rid bigint, line int, fp bigint, at int")
    assert sorted(r.fp for r in _repeated(win).collect()) == [6, 7]


def test_winnow_hostile(spark):
    rows = hostile()
    got = winnow(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert winnow(docs_frame(spark, [])).count() == 0


def brute_near(rows, k, percent):
    sets = []
    for _, t, *_ in rows:
        w = split_words(t)
        n = min(k, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            c = len(sets[a] & sets[b])
            if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                root[find(a)] = find(b)
    low = {}
    for k_, (i, *_) in enumerate(rows):
        if i is not None:
            low[find(k_)] = min(low.get(find(k_), i), i)
    return sorted([(i, len(sets[a]), low.get(find(a)) if sets[a] else i) for a, (i, *_) in enumerate(rows)], key=str), sets, len({find(a) for a in range(len(rows))})


def near_rows():
    """Chains, stars of near copies (some not linked with each other), copies and bystanders."""
    rnd = random.Random(2)
    text = lambda n: [rnd.choice("abcdefghijklmnopqrstuvwxyz") + rnd.choice("abcdefghijkl") for _ in range(n)]

    def change(w, n):
        w = list(w)
        for _ in range(n):
            w[rnd.randrange(len(w))] = "zz" + str(rnd.random())
        return w

    rows, base = [], text(150)
    rows += [(500 + k, " ".join(change(base, rnd.randint(1, 6))), "s") for k in range(80)]
    step = text(120)
    for k in range(12):  # a chain: each is close to the one before only
        rows.append((300 - k, " ".join(step), "s"))
        step = change(step, 2)
    for g in range(15):
        b = text(rnd.randint(1, 60))
        rows += [(1000 + 10 * g + k, " ".join(change(b, k)), "s") for k in range(3)]
    return rows


def test_near_duplicates(spark):
    rows = near_rows() + hostile()
    want, _, _ = brute_near(rows, 3, 85)
    got = near_duplicates(docs_frame(spark, rows), shingle=3, percent=85).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({r.component_id for r in got}) > 80


@pytest.mark.parametrize("minority", [64, 0])
def test_near_duplicates_table_by_table(spark, minority, monkeypatch):
    """Halves too large to be compared as a whole: buckets with few outsiders, and leaders in waves."""
    from quarry.llm import tensor_minhash

    monkeypatch.setattr(tensor_minhash, "HALF_WORK", 0)
    monkeypatch.setattr(tensor_minhash, "MINORITY", minority)
    rows = near_rows()
    want, _, _ = brute_near(rows, 3, 85)
    got = near_duplicates(docs_frame(spark, rows), shingle=3, percent=85).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == want


def test_near_dedup_keeps_one_row_per_class(spark):
    rows = near_rows() + hostile()
    want, _, classes = brute_near(rows, 5, 80)  # a row without words is a class of its own
    got = near_dedup(docs_frame(spark, rows))
    assert got.columns == docs_frame(spark, []).columns
    assert got.count() == classes
    assert {r.doc_id for r in got.collect()} == {c for _, _, c in want}


def test_near_empty(spark):
    assert near_duplicates(docs_frame(spark, [])).count() == 0
    assert near_duplicates(docs_frame(spark, [(1, None, "s"), (2, "", "s")])).filter("kept and n_shingles = 0").count() == 2


def test_collections_meet_the_miss_bound():
    for percent in (50, 80, 85, 95):
        p = 1 - (percent / 100) ** 3
        assert 1 - (1 - p ** collections_for(percent)) ** 2 <= 1e-5


def test_shingles_cross_no_words():
    assert len(shingle_set(b"a b c d", 3)) == 2
    assert (shingle_set(b"A  b\x0bc", 3) == shingle_set(b"a b c", 3)).all()
    assert (shingle_set(b"a bc", 3) != shingle_set(b"ab c", 3)).all()
    assert len(shingle_set("a b".encode(), 3)) == 1


def test_sketches_never_exceed_the_difference():
    rnd = random.Random(6)
    for _ in range(200):
        a = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 300)))]
        b = a[0].split()
        for _ in range(rnd.randint(0, 40)):
            b[rnd.randrange(len(b))] = rnd.choice("xyz")
        x, y = shingle_set(a[0].encode(), 3), shingle_set(" ".join(b).encode(), 3)
        bits = sum(int(v).bit_count() for v in (parity_sketch(x) ^ parity_sketch(y)).view("uint64"))
        assert bits <= len(set(x.tolist()) ^ set(y.tolist()))
