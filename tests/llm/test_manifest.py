"""Merkle manifest against a plain tree in memory."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from frames import hostile
from quarry.llm.merkle_manifest import build_manifest, fold, lowered

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp string, i string, m string, path string, range string, seen string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    parts = [row[0], row[1], row[2], row[3], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts])


def climb(nodes):
    """Root and, per node, the (siblings left, siblings right) of each level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, a in enumerate(at):
            run = a - a % 8
            paths[k].append(("".join(level[run:a]), "".join(level[a + 1:run + 8])))
            at[k] = a // 8
        level = [H(*level[a:a + 8]) for a in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    langs = {}
    for r in rows:
        altered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4] or "")
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), leaf(r, low) if altered else None, r[0]))
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([x[2] for x in sorted(langs[g], key=lambda x: x[:3])]) for g in order]
    root, upper = climb([t[0] for t in trees])
    out = []
    for g, (sub, paths), above in zip(order, trees, upper):
        for x, path in zip(sorted(langs[g], key=lambda x: x[:3]), paths):
            node = x[3] or x[2]
            for left, right in path + above:
                node = H(left, node, right)
            out.append((x[4], x[2], sub, root, H(*[a + b for a, b in path + above]), node, node == root))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)


def sample(n_hot):
    rnd = random.Random(5)
    rows = [(i, s, rnd.choice(["en", "de", None, "é"]), len(t or ""), t) for i, t, s in hostile()]
    rows += [(1000 + k, "s", "hot", None, f"Text {k} À") for k in range(n_hot)]
    return rows + [(9, None, "lone", 1, "Z"), (8, "a", "", 0, "")] + [(50 + k, "s", f"l{k:02d}", 2, "Ab") for k in range(70)]


@pytest.mark.parametrize("every", [1, 2, 3])
def test_audit(spark, every):
    rows = sample(1100)
    docs = frame(spark, rows)
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered(F.col("text")))
    got = build_manifest(docs, altered, every=every).audit()
    have = sorted(map(tuple, got.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)
    assert have == brute(rows)
    assert 100 < sum(not r[-1] for r in have) < len(have) - 100


def test_proofs_and_clean_table(spark):
    rows = sample(70)
    manifest = build_manifest(frame(spark, rows))
    found = manifest.proofs().collect()
    assert len(found) == len(rows)
    assert all(fold(r.leaf, [s.asDict() for s in r.path]) == r.root == manifest.root for r in found)
    assert all(r.verified for r in manifest.audit().collect())
    # a swapped leaf does not fold to the root
    assert fold(found[0].leaf[::-1], [s.asDict() for s in found[0].path]) != manifest.root
    # the order of the rows does not matter, one byte does
    again = build_manifest(frame(spark, rows[::-1]).repartition(7))
    assert again.root == manifest.root
    assert build_manifest(frame(spark, [(*rows[0][:4], "other"), *rows[1:]])).root != manifest.root


def test_small(spark):
    empty = build_manifest(frame(spark, []))
    assert empty.root is None and empty.audit().collect() == []
    one = build_manifest(frame(spark, [(None, None, None, None, None)]))
    r = one.audit().collect()[0]
    assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) == (H("-----"), H("-----"), H("-----"), H(""), True)
