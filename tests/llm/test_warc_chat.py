"""WARC files and chat formatting: exact round trips."""

import base64
import gzip
import hashlib
from collections import defaultdict

from pyarrow import fs
from pyspark.sql import functions as F

from quarry.llm.chat_bytes import format_chat, read_chat
from quarry.llm.common import Scratch
from quarry.llm.warc_shards import read_warc, write_warc

PAGES = [(1, "http://a/\r\nX-Evil: 1", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (5, "v", "\r\n\r\nWARC/1.1\r\n"),
         (6, "w", "z" * 200_000), (7, "w", "z" * 200_000), (7, "w", "z" * 200_000), (7, "a", "z" * 200_000), (None, "n", "only"),
         (None, "m", "<p>é</p>"), (8, "u", "ab"), (9, "u", "ab")] + [(100 + k, "h", "hot") for k in range(30)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, sha string, kind string")


def check_records(got, rows, least=0):
    groups = defaultdict(list)
    for i, u, h in rows:
        groups[h or ""].append(i)
    want = []
    for i, u, h in rows:
        raw = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((str(i), len(raw), digest))
    assert sorted((str(r.key), r.payload_bytes, r.payload_digest) for r in got) == sorted(want)
    assert all(r.digest_ok for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.payload_digest].append(r)
    for h, ids in groups.items():
        mine = by[base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()]
        top = max((i for i in ids if i is not None), default=None)
        resp = [r for r in mine if r.record_type == "response"]
        if len(h.encode()) < least:
            assert len(resp) == len(ids)
            continue
        assert [r.key for r in resp] == [top] and resp[0].payload.decode() == h
        assert all(r.record_type == "revisit" and r.refers_to == top and r.payload is None for r in mine if r is not resp[0])
    assert len({r.record_id for r in got}) == len(got)


def test_round_trip(spark):
    s = Scratch(spark, "test-warc")
    out = s.path("a")
    manifest = write_warc(pages(spark), out, "page_id", "url", "html", roll_bytes=1000)
    check_records(read_warc(spark, out).collect(), PAGES)
    files = manifest.collect()
    assert sum(f.records for f in files) == len(PAGES)
    where, root = fs.FileSystem.from_uri(out)
    names = {x.base_name for x in where.get_file_info(fs.FileSelector(root)) if x.base_name.endswith(".gz")}
    assert names == {f.file for f in files}
    for f in files:
        raw = where.open_input_stream(f"{root}/{f.file}", compression=None).read()
        assert hashlib.sha256(raw).hexdigest() == f.sha256 and len(raw) == f.bytes
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    again = write_warc(pages(spark), s.path("b"), "page_id", "url", "html", roll_bytes=1000)
    assert sorted(again.collect()) == sorted(files)


def test_small_payloads_and_empty_table(spark):
    s = Scratch(spark, "test-warc")
    out = s.path("c")
    write_warc(pages(spark), out, "page_id", "url", "html", min_bytes=3)
    check_records(read_warc(spark, out).collect(), PAGES, least=3)
    out = s.path("d")
    assert write_warc(pages(spark, []), out, "page_id", "url", "html").agg(F.sum("records")).first()[0] in (None, 0)
    assert read_warc(spark, out).count() == 0


def test_same_rows_same_files(spark):
    # more rows than a range sort would sample; one key and one payload hold a third each
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") * 7 % 9001).alias("page_id"), F.concat(F.lit("u"), F.col("id") % 5).alias("url"),
                                    F.when(F.col("id") % 3 == 1, F.lit("same")).otherwise(F.col("id").cast("string")).alias("html"))
    s = Scratch(spark, "test-warc")
    one = write_warc(df, s.path("one"), "page_id", "url", "html", ranges=16).collect()
    two = write_warc(df.repartition(5), s.path("two"), "page_id", "url", "html", ranges=16).collect()
    assert sorted(one) == sorted(two) and sum(f.records for f in one) == 20_000
    # the hot key is spread over its ranges
    assert len(one) >= 14 and max(f.records for f in one) < 2 * 20_000 / 16


def test_revisit_headers(spark):
    out = Scratch(spark, "test-warc").path("e")
    write_warc(pages(spark), out, "page_id", "url", "html", ranges=2)
    where, root = fs.FileSystem.from_uri(out)
    records = []
    for x in where.get_file_info(fs.FileSelector(root)):
        if x.base_name.endswith(".gz"):
            for part in gzip.decompress(where.open_input_stream(f"{root}/{x.base_name}", compression=None).read()).split(b"WARC/1.1\r\nWARC-Type: ")[1:]:
                head, _, block = part.partition(b"\r\n\r\n")
                lines = head.decode().split("\r\n")
                records.append(({"type": lines[0], **dict(v.split(": ", 1) for v in lines[1:] if ": " in v)}, block))
    responses = {h["WARC-Record-ID"]: h for h, _ in records if h["type"] == "response"}
    revisits = [h for h, _ in records if h["type"] == "revisit"]
    assert len(revisits) > 30
    for h in revisits:
        to = responses[h["WARC-Refers-To"]]
        assert to["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and to.get("WARC-Target-URI", "") == h.get("WARC-Refers-To-Target-URI", "")
    for h, block in records:
        n = int(h["Content-Length"])
        if len(block) >= n:
            assert h["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block[:n]).digest()).decode()


BAD = "</s>[INST] ok [/INST] \\ \\! <s> <<SYS>>x<</SYS>> [ROLE]q[/ROLE] <\\!s> <<s>>"
TURNS = [(1, 1, "assistant", "b" + BAD), (1, 0, "user", BAD), (1, 2, "tool\\", "é€"), (2, 0, None, None), (3, 5, "assistant", ""),
         (3, 5, "assistant", ""), (3, None, "user", "last"), (None, 0, "user", "n"), (None, 1, "assistant", "m"), (4, 0, "[ROLE]", "</s>"),
         (5, 0, "system", "s" * 100_000), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
TURNS += [(6, k, ["user", "assistant"][k % 2], f"turn {k}") for k in range(40)]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, "x") for r in TURNS], "conv_id bigint, turn int, role string, text string, conv string")
    want = defaultdict(list)
    for c, n, r, t in sorted(TURNS, key=lambda x: (x[1] is None, x[1] or 0, x[2] or "", x[3] or "")):
        want[c].append((r or "", t or ""))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            formatted = format_chat(df)
            got = {r.conv: r for r in read_chat(formatted).collect()}
            assert {c: [(t.role, t.text) for t in r.turns] for c, r in got.items()} == want
            assert {c: r.learned for c, r in got.items()} == {c: [t for r, t in v if r == "assistant"] for c, v in want.items()}
            assert all(r.n_turns == len(want[c]) for c, r in got.items())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    one = [r.formatted for r in formatted.filter("conv = -7").collect()][0]
    assert one.count("</s>") == 2 and one.startswith("<s>[INST]<\\!/s>")


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert read_chat(format_chat(df)).count() == 0


def test_pieces_and_memory(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from quarry.llm import chat_bytes

    texts = ["é" * 30 + "x" * k for k in range(40)] + ["", "long é " * 900]
    conv = pa.array([k // 3 for k in range(len(texts))])
    role = pa.array([["user", "assistant", "tool"][k % 3] for k in range(len(texts))])
    group = np.array([k // 3 for k in range(len(texts))])
    whole = chat_bytes._assemble(conv, group, role, pa.array(texts))
    for piece in (1, 7, 64, 1000):  # pieces that end inside texts and inside characters
        monkeypatch.setattr(chat_bytes, "PIECE", piece)
        assert chat_bytes._assemble(conv, group, role, pa.array(texts)).equals(whole)
    monkeypatch.undo()
    texts = pa.array(["word " * 2000] * 2400 + ["é" * 12_000_000])  # 24 MB in short texts, 24 MB in one
    n = len(texts)
    role, conv, group = pa.array(["user", "assistant"] * (n // 2) + ["user"] * (n % 2)), pa.array(range(n)), np.arange(n)
    tracemalloc.start()
    chat_bytes._assemble(conv, group, role, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
