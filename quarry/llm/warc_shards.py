"""Deterministic sharded WARC writer and reader (operator 3).

Records are range-sorted by key; each range is written by one task as a run
of files that roll over by compressed size. The keys that cut the ranges are
found by exact ranks, so the same rows and number of ranges give the same files. Headers, ids and digests are
made anew from the row, the gzip members carry no time, so a retry writes
the same bytes. Files are written under temporary names; only the files in the
manifest rows of tasks that succeeded get their final names, and the manifest is
written last, so readers see all of a write or none of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, delete_path
from quarry.operators.selection import select_ranks

ROLL_BYTES = 256 << 20
WARC_DATE = "2020-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: {type}\r\nContent-Length: {n}\r\n\r\n"
_SPACE = uuid.UUID("6f0d3a52-3c1f-5d3e-9a55-2b7c1f0e8d41")

MANIFEST = "range int, seq int, temp string, records bigint, bytes bigint, sha256 string"
RECORD = ("key bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, "
          "record_id string, payload binary, digest_ok boolean")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """One header line: line breaks become spaces."""
    return " ".join(value.splitlines()) if value else ""


def _record(kind: str, record_id: str, block: bytes, extra: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", WARC_DATE), *extra,
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record_id(key, n: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key}/{n}')}>"


class _Roller:
    """Files of one range, under temporary names."""

    def __init__(self, folder: str, part: int, roll: int):
        self.where, self.root = fs.FileSystem.from_uri(folder)
        self.folder, self.part, self.roll, self.seq = folder, part, roll, 0
        self.out, self.rows = None, []

    def write(self, member: bytes, level: int) -> None:
        if self.out is not None and self.size + len(member) > self.roll and self.records:
            self.close()
        if self.out is None:
            self.name = f"{self.part:06d}-{self.seq:05d}.{uuid.uuid4().hex}.tmp"
            self.out = self.where.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
            info = _record("warcinfo", record_id(f"info/{self.part}", self.seq), b"format: WARC File Format 1.1\r\n",
                           [("Content-Type", "application/warc-fields")])
            self._put(_gzip(info, level))
        self._put(member)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.rows.append((self.part, self.seq, self.name, self.records, self.size, self.sum.hexdigest()))
            self.seq += 1


def _write_range(batches: Iterator[pa.RecordBatch], folder: str, roll: int, level: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, key, url, sha, kind). A row of kind 0 says which row leads
    the group of equal payloads that (key, url, sha) belongs to; rows of kind 1
    are the records. A record without a leader row has no equal."""
    files, made = None, []
    now, leader, copy, open_ = None, None, 0, False
    for batch in batches:
        for k in range(len(batch)):
            part, key, url, sha, kind, mime, payload, lead_key, lead_url, leads = (c[k].as_py() for c in batch.columns)
            if files is None or part != files.part:
                if files is not None:
                    files.close()
                files, now = _Roller(folder, part, roll), None
                made.append(files)
            if (key, url, sha) != now:
                now, leader, copy, open_ = (key, url, sha), None, 0, False
            if kind == 0:
                leader, open_ = (lead_key, lead_url), leads
                continue
            payload = payload or b""
            extra = [("WARC-Target-URI", _clean(url)), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
                     ("X-Row-Key", "" if key is None else str(key)), ("X-Payload-Length", str(len(payload)))]
            head = _HTTP.format(type=mime, n=len(payload)).encode()
            kind_of = [("Content-Type", "application/http;msgtype=response")]
            name = record_id(f"{key}/{url}/{sha.hex()}", copy)
            if leader is None or (open_ and copy == 0):
                rec = _record("response", name, head + payload, kind_of + extra)
            else:
                extra += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                          ("WARC-Refers-To", record_id(f"{leader[0]}/{leader[1]}/{sha.hex()}", 0)),
                          ("WARC-Refers-To-Target-URI", _clean(leader[1])), ("WARC-Refers-To-Date", WARC_DATE),
                          ("X-Refers-To-Key", "" if leader[0] is None else str(leader[0]))]
                rec = _record("revisit", name, head, kind_of + extra)
            files.write(_gzip(rec, level), level)
            copy += 1
    if files is not None:
        files.close()
    rows = [r for f in made for r in f.rows]
    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(
        (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["range", "seq", "temp", "records", "bytes", "sha256"])


def _commit(batches: Iterator[pa.RecordBatch], temp: str, out: str) -> Iterator[pa.RecordBatch]:
    """Give the files of the manifest their final names; done twice, the second
    time finds them in place."""
    where, root = fs.FileSystem.from_uri(out)
    held = fs.FileSystem.from_uri(temp)[1]
    for batch in batches:
        names = []
        for r in batch.to_pylist():
            names.append(f"part-{r['range']:06d}-{r['seq']:05d}.warc.gz")
            if where.get_file_info(f"{held}/{r['temp']}").type == fs.FileType.File:
                where.move(f"{held}/{r['temp']}", f"{root}/{names[-1]}")
            elif where.get_file_info(f"{root}/{names[-1]}").size != r["bytes"]:
                raise OSError(f"{r['temp']} is gone and {names[-1]} is not in place")
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column(3), batch.column(4), batch.column(5)],
                                         names=["file", "records", "bytes", "sha256"])


def _cuts(keys: DataFrame, ranges: int) -> list[int]:
    """The key codes at the exact ranks i n / ``ranges``, ascending; a key that holds
    several of the ranks stands there as often."""
    n = keys.count() if ranges > 1 else 0
    if not n:
        return []
    ranks = F.array_distinct(F.expr(f"transform(sequence(1L, {ranges - 1}L), i -> ({n}L * i) div {ranges}L)"))
    found = select_ranks(keys, [], {"key": F.col("code")}, lambda _: ranks).select("rank", "code").collect()
    code = {r["rank"]: r["code"] for r in found}
    return [code[n * i // ranges] for i in range(1, ranges)]


def _range_of(code: Column, sha: Column, cuts: list[int]) -> Column:
    """Number of the range: the cuts up to the key. The rows of a key that holds
    several cuts are dealt to its ranges by their digest."""
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[a:a + step] for a in range(0, len(cuts), step)]
    if not blocks:
        return F.lit(0)
    lit = lambda v: F.array(*[F.lit(x).cast("bigint") for x in v])

    def count(below):
        # whole blocks by their last cut, then the cuts of the next block
        full = F.size(F.filter(lit([b[-1] for b in blocks]), below))
        inner = F.coalesce(F.get(F.array(*[lit(b) for b in blocks]), full), F.array().cast("array<bigint>"))
        return full * step + F.size(F.filter(inner, below))

    less, upto = count(lambda c: c < code), F.least(F.lit(len(cuts)), count(lambda c: c <= code))
    less = F.least(F.lit(len(cuts)), less)
    share = F.conv(F.substring(F.hex(sha), 1, 8), 16, 10).cast("bigint")
    return F.when(upto - less < 2, upto).otherwise(less + 1 + F.floor(share * (upto - less) / F.lit(1 << 32))).cast("int")


def write_warc(rows: DataFrame, out: str, key_col: str, url_col: str, payload_col: str, mime: str = "text/html; charset=utf-8",
               min_bytes: int = 0, roll_bytes: int = ROLL_BYTES, level: int = 6, ranges: int | None = None) -> DataFrame:
    """Write one record per row to the folder ``out`` (a URI that executors
    reach); returns the manifest (file, records, bytes, sha256).

    The payload is the column in UTF-8, null as empty; null url is empty. Of
    rows with equal payloads of at least ``min_bytes`` bytes the one with the
    largest key (null smallest; then the smallest url, then the first of
    repeated rows) is the response and the others are revisits. An empty table
    writes an empty manifest. ``out`` must not hold a manifest yet. ``ranges``
    (default: the session's shuffle partitions) and the rows decide every file.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "warc")
    r = rows.select(F.col(key_col).cast("bigint").alias("key"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                    F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    r = r.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    ids = scratch.keep(r.filter(F.octet_length("payload") >= min_bytes).select("key", "url", "sha"), "ids")
    first = F.min(F.struct(F.col("key").isNull().alias("z"), (-F.col("key")).alias("k"), "url")).alias("f")
    lead = ids.groupBy("sha").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    lead = scratch.keep(lead.select("sha", (-F.col("f.k")).alias("lead_key"), F.col("f.url").alias("lead_url")), "leaders")
    told = ids.join(lead, "sha").select("key", "url", "sha", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("mime"),
                                        F.lit(None).cast("binary").alias("payload"), "lead_key", "lead_url",
                                        (F.col("key").eqNullSafe(F.col("lead_key")) & (F.col("url") == F.col("lead_url"))).alias("leads")).distinct()
    recs = r.select("key", "url", "sha", F.lit(1).alias("kind"), F.lit(mime).alias("mime"), "payload",
                    F.lit(None).cast("bigint").alias("lead_key"), F.lit(None).cast("string").alias("lead_url"), F.lit(None).cast("boolean").alias("leads"))
    code = F.coalesce(F.col("key"), F.lit(-(2**63)).cast("bigint"))
    cuts = _cuts(rows.select(F.coalesce(F.col(key_col).cast("bigint"), F.lit(-(2**63)).cast("bigint")).alias("code")), ranges)
    both = recs.unionByName(told).select(_range_of(code, F.col("sha"), cuts).alias("range"), "*")
    both = both.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "key", "url", "sha", "kind")
    temp = f"{out}/_temporary"
    fs.FileSystem.from_uri(out)[0].create_dir(fs.FileSystem.from_uri(temp)[1], recursive=True)
    made = scratch.keep(both.mapInArrow(lambda it: _write_range(it, temp, roll_bytes, level), MANIFEST), "made")
    final = made.mapInArrow(lambda it: _commit(it, temp, out), "file string, records bigint, bytes bigint, sha256 string")
    final.write.parquet(f"{out}/manifest")
    delete_path(spark, temp)
    return spark.read.parquet(f"{out}/manifest")


def _records(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    rest, member, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(1 << 16)
        if not data:
            break
        parts.append(member.decompress(data))
        rest = member.unused_data
        if member.eof:
            yield b"".join(parts)
            member, parts = zlib.decompressobj(31), []


def _parse(raw: bytes) -> dict | None:
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    if h["WARC-Type"] == "warcinfo":
        return None
    block = block[:int(h["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, response = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"] == "response"
    number = lambda x: int(x) if x else None
    return {"key": number(h["X-Row-Key"]), "url": h["WARC-Target-URI"], "record_type": h["WARC-Type"], "payload_digest": digest,
            "payload_bytes": len(payload) if response else int(h["X-Payload-Length"]),
            "refers_to": None if response else number(h["X-Refers-To-Key"]), "record_id": h["WARC-Record-ID"],
            "payload": payload if response else None, "digest_ok": base32_sha1(payload) == digest if response else True}


def _read_files(batches: Iterator[pa.RecordBatch], out: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    where, root = fs.FileSystem.from_uri(out)
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def rows(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], t) for c, t in zip(names, types)], names=names)

    for batch in batches:
        for name in batch.column(0).to_pylist():
            held, size = [], 0
            with where.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for raw in _records(stream):
                    r = _parse(raw)
                    if r is None:
                        continue
                    if not payloads:
                        r["payload"] = None
                    held.append(r)
                    size += len(r["payload"] or b"") + 200
                    if size > 8 << 20:
                        yield rows(held)
                        held, size = [], 0
            if held:
                yield rows(held)


def read_warc(spark: SparkSession, out: str, payloads: bool = True) -> DataFrame:
    """The records of the files in the manifest of ``out``, one task per file at
    most; response payloads are checked against their digests (``digest_ok``)."""
    files = spark.read.parquet(f"{out}/manifest").select("file")
    return files.repartition("file").mapInArrow(lambda it: _read_files(it, out, payloads), RECORD)
