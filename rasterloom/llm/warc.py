"""Deterministic sharded WARC archives: range-sorted, rolled by compressed size, listed in a manifest."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "https://iipc.github.io/warc-specifications/")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard int, seq int, records long, bytes long, sha256 string, first_id long, last_id long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
#: Rows above which the table of repeated payloads is joined by a shuffle rather than broadcast.
BROADCAST_ROWS = 200_000


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}/{copy}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: tuple[int | None] | None, date: str, copy: int = 0) -> bytes:
    """One record; ``refers_to`` makes it a revisit, which has the headers but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest, copy)}", f"WARC-Date: {date}"]
    lines.append("WARC-Target-URI: " + (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if url is None:
        lines.append("Page-URL-Missing: true")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to[0], digest, 0)}"]
        if refers_to[0] is not None:
            lines.append(f"Refers-To-Page-ID: {refers_to[0]}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The parts of one record; the digests in its headers are checked against its bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(h["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or len(block) != int(h["Content-Length"]):
        raise ValueError(f"{h['WARC-Record-ID']}: cut short")
    if h["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"{h['WARC-Record-ID']}: block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{h['WARC-Record-ID']}: payload digest differs")
    number = lambda name: int(h[name]) if name in h else None
    return {
        "page_id": number("Page-ID"), "url": None if "Page-URL-Missing" in h else h["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": number("Refers-To-Page-ID"), "payload": payload if kind == "response" else None,
    }


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one by one: only one record is in memory."""
    data = b""
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                return
        one, parts = zlib.decompressobj(wbits=31), []
        while not one.eof:
            if not data:
                data = stream.read(chunk)
                if not data:
                    raise ValueError("the file ends inside a record")
            parts.append(one.decompress(data))
            data = one.unused_data if one.eof else b""
        yield b"".join(parts)


class _Roll:
    """The file being written: a temporary name until it is whole, then its own."""

    def __init__(self, store: fs.FileSystem, root: str, shard: int, seq: int):
        self.store, self.root, self.shard, self.seq = store, root, shard, seq
        self.name = f"shard-{shard:06d}-{seq:04d}.warc.gz"
        self.temporary = f"{root}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.out, self.sha, self.bytes, self.ids = store.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, []
        self.records, self.first, self.last = 0, None, None

    def add(self, page_id: int | None, packed: bytes) -> None:
        self.out.write(packed)
        self.sha.update(packed)
        self.bytes += len(packed)
        self.first = page_id if not self.records else self.first
        self.records, self.last = self.records + 1, page_id

    def commit(self) -> tuple:
        self.out.close()
        try:
            self.store.move(self.temporary, f"{self.root}/{self.name}")
        except OSError:  # some stores refuse to replace a file: that of a task run before is equal
            if self.store.get_file_info(f"{self.root}/{self.name}").size != self.bytes:
                raise
            self.store.delete_file(self.temporary)
        return self.name, self.shard, self.seq, self.records, self.bytes, self.sha.hexdigest(), self.first, self.last


def _splitters(rows: DataFrame, shard_bytes: int, sample_ids: int = 10_000) -> np.ndarray:
    """Identifiers that part the table into shards of about ``shard_bytes`` of payload.

    They come from about ``sample_ids`` identifiers chosen by a hash, so the same table always
    gives the same shards, however it is partitioned.
    """
    every = max(1, rows.count() // sample_ids)
    picked = rows.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0))
    sample = picked.groupBy("page_id").agg(F.sum("size").alias("size")).toPandas().sort_values("page_id")
    filled = np.cumsum(sample["size"].to_numpy(dtype=np.int64) * every) if len(sample) else np.zeros(0, np.int64)
    shards = max(1, int(round((filled[-1] if len(filled) else 0) / shard_bytes)))
    at = np.searchsorted(filled, np.arange(1, shards) * (filled[-1] / shards if len(filled) else 1))
    return np.unique(sample["page_id"].to_numpy(dtype=np.int64)[at]) if len(sample) else np.zeros(0, np.int64)


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 100,
    shard_bytes: int = 32 << 20, roll_bytes: int = 64 << 20, level: int = 3, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row below ``path`` and return the manifest.

    Of equal payloads of at least ``min_revisit_bytes`` the smallest identifier's record is the
    response and the others are revisits of it; of rows that are equal in identifier too, one is.
    Rows are sorted by identifier within shards; a shard rolls to a new file when its compressed
    size reaches ``roll_bytes``. The same table gives the same files, byte for byte: a task that
    runs again replaces a file by an equal one, and only what the manifest lists counts. Null
    payloads are empty; a null identifier sorts first and is no revisit's target unless all are
    null; null URLs are written as ``about:blank`` and read back as null. ``path`` must be in a
    store that pyarrow opens (a shared file system, HDFS, S3, GCS); the table may lie anywhere.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").alias("size"))
    cuts = _splitters(rows, shard_bytes)
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.col("size") >= min_revisit_bytes)
    repeated = large.groupBy("digest").agg(F.min("page_id").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "origin", F.lit(True).alias("again"))
    small = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(repeated) if small else repeated, "digest", "left")

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy(dtype=np.int64), "right")
        return pd.Series(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(f"{root}/_temporary", recursive=True)
        roll, done, before, copy = None, [], None, 0
        for batch in batches:
            for r in zip(*(batch.column(c) for c in ("shard", "page_id", "url", "payload", "size", "digest", "origin", "again"))):
                shard, page_id, url, body, size, digest, origin, again = (x.as_py() for x in r)
                copy = copy + 1 if before == (shard, page_id, digest) else 0
                before = (shard, page_id, digest)
                revisit = (origin,) if again and (page_id != origin or copy) else None
                one = zlib.compressobj(level, zlib.DEFLATED, 31)
                packed = one.compress(record(page_id, url, body, size, digest, revisit, date, copy)) + one.flush()
                if roll and (roll.shard != shard or roll.bytes + len(packed) > roll_bytes):
                    done.append(roll.commit())
                    roll = _Roll(store, root, shard, roll.seq + 1 if roll.shard == shard else 0)
                roll = roll or _Roll(store, root, shard, 0)
                roll.add(page_id, packed)
        if roll:
            done.append(roll.commit())
        if done:
            names = ["file", "shard", "seq", "records", "bytes", "sha256", "first_id", "last_id"]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    dealt = rows.withColumn("shard", shard_of("page_id")).repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", "url")
    written = dealt.select("shard", "page_id", "url", "payload", "size", "digest", "origin", "again").mapInArrow(run, MANIFEST)
    written.write.parquet(f"{path}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the files in the manifest, a file a task, one record in memory at a time."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    columns = [x.split()[0] for x in RECORD.split(", ")][: 7 if payloads else 6]
    schema = ", ".join(RECORD.split(", ")[: len(columns)])
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        kind = pa.schema([kinds.field(c) for c in columns])
        for batch in batches:
            for name, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out, held, seen = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        out.append(parse(raw))
                        held, seen = held + (len(raw) if payloads else 200), seen + 1
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(out, kind)
                            out, held = [], 0
                if seen != count:
                    raise ValueError(f"{name}: {seen} records, the manifest has {count}")
                yield pa.RecordBatch.from_pylist(out, kind)

    # a number of partitions of its own, else small manifests become one task
    files = manifest.select("file", "records").repartitionByRange(max(1, manifest.count()), "file")
    return files.mapInArrow(run, schema)
