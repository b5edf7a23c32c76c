"""Deterministic sharded WARC writer and reader.

Pages are put in order of their id and cut into shards of about
``shard_bytes`` by running byte totals over id buckets; heavy buckets are cut
further by payload digest, so a run of hot ids spans many shards. One task
sorts and writes a shard: every record is a gzip member of its own, headers,
record ids and digests are made anew from the payload, and a file is closed
when its compressed size passes ``roll_bytes``. Files are written under
temporary names that no other attempt uses; the names that count are those in
the manifest of the finished job, which are then moved to their final names
(again without harm, if a task is repeated) and the manifest is stored beside
them. The same pages give the same files, byte for byte.

Among records with equal payloads of at least ``revisit_bytes`` bytes, those
with the largest page id are responses and all others revisit it; a revisit
keeps the response's HTTP header block, length included, without its payload.

Defined results: null html is the empty payload and null url the empty address;
rows that repeat (page id, payload) are written each, of the same type; a null
page id is smaller than any other; an empty table writes no file and reads
back no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.util import need, pinned
from quarry.session import ensure_checkpoint_dir, shuffle_partitions

SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
ID_BUCKETS = 4096
DATE = "2024-01-01T00:00:00Z"
# Names and words of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary, file string")


def storage(uri: str):
    """(file system, path) of a shared folder; plain paths and any URI that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:sha1:{digest}>"


def record_bytes(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record with regenerated headers and digests."""
    digest = base32_digest(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in url)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id, digest)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{base32_digest(block)}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to, digest)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member; its header holds no time or name, so equal records give equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


class _Files:
    """The open file of a task: temporary name, running size and digest."""

    def __init__(self, root: str, roll: int):
        self.fs, self.path = storage(root)
        self.roll, self.attempt = roll, uuid.uuid4().hex
        self.out, self.shard, self.number = None, None, 0
        self.done: list[tuple] = []

    def write(self, shard: int, data: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        if self.out is None:
            self.name = f"part-{shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f".{self.name}.{self.attempt}.tmp"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.records, self.size, self.digest = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.digest.update(data)
        self.records += 1
        self.size += len(data)
        if self.size >= self.roll:
            self.close()
            self.number += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.name, self.temporary, self.records, self.size, self.digest.hexdigest()))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _shards(narrow: DataFrame, shard_bytes: int) -> tuple[DataFrame, int, int]:
    """(bucket -> first shard, shards) with at most ID_BUCKETS + 2 rows, and the bucket rule's origin and width."""
    low, high = narrow.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) // ID_BUCKETS))
    sizes = (narrow.groupBy(_bucket(low, width).alias("bucket"))
             .agg(F.sum(F.col("n_bytes") + 512).alias("size"))
             .withColumn("parts", F.ceil(F.col("size") / F.lit(float(shard_bytes))).cast("long")))
    # light buckets share a shard, heavy ones take several of their own
    heavy = F.col("parts") > 1
    run = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(heavy, 0).otherwise(F.col("size"))).over(run), F.lit(0))
    shards = F.coalesce(F.sum(F.when(heavy, F.col("parts") + 1).otherwise(0)).over(run), F.lit(0))
    out = sizes.select("bucket", F.when(heavy, F.col("parts")).otherwise(F.lit(1)).alias("parts"),
                       (shards + F.when(heavy, F.lit(1)).otherwise(0)
                        + F.floor(before / F.lit(float(shard_bytes)))).cast("long").alias("first"))
    return out, low, width


def _bucket(low: int, width: int):
    return F.coalesce(F.floor((F.col("page_id") - F.lit(low)) / F.lit(width)).cast("long"), F.lit(-1).cast("long"))


def write_archives(pages: DataFrame, root: str, revisit_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
                   roll_bytes: int = ROLL_BYTES, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Write the archives under ``root`` and return the committed manifest."""
    need(pages, page_id, url, html)
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    narrow = pinned(rows.select("page_id", "sha", F.length("payload").cast("long").alias("n_bytes")))
    shared = (narrow.filter(F.col("n_bytes") >= revisit_bytes).groupBy("sha")
              .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    verdicts = (narrow.join(shared, "sha")
                .filter(F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper")))
                .select("page_id", "sha", "keeper").distinct())
    shards, low, width = _shards(narrow, shard_bytes)
    both = (rows.select("page_id", "sha", F.lit(1).alias("tag"), "url", "payload", F.lit(None).cast("long").alias("keeper"))
            .unionByName(verdicts.select("page_id", "sha", F.lit(0).alias("tag"), F.lit(None).cast("string").alias("url"),
                                         F.lit(None).cast("binary").alias("payload"), "keeper")))
    slot = F.pmod(F.conv(F.substring("sha", 1, 8), 16, 10).cast("long"), F.col("parts"))
    placed = (both.withColumn("bucket", _bucket(low, width)).join(F.broadcast(shards), "bucket")
              .withColumn("shard", F.col("first") + slot).drop("bucket", "first", "parts"))
    laid = (placed.repartition(shuffle_partitions(spark), "shard")
            .sortWithinPartitions("shard", "page_id", "sha", "tag", "url"))
    schema = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()),
                        ("bytes", pa.int64()), ("sha256", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, verdict = None, None
        for b in batches:
            for pid, sha, tag, address, payload, keeper, shard in zip(*(b.column(c).to_pylist() for c in (
                    "page_id", "sha", "tag", "url", "payload", "keeper", "shard")), strict=True):
                if tag == 0:
                    verdict = (pid, sha, keeper)
                    continue
                revisit = verdict is not None and verdict[:2] == (pid, sha)
                files = files or _Files(root, roll_bytes)
                files.write(shard, member(record_bytes(pid, address, payload, verdict[2] if revisit else None, revisit)))
        if files:
            files.close()
            yield _table(files.done, schema)

    fs, path = storage(root)
    fs.create_dir(path, recursive=True)
    written = pinned(laid.mapInArrow(write, MANIFEST))

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = storage(root)
        for b in batches:
            for r in b.to_pylist():
                if fs.get_file_info(f"{path}/{r['temporary']}").is_file:
                    fs.move(f"{path}/{r['temporary']}", f"{path}/{r['name']}")
                if fs.get_file_info(f"{path}/{r['name']}").size != r["bytes"]:
                    raise OSError(f"archive {r['name']} is not whole")
            yield b

    manifest = pinned(written.mapInArrow(commit, MANIFEST))
    manifest.write.mode("overwrite").json(f"{root}/_manifest")
    return manifest


def _headers(stream) -> dict[str, str] | None:
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    head = {}
    for raw in iter(stream.readline, b"\r\n"):
        if not raw:
            raise ValueError("the file ends inside a header")
        name, _, value = raw.decode().partition(":")
        head[name.strip().lower()] = value.strip()
    return head


def parse_records(stream) -> Iterator[tuple]:
    """(page_id, url, payload length, digest, type, refers_to, payload) of every record; digests are verified."""
    while (head := _headers(stream)) is not None:
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size or base32_digest(block) != head["warc-block-digest"].removeprefix("sha1:"):
            raise ValueError(f"damaged record {head['warc-record-id']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(h.split(b":")[1]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        revisit = head["warc-type"] == "revisit"
        if not revisit and (len(payload) != length or base32_digest(payload) != digest):
            raise ValueError(f"damaged payload in {head['warc-record-id']}")
        number = lambda x: int(p) if (p := x.split(":")[2]) else None
        yield (number(head["warc-record-id"]), head["warc-target-uri"], length, digest, head["warc-type"],
               number(head["warc-refers-to"]) if revisit else None, None if revisit else payload)


def read_archives(spark: SparkSession, root: str, manifest: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """Records of all files of the manifest; one task reads a file as a stream."""
    manifest = spark.read.schema(MANIFEST).json(f"{root}/_manifest") if manifest is None else manifest
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary()), ("file", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        fs, path = storage(root)
        for b in batches:
            for name in b.column("name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for r in parse_records(stream):
                        rows.append((*r[:6], r[6] if payloads else None, name))
                        held += len(r[6] or b"") if payloads else 256
                        if held > 8 << 20:
                            yield _table(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _table(rows, schema)

    return manifest.select("name").repartition(shuffle_partitions(spark)).mapInArrow(read, RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
