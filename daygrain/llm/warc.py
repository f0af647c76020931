"""A deterministic sharded WARC writer and its reader.

Pages are put into shards of near-equal payload bytes, contiguous in the order
of (page id, payload digest): a page's shard is its global byte offset over the shard
size, so cuts depend on the pages alone. A task takes a range of whole shards. There
are at most as many ranges as shuffle partitions, and only where each range
begins is known to the driver and to every task; offsets inside a range are a running
sum of its writer. A task sorts its records and writes each shard
to files that roll over once ``roll_bytes`` of compressed records are in them.
Headers, record ids, block and payload digests are made anew; every record is a
gzip member of its own. A file is written under a temporary name and renamed
when complete; a repeated task writes the same bytes to the same name. Spark
commits the list of files as the manifest, and readers open only what it names,
so an archive is there as a whole or not at all.

Of records with equal payloads of at least ``min_bytes`` the one with the
smallest id is a response, the others are revisits that refer to it; smaller
payloads are all responses. Of rows that repeat id and payload one is the
response. A null payload counts as empty, a null url leaves out the target
header, a null id ranks last and is written as ``null``. Rows that repeat id and
payload are written by one task, to as many shards as they fill. An empty table gives an
archive without files and an empty result; other columns are never looked at.

Digests of a payload are counted before they are shuffled, and only payloads
that occur twice are joined back, without their text. Payloads move once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm.common import delete_on_exit, shuffle_partitions, stored, table, text_or_empty
from daygrain.llm.sharding import laid_out
from daygrain.session import scratch_path

SHARD_BYTES = 64 << 20
ROLL_BYTES = 8 << 20
#: What a record's headers count for in the size of a shard.
OVERHEAD = 512
LAST = (1 << 63) - 1
DATE = "2026-01-01T00:00:00Z"
LEVEL = 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, records long, bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    tail = f":{copy}" if copy else ""
    return f"<urn:x-page:{'null' if page_id is None else page_id}:{digest}{tail}>"


def page_of(record: str) -> int | None:
    page = record.strip("<>").split(":")[2]
    return None if page == "null" else int(page)


def make_record(page_id, url, payload: bytes, first_id, revisit: bool, copy: int, date: str = DATE) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head, which states the payload's length, and no payload."""
    digest = base32_sha1(payload)
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page_id, digest, copy)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first_id, digest)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # a gzip header without name or time
    return packer.compress(record) + packer.flush()


class ShardFiles:
    """The files of the shards one task writes, one open at a time."""

    def __init__(self, folder: str, roll_bytes: int):
        self.fs, self.folder = arrow_fs.FileSystem.from_uri(folder)
        self.roll, self.out, self.shard, self.number, self.done = roll_bytes, None, None, 0, []

    def add(self, shard: int, packed: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        if self.out is None:
            self.name = f"pages-{shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = posixpath.join(self.folder, f".{self.name}.{uuid.uuid4().hex}.tmp")
            self.out, self.records, self.bytes = self.fs.open_output_stream(self.temporary, compression=None), 0, 0
        self.out.write(packed)
        self.records += 1
        self.bytes += len(packed)
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        final = posixpath.join(self.folder, self.name)
        try:
            self.fs.move(self.temporary, final)
        except OSError:
            if self.fs.get_file_info(final).type != arrow_fs.FileType.File:
                raise
            self.fs.delete_file(self.temporary)  # an earlier attempt left the same bytes under the name
        self.done.append((self.name, self.shard, self.records, self.bytes))
        self.number += 1

    def taken(self) -> pd.DataFrame:
        frame = pd.DataFrame(self.done, columns=["file", "shard", "records", "bytes"])
        self.done = []
        return frame


def ranges(slim: DataFrame, shard_bytes: int, most: int) -> list[tuple[int, str, int, int]]:
    """(id, digest, offset, shard) at which each of at most ``most`` ranges of shards begins, in order.

    ``slim`` has id (null: ``LAST``), digest and size. Rows that repeat id and digest stay in
    one range, that of the first of them.
    """
    offsets = stored(laid_out(slim.select(F.col("id").alias("hash"), F.col("digest").alias("id"), "size")), "page-offsets")
    total = offsets.agg(F.max(F.col("start") + F.col("size"))).first()[0] or 0
    per_range = max(1, -(-(-(-total // shard_bytes)) // most))  # shards
    heads = offsets.groupBy(F.floor(F.col("start") / (shard_bytes * per_range)).alias("range")).agg(
        F.min(F.struct("hash", "id")).alias("key")
    )
    heads = heads.groupBy("key.hash", "key.id").agg(F.min("range").alias("range"))  # at most ``most`` rows
    found = offsets.join(F.broadcast(heads), ["hash", "id"]).groupBy("hash", "id", "range").agg(F.min("start").alias("start"))
    return sorted((r["hash"], r["id"], r["start"], r["range"] * per_range) for r in found.collect())


def _writer(folder: str, heads: list[tuple[int, str, int, int]], shard_bytes: int, roll_bytes: int, date: str):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, now, key, first, copy = None, None, None, None, 0
        for frame in frames:
            files = files or ShardFiles(folder, roll_bytes)
            for part, id, digest, kind, url, html, first_id in zip(
                frame.part, frame.id, frame.digest, frame.kind, frame.url, frame.html, frame.first_id
            ):
                if part != now:
                    now, (offset, least) = part, heads[part][2:]
                id = None if pd.isna(id) else int(id)
                if (id, digest) != key:
                    key, first, copy = (id, digest), None, 0
                if kind == 0:  # what the next records' payload was first seen as
                    first = (None if pd.isna(first_id) else int(first_id),)
                    continue
                revisit = first is not None and (first[0] != id or copy > 0)
                target = None if url is None or pd.isna(url) else url
                payload = html.encode()
                record = make_record(id, target, payload, first[0] if first else None, revisit, copy, date)
                files.add(max(least, offset // shard_bytes), member(record))
                offset += len(payload) + OVERHEAD
                copy += 1
            if files.done:
                yield files.taken()
        if files:
            files.close()
            yield files.taken()

    return write


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared scratch space, as a full address that tasks can open."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = system.makeQualified(path)
    system.mkdirs(full)
    folder = re.sub(r"^file:/+", "file:///", full.toString())
    delete_on_exit(spark, folder)
    return folder


def write_archive(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = DATE,
) -> DataFrame:
    """Write all pages to WARC files in ``folder`` and return the committed manifest."""
    spark = pages.sparkSession
    payload = text_or_empty(F.col(html))
    rows = pages.select(
        F.col(id).cast("long").alias("id"), F.sha1(payload.cast("binary")).alias("digest"), F.col(url).alias("url"),
        payload.alias("html"), F.octet_length(payload).cast("long").alias("size"),
    )
    slim = stored(rows.select("id", "digest", "size"), "page-digests")
    repeated = (
        slim.filter(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
        .filter("n > 1")
        .drop("n")
    )
    decisions = slim.filter(F.col("size") >= min_bytes).join(repeated, "digest").select("id", "digest", "first_id").distinct()

    last = F.coalesce(F.col("id"), F.lit(LAST))
    heads = ranges(
        slim.select(last.alias("id"), "digest", (F.col("size") + OVERHEAD).alias("size")), shard_bytes, shuffle_partitions(spark)
    )
    keys = [head[:2] for head in heads]

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, digests: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(keys, key) - 1 for key in zip(ids, digests)], dtype="int32")

    nothing = F.lit(None)
    both = rows.select("id", "digest", F.lit(1).alias("kind"), "url", "html", nothing.cast("long").alias("first_id")).union(
        decisions.select("id", "digest", F.lit(0), nothing.cast("string"), nothing.cast("string"), "first_id")
    )
    placed = both.withColumn("part", range_of(last, "digest")).repartitionById(max(1, len(heads)), "part")
    ordered = placed.sortWithinPartitions("part", last, "digest", F.col("id").asc_nulls_last(), "kind")
    manifest = ordered.select("part", "id", "digest", "kind", "url", "html", "first_id").mapInPandas(
        _writer(folder, heads, shard_bytes, roll_bytes, date), MANIFEST
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an opened, decompressed archive."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


def read_back(headers: dict[str, str], block: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), with both digests checked."""
    if base32_sha1(block) != headers["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError(f"block of {headers['warc-record-id']} does not match its digest")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)^content-length: *(\d+)", head, re.M)[1])
    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    refers = page_of(headers["warc-refers-to"]) if kind == "revisit" else None
    return page_of(headers["warc-record-id"]), size, digest, kind, refers


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the files that ``manifest`` names; each task streams through its files."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = arrow_fs.FileSystem.from_uri(folder)
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for frame in frames:
            for name in frame.file:
                with fs.open_input_stream(posixpath.join(base, name), compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows = [read_back(*r) for r in read_records(stream)]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    n = min(manifest.count(), shuffle_partitions(manifest.sparkSession))
    return manifest.repartition(max(1, n)).mapInPandas(read, RECORDS)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    return read_archive(write_archive(table(spark, sf_dir, "pages"), folder), folder)


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((twenty[{g}] >> {shift}) & 31)::INT, 1)"
    for g in range(1, 9)
    for shift in (15, 10, 5, 0)
)

#: A SHA-1 in base32: eight times twenty bits, four digits each.
OP6_SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
digested AS (
  SELECT page_id, strlen(payload) AS payload_bytes, hex,
         list_transform(range(8), lambda g: ('0x' || substr(hex, 5 * g::INT + 1, 5))::BIGINT) AS twenty
  FROM payloads)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM digested WINDOW same AS (PARTITION BY hex)
"""
