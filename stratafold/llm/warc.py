"""A deterministic sharded WARC writer and its reader.

Records go to shards of page-id ranges whose bounds depend on the rows alone, in id order; a
shard rolls to its next file once the compressed size passes a limit. Headers and digests
are made anew. Every attempt of a task writes under temporary names of its own; the manifest,
a table, has the files of the attempts that counted, and only those are renamed and read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.llm.common import parts_of, range_index, sampled_splits, stored, table
from stratafold.session import new_folder

REVISIT_FROM = 1000
FILE_BYTES = 64 << 20
SHARD_BYTES = 256 << 20
#: A small table has shards of this many bytes, up to this many of them.
FEWEST_BYTES, FEW_SHARDS = 1 << 20, 64
MOST_SHARDS = 1 << 17
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "shard int, seq int, name string, temp string, records bigint, bytes bigint, sha256 string"
_RECORDS = ("page_id bigint, url string, record_type string, payload_bytes bigint, "
            "payload_digest string, refers_to bigint, payload binary")


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (file, hdfs, s3, ...) and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member without a time stamp."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _page(page_id, url, payload: bytes, refers_to, revisit: bool, copy: int, level: int) -> bytes:
    digest = _sha1(payload)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + b"\r\n\r\n" + (b"" if revisit else payload))
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _record_id(page_id, digest, copy)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")))
    headers += [("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _sha1(block)),
                ("Content-Type", "application/http;msgtype=response")]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)),
                    ("X-Refers-To-Page-Id", str(refers_to))]
    return _member(headers, block, level)


class _Shard:
    """The files of one shard, one open at a time."""

    def __init__(self, store, folder: str, shard: int, file_bytes: int, level: int):
        self.store, self.folder, self.shard, self.level = store, folder, shard, level
        self.file_bytes, self.seq, self.out = file_bytes, 0, None

    def _open(self):
        self.name = f"shard-{self.shard:06d}-{self.seq:05d}.warc.gz"
        self.temp = f"{self.name}.{uuid.uuid4().hex}.tmp"
        self.out = self.store.open_output_stream(f"{self.folder}/{self.temp}", compression=None)
        self.size, self.records, self.sum = 0, 0, hashlib.sha256()
        info = b"format: WARC File Format 1.1\r\n"
        self._write(_member([("WARC-Type", "warcinfo"), ("WARC-Filename", self.name),
                             ("WARC-Record-ID", _record_id(None, self.name)), ("WARC-Date", DATE),
                             ("Content-Type", "application/warc-fields")], info, self.level))

    def _write(self, data: bytes):
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)

    def add(self, record: bytes) -> list[tuple]:
        if self.out is None:
            self._open()
        self._write(record)
        self.records += 1
        return self.close() if self.size >= self.file_bytes else []

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        self.out.close()
        self.out, self.seq = None, self.seq + 1
        return [(self.shard, self.seq - 1, self.name, self.temp, self.records, self.size, self.sum.hexdigest())]


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("binary"), F.lit("").cast("binary"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES,
               revisit_from: int = REVISIT_FROM, level: int = 4) -> DataFrame:
    """One record per row below ``path``; gives the manifest, also stored there as a table.

    Of rows with equal payloads of at least ``revisit_from`` bytes that with the largest id
    is a response and the others revisit it (rows that repeat that id and payload are
    responses too). A null payload is empty, a null url leaves its header out; rows without
    an id are written first and never revisited. The same rows give the same files, however
    they are partitioned. No rows give no files.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"),
                        _payload(F.col(html_col)).alias("payload"))
    facts = stored(rows.select("id", F.sha1("payload").alias("sha1"),
                               F.octet_length("payload").cast("bigint").alias("size")), "warc_facts")
    total = facts.agg(F.sum("size")).first()[0] or 0
    shards = min(MOST_SHARDS, max(1, min(FEW_SHARDS, total // FEWEST_BYTES), total // shard_bytes))
    splits = sampled_splits(facts, "id", shards)
    large = facts.where(F.col("size") >= revisit_from)
    heads = large.groupBy("sha1").agg(F.max("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = large.join(heads.drop("n"), "sha1").where("head is not null and not (id <=> head)").select(
        "id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        "sha1", "head", F.lit(0).alias("kind")).distinct()
    both = revisits.unionByName(rows.select(
        "*", F.sha1("payload").alias("sha1"), F.lit(None).cast("bigint").alias("head"),
        F.lit(1).alias("kind")))
    least = F.lit(-(1 << 63))
    placed = both.withColumn("shard", range_index(splits)(F.coalesce("id", least)))
    # Copies of an id and payload lie side by side, after the row that says what they revisit.
    placed = placed.repartitionById(max(1, len(splits)), "shard").sortWithinPartitions(
        "shard", "id", "sha1", "kind", F.xxhash64("url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        store.create_dir(folder, recursive=True)
        out, page, refers_to, revisit, copy, done = None, None, None, False, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for shard, page_id, kind, url, payload, sha1, head in zip(
                        *(batch.column(i).slice(at, 256).to_pylist() for i in range(7))):
                    if out is None or out.shard != shard:
                        done += out.close() if out else []
                        out, page = _Shard(store, folder, shard, file_bytes, level), None
                    if page != (page_id, sha1):
                        page, refers_to, revisit, copy = (page_id, sha1), None, False, 0
                    if kind == 0:
                        refers_to, revisit = head, True
                        continue
                    done += out.add(_page(page_id, url, payload, refers_to, revisit, copy, level))
                    copy += 1
        done += out.close() if out else []
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("shard", "seq", "name", "temp", "records", "bytes", "sha256"), row)) for row in done],
            schema=_arrow(_MANIFEST))

    written = stored(placed.select("shard", "id", "kind", "url", "payload", "sha1", "head")
                     .mapInArrow(write, _MANIFEST), "warc_written")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        for batch in batches:
            for name, temp, size in zip(*(batch.column(i).to_pylist() for i in (2, 3, 5))):
                if store.get_file_info(f"{folder}/{temp}").type == fs.FileType.File:
                    store.move(f"{folder}/{temp}", f"{folder}/{name}")
                if store.get_file_info(f"{folder}/{name}").size != size:
                    raise OSError(f"{name}: its size is not that of the manifest")
            yield batch

    manifest = written.repartition(parts_of(spark), "name").mapInArrow(rename, _MANIFEST)
    manifest.write.parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b":")
            headers[key.decode().lower()] = value.decode().strip()
        yield headers, stream.read(int(headers["content-length"]))


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The page records of the files in the manifest, with the digests checked again.

    A revisit has the size and digest of the full payload, and null as its payload.
    """
    schema = _arrow(_RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{folder}/{name}", compression=None) as raw:
                    for head, block in _records(io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16)):
                        if head["warc-type"] == "warcinfo":
                            continue
                        if _sha1(block) != head["warc-block-digest"]:
                            raise ValueError(f"{name}: a block differs from its digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.lower().partition(b"content-length:")[2].split(b"\r\n")[0])
                        digest, whole = head["warc-payload-digest"], head["warc-type"] == "response"
                        if whole and (_sha1(payload) != digest or len(payload) != size):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        number = lambda key: int(head[key]) if key in head else None
                        rows.append({
                            "page_id": number("x-page-id"), "url": head.get("warc-target-uri"),
                            "record_type": head["warc-type"], "payload_bytes": size,
                            "payload_digest": base64.b32decode(digest[5:]).hex(),
                            "refers_to": number("x-refers-to-page-id"),
                            "payload": payload if whole and with_payload else None})
                        held += len(payload) if with_payload else 200
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = read_manifest(spark, path).select("name").repartition(parts_of(spark), "name")
    return files.mapInArrow(read, _RECORDS)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, with_payload=False).drop("payload", "url")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
             max(page_id) OVER (PARTITION BY html) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN head END AS refers_to
FROM d"""
