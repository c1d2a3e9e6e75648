"""Deterministic sharded WARC writer (operator 12).

One ISO 28500 (WARC/1.1) record per page, each a gzip member of its own. The block of
a ``response`` is an HTTP message with regenerated headers and the page's html as its
payload; a ``revisit`` has the HTTP headers alone and names the record it repeats.

*Order and shards.* Records stand in the order of (page_id, digest of the payload,
url). Their running size in that order cuts them into shards of ``SHARD_BYTES``; the cuts
come from a range sort of (page_id, digest, size), without any html. So a record's shard
depends on the rows alone, not on how Spark has dealt them, and the html is shuffled once.

*Files.* A task writes one shard and begins a new file when the compressed size
reaches ``FILE_BYTES``. Headers, record ids and digests are made from the record, dates
are a parameter, gzip members carry no time: the same rows give the same bytes.

*Commit.* Files get temporary names that no other attempt has. The names of those
whose task succeeded are gathered in a written table; a second job renames them (a
repeated rename finds its work done); then the manifest is written, with name, size,
number of records and SHA-256 of each file. Readers go by the manifest alone, and check it.
What failed attempts leave is removed once the manifest stands.

*Revisits.* Of the records that have one payload of at least ``LEAST_BYTES`` bytes, the one
with the largest page_id is the response. Groups are partial aggregates of (SHA-256,
length); both sides of the join back are written tables, so Spark can split a hot group.

Defined results: null html is empty, a null page_id below all others. Rows that repeat
the largest page_id of their payload are all responses. A null url has no target
header, line breaks in one are percent-encoded. An empty table gives a manifest without
files and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, drop_caches, materialise, read_table, ship_package, shared_path

LEAST_BYTES = 1000
#: Size of a shard before compression, and of a file after it.
SHARD_BYTES, FILE_BYTES = 64 << 20, 24 << 20
#: What a record takes besides its payload, about.
RECORD_BYTES = 700
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6
CHUNK = 1 << 20
MANIFEST = ("shard int, seq int, name string, records bigint, bytes bigint, sha256 string")
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    """The urn of a record, from page_id and SHA-256 of its payload."""
    return f"urn:uuid:{uuid.UUID(hashlib.sha256(f'{page_id}:{digest}'.encode()).hexdigest()[:32], version=5)}"


def sha1(data: bytes) -> str:
    """As WARC headers write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool, date: str = DATE) -> bytes:
    """One WARC record. ``refers_to`` is the page whose record a revisit repeats."""
    http = HTTP.format(len(payload)).encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.strip().replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest)}>",
                  f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: {sha1(payload)}", f"WARC-Block-Digest: {sha1(block)}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member without a time."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Rolling:
    """Writes the records of one shard, file by file."""

    def __init__(self, folder: str, shard: int, most: int):
        self.folder, self.shard, self.most = folder, shard, most
        self.stream, self.seq, self.done = None, 0, []

    def _open(self) -> None:
        self.path = f"{self.folder}/_temporary/{self.shard:06d}-{self.seq:04d}-{uuid.uuid4().hex}"
        store, where = fs.FileSystem.from_uri(self.path)
        store.create_dir(where.rpartition("/")[0])
        self.stream, self.records, self.size, self.hash = store.open_output_stream(where), 0, 0, hashlib.sha256()

    def add(self, packed: bytes) -> None:
        if self.stream is not None and self.size + len(packed) > self.most:
            self.close()
        if self.stream is None:
            self._open()
        self.stream.write(packed)
        self.hash.update(packed)
        self.records += 1
        self.size += len(packed)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.shard, self.seq, f"part-{self.shard:06d}-{self.seq:04d}.warc.gz", self.records,
                              self.size, self.hash.hexdigest(), self.path))
            self.stream, self.seq = None, self.seq + 1


def _payload(pages: DataFrame) -> Column:
    return F.coalesce(col(pages, "html"), F.lit("")).cast("binary")


def _facts(pages: DataFrame) -> DataFrame:
    """(page_id, digest, bytes) of each row, written; no html."""
    data = _payload(pages)
    return materialise(pages.select(col(pages, "page_id").cast("bigint").alias("page_id"),
                                    F.sha2(data, 256).alias("digest"), F.octet_length(data).cast("bigint").alias("bytes")), "pages")


def _key(page_id, digest) -> tuple:
    return (page_id is not None, page_id or 0, digest)


def shard_cuts(facts: DataFrame, shard_bytes: int) -> list[tuple]:
    """Last (page_id, digest) key of every shard but the last, in order.

    One row per shard comes to the driver. Rows of one (page_id, digest) share a shard.
    """
    order = [F.col("page_id").asc_nulls_first(), F.col("digest")]
    sized = facts.groupBy("page_id", "digest").agg(F.sum(F.col("bytes") + RECORD_BYTES).alias("size"))
    dealt = materialise(sized.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "part", F.spark_partition_id()), "sorted")
    before, at = {}, 0
    for r in dealt.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").collect():  # one row per partition
        before[r.part], at = at, at + r.size

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        at = part = None
        for batch in batches:
            found = []
            for i, (size, p) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if p != part:
                    part, at = p, before[p]
                if at // shard_bytes != (at + size) // shard_bytes and at + size < before["all"]:
                    found.append(i)  # the shard ends with this row
                at += size
            yield batch.select(["page_id", "digest"]).take(pa.array(found, pa.int64()))

    before["all"] = at
    ship_package(facts.sparkSession)
    ends = dealt.repartitionById(max(1, len(before) - 1), F.col("part")).sortWithinPartitions("part", *order).select(
        "page_id", "digest", "size", "part").mapInArrow(cuts, "page_id bigint, digest string")
    return sorted(_key(r.page_id, r.digest) for r in ends.collect())


def write(pages: DataFrame, folder: str, least: int = LEAST_BYTES, shard_bytes: int = SHARD_BYTES,
          file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC files below ``folder``; gives the manifest."""
    spark = pages.sparkSession
    ship_package(spark)
    facts = _facts(pages)
    cuts = spark.sparkContext.broadcast(shard_cuts(facts, shard_bytes))  # one key per shard
    shards = len(cuts.value) + 1
    kept = materialise(facts.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1 and kept is not null").drop("n"), "kept")
    revisits = facts.join(kept, ["digest", "bytes"]).where(~F.col("page_id").eqNullSafe(F.col("kept"))).select(
        "page_id", "digest", "kept").distinct()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            keys = zip(batch.column("page_id").to_pylist(), batch.column("digest").to_pylist())
            shard = [bisect_left(cuts.value, _key(*k)) for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, known = None, None
        for batch in batches:
            for shard, page_id, digest, kept_, url, data in _rows(batch):
                if data is None:  # what is known of the pages that follow
                    known = (page_id, digest, kept_)
                    continue
                if rolling is None or rolling.shard != shard:
                    if rolling is not None:
                        rolling.close()
                        yield _files(rolling.done)
                    rolling = Rolling(folder, shard, file_bytes)
                revisit = known is not None and known[:2] == (page_id, digest)
                rolling.add(member(record(page_id, url, data, digest, known[2] if revisit else None, revisit, date)))
        if rolling is not None:
            rolling.close()
            yield _files(rolling.done)

    full = "page_id bigint, digest string, kept bigint, url string, data binary"
    data = _payload(pages)
    rows = pages.select(col(pages, "page_id").cast("bigint").alias("page_id"), F.sha2(data, 256).alias("digest"),
                        F.lit(None).cast("bigint").alias("kept"), col(pages, "url").cast("string").alias("url"), data.alias("data"))
    both = rows.unionByName(revisits, allowMissingColumns=True).mapInArrow(deal, full + ", shard int")
    written = materialise(both.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_first(), "digest", F.col("data").isNotNull(), F.col("url").asc_nulls_first()).select(
        "shard", "page_id", "digest", "kept", "url", "data").mapInArrow(put, MANIFEST + ", path string"), "warc-written")
    return commit(written, folder)


def _rows(batch: pa.RecordBatch, size: int = 256) -> Iterator[tuple]:
    for a in range(0, batch.num_rows, size):
        yield from zip(*(c.to_pylist() for c in batch.slice(a, size).columns))


def _files(done: list[tuple]) -> pa.RecordBatch:
    names = ["shard", "seq", "name", "records", "bytes", "sha256", "path"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names)


def commit(written: DataFrame, folder: str) -> DataFrame:
    """Gives the files of ``written`` their names and writes the manifest, which makes them the archive."""
    spark = written.sparkSession

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            for path, name in zip(batch.column("path").to_pylist(), batch.column("name").to_pylist()):
                store, where = fs.FileSystem.from_uri(path)
                _, target = fs.FileSystem.from_uri(f"{folder}/{name}")
                if store.get_file_info(where).type != fs.FileType.NotFound:
                    store.move(where, target)
                elif store.get_file_info(target).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{path} is lost")
            yield batch.select(["shard", "seq", "name", "records", "bytes", "sha256"])

    where = f"{folder}/manifest"
    written.mapInArrow(rename, MANIFEST).write.parquet(where)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return spark.read.schema(MANIFEST).parquet(where)


def members(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The members of a gzip stream, one at a time."""
    rest, unpack, out = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(chunk)
        if not data:
            break
        out.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(out)
            unpack, out = zlib.decompressobj(31), []
    if out and any(out):
        raise ValueError("the file ends within a record")


def parse(data: bytes) -> dict:
    """Headers (lower-case names), and ``payload`` of one record; checks the block's length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    out = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    n = int(out["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n" or sha1(block) != out["warc-block-digest"]:
        raise ValueError(f"record {out.get('warc-record-id')} is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    out["payload"] = payload
    out["payload_bytes"] = int(http.rpartition(b"Content-Length: ")[2])
    return out


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of each record of the archive.

    The payload of a revisit is null: the record it refers to has it.
    """
    ship_package(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    schema = ("page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, "
              "record_type string, refers_to bigint")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            for name, records in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                store, where = fs.FileSystem.from_uri(f"{folder}/{name}")
                rows, size, found = [], 0, 0
                with store.open_input_file(where) as stream:
                    for data in members(stream):
                        r = parse(data)
                        revisit = r["warc-type"] == "revisit"
                        digest = base64.b32decode(r["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if not revisit and (len(r["payload"]) != r["payload_bytes"] or
                                            hashlib.sha1(r["payload"]).hexdigest() != digest):
                            raise ValueError(f"{r['warc-record-id']}: another payload than its headers say")
                        page, other = r.get("x-page-id"), r.get("x-refers-to-page-id")
                        rows.append((None if page is None else int(page), r.get("warc-target-uri"),
                                     None if revisit else r["payload"], r["payload_bytes"], digest, r["warc-type"],
                                     None if other is None else int(other)))
                        size, found = size + len(data), found + 1
                        if size >= CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                if found != records:
                    raise ValueError(f"{name}: {found} records, the manifest says {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    n = max(1, manifest.count())
    dealt = manifest.repartition(n, "name")
    return dealt.select("name", "records").mapInArrow(run, schema)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    write(read_table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op12_warc": op12_warc}
ORACLE_SQL = {"op12_warc": """
with p as (select page_id, coalesce(html, '') as payload from pages),
k as (select *, strlen(payload) as payload_bytes, max(page_id) over (partition by payload) as kept from p)
select page_id, payload_bytes, sha1(payload) as payload_digest,
  case when payload_bytes >= 1000 and page_id is distinct from kept then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id is distinct from kept then kept end as refers_to
from k
"""}
