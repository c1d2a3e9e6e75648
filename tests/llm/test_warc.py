import gzip
import hashlib
import io
import os
import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from blocklot.llm import warc
from blocklot.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, digest string, SHARD int, bytes long"


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(i, u, t, "x", 1, 2) for i, u, t in rows], SCHEMA)
    return make


def expected(rows):
    data = [(i, (t or "").encode()) for i, _, t in rows]
    best = {}
    for i, d in data:
        if len(d) >= warc.LEAST_BYTES and i is not None:
            best[d] = max(best.get(d, i), i)
    out = []
    for i, d in data:
        revisit = d in best and best[d] != i
        out.append((i, len(d), hashlib.sha1(d).hexdigest(), "revisit" if revisit else "response", best[d] if revisit else None))
    return sorted(out, key=repr)


def odd_rows():
    random.seed(3)
    big, other = "ä" * 600, "x" * 999
    rows = [(7, "http://a/1", big), (3, "http://a/2", big), (None, None, big), (7, "http://a/3", big), (7, "http://a/1", big),
            (5, "http://b/\r\nX: y", other), (6, None, other), (8, "http://c", None), (9, "http://c", ""),
            (10, "http://d/é", "\x00\r\n\r\nWARC/1.1\r\n"), (11, "http://e", "long " * 300_000), (-4, "", big),
            (None, "http://n", "only null" * 200), (None, "http://n2", "only null" * 200)]
    rows += [(100 + k, f"http://x/{k}", random.choice("pqrs") * random.choice([3, 1000, 5000])) for k in range(120)]
    return rows


def names(folder):
    return sorted(n for n in os.listdir(urlparse(folder).path) if n.startswith("part-"))


def archive(folder):
    return {n: open(os.path.join(urlparse(folder).path, n), "rb").read() for n in names(folder)}


def digest_rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()),
                  key=repr)


@pytest.mark.parametrize("shard_bytes,file_bytes", [(warc.SHARD_BYTES, warc.FILE_BYTES), (20_000, 3_000)])
def test_round_trip_equals_brute_force(spark, pages, shard_bytes, file_bytes):
    rows = odd_rows()
    folder = shared_path(spark, "test-warc")
    manifest = warc.write(pages(rows).repartition(5), folder, shard_bytes=shard_bytes, file_bytes=file_bytes)
    got = warc.read(spark, folder)
    assert digest_rows(got) == expected(rows)
    texts = sorted((r.page_id, r.payload.decode()) for r in got.where("record_type = 'response' and page_id >= 8").collect())
    assert texts == sorted((i, t or "") for i, _, t in rows for e in [expected([(i, None, t)])] if i is not None and i >= 8
                           and not any(j is not None and j > i and u == t and len((t or "").encode()) >= 1000 for j, _, u in rows))
    files = manifest.collect()
    assert sorted(f.name for f in files) == names(folder) and sum(f.records for f in files) == len(rows)
    assert (len(files) > 20) == (file_bytes == 3_000)
    for f in files:
        data = archive(folder)[f.name]
        assert (len(data), hashlib.sha256(data).hexdigest()) == (f.bytes, f.sha256)
        assert f.records == 1 or len(data) <= file_bytes
    assert not os.path.exists(os.path.join(urlparse(folder).path, "_temporary"))


def test_bytes_do_not_depend_on_how_rows_are_dealt(spark, pages):
    rows = odd_rows()
    folders = []
    for parts, seed in ((1, 1), (7, 2)):
        random.seed(seed)
        random.shuffle(rows)
        folders.append(shared_path(spark, "test-warc"))
        warc.write(pages(rows).repartition(parts), folders[-1], shard_bytes=30_000, file_bytes=4_000)
    assert archive(folders[0]) == archive(folders[1])
    data = b"".join(archive(folders[0])[n] for n in names(folders[0]))
    order = [line.split(b": ")[1] for line in gzip.decompress(data).split(b"\r\n") if line.startswith(b"X-Page-ID")]
    assert [int(x) for x in order] == sorted(int(x) for x in order)


def test_records_are_valid_warc():
    data = warc.record(4, "http://h/\nq", "é".encode(), "00" * 32, None, False)
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and "WARC-Type: response" in lines and "WARC-Target-URI: http://h/%0Aq" in lines
    assert f"Content-Length: {len(block) - 4}" in lines and block.endswith(b"\r\n\r\n\xc3\xa9\r\n\r\n")
    revisit = warc.parse(warc.record(3, None, b"payload", "00" * 32, 4, True))
    assert (revisit["warc-type"], revisit["payload"], revisit["payload_bytes"]) == ("revisit", b"", 7)
    assert revisit["warc-refers-to"] == f"<{warc.record_id(4, '00' * 32)}>" and revisit["warc-profile"] == warc.PROFILE


def test_damage_is_found(spark, pages):
    folder = shared_path(spark, "test-warc")
    warc.write(pages([(1, "http://a", "text " * 50)]), folder)
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, None, b"abc", "00" * 32, None, False).replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(warc.member(b"x" * 500)[:-3])))
    path = os.path.join(urlparse(folder).path, names(folder)[0])
    data = open(path, "rb").read()
    with open(path, "wb") as f:
        f.write(data[:-9])
    with pytest.raises(Exception):
        warc.read(spark, folder).collect()


def test_members_across_any_chunk():
    parts = [bytes([k]) * k * 7 for k in range(1, 30)]
    data = b"".join(map(warc.member, parts))
    for chunk in (1, 5, 64, 1 << 20):
        assert list(warc.members(io.BytesIO(data), chunk)) == parts


def test_commit_can_be_repeated(spark, pages):
    folder = shared_path(spark, "test-warc")
    warc.write(pages([(1, "http://a", "text"), (2, "http://b", "more")]), folder)
    before = archive(folder)
    written = spark.read.parquet(f"{folder}/manifest").withColumn("path", F.lit(f"{folder}/_temporary/gone"))
    with pytest.raises(Exception, match="already exists"):  # a manifest is never replaced
        warc.commit(written, folder)
    assert archive(folder) == before


def test_empty_table(spark, pages):
    folder = shared_path(spark, "test-warc")
    assert warc.write(pages([]), folder).count() == 0
    assert warc.read(spark, folder).count() == 0
