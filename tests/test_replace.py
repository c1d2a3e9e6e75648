"""Several loads of one table at once."""

import os
import threading
from urllib.parse import urlparse

import pytest

from blocklot.session import scratch_path
from blocklot.sources import tables


@pytest.fixture
def path(spark, tmp_path):
    return f"file:{tmp_path}/table"


def rows(spark, path):
    return sorted(tuple(r) for r in tables.read_replaced(spark, path).collect())


def frame(spark, k, n=5):
    return spark.createDataFrame([(k, i) for i in range(n)], "k long, i long")


def names(path):
    return sorted(n for n in os.listdir(urlparse(path).path) if not n.startswith("."))


def test_two_interleaved_loads_leave_one_whole_table(spark, path):
    tables.replace_table(frame(spark, 0), path)
    one, two = tables.load(frame(spark, 1), path), tables.load(frame(spark, 2), path)
    assert one != two and rows(spark, path) == [(0, i) for i in range(5)]  # nothing is published yet
    assert tables.publish(spark, path, two) == 2 and rows(spark, path) == [(2, i) for i in range(5)]
    assert tables.publish(spark, path, one) == 3 and rows(spark, path) == [(1, i) for i in range(5)]


def test_a_number_that_is_taken_is_not_overwritten(spark, path, monkeypatch):
    """Both loads see the same last version; only one gets the next number."""
    tables.replace_table(frame(spark, 0), path)
    one, two = tables.load(frame(spark, 1), path), tables.load(frame(spark, 2), path)
    real = tables._versions
    seen = real(spark, path)
    monkeypatch.setattr(tables, "_versions", lambda s, p: seen)
    assert [tables.publish(spark, path, one), tables.publish(spark, path, two)] == [2, 3]
    monkeypatch.setattr(tables, "_versions", real)
    assert rows(spark, path) == [(2, i) for i in range(5)]


def test_many_loads_at_once(spark, path):
    tables.replace_table(frame(spark, 99), path)
    failed = []

    def run(k):
        try:
            tables.replace_table(frame(spark, k), path)
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=run, args=(k,)) for k in range(6)]
    reads = []
    for t in threads:
        t.start()
    while any(t.is_alive() for t in threads):
        reads.append(rows(spark, path))
    for t in threads:
        t.join()
    assert not failed and reads
    for got in [*reads, rows(spark, path)]:
        assert len(got) == 5 and len({k for k, _ in got}) == 1
    assert len([n for n in names(path) if n.startswith(tables.READY)]) == 7


def test_a_reader_keeps_its_version(spark, path):
    tables.replace_table(frame(spark, 1), path)
    before = tables.read_replaced(spark, path)
    tables.replace_table(frame(spark, 2), path)
    assert {r.k for r in before.collect()} == {1} and {k for k, _ in rows(spark, path)} == {2}


def test_failed_and_unfinished_loads_are_not_the_table(spark, path):
    tables.replace_table(frame(spark, 1), path)
    broken = frame(spark, 2).selectExpr("k", "raise_error('no') as i")
    with pytest.raises(Exception):
        tables.replace_table(broken, path)
    tables.load(frame(spark, 3), path)  # a load that was never published
    assert tables._create_new(spark, f"{path}/{tables.READY}2", "")  # one that was killed while it published
    assert {k for k, _ in rows(spark, path)} == {1}
    tables.replace_table(frame(spark, 4), path)
    assert {k for k, _ in rows(spark, path)} == {4}
    assert not tables._create_new(spark, f"{path}/{tables.READY}2", "x")


def test_old_versions_go(spark):
    path = scratch_path(spark, "replace-test")
    for k in range(5):
        tables.replace_table(frame(spark, k), path, partition_by=["k"], keep_seconds=-1)
    found = names(path)
    assert len([n for n in found if n.startswith(tables.DATA)]) == len([n for n in found if n.startswith(tables.READY)]) == 2
    assert {r.k for r in tables.read_replaced(spark, path).collect()} == {4}
