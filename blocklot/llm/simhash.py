"""SimHash near-dedup with covering locality-sensitive hashing (operator 5).

*Fingerprint*: lower-cased A-Z, words between ASCII white space, 3-word
shingles (fewer words: the whole sequence; none: fingerprint zero), XXH64 with
seed 42 of each shingle, repeats included; a bit is 1 if set in over half.

*Covering tables*: bit i of a fingerprint has a non-zero vector m(i) of F2^4.
Table v (one of the 15 non-zero vectors) looks at the bits with <m(i), v> = 1.
Three differing bits span at most three dimensions, so some v is orthogonal to
all of them: every pair within three bits agrees on all bits of some table,
with certainty. A bucket is (mask, fingerprint & mask).

*Links inside a bucket*: distinct fingerprints only, so copies cost nothing.
Buckets of up to ``BUCKET`` fingerprints are compared in one task. A larger
bucket is refined: the bits outside its mask are cut into four blocks, and two
fingerprints that differ in at most three bits agree on one block, so four finer
buckets lose no link. After three refinements at most 14 bits are free: such a
bucket holds at most 2**14 fingerprints, a proven bound. Each bucket gives a
spanning forest of its links, never all pairs.

Components of the link graph come from ``components.components``.

Defined results: null or empty text has fingerprint zero and is linked like any
other. ``component_id`` is the smallest non-null ``doc_id`` of the component (null
if all are null). Repeated rows give repeated results. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, drop_caches, materialise, read_table, ship_package
from .components import components

RADIUS = 3
WORDS = 3
SEED = 42
#: Fingerprints of one bucket that one task compares; a larger bucket is refined.
BUCKET = 2048
REFINEMENTS = 3
#: Shingles hashed between two additions to the bit counts.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The unsigned 64-bit SimHash of a text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:len(parts) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    digest, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for a in range(0, len(starts), CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a:a + CHUNK], ends[a:a + CHUNK])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64)
        count += bits.sum(axis=0, dtype=np.int64)
    on = (count * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_caches()
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of each row; fp is the fingerprint as a signed 64-bit integer."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text")).mapInArrow(
        _fingerprints, f"doc_id {kind}, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks() -> list[int]:
    """The 2**(RADIUS+1) - 1 masks of the tables, as signed 64-bit integers."""
    vectors = [1 + i % 15 for i in range(64)]
    return [_signed(sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)) for v in range(1, 16)]


def finer_masks(mask: int) -> list[int]:
    """``mask`` with each one of the RADIUS + 1 blocks of its free bits added."""
    free = [i for i in range(64) if not mask >> i & 1]
    blocks = np.array_split(np.array(free), RADIUS + 1)
    full = mask & ((1 << 64) - 1)
    return [_signed(full | sum(1 << int(i) for i in block)) for block in blocks]


def forest(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, smallest fp of its part) in runs of equal ``keys`` (sorted): a spanning forest of each run."""
    n = len(fps)
    root = np.arange(n)
    words = fps.view(np.uint64)
    for d in range(1, n):
        i = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(i):
            break
        i = i[np.bitwise_count(words[i] ^ words[i + d]) <= RADIUS]
        j = i + d
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if not len(i):
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    tied = np.flatnonzero(root != np.arange(n))
    return fps[tied], fps[root[tied]]


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (mask, value): a run that a batch's end may cut waits for the next one."""
    held = None

    def links(part: np.ndarray) -> pa.RecordBatch:
        step = np.ones(len(part), np.int64)
        step[1:] = (part[1:, 0] != part[:-1, 0]) | (part[1:, 1] != part[:-1, 1])
        a, b = forest(np.cumsum(step), np.ascontiguousarray(part[:, 2]))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        part = np.column_stack([batch.column(k).to_numpy() for k in range(3)])
        part = part if held is None else np.concatenate([held, part])
        if not len(part):
            continue
        cut = int(np.flatnonzero((part[:, :2] != part[-1, :2]).any(axis=1))[-1]) + 1 \
            if (part[:, :2] != part[-1, :2]).any() else 0
        held = part[cut:]
        if cut:
            yield links(part[:cut])
    if held is not None and len(held):
        yield links(held)


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints of ``nodes`` (fp) with the same components as all links."""
    masks = covering_masks()
    rows = nodes.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    out = None
    for level in range(REFINEMENTS + 1):
        rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        sizes = materialise(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
        last = level == REFINEMENTS
        easy = sizes if last else sizes.where(F.col("n") <= bucket)
        small = rows.join(easy.select("mask", "value"), ["mask", "value"], "left_semi").select("mask", "value", "fp")
        found = small.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(
            _bucket_links, "a bigint, b bigint")
        out = found if out is None else out.unionByName(found)
        hard = sizes.where(F.col("n") > bucket)
        if last or hard.isEmpty():
            return out
        finer = {m: finer_masks(m) for m in masks}
        masks = sorted({m for f in finer.values() for m in f})
        table = F.create_map(*[x for m, f in finer.items()
                               for x in (F.lit(m), F.array(*[F.lit(y) for y in f]))])
        rows = materialise(
            rows.join(hard.select("mask", "value"), ["mask", "value"], "left_semi")
            .select("fp", F.explode(table[F.col("mask")]).alias("mask")).distinct(), "refined")
    return out


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    found = materialise(fingerprints(docs), "fingerprints")
    nodes = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), bucket))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(placed.select("fp", "root").join(least, "root").select("fp", "component_id"), "classes")
    return found.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One document of each component, whole, with the columns of ``docs``.

    The row with the smallest (doc_id, hash of the text) stays; rows that
    repeat both are copies of one document, of which one row stays.
    """
    ship_package(docs.sparkSession)
    key = F.xxhash64(F.coalesce(col(docs, "text"), F.lit("")))
    found = materialise(near_keys(docs), "fingerprints")
    nodes = materialise(found.groupBy("fp").agg(F.min(F.struct("doc_id", "text_key")).alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), bucket))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("least", F.coalesce("root", "fp").alias("root"))
    winners = materialise(placed.groupBy("root").agg(F.min("least").alias("least")).select("least.*"), "winners")
    win = winners.select(F.col("doc_id").alias("_w_id"), F.col("text_key").alias("_w_key"))
    kept = docs.join(win, key.eqNullSafe(F.col("_w_key")) & col(docs, "doc_id").eqNullSafe(F.col("_w_id")), "left_semi")
    repeats = found.groupBy("doc_id", "text_key").count().where("count > 1")
    return kept if repeats.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def near_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.xxhash64(F.coalesce(col(docs, "text"), F.lit("")))
    return docs.select(F.struct(col(docs, "doc_id").alias("doc_id"), key.alias("text_key")).alias("doc_id"),
                       col(docs, "text").alias("text")).mapInArrow(
        _fingerprints, f"doc_id struct<doc_id:{kind},text_key:bigint>, fp bigint").select("doc_id.*", "fp")


def op5_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


QUERIES = {"op5_simhash_covering": op5_simhash_covering}
ORACLE_SQL: dict[str, str] = {}
