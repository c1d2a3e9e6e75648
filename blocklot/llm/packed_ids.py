"""Token ids in fixed-width bit packing (operator 4).

*File format* (little-endian), one file per shard, shards in ascending order of doc_id:

=========  ======================================================================
bytes      content
=========  ======================================================================
8          ``MAGIC``
8          u64 bits per id (the minimum for the vocabulary)
8          u64 ids per block
8          u64 ids in the file
8          u64 documents in the file
8 x docs   u64 ids before each document, in the file
8 x blocks u64 byte offset of each block, from the start of the file
...        blocks: ids packed without gaps, lowest bit first; each block starts on
           a byte and ends with 8 zero bytes, so that any id of it is in one 8-byte load
=========  ======================================================================

A block unpacks with a few numpy operations; id *i* of a document is found from
the two tables without reading any other block. The ``doc_id`` of each document
stands in the manifest's side table, which Spark writes as Parquet.

*Writing.* Documents are range-partitioned by (doc_id, hash of the text), so a
shard is one task. A task writes its file under a name of its own in the shared
folder; the name gets into the manifest only if the task succeeded, so a retried
or doubled task leaves at most a file that nothing refers to. Counts before each
shard come from the manifest, which has one row per shard.

*Encoding.* Arrow finds the distinct words between spaces and line feeds, as whole byte strings, and
``tokenizers`` encodes each once: the tokenizer drops white space, and no merge crosses
it. Special strings in a text become their ids, as they do in the library.

Defined results: a null or empty text has the end id only. Null doc_ids sort
first; rows that repeat doc_id and text are written one after the other. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, materialise, read_table, row_blocks, shared_path, ship_package, text_buffer, worker_cache
from .word_ids import ALPHANUMERIC, PUNCTUATION, WordIds, pieces, taken

MAGIC = b"PACKIDS1"
HEAD = struct.Struct("<8s4Q")
BLOCK_IDS = 1 << 16
END_ID = 2
#: Bytes of text that are encoded together, and words kept with their ids from batch to batch.
ENCODE_BYTES = 8 << 20
CACHE = 700_000


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each, lowest bit first, and 8 bytes of padding."""
    if width in (8, 16, 32):
        body = ids.astype(f"<u{width // 8}").tobytes()
    else:
        bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        body = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return body + bytes(8)


def unpack(block: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids [start, stop) of a packed block."""
    if stop <= start:
        return np.empty(0, np.uint32)
    if width in (8, 16, 32):
        return np.frombuffer(block, f"<u{width // 8}", stop - start, start * width // 8).astype(np.uint32)
    raw = np.frombuffer(block, np.uint8)
    at = np.arange(start, stop, dtype=np.int64) * width
    loads = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(raw) - 7,), (1,), writeable=False)
    return ((loads[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


class Writer:
    """Collects ids and writes one file; holds the packed blocks, not the ids."""

    def __init__(self, width: int, block_ids: int = BLOCK_IDS):
        self.width, self.block_ids = width, block_ids
        self.blocks: list[bytes] = []
        self.rest = np.empty(0, np.uint32)
        self.starts: list[np.ndarray] = []
        self.total = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents of ``lengths`` ids each, in ``ids`` one after the other."""
        self.starts.append(self.total + np.cumsum(lengths) - lengths)
        self.total += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block_ids * self.block_ids
        for a in range(0, whole, self.block_ids):
            self.blocks.append(pack(ids[a:a + self.block_ids], self.width))
        self.rest = ids[whole:]

    def write(self, stream) -> None:
        blocks = [*self.blocks, pack(self.rest, self.width)] if len(self.rest) else self.blocks
        starts = np.concatenate(self.starts) if self.starts else np.empty(0)
        head = HEAD.size + 8 * len(starts) + 8 * len(blocks)
        sizes = np.array([len(b) for b in blocks], np.uint64)
        stream.write(HEAD.pack(MAGIC, self.width, self.block_ids, self.total, len(starts)))
        stream.write(starts.astype("<u8").tobytes())
        stream.write((np.uint64(head) + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
        for b in blocks:
            stream.write(b)


class Reader:
    """Random access to one file."""

    def __init__(self, stream):
        self.stream = stream
        magic, self.width, self.block_ids, self.total, self.docs = HEAD.unpack(stream.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a packed-ids file")
        self.starts = np.append(np.frombuffer(stream.read(8 * self.docs), "<u8").astype(np.int64), self.total)
        n = -(-self.total // self.block_ids)
        self.offsets = np.frombuffer(stream.read(8 * n), "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the file; reads the blocks that hold them."""
        out = []
        while start < stop:
            k = start // self.block_ids
            first = k * self.block_ids
            upto = min(stop, first + self.block_ids, self.total)
            size = (min(self.block_ids, self.total - first) * self.width + 7) // 8 + 8
            self.stream.seek(int(self.offsets[k]))
            out.append(unpack(self.stream.read(size), self.width, start - first, upto - first))
            start = upto
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


#: What each byte is folded to.
FOLDED = np.array([0x20 if i == 0x0A else i + 0x20 if 0x41 <= i <= 0x5A else i for i in range(256)], np.uint8)


class WordEncoder:
    """Encodes batches of texts with a ``tokenizers`` file, each distinct word once."""

    def __init__(self, path: str, end_id: int, cache: int = CACHE):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.known = WordIds(self._learn, cache, [end_id])

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new words; they are encoded as lines of words, cut again by their offsets."""
        ids, counts = [], []
        for a in range(0, len(words), 256):
            part = words[a:a + 256]
            line = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in part])
            begin = np.array([o[0] for o in line.offsets], np.int64)
            counts.append(np.bincount(np.searchsorted(ends, begin, side="right"), minlength=len(part)))
            ids.append(np.array(line.ids, np.uint32))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text) of the texts ``bounds`` of ``raw``, the end id after each."""
        special = b"<|" in raw.tobytes()  # a special string may stand there, which is what it is byte by byte
        data = raw if special else FOLDED[raw]
        # A word ends after its space or line feed, or with its text.
        space = (data == 0x20) | (data == 0x0A)
        mark = np.zeros(len(data) + 1, bool)
        mark[1:] = space
        mark[bounds] = True
        if not special:
            mark[_tails(data, space, mark)] = True
        cuts = np.flatnonzero(mark)
        found = pieces(data, cuts)
        # Words that differ by the space at their end alone are one.
        bare = pc.ascii_rtrim(found.dictionary, " \n").dictionary_encode()
        at, lists = self.known.find(bare.dictionary)
        at = at[bare.indices.to_numpy()][found.indices.to_numpy()]
        stop = np.searchsorted(cuts, bounds)
        ids, lengths = taken(np.insert(at, stop[1:], 0), lists, stop + np.arange(len(stop)))
        return ids.astype(np.uint32), lengths


def _tails(data: np.ndarray, space: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Where ASCII punctuation begins that goes on from an ASCII letter or digit to the end of its word.

    The tokenizer cuts there too, whatever the word is: so ``word`` and ``word,`` are one word that is learnt.
    """
    other = np.zeros(len(data) + 2, bool)
    other[1:-1] = PUNCTUATION[data]
    change = np.flatnonzero(other[1:] != other[:-1])
    start, end = change[::2], change[1::2]
    whole = mark[end]  # a text ends there: the byte before is no space
    inner = end < len(data)
    whole[inner] |= space[end[inner]]
    whole &= start > 0
    start = start[whole]
    return start[ALPHANUMERIC[data[start - 1]]]


def _encoder(path: str, end_id: int) -> WordEncoder:
    return worker_cache("words", (path, end_id), lambda: WordEncoder(path, end_id))


def write_packed(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """Writes the ids of ``docs`` below ``folder``; gives (manifest, documents).

    manifest (shard, path, docs, ids, start): one row per file, ``start`` the ids
    in all files before it. documents (shard, place, doc_id): where each row went.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = _encoder(tokenizer, end_id)
        writer, shard, n = Writer(width_of(encoder.vocabulary)), TaskContext.get().partitionId(), 0
        path = f"{folder}/ids/{shard:06d}-{uuid.uuid4().hex}.bin"
        for batch in batches:
            raw, bounds = text_buffer(batch.column(1))
            for a, b in row_blocks(bounds, ENCODE_BYTES):
                part = batch.slice(a, b - a)
                ids, lengths = encoder.encode(raw[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                writer.add(ids, lengths)
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * k, pa.int32()), pa.array([path] * k), pa.array(range(n, n + k), pa.int64()),
                     part.column(0), pa.array(lengths, pa.int64())], ["shard", "path", "place", "doc_id", "n"])
                n += k
        if n:
            store, where = fs.FileSystem.from_uri(path)
            store.create_dir(where.rpartition("/")[0])
            with store.open_output_stream(where) as stream:
                writer.write(stream)

    rows = docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    written = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, f"shard int, path string, place bigint, doc_id {kind}, n bigint"), "packed-docs")
    files = written.groupBy("shard", "path").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    manifest = materialise(files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))), "manifest")
    return manifest, written.select("shard", "place", "doc_id")


def read_packed(manifest: DataFrame) -> DataFrame:
    """(shard, place, start, n_tokens, ids_crc32) of each document, read back from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, where = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(where) as stream:
                    reader = Reader(stream)
                    for a, b in row_blocks(reader.starts, BLOCK_IDS * 16):
                        low, n = int(reader.starts[a]), b - a
                        ids = reader.ids(low, int(reader.starts[b])).astype("<u4")
                        cut = reader.starts[a:b + 1] - low
                        crc = [zlib.crc32(ids[cut[k]:cut[k + 1]]) for k in range(n)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["shard"]] * n, pa.int32()), pa.array(range(a, b), pa.int64()),
                             pa.array(reader.starts[a:b] + row["start"], pa.int64()),
                             pa.array(np.diff(cut), pa.int64()), pa.array(crc, pa.int64())],
                            ["shard", "place", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    files = manifest.repartitionById(n, F.pmod(F.col("shard"), F.lit(n)))
    return files.select("shard", "path", "start").mapInArrow(
        run, "shard int, place bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op4_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    manifest, where = write_packed(read_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("word_bpe_49k.json"), shared_path(spark, "packed"))
    # One row per document on both sides: never a broadcast, however well the files compress.
    found = where.join(read_packed(manifest).hint("merge"), ["shard", "place"])
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op4_packed_ids": op4_packed_ids}
ORACLE_SQL: dict[str, str] = {}
