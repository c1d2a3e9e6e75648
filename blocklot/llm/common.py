"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: Bytes of text that the vectorised operators hold as arrays at a time.
BLOCK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``).

    Functions given to ``mapInArrow`` are pickled by reference, so the Python
    workers must be able to import the package they come from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_blocklot_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="blocklot-ship-")
    target = os.path.join(folder, "blocklot-package.zip")
    root = os.path.dirname(_PACKAGE)
    with zipfile.ZipFile(target, "w") as z:
        for base, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._blocklot_shipped = True


_WORKER: dict[tuple, object] = {}


def _release() -> None:
    """Gives memory that is free in this process back to the machine, where its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def worker_cache(kind: str, key: tuple, make):
    """An object that a Python worker keeps from task to task; those of other kinds are let go."""
    others = [k for k in _WORKER if k[0] != kind]
    if others:
        for other in others:
            del _WORKER[other]
        _release()
    if (kind, *key) not in _WORKER:
        _WORKER[(kind, *key)] = make()
    return _WORKER[(kind, *key)]


def drop_caches() -> None:
    """Lets go what an earlier operator kept in this worker; for operators that keep nothing."""
    if _WORKER:
        _WORKER.clear()
        _release()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder of the session (``spark.checkpoint.dir``)."""
    return f"{scratch_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks that read the files,
    not the work that made them. The copy also gives joins plain shuffles on
    both sides, which AQE can split where a key is hot.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` has not (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(df: DataFrame, name: str):
    """Column ``name`` of ``df``, whatever characters the name has."""
    return df[f"`{name}`"]


def crc32_of_id(doc_id) -> object:
    """Unsigned crc32 of the id written as decimal text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; row i is ``bytes[offsets[i]:offsets[i+1]]``. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    first = int(offsets[0])
    raw = np.frombuffer(data, np.uint8)[first:int(offsets[-1])] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - first


def row_blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``size`` bytes each; a longer row stands alone."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def fold_latin(data: np.ndarray) -> np.ndarray:
    """A copy in lower case: A-Z, and the Latin-1 capitals in UTF-8 (C3 80 to C3 9E, not C3 97)."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(data) > 1:
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        nxt = data[after]
        out[after[(nxt >= 0x80) & (nxt <= 0x9E) & (nxt != 0x97)]] += 0x20
    return out


#: Odd multiplier of the rolling hash modulo 2**64, and its inverse.
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_POW: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POW["p"], _POW["q"] = _powers(_P, size), _powers(_PINV, size)
    return _POW["p"], _POW["q"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, equal for equal bytes wherever they stand."""
    p, q = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * q[starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def word_spans(is_word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; no run crosses a row bound."""
    n = len(is_word)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = is_word.copy()
    start[1:] &= ~is_word[:-1]
    end = np.zeros(n + 1, bool)
    end[1:n] = is_word[:-1] & ~is_word[1:]
    end[n] = is_word[-1]
    inner = bounds[(bounds > 0) & (bounds < n)]
    start[inner] = is_word[inner]
    end[inner] |= is_word[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end)
