"""Benchmark decontamination (operator 3): n-gram seeds, then Smith-Waterman alignment.

1. One pass counts how often each word 3-gram of the benchmark items stands in the corpus.
   The rarer half of an item's 3-grams are its *rare seeds*, whatever the counts.
2. A second pass joins documents to items on the 3-grams. An item that has too few
   words in common with the document goes no further.
3. Seeds of an item that stand close together open a window of the document,
   which is aligned with the whole item by Smith-Waterman over words (match 2, mismatch -1, gap
   -1): changed, missing and added words cost score but don't hide a copy that
   keeps three words in a row (one that keeps none has no seed and isn't found). The windows
   of the rare seeds come first. Only a pair that they don't decide goes on to the
   windows of all its seeds, so an edited copy whose intact 3-grams are common is not lost.
   A window reaches twice the item's length beyond its seeds: no alignment that counts is longer.
4. A document is contaminated by an item if the score reaches ``THRESHOLD`` of the score of
   a full verbatim copy; for an item of fewer than ``MIN_WORDS`` words, if it is at most
   ``SHORT_LOSS`` below that (one word changed or missing, or a few added), and at most 1 below for one of
   fewer than five words.

The benchmark is the stated query set: it is taken in blocks of bounded size
(``BLOCK_ITEMS`` texts and ``BLOCK_BYTES_MAX`` bytes on average), each broadcast,
against all rows. Documents are never shuffled and no document text reaches the driver.

Words are runs of letters, digits and marks, in lower case (ASCII and Latin-1
capitals). A character of a script that is written without spaces between words
(``UNSEGMENTED``) and a non-ASCII symbol are each a word; punctuation, spaces and
control characters only separate.

Defined results: a null or empty document has no hits. A null ``item_id`` or
``doc_id`` is carried along; repeated document rows are each reported, equal
texts of one item are reported for every item. An item of fewer than ``SEED_WORDS`` words,
which stands in documents by chance, is found only where it is all
of the document's words. An item without words has no hits. Empty tables
give an empty result. Other columns of the documents are not read (``clean``
keeps them all).
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (col, drop_caches, fold_latin, read_table, row_blocks, ship_package, span_hashes,
                     text_buffer, word_spans)

SEED_WORDS = 3
THRESHOLD = 0.5
#: An item of fewer words may lose that much of its score.
MIN_WORDS, SHORT_LOSS = 8, 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: Size of a benchmark block, which bounds what is collected and broadcast at a time.
BLOCK_ITEMS = 20_000
BLOCK_BYTES_MAX = 32 << 20
#: First and last code points of scripts written without spaces between words.
UNSEGMENTED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF),  # Thai to Tai Tham
    (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x3035), (0x3038, 0x303C),
    (0x3041, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF),  # kana, Han, Yi
    (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))
SEPARATOR, PART, WHOLE = 0, 1, 2


@functools.cache
def _classes() -> np.ndarray:
    """Of each code point: ``SEPARATOR``, ``PART`` of a word, or a ``WHOLE`` word."""
    kinds = dict.fromkeys(("Sm", "Sc", "So"), WHOLE) | dict.fromkeys(
        ("Cc", "Cf", "Zs", "Zl", "Zp", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sk"), SEPARATOR)
    out = np.frombuffer(bytearray(kinds.get(unicodedata.category(chr(i)), PART) for i in range(0x110000)), np.uint8)
    for a, b in UNSEGMENTED:
        out[a:b + 1][out[a:b + 1] == PART] = WHOLE
    return out


def _word_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each byte is in a word, places where a word starts or ends within a run of such bytes)."""
    is_word = ((data >= 0x61) & (data <= 0x7A)) | ((data >= 0x30) & (data <= 0x39))
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return is_word, lead
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    first = padded[lead]
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = first & (0xFF >> (size + 1))
    for k in range(1, 4):
        code = np.where(size > k, (code << 6) | (padded[lead + np.minimum(k, size)] & 0x3F), code)
    kind = _classes()[np.minimum(code, 0x10FFFF)]
    for k in range(4):
        inside = (size > k) & (lead + k < len(data))
        is_word[lead[inside] + k] = kind[inside] != SEPARATOR
    own = kind == WHOLE
    return is_word, np.concatenate([lead[own], lead[own] + size[own]])


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the end) for rows ``bounds`` of ``data``."""
    data = fold_latin(data)
    is_word, cuts = _word_bytes(data)
    starts, ends = word_spans(is_word, np.concatenate([bounds, cuts]))
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of each run of ``SEED_WORDS`` words, by its first word."""
    n = len(words) - SEED_WORDS + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(SEED_WORDS):
        out = (out ^ words[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def smith_waterman(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """(best local score, first word, end) of ``item`` in ``text``, both as word hashes.

    One row per word of the text, vectorised over the item. A gap costs ``-GAP``
    a word, so the chain of insertions along a row is a running maximum.
    """
    m = len(item)
    ramp = np.arange(m + 1) * -GAP
    row, origin = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(text):
        diagonal = row[:-1] + np.where(item == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        new = np.zeros(m + 1, np.int64)
        new[1:] = np.maximum(diagonal, above)
        start = np.full(m + 1, i + 1, np.int64)
        from_row = np.where(row[:-1] > 0, origin[:-1], i)
        start[1:] = np.where(diagonal >= above, from_row, origin[1:])
        dead = new <= 0
        new[dead], start[dead] = 0, i + 1
        lifted = new + ramp
        peak = np.maximum.accumulate(lifted)
        at = np.maximum.accumulate(np.where(lifted == peak, np.arange(m + 1), 0))
        row = np.maximum(peak - ramp, 0)
        origin = start[at]
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), int(origin[top]), i + 1)
    return best


def least_score(words: int) -> float:
    """The score that a copy of an item of so many words must reach."""
    if words >= MIN_WORDS:
        return THRESHOLD * MATCH * words
    return MATCH * words - (SHORT_LOSS if words >= 5 else 1)


class Items:
    """One block of the benchmark: word hashes of each item, and an index of its 3-grams."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids, self.words, grams, owner = [], [], [], []
        #: Items too short for a 3-gram, by their words.
        self.tiny: dict[tuple, list[int]] = {}
        for item_id, text in zip(ids, texts):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            words, _ = word_hashes(raw, np.array([0, len(raw)]))
            if len(words):
                if len(words) < SEED_WORDS:
                    self.tiny.setdefault(tuple(words.tolist()), []).append(len(self.ids))
                own = np.unique(gram_hashes(words))
                grams.append(own)
                owner.append(np.full(len(own), len(self.ids)))
                self.ids.append(item_id)
                self.words.append(words)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate(self.words) if self.words else np.empty(0, np.uint64)
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        self.grams = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        self.owner = np.concatenate(owner).astype(np.int64) if owner else np.empty(0, np.int64)
        order = np.argsort(self.grams, kind="stable")
        self.grams, self.owner = self.grams[order], self.owner[order]
        self.distinct = np.unique(self.grams)
        self.least = np.array([least_score(n) for n in self.sizes.tolist()])
        self.rare = np.ones(len(self.grams), bool)
        self._filter()

    def mark_rare(self, counts: np.ndarray) -> None:
        """Marks the rarer half of each item's 3-grams by the ``counts`` of ``distinct``; ties by the hash."""
        n = counts[np.searchsorted(self.distinct, self.grams)]
        order = np.lexsort((self.grams, n, self.owner))
        own = self.owner[order]
        first = np.searchsorted(own, own)
        self.rare[order] = 2 * (np.arange(len(own)) - first) < np.bincount(own, minlength=1)[own]

    def _filter(self) -> None:
        """A bit per hash remainder: most 3-grams of the documents miss without a search."""
        self.bits = max(16, int(len(self.distinct) * 16).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.distinct >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``grams``, places in ``self.distinct``) of those that occur in the block."""
        if not len(self.distinct):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        maybe = np.flatnonzero(self.seen[(grams >> np.uint64(64 - self.bits)).astype(np.int64)])
        at = np.searchsorted(self.distinct, grams[maybe])
        at[at == len(self.distinct)] = 0
        same = self.distinct[at] == grams[maybe]
        return maybe[same], at[same]

    def _possible(self, items: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Those of ``items`` of whose words enough stand anywhere in the document."""
        n = self.sizes[items]
        ends = np.cumsum(n)
        inside = np.isin(self.flat[np.repeat(self.first[items] - ends + n, n) + np.arange(ends[-1])], words)
        return items[MATCH * np.add.reduceat(inside.astype(np.int64), ends - n) >= self.least[items]]

    def _common(self, item: int, window: np.ndarray) -> int:
        """Words that the item and the window have in common, repeats counted as often as both have them."""
        own, counts = self.bags[item]
        at = np.searchsorted(own, window)
        at[at == len(own)] = 0
        return int(np.minimum(np.bincount(at[own[at] == window], minlength=len(own)), counts).sum())

    def align(self, words: np.ndarray, places: np.ndarray, found: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """The best (share of the full score, first word, end) of each item of which the document holds a copy."""
        grams = self.distinct[found]
        first, last = np.searchsorted(self.grams, grams), np.searchsorted(self.grams, grams, side="right")
        many = last - first
        entry = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owner, rare, place = self.owner[entry], self.rare[entry], np.repeat(places, many)
        out = {}
        items = np.unique(owner)
        if len(items) > 8:
            items = self._possible(items, words)
        for item in items.tolist():
            own = owner == item
            at, mark = place[own], rare[own]
            best = self._best(item, words, at[mark]) if mark.any() else None
            if best is None and not mark.all():
                best = self._best(item, words, at)
            if best is not None:
                out[item] = best
        return out

    def _best(self, item: int, words: np.ndarray, seeds: np.ndarray) -> tuple[float, int, int] | None:
        """The best alignment in the windows of ``seeds`` that reaches the item's least score."""
        target, least = self.words[item], self.least[item]
        # An alignment of k <= m matches and g others has 2k - g >= m, so k + g <= 2m words.
        reach = 2 * len(target)
        best = None
        for part in np.split(seeds, np.flatnonzero(np.diff(seeds) > reach) + 1):
            a, b = max(0, int(part[0]) - reach), min(len(words), int(part[-1]) + SEED_WORDS + reach)
            if MATCH * self._common(item, words[a:b]) < least:
                continue  # no alignment can match more words than the two have in common
            score, s, e = smith_waterman(words[a:b], target)
            if score >= least and (best is None or score > best[0]):
                best = (score, a + s, a + e)
        return None if best is None else (best[0] / (MATCH * len(target)), *best[1:])


def _documents(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word hashes, first word of each row, 3-gram hashes) for blocks of rows."""
    raw, offsets = text_buffer(batch.column(column))
    for a, b in row_blocks(offsets):
        words, first = word_hashes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        yield a, words, first, gram_hashes(words)


def _seeds(block: Items, first: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, number among the block's 3-grams, row) of the 3-grams that occur in the block and cross no row's end."""
    places, found = block.hits(grams)
    row = np.searchsorted(first, places, side="right") - 1
    inside = places + SEED_WORDS <= first[np.minimum(row + 1, len(first) - 1)]
    return places[inside], found[inside], row[inside]


def _row_hits(batch: pa.RecordBatch, column: int, block: Items) -> Iterator[tuple[int, int, tuple[float, int, int]]]:
    """(row, item, alignment) of every item that a row holds a copy of."""
    for a, words, first, grams in _documents(batch, column):
        if block.tiny:
            many = np.diff(first)
            for r in np.flatnonzero((many > 0) & (many < SEED_WORDS)).tolist():
                for item in block.tiny.get(tuple(words[first[r]:first[r + 1]].tolist()), ()):
                    yield a + r, item, (1.0, 0, int(many[r]))
        places, found, row = _seeds(block, first, grams)
        cuts = np.flatnonzero(np.diff(row)) + 1
        for group in np.split(np.arange(len(row)), cuts) if len(row) else []:
            r = int(row[group[0]])
            doc = words[first[r]:first[r + 1]]
            for item, best in block.align(doc, places[group] - first[r], found[group]).items():
                yield a + r, item, best


def seed_counts(docs: DataFrame, block: Items) -> np.ndarray:
    """How often each of the block's 3-grams stands in ``docs``; one number for each comes to the driver."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        total = np.zeros(len(sent.value.distinct), np.int64)
        for batch in batches:
            for _, _, first, grams in _documents(batch, 0):
                np.add.at(total, _seeds(sent.value, first, grams)[1], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["seed", "n"])

    got = docs.select(col(docs, "text").alias("text")).mapInArrow(run, "seed bigint, n bigint").groupBy("seed").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(block.distinct), np.int64)
    out[got["seed"].to_numpy()] = got["n"].to_numpy()
    sent.unpersist()
    return out


def blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """Broadcast benchmark blocks, with their rare seeds in ``docs`` marked."""
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.select(col(benchmark, "item_id").alias("item_id"), col(benchmark, "text").alias("text"))
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(size / BLOCK_BYTES_MAX))
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()
        block = Items([r.item_id for r in own], [r.text for r in own])
        if block.ids:
            if len(block.grams):
                block.mark_rare(seed_counts(docs, block))
            yield spark.sparkContext.broadcast(block)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): one row per document row and item it contains.

    ``score`` is the alignment's share of a verbatim copy's score; the words
    are counted in the document, end exclusive.
    """
    def finder(items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_caches()
            block = items.value
            for batch in batches:
                rows, found, best = [], [], []
                for r, item, b in _row_hits(batch, 1, block):
                    rows.append(r)
                    found.append(block.ids[item])
                    best.append(b)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, id_type)]
                    + [pa.array([b[i] for b in best], t) for i, t in
                       enumerate((pa.float64(), pa.int64(), pa.int64()))],
                    ["doc_id", "item_id", "score", "first_word", "end_word"])
        return run

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    id_type = to_arrow_type(kinds[1])
    schema = (f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, "
              "score double, first_word bigint, end_word bigint")
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text"))
    out = None
    for items in blocks(docs, benchmark):
        part = rows.mapInArrow(finder(items), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    def keeper(items, text_at):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_caches()
            block = items.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for r, _, _ in _row_hits(batch, text_at, block):
                    keep[r] = False
                yield batch.filter(pa.array(keep))
        return run

    out = docs
    for items in blocks(docs, benchmark):
        out = out.mapInArrow(keeper(items, docs.columns.index("text")), docs.schema)
    return out


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op3_decontaminate": op3_decontaminate}
ORACLE_SQL: dict[str, str] = {}
