"""Quality scores from a factorisation machine (operator 6).

*Features* of a text: its words in lower case, hashed to ``WORD_BUCKETS`` (share of
each in the text, scaled; words that share a bucket are one feature), and structure statistics with the metadata column
``n_chars``, each cut into ``BINS`` bins at quantiles of the training sample (one
feature per bin, so that pairs of bins can interact).

*Model.* score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The
pairwise sum is computed in linear time as half of sum_f ((sum_i v_if x_i)^2 -
sum_i v_if^2 x_i^2).

*Fit.* On a bounded sample: the labelled ids that the caller marks, a hash sample
of about ``TRAIN_ROWS`` of them where there are more, and fewer if their texts could have more than
``TRAIN_WORDS`` words (documented bounds). Of documents that repeat an id, the one whose text has
the largest hash is learnt from. The sampled labels are broadcast (at most two for
each id), features are made on Spark, and the fit itself (Adam on the logistic
loss) runs on the bounded feature table, 6 bytes a word. Every document is scored, over its whole text.

Defined results: null and empty texts have no words and zero statistics, and a
score like any other. A null ``n_chars`` falls into the lowest bin. A null doc_id
is not held out and has no label. Two labels of one doc_id each count, equal ones once. If
nothing is labelled, or only one class, every score is the share of class 1 (0
without labels). Repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (col, crc32_of_id, fold_latin, materialise, read_table, row_blocks, ship_package, span_hashes, text_buffer,
                     word_spans)

WORD_BUCKETS = 1 << 13
BINS = 8
FACTORS = 8
TRAIN_ROWS = 12_000
TRAIN_WORDS = 6_000_000
EPOCHS = 8
BATCH = 64
RATE = 0.02
DECAY = 1e-4
CUT = 0.3
#: Scale of the word part of x against the one-hot bins.
WORD_SCALE = 2.0
STATS = ["words", "mean_word", "long_word", "upper", "digits", "symbols", "other_bytes", "spaces", "distinct",
         "top_word", "repeated_next", "title_words", "lines", "mean_line", "repeated_lines", "stops", "commas",
         "bars", "shouts", "short_words", "n_chars"]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _runs(row: np.ndarray, h: np.ndarray, rows: int):
    """Equal (row, hash) pairs: (row of each, hash, how many); sorted by row, then hash."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    return r[at], x[at], np.diff(np.append(at, len(r)))


def _block(raw: np.ndarray, bounds: np.ndarray, n_chars: np.ndarray):
    """(statistics, row, word bucket, share) of the rows of one block."""
    n = len(bounds) - 1
    size = np.maximum(np.diff(bounds), 1).astype(np.float64)
    low = fold_latin(raw)
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    starts, ends = word_spans(~space, bounds)
    first = np.searchsorted(starts, bounds)
    words = np.diff(first)
    some = np.maximum(words, 1).astype(np.float64)
    h = span_hashes(low, starts, ends)
    row = np.repeat(np.arange(n), words)
    r, x, times = _runs(row, h, n)
    lengths = ends - starts
    upper = (raw >= 0x41) & (raw <= 0x5A) | (low != raw)
    letters = ((low >= 0x61) & (low <= 0x7A)) | (raw >= 0x80)
    digits = (raw >= 0x30) & (raw <= 0x39)
    stats = np.zeros((n, len(STATS)))

    def put(name, values):
        stats[:, STATS.index(name)] = values

    top, longest = np.zeros(n), np.zeros(n)
    np.maximum.at(top, r, times)
    np.maximum.at(longest, row, lengths)
    put("words", np.log1p(words))
    put("mean_word", _sums(lengths, first) / some)
    put("long_word", longest)
    put("upper", _sums(upper, bounds) / size)
    put("digits", _sums(digits, bounds) / size)
    put("symbols", _sums(~letters & ~digits & ~space, bounds) / size)
    put("other_bytes", _sums(raw >= 0x80, bounds) / size)
    put("spaces", _sums(space, bounds) / size)
    put("distinct", np.bincount(r, minlength=n) / some)
    put("top_word", top / some)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    put("repeated_next", _sums(same, first) / some)
    put("title_words", _sums(upper[starts], first) / some)
    line_starts, line_ends = word_spans(raw != 0x0A, bounds)
    line_first = np.searchsorted(line_starts, bounds)
    lines = np.diff(line_first)
    line_row = np.repeat(np.arange(n), lines)
    lr, _, _ = _runs(line_row, span_hashes(raw, line_starts, line_ends), n)
    put("lines", np.log1p(lines))
    put("mean_line", _sums(line_ends - line_starts, line_first) / np.maximum(lines, 1))
    put("repeated_lines", 1 - np.bincount(lr, minlength=n) / np.maximum(lines, 1))
    for name, byte in (("stops", b"."), ("commas", b","), ("bars", b"|"), ("shouts", b"!")):
        put(name, _sums(raw == byte[0], bounds) / some)
    put("short_words", _sums(lengths <= 2, first) / some)
    put("n_chars", np.log1p(np.maximum(n_chars, 0)))
    # The words of a row are in the order of their hashes, so those of a bucket stand together: one feature.
    bucket, share = (x >> np.uint64(51)).astype(np.int64), WORD_SCALE * np.sqrt(times / some[r])
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (bucket[1:] != bucket[:-1])
    at = np.flatnonzero(new)
    return stats, r[at], bucket[at], np.add.reduceat(share, at) if len(at) else share


def features(batch: pa.RecordBatch, text_at: int, chars_at: int | None) -> Iterator:
    """(first row, statistics, row, word bucket, x) for blocks of rows."""
    raw, offsets = text_buffer(batch.column(text_at))
    chars = np.zeros(batch.num_rows) if chars_at is None else \
        batch.column(chars_at).cast(pa.float64()).fill_null(0).to_numpy()
    for a, b in row_blocks(offsets):
        yield a, *_block(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], chars[a:b])


class Machine:
    """Factorisation machine over word buckets and binned statistics."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges  # statistics x (BINS - 1)
        n = WORD_BUCKETS + len(STATS) * BINS
        random = np.random.default_rng(7)
        self.bias, self.linear = 0.0, np.zeros(n)
        self.factors = random.normal(0, 0.05, (n, FACTORS))

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """Feature numbers of the statistics, one per statistic."""
        out = np.empty(stats.shape, np.int64)
        for k in range(stats.shape[1]):
            out[:, k] = WORD_BUCKETS + k * BINS + np.searchsorted(self.edges[k], stats[:, k], side="right")
        return out

    def sparse(self, stats: np.ndarray, row: np.ndarray, bucket: np.ndarray, x: np.ndarray):
        """(row, feature, value) with the rows in order."""
        n, k = stats.shape
        rows = np.concatenate([np.repeat(np.arange(n), k), row])
        which = np.concatenate([self.bins(stats).ravel(), bucket])
        value = np.concatenate([np.ones(n * k), x])
        order = np.argsort(rows, kind="stable")
        return rows[order], which[order], value[order]

    def raw(self, n: int, row: np.ndarray, which: np.ndarray, value: np.ndarray):
        """(score before the sigmoid, sum_i v_i x_i) of ``n`` rows."""
        first = np.searchsorted(row, np.arange(n))  # every row has its statistics, so none is empty
        vx = self.factors[which] * value[:, None]
        sums = np.add.reduceat(vx, first, axis=0)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, first, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[which] * value, first) + pairs, sums

    def scores(self, stats, row, bucket, x) -> np.ndarray:
        if not len(stats):
            return np.empty(0)
        raw, _ = self.raw(len(stats), *self.sparse(stats, row, bucket, x))
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))

    def fit(self, stats: np.ndarray, first: np.ndarray, bucket: np.ndarray, x: np.ndarray, label: np.ndarray) -> "Machine":
        """Adam on the logistic loss, in a fixed order; row i has the words ``first[i]:first[i + 1]``."""
        rate, n = label.mean(), len(label)
        self.bias = float(np.log(rate / (1 - rate)))
        slow = [np.zeros_like(self.linear), np.zeros_like(self.factors)]
        fast = [np.zeros_like(self.linear), np.zeros_like(self.factors)]
        random, step = np.random.default_rng(11), 0
        for _ in range(EPOCHS):
            order = random.permutation(n)
            for a in range(0, n, BATCH):
                own = order[a:a + BATCH]
                sizes = first[own + 1] - first[own]
                at = np.repeat(first[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                r, f, v = self.sparse(stats[own], np.repeat(np.arange(len(own)), sizes), bucket[at], x[at])
                raw, sums = self.raw(len(own), r, f, v)
                error = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - label[own]) / len(own)
                self.bias -= RATE * error.sum()
                used, place = np.unique(f, return_inverse=True)
                ev = error[r] * v
                linear = np.bincount(place, ev, minlength=len(used))
                inner = ev[:, None] * (sums[r] - self.factors[f] * v[:, None])
                factor = np.stack([np.bincount(place, inner[:, k], minlength=len(used)) for k in range(FACTORS)], 1)
                step += 1
                for p, g, m, s in ((self.linear, linear, slow[0], fast[0]), (self.factors, factor, slow[1], fast[1])):
                    g = g + DECAY * p[used]
                    m[used] = 0.9 * m[used] + 0.1 * g
                    s[used] = 0.99 * s[used] + 0.01 * g * g
                    p[used] -= RATE * (m[used] / (1 - 0.9 ** step)) / (np.sqrt(s[used] / (1 - 0.99 ** step)) + 1e-8)
        return self


class Constant:
    """What is left to say without two classes."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, stats, row, bucket, x) -> np.ndarray:
        return np.full(len(stats), self.score)


def fit(stats: np.ndarray, first: np.ndarray, bucket: np.ndarray, x: np.ndarray, label: np.ndarray):
    """A machine from the statistics, words and label of each row."""
    if not len(label) or label.min() == label.max():
        return Constant(float(label.mean()) if len(label) else 0.0)
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    # The outer bins also see the tails: quantiles alone would hide rare extremes.
    edges[:, 0], edges[:, -1] = np.quantile(stats, 0.03, axis=0), np.quantile(stats, 0.97, axis=0)
    return Machine(np.sort(edges, axis=1)).fit(stats, first, bucket, x, label.astype(np.float64))


def _part(key: Column, share: float) -> Column:
    """Whether the hash of ``key`` is in the first ``share`` of all hashes."""
    return F.lit(True) if share >= 1 else F.shiftrightunsigned(F.xxhash64(key, F.lit("quality")), 2) < int((1 << 62) * share)


def sample(docs: DataFrame, labels: DataFrame, learn: Column, rows: int, words: int) -> DataFrame:
    """(quality, text, n_chars): one row for each (doc_id, quality) of a bounded sample of the labels that ``learn`` marks.

    At most about ``rows`` ids, and ``words`` words as their texts' sizes bound them.
    """
    quality = (col(labels, "quality").cast("int") != 0).cast("int")
    marked = materialise(labels.where(learn & quality.isNotNull() & col(labels, "doc_id").isNotNull()).select(
        col(labels, "doc_id").alias("id"), quality.alias("quality")).distinct(), "labels")
    has_chars = "n_chars" in docs.columns
    share = min(1.0, rows / max(1, marked.count()))
    text = col(docs, "text")
    texts = docs.select(col(docs, "doc_id").alias("id"), text.alias("text"),
                        (col(docs, "n_chars") if has_chars else F.lit(0)).cast("double").alias("n_chars"))

    def chosen(part: float) -> DataFrame:
        few = F.broadcast(marked.where(_part(F.col("id"), part)))  # at most about ``rows`` ids, two labels each
        return texts.where(_part(F.col("id"), part)).join(few, "id")

    # A word has a byte and a space at least; a row has no more words than buckets.
    most = chosen(share).agg(F.sum(F.least(F.lit(WORD_BUCKETS), F.octet_length("text") / 2 + 1))).first()[0]
    if (most or 0) > words:
        share *= words / most
    return chosen(share).groupBy("id", "quality").agg(F.max_by(
        F.struct("text", "n_chars"), F.struct(F.xxhash64("text"), "n_chars")).alias("row")).select("quality", "row.text", "row.n_chars")


def train(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS, words: int = TRAIN_WORDS):
    """Learns ``quality`` from the rows of ``labels`` that ``learn`` marks and the texts of ``docs``."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality = batch.column(0)
            for a, stats, row, bucket, x in features(batch, 1, 2):
                n = len(stats)
                ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [quality.slice(a, n), flat.cast(pa.list_(pa.float64())),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int16))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.float32)))],
                    ["quality", "stats", "bucket", "x"])

    # At most about ``rows`` rows and ``words`` words, six bytes each.
    got = sample(docs, labels, learn, rows, words).mapInArrow(
        run, "quality int, stats array<double>, bucket array<smallint>, x array<float>").toArrow()
    if not got.num_rows:
        return fit(*[np.empty(0)] * 5)
    stats = pc.list_flatten(got["stats"]).to_numpy().reshape(got.num_rows, len(STATS))
    # In an order of its own, so that the fit doesn't depend on how Spark dealt the rows.
    order = np.lexsort((got["quality"].to_numpy(), *stats.T))
    got = got.select(["quality", "bucket", "x"]).take(pa.array(order))
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(got["bucket"]).to_numpy())])
    return fit(stats[order], first, pc.list_flatten(got["bucket"]).to_numpy(), pc.list_flatten(got["x"]).to_numpy(),
               got["quality"].to_numpy())


def score(docs: DataFrame, machine) -> DataFrame:
    """(doc_id, score) of each row of ``docs``."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    kind = docs.schema["doc_id"].dataType.simpleString()
    has_chars = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [sent.value.scores(*block[1:]) for block in features(batch, 1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(parts) if parts else np.empty(0))], ["doc_id", "score"])

    return docs.select(
        col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text"),
        (col(docs, "n_chars") if has_chars else F.lit(0)).cast("double").alias("n_chars")).mapInArrow(
        run, f"doc_id {kind}, score double")


def held_out(table: DataFrame) -> Column:
    return F.coalesce(F.pmod(crc32_of_id(col(table, "doc_id")), F.lit(5)) == 0, F.lit(False))


def op6_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score(docs, train(docs, labels, ~held_out(labels)))
    return scored.select("doc_id", held_out(scored).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES = {"op6_quality_fm": op6_quality_fm}
ORACLE_SQL: dict[str, str] = {}
