"""Language ID by multilingual mixture inference (operator 1).

*Model.* Byte 3-grams of the folded text (letters kept, everything else a
space) are hashed to ``BUCKETS`` buckets; each learned language has a smoothed
distribution over them. Counting runs on Spark; the model has ``BUCKETS`` rows
per language, whatever the size of the corpus.

*Inference.* A document is cut into windows of ``WINDOW`` bytes. A window's
likelihood under a language is the product over its 3-grams (to the power 1/3,
as each byte is in three of them). Expectation-maximisation over the windows
estimates the document's language proportions. The set of languages is chosen by
penalised likelihood: languages enter in the order of their proportions, and one
more is kept only if it raises the log-likelihood by more than ``PENALTY`` times
the logarithm of the number of windows.

``lang_pred`` is the language with the largest proportion, ``score`` that
proportion; ``mixture`` lists the chosen set.

Training reads text and non-null lang of the documents that ``learn`` marks: of each
language the distinct texts, a hash sample of about ``TRAIN_ROWS`` of them where there are
more (the documented bound of the fit). So a rare language is learnt from all its texts,
and copies of one text count once. Every document is scored.

Defined results: ``und`` with score 0 and an empty mixture for a null text, a text
without letters, or if nothing could be learned. Equal likelihoods: the language
that sorts first. A null doc_id is not held out. Repeated rows give repeated
results, an empty table an empty one. Other columns are not read (``keep_known``
keeps them all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, col, crc32_of_id, drop_caches, fold_latin, read_table, row_blocks, ship_package, text_buffer

BUCKETS = 1 << 16
WINDOW = 64
STEPS = 15
PENALTY = 2.0
SMOOTHING = 0.1
TRAIN_ROWS = 5_000
UNKNOWN = "und"
#: Bytes of text whose windows are held at a time.
ROWS_BYTES = 2 << 20


def gram_buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the 3-gram that starts at each byte, whether it has a letter); two bytes shorter than ``data``."""
    data = fold_latin(data)
    letter = ((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80)
    data[~letter] = 0x20
    x = data.astype(np.uint32)
    gram = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return (gram * np.uint32(2654435761)) >> np.uint32(16), letter[:-2] | letter[1:-1] | letter[2:]


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        """counts: BUCKETS x languages."""
        self.langs = langs
        share = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)
        self.logs = (np.log(share) / 3).astype(np.float32)

    def windows(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood of each window under each language, number of windows of each row)."""
        sizes = np.diff(offsets)
        many = -(-sizes // WINDOW)
        k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        starts = np.repeat(offsets[:-1], many) + k * WINDOW
        out = np.zeros((len(starts), len(self.langs)))
        if not len(starts):
            return out, many
        blocked = np.zeros(len(raw) + 2, bool)  # 3-grams that would leave their row
        blocked[np.maximum(offsets[1:] - 1, 0)] = blocked[np.maximum(offsets[1:] - 2, 0)] = True
        step = max(1, BLOCK_BYTES // WINDOW * 8 // max(8, len(self.langs)))
        for w in range(0, len(starts), step):
            a = int(starts[w])
            b = int(starts[w + step]) if w + step < len(starts) else len(raw)
            padded = raw[a:b + 2] if b + 2 <= len(raw) else np.concatenate([raw[a:], np.zeros(b + 2 - len(raw), np.uint8)])
            bucket, letters = gram_buckets(padded)
            values = self.logs[bucket]
            values[~letters | blocked[a:b]] = 0
            out[w:w + step] = np.add.reduceat(values, starts[w:w + step] - a, axis=0)
        return out, many

    def mixtures(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Language proportions of each row, zero outside the chosen set; all zero for a row without windows."""
        ll, many = self.windows(raw, offsets)
        out = np.zeros((len(many), len(self.langs)))
        full = np.flatnonzero(many)
        if len(full) and len(self.langs):
            out[full] = choose(ll, many[full])
        return out


def expectation_maximisation(odds: np.ndarray, first: np.ndarray, many: np.ndarray, share: np.ndarray):
    """Proportions of each document from ``share`` on, and the log of its mixture likelihood (up to the odds' scale)."""
    row = np.repeat(np.arange(len(many)), many)
    for _ in range(STEPS):
        part = odds * share[row]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(part, first, axis=0) / many[:, None]
    total = np.log(np.maximum((odds * share[row]).sum(axis=1), 1e-300))
    return share, np.add.reduceat(total, first)


def choose(ll: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Proportions of each document (``many`` windows each) over the set of languages chosen for it."""
    first = np.cumsum(many) - many
    odds = np.exp(ll - ll.max(axis=1, keepdims=True))
    languages = ll.shape[1]
    everything = np.full((len(many), languages), 1 / languages)
    rank = np.argsort(-expectation_maximisation(odds, first, many, everything)[0], axis=1, kind="stable")
    best = np.zeros((len(many), languages))
    # One language: the likeliest, by all windows together.
    sums = np.add.reduceat(ll, first, axis=0)
    lead = sums.argmax(axis=1)
    best[np.arange(len(many)), lead] = 1
    top = np.add.reduceat(ll.max(axis=1), first)
    reached = sums[np.arange(len(many)), lead] - top
    active = np.arange(len(many))
    for k in range(2, languages + 1):
        n = many[active]
        rows = np.repeat(first[active], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.zeros((len(active), languages))
        np.put_along_axis(start, rank[active, :k], 1 / k, axis=1)
        share, total = expectation_maximisation(odds[rows], np.cumsum(n) - n, n, start)
        better = total - reached[active] > PENALTY * np.log(n + 1.0)
        active = active[better]
        if not len(active):
            break
        best[active], reached[active] = share[better], total[better]
    return best


def train(docs: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> Model:
    """Learns from text and lang of the rows of ``docs`` that ``learn`` marks."""
    ship_package(docs.sparkSession)
    known = docs.where(learn & col(docs, "lang").isNotNull() & col(docs, "text").isNotNull())
    known = known.select(col(docs, "text").alias("text"), col(docs, "lang").alias("lang"))
    # One row per language: the texts it has, as near as the sample needs it.
    texts = known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n"))
    share = texts.select("lang", F.least(F.lit(1.0), F.lit(float(rows)) / F.col("n")).alias("share"))
    place = F.shiftrightunsigned(F.xxhash64("text"), 11).cast("double") / float(1 << 53)
    # A broadcast as wide as the model: one row for each language.
    known = known.join(F.broadcast(share), "lang").where(place < F.col("share")).select("text", "lang").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            raw, offsets = text_buffer(batch.column(0))
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for i in np.flatnonzero(langs == lang).tolist():
                    for a in range(int(offsets[i]), int(offsets[i + 1]), BLOCK_BYTES):
                        part = raw[a:min(int(offsets[i + 1]), a + BLOCK_BYTES + 2)]
                        if len(part) > 2:
                            bucket, letters = gram_buckets(part)
                            total += np.bincount(bucket[letters], minlength=BUCKETS)
        for lang, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(total[some])],
                ["lang", "bucket", "n"])

    counted = known.mapInArrow(
        count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counted["lang"].to_pylist()))
    counts = np.zeros((BUCKETS, len(langs)))
    at = {lang: i for i, lang in enumerate(langs)}
    which = np.array([at[x] for x in counted["lang"].to_pylist()], np.int64)
    counts[counted["bucket"].to_numpy(), which] = counted["n"].to_numpy()
    return Model(langs, counts)


def _has_letters(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = ((raw | 0x20) >= 0x61) & ((raw | 0x20) <= 0x7A) & (raw < 0x80)
    at = np.flatnonzero(ascii_letter)
    found = np.searchsorted(at, offsets[1:]) > np.searchsorted(at, offsets[:-1])
    for i in np.flatnonzero(~found).tolist():
        found[i] = any(c.isalpha() for c in raw[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def predictions(model: Model, column) -> tuple[list[str], np.ndarray, list[str]]:
    """(language, score, mixture) of each text of an Arrow column."""
    raw, offsets = text_buffer(column)
    share = np.zeros((len(offsets) - 1, len(model.langs)))
    for a, b in row_blocks(offsets, ROWS_BYTES):
        part, bounds = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        share[a:b] = model.mixtures(part, bounds)
        share[a:b][~_has_letters(part, bounds)] = 0
    if not model.langs:
        return [UNKNOWN] * len(share), np.zeros(len(share)), [""] * len(share)
    best, score = share.argmax(axis=1), share.max(axis=1)
    lang = [model.langs[i] if s > 0 else UNKNOWN for i, s in zip(best.tolist(), score.tolist())]
    mixed = (share > 0).sum(axis=1) > 1
    mixture = []
    for i, name in enumerate(lang):
        if mixed[i]:
            order = np.argsort(-share[i], kind="stable")
            mixture.append(",".join(f"{model.langs[j]}:{share[i, j]:.4f}" for j in order if share[i, j] > 0))
        else:
            mixture.append("" if name == UNKNOWN else f"{name}:1.0000")
    return lang, np.minimum(score, 1.0), mixture


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, mixture) of each row of ``docs``."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            lang, score, mixture = predictions(sent.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(mixture, pa.string())],
                ["doc_id", "lang_pred", "score", "mixture"])

    return docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, mixture string")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is known, with all their columns; ``und`` rows go."""
    ship_package(docs.sparkSession)
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            lang, _, _ = predictions(sent.value, batch.column(at))
            yield batch.filter(pa.array([x != UNKNOWN for x in lang], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(F.pmod(crc32_of_id(col(docs, "doc_id")), F.lit(3)) == 1, F.lit(False))


def op1_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs, train(docs, ~held_out(docs)))
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score", "mixture")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs, train(docs, ~held_out(docs)))


QUERIES = {"op1_language_mix": op1_language_mix}
ORACLE_SQL: dict[str, str] = {}
