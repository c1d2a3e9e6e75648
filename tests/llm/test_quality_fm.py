import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from blocklot.llm import quality_fm as fm
from blocklot.llm.common import span_hashes


def test_pairwise_identity_equals_the_double_sum():
    rng = np.random.default_rng(0)
    m = fm.Machine(np.sort(rng.normal(size=(len(fm.STATS), fm.BINS - 1)), axis=1))
    m.linear, m.bias = rng.normal(size=m.linear.shape), 0.3
    stats = rng.normal(size=(3, len(fm.STATS)))
    row, bucket, x = np.array([0, 0, 2]), np.array([5, 9, 5]), np.array([0.5, 1.5, 2.0])
    got = m.scores(stats, row, bucket, x)
    for i in range(3):
        f = np.concatenate([m.bins(stats)[i], bucket[row == i]])
        v = np.concatenate([np.ones(len(fm.STATS)), x[row == i]])
        raw = m.bias + (m.linear[f] * v).sum() + sum(
            m.factors[f[a]] @ m.factors[f[b]] * v[a] * v[b] for a in range(len(f)) for b in range(a))
        assert abs(got[i] - 1 / (1 + np.exp(-raw))) < 1e-9


def test_features_do_not_depend_on_neighbours():
    texts = ["A b\nA b\n", None, "", "THE END!! THE END!!", "é" * 3, "x | y | z", " "]
    chars = pa.array([8, None, 0, 18, 3, 9, 1], pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(texts), chars], ["text", "n"])
    (_, stats, row, bucket, x), = fm.features(batch, 0, 1)
    for i in range(len(texts)):
        (_, s, r, b, v), = fm.features(batch.slice(i, 1), 0, 1)
        assert np.allclose(s[0], stats[i]) and (np.sort(b) == np.sort(bucket[row == i])).all()
    get = dict(zip(fm.STATS, stats[0]))
    assert np.isclose(get["words"], np.log1p(4)) and get["distinct"] == 0.5 and get["repeated_lines"] == 0.5
    get = dict(zip(fm.STATS, stats[3]))
    assert get["shouts"] == 1 and get["title_words"] == 1 and get["top_word"] == 0.5


def plain_features(text, n_chars):
    """Statistics and word shares of one text, by string functions."""
    raw = text.encode()
    low = "".join(c.lower() if c < "\u00df" and c != "×" and (c.isascii() or "À" <= c <= "Þ") else c for c in text)
    words = [w for w in re.split(r"[ \t\n\r\x0b\x0c]+", text) if w]
    lows = [w for w in re.split(r"[ \t\n\r\x0b\x0c]+", low) if w]
    size, some = max(len(raw), 1), max(len(words), 1)
    capital = [c for c in text if c.isascii() and c.isupper() or "À" <= c <= "Þ" and c != "×"]
    upper = len(capital)  # a capital of two bytes differs in one of them
    lengths, times = [len(w.encode()) for w in words], Counter(lows)
    lines = [x for x in text.split("\n") if x]
    symbols = sum(c.isascii() and not c.isalnum() and c not in " \t\n\r\x0b\x0c" for c in text)
    stats = {
        "words": np.log1p(len(words)), "mean_word": sum(lengths) / some, "long_word": max(lengths, default=0),
        "upper": upper / size, "digits": sum(c in "0123456789" for c in text) / size, "symbols": symbols / size,
        "other_bytes": sum(b >= 128 for b in raw) / size, "spaces": sum(c in " \t\n\r\x0b\x0c" for c in text) / size,
        "distinct": len(times) / some, "top_word": max(times.values(), default=0) / some,
        "repeated_next": sum(a == b for a, b in zip(lows, lows[1:])) / some,
        "title_words": sum(w[0].isascii() and w[0].isupper() for w in words) / some, "lines": np.log1p(len(lines)),
        "mean_line": sum(len(x.encode()) for x in lines) / max(len(lines), 1),
        "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1),
        "short_words": sum(n <= 2 for n in lengths) / some, "n_chars": np.log1p(max(n_chars or 0, 0))}
    for name, mark in (("stops", "."), ("commas", ","), ("bars", "|"), ("shouts", "!")):
        stats[name] = text.count(mark) / some
    shares = {}
    for word, n in times.items():
        data = np.frombuffer(word.encode(), np.uint8)
        bucket = int(span_hashes(data, np.array([0]), np.array([len(data)]))[0]) >> 51
        shares[bucket] = shares.get(bucket, 0) + fm.WORD_SCALE * (n / some) ** 0.5
    return stats, shares


def test_scores_equal_brute_force(spark, docs):
    rows = [(1, "Good words, more Words.\nGood words\n\nÉtude étude 12!"), (2, None), (3, ""), (4, "!! $$ ## | !!"), (5, "x " * 3000),
            (6, " ".join(f"w{k}" for k in range(4000))), (7, "漢字 é 漢字"), (7, "漢字 é 漢字")]
    rng = np.random.default_rng(3)
    m = fm.Machine(np.sort(rng.normal(size=(len(fm.STATS), fm.BINS - 1)), axis=1))
    m.linear, m.bias = rng.normal(0, 0.1, size=m.linear.shape), 0.2
    got = {r.doc_id: r.score for r in fm.score(docs(rows), m).collect()}
    for i, text in rows:
        stats, shares = plain_features(text or "", len(text or ""))
        x = {fm.WORD_BUCKETS + k * fm.BINS + int((m.edges[k] <= stats[name]).sum()): 1.0 for k, name in enumerate(fm.STATS)}
        x |= shares
        total = m.bias + sum(m.linear[f] * v for f, v in x.items())
        own = list(x.items())
        if len(own) < 200:
            total += sum(m.factors[f] @ m.factors[g] * v * w for a, (f, v) in enumerate(own) for g, w in own[:a])
        else:
            vectors = np.array([m.factors[f] * v for f, v in own])
            both = vectors @ vectors.T
            total += (both.sum() - np.trace(both)) / 2
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(total, -35, 35)))) < 1e-6, i


def test_the_sample_is_bounded(spark, docs):
    labels = spark.createDataFrame([(i % 500, i % 2) for i in range(3000)] + [(7, 0)] * 3000, "doc_id long, quality int")
    df = docs([(i, "some words here " * 20) for i in range(500)] + [(7, f"copy {k}") for k in range(1000)])
    whole = fm.sample(df, labels, F.lit(True), 10_000, 1_000_000).collect()
    assert len(whole) == 501 and {r.quality for r in whole} == {0, 1}
    assert 60 < fm.sample(df, labels, F.lit(True), 100, 1_000_000).count() < 160
    assert 5 < fm.sample(df, labels, F.lit(True), 10_000, 10_000).count() < 80


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = fm.op6_quality_fm(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in label:
            right.append(r.predicted == label[r.doc_id])
    assert len(right) > 50 and np.mean(right) > 0.93


def test_edge_cases(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1000, 1), (3, None), (1, 1)],
                                   "doc_id long, quality int")
    df = docs([(i, "GOOD words. Indeed" if i % 2 else "!! $$ ##" * 3) for i in range(40)] + [
        (None, None), (50, ""), (51, "a " * 50_000), (2, "!! $$ ##" * 3)])
    machine = fm.train(df, labels, F.lit(True))
    got = fm.score(df, machine).collect()
    assert len(got) == 44 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[1] > 0.7 > 0.3 > by_id[2]
    assert fm.score(docs([]), machine).count() == 0
    again = fm.train(df.repartition(5), labels.repartition(3), F.lit(True))
    assert np.allclose(again.factors, machine.factors)


def test_without_two_classes(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    df = docs([(1, "a"), (2, "b")])
    assert [r.score for r in fm.score(df, fm.train(df, labels, F.lit(True))).collect()] == [1.0, 1.0]
    none = fm.train(df, labels.where("false"), F.lit(True))
    assert [r.score for r in fm.score(df, none).collect()] == [0.0, 0.0]
