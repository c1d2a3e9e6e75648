import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from blocklot.llm import language

EN = "the cat and the dog went over this thing with that other one then they were there "
FR = "le chat et la chienne ont été dans une maison où quelque chose était très beau "


def small_model(spark):
    rows = [(i, EN * 3, "en", None) for i in range(5)] + [(10 + i, FR * 3, "fr", None) for i in range(5)]
    df = spark.createDataFrame(rows + [(99, "zzz", None, None), (98, None, "en", None)],
                               "doc_id long, text string, lang string, source string")
    return language.train(df, F.lit(True))


def test_held_out_accuracy_and_contract(spark):
    sf = "/root/testdata/sf0.01"
    known = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = language.op1_language_mix(spark, sf).collect()
    assert len(got) == len(known)
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == known[r.doc_id][0])
    assert len(right) > 200 and np.mean(right) > 0.97


def test_rare_languages_are_learnt_and_copies_count_once(spark):
    common = spark.range(6000).selectExpr("id as doc_id", "concat('the other one ', id) as text", "'en' as lang")
    rare = spark.range(5).selectExpr("id + 10000 as doc_id", "concat('chat très beau ', id) as text", "'fr' as lang")
    hot = spark.range(3000).selectExpr("id + 20000 as doc_id", "'une copie encore' as text", "'fr' as lang")
    df = common.unionByName(rare).unionByName(hot).withColumn("TEXT2", F.lit("x"))
    model = language.train(df, F.lit(True), rows=200)
    assert model.langs == ["en", "fr"]
    same = language.train(common.unionByName(rare).unionByName(hot.limit(1)), F.lit(True), rows=200)
    assert (model.logs == same.logs).all()
    got = {r.doc_id: r.lang_pred for r in language.identify(rare.unionByName(common.limit(50)), model).collect()}
    assert all(v == ("fr" if k >= 10_000 else "en") for k, v in got.items()) and len(got) == 55


def test_mixture_is_found_and_pure_text_stays_pure(spark):
    model = small_model(spark)
    assert model.langs == ["en", "fr"]
    langs, scores, mixtures = language.predictions(model, pa.array([EN * 20, EN * 15 + FR * 5, FR, FR * 20]))
    assert langs == ["en", "en", "fr", "fr"]
    assert scores[0] == 1 and scores[3] == 1 and 0.65 < scores[1] < 0.85
    assert mixtures[1].startswith("en:0.7") and "," not in mixtures[0]


def test_em_equals_a_plain_loop():
    rng = np.random.default_rng(0)
    ll = rng.normal(0, 2, (30, 3))
    many = np.array([10, 20])
    odds = np.exp(ll - ll.max(axis=1, keepdims=True))
    share, _ = language.expectation_maximisation(odds, np.array([0, 10]), many, np.full((2, 3), 1 / 3))
    for d, (a, b) in enumerate([(0, 10), (10, 30)]):
        p = np.full(3, 1 / 3)
        for _ in range(language.STEPS):
            r = np.exp(ll[a:b]) * p
            p = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        assert np.allclose(share[d], p)


def test_windows_do_not_depend_on_neighbours_or_blocks(spark, monkeypatch):
    model = small_model(spark)
    texts = ["", EN * 40, "x", FR, None, EN * 3000 + FR * 1000, "ab", "123", "é"]
    together = language.predictions(model, pa.array(texts))
    for i, t in enumerate(texts):
        alone = language.predictions(model, pa.array([t], pa.string()))
        assert alone[0][0] == together[0][i] and abs(alone[1][0] - together[1][i]) < 1e-9
    monkeypatch.setattr(language, "BLOCK_BYTES", 1 << 12)
    again = language.predictions(model, pa.array(texts))
    assert again[0] == together[0] and np.allclose(again[1], together[1])


def test_unknown(spark, docs):
    model = small_model(spark)
    rows = [(1, None), (2, ""), (3, "12 !! 34"), (4, "…—"), (5, "a"), (5, "a"), (None, EN)]
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs(rows), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (None, "en")} <= got and len(got) == 6
    df = docs(rows)
    kept = language.keep_known(df, model)
    assert kept.columns == df.columns and sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["5", "5", "None"]


def test_nothing_learned_and_empty_table(spark, docs):
    none = language.train(docs([(1, "a")], lang=None), F.lit(True))
    assert [r.lang_pred for r in language.identify(docs([(1, "abc")]), none).collect()] == ["und"]
    assert language.identify(docs([]), small_model(spark)).count() == 0
