import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from blocklot.llm import bpe, decontaminate, language
from blocklot.llm.registry import ORACLE_SQL, QUERIES
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "decontaminate", "bpe_round_trip"]
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(name, spark, duck):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    order = [want.columns.index(c) for c in columns]
    assert a == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_stages_keep_the_columns_and_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    unknown = {r.doc_id for r in language.identify(docs, language.train(docs, ~language.held_out(docs))).where(
        "lang_pred = 'und'").collect()}
    left = {i: t for i, t in rows.items() if i not in unknown}
    best = {}
    for i, t in left.items():
        best[t or ""] = max(i, best.get(t or "", -1))
    left = {i: left[i] for i in best.values()}
    classes = brute_components(sorted((i, brute_fingerprint(t)) for i, t in left.items()))
    left = {i: left[i] for i in set(classes.values())}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    frame = docs.where(docs.doc_id.isin([int(i) for i in left]))
    leaks = {r.doc_id for r in decontaminate.contaminated(frame, bench).collect()}
    left = {i: t for i, t in left.items() if i not in leaks}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {(i, hashlib.sha256(",".join(map(str, library.encode_ordinary(t or ""))).encode()).hexdigest())
            for i, t in left.items()}
    assert {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()} == want
    assert leaks and len(left) < len(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
