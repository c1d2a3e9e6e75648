import hashlib

from pyspark.sql import functions as F

from blocklot.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = set()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            out.add((i, hashlib.sha256(t.encode()).hexdigest(), keep, len(ids), i == keep))
    return out


CASES = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (None, "a"), (None, "c"), (7, "a "), (8, "b"), (8, "b"),
         (9, "é" * 50_000), (10, "é" * 50_000), (11, "A")]


def test_verdicts_equal_brute_force(docs, rows_of):
    got = rows_of(exact_dedup.verdicts(docs(CASES)))
    assert len(got) == len(set(got))
    assert set(got) == brute(CASES)


def test_shared_digests_are_told_apart_by_text(docs):
    weak = exact_dedup.verdicts(docs(CASES), digest=lambda t: F.length(t).cast("string"))
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in weak.collect()}
    assert got == {(i, k, n, x) for i, _, k, n, x in brute(CASES)}


def test_keep_documents_keeps_one_whole_row(docs, rows_of):
    df = docs(CASES)
    kept = exact_dedup.keep_documents(df)
    assert kept.columns == df.columns and kept.schema == df.schema
    got = {(r.doc_id, r.text or "") for r in kept.collect()}
    assert got == {(8, "b"), (2, "a"), (5, ""), (None, "c"), (7, "a "), (10, "é" * 50_000), (11, "A")} | set()
    assert kept.count() == 7


def test_hot_group_is_spread_over_the_salts(spark, docs):
    df = docs([(i, "same") for i in range(2000)] + [(10_000 + i, str(i)) for i in range(50)])
    out = {r.doc_id: r for r in exact_dedup.verdicts(df.repartition(4)).collect()}
    assert out[5].keep_id == 1999 and out[5].group_size == 2000 and sum(r.kept for r in out.values()) == 51


def test_the_rows_of_a_hot_digest_are_split(spark, docs):
    few = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k, None) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60_000, 1, 12).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('text ', id)) as text")
        out = exact_dedup.verdicts(rows)
        assert out.where("kept").count() == 40_001
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        sizes = [len(p) for p in exact_dedup.verdicts(rows).select("doc_id").rdd.glom().collect()]
        assert max(sizes) < 15_000 and sum(sizes) == 60_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_empty_table(docs):
    assert exact_dedup.verdicts(docs([])).count() == 0
    assert exact_dedup.keep_documents(docs([])).count() == 0


def test_no_python_in_the_plan(documents):
    plan = exact_dedup.verdicts(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
