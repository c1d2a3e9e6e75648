"""Exact dedup by skew-safe combining (operator 8), DataFrame functions only.

Equal texts are found by comparing the whole text at every stage:

1. *locally*: the partial aggregate of ``groupBy(digest, salt, text)`` reduces
   the copies that one task holds to one row, before any shuffle;
2. *salted digest groups*: the shuffle by (digest, salt, text) spreads a group
   of copies over ``SALTS`` tasks, each of which gets one row per upstream task;
3. *globally*: the ``SALTS`` winners of a text are combined by (digest, text).

Every stage keeps the largest ``doc_id`` and the number of rows. The verdict of
each row is then looked up by digest alone wherever a digest has one text
(stage 3 has compared them all, so that is exact); rows of a digest that two
texts share are looked up by the text.

Defined results: a null text counts as empty. A null ``doc_id`` is below all
others. Rows that repeat both ``doc_id`` and text are one document: ``verdicts``
gives one row for them (``group_size`` counts the rows), ``keep_documents`` one
copy. An empty table gives an empty result. Other columns are carried along,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, materialise, read_table

#: Tasks over which the copies of one text are spread.
SALTS = 32


def sha256_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(col(docs, "text"), F.lit(""))
    return docs.select(col(docs, "doc_id").alias("doc_id"), text.alias("text"), digest(text).alias("digest"))


def _groups(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(digest, text, keep_id, group_size): one row per distinct text."""
    salted = _rows(docs, digest).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    winners = salted.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return winners.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def verdicts(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept), one row per document, dropped ones too."""
    found = materialise(_groups(docs, digest).drop("text"), "dedup-groups")
    # Written, so that both sides of the join are plain shuffles, and Spark can split the rows of a hot digest.
    texts = materialise(found.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size")), "dedup-texts")
    ids = _rows(docs, digest).select("doc_id", "digest").distinct()
    shared = texts.where("texts > 1")
    if shared.isEmpty():
        out = ids.join(texts.drop("texts"), "digest")
    else:
        clear = ids.join(texts.where("texts = 1").drop("texts"), "digest")
        clash = _rows(docs, digest).join(shared.select("digest"), "digest", "left_semi").distinct()
        groups = materialise(_groups(docs, digest).join(shared.select("digest"), "digest", "left_semi"), "dedup-shared")
        out = clear.unionByName(clash.join(groups, ["digest", "text"]).drop("text"))
    return out.select("doc_id", "digest", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def keep_documents(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """The rows that stay, whole, with the columns of ``docs``.

    The rest of the winning row travels through the same three stages, so no
    join back is needed. Rows with one ``doc_id`` and text but other columns
    that differ: the row with the largest hash of its columns stays.
    """
    names = docs.columns
    rest = [c for c in names if c != "text"]
    hashed = [col(docs, c) for c in rest if "map<" not in dict(docs.dtypes)[c]]
    text = col(docs, "text")
    rows = docs.select(
        F.coalesce(text, F.lit("")).alias("text"), digest(F.coalesce(text, F.lit(""))).alias("digest"),
        F.pmod(F.xxhash64(col(docs, "doc_id")), F.lit(SALTS)).alias("salt"),
        F.struct(col(docs, "doc_id").alias("id"), text.isNotNull().alias("has_text"),
                 F.xxhash64(*hashed).alias("tie")).alias("rank"),
        F.struct(*[col(docs, c).alias(f"c{i}") for i, c in enumerate(rest)]).alias("rest"))
    best = [F.max_by("rest", "rank").alias("rest"), F.max("rank").alias("rank")]
    winners = rows.groupBy("digest", "salt", "text").agg(*best)
    kept = winners.groupBy("digest", "text").agg(*best)
    place = {c: f"rest.c{i}" for i, c in enumerate(rest)}
    return kept.select(*[F.when(F.col("rank.has_text"), F.col("text")).alias(c) if c == "text"
                         else F.col(place[c]).alias(c) for c in names])


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(read_table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_documents(docs)


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
ORACLE_SQL = {"op8_exact_dedup": """
with t as (select doc_id, coalesce(text, '') as txt from documents),
g as (select txt, max(doc_id) as keep_id, count(*) as group_size from t group by txt)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.txt) as text_sha256
from t join g on t.txt = g.txt
"""}
