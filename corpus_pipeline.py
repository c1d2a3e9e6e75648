"""Corpus pipeline: the stages that turn raw documents into token ids.

Each stage calls one operator of ``blocklot.llm``. Its result is written as
Parquet to the shared folder and read back as the next stage's documents, so
each stage works on all that its predecessor kept, and a lost executor costs
no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blocklot.llm import bpe, decontaminate, exact_dedup, language, simhash
from blocklot.llm.common import materialise, read_table

STAGES = [
    ("language_id", language.stage),  # documents whose language is not known go
    ("exact_dedup", exact_dedup.stage),  # one document of each group of equal texts stays
    ("simhash_near_dedup", simhash.stage),  # one document of each component stays
    ("decontaminate", decontaminate.stage),  # documents that hold a benchmark item go
    ("bpe_round_trip", bpe.stage),  # token ids and what they decode to
]

#: SQL can express neither the language model nor the near-duplicate components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
