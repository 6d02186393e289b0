"""The corpus pipeline: quality, boilerplate lines, near duplicates, benchmark leaks, token ids.

Every stage takes (spark, docs, sf_dir); each result is written as Parquet and read
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spectrine.llm import byte_bpe, decontaminate, line_dedup, near_dup, quality
from spectrine.llm.scratch import Scratch
from spectrine.workers import ready

STAGES = [
    ("quality", quality.stage),
    ("line_dedup", line_dedup.stage),
    ("near_dup", near_dup.stage),
    ("decontaminate", decontaminate.stage),
    ("byte_bpe", byte_bpe.stage),
]

#: A learned classifier and tiktoken's merges cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, n_tokens, ids_sha256, decoded_sha256 of what is kept."""
    ready(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
