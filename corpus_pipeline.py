"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``. Every stage works on
all that its predecessor kept; all but the last return the columns of
``documents``.

1. ``quality_rules``: documents that break a rule go.
2. ``near_dedup``: of each group of near duplicates (5-word shingles, similarity
   0.8) the document with the least id stays.
3. ``decontamination``: documents that leak a benchmark item go.
4. ``secret_scan``: secrets are replaced by a mark; all documents stay.
5. ``packing``: what is left is cut and packed into windows of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quill.llm.decontam import drop_leaks
from quill.llm.io import table, written
from quill.llm.near_dup import drop_near_duplicates
from quill.llm.packing import pack_documents
from quill.llm.quality import quality_filter
from quill.llm.queries import tokenizer_file
from quill.llm.secret_scan import redact_secrets


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_filter(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs, k=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the later stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
