"""Registered queries ``opN_<name>``: each applies its operator, with production
parameters, to the whole of its table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quill.llm import language_id, lm_score, rlz_dedup, suffix_dedup
from quill.llm.decontam import find_leaks
from quill.llm.io import table
from quill.llm.license import license_summary, scan_licenses
from quill.llm.near_dup import near_duplicates
from quill.llm.packing import pack_documents
from quill.llm.periodic import periodic_runs, run_summary, with_planted_runs
from quill.llm.quality import quality_rules
from quill.llm.secret_scan import scan_secrets, secret_summary
from quill.llm.toxicity import score_toxicity, train
from quill.llm.whitening import fit_whitening, whiten


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer's vocabulary lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base places, labels and score."""
    return license_summary(scan_licenses(table(spark, sf_dir, "documents")))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and component (4-word shingles)."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings."""
    return suffix_dedup.repeat_summary(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak with its tiles and coverage."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts, base digest and spans."""
    return secret_summary(scan_secrets(table(spark, sf_dir, "documents")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its measures, the base verdict and the whole verdict."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by documents labelled as good against all documents."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.score(docs, lm_score.train_models(docs, good))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word runs that an earlier one has."""
    return rlz_dedup.repeat_summary(rlz_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its predicted language."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, one in ten with a planted run, with its runs and their digests."""
    return run_summary(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the first whitened components."""
    vectors = table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit_whitening(vectors))


QUERIES = {f.__name__: f for f in (
    op1_license_scan,
    op2_near_duplicates,
    op3_suffix_dedup,
    op4_decontamination,
    op5_secret_scan,
    op6_packing,
    op7_quality_rules,
    op8_lm_scoring,
    op9_substring_dedup,
    op10_toxicity,
    op11_language_id,
    op12_periodic_runs,
    op13_embedding_whitening,
)}
