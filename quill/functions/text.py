"""Column expressions for text: cleaning, tokenising, TF-IDF weights, cosine.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of characters that are neither letters, digits nor the
# underscore separates tokens. Written with Unicode classes so that Spark
# (Java regex) and DuckDB (RE2) read the same set.
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Replace every run of non-word characters by one space."""
    return F.regexp_replace(_col(text), NON_WORD_RUN, " ")


def split_tokens(text: Column | str) -> Column:
    """Split on runs of non-word characters. Leading and trailing separators
    yield empty tokens, which are kept (limit -1)."""
    return F.split(_col(text), NON_WORD_RUN, -1)


def log_tf_idf(tf: Column | str, df: Column | str, n_docs: Column | str) -> Column:
    """``(1 + log10 tf) * log10(N / df)``."""
    tf, df, n_docs = _col(tf), _col(df), _col(n_docs)
    return (F.lit(1.0) + F.log10(tf.cast("double"))) * F.log10(n_docs.cast("double") / df.cast("double"))


def query_log_tf_idf(tf: Column | str, df: Column | str, n_docs: Column | str) -> Column:
    """Weight of a query-side term: 0 when the term is in no corpus document
    (``df`` null or 0), else :func:`log_tf_idf`."""
    df = _col(df)
    return F.when(df.isNull() | (df == 0), F.lit(0.0)).otherwise(log_tf_idf(tf, df, n_docs))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / den``, null when ``den`` is 0 (ANSI mode would raise)."""
    den = _col(den)
    return _col(num) / F.when(den != 0, den)


def divide_or_zero(num: Column | str, den: Column | str) -> Column:
    """``num / den``, 0 when ``den`` is 0."""
    den = _col(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(_col(num) / den)
