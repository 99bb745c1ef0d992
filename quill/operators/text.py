"""TF-IDF over a text column, kept in sparse long form ``(id, term, value)``.

No document x vocabulary product is ever built: a document vector is the set
of its ``(id, term, w)`` rows, and two vectors meet only through an equi-join
on ``term`` (see :mod:`quill.operators.similarity`).

Plan at scale (per corpus): the documents are hash-partitioned by id once
(:func:`by_document`; one shuffle of the raw text, which is smaller than the
``(id, term, tf)`` rows it turns into). Tokenising and term frequency then run
inside that partitioning without another exchange; a document is one input row, so
no per-document step can be more skewed than the input itself. Document frequency is a
partial/final hash aggregate on ``term`` (map-side combine, so a term present
everywhere is not a hot key), and the corpus size is a scalar subquery (no
driver action, no cross join). The tf-df equi-join on ``term`` is left to the
planner. While the measured vocabulary is small it is a broadcast join, and the
L2 norm (a window over ``id``) needs no exchange either. With a larger vocabulary
it is a sort-merge join, whose hot-term partitions AQE splits: then every tf row
is shuffled by term, and once more by id for the norm. Counts that were written can be
dealt for these steps so that tasks stay bounded (:func:`deal_by_term`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions.text import (divide_or_zero, log_tf_idf, query_log_tf_idf, safe_divide,
                                  split_tokens)


#: bytes of text that one task tokenises and counts, some 1.5 to 3 million words
DOCUMENT_TASK_BYTES = 16 << 20

#: counts that one task sorts by term, or weights by document, some 100 bytes each
COUNT_TASK_ROWS = 1 << 20


def by_document(docs: DataFrame, id_col: str = "id", sized_by: DataFrame | None = None) -> DataFrame:
    """Hash-partition documents by id so that every later per-document step
    (tokens, tf, norms) runs without another shuffle.

    A task holds the distinct words of all its documents at once, so the number of
    partitions follows the bytes of text (one aggregate job over the string columns of
    ``sized_by``, by default of ``docs``): a task gets some ``DOCUMENT_TASK_BYTES``
    however large the corpus is. A corpus of a few such tasks is left to the session's
    shuffle settings."""
    measured = docs if sized_by is None else sized_by
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in measured.schema.fields if f.dataType == T.StringType()]
    size = measured.agg(F.sum(sum(texts, F.lit(0)).cast("long")).alias("n")).first()["n"] or 0
    tasks = -(-size // DOCUMENT_TASK_BYTES)
    if tasks <= 4:
        return docs.repartition(F.col(id_col))
    return docs.repartition(max(tasks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), F.col(id_col))


def tokenize(docs: DataFrame, id_col: str = "id", text_col: str = "text",
             keep_empty: bool = True, carry: Iterable[str] = ()) -> DataFrame:
    """``(id, term, *carry)``, one row per token occurrence.

    Splits on runs of non-word characters, then lower-cases each token.
    Text that starts or ends with a separator yields the empty token ``''``,
    which is a term like any other unless ``keep_empty=False``. Null text
    yields no rows.
    """
    carry = list(carry)
    out = (docs.where(F.col(text_col).isNotNull())
           .select(F.col(id_col).alias("id"), *carry,
                   F.explode(split_tokens(text_col)).alias("_tok"))
           .select("id", F.lower("_tok").alias("term"), *carry))
    if not keep_empty:
        out = out.where(F.col("term") != "")
    return out


def remove_stop_words(tokens: DataFrame, stop: Iterable[str] | DataFrame,
                      term: str = "term") -> DataFrame:
    """Drop tokens that equal a stop word exactly (no trimming, no case
    folding of the list).

    A Python list becomes an ``IN`` predicate evaluated in the scan's codegen
    stage (its size is known on the driver). A DataFrame list (one string
    column) becomes a left-anti join whose strategy the planner picks from
    the list's measured size.
    """
    if isinstance(stop, DataFrame):
        word = stop.columns[0]
        words = stop.select(F.col(word).alias("_stop")).where(F.col("_stop").isNotNull())
        return tokens.join(words, tokens[term] == words["_stop"], "left_anti")
    words = sorted(set(stop))
    if not words:
        return tokens
    return tokens.where(~F.col(term).isin(words))


def term_frequency(tokens: DataFrame, id_col: str = "id", term: str = "term") -> DataFrame:
    """``(id, term, tf BIGINT)``."""
    return tokens.groupBy(id_col, term).agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(tf: DataFrame, term: str = "term") -> DataFrame:
    """``(term, df BIGINT)``: number of ``(id, term)`` rows per term, i.e. of
    distinct documents containing it."""
    return tf.groupBy(term).agg(F.count(F.lit(1)).alias("df"))


def corpus_size(docs: DataFrame) -> Column:
    """Number of rows of the corpus as a scalar-subquery column. Rows are
    counted, so a repeated id counts twice and an empty document counts."""
    return docs.select(F.count(F.lit(1)).alias("n_docs")).scalar()


@dataclass
class TermDeal:
    """How rows of counts meet rows of terms, see :func:`deal_by_term`. ``on``: the columns they
    share, the ``term`` of the operators that join them."""
    on: list[str]
    tasks: int | None = None
    hot: DataFrame | None = None

    def counts(self, tf: DataFrame) -> DataFrame:
        """``(id, term, ...)`` dealt by term, a hot term's rows by id as well."""
        if self.tasks is None:
            return tf
        term, salt = self.on
        salts = F.coalesce("_salts", F.lit(1).cast("long"))
        return (tf.join(F.broadcast(self.hot), term, "left")     # a term for each COUNT_TASK_ROWS / 4 counts at most
                .withColumn(salt, F.pmod(F.xxhash64("id"), salts)).drop("_salts")
                .repartition(self.tasks, *self.on))

    def terms(self, table: DataFrame) -> DataFrame:
        """``(term, ...)`` dealt alike, a hot term's row once for each part of its counts."""
        if self.tasks is None:
            return table
        term, salt = self.on
        salts = F.coalesce("_salts", F.lit(1).cast("long"))
        return (table.join(F.broadcast(self.hot), term, "left")
                .withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
                .repartition(self.tasks, *self.on))

    def by_id(self, weights: DataFrame, id_col: str = "id") -> DataFrame:
        """Weights dealt by document, for the norms."""
        return weights if self.tasks is None else weights.repartition(self.tasks, F.col(id_col))


def deal_by_term(tf: DataFrame, df: DataFrame, term: str = "term") -> TermDeal:
    """Dealing of counts ``(id, term, ...)`` and of their terms that keeps a task at some
    ``COUNT_TASK_ROWS`` counts however many there are (one count of ``tf``): the number of
    partitions follows them, and a term with over a quarter of that is dealt over several
    by a hash of the id. Counts that the session's shuffle partitions hold are left to these.
    Both frames are read more than once: pass written ones."""
    rows = tf.count()
    tasks = -(-rows // COUNT_TASK_ROWS)
    if tasks <= 4:
        return TermDeal([term])
    share = COUNT_TASK_ROWS // 4
    hot = df.where(F.col("df") > share).select(term, F.ceil(F.col("df") / share).alias("_salts"))
    return TermDeal([term, "_salt"], max(tasks, int(tf.sparkSession.conf.get("spark.sql.shuffle.partitions"))), hot)


def tfidf(tf: DataFrame, df: DataFrame, n_docs: Column, term: str | list[str] = "term") -> DataFrame:
    """``(id, term, tf, df, w)`` with ``w = (1 + log10 tf) * log10(N / df)``."""
    return (tf.join(df, on=term, how="inner")
            .withColumn("w", log_tf_idf("tf", "df", n_docs)))


def query_tfidf(query_tf: DataFrame, corpus_df: DataFrame, n_docs: Column,
                term: str | list[str] = "term") -> DataFrame:
    """Query-side weights against the corpus's document frequencies:
    ``(id, term, tf, df, w)``; a term that no corpus document contains keeps
    its row with ``df`` null and ``w = 0``."""
    return (query_tf.join(corpus_df, on=term, how="left")
            .withColumn("w", query_log_tf_idf("tf", "df", n_docs)))


def l2_norms(weights: DataFrame, id_col: str = "id", w: str = "w") -> DataFrame:
    """``(id, norm)`` with ``norm = sqrt(sum(w^2))``, as a partial/final
    aggregate (for vectors keyed by something coarser than a document)."""
    return weights.groupBy(id_col).agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("norm"))


def l2_normalize(weights: DataFrame, id_col: str = "id", w: str = "w", out: str = "w_norm",
                 zero_norm: str = "null") -> DataFrame:
    """Adds ``norm`` and ``out = w / norm`` for per-document vectors.

    The norm is a window sum over ``id``: no exchange when the rows are
    already partitioned by document (see :func:`by_document`).
    ``zero_norm='null'`` leaves ``out`` null for a document whose norm is 0
    (every term in every document); ``'zero'`` sets it to 0 instead.
    """
    div = safe_divide if zero_norm == "null" else divide_or_zero
    norm = F.sqrt(F.sum(F.col(w) * F.col(w)).over(Window.partitionBy(id_col)))
    return weights.withColumn("norm", norm).withColumn(out, div(w, "norm"))


def tfidf_index(docs: DataFrame, id_col: str = "id", text_col: str = "text",
                stop: Iterable[str] | DataFrame = (), keep_empty: bool = True) -> DataFrame:
    """Normalised TF-IDF of a corpus: ``(id, term, tf, df, w, norm, w_norm)``."""
    tf = term_frequency(remove_stop_words(tokenize(by_document(docs, id_col), id_col, text_col,
                                                   keep_empty), stop))
    weights = tfidf(tf, document_frequency(tf), corpus_size(docs))
    return l2_normalize(weights, "id", "w", "w_norm", zero_norm="null")


def query_index(queries: DataFrame, corpus: DataFrame, id_col: str = "id",
                query_col: str = "title", corpus_col: str = "text",
                stop: Iterable[str] | DataFrame = (), keep_empty: bool = True) -> DataFrame:
    """Normalised query-side TF-IDF (weights from the corpus's df and N):
    ``(id, term, tf, df, w, norm, w_norm)``; ``w_norm`` is 0 for a query
    whose norm is 0."""
    corpus_tf = term_frequency(remove_stop_words(
        tokenize(by_document(corpus, id_col), id_col, corpus_col, keep_empty), stop))
    q_tf = term_frequency(remove_stop_words(
        tokenize(by_document(queries, id_col), id_col, query_col, keep_empty), stop))
    weights = query_tfidf(q_tf, document_frequency(corpus_tf), corpus_size(corpus))
    return l2_normalize(weights, "id", "w", "w_norm", zero_norm="zero")


def vocabulary_index(df: DataFrame, term: str = "term", out: str = "slot") -> DataFrame:
    """``(term, slot BIGINT)``: every vocabulary term numbered 0, 1, ... in
    term order -- the slot it would hold in a dense vector. A distributed
    global ranking (see :func:`quill.operators.ratings.global_index`)."""
    from quill.operators.ratings import global_index
    return global_index(df.select(term).distinct(), [F.col(term).asc()], out)


def sparse_vectors(weights: DataFrame, vocab: DataFrame, id_col: str = "id", term: str | list[str] = "term",
                   w: str = "w_norm", slot: str = "slot") -> DataFrame:
    """``(id, slot, w)``: each document vector as coordinates in the dense
    slot order -- the dense vector without its zeros. No document x
    vocabulary grid is built; the join on ``term`` is an equi-join (AQE
    broadcasts the vocabulary when its measured size allows)."""
    return weights.join(vocab, on=term, how="inner").select(id_col, slot, w)
