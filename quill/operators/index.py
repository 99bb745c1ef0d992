"""A TF-IDF index kept as bucketed tables, so that later queries shuffle nothing.

Three tables lie in the shared scratch folder (or below ``path``):

* ``postings`` ``(term, salt, id, tf)`` and ``terms`` ``(term, salt, df)``, bucketed alike by
  term and salt: weights for another corpus size, or of other terms, are a join without
  an exchange;
* ``weights`` ``(id, term, tf, df, w)``, bucketed by id: norms and all per-document steps
  are windows without an exchange.

Building tokenises the corpus once and shuffles its term counts twice, to the terms and
back. A bucket is read by one task, and a term can be in every document: ``salt`` deals a term
that more than ``hot`` documents have over as many buckets as it needs, by a hash of
the id, and ``terms`` has a row for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.functions.text import log_tf_idf
from quill.operators import text as TX
from quill.sources.scratch import scratch_path, written


#: postings that a bucket holds; a task sorts those of a bucket, some 100 bytes each
BUCKET_ROWS = 4_000_000


@dataclass
class TfidfIndex:
    """Names of the tables, and the number of documents that the weights are for."""
    spark: SparkSession
    name: str
    n_docs: int
    buckets: int

    def table(self, part: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{part}")

    def document_frequency(self) -> DataFrame:
        """``(term, df)``."""
        return self.table("terms").where("salt = 0").select("term", "df")

    def reweighted(self, n_docs: int | Column | None = None) -> DataFrame:
        """``(id, term, tf, df, w)`` from the postings, for any corpus size."""
        n = self.n_docs if n_docs is None else n_docs
        n = n if isinstance(n, Column) else F.lit(n)
        joined = self.table("postings").hint("merge").join(self.table("terms"), ["term", "salt"])
        return joined.select("id", "term", "tf", "df", log_tf_idf("tf", "df", n).alias("w"))

    def normalized(self, zero_norm: str = "null") -> DataFrame:
        """``(id, term, tf, df, w, norm, w_norm)``, see :func:`quill.operators.text.l2_normalize`."""
        return TX.l2_normalize(self.table("weights"), zero_norm=zero_norm)

    def query_side(self, query_tf: DataFrame) -> DataFrame:
        """Normalised weights of queries ``(id, term, tf)`` against this corpus."""
        weights = TX.query_tfidf(query_tf, self.document_frequency(), F.lit(self.n_docs))
        return TX.l2_normalize(weights, zero_norm="zero")

    def drop(self) -> None:
        for part in ("postings", "terms", "weights"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")


def build_index(docs: DataFrame, id_col: str = "id", text_col: str = "text", stop: Iterable[str] | DataFrame = (),
                keep_empty: bool = True, buckets: int | None = None, hot: int = 1_000_000,
                path: str | None = None) -> TfidfIndex:
    """Index of a corpus. ``buckets``: as many as tasks should read it; by default the session's
    shuffle partitions, or more if a bucket would have over ``BUCKET_ROWS`` postings, so that what a
    task sorts does not grow with the corpus."""
    spark = docs.sparkSession
    tokens = TX.tokenize(TX.by_document(docs, id_col), id_col, text_col, keep_empty)
    tf = written(TX.term_frequency(TX.remove_stop_words(tokens, stop)))
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tf.count() // BUCKET_ROWS))
    index = TfidfIndex(spark, f"quill_index_{uuid.uuid4().hex}", docs.count(), buckets)
    base = path or scratch_path(spark)

    def save(df: DataFrame, part: str, *keys: str) -> None:
        (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
         .option("path", f"{base}/{part}").saveAsTable(f"{index.name}_{part}"))

    # written: both tables must deal a term alike
    df = written(TX.document_frequency(tf).withColumn("_salts", F.ceil(F.col("df") / hot)))
    save(df.select("term", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("salt"), "df"), "terms", "term", "salt")
    # only hot terms have several salts: while these are few, the postings meet them without a shuffle
    hot_terms = written(df.where("_salts > 1").select("term", "_salts"))
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    save(tf.join(hot_terms, "term", "left")
         .select("term", F.pmod(F.xxhash64("id"), salts).alias("salt"), "id", "tf"), "postings", "term", "salt")
    save(index.reweighted(), "weights", "id")
    return index
