"""The input shapes of the analyses, as views over the driver's test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame read from the
parquet tables in ``sf_dir``; filters and column choices reach the parquet
scan. The same views are written in SQL in :mod:`quill.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The stop-word list of the test views.
STOP_WORDS = ("the", "and", "of", "in", "to", "en", "is", "la", "le", "der", "und", "de")

# The patterns that cut a title and an article body out of a page.
TITLE_PATTERN = r"(?is)<title>(.*?)</title>"
ARTICLE_PATTERN = r"(?is)<article>(.*?)</article>"
TAG_PATTERN = r"<[^>]+>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(asin, review_date DATE, overall DOUBLE)``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asin"),
        F.col("l_shipdate").cast("date").alias("review_date"),
        F.col("l_quantity").alias("overall"))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(asin, brand)``; every tenth size has no brand."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asin"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand")).alias("brand"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, abstract, lang, source)``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("abstract"), "lang", "source")


def titled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, title, body)``: the page title and the article text with tags
    replaced by spaces."""
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract(html, TITLE_PATTERN, 1).alias("title"),
        F.regexp_replace(F.regexp_extract(html, ARTICLE_PATTERN, 1), TAG_PATTERN, " ").alias("body"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their orders; Spark reads the columns a view asks for."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")


def users_items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Flat ``(user_id, item_id, playtime_forever)``, one row per order line. ``lines``: the
    order lines where they are at hand."""
    return (order_lines(spark, sf_dir) if lines is None else lines).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("playtime_forever"))


def users_items_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested ``(user_id, items: array<struct<item_id, playtime_forever>>)``,
    one record per order (an order has a bounded number of lines), so a user
    with many orders has many records and no array grows with the user."""
    lines = order_lines(spark, sf_dir)
    return (lines.groupBy("o_orderkey", "o_custkey")
            .agg(F.collect_list(F.struct(F.col("l_partkey").alias("item_id"),
                                         F.col("l_quantity").alias("playtime_forever"))).alias("items"))
            .select(F.col("o_custkey").alias("user_id"), "items"))


def sentiments(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """``(user_id, item_id, vader_score)``, one row per pair, open lines only
    (so a left join has misses)."""
    return ((order_lines(spark, sf_dir) if lines is None else lines).where(F.col("l_linestatus") == "O")
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.max(F.round(F.col("l_discount") - F.lit(0.05), 2)).alias("vader_score")))


def user_reviews(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """``(user_id, item_id, recommend BOOLEAN)``: returned lines do not
    recommend, accepted ones do, the rest have no review."""
    flag = F.when(F.col("l_returnflag") == "R", F.lit(0)).when(F.col("l_returnflag") == "A", F.lit(1))
    return ((order_lines(spark, sf_dir) if lines is None else lines).where(F.col("l_returnflag") != "N")
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg((F.max(flag) == 1).alias("recommend")))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_idx, item_id, rating)``: summed quantity per customer and part."""
    return (order_lines(spark, sf_dir)
            .groupBy(F.col("o_custkey").alias("user_idx"), F.col("l_partkey").alias("item_id"))
            .agg(F.sum("l_quantity").alias("rating")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
