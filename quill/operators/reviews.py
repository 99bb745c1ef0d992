"""Review leader board: reviews per (product, day) with average rating,
joined with product brands, top-k by review count.

Plan at scale: one partial/final hash aggregate on (product, day) (a hot
product only adds rows to the map-side combine), one equi-join on the
product key, whose strategy is left to the planner and AQE (the metadata
table grows with the catalogue, so it is never forced to broadcast), and a
``TakeOrderedAndProject`` for the top-k, which keeps a k-row heap per
partition instead of sorting everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_review_stats(reviews: DataFrame, product: str = "asin", day: str = "review_date",
                       rating: str = "overall", digits: int | None = None) -> DataFrame:
    """``(product, day, n, avg_overall[, avg_<digits>])``: number of reviews and
    average rating per product and day. Null ratings count as reviews but
    are skipped by the average."""
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(rating).alias("avg_overall")]
    out = reviews.groupBy(product, day).agg(*aggs)
    if digits is not None:
        out = out.withColumn(f"avg_{digits}", F.round("avg_overall", digits))
    return out


def brands(meta: DataFrame, product: str = "asin", brand: str = "brand") -> DataFrame:
    """Products with a brand: drops null brands, keeps the empty string."""
    return meta.select(product, brand).where(F.col(brand).isNotNull())


def with_brand(stats: DataFrame, meta: DataFrame, product: str = "asin",
               brand: str = "brand") -> DataFrame:
    """Inner join of per-(product, day) stats with brands; a product listed
    twice in the metadata fans out to two rows."""
    return stats.join(brands(meta, product, brand), on=product, how="inner")


def top_reviewed(df: DataFrame, k: int = 15, by: str = "n",
                 tie_break: tuple[str, ...] = ("asin", "review_date")) -> DataFrame:
    """The k rows with the most reviews; ties go to the smallest tie-break
    key, so the result is deterministic."""
    order = [F.col(by).desc()] + [F.col(c).asc() for c in tie_break]
    return df.orderBy(*order).limit(k)


def review_leader_board(reviews: DataFrame, meta: DataFrame, k: int = 15, digits: int = 2,
                        product: str = "asin", day: str = "review_date",
                        rating: str = "overall", brand: str = "brand",
                        rounding: str = "half_up") -> DataFrame:
    """``(asin, review_date, n, avg, brand)`` for the k busiest (product, day)
    pairs that have a brand. ``rounding='half_even'`` rounds the average
    like Python's ``round`` does on most values (``bround``)."""
    rnd = F.bround if rounding == "half_even" else F.round
    stats = (reviews.groupBy(product, day)
             .agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(rating), digits).alias("avg")))
    joined = with_brand(stats, meta, product, brand)
    return top_reviewed(joined.select(product, day, "n", "avg", brand), k, "n",
                        (product, day, brand))
