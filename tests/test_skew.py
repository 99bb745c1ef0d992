"""Hot keys: every per-key aggregate combines map-side before its shuffle,
and results stay exact when one key holds a third of the rows."""

import datetime as dt

from pyspark.sql import functions as F

from quill.operators import ratings as RT
from quill.operators import reviews as RV
from quill.operators import similarity as SM
from quill.operators import text as TX


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed_reviews(spark, n=3000):
    # product 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("asin"),
        F.lit(dt.date(2020, 1, 1)).alias("review_date"),
        (F.col("id") % 5 + 1).cast("double").alias("overall"))


def test_daily_stats_partial_aggregate_on_hot_product(spark):
    stats = RV.daily_review_stats(_skewed_reviews(spark))
    plan = _plan(stats)
    assert "partial_count" in plan and "partial_avg" in plan
    hot = stats.where("asin = 0").collect()[0]
    assert hot.n == 1000 and hot.avg_overall == sum((i % 5 + 1) for i in range(0, 3000, 3)) / 1000


def test_median_sketch_merges_map_side(spark):
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("item_id"),
        (F.col("id") % 101).cast("double").alias("playtime_forever"))
    med = RT.item_median(items)
    assert "partial_percentile_approx" in _plan(med)
    hot = med.where("item_id = 7").collect()[0].median
    vals = sorted(float(i % 101) for i in range(0, 3000, 3))
    assert hot == vals[(len(vals) - 1) // 2]


def test_best_match_reduces_map_side(spark):
    scores = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("id_1"),
        F.col("id").alias("id_2"), ((F.col("id") * 7919) % 1000 / 1000.0).alias("cos"))
    best = SM.best_match(scores)
    assert "partial_min_by" in _plan(best)
    rows = [(i, (i * 7919) % 1000 / 1000.0) for i in range(0, 3000, 3)]
    want = min(rows, key=lambda r: (-round(r[1], 9), r[0]))
    got = best.where("id_1 = 1").collect()[0]
    assert (got.best, got.cos) == want


def test_document_frequency_combines_hot_terms(spark):
    docs = spark.range(600).select(F.col("id"), F.concat(F.lit("the common "), F.col("id").cast("string"))
                                   .alias("text"))
    df = TX.document_frequency(TX.term_frequency(TX.tokenize(docs, "id", "text")))
    assert "partial_count" in _plan(df)
    got = {r.term: r.df for r in df.where("term in ('the', 'common')").collect()}
    assert got == {"the": 600, "common": 600}
