"""Review leader board and rating operators on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quill.operators import ratings as RT
from quill.operators import reviews as RV

from conftest import rows

D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)


def test_leader_board_ties_fanout_and_brands(spark):
    reviews = spark.createDataFrame(
        [(1, D1, 5.0), (1, D1, 4.0), (2, D1, 3.0), (2, D1, 2.0), (3, D2, 1.0), (4, D2, 5.0), (5, D1, None)],
        "asin long, review_date date, overall double")
    meta = spark.createDataFrame(
        [(1, "acme"), (1, "acme-dup"), (2, ""), (3, None), (4, "zed")],
        "asin long, brand string")
    got = RV.review_leader_board(reviews, meta, k=3).collect()
    # product 1 is listed twice in the metadata: two rows; the empty brand is
    # kept; the null brand is dropped; ties go to the smaller product id
    assert [(r.asin, r.n, r.avg, r.brand) for r in got] == [
        (1, 2, 4.5, "acme"), (1, 2, 4.5, "acme-dup"), (2, 2, 2.5, "")]
    stats = {(r.asin, r.review_date): (r.n, r.avg_overall)
             for r in RV.daily_review_stats(reviews).collect()}
    assert stats[(5, D1)] == (1, None)   # a null rating counts, the average skips it


def test_item_median_and_explode(spark):
    nested = spark.createDataFrame(
        [("u1", [("a", 1.0), ("b", 10.0)]), ("u2", [("a", 3.0)]), ("u3", []), ("u4", None),
         ("u5", [("a", 2.0)])],
        "user_id string, items array<struct<item_id:string, playtime_forever:double>>")
    flat = RT.explode_items(nested)
    assert flat.count() == 4                       # empty and null lists vanish
    med = dict(rows(RT.item_median(flat)))
    assert med == {"a": 2.0, "b": 10.0}
    rated = {(r.user_id, r.item_id): r.rating for r in RT.playtime_rating(flat).collect()}
    # a play time equal to the median or to 0.5 x the median falls to 1
    assert rated == {("u1", "a"): 1, ("u1", "b"): 1, ("u2", "a"): 5, ("u5", "a"): 1}


def test_index_users_frequency_then_string_order(spark):
    data = [("b",), ("b",), ("a",), ("c",), ("c",), ("10",), ("9",)]
    items = spark.createDataFrame(data, "user_id string")
    got = rows(RT.index_users(items), "user_id_encoded", "user_id", "n")
    # b and c tie on 2 rows (b first), then 10, 9, a tie on 1 (string order)
    assert got == [(0, "b", 2), (1, "c", 2), (2, "10", 1), (3, "9", 1), (4, "a", 1)]


def test_global_index_across_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(13)
    got = [(r.k, r.idx) for r in RT.global_index(df, [F.col("k").desc()]).collect()]
    ks = sorted((k for k, _ in got), reverse=True)
    assert sorted(got, key=lambda x: x[1]) == [(k, i) for i, k in enumerate(ks)]


def test_encode_decode_round_trip(spark):
    items = spark.createDataFrame([(5,), (5,), (7,)], "user_id long")
    idx = RT.index_users(items)
    enc = RT.encode_users(items, idx)
    dec = RT.decode_users(enc.select("user_id_encoded").distinct(), idx)
    assert rows(dec, "user_id_encoded", "user_id") == [(0, 5), (1, 7)]


def test_fusion_fan_out_on_several_reviews(spark):
    rated = spark.createDataFrame([("u", "i", 3)], "user_id string, item_id string, rating int")
    sent = spark.createDataFrame([("u", "i", 0.5), ("u", "i", -0.5)],
                                 "user_id string, item_id string, vader_score double")
    assert sorted(r.ratings for r in RT.fuse_sentiment(rated, sent).collect()) == [2, 4]
    rec = spark.createDataFrame([("u", "i", True)], "user_id string, item_id string, recommend boolean")
    assert [r.ratings for r in RT.fuse_recommend(rated, rec).collect()] == [5]


@pytest.mark.parametrize("k", [1, 15])
def test_top_reviewed_is_deterministic(spark, k):
    df = spark.createDataFrame([(i % 3, D1, 2, "x") for i in range(6)],
                               "asin long, review_date date, n long, brand string")
    a = [tuple(r) for r in RV.top_reviewed(df, k).collect()]
    b = [tuple(r) for r in RV.top_reviewed(df.repartition(5), k).collect()]
    assert a == b


def test_leader_board_rounding_modes(spark):
    # average 2.125 is exact in binary: half-up gives 2.13, half-even 2.12
    reviews = spark.createDataFrame([(1, D1, 2.0), (1, D1, 2.0), (1, D1, 2.0), (1, D1, 2.5)],
                                    "asin long, review_date date, overall double")
    meta = spark.createDataFrame([(1, "b")], "asin long, brand string")
    up = RV.review_leader_board(reviews, meta).collect()[0].avg
    even = RV.review_leader_board(reviews, meta, rounding="half_even").collect()[0].avg
    assert (up, even) == (2.13, 2.12) and round(2.125, 2) == even
