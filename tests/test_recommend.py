"""ALS recommender: rows-only checks on the sf0.001 ratings."""

import math

import pytest
from pyspark.sql import functions as F

from quill.operators import recommend as RC
from quill.plans import catalogue as C
from quill.plans import fixtures as FX

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def triples(spark):
    return C.als_input(spark, SF)[0]


def test_hash_split_is_partitioning_independent(spark, triples):
    a_train, a_test = RC.hash_split(triples)
    b_train, _ = RC.hash_split(triples.repartition(7))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(a_train) == key(b_train)
    n, n_train, n_test = triples.count(), a_train.count(), a_test.count()
    assert n_train + n_test == n
    assert 0.7 < n_train / n < 0.9


def test_ratings_fixture_split_count(spark):
    t = RC.as_triples(FX.ratings(spark, SF), "user_idx", "item_id", "rating")
    train, test = RC.hash_split(t)
    assert train.count() + test.count() == t.count()


def test_fit_predict_top_n_and_rmse(spark, triples):
    train, test = RC.hash_split(triples)
    model = RC.fit_implicit(train, rank=4, max_iter=5)
    pred = RC.predict(model, test)
    seen_users = {r.user for r in train.select("user").distinct().collect()}
    seen_items = {r.item for r in train.select("item").distinct().collect()}
    got = pred.collect()
    assert all(r.user in seen_users and r.item in seen_items for r in got)   # cold rows dropped
    assert all(math.isfinite(r.prediction) for r in got)
    err = RC.rmse(pred).collect()[0].rmse
    assert math.isfinite(err) and err > 0
    users = spark.range(3).select(F.col("id").cast("int").alias("user"))
    recs = RC.top_n(model, users, 10, rank=4).collect()
    by_user = {}
    for r in recs:
        by_user.setdefault(r.user, []).append((r.pos, r.score))
    for u, lst in by_user.items():
        lst.sort()
        assert [p for p, _ in lst] == list(range(1, 11))
        scores = [s for _, s in lst]
        assert scores == sorted(scores, reverse=True)


def test_rank_sweep_shape(spark, triples):
    errors, recs = RC.rank_sweep(triples, ranks=(2, 3), users=spark.range(2).select(
        F.col("id").cast("int").alias("user")), max_iter=3)
    e = sorted((r["rank"], r.rmse) for r in errors.collect())
    assert [k for k, _ in e] == [2, 3] and all(math.isfinite(v) for _, v in e)
    assert {r["rank"] for r in recs.collect()} == {2, 3}


def test_split_share(spark):
    """About eight tenths of the 59,391 ratings at sf0.01 go to training, the same
    ones whatever the id type (the oracle test compares them row by row)."""
    t = RC.as_triples(FX.ratings(spark, "/root/testdata/sf0.01"), "user_idx", "item_id", "rating")
    train, test = RC.hash_split(t)
    n = train.count()
    assert n + test.count() == t.count() == 59391 and abs(n / 59391 - 0.8) < 0.01
    wide = t.withColumn("user", F.col("user").cast("long"))
    assert RC.hash_split(wide)[0].count() == n


def test_all_sources(spark):
    for source in C.RATING_SOURCES:
        triples, items = C.als_input(spark, SF, source)
        assert triples.count() > 0 and items.count() > 0


def test_index_ids_dense_and_ordered(spark):
    df = spark.createDataFrame([(5_000_000_000,), (7,), (7,), (42,), (None,)], "item_id long")
    got = sorted((r.item_id, r.item) for r in RC.index_ids(df, "item_id", "item").collect())
    assert got == [(7, 0), (42, 1), (5_000_000_000, 2)]
