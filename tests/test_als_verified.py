"""ALS results against numpy: last half-step, predictions, errors, top lists, a fit of
our own from scratch, and the sweep of several ranks at a time."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quill.operators import recommend as RC
from quill.plans import catalogue as C

SF = "/root/testdata/sf0.001"
ALPHA, REG, RANK = 0.5, 0.05, 3


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(4)
    taste, kind = rng.normal(size=(40, 2)), rng.normal(size=(25, 2))
    rows = [(u, i, float(max(-1, round(2 + taste[u] @ kind[i])))) for u in range(40) for i in range(25) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "user int, item int, rating float").persist()


@pytest.fixture(scope="module")
def model(ratings):
    return RC.fit_implicit(ratings, rank=RANK, max_iter=25, alpha=ALPHA, reg_param=REG)


def factors(df):
    return {r.id: np.array(r.features, float) for r in df.collect()}


def solve(rows, y, rank=RANK):
    """One half-step: the factors of every left id for fixed right ones."""
    gram = sum(np.outer(v, v) for v in y.values())
    out = {}
    for u in {r[0] for r in rows}:
        a, b, n = gram.copy(), np.zeros(rank), 0
        for _, i, r in (x for x in rows if x[0] == u):
            c = ALPHA * abs(r)
            if r:
                a += c * np.outer(y[i], y[i])
            if r > 0:
                b += (1 + c) * y[i]
                n += 1
        out[u] = np.linalg.solve(a + REG * n * np.eye(rank), b) if n else np.zeros(rank)
    return out


def loss(rows, x, y):
    """What implicit ALS minimises, over all pairs."""
    conf, pref = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
    xs, ys = sorted(x), sorted(y)
    for u, i, r in rows:
        conf[xs.index(u), ys.index(i)], pref[xs.index(u), ys.index(i)] = ALPHA * abs(r), r > 0
    p = np.stack([x[u] for u in xs]) @ np.stack([y[i] for i in ys]).T
    n_u, n_i = pref.sum(1), pref.sum(0)
    return (((1 + conf) * (pref - p) ** 2).sum() + REG * sum(n * (x[u] @ x[u]) for n, u in zip(n_u, xs))
            + REG * sum(n * (y[i] @ y[i]) for n, i in zip(n_i, ys)))


def test_last_half_step_is_the_least_squares_solution(ratings, model):
    rows = [tuple(r) for r in ratings.collect()]
    x, y = factors(model.userFactors), factors(model.itemFactors)
    want = solve(rows, y)
    assert x.keys() == want.keys() and all(np.allclose(x[u], want[u], atol=2e-4) for u in x)
    gram = {(r.i, r.j): r.g for r in RC.gram_matrix(model.itemFactors).collect()}
    full = sum(np.outer(v, v) for v in y.values())
    assert all(abs(full[k] - g) < 1e-9 for k, g in gram.items()) and len(gram) == RANK * (RANK + 1) // 2
    got = RC.half_step_residuals(model, ratings, ALPHA, REG).collect()
    gram = sum(np.outer(v, v) for v in y.values())
    for r in got:
        own = [(i, v) for u, i, v in rows if u == r.user and v]
        a = gram + sum(ALPHA * abs(v) * np.outer(y[i], y[i]) for i, v in own)
        n = sum(v > 0 for _, v in own)
        b = sum((1 + ALPHA * abs(v)) * y[i] for i, v in own if v > 0)
        assert r.n == n and abs(r.residual - np.linalg.norm((a + REG * n * np.eye(RANK)) @ x[r.user] - b) / np.linalg.norm(b)) < 1e-9
        assert r.residual < 1e-4


def test_residual_shows_factors_that_do_not_belong(spark, ratings, model):
    class Other:
        userFactors = model.userFactors.withColumn("features", F.transform("features", lambda v: v * 1.1))
        itemFactors = model.itemFactors
    assert min(r.residual for r in RC.half_step_residuals(Other, ratings, ALPHA, REG).collect()) > 0.01
    blocks = RC.residuals_by_block(RC.half_step_residuals(model, ratings, ALPHA, REG), 7).collect()
    assert sorted(r.block for r in blocks) == list(range(7)) and sum(r.n_users for r in blocks) == 40
    assert all(0 <= r["mean"] <= r.worst < 1e-4 for r in blocks)


def test_as_good_as_a_fit_from_scratch(ratings, model):
    rows = [tuple(r) for r in ratings.collect()]
    turned = [(i, u, r) for u, i, r in rows]
    best = math.inf
    for seed in range(3):
        rng = np.random.default_rng(seed)
        y = {i: rng.normal(size=RANK) / RANK ** 0.5 for i in range(25)}
        for _ in range(40):
            x = solve(rows, y)
            y = solve(turned, x)
        best = min(best, loss(rows, solve(rows, y), y))
    assert loss(rows, factors(model.userFactors), factors(model.itemFactors)) < 1.02 * best


def test_predictions_error_and_top_lists(spark, ratings, model):
    x, y = factors(model.userFactors), factors(model.itemFactors)
    pred = RC.predict(model, ratings).collect()
    assert len(pred) == ratings.count()
    assert all(abs(r.prediction - x[r.user] @ y[r.item]) < 1e-5 for r in pred)
    err = RC.rmse(RC.predict(model, ratings)).first()
    assert err.n_test == len(pred)
    assert abs(err.rmse - math.sqrt(np.mean([(r.rating - r.prediction) ** 2 for r in pred]))) < 1e-6
    users = spark.range(5).select(F.col("id").cast("int").alias("user"))
    for r in RC.top_n(model, users, 6).collect():
        scores = sorted(((float(x[r.user] @ v), i) for i, v in y.items()), reverse=True)
        assert abs(scores[r.pos - 1][0] - r.score) < 1e-5 and abs(x[r.user] @ y[r.item] - r.score) < 1e-5


def test_sweep_at_once_equals_one_after_another(spark):
    triples, _ = C.als_input(spark, SF)
    ranks = (2, 3, 4, 5, 6, 7)
    spans, plain = {}, RC.fit_implicit

    def timed(train, rank, **kw):
        begin = time.time()
        out = plain(train, rank=rank, **kw)
        spans[rank] = (begin, time.time())
        return out

    RC.fit_implicit = timed
    try:
        together = RC.sweep_fits(triples, ranks, at_once=6, max_iter=3)
        assert sum(a < d and c < b for a, b in spans.values() for c, d in spans.values()) > len(ranks)   # fits overlap
    finally:
        RC.fit_implicit = plain
    alone = RC.sweep_fits(triples, ranks, max_iter=3)
    assert [(f.rank, f.n_test) for f in together] == [(f.rank, f.n_test) for f in alone] == [(k, alone[0].n_test) for k in ranks]
    assert all(abs(p.rmse - q.rmse) < 1e-5 for p, q in zip(together, alone))
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_queries_return_items_scores_and_errors(spark):
    recs = C.als_topn(spark, SF).collect()
    items = {r.p_partkey for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    assert {r["rank"] for r in recs} == {10, 20, 30, 40, 50, 60} and all(r.item_id in items and math.isfinite(r.score) for r in recs)
    pred = C.als_predict(spark, SF).collect()
    err = C.als_rmse(spark, SF).first()
    assert err.n_test == len(pred)
    assert abs(err.rmse - math.sqrt(np.mean([(r.rating - r.prediction) ** 2 for r in pred]))) < 1e-4
    for query in (C.als_predict_sentiment, C.als_predict_implicit):
        own = query(spark, SF).collect()
        assert own and all(math.isfinite(r.prediction) for r in own)
