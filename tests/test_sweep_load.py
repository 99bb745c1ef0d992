"""What a sweep of ranks asks of the cluster: fits at a time, their order, and work done once for all."""

import contextlib
import threading

import pytest

from quill.operators import recommend as RC
from quill.plans import catalogue as C

SF = "/root/testdata/sf0.001"


def _watched(monkeypatch, **short):
    """Ranks in the order in which they begin, the most fits at a time, and the plans of what they train on."""
    seen = {"order": [], "most": 0, "now": 0, "plans": []}
    lock, plain = threading.Lock(), RC.fit_implicit

    def fit(train, rank, **kw):
        with lock:
            seen["order"].append(rank)
            seen["plans"].append(train._jdf.queryExecution().toString())
            seen["now"] += 1
            seen["most"] = max(seen["most"], seen["now"])
        try:
            return plain(train, rank=rank, **kw | short)
        finally:
            with lock:
                seen["now"] -= 1

    monkeypatch.setattr(RC, "fit_implicit", fit)
    return seen


@pytest.mark.parametrize("query", ["als_rank_sweep_facts", "als_topn_facts"])
def test_queries_fit_two_ranks_at_a_time_largest_first(spark, monkeypatch, query):
    seen = _watched(monkeypatch, max_iter=1)
    got = C.QUERIES[query](spark, SF).collect()
    assert seen["most"] == C.ALS_AT_ONCE == 2
    assert set(seen["order"][:2]) == {50, 60} and sorted(seen["order"]) == list(RC.DEFAULT_RANKS)
    assert {r["rank"] for r in got} == set(RC.DEFAULT_RANKS)


def test_fits_come_back_in_the_order_of_the_ranks(spark):
    triples = spark.createDataFrame([(u, i, 1.0) for u in range(8) for i in range(6)], "user int, item int, rating float")
    ranks = (3, 5, 2, 3)
    fits = RC.sweep_fits(triples, ranks, at_once=3, use=lambda model, rank: rank, max_iter=1)
    assert [(f.rank, f.used) for f in fits] == [(k, k) for k in ranks] and all(f.n_test == fits[0].n_test for f in fits)


def test_the_split_is_hashed_once_for_all_ranks(spark, monkeypatch):
    rows = [(u, i, float(u * i % 5)) for u in range(12) for i in range(9)] + [(3, 4, 1.0), (3, 4, 2.0)]
    triples = spark.createDataFrame(rows, "user int, item int, rating float")
    seen, tested, plain = _watched(monkeypatch, max_iter=1), [], RC.predict
    monkeypatch.setattr(RC, "predict", lambda model, test: tested.append(test) or plain(model, test))
    RC.rank_sweep(triples, (2, 3))
    assert not [p for p in seen["plans"] if "md5" in p]
    assert not [t for t in tested if "md5" in t._jdf.queryExecution().toString()]
    train, test = RC.hash_split(triples)
    assert sorted(map(tuple, tested[0].collect())) == sorted(map(tuple, test.collect()))
    assert train.count() + test.count() == len(rows)


@pytest.mark.parametrize("query", ["als_residual_facts", "als_predict_facts", "als_rmse_facts"])
def test_a_single_fit_releases_its_files_too(spark, monkeypatch, query):
    asked, inside, plain, real = [], [], RC.fit_implicit, C.files_released
    depth = []

    @contextlib.contextmanager
    def released(session):
        depth.append(1)
        with real(session, every=0.5):
            yield
        depth.pop()

    def fit(train, **kw):
        asked.append(kw.get("checkpoint_interval"))
        inside.append(len(depth))
        return plain(train, **kw)

    monkeypatch.setattr(RC, "fit_implicit", fit)
    monkeypatch.setattr(C, "files_released", released)
    assert C.QUERIES[query](spark, SF).count() > 0
    assert asked == [1] and inside == [1] and not depth
