"""Figures that must not grow faster than the input: bytes of text a task counts, exchanges
of the per-user and per-document steps, and shuffle files that a sweep leaves on disk."""

import math

import pytest
from pyspark.sql import functions as F

from quill.operators import index as IX
from quill.operators import recommend as RC
from quill.operators import similarity as SM
from quill.operators import text as TX
from quill.plans import catalogue as C
from quill.sources import scratch

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_bytes_of_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 300, "alpha beta " * 20, None) for i in range(600)], "id long, text string, extra string")
    assert "REPARTITION_BY_COL" in plan(TX.by_document(docs))                # a small corpus: the session's settings
    monkeypatch.setattr(TX, "DOCUMENT_TASK_BYTES", 4096)
    many = TX.by_document(docs)
    assert many.rdd.getNumPartitions() == math.ceil(600 * 220 / 4096)
    assert TX.by_document(docs, sized_by=docs.where("id < 150")).rdd.getNumPartitions() == math.ceil(300 * 220 / 4096)
    tf = TX.term_frequency(TX.tokenize(many, "id", "text"))
    assert plan(tf).count("Exchange") == 1                                   # counted where the documents were dealt
    assert {(r.term, r.tf) for r in tf.collect()} == {("alpha", 40), ("beta", 40), ("", 2)} and tf.count() == 900


def test_an_empty_corpus_and_null_texts_are_dealt(spark):
    none = spark.createDataFrame([], "id long, text string")
    assert TX.by_document(none).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, None), (1, "a")], "id long, text string")
    assert TX.by_document(nulls).count() == 3


def test_whole_residuals_deal_ratings_by_user_once(spark, monkeypatch):
    train = spark.createDataFrame([(u, i, float(u * i % 5)) for u in range(12) for i in range(9)], "user int, item int, rating float")
    model = RC.fit_implicit(train, rank=3, max_iter=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(RC.half_step_residuals(model, train))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(user#" in text and not [x for x in text.splitlines() if "hashpartitioning(user#" in x and ", i#" in x]


def test_vectors_meet_their_slots_before_the_norm(spark):
    text = plan(C.doc_vector(spark, SF)).splitlines()
    by_id = [x for x in text if "hashpartitioning(id#" in x]
    window = next(i for i, x in enumerate(text) if "Window" in x)
    assert by_id and any("slot#" in x for x in text[window:window + 12])


def test_a_sweep_checkpoints_every_iteration_and_releases_files(spark, monkeypatch):
    triples = spark.createDataFrame([(u, i, 1.0) for u in range(8) for i in range(6)], "user int, item int, rating float")
    asked, entered, fit = [], [], RC.fit_implicit
    monkeypatch.setattr(RC, "fit_implicit", lambda train, **kw: asked.append(kw["checkpoint_interval"]) or fit(train, **kw))
    real = scratch.files_released
    monkeypatch.setattr(RC, "files_released", lambda s: entered.append(1) or real(s, every=0.2))
    errors, _ = RC.rank_sweep(triples, (2, 3), max_iter=2)
    assert asked == [1, 1] and entered == [1] and errors.count() == 2


def test_a_sweep_keeps_one_model_at_most(spark):
    import time
    triples = spark.createDataFrame([(u, i, 1.0) for u in range(8) for i in range(6)], "user int, item int, rating float")
    kept = spark.sparkContext._jsc.getPersistentRDDs
    before = set(kept().keySet())
    errors, recs = RC.rank_sweep(triples, (2, 3), users=spark.range(2), n=2, max_iter=2)
    assert errors.count() == 2
    assert {(r["rank"], r["user"], r["pos"]) for r in recs.collect()} == {(k, u, p) for k in (2, 3) for u in (0, 1) for p in (1, 2)}
    for _ in range(50):                                                      # the cleaner runs beside the job
        left = set(kept().keySet()) - before
        if len(left) <= 2:                                                   # user and item factors of the last fit
            break
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    assert len(left) <= 2


def test_buckets_follow_the_postings(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{i % 7} w{j}" for j in range(5))) for i in range(40)], "id long, text string")
    few = IX.build_index(docs, hot=10)
    monkeypatch.setattr(IX, "BUCKET_ROWS", 20)
    built = IX.build_index(docs, hot=10)
    rows = built.table("postings").count()
    assert few.buckets == 8 and built.buckets == math.ceil(rows / 20) > 8
    key = ["id", "term", "tf", "df", "w"]
    assert sorted(map(tuple, built.reweighted().select(key).collect())) == sorted(map(tuple, few.reweighted().select(key).collect()))
    assert built.table("terms").groupBy("term").count().where("count > 1").count() == 5      # w0-w4 are in more than ten documents
    assert IX.build_index(docs, buckets=3).buckets == 3


@pytest.mark.parametrize("broken", [False, True])
def test_released_files_stop_collecting(spark, broken):
    import threading
    before = threading.active_count()
    try:
        with scratch.files_released(spark, every=0.05):
            assert spark.range(5).agg(F.sum("id")).first()[0] == 10
            if broken:
                raise ValueError("stop")
    except ValueError:
        assert broken
    assert threading.active_count() <= before


def grid_sides(spark):
    left = [(i if i else None, f"w{j}", float(i % 5 + j)) for i in range(30) for j in range(i % 7)] + [(3, None, 1.0), (3, "w0", 2.0)]
    right = [(f"t{i}", f"w{j}", float(j - 1) if i % 4 else None) for i in range(25) for j in range(i % 9)] + [("t5", "w0", 2.0), ("t5", None, 1.0)]
    return spark.createDataFrame(left, "id long, term string, w double"), spark.createDataFrame(right, "id string, term string, w double")


@pytest.mark.parametrize("blocks", [(1, 1), (3, 4), (7, 1)])
def test_pairs_in_cells_are_those_that_meet_by_term(spark, blocks):
    left, right = grid_sides(spark)
    key = lambda r: (str(r.id_1), r.id_2)                                    # noqa: E731
    want = sorted(SM.dot_products(left, right).collect(), key=key)
    got = SM.dot_products(left, right, blocks=blocks)
    assert plan(got).count("Exchange") == 1                                  # products are not shuffled
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in want] and len(want) > 100
    assert got.rdd.getNumPartitions() == blocks[0] * blocks[1]


def test_cells_follow_the_products(spark, monkeypatch):
    left, right = grid_sides(spark)
    assert SM.pair_blocks(left, right) is None                               # a few tasks' worth: the session's settings
    monkeypatch.setattr(SM, "PAIR_TASK_ROWS", 10)
    l, r = (SM._side(v, "id", "term", "w", x) for v, x in ((left, "l"), (right, "r")))
    products = l.join(r, "_term").count()
    a, b = SM.pair_blocks(left, right)
    assert products / 10 <= a * b <= 2 * products / 10
    assert SM.pair_blocks(left.where("false"), right) is None


def test_counts_meet_their_terms_in_bounded_tasks(spark, monkeypatch):
    tf = scratch.written(spark.createDataFrame([(i, t, i % 3 + 1) for i in range(200) for t in ("all", f"w{i % 20}", f"own{i}")], "id long, term string, tf long"))
    df = scratch.written(TX.document_frequency(tf))
    n = F.lit(400)
    want = sorted(map(tuple, TX.tfidf(tf, df, n).select("id", "term", "tf", "df", "w").collect()))
    assert TX.deal_by_term(tf, df).tasks is None                             # a few tasks' worth: the session's settings
    monkeypatch.setattr(TX, "COUNT_TASK_ROWS", 40)
    deal = TX.deal_by_term(tf, df)
    assert deal.tasks == 600 / 40 and deal.counts(tf).where("term = 'all'").select("_salt").distinct().count() == 20
    weights = TX.tfidf(deal.counts(tf), deal.terms(df), n, deal.on)
    assert sorted(map(tuple, weights.select("id", "term", "tf", "df", "w").collect())) == want
    sizes = deal.counts(tf).rdd.glom().map(len).collect()
    assert len(sizes) == 15 and max(sizes) <= 3 * 40                         # the hot term alone has 200 rows
    assert deal.by_id(weights).rdd.getNumPartitions() == 15
    queries = spark.createDataFrame([(1, "all", 2), (1, "no", 1), (None, "w3", 1)], "id long, term string, tf long")
    rows = [sorted(map(str, q.select("id", "term", "tf", "df", "w").collect()))
            for q in (TX.query_tfidf(queries, df, n), TX.query_tfidf(deal.counts(queries), deal.terms(df), n, deal.on))]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_dealt_text_queries_keep_their_rows(spark, monkeypatch):
    names = ("tfidf", "tfidf_norm", "doc_vector", "title_match_scores", "title_match_top1")
    run = lambda: [sorted(map(str, C.QUERIES[x](spark, SF).collect())) for x in names]               # noqa: E731
    want = run()
    monkeypatch.setattr(TX, "COUNT_TASK_ROWS", 2000)
    monkeypatch.setattr(SM, "PAIR_TASK_ROWS", 10)
    assert run() == want


def test_ratings_and_what_they_are_fused_with_read_the_lines_once(spark, monkeypatch):
    made, lines = [], C.FX.order_lines
    monkeypatch.setattr(C.FX, "order_lines", lambda s, d: made.append(d) or lines(s, d))
    for name in ("fuse_recommend", "fuse_sentiment"):
        made.clear()
        fused = C.QUERIES[name](spark, SF)
        assert made == [SF] and fused.count() >= spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert sorted(C.FX.user_reviews(spark, SF).collect()) == sorted(C.FX.user_reviews(spark, SF, lines(spark, SF)).collect())
