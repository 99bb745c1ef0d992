"""End to end from files in the original input formats: papers and reviews as
JSON lines, metadata and user records as Python-literal lines, sentiments as
CSV, a stop-word file; every step is a quill operator."""

import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.operators import ratings as RT
from quill.operators import reviews as RV
from quill.operators import similarity as SM
from quill.operators import text as TX
from quill.sources import files as IO

from test_text import py_tokens

PAPERS = [
    {"id": "p1", "title": "Sparse cosine joins", "abstract": "We join sparse vectors on terms; cosine follows.",
     "categories": "cs.DB"},
    {"id": "p2", "title": "Median play time", "abstract": "Play time against the median gives a rating.",
     "categories": "cs.IR"},
    {"id": "p3", "title": "Review leader boards", "abstract": "Daily review counts, ranked, with brands.",
     "categories": "cs.DB"},
]


def test_title_matching_from_files(spark, tmp_path):
    papers = tmp_path / "papers.jsonl"
    papers.write_text("\n".join(json.dumps(p) for p in PAPERS) + "\n")
    stop = tmp_path / "stop.txt"
    stop.write_text("the\nwe\non\n")
    docs = IO.read_json_lines(spark, str(papers), "id STRING, title STRING, abstract STRING, categories STRING")
    stop_df = IO.read_stop_words(spark, str(stop))
    body = TX.tfidf_index(docs, "id", "abstract", stop=stop_df)
    title = TX.query_index(docs, docs, "id", "title", "abstract", stop=stop_df)
    best = SM.best_match_bounded(body, title, out=("abstract_id", "title_id"))
    keys = docs.select(F.col("id").alias("abstract_id"))
    top = SM.match_indicator(keys.join(best, "abstract_id", "left"), "abstract_id", "best")
    acc = SM.match_accuracy(top, TX.corpus_size(docs)).collect()[0]
    assert acc.value == pytest.approx(100.0)      # each title shares its own rare words
    # category vectors of raw counts, cosine matrix, wide form
    tf = TX.term_frequency(TX.remove_stop_words(TX.tokenize(docs, "id", "abstract"), stop_df))
    m = SM.similarity_matrix(SM.group_term_vectors(tf, docs, "id", "categories"), "categories")
    wide = {r.category_1: r for r in SM.pivot_matrix(m, ["cs.DB", "cs.IR"]).collect()}
    assert wide["cs.DB"]["cs.DB"] == pytest.approx(1.0)
    assert wide["cs.DB"]["cs.IR"] == pytest.approx(wide["cs.IR"]["cs.DB"])


def test_leader_board_from_json_and_literals(spark, tmp_path):
    reviews = tmp_path / "reviews.jsonl"
    rows = [("A", "01 1, 2020", 5.0), ("A", "01 1, 2020", 3.0), ("B", "01 2, 2020", 4.0),
            ("C", "01 2, 2020", 2.0), ("C", "01 2, 2020", 2.0), ("C", "01 2, 2020", 5.0)]
    reviews.write_text("\n".join(json.dumps({"asin": a, "reviewTime": t, "overall": o, "x": 1})
                                 for a, t, o in rows) + "\n")
    meta = tmp_path / "meta.txt"
    meta.write_text("{'asin': 'A', 'brand': u'Caf\\xe9'}\n{'asin': 'B'}\n{'asin': 'C', 'brand': ''}\n")
    r = IO.read_json_lines(spark, str(reviews), "asin STRING, reviewTime STRING, overall DOUBLE")
    m = IO.read_python_literals(spark, str(meta), T.StructType([T.StructField("asin", T.StringType()),
                                                                T.StructField("brand", T.StringType())]))
    top = RV.review_leader_board(r, m, k=15, day="reviewTime").collect()
    assert [(x.asin, x.n, x.avg, x.brand) for x in top] == [("C", 3, 3.0, ""), ("A", 2, 4.0, "Café")]


USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("items_count", T.IntegerType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()),
        T.StructField("playtime_forever", T.DoubleType())]))),
])
REVIEWS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("reviews", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()),
        T.StructField("recommend", T.BooleanType())]))),
])


def test_rating_fusion_from_literals_and_csv(spark, tmp_path):
    users = tmp_path / "users.txt"
    users.write_text(
        "{'user_id': 'u1', 'items_count': 2, 'items': [{'item_id': '10', 'playtime_forever': 100}, "
        "{'item_id': '20', 'playtime_forever': 5}]}\n"
        "{'user_id': 'u2', 'items_count': 2, 'items': [{'item_id': '10', 'playtime_forever': 90}, "
        "{'item_id': '20', 'playtime_forever': 10}]}\n"
        "{'user_id': 'u3', 'items_count': 1, 'items': [{'item_id': '10', 'playtime_forever': 10}]}\n")
    sentiments = tmp_path / "sentiments.csv"
    sentiments.write_text("_c0,user_id,item_id,review,textblob_score,sentiment_class,vader_score\n"
                          '0,u1,10,"great, really",0.5,pos,0.8\n1,u2,10,meh,0.0,neu,0.0\n')
    reviews = tmp_path / "reviews.txt"
    reviews.write_text("{'user_id': 'u1', 'reviews': [{'item_id': '20', 'recommend': True}]}\n"
                       "{'user_id': 'u2', 'reviews': [{'item_id': '10', 'recommend': False}]}\n")
    items = RT.explode_items(IO.read_python_literals(spark, str(users), USERS))
    rated = RT.playtime_rating(items)
    med = {r.item_id: r.median for r in rated.select("item_id", "median").distinct().collect()}
    assert med == {"10": 90.0, "20": 5.0}
    # u1/10: 100 > 90 -> 5; u2/10: 90 = median -> 1; u3/10: 10 < 0.2*90 -> 1;
    # u1/20: 5 = median -> 1; u2/20: 10 > 5 -> 5
    tiers = {(r.user_id, r.item_id): r.rating for r in rated.collect()}
    assert tiers == {("u1", "10"): 5, ("u2", "10"): 1, ("u3", "10"): 1, ("u1", "20"): 1, ("u2", "20"): 5}
    index = RT.index_users(items)
    assert {r.user_id: r.user_id_encoded for r in index.collect()} == {"u1": 0, "u2": 1, "u3": 2}
    enc = RT.encode_users(rated.select("user_id", "item_id", "rating"), index)
    sent = IO.read_csv_typed(spark, str(sentiments), "_c0 INT, user_id STRING, item_id STRING, review STRING, "
                             "textblob_score DOUBLE, sentiment_class STRING, vader_score DOUBLE")
    fused = {(r.user_id, r.item_id): r.ratings for r in RT.fuse_sentiment(enc, sent).collect()}
    # u1/10 positive keeps 5; u2/10 neutral keeps 1; the rest have no review (negative):
    # 5 -> 4, 1 -> 1
    assert fused == {("u1", "10"): 5, ("u2", "10"): 1, ("u3", "10"): 1, ("u1", "20"): 1, ("u2", "20"): 4}
    flags = RT.explode_items(IO.read_python_literals(spark, str(reviews), REVIEWS), items_col="reviews",
                             fields=("item_id", "recommend"))
    rec = {(r.user_id, r.item_id): r.ratings for r in RT.fuse_recommend(enc, flags).collect()}
    # u1/20 recommended: 1 -> 3; u2/10 not recommended: 1 stays 1; others unchanged
    assert rec == {("u1", "10"): 5, ("u2", "10"): 1, ("u3", "10"): 1, ("u1", "20"): 3, ("u2", "20"): 5}


def test_rows_count_in_n_and_ids_in_df(spark):
    """N counts rows (a repeated id counts twice); df counts distinct ids."""
    docs = spark.createDataFrame([(1, "x y"), (1, "x"), (2, "y")], "id long, text string")
    w = {(r.id, r.term): r for r in TX.tfidf_index(docs, "id", "text").collect()}
    assert w[(1, "x")].tf == 2 and w[(1, "x")].df == 1
    assert w[(1, "x")].w == pytest.approx((1 + math.log10(2)) * math.log10(3 / 1))


def test_empty_token_weighs_in_raw_counts(spark):
    """The empty token from leading punctuation is a term: weight ~0 in TF-IDF
    (it is in most documents) but a full count in category vectors."""
    docs = spark.createDataFrame([(1, ".a", "c1"), (2, ".b", "c2"), (3, "c", "c2")],
                                 "id long, text string, cat string")
    tf = TX.term_frequency(TX.tokenize(docs, "id", "text"))
    vec = {(r.cat, r.term): r.tf for r in SM.group_term_vectors(tf, docs, "id", "cat").collect()}
    assert vec[("c1", "")] == 1 and vec[("c2", "")] == 1
    m = {(r.category_1, r.category_2): r.value for r in SM.similarity_matrix(
        SM.group_term_vectors(tf, docs, "id", "cat"), "cat").collect()}
    assert m[("c1", "c2")] > 0                       # linked only through ''


TEXT = st.text(alphabet=st.sampled_from(list("aZé_9²ß ,.!-'\tÆñ中文日本")), max_size=40)


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=5))
def test_tokenizer_property_matches_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = sorted((r.id, r.term) for r in TX.tokenize(df, "id", "text").collect())
    want = sorted((i, t) for i, x in enumerate(texts) for t in py_tokens(x))
    assert got == want


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=6), stop=st.sets(st.sampled_from(["a", "", "é", "9"])))
def test_tf_sums_to_kept_tokens(spark, texts, stop):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tf = TX.term_frequency(TX.remove_stop_words(TX.tokenize(df, "id", "text"), sorted(stop)))
    total = tf.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("s")).collect()[0].s
    assert total == sum(1 for x in texts for t in py_tokens(x) if t not in stop)
