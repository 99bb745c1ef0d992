"""Command-line jobs over user files: the five batch analyses end to end.

    python -m quill.jobs review-board REVIEWS META OUT [--k 15]
    python -m quill.jobs title-match PAPERS STOPWORDS OUT
    python -m quill.jobs category-matrix PAPERS STOPWORDS OUT
    python -m quill.jobs ratings USERS_ITEMS SENTIMENTS USER_REVIEWS OUT
    python -m quill.jobs recommend RATINGS_DIR OUT [--source recommend] [--ranks 10,20,...] [--at-once 6]

On a cluster: ``spark-submit --py-files quill.zip quill/jobs.py <job> ...``. Inputs: reviews and papers are JSON lines;
product metadata, user items and user reviews are Python-literal lines;
sentiments are CSV with a header; stop words are one per line. Outputs are
written under OUT as CSV with a header. The session comes from the launcher
(``getOrCreate``), and ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.operators import index as IX
from quill.operators import ratings as RT
from quill.operators import recommend as RC
from quill.operators import reviews as RV
from quill.operators import similarity as SM
from quill.operators import text as TX
from quill.sources import files as IO
from quill.sources.scratch import written

PAPERS = "id STRING, title STRING, abstract STRING, categories STRING"
REVIEWS = "asin STRING, reviewTime STRING, overall DOUBLE"
META = T.StructType([T.StructField("asin", T.StringType()), T.StructField("brand", T.StringType())])
USERS_ITEMS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("items_count", T.IntegerType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("playtime_forever", T.DoubleType()),
        T.StructField("playtime_2weeks", T.DoubleType())]))),
])
USER_REVIEWS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("reviews", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()),
        T.StructField("recommend", T.BooleanType())]))),
])
# the sentiment file is read by header name: only these columns are used
SENTIMENTS = {"user_id": "string", "item_id": "string", "vader_score": "double"}
FUSED = "user_id STRING, item_id STRING, rating INT, user_id_encoded INT, ratings INT"


def _out(df: DataFrame, out: str, name: str, single_file: bool = False, **kw) -> str:
    path = os.path.join(out, name)
    IO.write_result(df, path, fmt="csv", header=True, single_file=single_file, **kw)
    return path


def review_board(spark: SparkSession, reviews: str, meta: str, out: str, k: int = 15) -> str:
    r = IO.read_json_lines(spark, reviews, REVIEWS)
    m = IO.read_python_literals(spark, meta, META)
    top = RV.review_leader_board(r, m, k=k, day="reviewTime", rounding="half_even")
    # a window over the k result rows only (bounded by k)
    order = Window.orderBy(F.col("n").desc(), "asin", "reviewTime", "brand")
    return _out(top.withColumn("pos", F.row_number().over(order)), out, "top_reviews", single_file=True)


def _papers(spark, papers, stopwords):
    return IO.read_json_lines(spark, papers, PAPERS), IO.read_stop_words(spark, stopwords)


def title_match(spark: SparkSession, papers: str, stopwords: str, out: str) -> str:
    docs, stop = _papers(spark, papers, stopwords)
    # abstracts are tokenised once: titles are weighted against the index's terms
    index = IX.build_index(docs, "id", "abstract", stop)
    tokens = TX.tokenize(TX.by_document(docs), "id", "title")
    title = index.query_side(TX.term_frequency(TX.remove_stop_words(tokens, stop)))
    body, title = (written(v.select("id", "term", "w_norm")) for v in (index.normalized(), title))
    index.drop()
    best = SM.best_match_bounded(body, title, out=("abstract_id", "title_id"))
    keys = docs.select(F.col("id").alias("abstract_id"))
    top = SM.match_indicator(keys.join(best, "abstract_id", "left"), "abstract_id", "best")
    _out(top.select("abstract_id", F.col("best").alias("best_title_id"), "cos", "match"), out, "best_titles")
    return _out(SM.match_accuracy(top, TX.corpus_size(docs)), out, "accuracy", single_file=True)


def category_matrix(spark: SparkSession, papers: str, stopwords: str, out: str) -> str:
    docs, stop = _papers(spark, papers, stopwords)
    tf = TX.term_frequency(TX.remove_stop_words(TX.tokenize(TX.by_document(docs), "id", "abstract"), stop))
    pairs = SM.similarity_matrix(SM.group_term_vectors(tf, docs, "id", "categories"), "categories")
    return _out(pairs, out, "category_pairs")


def ratings(spark: SparkSession, users_items: str, sentiments: str, user_reviews: str, out: str) -> str:
    # the literal files are parsed once: median, index and all outputs read the copy
    items = written(RT.explode_items(IO.read_python_literals(spark, users_items, USERS_ITEMS)))
    rated = RT.playtime_rating(items).select("user_id", "item_id", "rating")
    encoded = RT.encode_users(rated, RT.index_users(items))
    _out(encoded.select("item_id", "user_id", "rating", "user_id_encoded"), out, "encoded_ratings")
    sent = IO.read_csv_columns(spark, sentiments, SENTIMENTS)
    fused_s = RT.fuse_sentiment(encoded, sent).select("user_id", "item_id", "rating", "user_id_encoded",
                                                      "ratings")
    _out(fused_s, out, "sentiment_ratings")
    flags = RT.explode_items(IO.read_python_literals(spark, user_reviews, USER_REVIEWS),
                             items_col="reviews", fields=("item_id", "recommend"))
    fused_r = RT.fuse_recommend(encoded, flags).select("user_id", "item_id", "rating", "user_id_encoded",
                                                      "ratings")
    return _out(fused_r, out, "recommend_ratings")


def recommend(spark: SparkSession, ratings_dir: str, out: str, source: str = "recommend",
              ranks: tuple[int, ...] = RC.DEFAULT_RANKS, users: int = 8, n: int = RC.TOP_N, at_once: int = 1) -> str:
    name = {"implicit": "encoded_ratings", "sentiment": "sentiment_ratings",
            "recommend": "recommend_ratings"}[source]
    path = os.path.join(ratings_dir, name)
    if source == "implicit":
        df = IO.read_csv_typed(spark, path, "item_id STRING, user_id STRING, rating INT, user_id_encoded INT")
        value = "rating"
    else:
        df = IO.read_csv_typed(spark, path, FUSED)
        value = "ratings"
    item_index = RC.index_ids(df, "item_id", "item")
    triples = RC.as_triples(df.join(item_index, "item_id"), "user_id_encoded", "item", value)
    who = spark.range(users).select(F.col("id").cast("int").alias("user"))
    errors, recs = RC.rank_sweep(triples, ranks, users=who, n=n, at_once=at_once)
    recs = recs.join(item_index, "item").select("rank", "user", "pos", "item_id", "score")
    # a rank that is run again replaces its lists only
    IO.write_partitions(recs, os.path.join(out, "top_recommendations"), ["rank"], "csv")
    return _out(errors, out, "rank_rmse", single_file=True)


def main(argv=None):
    p = argparse.ArgumentParser(prog="quill.jobs")
    p.add_argument("--checkpoint-dir", help="shared folder for checkpoints, used when the session "
                   "has no spark.checkpoint.dir")
    sub = p.add_subparsers(dest="job", required=True)
    positional = {
        "review-board": ("reviews", "meta", "out"),
        "title-match": ("papers", "stopwords", "out"),
        "category-matrix": ("papers", "stopwords", "out"),
        "ratings": ("users_items", "sentiments", "user_reviews", "out"),
        "recommend": ("ratings_dir", "out"),
    }
    parsers = {}
    for job, names in positional.items():
        parsers[job] = sub.add_parser(job)
        for name in names:
            parsers[job].add_argument(name)
    parsers["review-board"].add_argument("--k", type=int, default=15)
    d = parsers["recommend"]
    d.add_argument("--source", default="recommend", choices=("implicit", "sentiment", "recommend"))
    d.add_argument("--at-once", type=int, default=1, help="models fitted at the same time")
    d.add_argument("--ranks", default=",".join(str(r) for r in RC.DEFAULT_RANKS))
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"quill-{args.job}").getOrCreate()
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None) or args.checkpoint_dir
        if configured:
            sc.setCheckpointDir(configured)
    if args.job == "review-board":
        review_board(spark, args.reviews, args.meta, args.out, args.k)
    elif args.job == "title-match":
        title_match(spark, args.papers, args.stopwords, args.out)
    elif args.job == "category-matrix":
        category_matrix(spark, args.papers, args.stopwords, args.out)
    elif args.job == "ratings":
        ratings(spark, args.users_items, args.sentiments, args.user_reviews, args.out)
    else:
        recommend(spark, args.ratings_dir, args.out, args.source,
                  tuple(int(r) for r in args.ranks.split(",")), at_once=args.at_once)


if __name__ == "__main__":
    main()
