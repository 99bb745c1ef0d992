"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over whole test tables. :mod:`quill.plans.oracle` holds the
equivalent DuckDB SQL under the same keys; computed columns carry the same
names in both, and floating results are rounded to the same places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions.text import clean_text
from quill.operators import index as IX
from quill.operators import ratings as RT
from quill.operators import recommend as RC
from quill.operators import reviews as RV
from quill.operators import similarity as SM
from quill.operators import text as TX
from quill.plans import fixtures as FX
from quill.sources import files as IO
from quill.sources import literal_source as LS
from quill.sources.scratch import drop, files_released, scratch_path, written

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6  # places for floating results compared against the oracle
ALS_USERS = 8  # recommendations for user indices 0..7
ALS_AT_ONCE = 2  # fits of a sweep at a time: one leaves cores idle, all at once fill the disks
SEARCH_EVERY = 50  # searches take the rows whose id this divides as queries


def _r(col: str, digits: int = DIGITS):
    return F.round(F.col(col), digits).alias(col)


# ---------------------------------------------------------------- sources
def src_json(spark, d):
    ev = FX.events(spark, d)
    return ev.select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"))


# Files written from a test table to the scratch folder, then read by the sources.
def _text_file(spark, lines):
    path = scratch_path(spark)
    lines.toDF("value").write.text(path)
    return path


def _good_and_bad(lenient, *columns):
    good, bad = IO.split_malformed(lenient)
    return good.select(*columns, F.lit(None).cast("string").alias("line")).unionByName(
        bad.select(*[F.lit(None).cast(good.schema[c].dataType).alias(c) for c in columns], "line"))


def malformed_json(spark, d):
    """JSON lines of events, every seventh cut short: rows, and the lines that are none."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(line, 1, 20)).otherwise(line)
    path = _text_file(spark, FX.events(spark, d).select(cut))
    return _good_and_bad(IO.read_lenient(spark, path, "event_id BIGINT, user_id BIGINT, event_type STRING"),
                         "event_id", "user_id", "event_type")


def _part_lines(spark, d, cut):
    line = F.format_string("{'key': %d, u'brand': u'%s', 'size': %s, 'new': True}", "p_partkey", "p_brand",
                           F.when(F.col("p_size") % 10 == 0, "None").otherwise(F.col("p_size").cast("string")))
    if cut:
        line = F.when(F.col("p_partkey") % 7 == 0, F.substring(line, 1, 12)).otherwise(line)
    return _text_file(spark, FX.table(spark, d, "part").select(line))


_PART = T.StructType([T.StructField("key", T.LongType()), T.StructField("brand", T.StringType()),
                      T.StructField("size", T.IntegerType())])


def malformed_literals(spark, d):
    """The same for Python-literal lines of parts."""
    return _good_and_bad(IO.read_lenient(spark, _part_lines(spark, d, True), _PART, "literals"), "key", "brand", "size")


def malformed_csv(spark, d):
    """The same for CSV lines of customers, every seventh with a word for its nation."""
    nation = F.when(F.col("c_custkey") % 7 == 0, F.lit("none")).otherwise(F.col("c_nationkey").cast("string"))
    path = _text_file(spark, FX.table(spark, d, "customer").select(F.concat_ws(",", "c_custkey", "c_mktsegment", nation)))
    return _good_and_bad(IO.read_lenient(spark, path, "custkey BIGINT, segment STRING, nation INT", "csv", header=False),
                         "custkey", "segment", "nation")


def src_literals(spark, d):
    """Python-literal lines through the registered data source, in small byte ranges."""
    reader = spark.read.format(LS.register(spark)).schema(_PART).option("splitBytes", 4096)
    return reader.load(_part_lines(spark, d, False))


def src_csv_columns(spark, d):
    """A written CSV read by header names, columns in another order."""
    path = scratch_path(spark)
    IO.write_result(FX.table(spark, d, "customer").select("c_name", "c_acctbal", "c_custkey"), path, "csv")
    return IO.read_csv_columns(spark, path, {"c_custkey": "bigint", "c_acctbal": "double"})


def src_stop_words(spark, d):
    """Documents without the words of a stop-word file."""
    path = _text_file(spark, spark.createDataFrame([(w,) for w in FX.STOP_WORDS], "value string"))
    _, toks = _doc_tokens(spark, d, stop=False, colocate=False)
    kept = TX.remove_stop_words(toks, IO.read_stop_words(spark, path))
    return kept.groupBy("id").agg(F.count(F.lit(1)).alias("n_kept"))


def sink_partitions(spark, d):
    """Daily statistics written by year, all of them twice and one year a third time: one copy."""
    path = scratch_path(spark)
    stats = RV.daily_review_stats(FX.reviews(spark, d)).withColumn("year", F.year("review_date"))
    for part in (stats, stats, stats.where("year = 1997")):
        IO.write_partitions(part, path, ["year"])
    return spark.read.parquet(path).select("asin", "review_date", "n", "year")


# ---------------------------------------------------------------- reviews
def daily_reviews(spark, d):
    return RV.daily_review_stats(FX.reviews(spark, d), digits=2)


def brand_filter(spark, d):
    return RV.brands(FX.meta(spark, d))


def daily_reviews_brand(spark, d):
    stats = RV.daily_review_stats(FX.reviews(spark, d))
    return RV.with_brand(stats, FX.meta(spark, d))


def daily_reviews_top15(spark, d):
    return RV.review_leader_board(FX.reviews(spark, d), FX.meta(spark, d), k=15)


# ---------------------------------------------------------------- text: corpus side
def _doc_tokens(spark, d, stop=True, colocate=True):
    docs = FX.documents(spark, d)
    toks = TX.tokenize(TX.by_document(docs) if colocate else docs, "id", "abstract")
    return docs, (TX.remove_stop_words(toks, FX.STOP_WORDS) if stop else toks)


def text_clean(spark, d):
    docs = FX.documents(spark, d)
    return docs.where(F.col("abstract").isNotNull()).select("id", clean_text("abstract").alias("clean"))


def tokenize(spark, d):
    _, toks = _doc_tokens(spark, d, stop=False, colocate=False)
    return toks.groupBy("id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                  F.count_if(F.col("term") == "").alias("n_empty"))


def stopword_filter(spark, d):
    _, toks = _doc_tokens(spark, d, colocate=False)
    return toks.groupBy("id").agg(F.count(F.lit(1)).alias("n_kept"))


def term_freq(spark, d):
    _, toks = _doc_tokens(spark, d)
    return TX.term_frequency(toks)


def doc_freq(spark, d):
    _, toks = _doc_tokens(spark, d, colocate=False)
    return TX.document_frequency(TX.term_frequency(toks))


def stopword_table(spark, d):
    """Stop words as a table: the terms that a fifth of the documents have."""
    docs, toks = _doc_tokens(spark, d, stop=False)
    toks = written(toks)
    df = TX.document_frequency(toks.distinct())
    words = df.where(5 * F.col("df") >= TX.corpus_size(docs)).select("term")
    return TX.remove_stop_words(toks, words).groupBy("id").agg(F.count(F.lit(1)).alias("n_kept"))


def _doc_tf(spark, d):
    """Documents, and ``(id, term, tf)`` written once: df, weights and vocabulary
    all read the copy, so the corpus is tokenised once."""
    docs, toks = _doc_tokens(spark, d)
    return docs, written(TX.term_frequency(toks))


def _doc_weights(spark, d):
    """Weights, and how their terms were dealt. Frequencies are written: the dealing reads them too."""
    docs, tf = _doc_tf(spark, d)
    df = written(TX.document_frequency(tf))
    deal = TX.deal_by_term(tf, df)
    return TX.tfidf(deal.counts(tf), deal.terms(df), TX.corpus_size(docs), deal.on), df, deal


def tfidf(spark, d):
    return _doc_weights(spark, d)[0].select("id", "term", "tf", "df", _r("w"))


def tfidf_norm(spark, d):
    weights, _, deal = _doc_weights(spark, d)
    w = TX.l2_normalize(deal.by_id(weights.select("id", "term", "w")))
    return w.select("id", "term", _r("w_norm"))


def _index(spark, d):
    return IX.build_index(FX.documents(spark, d), "id", "abstract", FX.STOP_WORDS, hot=500)


def tfidf_indexed(spark, d):
    """:func:`tfidf` from the bucketed postings, without an exchange."""
    return _index(spark, d).reweighted().select("id", "term", "tf", "df", _r("w"))


def tfidf_norm_indexed(spark, d):
    """:func:`tfidf_norm` from the bucketed weights, without an exchange."""
    return _index(spark, d).normalized().select("id", "term", _r("w_norm"))


def doc_vector(spark, d):
    weights, df, deal = _doc_weights(spark, d)
    # slots are met where the weights are, by term; only ids, slots and weights go on to the norms
    slots = TX.sparse_vectors(weights, deal.terms(TX.vocabulary_index(df)), term=deal.on, w="w")
    return TX.l2_normalize(deal.by_id(slots)).select("id", "slot", _r("w_norm"))


# ---------------------------------------------------------------- text: page titles against bodies
def _page_tf(spark, d):
    pages = FX.titled_pages(spark, d)
    by_id = TX.by_document(pages, sized_by=FX.table(spark, d, "pages").select("html"))
    body_tf = TX.term_frequency(TX.remove_stop_words(TX.tokenize(by_id, "id", "body"), FX.STOP_WORDS))
    title_tf = TX.term_frequency(TX.remove_stop_words(TX.tokenize(by_id, "id", "title"), FX.STOP_WORDS))
    return pages, body_tf, title_tf


def title_term_freq(spark, d):
    return _page_tf(spark, d)[2]


def _title_weights(spark, d):
    pages, body_tf, title_tf = _page_tf(spark, d)
    return TX.query_tfidf(title_tf, TX.document_frequency(body_tf), TX.corpus_size(pages))


def title_tfidf(spark, d):
    return _title_weights(spark, d).select("id", "term", "tf", "df", _r("w"))


def title_tfidf_norm(spark, d):
    w = TX.l2_normalize(_title_weights(spark, d), zero_norm="zero")
    return w.select("id", "term", _r("w_norm"))


def title_match_scores(spark, d):
    """Search: every ``SEARCH_EVERY``-th abstract against all titles."""
    _, body, title = _title_vectors(spark, d)
    queries = body.where(F.col("id") % SEARCH_EVERY == 0)
    scores = SM.cosine_pairs(queries, title, "id", "id", "term", "w_norm", ("abstract_id", "title_id"),
                             normalized=True, blocks=SM.pair_blocks(queries, title, term="term", w="w_norm"))
    return scores.select("abstract_id", "title_id", _r("cos"))


def _title_vectors(spark, d):
    """Body and title unit vectors. The body term counts are written once, so bodies
    are tokenised once; so are the vectors, which the match reads several times. Shuffle
    files of counts and weights are deleted before the match."""
    with files_released(spark):
        pages, body_tf, title_tf = _page_tf(spark, d)
        n = TX.corpus_size(pages)
        body_tf = written(body_tf)
        df = written(TX.document_frequency(body_tf))
        deal = TX.deal_by_term(body_tf, df)
        terms = deal.terms(df)
        body, title = TX.tfidf(deal.counts(body_tf), terms, n, deal.on), TX.query_tfidf(deal.counts(title_tf), terms, n, deal.on)
        body, title = (deal.by_id(v.select("id", "term", "w")) for v in (body, title))
        body, title = TX.l2_normalize(body), TX.l2_normalize(title, zero_norm="zero")
        vectors = [written(v.select("id", "term", "w_norm")) for v in (body, title)]
        drop(body_tf, df)
        return pages, *vectors


def _title_top1(spark, d):
    pages, body, title = _title_vectors(spark, d)
    best = SM.best_match_bounded(body, title, "id", "id", "term", "w_norm", ("abstract_id", "title_id"))
    drop(body, title)
    keys = pages.select(F.col("id").alias("abstract_id"))
    best = keys.join(best, "abstract_id", "left")
    return pages, SM.match_indicator(best.withColumnRenamed("best", "best_title_id"),
                                     "abstract_id", "best_title_id")


def title_match_top1(spark, d):
    _, top = _title_top1(spark, d)
    return top.select("abstract_id", "best_title_id", _r("cos"), "match")


def title_match_accuracy(spark, d):
    pages, top = _title_top1(spark, d)
    acc = SM.match_accuracy(top, TX.corpus_size(pages))
    return acc.select("label", _r("value"))


# ---------------------------------------------------------------- categories
def _category_vectors(spark, d, by):
    docs, toks = _doc_tokens(spark, d)
    tf = TX.term_frequency(toks)
    return SM.group_term_vectors(tf, docs, "id", by)


def category_tf(spark, d):
    return _category_vectors(spark, d, "lang").withColumnRenamed("lang", "category")


def category_cosine(spark, d):
    m = SM.similarity_matrix(_category_vectors(spark, d, "lang"), "lang")
    return m.select("category_1", "category_2", _r("value"))


def category_cosine_source(spark, d):
    m = SM.similarity_matrix(_category_vectors(spark, d, "source"), "source")
    return m.select("category_1", "category_2", _r("value"))


def category_matrix(spark, d):
    m = SM.similarity_matrix(_category_vectors(spark, d, "lang"), "lang")
    return SM.pivot_matrix(m.select("category_1", "category_2", _r("value")))


def _mixed_vectors(spark, d):
    """Whole ``source language`` strings as categories."""
    docs, toks = _doc_tokens(spark, d)
    named = docs.select("id", F.concat_ws(" ", "source", "lang").alias("category"))
    return SM.group_term_vectors(TX.term_frequency(toks), named)


def category_neighbours(spark, d):
    """Sources whose documents are alike (cosine of at least 0.9)."""
    near = SM.group_neighbours(_category_vectors(spark, d, "source"), 0.9, "source")
    return near.select("category_1", "category_2", _r("value"))


def category_neighbours_mixed(spark, d):
    """The same for every source and language: most pairs never meet."""
    near = SM.group_neighbours(_mixed_vectors(spark, d), 0.9)
    return near.select("category_1", "category_2", _r("value"))


def category_tiles(spark, d):
    """The source matrix in tiles of 6 by 6, one row per cell."""
    m = SM.similarity_matrix(_category_vectors(spark, d, "source"), "source")
    tiles = SM.tile_matrix(m.select("category_1", "category_2", _r("value")), tile=6)
    return tiles.select("row_block", "col_block", "category_1", F.explode(F.arrays_zip("labels", "values")).alias("_c")).select(
        "row_block", "col_block", "category_1", F.col("_c.labels").alias("category_2"), F.col("_c.values").alias("value"))


# ---------------------------------------------------------------- ratings
def nested_explode(spark, d):
    return RT.explode_items(FX.users_items_nested(spark, d))


def item_median(spark, d):
    return RT.item_median(FX.users_items(spark, d))


def item_median_sketch(spark, d):
    """Medians from sketches of odd and even order lines, kept and then merged."""
    lines = FX.order_lines(spark, d).select(F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("playtime_forever"),
                                            (F.col("l_linenumber") % 2).alias("half"))
    halves = [written(RT.value_sketches(lines.where(F.col("half") == i))) for i in (0, 1)]
    return RT.sketch_median(RT.merge_sketches(halves[0].unionByName(halves[1])))


def playtime_rating(spark, d):
    return RT.playtime_rating(FX.users_items(spark, d)).select(
        "user_id", "item_id", "playtime_forever", "median", "rating")


def user_distinct(spark, d):
    return FX.users_items(spark, d).select("user_id").distinct()


def user_index(spark, d):
    return RT.index_users(FX.users_items(spark, d))


def user_index_decode(spark, d):
    items = FX.users_items(spark, d)
    index = RT.index_users(items)
    codes = RT.encode_users(items, index).select("user_id_encoded").distinct()
    return RT.decode_users(codes, index).select("user_id_encoded", "user_id")


def user_index_grow(spark, d):
    """Users of the orders of the first half-year, then those that all orders add."""
    lines = FX.order_lines(spark, d).select(F.col("o_custkey").alias("user_id"), "o_orderdate")
    first = written(RT.index_users(lines.where("o_orderdate < DATE '1995-07-01'")))
    return RT.grow_index(first, lines)


def _lines(spark, d, *more):
    """Order lines with the columns of ratings and ``more``, written: medians, users, ratings and
    what they are fused with read the copy, so orders and lines are joined once."""
    return written(FX.order_lines(spark, d).select("o_custkey", "l_partkey", "l_quantity", *more))


def _encoded_ratings(spark, d, lines=None):
    items = FX.users_items(spark, d, _lines(spark, d) if lines is None else lines)
    rated = RT.playtime_rating(items).select("user_id", "item_id", "rating")
    return RT.encode_users(rated, RT.index_users(items))


def sentiment_bucket(spark, d):
    rated = FX.users_items(spark, d).select("user_id", "item_id")
    return RT.with_sentiment(rated, FX.sentiments(spark, d)).select(
        "user_id", "item_id", "vader_score", "sentiment")


def fuse_sentiment(spark, d):
    lines = _lines(spark, d, "l_linestatus", "l_discount")
    fused = RT.fuse_sentiment(_encoded_ratings(spark, d, lines), FX.sentiments(spark, d, lines))
    return fused.select("user_id", "item_id", "rating", "user_id_encoded", "ratings")


def recommend_flag(spark, d):
    rated = FX.users_items(spark, d).select("user_id", "item_id")
    return RT.with_recommend(rated, FX.user_reviews(spark, d)).select(
        "user_id", "item_id", "recommended")


def fuse_recommend(spark, d):
    lines = _lines(spark, d, "l_returnflag")
    fused = RT.fuse_recommend(_encoded_ratings(spark, d, lines), FX.user_reviews(spark, d, lines))
    return fused.select("user_id", "item_id", "rating", "user_id_encoded", "ratings")


RATING_SOURCES = {  # the recommender's three inputs: play time alone, with sentiment, with the flag
    "implicit": (_encoded_ratings, "rating"),
    "sentiment": (fuse_sentiment, "ratings"),
    "recommend": (fuse_recommend, "ratings"),
}


def rating_source(spark, d, source: str = "recommend") -> tuple[DataFrame, str]:
    """Rated rows of one of ``RATING_SOURCES`` and the name of their rating."""
    build, value = RATING_SOURCES[source]
    return build(spark, d).select("user_id_encoded", "item_id", value), value


def _projected(source):
    def query(spark, d):
        rated, value = rating_source(spark, d, source)
        return RC.as_triples(rated, "user_id_encoded", "item_id", value).withColumn("rating", F.col("rating").cast("int"))
    return query


ratings_project = _projected("recommend")
ratings_project_sentiment = _projected("sentiment")
ratings_project_implicit = _projected("implicit")


# ---------------------------------------------------------------- recommender
def train_test_split(spark, d):
    triples = RC.as_triples(FX.ratings(spark, d), "user_idx", "item_id", "rating")
    train, test = RC.hash_split(triples)
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


def rmse_metric(spark, d):
    li = FX.table(spark, d, "lineitem").select("l_partkey", "l_quantity")
    mean = li.groupBy("l_partkey").agg(F.avg("l_quantity").alias("prediction"))
    pred = li.join(mean, "l_partkey").select(F.col("l_quantity").alias("rating"), "prediction")
    return RC.rmse(pred).select(_r("rmse"))


def als_input(spark, d, source="recommend"):
    """ALS triples with a dense item index, and the index to map items back.
    Written once to the scratch folder: fits, predictions and tests all read
    that copy."""
    rated, value = rating_source(spark, d, source)
    rated = written(rated)
    items = RC.index_ids(rated, "item_id", "item")
    triples = RC.as_triples(rated.join(items, "item_id"), "user_id_encoded", "item", value)
    return written(triples), items


def _fitted(spark, d, rank=10, source="recommend"):
    """One model, its train and test rows, and the items. The shuffle files of the preparation and of
    past iterations are deleted meanwhile, so the disk has room for what reads the model."""
    with files_released(spark):
        triples, items = als_input(spark, d, source)
        train, test = RC.hash_split(triples)
        return RC.fit_implicit(train, rank=rank, checkpoint_interval=1), train, test, items


# Scores differ from run to run in their last places and have no SQL twin: tests compare
# them with a plain computation. What is fixed about them, which pairs, positions and
# counts there are, is the ``_facts`` query of each, which has one.
def als_predict(spark, d, source="recommend"):
    """Test pairs with their predicted preference (users and items unseen in training get none)."""
    model, _, test, items = _fitted(spark, d, source=source)
    return RC.predict(model, test).join(items, "item").select("user", "item_id", "rating", "prediction")


def als_predict_facts(spark, d):
    return als_predict(spark, d).where(~F.isnan("prediction")).select("user", "item_id", "rating")


def als_predict_sentiment(spark, d):
    """:func:`als_predict` on ratings fused with sentiment."""
    return als_predict(spark, d, "sentiment")


def als_predict_implicit(spark, d):
    """:func:`als_predict` on ratings from play time alone."""
    return als_predict(spark, d, "implicit")


def als_rmse(spark, d):
    """Error of one model: pairs tested and root mean squared error."""
    model, _, test, _ = _fitted(spark, d)
    return RC.rmse(RC.predict(model, test)).select(F.lit(10).alias("rank"), "n_test", "rmse")


def als_rmse_facts(spark, d):
    return als_rmse(spark, d).select("rank", "n_test")


def als_residual(spark, d):
    """How exactly each user block's factors solve the last half-step of the fit."""
    model, train, _, _ = _fitted(spark, d)
    return RC.residuals_by_block(RC.half_step_residuals(model, train))


def als_residual_facts(spark, d):
    return als_residual(spark, d).select("block", "n_users", (F.col("worst") < 1e-3).alias("solved"))


def als_topn(spark, d):
    """Top lists of users 0-7, with items and scores, for every rank of the sweep."""
    triples, items = als_input(spark, d)
    users = spark.range(ALS_USERS).select(F.col("id").cast("int").alias("user"))
    _, recs = RC.rank_sweep(triples, users=users, at_once=ALS_AT_ONCE)
    return recs.join(items, "item").select("rank", "user", "pos", "item_id", "score")


def als_topn_facts(spark, d):
    return als_topn(spark, d).select("rank", "user", "pos")


def als_rank_sweep(spark, d):
    """Error table of all ranks, ``ALS_AT_ONCE`` fits at a time."""
    triples, _ = als_input(spark, d)
    return RC.rank_sweep(triples, at_once=ALS_AT_ONCE)[0]


def als_rank_sweep_facts(spark, d):
    return als_rank_sweep(spark, d).select("rank", "n_test")


QUERIES: dict[str, Query] = {
    "src_json": src_json,
    "malformed_json": malformed_json,
    "malformed_literals": malformed_literals,
    "malformed_csv": malformed_csv,
    "src_literals": src_literals,
    "src_csv_columns": src_csv_columns,
    "src_stop_words": src_stop_words,
    "sink_partitions": sink_partitions,
    "daily_reviews": daily_reviews,
    "brand_filter": brand_filter,
    "daily_reviews_brand": daily_reviews_brand,
    "daily_reviews_top15": daily_reviews_top15,
    "text_clean": text_clean,
    "tokenize": tokenize,
    "stopword_filter": stopword_filter,
    "stopword_table": stopword_table,
    "term_freq": term_freq,
    "doc_freq": doc_freq,
    "tfidf": tfidf,
    "tfidf_norm": tfidf_norm,
    "tfidf_indexed": tfidf_indexed,
    "tfidf_norm_indexed": tfidf_norm_indexed,
    "doc_vector": doc_vector,
    "title_term_freq": title_term_freq,
    "title_tfidf": title_tfidf,
    "title_tfidf_norm": title_tfidf_norm,
    "title_match_scores": title_match_scores,
    "title_match_top1": title_match_top1,
    "title_match_accuracy": title_match_accuracy,
    "category_tf": category_tf,
    "category_cosine": category_cosine,
    "category_cosine_source": category_cosine_source,
    "category_matrix": category_matrix,
    "category_neighbours": category_neighbours,
    "category_neighbours_mixed": category_neighbours_mixed,
    "category_tiles": category_tiles,
    "nested_explode": nested_explode,
    "item_median": item_median,
    "item_median_sketch": item_median_sketch,
    "playtime_rating": playtime_rating,
    "user_distinct": user_distinct,
    "user_index": user_index,
    "user_index_grow": user_index_grow,
    "user_index_decode": user_index_decode,
    "sentiment_bucket": sentiment_bucket,
    "fuse_sentiment": fuse_sentiment,
    "recommend_flag": recommend_flag,
    "fuse_recommend": fuse_recommend,
    "ratings_project": ratings_project,
    "ratings_project_sentiment": ratings_project_sentiment,
    "ratings_project_implicit": ratings_project_implicit,
    "train_test_split": train_test_split,
    "rmse_metric": rmse_metric,
    "als_predict": als_predict,
    "als_predict_facts": als_predict_facts,
    "als_predict_sentiment": als_predict_sentiment,
    "als_predict_implicit": als_predict_implicit,
    "als_rmse": als_rmse,
    "als_rmse_facts": als_rmse_facts,
    "als_residual": als_residual,
    "als_residual_facts": als_residual_facts,
    "als_topn": als_topn,
    "als_topn_facts": als_topn_facts,
    "als_rank_sweep": als_rank_sweep,
    "als_rank_sweep_facts": als_rank_sweep_facts,
}
