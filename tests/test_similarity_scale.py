"""Bounded best match, threshold self-join and tiles: exact, and without the pairs that
don't matter."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quill.operators import similarity as SM
from quill.plans import catalogue as C

SF = "/root/testdata/sf0.01"
V = "id long, term string, w_norm double"


def unit(vec):
    n = math.sqrt(sum(w * w for w in vec.values()))
    return {t: w / n for t, w in vec.items()} if n else {}


def rows(vectors):
    return [(i, t, w) for i, vec in vectors.items() for t, w in unit(vec).items()]


def best_of(left, right):
    out = {}
    for a, l in left.items():
        scores = [(-round(sum(w * unit(r).get(t, 0.0) for t, w in unit(l).items()), 9), b) for b, r in right.items()]
        s, b = min(scores)
        if s < 0:
            out[a] = (b, -s)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_vectors_of_all_shapes(spark, seed):
    rng = random.Random(seed)
    terms = [f"t{i}" for i in range(40)]
    pick = lambda n: {t: rng.random() ** 3 for t in rng.sample(terms[: rng.choice([3, 10, 40])], n)}
    left = {i: pick(rng.randint(1, 3 if i % 3 else 30) if i % 3 else 3) for i in range(80)}
    right = {i + 20: pick(rng.randint(1, 3)) for i in range(80)}
    for i in range(0, 30, 3):                           # copies on both sides
        left[i + 1], right[i + 21] = left[i], right[20]
    got = SM.best_match_bounded(spark.createDataFrame(rows(left), V), spark.createDataFrame(rows(right), V)).collect()
    assert {r.id_1: (r.best, round(r.cos, 9)) for r in got} == best_of(left, right)


def _candidates(spark, body, title):
    lhs = SM._side(body, "id", "term", "w_norm", "l").withColumnRenamed("l_id", "a")
    rhs = SM._side(title, "id", "term", "w_norm", "r").withColumnRenamed("r_id", "b")
    lhs = lhs.join(rhs.select("_term").distinct(), "_term", "left_semi")
    lc, rc = (SM.identical_vectors(s, i, w) for s, i, w in ((lhs, "a", "l_w"), (rhs, "b", "r_w")))
    lhs, rhs = SM._one_of_each(lhs, lc, "a"), SM._one_of_each(rhs, rc, "b")
    own = (lc.join(rc.withColumnRenamed("_rep", "_o"), F.col("a") == F.col("b"))
           .select(F.col("_rep").alias("a"), F.col("_o").alias("b")))
    return SM.match_candidates(lhs, rhs, own, "a", "b", 1e-8).count()


def test_few_candidates_are_scored(spark):
    _, body, title = C._title_vectors(spark, SF)
    n = body.select("id").distinct().count()
    sharing = SM.dot_products(body, title, w="w_norm").count()
    assert sharing > 50 * n and _candidates(spark, body, title) < 2 * n


def test_copies_in_a_third_of_all_rows(spark):
    """300 equal bodies and 300 equal titles are one pair, not 90,000."""
    body = spark.range(900).select("id", F.explode(F.array(F.lit("same"), F.lit("words"))).alias("term"), F.lit(0.5 ** 0.5).alias("w_norm"))
    body = body.withColumn("term", F.when(F.col("id") % 3 == 0, F.col("term")).otherwise(F.concat("term", F.col("id").cast("string"))))
    assert _candidates(spark, body, body) <= 700
    got = {r.id_1: r.best for r in SM.best_match_bounded(body, body).collect()}
    assert got == {i: 0 if i % 3 == 0 else i for i in range(900)}


def test_nothing_shared_or_empty(spark):
    a, b = spark.createDataFrame([(1, "x", 1.0)], V), spark.createDataFrame([(1, "y", 1.0)], V)
    assert SM.best_match_bounded(a, b).count() == 0
    assert SM.best_match_bounded(a.where("false"), b).count() == 0
    assert SM.best_match_bounded(a, b.where("false")).count() == 0
    zero = spark.createDataFrame([(1, "x", 0.0), (2, "x", None), (3, "x", 1.0)], V)
    assert [tuple(r) for r in SM.best_match_bounded(zero, zero).collect()] == [(3, 3, 1.0)]


@pytest.mark.parametrize("threshold", [0.05, 0.5, 0.9, 0.999])
def test_group_neighbours_equal_the_filtered_matrix(spark, threshold):
    vectors = C._mixed_vectors(spark, "/root/testdata/sf0.001").persist()
    full = SM.similarity_matrix(vectors).where(f"category_1 < category_2 and value >= {threshold}")
    want = {(r[0], r[1]): round(r[2], 9) for r in full.collect()}
    got = SM.group_neighbours(vectors, threshold).collect()
    assert {(r[0], r[1]): round(r[2], 9) for r in got} == want
    vectors.unpersist()


def test_group_neighbours_of_odd_rows(spark):
    rows = [("a", "x", 2), ("a", "y", 0), ("b", "x", 5), ("c", "z", 1), (None, "x", 1), ("d", "x", None), ("e", "x", 3), ("e", "q", 4)]
    got = SM.group_neighbours(spark.createDataFrame(rows, "category string, term string, tf long"), 0.5).collect()
    assert sorted((r[0], r[1], round(r[2], 6)) for r in got) == [("a", "b", 1.0), ("a", "e", 0.6), ("b", "e", 0.6)]
    assert SM.group_neighbours(spark.createDataFrame([], "category string, term string, tf long"), 0.5).count() == 0


@pytest.mark.parametrize("tile", [1, 3, 100])
def test_tiles_hold_the_whole_matrix(spark, tile):
    labels = [f"c{i:02d}" for i in range(10)]
    pairs = {(a, b): i * 100.0 + j + 1 for i, a in enumerate(labels) for j, b in enumerate(labels) if (i + j) % 4}
    df = spark.createDataFrame([(a, b, v) for (a, b), v in pairs.items()], "category_1 string, category_2 string, value double")
    got = {}
    for r in SM.tile_matrix(df, tile).collect():
        assert len(r.labels) == len(r["values"]) <= tile
        assert r.row_block == labels.index(r.category_1) // tile
        assert all(labels.index(x) // tile == r.col_block for x in r.labels)
        got |= {(r.category_1, x): v for x, v in zip(r.labels, r["values"])}
    assert {k: v for k, v in got.items() if v} == pairs and all(v == 0 for k, v in got.items() if k not in pairs)


def test_pivot_takes_its_labels_from_written_pairs(spark):
    """Without given labels the pairs are computed once, not once for the labels too."""
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch
    pairs = spark.createDataFrame([("a", "a", 1.0), ("b", "b", 1.0)], "category_1 string, category_2 string, value double")
    SM.pivot_matrix(pairs.coalesce(1).mapInArrow(seen, pairs.schema)).collect()
    assert runs.value == 2


def test_terms_that_a_body_lacks_make_no_candidates(spark):
    """Forty titles share one rare term with each body, their other terms are in other bodies only."""
    body = {i: {"g": 1.0, "m": 1 + i / 100} for i in range(20)} | {i: {"p": 1.0, "q": 1 + i / 100} for i in range(20, 45)}
    title = {100 + j: {"g": 1 + j / 100, "p": 1.0, "q": 1.0} for j in range(40)} | {99: {"m": 1.0}}
    lhs, rhs = (spark.createDataFrame(rows(v), f"{i} long, _term string, {w} double") for v, i, w in ((body, "a", "l_w"), (title, "b", "r_w")))
    own = spark.createDataFrame([], "a long, b long")
    found = SM.match_candidates(lhs, rhs, own, "a", "b", 1e-8).where("a < 20")
    assert 20 <= found.count() <= 100
    got = SM.best_match_bounded(spark.createDataFrame(rows(body), V), spark.createDataFrame(rows(title), V)).collect()
    assert {r.id_1: (r.best, round(r.cos, 9)) for r in got} == best_of(body, title)


def test_right_vectors_longer_than_what_a_signature_is_asked(spark, monkeypatch):
    rng = random.Random(7)
    pick = lambda n: {f"t{i}": rng.random() ** 2 + 0.01 for i in rng.sample(range(60), n)}
    left, right = ({i: pick(rng.randint(5, 50)) for i in range(n)} for n in (50, 40))
    monkeypatch.setattr(SM, "SIGNED_TERMS", 3)
    monkeypatch.setattr(SM, "SIGNATURE_WORDS", 1)
    got = SM.best_match_bounded(spark.createDataFrame(rows(left), V), spark.createDataFrame(rows(right), V)).collect()
    assert {r.id_1: (r.best, round(r.cos, 9)) for r in got} == best_of(left, right)
