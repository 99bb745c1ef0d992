"""Tokeniser cases and TF-IDF against a brute-force dense computation."""

import math
import random

import pytest
import regex

from quill.operators import similarity as SM
from quill.operators import text as TX

from conftest import rows

SPLIT = regex.compile(r"[^\p{L}\p{N}_]+")


def py_tokens(text):
    return [t.lower() for t in SPLIT.split(text)]


@pytest.mark.parametrize("text", [
    ",Hello, World!",          # leading and trailing punctuation -> empty tokens
    "",                        # empty string -> one empty token
    "the and of",              # only stop words
    "wörld Wörld",             # accents
    "snake_case x_1",          # underscore is a word character
    "2² 10 ³x",                # digits and superscripts
    "  spaced   out  ",
])
def test_tokenize_matches_python_split(spark, text):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    got = [r.term for r in TX.tokenize(df, "id", "text").collect()]
    assert sorted(got) == sorted(py_tokens(text))


def test_tokenize_null_text_and_keep_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ".a.")], "id long, text string")
    assert rows(TX.tokenize(df, "id", "text"), "id", "term") == [(2, ""), (2, ""), (2, "a")]
    assert rows(TX.tokenize(df, "id", "text", keep_empty=False), "id", "term") == [(2, "a")]


def test_stop_words_list_and_dataframe(spark):
    df = spark.createDataFrame([(1, "The cat and the Hat")], "id long, text string")
    toks = TX.tokenize(df, "id", "text")
    by_list = rows(TX.remove_stop_words(toks, ["the", "and"]), "term")
    stop_df = spark.createDataFrame([("the",), ("and",), ("Hat",)], "value string")
    by_df = rows(TX.remove_stop_words(toks, stop_df), "term")
    assert by_list == [("cat",), ("hat",)]
    # the list is used as written: 'Hat' does not remove the lower-cased 'hat'
    assert by_df == [("cat",), ("hat",)]


def brute_tfidf(docs, stop):
    """Dense, per-document dicts: the straightforward computation."""
    n = len(docs)
    tf = {}
    for i, text in docs:
        if text is None:
            continue
        for t in py_tokens(text):
            if t in stop:
                continue
            tf.setdefault(i, {}).setdefault(t, 0)
            tf[i][t] += 1
    df = {}
    for vec in tf.values():
        for t in vec:
            df[t] = df.get(t, 0) + 1
    w = {i: {t: (1 + math.log10(c)) * math.log10(n / df[t]) for t, c in vec.items()}
         for i, vec in tf.items()}
    out = {}
    for i, vec in w.items():
        norm = math.sqrt(sum(x * x for x in vec.values()))
        out[i] = {t: (x / norm if norm else None) for t, x in vec.items()}
    return tf, df, w, out


CORPUS = [
    (1, "Common words: alpha beta gamma. Alpha again!"),
    (2, "common beta delta, delta delta"),
    (3, "common gamma epsilon zeta"),
    (4, "common gamma epsilon zeta"),        # equal to another document
    (5, "common"),                           # only a term that is in every document
    (6, None),                               # null text still counts in N
]


def test_tfidf_index_equals_brute_force(spark):
    stop = {"the", "and"}
    df = spark.createDataFrame(CORPUS, "id long, text string")
    got = TX.tfidf_index(df, "id", "text", stop=sorted(stop)).collect()
    tf, dfreq, w, wn = brute_tfidf(CORPUS, stop)
    assert len(got) == sum(len(v) for v in tf.values())
    for r in got:
        assert r.tf == tf[r.id][r.term]
        assert r.df == dfreq[r.term]
        assert math.isclose(r.w, w[r.id][r.term], rel_tol=1e-12, abs_tol=1e-15)
        if wn[r.id][r.term] is None:
            assert r.w_norm is None          # zero-norm document: no division by zero
        else:
            assert math.isclose(r.w_norm, wn[r.id][r.term], rel_tol=1e-12, abs_tol=1e-15)
    # unit norm for every document with a non-zero vector
    sums = {}
    for r in got:
        if r.w_norm is not None:
            sums[r.id] = sums.get(r.id, 0.0) + r.w_norm ** 2
    assert all(math.isclose(v, 1.0, rel_tol=1e-12) for v in sums.values())


def test_one_document_corpus(spark):
    df = spark.createDataFrame([(1, "solo words here")], "id long, text string")
    got = TX.tfidf_index(df, "id", "text").collect()
    assert all(r.w == 0.0 and r.w_norm is None for r in got)


def test_query_side_unknown_term_and_zero_norm(spark):
    corpus = spark.createDataFrame([(1, "apple banana"), (2, "banana cherry")], "id long, text string")
    queries = spark.createDataFrame([(1, "apple pie"), (2, "pie crust"), (3, "banana")],
                                    "id long, title string")
    got = {(r.id, r.term): r for r in TX.query_index(queries, corpus, "id", "title", "text").collect()}
    assert got[(1, "pie")].w == 0.0 and got[(1, "pie")].df is None   # not in the corpus
    assert got[(1, "apple")].w_norm == pytest.approx(1.0)
    assert got[(2, "pie")].w_norm == 0.0                              # zero norm -> 0, not null
    assert got[(3, "banana")].w_norm == 0.0                           # df = N -> weight 0


def dense_cos(a, b):
    keys = set(a) | set(b)
    dot = sum(a.get(k, 0.0) * b.get(k, 0.0) for k in keys)
    na = math.sqrt(sum(v * v for v in a.values()))
    nb = math.sqrt(sum(v * v for v in b.values()))
    return dot / (na * nb)


def test_sparse_cosine_equals_dense_on_random_corpora(spark):
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(30)]
    for trial in range(3):
        left = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 12)))) for i in range(12)]
        right = [(100 + i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 5)))) for i in range(8)]
        l_df = spark.createDataFrame(left, "id long, text string")
        r_df = spark.createDataFrame(right, "id long, text string")
        lt = TX.term_frequency(TX.tokenize(l_df, "id", "text"))
        rt = TX.term_frequency(TX.tokenize(r_df, "id", "text"))
        got = {(r.id_1, r.id_2): r.cos for r in SM.cosine_pairs(lt, rt, w="tf").collect()}
        lv = {i: {} for i, _ in left}
        rv = {i: {} for i, _ in right}
        for i, t in left:
            for tok in py_tokens(t):
                lv[i][tok] = lv[i].get(tok, 0) + 1
        for i, t in right:
            for tok in py_tokens(t):
                rv[i][tok] = rv[i].get(tok, 0) + 1
        for i in lv:
            for j in rv:
                c = dense_cos(lv[i], rv[j])
                if c == 0:
                    assert (i, j) not in got
                else:
                    assert got[(i, j)] == pytest.approx(c, rel=1e-12)


def test_cosine_symmetric_and_self_one(spark):
    vec = spark.createDataFrame([("a", "x", 2.0), ("a", "y", 1.0), ("b", "x", 1.0), ("b", "z", 3.0)],
                                "category string, term string, tf double")
    m = {(r.category_1, r.category_2): r.value for r in SM.similarity_matrix(vec).collect()}
    assert m[("a", "a")] == pytest.approx(1.0) and m[("b", "b")] == pytest.approx(1.0)
    assert m[("a", "b")] == pytest.approx(m[("b", "a")])
    assert 0.0 <= m[("a", "b")] <= 1.0


def test_best_match_tie_break_and_no_candidate(spark):
    scores = spark.createDataFrame(
        [(1, 20, 0.5), (1, 10, 0.5), (1, 30, 0.4), (2, 30, 0.9), (2, 31, float("nan"))],
        "id_1 long, id_2 long, cos double")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "id_1 long")
    best = {r.id_1: (r.best, r.cos) for r in SM.best_match(scores, keys).collect()}
    assert best == {1: (10, 0.5), 2: (30, 0.9), 3: (None, None)}
    m = SM.match_indicator(SM.best_match(scores, keys).withColumnRenamed("best", "b"), "id_1", "b")
    acc = SM.match_accuracy(m).collect()[0]
    assert acc.label == "accuracy" and acc.value == 0.0


def test_pivot_matrix_fills_missing_pairs(spark):
    pairs = spark.createDataFrame([("a", "a", 1.0), ("b", "b", 1.0)],
                                  "category_1 string, category_2 string, value double")
    wide = {r.category_1: (r.a, r.b) for r in SM.pivot_matrix(pairs, ["a", "b"]).collect()}
    assert wide == {"a": (1.0, 0.0), "b": (0.0, 1.0)}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_bounded_top1_equals_full_enumeration(spark, sf):
    from quill.plans import catalogue as C
    _, body, title = C._title_vectors(spark, f"/root/testdata/sf{sf}")
    check_bounded(body, title)


def check_bounded(body, title):
    ids = ("abstract_id", "title_id")
    full = SM.best_match(SM.cosine_pairs(body, title, "id", "id", "term", "w_norm", ids, normalized=True),
                         None, *ids, "cos")
    want = {r.abstract_id: (r.best, round(r.cos, 9)) for r in full.collect()}
    got = SM.best_match_bounded(body, title, "id", "id", "term", "w_norm", ids).collect()
    assert {r.abstract_id: (r.best, round(r.cos, 9)) for r in got} == want


def test_bounded_top1_with_one_dominant_term(spark):
    """Nearly every vector has the common term; some have nothing else, some have no
    right vector of their own id, some tie."""
    rng = random.Random(11)
    left, right = [], []
    for i in range(400):
        common = [("all", 0.05 + 0.05 * (i % 3))] if i % 17 else []
        own = [(f"t{rng.randrange(60)}", rng.random()) for _ in range(rng.randrange(0, 4))]
        left += [(i, t, w) for t, w in dict(common + own).items()]
        right += [(i + 5, t, w) for t, w in dict(common + own[:2]).items()]
    schema = "id long, term string, w_norm double"
    check_bounded(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))


def test_category_matrix_of_new_and_disjoint_categories(spark):
    tf = spark.createDataFrame([("it", "a", 2), ("it", "b", 1), ("de", "a", 1), ("nl", "z", 4)],
                               "category string, term string, tf long")
    pairs = {(r.category_1, r.category_2): r.value for r in SM.similarity_matrix(tf).collect()}
    assert set(pairs) == {("it", "it"), ("de", "de"), ("nl", "nl"), ("it", "de"), ("de", "it")}
    assert pairs["it", "de"] == pairs["de", "it"] == pytest.approx(2 / 5 ** 0.5)
    wide = {r.category_1: r.asDict() for r in SM.pivot_matrix(SM.similarity_matrix(tf)).collect()}
    assert set(wide["nl"]) == {"category_1", "it", "de", "nl"} and wide["nl"]["it"] == 0.0 and wide["nl"]["nl"] == 1.0


def test_sparse_vectors_equal_dense_slots(spark):
    """Coordinates (id, slot, w) densified over the sorted vocabulary equal
    the dense vectors built slot by slot."""
    docs = spark.createDataFrame(CORPUS, "id long, text string")
    idx = TX.tfidf_index(docs, "id", "text", stop=["the", "and"])
    vocab = TX.vocabulary_index(idx)
    coords = TX.sparse_vectors(idx, vocab).collect()
    _, _, _, wn = brute_tfidf(CORPUS, {"the", "and"})
    terms = sorted({t for vec in wn.values() for t in vec})
    assert sorted((r.term, r.slot) for r in vocab.collect()) == [(t, i) for i, t in enumerate(terms)]
    dense = {i: [0.0] * len(terms) for i in wn}
    for r in coords:
        dense[r.id][r.slot] = r.w_norm
    for i, vec in wn.items():
        want = [vec.get(t) if vec.get(t) is not None else (None if t in vec else 0.0) for t in terms]
        assert [None if x is None else pytest.approx(x, rel=1e-12, abs=1e-15) for x in want] == dense[i]
