"""DuckDB SQL twins of the catalogue queries (same keys, same column names,
same rounding). The test tables are registered as views named after the
parquet files. ALS scores have no SQL twin: their queries return
what is fixed about them (which pairs are scored, positions, ranges).
"""

from __future__ import annotations

from quill.plans.fixtures import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_SPLIT = r"'[^\p{L}\p{N}_]+'"

# ------------------------------------------------------------ view fragments
REVIEWS = ("reviews AS (SELECT l_partkey AS asin, CAST(l_shipdate AS DATE) AS review_date, "
           "l_quantity AS overall FROM lineitem)")
META = ("meta AS (SELECT p_partkey AS asin, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END "
        "AS brand FROM part)")
STATS = ("stats AS (SELECT asin, review_date, count(*) AS n, avg(overall) AS avg_overall "
         "FROM reviews GROUP BY asin, review_date)")

DOCS = "docs AS (SELECT doc_id AS id, text AS abstract, lang, source FROM documents)"


def _tokens(name: str, src: str, id_col: str, text_col: str, stop: bool = True) -> str:
    where = f" WHERE term NOT IN ({_STOP})" if stop else ""
    return (f"{name} AS (SELECT * FROM (SELECT id, lower(tok) AS term FROM (SELECT {id_col} AS id, "
            f"unnest(regexp_split_to_array({text_col}, {_SPLIT})) AS tok FROM {src} "
            f"WHERE {text_col} IS NOT NULL)){where})")


def _tf(name: str, toks: str) -> str:
    return f"{name} AS (SELECT id, term, count(*) AS tf FROM {toks} GROUP BY id, term)"


def _df(name: str, tf: str) -> str:
    return f"{name} AS (SELECT term, count(*) AS df FROM {tf} GROUP BY term)"


def _weights(name: str, tf: str, df: str, corpus: str) -> str:
    return (f"{name} AS (SELECT t.id, t.term, t.tf, d.df, "
            f"(1 + log10(t.tf)) * log10(CAST((SELECT count(*) FROM {corpus}) AS DOUBLE) / d.df) AS w "
            f"FROM {tf} t JOIN {df} d ON t.term = d.term)")


def _query_weights(name: str, tf: str, df: str, corpus: str) -> str:
    return (f"{name} AS (SELECT t.id, t.term, t.tf, d.df, CASE WHEN d.df IS NULL OR d.df = 0 THEN 0.0 "
            f"ELSE (1 + log10(t.tf)) * log10(CAST((SELECT count(*) FROM {corpus}) AS DOUBLE) / d.df) END AS w "
            f"FROM {tf} t LEFT JOIN {df} d ON t.term = d.term)")


def _normalized(name: str, w: str, zero: bool) -> str:
    div = ("CASE WHEN n.norm = 0 THEN 0.0 ELSE x.w / n.norm END" if zero
           else "x.w / NULLIF(n.norm, 0)")
    return (f"{name} AS (SELECT x.id, x.term, x.w, {div} AS w_norm FROM {w} x JOIN "
            f"(SELECT id, sqrt(sum(w * w)) AS norm FROM {w} GROUP BY id) n ON x.id = n.id)")


def _cosine(name: str, left: str, right: str, w: str, ids: tuple[str, str],
            normalized: bool = False) -> str:
    a, b = ids
    if normalized:  # unit vectors: the cosine is the dot product
        return (f"{name} AS (SELECT l.id AS {a}, r.id AS {b}, "
                f"sum(CAST(l.{w} AS DOUBLE) * CAST(r.{w} AS DOUBLE)) AS cos "
                f"FROM {left} l JOIN {right} r ON l.term = r.term "
                f"WHERE l.{w} IS NOT NULL AND l.{w} <> 0 AND r.{w} IS NOT NULL AND r.{w} <> 0 "
                f"GROUP BY l.id, r.id)")
    return (
        f"{name} AS (SELECT d.{a}, d.{b}, d.dot / (nl.nrm * nr.nrm) AS cos FROM "
        f"(SELECT l.id AS {a}, r.id AS {b}, sum(CAST(l.{w} AS DOUBLE) * CAST(r.{w} AS DOUBLE)) AS dot "
        f"FROM {left} l JOIN {right} r ON l.term = r.term "
        f"WHERE l.{w} IS NOT NULL AND l.{w} <> 0 AND r.{w} IS NOT NULL AND r.{w} <> 0 "
        f"GROUP BY l.id, r.id) d "
        f"JOIN (SELECT id, sqrt(sum({w} * {w})) AS nrm FROM {left} GROUP BY id) nl ON d.{a} = nl.id "
        f"JOIN (SELECT id, sqrt(sum({w} * {w})) AS nrm FROM {right} GROUP BY id) nr ON d.{b} = nr.id)")


DOC_TEXT = [DOCS, _tokens("toks", "docs", "id", "abstract"), _tf("tf", "toks"), _df("dfq", "tf"),
            _weights("wt", "tf", "dfq", "docs")]

PAGES = ("pg AS (SELECT page_id AS id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, "
         "regexp_replace(regexp_extract(html, '(?is)<article>(.*?)</article>', 1), '<[^>]+>', ' ', 'g') "
         "AS body FROM pages)")
PAGE_TEXT = [PAGES,
             _tokens("btoks", "pg", "id", "body"), _tf("btf", "btoks"), _df("bdf", "btf"),
             _tokens("ttoks", "pg", "id", "title"), _tf("ttf", "ttoks"),
             _weights("bw", "btf", "bdf", "pg"), _query_weights("tw", "ttf", "bdf", "pg"),
             _normalized("bn", "bw", zero=False), _normalized("tn", "tw", zero=True),
             _cosine("scores", "bn", "tn", "w_norm", ("abstract_id", "title_id"), normalized=True)]
TOP1 = ("best AS (SELECT abstract_id, title_id AS best_title_id, cos FROM (SELECT *, row_number() OVER "
        "(PARTITION BY abstract_id ORDER BY round(cos, 9) DESC, title_id ASC) AS rn FROM scores "
        "WHERE cos IS NOT NULL AND NOT isnan(cos)) WHERE rn = 1), "
        "top AS (SELECT k.id AS abstract_id, b.best_title_id, b.cos, "
        "CASE WHEN b.best_title_id IS NOT NULL AND b.best_title_id = k.id THEN 1 ELSE 0 END AS match "
        "FROM pg k LEFT JOIN best b ON b.abstract_id = k.id)")


def _category(by: str) -> list[str]:
    return DOC_TEXT[:3] + [
        f"ctf AS (SELECT {by} AS id, t.term, CAST(sum(t.tf) AS BIGINT) AS tf FROM tf t "
        f"JOIN docs d ON t.id = d.id GROUP BY {by}, t.term)",
        _cosine("cc", "ctf", "ctf", "tf", ("category_1", "category_2"))]


USERS_ITEMS = ("ui AS (SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS playtime_forever, "
               "l_linestatus, l_returnflag, l_discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
MEDIAN = ("med AS (SELECT item_id, quantile_disc(playtime_forever, 0.5) AS median FROM ui "
          "GROUP BY item_id)")
RATED = ("rated AS (SELECT u.user_id, u.item_id, u.playtime_forever, m.median, CASE "
         "WHEN u.playtime_forever > m.median THEN 5 "
         "WHEN m.median > u.playtime_forever AND u.playtime_forever > 0.8 * m.median THEN 4 "
         "WHEN 0.8 * m.median > u.playtime_forever AND u.playtime_forever > 0.5 * m.median THEN 3 "
         "WHEN 0.5 * m.median > u.playtime_forever AND u.playtime_forever > 0.2 * m.median THEN 2 "
         "ELSE 1 END AS rating FROM ui u LEFT JOIN med m ON u.item_id = m.item_id)")
INDEX = ("idx AS (SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, CAST(user_id AS VARCHAR)) "
         "- 1 AS INTEGER) AS user_id_encoded FROM (SELECT user_id, count(*) AS n FROM ui GROUP BY user_id))")
ENCODED = ("enc AS (SELECT r.user_id, r.item_id, r.rating, i.user_id_encoded FROM rated r "
           "JOIN idx i ON r.user_id = i.user_id)")
SENT = ("sent AS (SELECT user_id, item_id, max(round(l_discount - 0.05, 2)) AS vader_score FROM ui "
        "WHERE l_linestatus = 'O' GROUP BY user_id, item_id)")
REV = ("rev AS (SELECT user_id, item_id, max(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END) = 1 "
       "AS recommend FROM ui WHERE l_returnflag <> 'N' GROUP BY user_id, item_id)")
BUCKET = ("CASE WHEN CAST(coalesce(s.vader_score, -2) AS FLOAT) < 0 THEN -1 "
          "WHEN CAST(coalesce(s.vader_score, -2) AS FLOAT) > 0 THEN 1 ELSE 0 END")
FLAG = "CASE WHEN v.recommend = true THEN 1 WHEN v.recommend = false THEN 0 ELSE -1 END"


# the two rule tables as rows: (rating, signal, rating after fusion)
SENTIMENT_RULE = ("rule_s(r, s, f) AS (VALUES (1, 1, 2), (2, 1, 3), (3, 1, 4), (4, 1, 4), (5, 1, 5), "
                  "(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 3), (5, 0, 4), "
                  "(1, -1, 1), (2, -1, 2), (3, -1, 2), (4, -1, 3), (5, -1, 4))")
RECOMMEND_RULE = ("rule_c(r, c, f) AS (VALUES (1, 1, 3), (2, 1, 4), (3, 1, 5), (4, 1, 4), (5, 1, 5), "
                  "(1, 0, 1), (2, 0, 2), (3, 0, 1), (4, 0, 2), (5, 0, 3), "
                  "(1, -1, 1), (2, -1, 2), (3, -1, 3), (4, -1, 4), (5, -1, 5))")

FUSED_SENT = [USERS_ITEMS, MEDIAN, RATED, INDEX, ENCODED, SENT, SENTIMENT_RULE,
              f"es AS (SELECT e.*, {BUCKET} AS sentiment FROM enc e LEFT JOIN sent s "
              "ON e.user_id = s.user_id AND e.item_id = s.item_id)",
              "fs AS (SELECT user_id, item_id, rating, user_id_encoded, f AS ratings "
              "FROM es JOIN rule_s ON rating = r AND sentiment = s)"]
FUSED_REC = [USERS_ITEMS, MEDIAN, RATED, INDEX, ENCODED, REV, RECOMMEND_RULE,
             f"er AS (SELECT e.*, {FLAG} AS recommended FROM enc e LEFT JOIN rev v "
             "ON e.user_id = v.user_id AND e.item_id = v.item_id)",
             "fr AS (SELECT user_id, item_id, rating, user_id_encoded, f AS ratings "
             "FROM er JOIN rule_c ON rating = r AND recommended = c)"]


def _project(value: str, src: str) -> str:
    return ("SELECT CAST(user_id_encoded AS INTEGER) AS user, CAST(item_id AS INTEGER) AS item, "
            f"CAST({value} AS INTEGER) AS rating FROM {src}")


def _split(user: str, item: str) -> str:
    """Tenth of a (user, item) pair, 0-9: the first eight digits of an md5."""
    return (f"CAST('0x' || substr(md5(CAST({user} AS VARCHAR) || ',' || CAST({item} AS VARCHAR) || ',1001'), 1, 8) "
            "AS BIGINT) % 10")


# the recommender's input with dense item numbers, split in train and test
ALS_SPLIT = FUSED_REC + [
    "dense AS (SELECT item_id, dense_rank() OVER (ORDER BY item_id) - 1 AS item FROM fr GROUP BY item_id)",
    "tri AS (SELECT user_id_encoded AS user, fr.item_id, item, ratings AS rating, "
    f"{_split('user_id_encoded', 'item')} AS tenth FROM fr JOIN dense USING (item_id))",
    "train AS (SELECT * FROM tri WHERE tenth < 8)",
    "seen AS (SELECT t.* FROM tri t WHERE tenth >= 8 AND user IN (SELECT user FROM train) "
    "AND item IN (SELECT item FROM train))",
    "ranks AS (SELECT unnest([10, 20, 30, 40, 50, 60]) AS rank)"]


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _cut(key: str, line: str, shown: str, n: int | None) -> str:
    """Good rows, and as lines those whose key 7 divides (cut to ``n`` characters)."""
    columns = shown.split(", ")
    named = ", ".join(f"CASE WHEN {key} % 7 <> 0 THEN {c} END AS {c.split('.')[-1]}" for c in columns)
    text = f"substr({line}, 1, {n})" if n else line
    return f"SELECT {named}, CASE WHEN {key} % 7 = 0 THEN {text} END AS line"


_PARTS = ("(SELECT p_partkey AS key, p_brand AS brand, CASE WHEN p_size % 10 <> 0 THEN p_size END AS size FROM part)")

ORACLE: dict[str, str] = {
    "malformed_json": _cut("event_id", "'{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' "
                           "|| event_type || '\"}'", "event_id, user_id, event_type", 20) + " FROM events",
    "malformed_literals": _cut("key", "'{''key'': ' || key || ', u''brand'': u'", "key, brand, size", 12) + f" FROM {_PARTS}",
    "malformed_csv": _cut("custkey", "custkey || ',' || segment || ',none'", "custkey, segment, nation", None)
    + " FROM (SELECT c_custkey AS custkey, c_mktsegment AS segment, c_nationkey AS nation FROM customer)",
    "src_literals": f"SELECT key, brand, size FROM {_PARTS}",
    "src_csv_columns": "SELECT c_custkey, c_acctbal FROM customer",
    "src_stop_words": _with(DOC_TEXT[:2], "SELECT id, count(*) AS n_kept FROM toks GROUP BY id"),
    "sink_partitions": _with([REVIEWS, STATS], "SELECT asin, review_date, n, CAST(year(review_date) AS INTEGER) AS year FROM stats"),
    "tfidf_indexed": _with(DOC_TEXT, "SELECT id, term, tf, df, round(w, 6) AS w FROM wt"),
    "tfidf_norm_indexed": _with(DOC_TEXT + [_normalized("wn", "wt", zero=False)],
                                "SELECT id, term, round(w_norm, 6) AS w_norm FROM wn"),
    "item_median_sketch": _with([USERS_ITEMS], "SELECT item_id, count(*) AS n, quantile_disc(playtime_forever, 0.5) AS median "
                                "FROM ui GROUP BY item_id"),
    "user_index_grow": _with([
        "al AS (SELECT o_custkey AS user_id, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
        "old AS (SELECT user_id, count(*) AS n FROM al WHERE o_orderdate < DATE '1995-07-01' GROUP BY user_id)",
        "new AS (SELECT user_id, count(*) AS n FROM al WHERE user_id NOT IN (SELECT user_id FROM old) GROUP BY user_id)"],
        "SELECT user_id, n, CAST(row_number() OVER (ORDER BY batch, n DESC, CAST(user_id AS VARCHAR)) - 1 AS INTEGER) "
        "AS user_id_encoded FROM (SELECT 1 AS batch, * FROM old UNION ALL SELECT 2, * FROM new)"),
    "src_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "daily_reviews": _with([REVIEWS, STATS], "SELECT asin, review_date, n, avg_overall, "
                           "round(avg_overall, 2) AS avg_2 FROM stats"),
    "brand_filter": _with([META], "SELECT asin, brand FROM meta WHERE brand IS NOT NULL"),
    "daily_reviews_brand": _with([REVIEWS, META, STATS],
                                 "SELECT s.asin, s.review_date, s.n, s.avg_overall, m.brand FROM stats s "
                                 "JOIN meta m ON s.asin = m.asin WHERE m.brand IS NOT NULL"),
    "daily_reviews_top15": _with([REVIEWS, META, STATS],
                                 "SELECT s.asin, s.review_date, s.n, round(s.avg_overall, 2) AS avg, m.brand "
                                 "FROM stats s JOIN meta m ON s.asin = m.asin WHERE m.brand IS NOT NULL "
                                 "ORDER BY s.n DESC, s.asin, s.review_date, m.brand LIMIT 15"),
    "text_clean": _with([DOCS], f"SELECT id, regexp_replace(abstract, {_SPLIT}, ' ', 'g') AS clean "
                        "FROM docs WHERE abstract IS NOT NULL"),
    "tokenize": _with([DOCS, _tokens("toks", "docs", "id", "abstract", stop=False)],
                      "SELECT id, count(*) AS n_tokens, CAST(count_if(term = '') AS BIGINT) AS n_empty "
                      "FROM toks GROUP BY id"),
    "stopword_filter": _with(DOC_TEXT[:2], "SELECT id, count(*) AS n_kept FROM toks GROUP BY id"),
    "stopword_table": _with([DOCS, _tokens("alltoks", "docs", "id", "abstract", stop=False),
                             "words AS (SELECT term FROM alltoks GROUP BY term "
                             "HAVING 5 * count(DISTINCT id) >= (SELECT count(*) FROM docs))"],
                            "SELECT id, count(*) AS n_kept FROM alltoks WHERE term NOT IN (SELECT term FROM words) "
                            "GROUP BY id"),
    "term_freq": _with(DOC_TEXT[:3], "SELECT id, term, tf FROM tf"),
    "doc_freq": _with(DOC_TEXT[:4], "SELECT term, df FROM dfq"),
    "tfidf": _with(DOC_TEXT, "SELECT id, term, tf, df, round(w, 6) AS w FROM wt"),
    "tfidf_norm": _with(DOC_TEXT + [_normalized("wn", "wt", zero=False)],
                        "SELECT id, term, round(w_norm, 6) AS w_norm FROM wn"),
    "doc_vector": _with(DOC_TEXT + [_normalized("wn", "wt", zero=False),
                                    "voc AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS slot "
                                    "FROM (SELECT DISTINCT term FROM wt))"],
                        "SELECT wn.id, voc.slot, round(wn.w_norm, 6) AS w_norm FROM wn JOIN voc "
                        "ON wn.term = voc.term"),
    "title_term_freq": _with(PAGE_TEXT[:1] + PAGE_TEXT[4:6], "SELECT id, term, tf FROM ttf"),
    "title_tfidf": _with(PAGE_TEXT[:8], "SELECT id, term, tf, df, round(w, 6) AS w FROM tw"),
    "title_tfidf_norm": _with(PAGE_TEXT[:10], "SELECT id, term, round(w_norm, 6) AS w_norm FROM tn"),
    "title_match_scores": _with(PAGE_TEXT, "SELECT abstract_id, title_id, round(cos, 6) AS cos FROM scores "
                                "WHERE abstract_id % 50 = 0"),
    "title_match_top1": _with(PAGE_TEXT + [TOP1], "SELECT abstract_id, best_title_id, round(cos, 6) AS cos, "
                              "match FROM top"),
    "title_match_accuracy": _with(PAGE_TEXT + [TOP1],
                                  "SELECT 'accuracy' AS label, round(100.0::DOUBLE * CAST(sum(match) AS DOUBLE) "
                                  "/ CAST((SELECT count(*) FROM pg) AS DOUBLE), 6) AS value FROM top"),
    "category_tf": _with(_category("d.lang")[:4], "SELECT id AS category, term, tf FROM ctf"),
    "category_cosine": _with(_category("d.lang"),
                             "SELECT category_1, category_2, round(cos, 6) AS value FROM cc"),
    "category_cosine_source": _with(_category("d.source"),
                                    "SELECT category_1, category_2, round(cos, 6) AS value FROM cc"),
    "category_neighbours": _with(_category("d.source"),
                                 "SELECT category_1, category_2, round(cos, 6) AS value FROM cc "
                                 "WHERE category_1 < category_2 AND cos >= 0.9"),
    "category_neighbours_mixed": _with(_category("d.source || ' ' || d.lang"),
                                       "SELECT category_1, category_2, round(cos, 6) AS value FROM cc "
                                       "WHERE category_1 < category_2 AND cos >= 0.9"),
    "category_tiles": _with(_category("d.source") + [
        "num AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS at FROM (SELECT DISTINCT id FROM ctf))"],
        "SELECT r.at // 6 AS row_block, c.at // 6 AS col_block, r.id AS category_1, c.id AS category_2, "
        "coalesce(round(cos, 6), 0.0) AS value FROM num r CROSS JOIN num c "
        "LEFT JOIN cc ON category_1 = r.id AND category_2 = c.id"),
    "category_matrix": _with(_category("d.lang"),
                             "SELECT category_1, "
                             + ", ".join(f"coalesce(max(round(cos, 6)) FILTER (WHERE category_2 = '{c}'), 0.0) AS {c}"
                                         for c in ("de", "en", "es", "fr"))
                             + " FROM cc GROUP BY category_1"),
    "nested_explode": _with([USERS_ITEMS], "SELECT user_id, item_id, playtime_forever FROM ui"),
    "item_median": _with([USERS_ITEMS, MEDIAN], "SELECT item_id, median FROM med"),
    "playtime_rating": _with([USERS_ITEMS, MEDIAN, RATED],
                             "SELECT user_id, item_id, playtime_forever, median, rating FROM rated"),
    "user_distinct": _with([USERS_ITEMS], "SELECT DISTINCT user_id FROM ui"),
    "user_index": _with([USERS_ITEMS, INDEX], "SELECT user_id, n, user_id_encoded FROM idx"),
    "user_index_decode": _with([USERS_ITEMS, INDEX], "SELECT user_id_encoded, user_id FROM idx"),
    "sentiment_bucket": _with([USERS_ITEMS, SENT],
                              f"SELECT u.user_id, u.item_id, s.vader_score, {BUCKET} AS sentiment FROM ui u "
                              "LEFT JOIN sent s ON u.user_id = s.user_id AND u.item_id = s.item_id"),
    "fuse_sentiment": _with(FUSED_SENT, "SELECT user_id, item_id, rating, user_id_encoded, ratings FROM fs"),
    "recommend_flag": _with([USERS_ITEMS, REV],
                            f"SELECT u.user_id, u.item_id, {FLAG} AS recommended FROM ui u "
                            "LEFT JOIN rev v ON u.user_id = v.user_id AND u.item_id = v.item_id"),
    "fuse_recommend": _with(FUSED_REC, "SELECT user_id, item_id, rating, user_id_encoded, ratings FROM fr"),
    "ratings_project": _with(FUSED_REC, _project("ratings", "fr")),
    "ratings_project_sentiment": _with(FUSED_SENT, _project("ratings", "fs")),
    "ratings_project_implicit": _with(FUSED_REC[:5], _project("rating", "enc")),
    "train_test_split": ("SELECT CAST(o_custkey AS INTEGER) AS user, CAST(l_partkey AS INTEGER) AS item, "
                         "CAST(sum(l_quantity) AS FLOAT) AS rating, "
                         f"({_split('o_custkey', 'l_partkey')}) < 8 AS train "
                         "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey"),
    "als_predict_facts": _with(ALS_SPLIT, "SELECT CAST(user AS INTEGER) AS user, item_id, CAST(rating AS FLOAT) AS rating FROM seen"),
    "als_rmse_facts": _with(ALS_SPLIT, "SELECT 10 AS rank, count(*) AS n_test FROM seen"),
    "als_residual_facts": _with(ALS_SPLIT, "SELECT CAST(user % 10 AS INTEGER) AS block, count(DISTINCT user) AS n_users, "
                                "true AS solved FROM train GROUP BY 1"),
    "als_topn_facts": _with(ALS_SPLIT, "SELECT rank, CAST(u.user AS INTEGER) AS user, CAST(p.pos AS INTEGER) AS pos "
                            "FROM ranks, (SELECT DISTINCT user FROM train WHERE user < 8) u, "
                            "(SELECT unnest(range(1, 1 + least(10, count(DISTINCT item)))) AS pos FROM train) p"),
    "als_rank_sweep_facts": _with(ALS_SPLIT, "SELECT rank, count(*) AS n_test FROM ranks, seen GROUP BY rank"),
    "rmse_metric": ("SELECT round(sqrt(avg((l.l_quantity - m.prediction) * (l.l_quantity - m.prediction))), 6) "
                    "AS rmse FROM lineitem l JOIN (SELECT l_partkey, avg(l_quantity) AS prediction "
                    "FROM lineitem GROUP BY l_partkey) m ON l.l_partkey = m.l_partkey"),
}
