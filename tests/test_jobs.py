"""The command-line jobs end to end on small files in the original formats."""

import json

import pytest

from quill import jobs

from test_end_to_end import PAPERS


def _csv(spark, path, schema):
    return spark.read.option("header", True).schema(schema).csv(path).collect()


def test_review_board_job(spark, tmp_path):
    reviews = tmp_path / "reviews.json"
    reviews.write_text("\n".join(json.dumps({"asin": a, "reviewTime": t, "overall": o}) for a, t, o in [
        ("A", "01 1, 2020", 5.0), ("A", "01 1, 2020", 4.0), ("B", "01 2, 2020", 3.0)]) + "\n")
    meta = tmp_path / "meta.txt"
    meta.write_text("{'asin': 'A', 'brand': 'x'}\n{'asin': 'B', 'brand': None}\n")
    path = jobs.review_board(spark, str(reviews), str(meta), str(tmp_path / "out"))
    got = _csv(spark, path, "asin STRING, reviewTime STRING, n LONG, avg DOUBLE, brand STRING, pos INT")
    assert [(r.asin, r.n, r.avg, r.brand, r.pos) for r in got] == [("A", 2, 4.5, "x", 1)]


def test_text_jobs(spark, tmp_path):
    papers = tmp_path / "papers.json"
    papers.write_text("\n".join(json.dumps(p) for p in PAPERS) + "\n")
    stop = tmp_path / "stop.txt"
    stop.write_text("the\nwe\non\n")
    acc = _csv(spark, jobs.title_match(spark, str(papers), str(stop), str(tmp_path / "t")),
               "label STRING, value DOUBLE")
    assert acc[0].value == pytest.approx(100.0)
    m = _csv(spark, jobs.category_matrix(spark, str(papers), str(stop), str(tmp_path / "c")),
             "category_1 STRING, category_2 STRING, value DOUBLE")
    value = {(r.category_1, r.category_2): r.value for r in m}
    assert value["cs.DB", "cs.DB"] == pytest.approx(1.0)
    assert value.get(("cs.DB", "cs.IR")) == value.get(("cs.IR", "cs.DB"))


def test_ratings_and_recommend_jobs(spark, tmp_path, monkeypatch):
    users = tmp_path / "users.txt"
    lines = []
    for u in range(6):
        items = ", ".join("{'item_id': '%d', 'item_name': 'g', 'playtime_forever': %d, 'playtime_2weeks': 0}"
                          % (i, (u * 7 + i * 3) % 11) for i in range(5))
        lines.append("{'user_id': 'u%d', 'items_count': 5, 'items': [%s]}" % (u, items))
    users.write_text("\n".join(lines) + "\n")
    sent = tmp_path / "sentiments.csv"
    sent.write_text("_c0,user_id,item_id,review,textblob_score,sentiment_class,vader_score\n"
                    "0,u1,2,ok,0.1,pos,0.4\n1,u2,3,bad,-0.2,neg,-0.6\n")
    rev = tmp_path / "reviews.txt"
    rev.write_text("{'user_id': 'u0', 'reviews': [{'item_id': '1', 'recommend': True}]}\n")
    out = tmp_path / "ratings"
    scans = []
    decode = jobs.IO.read_python_literals
    monkeypatch.setattr(jobs.IO, "read_python_literals", lambda *a, **k: scans.append(a[1]) or decode(*a, **k))
    jobs.ratings(spark, str(users), str(sent), str(rev), str(out))
    fused = _csv(spark, str(out / "recommend_ratings"), jobs.FUSED)
    assert scans == [str(users), str(rev)]
    assert len(fused) == 30 and all(1 <= r.ratings <= 5 for r in fused)
    errors = _csv(spark, jobs.recommend(spark, str(out), str(tmp_path / "rec"), ranks=(2, 3), users=2, n=3),
                  "rank INT, n_test LONG, rmse DOUBLE")
    assert sorted(r["rank"] for r in errors) == [2, 3]
    recs = spark.read.option("header", True).csv(str(tmp_path / "rec" / "top_recommendations")).collect()
    assert {int(r["rank"]) for r in recs} == {2, 3} and len(recs) == 2 * 2 * 3


def test_main_parses_and_runs(spark, tmp_path):
    reviews = tmp_path / "reviews.json"
    reviews.write_text(json.dumps({"asin": "A", "reviewTime": "d", "overall": 3.0}) + "\n")
    meta = tmp_path / "meta.txt"
    meta.write_text("{'asin': 'A', 'brand': 'z'}\n")
    out = tmp_path / "out"
    jobs.main(["--checkpoint-dir", str(tmp_path / "ckpt"), "review-board", str(reviews), str(meta),
               str(out), "--k", "5"])
    got = _csv(spark, str(out / "top_reviews"), "asin STRING, reviewTime STRING, n LONG, avg DOUBLE, "
               "brand STRING, pos INT")
    assert [(r.asin, r.n, r.brand, r.pos) for r in got] == [("A", 1, "z", 1)]
