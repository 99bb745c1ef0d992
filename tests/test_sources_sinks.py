"""Round trips through the file sources and sinks, in a temporary folder."""

import pytest
from pyspark.sql import types as T

from quill.sources import files as IO

from conftest import rows

PAPER = "id STRING, title STRING, abstract STRING, categories STRING"


def test_json_lines_missing_fields_and_failfast(spark, tmp_path):
    p = tmp_path / "papers.jsonl"
    p.write_text('{"id": "1", "title": "T", "abstract": "A b", "categories": "cs.AI", "x": 1}\n'
                 '{"id": "2", "abstract": "only"}\n')
    got = rows(IO.read_json_lines(spark, str(p), PAPER))
    assert got == [("1", "T", "A b", "cs.AI"), ("2", None, "only", None)]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id": "1"}\n{not json\n')
    with pytest.raises(Exception):
        IO.read_json_lines(spark, str(bad), PAPER).collect()
    permissive = IO.read_json_lines(spark, str(bad), PAPER, mode="PERMISSIVE").collect()
    assert len(permissive) == 2


USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("items_count", T.IntegerType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("playtime_forever", T.DoubleType()),
    ]))),
])


def test_python_literal_lines(spark, tmp_path):
    p = tmp_path / "users.txt"
    p.write_text(
        "{'user_id': u'caf\\xe9', 'items_count': 2, 'items': [{'item_id': '10', 'item_name': \"Bob's Game\", "
        "'playtime_forever': 6}, {'item_id': 11, 'item_name': None, 'playtime_forever': 0}]}\n"
        "\n"
        "{'user_id': 'b', 'items_count': 0, 'items': [], 'flag': True}\n",
        encoding="utf-8")
    got = IO.read_python_literals(spark, str(p), USERS).collect()
    assert len(got) == 2
    a = [r for r in got if r.user_id != "b"][0]
    assert a.user_id == "café" and a.items_count == 2
    assert [(i.item_id, i.item_name, i.playtime_forever) for i in a["items"]] == [
        ("10", "Bob's Game", 6.0), ("11", None, 0.0)]


def test_python_literal_booleans_as_strings_and_bools(spark, tmp_path):
    schema = T.StructType([T.StructField("user_id", T.StringType()),
                           T.StructField("reviews", T.ArrayType(T.StructType([
                               T.StructField("item_id", T.StringType()),
                               T.StructField("recommend", T.BooleanType())])))])
    p = tmp_path / "reviews.txt"
    p.write_text("{'user_id': 'u', 'reviews': [{'item_id': '1', 'recommend': True}, "
                 "{'item_id': '2', 'recommend': 'false'}, {'item_id': '3'}]}\n")
    r = IO.read_python_literals(spark, str(p), schema).collect()[0]
    assert [(x.item_id, x.recommend) for x in r.reviews] == [("1", True), ("2", False), ("3", None)]


def test_python_literal_malformed_line(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_text("{'user_id': 'u'}\n{'user_id': \n")
    with pytest.raises(Exception):
        IO.read_python_literals(spark, str(p), USERS).collect()
    got = IO.read_python_literals(spark, str(p), USERS, mode="PERMISSIVE").collect()
    assert sorted((r.user_id or "") for r in got) == ["", "u"]


def test_csv_quoted_comma_and_header(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text('user_id,item_id,review,vader_score\nu1,10,"good, really",0.5\nu2,11,bad,-0.25\n')
    df = IO.read_csv_typed(spark, str(p), "user_id STRING, item_id STRING, review STRING, vader_score DOUBLE")
    assert rows(df) == [("u1", "10", "good, really", 0.5), ("u2", "11", "bad", -0.25)]


def test_stop_words_file(spark, tmp_path):
    p = tmp_path / "stop.txt"
    p.write_text("the\nand \nOf\n")
    assert rows(IO.read_stop_words(spark, str(p))) == [("Of",), ("and ",), ("the",)]


def test_write_result_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(10, 1, 5, 0.9), (10, 1, 6, 0.8), (20, 2, 7, 0.7)],
                               "rank int, user int, item int, score double")
    out = str(tmp_path / "recs")
    IO.write_result(df, out, fmt="csv", partition_by=["rank"])
    back = spark.read.option("header", True).schema("user int, item int, score double, rank int").csv(out)
    assert rows(back, "rank", "user", "item", "score") == rows(df)
    single = str(tmp_path / "metric")
    IO.write_result(df.limit(1), single, fmt="parquet", single_file=True)
    assert spark.read.parquet(single).count() == 1


def test_fused_ratings_csv_hand_over(spark, tmp_path):
    """K3 then S5: fused ratings written as header-less CSV and read back by
    position give the same ALS triples as the in-memory DataFrame."""
    from quill.operators import recommend as RC
    from quill.plans import catalogue as C
    fused = C.fuse_recommend(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "recommended_ratings")
    IO.write_result(fused, out, fmt="csv", header=False)
    back = IO.read_csv_typed(spark, out, "user_id BIGINT, item_id BIGINT, rating INT, user_id_encoded INT, "
                             "ratings INT", header=False)
    got = rows(RC.as_triples(back, "user_id_encoded", "item_id", "ratings"))
    assert got == rows(RC.as_triples(fused, "user_id_encoded", "item_id", "ratings"))
    assert len(got) == fused.count()


def test_csv_columns_by_header_name(spark, tmp_path):
    p = tmp_path / "sent.csv"
    p.write_text('vader_score,review,item_id,user_id\n0.5,"fine, thanks",10,u1\n-0.25,bad,11,u2\n')
    df = IO.read_csv_columns(spark, str(p), {"user_id": "string", "item_id": "string", "vader_score": "double"})
    assert df.columns == ["user_id", "item_id", "vader_score"]
    assert rows(df) == [("u1", "10", 0.5), ("u2", "11", -0.25)]


def test_python_literals_keep_64_bit_integers(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text("{'a': 1152921504606846977}\n{'a': None}\n{'a': 3, 'b': [1, None, 9007199254740993]}\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.ArrayType(T.LongType()))])
    got = [tuple(r) for r in IO.read_python_literals(spark, str(p), schema).collect()]
    assert got == [(1152921504606846977, None), (None, None), (3, [1, None, 9007199254740993])]
