"""What is kept and added to: sketches, user codes, the bucketed index, partitioned sinks;
and input that is not what it should be."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.operators import index as IX
from quill.operators import ratings as RT
from quill.operators import text as TX
from quill.plans import catalogue as C
from quill.sources import files as IO
from quill.sources import literal_source as LS
from quill.sources import scratch

from conftest import rows

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ sketches
def test_merged_halves_stay_within_the_rank_error(spark):
    """An item with 100,000 rows beside small ones: halves sketched apart, then merged."""
    items = spark.range(100_000).select(F.lit(7).alias("item_id"), ((F.col("id") * 7919) % 100_003).cast("double").alias("playtime_forever"))
    items = items.unionByName(spark.range(50).select((F.col("id") % 5 + 10).cast("int").alias("item_id"), F.col("id").cast("double").alias("playtime_forever")))
    halves = [RT.value_sketches(items.where(F.xxhash64("playtime_forever") % 2 == i)) for i in (0, 1)] \
        + [RT.value_sketches(items.where(F.xxhash64("playtime_forever") % 2 == -1))]
    merged = RT.merge_sketches(halves[0].unionByName(halves[1]).unionByName(halves[2]))
    values = sorted((i * 7919) % 100_003 for i in range(100_000))
    got = {r.item_id: (r.n, r.median) for r in RT.sketch_median(merged).collect()}
    whole = {r.item_id: (r.n, r.median) for r in RT.sketch_median(RT.value_sketches(items)).collect()}
    for n, median in (got[7], whole[7]):
        at = sum(v < median for v in values)
        assert n == 100_000 and abs(at / n - 0.5) < 0.0133
    for item in range(10, 15):                          # kept exactly: the lower median of ten
        assert got[item] == whole[item] == (10, float(item - 10 + 20))


def test_sketch_of_a_hot_item_combines_map_side(spark):
    plan = RT.value_sketches(spark.range(10).select(F.lit(1).alias("item_id"), F.col("id").alias("playtime_forever")))
    assert "partial_kll_sketch_agg_double" in plan._jdf.queryExecution().executedPlan().toString()


def test_sketch_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 4.0), (2, None), (None, 3.0)], "item_id int, playtime_forever double")
    assert rows(RT.sketch_median(RT.value_sketches(df)).where("item_id is not null")) == [(1, 1, 4.0)]
    assert RT.merge_sketches(RT.value_sketches(df.where("false"))).count() == 0


# ------------------------------------------------------------------ user codes
def test_codes_stay_when_users_come(spark):
    first = spark.createDataFrame([("b",), ("b",), ("a",)], "user_id string")
    second = spark.createDataFrame([("a",), ("z",), ("c",), ("z",), ("d",)], "user_id string")
    old = RT.index_users(first)
    grown = RT.grow_index(old, second)
    assert {r.user_id: r.user_id_encoded for r in grown.collect()} == {"b": 0, "a": 1, "z": 2, "c": 3, "d": 4}
    assert rows(RT.grow_index(grown, second)) == rows(grown)    # nobody new
    assert rows(RT.grow_index(old.where("false"), second)) == rows(RT.index_users(second))


def test_unseen_users_fail_the_query(spark):
    index = RT.index_users(spark.createDataFrame([("a",)], "user_id string"))
    items = spark.createDataFrame([("a", 1), ("q", 2)], "user_id string, item_id int")
    with pytest.raises(PySparkException, match="user not in the index: q"):
        RT.encode_users(items, index).collect()
    assert rows(RT.encode_users(items.where("item_id = 1"), index)) == [("a", 1, 0)]
    assert [r.user_id_encoded for r in RT.encode_users(items, index, unseen="null").orderBy("item_id").collect()] == [0, None]
    assert RT.encode_users(items, index, unseen="drop").count() == 1
    with pytest.raises(PySparkException, match="user not in the index: null"):
        RT.encode_users(spark.createDataFrame([(None, 1)], "user_id string, item_id int"), index).collect()
    with pytest.raises(ValueError):
        RT.encode_users(items, index, unseen="ignore")


# ------------------------------------------------------------------ index
DOCS = [(i, " ".join(f"w{random.Random(i * 31 + k).randrange(40)}" for k in range(i % 9)) + (" common" if i % 3 else "")) for i in range(120)]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(DOCS, "id long, text string")
    built = IX.build_index(docs, stop=["w1"], buckets=6, hot=10)
    yield docs, built
    built.drop()


def test_index_equals_the_plain_weights_without_an_exchange(index):
    docs, built = index
    want = TX.tfidf_index(docs, "id", "text", stop=["w1"])
    got = built.normalized()
    near = lambda df: sorted((r.id, r.term, r.tf, r.df, round(r.w, 9), None if r.w_norm is None else round(r.w_norm, 9)) for r in df.collect())
    assert near(got) == near(want)
    for df in (got, built.reweighted()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    assert rows(built.reweighted(), "id", "term", "tf", "df") == rows(want, "id", "term", "tf", "df")


def test_hot_terms_are_dealt_over_buckets(index):
    _, built = index
    salts = {r.term: r.n for r in built.table("terms").groupBy("term").agg(F.count("*").alias("n")).collect()}
    hot = built.table("postings").where("term = 'common'").groupBy("salt").count().collect()
    assert salts["common"] == 8 and len(hot) > 4 and max(r["count"] for r in hot) < 30
    assert built.document_frequency().where("term = 'common'").first().df == 80


def test_query_side_and_other_corpus_size(spark, index):
    docs, built = index
    tf = spark.createDataFrame([(1, "w2", 1), (1, "common", 2), (2, "unknown", 1)], "id long, term string, tf long")
    got = {(r.id, r.term): r.w_norm for r in built.query_side(tf).collect()}
    want = TX.l2_normalize(TX.query_tfidf(tf, built.document_frequency(), TX.corpus_size(docs)), zero_norm="zero")
    assert got == pytest.approx({(r.id, r.term): r.w_norm for r in want.collect()}) and got[2, "unknown"] == 0
    twice = {(r.id, r.term): r.w for r in built.reweighted(2 * len(DOCS)).collect()}
    once = {(r.id, r.term): r.w for r in built.reweighted().collect()}
    assert twice.keys() == once.keys() and all(twice[k] > once[k] for k in once)


def test_index_of_an_empty_corpus(spark):
    built = IX.build_index(spark.createDataFrame([], "id long, text string"), buckets=2)
    assert built.normalized().count() == 0 and built.n_docs == 0
    built.drop()


# ------------------------------------------------------------------ malformed input
def _file(tmp_path, name, lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_malformed_json_goes_to_the_side_table(spark, tmp_path):
    path = _file(tmp_path, "x.json", ['{"a": 1, "b": "x"}', '{"a": 2', "", "no json", '{"a": "word", "b": "y"}', '{"b": "only"}'])
    good, bad = IO.split_malformed(IO.read_lenient(spark, path, "a INT, b STRING"))
    assert sorted(map(str, good.collect())) == sorted(["Row(a=1, b='x')", "Row(a=None, b='only')"])
    assert sorted(r.line for r in bad.collect()) == sorted(['{"a": 2', "no json", '{"a": "word", "b": "y"}'])
    assert good.columns == ["a", "b"]


def test_malformed_literals_and_csv(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    path = _file(tmp_path, "x.txt", ["{'a': 9007199254740993, 'b': u'\\xe9'}", "{'a': ", "[1]", "{'a': 'x'}", "{'b': None}"])
    good, bad = IO.split_malformed(IO.read_lenient(spark, path, schema, "literals"))
    assert sorted(map(tuple, good.collect()), key=str) == [(9007199254740993, "é"), (None, None)]
    assert sorted(r.line for r in bad.collect()) == ["[1]", "{'a': ", "{'a': 'x'}"]
    path = _file(tmp_path, "x.csv", ["a,b", '1,"x,y"', "word,z", "2,q,extra", "3,"])
    good, bad = IO.split_malformed(IO.read_lenient(spark, path, schema, "csv"))
    assert sorted(tuple(r) for r in good.fillna("").collect()) == [(1, "x,y"), (3, "")]
    assert sorted(r.line for r in bad.collect()) == ["2,q,extra", "word,z"]


def test_all_good_and_all_bad(spark, tmp_path):
    good, bad = IO.split_malformed(IO.read_lenient(spark, _file(tmp_path, "g.json", ['{"a": 1}']), "a INT"))
    assert (good.count(), bad.count()) == (1, 0)
    good, bad = IO.split_malformed(IO.read_lenient(spark, _file(tmp_path, "b.json", ["x"]), "a INT"))
    assert (good.count(), bad.count()) == (0, 1)


# ------------------------------------------------------------------ data source
LINES = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType()),
                      T.StructField("tags", T.ArrayType(T.IntegerType()))])


@pytest.mark.parametrize("split", [1, 7, 100, 1 << 20])
def test_data_source_reads_every_line_once(spark, tmp_path, split):
    (tmp_path / "in").mkdir()
    for k in range(3):
        _file(tmp_path / "in", f"part{k}", ["" if i % 11 == 3 else f"{{'key': {100 * k + i}, 'name': u'n\\xfc {i}', 'tags': [{i}, None], 'x': 1.5}}" for i in range(40)])
    _file(tmp_path / "in", "_SUCCESS", ["not a literal"])
    LS.register(spark)
    path = str(tmp_path / "in")
    got = spark.read.format(LS.FORMAT).schema(LINES).option("splitBytes", split).load(path) if split > 1 else \
        spark.read.format(LS.FORMAT).schema(LINES).option("splitBytes", 40).load(f"{path}/part1")
    want = IO.read_python_literals(spark, path if split > 1 else f"{path}/part1", LINES)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    pruned = spark.read.format(LS.FORMAT).schema("name STRING").load(path)
    assert pruned.columns == ["name"] and pruned.count() == 3 * len([i for i in range(40) if i % 11 != 3])


def test_ranges_cut_files_without_losing_lines(tmp_path):
    path = _file(tmp_path, "lines", [f"{{'key': {i}}}" for i in range(30)])
    for split in (1, 2, 9, 13, 10_000):
        reader = LS.LiteralReader(LINES, {"path": path, "splitBytes": split})
        parts = reader.partitions()
        assert sum(p.end - p.start for p in parts) == (tmp_path / "lines").stat().st_size
        assert [line for p in parts for line in reader._lines(p)] == [f"{{'key': {i}}}" for i in range(30)]


def test_data_source_modes(spark, tmp_path):
    path = _file(tmp_path, "bad", ["{'key': 1}", "{'key'"])
    LS.register(spark)
    with pytest.raises(PySparkException):
        spark.read.format(LS.FORMAT).schema(LINES).load(path).collect()
    lenient = spark.read.format(LS.FORMAT).schema(LINES).option("mode", "PERMISSIVE").load(path)
    assert sorted((r.key for r in lenient.collect()), key=str) == [1, None]
    with pytest.raises(PySparkException):
        spark.read.format(LS.FORMAT).schema(LINES).load(str(tmp_path / "missing")).collect()


# ------------------------------------------------------------------ sinks
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_partitions_are_replaced_not_added(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    day = lambda d, n: spark.range(n).select(F.lit(d).alias("day"), "id")
    IO.write_partitions(day("a", 5).unionByName(day("b", 4)), path, ["day"], fmt)
    IO.write_partitions(day("b", 2).unionByName(day("c", 1)), path, ["day"], fmt)
    IO.write_partitions(day("b", 2), path, ["day"], fmt)
    got = spark.read.option("header", True).format(fmt).load(path)
    assert {r.day: r["count"] for r in got.groupBy("day").count().collect()} == {"a": 5, "b": 2, "c": 1}


def test_scratch_is_cleared(spark):
    from pathlib import Path
    before = {k: list(v) for k, v in scratch._made.items()}
    scratch._made[spark.sparkContext.applicationId] = []
    kept = scratch.written(spark.range(3))
    path = scratch._made[spark.sparkContext.applicationId][0].removeprefix("file:")
    assert Path(path).is_dir() and kept.count() == 3
    assert scratch.clear(spark) == 1 and not Path(path).exists()
    assert scratch.clear(spark) == 0
    scratch._made.update(before)


def test_queries_count_good_and_bad(spark):
    for query, table, key in ((C.malformed_json, "events", "event_id"), (C.malformed_literals, "part", "p_partkey"), (C.malformed_csv, "customer", "c_custkey")):
        keys = [r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()]
        got = query(spark, SF)
        assert got.where("line is not null").count() == sum(k % 7 == 0 for k in keys)
        assert got.where("line is null").count() == sum(k % 7 != 0 for k in keys)
