import pytest
from pyspark.sql import functions as F

from seamline.functions import model as fm
from seamline.operators import relational as rel


def test_surrogate_key_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    keys = [r.k for r in df.select(fm.surrogate_key("x", "y", "z").alias("k")).collect()]
    assert keys[0] != keys[1]


def test_latest_row_is_max_by_order(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 5, "a"), (1, "2021-01-01", 3, "b"), (1, "2021-01-01", 4, "c"),
                                (2, None, 1, "d"), (2, "2019-01-01", 0, "e")], "k int, d string, id int, v string")
    df = df.withColumn("d", F.col("d").cast("date"))
    got = {r.k: r.v for r in rel.latest_row(df, ["k"], [F.col("d"), F.col("id")]).collect()}
    assert got == {1: "c", 2: "e"}


def test_latest_ties_keeps_all_ties(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 4), (2, 1)], "k int, v int")
    got = sorted(tuple(r) for r in rel.latest_ties(df, [F.col("k")], [F.col("v")]).collect())
    assert got == [(1, 5), (1, 5), (2, 1)]


def test_latest_ties_of_null_keys_and_places(spark):
    df = spark.createDataFrame([(None, 5, 1), (None, 5, None), (None, 5, 1), (2, None, None), (3, None, 4), (3, 1, None)],
                               "k int, v int, w int")
    got = rel.latest_ties(df, [F.col("k")], [F.col("v"), F.col("w")])
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(tuple, got.collect()), key=str) == [(2, None, None), (3, 1, None), (None, 5, 1), (None, 5, 1)]


def test_route_branches_is_the_union_of_its_branches(spark):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("a bigint, b string, c date")
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None)], "n int, s string")
    branches = {"x": {"a": F.col("n")}, "y": {"b": F.col("s")}}
    out = rel.route_branches(df, F.col("s"), branches, schema)
    assert out.schema == schema
    parts = [df.filter(F.col("s") == r).select(*[v.alias(k) for k, v in b.items()]) for r, b in branches.items()]
    assert sorted(out.collect(), key=str) == sorted(rel.union_branches(parts, schema).collect(), key=str)


def test_value_map_takes_the_first_rule(spark):
    rules = (("is", "ab", "one"), ("prefix", "A", "two"), ("part", "Z", "three"), ("null", None, "four"))
    df = spark.createDataFrame([("ab",), ("abc",), ("xzx",), (None,), ("q",)], "v string")
    assert [r[0] for r in df.select(fm.value_map("v", rules)).collect()] == ["one", "two", "three", "four", "q"]


def test_theta_join_keeps_rows_without_partner(spark):
    from pyspark.sql import functions as F

    from seamline.operators import relational as rel

    left, right = spark.range(6).toDF("a"), spark.range(6).toDF("b")
    out = rel.theta_left_join(left, right, F.col("a") > F.col("b"))
    assert out.count() == 16 and out.filter("b is null").count() == 1


def test_union_branches_types(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    out = rel.union_branches([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")], schema)
    assert out.schema == schema
    assert sorted(out.collect(), key=str) == sorted([(1, None), (None, "x")], key=str)
