import random

from pyspark.sql import functions as F

from conftest import rows
from taxaspark.operators import dedup as D


def test_keep_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(D.keep_unique(df, ["k"])) == [(None, 4), ("b", 3)]


def test_first_per_key_order_and_repartition(spark):
    data = [(random.Random(i).randint(0, 20), i, f"v{i}") for i in range(500)]
    df = spark.createDataFrame(data, "k int, o int, v string")
    want = {}
    for k, o, v in sorted(data, key=lambda t: t[1]):
        want.setdefault(k, (k, o, v))
    got = rows(D.first_per_key(df, ["k"], ["o"]))
    assert got == sorted(want.values())
    assert rows(D.first_per_key(df.repartition(7, "v"), ["k"], ["o"])) == got


def test_first_per_key_earlier_file_wins(spark):
    df = spark.createDataFrame([(1, 1, "US file"), (1, 0, "CA file")], "id long, file int, src string")
    assert rows(D.first_per_key(df, ["id"], ["file"]), "src") == [("CA file",)]


def test_group_min_ties_and_nulls(spark):
    df = spark.createDataFrame([("g", 1900, 1), ("g", 1900, 2), ("g", 1950, 3), ("g", None, 4),
                                ("h", None, 5), ("h", None, 6)], "k string, y int, id int")
    assert rows(D.keep_group_min(df, ["k"], "y"), "id") == [(1,), (2,)]


def test_top_with_ties(spark):
    df = spark.createDataFrame([("s", 100, "k1"), ("s", 100, "k2"), ("s", 90, "k3"), ("t", None, "k4")],
                               "k string, c int, key string")
    assert rows(D.top_with_ties(df, ["k"], "c"), "key") == [("k1",), ("k2",), ("k4",)]


def test_two_stage_dedup_depends_on_survivors(spark):
    # stage 1 keeps id 1 for (sp, loc, 2000); stage 2 then dedups (sp, lat, lon, year)
    df = spark.createDataFrame([(1, "sp", "L", 2000, 1.0), (2, "sp", "L", 2000, 2.0), (3, "sp", "M", 2000, 1.0)],
                               "id int, s string, loc string, y int, lat double")
    out = D.two_stage_dedup(df, ["s", "loc", "y"], ["s", "lat", "y"], ["id"])
    assert rows(out, "id") == [(1,)]


def test_grid_dedup(spark):
    df = spark.createDataFrame([(1, "sp", 45.12341, -69.0), (2, "sp", 45.12342, -69.0), (3, "sp", 45.1236, -69.0)],
                               "id int, s string, lat double, lon double")
    out = D.grid_dedup(df, ["s"], "lat", "lon", 3, ["id"])
    assert rows(out, "id") == [(1,), (3,)]


def test_keep_unique_hot_key_plan_is_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = D.keep_unique(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
