import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import rows
from taxaspark.operators import frames as FR
from taxaspark.operators import joins as J
from taxaspark.session import clear_staged, staged


def test_drop_strict_rejects_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert FR.drop_strict(df, ["a"]).columns == ["b"]
    with pytest.raises(FR.SchemaError):
        FR.drop_strict(df, ["a", "zzz"])


def test_rename_shift_is_simultaneous(spark):
    df = spark.createDataFrame([("n", "s")], "scientificName string, species string")
    a = FR.rename(df, {"scientificName": "NameAuthor", "species": "scientificName"})
    b = FR.rename(df, {"species": "scientificName", "scientificName": "NameAuthor"})
    assert a.columns == b.columns == ["NameAuthor", "scientificName"]
    assert a.collect()[0] == b.collect()[0] == ("n", "s")


def test_conform_adds_typed_nulls(spark):
    tpl = StructType([StructField("k", StringType()), StructField("v", IntegerType())])
    out = FR.conform(spark.createDataFrame([("a", 9)], "k string, extra long"), tpl)
    assert out.schema == tpl and out.collect()[0] == ("a", None)


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2, 3.5)], "k int, d double")
    u = FR.union_missing(a, b)
    assert rows(u, "k", "s", "d") == [(1, "x", None), (2, None, 3.5)]
    with pytest.raises(FR.SchemaError):
        FR.union_strict(a, b)
    with pytest.raises(FR.SchemaError):
        FR.union_missing(a, spark.createDataFrame([(1,)], "s int"))


def test_except_rows_dedups(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    b = spark.createDataFrame([("y",)], "v string")
    assert rows(FR.except_rows(a, b)) == [("x",)]


def test_round_numeric_only_fractional(spark):
    df = spark.createDataFrame([(7, 1.23456, "t")], "i int, d double, s string")
    out = FR.round_numeric(df, 3)
    assert out.collect()[0] == (7, 1.235, "t") and out.schema == df.schema


def test_null_safe_semi_anti(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    s1 = spark.createDataFrame([("a",)], "k string")
    s2 = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(J.anti_join(df, s1, "k")) == [(None,), ("b",)]
    assert rows(J.anti_join(df, s2, "k")) == [("b",)]
    assert rows(J.semi_join(df, s2, "k")) == [(None,), ("a",)]


def test_join_on_keys_and_suffix(spark):
    left = spark.createDataFrame([(1, "l1"), (None, "l2"), (3, "l3")], "k int, v string")
    right = spark.createDataFrame([(1, "r1"), (None, "r2"), (4, "r4")], "rk int, v string")
    inner = J.join_suffixed(left, right, {"k": "rk"}, "inner", ("", ".y"))
    assert inner.columns == ["k", "v", "v.y"]
    assert rows(inner) == [(None, "l2", "r2"), (1, "l1", "r1")]
    right_j = J.join_on(left.select("k"), right, {"k": "rk"}, "right")
    assert rows(right_j) == [(None, "r2"), (1, "r1"), (4, "r4")]
    plain = J.join_on(left, right.withColumnRenamed("v", "w"), {"k": "rk"}, "inner", null_safe=False)
    assert rows(plain) == [(1, "l1", "r1")]


def test_semi_join_either_is_equi_join(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "k int")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (7,)], "y int")
    out = J.semi_join_either(df, "k", [(a, "x"), (b, "y")])
    assert rows(out) == [(1,), (2,), (7,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_exclusions(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3758416,)], "id long")
    assert rows(J.exclude_values(df, "id", [3758416])) == [(None,), (1,), (2,)]
    bad = spark.createDataFrame([(2,), (None,)], "id long")
    out = J.exclude_keys(df, "id", bad)
    assert rows(out) == [(1,), (3758416,)]
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_full_join_and_map_columns(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n")], "k int, x string")
    b = spark.createDataFrame([(2, "b"), (None, "m")], "k int, y string")
    full = J.join_on(a, b, "k", "full")
    assert rows(full) == [(None, "n", "m"), (1, "a", None), (2, None, "b")]
    df = spark.createDataFrame([(1.5, 2, "s")], "d double, i int, s string")
    from pyspark.sql.types import StringType
    up = FR.map_columns(df, StringType, F.upper)
    assert up.collect()[0] == (1.5, 2, "S") and up.schema == df.schema


def test_exclude_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    bad = spark.createDataFrame([(2,)], "id long")
    assert rows(J.exclude_keys(df, "id", bad)) == [(None,), (1,)]


def test_rounding_keeps_types_and_large_values(spark):
    from pyspark.sql.types import DecimalType
    df = spark.createDataFrame([(1e26, 0.0005), (float("inf"), -0.0005), (-1e300, 1.2345), (None, float("nan"))], "a double, b double")
    got = FR.round_numeric(df, 3).collect()
    assert [r.a for r in got] == [1e26, float("inf"), -1e300, None]
    assert [r.b for r in got][:3] == [0.001, -0.001, 1.235] and got[3].b != got[3].b
    typed = df.select(F.lit(1.23456).cast("float").alias("f"), F.lit("2.34567").cast(DecimalType(10, 5)).alias("d"), F.lit(7).alias("i"))
    assert FR.round_numeric(typed, 3).dtypes == typed.dtypes
    assert float(FR.round_numeric(typed, 3).first()["d"]) == 2.346


def _wide(spark, n, copies):
    """``n`` rows of 60 columns, the first ``copies`` of them twice; nulls, -0.0 and NaN among them."""
    cols = [F.when((F.col("id") + i) % 7 != 0, F.concat(F.lit(f"value {i} "), (F.col("id") % (i + 3)).cast("string"))).alias(f"c{i}") for i in range(56)]
    more = [F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("z"),
            F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).alias("nan"), (F.col("id") % 3 == 0).alias("b")]
    ids = spark.range(n).union(spark.range(copies))
    return ids.select(*more, *cols)


def test_wide_rows_are_compared_by_prints(spark):
    a = _wide(spark, 3000, 40)
    flipped = a.withColumn("z", -F.col("z"))        # equal rows: 0.0 is -0.0
    got = FR.union_distinct(a, flipped.where("k < 10"))
    assert got.columns == a.columns and got.count() == 3000 == got.select("k").distinct().count()
    b = _wide(spark, 100, 0).withColumn("c5", F.lit("other")).where("k > 50").unionByName(_wide(spark, 30, 30))
    left = FR.except_rows(a, b)
    assert sorted(r["k"] for r in left.select("k").collect()) == list(range(30, 3000))
    unlike = a.withColumn("k", F.col("k") + 0.5)     # another type: 0.5 is no 0
    assert FR.except_rows(a, unlike).count() == 3000
    assert FR.except_rows(a, a).count() == 0 and FR.union_distinct(a.limit(0)).count() == 0


def test_wide_rows_alone_are_not_shuffled(spark):
    """Rows whose print is their own pass where they lie: what is exchanged whole are the doubtful ones."""
    a = _wide(spark, 3000, 40)
    path = tempfile.mkdtemp(prefix="taxaspark-wide-") + "/t"
    a.write.parquet(path)
    df = FR.distinct_rows(spark.read.parquet(path))
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_rows_whose_prints_collide_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(FR, "row_print", lambda df: [F.lit(1).cast("long").alias("__print_a__"), F.lit(2).cast("long").alias("__print_b__")])
    a = _wide(spark, 50, 5)
    assert FR.distinct_rows(a).count() == 50
    assert FR.except_rows(a, _wide(spark, 20, 0)).count() == 30


def test_staged_tables_are_removed(spark):
    import os
    clear_staged(spark)
    df = staged(spark.range(5).toDF("x"), "probe")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 5 and os.path.isdir(folder)
    assert clear_staged(spark) == 1 and not os.path.exists(folder) and clear_staged(spark) == 0
