from pyspark.sql import functions as F

from conftest import rows
from taxaspark.functions import nulls as N
from taxaspark.functions import text as X
from taxaspark.functions.numeric import round_half_up


def test_not_in_list_keeps_null(spark):
    df = spark.createDataFrame([("US",), ("CA",), ("MX",), (None,)], "c string")
    assert rows(df.filter(N.not_member("c", ["US", "CA"]))) == [(None,), ("MX",)]
    # NULL is a member only when listed
    assert rows(df.filter(N.is_member("c", ["MX", None]))) == [(None,), ("MX",)]


def test_inequality_drops_null(spark):
    df = spark.createDataFrame([("PRESENT",), ("ABSENT",), (None,)], "s string")
    assert rows(df.filter(F.col("s") != "ABSENT")) == [("PRESENT",)]


def test_regex_exclude_keeps_null(spark):
    df = spark.createDataFrame([("Amanita var. x",), ("Amanita muscaria",), (None,)], "n string")
    assert rows(df.filter(N.not_matches("n", r"\."))) == [(None,), ("Amanita muscaria",)]


def test_guarded_name_and_paste(spark):
    df = spark.createDataFrame([("A b", None), ("A b", "Fr."), (None, "L.")], "n string, a string")
    out = rows(df.select(N.paste_guarded("n", "a").alias("x"), N.paste("n", "a").alias("p")))
    assert out == [("A b", "A b NA"), ("A b Fr.", "A b Fr."), ("NA L.", "NA L.")]


def test_ifelse_null_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    out = rows(df.select("v", N.ifelse(F.col("v") > 2, "big", "small").alias("k")))
    assert out == [(None, None), (1, "small"), (5, "big")]


def test_initials_and_override(spark):
    df = spark.createDataFrame([("Voitk & J.I.Kim",), ("A.H.Sm.",), ("X y",)], "n string")
    out = rows(df.select(X.space_initials("n")))
    assert out == [("A.H. Sm.",), ("Voitk & J.I. Kim",), ("X y",)]
    fixed = df.select(X.override("n", {"X y": "Z"}, X.space_initials("n")).alias("m"))
    assert ("Z",) in rows(fixed)


def test_first_word_unicode_and_count(spark):
    df = spark.createDataFrame([("Éab cd",), ("   ",), (None,), ("Amanita muscaria var. alba",)], "n string")
    out = rows(df.select("n", X.first_word("n").alias("g"), X.word_count("n").alias("w")))
    assert out == [(None, None, None), ("   ", None, 0), ("Amanita muscaria var. alba", "Amanita", 4),
                   ("Éab cd", "Éab", 2)]


def test_country_map_and_tagged_id(spark):
    df = spark.createDataFrame([("USA", None), ("canada", None), ("Mexico", None), (None, None), ("x", "FR")],
                               "country string, code string")
    groups = {"CA": ["Canada", "canada", "CANADA"], "US": ["United States", "USA", "usa"]}
    out = rows(df.select("country", X.code_map("country", groups, existing="code").alias("c")))
    assert out == [(None, None), ("Mexico", None), ("USA", "US"), ("canada", "CA"), ("x", "FR")]
    ids = spark.createDataFrame([(5, None), (None, 100000)], "id long, g long")
    assert rows(ids.select(X.combined_id("id", "g", "m", "g"))) == [("100000g",), ("5m",)]


def test_lenient_cast_and_rounding(spark):
    df = spark.createDataFrame([("12",), ("1e3",), ("abc",), (None,)], "s string")
    assert rows(df.select(X.lenient_double("s"))) == [(None,), (None,), (12.0,), (1000.0,)]
    nums = spark.createDataFrame([(0.0625,), (1.0005,), (0.0005,), (-2.5,)], "x double")
    assert rows(nums.select(round_half_up("x", 3))) == [(-2.5,), (0.001,), (0.063,), (1.001,)]
