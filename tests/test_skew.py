"""One key holds a third of all rows: results stay exact and the plans combine before the shuffle."""

import random
from decimal import ROUND_HALF_UP, Decimal
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from taxaspark.operators import dedup as D
from taxaspark.plans import predictors as P
from taxaspark.session import scale_conf

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    data = []
    for i in range(N):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 2000)}"
        data.append((i, k, rnd.randint(1900, 2020), rnd.choice([None, "L1", "L2", "L3"]),
                     rnd.choice([None, round(rnd.uniform(-1, 1), 4)])))
    df = spark.createDataFrame(data, "id long, k string, y int, loc string, lat double").repartition(8)
    return data, df


def test_keep_unique_and_first_per_key(spark, skewed):
    data, df = skewed
    cnt = Counter(k for _, k, *_ in data)
    assert rows(D.keep_unique(df, ["k"]), "id") == sorted((i,) for i, k, *_ in data if cnt[k] == 1)
    first = {}
    for i, k, *_ in data:
        first.setdefault(k, i)
    assert rows(D.first_per_key(df, ["k"], ["id"]), "id") == sorted((i,) for i in first.values())


def test_group_min_on_hot_key(spark, skewed):
    data, df = skewed
    mins = defaultdict(lambda: 10**9)
    for _, k, y, *_ in data:
        mins[k] = min(mins[k], y)
    want = sorted((i,) for i, k, y, *_ in data if y == mins[k])
    assert rows(D.keep_group_min(df, ["k"], "y"), "id") == want


def test_specimen_count_on_hot_species(spark, skewed):
    data, df = skewed
    occ = df.select(F.col("k").alias("acceptedNameAuthor"), "loc", "lat", "id").select(
        "acceptedNameAuthor", F.col("loc").alias("locality"), F.col("lat").alias("decimalLatitude"),
        F.col("lat").alias("decimalLongitude"), F.col("lat").isNotNull().alias("georeferenced"))
    got = dict(P.specimen_count(occ).collect())
    want = defaultdict(set)
    for i, k, y, loc, lat in data:
        if lat is not None:
            want[k].add(("g", Decimal(repr(lat)).quantize(Decimal("0.001"), ROUND_HALF_UP)))
        elif loc is not None:
            want[k].add(("l", loc))
        else:
            want[k].add(("r", i))
    assert got == {k: len(v) for k, v in want.items()}


def test_scale_conf_sizes():
    conf = scale_conf(100e12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 186264
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(scale_conf(1e9, 64)["spark.sql.shuffle.partitions"]) == 128
