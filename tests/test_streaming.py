import tempfile

from conftest import rows
from taxaspark.streaming.flags import flag_stream, start_to_parquet

SCHEMA = ("uid long, acceptedNameAuthor string, decimalLatitude double, decimalLongitude double, "
          "coordinateUncertaintyInMeters double")


def test_stream_flags_equal_batch(spark):
    data = [(1, "a", 0.0, 5.0, 10.0), (2, "a", 12.0, 12.0, 10.0), (3, "b", 12.0, 10.0, 200000.0),
            (4, "b", None, None, None), (5, "c", 3.0, 4.0, None), (6, "z", 3.0, 4.0, 1.0)]
    batch = spark.createDataFrame(data, SCHEMA)
    src = tempfile.mkdtemp(prefix="taxaspark-src-")
    out = tempfile.mkdtemp(prefix="taxaspark-out-")
    ck = tempfile.mkdtemp(prefix="taxaspark-ck-")
    batch.write.mode("overwrite").parquet(src)
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "acceptedNameAuthor string")
    stream = spark.readStream.schema(batch.schema).parquet(src)
    q = start_to_parquet(flag_stream(stream, species=wanted), out, ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    expect = flag_stream(batch, species=wanted)   # the same function on the batch frame
    assert rows(got, "uid") == [(4,), (5,)]
    assert rows(got) == rows(expect.select(*got.columns))


def test_stream_centroid_flag_equals_batch(spark):
    from taxaspark.operators import geo as G
    import random
    rnd = random.Random(4)
    cents = spark.createDataFrame([(10.0, 20.0), (-45.0, 179.9), (89.9, 0.0)], "lat double, lon double")
    pts = [(i, rnd.choice([10.0, -45.0, 89.95, 30.0]) + rnd.uniform(-0.05, 0.05),
            rnd.choice([20.0, -179.95, 100.0]) + rnd.uniform(-0.05, 0.05), 10.0) for i in range(400)]
    pts += [(1000, None, 1.0, 1.0)]
    batch = spark.createDataFrame(pts, "uid long, decimalLatitude double, decimalLongitude double, "
                                       "coordinateUncertaintyInMeters double")
    src = tempfile.mkdtemp(prefix="taxaspark-src-")
    out = tempfile.mkdtemp(prefix="taxaspark-out-")
    ck = tempfile.mkdtemp(prefix="taxaspark-ck-")
    batch.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    q = start_to_parquet(flag_stream(stream, points=cents, radius_m=20000.0, gate=False), out, ck)
    q.awaitTermination(120)
    got = dict(spark.read.parquet(out).select("uid", "clean_tests").collect())
    want = dict(G.flag_near_points(batch, "decimalLatitude", "decimalLongitude", cents, radius_m=20000.0)
                .select("uid", "clean_tests").collect())
    assert got == want and list(want.values()).count(False) > 50


def test_first_per_key_over_restarts_equals_batch(spark):
    """Five files, two runs; the second run's first batch fails once after it has written some buckets."""
    import random

    import pytest

    from taxaspark.operators.dedup import first_per_key
    from taxaspark.streaming import dedup
    rnd = random.Random(8)
    data = [(rnd.choice(["hot", *(f"k{i}" for i in range(40)), None]), i, float(rnd.randrange(100))) for i in range(600)]
    schema = "k string, uid long, v double"
    src, out, ck = (tempfile.mkdtemp(prefix=f"taxaspark-{x}-") for x in ("src", "out", "ck"))
    order = ["v", "uid"]

    def feed(rows_, name):
        spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(f"{src}/{name}")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(src)
        q = dedup.first_per_key_stream(stream, ["k"], order, out, ck, buckets=3)
        q.awaitTermination(180)
        return q

    feed(data[:200], "a")
    feed(data[200:300], "b")
    run()
    kind = spark.createDataFrame([], schema).schema
    assert rows(dedup.survivors(spark, out, kind)) == rows(first_per_key(spark.createDataFrame(data[:300], schema), ["k"], order))
    feed(data[300:450], "c")
    feed(data[450:], "d")
    real, calls = dedup._read, []

    def fails(*a):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a)

    dedup._read = fails
    with pytest.raises(Exception, match="lost"):
        run()
    dedup._read = real
    run()
    assert rows(dedup.survivors(spark, out, kind)) == rows(first_per_key(spark.createDataFrame(data, schema), ["k"], order))
    assert max(len(v) for v in dedup._versions(spark, out).values()) <= 2
    assert dedup.survivors(spark, out + "/none", kind).count() == 0
