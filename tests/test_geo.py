import math
import random

from pyspark.sql import functions as F

from conftest import rows
from taxaspark.operators import geo as G
from taxaspark.plans.locality import fill_by_locality


def test_zero_equal_uncertainty(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0, 99999.0), (2, 12.0, 12.0, 100000.0), (3, 12.0, 10.0, None),
                                (4, None, 5.0, 1.0)], "id int, lat double, lon double, unc double")
    out = G.flag_uncertainty(G.flag_equal(G.flag_zero(df, "lat", "lon"), "lat", "lon"), "unc")
    assert rows(out, "id", "cc_zero", "cc_equ", "cc_err") == [
        (1, False, True, True), (2, True, False, False), (3, True, True, None), (4, None, None, True)]


def test_quality_gate_precedence(spark):
    df = spark.createDataFrame([(1, True, None, False, True, True), (2, True, True, False, True, True),
                                (3, False, None, None, None, None)],
                               "id int, georeferenced boolean, cc_err boolean, cc_zero boolean, cc_equ boolean, clean_tests boolean")
    assert rows(G.quality_gate(df), "id") == [(1,), (3,)]


def _haversine(a, b, c, d, r=G.EARTH_RADIUS_M):
    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * r * math.asin(min(1.0, math.sqrt(h)))


def test_near_points_cells_equal_brute_force(spark):
    rnd = random.Random(3)
    cents = [(rnd.uniform(-89.99, 89.99), rnd.uniform(-180, 180)) for _ in range(40)]
    cents += [(89.9, 10.0), (-89.95, -170.0), (0.0, 179.95), (10.0, -179.99)]
    pts = []
    for i in range(3000):
        if i % 3 == 0:
            la, lo = cents[rnd.randrange(len(cents))]
            la = max(-90.0, min(90.0, la + rnd.uniform(-0.6, 0.6)))
            lo = ((lo + rnd.uniform(-0.6, 0.6) + 180) % 360) - 180
        else:
            la, lo = rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        pts.append((i, la, lo))
    pts += [(10_000, 90.0, 45.0), (10_001, 0.0, -180.0), (10_002, None, 3.0)]
    radius = 40_000.0
    want = {}
    for i, la, lo in pts:
        want[i] = None if la is None else not any(_haversine(la, lo, a, b) <= radius for a, b in cents)
    pdf = spark.createDataFrame(pts, "id int, lat double, lon double")
    cdf = spark.createDataFrame(cents, "lat double, lon double")
    for kw in ({}, {"cell_deg": 0.5}, {"cell_deg": 7.0}):
        got = dict(G.flag_near_points(pdf, "lat", "lon", cdf, radius_m=radius, **kw)
                   .select("id", "clean_tests").collect())
        assert got == want
    assert sum(1 for v in want.values() if v is False) > 100


def test_crowded_cell_and_records_without_coordinates(spark):
    """100,000 reference points in one cell; half of the records lack coordinates."""
    points = spark.range(100_000).selectExpr("10 + (id % 317) / 1000000 AS lat", "20 + (id % 331) / 1000000 AS lon")
    recs = spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 10 + (id % 100) / 1000 END AS lat", "CASE WHEN id % 2 = 0 THEN 20D END AS lon")
    got = G.flag_near_points(recs, "lat", "lon", points, radius_m=1000.0).groupBy("clean_tests").count().collect()
    near = sum(1 for i in range(0, 4000, 2) if (i % 100) / 1000 * 111.2 <= 1.0 + 0.035)
    assert {r["clean_tests"]: r["count"] for r in got} == {None: 2000, False: near, True: 2000 - near}


def test_flag_all_no_split(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, 5.0), (2, None, None, 5.0)], "id int, lat double, lon double, unc double")
    out = G.flag_all(df, "lat", "lon", "unc")
    assert rows(out, "id", "georeferenced", "cc_zero", "cc_equ", "clean_tests", "cc_err") == [
        (1, True, False, True, True, True), (2, False, None, None, None, None)]


LOC_SCHEMA = ("uid long, countryCode string, stateProvince string, county string, locality string, "
              "decimalLatitude double, decimalLongitude double, georeferenced boolean, cc_zero boolean, "
              "cc_equ boolean, clean_tests boolean, cc_err boolean")


def test_locality_fill(spark):
    data = [
        (1, "US", "ME", None, "Bog", 45.0, -69.0, True, False, True, True, True),   # reference (suspect flag kept)
        (2, "US", "ME", None, "Bog", None, None, False, None, None, None, None),    # filled
        (3, "US", "ME", None, "", None, None, False, None, None, None, None),       # blank locality: untouched
        (4, "US", None, None, "Fen", 44.0, -70.0, True, True, True, True, True),    # no state: never a reference
        (5, "US", None, None, "Fen", None, None, False, None, None, None, None),    # stays without coordinates
        (6, "US", "ME", None, "Bog", 46.0, -68.0, True, True, True, True, True),    # later reference loses
        (7, "US", "ME", None, "Bog", None, -1.0, False, None, None, None, None),    # longitude kept
    ]
    df = spark.createDataFrame(data, LOC_SCHEMA)
    out = {r["uid"]: r for r in fill_by_locality(df, ["uid"]).collect()}
    assert len(out) == 7
    assert (out[2].decimalLatitude, out[2].decimalLongitude, out[2].coordsAdded, out[2].georeferenced,
            out[2].cc_zero, out[2].cc_err) == (45.0, -69.0, True, True, True, True)
    assert out[3].coordsAdded is False and out[3].decimalLatitude is None
    assert out[5].coordsAdded is False and out[5].decimalLatitude is None and out[5].georeferenced is False
    assert (out[7].decimalLatitude, out[7].decimalLongitude) == (45.0, -1.0)
    # rows that had a latitude are never changed
    for k in (1, 4, 6):
        assert tuple(out[k])[:12] == data[k - 1] and out[k].coordsAdded is False


def test_locality_fill_record_id_path_equals_distinct(spark):
    data = [
        (1, "US", "ME", None, "Bog", 45.0, -69.0, True, True, True, True, True),
        (1, "US", "ME", None, "Bog", 45.0, -69.0, True, True, True, True, True),   # exact copy: one survives
        (1, "US", "ME", None, "Bog", 45.5, -69.0, True, True, True, True, True),   # same id, other row: kept
        (2, "US", "ME", None, "Bog", None, None, False, None, None, None, None),
        (None, "US", None, None, None, 1.0, 2.0, True, True, True, True, True),
        (None, "US", None, None, None, 1.0, 2.0, True, True, True, True, True),
    ]
    df = spark.createDataFrame(data, LOC_SCHEMA)
    a = rows(fill_by_locality(df, ["uid", "decimalLatitude"]))
    b = rows(fill_by_locality(df, ["uid", "decimalLatitude"], record_id="uid"))
    assert a == b and len(a) == 4


def test_valid_coordinate_rule(spark):
    df = spark.createDataFrame([(1, 91.0, 0.0), (2, 45.0, -181.0), (3, -90.0, 180.0), (4, None, 500.0)],
                               "id int, lat double, lon double")
    assert rows(G.drop_invalid_coordinates(df, "lat", "lon"), "id") == [(3,), (4,)]


def test_locality_fill_sorted_output(spark):
    data = [(k, "US", "ME", None, "Bog", None if k % 2 else 1.0, 2.0, k % 2 == 0, None, None, None, None)
            for k in (5, 3, 9, 1, 4)]
    out = fill_by_locality(spark.createDataFrame(data, LOC_SCHEMA), ["uid"], sort_output=True)
    assert [r["uid"] for r in out.collect()] == [1, 3, 4, 5, 9]


def test_filling_shuffles_no_row_to_find_repeated_ids(spark, tmp_path):
    """The repeated ids are staged, so the planner knows that they are few: rows that stay as they are meet them where they lie."""
    kind = ("uid string, countryCode string, stateProvince string, county string, locality string, decimalLatitude double, "
            "decimalLongitude double, georeferenced boolean, cc_zero boolean, cc_equ boolean, clean_tests boolean, cc_err boolean")
    row = ("CA", "s", None, "place", 1.5, 2.5, True, True, True, True, True)
    data = [(f"u{i}", *row) for i in range(20)] + [("u3", *row), ("u4", *row[:4], 9.0, *row[5:]), ("t", *row[:4], None, None, False, None, None, None, None)]
    spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/occs")
    out = fill_by_locality(spark.read.parquet(f"{tmp_path}/occs"), ["uid"], record_id="uid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(uid" not in plan and "SortMergeJoin" not in plan
    assert sorted(r["uid"] for r in out.collect()) == sorted([f"u{i}" for i in range(20)] + ["u4", "t"])
    assert [(r["decimalLatitude"], r["coordsAdded"]) for r in out.where("uid = 't'").collect()] == [(1.5, True)]
