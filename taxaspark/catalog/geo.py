"""Registered queries for coordinate flags, grid dedup and locality fill."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import dedup as D
from ..operators import geo as G
from ..operators.ranking import row_index
from ..plans.locality import fill_by_locality
from ..session import ensure_checkpoint_dir
from ..sources.io import write_stage
from ..streaming.flags import flag_stream, start_to_parquet
from .registry import register
from .standins import (CENTROID_RADIUS_M, CENTROIDS_SQL, FLAGGED_OCCS_SQL, POINTS_SQL, c, centroids, flags_sql,
                       occurrences, points, points_from, sql_round, table)

FLAGGED_POINTS_SQL = f"""WITH {POINTS_SQL},
{CENTROIDS_SQL},
fp AS (SELECT pts.*, {flags_sql('pts', 'lat', 'lon', 'unc')} FROM pts)"""


def _flagged_points(spark, d):
    return G.flag_all(points(spark, d), "lat", "lon", "unc", centroids(spark, d), radius_m=CENTROID_RADIUS_M)


@register("flag_zero", f"""WITH {POINTS_SQL}
SELECT event_id, lat, lon,
       CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN NOT (lat = 0 OR lon = 0 OR sqrt(lat * lat + lon * lon) <= 0.5) END AS cc_zero
FROM pts""")
def flag_zero(spark, d):
    """Zero latitude or longitude, or within 0.5 degrees of (0, 0), is suspect."""
    return G.flag_zero(points(spark, d), "lat", "lon").select("event_id", "lat", "lon", "cc_zero")


@register("flag_equal", f"""WITH {POINTS_SQL}
SELECT event_id, lat, lon, CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN abs(lat) <> abs(lon) END AS cc_equ
FROM pts""")
def flag_equal(spark, d):
    """Latitude equal to longitude (absolute values) is suspect."""
    return G.flag_equal(points(spark, d), "lat", "lon").select("event_id", "lat", "lon", "cc_equ")


@register("flag_uncertainty", f"""WITH {POINTS_SQL}
SELECT event_id, unc, unc < 100000 AS cc_err FROM pts""")
def flag_uncertainty(spark, d):
    """Coordinate uncertainty of 100 km or more is suspect; a missing value stays NULL."""
    return G.flag_uncertainty(points(spark, d), "unc").select("event_id", "unc", "cc_err")


@register("flag_near_points", f"""{FLAGGED_POINTS_SQL}
SELECT event_id, lat, lon, clean_tests FROM fp""")
def flag_near_points(spark, d):
    """Within 50 km of a reference point is suspect (cell join + exact haversine, one flag per row)."""
    pts = points(spark, d)
    return G.flag_near_points(pts, "lat", "lon", centroids(spark, d), radius_m=CENTROID_RADIUS_M).select(
        "event_id", "lat", "lon", "clean_tests")


@register("flag_all", f"""{FLAGGED_POINTS_SQL}
SELECT event_id, georeferenced, cc_zero, cc_equ, clean_tests, cc_err FROM fp""")
def flag_all(spark, d):
    """All four flags in one pass; rows without coordinates get NULL flags."""
    return _flagged_points(spark, d).select("event_id", "georeferenced", "cc_zero", "cc_equ", "clean_tests", "cc_err")


@register("quality_gate", f"""{FLAGGED_POINTS_SQL}
SELECT event_id, user_id FROM fp
WHERE georeferenced = false OR ((cc_equ AND cc_zero AND clean_tests AND cc_err) OR cc_err IS NULL)""")
def quality_gate(spark, d):
    """Records that pass the flags (or have no coordinates); a NULL uncertainty flag passes."""
    return G.quality_gate(_flagged_points(spark, d)).select("event_id", "user_id")


@register("flag_summary", f"""{FLAGGED_POINTS_SQL}
SELECT 'cc_zero' AS cleaning_step, count(*) FILTER (WHERE NOT cc_zero) AS records_cleaned FROM fp
UNION ALL SELECT 'cc_equ', count(*) FILTER (WHERE NOT cc_equ) FROM fp
UNION ALL SELECT 'cc_clean', count(*) FILTER (WHERE NOT clean_tests) FROM fp
UNION ALL SELECT 'cc_err', count(*) FILTER (WHERE NOT cc_err) FROM fp""")
def flag_summary(spark, d):
    """Records flagged FALSE per cleaning step, one aggregate pass, long form."""
    return A.flag_summary(_flagged_points(spark, d), G.FLAG_STEPS)


@register("grid_dedup", f"""WITH t AS (
  SELECT event_id, user_id, value, {sql_round('value', 0)} AS round_value,
         {sql_round('CAST(user_id AS DOUBLE)', 0)} AS round_user
  FROM events)
SELECT event_id, user_id, value, round_value, round_user FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, round_value, round_user ORDER BY event_id) AS rn FROM t) s
WHERE rn = 1""")
def grid_dedup(spark, d):
    """One record per (user, value rounded to 0 decimals), first by event id."""
    e = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", "user_id", "value", c("user_id").cast("double").alias("user"))
    out = D.grid_dedup(e, ["user_id"], "value", "user", 0, ["event_id"])
    return out.select("event_id", "user_id", "value", "round_value", F.col("round_user"))


LOCALITY_FILL_SQL = f"""WITH {FLAGGED_OCCS_SQL},
ref AS (
  SELECT countryCode, stateProvince, county, locality, decimalLatitude AS lat_y, decimalLongitude AS lon_y FROM (
    SELECT *, row_number() OVER (PARTITION BY countryCode, stateProvince, county, locality ORDER BY uid) AS rn
    FROM flagged
    WHERE georeferenced = true AND locality IS NOT NULL AND locality <> '' AND stateProvince IS NOT NULL) r
  WHERE rn = 1),
tgt AS (SELECT * FROM flagged WHERE decimalLatitude IS NULL AND locality IS NOT NULL AND locality <> ''),
untouched AS (
  SELECT DISTINCT * FROM flagged WHERE NOT (decimalLatitude IS NULL AND locality IS NOT NULL AND locality <> '')),
m AS (
  SELECT t.uid, t.acceptedNameAuthor, t.year, t.locality, t.countryCode, t.stateProvince, t.county,
         coalesce(t.decimalLatitude, r.lat_y) AS decimalLatitude,
         coalesce(t.decimalLongitude, r.lon_y) AS decimalLongitude,
         t.coordinateUncertaintyInMeters,
         coalesce(t.decimalLatitude, r.lat_y) IS NOT NULL AS georeferenced,
         CASE WHEN coalesce(t.decimalLatitude, r.lat_y) IS NOT NULL THEN true ELSE t.cc_zero END AS cc_zero,
         CASE WHEN coalesce(t.decimalLatitude, r.lat_y) IS NOT NULL THEN true ELSE t.cc_equ END AS cc_equ,
         CASE WHEN coalesce(t.decimalLatitude, r.lat_y) IS NOT NULL THEN true ELSE t.clean_tests END AS clean_tests,
         CASE WHEN coalesce(t.decimalLatitude, r.lat_y) IS NOT NULL THEN true ELSE t.cc_err END AS cc_err,
         coalesce(t.decimalLatitude, r.lat_y) IS NOT NULL AS coordsAdded
  FROM tgt t LEFT JOIN ref r
    ON t.countryCode IS NOT DISTINCT FROM r.countryCode AND t.stateProvince IS NOT DISTINCT FROM r.stateProvince
   AND t.county IS NOT DISTINCT FROM r.county AND t.locality IS NOT DISTINCT FROM r.locality)
SELECT uid, acceptedNameAuthor, year, locality, countryCode, stateProvince, county, decimalLatitude, decimalLongitude,
       coordinateUncertaintyInMeters, georeferenced, cc_zero, cc_equ, clean_tests, cc_err, false AS coordsAdded
FROM untouched
UNION ALL
SELECT * FROM m"""


@register("locality_fill", LOCALITY_FILL_SQL)
def locality_fill(spark, d):
    """Records without latitude take the coordinates of the first georeferenced record of the same place."""
    occ = G.flag_all(occurrences(spark, d), "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters",
                     centroids(spark, d), radius_m=CENTROID_RADIUS_M)
    return fill_by_locality(occ, ["uid"], record_id="uid")


@register("locality_fill_ordered", f"""SELECT uid, decimalLatitude, decimalLongitude, coordsAdded,
       row_number() OVER (ORDER BY uid) AS position FROM ({LOCALITY_FILL_SQL}) filled""")
def locality_fill_ordered(spark, d):
    """The same put back into input order, with each record's position. The flagged records are written once and
    read in narrow columns by each branch."""
    occ = G.flag_all(occurrences(spark, d), "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters",
                     centroids(spark, d), radius_m=CENTROID_RADIUS_M)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flagged-{uuid.uuid4().hex}"
    write_stage(occ, path)
    filled = fill_by_locality(spark.read.schema(occ.schema).parquet(path), ["uid"], record_id="uid", sort_output=True)
    return row_index(filled, ["uid"], "position").select("uid", "decimalLatitude", "decimalLongitude", "coordsAdded", "position")


@register("stream_quality_gate", f"""{FLAGGED_POINTS_SQL}
SELECT event_id, user_id FROM fp
WHERE georeferenced = false OR ((cc_equ AND cc_zero AND clean_tests AND cc_err) OR cc_err IS NULL)""")
def stream_quality_gate(spark, d):
    """The quality gate run as a stream: events read by the file source, flags (the centroid test as
    stream-static semi/anti joins), gate, exactly-once Parquet sink under the shared checkpoint folder;
    the same rows as the batch ``quality_gate``."""
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    flagged = flag_stream(points_from(stream), lat="lat", lon="lon", unc="unc", points=centroids(spark, d),
                          radius_m=CENTROID_RADIUS_M)
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-gate-{uuid.uuid4().hex}"
    q = start_to_parquet(flagged.select("event_id", "user_id"), f"{out}/data", f"{out}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema("event_id long, user_id long").parquet(f"{out}/data")


@register("stream_first_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def stream_first_per_key(spark, d):
    """The first record of each key kept on a stream of three micro-batches that stops after each and starts again;
    the same rows as the batch operator."""
    from ..streaming.dedup import first_per_key_stream, survivors
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-first-{uuid.uuid4().hex}"
    for i in range(3):
        o.where(F.pmod("o_orderkey", F.lit(3)) == i).write.parquet(f"{out}/in/part={i}")
        stream = spark.readStream.schema(o.schema).option("recursiveFileLookup", True).parquet(f"{out}/in")
        q = first_per_key_stream(stream, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], f"{out}/kept", f"{out}/checkpoint", buckets=4)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return survivors(spark, f"{out}/kept", o.schema)
