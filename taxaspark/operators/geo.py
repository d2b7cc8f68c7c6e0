"""Coordinate quality flags (TRUE = passes, FALSE = suspect, NULL = no coordinates).

No split and re-union: every flag is ``when(georeferenced, test)``, so rows
without coordinates pass through the same projection with NULL flags.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import col_of

EARTH_RADIUS_M = 6371008.8


def has_coordinates(lat: str | Column, lon: str | Column) -> Column:
    return col_of(lat).isNotNull() & col_of(lon).isNotNull()


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                radius_m: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres, as a column expression."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * radius_m) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def valid_coordinates(lat: str | Column, lon: str | Column) -> Column:
    """Rule form of removing records with impossible coordinates: |lat| <= 90 and |lon| <= 180
    (NULL coordinates are not invalid; they are handled as non-georeferenced)."""
    la, lo = col_of(lat), col_of(lon)
    return F.when(la.isNull() | lo.isNull(), F.lit(True)).otherwise((F.abs(la) <= 90) & (F.abs(lo) <= 180))


def drop_invalid_coordinates(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.filter(valid_coordinates(lat, lon))


def zero_test(lat: str | Column, lon: str | Column, buffer_deg: float = 0.5) -> Column:
    la, lo = col_of(lat), col_of(lon)
    near_origin = F.sqrt(la * la + lo * lo) <= F.lit(buffer_deg)
    return ~((la == 0) | (lo == 0) | near_origin)


def equal_test(lat: str | Column, lon: str | Column, absolute: bool = True) -> Column:
    la, lo = col_of(lat), col_of(lon)
    return (F.abs(la) != F.abs(lo)) if absolute else (la != lo)


def uncertainty_test(unc: str | Column, limit: float = 100000) -> Column:
    """``ifelse(unc >= limit, FALSE, TRUE)``: NULL uncertainty stays NULL."""
    return col_of(unc) < F.lit(limit)


def flag_zero(df: DataFrame, lat: str, lon: str, buffer_deg: float = 0.5, out: str = "cc_zero") -> DataFrame:
    """FALSE where latitude or longitude is 0, or the point is within ``buffer_deg`` of (0, 0)."""
    return df.withColumn(out, F.when(has_coordinates(lat, lon), zero_test(lat, lon, buffer_deg)))


def flag_equal(df: DataFrame, lat: str, lon: str, absolute: bool = True, out: str = "cc_equ") -> DataFrame:
    """FALSE where latitude equals longitude (in absolute value by default)."""
    return df.withColumn(out, F.when(has_coordinates(lat, lon), equal_test(lat, lon, absolute)))


def flag_uncertainty(df: DataFrame, unc: str, limit: float = 100000, out: str = "cc_err",
                     lat: str | None = None, lon: str | None = None) -> DataFrame:
    """FALSE where the coordinate uncertainty is at least ``limit`` metres."""
    test = uncertainty_test(unc, limit)
    if lat is not None and lon is not None:
        test = F.when(has_coordinates(lat, lon), test)
    return df.withColumn(out, test)


def point_cells(points: DataFrame, lat: str, lon: str, radius_m: float, cell_deg: float) -> DataFrame:
    """Every grid cell a point's radius can reach, one row per (point, cell).

    Cells are ``cell_deg`` wide; longitude cells wrap at 180 degrees, and a
    radius that reaches a pole covers every longitude cell.
    """
    ang = radius_m / EARTH_RADIUS_M                       # angular radius, radians
    dlat = math.degrees(ang)
    nlon = round(360.0 / cell_deg)
    nlat = int(math.floor(180.0 / cell_deg))
    la, lo = F.col(lat), F.col(lon)
    lat_lo = F.greatest(F.lit(0), F.floor((la - dlat + 90.0) / cell_deg))
    lat_hi = F.least(F.lit(nlat), F.floor((la + dlat + 90.0) / cell_deg))
    # longitude half-width of a spherical cap: asin(sin a / cos(lat))
    s = F.lit(math.sin(ang)) / F.cos(F.radians(la))
    polar = (F.abs(la) + F.lit(dlat) >= F.lit(90.0)) | (s >= F.lit(1.0))
    dlon = F.degrees(F.asin(F.least(F.lit(1.0), s)))
    lon_lo = F.floor((lo - dlon + 180.0) / cell_deg)
    lon_hi = F.floor((lo + dlon + 180.0) / cell_deg)
    lon_seq = F.when(polar | (lon_hi - lon_lo + 1 >= F.lit(nlon)), F.sequence(F.lit(0).cast("long"), F.lit(nlon - 1).cast("long"))) \
        .otherwise(F.transform(F.sequence(lon_lo.cast("long"), lon_hi.cast("long")), lambda x: F.pmod(x, F.lit(nlon))))
    return (points.select(la.alias("__plat__"), lo.alias("__plon__"),
                          F.sequence(lat_lo.cast("long"), lat_hi.cast("long")).alias("__ilat__"),
                          lon_seq.alias("__ilon__"))
            .select("__plat__", "__plon__", F.explode("__ilat__").alias("__clat__"), "__ilon__")
            .select("__plat__", "__plon__", "__clat__", F.explode("__ilon__").alias("__clon__")))


def own_cell(lat: str | Column, lon: str | Column, cell_deg: float) -> tuple[Column, Column]:
    nlon = round(360.0 / cell_deg)
    la, lo = col_of(lat), col_of(lon)
    return (F.floor((la + 90.0) / cell_deg),
            F.pmod(F.floor((lo + 180.0) / cell_deg), F.lit(nlon)))


def near_cells(points: DataFrame, radius_m: float, lat: str = "lat", lon: str = "lon",
               cell_deg: float | None = None) -> DataFrame:
    """``__clat__, __clon__, __pts__``: the distinct reference points that reach each grid cell."""
    cells = point_cells(points.select(lat, lon).na.drop().distinct(), lat, lon, radius_m, cell_size(radius_m, cell_deg))
    return cells.groupBy("__clat__", "__clon__").agg(
        F.collect_list(F.struct(F.col("__plat__").alias("la"), F.col("__plon__").alias("lo"))).alias("__pts__"))


def cell_size(radius_m: float, cell_deg: float | None = None) -> float:
    """Cells of about the radius: the points listed for a cell all lie within some two radii of it."""
    size = cell_deg or max(math.degrees(radius_m / EARTH_RADIUS_M), 0.01)
    return 360.0 / max(1, math.floor(360.0 / size))     # whole cells around the globe


def flag_near_points(df: DataFrame, lat: str, lon: str, points: DataFrame,
                     radius_m: float = 1000.0, out: str = "clean_tests",
                     points_lat: str = "lat", points_lon: str = "lon",
                     cell_deg: float | None = None) -> DataFrame:
    """FALSE where a reference point (e.g. a country centroid) lies within ``radius_m``.

    The small side (distinct reference points) is expanded to the cells its
    radius reaches, one row with an array of points per cell. Each record
    looks up its own cell with a left equi-join (at most one match, so no
    fan-out) and runs the exact haversine test over that cell's points: one
    scan, one flag per record, no theta join; works on a stream too. Cells
    are as small as the radius, so an array holds only the points around its
    cell. The planner (AQE) broadcasts the cell table if it is small and
    splits the partition of a crowded cell if not; records without
    coordinates get a cell that no point has, spread by a hash of the record.
    """
    size = cell_size(radius_m, cell_deg)
    cells = near_cells(points, radius_m, points_lat, points_lon, size)
    clat, clon = own_cell(lat, lon, size)
    nowhere = -1 - F.pmod(F.xxhash64(*df.columns), F.lit(65536))
    geo = has_coordinates(lat, lon)
    recs = df.withColumn("__rlat__", F.when(geo, clat).otherwise(nowhere)).withColumn(
        "__rlon__", F.when(geo, clon).otherwise(F.lit(-1)))
    joined = recs.join(cells, (F.col("__rlat__") == F.col("__clat__")) & (F.col("__rlon__") == F.col("__clon__")), "left")
    near = F.exists(F.col("__pts__"),
                    lambda p: haversine_m(F.col(lat), F.col(lon), p["la"], p["lo"]) <= F.lit(radius_m))
    flagged = joined.withColumn(out, F.when(geo, ~F.coalesce(near, F.lit(False))))
    return flagged.select(*[c for c in df.columns if c != out], out) if out in df.columns else \
        flagged.select(*df.columns, out)


def flag_all(df: DataFrame, lat: str, lon: str, unc: str, points: DataFrame | None = None,
             radius_m: float = 1000.0, zero_buffer_deg: float = 0.5, unc_limit: float = 100000,
             points_lat: str = "lat", points_lon: str = "lon", cell_deg: float | None = None) -> DataFrame:
    """``georeferenced`` plus the four flags; rows without coordinates get NULL flags."""
    out = df.withColumn("georeferenced", has_coordinates(lat, lon))
    out = flag_zero(out, lat, lon, zero_buffer_deg)
    out = flag_equal(out, lat, lon)
    if points is not None:
        out = flag_near_points(out, lat, lon, points, radius_m, "clean_tests",
                               points_lat, points_lon, cell_deg)
    else:
        out = out.withColumn("clean_tests", F.when(F.col("georeferenced"), F.lit(True)))
    return flag_uncertainty(out, unc, unc_limit, "cc_err", lat, lon)


def quality_gate(df: DataFrame, georef: str = "georeferenced", equ: str = "cc_equ", zero: str = "cc_zero",
                 tests: str = "clean_tests", err: str = "cc_err") -> DataFrame:
    """``georeferenced == F | (equ & zero & tests & err | is.na(err))``.

    ``&`` binds tighter than ``|``: a row with a NULL uncertainty flag passes
    even when another flag is FALSE.
    """
    g = F.col(georef)
    cond = (g == F.lit(False)) | ((F.col(equ) & F.col(zero) & F.col(tests) & F.col(err)) | F.col(err).isNull())
    return df.filter(cond)


FLAG_STEPS = {"cc_zero": "cc_zero", "cc_equ": "cc_equ", "cc_clean": "clean_tests", "cc_err": "cc_err"}
