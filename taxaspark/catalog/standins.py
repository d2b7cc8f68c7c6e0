"""Stand-in inputs built from the driver's tables, in Spark and as DuckDB SQL.

The reference's raw inputs (checklists, occurrence downloads, taxonomy
service, backbone) are not public files, so the registered queries map the
driver's tables onto the same schemas (SURVEY §7.4):

* ``orders``   -> occurrence records (species = customer, record id = order key)
* ``events``   -> points with pseudo-coordinates and uncertainty
* ``nation``   -> reference points (country centroids)
* ``part`` / ``lineitem`` / ``supplier`` / ``customer`` -> search names,
  name candidates, taxon usage, synonyms and backbone records
* ``labels``   -> threat labels; ``documents`` -> labelled / unlabelled rows

Each Spark builder has a SQL twin with the same arithmetic in the same
order; every double is built from exact binary fractions or computed the
same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SQL = r"[\p{L}\p{M}\p{N}_]+"
CENTROID_RADIUS_M = 50000.0


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def c(name: str) -> Column:
    return F.col(name)


def sql_round(x: str, digits: int) -> str:
    """Twin of ``functions.numeric.round_half_up``."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


# ---------------------------------------------------------------- occurrences
def occurrences(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    yr = F.year("o_orderdate")
    mo = F.month("o_orderdate")
    dy = F.dayofmonth("o_orderdate")
    prio = c("o_orderpriority")
    lat = ((F.floor(c("o_totalprice") / 50000) * 4.5 - 18)
           + (c("o_orderkey") % 5).cast("double") / 4096)
    lon = (((c("o_custkey") % 60).cast("double") * 1.5 - 45)
           + (c("o_orderkey") % 3).cast("double") / 4096)
    return o.select(
        c("o_orderkey").alias("uid"),
        F.concat(F.lit("sp"), c("o_custkey").cast("string")).alias("acceptedNameAuthor"),
        yr.alias("year"),
        F.when(prio == "5-LOW", F.lit(None).cast("string"))
         .when(prio == "4-NOT SPECIFIED", F.lit("")).otherwise(prio).alias("locality"),
        c("o_orderstatus").alias("countryCode"),
        F.when(mo == 1, F.lit(None).cast("string")).otherwise(yr.cast("string")).alias("stateProvince"),
        F.when(mo <= 6, F.lit(None).cast("string")).otherwise(mo.cast("string")).alias("county"),
        F.when(dy <= 5, F.lit(None).cast("double")).otherwise(lat).alias("decimalLatitude"),
        F.when(dy <= 3, F.lit(None).cast("double")).otherwise(lon).alias("decimalLongitude"),
        F.when(prio == "1-URGENT", F.lit(None).cast("double")).otherwise(c("o_totalprice") / 2)
         .alias("coordinateUncertaintyInMeters"),
    )


OCCS_SQL = """occs AS (
  SELECT o_orderkey AS uid,
         'sp' || CAST(o_custkey AS VARCHAR) AS acceptedNameAuthor,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
              ELSE o_orderpriority END AS locality,
         o_orderstatus AS countryCode,
         CASE WHEN month(o_orderdate) = 1 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS stateProvince,
         CASE WHEN month(o_orderdate) <= 6 THEN NULL ELSE CAST(month(o_orderdate) AS VARCHAR) END AS county,
         CASE WHEN day(o_orderdate) <= 5 THEN NULL
              ELSE (floor(o_totalprice / 50000) * CAST(4.5 AS DOUBLE) - 18)
                   + CAST(o_orderkey % 5 AS DOUBLE) / 4096 END AS decimalLatitude,
         CASE WHEN day(o_orderdate) <= 3 THEN NULL
              ELSE (CAST(o_custkey % 60 AS DOUBLE) * CAST(1.5 AS DOUBLE) - 45)
                   + CAST(o_orderkey % 3 AS DOUBLE) / 4096 END AS decimalLongitude,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice / 2 END AS coordinateUncertaintyInMeters
  FROM orders)"""


# ---------------------------------------------------------------- centroids
def centroids(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select(c("n_name").alias("country"),
                    (c("n_regionkey").cast("double") * 9 - 18).alias("lat"),
                    (c("n_nationkey").cast("double") * 3 - 36).alias("lon"))


CENTROIDS_SQL = """cen AS (
  SELECT n_name AS country, CAST(n_regionkey AS DOUBLE) * 9 - 18 AS lat,
         CAST(n_nationkey AS DOUBLE) * 3 - 36 AS lon
  FROM nation)"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Twin of ``operators.geo.haversine_m``."""
    r2 = 2.0 * 6371008.8
    return (f"({r2!r} * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")


def flags_sql(src: str, lat: str, lon: str, unc: str, radius: float = CENTROID_RADIUS_M) -> str:
    """Select list fragment: georeferenced and the four flags over ``src``."""
    has = f"({src}.{lat} IS NOT NULL AND {src}.{lon} IS NOT NULL)"
    near = (f"EXISTS (SELECT 1 FROM cen WHERE {haversine_sql(f'{src}.{lat}', f'{src}.{lon}', 'cen.lat', 'cen.lon')}"
            f" <= {radius!r})")
    return (f"{has} AS georeferenced, "
            f"CASE WHEN {has} THEN NOT ({src}.{lat} = 0 OR {src}.{lon} = 0 OR "
            f"sqrt({src}.{lat} * {src}.{lat} + {src}.{lon} * {src}.{lon}) <= 0.5) END AS cc_zero, "
            f"CASE WHEN {has} THEN abs({src}.{lat}) <> abs({src}.{lon}) END AS cc_equ, "
            f"CASE WHEN {has} THEN NOT {near} END AS clean_tests, "
            f"CASE WHEN {has} THEN {src}.{unc} < 100000 END AS cc_err")


FLAGGED_OCCS_SQL = f"""{OCCS_SQL},
{CENTROIDS_SQL},
flagged AS (
  SELECT occs.*, {flags_sql('occs', 'decimalLatitude', 'decimalLongitude', 'coordinateUncertaintyInMeters')}
  FROM occs)"""


# ---------------------------------------------------------------- event points
def points(spark: SparkSession, d: str) -> DataFrame:
    return points_from(table(spark, d, "events"))


def points_from(e: DataFrame) -> DataFrame:
    """Pseudo-coordinates and uncertainty of event rows (batch or streaming frame)."""
    return e.select(
        "event_id", "user_id", "event_type", "value",
        F.when(c("event_type") == "error", F.lit(None).cast("double"))
         .otherwise((c("event_id") % 181).cast("double") - 90).alias("lat"),
        ((c("event_id") * 7) % 361).cast("double").__sub__(180).alias("lon"),
        (F.nullif(c("user_id"), F.lit(0)).cast("double") * 1000).alias("unc"),
    )


POINTS_SQL = """pts AS (
  SELECT event_id, user_id, event_type, value,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 181 AS DOUBLE) - 90 END AS lat,
         CAST((event_id * 7) % 361 AS DOUBLE) - 180 AS lon,
         CAST(NULLIF(user_id, 0) AS DOUBLE) * 1000 AS unc
  FROM events)"""


# ---------------------------------------------------------------- names
def search_names(spark: SparkSession, d: str) -> DataFrame:
    """Every part is a search name; one in ten has a suffix that no candidate has."""
    k = c("p_partkey").cast("string")
    return table(spark, d, "part").select(
        F.when(c("p_partkey") % 10 == 6, F.concat(k, F.lit(" nom. nud."))).otherwise(k).alias("NameAuthor"))


NAMES_SQL = """names AS (
  SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 10 = 6 THEN ' nom. nud.' ELSE '' END AS NameAuthor FROM part)"""


def match_type() -> Column:
    """Of all candidates of a name, by its key: nothing found, a higher rank only, missing, or exact."""
    k = c("l_partkey") % 10
    return F.when(k == 3, F.lit("NONE")).when(k == 4, F.lit("HIGHERRANK")).when(k == 5, F.lit(None).cast("string")) \
        .otherwise(F.lit("EXACT"))


MATCH_TYPE_SQL = "CASE l_partkey % 10 WHEN 3 THEN 'NONE' WHEN 4 THEN 'HIGHERRANK' WHEN 5 THEN NULL ELSE 'EXACT' END"


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        c("l_partkey").cast("string").alias("searchName"),
        c("l_suppkey").alias("usageKey"),
        F.concat(F.lit("taxon"), c("l_suppkey").cast("string")).alias("scientificName"),
        c("l_linestatus").alias("rank"),
        (c("l_quantity").cast("int") + 50).alias("confidence"),
        match_type().alias("matchType"),
    )


CANDIDATES_SQL = f"""cand AS (
  SELECT CAST(l_partkey AS VARCHAR) AS searchName, l_suppkey AS usageKey,
         'taxon' || CAST(l_suppkey AS VARCHAR) AS scientificName, l_linestatus AS rank,
         CAST(l_quantity AS INTEGER) + 50 AS confidence,
         {MATCH_TYPE_SQL} AS matchType
  FROM lineitem)"""


def usage(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    neg = c("s_acctbal") < 0
    return s.select(
        c("s_suppkey").alias("key"),
        F.concat(F.lit("taxon"), c("s_suppkey").cast("string")).alias("scientificName"),
        c("s_name").alias("species"),
        F.when(neg, F.lit(None).cast("string")).otherwise(F.concat(F.lit("acc"), c("s_nationkey").cast("string"))).alias("accepted"),
        F.when(neg, F.lit("DOUBTFUL")).when(c("s_nationkey") < 5, F.lit("SYNONYM")).otherwise(F.lit("ACCEPTED")).alias("taxonomicStatus"),
        F.when(neg, F.lit(None).cast("long")).otherwise(c("s_nationkey").cast("long")).alias("acceptedKey"),
    )


USAGE_SQL = """usage AS (
  SELECT s_suppkey AS key, 'taxon' || CAST(s_suppkey AS VARCHAR) AS scientificName, s_name AS species,
         CASE WHEN s_acctbal < 0 THEN NULL ELSE 'acc' || CAST(s_nationkey AS VARCHAR) END AS accepted,
         CASE WHEN s_acctbal < 0 THEN 'DOUBTFUL' WHEN s_nationkey < 5 THEN 'SYNONYM' ELSE 'ACCEPTED' END AS taxonomicStatus,
         CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END AS acceptedKey
  FROM supplier)"""


def synonyms(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    seg = c("c_mktsegment")
    name = (F.when(seg == "MACHINERY", F.concat(F.lit("J."), c("c_name")))
            .when(seg == "BUILDING", F.concat(c("c_name"), F.lit("?"))).otherwise(c("c_name")))
    return cu.select(
        c("c_nationkey").cast("long").alias("acceptedKey"),
        name.alias("scientificName"),
        F.concat(F.lit("sp"), c("c_nationkey").cast("string")).alias("species"),
        F.concat(F.lit("acc"), c("c_nationkey").cast("string")).alias("accepted"),
    )


SYNONYMS_SQL = """syn AS (
  SELECT CAST(c_nationkey AS BIGINT) AS acceptedKey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'J.' || c_name
              WHEN c_mktsegment = 'BUILDING' THEN c_name || '?' ELSE c_name END AS scientificName,
         'sp' || CAST(c_nationkey AS VARCHAR) AS species,
         'acc' || CAST(c_nationkey AS VARCHAR) AS accepted
  FROM customer)"""


# ---------------------------------------------------------------- backbone / labels
def backbone(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer")
    k = c("c_custkey")
    group = k - k % 3
    return cu.select(
        F.concat(F.lit("sp"), k.cast("string")).alias("NAME_OF_FUNGUS"),
        F.nullif(c("c_mktsegment"), F.lit("BUILDING")).alias("AUTHORS"),
        F.concat(F.lit("sp"), group.cast("string")).alias("CURRENT_NAME"),
        k.alias("RECORD_NUMBER"),
        F.when(k % 3 == 2, k - 1).otherwise(k).alias("BASIONYM_RECORD_NUMBER"),
        group.alias("CURRENT_NAME_RECORD_NUMBER"),
        (F.lit(1800) + c("c_nationkey") * 8).cast("int").alias("YEAR_OF_PUBLICATION"),
    )


BACKBONE_SQL = """bb AS (
  SELECT 'sp' || CAST(c_custkey AS VARCHAR) AS NAME_OF_FUNGUS,
         NULLIF(c_mktsegment, 'BUILDING') AS AUTHORS,
         'sp' || CAST(c_custkey - c_custkey % 3 AS VARCHAR) AS CURRENT_NAME,
         c_custkey AS RECORD_NUMBER,
         CASE WHEN c_custkey % 3 = 2 THEN c_custkey - 1 ELSE c_custkey END AS BASIONYM_RECORD_NUMBER,
         c_custkey - c_custkey % 3 AS CURRENT_NAME_RECORD_NUMBER,
         CAST(1800 + c_nationkey * 8 AS INTEGER) AS YEAR_OF_PUBLICATION
  FROM customer)"""


def threat(spark: SparkSession, d: str) -> DataFrame:
    lb = table(spark, d, "labels")
    return lb.select(F.concat(F.lit("sp"), c("doc_id").cast("string")).alias("acceptedNameAuthor"),
                     c("quality").alias("Threatened"))


THREAT_SQL = """threat AS (
  SELECT 'sp' || CAST(doc_id AS VARCHAR) AS acceptedNameAuthor, quality AS Threatened FROM labels)"""


def wanted_names(spark: SparkSession, d: str) -> DataFrame:
    """Accepted names of interest: every species that has a record."""
    return table(spark, d, "customer").select(
        F.concat(F.lit("sp"), c("c_custkey").cast("string")).alias("acceptedNameAuthor"))


WANTED_SQL = """wanted AS (SELECT 'sp' || CAST(c_custkey AS VARCHAR) AS acceptedNameAuthor FROM customer)"""


# ---------------------------------------------------------------- draws for scoring
DRAWS = [
    (1, -1.20, 0.80, 0.30, -0.20, 0.50),
    (2, -1.00, 0.70, 0.25, -0.10, 0.40),
    (3, -0.90, 0.90, 0.35, -0.30, 0.60),
    (4, -1.10, 0.60, 0.20, -0.15, 0.45),
    (5, -0.80, 0.85, 0.40, -0.25, 0.55),
    (6, -1.30, 0.75, 0.28, -0.05, 0.35),
    (7, -0.95, 0.65, 0.32, -0.35, 0.65),
    (8, -1.05, 0.95, 0.22, -0.12, 0.52),
    (9, -1.15, 0.55, 0.38, -0.22, 0.48),
]
DRAW_COLS = ["draw_id", "b_intercept", "b_size", "b_price", "b_size_x_price", "b_name_len"]


def draws(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DRAWS, "draw_id int, b_intercept double, b_size double, b_price double, "
                                        "b_size_x_price double, b_name_len double")


DRAWS_SQL = "draws AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join([str(r[0])] + [f"CAST({v!r} AS DOUBLE)" for v in r[1:]]) + ")" for r in DRAWS
) + ") v(" + ", ".join(DRAW_COLS) + "))"


def scored_parts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey",
                    (c("p_size").cast("double") / 50).alias("x_size"),
                    ((c("p_retailprice") - 900) / 100).alias("x_price"),
                    (F.length("p_name").cast("double") / 20).alias("x_name_len"))


PARTS_X_SQL = """px AS (
  SELECT p_partkey, CAST(p_size AS DOUBLE) / 50 AS x_size, (p_retailprice - 900) / 100 AS x_price,
         CAST(length(p_name) AS DOUBLE) / 20 AS x_name_len
  FROM part)"""

PART_TERMS = {"b_size": "x_size", "b_price": "x_price", "b_name_len": "x_name_len"}


def part_terms() -> dict:
    return {"b_size": c("x_size"), "b_price": c("x_price"),
            "b_size_x_price": c("x_size") * c("x_price"), "b_name_len": c("x_name_len")}


EPRED_SQL = ("1.0 / (1.0 + exp(-(((b_intercept + b_size * x_size) + b_price * x_price)"
             " + b_size_x_price * (x_size * x_price) + b_name_len * x_name_len)))")


# ---------------------------------------------------------------- scored events
def scored_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", "user_id", "event_type",
                    F.when(c("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("observed"),
                    (c("value") / 500).alias("score"))


SCORED_EVENTS_SQL = """sev AS (
  SELECT event_id, user_id, event_type, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS observed,
         value / 500 AS score
  FROM events)"""
