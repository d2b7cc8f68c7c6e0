"""The whole sequence as one query: stages written and read again, from the raw stand-ins to the predictor table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from ..plans import constants as K
from ..plans import predictors as P
from ..plans.pipeline import Inputs, run_predictors
from ..session import ensure_checkpoint_dir
from .composites import (CHECKLIST_INPUTS_SQL, TRAINING_SQL, W, _assessments, _in, _micro, _natureserve, _portal_checklist,
                         _proto, _taxa, _taxonomy)
from .registry import register
from .standins import (CENTROID_RADIUS_M, CENTROIDS_SQL, MATCH_TYPE_SQL, USAGE_SQL, c, centroids, flags_sql, match_type,
                       sql_round, table, usage)

def _candidates(spark, d):
    """Odd lines search for assessed names, even lines for checklist names, of the line's part."""
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_name", "p_brand")
    li = table(spark, d, "lineitem").join(p, c("l_partkey") == c("p_partkey"))
    name = F.when(c("p_size") < 5, c("p_name")).otherwise(F.concat("p_name", F.lit(" "), "p_brand"))
    assessed = F.concat(c("l_partkey").cast("string"), F.when(c("l_linestatus") == "O", F.lit(" L.")).otherwise(F.lit(" Fr.")))
    return li.select(
        F.when(c("l_linenumber") % 2 == 0, name).otherwise(assessed).alias("searchName"), c("l_suppkey").alias("usageKey"),
        F.concat(F.lit("taxon"), c("l_suppkey").cast("string")).alias("scientificName"), c("l_linestatus").alias("rank"),
        (c("l_quantity").cast("int") + 50).alias("confidence"), match_type().alias("matchType"))


def _synonyms(spark, d):
    cu = table(spark, d, "customer")
    nk = c("c_nationkey").cast("string")
    name = F.when(c("c_mktsegment") == "MACHINERY", F.concat(F.lit("J."), c("c_name"))).otherwise(c("c_name"))
    return cu.select(c("c_nationkey").cast("long").alias("acceptedKey"), F.concat(name, F.lit(" Auth")).alias("scientificName"),
                     F.concat(F.lit("sp"), nk).alias("species"), F.concat(F.lit("acc"), nk).alias("accepted"))


def _wide(df, drops):
    """The file with the columns that are dropped from it right after."""
    return df.select("*", *[F.lit("x").alias(n) for n in dict.fromkeys(drops) if n not in df.columns])


def _portal_file(spark, d, part, tag, drops):
    """Orders of two priorities each; urgent ones are in both files."""
    o = table(spark, d, "orders").filter(c("o_orderpriority").isin("1-URGENT", *part))
    st, dy, mo = c("o_orderstatus"), F.dayofmonth("o_orderdate"), F.month("o_orderdate")
    lat = (F.floor(c("o_totalprice") / 50000) * 4.5 - 18) + (c("o_orderkey") % 5).cast("double") / 4096
    lon = ((c("o_custkey") % 60).cast("double") * 1.5 - 45) + (c("o_orderkey") % 3).cast("double") / 4096
    return _wide(o.select(
        c("o_orderkey").alias("id"), F.when(c("o_orderpriority") == "1-URGENT", c("o_custkey")).alias("taxonID"),
        F.concat(F.lit("Customer#"), F.lpad(c("o_custkey").cast("string"), 9, "0")).alias("scientificName"),
        F.lit("Auth").alias("scientificNameAuthorship"), F.lit("Customer").alias("genus"),
        F.lpad(c("o_custkey").cast("string"), 9, "0").alias("specificEpithet"),
        F.when(st == "O", F.lit("canada")).when(st == "F", F.lit("USA")).otherwise(F.lit("Mexico")).alias("country"),
        F.when(c("o_orderpriority") == "5-LOW", F.lit("XX")).alias("countryCode"),
        F.when(mo == 1, F.lit(None).cast("string")).otherwise(F.year("o_orderdate").cast("string")).alias("stateProvince"),
        F.when(mo <= 6, F.lit(None).cast("string")).otherwise(mo.cast("string")).alias("county"),
        F.when(dy == 9, F.lit("")).otherwise(F.concat(F.lit(tag), (c("o_custkey") % 4).cast("string"))).alias("locality"),
        F.year("o_orderdate").alias("year"),
        F.when(dy <= 5, F.lit(None).cast("double")).otherwise(lat).alias("decimalLatitude"),
        F.when(dy <= 3, F.lit(None).cast("double")).otherwise(lon).alias("decimalLongitude"),
        F.when(dy == 20, F.lit(None).cast("double")).otherwise(c("o_totalprice") / 2).alias("coordinateUncertaintyInMeters")),
        drops)


def _aggregator_file(spark, d, half, drops):
    li = table(spark, d, "lineitem").filter(c("l_linenumber") % 2 == half)
    rf = c("l_returnflag")
    return _wide(li.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("gbifID"), (c("l_suppkey") % 25).alias("speciesKey"),
        F.concat(F.lit("Customer#"), F.lpad(c("l_partkey").cast("string"), 9, "0")).alias("scientificName"), F.lit("sp").alias("species"),
        F.when(rf == "A", F.lit("US")).when(rf == "R", F.lit("DE")).alias("countryCode"),
        F.when(c("l_linestatus") == "O", F.lit("PRESENT")).otherwise(F.lit("ABSENT")).alias("occurrenceStatus"),
        F.lit(None).cast("string").alias("stateProvince"), F.lit(None).cast("string").alias("county"),
        F.concat(F.lit("agg"), (c("l_partkey") % 7).cast("string")).alias("locality"),
        F.when(c("l_quantity") > 49, F.lit("unknown")).otherwise(F.year("l_shipdate").cast("string")).alias("year"),
        F.when(c("l_linenumber") == 3, F.lit(None).cast("double")).otherwise(c("l_quantity")).alias("decimalLatitude"),
        (c("l_partkey") % 90).cast("double").alias("decimalLongitude"),
        (c("l_extendedprice") * 2).alias("coordinateUncertaintyInMeters")), drops)


def _backbone(spark, d):
    cu = table(spark, d, "customer")
    k = c("c_custkey")
    acc = lambda x: F.concat(F.lit("acc"), (x % 40).cast("string"))
    return cu.select(
        acc(k).alias("NAME_OF_FUNGUS"), F.nullif(c("c_mktsegment"), F.lit("BUILDING")).alias("AUTHORS"), acc(k - k % 3).alias("CURRENT_NAME"),
        k.alias("RECORD_NUMBER"), F.when(k % 3 == 2, k - 1).otherwise(k).alias("BASIONYM_RECORD_NUMBER"),
        (k - k % 3).alias("CURRENT_NAME_RECORD_NUMBER"), (F.lit(1800) + c("c_nationkey") * 8).cast("int").alias("YEAR_OF_PUBLICATION"))


def _resolved(tag: str, names: str) -> str:
    """CTEs ``resolved_<tag>`` of the names in ``names`` (twin of ``plans.names.resolve_accepted``)."""
    return f"""matched_{tag} AS (
  SELECT q.NameAuthor AS searchName, b.usageKey, b.scientificName, b.confidence
  FROM {names} q LEFT JOIN best b ON q.NameAuthor IS NOT DISTINCT FROM b.searchName),
uniq_{tag} AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY searchName) AS n FROM matched_{tag}) t WHERE n = 1 AND confidence = 100),
named_{tag} AS (
  SELECT u.*, x.searchName FROM (SELECT usage.* FROM uniq_{tag} k JOIN usage ON k.usageKey = usage.key) u
  LEFT JOIN uniq_{tag} x ON u.scientificName IS NOT DISTINCT FROM x.scientificName),
resolved_{tag} AS (
  SELECT key, scientificName, species, coalesce(accepted, scientificName) AS accepted, taxonomicStatus,
         coalesce(acceptedKey, key) AS acceptedKey, searchName FROM (
    SELECT *, row_number() OVER (PARTITION BY scientificName ORDER BY searchName ASC NULLS LAST, key ASC NULLS LAST) AS rn
    FROM named_{tag}) t WHERE rn = 1)"""


def _synonym_sql(src: str) -> str:
    return f"""(SELECT coalesce(scientificName, accepted) AS NameAuthor, species AS acceptedName, accepted AS acceptedNameAuthor,
         acceptedKey AS gbifAcceptedKey FROM (
    SELECT scientificName, species, accepted, acceptedKey FROM (
      SELECT s.*, count(*) OVER (PARTITION BY s.scientificName) AS n FROM syn s
      WHERE s.acceptedKey IN (SELECT acceptedKey FROM {src})) x WHERE n = 1
    UNION ALL SELECT NULL, species, accepted, acceptedKey FROM {src}) y
  WHERE NOT coalesce(regexp_matches(coalesce(scientificName, accepted), '\\?'), false))"""


def _portal_sql(name: str, rank: int, prios: str, tag: str) -> str:
    return f"""{name} AS (
  SELECT {rank} AS file_, o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS taxonID,
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS scientificName, 'Auth' AS author, 'Customer' AS genus,
         lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS epithet,
         CASE WHEN o_orderstatus = 'O' THEN 'canada' WHEN o_orderstatus = 'F' THEN 'USA' ELSE 'Mexico' END AS country,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'XX' END AS countryCode,
         CASE WHEN month(o_orderdate) = 1 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS stateProvince,
         CASE WHEN month(o_orderdate) <= 6 THEN NULL ELSE CAST(month(o_orderdate) AS VARCHAR) END AS county,
         CASE WHEN day(o_orderdate) = 9 THEN '' ELSE '{tag}' || CAST(o_custkey % 4 AS VARCHAR) END AS locality,
         CAST(year(o_orderdate) AS DOUBLE) AS year,
         CASE WHEN day(o_orderdate) <= 5 THEN NULL
              ELSE (floor(o_totalprice / 50000) * CAST(4.5 AS DOUBLE) - 18) + CAST(o_orderkey % 5 AS DOUBLE) / 4096 END AS lat,
         CASE WHEN day(o_orderdate) <= 3 THEN NULL
              ELSE (CAST(o_custkey % 60 AS DOUBLE) * CAST(1.5 AS DOUBLE) - 45) + CAST(o_orderkey % 3 AS DOUBLE) / 4096 END AS lon,
         CASE WHEN day(o_orderdate) = 20 THEN NULL ELSE o_totalprice / 2 END AS unc
  FROM orders WHERE o_orderpriority IN ('1-URGENT', {prios}))"""


RECORD_COLS = "country, countryCode, stateProvince, county, locality, year, lat, lon, unc"

PIPELINE_SQL = f"""{CHECKLIST_INPUTS_SQL},
first0 AS (
  SELECT ScientificName, TaxonId, NULLIF(regexp_extract(ScientificName, '{W}', 0), '') AS Genus,
         CASE WHEN ScientificNameAuthorship IS NULL THEN ScientificName
              ELSE coalesce(ScientificName, 'NA') || ' ' || ScientificNameAuthorship END AS NameAuthor FROM portal),
first1 AS (
  SELECT * FROM first0 f WHERE NOT coalesce(regexp_matches(ScientificName, '\\.'), false)
    AND NOT EXISTS (SELECT 1 FROM micro m WHERE m.Species IS NOT DISTINCT FROM f.ScientificName OR m.Species IS NOT DISTINCT FROM f.Genus)),
macro AS (SELECT * FROM taxa WHERE subphylum_name IN ({_in(K.MACRO_SUBPHYLA)}) OR class_name IN ({_in(K.MACRO_CLASSES)})
                              OR order_name IN ({_in(K.MACRO_ORDERS)})),
second0 AS (
  SELECT p.*, NULLIF(regexp_extract(MycoBank, '{W}', 0), '') AS Genus,
         CASE WHEN Author IS NULL THEN MycoBank ELSE coalesce(MycoBank, 'NA') || ' ' || Author END AS NameAuthor FROM proto p),
checklist AS (
  SELECT NameAuthor, TaxonId FROM first1
  UNION ALL
  SELECT NameAuthor, CAST(NULL AS BIGINT) FROM second0 s
  WHERE current_name IS NOT NULL AND len(regexp_extract_all(MycoBank, '{W}')) >= 2
    AND NOT coalesce(regexp_matches(MycoBank, '\\.'), false)
    AND EXISTS (SELECT 1 FROM macro m WHERE m.genus_name IS NOT DISTINCT FROM s.Genus)
    AND NOT EXISTS (SELECT 1 FROM first1 f WHERE f.ScientificName IS NOT DISTINCT FROM s.MycoBank)),
{TRAINING_SQL},
cand AS (
  SELECT CASE WHEN l_linenumber % 2 = 0 THEN CASE WHEN p_size < 5 THEN p_name ELSE p_name || ' ' || p_brand END
              ELSE CAST(l_partkey AS VARCHAR) || CASE WHEN l_linestatus = 'O' THEN ' L.' ELSE ' Fr.' END END AS searchName,
         l_suppkey AS usageKey, 'taxon' || CAST(l_suppkey AS VARCHAR) AS scientificName,
         CAST(l_quantity AS INTEGER) + 50 AS confidence, {MATCH_TYPE_SQL} AS matchType
  FROM lineitem JOIN part ON l_partkey = p_partkey),
{USAGE_SQL},
syn AS (
  SELECT CAST(c_nationkey AS BIGINT) AS acceptedKey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'J.' || c_name ELSE c_name END || ' Auth' AS scientificName,
         'sp' || CAST(c_nationkey AS VARCHAR) AS species, 'acc' || CAST(c_nationkey AS VARCHAR) AS accepted FROM customer),
stats AS (
  SELECT searchName, bool_and(coalesce(matchType = 'NONE', false)) AS none_, bool_and(coalesce(matchType = 'HIGHERRANK', false)) AS higher_,
         max(confidence) AS top FROM cand GROUP BY searchName),
best AS (
  SELECT c.* FROM cand c WHERE EXISTS (
    SELECT 1 FROM stats u WHERE NOT none_ AND NOT higher_ AND u.searchName IS NOT DISTINCT FROM c.searchName
      AND u.top IS NOT DISTINCT FROM c.confidence)),
{_resolved("t", "training")},
acc_t AS (
  SELECT * FROM resolved_t WHERE NOT coalesce(taxonomicStatus IN ({_in(K.DROP_STATUS_ASSESSED)}), false)
    AND NOT coalesce(species IN ({_in(K.ASSESSED_UNDER_HETEROTYPIC_SYNONYM)}), false)),
threat AS (SELECT acc.accepted AS acceptedNameAuthor, t.Threatened
           FROM training t RIGHT JOIN acc_t acc ON t.NameAuthor IS NOT DISTINCT FROM acc.searchName),
unassessed AS (
  SELECT * FROM checklist c WHERE NOT EXISTS (SELECT 1 FROM training t WHERE t.NameAuthor IS NOT DISTINCT FROM c.NameAuthor)),
{_resolved("c", "unassessed")},
acc_c AS (SELECT * FROM resolved_c WHERE NOT coalesce(taxonomicStatus IN ({_in(K.DROP_STATUS_CHECKLIST)}), false)),
cl AS (
  SELECT u.TaxonId, acc.species AS acceptedName, acc.accepted AS acceptedNameAuthor
  FROM unassessed u RIGHT JOIN acc_c acc ON u.NameAuthor IS NOT DISTINCT FROM acc.searchName),
allnames AS (
  SELECT NameAuthor, acceptedName, acceptedNameAuthor, gbifAcceptedKey,
         regexp_replace(NameAuthor, '\\.([A-Z]\\p{{Ll}})', '. \\1', 'g') AS spaced FROM (
    SELECT *, count(*) OVER (PARTITION BY NameAuthor) AS n FROM (
      SELECT DISTINCT * FROM (SELECT * FROM {_synonym_sql("acc_t")} a UNION ALL SELECT DISTINCT * FROM {_synonym_sql("acc_c")} b) u) v) w
  WHERE n = 1),
{_portal_sql("f_ca", 0, "'2-HIGH', '3-MEDIUM'", "ca-")},
{_portal_sql("f_us", 1, "'4-NOT SPECIFIED', '5-LOW'", "us-")},
records AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_) AS rn FROM (
  SELECT * FROM f_ca UNION ALL SELECT * FROM f_us) u) t WHERE rn = 1),
routes AS (
  SELECT r.*, cl.acceptedNameAuthor, cl.acceptedName, 1 AS route FROM records r JOIN cl ON r.taxonID = cl.TaxonId
  UNION ALL
  SELECT r.*, n.acceptedNameAuthor, n.acceptedName, 2 AS route
  FROM records r LEFT JOIN allnames n ON r.scientificName || ' ' || r.author = n.spaced
  WHERE r.scientificName || ' ' || r.author IN (SELECT spaced FROM allnames UNION SELECT NameAuthor FROM allnames)),
matched AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY route, acceptedNameAuthor ASC NULLS LAST, acceptedName ASC NULLS LAST) AS best_
  FROM routes) t WHERE best_ = 1),
agg AS (
  SELECT l_orderkey * 10 + l_linenumber AS gbifID, CAST(NULL AS VARCHAR) AS country,
         CASE WHEN l_returnflag = 'A' THEN 'US' WHEN l_returnflag = 'R' THEN 'DE' END AS countryCode, CAST(NULL AS VARCHAR) AS stateProvince,
         CAST(NULL AS VARCHAR) AS county, 'agg' || CAST(l_partkey % 7 AS VARCHAR) AS locality,
         CASE WHEN l_quantity > 49 THEN NULL ELSE CAST(year(l_shipdate) AS DOUBLE) END AS year,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS lat, CAST(l_partkey % 90 AS DOUBLE) AS lon,
         l_extendedprice * 2 AS unc, k.acceptedNameAuthor
  FROM lineitem JOIN (SELECT DISTINCT gbifAcceptedKey, acceptedName, acceptedNameAuthor FROM allnames) k
    ON l_suppkey % 25 IS NOT DISTINCT FROM k.gbifAcceptedKey
  WHERE NOT coalesce(l_returnflag = 'A', false) AND l_linestatus = 'O'),
occs AS (
  SELECT uid, acceptedNameAuthor, year, locality, stateProvince, county, lat AS decimalLatitude, lon AS decimalLongitude,
         unc AS coordinateUncertaintyInMeters,
         coalesce(countryCode, CASE WHEN country IN ({_in(K.COUNTRY_CODES["CA"])}) THEN 'CA'
                                    WHEN country IN ({_in(K.COUNTRY_CODES["US"])}) THEN 'US' END) AS countryCode
  FROM (
    SELECT CAST(id AS VARCHAR) || 'm' AS uid, id, acceptedNameAuthor, {RECORD_COLS} FROM matched
    UNION ALL
    SELECT CAST(gbifID AS VARCHAR) || 'g', NULL, acceptedNameAuthor, {RECORD_COLS} FROM agg) a
  WHERE EXISTS (SELECT 1 FROM matched m WHERE m.acceptedNameAuthor IS NOT DISTINCT FROM a.acceptedNameAuthor)
    AND (id IS NULL OR id NOT IN ({", ".join(map(str, K.ROGUE_RECORD_IDS))}))),
{CENTROIDS_SQL},
flagged AS (SELECT occs.*, {flags_sql('occs', 'decimalLatitude', 'decimalLongitude', 'coordinateUncertaintyInMeters')} FROM occs),
ref AS (
  SELECT countryCode, stateProvince, county, locality, decimalLatitude AS lat_y, decimalLongitude AS lon_y FROM (
    SELECT *, row_number() OVER (PARTITION BY countryCode, stateProvince, county, locality ORDER BY uid) AS rn FROM flagged
    WHERE georeferenced = true AND locality IS NOT NULL AND locality <> '' AND stateProvince IS NOT NULL) r WHERE rn = 1),
filled AS (
  SELECT t.uid, t.acceptedNameAuthor, t.year, t.locality, coalesce(t.decimalLatitude, r.lat_y) AS decimalLatitude,
         coalesce(t.decimalLongitude, r.lon_y) AS decimalLongitude, t.cc_zero, t.cc_equ, t.clean_tests, t.cc_err
  FROM (SELECT * FROM flagged WHERE decimalLatitude IS NULL AND locality IS NOT NULL AND locality <> '') t LEFT JOIN ref r
    ON t.countryCode IS NOT DISTINCT FROM r.countryCode AND t.stateProvince IS NOT DISTINCT FROM r.stateProvince
   AND t.county IS NOT DISTINCT FROM r.county AND t.locality IS NOT DISTINCT FROM r.locality),
cleaned AS (
  SELECT DISTINCT uid, acceptedNameAuthor, year, locality, decimalLatitude, decimalLongitude, georeferenced, cc_zero, cc_equ, clean_tests, cc_err
  FROM flagged WHERE NOT (decimalLatitude IS NULL AND locality IS NOT NULL AND locality <> '')
  UNION ALL
  SELECT uid, acceptedNameAuthor, year, locality, decimalLatitude, decimalLongitude, decimalLatitude IS NOT NULL,
         decimalLatitude IS NOT NULL OR cc_zero, decimalLatitude IS NOT NULL OR cc_equ,
         decimalLatitude IS NOT NULL OR clean_tests, decimalLatitude IS NOT NULL OR cc_err FROM filled),
gated AS (SELECT * FROM cleaned
          WHERE georeferenced = false OR ((cc_equ AND cc_zero AND clean_tests AND cc_err) OR cc_err IS NULL)),
cnt AS (
  SELECT acceptedNameAuthor, count(*) AS specimenCount FROM (
    SELECT acceptedNameAuthor FROM (SELECT DISTINCT acceptedNameAuthor, locality FROM gated WHERE locality IS NOT NULL AND georeferenced = false) a
    UNION ALL
    SELECT acceptedNameAuthor FROM (SELECT DISTINCT acceptedNameAuthor, {sql_round('decimalLatitude', 3)} AS rl,
                                           {sql_round('decimalLongitude', 3)} AS rn FROM gated WHERE georeferenced = true) b
    UNION ALL
    SELECT acceptedNameAuthor FROM gated WHERE locality IS NULL AND georeferenced = false) u
  GROUP BY acceptedNameAuthor),
d1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acceptedNameAuthor, locality, year ORDER BY uid) AS rn1 FROM gated) t WHERE rn1 = 1),
d2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acceptedNameAuthor, decimalLatitude, decimalLongitude, year ORDER BY uid) AS rn2
                      FROM d1) t WHERE rn2 = 1),
share AS (SELECT acceptedNameAuthor, coalesce(avg(CASE WHEN year > 1992 THEN CAST(1 AS DOUBLE) WHEN year IS NOT NULL THEN CAST(0 AS DOUBLE) END),
                 CAST(0 AS DOUBLE)) AS propContemporary FROM d2 GROUP BY acceptedNameAuthor),
bb AS (
  SELECT 'acc' || CAST(c_custkey % 40 AS VARCHAR) AS name_, 'acc' || CAST((c_custkey - c_custkey % 3) % 40 AS VARCHAR) AS current_,
         c_custkey AS rec, CASE WHEN c_custkey % 3 = 2 THEN c_custkey - 1 ELSE c_custkey END AS basionym, c_custkey - c_custkey % 3 AS current_rec,
         CAST(1800 + c_nationkey * 8 AS INTEGER) AS y
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
wanted AS (SELECT DISTINCT acceptedNameAuthor FROM allnames),
y1 AS (SELECT b.current_ AS acceptedNameAuthor, (SELECT min(y) FROM bb s WHERE s.rec = s.basionym AND s.current_ = b.current_) AS yearPublished
       FROM (SELECT DISTINCT current_ FROM bb WHERE rec = current_rec OR name_ = current_) b
       WHERE b.current_ IN (SELECT acceptedNameAuthor FROM wanted)),
y2 AS (SELECT b.name_ AS acceptedNameAuthor, (SELECT min(y) FROM bb s WHERE s.rec = s.basionym AND s.name_ = b.name_) AS yearPublished
       FROM (SELECT DISTINCT name_ FROM bb) b
       WHERE b.name_ IN (SELECT acceptedNameAuthor FROM wanted) AND b.name_ NOT IN (SELECT acceptedNameAuthor FROM y1)),
yall AS (SELECT * FROM y1 UNION ALL SELECT * FROM y2)
SELECT cnt.acceptedNameAuthor, cnt.specimenCount, share.propContemporary, {sql_round('ln(CAST(cnt.specimenCount AS DOUBLE))', 6)} AS logSpecimenCount,
       yall.yearPublished, threat.Threatened
FROM cnt JOIN share USING (acceptedNameAuthor) JOIN yall USING (acceptedNameAuthor) LEFT JOIN threat USING (acceptedNameAuthor)
WHERE yall.yearPublished IS NOT NULL"""


@register("pipeline_predictors", f"WITH {PIPELINE_SQL}")
def pipeline_predictors(spark, d):
    """From the raw checklists, assessments, candidates and records to the predictor table, each stage written and read again."""
    inputs = Inputs(
        _portal_checklist(spark, d), _micro(spark, d), _taxa(spark, d), _proto(spark, d), _assessments(spark, d), _taxonomy(spark, d),
        _natureserve(spark, d), _candidates(spark, d), usage(spark, d), _synonyms(spark, d),
        [_portal_file(spark, d, ("2-HIGH", "3-MEDIUM"), "ca-", K.PORTAL_CA_DROP),
         _portal_file(spark, d, ("4-NOT SPECIFIED", "5-LOW"), "us-", K.PORTAL_US_DROP)],
        [_aggregator_file(spark, d, 0, K.AGGREGATOR_DROP), _aggregator_file(spark, d, 1, K.AGGREGATOR_DROP)],
        centroids(spark, d), _backbone(spark, d), [K.PORTAL_CA_DROP, K.PORTAL_US_DROP], [K.AGGREGATOR_DROP] * 2)
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    no_manual = spark.createDataFrame([], P.MANUAL_SCHEMA)
    table_, _ = run_predictors(spark, inputs, out, radius_m=CENTROID_RADIUS_M, manual=no_manual)
    return table_.withColumn("logSpecimenCount", round_half_up("logSpecimenCount", 6))
