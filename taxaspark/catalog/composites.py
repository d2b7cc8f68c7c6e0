"""Registered queries for the composite operators that start from several raw tables:
combining checklists, labelling assessed species, and filtering occurrence records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import checklists as CL
from ..plans import constants as K
from ..plans import names as N
from ..plans import occurrences as O
from .names import resolve_sql
from .registry import register
from .standins import MATCH_TYPE_SQL, WORD_SQL, c, match_type, table, usage

W = WORD_SQL


def _in(values) -> str:
    """A SQL list of the fixed values."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ------------------------------------------------------------------ combine checklists
def _portal_checklist(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.when(c("p_size") > 45, F.concat(c("p_name"), F.lit(" var. x"))).otherwise(c("p_name")).alias("ScientificName"),
        F.when(c("p_size") < 5, F.lit(None).cast("string")).otherwise(c("p_brand")).alias("ScientificNameAuthorship"),
        c("p_partkey").alias("TaxonId"))


def _micro(spark, d):
    return table(spark, d, "part").select(F.lower("p_type").alias("Species")).distinct()


def _taxa(spark, d):
    seg = c("c_mktsegment")
    return table(spark, d, "customer").select(
        F.when(seg.isin("MACHINERY", "BUILDING"), F.lit("Agaricomycotina")).otherwise(F.lit("Pezizomycotina")).alias("subphylum_name"),
        F.when(seg == "FURNITURE", F.lit("Pezizomycetes")).otherwise(F.lit("Other")).alias("class_name"),
        F.when(seg == "HOUSEHOLD", F.lit(None).cast("string")).otherwise(F.lit("Ord")).alias("order_name"),
        F.lower(seg).alias("genus_name")).distinct()


def _proto(spark, d):
    cu = table(spark, d, "customer")
    base = F.concat(F.lower("c_mktsegment"), F.lit(" "), c("c_name"))
    nk = c("c_nationkey")
    return cu.select(
        F.when(nk == 1, F.concat(base, F.lit(" var."))).when(nk == 2, F.lower("c_mktsegment")).otherwise(base).alias("MycoBank"),
        F.when(c("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Auth"), nk.cast("string"))).alias("Author"),
        F.when(nk == 3, F.lit(None).cast("string")).otherwise(F.lit("placed")).alias("current_name"))


CHECKLIST_INPUTS_SQL = """portal AS (
  SELECT CASE WHEN p_size > 45 THEN p_name || ' var. x' ELSE p_name END AS ScientificName,
         CASE WHEN p_size < 5 THEN NULL ELSE p_brand END AS ScientificNameAuthorship, p_partkey AS TaxonId
  FROM part),
micro AS (SELECT DISTINCT lower(p_type) AS Species FROM part),
taxa AS (
  SELECT DISTINCT CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Agaricomycotina' ELSE 'Pezizomycotina' END AS subphylum_name,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Pezizomycetes' ELSE 'Other' END AS class_name,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 'Ord' END AS order_name,
         lower(c_mktsegment) AS genus_name
  FROM customer),
proto AS (
  SELECT CASE WHEN c_nationkey = 1 THEN lower(c_mktsegment) || ' ' || c_name || ' var.'
              WHEN c_nationkey = 2 THEN lower(c_mktsegment)
              ELSE lower(c_mktsegment) || ' ' || c_name END AS MycoBank,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE 'Auth' || CAST(c_nationkey AS VARCHAR) END AS Author,
         CASE WHEN c_nationkey = 3 THEN NULL ELSE 'placed' END AS current_name
  FROM customer)"""


@register("combine_checklists", rf"""WITH {CHECKLIST_INPUTS_SQL},
first0 AS (
  SELECT ScientificName, ScientificNameAuthorship, TaxonId,
         NULLIF(regexp_extract(ScientificName, '{W}', 0), '') AS Genus, 'Mycoportal' AS Source,
         CASE WHEN ScientificNameAuthorship IS NULL THEN ScientificName
              ELSE coalesce(ScientificName, 'NA') || ' ' || ScientificNameAuthorship END AS NameAuthor
  FROM portal),
first1 AS (
  SELECT * FROM first0 f
  WHERE NOT coalesce(regexp_matches(ScientificName, '\.'), false)
    AND NOT EXISTS (SELECT 1 FROM micro m WHERE m.Species IS NOT DISTINCT FROM f.ScientificName)
    AND NOT EXISTS (SELECT 1 FROM micro m WHERE m.Species IS NOT DISTINCT FROM f.Genus)),
macro AS (SELECT * FROM taxa WHERE subphylum_name = 'Agaricomycotina' OR class_name = 'Geoglossomycetes'
                              OR class_name = 'Pezizomycetes' OR order_name = 'Xylariales'),
second0 AS (
  SELECT p.*, NULLIF(regexp_extract(MycoBank, '{W}', 0), '') AS Genus,
         CASE WHEN Author IS NULL THEN MycoBank ELSE coalesce(MycoBank, 'NA') || ' ' || Author END AS NameAuthor
  FROM proto p),
second1 AS (
  SELECT MycoBank AS ScientificName, Author AS ScientificNameAuthorship, Genus, NameAuthor, 'Protochecklist' AS Source
  FROM second0 s
  WHERE current_name IS NOT NULL AND len(regexp_extract_all(MycoBank, '{W}')) >= 2
    AND NOT coalesce(regexp_matches(MycoBank, '\.'), false)
    AND EXISTS (SELECT 1 FROM macro m WHERE m.genus_name IS NOT DISTINCT FROM s.Genus)
    AND NOT EXISTS (SELECT 1 FROM first1 f WHERE f.ScientificName IS NOT DISTINCT FROM s.MycoBank))
SELECT ScientificName, ScientificNameAuthorship, TaxonId, Genus, Source, NameAuthor FROM first1
UNION ALL
SELECT ScientificName, ScientificNameAuthorship, CAST(NULL AS BIGINT), Genus, Source, NameAuthor FROM second1""")
def combine_checklists(spark, d):
    """Both checklists with genus, name + author and source; infraspecific, micro and duplicate names removed."""
    return CL.combine_checklists(_portal_checklist(spark, d), _micro(spark, d), _taxa(spark, d), _proto(spark, d))


# ------------------------------------------------------------------ training labels
def _assessments(spark, d):
    p = table(spark, d, "part")
    cat = (F.when(c("p_type") == "SMALL", F.lit("Least Concern")).when(c("p_type") == "LARGE", F.lit("Near Threatened"))
           .when(c("p_type") == "PROMO", F.lit("Data Deficient")).when(c("p_type") == "MEDIUM", F.lit(None).cast("string"))
           .otherwise(F.lit("Endangered")))
    key = c("p_partkey").cast("string")         # a name that the taxonomy lacks: not assessed
    return p.select(F.when(c("p_size") <= 30, key).otherwise(F.concat(key, F.lit("*"))).alias("scientificName"),
                    cat.alias("redlistCategory"))


def _taxonomy(spark, d):
    p = table(spark, d, "part")
    return p.select(c("p_partkey").cast("string").alias("scientificName"),
                    F.when(c("p_size") > 20, F.lit("Fr.")).otherwise(F.lit("L.")).alias("authority"))


def _natureserve(spark, d):
    key = c("p_partkey").cast("string")         # a name that no candidate has: not resolved
    name = F.when(c("p_size") > 20, key).otherwise(F.concat(key, F.lit("+")))
    return table(spark, d, "part").select(name.alias("scientificName"), F.lit("Fr.").alias("scientificNameAuthor"),
                    F.concat(F.lit("G"), (c("p_size") % 5).cast("string")).alias("roundedGRank"))


def _training_candidates(spark, d):
    return table(spark, d, "lineitem").select(
        F.concat(c("l_partkey").cast("string"), F.when(c("l_linestatus") == "O", F.lit(" L.")).otherwise(F.lit(" Fr."))).alias("searchName"),
        c("l_suppkey").alias("usageKey"),
        F.concat(F.lit("taxon"), c("l_suppkey").cast("string")).alias("scientificName"),
        c("l_linestatus").alias("rank"), (c("l_quantity").cast("int") + 50).alias("confidence"),
        match_type().alias("matchType"))


TRAINING_SQL = f"""rl AS (
  SELECT a.scientificName, a.redlistCategory, t.authority,
         coalesce(a.scientificName, 'NA') || ' ' || coalesce(t.authority, 'NA') AS NameAuthor,
         CASE WHEN coalesce(a.redlistCategory IN ({_in(K.NOT_THREATENED_CATEGORIES)}), false) THEN 0 ELSE 1 END AS Threatened,
         'RedList' AS Source
  FROM (SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_size <= 30 THEN '' ELSE '*' END AS scientificName,
               CASE WHEN p_type = 'SMALL' THEN 'Least Concern' WHEN p_type = 'LARGE' THEN 'Near Threatened'
                    WHEN p_type = 'PROMO' THEN 'Data Deficient' WHEN p_type = 'MEDIUM' THEN NULL
                    ELSE 'Endangered' END AS redlistCategory
        FROM part) a
  JOIN (SELECT CAST(p_partkey AS VARCHAR) AS scientificName, CASE WHEN p_size > 20 THEN 'Fr.' ELSE 'L.' END AS authority
        FROM part) t ON a.scientificName IS NOT DISTINCT FROM t.scientificName
  WHERE a.redlistCategory <> 'Data Deficient'),
ns AS (
  SELECT coalesce(scientificName, 'NA') || ' ' || coalesce(scientificNameAuthor, 'NA') AS NameAuthor,
         CASE WHEN coalesce(roundedGRank IN ({_in(K.THREATENED_GRANKS)}), false) THEN 1 ELSE 0 END AS Threatened,
         'NatureServe' AS Source, scientificName
  FROM (SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_size > 20 THEN '' ELSE '+' END AS scientificName,
               'Fr.' AS scientificNameAuthor, 'G' || CAST(p_size % 5 AS VARCHAR) AS roundedGRank FROM part) n
  WHERE NOT EXISTS (SELECT 1 FROM rl WHERE rl.scientificName IS NOT DISTINCT FROM n.scientificName)),
training AS (
  SELECT NameAuthor, Source, Threatened FROM (
    SELECT NameAuthor, Source, Threatened FROM rl UNION ALL SELECT NameAuthor, Source, Threatened FROM ns) u
  WHERE NOT coalesce(NameAuthor IN ({_in(K.KNOWN_ISSUE_NAMES)}), false))"""

TRAINING_NAMES_SQL = f"""{TRAINING_SQL},
names AS (SELECT NameAuthor FROM training)"""

TRAINING_CAND_SQL = f"""cand AS (
  SELECT CAST(l_partkey AS VARCHAR) || CASE WHEN l_linestatus = 'O' THEN ' L.' ELSE ' Fr.' END AS searchName,
         l_suppkey AS usageKey, 'taxon' || CAST(l_suppkey AS VARCHAR) AS scientificName, l_linestatus AS rank,
         CAST(l_quantity AS INTEGER) + 50 AS confidence,
         {MATCH_TYPE_SQL} AS matchType
  FROM lineitem)"""


@register("training_table", f"""WITH {resolve_sql(TRAINING_NAMES_SQL, TRAINING_CAND_SQL)},
acc AS (
  SELECT searchName, coalesce(accepted, scientificName) AS accepted, species FROM resolved
  WHERE NOT coalesce(taxonomicStatus IN ('DOUBTFUL', 'HETEROTYPIC_SYNONYM'), false)
    AND NOT coalesce(species IN ({_in(K.ASSESSED_UNDER_HETEROTYPIC_SYNONYM)}), false))
SELECT acc.searchName AS NameAuthor, t.Source, t.Threatened, acc.accepted AS acceptedNameAuthor, acc.species AS acceptedName
FROM training t RIGHT JOIN acc ON t.NameAuthor IS NOT DISTINCT FROM acc.searchName""")
def training_table(spark, d):
    """Assessed species from two sources, labelled, resolved to accepted names (right join)."""
    rl = N.redlist_labels(_assessments(spark, d), _taxonomy(spark, d))
    ns = N.natureserve_labels(_natureserve(spark, d), rl)
    training = N.assessed_species(rl, ns)
    acc = N.accepted_assessed(training, _training_candidates(spark, d), usage(spark, d))
    return N.training_table(training, acc)


# ------------------------------------------------------------------ occurrence records
def _all_names(spark, d):
    cu = table(spark, d, "customer")
    nk = c("c_nationkey").cast("string")
    return cu.select(
        F.concat(c("c_name"), F.lit(" Auth")).alias("NameAuthor"),
        F.concat(F.lit("sp"), nk).alias("acceptedName"), F.concat(F.lit("acc"), nk).alias("acceptedNameAuthor"),
        c("c_nationkey").cast("long").alias("gbifAcceptedKey"),
        F.when(c("c_mktsegment") == "MACHINERY", F.concat(c("c_name"), F.lit(" Auth."))).otherwise(
            F.concat(c("c_name"), F.lit(" Auth"))).alias("mycoportalNameAuthor"))


def _checklist_filtered(spark, d):
    s = table(spark, d, "supplier")
    nk = c("s_nationkey").cast("string")
    return s.select(F.when(c("s_acctbal") < 0, F.lit(None).cast("long")).otherwise(c("s_suppkey")).alias("TaxonId"),
                    F.concat(F.lit("acc"), nk).alias("acceptedNameAuthor"), F.concat(F.lit("sp"), nk).alias("acceptedName"))


def _portal_file(spark, d, priorities, tag):
    o = table(spark, d, "orders").filter(c("o_orderpriority").isin(*priorities))
    st = c("o_orderstatus")
    return o.select(
        c("o_orderkey").alias("id"),
        F.when(c("o_orderpriority") == "1-URGENT", c("o_custkey")).alias("taxonID"),
        F.concat(F.lit("Customer#"), F.lpad(c("o_custkey").cast("string"), 9, "0")).alias("scientificName"),
        F.when(st == "P", F.lit(None).cast("string")).otherwise(F.lit("Auth")).alias("scientificNameAuthorship"),
        F.lit("Customer").alias("genus"), F.lpad(c("o_custkey").cast("string"), 9, "0").alias("specificEpithet"),
        F.when(st == "O", F.lit("canada")).when(st == "F", F.lit("USA")).otherwise(F.lit("Mexico")).alias("country"),
        F.when(c("o_orderpriority") == "5-LOW", F.lit("XX")).alias("countryCode"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit(tag), c("o_orderpriority")).alias("locality"))


def _aggregator_file(spark, d, low):
    li = table(spark, d, "lineitem")
    li = li.filter(c("l_discount") < 0.05) if low else li.filter(c("l_discount") >= 0.05)
    rf = c("l_returnflag")
    return li.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("gbifID"), c("l_suppkey").alias("speciesKey"),
        F.concat(F.lit("Customer#"), F.lpad(c("l_partkey").cast("string"), 9, "0")).alias("scientificName"),
        F.lit("sp").alias("species"),
        F.when(rf == "A", F.lit("US")).when(rf == "R", F.lit("DE")).alias("countryCode"),
        F.when(c("l_linestatus") == "O", F.lit("PRESENT")).otherwise(F.lit("ABSENT")).alias("occurrenceStatus"),
        F.when(c("l_quantity") > 49, F.lit("unknown")).otherwise(F.year("l_shipdate").cast("string")).alias("year"),
        F.lit("agg").alias("locality"))


def _portal_sql(name: str, prios: str, tag: str, rank: int) -> str:
    return f"""{name} AS (
  SELECT {rank} AS file_, o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS taxonID,
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS scientificName,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Auth' END AS scientificNameAuthorship,
         'Customer' AS genus, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS specificEpithet,
         CASE WHEN o_orderstatus = 'O' THEN 'canada' WHEN o_orderstatus = 'F' THEN 'USA' ELSE 'Mexico' END AS country,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'XX' END AS countryCode,
         CAST(year(o_orderdate) AS INTEGER) AS year, '{tag}' || o_orderpriority AS locality
  FROM orders WHERE o_orderpriority IN ({prios}))"""


def _agg_sql(name: str, cond: str) -> str:
    return f"""{name} AS (
  SELECT l_orderkey * 10 + l_linenumber AS gbifID, l_suppkey AS speciesKey,
         'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS scientificName, 'sp' AS species,
         CASE WHEN l_returnflag = 'A' THEN 'US' WHEN l_returnflag = 'R' THEN 'DE' END AS countryCode,
         CASE WHEN l_linestatus = 'O' THEN 'PRESENT' ELSE 'ABSENT' END AS occurrenceStatus,
         CASE WHEN l_quantity > 49 THEN 'unknown' ELSE CAST(year(l_shipdate) AS VARCHAR) END AS year,
         'agg' AS locality
  FROM lineitem WHERE {cond})"""


CA_PRIOS, US_PRIOS = ("1-URGENT", "2-HIGH", "3-MEDIUM"), ("3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "1-URGENT")
PORTAL_COLS = ("id, taxonID, scientificName, scientificNameAuthorship, genus, specificEpithet, country, countryCode, "
               "year, locality")


def _q(xs):
    return ", ".join(f"'{x}'" for x in xs)


OCC_SQL = f"""{_portal_sql('f_ca', _q(CA_PRIOS), 'ca-', 0)},
{_portal_sql('f_us', _q(US_PRIOS), 'us-', 1)},
{_agg_sql('a_low', 'l_discount < 0.05')},
{_agg_sql('a_high', 'l_discount >= 0.05')},
allnames AS (
  SELECT c_name || ' Auth' AS NameAuthor, 'sp' || CAST(c_nationkey AS VARCHAR) AS acceptedName,
         'acc' || CAST(c_nationkey AS VARCHAR) AS acceptedNameAuthor, CAST(c_nationkey AS BIGINT) AS gbifAcceptedKey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || ' Auth.' ELSE c_name || ' Auth' END AS mycoportalNameAuthor
  FROM customer),
cl AS (
  SELECT CASE WHEN s_acctbal < 0 THEN NULL ELSE s_suppkey END AS TaxonId,
         'acc' || CAST(s_nationkey AS VARCHAR) AS acceptedNameAuthor, 'sp' || CAST(s_nationkey AS VARCHAR) AS acceptedName
  FROM supplier),
portal AS (
  SELECT {PORTAL_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY file_) AS rn FROM (
      SELECT * FROM f_ca UNION ALL SELECT * FROM f_us) u) t WHERE rn = 1),
r1 AS (
  SELECT p.*, cl.acceptedNameAuthor, cl.acceptedName,
         coalesce(p.genus, 'NA') || ' ' || coalesce(p.specificEpithet, 'NA') || ' ' || coalesce(p.scientificNameAuthorship, 'NA') AS NameAuthor,
         1 AS route
  FROM portal p JOIN cl ON p.taxonID = cl.TaxonId WHERE p.taxonID IS NOT NULL AND cl.TaxonId IS NOT NULL),
r2a AS (
  SELECT p.*, coalesce(p.scientificName, 'NA') || ' ' || coalesce(p.scientificNameAuthorship, 'NA') AS NameAuthor FROM portal p),
r2 AS (
  SELECT r.{PORTAL_COLS.replace(', ', ', r.')}, n.acceptedNameAuthor, n.acceptedName, r.NameAuthor, 2 AS route
  FROM r2a r LEFT JOIN allnames n ON r.NameAuthor IS NOT DISTINCT FROM n.mycoportalNameAuthor
  WHERE r.NameAuthor IN (SELECT mycoportalNameAuthor FROM allnames UNION SELECT NameAuthor FROM allnames)),
both_ AS (SELECT DISTINCT * FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2) u),
matched AS (
  SELECT {PORTAL_COLS}, acceptedNameAuthor, acceptedName, NameAuthor FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY route, taxonID ASC NULLS LAST, scientificName ASC NULLS LAST,
           scientificNameAuthorship ASC NULLS LAST, genus ASC NULLS LAST, specificEpithet ASC NULLS LAST,
           country ASC NULLS LAST, countryCode ASC NULLS LAST, year ASC NULLS LAST, locality ASC NULLS LAST,
           acceptedNameAuthor ASC NULLS LAST, acceptedName ASC NULLS LAST, NameAuthor ASC NULLS LAST) AS rn
    FROM both_) t WHERE rn = 1),
keys AS (SELECT DISTINCT gbifAcceptedKey, acceptedName, acceptedNameAuthor FROM allnames),
agg AS (
  SELECT a.gbifID, a.speciesKey, a.scientificName AS NameAuthor, a.species AS scientificName, a.countryCode,
         a.occurrenceStatus, a.year, a.locality, k.acceptedName, k.acceptedNameAuthor
  FROM (SELECT * FROM a_low UNION ALL SELECT * FROM a_high) a
  JOIN keys k ON a.speciesKey IS NOT DISTINCT FROM k.gbifAcceptedKey
  WHERE NOT coalesce(a.countryCode IN ('US', 'CA'), false) AND a.occurrenceStatus <> 'ABSENT'),
allocc AS (
  SELECT id, CAST(NULL AS BIGINT) AS gbifID, country, countryCode, CAST(year AS DOUBLE) AS year, locality,
         NameAuthor, acceptedNameAuthor, acceptedName FROM matched
  UNION ALL
  SELECT CAST(NULL AS BIGINT), gbifID, CAST(NULL AS VARCHAR), countryCode, TRY_CAST(year AS DOUBLE), locality,
         NameAuthor, acceptedNameAuthor, acceptedName FROM agg),
final AS (
  SELECT CASE WHEN gbifID IS NULL THEN 'MycoPortal' ELSE 'GBIF' END AS Source,
         CASE WHEN id IS NULL THEN coalesce(CAST(gbifID AS VARCHAR), 'NA') || 'g' ELSE CAST(id AS VARCHAR) || 'm' END AS uniqueCombinedID,
         coalesce(countryCode, CASE WHEN country IN ('Canada', 'canada', 'CANADA') THEN 'CA'
                                    WHEN country IN ('United States', 'USA', 'US', 'U.S.A.', 'United States of America', 'usa') THEN 'US'
                               END) AS countryCode,
         year, locality, NameAuthor, acceptedNameAuthor, acceptedName
  FROM allocc a
  WHERE EXISTS (SELECT 1 FROM matched m WHERE m.acceptedNameAuthor IS NOT DISTINCT FROM a.acceptedNameAuthor))"""


@register("filter_occurrences", f"""WITH {OCC_SQL}
SELECT uniqueCombinedID, Source, countryCode, year, locality, NameAuthor, acceptedNameAuthor, acceptedName FROM final""")
def filter_occurrences(spark, d):
    """Portal records (two files, first wins per id; taxon-id route before name route) and aggregator
    records of the wanted keys, merged, tagged, country codes filled, species gate applied."""
    out = O.filter_occurrences(
        [_portal_file(spark, d, CA_PRIOS, "ca-"), _portal_file(spark, d, US_PRIOS, "us-")],
        [_aggregator_file(spark, d, True), _aggregator_file(spark, d, False)],
        _all_names(spark, d), _checklist_filtered(spark, d))
    return out.select("uniqueCombinedID", "Source", "countryCode", "year", "locality", "NameAuthor",
                      "acceptedNameAuthor", "acceptedName")


# ------------------------------------------------------------------ unassessed checklist
def _checklist_names(spark, d):
    p = table(spark, d, "part")
    return p.select(F.concat(c("p_partkey").cast("string"), F.when(c("p_size") > 25, F.lit(" L.")).otherwise(F.lit(" Fr.")))
                    .alias("NameAuthor"), c("p_brand").alias("Source"), c("p_partkey").alias("TaxonId"))


CHECKLIST_NAMES_SQL = f"""{TRAINING_SQL},
checklist AS (
  SELECT CAST(p_partkey AS VARCHAR) || CASE WHEN p_size > 25 THEN ' L.' ELSE ' Fr.' END AS NameAuthor,
         p_brand AS Source, p_partkey AS TaxonId FROM part),
unassessed AS (
  SELECT * FROM checklist c WHERE NOT EXISTS (SELECT 1 FROM training t WHERE t.NameAuthor IS NOT DISTINCT FROM c.NameAuthor)),
names AS (SELECT NameAuthor FROM unassessed)"""


@register("checklist_table", f"""WITH {resolve_sql(CHECKLIST_NAMES_SQL, TRAINING_CAND_SQL)},
acc AS (
  SELECT searchName, species, coalesce(accepted, scientificName) AS accepted, coalesce(acceptedKey, key) AS acceptedKey
  FROM resolved WHERE NOT coalesce(taxonomicStatus IN ('DOUBTFUL'), false))
SELECT acc.searchName AS NameAuthor, u.Source, u.TaxonId, acc.species AS acceptedName,
       acc.accepted AS acceptedNameAuthor, acc.acceptedKey AS gbifAcceptedKey
FROM unassessed u RIGHT JOIN acc ON u.NameAuthor IS NOT DISTINCT FROM acc.searchName""")
def checklist_table(spark, d):
    """Checklist names not assessed, resolved (doubtful dropped, accepted name and key filled), right join."""
    rl = N.redlist_labels(_assessments(spark, d), _taxonomy(spark, d))
    training = N.assessed_species(rl, N.natureserve_labels(_natureserve(spark, d), rl))
    unassessed = N.unassessed_checklist(_checklist_names(spark, d), training)
    acc = N.accepted_checklist(unassessed, _training_candidates(spark, d), usage(spark, d))
    return N.checklist_table(unassessed, acc)


# ------------------------------------------------------------------ sub-steps of the composites
@register("assessed_species", f"""WITH {TRAINING_SQL}
SELECT NameAuthor, Source, Threatened FROM training""")
def assessed_species(spark, d):
    """Both assessment sources labelled 0/1, the second minus names of the first, problem names removed."""
    rl = N.redlist_labels(_assessments(spark, d), _taxonomy(spark, d))
    return N.assessed_species(rl, N.natureserve_labels(_natureserve(spark, d), rl))


@register("portal_records", f"""WITH {OCC_SQL}
SELECT {PORTAL_COLS} FROM portal""")
def portal_records(spark, d):
    """Two portal files bound by name, one record per id, the earlier file winning."""
    return O.portal_records([_portal_file(spark, d, CA_PRIOS, "ca-"), _portal_file(spark, d, US_PRIOS, "us-")])


#: rows that one task sorts and writes of a download (at least three parts a file)
RANGE_ROWS = 250_000


def _downloads(spark, d):
    """The two portal files as delimited text with unlike headers; each record has a second copy of its id further down."""
    from ..sources.io import read_delimited
    from .basic import _folder
    path, out = _folder(spark, "portal"), []
    for i, (prios, tag) in enumerate(((CA_PRIOS, "ca-"), (US_PRIOS, "us-"))):
        f = _portal_file(spark, d, prios, tag)
        copies = f.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
        later = [F.when(c("copy") == 0, c(n)).otherwise(F.lit("later copy")).alias(n) if n == "locality" else c(n) for n in f.columns]
        names = f.columns if i else f.columns[::-1]
        ranges = max(3, -(-2 * f.count() // RANGE_ROWS))
        copies.repartitionByRange(ranges, "copy", "id").sortWithinPartitions("copy", "id").select("copy", *later).select(*names) \
            .write.option("header", True).option("escape", '"').csv(f"{path}/{i}")
        out.append(read_delimited(spark, f"{path}/{i}", f.schema, na_value="", ordered=True))
    return out


@register("portal_records_in_file_order", f"""WITH {OCC_SQL}
SELECT {PORTAL_COLS} FROM portal""")
def portal_records_in_file_order(spark, d):
    """The portal files written as text with unlike headers and a second copy of every id, read by name and in file order:
    the first record of the file stays, without a hash."""
    return O.portal_records(_downloads(spark, d)).select(*_portal_file(spark, d, CA_PRIOS, "ca-").columns)


@register("aggregator_records", f"""WITH {OCC_SQL}
SELECT gbifID, speciesKey, NameAuthor, scientificName, countryCode, occurrenceStatus, year, locality,
       acceptedName, acceptedNameAuthor FROM agg""")
def aggregator_records(spark, d):
    """Aggregator records of the wanted keys (names attached), outside the excluded countries, no absences."""
    out = O.aggregator_records([_aggregator_file(spark, d, True), _aggregator_file(spark, d, False)],
                               _all_names(spark, d))
    return out.select("gbifID", "speciesKey", "NameAuthor", "scientificName", "countryCode", "occurrenceStatus",
                      "year", "locality", "acceptedName", "acceptedNameAuthor")


@register("redlist_labels", f"""WITH {TRAINING_SQL}
SELECT scientificName, redlistCategory, authority, NameAuthor, Threatened, Source FROM rl""")
def redlist_labels(spark, d):
    """Assessments joined to their taxonomy, labelled 0/1, data-deficient ones dropped."""
    return N.redlist_labels(_assessments(spark, d), _taxonomy(spark, d))


@register("portal_matches", f"""WITH {OCC_SQL}
SELECT {PORTAL_COLS}, acceptedNameAuthor, acceptedName, NameAuthor FROM matched""")
def portal_matches(spark, d):
    """Portal records of wanted species by taxon id (route 1, wins) or by name (route 2), one per id."""
    portal = O.portal_records([_portal_file(spark, d, CA_PRIOS, "ca-"), _portal_file(spark, d, US_PRIOS, "us-")])
    return O.portal_matches(portal, _checklist_filtered(spark, d), _all_names(spark, d))
