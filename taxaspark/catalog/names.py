"""Registered queries for name matching, taxon lookup and synonym expansion."""

from __future__ import annotations

from ..operators.joins import join_on
from ..plans import names as N
from .registry import register
from .standins import CANDIDATES_SQL, NAMES_SQL, SYNONYMS_SQL, USAGE_SQL, c, candidates, search_names, synonyms, table, usage

def match_sql(names_cte: str = NAMES_SQL, cand_cte: str = CANDIDATES_SQL) -> str:
    """CTE chain ending in ``matched`` (twin of ``plans.names.match_names``)."""
    return f"""{names_cte},
{cand_cte},
stats AS (
  SELECT searchName, bool_and(coalesce(matchType = 'NONE', false)) AS none_,
         bool_and(coalesce(matchType = 'HIGHERRANK', false)) AS higher_, max(confidence) AS top
  FROM cand GROUP BY searchName),
usable AS (SELECT searchName, top FROM stats WHERE NOT none_ AND NOT higher_),
best AS (
  SELECT c.searchName, c.usageKey, c.scientificName, c.rank, c.confidence FROM cand c
  WHERE EXISTS (SELECT 1 FROM usable u WHERE u.searchName IS NOT DISTINCT FROM c.searchName
                AND u.top IS NOT DISTINCT FROM c.confidence)),
matched AS (
  SELECT q.NameAuthor AS searchName, b.usageKey, b.scientificName, b.rank, b.confidence
  FROM names q JOIN best b ON q.NameAuthor IS NOT DISTINCT FROM b.searchName
  UNION ALL
  SELECT q.NameAuthor, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER)
  FROM names q WHERE NOT EXISTS (SELECT 1 FROM usable u WHERE u.searchName IS NOT DISTINCT FROM q.NameAuthor))"""


MATCH_SQL = match_sql()


@register("match_names", f"""WITH {MATCH_SQL}
SELECT * FROM matched""")
def match_names(spark, d):
    """Best candidates per search name with ties; a row of NULLs when nothing usable was found."""
    return N.match_names(search_names(spark, d), candidates(spark, d))


def resolve_sql(names_cte: str = NAMES_SQL, cand_cte: str = CANDIDATES_SQL) -> str:
    """CTE chain ending in ``resolved`` (twin of ``plans.names.resolve_accepted``)."""
    return f"""{match_sql(names_cte, cand_cte)},
{USAGE_SQL},
uniq AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY searchName) AS n FROM matched) t
  WHERE n = 1 AND confidence = 100),
used AS (SELECT u.* FROM (SELECT usageKey FROM uniq) k JOIN usage u ON k.usageKey = u.key),
named AS (
  SELECT used.*, uniq.searchName FROM used LEFT JOIN uniq ON used.scientificName IS NOT DISTINCT FROM uniq.scientificName),
resolved AS (
  SELECT key, scientificName, species, accepted, taxonomicStatus, acceptedKey, searchName FROM (
    SELECT *, row_number() OVER (PARTITION BY scientificName ORDER BY searchName ASC NULLS LAST, key ASC NULLS LAST) AS rn
    FROM named) t WHERE rn = 1)"""


RESOLVE_SQL = resolve_sql()


@register("resolve_accepted", f"""WITH {RESOLVE_SQL}
SELECT * FROM resolved""")
def resolve_accepted(spark, d):
    """Unique, fully confident matches resolved to taxon attributes, one row per scientific name."""
    return N.resolve_accepted(search_names(spark, d), candidates(spark, d), usage(spark, d))


@register("taxon_lookup", f"""WITH {USAGE_SQL}
SELECT u.key, u.scientificName, u.species, u.taxonomicStatus
FROM (SELECT l_suppkey AS usageKey FROM lineitem) k JOIN usage u ON k.usageKey = u.key""")
def taxon_lookup(spark, d):
    """Attributes of every looked-up key, one row per input key row."""
    keys = table(spark, d, "lineitem").select(c("l_suppkey").alias("usageKey"))
    return N.lookup_usage(keys, usage(spark, d)).select("key", "scientificName", "species", "taxonomicStatus")


@register("expand_synonyms", f"""WITH {USAGE_SQL},
{SYNONYMS_SQL}
SELECT s.acceptedKey, s.scientificName, s.species, s.accepted
FROM syn s WHERE s.acceptedKey IN (SELECT acceptedKey FROM usage WHERE acceptedKey IS NOT NULL)""")
def expand_synonyms(spark, d):
    """All synonyms listed under the distinct accepted keys (1:n)."""
    keys = usage(spark, d).select("acceptedKey").distinct()
    return join_on(synonyms(spark, d), keys, "acceptedKey", "left_semi", null_safe=False)


@register("find_synonyms", f"""WITH {USAGE_SQL},
{SYNONYMS_SQL}
SELECT acceptedKey, scientificName, species, accepted FROM (
  SELECT s.*, count(*) OVER (PARTITION BY s.scientificName) AS n FROM syn s
  WHERE s.acceptedKey IN (SELECT acceptedKey FROM usage WHERE acceptedKey IS NOT NULL)) x WHERE n = 1""")
def find_synonyms(spark, d):
    """Synonyms of the distinct accepted keys, names listed under several keys dropped."""
    return N.find_synonyms(usage(spark, d), synonyms(spark, d))


def _accepted_split(spark, d):
    acc = N._accepted_fallback(N.resolve_accepted(search_names(spark, d), candidates(spark, d), usage(spark, d)))
    size = table(spark, d, "part").select(c("p_partkey").cast("string").alias("searchName"), "p_size")
    acc = join_on(acc, size, "searchName", "inner")
    return acc.filter(c("p_size") <= 25).drop("p_size"), acc.filter(c("p_size") > 25).drop("p_size")


def _syn_rows_sql(src: str) -> str:
    return f"""(
  SELECT NameAuthor, acceptedName, acceptedNameAuthor, gbifAcceptedKey FROM (
    SELECT coalesce(scientificName, accepted) AS NameAuthor, species AS acceptedName,
           accepted AS acceptedNameAuthor, acceptedKey AS gbifAcceptedKey FROM (
      SELECT scientificName, species, accepted, acceptedKey FROM (
        SELECT s.*, count(*) OVER (PARTITION BY s.scientificName) AS n FROM syn s
        WHERE s.acceptedKey IN (SELECT acceptedKey FROM {src})) x WHERE n = 1
      UNION ALL
      SELECT NULL, species, accepted, acceptedKey FROM {src}) y) z
  WHERE NOT coalesce(regexp_matches(NameAuthor, '\\?'), false))"""


@register("synonym_map", f"""WITH {RESOLVE_SQL},
{SYNONYMS_SQL},
acc AS (
  SELECT r.key, r.scientificName, r.species, coalesce(r.accepted, r.scientificName) AS accepted,
         r.taxonomicStatus, coalesce(r.acceptedKey, r.key) AS acceptedKey, r.searchName, p.p_size
  FROM resolved r JOIN part p ON r.searchName IS NOT DISTINCT FROM CAST(p.p_partkey AS VARCHAR)),
acc_a AS (SELECT * FROM acc WHERE p_size <= 25),
acc_b AS (SELECT * FROM acc WHERE p_size > 25),
allnames AS (
  SELECT DISTINCT * FROM (SELECT * FROM {_syn_rows_sql('acc_a')} a UNION ALL SELECT DISTINCT * FROM {_syn_rows_sql('acc_b')} b) u),
spaced AS (
  SELECT *, CASE WHEN NameAuthor = 'Cantharellus enelensis Voitk, Thorn, Lebeuf & J.I.Kim'
                 THEN 'Cantharellus enelensis Voitk, Thorn, Lebeuf, J.I. Kim'
                 ELSE regexp_replace(NameAuthor, '\\.([A-Z]\\p{{Ll}})', '. \\1', 'g') END AS mycoportalNameAuthor
  FROM allnames)
SELECT NameAuthor, acceptedName, acceptedNameAuthor, gbifAcceptedKey, mycoportalNameAuthor FROM (
  SELECT *, count(*) OVER (PARTITION BY NameAuthor) AS n FROM spaced) t WHERE n = 1""")
def synonym_map(spark, d):
    """Accepted names and their synonyms from two resolved populations; names of two taxa dropped."""
    a, b = _accepted_split(spark, d)
    return N.synonym_map(a, b, synonyms(spark, d))
