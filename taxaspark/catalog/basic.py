"""Registered queries for the general operators (projection, filter, join, aggregate, set, scalar)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.nulls import is_member, not_matches, paste_guarded
from ..functions.text import code_map, combined_id, first_word, lenient_double, override, space_initials, word_count
from ..operators import aggregates as A
from ..operators import dedup as D
from ..operators import frames as FR
from ..operators import joins as J
from ..operators import ranking as R
from ..plans.names import MATCH_TEMPLATE
from ..sources.io import inline_table
from .registry import register
from .standins import WORD_SQL, c, sql_round, table

W = WORD_SQL


# ------------------------------------------------------------ sources / projections
@register("inline_table_union", """
SELECT r_regionkey AS key, r_name AS name FROM region
UNION ALL
SELECT * FROM (VALUES (100, 'Sarcodon joeides'), (101, 'Gomphidius smithii'), (102, 'Elaphomyces decipiens')) v(key, name)
""")
def inline_table_union(spark, d):
    """Region keys and names bound with a literal table."""
    lit = inline_table(spark, [(100, "Sarcodon joeides"), (101, "Gomphidius smithii"), (102, "Elaphomyces decipiens")],
                       StructType([StructField("key", IntegerType()), StructField("name", StringType())]))
    reg = table(spark, d, "region").select(c("r_regionkey").alias("key"), c("r_name").alias("name"))
    return FR.union_strict(reg, lit)


@register("derive_columns", rf"""
SELECT c_custkey,
       NULLIF(regexp_extract(c_name, '{W}', 0), '') AS Genus,
       'Checklist' AS Source,
       CASE WHEN NULLIF(c_mktsegment, 'BUILDING') IS NULL THEN c_name
            ELSE coalesce(c_name, 'NA') || ' ' || NULLIF(c_mktsegment, 'BUILDING') END AS NameAuthor
FROM customer
""")
def derive_columns(spark, d):
    """Genus (first word), constant source, name with author only when an author exists."""
    cu = table(spark, d, "customer").withColumn("author", F.nullif(c("c_mktsegment"), F.lit("BUILDING")))
    return cu.select("c_custkey", first_word("c_name").alias("Genus"), F.lit("Checklist").alias("Source"),
                     paste_guarded("c_name", "author").alias("NameAuthor"))


@register("drop_strict", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def drop_strict(spark, d):
    """Drop two columns; an unknown column would be an error."""
    return FR.drop_strict(table(spark, d, "part"), ["p_type", "p_size"])


@register("rename_shift", """
SELECT p_partkey, p_name AS p_label, p_brand, p_type AS p_name, p_size, p_retailprice FROM part
""")
def rename_shift(spark, d):
    """Rename with a shift: p_name becomes p_label while p_type becomes p_name."""
    return FR.rename(table(spark, d, "part"), {"p_name": "p_label", "p_type": "p_name"})


@register("conform_schema", """
SELECT s_name AS searchName, s_suppkey AS usageKey, 'taxon' || CAST(s_suppkey AS VARCHAR) AS scientificName,
       CAST(NULL AS VARCHAR) AS rank, CAST(s_nationkey AS INTEGER) AS confidence
FROM supplier
""")
def conform_schema(spark, d):
    """Conform to the name-match template; absent columns become typed NULLs."""
    s = table(spark, d, "supplier").select(
        c("s_name").alias("searchName"), c("s_suppkey").alias("usageKey"),
        F.concat(F.lit("taxon"), c("s_suppkey").cast("string")).alias("scientificName"),
        c("s_nationkey").alias("confidence"), c("s_acctbal"))
    return FR.conform(s, MATCH_TEMPLATE)


@register("round_numeric_columns", f"""
SELECT c_custkey, c_name, c_nationkey, {sql_round('c_acctbal', 3)} AS c_acctbal,
       {sql_round('c_acctbal / 7', 3)} AS acctbal_7
FROM customer
""")
def round_numeric_columns(spark, d):
    """Round every fractional numeric column to 3 decimals; integer columns unchanged."""
    cu = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                            (c("c_acctbal") / 7).alias("acctbal_7"))
    return FR.round_numeric(cu, 3)


# ------------------------------------------------------------ filters
PRIO_SQL = "NULLIF(o_orderpriority, '5-LOW')"


def _orders_prio(spark, d):
    return table(spark, d, "orders").withColumn("o_orderpriority", F.nullif(c("o_orderpriority"), F.lit("5-LOW")))


@register("filter_compare", f"""
SELECT o_orderkey, o_custkey, {PRIO_SQL} AS o_orderpriority, o_totalprice FROM orders
WHERE {PRIO_SQL} <> '1-URGENT' AND o_totalprice >= 100000
""")
def filter_compare(spark, d):
    """Inequality drops NULL; range predicate."""
    o = _orders_prio(spark, d)
    return o.filter((c("o_orderpriority") != "1-URGENT") & (c("o_totalprice") >= 100000)).select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@register("filter_not_in_list", f"""
SELECT o_orderkey, o_custkey, {PRIO_SQL} AS o_orderpriority FROM orders
WHERE NOT coalesce({PRIO_SQL} IN ('1-URGENT', '2-HIGH'), false)
""")
def filter_not_in_list(spark, d):
    """Negated membership in a literal list keeps NULL."""
    o = _orders_prio(spark, d)
    return o.filter(~is_member("o_orderpriority", ["1-URGENT", "2-HIGH"])).select(
        "o_orderkey", "o_custkey", "o_orderpriority")


@register("filter_boolean_mix", f"""
SELECT o_orderkey, {PRIO_SQL} AS o_orderpriority, o_orderstatus, o_totalprice FROM orders
WHERE ({PRIO_SQL} = '3-MEDIUM' AND o_orderstatus = 'F') OR o_totalprice < 50000
""")
def filter_boolean_mix(spark, d):
    """Conjunction inside a disjunction, three-valued."""
    o = _orders_prio(spark, d)
    return o.filter(((c("o_orderpriority") == "3-MEDIUM") & (c("o_orderstatus") == "F")) | (c("o_totalprice") < 50000)) \
        .select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")


@register("filter_regex_exclude", """
SELECT c_custkey, NULLIF(c_name, 'Customer#000000007') AS c_name FROM customer
WHERE NOT coalesce(regexp_matches(NULLIF(c_name, 'Customer#000000007'), '7'), false)
""")
def filter_regex_exclude(spark, d):
    """Regex exclusion; a NULL name is kept."""
    cu = table(spark, d, "customer").withColumn("c_name", F.nullif(c("c_name"), F.lit("Customer#000000007")))
    return cu.filter(not_matches("c_name", "7")).select("c_custkey", "c_name")


@register("filter_word_count", rf"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{W}')) AS INTEGER) AS n_words FROM documents
WHERE len(regexp_extract_all(text, '{W}')) >= 2
""")
def filter_word_count(spark, d):
    """Documents of at least two words (Unicode word class), whole texts."""
    doc = table(spark, d, "documents").withColumn("n_words", word_count("text"))
    return doc.filter(c("n_words") >= 2).select("doc_id", "n_words")


EXCLUDED_ORDERS = [3, 7, 11, 1000, 99999]


@register("exclude_keys", f"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN ({', '.join(map(str, EXCLUDED_ORDERS))})
""")
def exclude_keys(spark, d):
    """Known bad records removed: a literal id list is a pushed-down filter (no join, no shuffle)."""
    return J.exclude_values(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", EXCLUDED_ORDERS)


@register("split_labelled", """
SELECT d.doc_id, l.quality, CASE WHEN l.quality IS NOT NULL THEN 'labelled' ELSE 'unlabelled' END AS split
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def split_labelled(spark, d):
    """Labelled and unlabelled halves of one joined frame, tagged and bound."""
    j = J.join_on(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id", "quality"),
                  "doc_id", "left")
    lab, unl = FR.split_by_null(j, "quality")
    return FR.union_strict(lab.withColumn("split", F.lit("labelled")), unl.withColumn("split", F.lit("unlabelled")))


@register("drop_missing", """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id IS NOT NULL AND d.lang IS NOT NULL AND d.n_chars IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL
""")
def drop_missing(spark, d):
    """Complete rows only (any column missing drops the row)."""
    j = J.join_on(table(spark, d, "documents").select("doc_id", "lang", "n_chars"),
                  table(spark, d, "labels"), "doc_id", "left")
    return FR.drop_missing(j)


# ------------------------------------------------------------ joins
@register("join_inner", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def join_inner(spark, d):
    """Inner equi-join on differently named keys; the left key is kept."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cu = table(spark, d, "customer").select("c_custkey", "c_name")
    return J.join_on(o, cu, {"o_custkey": "c_custkey"}, "inner").select("o_orderkey", "o_custkey", "c_name", "o_totalprice")


@register("join_left", """
SELECT c.c_custkey, NULLIF(c.c_nationkey, 0) AS c_nationkey, n.n_name
FROM customer c LEFT JOIN nation n ON NULLIF(c.c_nationkey, 0) IS NOT DISTINCT FROM NULLIF(n.n_nationkey, 0)
""")
def join_left(spark, d):
    """Left join where a NULL key matches a NULL key (dplyr's rule)."""
    cu = table(spark, d, "customer").select("c_custkey", F.nullif(c("c_nationkey"), F.lit(0)).alias("c_nationkey"))
    na = table(spark, d, "nation").select(F.nullif(c("n_nationkey"), F.lit(0)).alias("n_nationkey"), "n_name")
    return J.join_on(cu, na, {"c_nationkey": "n_nationkey"}, "left", null_safe=True)


@register("join_right", """
SELECT l.doc_id, d.lang, l.quality, l.toxic FROM documents d RIGHT JOIN labels l ON d.doc_id = l.doc_id
""")
def join_right(spark, d):
    """Right join; the key comes from the right side."""
    doc = table(spark, d, "documents").select("doc_id", "lang")
    return J.join_on(doc, table(spark, d, "labels"), "doc_id", "right")


BIG_ORDERS_SQL = "(SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"


@register("join_semi", f"""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN {BIG_ORDERS_SQL}
""")
def join_semi(spark, d):
    """Customers with an order over 400,000 (semi join on the distinct key set)."""
    big = table(spark, d, "orders").filter(c("o_totalprice") > 400000)
    return J.semi_join(table(spark, d, "customer").select("c_custkey", "c_name"), big, {"c_custkey": "o_custkey"})


@register("join_anti", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_totalprice > 400000 AND o.o_custkey IS NOT DISTINCT FROM c.c_custkey)
""")
def join_anti(spark, d):
    """Customers without such an order (null-safe anti join, never NOT IN)."""
    big = table(spark, d, "orders").filter(c("o_totalprice") > 400000)
    return J.anti_join(table(spark, d, "customer").select("c_custkey", "c_name"), big, {"c_custkey": "o_custkey"})


@register("join_semi_either", """
SELECT p_partkey, p_name FROM part
WHERE p_partkey IN (SELECT s_suppkey FROM supplier)
   OR p_partkey IN (SELECT o_custkey FROM orders)
""")
def join_semi_either(spark, d):
    """Key in set A or in set B: one semi join on the union of the key sets."""
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return J.semi_join_either(p, "p_partkey", [(table(spark, d, "supplier"), "s_suppkey"), (table(spark, d, "orders"), "o_custkey")])


@register("join_suffix", """
WITH f AS (SELECT o_custkey, o_orderkey, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn_first,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn_last
           FROM orders)
SELECT a.o_custkey, a.o_orderkey AS o_orderkey_x, a.o_totalprice AS o_totalprice_x,
       b.o_orderkey AS o_orderkey_y, b.o_totalprice AS o_totalprice_y
FROM (SELECT * FROM f WHERE rn_first = 1) a JOIN (SELECT * FROM f WHERE rn_last = 1) b ON a.o_custkey = b.o_custkey
""")
def join_suffix(spark, d):
    """First and last order per customer side by side; clashing columns get _x/_y."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    first = D.first_per_key(o, ["o_custkey"], [c("o_orderkey").asc()])
    last = D.first_per_key(o, ["o_custkey"], [c("o_orderkey").desc()])
    return J.join_suffixed(first, last, "o_custkey", "inner", ("_x", "_y"))


# ------------------------------------------------------------ aggregates
YEAR_NULL_SQL = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END"


def _orders_year(spark, d, null_low=False):
    o = table(spark, d, "orders")
    y = F.year("o_orderdate")
    if null_low:
        y = F.when(c("o_orderpriority") == "5-LOW", F.lit(None).cast("int")).otherwise(y)
    return o.withColumn("year", y)


@register("group_count", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def group_count(spark, d):
    """Orders per customer."""
    return A.group_count(table(spark, d, "orders"), ["o_custkey"], "n")


@register("group_count_having", """
SELECT o_custkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
FROM orders GROUP BY 1, 2, 3 HAVING count(*) <> 1
""")
def group_count_having(spark, d):
    """Groups whose count is not 1."""
    return A.group_count_having(_orders_year(spark, d), ["o_custkey", "o_orderpriority", "year"], lambda n: n != 1, "n")


@register("group_share", f"""
SELECT o_custkey, o_orderpriority,
       coalesce(avg(CASE WHEN y > 1998 THEN CAST(1 AS DOUBLE) WHEN y IS NOT NULL THEN CAST(0 AS DOUBLE) END),
                CAST(0 AS DOUBLE)) AS share_recent
FROM (SELECT o_custkey, o_orderpriority, {YEAR_NULL_SQL} AS y FROM orders) t
GROUP BY o_custkey, o_orderpriority
""")
def group_share(spark, d):
    """Share of orders after 1998 per group; NULL years ignored; a group with none gives 0."""
    o = _orders_year(spark, d, null_low=True)
    return A.group_share(o, ["o_custkey", "o_orderpriority"], c("year") > 1998, "share_recent")


# ------------------------------------------------------------ distinct / dedup / windows
@register("distinct_rows", """
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def distinct_rows(spark, d):
    """Distinct rows of a frame (all its columns)."""
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


@register("distinct_projection", """
SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem
""")
def distinct_projection(spark, d):
    """Distinct combinations of three columns."""
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@register("first_per_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, year FROM (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn
  FROM orders) t WHERE rn = 1
""")
def first_per_key(spark, d):
    """One order per (customer, priority): the first by order key, all columns kept."""
    o = _orders_year(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "year")
    return D.first_per_key(o, ["o_custkey", "o_orderpriority"], ["o_orderkey"])


@register("two_stage_dedup", """
WITH s AS (SELECT o_orderkey, o_custkey, o_orderpriority AS locality, o_orderstatus AS lat,
                  CAST(floor(o_totalprice / 100000) AS BIGINT) AS lon, CAST(year(o_orderdate) AS INTEGER) AS year
           FROM orders),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, locality, year ORDER BY o_orderkey) AS rn FROM s) t WHERE rn = 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, lat, lon, year ORDER BY o_orderkey) AS rn2 FROM a) t WHERE rn2 = 1)
SELECT o_orderkey, o_custkey, locality, lat, lon, year FROM b
""")
def two_stage_dedup(spark, d):
    """Two first-wins passes with one order; the second sees the survivors of the first."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", c("o_orderpriority").alias("locality"), c("o_orderstatus").alias("lat"),
        F.floor(c("o_totalprice") / 100000).alias("lon"), F.year("o_orderdate").alias("year"))
    return D.two_stage_dedup(o, ["o_custkey", "locality", "year"], ["o_custkey", "lat", "lon", "year"], ["o_orderkey"])


@register("keep_unique", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM (
  SELECT *, count(*) OVER (PARTITION BY p_name, p_brand, p_size) AS n FROM part) t
WHERE n = 1
""")
def keep_unique(spark, d):
    """Parts whose (name, brand, size) occurs once."""
    return D.keep_unique(table(spark, d, "part"), ["p_name", "p_brand", "p_size"])


@register("filter_group_min", f"""
SELECT o_orderkey, o_custkey, year FROM (
  SELECT o_orderkey, o_custkey, {YEAR_NULL_SQL} AS year FROM orders) t
WHERE year = (SELECT min(t2.y) FROM (SELECT o_custkey AS k, {YEAR_NULL_SQL} AS y FROM orders) t2 WHERE t2.k = t.o_custkey)
""")
def filter_group_min(spark, d):
    """Orders in their customer's earliest year, ties kept; a NULL year never qualifies."""
    o = _orders_year(spark, d, null_low=True).select("o_orderkey", "o_custkey", "year")
    return D.keep_group_min(o, ["o_custkey"], "year")


@register("top_with_ties", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem l
WHERE l_quantity = (SELECT max(l2.l_quantity) FROM lineitem l2 WHERE l2.l_partkey = l.l_partkey)
""")
def top_with_ties(spark, d):
    """Largest quantity per part, ties kept."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return D.top_with_ties(li, ["l_partkey"], "l_quantity")


# ------------------------------------------------------------ order
@register("row_index", """
SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS index FROM part
""")
def row_index(spark, d):
    """Row number after a sort, computed per range partition plus offsets (no single-task window)."""
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return R.row_index(p, ["p_retailprice", "p_partkey"], "index")


@register("sort_rows", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey")
def sort_rows(spark, d):
    """Sort, descending price then key, missing values last."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    return R.sort_rows(p, [c("p_retailprice").desc_nulls_last(), "p_partkey"])


# ------------------------------------------------------------ set operations
@register("union_missing_columns", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT s_suppkey AS key, s_name AS name, CAST(NULL AS VARCHAR) AS segment, s_acctbal AS balance FROM supplier
""")
def union_missing_columns(spark, d):
    """Bind by name; a column only one side has is NULL on the other."""
    a = table(spark, d, "customer").select(c("c_custkey").alias("key"), c("c_name").alias("name"),
                                           c("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(c("s_suppkey").alias("key"), c("s_name").alias("name"),
                                           c("s_acctbal").alias("balance"))
    return FR.union_missing(a, b)


UNION_PARTS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
{op}
SELECT l_orderkey, l_suppkey, l_linestatus FROM lineitem
"""


def _union_parts(spark, d):
    a = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    b = table(spark, d, "lineitem").select(c("l_linestatus").alias("o_orderstatus"), c("l_suppkey").alias("o_custkey"),
                                           c("l_orderkey").alias("o_orderkey"))
    return a, b


@register("union_strict", UNION_PARTS_SQL.format(op="UNION ALL"))
def union_strict(spark, d):
    """Bind by name with equal column sets (column order may differ); duplicates kept."""
    return FR.union_strict(*_union_parts(spark, d))


@register("union_distinct", UNION_PARTS_SQL.format(op="UNION"))
def union_distinct(spark, d):
    """Bind and de-duplicate."""
    return FR.union_distinct(*_union_parts(spark, d))


@register("except_rows", """
SELECT o_custkey, o_orderstatus FROM orders
EXCEPT
SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW'
""")
def except_rows(spark, d):
    """Row-set difference (distinct, as dplyr's setdiff)."""
    o = table(spark, d, "orders")
    return FR.except_rows(o.select("o_custkey", "o_orderstatus"),
                          o.filter(c("o_orderpriority") == "5-LOW").select("o_custkey", "o_orderstatus"))


@register("keep_keys_in_other", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def keep_keys_in_other(spark, d):
    """Drop customers that only have records of the second kind (setdiff then exclusion = one semi join)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return J.keep_keys_in_other(o, "o_custkey", o.filter(c("o_orderstatus") == "F"))


# ------------------------------------------------------------ scalar functions
@register("name_first_word", rf"""
SELECT p_partkey, NULLIF(regexp_extract(p_name, '{W}', 0), '') AS genus FROM part
""")
def name_first_word(spark, d):
    """First word of a name (Unicode letters, marks, digits, underscore)."""
    return table(spark, d, "part").select("p_partkey", first_word("p_name").alias("genus"))


@register("name_initials", r"""
SELECT c_custkey,
       CASE WHEN 'A.' || c_name = 'A.Customer#000000001' THEN 'A. Customer#000000001 (fixed)'
            ELSE regexp_replace('A.' || c_name, '\.([A-Z]\p{Ll})', '. \1', 'g') END AS name_spaced
FROM customer
""")
def name_initials(spark, d):
    """Blank after an initial's period when a name follows; one exact-value override."""
    cu = table(spark, d, "customer").withColumn("nm", F.concat(F.lit("A."), c("c_name")))
    fixed = override("nm", {"A.Customer#000000001": "A. Customer#000000001 (fixed)"}, space_initials("nm"))
    return cu.select("c_custkey", fixed.alias("name_spaced"))


@register("id_tagging", """
SELECT o_orderkey,
       CASE WHEN gbif IS NULL THEN 'MycoPortal' ELSE 'GBIF' END AS Source,
       CASE WHEN id IS NULL THEN coalesce(CAST(gbif AS VARCHAR), 'NA') || 'g'
            ELSE CAST(id AS VARCHAR) || 'm' END AS uniqueCombinedID
FROM (SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS id,
             CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS gbif
      FROM orders) t
""")
def id_tagging(spark, d):
    """Origin label and one tagged id per record from two id columns."""
    o = table(spark, d, "orders")
    f = c("o_orderstatus") == "F"
    o = o.select("o_orderkey", F.when(f, F.lit(None).cast("long")).otherwise(c("o_orderkey")).alias("id"),
                 F.when(f, c("o_orderkey")).alias("gbif"))
    return o.select("o_orderkey",
                    F.when(c("gbif").isNull(), F.lit("MycoPortal")).otherwise(F.lit("GBIF")).alias("Source"),
                    combined_id("id", "gbif", "m", "g").alias("uniqueCombinedID"))


@register("code_map", """
SELECT c_custkey,
       coalesce(CASE WHEN c_nationkey >= 20 THEN 'N' || CAST(c_nationkey AS VARCHAR) END,
                CASE WHEN c_mktsegment IN ('AUTOMOBILE') THEN 'AU'
                     WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'MB' END) AS code
FROM customer
""")
def code_map_q(spark, d):
    """Keep an existing code, else map names to codes; unknown names give NULL."""
    cu = table(spark, d, "customer")
    existing = F.when(c("c_nationkey") >= 20, F.concat(F.lit("N"), c("c_nationkey").cast("string")))
    code = code_map("c_mktsegment", {"AU": ["AUTOMOBILE"], "MB": ["MACHINERY", "BUILDING"]}, existing=existing)
    return cu.select("c_custkey", code.alias("code"))


@register("lenient_cast", """
SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_no, TRY_CAST(p_type AS DOUBLE) AS type_no
FROM part
""")
def lenient_cast(spark, d):
    """Text to number; text that is no number becomes NULL, never an error."""
    p = table(spark, d, "part")
    return p.select("p_partkey", lenient_double(F.split_part(c("p_brand"), F.lit("#"), F.lit(2))).alias("brand_no"),
                    lenient_double("p_type").alias("type_no"))


@register("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, d):
    """Whole documents (multi-line text with quotes) written as R-style CSV under the shared checkpoint
    folder and read back with the declared schema: the delimited sink and source lose nothing."""
    import uuid
    from ..session import ensure_checkpoint_dir
    from ..sources.io import read_delimited, write_list
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_list(docs, path)
    return read_delimited(spark, path, docs.schema)     # texts hold line breaks


def _folder(spark, name: str) -> str:
    import uuid
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("tsv_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def tsv_round_trip(spark, d):
    """Orders written as tab-separated text, in files with unlike headers, and read back by name, each file split over tasks."""
    from ..sources.io import read_tsv
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = _folder(spark, "tsv")
    for i, names in enumerate((o.columns, ["o_orderpriority", "o_totalprice", "o_orderkey", "o_custkey", "o_orderstatus"])):
        o.filter(c("o_orderkey") % 2 == i).select(names).write.option("header", True).option("escape", '"') \
            .option("nullValue", "NA").option("sep", "\t").csv(f"{path}/{i}")
    return read_tsv(spark, [f"{path}/0", f"{path}/1"], o.schema)


@register("csv_base_flavour", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN NULL ELSE p_name END AS name,
       CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_size END AS size
FROM part
""")
def csv_base_flavour(spark, d):
    """Base R's reading of blanks and NA: blank text stays text, NA and blank numbers are missing."""
    from ..sources.io import read_delimited
    p = table(spark, d, "part")
    k = c("p_size") % 3
    name = F.when(k == 0, F.lit("")).when(k == 1, F.lit("NA")).otherwise(c("p_name"))
    size = F.when(c("p_size") % 4 == 0, F.lit("")).when(c("p_size") % 2 == 0, F.lit("NA")).otherwise(c("p_size").cast("string"))
    path = _folder(spark, "base")
    p.select("p_partkey", name.alias("name"), size.alias("size")).write.option("header", True).option("escape", '"') \
        .option("emptyValue", "").csv(path)
    kind = p.schema["p_size"].dataType.simpleString()
    return read_delimited(spark, path, f"p_partkey bigint, name string, size {kind}", blank_as_null=False)


@register("read_tree_union", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN 'ca' ELSE 'us' END AS origin
FROM orders
""")
def read_tree_union(spark, d):
    """Files in nested folders found and bound by name, each row with the folder it came from; NA is missing.
    One folder's files have the columns in another order and one more."""
    from ..sources.io import read_tree
    o = table(spark, d, "orders")
    root = _folder(spark, "tree")
    status = F.when(c("o_orderstatus") != "P", c("o_orderstatus")).otherwise(F.lit("NA")).alias("status")
    for i, place in enumerate(("ca", "us")):
        own = ["o_orderkey", status] if i else [status, c("o_orderpriority").alias("priority"), "o_orderkey"]
        o.filter(c("o_orderkey") % 2 == i).select(*own).write.option("header", True).csv(f"{root}/{place}/occ")
    t = read_tree(spark, root, "*.csv", schema="o_orderkey bigint, status string")
    return t.select("o_orderkey", "status", F.regexp_extract("source_file", "/(ca|us)/occ/", 1).alias("origin"))


@register("read_like_schema", "SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier")
def read_like_schema(spark, d):
    """A file read with the column types of another frame, by name: its columns stand in another order, with one more."""
    from ..sources.io import read_like, write_list
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    path = _folder(spark, "like")
    write_list(s.select("s_name", "s_nationkey", c("s_name").alias("more"), "s_acctbal", "s_suppkey"), path)
    return read_like(spark, path, s).select(s.columns)


@register("first_in_file", """
SELECT o_custkey, o_orderkey, o_totalprice, place FROM (
  SELECT *, o_orderkey % 2 AS place, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2, o_totalprice DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1
""")
def first_in_file(spark, d):
    """Two downloads with unlike headers, read in file order: of the records of one id the first in the files stays, the
    first download's before the second's, whatever the splits and shuffles."""
    from ..operators.dedup import first_per_key
    from ..sources.io import ORDER, read_delimited
    o = table(spark, d, "orders")
    path = _folder(spark, "downloads")
    for i, names in enumerate((["o_custkey", "o_orderkey", "o_totalprice"], ["o_totalprice", "o_custkey", "o_orderstatus", "o_orderkey"])):
        # part files follow one another as their ranges do
        o.filter(c("o_orderkey") % 2 == i).select(names).repartitionByRange(3, c("o_totalprice").desc(), "o_orderkey") \
            .sortWithinPartitions(c("o_totalprice").desc(), "o_orderkey").write.option("header", True).csv(f"{path}/{i}")
    read = read_delimited(spark, [f"{path}/0", f"{path}/1"], o.select("o_custkey", "o_orderkey", "o_totalprice").schema, ordered=True)
    return first_per_key(read.repartition(7), ["o_custkey"], [ORDER]).select(
        "o_custkey", "o_orderkey", "o_totalprice", c(ORDER).getField("place").cast("bigint").alias("place"))


@register("exclude_keys_table", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IS NULL OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0 AND l_orderkey IS NOT NULL)
""")
def exclude_keys_table(spark, d):
    """Records whose id is listed in a table of bad records are removed."""
    bad = table(spark, d, "lineitem").filter(c("l_discount") == 0)
    return J.exclude_keys(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", bad, "l_orderkey")


@register("distinct_wide_rows", """
SELECT * FROM lineitem
UNION
SELECT * FROM lineitem WHERE l_quantity > 48
""")
def distinct_wide_rows(spark, d):
    """Bind and de-duplicate rows of many columns: prints are shuffled, and whole rows only where a print occurs again."""
    rows = table(spark, d, "lineitem")
    return FR.union_distinct(rows, rows.where(c("l_quantity") > 48))


@register("except_wide_rows", """
SELECT * FROM lineitem
EXCEPT
SELECT * FROM lineitem WHERE l_quantity > 45
""")
def except_wide_rows(spark, d):
    """Row-set difference of rows of many columns, by prints first."""
    rows = table(spark, d, "lineitem")
    return FR.except_rows(rows, rows.where(c("l_quantity") > 45))
