"""Names in, accepted names and synonyms out (bulk joins, no service calls).

The taxonomy service of the reference is replaced by three tables:

* ``candidates`` -- (searchName, usageKey, scientificName, rank, confidence,
  matchType): every candidate the name search returns for a search name,
  alternatives and best match together;
* ``usage`` -- (key, scientificName, species, accepted, taxonomicStatus,
  acceptedKey): attributes of a taxon key;
* ``synonyms`` -- (acceptedKey, scientificName, species, accepted): the
  synonyms listed under an accepted key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.nulls import is_member, not_matches, paste
from ..functions.text import override, space_initials
from ..operators.aggregates import group_count_having
from ..operators.dedup import keep_unique
from ..operators.frames import conform, rename, union_missing, union_strict
from ..operators.joins import anti_join, join_on, join_suffixed
from . import constants as K

MATCH_TEMPLATE = StructType([
    StructField("searchName", StringType()),
    StructField("usageKey", LongType()),
    StructField("scientificName", StringType()),
    StructField("rank", StringType()),
    StructField("confidence", IntegerType()),
])


def match_names(names: DataFrame, candidates: DataFrame, name_col: str = "NameAuthor",
                no_match: str = K.NO_MATCH_TYPE, higher_rank: str = K.HIGHER_RANK_TYPE) -> DataFrame:
    """Best candidates per search name, ties kept; one row of NULLs when nothing usable.

    A search name gets the default row when it has no candidate, or when
    every candidate's match type is ``no_match``, or every one is
    ``higher_rank`` (a NULL match type counts as neither). Otherwise all
    candidates tied at the highest confidence are kept, in the template's
    columns. Names are searched once per input row, duplicates included.
    """
    mt = F.col("matchType")
    stats = candidates.groupBy("searchName").agg(
        F.bool_and(F.coalesce(mt == F.lit(no_match), F.lit(False))).alias("__none__"),
        F.bool_and(F.coalesce(mt == F.lit(higher_rank), F.lit(False))).alias("__higher__"),
        F.max("confidence").alias("__top__"),
    )
    usable = stats.filter(~F.col("__none__") & ~F.col("__higher__")).select("searchName", "__top__")
    best = join_on(candidates, usable, {"searchName": "searchName", "confidence": "__top__"}, "left_semi")
    # a name without usable candidates finds no row here: the left join itself gives the default row
    best = conform(best, MATCH_TEMPLATE)
    queries = names.select(F.col(name_col).cast("string").alias("searchName"))
    return join_on(queries, best, "searchName", "left").select(*MATCH_TEMPLATE.fieldNames())


def lookup_usage(keys: DataFrame, usage: DataFrame, key_col: str = "usageKey") -> DataFrame:
    """One usage row per input key row (``map_df(keys, name_usage)``)."""
    k = keys.select(F.col(key_col).alias("key"))
    return join_on(k, usage, "key", "inner", null_safe=False)


def resolve_accepted(names: DataFrame, candidates: DataFrame, usage: DataFrame,
                     name_col: str = "NameAuthor", confidence: int = K.REQUIRED_CONFIDENCE) -> DataFrame:
    """Resolve names to taxon keys and their attributes (``find_accepted_names``).

    Search names with more than one best candidate are dropped, then those
    below ``confidence``; usage rows are fetched per key; the search name is
    attached by *scientific name*; one row per scientific name survives
    (first by searchName, then key).

    A name that is searched more than once has more than one match whatever its candidates are, so it is left out before
    the search: names and candidates that share a frequent name would otherwise meet in all pairs, only to be dropped.

    One pass over the matches: each gives its search name to the scientific
    name that it matched, and its usage row to the one that this row has; an
    aggregate per scientific name takes the first of both.
    """
    once = group_count_having(names.select(F.col(name_col).cast("string").alias(name_col)), [name_col], lambda n: n == 1)
    batch = match_names(once.select(name_col), candidates, name_col)
    unique = keep_unique(batch, ["searchName"], narrow=True).filter(F.col("confidence") == F.lit(confidence))
    fields = [c for c in usage.columns if c != "scientificName"]
    rows = usage.select(F.col("key").alias("__key__"), F.col("scientificName").alias("__name__"),
                        F.struct("key", *[c for c in fields if c != "key"]).alias("__usage__"))
    found = unique.join(rows, unique["usageKey"] == rows["__key__"], "left")
    both = found.select(F.explode(F.array(
        F.struct(F.col("scientificName").alias("name"), F.col("searchName").alias("search"),
                 F.when(F.lit(False), F.col("__usage__")).alias("use")),
        F.struct(F.col("__name__").alias("name"), F.lit(None).cast("string").alias("search"),
                 F.col("__usage__").alias("use")))).alias("r")).select("r.*")
    per_name = both.groupBy("name").agg(F.min("search").alias("searchName"), F.min("use").alias("use")).filter(
        F.col("use").isNotNull())
    return per_name.select(*[F.col("name").alias(c) if c == "scientificName" else F.col("use")[c].alias(c)
                             for c in usage.columns], "searchName")


def _accepted_fallback(df: DataFrame) -> DataFrame:
    return (df.withColumn("accepted", F.coalesce(F.col("accepted"), F.col("scientificName")))
              .withColumn("acceptedKey", F.coalesce(F.col("acceptedKey"), F.col("key"))))


def redlist_labels(assessments: DataFrame, taxonomy: DataFrame,
                   not_threatened=K.NOT_THREATENED_CATEGORIES, data_deficient: str = K.DATA_DEFICIENT) -> DataFrame:
    """Assessments joined to their taxonomy, labelled 0/1, data-deficient ones dropped."""
    rl = join_suffixed(assessments, taxonomy, "scientificName", "inner", (".x", ".y"))
    return (rl.withColumn("NameAuthor", paste("scientificName", "authority"))
              .withColumn("Threatened", F.when(is_member("redlistCategory", not_threatened), F.lit(0)).otherwise(F.lit(1)))
              .withColumn("Source", F.lit(K.SOURCE_REDLIST))
              .filter(F.col("redlistCategory") != F.lit(data_deficient)))


def natureserve_labels(natureserve: DataFrame, redlist: DataFrame, threatened=K.THREATENED_GRANKS) -> DataFrame:
    """Second assessment source, minus names the first one holds."""
    ns = (natureserve.withColumn("NameAuthor", paste("scientificName", "scientificNameAuthor"))
          .withColumn("Threatened", F.when(is_member("roundedGRank", threatened), F.lit(1)).otherwise(F.lit(0)))
          .withColumn("Source", F.lit(K.SOURCE_NATURESERVE)))
    return anti_join(ns, redlist, "scientificName")


def assessed_species(redlist: DataFrame, natureserve: DataFrame, excluded=K.KNOWN_ISSUE_NAMES) -> DataFrame:
    """(NameAuthor, Source, Threatened) of both sources, known problem names removed."""
    both = union_missing(redlist, natureserve).select("NameAuthor", "Source", "Threatened")
    return both.filter(~is_member("NameAuthor", excluded))


def accepted_assessed(training: DataFrame, candidates: DataFrame, usage: DataFrame,
                      drop_status=K.DROP_STATUS_ASSESSED, drop_species=K.ASSESSED_UNDER_HETEROTYPIC_SYNONYM) -> DataFrame:
    acc = resolve_accepted(training, candidates, usage)
    acc = acc.filter(~is_member("taxonomicStatus", drop_status) & ~is_member("species", drop_species))
    return _accepted_fallback(acc)


def training_table(training: DataFrame, accepted: DataFrame) -> DataFrame:
    """Assessed names with their accepted name (right join: one row per resolved name)."""
    acc = accepted.select("searchName", "accepted", "species")
    out = join_on(training, acc, {"NameAuthor": "searchName"}, "right")
    return rename(out, {"accepted": "acceptedNameAuthor", "species": "acceptedName"})


def unassessed_checklist(checklist: DataFrame, training: DataFrame) -> DataFrame:
    return anti_join(checklist, training, "NameAuthor")


def accepted_checklist(checklist: DataFrame, candidates: DataFrame, usage: DataFrame,
                       drop_status=K.DROP_STATUS_CHECKLIST) -> DataFrame:
    acc = resolve_accepted(checklist, candidates, usage)
    return _accepted_fallback(acc.filter(~is_member("taxonomicStatus", drop_status)))


def checklist_table(checklist: DataFrame, accepted: DataFrame) -> DataFrame:
    acc = accepted.select("searchName", "species", "accepted", "acceptedKey")
    out = join_on(checklist, acc, {"NameAuthor": "searchName"}, "right")
    return rename(out, {"species": "acceptedName", "accepted": "acceptedNameAuthor",
                        "acceptedKey": "gbifAcceptedKey"})


def find_synonyms(accepted: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Synonyms of the distinct accepted keys; names listed under several keys are dropped."""
    keys = accepted.select("acceptedKey").distinct()
    syn = join_on(synonyms, keys, "acceptedKey", "left_semi", null_safe=False)
    return keep_unique(syn, ["scientificName"], narrow=True)


def _synonym_rows(accepted: DataFrame, synonyms: DataFrame) -> DataFrame:
    syn = find_synonyms(accepted, synonyms).select("scientificName", "species", "accepted", "acceptedKey")
    rows = union_missing(syn, accepted.select("species", "accepted", "acceptedKey"))
    rows = rows.select("scientificName", "species", "accepted", "acceptedKey")
    rows = rows.withColumn("scientificName", F.coalesce(F.col("scientificName"), F.col("accepted")))
    rows = rename(rows, {"species": "acceptedName", "accepted": "acceptedNameAuthor",
                         "acceptedKey": "gbifAcceptedKey", "scientificName": "NameAuthor"})
    return rows.filter(not_matches("NameAuthor", r"\?"))


def synonym_map(accepted_assessed: DataFrame, accepted_checklist: DataFrame, synonyms: DataFrame,
                fixes=K.NAME_AUTHOR_FIXES) -> DataFrame:
    """Every name (accepted and synonym) with its accepted name; names of two taxa dropped.

    Adds ``mycoportalNameAuthor``: the name with a blank after each initial
    (or a fixed spelling), used to match the portal's records.
    """
    a = _synonym_rows(accepted_assessed, synonyms)
    b = _synonym_rows(accepted_checklist, synonyms).distinct()
    both = union_strict(a, b).distinct()
    both = both.withColumn("mycoportalNameAuthor", override("NameAuthor", fixes, space_initials("NameAuthor")))
    return keep_unique(both, ["NameAuthor"], narrow=True)
