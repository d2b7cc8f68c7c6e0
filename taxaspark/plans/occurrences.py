"""Filter and merge occurrence records of the wanted species from a portal and an aggregator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_member, paste, qcol
from ..functions.text import code_map, combined_id, lenient_double
from ..operators.dedup import first_per_key
from ..operators.frames import drop_strict, rename, union_missing, union_strict
from ..operators.joins import join_on, keep_keys_in_other
from ..sources.delimited import ORDER
from . import constants as K


def portal_records(files: Sequence[DataFrame], drops: Sequence[Sequence[str]] | None = None,
                   tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Portal files bound by name (earlier files first), one record per ``id``.

    ``drops`` are the columns removed from each file (strict). Between
    copies of an id the earlier file wins, then the one that stands first in it where the files were read with their
    order (``ordered=True``; the order itself is left out of the result), then ``tiebreak``. Frames without it have no
    order of their own, so the smallest hash of the whole record decides last: the order is total, and a retry keeps the same copy.
    """
    tagged = []
    for i, f in enumerate(files):
        if drops and drops[i]:
            f = drop_strict(f, drops[i])
        tagged.append(f.withColumn("__file__", F.lit(i)))
    allr = union_missing(*tagged)
    placed = [F.col(ORDER)] if ORDER in allr.columns else []
    total = [] if all(ORDER in f.columns for f in tagged) else [F.xxhash64(*[qcol(c) for c in allr.columns if c != ORDER])]
    return first_per_key(allr, ["id"], [F.col("__file__"), *placed, *tiebreak, *total]).drop("__file__", ORDER)


def portal_matches(portal: DataFrame, checklist: DataFrame, names: DataFrame) -> DataFrame:
    """Portal records of wanted species, by taxon id (route 1, wins) or by name (route 2).

    Route 1: taxon id in the checklist, accepted name attached, NameAuthor =
    genus + epithet + author. Route 2: name + author equal to a name in
    either name column of the synonym map; the accepted name is attached by
    the spaced name only. ``portal`` must hold one row per id (as
    ``portal_records`` returns), and each gives at most one row: where a taxon id or a
    name has several accepted names, the first by (acceptedNameAuthor,
    acceptedName), missing values last.

    The name tables are reduced to one row per key first, so the wide records
    go through two left joins and nothing else: no union, no distinct, no window.
    """
    accepted = ("acceptedNameAuthor", "acceptedName")

    def first_name(route: Column) -> Column:
        return F.min(F.struct(route.alias("route"), *[x for c in accepted for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]))

    by_id = checklist.filter(F.col("TaxonId").isNotNull()).groupBy(F.col("TaxonId").alias("__id__")).agg(
        first_name(F.lit(1)).alias("__by_id__"))
    none = F.lit(None).cast("string")
    keyed = names.select(F.explode(F.array(
        F.struct(F.col("mycoportalNameAuthor").alias("__name__"), F.lit(1).alias("route"), *[F.col(c) for c in accepted]),
        F.struct(F.col("NameAuthor").alias("__name__"), F.lit(2).alias("route"), *[none.alias(c) for c in accepted]))).alias("k")).select("k.*")
    by_name = keyed.filter(F.col("__name__").isNotNull()).groupBy("__name__").agg(first_name(F.col("route")).alias("__by_name__"))
    full = paste("scientificName", "scientificNameAuthorship")
    found = portal.join(by_id, portal["taxonID"] == F.col("__id__"), "left").withColumn("__full__", full) \
        .join(by_name, F.col("__full__") == F.col("__name__"), "left")
    route1, route2 = F.col("__by_id__").isNotNull(), F.col("__by_name__").isNotNull()
    return found.filter(route1 | route2).select(
        *[qcol(c) for c in portal.columns],
        *[F.when(route1, F.col("__by_id__")[c]).otherwise(F.col("__by_name__")[c]).alias(c) for c in accepted],
        F.when(route1, paste("genus", "specificEpithet", "scientificNameAuthorship")).otherwise(F.col("__full__")).alias("NameAuthor"))


def aggregator_records(files: Sequence[DataFrame], names: DataFrame, drops: Sequence[Sequence[str]] | None = None,
                       excluded_codes=K.EXCLUDED_COUNTRY_CODES, absent: str = K.ABSENT_STATUS) -> DataFrame:
    """Aggregator records of the wanted keys outside the excluded countries, absences removed.

    The semi-join on the wanted keys followed by a left join of their names
    is one inner join (null-safe); keys listed with two names fan out as in
    the reference.
    """
    keys = names.select("gbifAcceptedKey", "acceptedName", "acceptedNameAuthor").distinct()
    out = []
    for i, f in enumerate(files):
        g = join_on(f, keys, {"speciesKey": "gbifAcceptedKey"}, "inner")
        g = rename(g, {"scientificName": "NameAuthor", "species": "scientificName"})
        g = g.filter(~is_member("countryCode", excluded_codes) & (F.col("occurrenceStatus") != F.lit(absent)))
        if drops and drops[i]:
            g = drop_strict(g, drops[i])
        out.append(g)
    return union_strict(*out)


def combine_records(portal: DataFrame, aggregator: DataFrame, country_codes=K.COUNTRY_CODES) -> DataFrame:
    """Bind both sources, label the origin, make one id per record, fill country codes,
    and keep only species that have at least one portal record."""
    agg = aggregator.withColumn("year", lenient_double("year"))
    allr = union_missing(portal.withColumn("year", F.col("year").cast("double")), agg)
    allr = (allr.withColumn("Source", F.when(F.col("gbifID").isNull(), F.lit(K.SOURCE_PORTAL))
                            .otherwise(F.lit(K.SOURCE_AGGREGATOR)))
            .withColumn("uniqueCombinedID", combined_id("id", "gbifID", K.PORTAL_ID_TAG, K.AGGREGATOR_ID_TAG))
            .withColumn("countryCode", code_map("country", country_codes, existing="countryCode")))
    return keep_keys_in_other(allr, "acceptedNameAuthor", portal)


def filter_occurrences(portal_files: Sequence[DataFrame], aggregator_files: Sequence[DataFrame],
                       names: DataFrame, checklist: DataFrame,
                       portal_drops: Sequence[Sequence[str]] | None = None,
                       aggregator_drops: Sequence[Sequence[str]] | None = None,
                       tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Occurrence records of the wanted species from both sources, one row per record."""
    portal = portal_records(portal_files, portal_drops, tiebreak)
    matched = portal_matches(portal, checklist, names)
    agg = aggregator_records(aggregator_files, names, aggregator_drops)
    return combine_records(matched, agg)
