"""Species-level predictors: record counts, share of recent records, year of publication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.nulls import present
from ..functions.numeric import round_half_up, share_true
from ..functions.text import override
from ..operators.dedup import two_stage_dedup
from ..operators.frames import drop_missing, union_strict
from ..operators.geo import quality_gate
from ..operators.joins import join_on
from . import constants as K

ACC = "acceptedNameAuthor"


def specimen_count(occs: DataFrame, species: str = ACC, lat: str = "decimalLatitude",
                   lon: str = "decimalLongitude", locality: str = "locality",
                   georef: str = "georeferenced", digits: int = K.GRID_DIGITS) -> DataFrame:
    """Records per species after de-duplication.

    Georeferenced records count once per coordinate cell rounded to
    ``digits``; others once per locality; others without locality each.
    The first-wins dedups only feed a count, so this is one scan: every
    record is tagged with its dedup key (kind, a, b), a first aggregate
    collapses equal keys (rows without locality keep their multiplicity in
    ``n``), a second one counts per species. Both aggregates combine on the
    map side, so a species holding a large share of the rows stays cheap.
    """
    g = F.col(georef)
    is_geo = g == F.lit(True)
    is_loc = F.col(locality).isNotNull() & (g == F.lit(False))
    is_rest = F.col(locality).isNull() & (g == F.lit(False))
    kind = F.when(is_geo, F.lit(1)).when(is_loc, F.lit(2)).when(is_rest, F.lit(3))
    a = F.when(is_geo, round_half_up(lat, digits).cast("string")).when(is_loc, F.col(locality))
    b = F.when(is_geo, round_half_up(lon, digits).cast("string"))
    keyed = occs.select(species, kind.alias("__k__"), a.alias("__a__"), b.alias("__b__")).filter(
        F.col("__k__").isNotNull())
    per_key = keyed.groupBy(species, "__k__", "__a__", "__b__").agg(F.count(F.lit(1)).alias("__n__"))
    weight = F.when(F.col("__k__") == 3, F.col("__n__")).otherwise(F.lit(1))
    return per_key.groupBy(species).agg(F.sum(weight).cast("long").alias("specimenCount"))


def contemporary_share(occs: DataFrame, order_by: Sequence[str | Column], species: str = ACC,
                       year: str = "year", locality: str = "locality", lat: str = "decimalLatitude",
                       lon: str = "decimalLongitude", after: int = K.CONTEMPORARY_AFTER_YEAR) -> DataFrame:
    """Share of records after ``after`` per species, after two first-wins dedups
    (species/locality/year, then species/coordinates/year); no year gives 0."""
    d = two_stage_dedup(occs, [species, locality, year], [species, lat, lon, year], order_by)
    return d.groupBy(species).agg(share_true(F.col(year) > F.lit(after)).alias("propContemporary"))


def occurrence_predictors(occs: DataFrame, order_by: Sequence[str | Column], gate: bool = True) -> DataFrame:
    """(species, specimenCount, propContemporary, logSpecimenCount) from flagged records."""
    o = quality_gate(occs) if gate else occs
    counts = specimen_count(o)
    share = contemporary_share(o, order_by)
    out = join_on(counts, share, ACC, "left")
    return out.withColumn("logSpecimenCount", F.ln(F.col("specimenCount").cast("double")))


def clean_backbone(backbone: DataFrame, fixes=K.CURRENT_NAME_FIXES) -> DataFrame:
    """Names with an author (blank counts as missing), known misspelt current names fixed."""
    b = backbone.filter(present("AUTHORS"))
    return b.withColumn("CURRENT_NAME", override("NAME_OF_FUNGUS", fixes, "CURRENT_NAME"))


def basionym_years(backbone: DataFrame, group: str) -> DataFrame:
    """(group, ``__y__``): the earliest year of each group's basionym records; groups without a year are left out."""
    b = backbone.filter(F.col("RECORD_NUMBER") == F.col("BASIONYM_RECORD_NUMBER"))
    return b.groupBy(group).agg(F.min("YEAR_OF_PUBLICATION").cast("int").alias("__y__")).filter(F.col("__y__").isNotNull())


MANUAL_SCHEMA = StructType([StructField(ACC, StringType()), StructField("yearPublished", IntegerType())])


def year_published(backbone: DataFrame, names: DataFrame, manual: DataFrame | None = None,
                   key_form: Callable[[Column], Column] | None = None) -> DataFrame:
    """(acceptedNameAuthor, yearPublished): the basionym year of each wanted name.

    By current name first; names not found that way by the name itself;
    then manual rows; incomplete rows dropped.

    ``key_form`` (e.g. ``functions.text.binomial``) is applied to the wanted
    names, the backbone's names and the manual names before they are
    compared, for when one side carries the author and the other does not;
    the result is then keyed by the wanted names as given.
    """
    form = key_form or (lambda c: c)
    bb = clean_backbone(backbone).select(
        "RECORD_NUMBER", "BASIONYM_RECORD_NUMBER", "CURRENT_NAME_RECORD_NUMBER", "YEAR_OF_PUBLICATION",
        (F.col("NAME_OF_FUNGUS") == F.col("CURRENT_NAME")).alias("__same__"),
        form(F.col("CURRENT_NAME")).alias("CURRENT_NAME"), form(F.col("NAME_OF_FUNGUS")).alias("NAME_OF_FUNGUS"))
    keyed = names.select(F.col(ACC), form(F.col(ACC)).alias("__key__")).distinct()

    def years(held: DataFrame, group: str, route: int) -> DataFrame:
        """Names that the backbone holds in column ``group``, with the year of their basionyms if it has one."""
        found = join_on(held.select(group).distinct(), basionym_years(bb, group), group, "left")
        return found.select(F.col(group).alias("__key__"), F.lit(route).alias("__route__"), F.col("__y__").alias("yearPublished"))

    current = bb.filter((F.col("RECORD_NUMBER") == F.col("CURRENT_NAME_RECORD_NUMBER")) | F.col("__same__"))
    # by the current name; names that are no current name by the name itself: the first route that knows the name counts
    known = years(current, "CURRENT_NAME", 1).unionByName(years(bb, "NAME_OF_FUNGUS", 2))
    first = known.groupBy("__key__").agg(F.min(F.struct("__route__", "yearPublished")).alias("f")).select(
        "__key__", F.col("f.yearPublished").alias("yearPublished"))
    if key_form is None:
        out = join_on(keyed.select(F.col(ACC).alias("__key__")), first, "__key__", "inner")
        parts = [out.select(F.col("__key__").alias(ACC), "yearPublished")]
        if manual is not None:
            parts.append(manual.select(F.col(ACC).cast("string").alias(ACC), F.col("yearPublished").cast("int").alias("yearPublished")))
        return drop_missing(union_strict(*parts))
    if manual is not None:
        first = union_strict(first, manual.select(form(F.col(ACC).cast("string")).alias("__key__"),
                                                  F.col("yearPublished").cast("int").alias("yearPublished")))
    return join_on(keyed, drop_missing(first), "__key__", "inner").select(ACC, "yearPublished").distinct()


def manual_years(spark, rows=K.MANUAL_YEARS) -> DataFrame:
    return spark.createDataFrame(list(rows), MANUAL_SCHEMA)


def species_predictors(occs: DataFrame, years: DataFrame, threat: DataFrame,
                       order_by: Sequence[str | Column], gate: bool = True) -> DataFrame:
    """Predictor table: counts, share, log count, year; complete rows only; label attached
    after the drop, so it may be NULL (one row per label when a name has several)."""
    occ = occurrence_predictors(occs, order_by, gate)
    out = drop_missing(join_on(occ, years, ACC, "left"))
    return join_on(out, threat.select(ACC, "Threatened"), ACC, "left")
