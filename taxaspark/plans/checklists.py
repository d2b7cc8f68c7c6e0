"""Combine two species checklists into one (names, genus, name with author, source)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of, not_matches, paste_guarded
from ..functions.text import first_word, word_count
from ..operators.frames import union_missing
from ..operators.joins import anti_join, semi_join
from . import constants as K

PERIOD = r"\."


def portal_checklist(portal: DataFrame, micro: DataFrame, micro_col: str = "Species") -> DataFrame:
    """First checklist: genus, name with author, source; infraspecific names and known
    microfungi (by species or by genus) removed."""
    out = (portal.withColumn("Genus", first_word("ScientificName"))
           .withColumn("Source", F.lit(K.SOURCE_PORTAL_CHECKLIST))
           .withColumn("NameAuthor", paste_guarded("ScientificName", "ScientificNameAuthorship"))
           .filter(not_matches("ScientificName", PERIOD)))
    out = anti_join(out, micro, {"ScientificName": micro_col})
    return anti_join(out, micro, {"Genus": micro_col})


def macro_genera(taxa: DataFrame, subphyla=K.MACRO_SUBPHYLA, classes=K.MACRO_CLASSES,
                 orders=K.MACRO_ORDERS) -> DataFrame:
    """Rows of the higher taxonomy in the macrofungal groups (NULL tests drop, as R's filter)."""
    conds = [F.col("subphylum_name") == F.lit(s) for s in subphyla]
    conds += [F.col("class_name") == F.lit(c) for c in classes]
    conds += [F.col("order_name") == F.lit(o) for o in orders]
    return taxa.filter(any_of(conds))


def proto_checklist(proto: DataFrame, macro: DataFrame, first: DataFrame, require_placed: bool = True) -> DataFrame:
    """Second checklist: two-word names in macrofungal genera that the first list lacks."""
    out = (proto.withColumn("Genus", first_word("MycoBank"))
           .withColumn("Source", F.lit(K.SOURCE_PROTO_CHECKLIST))
           .withColumn("NameAuthor", paste_guarded("MycoBank", "Author")))
    cond = (word_count("MycoBank") >= 2) & not_matches("MycoBank", PERIOD)
    if require_placed:
        cond = F.col("current_name").isNotNull() & cond
    out = out.filter(cond)
    out = semi_join(out, macro, {"Genus": "genus_name"})
    out = anti_join(out, first, {"MycoBank": "ScientificName"})
    return out.select(F.col("MycoBank").alias("ScientificName"),
                      F.col("Author").alias("ScientificNameAuthorship"), "Genus", "NameAuthor", "Source")


def combine_checklists(portal: DataFrame, micro: DataFrame, taxa: DataFrame, proto: DataFrame,
                       require_placed: bool = True) -> DataFrame:
    """Both checklists bound by name; columns only one side has are NULL on the other."""
    first = portal_checklist(portal, micro)
    second = proto_checklist(proto, macro_genera(taxa), first, require_placed)
    return union_missing(first, second)

