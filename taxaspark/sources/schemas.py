"""Declared schemas of the pipeline's inputs (read with ``.schema(...)``, never inferred).

Column names are the reference's, with blanks, dots and slashes of the raw
headers turned into underscores (``Subphylum name`` -> ``subphylum_name``,
``NAME.OF.FUNGUS`` -> ``NAME_OF_FUNGUS``).
"""

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _s(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


S, L, I, D, B = StringType(), LongType(), IntegerType(), DoubleType(), BooleanType()

MICROFUNGI = _s(("Species", S))
PORTAL_CHECKLIST = _s(("ScientificName", S), ("ScientificNameAuthorship", S), ("TaxonId", L))
HIGHER_TAXA = _s(("subphylum_name", S), ("class_name", S), ("order_name", S), ("genus_name", S))
PROTO_CHECKLIST = _s(("MycoBank", S), ("Author", S), ("current_name", S))
ASSESSMENTS = _s(("scientificName", S), ("redlistCategory", S))
TAXONOMY = _s(("scientificName", S), ("authority", S))
NATURESERVE = _s(("scientificName", S), ("scientificNameAuthor", S), ("roundedGRank", S))
NAME_CANDIDATES = _s(("searchName", S), ("usageKey", L), ("scientificName", S), ("rank", S),
                     ("confidence", I), ("matchType", S))
TAXON_USAGE = _s(("key", L), ("scientificName", S), ("species", S), ("accepted", S),
                 ("taxonomicStatus", S), ("acceptedKey", L))
TAXON_SYNONYMS = _s(("acceptedKey", L), ("scientificName", S), ("species", S), ("accepted", S))
PORTAL_OCCURRENCES = _s(("id", L), ("taxonID", L), ("scientificName", S), ("scientificNameAuthorship", S),
                        ("genus", S), ("specificEpithet", S), ("country", S), ("countryCode", S),
                        ("stateProvince", S), ("county", S), ("locality", S), ("year", I),
                        ("decimalLatitude", D), ("decimalLongitude", D), ("coordinateUncertaintyInMeters", D))
AGGREGATOR_OCCURRENCES = _s(("gbifID", L), ("speciesKey", L), ("scientificName", S), ("species", S),
                            ("countryCode", S), ("occurrenceStatus", S), ("stateProvince", S), ("county", S),
                            ("locality", S), ("year", S), ("decimalLatitude", D), ("decimalLongitude", D),
                            ("coordinateUncertaintyInMeters", D))
COUNTRY_CENTROIDS = _s(("country", S), ("lat", D), ("lon", D))
BACKBONE = _s(("NAME_OF_FUNGUS", S), ("AUTHORS", S), ("CURRENT_NAME", S), ("RECORD_NUMBER", L),
              ("BASIONYM_RECORD_NUMBER", L), ("CURRENT_NAME_RECORD_NUMBER", L), ("YEAR_OF_PUBLICATION", I))
PREDICTORS = _s(("acceptedNameAuthor", S), ("specimenCount", L), ("propContemporary", D),
                ("logSpecimenCount", D), ("yearPublished", I), ("Threatened", I))
