from pyspark.sql import functions as F

from conftest import rows
from taxaspark.plans import occurrences as O
from taxaspark.plans import predictors as P

PORTAL = ("id long, taxonID long, scientificName string, scientificNameAuthorship string, genus string, "
          "specificEpithet string, country string, countryCode string, year int, locality string")
AGG = ("gbifID long, speciesKey long, scientificName string, species string, countryCode string, "
       "occurrenceStatus string, year string, locality string")
NAMES = ("NameAuthor string, acceptedName string, acceptedNameAuthor string, gbifAcceptedKey long, "
         "mycoportalNameAuthor string")


def _inputs(spark):
    ca = spark.createDataFrame([(1, 10, "Aa b", "L.", "Aa", "b", "canada", None, 2001, "x")], PORTAL)
    us = spark.createDataFrame([(1, 10, "Aa b", "L.", "Aa", "b", "USA", None, 1999, "us-copy"),
                                (2, None, "Cc d", "J.I.Kim", "Cc", "d", "USA", None, 1990, "y"),
                                (3, 11, "Zz q", "Q", "Zz", "q", "Mexico", "MX", None, "z")], PORTAL)
    names = spark.createDataFrame([("Aa b L.", "Aa b", "Aa b L.", 100, "Aa b L."),
                                   ("Cc d J.I.Kim", "Cc d", "Cc d J.I. Kim", 200, "Cc d J.I. Kim"),
                                   ("Zz q Q", "Zz q", "Zz q Q", 300, "Zz q Q")], NAMES)
    checklist = spark.createDataFrame([(10, "Aa b L.", "Aa b"), (11, "Zz q Q", "Zz q"), (None, "n", "n")],
                                      "TaxonId long, acceptedNameAuthor string, acceptedName string")
    agg = spark.createDataFrame([(900, 100, "Aa b L.", "Aa b", "FR", "PRESENT", "1980", "f"),
                                 (901, 100, "Aa b L.", "Aa b", "US", "PRESENT", "2000", "u"),
                                 (902, 100, "Aa b L.", "Aa b", None, "PRESENT", "abc", "n"),
                                 (903, 100, "Aa b L.", "Aa b", "DE", "ABSENT", "2000", "a"),
                                 (904, 999, "Ee f", "Ee f", "DE", "PRESENT", "2000", "e"),
                                 (905, 300, "Zz q Q", "Zz q", "DE", None, "2000", "s")], AGG)
    return ca, us, names, checklist, agg


def test_filter_occurrences(spark):
    ca, us, names, checklist, agg = _inputs(spark)
    out = O.filter_occurrences([ca, us], [agg], names, checklist)
    got = {r.uniqueCombinedID: r for r in out.collect()}
    # id 1: the Canadian copy wins; route 1 (taxon id) supplies the accepted name
    assert got["1m"].locality == "x" and got["1m"].countryCode == "CA" and got["1m"].Source == "MycoPortal"
    # id 2: matched by name only; the accepted name comes from the spaced name column
    assert got["2m"].acceptedNameAuthor is None and got["2m"].countryCode == "US"
    assert got["3m"].countryCode == "MX"
    # aggregator: US dropped, NULL country kept, absences and NULL status dropped, unknown key dropped
    assert {k for k in got if k.endswith("g")} == {"900g", "902g"}
    assert got["902g"].year is None and got["900g"].year == 1980.0 and got["900g"].Source == "GBIF"


def test_species_gate(spark):
    portal = spark.createDataFrame([(1, "A"), (None, "A")], "id long, acceptedNameAuthor string")
    allr = spark.createDataFrame([(1, None, "A"), (None, 7, "A"), (None, 8, "B")],
                                 "id long, gbifID long, acceptedNameAuthor string")
    from taxaspark.operators.joins import keep_keys_in_other
    assert rows(keep_keys_in_other(allr, "acceptedNameAuthor", portal), "gbifID") == [(None,), (7,)]


OCC = ("uid long, acceptedNameAuthor string, year double, locality string, decimalLatitude double, "
       "decimalLongitude double, georeferenced boolean")


def test_specimen_count_and_share(spark):
    data = [
        (1, "s", 1990.0, "L1", 45.12341, -69.0, True), (2, "s", 1995.0, "L1", 45.12342, -69.0, True),
        (3, "s", None, "L2", 10.0, 10.0, True), (4, "s", 2000.0, "L3", None, None, False),
        (5, "s", 2001.0, "L3", None, None, False), (6, "s", 1991.0, None, None, None, False),
        (7, "s", 1991.0, None, None, None, False), (8, "t", None, None, None, None, False),
    ]
    df = spark.createDataFrame(data, OCC)
    assert rows(P.specimen_count(df)) == [("s", 5), ("t", 1)]
    share = dict(P.contemporary_share(df, ["uid"]).collect())
    # stage 1 (species, locality, year) keeps 1,2,3,4,5,6; stage 2 drops none -> years 1990,1995,2000,2001,1991
    assert abs(share["s"] - 3 / 5) < 1e-12 and share["t"] == 0.0


def test_share_fixture(spark):
    df = spark.createDataFrame([(1, "a", 1990.0, "x"), (2, "a", 1995.0, "y"), (3, "a", None, "z"),
                                (4, "b", None, "x")], "uid long, acceptedNameAuthor string, year double, locality string")
    df = df.withColumn("decimalLatitude", F.lit(None).cast("double")).withColumn("decimalLongitude", F.lit(None).cast("double"))
    assert rows(P.contemporary_share(df, ["uid"], after=1992)) == [("a", 0.5), ("b", 0.0)]


BB = ("NAME_OF_FUNGUS string, AUTHORS string, CURRENT_NAME string, RECORD_NUMBER long, BASIONYM_RECORD_NUMBER long, "
      "CURRENT_NAME_RECORD_NUMBER long, YEAR_OF_PUBLICATION int")


def test_year_published(spark):
    bb = spark.createDataFrame([
        ("Aa b", "L.", "Aa b", 1, 1, 1, 1800),          # current, basionym 1800
        ("Xx b", "Fr.", "Aa b", 2, 2, 1, 1790),         # older basionym of the same current name
        ("Yy c", "", "Aa b", 3, 3, 1, 1700),            # blank author: removed
        ("Cc d", "Pk.", "Zz z", 4, 4, 9, 1900),         # not current: found through the name route
        ("Amylocystis lapponicus", "X", "wrong", 5, 5, 5, 1850),
    ], BB)
    names = spark.createDataFrame([("Aa b",), ("Cc d",), ("Amylocystis lapponica",), ("Nn n",)], "acceptedNameAuthor string")
    out = P.year_published(bb, names, P.manual_years(spark))
    got = dict(out.collect())
    assert got["Aa b"] == 1790 and got["Cc d"] == 1900 and got["Amylocystis lapponica"] == 1850
    assert "Nn n" not in got and got["Sarcodon joeides"] == 1872


def test_label_after_drop(spark):
    occ = spark.createDataFrame([(1, "s", 2000.0, "L", 1.0, 2.0, True)], OCC)
    for c in ("cc_zero", "cc_equ", "clean_tests", "cc_err"):
        occ = occ.withColumn(c, F.lit(True))
    years = spark.createDataFrame([("s", 1900)], "acceptedNameAuthor string, yearPublished int")
    threat = spark.createDataFrame([("other", 1)], "acceptedNameAuthor string, Threatened int")
    out = P.species_predictors(occ, years, threat, ["uid"]).collect()
    assert len(out) == 1 and out[0].Threatened is None and out[0].specimenCount == 1


def test_reference_drop_lists_apply(spark):
    from taxaspark.plans import constants as K
    cols = ["id", "locality"] + list(dict.fromkeys(K.PORTAL_US_DROP))
    df = spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"`{c}` int" for c in cols))
    out = O.portal_records([df], [K.PORTAL_US_DROP])
    assert out.columns == ["id", "locality"]


def test_route_one_wins_over_name_route(spark):
    portal = spark.createDataFrame([(1, 10, "Aa b", "L.", "Aa", "b", "USA", None, 2001, "x"),
                                    (2, None, "Aa b", "L.", "Aa", "b", "USA", None, 2001, "y")], PORTAL)
    checklist = spark.createDataFrame([(10, "Route one", "R1")],
                                      "TaxonId long, acceptedNameAuthor string, acceptedName string")
    names = spark.createDataFrame([("Aa b L.", "N2", "Route two", 5, "Aa b L.")], NAMES)
    got = dict(O.portal_matches(portal, checklist, names).select("id", "acceptedNameAuthor").collect())
    assert got == {1: "Route one", 2: "Route two"}


def test_year_published_key_form(spark):
    from taxaspark.functions.text import binomial
    bb = spark.createDataFrame([
        ("Aa b", "L.", "Aa b", 1, 1, 1, 1800),
        ("Xx b", "Fr.", "Aa b", 2, 2, 1, 1790),
        ("Cc d", "Pk.", "Zz z", 4, 4, 9, 1900),
    ], BB)
    names = spark.createDataFrame([("Aa b L.",), ("Cc d (Fr.) Pk.",), ("Sarcodon joeides Pat.",), ("Nn",)],
                                  "acceptedNameAuthor string")
    plain = dict(P.year_published(bb, names).collect())
    assert "Aa b L." not in plain                     # with authors on one side only, nothing matches
    keyed = dict(P.year_published(bb, names, P.manual_years(spark), key_form=binomial).collect())
    assert keyed == {"Aa b L.": 1790, "Cc d (Fr.) Pk.": 1900, "Sarcodon joeides Pat.": 1872}
