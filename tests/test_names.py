from pyspark.sql import functions as F

from conftest import rows
from taxaspark.plans import checklists as CL
from taxaspark.plans import names as N
from taxaspark.sources import schemas as SC

CAND = [
    ("s1", 1, "k1", "SPECIES", 100, "EXACT"),
    ("s1", 2, "k2", "SPECIES", 100, "FUZZY"),
    ("s1", 3, "k3", "SPECIES", 90, "FUZZY"),
    ("s2", 5, "k5", "GENUS", 50, "NONE"),
    ("s2", 6, "k6", "GENUS", 40, "NONE"),
    ("s4", 4, "k4", "SPECIES", 100, "EXACT"),
    ("s5", 7, "k5b", "SPECIES", 98, "EXACT"),
    ("s6", 8, "k8", "GENUS", 70, "HIGHERRANK"),
]


def _names(spark, *ns):
    return spark.createDataFrame([(n,) for n in ns], "NameAuthor string")


def test_match_names(spark):
    cand = spark.createDataFrame(CAND, SC.NAME_CANDIDATES)
    out = N.match_names(_names(spark, "s1", "s2", "s3", "s6"), cand)
    assert out.columns == ["searchName", "usageKey", "scientificName", "rank", "confidence"]
    assert rows(out) == [("s1", 1, "k1", "SPECIES", 100), ("s1", 2, "k2", "SPECIES", 100),
                         ("s2", None, None, None, None), ("s3", None, None, None, None),
                         ("s6", None, None, None, None)]


def test_match_names_null_match_type_is_not_none(spark):
    cand = spark.createDataFrame([("s", 1, "a", "SPECIES", 80, None), ("s", 2, "b", "SPECIES", 60, "NONE")],
                                 SC.NAME_CANDIDATES)
    assert rows(N.match_names(_names(spark, "s"), cand), "usageKey") == [(1,)]


def test_resolve_accepted(spark):
    cand = spark.createDataFrame(CAND, SC.NAME_CANDIDATES)
    usage = spark.createDataFrame([
        (1, "k1", "sp1", None, "ACCEPTED", None), (2, "k2", "sp2", None, "ACCEPTED", None),
        (4, "k4", "sp4", None, "ACCEPTED", None), (7, "k5b", "sp5", None, "ACCEPTED", None)], SC.TAXON_USAGE)
    out = N.resolve_accepted(_names(spark, "s1", "s2", "s3", "s4", "s5"), cand, usage)
    assert rows(out, "searchName", "key") == [("s4", 4)]


def test_accepted_fallback(spark):
    df = spark.createDataFrame([(7, "X", "X", None, "ACCEPTED", None, "q")],
                               "key long, scientificName string, species string, accepted string, "
                               "taxonomicStatus string, acceptedKey long, searchName string")
    r = N._accepted_fallback(df).collect()[0]
    assert (r.accepted, r.acceptedKey) == ("X", 7)


def test_labels_and_training(spark):
    ass = spark.createDataFrame([("A a", "Least Concern"), ("B b", "Endangered"), ("C c", "Data Deficient"),
                                 ("D d", None)], SC.ASSESSMENTS)
    tax = spark.createDataFrame([("A a", "L."), ("B b", "Fr."), ("C c", None), ("D d", "Pk.")], SC.TAXONOMY)
    rl = N.redlist_labels(ass, tax)
    assert rows(rl, "NameAuthor", "Threatened") == [("A a L.", 0), ("B b Fr.", 1)]
    ns = spark.createDataFrame([("A a", "L.", "G1"), ("E e", None, "G4"), ("F f", "X", "GH")], SC.NATURESERVE)
    nsl = N.natureserve_labels(ns, rl)
    assert rows(nsl, "NameAuthor", "Threatened") == [("E e NA", 0), ("F f X", 1)]
    tr = N.assessed_species(rl, nsl, excluded=["F f X"])
    assert rows(tr) == [("A a L.", "RedList", 0), ("B b Fr.", "RedList", 1), ("E e NA", "NatureServe", 0)]


def test_synonym_map(spark):
    acc = spark.createDataFrame([(1, "Aa b", "Aa b", "Aa b L.", "ACCEPTED", 1, "q1"),
                                 (2, "Cc d", "Cc d", "Cc d Fr.", "ACCEPTED", 2, "q2")],
                                "key long, scientificName string, species string, accepted string, "
                                "taxonomicStatus string, acceptedKey long, searchName string")
    syn = spark.createDataFrame([(1, "Xx y J.I.Kim", "Aa b", "Aa b L."), (1, "Dup z", "Aa b", "Aa b L."),
                                 (2, "Dup z", "Cc d", "Cc d Fr."), (2, "Bad ? name", "Cc d", "Cc d Fr."),
                                 (3, "Other", "Q", "Q")], SC.TAXON_SYNONYMS)
    out = N.synonym_map(acc.filter("key = 1"), acc, syn)
    got = rows(out, "NameAuthor", "acceptedNameAuthor", "mycoportalNameAuthor")
    # "Dup z" is listed under two keys only in the second population, so it survives from the first
    assert got == [("Aa b L.", "Aa b L.", "Aa b L."), ("Cc d Fr.", "Cc d Fr.", "Cc d Fr."),
                   ("Dup z", "Aa b L.", "Dup z"), ("Xx y J.I.Kim", "Aa b L.", "Xx y J.I. Kim")]


def test_combine_checklists(spark):
    portal = spark.createDataFrame([("Amanita muscaria", "(L.) Lam.", 1), ("Amanita var. x", None, 2),
                                    ("Tinyus minor", None, 3), ("Boletus edulis", None, 4)], SC.PORTAL_CHECKLIST)
    micro = spark.createDataFrame([("Tinyus",)], SC.MICROFUNGI)
    taxa = spark.createDataFrame([("Agaricomycotina", "Agaricomycetes", "Boletales", "Suillus"),
                                  ("Pezizomycotina", "Pezizomycetes", "Pezizales", "Peziza"),
                                  ("Pezizomycotina", "Sordariomycetes", "Hypocreales", "Hypomyces"),
                                  (None, None, "Xylariales", "Xylaria")], SC.HIGHER_TAXA)
    proto = spark.createDataFrame([("Suillus luteus", "(L.) Roussel", "x"), ("Peziza", None, "x"),
                                   ("Hypomyces lactifluorum", None, "x"), ("Xylaria polymorpha", None, None),
                                   ("Xylaria hypoxylon", None, "x"), ("Amanita muscaria", None, "x"),
                                   ("Peziza var. y", None, "x")], SC.PROTO_CHECKLIST)
    out = CL.combine_checklists(portal, micro, taxa, proto)
    got = rows(out, "ScientificName", "NameAuthor", "Source", "TaxonId")
    assert got == [("Amanita muscaria", "Amanita muscaria (L.) Lam.", "Mycoportal", 1),
                   ("Boletus edulis", "Boletus edulis", "Mycoportal", 4),
                   ("Suillus luteus", "Suillus luteus (L.) Roussel", "Protochecklist", None),
                   ("Xylaria hypoxylon", "Xylaria hypoxylon", "Protochecklist", None)]


def test_unassessed_checklist_table(spark):
    checklist = spark.createDataFrame([("s1", "Mycoportal", 11), ("s4", "Mycoportal", 44), ("s9", "Proto", None)],
                                      "NameAuthor string, Source string, TaxonId long")
    training = spark.createDataFrame([("s9", "RedList", 1)], "NameAuthor string, Source string, Threatened int")
    unassessed = N.unassessed_checklist(checklist, training)
    assert rows(unassessed, "NameAuthor") == [("s1",), ("s4",)]
    cand = spark.createDataFrame(CAND + [("s7", 9, "k9", "SPECIES", 100, "EXACT")], SC.NAME_CANDIDATES)
    usage = spark.createDataFrame([
        (4, "k4", "sp4", None, "ACCEPTED", None), (9, "k9", "sp9", "sp0 L.", "DOUBTFUL", 0)], SC.TAXON_USAGE)
    acc = N.accepted_checklist(unassessed, cand, usage)
    out = N.checklist_table(unassessed, acc)
    assert out.columns == ["NameAuthor", "Source", "TaxonId", "acceptedName", "acceptedNameAuthor", "gbifAcceptedKey"]
    # s4 resolves (accepted falls back to its own name and key); s1 is ambiguous; s7 is not in the checklist
    assert rows(out) == [("s4", "Mycoportal", 44, "sp4", "k4", 4)]


def test_standins_read_whole_tables_and_hit_every_case(spark):
    """Name matching over the whole driver tables meets each of its cases."""

    from taxaspark.catalog import standins as ST
    d = "/root/testdata/sf0.001"
    cand, names_ = ST.candidates(spark, d), ST.search_names(spark, d)
    assert cand.count() == spark.read.parquet(f"{d}/lineitem.parquet").count()
    assert names_.count() == spark.read.parquet(f"{d}/part.parquet").count()
    types = cand.groupBy("searchName").agg(F.collect_set("matchType").alias("t"), F.count(F.lit(1)).alias("n"))
    per = names_.join(types, names_["NameAuthor"] == types["searchName"], "left")
    cases = per.agg(
        F.count_if(F.col("n").isNull()).alias("no_candidate"), F.count_if(F.array_contains("t", "NONE")).alias("none"),
        F.count_if(F.array_contains("t", "HIGHERRANK")).alias("higher"), F.count_if(F.size("t") == 0).alias("missing_type"),
        F.count_if(F.array_contains("t", "EXACT")).alias("exact")).first().asDict()
    assert all(v > 0 for v in cases.values()), cases
    matched = N.match_names(names_, cand)
    per_name = matched.groupBy("searchName").agg(F.count(F.lit(1)).alias("n"), F.max("confidence").alias("c"))
    assert per_name.filter("n > 1").count() and per_name.filter("n = 1 AND c = 100").count() and per_name.filter("c IS NULL").count()
    # a default row for each name without usable candidates, and only for those
    unusable = cases["no_candidate"] + cases["none"] + cases["higher"]
    assert matched.filter("usageKey IS NULL").count() == unusable


def test_repeated_names_do_not_meet_their_candidates_in_pairs(spark, monkeypatch):
    """Names searched 300 times, with 300 candidates tied at the top: 90,000 pairs, all of which would be dropped."""
    cand = spark.createDataFrame(
        [("hot", k, f"T{k}", "R", 100, "EXACT") for k in range(300)] + [(None, k, f"T{k}", "R", 100, "EXACT") for k in range(300)]
        + [("one", 1, "T1", "R", 100, "EXACT"), ("tied", 2, "T2", "R", 100, "EXACT"), ("tied", 3, "T3", "R", 100, "EXACT")],
        "searchName string, usageKey long, scientificName string, rank string, confidence int, matchType string")
    usage = spark.createDataFrame([(k, f"T{k}", f"s{k}", f"a{k}", "ACCEPTED", k) for k in range(300)],
                                  "key long, scientificName string, species string, accepted string, taxonomicStatus string, acceptedKey long")
    batches, match = [], N.match_names
    monkeypatch.setattr(N, "match_names", lambda *a, **k: batches.append(match(*a, **k)) or batches[-1])
    names_ = _names(spark, *["hot"] * 300, *[None] * 300, "one", "tied", "lost")
    out = N.resolve_accepted(names_, cand, usage)
    assert rows(out, "key", "searchName") == [(1, "one")]
    assert batches[0].count() == 4                       # one, tied (2), lost
