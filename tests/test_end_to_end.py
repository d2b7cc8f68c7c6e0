"""The README's end-to-end sequence on small, consistent fixture frames."""

import tempfile

import pytest

from taxaspark.plans import pipeline, predictors, screen
from taxaspark.plans.pipeline import Inputs, run_pipeline
from taxaspark.sources import schemas as SC

OCC = ("id long, taxonID long, scientificName string, scientificNameAuthorship string, genus string, "
       "specificEpithet string, country string, countryCode string, stateProvince string, county string, "
       "locality string, year int, decimalLatitude double, decimalLongitude double, coordinateUncertaintyInMeters double")


def test_readme_sequence(spark, monkeypatch):
    s = spark
    portal_cl = s.createDataFrame([("Aa b", "L.", 10), ("Cc d", "Fr.", 11)], SC.PORTAL_CHECKLIST)
    micro = s.createDataFrame([("Zz",)], SC.MICROFUNGI)
    higher = s.createDataFrame([("Agaricomycotina", "X", "Y", "Ee")], SC.HIGHER_TAXA)
    proto = s.createDataFrame([("Ee f", "Pk.", "placed")], SC.PROTO_CHECKLIST)
    assessments = s.createDataFrame([("Aa b", "Least Concern"), ("Hh i", "Endangered")], SC.ASSESSMENTS)
    taxonomy = s.createDataFrame([("Aa b", "L."), ("Hh i", "Sm.")], SC.TAXONOMY)
    natureserve = s.createDataFrame([("Gg h", "Q.", "G1")], SC.NATURESERVE)
    candidates = s.createDataFrame([
        ("Aa b L.", 1, "Aa b L.", "SPECIES", 100, "EXACT"), ("Hh i Sm.", 5, "Hh i Sm.", "SPECIES", 100, "EXACT"),
        ("Gg h Q.", 3, "Gg h Q.", "SPECIES", 100, "EXACT"), ("Cc d Fr.", 2, "Cc d Fr.", "SPECIES", 100, "EXACT"),
        ("Ee f Pk.", 4, "Ee f Pk.", "SPECIES", 100, "EXACT")], SC.NAME_CANDIDATES)
    usage = s.createDataFrame([
        (1, "Aa b L.", "Aa b", None, "ACCEPTED", None), (2, "Cc d Fr.", "Cc d", None, "ACCEPTED", None),
        (3, "Gg h Q.", "Gg h", None, "ACCEPTED", None), (4, "Ee f Pk.", "Ee f", None, "ACCEPTED", None),
        (5, "Hh i Sm.", "Hh i", None, "ACCEPTED", None)], SC.TAXON_USAGE)
    synonyms = s.createDataFrame([(1, "Aa bb Syn.", "Aa b", "Aa b L.")], SC.TAXON_SYNONYMS)
    portal_ca = s.createDataFrame([(1, 11, "Cc d", "Fr.", "Cc", "d", "Canada", None, "ON", None, "Bog", 2001,
                                    45.0, -75.0, 10.0)], OCC)
    portal_us = s.createDataFrame([
        (2, None, "Aa b", "L.", "Aa", "b", "USA", None, "ME", None, "Fen", 1990, None, None, None),
        (3, None, "Aa b", "L.", "Aa", "b", "USA", None, "ME", None, "Fen", 1999, 44.0, -69.0, 100.0),
        (4, None, "Aa bb", "Syn.", "Aa", "bb", "USA", None, "ME", None, None, 2010, 43.0, -70.0, 5.0),
        (3758416, None, "Aa b", "L.", "Aa", "b", "USA", None, "ME", None, "X", 2000, 999.0, 999.0, 1.0)], OCC)
    agg = s.createDataFrame([
        (900, 1, "Aa b L.", "Aa b", "FR", "PRESENT", None, None, "Paris", "2005", 48.0, 2.3, 50.0),
        (901, 3, "Gg h Q.", "Gg h", "DE", "PRESENT", None, None, "B", "2005", 52.0, 13.0, 50.0)],
        SC.AGGREGATOR_OCCURRENCES)
    centroids = s.createDataFrame([("FR", 46.0, 2.0)], SC.COUNTRY_CENTROIDS)
    backbone = s.createDataFrame([("Aa b L.", "L.", "Aa b L.", 1, 1, 1, 1800),
                                  ("Cc d Fr.", "Fr.", "Cc d Fr.", 2, 2, 2, 1821)], SC.BACKBONE)
    shared = tempfile.mkdtemp(prefix="taxaspark-e2e-")
    inputs = Inputs(portal_cl, micro, higher, proto, assessments, taxonomy, natureserve, candidates, usage, synonyms,
                    [portal_ca, portal_us], [agg], centroids, backbone)
    result, stage = run_pipeline(s, inputs, shared, n_draws=200, prior_sd=2.5)
    # every stage reads what the one before wrote: no plan grows with the number of stages
    assert max(stage.nodes.values()) <= 300, stage.nodes
    read = lambda name: s.read.parquet(f"{shared}/{name}")
    cl, threat, syn, filled, pred = (read(n) for n in ("checklist", "threat", "synonyms", "cleaned", "predictors"))

    assert sorted(r.NameAuthor for r in cl.collect()) == ["Aa b L.", "Cc d Fr.", "Ee f Pk."]
    assert sorted((r.NameAuthor, r.Threatened) for r in threat.collect()) == [
        ("Aa b L.", 0), ("Gg h Q.", 1), ("Hh i Sm.", 1)]
    assert "Aa bb Syn." in {r.NameAuthor for r in syn.collect()}
    got = {r.uniqueCombinedID: r for r in filled.collect()}
    # the rogue record is gone; the aggregator record of a species without portal records (Gg h) is dropped
    # by the species gate; record 2 took the coordinates of record 3 (same place)
    assert set(got) == {"1m", "2m", "3m", "4m", "900g"}
    assert (got["2m"].decimalLatitude, got["2m"].coordsAdded) == (44.0, True)
    assert got["900g"].clean_tests is True                     # 48.0/2.3 lies far outside the radius around 46/2
    p = {r.acceptedNameAuthor: r for r in pred.collect()}
    assert p["Aa b L."].yearPublished == 1800 and p["Aa b L."].Threatened == 0
    assert p["Cc d Fr."].Threatened is None
    first = list(stage.ran)
    assert first[0] == "checklist" and first[-1] == "predictors" and len(first) == 15

    # the same inputs again (new frames): nothing is written
    anew = lambda f: [anew(x) for x in f] if isinstance(f, list) else f and s.createDataFrame(f.collect(), f.schema)
    again = Inputs(*[anew(getattr(inputs, x)) for x in Inputs.__dataclass_fields__])
    assert pipeline.run_predictors(s, again, shared, manual=predictors.manual_years(s))[1].ran == []
    # a changed constant: that stage and what follows from it
    assert pipeline.run_predictors(s, inputs, shared, manual=predictors.manual_years(s), radius_m=2000.0)[1].ran == ["flagged", "cleaned", "predictors"]
    assert pipeline.run_predictors(s, inputs, shared, manual=predictors.manual_years(s), rogue_ids=[])[1].ran == ["flagged", "cleaned", "predictors"]
    # a changed input
    inputs.aggregator_files = [agg.where("gbifID <> 901")]
    assert pipeline.run_predictors(s, inputs, shared, manual=predictors.manual_years(s))[1].ran == ["aggregator", "flagged", "cleaned", "predictors"]
    # a run that breaks while a stage is written goes on there, and rows without a print do not count
    inputs.aggregator_files = [agg]
    real = pipeline.write_stage

    def breaks(df, path):
        real(df, path)
        if path.endswith("/flagged"):
            raise RuntimeError("lost")

    monkeypatch.setattr(pipeline, "write_stage", breaks)
    with pytest.raises(RuntimeError):
        pipeline.run_predictors(s, inputs, shared, manual=predictors.manual_years(s))
    monkeypatch.setattr(pipeline, "write_stage", real)
    assert pipeline.run_predictors(s, inputs, shared, manual=predictors.manual_years(s))[1].ran == ["flagged", "cleaned", "predictors"]
    assert pipeline.run_predictors(s, inputs, shared, manual=predictors.manual_years(s), resume=False)[1].ran == first
    lines = [r[0] for r in screen.summary_lines(result).collect()]
    assert len(lines) == 2 and result.fit.n == sum(1 for r in p.values() if r.Threatened is not None)
