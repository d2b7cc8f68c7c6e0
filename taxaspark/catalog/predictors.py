"""The flagship: species predictors from flagged occurrence records, and the full screening."""

from __future__ import annotations

from ..functions.numeric import round_half_up
from ..operators import geo as G
from ..plans import constants as K
from ..plans import predictors as P
from ..plans.screen import screen_species
from .registry import register
from .standins import (BACKBONE_SQL, CENTROID_RADIUS_M, FLAGGED_OCCS_SQL, THREAT_SQL, WANTED_SQL, backbone,
                       centroids, occurrences, sql_round, threat, wanted_names)


def predictor_table(spark, d):
    occ = G.flag_all(occurrences(spark, d), "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters",
                     centroids(spark, d), radius_m=CENTROID_RADIUS_M)
    years = P.year_published(backbone(spark, d), wanted_names(spark, d), P.manual_years(spark))
    return P.species_predictors(occ, years, threat(spark, d), ["uid"])


PREDICTORS_SQL = f"""{FLAGGED_OCCS_SQL},
{BACKBONE_SQL},
{THREAT_SQL},
{WANTED_SQL},
gated AS (SELECT * FROM flagged
          WHERE georeferenced = false OR ((cc_equ AND cc_zero AND clean_tests AND cc_err) OR cc_err IS NULL)),
cnt AS (
  SELECT acceptedNameAuthor, count(*) AS specimenCount FROM (
    SELECT acceptedNameAuthor FROM (SELECT DISTINCT acceptedNameAuthor, locality FROM gated
                                    WHERE locality IS NOT NULL AND georeferenced = false) a
    UNION ALL
    SELECT acceptedNameAuthor FROM (SELECT DISTINCT acceptedNameAuthor, {sql_round('decimalLatitude', 3)} AS rl,
                                           {sql_round('decimalLongitude', 3)} AS rn
                                    FROM gated WHERE georeferenced = true) b
    UNION ALL
    SELECT acceptedNameAuthor FROM gated WHERE locality IS NULL AND georeferenced = false) u
  GROUP BY acceptedNameAuthor),
d1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acceptedNameAuthor, locality, year ORDER BY uid) AS rn1
                      FROM gated) t WHERE rn1 = 1),
d2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY acceptedNameAuthor, decimalLatitude, decimalLongitude, year
                                                   ORDER BY uid) AS rn2 FROM d1) t WHERE rn2 = 1),
share AS (SELECT acceptedNameAuthor,
                 coalesce(avg(CASE WHEN year > 1992 THEN CAST(1 AS DOUBLE) WHEN year IS NOT NULL THEN CAST(0 AS DOUBLE) END),
                          CAST(0 AS DOUBLE)) AS propContemporary
          FROM d2 GROUP BY acceptedNameAuthor),
spec AS (SELECT cnt.acceptedNameAuthor, cnt.specimenCount, share.propContemporary,
                ln(CAST(cnt.specimenCount AS DOUBLE)) AS logSpecimenCount
         FROM cnt LEFT JOIN share ON cnt.acceptedNameAuthor IS NOT DISTINCT FROM share.acceptedNameAuthor),
bbc AS (SELECT NAME_OF_FUNGUS, AUTHORS, RECORD_NUMBER, BASIONYM_RECORD_NUMBER, CURRENT_NAME_RECORD_NUMBER,
               YEAR_OF_PUBLICATION,
               CASE WHEN NAME_OF_FUNGUS = 'Amylocystis lapponicus' THEN 'Amylocystis lapponica'
                    WHEN NAME_OF_FUNGUS = 'Agaricus pattersonae' THEN 'Agaricus pattersoniae'
                    ELSE CURRENT_NAME END AS CURRENT_NAME
        FROM bb WHERE AUTHORS IS NOT NULL AND AUTHORS <> ''),
bas AS (SELECT * FROM (SELECT *, min(YEAR_OF_PUBLICATION) OVER (PARTITION BY CURRENT_NAME) AS m
                       FROM bbc WHERE RECORD_NUMBER = BASIONYM_RECORD_NUMBER) t WHERE YEAR_OF_PUBLICATION = m),
bas2 AS (SELECT * FROM (SELECT *, min(YEAR_OF_PUBLICATION) OVER (PARTITION BY NAME_OF_FUNGUS) AS m
                        FROM bbc WHERE RECORD_NUMBER = BASIONYM_RECORD_NUMBER) t WHERE YEAR_OF_PUBLICATION = m),
y1 AS (SELECT DISTINCT b.CURRENT_NAME AS acceptedNameAuthor, CAST(s.YEAR_OF_PUBLICATION AS INTEGER) AS yearPublished
       FROM bbc b LEFT JOIN bas s ON b.CURRENT_NAME IS NOT DISTINCT FROM s.CURRENT_NAME
       WHERE (b.RECORD_NUMBER = b.CURRENT_NAME_RECORD_NUMBER OR b.NAME_OF_FUNGUS = b.CURRENT_NAME)
         AND EXISTS (SELECT 1 FROM wanted w WHERE w.acceptedNameAuthor IS NOT DISTINCT FROM b.CURRENT_NAME)),
missed AS (SELECT DISTINCT acceptedNameAuthor FROM wanted w
           WHERE NOT EXISTS (SELECT 1 FROM y1 WHERE y1.acceptedNameAuthor IS NOT DISTINCT FROM w.acceptedNameAuthor)),
y2 AS (SELECT DISTINCT b.NAME_OF_FUNGUS AS acceptedNameAuthor, CAST(s.YEAR_OF_PUBLICATION AS INTEGER) AS yearPublished
       FROM bbc b LEFT JOIN bas2 s ON b.NAME_OF_FUNGUS IS NOT DISTINCT FROM s.NAME_OF_FUNGUS
       WHERE EXISTS (SELECT 1 FROM missed m WHERE m.acceptedNameAuthor IS NOT DISTINCT FROM b.NAME_OF_FUNGUS)),
manual AS (SELECT * FROM (VALUES ('Sarcodon joeides', 1872), ('Gomphidius smithii', 1949),
                                 ('Elaphomyces decipiens', 1831)) v(acceptedNameAuthor, yearPublished)),
yall AS (SELECT * FROM (SELECT * FROM y1 UNION ALL SELECT * FROM y2 UNION ALL SELECT * FROM manual) u
         WHERE acceptedNameAuthor IS NOT NULL AND yearPublished IS NOT NULL),
pred AS (SELECT spec.*, yall.yearPublished FROM spec LEFT JOIN yall
           ON spec.acceptedNameAuthor IS NOT DISTINCT FROM yall.acceptedNameAuthor
         WHERE spec.acceptedNameAuthor IS NOT NULL AND spec.specimenCount IS NOT NULL
           AND spec.propContemporary IS NOT NULL AND spec.logSpecimenCount IS NOT NULL
           AND yall.yearPublished IS NOT NULL),
final AS (SELECT pred.*, threat.Threatened FROM pred LEFT JOIN threat
            ON pred.acceptedNameAuthor IS NOT DISTINCT FROM threat.acceptedNameAuthor)"""


@register("species_predictors", f"""WITH {PREDICTORS_SQL}
SELECT acceptedNameAuthor, specimenCount, propContemporary, {sql_round('logSpecimenCount', 6)} AS logSpecimenCount,
       yearPublished, Threatened
FROM final""")
def species_predictors(spark, d):
    """Flag, gate, count (grid / locality dedup), share after 1992, log count, basionym year, label."""
    p = predictor_table(spark, d)
    return p.withColumn("logSpecimenCount", round_half_up("logSpecimenCount", 6))


#: draws of the screening's coefficients, in exact binary fractions
SCREEN_DRAWS = [(i, -2.0 + (i * 7 % 11) / 16, 0.0009765625 + (i * 5 % 7) / 8192, -0.5 + (i * 3 % 13) / 32,
                 (i * 11 % 5) / 16384, -0.25 + (i * 2 % 9) / 16) for i in range(1, 41)]
SCREEN_COLS = ["draw_id", "b_intercept", "b_yearPublished", "b_logSpecimenCount", "b_yearPublished_x_logSpecimenCount",
               "b_propContemporary"]


def screen_draws(spark):
    return spark.createDataFrame(SCREEN_DRAWS, ", ".join([f"{SCREEN_COLS[0]} int", *[f"{x} double" for x in SCREEN_COLS[1:]]]))


SCREEN_SQL = f"""{PREDICTORS_SQL},
dr AS (SELECT * FROM (VALUES {", ".join("(" + ", ".join([str(r[0]), *[f"CAST({v!r} AS DOUBLE)" for v in r[1:]]]) + ")" for r in SCREEN_DRAWS)})
       v({", ".join(SCREEN_COLS)})),
rows_ AS (SELECT row_number() OVER (ORDER BY acceptedNameAuthor, Threatened) AS rid, CAST(yearPublished AS DOUBLE) AS yp,
                 f.* FROM final f),
ep AS (SELECT rid, 1 / (1 + exp(-((((b_intercept + b_yearPublished * yp) + b_logSpecimenCount * logSpecimenCount)
              + b_yearPublished_x_logSpecimenCount * (yp * logSpecimenCount)) + b_propContemporary * propContemporary))) AS e
       FROM rows_ CROSS JOIN dr),
mi AS (SELECT rid, quantile_cont(e, 0.5) AS epred, quantile_cont(e, 0.025) AS lower, quantile_cont(e, 0.975) AS upper
       FROM ep GROUP BY rid),
scored AS (SELECT r.*, mi.epred, mi.lower, mi.upper, CASE WHEN mi.epred < 0.5 THEN 0 WHEN mi.epred >= 0.5 THEN 1 END AS pred_class
           FROM rows_ r JOIN mi USING (rid)),
lab AS (SELECT * FROM scored WHERE Threatened IS NOT NULL),
per AS (SELECT epred, sum(CASE WHEN Threatened = 1 THEN 1 ELSE 0 END) AS pos FROM lab GROUP BY epred),
run AS (SELECT epred, sum(pos) OVER (ORDER BY epred DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(pos) OVER () AS p FROM per),
thr AS (SELECT max(CASE WHEN 1 - CAST(tp AS DOUBLE) / NULLIF(CAST(p AS DOUBLE), 0) <= 0.05 THEN epred END) AS t FROM run)"""


def _screening(spark, d):
    return screen_species(predictor_table(spark, d), draws=screen_draws(spark))


def _screened(res):
    """Every species with its interval, class and whether it is a confident negative."""
    from pyspark.sql import functions as F
    thr = res.threshold.select(F.col("threshold").alias("__t__"))
    both = (res.labelled.withColumn("labelled", F.lit(True))
            .unionByName(res.predictions.withColumn("labelled", F.lit(False))))
    out = both.crossJoin(F.broadcast(thr))
    return out.select(
        "acceptedNameAuthor", "Threatened", "labelled",
        round_half_up("epred", 3).alias("medianPrediction"), round_half_up("lower", 3).alias("lower95ConfInt"),
        round_half_up("upper", 3).alias("upper95ConfInt"), "pred_class",
        (~F.col("labelled") & (F.col("upper") < F.col("__t__"))).alias("confident"))


@register("screen_species", f"""WITH {SCREEN_SQL}
SELECT acceptedNameAuthor, Threatened, Threatened IS NOT NULL AS labelled, {sql_round('epred', 3)} AS medianPrediction,
       {sql_round('lower', 3)} AS lower95ConfInt, {sql_round('upper', 3)} AS upper95ConfInt, pred_class,
       Threatened IS NULL AND upper < thr.t AS confident
FROM scored CROSS JOIN thr""")
def screen_species_q(spark, d):
    """Intervals over given draws and the threshold for FNR 0.05; every species with its interval and
    whether it is a confident negative (unlabelled, upper bound below the threshold)."""
    return _screened(_screening(spark, d))


def screen_species_fitted(spark, d):
    """The whole screening: split, fit on the labelled species, 2,000 draws, intervals and threshold; rows as ``screen_species``,
    with how the model was fitted."""
    from pyspark.sql import functions as F
    res = screen_species(predictor_table(spark, d), n_draws=2000, seed=1)
    return _screened(res).withColumns({"n_fitted": F.lit(res.fit.n).cast("long"), "converged": F.lit(bool(res.fit.converged)),
                                       "method": F.lit(res.fit.method)})


#: queries that fit a model and have no DuckDB twin: registered by name, but not in REGISTRY, whose queries are held to their twins
FITTED = {"screen_species_fitted": screen_species_fitted}


def _gated_occurrences(spark, d):
    from ..operators.geo import quality_gate
    occ = G.flag_all(occurrences(spark, d), "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters",
                     centroids(spark, d), radius_m=CENTROID_RADIUS_M)
    return quality_gate(occ)


@register("specimen_count", f"""WITH {PREDICTORS_SQL}
SELECT acceptedNameAuthor, specimenCount FROM cnt""")
def specimen_count(spark, d):
    """Records per species after the grid / locality dedups (one scan, two map-side-combined aggregates)."""
    return P.specimen_count(_gated_occurrences(spark, d))


@register("contemporary_share", f"""WITH {PREDICTORS_SQL}
SELECT acceptedNameAuthor, propContemporary FROM share""")
def contemporary_share(spark, d):
    """Share of records after 1992 per species, after the two first-wins dedups."""
    return P.contemporary_share(_gated_occurrences(spark, d), ["uid"])


@register("year_published", f"""WITH {PREDICTORS_SQL}
SELECT acceptedNameAuthor, yearPublished FROM yall""")
def year_published(spark, d):
    """Basionym year per wanted name: by current name, then by name, then manual rows."""
    return P.year_published(backbone(spark, d), wanted_names(spark, d), P.manual_years(spark))


@register("plot_table", f"""WITH {SCREEN_SQL}
SELECT row_number() OVER (ORDER BY epred, acceptedNameAuthor) AS index, acceptedNameAuthor,
       CASE WHEN Threatened = 0 THEN 'Not threatened' ELSE 'Threatened' END AS Predicted, {sql_round('epred', 6)} AS epred,
       {sql_round('lower', 6)} AS lower, {sql_round('upper', 6)} AS upper
FROM lab""")
def plot_table(spark, d):
    """Labelled species with actual label text, sorted by the median prediction and numbered."""
    from ..plans.screen import plot_table as plot
    return plot(_screening(spark, d).labelled).select(
        "index", "acceptedNameAuthor", "Predicted", *[round_half_up(x, 6).alias(x) for x in ("epred", "lower", "upper")])


@register("summary_lines", f"""WITH {SCREEN_SQL}
SELECT printf('{K.THRESHOLD_SENTENCE}', '0.05', CAST(CAST(t AS DECIMAL(18, 6)) AS VARCHAR)) AS line FROM thr
UNION ALL
SELECT printf('{K.COUNT_SENTENCE}', (SELECT count(*) FROM scored CROSS JOIN thr WHERE Threatened IS NULL AND upper < thr.t))""")
def summary_lines_q(spark, d):
    """The two result sentences (threshold to six decimals, number of confident negatives)."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from ..plans.screen import summary_lines
    res = _screening(spark, d)
    return summary_lines(replace(res, threshold=res.threshold.select(F.col("threshold").cast("decimal(18,6)").alias("threshold"))))
