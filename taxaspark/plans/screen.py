"""Screening: fit on labelled species, score all, threshold for a false-negative rate,
list the species confidently below it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.frames import split_by_null
from ..operators.model import (RESAMPLED, LogitFit, coefficient_column, design_matrix, fit_logit, importance_resample,
                               interaction_name, posterior_draws)
from ..operators.ranking import row_index
from ..operators.scoring import classify, confident_list, posterior_interval, threshold_for_fnr
from ..session import ensure_checkpoint_dir
from . import constants as K

ACC = "acceptedNameAuthor"
YEAR, LOGN, SHARE = "yearPublished", "logSpecimenCount", "propContemporary"
FEATURES = [YEAR, LOGN, interaction_name(YEAR, LOGN), SHARE]


@dataclass
class Screening:
    fit: LogitFit | None             # None when the caller gave the draws
    draws: DataFrame
    labelled: DataFrame
    predictions: DataFrame
    threshold: DataFrame
    confident: DataFrame


def _terms():
    return {coefficient_column(YEAR): F.col(YEAR).cast("double"),
            coefficient_column(LOGN): F.col(LOGN).cast("double"),
            coefficient_column(interaction_name(YEAR, LOGN)): F.col(YEAR).cast("double") * F.col(LOGN).cast("double"),
            coefficient_column(SHARE): F.col(SHARE).cast("double")}


def score_rows(rows: DataFrame, draws: DataFrame, width: float = K.INTERVAL_WIDTH,
               cutoff: float = K.CLASS_CUTOFF) -> DataFrame:
    """Median and interval of the expected probability per row, and the class at ``cutoff``.

    Each input row is its own group (as ``add_epred_draws`` numbers rows),
    so identical rows stay separate.
    """
    mi = posterior_interval(rows, draws, _terms(), width=width)
    return classify(mi, "epred", cutoff)


def screen_species(predictors: DataFrame, n_draws: int = 4000, seed: int = 1, fnr: float = K.DESIRED_FNR,
                   prior_sd=None, intercept_prior_t: tuple[float, float, float] | None = K.PACKAGE_INTERCEPT_PRIOR_T,
                   importance: bool = False, draws: DataFrame | None = None) -> Screening:
    """Split, fit, draw, score both halves, threshold on the labelled, list the confident unlabelled.

    The reference passes no prior, so its modelling package puts its own on the intercept of the centred
    predictors: a Student-t with 3 degrees of freedom and scale 2.5 (package behaviour; its location
    there follows the data, here it is 0). ``intercept_prior_t=K.INTERCEPT_PRIOR_T`` applies the one that the
    reference builds but does not pass, ``None`` none. ``importance=True`` corrects the normal approximation
    by importance resampling (one more distributed job over the labelled rows). ``draws`` (``draw_id`` and a column for
    each coefficient) skips fit and sampling.
    """
    # species-level tables are read by every Newton step and both scoring branches:
    # materialise them once in the shared checkpoint folder (lineage cut, survives lost executors)
    ensure_checkpoint_dir(predictors.sparkSession)
    predictors = predictors.checkpoint(eager=True)
    labelled, unlabelled = split_by_null(predictors, "Threatened")
    fit = None
    if draws is None:
        prior_t = {"intercept": intercept_prior_t} if intercept_prior_t else None
        design = design_matrix(labelled, YEAR, LOGN, [SHARE], keep=["Threatened"])
        fit = fit_logit(design, "Threatened", FEATURES, prior_sd=prior_sd, prior_t=prior_t)
        if importance:
            draws, fit.ess = importance_resample(predictors.sparkSession, design, "Threatened", FEATURES, fit,
                                                 n_draws, seed, prior_sd, prior_t)
            fit.method = RESAMPLED
        else:
            draws = posterior_draws(predictors.sparkSession, fit, n_draws, seed)
    lab = score_rows(labelled, draws).checkpoint(eager=True)
    pred = score_rows(unlabelled, draws)
    thr = threshold_for_fnr(lab, "Threatened", "epred", fnr)
    lc = confident_list(pred, thr, "upper",
                        columns=[ACC, "specimenCount", SHARE, YEAR, "epred", "lower", "upper"],
                        renames={"epred": "medianPrediction", "lower": "lower95ConfInt", "upper": "upper95ConfInt"},
                        order_by=["medianPrediction"], digits=K.OUTPUT_DIGITS)
    return Screening(fit, draws, lab, pred, thr, lc)


def plot_table(scored_labelled: DataFrame) -> DataFrame:
    """Plot-ready rows: actual label as text, sorted by the median, numbered from 1."""
    t = scored_labelled.withColumn(
        "Predicted", F.when(F.col("Threatened") == 0, F.lit("Not threatened")).when(F.col("Threatened") != 0, F.lit("Threatened")))
    # a name may have several labels: every further column follows, so that the order is total
    return row_index(t, ["epred", ACC, *[c for c in t.columns if c not in ("epred", ACC)]], "index")


def summary_lines(result: Screening, fnr: float = K.DESIRED_FNR) -> DataFrame:
    """The two result sentences, as a two-row DataFrame (one aggregate over the confident list)."""
    thr = result.threshold.select(F.format_string(K.THRESHOLD_SENTENCE, F.lit(str(fnr)), F.col("threshold").cast("string"))
                                  .alias("line"))
    cnt = result.confident.agg(F.format_string(K.COUNT_SENTENCE, F.count(F.lit(1))).alias("line"))
    return thr.unionByName(cnt)
