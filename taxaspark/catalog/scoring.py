"""Registered queries for the model and scoring operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from ..operators import model as M
from ..operators import frames as FR
from ..operators import scoring as S
from ..plans.constants import PACKAGE_INTERCEPT_PRIOR_T
from .registry import register
from .standins import (DRAWS, DRAWS_SQL, EPRED_SQL, PARTS_X_SQL, SCORED_EVENTS_SQL, c, draws, part_terms,
                       scored_events, scored_parts, sql_round, table)


@register("design_matrix", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_quantity * l_discount AS l_quantity_x_l_discount, l_tax
FROM lineitem""")
def design_matrix(spark, d):
    """Columns of y ~ quantity * discount + tax."""
    return M.design_matrix(table(spark, d, "lineitem"), "l_quantity", "l_discount", ["l_tax"],
                           keep=["l_orderkey", "l_linenumber"])


def _epred(spark, d):
    return S.posterior_expected(scored_parts(spark, d), draws(spark), part_terms(), n_draws=len(DRAWS))


EP_SQL = f"""WITH {PARTS_X_SQL},
{DRAWS_SQL},
ep AS (SELECT px.p_partkey, draws.draw_id, {EPRED_SQL} AS epred FROM px CROSS JOIN draws)"""

MI_SQL = f"""{EP_SQL},
mi AS (SELECT p_partkey, quantile_cont(epred, 0.5) AS epred, quantile_cont(epred, 0.025) AS lower,
              quantile_cont(epred, 0.975) AS upper FROM ep GROUP BY p_partkey)"""


@register("posterior_expected", f"""{EP_SQL}
SELECT p_partkey, draw_id, {sql_round('epred', 6)} AS epred FROM ep""")
def posterior_expected(spark, d):
    """Expected probability for every (part, draw): rows x broadcast draws, inverse logit."""
    ep = _epred(spark, d)
    return ep.select("p_partkey", "draw_id", round_half_up("epred", 6).alias("epred"))


@register("median_interval", f"""{MI_SQL}
SELECT p_partkey, {sql_round('epred', 6)} AS epred, {sql_round('lower', 6)} AS lower, {sql_round('upper', 6)} AS upper
FROM mi""")
def median_interval(spark, d):
    """Median and 95% interval of the draws per part (exact percentiles)."""
    mi = S.median_interval(_epred(spark, d), ["p_partkey"], "epred")
    return mi.select("p_partkey", *[round_half_up(x, 6).alias(x) for x in ("epred", "lower", "upper")])


@register("hot_group_quantiles", f"""
SELECT g, {sql_round('quantile_cont(v, 0.5)', 6)} AS median, {sql_round('quantile_cont(v, 0.025)', 6)} AS lower,
       {sql_round('quantile_cont(v, 0.975)', 6)} AS upper
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS g, l_extendedprice AS v FROM lineitem) GROUP BY g""")
def hot_group_quantiles(spark, d):
    """Exact quantiles by rank where one group has a third of all rows."""
    rows = table(spark, d, "lineitem").select(
        F.when(c("l_orderkey") % 3 == 0, F.lit(0).cast("bigint")).otherwise(c("l_suppkey")).alias("g"), c("l_extendedprice").alias("v"))
    mi = S.median_interval(rows, ["g"], "v", median="median")
    return mi.select("g", *[round_half_up(x, 6).alias(x) for x in ("median", "lower", "upper")])


@register("posterior_interval", f"""{MI_SQL}
SELECT p_partkey, {sql_round('epred', 6)} AS epred, {sql_round('lower', 6)} AS lower, {sql_round('upper', 6)} AS upper
FROM mi""")
def posterior_interval(spark, d):
    """The same by blocks of linear predictors, of which the neighbours of the quantiles are selected; inverse logit of these only."""
    mi = S.posterior_interval(scored_parts(spark, d), draws(spark), part_terms())
    return mi.select("p_partkey", *[round_half_up(x, 6).alias(x) for x in ("epred", "lower", "upper")])


@register("classify", f"""{MI_SQL}
SELECT p_partkey, {sql_round('epred', 6)} AS epred,
       CASE WHEN epred < 0.5 THEN 0 WHEN epred >= 0.5 THEN 1 END AS pred_class FROM mi""")
def classify(spark, d):
    """Class 1 at or above 0.5 of the median, else 0."""
    mi = S.classify(S.median_interval(_epred(spark, d), ["p_partkey"], "epred"), "epred", 0.5)
    return mi.select("p_partkey", round_half_up("epred", 6).alias("epred"), "pred_class")


CURVE_SQL = f"""{SCORED_EVENTS_SQL},
per AS (SELECT score, CAST(sum(CASE WHEN observed = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives FROM sev
        WHERE score IS NOT NULL GROUP BY score),
tot AS (SELECT CAST(sum(CASE WHEN observed = 1 THEN 1 ELSE 0 END) AS BIGINT) AS P FROM sev WHERE score IS NOT NULL),
run AS (SELECT score, positives, CAST(sum(positives) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp
        FROM per),
curve AS (SELECT run.score AS threshold, positives, tp, tot.P - tp AS fn,
                 1 - CAST(tp AS DOUBLE) / CAST(tp + (tot.P - tp) AS DOUBLE) AS fnr
          FROM run CROSS JOIN tot)"""


@register("fnr_curve", f"""WITH {CURVE_SQL}
SELECT threshold, positives, tp, fn, fnr FROM curve""")
def fnr_curve(spark, d):
    """False-negative rate for every distinct score as threshold (running sum over quantile buckets)."""
    return S.fnr_curve(scored_events(spark, d), "observed", "score")


THRESH_SQL = f"""{CURVE_SQL},
thr AS (SELECT max(CASE WHEN fnr <= 0.05 THEN threshold END) AS threshold FROM curve)"""


@register("threshold_for_fnr", f"""WITH {THRESH_SQL}
SELECT threshold FROM thr""")
def threshold_for_fnr(spark, d):
    """Largest score whose false-negative rate is at most 0.05."""
    return S.threshold_for_fnr(scored_events(spark, d), "observed", "score", 0.05)


LABELLED_SQL = CURVE_SQL.replace(SCORED_EVENTS_SQL, SCORED_EVENTS_SQL.replace("sev AS (", "every AS (") + """,
sev AS (SELECT * FROM every WHERE event_type IN ('purchase', 'view'))""") + """,
thr AS (SELECT max(CASE WHEN fnr <= 0.05 THEN threshold END) AS threshold FROM curve)"""


@register("threshold_edge_groups", f"""WITH {THRESH_SQL}
SELECT 'all' AS grp, threshold FROM thr
UNION ALL SELECT 'no positive', NULL FROM (SELECT count(*) FROM sev) n
UNION ALL SELECT 'no score', NULL FROM (SELECT count(*) FROM sev) n""")
def threshold_edge_groups(spark, d):
    """The threshold of all rows, of rows without a positive and of rows without a score (NULL for both)."""
    ev = scored_events(spark, d)
    groups = {"all": ev, "no positive": ev.withColumn("observed", F.lit(0)),
              "no score": ev.withColumn("score", F.lit(None).cast("double"))}
    parts = [S.threshold_for_fnr(g, "observed", "score", 0.05).select(F.lit(n).alias("grp"), "threshold") for n, g in groups.items()]
    return FR.union_strict(*parts)


@register("confident_list", f"""WITH {LABELLED_SQL}
SELECT event_id, user_id, {sql_round('score', 3)} AS medianPrediction,
       {sql_round('score * 0.75', 3)} AS lower95ConfInt, {sql_round('score * 1.25', 3)} AS upper95ConfInt
FROM every CROSS JOIN thr
WHERE coalesce(event_type NOT IN ('purchase', 'view'), true) AND score * 1.25 < thr.threshold""")
def confident_list(spark, d):
    """Unlabelled rows whose upper bound is below the threshold learnt on the labelled rows (purchase 1, view 0)."""
    ev = scored_events(spark, d).withColumn("observed", F.when(c("event_type").isin("purchase", "view"), c("observed")))
    lab, rest = FR.split_by_null(ev, "observed")
    thr = S.threshold_for_fnr(lab, "observed", "score", 0.05)
    unl = rest.select(
        "event_id", "user_id", c("score").alias("median"), (c("score") * 0.75).alias("lower"),
        (c("score") * 1.25).alias("upper"))
    return S.confident_list(unl, thr, "upper", columns=["event_id", "user_id", "median", "lower", "upper"],
                            renames={"median": "medianPrediction", "lower": "lower95ConfInt",
                                     "upper": "upper95ConfInt"}, order_by=["medianPrediction"], digits=3)


def _labelled_docs(spark, d):
    doc = table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    lab = table(spark, d, "labels")
    j = doc.join(lab, "doc_id")
    return j.select("doc_id", c("quality").alias("y"), F.ln(c("n_chars").cast("double") + 1).alias("log_chars"),
                    c("toxic").cast("double").alias("toxic"),
                    F.when(c("lang") == "en", F.lit(1.0)).otherwise(F.lit(0.0)).alias("english"))


def _doc_fit(spark, d):
    x = M.design_matrix(_labelled_docs(spark, d), "log_chars", "toxic", ["english"], keep=["y"])
    return M.fit_logit(x, "y", DOC_FEATURES, prior_t={"intercept": PACKAGE_INTERCEPT_PRIOR_T})


DOC_FEATURES = ["log_chars", "toxic", M.interaction_name("log_chars", "toxic"), "english"]
BETAS = [[0.0, 0.0, 0.0, 0.0, 0.0], [0.5, 0.125, -0.25, 0.0625, 0.75]]


def _newton_sql(n: int, beta: list[float]) -> str:
    x = ["CAST(1 AS DOUBLE)", "log_chars", "toxic", "log_chars * toxic", "english"]
    eta = "(" + " + ".join(f"CAST({b!r} AS DOUBLE) * {v}" for b, v in zip(beta, x)) + ")"
    p = f"(1 / (1 + exp(-{eta})))"
    sums = [f"sum((y - {p}) * {v}) AS g{j}" for j, v in enumerate(x)]
    sums += [f"sum({p} * (1 - {p}) * {x[a]} * {x[b]}) AS h{a}_{b}" for a in range(5) for b in range(a, 5)]
    sums.append(f"sum(y * {eta} - (greatest({eta}, 0) + ln(1 + exp(-abs({eta}))))) AS ll")
    names = [s.split(" AS ")[-1] for s in sums]
    rounded = ", ".join(f"{sql_round(c_, 4)} AS {c_}" for c_ in names)
    return f"SELECT {n} AS step, {rounded} FROM (SELECT {', '.join(sums)} FROM x) s{n}"


@register("newton_sums", """WITH x AS (
  SELECT CAST(quality AS DOUBLE) AS y, ln(CAST(n_chars AS DOUBLE) + 1) AS log_chars, CAST(toxic AS DOUBLE) AS toxic,
         CASE WHEN lang = 'en' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS english
  FROM documents JOIN labels USING (doc_id)
  WHERE quality IS NOT NULL AND toxic IS NOT NULL AND n_chars IS NOT NULL)
""" + " UNION ALL ".join(_newton_sql(i, b) for i, b in enumerate(BETAS)))
def newton_sums(spark, d):
    """Gradient, Hessian and log-likelihood of the logit model at two fixed coefficient vectors."""
    x = M.design_matrix(_labelled_docs(spark, d), "log_chars", "toxic", ["english"], keep=["y"])
    parts = []
    for i, beta in enumerate(BETAS):
        sums = M.newton_sums(x, "y", DOC_FEATURES, beta)
        parts.append(sums.select(F.lit(i).alias("step"), *[round_half_up(n, 4).alias(n) for n in sums.columns]))
    return FR.union_strict(*parts)


@register("fit_logit")
def fit_logit(spark, d):
    """Posterior mode and sd per coefficient of a logit model (Newton steps as Spark aggregates)."""
    fit = _doc_fit(spark, d)
    rows = [(t, float(m), float(fit.cov[i, i]) ** 0.5, fit.n, fit.iterations, fit.converged, fit.method)
            for i, (t, m) in enumerate(zip(fit.terms, fit.mode))]
    return spark.createDataFrame(
        rows, "term string, estimate double, sd double, n long, iterations int, converged boolean, method string")


@register("posterior_draws")
def posterior_draws(spark, d):
    """Draws from the normal approximation at the posterior mode (one row per draw)."""
    return M.posterior_draws(spark, _doc_fit(spark, d), 1000, seed=7)


LINE_DRAWS = ("b_price", "b_size", "b_name_len")


@register("draws_summary", """WITH d AS (
  SELECT p_partkey AS draw_id, p_retailprice / 1000 AS b_price, CAST(p_size AS DOUBLE) / 16 AS b_size,
         CAST(length(p_name) AS DOUBLE) / 8 AS b_name_len FROM part),
l AS (UNPIVOT d ON b_price, b_size, b_name_len INTO NAME term VALUE value)
SELECT term, """ + ", ".join([sql_round("avg(value)", 9) + " AS mean", sql_round("stddev_samp(value)", 9) + " AS sd",
                              *[sql_round(f"quantile_cont(value, {q})", 9) + f" AS {n}" for q, n in
                                ((0.025, "q2_5"), (0.5, "q50"), (0.975, "q97_5"))]]) + """,
       count(*) AS draws, 'laplace' AS method FROM l GROUP BY term""")
def draws_summary(spark, d):
    """Mean, sd and quantiles per coefficient over a table of draws (parts stand in, one draw each)."""
    p = table(spark, d, "part").select(
        c("p_partkey").alias("draw_id"), (c("p_retailprice") / 1000).alias("b_price"),
        (c("p_size").cast("double") / 16).alias("b_size"), (F.length("p_name").cast("double") / 8).alias("b_name_len"))
    s = M.draws_summary(p)
    return s.select("term", *[round_half_up(n, 9).alias(n) for n in ("mean", "sd", "q2_5", "q50", "q97_5")], "draws", "method")
