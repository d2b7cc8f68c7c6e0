"""Logistic model: design matrix, posterior mode by Newton steps, Gaussian draws.

Each Newton step is one Spark aggregate of the gradient (k sums), the
Hessian (k(k+1)/2 sums) and the log-likelihood; only those numbers reach the
driver, where the k x k system is solved. The posterior is approximated by
a normal distribution at the mode with the inverse negative Hessian as
covariance (a Laplace approximation), not by the reference's sampler.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

METHOD = "laplace"
RESAMPLED = "laplace, importance-resampled"


def newton_sums(df: DataFrame, label: str, features: Sequence[str], beta: Sequence[float]) -> DataFrame:
    """One row: log-likelihood ``ll``, gradient ``g<j>`` and Hessian ``h<i>_<j>`` of a Bernoulli-logit model at
    ``beta`` (intercept first): the distributed part of a Newton step. Rows with NULLs are left out."""
    data = df.select(F.col(label).cast("double").alias("__y__"),
                     *[F.col(f).cast("double").alias(f"__x{j}__") for j, f in enumerate(features, 1)]).na.drop()
    return data.agg(*_newton_aggregates([F.lit(1.0), *[F.col(f"__x{j}__") for j in range(1, len(features) + 1)]], beta))


def _newton_aggregates(x: Sequence[Column], beta: Sequence[float]) -> list[Column]:
    k = len(x)
    eta = F.lit(float(beta[0]))
    for j in range(1, k):
        eta = eta + x[j] * F.lit(float(beta[j]))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
    w, r = p * (F.lit(1.0) - p), F.col("__y__") - p
    return ([F.sum(r * x[j]).alias(f"g{j}") for j in range(k)]
            + [F.sum(w * x[a] * x[b]).alias(f"h{a}_{b}") for a in range(k) for b in range(a, k)]
            + [F.sum(F.col("__y__") * eta - _log1pexp(eta)).alias("ll")])


def interaction_name(a: str, b: str) -> str:
    return f"{a}_x_{b}"


def design_matrix(df: DataFrame, a: str, b: str, others: Sequence[str] = (),
                  keep: Sequence[str] = ()) -> DataFrame:
    """Columns of the formula ``y ~ a * b + others``: a, b, a:b, others."""
    return df.select(*keep, F.col(a).cast("double").alias(a), F.col(b).cast("double").alias(b),
                     (F.col(a).cast("double") * F.col(b).cast("double")).alias(interaction_name(a, b)),
                     *[F.col(o).cast("double").alias(o) for o in others])


@dataclass
class LogitFit:
    terms: list[str]                 # "intercept" first, then the features
    mode: np.ndarray                 # posterior mode, original scale
    cov: np.ndarray                  # covariance at the mode, original scale
    n: int
    loglik: float
    iterations: int
    converged: bool
    method: str = METHOD
    scale: dict = field(default_factory=dict)
    ess: float | None = None         # effective sample size when draws were importance-resampled

    def as_dict(self) -> dict:
        return dict(zip(self.terms, self.mode.tolist()))


def _log1pexp(eta: Column) -> Column:
    return F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta)))


def fit_logit(df: DataFrame, label: str, features: Sequence[str], prior_sd: float | Mapping[str, float] | None = None,
              prior_mean: Mapping[str, float] | None = None, max_iter: int = 50, tol: float = 1e-10,
              prior_t: Mapping[str, tuple[float, float, float]] | None = None) -> LogitFit:
    """Posterior mode of a Bernoulli-logit model with optional normal priors.

    Features are centred and scaled first (one aggregate); ``prior_sd`` is on
    that scale (a float for every slope, or a mapping by term, "intercept"
    included). ``prior_t`` maps a term to a Student-t prior (df, location,
    scale); on the intercept it is the intercept of the centred predictors.
    ``None`` everywhere gives the maximum-likelihood fit.
    """
    feats = list(features)
    k = len(feats) + 1
    data = df.select(F.col(label).cast("double").alias("__y__"),
                     *[F.col(f).cast("double").alias(f) for f in feats]).na.drop()
    stats = data.agg(F.count(F.lit(1)).alias("n"),
                     *[F.avg(f).alias(f"m_{i}") for i, f in enumerate(feats)],
                     *[F.stddev_pop(f).alias(f"s_{i}") for i, f in enumerate(feats)]).first()
    n = int(stats["n"])
    means = np.array([stats[f"m_{i}"] or 0.0 for i in range(len(feats))])
    sds = np.array([(stats[f"s_{i}"] or 0.0) for i in range(len(feats))])
    sds[sds == 0] = 1.0
    z = data.select("__y__", *[((F.col(f) - F.lit(float(means[i]))) / F.lit(float(sds[i]))).alias(f"z{i}")
                               for i, f in enumerate(feats)])
    z = z.persist(StorageLevel.MEMORY_AND_DISK)
    zcols = [F.lit(1.0)] + [F.col(f"z{i}") for i in range(len(feats))]
    names = ["intercept", *feats]
    prec = np.zeros(k)
    mu0 = np.zeros(k)
    if prior_sd is not None:
        for j, t in enumerate(names):
            sd = prior_sd.get(t) if isinstance(prior_sd, Mapping) else (None if t == "intercept" else prior_sd)
            if sd:
                prec[j] = 1.0 / (sd * sd)
    if prior_mean:
        for j, t in enumerate(names):
            mu0[j] = prior_mean.get(t, 0.0)
    def evaluate(beta: np.ndarray):
        """Log-posterior, gradient and negative Hessian at ``beta``: one Spark aggregate."""
        row = z.agg(*_newton_aggregates(zcols, beta)).first()
        g = np.array([row[f"g{j}"] or 0.0 for j in range(k)]) - prec * (beta - mu0)
        h = np.zeros((k, k))
        for a in range(k):
            for b in range(a, k):
                h[a, b] = h[b, a] = row[f"h{a}_{b}"] or 0.0
        h += np.diag(prec)
        tg, th = _t_prior_terms(beta, names, prior_t)
        ll = float(row["ll"] or 0.0)
        lp = ll - 0.5 * float(np.sum(prec * (beta - mu0) ** 2)) + _t_log_prior(beta, names, prior_t)
        return lp, g + tg, h + np.diag(th), ll

    beta = np.zeros(k)
    converged, it = False, 0
    try:
        lp, g, h, ll = evaluate(beta)
        for it in range(1, max_iter + 1):
            try:
                step = np.linalg.solve(h, g)
            except np.linalg.LinAlgError:
                step = np.linalg.lstsq(h, g, rcond=None)[0]
            # Newton step, halved until the log-posterior does not fall (separable data,
            # poor curvature far from the mode); each trial is one aggregate
            t, accepted = 1.0, False
            if np.all(np.isfinite(step)):
                for _ in range(20):
                    cand = beta + t * step
                    lp_c, g_c, h_c, ll_c = evaluate(cand)
                    if np.isfinite(lp_c) and lp_c >= lp - 1e-12 * max(1.0, abs(lp)):
                        accepted = True
                        break
                    t /= 2
            if not accepted:
                break                        # no finite improvement left (e.g. separable labels, no prior)
            moved = np.max(np.abs(cand - beta))
            beta, lp, g, h, ll = cand, lp_c, g_c, h_c, ll_c
            if moved < tol:
                converged = True
                break
    finally:
        z.unpersist()
    try:
        cov_z = np.linalg.inv(h)             # h is evaluated at the returned mode
    except np.linalg.LinAlgError:
        cov_z = np.linalg.pinv(h)
    return _finish(beta, cov_z, means, sds, names, n, ll, it, converged)


def _finish(beta, cov_z, means, sds, names, n, ll, it, converged) -> LogitFit:
    """Back to the original scale: beta_orig = A @ beta_z."""
    k = len(beta)
    A = np.eye(k)
    for j in range(1, k):
        A[j, j] = 1.0 / sds[j - 1]
        A[0, j] = -means[j - 1] / sds[j - 1]
    return LogitFit(terms=list(names), mode=A @ beta, cov=A @ cov_z @ A.T, n=n, loglik=ll,
                    iterations=it, converged=converged,
                    scale={"mean": means.tolist(), "sd": sds.tolist()})


def _t_prior_terms(beta, names, prior_t):
    """Gradient of the log Student-t prior and its curvature (clamped at 0 to keep the Newton step a descent)."""
    g = np.zeros(len(beta))
    h = np.zeros(len(beta))
    for j, t in enumerate(names):
        spec = (prior_t or {}).get(t)
        if not spec:
            continue
        nu, loc, scale = spec
        d = beta[j] - loc
        den = nu * scale * scale + d * d
        g[j] = -(nu + 1) * d / den
        h[j] = max(0.0, (nu + 1) * (nu * scale * scale - d * d) / (den * den))
    return g, h


def _t_log_prior(beta, names, prior_t) -> float:
    total = 0.0
    for j, t in enumerate(names):
        spec = (prior_t or {}).get(t)
        if spec:
            nu, loc, scale = spec
            total += -(nu + 1) / 2 * np.log1p(((beta[j] - loc) / scale) ** 2 / nu)
    return float(total)


def _factor(cov: np.ndarray) -> np.ndarray:
    """A matrix whose square is ``cov``, from its eigenvalues; negative ones (a singular fit) count as 0."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    return vectors * np.sqrt(np.clip(values, 0.0, None))


def coefficient_column(term: str) -> str:
    return f"b_{term}"


def posterior_draws(spark: SparkSession, fit: LogitFit, n: int = 4000, seed: int = 1) -> DataFrame:
    """``n`` draws from Normal(mode, cov): one row per draw, one column per coefficient.

    ``n`` x k numbers are made on the driver; the table size is the caller's ``n``.
    """
    rng = np.random.default_rng(seed)
    draws = fit.mode + rng.standard_normal((n, len(fit.mode))) @ _factor(fit.cov).T
    schema = StructType([StructField("draw_id", IntegerType(), False)] +
                        [StructField(coefficient_column(t), DoubleType(), False) for t in fit.terms])
    rows = [(i + 1, *map(float, draws[i])) for i in range(n)]
    return spark.createDataFrame(rows, schema)


def draws_log_likelihood(df: DataFrame, label: str, features: Sequence[str], draws: DataFrame,
                         terms: Sequence[str]) -> dict[int, float]:
    """Bernoulli-logit log-likelihood of the data under every draw, in one Spark job.

    Rows x draws, summed per draw: the aggregate has one group per draw and combines on the
    map side, so only ``n`` numbers come back. The draws are the caller's ``n`` rows.
    """
    data = df.select(F.col(label).cast("double").alias("__y__"),
                     *[F.col(f).cast("double").alias(f) for f in features]).na.drop()
    eta = F.col(coefficient_column(terms[0]))
    for t, f in zip(terms[1:], features):
        eta = eta + F.col(coefficient_column(t)) * F.col(f)
    ll = F.col("__y__") * eta - _log1pexp(eta)
    out = data.crossJoin(draws).groupBy("draw_id").agg(F.sum(ll).alias("ll"))
    return {r["draw_id"]: float(r["ll"]) for r in out.collect()}


def importance_resample(spark: SparkSession, df: DataFrame, label: str, features: Sequence[str], fit: LogitFit,
                        n: int = 4000, seed: int = 1, prior_sd=None, prior_t=None,
                        truncate_at: float | None = None) -> tuple[DataFrame, float]:
    """Laplace draws corrected towards the exact posterior by importance resampling.

    Proposal: Student-t (4 df) around the mode with the Laplace covariance
    (heavier tails than the posterior). Weights = likelihood x prior /
    proposal; ``n`` draws are resampled. ``truncate_at`` cuts weights at that many
    mean weights (truncated importance sampling, e.g. ``sqrt(n)``); it changes
    the sampled distribution and is off by default. Returns the draws and the effective sample size of the weights.
    """
    rng = np.random.default_rng(seed)
    k = len(fit.terms)
    nu = 4.0
    chol = _factor(fit.cov)
    z = rng.standard_normal((n, k))
    u = rng.chisquare(nu, n)
    prop = fit.mode + (z @ chol.T) * np.sqrt(nu / u)[:, None]
    schema = StructType([StructField("draw_id", IntegerType(), False)] +
                        [StructField(coefficient_column(t), DoubleType(), False) for t in fit.terms])
    proposal = spark.createDataFrame([(i + 1, *map(float, prop[i])) for i in range(n)], schema)
    ll = draws_log_likelihood(df, label, features, proposal, fit.terms)
    inv = np.linalg.pinv(fit.cov, hermitian=True)
    d = prop - fit.mode
    maha = np.einsum("ij,jk,ik->i", d, inv, d)
    log_q = -0.5 * (nu + k) * np.log1p(maha / nu)
    log_p = np.array([ll[i + 1] for i in range(n)])
    # priors act on the standardised scale (the fit's parameterisation); map the draws there
    if prior_sd is not None or prior_t:
        means = np.array(fit.scale["mean"])
        sds = np.array(fit.scale["sd"])
        bz = prop.copy()
        bz[:, 1:] = prop[:, 1:] * sds
        bz[:, 0] = prop[:, 0] + prop[:, 1:] @ means
        for j, t in enumerate(fit.terms):
            sd = prior_sd.get(t) if isinstance(prior_sd, Mapping) else (None if t == "intercept" else prior_sd)
            if sd:
                log_p += -0.5 * (bz[:, j] / sd) ** 2
            spec = (prior_t or {}).get(t)
            if spec:
                df_, loc, sc = spec
                log_p += -(df_ + 1) / 2 * np.log1p(((bz[:, j] - loc) / sc) ** 2 / df_)
    lw = log_p - log_q
    w = np.exp(lw - lw.max())
    if truncate_at is not None:
        w = np.minimum(w, w.mean() * truncate_at)
    w /= w.sum()
    ess = float(1.0 / np.sum(w * w))
    pick = rng.choice(n, size=n, replace=True, p=w)
    rows = [(i + 1, *map(float, prop[j])) for i, j in enumerate(pick)]
    return spark.createDataFrame(rows, schema), ess


def draws_summary(draws: DataFrame, draw_id: str = "draw_id", method: str = METHOD) -> DataFrame:
    """Mean, sd and 2.5/50/97.5 % quantiles per coefficient (``summary(fit)``); ``method`` tells how the draws were made."""
    coefs = [c for c in draws.columns if c != draw_id]
    long = draws.unpivot([draw_id], coefs, "term", "value")
    q = F.percentile("value", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))
    return (long.groupBy("term").agg(F.avg("value").alias("mean"), F.stddev("value").alias("sd"),
                                     q.alias("__q__"), F.count(F.lit(1)).alias("draws"))
            .select("term", "mean", "sd", F.col("__q__")[0].alias("q2_5"), F.col("__q__")[1].alias("q50"),
                    F.col("__q__")[2].alias("q97_5"), "draws", F.lit(method).alias("method")))
