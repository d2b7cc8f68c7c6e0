import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from taxaspark.operators import model as M
from taxaspark.operators import ranking as R
from taxaspark.operators import scoring as S


def test_classify_cutoff(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (None,)], "p double")
    assert rows(S.classify(df, "p"), "p", "pred_class") == [(None, None), (0.49, 0), (0.5, 1)]


def test_threshold_fixtures(spark):
    pos = spark.createDataFrame([(1, (i + 1) * 0.05) for i in range(20)], "y int, s double")
    assert S.threshold_for_fnr(pos, "y", "s", 0.05).collect()[0][0] == pytest.approx(0.05)
    mixed = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.7), (0, 0.1)], "y int, s double")
    assert S.threshold_for_fnr(mixed, "y", "s", 0.5).collect()[0][0] == 0.9
    none = spark.createDataFrame([(0, 0.9), (0, 0.5)], "y int, s double")
    assert S.threshold_for_fnr(none, "y", "s", 0.05).collect()[0][0] is None


def _brute_threshold(obs, pred, fnr):
    best = None
    for t in sorted(pred, reverse=True):
        tp = sum(1 for o, p in zip(obs, pred) if p >= t and o == 1)
        fn = sum(1 for o, p in zip(obs, pred) if p < t and o == 1)
        if tp + fn and 1 - tp / (tp + fn) <= fnr:
            best = t
            break
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_threshold_equals_quadratic_definition(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.random() < 0.3 and 1 or 0, round(rnd.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(data, "y int, s double")
    obs, pred = zip(*data)
    for fnr in (0.0, 0.05, 0.2):
        got = S.threshold_for_fnr(df, "y", "s", fnr, partitions=5).collect()[0][0]
        assert got == _brute_threshold(obs, pred, fnr)


def test_fnr_curve_running_sum(spark):
    rnd = random.Random(9)
    data = [(rnd.randint(0, 1), float(rnd.randint(0, 50))) for _ in range(300)]
    curve = {r.threshold: r for r in S.fnr_curve(spark.createDataFrame(data, "y int, s double"), "y", "s", 4).collect()}
    for t, r in curve.items():
        assert r.tp == sum(1 for y, s in data if y == 1 and s >= t)
        assert r.tp + r.fn == sum(y for y, _ in data)


def test_interval_fixture(spark):
    df = spark.createDataFrame([("r", v) for v in (1.0, 2.0, 4.0, 10.0)], "k string, e double")
    r = S.median_interval(df, ["k"], "e").collect()[0]
    assert (r.e, r.lower, r.upper) == (pytest.approx(3.0), pytest.approx(1.075), pytest.approx(9.55))
    assert r.lower <= r.e <= r.upper


def test_group_quantiles_by_rank_against_percentile(spark):
    """One group with a third of the rows, one value with a third of that, single rows, ties, NULL, NaN and NULL keys."""
    big = spark.range(60_000).select(F.lit("hot").alias("k"), F.lit(1).alias("g"),
                                     F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_007)) / 7).alias("v"))
    rest = spark.range(120_000).select(F.concat(F.lit("k"), (F.col("id") % 900).cast("string")).alias("k"), (F.col("id") % 2).cast("int").alias("g"),
                                       (F.pmod(F.xxhash64("id"), F.lit(1000)) / 3 - 100).alias("v"))
    odd = spark.createDataFrame([(None, 1, 2.0), (None, 1, 4.0), (None, None, 1.0), ("null", 1, None), ("null", 1, None), ("one", 1, 3.5),
                                 ("nan", 1, float("nan")), ("nan", 1, 1.0), ("nan", 1, 2.0), ("some", 1, None), ("some", 1, 8.0)], "k string, g int, v double")
    df = big.union(rest).union(odd)
    ps = [0.0, 0.025, 0.37, 0.5, 0.975, 1.0]
    want = {(r["k"], r["g"]): r["q"] for r in df.groupBy("k", "g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q")).collect()}
    for parts in (7, 40):
        got = {(r["k"], r["g"]): r["quantiles"] for r in S.group_quantiles(df, ["k", "g"], "v", ps, partitions=parts).collect()}
        assert got.keys() == want.keys()
        for key, q in want.items():
            assert (q is None and got[key] is None) or got[key] == pytest.approx(q, abs=1e-9, nan_ok=True), key
    assert S.group_quantiles(df.limit(0), ["k"], "v", ps).collect() == []


def test_posterior_interval_equals_long_form(spark):
    rnd = random.Random(5)
    rows_df = spark.createDataFrame([(i, rnd.uniform(-2, 2), rnd.uniform(0, 1)) for i in range(50)],
                                    "id int, x double, z double")
    draws = spark.createDataFrame([(i, rnd.gauss(0, 1), rnd.gauss(1, 0.5), rnd.gauss(-1, 0.3)) for i in range(37)],
                                  "draw_id int, b_intercept double, b_x double, b_z double")
    terms = {"b_x": F.col("x"), "b_z": F.col("z")}
    a = {r.id: r for r in S.posterior_interval(rows_df, draws, terms).collect()}
    long = S.median_interval(S.posterior_expected(rows_df, draws, terms, n_draws=37), ["id"], "epred")
    for r in long.collect():
        assert a[r.id].epred == pytest.approx(r.epred, abs=1e-12)
        assert a[r.id].lower == pytest.approx(r.lower, abs=1e-12)
        assert a[r.id].upper == pytest.approx(r.upper, abs=1e-12)
        assert r.lower <= r.epred <= r.upper


def test_posterior_interval_selects_in_blocks(spark):
    """Every task selects the neighbours of the quantiles from a block of numbers: no array of draws goes with a row, none is sorted by
    row; missing terms and draws count as in the long form."""
    nan, inf = float("nan"), float("inf")
    rows_df = spark.createDataFrame([(1, 0.5, 1.0), (2, None, 1.0), (3, nan, 0.0), (4, inf, 0.0), (5, -3.0, 2.0), (5, -3.0, 2.0)],
                                    "id int, x double, z double")
    draws = spark.createDataFrame([(i, i / 7, 1.0 - i / 5, -i / 9) for i in range(1, 23)] + [(23, None, 1.0, 1.0), (24, 0.0, nan, 0.0)],
                                  "draw_id int, b_intercept double, b_x double, b_z double")
    terms = {"b_x": F.col("x"), "b_z": F.col("z")}
    found = S.posterior_interval(rows_df, draws, terms)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "sort_array" not in plan and "Join" not in plan
    got = {r["id"]: (r["epred"], r["lower"], r["upper"]) for r in found.collect()}
    ps = [0.5, (1 - 0.95) / 2, 1 - (1 - 0.95) / 2]
    long = S.group_quantiles(S.posterior_expected(rows_df.distinct(), draws, terms, n_draws=24), ["id"], "epred", ps)
    want = {r["id"]: tuple(r["quantiles"]) if r["quantiles"] else (None, None, None) for r in long.collect()}
    assert found.count() == 6 and got.keys() == want.keys() and want[2] == (None, None, None)
    for k in got:
        assert got[k] == pytest.approx(want[k], abs=1e-12, nan_ok=True) if k != 2 else got[k] == want[k]
    none = S.posterior_interval(rows_df, draws.where("draw_id = 23"), terms).collect()
    assert len(none) == 6 and {r["epred"] for r in none} == {None}


def test_confident_list_strict(spark):
    pred = spark.createDataFrame([("a", 0.1, 0.2), ("b", 0.2, 0.3)], "name string, epred double, upper double")
    thr = spark.createDataFrame([(0.3,)], "threshold double")
    assert rows(S.confident_list(pred, thr, "upper"), "name") == [("a",)]


def test_row_index_matches_sort(spark):
    rnd = random.Random(2)
    data = [(i, float(rnd.randint(0, 30))) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, v double")
    got = dict((r["k"], r["index"]) for r in R.row_index(df, ["v", "k"], "index", partitions=5).collect())
    want = {k: i + 1 for i, (k, _) in enumerate(sorted(data, key=lambda t: (t[1], t[0])))}
    assert got == want


def _logit_data(spark, n=3000, seed=4):
    rnd = np.random.default_rng(seed)
    a = rnd.normal(50, 10, n)
    b = rnd.normal(0, 1, n)
    c = rnd.uniform(0, 1, n)
    eta = -3 + 0.05 * a + 0.8 * b - 0.02 * a * b + 1.5 * c
    y = (rnd.uniform(0, 1, n) < 1 / (1 + np.exp(-eta))).astype(int)
    return spark.createDataFrame([(int(y[i]), float(a[i]), float(b[i]), float(c[i])) for i in range(n)],
                                 "y int, a double, b double, c double")


def test_fit_logit_matches_mllib(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = M.design_matrix(_logit_data(spark), "a", "b", ["c"], keep=["y"])
    feats = ["a", "b", "a_x_b", "c"]
    fit = M.fit_logit(df, "y", feats)
    assert fit.converged
    va = VectorAssembler(inputCols=feats, outputCol="f")
    lr = LogisticRegression(featuresCol="f", labelCol="y", regParam=0.0, standardization=False,
                            maxIter=200, tol=1e-12).fit(va.transform(df.withColumn("y", F.col("y").cast("double"))))
    ref = np.array([lr.intercept, *lr.coefficients.toArray()])
    assert np.allclose(fit.mode, ref, rtol=1e-4, atol=1e-4)
    draws = M.posterior_draws(spark, fit, 4000, seed=3)
    mean = np.array(draws.agg(*[F.avg(M.coefficient_column(t)) for t in fit.terms]).collect()[0])
    sd = np.sqrt(np.diag(fit.cov))
    assert np.all(np.abs(mean - fit.mode) < 4 * sd / np.sqrt(4000) + 1e-12)
    summ = {r.term: r for r in M.draws_summary(draws).collect()}
    assert summ["b_intercept"].draws == 4000 and summ["b_c"].method == "laplace"
    assert summ["b_a"].q2_5 < summ["b_a"].q50 < summ["b_a"].q97_5


def test_student_t_intercept_prior_pulls_intercept(spark):
    df = M.design_matrix(_logit_data(spark, n=300, seed=8), "a", "b", ["c"], keep=["y"])
    feats = ["a", "b", "a_x_b", "c"]
    free = M.fit_logit(df, "y", feats)
    tight = M.fit_logit(df, "y", feats, prior_t={"intercept": (3, -1, 0.3)})
    # the prior acts on the intercept of the standardised (centred) predictors
    zfree = free.mode[0] + sum(free.mode[1:] * np.array(free.scale["mean"]))
    ztight = tight.mode[0] + sum(tight.mode[1:] * np.array(tight.scale["mean"]))
    assert abs(ztight + 1) < abs(zfree + 1)


def test_plot_table_and_summary(spark):
    from taxaspark.plans import screen as SC
    lab = spark.createDataFrame([("a", 1, 0.9, 0.8, 0.95), ("b", 0, 0.2, 0.1, 0.3), ("c", 0, 0.5, 0.4, 0.6)],
                                "acceptedNameAuthor string, Threatened int, epred double, lower double, upper double")
    out = {r["acceptedNameAuthor"]: r for r in SC.plot_table(lab).collect()}
    assert [out[k]["index"] for k in "bca"] == [1, 2, 3]
    assert out["a"]["Predicted"] == "Threatened" and out["b"]["Predicted"] == "Not threatened"
    res = SC.Screening(None, None, lab, lab, spark.createDataFrame([(0.4,)], "threshold double"), lab.limit(2))
    lines = sorted(r[0] for r in SC.summary_lines(res).collect())
    assert lines == ["2 of macrofungi species confidently least concern", "Threshold for FNR of 0.05 : 0.4"]


def test_importance_resampling_matches_laplace_on_large_data(spark):
    df = M.design_matrix(_logit_data(spark, n=2000, seed=12), "a", "b", ["c"], keep=["y"])
    feats = ["a", "b", "a_x_b", "c"]
    fit = M.fit_logit(df, "y", feats)
    draws, ess = M.importance_resample(spark, df, "y", feats, fit, n=2000, seed=5)
    assert ess > 300
    mean = np.array(draws.agg(*[F.avg(M.coefficient_column(t)) for t in fit.terms]).collect()[0])
    sd = np.sqrt(np.diag(fit.cov))
    # with 2000 rows the posterior is close to normal: resampled means stay within a fraction of an sd
    assert np.all(np.abs(mean - fit.mode) < 0.25 * sd)


def test_importance_resampling_skews_small_data(spark):
    # few rows: the exact posterior of the intercept is skewed; the correction moves the mean off the mode
    data = spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 0.5), (0, 0.2), (1, 0.9), (1, 0.3), (1, 0.7)],
                                 "y int, x double")
    fit = M.fit_logit(data, "y", ["x"], prior_sd=2.5)
    draws, ess = M.importance_resample(spark, data, "y", ["x"], fit, n=3000, seed=2, prior_sd=2.5)
    m = draws.agg(F.avg("b_intercept")).collect()[0][0]
    assert ess > 100 and m != pytest.approx(fit.mode[0], abs=1e-3)


def test_fit_logit_separable_data_stays_finite(spark):
    df = spark.createDataFrame([(0, float(x)) for x in range(10)] + [(1, float(x)) for x in range(10, 20)],
                               "y int, x double")
    free = M.fit_logit(df, "y", ["x"], max_iter=15)
    assert not free.converged and np.all(np.isfinite(free.mode))
    weak = M.fit_logit(df, "y", ["x"], prior_sd=2.5)
    assert weak.converged and np.all(np.isfinite(weak.cov)) and weak.mode[1] > 0


def test_posterior_expected_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "DRAWS_IN_CHUNK", 7)
    rows_df = spark.createDataFrame([(i, i / 10) for i in range(20)], "id int, x double")
    draws = spark.createDataFrame([(i, i / 30, 1 - i / 20) for i in range(30)], "draw_id int, b_intercept double, b_x double")
    got = {(r.id, r.draw_id): r.epred for r in S.posterior_expected(rows_df, draws, {"b_x": F.col("x")}).collect()}
    assert len(got) == 600
    for (i, k), p in got.items():
        assert p == pytest.approx(1 / (1 + np.exp(-(k / 30 + (1 - k / 20) * (i / 10)))), abs=1e-12)


def test_threshold_without_rows_scores_or_with_one_partition(spark):
    schema = "y int, s double"
    for data in ([], [(1, None), (0, None)], [(0, 0.5)]):
        assert S.threshold_for_fnr(spark.createDataFrame(data, schema), "y", "s").collect()[0][0] is None
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], schema)
    assert S.threshold_for_fnr(one, "y", "s", partitions=1).collect()[0][0] == 0.5


def test_draws_after_a_singular_fit(spark):
    df = spark.createDataFrame([(i % 2, float(i), 3.0) for i in range(40)], "y int, x double, constant double")
    fit = M.fit_logit(df, "y", ["x", "constant"])
    draws = M.posterior_draws(spark, fit, 50)
    assert draws.count() == 50
    assert all(np.isfinite(v) for r in draws.collect() for v in r)
    drawn, ess = M.importance_resample(spark, df, "y", ["x", "constant"], fit, n=50)
    assert drawn.count() == 50 and np.isfinite(ess)
    assert M.draws_summary(drawn, method=M.RESAMPLED).first()["method"] == M.RESAMPLED


def test_truncation_is_a_parameter(spark):
    df = _logit_data(spark, 400)
    x = M.design_matrix(df, "a", "b", ["c"], keep=["y"])
    feats = ["a", "b", "a_x_b", "c"]
    fit = M.fit_logit(x, "y", feats)
    _, plain = M.importance_resample(spark, x, "y", feats, fit, n=300)
    _, cut = M.importance_resample(spark, x, "y", feats, fit, n=300, truncate_at=1.0)
    assert cut >= plain


def test_fitted_screening_is_a_query_that_fits_draws_and_thresholds(spark, monkeypatch):
    import bench
    from __spark_entry__ import queries
    from taxaspark.catalog import predictors

    sf, made = "/root/testdata/sf0.001", []
    real = predictors.screen_species
    monkeypatch.setattr(predictors, "screen_species", lambda *a, **b: made.append(real(*a, **b)) or made[-1])
    got = queries()["screen_species_fitted"](spark, sf).collect()
    assert "screen_species_fitted" in bench.EXTRA
    res = made[0]
    assert res.fit is not None and res.draws.count() == 2000
    labelled = [r for r in got if r["labelled"]]
    assert len(got) == predictors.predictor_table(spark, sf).count() and 0 < len(labelled) == res.fit.n
    assert {(r["n_fitted"], r["converged"], r["method"]) for r in got} == {(res.fit.n, True, "laplace")}
    assert all(0 <= r["lower95ConfInt"] <= r["medianPrediction"] <= r["upper95ConfInt"] <= 1 for r in got)
    assert any(r["lower95ConfInt"] < r["upper95ConfInt"] for r in got)
    assert sum(r["confident"] for r in got if r["confident"] is not None) == res.confident.count()
