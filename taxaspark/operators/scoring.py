"""Scoring with posterior draws, intervals, threshold for a false-negative rate."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.nulls import all_of
from ..functions.numeric import inv_logit
from ..session import default_parallelism, staged
from .frames import rename, round_numeric
from .joins import join_on
from .ranking import running_sum_desc, sort_rows

DRAWS_IN_CHUNK = 1000


def spread(rows: DataFrame) -> DataFrame:
    """Round-robin the (small, species-level) rows over all cores before work that
    multiplies every row by the number of draws; AQE would otherwise leave a
    small table in one partition and the expansion in one task."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def classify(df: DataFrame, prob: str, cutoff: float = 0.5, out: str = "pred_class") -> DataFrame:
    """``ifelse(p < cutoff, 0, 1)``: the cut-off itself is class 1, NULL stays NULL."""
    p = F.col(prob)
    return df.withColumn(out, F.when(p < F.lit(cutoff), F.lit(0)).when(p >= F.lit(cutoff), F.lit(1)))


def linear_predictor(terms: Mapping[str, Column], intercept: str = "b_intercept") -> Column:
    """``b_intercept + sum(b_term * term)`` over a row joined to one draw."""
    eta = F.col(intercept)
    for coef, term in terms.items():
        eta = eta + F.col(coef) * term
    return eta


def posterior_expected(rows: DataFrame, draws: DataFrame, terms: Mapping[str, Column],
                       intercept: str = "b_intercept", out: str = "epred",
                       draw_id: str = "draw_id", n_draws: int | None = None) -> DataFrame:
    """Expected probability per (row, draw): ``inv_logit(eta)`` (``add_epred_draws``).

    The product is what is asked for, but not a cross join: draws travel in
    chunks of a fixed number, every row is dealt to every chunk, and rows and
    chunks meet in an equi-join, broadcast or shuffled as the planner's size
    check says. One path for every number of draws; the product is never cached.
    """
    n = n_draws if n_draws is not None else draws.count()
    chunks = max(1, -(-n // DRAWS_IN_CHUNK))
    fields = [draw_id, intercept, *terms]
    packed = draws.groupBy(F.pmod(F.hash(draw_id), F.lit(chunks)).alias("__chunk__")).agg(
        F.collect_list(F.struct(*fields)).alias("__draws__"))
    dealt = spread(rows).withColumn("__chunk__", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pairs = dealt.join(packed, "__chunk__").select(*rows.columns, F.explode("__draws__").alias("__d__"))
    eta = F.col("__d__")[intercept]
    for coef, term in terms.items():
        eta = eta + F.col("__d__")[coef] * term
    return pairs.select(*rows.columns, F.col("__d__")[draw_id].alias(draw_id), inv_logit(eta).alias(out))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float], out: str = "quantiles",
                    partitions: int | None = None) -> DataFrame:
    """Exact quantiles per group by rank (linear interpolation between closest ranks), for groups of any size.

    Equal values of a group become one row with a count. The rows are dealt into ranges of (group, value), so a group that holds a
    third of all rows lies in a third of the ranges; totals for each (range, group) say in which range a wanted rank is,
    and only these parts of the ranges are read again to find it. No task, buffer or array holds a whole group.
    NULL values do not count; a group of only NULLs has a NULL result. NaN is above all numbers.
    """
    spark, keys = df.sparkSession, list(keys)
    names = [f"__k{i}__" for i in range(len(keys))]
    tally = staged(df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(value).cast("double").alias("__v__"))
                   .groupBy(*names, "__v__").agg(F.count("__v__").alias("__n__")), "tally")
    ranged = staged(tally.repartitionByRange(partitions or default_parallelism(spark), *names, "__v__")
                    .withColumn("__part__", F.spark_partition_id()), "ranges")
    own = Window.partitionBy(*names)
    upto = own.orderBy("__part__").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(ranged.groupBy(*names, "__part__").agg(F.sum("__n__").alias("__n__"))
                   .select(*names, "__part__", "__n__", F.coalesce(F.sum("__n__").over(upto), F.lit(0)).alias("__base__"),
                           F.sum("__n__").over(own).alias("__total__")), "parts")          # a row for each range and group
    position = [(F.col("__total__") - 1).cast("double") * F.lit(float(p)) for p in ps]
    ranks = F.array(*[F.struct(F.lit(2 * i + j).alias("which"), (near(x).cast("bigint") - F.col("__base__")).alias("rank"))
                      for i, x in enumerate(position) for j, near in enumerate((F.floor, F.ceil))])
    asked = parts.select(*names, "__part__", F.filter(ranks, lambda r: (r["rank"] >= 0) & (r["rank"] < F.col("__n__"))).alias("__ranks__")) \
        .where(F.size("__ranks__") > 0)
    met = join_on(ranged, asked, [*names, "__part__"], "inner", null_safe=True)
    before = Window.partitionBy(*names, "__part__").orderBy("__v__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = met.withColumn("__upto__", F.sum("__n__").over(before)).select(
        *names, "__v__", F.explode(F.filter("__ranks__", lambda r: (r["rank"] < F.col("__upto__")) & (r["rank"] >= F.col("__upto__") - F.col("__n__")))).alias("__r__"))
    picked = found.groupBy(*names).agg(*[F.max(F.when(F.col("__r__.which") == i, F.col("__v__"))).alias(f"__q{i}__") for i in range(2 * len(ps))])
    groups = parts.groupBy(*names).agg(F.first("__total__").alias("__total__"))
    whole = join_on(groups, picked, names, "left", null_safe=True)

    def between(i: int, x: Column) -> Column:
        low, high = F.col(f"__q{2 * i}__"), F.col(f"__q{2 * i + 1}__")
        return F.when(low == high, low).otherwise((F.ceil(x).cast("double") - x) * low + (x - F.floor(x).cast("double")) * high)

    return whole.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)],
                        F.when(F.col("__total__") > 0, F.array(*[between(i, x) for i, x in enumerate(position)])).alias(out))


def median_interval(df: DataFrame, keys: Sequence[str], value: str = "epred", width: float = 0.95,
                    median: str | None = None, lower: str = "lower", upper: str = "upper") -> DataFrame:
    """``median_qi``: median and central ``width`` interval per key (exact, linear interpolation), for groups of any size
    (``group_quantiles``). For intervals of a row over draws ``posterior_interval`` avoids the group-by altogether.
    """
    lo, hi = (1 - width) / 2, 1 - (1 - width) / 2
    found = group_quantiles(df, keys, value, [lo, 0.5, hi], "__q__")
    return found.select(*keys, F.col("__q__")[1].alias(median or value), F.col("__q__")[0].alias(lower), F.col("__q__")[2].alias(upper))


def posterior_interval(rows: DataFrame, draws: DataFrame, terms: Mapping[str, Column],
                       intercept: str = "b_intercept", width: float = 0.95, median: str = "epred",
                       lower: str = "lower", upper: str = "upper", draw_id: str = "draw_id") -> DataFrame:
    """Median and central interval of the expected probability over all draws, per row.

    Same numbers as ``posterior_expected`` followed by ``median_interval``,
    without materialising rows x draws or shuffling: tasks hold the draws as one array of numbers,
    and map a block of rows at a time to linear predictors (``_predictors_at``), of which only the
    neighbours of the three quantiles are selected. The inverse logit is monotone, so Spark
    applies it to these few, not to every draw.
    The array is one value, of the number of draws that the caller chose.
    """
    coefs = [intercept, *terms.keys()]
    # a draw that lacks a coefficient has no predictor for any row
    held = draws.select(*[F.col(x).cast("double").alias(x) for x in coefs]).where(all_of([F.col(x).isNotNull() for x in coefs]))
    betas = np.array([tuple(r) for r in held.collect()], dtype=float).reshape(-1, len(coefs)).T
    ranks = [(betas.shape[1] - 1) * p for p in (0.5, (1 - width) / 2, 1 - (1 - width) / 2)]
    if betas.shape[1] == 0:
        return rows.select(*rows.columns, *[F.lit(None).cast("double").alias(x) for x in (median, lower, upper)])
    names = [f"__eta{i}__" for i in range(2 * len(ranks))]
    given = spread(rows).select(*rows.columns, *[t.cast("double").alias(f"__x{i}__") for i, t in enumerate(terms.values())])
    kind = StructType([*rows.schema.fields, *[StructField(x, DoubleType()) for x in names]])
    found = given.mapInArrow(_predictors_at(betas, [near(x) for x in ranks for near in (math.floor, math.ceil)], names), kind)

    def quantile(i: int) -> Column:
        """The formula of Spark's exact ``percentile``: linear interpolation between closest ranks."""
        x, low, high = ranks[i], inv_logit(F.col(names[2 * i])), inv_logit(F.col(names[2 * i + 1]))
        return low if math.floor(x) == math.ceil(x) else F.lit(math.ceil(x) - x) * low + F.lit(x - math.floor(x)) * high

    return found.select(*rows.columns, *[quantile(i).alias(x) for i, x in enumerate((median, lower, upper))])


def _predictors_at(betas: np.ndarray, ranks: Sequence[int], names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to rows, whose last columns are the terms, the linear predictors at ``ranks`` of all draws (``betas``: a row for each
    coefficient, intercept first); a row with a missing term has none. NaN is above all numbers."""
    terms, block = len(betas) - 1, max(1, (1 << 18) // betas.shape[1])
    places = sorted(set(ranks))
    wanted = [places.index(r) for r in ranks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.num_columns - terms
            xs = [c.to_numpy(zero_copy_only=False) for c in batch.columns[own:]]
            missing = np.zeros(batch.num_rows, dtype=bool)
            for c in batch.columns[own:]:
                missing |= c.is_null().to_numpy(zero_copy_only=False)
            at = np.empty((batch.num_rows, len(places)))
            with np.errstate(all="ignore"):
                for start in range(0, batch.num_rows, block):
                    eta = np.tile(betas[0], (min(block, batch.num_rows - start), 1))
                    for beta, x in zip(betas[1:], xs, strict=True):         # term by term, as the sum is written
                        eta += beta * x[start:start + block, None]
                    eta.partition(places, axis=1)
                    at[start:start + block] = eta[:, places]
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], *[pa.array(at[:, i], pa.float64(), mask=missing) for i in wanted]],
                                             [*batch.schema.names[:own], *names])

    return run


def fnr_curve(df: DataFrame, observed: str, score: str, partitions: int | None = None) -> DataFrame:
    """False-negative rate for every distinct score used as threshold.

    ``tp(t)`` counts observed positives with ``score >= t``; ``fnr = 1 - tp / (tp + fn)``
    in exactly that form (``1 - 19/20 <= 0.05`` is FALSE in doubles). With no
    positives the rate is NULL.
    """
    scored = df.filter(F.col(score).isNotNull())
    pos = F.when(F.col(observed) == 1, F.lit(1)).otherwise(F.lit(0))
    per = scored.groupBy(score).agg(F.sum(pos).cast("long").alias("positives"))
    total = scored.agg(F.sum(pos).cast("long").alias("__P__"))
    run = running_sum_desc(per, score, "positives", "tp", partitions)
    tp = F.col("tp")
    fn = F.col("__P__") - tp
    out = run.crossJoin(F.broadcast(total))           # one row
    return out.select(
        F.col(score).alias("threshold"), "positives", tp.cast("long").alias("tp"),
        fn.cast("long").alias("fn"),
        (F.lit(1.0) - F.try_divide(tp.cast("double"), (tp + fn).cast("double"))).alias("fnr"),
    )


def threshold_for_fnr(df: DataFrame, observed: str, score: str, fnr: float = 0.05,
                      partitions: int | None = None) -> DataFrame:
    """One row: the largest score whose false-negative rate is at most ``fnr`` (NULL if none, or without scores)."""
    curve = fnr_curve(df, observed, score, partitions)
    return curve.agg(F.max(F.when(F.col("fnr") <= F.lit(fnr), F.col("threshold"))).alias("threshold"))


def confident_list(pred: DataFrame, threshold: DataFrame, upper: str = "upper",
                   columns: Sequence[str] | None = None, renames: Mapping[str, str] | None = None,
                   order_by: Sequence[str] = (), digits: int | None = 3) -> DataFrame:
    """Rows whose upper bound is strictly below the one-row ``threshold``; select, rename, round, sort."""
    t = threshold.select(F.col("threshold").alias("__thr__"))
    out = pred.crossJoin(F.broadcast(t)).filter(F.col(upper) < F.col("__thr__")).drop("__thr__")
    if columns:
        out = out.select(*columns)
    if renames:
        out = rename(out, renames)
    if digits is not None:
        out = round_numeric(out, digits)
    return sort_rows(out, list(order_by)) if order_by else out
