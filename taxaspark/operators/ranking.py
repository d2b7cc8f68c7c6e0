"""Global order operators that stay distributed.

A window without ``partitionBy`` moves every row into one task. The two
operators here keep the work spread out: the rows are range-partitioned on
the order and written to the shared checkpoint folder, so that the totals
of each range and the rows themselves come from the same ranges even if
executors are lost. What is ahead of a range is a prefix sum over one row per
range partition.

* ``row_index``: the position inside a range is taken while the range is
  written; only the broadcast of the offsets follows.
* ``running_sum_desc``: the input is one row per distinct value (a hot value
  has been added up before), with a window inside each range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, ensure_checkpoint_dir


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    out = []
    for c in order_by:
        out.append(F.col(c).asc_nulls_last() if isinstance(c, str) else c)
    return out


def sort_rows(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``arrange(...)``: ascending with missing values last (R's rule) unless a Column says otherwise."""
    return df.orderBy(*_order_cols(order_by))


def row_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "index",
              partitions: int | None = None) -> DataFrame:
    """``arrange(...) %>% mutate(index = 1:n())`` without a single-partition window.

    ``order_by`` must be a total order (add a unique tiebreak key). One shuffle: the
    ranges are written with each row's position in them.
    """
    order = _order_cols(order_by)
    # a monotonic id is (partition << 33) + position in the partition
    ranged = _ranges(df, order, partitions).withColumn("__id__", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright("__id__", 33).alias("__part__")
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("__n__"))
    offsets = _ahead(counts, "__n__", "__off__", F.col("__part__"))
    within = F.col("__id__").bitwiseAND(F.lit((1 << 33) - 1))
    return (ranged.withColumn("__part__", F.shiftright("__id__", 33)).join(F.broadcast(offsets), "__part__")
            .withColumn(name, F.col("__off__") + within + 1).drop("__part__", "__off__", "__id__"))


def _ranges(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or default_parallelism(spark)
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def _ahead(totals: DataFrame, amount: str, name: str, order: Column) -> DataFrame:
    """Per range partition, the total of those before it: one row each, bounded by the partition count."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__part__", F.coalesce(F.sum(amount).over(before), F.lit(0)).alias(name))


def running_sum_desc(per_value: DataFrame, value: str, amount: str, name: str,
                     partitions: int | None = None) -> DataFrame:
    """Running total of ``amount`` from the largest ``value`` down (``value`` unique per row).

    As many ranges as ``partitions`` (the session's shuffle partitions by default). No rows: no rows.
    """
    ranged = _ranges(per_value, [F.col(value).desc()], partitions).withColumn("__part__", F.spark_partition_id()) \
        .checkpoint(eager=True)
    totals = ranged.groupBy("__part__").agg(F.sum(amount).alias("__tot__"))
    above = _ahead(totals, "__tot__", "__above__", F.col("__part__"))
    w = (Window.partitionBy("__part__").orderBy(F.col(value).desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.join(F.broadcast(above), "__part__")
            .withColumn(name, F.col("__above__") + F.sum(amount).over(w))
            .drop("__part__", "__above__"))
