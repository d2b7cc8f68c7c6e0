"""Reading the input tables and writing intermediate tables to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.session import default_parallelism, ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs at most the running stage), fixes
    the rows for every later use, and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return default_parallelism(spark)


def text_print(text: Column) -> Column:
    """A 64-bit print of a text. With doc_id it tells rows of one doc_id apart, so that joins back to rows stay one to one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
