"""First record of a key wins, on a stream.

The survivors are a table that every micro-batch is merged into: the batch meets only the survivors of
the buckets that its keys fall in, and those buckets are written anew under the number of the
batch. A batch that is run again after a failure reads the same survivors and replaces what it had written, so a restart changes
nothing. The order is the caller's (a total one), not that of arrival: after all batches the survivors are those
of ``operators.dedup.first_per_key`` on the whole.

Layout: ``<out>/bucket=<b>/batch=<n>/`` holds the survivors of a bucket after batch ``n``; the newest one of a bucket is valid.
Versions that a newer batch has replaced are removed one batch later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedup import first_per_key

BUCKET = "__bucket__"


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _versions(spark: SparkSession, out_dir: str) -> dict[int, list[int]]:
    """The batches whose survivors of each bucket are whole, in order (buckets: a fixed number)."""
    fs, top = _fs(spark, out_dir)
    found: dict[int, list[int]] = {}
    if fs.exists(top):
        for done in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/bucket=*/batch=*/_SUCCESS")) or []:
            version = done.getPath().getParent()
            found.setdefault(int(version.getParent().getName()[7:]), []).append(int(version.getName()[6:]))
    return {b: sorted(v) for b, v in found.items()}


def _read(spark: SparkSession, out_dir: str, schema: StructType, newest: dict[int, int]) -> DataFrame | None:
    paths = [f"{out_dir}/bucket={b}/batch={n}" for b, n in sorted(newest.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def survivors(spark: SparkSession, out_dir: str, schema: StructType) -> DataFrame:
    """The first record of every key that the stream has seen."""
    newest = {b: v[-1] for b, v in _versions(spark, out_dir).items()}
    found = _read(spark, out_dir, schema, newest)
    return found if found is not None else spark.createDataFrame([], schema)


def first_per_key_stream(records: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], out_dir: str, checkpoint: str,
                         buckets: int = 16) -> StreamingQuery:
    """Keep the first record of each key in ``order_by`` (a total order) over all micro-batches; read them with ``survivors``.

    ``buckets`` is fixed for the life of ``out_dir``. A hot key is one row among the survivors and, before a batch is shuffled,
    one row a task.
    """
    out_dir = out_dir.rstrip("/")

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = first_per_key(batch, keys, order_by).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        batch = batch.persist()
        try:
            touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # buckets, a fixed number at most
            versions = {b: [n for n in v if n < number] for b, v in _versions(spark, out_dir).items()}
            for b in sorted(touched):
                own = batch.where(F.col(BUCKET) == b).drop(BUCKET)
                before = _read(spark, out_dir, own.schema, {b: versions[b][-1]}) if versions.get(b) else None
                rows = own if before is None else first_per_key(before.unionByName(own), keys, order_by)
                rows.write.mode("overwrite").parquet(f"{out_dir}/bucket={b}/batch={number}")
                for old in versions.get(b, [])[:-1]:
                    fs, path = _fs(spark, f"{out_dir}/bucket={b}/batch={old}")
                    fs.delete(path, True)
        finally:
            batch.unpersist()

    return records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
