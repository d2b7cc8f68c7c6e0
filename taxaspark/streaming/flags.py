"""Coordinate flags on a stream of records.

The reference works on whole files only. The per-record parts of the
pipeline (flags, quality gate, exclusion of known bad records, membership
in a static species table) are projections, filters and stream-static
joins, so they run on a streaming DataFrame without state. The centroid
test is the batch form, a stream-static left join: every micro-batch is read
once. Grouped steps (first-wins dedup, counts, intervals) need the whole
table and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.geo import flag_equal, flag_near_points, flag_uncertainty, flag_zero, has_coordinates, quality_gate
from ..operators.joins import semi_join
from pyspark.sql import functions as F


def flag_stream(records: DataFrame, lat: str = "decimalLatitude", lon: str = "decimalLongitude",
                unc: str = "coordinateUncertaintyInMeters", species: DataFrame | None = None,
                species_col: str = "acceptedNameAuthor", gate: bool = True, points: DataFrame | None = None,
                radius_m: float = 1000.0) -> DataFrame:
    """Flags (zero, equal, centroid, uncertainty) and the quality gate on a streaming frame.

    ``points`` (static) are the reference points of the centroid test; without them the test
    passes every georeferenced record. ``species`` (static) keeps only records of wanted species.
    """
    out = records.withColumn("georeferenced", has_coordinates(lat, lon))
    out = flag_zero(out, lat, lon)
    out = flag_equal(out, lat, lon)
    if points is not None:
        out = flag_near_points(out, lat, lon, points, radius_m)
    else:
        out = out.withColumn("clean_tests", F.when(F.col("georeferenced"), F.lit(True)))
    out = flag_uncertainty(out, unc, lat=lat, lon=lon)
    if species is not None:
        out = semi_join(out, species, species_col)
    return quality_gate(out) if gate else out


def start_to_parquet(flagged: DataFrame, path: str, checkpoint: str, trigger_once: bool = True) -> StreamingQuery:
    """Append the flagged records to Parquet with a checkpoint (exactly-once file sink)."""
    w = flagged.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
