"""Scale smoke run: synthetic occurrence records, name candidates and scores where one key
(a species, a search name, a score value) holds a third of the rows.

Usage: python tools/scale_smoke.py SCRATCH_DIR [ROWS]

Generates the tables with Spark (deterministic, no driver data), writes them as
Parquet under SCRATCH_DIR, runs the main operators on them and reads task
durations per stage from Spark's event log (also under SCRATCH_DIR). Prints
a Markdown report: wall time per step and, per step, the stage with the
largest max/median task-time ratio (a skew indicator).
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from taxaspark.operators import dedup as D  # noqa: E402
from taxaspark.operators import geo as G  # noqa: E402
from taxaspark.operators import ranking as R  # noqa: E402
from taxaspark.operators import scoring as S  # noqa: E402
from taxaspark.plans import locality as L  # noqa: E402
from taxaspark.plans import names as N  # noqa: E402
from taxaspark.plans import predictors as P  # noqa: E402


def session(scratch: str) -> SparkSession:
    ev = os.path.join(scratch, "events")
    os.makedirs(ev, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("scale-smoke")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def generate(spark: SparkSession, rows: int, path: str) -> None:
    i = F.col("id")
    hot = (i % 3) == 0
    species = F.when(hot, F.lit("hot species")).otherwise(F.concat(F.lit("sp"), (F.abs(F.hash(i)) % 200000).cast("string")))
    has_xy = (F.abs(F.hash(i, F.lit(1))) % 10) != 0
    lat = F.when(has_xy, (F.abs(F.hash(i, F.lit(2))) % 170000).cast("double") / 1000 - 85)
    lon = F.when(has_xy, (F.abs(F.hash(i, F.lit(3))) % 360000).cast("double") / 1000 - 180)
    loc = F.when((i % 7) == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("L"), (F.abs(F.hash(i, F.lit(4))) % 5000).cast("string")))
    df = spark.range(rows, numPartitions=64).select(
        i.alias("uid"), species.alias("acceptedNameAuthor"), (1950 + i % 70).cast("int").alias("year"),
        loc.alias("locality"), F.when(hot, F.lit("US")).otherwise(F.lit("CA")).alias("countryCode"),
        F.concat(F.lit("S"), (i % 50).cast("string")).alias("stateProvince"),
        F.when((i % 4) == 0, F.lit(None).cast("string")).otherwise(F.lit("C1")).alias("county"),
        lat.alias("decimalLatitude"), lon.alias("decimalLongitude"),
        ((F.abs(F.hash(i, F.lit(5))) % 200000).cast("double")).alias("coordinateUncertaintyInMeters"))
    df.write.mode("overwrite").parquet(path)


def _event_lines(scratch: str):
    for root, _, names in os.walk(os.path.join(scratch, "events")):
        for n in sorted(names):
            if not n.startswith("events_"):
                continue
            with open(os.path.join(root, n), "rb") as raw:
                data = raw.read()
            if n.endswith(".zstd"):
                import zstandard
                data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
            yield from (line for line in data.decode("utf-8").splitlines() if line.strip())


def event_stats(scratch: str) -> tuple[dict[int, list[float]], dict[str, set[int]]]:
    """Task durations per stage, and stage ids per job group, from the event log."""
    tasks: dict[int, list[float]] = {}
    groups: dict[str, set[int]] = {}
    for line in _event_lines(scratch):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerTaskEnd":
            info = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"]) / 1000)
        elif ev == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            if g:
                groups.setdefault(g, set()).update(e["Stage IDs"])
    return tasks, groups


def main() -> None:
    scratch = sys.argv[1]
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 12_000_000
    spark = session(scratch)
    sc = spark.sparkContext
    src = os.path.join(scratch, "occs")
    steps: list[tuple[str, float]] = []

    def step(name, fn):
        sc.setJobGroup(name, name)
        t = time.perf_counter()
        fn()
        steps.append((name, round(time.perf_counter() - t, 1)))

    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    step("generate + write", lambda: generate(spark, rows, src))
    occ = spark.read.parquet(src)
    cents = spark.range(250).select(((F.abs(F.hash("id")) % 170).cast("double") - 85).alias("lat"),
                                    ((F.abs(F.hash("id", F.lit(9))) % 360).cast("double") - 180).alias("lon"))
    flagged_path = os.path.join(scratch, "flagged")
    step("flag_all (broadcast cell join, 250 points)",
         lambda: G.flag_all(occ, "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters", cents,
                            radius_m=5000.0).write.mode("overwrite").parquet(flagged_path))
    flagged = spark.read.parquet(flagged_path)
    gated = G.quality_gate(flagged)
    step("fill_by_locality (record_id)", lambda: noop(L.fill_by_locality(flagged, ["uid"], record_id="uid")))
    step("first_per_key (species)", lambda: noop(D.first_per_key(occ, ["acceptedNameAuthor"], ["uid"])))
    step("keep_unique (species, locality)", lambda: noop(D.keep_unique(occ, ["acceptedNameAuthor", "locality"])))
    step("keep_group_min (species, year)", lambda: noop(D.keep_group_min(occ, ["acceptedNameAuthor"], "year")))
    step("specimen_count", lambda: noop(P.specimen_count(gated)))
    step("contemporary_share (two first-wins passes)", lambda: noop(P.contemporary_share(gated, ["uid"])))
    species = spark.range(200_000).select(F.concat(F.lit("sp"), F.col("id").cast("string")).alias("acceptedNameAuthor"))
    species = species.unionByName(spark.createDataFrame([("hot species",)], "acceptedNameAuthor string"))
    years = species.select("acceptedNameAuthor", (1750 + F.abs(F.hash("acceptedNameAuthor")) % 250).cast("int")
                           .alias("yearPublished"))
    threat = species.filter((F.abs(F.hash("acceptedNameAuthor", F.lit(7))) % 10) == 0).select(
        "acceptedNameAuthor", (F.abs(F.hash("acceptedNameAuthor")) % 2).cast("int").alias("Threatened"))
    step("species_predictors (gate, counts, share, year, label)",
         lambda: noop(P.species_predictors(flagged, years, threat, ["uid"])))
    # name side: as many candidate rows, one search name holding a third of them
    i = F.col("id")
    h = F.abs(F.hash(i, F.lit(11)))
    cand = spark.range(rows, numPartitions=64).select(
        F.when((i % 3) == 0, F.lit("hot name")).otherwise(F.concat(F.lit("n"), (h % 500000).cast("string"))).alias("searchName"),
        (i % 100000).alias("usageKey"), F.concat(F.lit("t"), (i % 100000).cast("string")).alias("scientificName"),
        F.lit("SPECIES").alias("rank"), (50 + h % 51).cast("int").alias("confidence"),
        F.when(h % 10 == 0, F.lit("NONE")).when(h % 10 == 1, F.lit("HIGHERRANK")).otherwise(F.lit("EXACT")).alias("matchType"))
    cand_path = os.path.join(scratch, "candidates")
    step("generate candidates", lambda: cand.write.mode("overwrite").parquet(cand_path))
    cands = spark.read.parquet(cand_path)
    search = cands.select(F.col("searchName").alias("NameAuthor")).distinct()
    step("match_names (hot search name)", lambda: noop(N.match_names(search, cands)))
    # order operators: one score value holds a third of the rows
    hs = F.abs(F.hash(i, F.lit(13)))
    scores = spark.range(rows, numPartitions=64).select(
        i.alias("id"), (hs % 2).cast("int").alias("observed"),
        F.when((i % 3) == 0, F.lit(0.5)).otherwise((hs % 1000000).cast("double") / 1000000).alias("score"))
    score_path = os.path.join(scratch, "scores")
    step("generate scores", lambda: scores.write.mode("overwrite").parquet(score_path))
    sc_df = spark.read.parquet(score_path)
    step("threshold_for_fnr (hot score value)", lambda: noop(S.threshold_for_fnr(sc_df, "observed", "score", 0.05)))
    step("row_index (hot score value)", lambda: noop(R.row_index(sc_df, ["score", "id"], "index", partitions=64)))
    spark.stop()
    tasks, groups = event_stats(scratch)
    print(f"# Scale smoke: {rows:,} records, one species holds 1/3 of them (local[8], 64 shuffle partitions)\n")
    print("Task times from the Spark event log. `worst stage` is the stage (of more than 8 tasks) with the "
          "largest max / median task time: tasks, median s, max s, ratio.\n")
    print("| step | wall s | stages | tasks | worst stage |")
    print("| --- | --- | --- | --- | --- |")
    for name, wall in steps:
        sids = sorted(groups.get(name, set()) & set(tasks))
        worst = None
        for sid in sids:
            ts = tasks[sid]
            if len(ts) > 8:
                med = max(statistics.median(ts), 1e-3)
                r = max(ts) / med
                if worst is None or r > worst[3]:
                    worst = (len(ts), round(med, 2), round(max(ts), 2), round(r, 1))
        print(f"| {name} | {wall} | {len(sids)} | {sum(len(tasks[s]) for s in sids)} | {worst} |")


if __name__ == "__main__":
    main()
