"""The whole sequence, from raw tables to the list of confident negatives.

Every stage is written as Parquet where the reference writes a file, and the
next one reads it: plans stay as small as a stage, and a lost executor costs
at most the running one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import qcol
from ..operators.geo import flag_all
from ..operators.joins import exclude_values
from ..sources.io import write_list, write_stage
from . import checklists, locality, names, occurrences, predictors, screen
from . import constants as K

RECORD = "uniqueCombinedID"


@dataclass
class Inputs:
    """The raw tables (schemas: ``sources.schemas``)."""

    portal_checklist: DataFrame
    microfungi: DataFrame
    higher_taxa: DataFrame
    proto_checklist: DataFrame
    assessments: DataFrame
    taxonomy: DataFrame
    natureserve: DataFrame
    candidates: DataFrame
    usage: DataFrame
    synonyms: DataFrame
    portal_files: Sequence[DataFrame]
    aggregator_files: Sequence[DataFrame]
    centroids: DataFrame
    backbone: DataFrame
    portal_drops: Sequence[Sequence[str]] | None = None
    aggregator_drops: Sequence[Sequence[str]] | None = None


def _plan_text(df: DataFrame) -> str:
    """The analysed plan, whole, without the numbers that differ from run to run."""
    conf, key = df.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(key)
    conf.set(key, str(2**31 - 1))
    try:
        plan = re.sub(r"#\d+L?", "#", df._jdf.queryExecution().analyzed().toString())
        return re.sub(r"lambda (\w+?)_\d+#", r"lambda \1#", plan)
    finally:
        conf.set(key, before)


def content_print(df: DataFrame) -> str:
    """What tells one input table from another: its plan with the names, sizes and times of the files below it; of a table that is not
    made of files alone, the number of its rows and the sums of their hashes."""
    plan = _plan_text(df)
    if re.search(r"LogicalRDD|LocalRelation|Range \(", plan) or "Relation" not in plan:
        rows = [F.sum(F.xxhash64(*[F.lit(seed), *[x for c in df.columns for x in (qcol(c), qcol(c).isNull())]]).cast("decimal(38,0)")) for seed in (0, 1)]
        return f"{df.schema.simpleString()} {tuple(df.agg(F.count(F.lit(1)), *rows).first())}"
    spark = df.sparkSession
    conf, found = spark.sparkContext._jsc.hadoopConfiguration(), []
    for file in sorted(df.inputFiles()):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(file))
        stat = path.getFileSystem(conf).getFileStatus(path)
        found.append(f"{file} {stat.getLen()} {stat.getModificationTime()}")
    return "\n".join([plan, *found])


class Stages:
    """Writes stages below ``out_dir`` and hands back what was written; a stage that is done is not done again.

    A stage's print covers its name, its plan (so its constants and parameters), and the prints of the tables it
    reads: inputs by their content, earlier stages by their own prints. When a stage's rows are written,
    its print is written beside them (``_prints/<name>``). A later run skips a stage whose print is the same;
    rows without a print, or with another, are replaced. So a run that broke goes on where it broke, and a changed constant
    or input runs that stage and what follows from it. ``resume=False`` does all anew. ``nodes``: the size of each stage's plan; ``ran``: the stages
    that were written, in order.
    """

    def __init__(self, spark: SparkSession, out_dir: str, resume: bool = True) -> None:
        self.spark, self.out_dir, self.resume = spark, out_dir.rstrip("/"), resume
        self.nodes: dict[str, int] = {}
        self.ran: list[str] = []
        self._prints: dict[int, tuple[DataFrame, str]] = {}      # the frame is held, so its id stays its own

    def _print_of(self, df: DataFrame) -> str:
        if id(df) not in self._prints:
            self._prints[id(df)] = (df, hashlib.sha256(content_print(df).encode()).hexdigest())
        return self._prints[id(df)][1]

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.out_dir}/_prints/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _done(self, name: str) -> str | None:
        path, fs = self._path(name)
        if not self.resume or not fs.exists(path):
            return None
        return "".join(r[0] for r in self.spark.read.text(path.toString()).collect())

    def __call__(self, name: str, df: DataFrame, reads: Sequence[DataFrame]) -> DataFrame:
        """``df`` as stage ``name``; ``reads``: the inputs and stages that it is made of."""
        plan = _plan_text(df)
        self.nodes[name] = len(plan.strip().splitlines())
        told = hashlib.sha256("\n".join([name, df.schema.simpleString(), plan, *[self._print_of(r) for r in reads]]).encode()).hexdigest()
        path = f"{self.out_dir}/{name}"
        if self._done(name) != told:
            mark, fs = self._path(name)
            fs.delete(mark, True)                                # first: until the rows are whole there is no print
            write_stage(df, path)
            self.spark.createDataFrame([(told,)], "print string").coalesce(1).write.mode("overwrite").text(mark.toString())
            self.ran.append(name)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._prints[id(out)] = (out, told)
        return out


def run_predictors(spark: SparkSession, inputs: Inputs, out_dir: str, radius_m: float = 1000.0,
                   rogue_ids: Sequence[int] = K.ROGUE_RECORD_IDS, manual: DataFrame | None = None,
                   tiebreak: Sequence[str | Column] = (), resume: bool = True) -> tuple[DataFrame, Stages]:
    """Checklists, names, occurrences, flags, coordinates and years down to the predictor table (a stage of its own).

    With the same ``out_dir`` a run goes on where an earlier one ended (see ``Stages``).
    """
    stage = Stages(spark, out_dir, resume)
    i = inputs
    lists = [i.portal_checklist, i.microfungi, i.higher_taxa, i.proto_checklist]
    checklist = stage("checklist", checklists.combine_checklists(*lists), lists)
    redlist = stage("redlist", names.redlist_labels(i.assessments, i.taxonomy), [i.assessments, i.taxonomy])
    training = stage("training", names.assessed_species(redlist, names.natureserve_labels(i.natureserve, redlist)), [redlist, i.natureserve])
    accepted_training = stage("accepted_training", names.accepted_assessed(training, i.candidates, i.usage), [training, i.candidates, i.usage])
    threat = stage("threat", names.training_table(training, accepted_training), [training, accepted_training])
    unassessed = stage("unassessed", names.unassessed_checklist(checklist, training), [checklist, training])
    accepted_rest = stage("accepted_checklist", names.accepted_checklist(unassessed, i.candidates, i.usage), [unassessed, i.candidates, i.usage])
    filtered = stage("checklist_filtered", names.checklist_table(unassessed, accepted_rest), [unassessed, accepted_rest])
    every_name = stage("synonyms", names.synonym_map(accepted_training, accepted_rest, i.synonyms), [accepted_training, accepted_rest, i.synonyms])
    portal = stage("portal", occurrences.portal_matches(
        occurrences.portal_records(i.portal_files, i.portal_drops, tiebreak), filtered, every_name), [*i.portal_files, filtered, every_name])
    aggregator = stage("aggregator", occurrences.aggregator_records(i.aggregator_files, every_name, i.aggregator_drops),
                       [*i.aggregator_files, every_name])
    records = exclude_values(occurrences.combine_records(portal, aggregator), "id", rogue_ids)
    flagged = stage("flagged", flag_all(records, "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters",
                                        i.centroids, radius_m), [portal, aggregator, i.centroids])
    cleaned = stage("cleaned", locality.fill_by_locality(flagged, [RECORD], record_id=RECORD), [flagged])
    wanted = every_name.select(F.col("acceptedNameAuthor")).distinct()
    years = stage("years", predictors.year_published(i.backbone, wanted, manual),
                  [i.backbone, every_name, *([manual] if manual is not None else [])])
    return stage("predictors", predictors.species_predictors(cleaned, years, threat, [RECORD]), [cleaned, years, threat]), stage


def run_pipeline(spark: SparkSession, inputs: Inputs, out_dir: str, n_draws: int = 4000, draws: DataFrame | None = None,
                 prior_sd=None, manual: DataFrame | None = None, **options) -> tuple[screen.Screening, Stages]:
    """``run_predictors``, then the screening; the confident list is written as CSV (``out_dir/confident_negatives``)."""
    table, stage = run_predictors(spark, inputs, out_dir, manual=predictors.manual_years(spark) if manual is None else manual, **options)
    result = screen.screen_species(table, n_draws=n_draws, prior_sd=prior_sd, draws=draws)
    write_list(result.confident, f"{stage.out_dir}/confident_negatives")
    return result, stage
