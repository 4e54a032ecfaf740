"""Runs whose duplicates are judged over all files that have come so far.

A ledger holds, per run, the 128-bit identity of every row that can be a
duplicate and whether it is flagged yet: 17 bytes a row, no values. A new run

1. flags its rows that are copies of each other or of a row in any other run;
2. writes its typed rows as a new version (``sources.versions``), and from it
   its outputs and warehouse partition;
3. corrects earlier runs that hold a first copy, not flagged until now: they
   get a new version, outputs and partition, once per identity in its life;
4. writes its ledger last, after those of the corrected runs.

Each step replaces what belongs to one run, reads only committed versions and
leaves the run's own ledger entries out, so a run that is repeated after a
failure at any point ends the same. Equality is that of the identity; two
different rows share one with a probability of about rows^2 / 2^129.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablecare.functions.columns import all_not_null
from tablecare.operators.duplicates import IDENTITY, fingerprint
from tablecare.operators.split import CLEAN, with_outcome
from tablecare.plans.run import RunLayout
from tablecare.plans.spec import Spec
from tablecare.session import stage_table
from tablecare.sources import sinks, versions
from tablecare.sources.files import CSV_OPTIONS, run_folder
from tablecare.streaming.runs import batch_run_id

LEDGER = f"{IDENTITY[0]} bigint, {IDENTITY[1]} bigint, flagged boolean"


def _flag_step(spec: Spec):
    return next(s for s in spec.steps if s.name == "flag_duplicates")


def _marked(rows: DataFrame, spec: Spec) -> DataFrame:
    """Rows with their identity; NULL flag-eligibility follows the step's ``null_safe``."""
    step, flag = _flag_step(spec), spec.flag()
    keys = list(step.columns) or [c for c in rows.columns if c != flag]
    counts = F.lit(True) if step.options.get("null_safe") else all_not_null([f"`{k}`" for k in keys])
    return rows.withColumns({IDENTITY[0]: fingerprint(keys), IDENTITY[1]: fingerprint(keys, seed=1),
                             "__counted": counts})


def _rows_root(layout: RunLayout, run_id: str) -> str:
    return run_folder(f"{layout.root}/rows", run_id)


def _ledger(spark: SparkSession, layout: RunLayout) -> DataFrame | None:
    root = f"{layout.root}/ledger"
    if not versions.exists(spark, root):
        return None
    return spark.read.schema(f"{LEDGER}, run_id string").parquet(root)


def _write(rows: DataFrame, spec: Spec, layout: RunLayout, run_id: str) -> None:
    """A new version of the run's rows, and all that is made from it."""
    spark, root = rows.sparkSession, _rows_root(layout, run_id)
    versions.commit_version(spark, root, versions.write_version(rows, root))
    kept = spark.read.schema(rows.schema).parquet(versions.current_path(spark, root))
    tagged = with_outcome(kept, spec.required(), spec.flag(), rejects=spec.rejects())
    sinks.write_run(tagged, layout.runs, run_id, layout.fmt)
    sinks.load_warehouse(tagged.where(F.col("outcome") == F.lit(CLEAN)).drop("outcome"),
                         layout.warehouse, run_id)


def _write_ledger(rows: DataFrame, spec: Spec, layout: RunLayout, run_id: str) -> None:
    (_marked(rows, spec).where("__counted").groupBy(*IDENTITY)
     .agg(F.max(F.col(f"`{spec.flag()}`")).alias("flagged"))
     .write.mode("overwrite").parquet(run_folder(f"{layout.root}/ledger", run_id)))


def _flag_these(rows: DataFrame, spec: Spec, ids: DataFrame) -> DataFrame:
    """``rows`` with the flag set where the identity is among ``ids`` as well."""
    flag, names = spec.flag(), rows.columns
    hit = ids.select(*IDENTITY).distinct().withColumn("__hit", F.lit(True))
    found = _marked(rows, spec).join(hit, IDENTITY, "left")
    more = F.col(f"`{flag}`") | (F.col("__counted") & F.col("__hit").isNotNull())
    return found.withColumn(flag, more).select(*[F.col(f"`{c}`") for c in names])


def run_across(raw: DataFrame, spec: Spec, layout: RunLayout, run_id: str) -> list[str]:
    """Run one file batch; returns the earlier runs that it corrected."""
    spark = raw.sparkSession
    rows = spec.apply(raw)                                  # copies within the run are flagged
    ledger = _ledger(spark, layout)
    touched: list[str] = []
    if ledger is not None:
        mine = _marked(rows, spec).where("__counted").select(*IDENTITY).distinct()
        seen = stage_table(ledger.where(F.col("run_id") != F.lit(run_id))
                           .join(mine, IDENTITY, "left_semi"), "seen")
        rows = _flag_these(rows, spec, seen)
        touched = [r["run_id"] for r in seen.where("NOT flagged").select("run_id").distinct()
                   .orderBy("run_id").collect()]            # names of runs, no rows
    _write(rows, spec, layout, run_id)
    rows = spark.read.schema(rows.schema).parquet(
        versions.current_path(spark, _rows_root(layout, run_id)))
    for other in touched:
        path = versions.current_path(spark, _rows_root(layout, other))
        earlier = spark.read.schema(rows.schema).parquet(path)
        corrected = _flag_these(earlier, spec, seen.where(F.col("run_id") == F.lit(other)))
        _write(corrected, spec, layout, other)
        again = versions.current_path(spark, _rows_root(layout, other))
        _write_ledger(spark.read.schema(rows.schema).parquet(again), spec, layout, other)
    _write_ledger(rows, spec, layout, run_id)
    return touched


def start_ledger_stream(spark: SparkSession, source_dir: str, schema: StructType, spec: Spec,
                        layout: RunLayout, checkpoint_location: str, files_per_run: int | None = 1,
                        available_now: bool = True, prefix: str = "batch") -> StreamingQuery:
    """A file stream whose micro-batches are runs judged against all runs before them.

    ``files_per_run=None`` takes all files that are there as one run, however many they are.
    """
    if spec.flag() is None:
        raise ValueError("the spec has no flag_duplicates step")
    if _flag_step(spec).options.get("keep", "none") != "none":
        raise ValueError("a ledger flags all copies of all runs; keep is for one table")
    limit = {} if files_per_run is None else {"maxFilesPerTrigger": files_per_run}
    source = spark.readStream.schema(schema).options(**CSV_OPTIONS, **limit).csv(source_dir)
    writer = (source.writeStream.option("checkpointLocation", checkpoint_location)
              .foreachBatch(lambda batch, n: run_across(batch, spec, layout, batch_run_id(n, prefix))
                            and None))
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
