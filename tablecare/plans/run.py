"""End-to-end run: clean, split, write every output, load, validate, summarise.

One run computes the cleaned and tagged table once, into a staged Parquet table
in the shared folder (split counts are taken by an ``Observation`` during that
write). The run outputs, the latest copy, the warehouse load and the report's
after-profile read the staged table: nothing is recomputed, and CSV is an export
only. The staged files are deleted when the run ends. The report's
before-profile is one more aggregate over the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablecare.operators.profile import profile_diff
from tablecare.operators.split import CLEAN, QUARANTINE, with_outcome
from tablecare.operators.validate import validate_load
from tablecare.plans.spec import Spec
from tablecare.sources import sinks
from tablecare.sources.files import read_runs


@dataclass(frozen=True)
class RunLayout:
    """Where a run writes: ``<root>/runs``, ``<root>/latest``, ``<root>/warehouse``,
    ``<root>/reports``. ``root`` must be on a file system every executor sees."""

    root: str
    fmt: str = "csv"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    @property
    def latest(self) -> str:
        return f"{self.root}/latest"

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


def run_table(raw: DataFrame, spec: Spec, layout: RunLayout, run_id: str,
              type_col: str, status_col: str, price_col: str,
              report: bool = True) -> DataFrame:
    """Run the whole cleaning job for one run id and return a one-row summary.

    Re-running the same ``run_id`` replaces that run everywhere (outputs,
    warehouse, report) and leaves other runs alone. A load that does not hold
    the run's clean rows raises.
    """
    required, flag = spec.required(), spec.flag()
    spark = raw.sparkSession
    tagged = with_outcome(spec.apply(raw), required, flag, rejects=spec.rejects())
    obs = Observation()
    observed = tagged.observe(obs, F.count(F.lit(1)).alias("total_rows"),
                              F.count_if(F.col("outcome") == F.lit(CLEAN)).alias("clean_rows"),
                              F.count_if(F.col("outcome") == F.lit(QUARANTINE)).alias("quarantine_rows"))
    # The one pass that computes the cleaning, counted while it is written. (The
    # report's before-profile reads the raw input once more.)
    with sinks.staged(observed, "run") as rows:
        counts = obs.get
        sinks.write_run(rows, layout.runs, run_id, layout.fmt)
        sinks.write_latest(sinks.with_run_id(rows, run_id), layout.latest, layout.fmt)
        clean = rows.where(F.col("outcome") == F.lit(CLEAN)).drop("outcome", "run_id")
        sinks.load_warehouse(clean, layout.warehouse, run_id)
        if report:
            diff = profile_diff(raw, clean)
            diff.write.mode("overwrite").parquet(sinks.run_folder(layout.reports, run_id))

    table = read_runs(spark, layout.warehouse)
    checked = validate_load(table, run_id, type_col, status_col, price_col)
    summary = checked.select(
        F.lit(run_id).alias("run_id"),
        F.lit(counts["total_rows"]).cast("bigint").alias("total_rows"),
        F.lit(counts["clean_rows"]).cast("bigint").alias("clean_rows"),
        F.lit(counts["quarantine_rows"]).cast("bigint").alias("quarantine_rows"),
        "distinct_types", "distinct_statuses", "average_price",
        (F.col("clean_rows") == F.lit(counts["clean_rows"])).alias("load_complete"),
    )
    row = summary.first()                              # one row
    if not row["load_complete"]:
        raise RuntimeError(f"load of run {run_id!r} is not complete: {row}")
    return spark.createDataFrame([tuple(row)], summary.schema)
