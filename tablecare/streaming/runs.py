"""The run applied to raw files as they arrive (Structured Streaming).

Each micro-batch of new CSV files becomes one run, with a run id derived from
the batch id. The batch id is stable across restarts (the stream checkpoint
records which files each batch took), and every sink replaces its run's
partitions, so a batch replayed after a failure rewrites the same run instead
of adding to it. Duplicates are judged within a run, as for a batch run over
one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablecare.plans.run import RunLayout, run_table
from tablecare.plans.spec import Spec
from tablecare.sources.files import CSV_OPTIONS


def batch_run_id(batch_id: int, prefix: str = "batch") -> str:
    return f"{prefix}_{batch_id:08d}"


def start_run_stream(spark: SparkSession, source_dir: str, schema: StructType, spec: Spec,
                     layout: RunLayout, checkpoint_location: str, type_col: str,
                     status_col: str, price_col: str, files_per_run: int = 1,
                     available_now: bool = True, prefix: str = "batch") -> StreamingQuery:
    """Start a file stream whose every micro-batch is written as one run.

    ``checkpoint_location`` must be on the shared file system. With
    ``available_now`` the stream takes the files present at start and stops;
    otherwise it keeps watching ``source_dir``.
    """
    source = (spark.readStream.schema(schema).options(**CSV_OPTIONS)
                   .option("maxFilesPerTrigger", files_per_run).csv(source_dir))

    def each(batch: DataFrame, batch_id: int) -> None:
        run_table(batch, spec, layout, batch_run_id(batch_id, prefix),
                  type_col, status_col, price_col, report=False).collect()

    writer = (source.writeStream.foreachBatch(each)
                    .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
