"""Sinks: run-partitioned outputs, the "latest" copy, the warehouse table.

Every write is idempotent per run: the run's folder (``run_id`` is the outermost
partition) is replaced as a whole, other runs are left alone, and writing the
same run twice leaves one copy. Outputs are written by the executors straight
to the target file system (any Hadoop URI); nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablecare.session import fresh_dir, remove_dir
from tablecare.sources import versions
from tablecare.sources.files import (CSV_EXPORT_OPTIONS, CSV_EXPORT_READ_OPTIONS, read_runs,
                                     run_folder)

CSV_WRITE_OPTIONS = {
    "header": "true",
    # keep leading/trailing spaces: a round trip must give back the same text
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    **CSV_EXPORT_OPTIONS,
}


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str] = (),
            dynamic: bool = True):
    w = df.write.format(fmt).mode(mode)
    if not dynamic:
        w = w.option("partitionOverwriteMode", "static")
    if fmt == "csv":
        w = w.options(**CSV_WRITE_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    return w


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage where one computed table feeds several writes or reports:
    they read the staged files instead of recomputing the cleaning, and a lost
    executor costs a re-read, not a recomputation.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``stage`` with an owner: the staged files are deleted when the block ends."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_dir(spark, path)


def write_run(tagged: DataFrame, root: str, run_id: str, fmt: str = "csv",
              partition_by: Sequence[str] = ("outcome",)) -> str:
    """Write clean and quarantine rows of one run in a single pass.

    ``tagged`` carries an ``outcome`` column; rows land under
    ``run_id=<run>/outcome=<clean|quarantine>/``. The run's folder is replaced as a
    whole, so an outcome without rows leaves nothing of an earlier run behind.
    """
    _writer(tagged.drop("run_id"), fmt, "overwrite", partition_by, dynamic=False).save(run_folder(root, run_id))
    return root


def with_run_id(df: DataFrame, run_id: str) -> DataFrame:
    """``run_id`` as the last column, replacing one that is there."""
    return df.drop("run_id").withColumn("run_id", F.lit(run_id).cast("string"))


def write_latest(written: DataFrame, latest: str, fmt: str = "csv") -> str:
    """Replace the whole ``latest/`` copy with one run's rows (partitioned by outcome).

    A new version is written beside the current one and then switched to
    (``sources.versions``): readers through ``read_outputs`` see the old copy or the new one.
    """
    version = versions.write_version(written, latest, fmt, ("outcome",),
                                     CSV_WRITE_OPTIONS if fmt == "csv" else None)
    versions.commit_version(written.sparkSession, latest, version)
    return latest


def publish(tagged: DataFrame, root: str, run_id: str, fmt: str = "csv") -> tuple[str, str]:
    """Publish a run twice: into ``runs/`` (history) and as ``latest/``.

    The run is computed once, into a staged Parquet table; both copies are
    written from it, so a text passes through CSV only on its way out.
    """
    runs = f"{root}/runs"
    latest = f"{root}/latest"
    with staged(tagged, "publish") as rows:
        write_run(rows, runs, run_id, fmt)
        write_latest(with_run_id(rows, run_id), latest, fmt)
    return runs, latest


def read_outputs(spark: SparkSession, root: str, fmt: str = "csv", schema=None,
                 partition_cols: Sequence[str] = ("outcome", "run_id")) -> DataFrame:
    """Read back outputs written by ``write_run``/``publish`` (partition columns restored).

    For CSV pass the written table's ``schema``; the ``run_id`` column is
    typed as a string and kept as data where it is not a partition column. Of a
    copy with versions the current one is read.
    """
    root = versions.current_path(spark, root) or root
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_EXPORT_READ_OPTIONS)
        if schema is not None:
            fields = [f for f in schema.fields if f.name != "run_id" and f.name not in partition_cols]
            text = [StructField(c, StringType(), True) for c in dict.fromkeys([*partition_cols, "run_id"])]
            return reader.schema(StructType(fields + text)).load(root)
    return read_runs(spark, root, fmt, schema)


def load_warehouse(df: DataFrame, root: str, run_id: str, fmt: str = "parquet") -> str:
    """Load rows into a warehouse table partitioned by ``run_id``.

    Replaces that run's partition (a retried or repeated load cannot double a
    run, unlike append-and-retry).
    """
    _writer(df.drop("run_id"), fmt, "overwrite", (), dynamic=False).save(run_folder(root, run_id))
    return root


def append_jdbc(df: DataFrame, url: str, table: str, run_id: str,
                properties: dict | None = None, num_partitions: int = 8,
                batch_size: int = 10_000) -> None:
    """Append rows stamped with ``run_id`` to a database table over JDBC.

    ``num_partitions`` caps concurrent connections; rows go in batches. JDBC has no partition
    overwrite, so this call alone doubles a run that is loaded twice. The contract for a
    repeat-safe load: append into a staging table of the run's own, and let the database, in
    one transaction, delete the run from the target and insert the staged rows; then hold
    the target's run against its source with ``operators.reconcile``.
    """
    stamped = df.withColumn("run_id", F.lit(run_id).cast("string"))
    (stamped.write.format("jdbc").mode("append")
            .option("url", url).option("dbtable", table)
            .option("numPartitions", num_partitions).option("batchsize", batch_size)
            .options(**(properties or {}))
            .save())
