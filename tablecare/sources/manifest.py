"""Run manifests: what files a run has, their rows, and each column's least and greatest value.

One manifest row per file, kept under ``<root>/_manifest/run_id=<run>``. A reader
of one run opens that folder and the files it names and lists nothing else; a
range on a column leaves out the files that cannot hold it.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

from tablecare.sources.files import run_folder

MANIFESTS = "_manifest"
NO_ORDER = (ArrayType, MapType, StructType, BinaryType)


def manifest_folder(root: str, run_id: str) -> str:
    return run_folder(f"{root}/{MANIFESTS}", run_id)


def write_manifest(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """Describe the files of a Parquet run (one read of the run); replaces its manifest."""
    rows = spark.read.parquet(run_folder(root, run_id))
    ordered = [f.name for f in rows.schema.fields if not isinstance(f.dataType, NO_ORDER)]
    ends = [F.struct(*[fn(F.col(f"`{c}`")).alias(c) for c in ordered]).alias(name)
            for name, fn in (("low", F.min), ("high", F.max))]
    found = rows.groupBy(F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), *(ends if ordered else []))
    # one row per file
    found.coalesce(1).write.mode("overwrite").parquet(manifest_folder(root, run_id))
    return read_manifest(spark, root, run_id)


def read_manifest(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.parquet(manifest_folder(root, run_id))


def files_of(spark: SparkSession, root: str, run_id: str,
             ranges: Mapping[str, tuple] | None = None) -> list[str]:
    """Files of the run that may hold rows within all ``ranges`` (column: least and greatest
    wanted value, None for open). NULLs are in no range."""
    keep = F.lit(True)
    for c, (low, high) in (ranges or {}).items():
        if low is not None:
            keep = keep & (F.col("high")[c] >= F.lit(low))
        if high is not None:
            keep = keep & (F.col("low")[c] <= F.lit(high))
    manifest = read_manifest(spark, root, run_id)
    # Spark reports a file as a URI, with its special characters escaped
    return [unquote(r["file"]) for r in manifest.where(keep).select("file").orderBy("file").collect()]


def read_run_rows(spark: SparkSession, root: str, run_id: str,
                  ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    """Rows of one run within ``ranges``, from the files that its manifest names."""
    found = files_of(spark, root, run_id, ranges)
    folder = run_folder(root, run_id)
    if not found:
        rows = spark.read.parquet(folder).where(F.lit(False))
    else:
        rows = spark.read.option("basePath", folder).parquet(*found)
    for c, (low, high) in (ranges or {}).items():
        if low is not None:
            rows = rows.where(F.col(f"`{c}`") >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(f"`{c}`") <= F.lit(high))
    return rows.withColumn("run_id", F.lit(run_id))
