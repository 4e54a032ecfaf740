"""Sources: raw CSV scans and reads of one run of a run-partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablecare.sources import versions

CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",          # a leading byte-order mark is dropped from the first header
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# How this library's own CSV exports quote: a text with quotes, backslashes or line
# breaks reads back as it was written. Such files are read whole, not in splits.
CSV_EXPORT_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}
# An unquoted empty cell is NULL and reads as this stand-in, so that "" stays an empty text.
CSV_EXPORT_READ_OPTIONS = {**CSV_OPTIONS, **CSV_EXPORT_OPTIONS, "nullValue": "\u0000"}


# Fixed value: characters that partition paths escape.
PATH_SPECIAL = "\"#%'*/:=?\\{[]^\x7f"


def run_folder(root: str, run_id: str) -> str:
    """Folder of one run; special characters are escaped the way Spark reads them back."""
    name = "".join(f"%{ord(c):02X}" if c < " " or c in PATH_SPECIAL else c for c in run_id)
    return f"{root}/run_id={name}"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows to ``partitions`` tasks, only where asked for (one file that cannot be split)."""
    return df if partitions is None else df.repartition(partitions)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, corrupt_column: str | None = None, **options) -> DataFrame:
    """Scan CSV files with a header.

    Prefer an explicit ``schema`` (no inference pass over the data; messy
    columns stay strings and are cast by ``try_*`` steps). With
    ``corrupt_column`` a ragged line is kept whole in that column instead of
    being cut silently. ``infer=True`` reproduces header-and-type inference.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    if schema is not None:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        if corrupt_column:
            schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_runs(spark: SparkSession, root: str, fmt: str = "parquet",
              schema: StructType | None = None) -> DataFrame:
    """A table partitioned by ``run_id``; run ids are strings, never guessed to be numbers or dates."""
    def reader():
        r = spark.read.format(fmt)
        return r.options(**CSV_EXPORT_READ_OPTIONS) if fmt == "csv" else r

    fields = (schema or reader().load(root).schema).fields
    text = StructType([f for f in fields if f.name != "run_id"]
                      + [StructField("run_id", StringType(), True)])
    return reader().schema(text).load(root)


def read_run(spark: SparkSession, root: str, run_id: str, fmt: str = "parquet",
             schema: StructType | None = None) -> DataFrame:
    """Rows of one run from a table partitioned by ``run_id``.

    The run's own folder is opened, so no other run is listed. A run that is not there has no
    rows; only then, and without a ``schema``, is the table listed for its columns.
    """
    folder = run_folder(root, run_id)
    known = versions.exists(spark, folder)
    if not known and schema is None:
        return read_runs(spark, root, fmt).where(F.col("run_id") == F.lit(run_id))
    fields = [f for f in schema.fields if f.name != "run_id"] if schema is not None else None
    if not known:
        return spark.createDataFrame([], StructType([*fields, StructField("run_id", StringType(), True)]))
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_EXPORT_READ_OPTIONS)
    if fields is not None:
        reader = reader.schema(StructType(fields))
    return reader.load(folder).withColumn("run_id", F.lit(run_id).cast("string"))
