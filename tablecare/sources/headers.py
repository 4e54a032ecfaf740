"""CSV files of one folder (and those below it) whose headers differ: columns united by name.

Spark's CSV scan takes the header of one file for all and reads others by
position, so a file with its columns in another order is read wrong without a
word. Here every file is read by its own header:

1. One text scan finds the first line of each file and the number of lines of each
   split (``_metadata`` gives file and split); what is kept is one row a split.
2. The distinct headers, at most ``max_headers`` of them (more raise), come to the
   driver; each gives a schema, and names are compared as ``normalized_name`` makes
   them.
3. A second scan parses each line with the schema of its file's header
   (``from_csv``) and places the values by name. A file without a column has NULL
   there. The small table of splits is broadcast up to ``BROADCAST_SPLITS`` rows and
   joined by a shuffle beyond.

Each row keeps its file and line number (the header is line 1), so a corrupt record,
which is also kept whole, can be looked up.

Defined cases: an empty file has no rows, a file with a header only neither; blank
lines are no rows but are counted; a byte-order mark is dropped; a header with two
equal names raises; records hold no line breaks (as in any CSV that can be split).
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablecare.operators.frames import normalized_name
from tablecare.session import stage_table

MAX_HEADERS = 200
BROADCAST_SPLITS = 1_000_000     # about 200 bytes each
CORRUPT = "_corrupt_record"
BOM = "﻿"


def header_names(line: str) -> list[str]:
    """Normalised column names of a header line."""
    names = [normalized_name(c.strip()) for c in next(csv.reader([line.removeprefix(BOM)]))]
    if len(set(names)) < len(names):
        raise ValueError(f"a header names a column twice: {line!r}")
    return names


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("mark"), "value")


def header_splits(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, first, before, header): per split its first mark and the lines before it."""
    splits = stage_table(_lines(spark, path).groupBy("file", "start").agg(
        F.min("mark").alias("first"), F.count(F.lit(1)).alias("lines"),
        F.min_by(F.when(F.col("start") == 0, F.col("value")), "mark").alias("line")), "splits")
    whole = Window.partitionBy("file").orderBy("start")     # one row a split of a file
    return stage_table(splits.select(
        "file", "start", "first",
        F.coalesce(F.sum("lines").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.first("line").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("header")),
        "headers")


def read_csv_by_header(spark: SparkSession, path: str, file_column: str = "source_file",
                       line_column: str = "source_line", max_headers: int = MAX_HEADERS) -> DataFrame:
    """Rows of all files: united columns (text), file, line and ``_corrupt_record``.

    Columns stand in the order in which headers name them, the header of the smallest
    file name first.
    """
    splits = header_splits(spark, path)
    found = (splits.groupBy("header").agg(F.min("file").alias("file"))
             .orderBy("file").limit(max_headers + 1).collect())
    if len(found) > max_headers:
        raise ValueError(f"more than {max_headers} different headers under {path}")
    known = {r.header: header_names(r.header) for r in found}
    columns = list(dict.fromkeys(c for names in known.values() for c in names))
    extra = {file_column, line_column, CORRUPT} & set(columns)
    if extra:
        raise ValueError(f"columns named like those added here: {sorted(extra)}")
    if splits.count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    lines = (_lines(spark, path).join(splits, ["file", "start"])
             .withColumn("line", F.col("mark") - F.col("first") + F.col("before") + 1)
             .where((F.col("line") > 1) & (F.trim("value") != "")))
    target = StructType([StructField(c, StringType()) for c in [*columns, CORRUPT]])
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = F.lit(None).cast(target)
    for header, names in known.items():
        row = F.from_csv("value", ", ".join(f"`{c}` string" for c in [*names, CORRUPT]), options)
        placed = F.struct(*[(row[c] if c in names else F.lit(None).cast("string")).alias(c) for c in columns],
                          row[CORRUPT].alias(CORRUPT))
        parsed = F.when(F.col("header") == header, placed).otherwise(parsed)
    return lines.select(parsed.alias("row"), F.col("file").alias(file_column),
                        F.col("line").alias(line_column)).select(
        *[F.col("row")[c].alias(c) for c in columns], file_column, line_column,
        F.col("row")[CORRUPT].alias(CORRUPT))
