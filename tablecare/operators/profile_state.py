"""Mergeable profiles: the profile of many runs from one small row per run and column.

A run's state holds exact counts (rows, NULLs, blanks) and a HyperLogLog sketch
of the distinct values. States are stored once per run and merged by sums and
sketch unions, so profiling N runs reads N small tables and no data. Counts stay
exact; the distinct count is an estimate with a standard error of about
1.04 / sqrt(2^lg_k) (0.8 % at the default), NULL counted as one value exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StringType, TimestampType)

from tablecare.sources.files import run_folder

LG_K = 14
STATE = "run_id string, column string, schema string, rows bigint, null_count bigint, " \
        "blank_count bigint, sketch binary"


def _sketched(name: str, kind) -> Column:
    """The value as one of the types that sketches take, equal where values are equal."""
    c = F.col(f"`{name}`")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, (BooleanType, ByteType, ShortType, IntegerType, LongType)):
        return c.cast("bigint")
    if isinstance(kind, (FloatType, DoubleType)):
        return (c.cast("double") + F.lit(0.0)).cast("string")       # one zero
    return c.cast("string")


def profile_state(df: DataFrame, run_id: str, lg_k: int = LG_K) -> DataFrame:
    """One row per column, in one pass; partial sketches merge map-side."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        blank = (F.count_if(F.trim(c) == F.lit("")) if isinstance(f.dataType, StringType)
                 else F.lit(None).cast("bigint"))
        cells.append(F.struct(
            F.lit(run_id).alias("run_id"), F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("schema"), F.count(F.lit(1)).alias("rows"),
            F.count_if(c.isNull()).alias("null_count"), blank.alias("blank_count"),
            F.hll_sketch_agg(_sketched(f.name, f.dataType), lg_k).alias("sketch")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def save_state(df: DataFrame, root: str, run_id: str, lg_k: int = LG_K) -> str:
    """Store a run's state under ``root``, replacing an earlier one of the same run."""
    path = run_folder(root, run_id)
    profile_state(df, run_id, lg_k).drop("run_id").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def read_states(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(root)


def merge_states(states: DataFrame) -> DataFrame:
    """column, schema, rows, null_count, blank_count, distinct_estimate over all runs given."""
    return states.groupBy("column", "schema").agg(
        F.sum("rows").alias("rows"), F.sum("null_count").alias("null_count"),
        F.sum("blank_count").alias("blank_count"),
        (F.hll_sketch_estimate(F.hll_union_agg("sketch"))
         + F.max((F.col("null_count") > 0).cast("bigint"))).alias("distinct_estimate"))
