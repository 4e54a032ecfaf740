"""Helpers shared by the operators: reading tables, staging, and worker-side caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecare.session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with NULL text as ''; no other column of the input is read."""
    return docs.select(quoted(id_col).cast("long").alias("doc_id"),
                       F.coalesce(quoted(text_col), F.lit("")).alias("text"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = fresh_dir(df.sparkSession, f"stage-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


HOT = 1000     # a key is hot when it holds more than one in HOT of the rows: at most HOT keys


def hot_size(rows: int | None) -> int:
    """Keys with more rows than this are hot; ``rows`` is the number of all rows."""
    return max(1, -(-(rows or 0) // HOT))


def join_hot_apart(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows with one row per key, both with a flag ``hot`` that hangs on the key alone.

    The rows of hot keys stay where they are: fewer than ``HOT`` keys can be hot (see ``hot_size``),
    so their side is broadcast. All others meet by a shuffle, in which no key is large.
    """
    cold = rows.filter("NOT hot").join(keyed.filter("NOT hot").drop("hot"), keys)
    few = F.broadcast(keyed.filter("hot").drop("hot"))
    return cold.unionByName(rows.filter("hot").join(few, keys))


def flag_hot(rows: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the flag ``hot``: whether their keys are among ``hot``, fewer than ``HOT`` rows."""
    few = F.broadcast(hot.select(*keys, F.lit(True).alias("hot")))
    return rows.join(few, keys, "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


def min_partitions(df: DataFrame) -> int:
    """At least two tasks per core and the session's shuffle partitions."""
    spark = df.sparkSession
    return max(2 * spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions")))


def worker_cache(key, make: Callable):
    """A value kept for the life of a Python worker process, made on first use."""
    store = sys.modules.setdefault("_tablecare_worker", types.ModuleType("_tablecare_worker"))
    kept = store.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def held_out(id_col: Column, divisor: int, remainder: int) -> Column:
    """crc32(id as text) mod divisor = remainder; a NULL id counts as ''."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor)) == remainder
