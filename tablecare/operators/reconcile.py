"""Load reconciliation by content: which rows a load lost, gained or changed.

Counts and averages agree where one row was lost and another doubled, or two
values were swapped. Here both tables are reduced to one row per hash bucket
(rows, exclusive-or and sums of two row hashes), whatever their order or files;
only rows of buckets that differ are then compared by value. An equal table
costs two narrow aggregates and nothing else is shuffled.

Copies count: a row that is there twice on one side and once on the other
differs. NULLs are equal to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecare.operators.duplicates import fingerprint

BUCKETS = 4096
SUMS = ["rows", "one_xor", "two_xor", "two_low", "two_high"]


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(fingerprint(columns), F.lit(buckets)).cast("int")


def table_fingerprint(df: DataFrame, buckets: int = BUCKETS,
                      columns: list[str] | None = None) -> DataFrame:
    """One row per bucket in use: an order-independent digest of the multiset of rows.

    It can be stored with a run and held against a later load without its source.
    """
    columns = list(columns or df.columns)
    hashed = df.select(_bucket(columns, buckets).alias("bucket"), fingerprint(columns).alias("one"),
                       fingerprint(columns, seed=1).alias("two"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("one").alias("one_xor"),
        F.bit_xor("two").alias("two_xor"),
        # halves, so that a sum of 2^31 rows fits
        F.sum(F.col("two").bitwiseAND(F.lit(0xFFFFFFFF))).alias("two_low"),
        F.sum(F.shiftrightunsigned("two", 32)).alias("two_high"))


def differing_buckets(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Buckets whose digests differ, from two ``table_fingerprint`` results."""
    e, a = expected.alias("e"), actual.alias("a")
    same = F.lit(True)
    for c in SUMS:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))
    return (e.join(a, F.col("e.bucket") == F.col("a.bucket"), "full").where(~same)
            .select(F.coalesce("e.bucket", "a.bucket").alias("bucket")))


def reconcile(expected: DataFrame, actual: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Every row whose number of copies differs: its columns, expected_copies, actual_copies.

    Both tables need the same columns (any order). No rows: the load holds exactly what it should.
    """
    columns = expected.columns
    if set(columns) != set(actual.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(actual.columns))}")
    actual = actual.select(*[F.col(f"`{c}`").cast(expected.schema[c].dataType).alias(c) for c in columns])
    # at most ``buckets`` numbers
    wrong = F.broadcast(differing_buckets(table_fingerprint(expected, buckets),
                                          table_fingerprint(actual, buckets)))

    def suspects(df: DataFrame, here: int, there: int) -> DataFrame:
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                         _bucket(columns, buckets).alias("bucket"))
        return rows.join(wrong, "bucket", "left_semi").select(
            "row", F.lit(here).alias("expected"), F.lit(there).alias("actual"))

    both = suspects(expected, 1, 0).unionByName(suspects(actual, 0, 1))
    return (both.groupBy("row").agg(F.sum("expected").alias("expected_copies"),
                                    F.sum("actual").alias("actual_copies"))
            .where("expected_copies <> actual_copies")
            .select("row.*", "expected_copies", "actual_copies"))
