"""Dirty tables derived from the driver's clean tables.

``orders`` has no NULLs, blanks or copies, so the dirt is derived from it by
arithmetic on ``o_orderkey``: deterministic, the same in every engine, and its
size grows with ``orders`` (about 1.1 rows per order: every tenth order appears
twice, as an exact copy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecare.sources.files import read_parquet


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# The fixture's columns as Spark SQL (the "Spark form" of the FIXTURES.md text).
DIRTY_COLUMNS = [
    "CASE WHEN o_orderkey % 2 = 0 THEN 'o' ELSE 'O' END || o_orderkey::string AS `Order ID`",
    "CASE WHEN o_orderkey % 20 = 3 THEN '   ' WHEN o_orderkey % 20 = 13 THEN NULL"
    " ELSE '  cUSTOMER ' || o_custkey::string || ' ' END AS `Customer Name`",
    "CASE o_orderkey % 3 WHEN 0 THEN upper(o_orderpriority)"
    " WHEN 1 THEN lower(o_orderpriority) ELSE o_orderpriority END AS `Order Type`",
    "CASE WHEN o_orderkey % 25 = 7 THEN 'two' WHEN o_orderkey % 25 = 17 THEN 'High'"
    " ELSE (o_orderkey % 12)::string END AS `Risk Level`",
    "CASE o_orderkey % 7 WHEN 0 THEN date_format(o_orderdate, 'M/d/yy')"
    " WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd')"
    " WHEN 2 THEN date_format(o_orderdate, 'yyyy/MM/dd')"
    " WHEN 3 THEN date_format(o_orderdate, 'MMM d yyyy')"
    " WHEN 4 THEN date_format(o_orderdate, 'MM-dd-yyyy')"
    " WHEN 5 THEN 'not a date' ELSE '32/13/2026' END AS `Created Date`",
    "CASE WHEN o_orderkey % 30 = 20 THEN NULL ELSE CASE o_orderkey % 4"
    " WHEN 0 THEN '$' || (o_orderkey % 9 + 1)::string || ','"
    " || lpad((o_orderkey % 1000)::string, 3, '0') || '.00'"
    " WHEN 1 THEN 'USD ' || (o_orderkey % 5000)::string"
    " WHEN 2 THEN '-' || (o_orderkey % 700)::string"
    " ELSE (o_orderkey % 5000)::string END END AS `Base Price`",
    "CASE o_orderkey % 2 WHEN 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS `Status`",
]


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven messy string columns shaped like the source pipeline's raw CSV."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    copies = orders.where(F.col("o_orderkey") % F.lit(10) == F.lit(0))
    return orders.unionByName(copies).selectExpr(*DIRTY_COLUMNS)
