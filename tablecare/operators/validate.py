"""Load validation and run summaries over run-partitioned tables.

The validation filter on ``run_id`` reaches the scan as a partition filter, so
checking one run reads only that run's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecare.operators.split import CLEAN, QUARANTINE

# The validation query as parameterised SQL (``:run_id`` is bound, not pasted).
VALIDATION_SQL = """
SELECT COUNT(*)                        AS clean_rows,
       COUNT(DISTINCT {type_col})      AS distinct_types,
       COUNT(DISTINCT {status_col})    AS distinct_statuses,
       ROUND(AVG({price_col}), 2)      AS average_price
FROM {{table}}
WHERE run_id = :run_id
"""


def validate_load(table: DataFrame, run_id: str, type_col: str, status_col: str,
                  price_col: str) -> DataFrame:
    """Row count, distinct types and statuses (NULL not counted), rounded mean price."""
    one = table.where(F.col("run_id") == F.lit(run_id))
    return one.agg(F.count(F.lit(1)).alias("clean_rows"),
                   F.count_distinct(F.col(f"`{type_col}`")).alias("distinct_types"),
                   F.count_distinct(F.col(f"`{status_col}`")).alias("distinct_statuses"),
                   F.round(F.avg(F.col(f"`{price_col}`")), 2).alias("average_price"))


def validate_load_sql(spark: SparkSession, table: DataFrame, run_id: str, type_col: str,
                      status_col: str, price_col: str) -> DataFrame:
    """The same check as SQL text with a bound ``:run_id`` parameter."""
    text = VALIDATION_SQL.format(type_col=f"`{type_col}`", status_col=f"`{status_col}`",
                                 price_col=f"`{price_col}`")
    return spark.sql(text, args={"run_id": run_id}, table=table)


def run_summary(outputs: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Per run: clean and quarantine row counts, from the written outputs."""
    o = F.col(outcome)
    return (outputs.groupBy("run_id")
                   .agg(F.count_if(o == F.lit(CLEAN)).alias("clean_rows"),
                        F.count_if(o == F.lit(QUARANTINE)).alias("quarantine_rows")))
