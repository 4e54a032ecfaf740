"""Clean / quarantine split of a flagged table.

A row goes to quarantine when any required column is NULL or its duplicate
flag is set; clean rows are the exact complement (the condition is never NULL,
so no row is lost or counted twice). The split is one boolean expression, so
both halves, their counts and an ``outcome`` column come from one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecare.functions.columns import any_null

CLEAN = "clean"
QUARANTINE = "quarantine"


def missing_required(required: Sequence[str]) -> Column:
    """The null check: True when any required column is NULL."""
    return any_null([f"`{c}`" for c in required])


def _is_set(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(False))


def quarantine_condition(required: Sequence[str], flag: str | None = "duplicate_row",
                         rejects: Sequence[str] = ()) -> Column:
    cond = missing_required(required)
    for name in [*([] if flag is None else [flag]), *rejects]:
        cond = cond | _is_set(name)
    return cond


def null_check(df: DataFrame, required: Sequence[str], out: str = "missing_required") -> DataFrame:
    """Add a boolean column telling whether a required value is missing."""
    unknown = set(required) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown required columns: {sorted(unknown)}")
    return df.withColumn(out, missing_required(required))


def failed_checks(required: Sequence[str], flag: str | None = "duplicate_row",
                  rejects: Sequence[str] = ()) -> Column:
    """How many checks a row fails (NULL required values, duplicate flag, ``rejects``).

    The split filters on this count rather than on the boolean condition. As
    a conjunction (``a IS NOT NULL AND b IS NOT NULL AND NOT dup``) Catalyst
    would push each ``IS NOT NULL`` under the cleaning projection and evaluate
    the cleaning expressions twice (once in the pushed filter, once in the
    projection); a single count that depends on the duplicate flag stays above
    the duplicate join, where the cleaned values already exist.
    """
    n = F.lit(0)
    for c in required:
        n = n + F.col(f"`{c}`").isNull().cast("int")
    for name in [*([] if flag is None else [flag]), *rejects]:
        n = n + _is_set(name).cast("int")
    return n


def quarantine_rows(df: DataFrame, required: Sequence[str], flag: str | None = "duplicate_row",
                    rejects: Sequence[str] = ()) -> DataFrame:
    return df.where(failed_checks(required, flag, rejects) > F.lit(0))


def clean_rows(df: DataFrame, required: Sequence[str], flag: str | None = "duplicate_row",
               rejects: Sequence[str] = ()) -> DataFrame:
    return df.where(failed_checks(required, flag, rejects) == F.lit(0))


def reasons(required: Sequence[str], flag: str | None = "duplicate_row",
            rejects: Sequence[str] = ()) -> Column:
    """Why a row is quarantined: ``missing:<column>`` per NULL required column, ``duplicate``
    when flagged and the name of each reject column that is set. Empty for clean rows."""
    parts = [F.when(F.col(f"`{c}`").isNull(), F.lit(f"missing:{c}")) for c in required]
    if flag is not None:
        parts.append(F.when(F.coalesce(F.col(f"`{flag}`"), F.lit(False)), F.lit("duplicate")))
    parts += [F.when(_is_set(name), F.lit(name)) for name in rejects]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def with_outcome(df: DataFrame, required: Sequence[str], flag: str | None = "duplicate_row",
                 out: str = "outcome", rejects: Sequence[str] = ()) -> DataFrame:
    """Tag each row ``clean`` or ``quarantine`` (for one partitioned write of both)."""
    return df.withColumn(out, F.when(quarantine_condition(required, flag, rejects), F.lit(QUARANTINE))
                                .otherwise(F.lit(CLEAN)))


def split_summary(df: DataFrame, required: Sequence[str], flag: str | None = "duplicate_row",
                  rejects: Sequence[str] = ()) -> DataFrame:
    """One row: total, clean and quarantine row counts, in a single aggregate."""
    q = quarantine_condition(required, flag, rejects)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(~q).alias("clean_rows"),
                  F.count_if(q).alias("quarantine_rows"))
