"""Column profiles and findings, each in one aggregate over the table.

The source pipeline ran one Spark job per metric per column (33 jobs for a raw
seven-column table). Here one scan gives all: each row becomes narrow
(column number, value) pairs, which are counted per distinct value map-side; the
counts of distinct values, shuffled once by (column, value), give rows, NULLs,
blanks and distinct values of every column by a second, partial count. Nothing
is copied per column but the value itself, blanks are tested once per distinct
value, and a hot value is one pair a task. Values keep a type that tells equal
from unequal (text, long, double); columns of nested types are counted by the
distinct aggregate. ``approx=True`` switches to HyperLogLog++ sketches, which
need no pairs, for very wide tables.

Two notions of distinct are kept apart: the profile counts NULL as one more
value (``SELECT DISTINCT`` semantics), the load validation does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType,
                               DoubleType, FloatType, IntegerType, LongType, MapType, ShortType,
                               StringType, StructType, TimestampType)

from tablecare.operators.frames import normalized_name

PROFILE_COLUMNS = ["column", "schema", "null_count", "blank_count", "distinct_count"]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def distinct_with_null(c: Column, approx: bool = False, rsd: float = 0.01) -> Column:
    """Distinct values of ``c`` with NULL counted as one value when present."""
    base = F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    return base + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0)).cast("bigint")


def _metrics(df: DataFrame, approx: bool) -> list[Column]:
    out = []
    for f in df.schema.fields:
        c = _q(f.name)
        blank = (F.count_if(F.trim(c) == F.lit("")) if isinstance(f.dataType, StringType)
                 else F.lit(None).cast(LongType()))
        out.append(F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("schema"),
            F.count_if(c.isNull()).alias("null_count"),
            blank.alias("blank_count"),
            distinct_with_null(c, approx).alias("distinct_count"),
        ))
    return out


def _wide(df: DataFrame, approx: bool) -> DataFrame:
    """One row: ``rows`` and an array with one profile struct per column."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.array(*_metrics(df, approx)).alias("cols"))


NESTED = (ArrayType, StructType, MapType)
VALUE = "struct<text: string, whole: bigint, real: double>"


def _value(name: str, kind: DataType) -> Column:
    """The value in the one field of ``VALUE`` that keeps equal apart from unequal."""
    c, field = _q(name), "text"
    if isinstance(kind, DateType):
        c, field = F.unix_date(c).cast("bigint"), "whole"
    elif isinstance(kind, TimestampType):
        c, field = F.unix_micros(c), "whole"
    elif isinstance(kind, (BooleanType, ByteType, ShortType, IntegerType, LongType)):
        c, field = c.cast("bigint"), "whole"
    elif isinstance(kind, (FloatType, DoubleType)):
        c, field = c.cast("double"), "real"
    elif isinstance(kind, BinaryType):
        c = F.hex(c)
    parts = {"text": F.lit(None).cast("string"), "whole": F.lit(None).cast("bigint"),
             "real": F.lit(None).cast("double")} | {field: c.cast("string") if field == "text" else c}
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def per_column(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """rows, column, schema, null_count, blank_count, distinct_count; one row per column."""
    wanted = [f for f in df.schema.fields if columns is None or f.name in set(columns)]
    if approx or not wanted:
        return _wide(df.select(*[_q(f.name) for f in wanted]), approx).select("rows", F.inline("cols"))
    nested = [f for f in wanted if isinstance(f.dataType, NESTED)]
    flat = [f for f in wanted if f not in nested]
    out = None
    if flat:
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("k"), _value(f.name, f.dataType).alias("v"))
            for k, f in enumerate(flat)]))).select("k", "v.*")
        values = pairs.groupBy("k", "text", "whole", "real").agg(F.count(F.lit(1)).alias("n"))
        no_value = F.col("text").isNull() & F.col("whole").isNull() & F.col("real").isNull()
        counts = values.groupBy("k").agg(
            F.sum("n").alias("rows"), F.sum(F.when(no_value, F.col("n"))).alias("null_count"),
            F.sum(F.when(F.trim("text") == F.lit(""), F.col("n"))).alias("blank_count"),
            F.count(F.lit(1)).alias("distinct_count"))
        # one row, bounded by the column count, so that an empty table has its columns too
        found = counts.agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct(
            "rows", "null_count", "blank_count", "distinct_count")))).alias("of"))
        n = lambda k, c: F.coalesce(F.col("of")[k][c], F.lit(0).cast("bigint")).alias(c)
        out = found.select(F.inline(F.array(*[F.struct(
            n(k, "rows"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("schema"),
            n(k, "null_count"),
            (n(k, "blank_count") if isinstance(f.dataType, StringType)
             else F.lit(None).cast("bigint").alias("blank_count")),
            n(k, "distinct_count")) for k, f in enumerate(flat)])))
    if nested:
        wide = _wide(df.select(*[_q(f.name) for f in nested]), False).select("rows", F.inline("cols"))
        out = wide if out is None else out.unionByName(wide)
    return out


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: name, type, NULLs, blanks (strings only), distinct values."""
    return per_column(df, approx=approx).select(*PROFILE_COLUMNS)


def row_count(df: DataFrame) -> DataFrame:
    """The row count as a one-row DataFrame (errors raise; nothing reads as 0)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """One row per column with its distinct count (NULL counted as a value)."""
    unknown = set(columns or ()) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return per_column(df, columns, approx).select("column", "distinct_count")


def duplicate_ids(df: DataFrame, id_column: str) -> DataFrame:
    """Rows, distinct ids (NULL counted) and the surplus ``rows - distinct ids``."""
    c = _q(id_column)
    return (df.agg(F.count(F.lit(1)).alias("rows"), distinct_with_null(c).alias("distinct_ids"))
              .withColumn("duplicate_ids", F.col("rows") - F.col("distinct_ids")))


def findings(df: DataFrame, id_column: str | None = None,
             watch_columns: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Warnings and notes as rows ``(severity, column, metric, value)``.

    * ``duplicate_ids`` on the id column: WARNING when above 0, else OK;
    * ``null_count`` per column with NULLs: WARNING;
    * ``distinct_count`` per watched column present in the table: INFO.

    All of it comes from the same single pass as ``profile``.
    """
    per_col = per_column(df, approx=approx)

    def finding(severity: Column, metric: str, value: Column) -> Column:
        return F.struct(severity.alias("severity"), F.col("column").alias("column"),
                        F.lit(metric).alias("metric"), value.cast("bigint").alias("value"))

    parts = []
    if id_column is not None:
        if id_column not in df.columns:
            raise ValueError(f"unknown id column {id_column!r}")
        surplus = F.col("rows") - F.col("distinct_count")
        parts.append(F.when(F.col("column") == F.lit(id_column), finding(
            F.when(surplus > 0, F.lit("WARNING")).otherwise(F.lit("OK")), "duplicate_ids", surplus)))
    parts.append(F.when(F.col("null_count") > 0,
                        finding(F.lit("WARNING"), "null_count", F.col("null_count"))))
    present = [c for c in watch_columns if c in df.columns]
    if present:
        parts.append(F.when(F.col("column").isin(present),
                            finding(F.lit("INFO"), "distinct_count", F.col("distinct_count"))))
    found = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return per_col.select(F.explode(found).alias("f")).select("f.*")


def profile_diff(before: DataFrame, after: DataFrame, approx: bool = False) -> DataFrame:
    """Profiles before and after cleaning side by side, matched by normalised name.

    Both sides have one row per column, so the join input is bounded by the
    number of columns, not by the data.
    """
    b = profile(before, approx)
    names = {c: normalized_name(c) for c in before.columns}
    mapping = F.create_map(*[x for kv in names.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    b = b.select(mapping[F.col("column")].alias("column"),
                 *[F.col(m).alias(f"{m}_before") for m in PROFILE_COLUMNS[1:]])
    a = profile(after, approx)
    a = a.select("column", *[F.col(m).alias(f"{m}_after") for m in PROFILE_COLUMNS[1:]])
    return b.join(a, on="column", how="full")
