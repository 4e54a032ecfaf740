"""Whole-table operators: headers, string sweeps, defaults, search, previews, maps.

Each operator is one ``select``/``filter``/aggregate over the input, so Catalyst
collapses adjacent steps into a single projection and pushes filters and column
pruning into the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablecare.functions import columns as C


def string_columns(df: DataFrame) -> list[str]:
    """Names of the string-typed columns, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def normalized_name(name: str) -> str:
    """Header rule: lower case, spaces become underscores."""
    return name.lower().replace(" ", "_")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column by ``normalized_name``; two names mapping to one fails."""
    new = [normalized_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, name in zip(df.columns, new):
        if name in seen:
            raise ValueError(f"columns {seen[name]!r} and {old!r} both normalise to {name!r}")
        seen[name] = old
    return df.toDF(*new)


def map_columns(df: DataFrame, columns: Iterable[str],
                fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to the named columns in one projection, keeping column order."""
    wanted = set(columns)
    missing = wanted - set(df.columns)
    if missing:
        raise ValueError(f"unknown columns: {sorted(missing)}")
    def named(c: str) -> Column:
        return F.col("`" + c.replace("`", "``") + "`")

    return df.select(*[fn(named(c)).alias(c) if c in wanted else named(c) for c in df.columns])


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim spaces on every string column (or the given ones)."""
    return map_columns(df, string_columns(df) if columns is None else columns, C.trim_spaces)


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Blank strings become NULL on every string column (or the given ones)."""
    return map_columns(df, string_columns(df) if columns is None else columns, C.blank_to_null)


def preserve_columns(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """Append a copy of each source column under a new name (``{source: copy}``)."""
    clash = set(copies.values()) & set(df.columns)
    if clash:
        raise ValueError(f"copy names already present: {sorted(clash)}")
    return df.select("*", *[F.col(src).alias(dst) for src, dst in copies.items()])


def fill_default(df: DataFrame, value, subset: Sequence[str]) -> DataFrame:
    """Replace NULL by ``value`` in the chosen columns."""
    return df.fillna(value, subset=list(subset))


def stamp_run_id(df: DataFrame, run_id: str, name: str = "run_id") -> DataFrame:
    """Add a constant run id column."""
    return df.withColumn(name, F.lit(run_id).cast("string"))


def keyword_search(df: DataFrame, query: str, columns: Sequence[str],
                   include_private: bool = True, name_column: str | None = None) -> DataFrame:
    """Rows where any chosen column contains ``query``, ignoring case.

    Values are compared as text; NULL never matches. With
    ``include_private=False`` rows whose ``name_column`` starts with ``_`` are
    dropped. A pure filter: it runs where the data is, with no shuffle.
    """
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"invalid search columns: {sorted(unknown)}; choose from {sorted(df.columns)}")
    if not columns:
        raise ValueError("no search columns given")
    needle = F.lit(query.lower())
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.coalesce(F.contains(F.lower(F.col(f"`{c}`").cast("string")), needle), F.lit(False))
    if not include_private:
        if name_column is None:
            raise ValueError("include_private=False needs name_column")
        cond = cond & ~F.coalesce(F.startswith(F.col(f"`{name_column}`"), F.lit("_")), F.lit(False))
    return df.where(cond)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column],
            flag: str = "truncated") -> DataFrame:
    """First ``n`` rows in a total order, with a flag telling whether more exist.

    Takes ``n + 1`` rows with a top-k (each partition keeps ``n + 1``, one task
    merges them), keeps ``n``; the flag is true when the ``n + 1``-th existed.
    ``order_by`` must be a total order for the result to be deterministic.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    head = df.orderBy(*order).limit(n + 1)
    w = Window.orderBy(*order)  # n + 1 rows at most: one small partition by design
    ranked = head.withColumn("__rank", F.row_number().over(w))
    total = F.max("__rank").over(Window.partitionBy())
    return (ranked.withColumn(flag, total > F.lit(n))
            .where(F.col("__rank") <= F.lit(n))
            .drop("__rank"))


def named_entries(df: DataFrame, group_cols: Sequence[str], name_col: str, value_col: str,
                  order_col: str) -> DataFrame:
    """Per group and name one row with its last value: the form without a bound on names.

    "Last" is the row with the greatest ``order_col`` (NULL comes first, ties go to the greatest
    value), one maximum with partial aggregation, so a hot group is combined before the shuffle.
    Rows with a NULL name carry no entry.
    """
    return (df.where(F.col(name_col).isNotNull())
              .groupBy(*group_cols, name_col)
              .agg(F.max(F.struct(F.col(order_col).alias("o"), F.col(value_col).alias("v")))["v"]
                   .alias(value_col)))


# A map or list with more entries raises: use the row form.
MAX_NAMES = 10_000


def named_map(df: DataFrame, group_cols: Sequence[str], name_col: str, value_col: str,
              order_col: str, out: str = "named", max_names: int = MAX_NAMES) -> DataFrame:
    """Per group, a map from each name to its value; a repeated name keeps the last.

    The map is made of ``named_entries``, one per distinct name. A group with more than
    ``max_names`` names raises; no more than ``max_names + 1`` entries of a group meet in a task.
    """
    last = named_entries(df, group_cols, name_col, value_col, order_col)
    w = Window.partitionBy(*group_cols).orderBy(name_col)
    few = last.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= max_names + 1)
    entry = F.struct(F.col(name_col).alias("key"), F.col(value_col).alias("value"))
    entries = few.groupBy(*group_cols).agg(F.array_sort(F.collect_list(entry)).alias("__entries"))
    checked = F.when(F.size("__entries") <= max_names, F.map_from_entries("__entries")).otherwise(
        F.raise_error(F.lit(f"more than {max_names} names in one group: use named_entries")))
    return entries.select(*group_cols, checked.alias(out))
