"""Usage index: per key, how often it is used, with which types, by whom.

Output per key: ``used`` (rows), ``types`` (sorted distinct types),
``examples`` (the first ``max_examples`` distinct owners in ascending order) and
``more`` (the exact number of distinct owners that are not listed).

Scale notes:

* ``used`` is a plain count with map-side partial aggregation.
* ``types`` are de-duplicated as ``(key, type)`` pairs before they are
  collected, so a hot key contributes one entry per distinct type, not one per
  row. The list holds every distinct type of the key (it is the index itself);
  ``max_types`` cuts it like the examples and reports the exact count.
* ``examples`` are cut *before* collecting: ``row_number() <= k`` over the
  distinct ``(key, owner)`` pairs is planned with a partial window group
  limit below the shuffle, so each map task sends at most ``k`` owners per key
  and one key with a third of all rows still sends ``k`` per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the index lists 10 owners; ``more`` counts those left out.
MAX_EXAMPLES = 10


# A key with more types raises in the list form.
MAX_TYPES = 100_000


def usage_types(df: DataFrame, key: str, type_col: str) -> DataFrame:
    """One row per key and type with its number of rows: the form without a bound on types."""
    k, t = F.col(f"`{key}`"), F.col(f"`{type_col}`")
    return (df.where(k.isNotNull() & t.isNotNull()).groupBy(k.alias("key"), t.alias("type"))
              .agg(F.count(F.lit(1)).alias("used")))


def _first_per_key(pairs: DataFrame, value: str, k: int) -> DataFrame:
    """The ``k`` smallest values per key, cut before the shuffle (partial window limit)."""
    w = Window.partitionBy("key").orderBy(F.col(value).asc())
    return pairs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)


def usage_index(df: DataFrame, key: str, type_col: str, owner: str,
                max_examples: int = MAX_EXAMPLES, max_types: int | None = None) -> DataFrame:
    """Per key: ``used`` rows, sorted distinct ``types``, first ``max_examples`` owners.

    ``types`` lists every distinct type of the key by default, as the index
    does; more than ``MAX_TYPES`` of one key raise (``usage_types`` has them as
    rows). For a type vocabulary without a natural bound, ``max_types`` lists
    the first ``max_types`` types (cut like the examples, before the shuffle)
    and adds ``type_count``, the exact number of distinct types.
    """
    k = F.col(f"`{key}`")
    used = df.where(k.isNotNull()).groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("used"))

    pairs_t = (df.where(k.isNotNull() & F.col(f"`{type_col}`").isNotNull())
                 .select(k.alias("key"), F.col(f"`{type_col}`").alias("t")).distinct())
    listed_t = _first_per_key(pairs_t, "t", MAX_TYPES + 1 if max_types is None else max_types)
    types = listed_t.groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("types"))
    if max_types is None:
        types = types.withColumn("types", F.when(F.size("types") <= MAX_TYPES, F.col("types")).otherwise(
            F.raise_error(F.lit(f"more than {MAX_TYPES} types of one key: use usage_types"))))
    if max_types is not None:
        counts = pairs_t.groupBy("key").agg(F.count(F.lit(1)).alias("type_count"))
        types = types.join(counts, "key", "right")

    pairs_o = (df.where(k.isNotNull() & F.col(f"`{owner}`").isNotNull())
                 .select(k.alias("key"), F.col(f"`{owner}`").alias("o")).distinct())
    firsts = _first_per_key(pairs_o, "o", max_examples)
    owners = pairs_o.groupBy("key").agg(F.count(F.lit(1)).alias("owners"))
    examples = (firsts.groupBy("key").agg(F.array_sort(F.collect_list("o")).alias("examples"))
                .join(owners, "key"))

    return (used.join(types, "key", "left").join(examples, "key", "left")
               .select("key", "used",
                       F.coalesce("types", F.array().cast(types.schema["types"].dataType)).alias("types"),
                       F.coalesce("examples", F.array().cast(examples.schema["examples"].dataType))
                        .alias("examples"),
                       (F.coalesce("owners", F.lit(0)) - F.coalesce(F.size("examples"), F.lit(0)))
                        .cast("bigint").alias("more"),
                       *([F.coalesce("type_count", F.lit(0).cast("bigint")).alias("type_count")]
                         if max_types is not None else [])))
