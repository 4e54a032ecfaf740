"""Exact duplicate rows: group counts and the per-row duplicate flag.

Semantics kept from the source pipeline: a row is a duplicate when another row
has equal values in every key column; *all* copies are flagged. By default the
equality is NULL-unsafe (a row with a NULL in any key is never flagged, as an
equi-join ``USING`` all columns behaves); ``null_safe=True`` treats NULLs as
equal.

Scale design of ``method="fingerprint"``, which is used only where asked for:

1. Each eligible row gets a 64-bit fingerprint of its key values. Counting
   fingerprints is a shuffle of 8-byte values with map-side partial counts, so
   one row repeated a billion times costs one value per map task.
2. Fingerprints seen more than once are written to the shared checkpoint folder
   and counted. Only when that count is below ``broadcast_rows`` are they
   broadcast (a checked size); otherwise they are joined by a shuffle on the
   8-byte key.
3. Rows whose fingerprint is not repeated are flagged ``False`` where they are:
   most of the table is never shuffled.
4. Candidate rows (true copies, plus the rare hash collisions) are confirmed
   exactly by grouping on the full key values and joining back. Hot groups are
   combined map-side by the aggregate; the join back leaves skew to AQE's
   skew-join split.

``method="staged"``, the default at every size, computes the rows once:

1. The rows and a 128-bit identity of their key values (two 64-bit hashes of the
   values and of their NULL pattern) are written to the shared folder; whatever
   made the rows (cleaning, date parsing) runs once, however often they are read.
2. Identities are counted: 16 bytes a row, combined map-side, then per salt, then
   whole, so a group of copies holding a third of the table is one row a task.
   Without ``null_safe``, rows with a NULL key are not counted at all.
3. Rows of repeated identities only are grouped by their full values. An identity
   that turns out to hold two kinds of rows (a collision) is decided on the
   values; all others are decided.
4. The staged rows are joined with the repeated identities, which AQE broadcasts
   where their files are small and splits where one identity is hot.

``method="join"`` is the plain form (aggregate on all columns, left join back
on all columns), lazy: whole rows are computed and shuffled for the aggregate
(map-side partial) and again for the join, which leaves skew to AQE's skew-join
split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tablecare.functions.columns import all_not_null
from tablecare.session import stage_table


DEFAULT_FLAG = "duplicate_row"
DEFAULT_COUNT = "copies"
# A fingerprint is 8 bytes; 4M of them is ~32 MB once broadcast.
BROADCAST_ROWS = 4_000_000


def _keys(df: DataFrame, keys: Sequence[str] | None) -> list[str]:
    keys = list(df.columns if keys is None else keys)
    unknown = set(keys) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown key columns: {sorted(unknown)}")
    maps = [f.name for f in df.schema.fields if f.name in keys and isinstance(f.dataType, MapType)]
    if maps:
        raise ValueError(f"map columns cannot be compared for duplicates: {maps}")
    return keys


def _ref(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def _key_match(keys: Sequence[str], null_safe: bool, left="l", right="r") -> Column:
    cond = F.lit(True)
    for k in keys:
        a, b = _ref(left, k), _ref(right, k)
        cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
    return cond


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None,
                     count_col: str = DEFAULT_COUNT) -> DataFrame:
    """One row per distinct key combination that occurs more than once, with its count.

    NULLs group together here (as ``GROUP BY`` does); the flag decides later
    whether such a group counts.
    """
    keys = _keys(df, keys)
    if count_col in keys:
        raise ValueError(f"count column {count_col!r} collides with a key column")
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > F.lit(1)))


def _flag_by_join(df: DataFrame, keys: list[str], flag: str, null_safe: bool) -> DataFrame:
    """Aggregate on all keys, left join back on all keys (NULL-safe match, NULL
    rule applied after the join, see ``mark_duplicates_left``)."""
    marked = duplicate_groups(df, keys, "__copies").select(*keys, F.lit(True).alias("__dup"))
    joined = df.alias("l").join(marked.alias("r"), _key_match(keys, True), "left")
    is_dup = F.coalesce(F.col("r.__dup"), F.lit(False))
    if not null_safe:
        is_dup = is_dup & all_not_null([f"l.`{k}`" for k in keys])
    return joined.select(*[_ref("l", c) for c in df.columns], is_dup.alias(flag))


def fingerprint(keys: Sequence[str], seed: int | None = None) -> Column:
    """64-bit hash of the key values and of their NULL pattern; never NULL. Another ``seed``
    gives an independent hash.

    ``xxhash64`` skips NULL inputs, so the NULL pattern is hashed too, keeping
    ``(NULL, 'a')`` and ``('a', NULL)`` apart. Being non-nullable matters for
    the plan: Catalyst then has no ``IS NOT NULL`` filter to push below the
    projection, which would evaluate every cleaning expression twice.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    return F.xxhash64(*([] if seed is None else [F.lit(seed)]),
                      F.array(*[c.isNull() for c in cols]), *cols)


def _flag_by_fingerprint(df: DataFrame, keys: list[str], flag: str, null_safe: bool,
                         broadcast_rows: int) -> DataFrame:
    from tablecare.session import shared_dir

    shared_dir(df.sparkSession)  # checkpoint() writes under spark.checkpoint.dir
    tagged = df.withColumn("__fp", fingerprint(keys))
    repeated = (tagged.groupBy("__fp").agg(F.count(F.lit(1)).alias("__n"))
                      .where(F.col("__n") > F.lit(1))
                      .select("__fp", F.lit(True).alias("__cand")))
    size = Observation()
    repeated = repeated.observe(size, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    small = size.get["n"] <= broadcast_rows  # counted while the checkpoint was written
    side = F.broadcast(repeated) if small else repeated
    marked = tagged.join(side, on="__fp", how="left")

    # Rows whose fingerprint is not repeated: never duplicates. The flag is
    # taken from the join column (NULL here) rather than written as a literal,
    # so filters on it cannot be folded away and pushed below the join.
    plain = (marked.where(F.col("__cand").isNull())
                   .select(*[F.col(f"`{c}`") for c in df.columns],
                           F.coalesce(F.col("__cand"), F.lit(False)).alias(flag)))

    # Exact confirmation among candidates: group on the full key values, join
    # back on fingerprint plus NULL-safe equality of every key (NULL-safe
    # equality gives Catalyst no IS NOT NULL filter to push down), and apply
    # the NULL-unsafe rule after the join: a row holding a NULL key is never a
    # duplicate, as with an equi-join on all columns.
    cand = marked.where(F.col("__cand").isNotNull()).drop("__cand")
    counts = cand.groupBy("__fp", *keys).agg(F.count(F.lit(1)).alias("__n"))
    match = (F.col("l.__fp") == F.col("r.__fp")) & _key_match(keys, True)
    is_dup = F.coalesce(F.col("r.__n") > F.lit(1), F.lit(False))
    if not null_safe:
        is_dup = is_dup & all_not_null([f"l.`{k}`" for k in keys])
    confirmed = (cand.alias("l").join(counts.alias("r"), match, "left")
                     .select(*[_ref("l", c) for c in df.columns], is_dup.alias(flag)))
    return plain.unionByName(confirmed)


IDENTITY = ["__id1", "__id2"]
SALTS = 16


ROW = "__row"


def _flag_staged(df: DataFrame, keys: list[str], flag: str, null_safe: bool,
                 order: Sequence[str] | None = None) -> DataFrame:
    numbered = [] if order is None else [F.monotonically_increasing_id().alias(ROW)]
    counted = F.lit(True) if null_safe else all_not_null([f"`{k}`" for k in keys])
    rows = stage_table(df.select(
        *[F.col(f"`{c}`") for c in df.columns], fingerprint(keys).alias(IDENTITY[0]),
        fingerprint(keys, seed=1).alias(IDENTITY[1]), counted.alias("__counted"), *numbered), "rows")
    repeated = stage_table(
        rows.where("__counted").select(*IDENTITY, F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("__salt"))
        .groupBy(*IDENTITY, "__salt").agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(*IDENTITY).agg(F.sum("__n").alias("__n")).where("__n > 1")
        .select(*IDENTITY, F.lit(True).alias("__dup")), "repeated")
    kinds = (rows.where("__counted").join(repeated, IDENTITY, "left_semi")
             .groupBy(*IDENTITY, *keys).agg(F.count(F.lit(1)).alias("__n")))
    mixed = stage_table(kinds.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("__kinds"))
                        .where("__kinds > 1").drop("__kinds"), "mixed")
    l, r = rows.alias("l"), repeated.alias("r")
    same = F.lit(True)
    for i in IDENTITY:
        same = same & (_ref("l", i) == _ref("r", i))
    is_dup = F.coalesce(_ref("r", "__dup"), F.lit(False)) & _ref("l", "__counted")
    if mixed.isEmpty():
        out = l.join(r, same, "left")
    else:       # two kinds of rows under one 128-bit identity: their values decide
        single = kinds.join(mixed, IDENTITY, "left_semi").where("__n = 1").withColumn("__single", F.lit(True))
        out = l.join(r, same, "left").join(
            single.alias("s"), _key_match(keys, True, "l", "s"), "left")
        is_dup = is_dup & F.col("s.__single").isNull()
    if order is None:
        return out.select(*[_ref("l", c) for c in df.columns], is_dup.alias(flag))
    # the first copy of each group by ``order`` keeps its place; a row number joins it, never a hot key
    flagged = out.select(*[_ref("l", c) for c in df.columns], _ref("l", ROW), is_dup.alias(flag))
    place = F.struct(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in order], F.col(ROW))
    firsts = stage_table(flagged.where(F.col(flag)).groupBy(*keys).agg(F.min_by(ROW, place).alias("__first"))
                         .select("__first", F.lit(True).alias("__is_first")), "firsts")
    return (flagged.alias("l").join(firsts.alias("f"), _ref("l", ROW) == F.col("f.__first"), "left")
            .select(*[_ref("l", c) for c in df.columns],
                    (_ref("l", flag) & F.col("f.__is_first").isNull()).alias(flag)))


def flag_duplicates(df: DataFrame, keys: Sequence[str] | None = None,
                    flag: str = DEFAULT_FLAG, null_safe: bool = False,
                    method: str = "staged",
                    broadcast_rows: int = BROADCAST_ROWS,
                    keep: str = "none", order: Sequence[str] = ()) -> DataFrame:
    """Every row of ``df`` once, plus a non-NULL boolean ``flag`` column.

    ``keys`` defaults to all columns. ``method`` is ``staged`` (rows computed once, into the
    shared folder), ``join`` (lazy, rows computed twice) or ``fingerprint`` (one eager pass, then
    narrow shuffles); all give the same rows. See the module notes.

    ``keep="none"`` flags all copies. ``keep="first"`` leaves the first one by the columns of
    ``order`` unflagged (NULL last; of rows equal there too, any one); it needs ``staged``.
    """
    keys = _keys(df, keys)
    if flag in df.columns:
        raise ValueError(f"flag column {flag!r} already exists")
    if keep not in ("none", "first"):
        raise ValueError(f"unknown keep {keep!r}")
    if keep == "first":
        if not order or method != "staged":
            raise ValueError('keep="first" needs order columns and the staged method')
        return _flag_staged(df, keys, flag, null_safe, _keys(df, order))
    if method == "staged":
        return _flag_staged(df, keys, flag, null_safe)
    if method == "join":
        return _flag_by_join(df, keys, flag, null_safe)
    if method == "fingerprint":
        return _flag_by_fingerprint(df, keys, flag, null_safe, broadcast_rows)
    raise ValueError(f"unknown method {method!r}")


def mark_duplicates_left(df: DataFrame, keys: Sequence[str] | None = None,
                         flag: str = DEFAULT_FLAG) -> DataFrame:
    """The source pipeline's raw left join: the flag is True or NULL (before filling).

    Same result as ``df LEFT JOIN groups USING (all keys)``: True for rows
    with no NULL key whose values occur more than once, NULL otherwise. The
    join matches NULL-safely and applies the NULL rule afterwards, so Catalyst
    infers no IS NOT NULL filter on derived key columns (which it would push
    under the projection and evaluate every expression twice).
    """
    keys = _keys(df, keys)
    marked = duplicate_groups(df, keys, "__copies").select(*keys, F.lit(True).alias("__dup"))
    joined = df.alias("l").join(marked.alias("r"), _key_match(keys, True), "left")
    value = F.when(F.col("r.__dup") & all_not_null([f"l.`{k}`" for k in keys]), F.lit(True))
    return joined.select(*[_ref("l", c) for c in df.columns], value.alias(flag))
