"""Exact dedup by skew-safe combining [native].

Three combining steps, each grouping by the full text beside its SHA-256, so
two texts that merely share a digest never merge:

1. local: the map side of the salted grouping folds equal texts of one task;
2. salted: one row per (digest, text, salt); the salt is the map task modulo
   ``salts``, so a hot text is merged by ``salts`` reducers at most one row per
   task each;
3. global: the few salt winners of a text become one row.

A document finds its group again by a narrow equi-join on (SHA-256, 64-bit
hash, length). Groups are staged first; rows of hot groups (more than one in
1,000 of all rows, so fewer than 1,000 groups) are not shuffled for it, their
groups are broadcast. Should two different texts ever agree on all three, the
query fails instead of merging them.

Defined cases: NULL text counts as ''; NULL doc_id is smaller than any id (a
group of NULL ids keeps NULL); rows equal in id and text are one decision (each
gets the same result row, ``deduplicate`` keeps one); an empty table gives no
rows; other input columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import flag_hot, hot_size, id_text, join_hot_apart, quoted, stage

IDENTITY = ["digest", "hash64", "length"]


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).withColumns({
        "digest": F.unhex(F.sha2("text", 256)),
        "hash64": F.xxhash64("text"),
        "length": F.octet_length("text")})


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           salts: int = 16) -> DataFrame:
    """One row per distinct text: digest, hash64, length, keep_id (largest id), group_size."""
    rows = _identified(docs, id_col, text_col).withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    content = [*IDENTITY, "text"]
    salted = rows.groupBy(*content, "salt").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    whole = salted.groupBy(*content).agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    # one text per identity, or fail
    return (whole.groupBy(*IDENTITY)
            .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"),
                 F.count(F.lit(1)).alias("texts"))
            .filter(F.when(F.col("texts") == 1, True).otherwise(
                F.raise_error(F.lit("two texts share SHA-256, 64-bit hash and length"))
                .cast("boolean")))
            .drop("texts"))


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            salts: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    found = stage(groups(docs, id_col, text_col, salts), "groups")
    total = found.agg(F.sum("group_size")).first()[0]
    found = found.withColumn("hot", F.col("group_size") > hot_size(total))
    rows = flag_hot(_identified(docs, id_col, text_col).select("doc_id", *IDENTITY),
                    found.filter("hot"), IDENTITY)
    return (join_hot_apart(rows, found, IDENTITY)
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                salts: int = 16) -> DataFrame:
    """The input rows that stay, with the input's columns; equal rows stay once.

    The same combining, but the winner's other columns travel with it, so nothing is joined back
    and each text is shuffled twice at most. Of rows equal in id and text, the one of greatest
    hash of its other columns stays.
    """
    others = [c for c in docs.columns if c != text_col]
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    row = F.struct(quoted(text_col).isNull().alias("no_text"),
                   *[quoted(c).alias(f"c{k}") for k, c in enumerate(others)])
    rows = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
                       F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), row.alias("row"),
                       F.struct(quoted(id_col).cast("long"), F.xxhash64(F.to_json(row))).alias("rank"))
    for keys in (["digest", "text", "salt"], ["digest", "text"]):
        rows = rows.groupBy(*keys).agg(F.max_by("row", "rank").alias("row"), F.max("rank").alias("rank"))
    back = {c: F.col(f"row.c{k}") for k, c in enumerate(others)}
    back[text_col] = F.when(~F.col("row.no_text"), F.col("text"))
    return rows.select(*[back[c].alias(c) for c in docs.columns])
