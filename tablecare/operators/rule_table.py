"""Ordered category rules held as a table, for rule lists too long for one expression.

``functions.text.categorize`` tests every rule on every row. Here each distinct
value is looked up instead, whatever the number of rules:

* ``exact`` (and each member of a set, as a rule of its own): the value itself;
* ``prefix``, ``suffix``: the value's ends, one per pattern length in use;
* ``contains``: a pattern is filed under the rarest of its three-character
  grams among the values, so few values meet it; patterns below three
  characters are looked up by grams of their own length.

Look-ups and rules meet in one join on (kind, piece); what it yields is tested
in full, and the smallest rule number of a value wins. Of rules with the same
kind and pattern only the one with the smallest number can win, so the others go
first: a pattern that many rules repeat costs each value one match. Rules are
never collected, and a common gram costs only the rules that have none rarer.

Look-ups are many times the values, which a planner cannot see, so they are never
broadcast: the rules are, up to ``BROADCAST_BYTES`` by their counted size. Longer
lists meet the look-ups by a merge join, where AQE splits a hot piece.

Defined cases: rules with a NULL number, kind or pattern are left out; an empty
pattern of ``prefix``, ``suffix`` or ``contains`` matches every value; a NULL value
gets ``null_label`` (``default`` when not given); an unknown kind raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecare.session import stage_table

KINDS = ("exact", "prefix", "suffix", "contains")
GRAM = 3
BROADCAST_BYTES = 16 << 20
ROW_BYTES = 100         # of a broadcast row beside its texts


def _grams(c: Column, size: int) -> Column:
    """All distinct pieces of ``size`` characters."""
    last = F.length(c) - F.lit(size - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.substring(c, i, F.lit(size))))).otherwise(
        F.array().cast("array<string>"))


def _filed(rules: DataFrame, values: DataFrame) -> DataFrame:
    """(kind, piece, number, pattern, label): each rule under the one piece it is looked up by."""
    plain = rules.where("kind <> 'contains' OR length(pattern) < 3").withColumn("piece", F.col("pattern"))
    long = rules.where("kind = 'contains' AND length(pattern) >= 3").withColumn(
        "piece", F.explode(_grams(F.col("pattern"), GRAM)))
    seen = (values.select(F.explode(_grams(F.col("value"), GRAM)).alias("piece"))
            .groupBy("piece").agg(F.count(F.lit(1)).alias("n")))
    rarest = (long.join(seen.hint("merge"), "piece", "left")
              .groupBy("number", "kind", "pattern", "label")
              .agg(F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), "piece")).alias("piece")))
    return plain.unionByName(rarest)


def _beside(filed: DataFrame) -> DataFrame:
    """Filed rules as the side of a join: broadcast where they are few, merged where not."""
    filed = stage_table(filed, "rules-filed")
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("kind", "piece", "pattern", "label")]
    size = filed.agg(F.sum(sum(texts, F.lit(ROW_BYTES)).cast("long"))).first()[0] or 0
    return F.broadcast(filed) if size <= BROADCAST_BYTES else filed.hint("merge")


def categorize_by_table(df: DataFrame, column: str, rules: DataFrame, out: str = "category",
                        default: str = "other", null_label: str | None = None) -> DataFrame:
    """``df`` with ``out``: the label of the first rule (number, kind, pattern, label) that matches."""
    value = F.col(f"`{column}`")
    checked = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown rule kind "), F.col("kind"))))
    rules = (rules.where("number IS NOT NULL AND kind IS NOT NULL AND pattern IS NOT NULL")
             .select("number", checked.alias("kind"), "pattern", "label"))
    rules = stage_table(rules.groupBy("kind", "pattern").agg(F.min_by("label", "number").alias("label"),
                                                             F.min("number").alias("number")), "rules")
    values = df.where(value.isNotNull()).select(value.alias("value")).distinct()
    # one row of numbers: the pattern lengths in use, as many as the longest pattern at most
    row = rules.agg(*[F.collect_set(F.when(F.col("kind") == k, F.length("pattern"))).alias(k)
                      for k in KINDS]).first()
    lengths = {k: F.array(*[F.lit(n) for n in sorted(row[k])]).cast("array<int>") for k in KINDS}
    v = F.col("value")
    fits = lambda k: F.filter(lengths[k], lambda n: n <= F.length(v))
    probe = lambda kind, pieces: F.transform(
        pieces, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("piece")))
    none = F.array().cast("array<string>")
    short = [_grams(v, n) for n in range(1, GRAM) if n in row["contains"]]
    empty = F.array(F.lit("")) if 0 in row["contains"] else none
    long = _grams(v, GRAM) if any(n >= GRAM for n in row["contains"]) else none
    probes = values.select("value", F.explode(F.concat(
        probe("exact", F.array(v)),
        probe("prefix", F.transform(fits("prefix"), lambda n: F.substring(v, F.lit(1), n))),
        probe("suffix", F.transform(fits("suffix"), lambda n: F.substring(
            v, F.length(v) - n + F.lit(1), n))),
        probe("contains", F.concat(*short, empty, long)))).alias("p")).select("value", "p.*")
    hits = (probes.join(_beside(_filed(rules, values)), ["kind", "piece"])
            .where((F.col("kind") != "contains") | F.contains("value", "pattern")))
    first = hits.groupBy("value").agg(F.min_by("label", "number").alias("label"),
                                      F.lit(True).alias("found"))
    label = F.when(value.isNull(), F.lit(default if null_label is None else null_label)).when(
        F.col("__r.found"), F.col("__r.label")).otherwise(F.lit(default))
    return (df.alias("__l").join(first.alias("__r"), value == F.col("__r.value"), "left")
            .select(*[F.col(f"__l.`{c}`") for c in df.columns], label.alias(out)))
