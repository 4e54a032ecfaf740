import random

import pytest
from pyspark.sql import functions as F

from tablecare.functions.text import Rule, categorize
from tablecare.operators import frames, rule_table, usage
from tablecare.operators.rule_table import categorize_by_table


def test_same_as_the_expression(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abé.") for _ in range(n))
    values = [(i, word(rng.randrange(0, 12))) for i in range(400)] + [(900, None), (901, "abab" * 3000)]
    rules = [(rng.choice(["exact", "prefix", "suffix", "contains"]), word(rng.randrange(0, 6))) for _ in range(120)]
    rules = [r for r in rules if r[1] or rng.random() < 0.02]
    df = spark.createDataFrame(values, "id long, `v.x` string")
    table = spark.createDataFrame([(n, k, p, f"L{n}") for n, (k, p) in enumerate(rules)]
                                  + [(-1, "exact", None, "never")],
                                  "number long, kind string, pattern string, label string")
    got = categorize_by_table(df, "v.x", table, default="none", null_label="null")
    assert got.columns == ["id", "v.x", "category"]
    want = df.select("id", categorize(F.col("`v.x`"), [Rule(k, p, f"L{n}") for n, (k, p) in enumerate(rules)],
                                      "none", "null").alias("category"))
    assert {r.id: r.category for r in got.collect()} == {r.id: r.category for r in want.collect()}
    assert {r.category for r in categorize_by_table(df, "v.x", table.limit(0)).collect()} == {"other"}
    with pytest.raises(Exception, match="unknown rule kind"):
        categorize_by_table(df, "v.x", table.withColumn("kind", F.lit("like"))).collect()


@pytest.mark.parametrize("broadcast_bytes", [rule_table.BROADCAST_BYTES, 0])
def test_look_ups_are_not_broadcast_and_repeated_patterns_match_once(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(rule_table, "BROADCAST_BYTES", broadcast_bytes)
    df = spark.range(600).select("id", F.concat(F.lit("https://host/x"), F.col("id").cast("string")).alias("u"))
    rules = [(n, kind, pattern, f"L{n}") for n, (kind, pattern) in enumerate(
        [("contains", "st/x7"), ("contains", "x7"), ("suffix", "9"), ("prefix", "https://host/x5"),
         ("exact", "https://host/x12")] * 40)]
    table = spark.createDataFrame(rules[::-1], "number long, kind string, pattern string, label string")
    got = categorize_by_table(df, "u", table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join [" in x and "piece#" in x]
    assert joins and all(("BroadcastHashJoin" in x and "BuildRight" in x) == (broadcast_bytes > 0) for x in joins)
    label = lambda i: ("L0" if i.startswith("7") else "L2" if i.endswith("9")
                       else "L3" if i.startswith("5") else "L4" if i == "12" else "other")
    assert {r.id: r.category for r in got.collect()} == {i: label(str(i)) for i in range(600)}
    met = rule_table._beside(rule_table._filed(*_staged_rules(df, table)))
    assert met.count() == 5     # 200 rules, five patterns


def _staged_rules(df, table):
    """What ``categorize_by_table`` files: its rules, and the values."""
    kept = []
    filed, rule_table._filed = rule_table._filed, lambda r, v: kept.extend((r, v)) or filed(r, v)
    try:
        categorize_by_table(df, "u", table)
    finally:
        rule_table._filed = filed
    return kept


def test_lists_beyond_their_bound_raise(spark, monkeypatch):
    df = spark.range(50).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("name"),
                                F.col("id").alias("v"))
    assert len(frames.named_map(df, ["g"], "name", "v", "v").first()["named"]) == 50
    assert frames.named_entries(df, ["g"], "name", "v", "v").count() == 50
    with pytest.raises(Exception, match="more than 49 names"):
        frames.named_map(df, ["g"], "name", "v", "v", max_names=49).collect()
    monkeypatch.setattr(usage, "MAX_TYPES", 49)
    assert usage.usage_types(df, "g", "name").count() == 50
    with pytest.raises(Exception, match="more than 49 types"):
        usage.usage_index(df, "g", "name", "v").collect()
