from pyspark.sql import functions as F

from tablecare.operators import profile as P
from tablecare.operators import split as S
from conftest import rows

FLAGGED = [("n1", 1, False), (None, 2, False), ("n3", None, False), ("n4", 4, True), ("n5", 5, False)]


def test_split_is_a_partition(spark):
    df = spark.createDataFrame(FLAGGED, "name string, lvl int, duplicate_row boolean")
    q = S.quarantine_rows(df, ["name", "lvl"])
    c = S.clean_rows(df, ["name", "lvl"])
    assert sorted(rows(q) + rows(c), key=repr) == rows(df)
    assert not set(rows(q)) & set(rows(c))
    s = S.split_summary(df, ["name", "lvl"]).collect()[0]
    assert (s.total_rows, s.clean_rows, s.quarantine_rows) == (5, 2, 3)
    reasons = {r.name: r.r for r in df.select("name", S.reasons(["name", "lvl"]).alias("r")).collect()}
    assert reasons["n4"] == ["duplicate"] and reasons[None] == ["missing:name"] and reasons["n1"] == []


def test_profile_counts_null_as_distinct_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("  ", 2)], "s string, n int")
    p = {r.column: r for r in P.profile(df).collect()}
    assert (p["s"].schema, p["s"].null_count, p["s"].blank_count, p["s"].distinct_count) == ("string", 1, 1, 3)
    assert (p["n"].schema, p["n"].null_count, p["n"].blank_count, p["n"].distinct_count) == ("int", 1, None, 3)
    d = P.duplicate_ids(df, "s").collect()[0]
    assert (d.rows, d.distinct_ids, d.duplicate_ids) == (4, 3, 1)


def test_findings(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "`Monster ID` string, Status string")
    got = rows(P.findings(df, "Monster ID", ["Status", "missing"]))
    assert got == sorted([("WARNING", "Monster ID", "duplicate_ids", 1),
                          ("WARNING", "Status", "null_count", 1),
                          ("INFO", "Status", "distinct_count", 3)], key=repr)


def test_profile_diff_matches_normalised_names(spark):
    before = spark.createDataFrame([(" a ",)], "`Monster Name` string")
    after = spark.createDataFrame([("A", True)], "monster_name string, flag boolean")
    d = {r.column: r for r in P.profile_diff(before, after).collect()}
    assert set(d) == {"monster_name", "flag"}
    assert d["flag"].schema_before is None and d["monster_name"].schema_after == "string"


def test_profile_is_one_job(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    plan = P.profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") + plan.count("Range") == 1


def test_profile_approx_close_to_exact(spark):
    df = spark.range(5000).select((F.col("id") % 997).alias("a"), F.col("id").cast("string").alias("s"))
    exact = {r.column: r.distinct_count for r in P.profile(df).collect()}
    approx = {r.column: r.distinct_count for r in P.profile(df, approx=True).collect()}
    assert exact == {"a": 997, "s": 5000}
    assert all(abs(approx[c] - exact[c]) <= 0.05 * exact[c] for c in exact)


def test_profile_types_and_empty(spark):
    """Every type keeps equal from unequal; nested columns and empty tables have their rows."""
    from tablecare.operators.profile import distinct_counts, profile

    df = spark.sql("""
        SELECT * FROM VALUES
          (1, 1.5D, DATE'2020-01-01', TIMESTAMP'2020-10-25 00:30:00', true, 1.10BD, ' ', array(1), X'01'),
          (1, -0.0D, DATE'2020-01-02', TIMESTAMP'2020-10-25 00:30:00', false, 1.1BD, '', array(1), X'0100'),
          (2, 0.0D, NULL, NULL, NULL, 2BD, NULL, array(2), NULL),
          (NULL, double('NaN'), NULL, NULL, true, NULL, 'x', NULL, X'')
        AS t(i, d, day, ts, b, m, s, a, `x.y`)""")
    got = {r["column"]: (r.null_count, r.blank_count, r.distinct_count) for r in profile(df).collect()}
    assert got == {"i": (1, None, 3), "d": (0, None, 3), "day": (2, None, 3), "ts": (2, None, 2),
                   "b": (1, None, 3), "m": (1, None, 3), "s": (1, 2, 4), "a": (1, None, 3),
                   "x.y": (1, None, 4)}
    empty = {r["column"]: r for r in profile(df.limit(0)).collect()}
    assert set(empty) == set(df.columns) and {r.distinct_count for r in empty.values()} == {0}
    assert [(r["column"], r.distinct_count) for r in distinct_counts(df, ["s"]).collect()] == [("s", 4)]
    assert "Expand" not in profile(df.drop("a"))._jdf.queryExecution().executedPlan().toString()
