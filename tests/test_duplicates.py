from collections import Counter

from hypothesis import given, settings, strategies as st

from tablecare.operators.duplicates import duplicate_groups, flag_duplicates, mark_duplicates_left
from conftest import rows

DATA = [("a", 1), ("a", 1), ("a", None), ("a", None), ("b", 2), (None, 3), (None, 3), ("c", 4)]
SCHEMA = "k string, v int"


def brute(data, null_safe):
    counts = Counter(data)
    return sorted(((k, v, counts[(k, v)] > 1 and (null_safe or (k is not None and v is not None)))
                   for k, v in data), key=repr)


def test_flag_semantics_all_methods(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    for method in ("staged", "fingerprint", "join"):
        for ns in (False, True):
            got = rows(flag_duplicates(df, null_safe=ns, method=method))
            assert got == brute(DATA, ns), (method, ns)


def test_shuffle_join_path_matches_broadcast_path(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(flag_duplicates(df, method="fingerprint", broadcast_rows=0)) == brute(DATA, False)


def test_duplicate_groups_and_raw_left_join(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    g = rows(duplicate_groups(df))
    assert g == sorted([("a", 1, 2), ("a", None, 2), (None, 3, 2)], key=repr)
    marked = rows(mark_duplicates_left(df))
    assert marked == sorted([(k, v, True if (k, v) == ("a", 1) else None) for k, v in DATA], key=repr)


def test_hot_group_of_copies(spark):
    """One row repeated for a third of the table is flagged whole, with no rows lost."""
    hot = [("hot", 7)] * 3000
    rest = [(f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(hot + rest, SCHEMA).repartition(16)
    out = flag_duplicates(df)
    assert out.count() == 9000
    assert out.where("duplicate_row").count() == 3000


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([0, 1, None])),
                min_size=0, max_size=25), st.booleans())
def test_flag_property(spark, data, null_safe):
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(flag_duplicates(df, null_safe=null_safe)) == brute(data, null_safe)


def test_staged_computes_rows_once(spark):
    from tablecare.plans.fixtures import dirty_orders
    from tablecare.plans.spec import ORDERS_SPEC
    from tablecare.session import remove_staged
    from conftest import SF001

    out = ORDERS_SPEC.upto("flag_duplicates").apply(dirty_orders(spark, SF001))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan and "to_date" not in plan      # the staged rows are read
    assert out.count() and remove_staged(spark) >= 3
    assert remove_staged(spark) == 0


def test_collision_of_identities(spark, monkeypatch):
    """Rows of two kinds under one identity are told apart by their values."""
    from pyspark.sql import functions as F
    from tablecare.operators import duplicates

    monkeypatch.setattr(duplicates, "fingerprint",
                        lambda keys, seed=None: F.length(F.coalesce(F.col("k"), F.lit(""))).cast("bigint"))
    df = spark.createDataFrame(DATA + [("d", 9), ("d", 9)], SCHEMA)
    for ns in (False, True):
        assert rows(flag_duplicates(df, null_safe=ns)) == brute(DATA + [("d", 9), ("d", 9)], ns)
