"""Plan-shape checks: the properties the scale design relies on."""

import re

from tablecare.operators.duplicates import flag_duplicates
from tablecare.operators.split import clean_rows, quarantine_rows
from tablecare.plans.fixtures import dirty_orders
from tablecare.plans.spec import ORDERS_SPEC
from conftest import SF001


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def filters(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if re.search(r"\bFilter\b", line)]


def test_split_filters_do_not_reparse_dates(spark):
    """The clean/quarantine filters stay above the duplicate join: no Filter
    re-evaluates the date parsing under the cleaning projection."""
    flagged = ORDERS_SPEC.upto("flag_duplicates").apply(dirty_orders(spark, SF001))
    for df in (clean_rows(flagged, ORDERS_SPEC.required()),
               quarantine_rows(flagged, ORDERS_SPEC.required())):
        assert not [f for f in filters(executed(df)) if "gettimestamp" in f]


def test_fingerprint_set_is_broadcast_after_its_size_check(spark):
    cleaned = ORDERS_SPEC.upto("range_check").apply(dirty_orders(spark, SF001))
    plan = executed(flag_duplicates(cleaned, method="fingerprint"))
    assert "BroadcastHashJoin" in plan
    assert "xxhash64" in plan


def test_fingerprint_never_null(spark):
    from tablecare.operators.duplicates import fingerprint

    df = spark.createDataFrame([(None, None), ("a", None)], "a string, b string")
    out = df.select(fingerprint(["a", "b"]).alias("fp"))
    assert not out.schema["fp"].nullable
    assert out.where("fp IS NULL").count() == 0


def test_spread_shuffles_only_on_request(spark):
    from tablecare.sources.files import spread

    df = spark.range(10).coalesce(1)
    assert spread(df) is df
    assert spread(df, 3).rdd.getNumPartitions() == 3
