import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablecare.functions import columns as C


def one(spark, values, fn, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("v")).alias("o")).collect()]


def test_trim_spaces_only(spark):
    assert one(spark, ["  a  ", "\ta\t", None], C.trim_spaces) == ["a", "\ta\t", None]


def test_blank_to_null_keeps_untrimmed_text(spark):
    assert one(spark, ["   ", "", " a ", None], C.blank_to_null) == [None, None, " a ", None]


def test_case_rules(spark):
    assert one(spark, ["mcDONALD o'neil foo-bar"], C.case_title) == ["Mcdonald O'neil Foo-bar"]
    assert one(spark, ["m001"], C.case_upper) == ["M001"]
    assert one(spark, ["ACTive"], C.case_lower) == ["active"]


def test_clean_currency_is_case_sensitive(spark):
    got = one(spark, ["$6,371.00", "USD 1100", "USD1100", "usd 1100", None], C.clean_currency)
    assert got == ["6371.00", "1100", "USD1100", "usd 1100", None]


def test_try_double_and_int(spark):
    assert one(spark, ["1e3", "abc", "12.5", None], C.try_double) == [1000.0, None, 12.5, None]
    assert one(spark, [" 3 ", "3.0", "3.7", "two", "7"], C.try_int) == [3, None, None, None, 7]


def test_negative_flag_and_fix(spark):
    assert one(spark, [-5.0, 0.0, 3.0, None], C.is_negative, "v double") == [True, False, False, False]
    assert one(spark, [-5.0, 0.0, 3.0, None], C.fix_negative, "v double") == [5.0, 0.0, 3.0, None]


def test_range_check_inclusive(spark):
    assert one(spark, [0, 1, 10, 11, None], C.in_range, "v int") == [None, 1, 10, None, None]


# Measured semantics of the five date formats (first hit wins).
DATES = [
    ("1/5/26", dt.date(2026, 1, 5)), ("01/05/26", dt.date(2026, 1, 5)),
    ("1/5/99", dt.date(2099, 1, 5)), ("1/5/2026", None),
    ("2026-01-05", dt.date(2026, 1, 5)), ("2026-1-5", None),
    ("2026/01/05", dt.date(2026, 1, 5)), ("Jan 5 2026", dt.date(2026, 1, 5)),
    ("Jan 05 2026", dt.date(2026, 1, 5)), ("jan 5 2026", dt.date(2026, 1, 5)),
    ("January 5 2026", None), ("05-01-2026", dt.date(2026, 5, 1)),
    ("13-01-2026", None), ("32/13/2026", None), ("not a date", None), ("2026-02-30", None),
    (" 1/5/26", None), (None, None),
]


@pytest.mark.parametrize("text,expected", DATES)
def test_parse_date(spark, text, expected):
    assert one(spark, [text], C.parse_date) == [expected]


def test_shape_guard_never_narrower_than_parser(spark):
    """Unguarded and guarded parsing agree on every probe value."""
    df = spark.createDataFrame([(t,) for t, _ in DATES], "v string")
    plain = F.coalesce(*[F.try_to_date(F.col("v"), f) for f in C.DATE_FORMATS])
    got = df.select(C.parse_date("v").alias("a"), plain.alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_shape_guard_skips_unknown_fields():
    assert C.shape_guard("yyyy-MM-dd HH:mm") is None
    assert C.shape_guard("yyyy'T'MM") is None
    assert C.shape_guard("MMM d yyyy") is not None


from hypothesis import given, settings, strategies as st  # noqa: E402

TEXT = st.one_of(st.none(), st.text(alphabet=" \taB$,.USD0123-/x", max_size=12))


@settings(max_examples=20, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_value_steps_idempotent(spark, values):
    """Every value step except date parsing gives the same result when applied twice."""
    df = spark.createDataFrame([(v,) for v in values], "v string")
    steps = [C.trim_spaces, C.blank_to_null, C.case_upper, C.case_lower, C.case_title, C.clean_currency]
    for fn in steps:
        once = df.select(fn(F.col("v")).alias("v"))
        twice = once.select(fn(F.col("v")).alias("v"))
        assert [r.v for r in once.collect()] == [r.v for r in twice.collect()], fn.__name__
    nums = df.select(C.try_double(C.clean_currency("v")).alias("v"))
    for fn in (C.fix_negative, C.in_range, C.try_double):
        once = nums.select(fn(F.col("v")).alias("v"))
        assert once.collect() == once.select(fn(F.col("v")).alias("v")).collect(), fn.__name__
