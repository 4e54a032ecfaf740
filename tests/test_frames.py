import pytest
from pyspark.sql import functions as F

from tablecare.operators import frames
from conftest import rows


def test_normalize_headers(spark):
    df = spark.createDataFrame([("a", "b")], "`Monster ID` string, `Status` string")
    assert frames.normalize_headers(df).columns == ["monster_id", "status"]


def test_normalize_headers_collision_raises(spark):
    df = spark.createDataFrame([("a", "b")], "`A b` string, `a_b` string")
    with pytest.raises(ValueError, match="both normalise"):
        frames.normalize_headers(df)


def test_string_sweeps_touch_only_strings(spark):
    df = spark.createDataFrame([("  x ", 1, "   "), (None, 2, " y")], "s string, n int, t string")
    out = frames.blank_to_null(frames.trim_strings(df))
    assert rows(out) == sorted([("x", 1, None), (None, 2, "y")], key=repr)
    assert dict(out.dtypes)["n"] == "int"


def test_preserve_and_fill(spark):
    df = spark.createDataFrame([("a", None), ("b", True)], "k string, f boolean")
    kept = frames.preserve_columns(df, {"k": "k_orig"})
    assert kept.columns == ["k", "f", "k_orig"]
    with pytest.raises(ValueError):
        frames.preserve_columns(df, {"k": "f"})
    assert rows(frames.fill_default(df, False, ["f"])) == [("a", False), ("b", True)]


def test_keyword_search(spark):
    df = spark.createDataFrame([("upload_file", "Uploads A FILE"), ("_private_file", None),
                                ("other", "nothing")], "name string, doc string")
    hit = frames.keyword_search(df, "FILE", ["name", "doc"])
    assert sorted(r.name for r in hit.collect()) == ["_private_file", "upload_file"]
    public = frames.keyword_search(df, "file", ["name"], include_private=False, name_column="name")
    assert [r.name for r in public.collect()] == ["upload_file"]
    with pytest.raises(ValueError, match="invalid search columns"):
        frames.keyword_search(df, "x", ["nope"])


def test_preview_flag(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    p = frames.preview(df, 3, ["k"])
    assert [(r.k, r.truncated) for r in p.collect()] == [(0, True), (1, True), (2, True)]
    full = frames.preview(df, 10, ["k"])
    assert full.count() == 10 and not any(r.truncated for r in full.collect())


def test_named_map_last_wins(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"),
         (2, 0, None, "x"), (2, 1, "system", "s")], "g long, t long, role string, text string")
    m = {r.g: r.named for r in frames.named_map(df, ["g"], "role", "text", "t").collect()}
    assert m == {1: {"assistant": "hello", "user": "bye"}, 2: {"system": "s"}}
