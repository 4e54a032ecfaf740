from pyspark.sql import functions as F

import os

import pytest

from tablecare.operators.validate import run_summary, validate_load, validate_load_sql
from tablecare.session import fresh_dir
from tablecare.sources import sinks
from tablecare.sources.files import read_run


def tagged(spark):
    return spark.createDataFrame(
        [("A", "x", 1.0, "clean"), ("B", "y", 3.0, "clean"), ("C", None, None, "quarantine")],
        "id string, kind string, price double, outcome string")


def test_rerun_of_a_run_does_not_double(spark):
    root = fresh_dir(spark, "t_runs")
    t = tagged(spark)
    for run in ("r1", "r2", "r1"):
        sinks.write_run(t, root, run)
    back = sinks.read_outputs(spark, root, "csv", t.schema)
    got = {(r.run_id, r.outcome): r.n for r in back.groupBy("run_id", "outcome").agg(F.count("*").alias("n")).collect()}
    assert got == {("r1", "clean"): 2, ("r1", "quarantine"): 1, ("r2", "clean"): 2, ("r2", "quarantine"): 1}
    summary = {r.run_id: (r.clean_rows, r.quarantine_rows) for r in run_summary(back).collect()}
    assert summary == {"r1": (2, 1), "r2": (2, 1)}


def test_publish_latest_replaced(spark):
    root = fresh_dir(spark, "t_pub")
    t = tagged(spark)
    sinks.publish(t, root, "r1")
    runs, latest = sinks.publish(t.where("id != 'B'"), root, "r2")
    last = sinks.read_outputs(spark, latest, "csv", t.schema, partition_cols=("outcome",))
    assert {r.run_id for r in last.collect()} == {"r2"} and last.count() == 2
    assert sinks.read_outputs(spark, runs, "csv", t.schema).count() == 5


def test_warehouse_read_run_prunes_partitions(spark):
    root = fresh_dir(spark, "t_wh")
    clean = tagged(spark).where("outcome = 'clean'").drop("outcome")
    for run in ("r1", "r2", "r1"):
        sinks.load_warehouse(clean, root, run)
    one = read_run(spark, root, "r2")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "run_id" in plan
    v = validate_load(spark.read.parquet(root), "r1", "kind", "id", "price").collect()[0]
    assert (v.clean_rows, v.distinct_types, v.distinct_statuses, v.average_price) == (2, 2, 2, 2.0)
    s = validate_load_sql(spark, spark.read.parquet(root), "r1", "kind", "id", "price").collect()[0]
    assert tuple(s) == tuple(v)


def test_validation_sql_binds_the_run_id(spark):
    table = spark.createDataFrame([("a", "x", 1.0, "it's"), ("b", "y", 3.0, "other")],
                                  "kind string, status string, price double, run_id string")
    v = validate_load_sql(spark, table, "it's", "kind", "status", "price").collect()[0]
    assert (v.clean_rows, v.distinct_types, v.average_price) == (1, 1, 1.0)
    none = validate_load_sql(spark, table, "x' OR '1'='1", "kind", "status", "price").collect()[0]
    assert none.clean_rows == 0


def test_rerun_without_an_outcome_leaves_nothing_behind(spark):
    root = fresh_dir(spark, "rerun")
    rows = spark.createDataFrame([(1, "clean"), (2, "quarantine")], "id int, outcome string")
    sinks.write_run(rows, root, "r1", "parquet")
    sinks.write_run(rows, root, "r2", "parquet")
    sinks.write_run(rows.filter("id = 1"), root, "r1", "parquet")
    got = sorted((r["run_id"], r["outcome"]) for r in sinks.read_outputs(spark, root, "parquet").collect())
    assert got == [("r1", "clean"), ("r2", "clean"), ("r2", "quarantine")]
    house = fresh_dir(spark, "house")
    sinks.load_warehouse(rows, house, "r1")
    sinks.load_warehouse(rows.limit(0), house, "r1")
    assert read_run(spark, house, "r1").count() == 0


def test_run_ids_are_strings(spark):
    house = fresh_dir(spark, "ids")
    for i, run in enumerate(["007", "7", "2026-07-11", "20260711_164412", "a=b/c"]):
        sinks.load_warehouse(spark.createDataFrame([(i,)], "id int"), house, run)
        assert [r["id"] for r in read_run(spark, house, run).collect()] == [i]


AWKWARD = ["plain", "two\nlines", 'a "quoted" word', "comma, here", "back\\", 'mix\\"ed\n,"end"', " spaced ",
           "cr\r\nlf", "", None]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_texts_survive_both_copies(spark, tmp_path, fmt):
    rows = [(i, text, "clean" if i % 2 else "quarantine") for i, text in enumerate(AWKWARD)]
    tagged = spark.createDataFrame(rows, "id long, text string, outcome string")
    runs, latest = sinks.publish(tagged, str(tmp_path / "out"), "r1", fmt)
    for root, parts in ((runs, ("outcome", "run_id")), (latest, ("outcome",))):
        back = sinks.read_outputs(spark, root, fmt, tagged.schema, parts)
        assert sorted(map(tuple, back.select("id", "text", "outcome").collect())) == rows


def test_staged_files_go_when_the_block_ends(spark):
    df = spark.range(5)
    with sinks.staged(df, "owned") as rows:
        assert rows.count() == 5
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
