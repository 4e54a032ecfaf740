"""Versions, manifests, reconciliation, mergeable profiles and duplicates across runs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablecare.operators import profile_state, reconcile
from tablecare.plans import catalog
from tablecare.plans.fixtures import dirty_orders
from tablecare.plans.run import RunLayout
from tablecare.plans.spec import ORDERS_SPEC, tagged_table
from tablecare.session import fresh_dir
from tablecare.sources import files, manifest, sinks, versions
from tablecare.sources.files import CSV_OPTIONS
from tablecare.streaming import ledger
from conftest import SF001


def test_version_is_seen_only_when_committed(spark):
    root = fresh_dir(spark, "versions")
    assert versions.current_path(spark, root) is None
    first = versions.write_version(spark.range(5).toDF("id"), root)
    assert versions.current_path(spark, root) is None
    versions.commit_version(spark, root, first)

    # a write that fails half way leaves the current version as it was
    broken = spark.range(8).select(F.when(F.col("id") < 7, F.col("id")).otherwise(
        F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.write_version(broken, root)
    with pytest.raises(ValueError):
        versions.commit_version(spark, root, "nothing")
    held = spark.read.parquet(versions.current_path(spark, root))
    second = versions.write_version(spark.range(3).toDF("id"), root)
    versions.commit_version(spark, root, second)
    assert held.count() == 5                                    # a reader of the old one goes on
    assert spark.read.parquet(versions.current_path(spark, root)).count() == 3
    assert versions.remove_old_versions(spark, root, grace_seconds=3600) == 0
    assert versions.remove_old_versions(spark, root, grace_seconds=-5) >= 1
    assert spark.read.parquet(versions.current_path(spark, root)).count() == 3


def test_latest_through_versions(spark):
    root = fresh_dir(spark, "latest")
    rows = spark.createDataFrame([(1, "a", "clean"), (2, "b", "quarantine")], "id int, t string, outcome string")
    sinks.write_latest(rows, root)
    sinks.write_latest(rows.where("id = 1"), root)
    got = sinks.read_outputs(spark, root, "csv", rows.schema, partition_cols=("outcome",))
    assert [(r.id, r.t, r.outcome) for r in got.collect()] == [(1, "a", "clean")]


def test_read_run_opens_its_folder_only(spark):
    root = fresh_dir(spark, "many")
    many = spark.range(500).select(F.col("id"), F.concat(F.lit("r"), "id").alias("run_id"))
    many.repartition(1).write.partitionBy("run_id").parquet(root)
    got = files.read_run(spark, root, "r77")
    assert [tuple(r) for r in got.collect()] == [(77, "r77")]
    assert len(got.inputFiles()) == 1
    assert "PartitionFilters" not in got._jdf.queryExecution().optimizedPlan().toString()
    missing = files.read_run(spark, root, "none", schema=got.schema)
    assert missing.columns == got.columns and missing.count() == 0
    assert files.read_run(spark, root, "none").count() == 0


def test_manifest_skips_files(spark):
    root = fresh_dir(spark, "manifest")
    rows = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, "x").alias("t"),
                                    F.array("id").alias("a"), F.col("id").cast("string").alias("odd.name"))
    sinks.load_warehouse(rows.repartitionByRange(5, "id"), root, "r/1")
    listed = manifest.write_manifest(spark, root, "r/1").collect()
    assert sum(r["rows"] for r in listed) == 1000 and len(listed) == 5
    assert len(manifest.files_of(spark, root, "r/1", {"id": (10, 20)})) == 1
    got = manifest.read_run_rows(spark, root, "r/1", {"id": (190, 210), "t": ("x", None)})
    assert sorted(r.id for r in got.collect()) == list(range(190, 211, 2))
    assert manifest.read_run_rows(spark, root, "r/1", {"id": (5000, None)}).count() == 0
    assert manifest.read_run_rows(spark, root, "r/1").count() == 1000
    assert files.read_runs(spark, root).count() == 1000          # manifests are no data


def test_reconcile_finds_what_counts_hide(spark):
    rows = [(i, f"t{i % 5}", None if i % 7 == 0 else i * 0.5) for i in range(300)] + [(1, "t1", 0.5)]
    schema = "id long, `t.x` string, v double"
    good = spark.createDataFrame(rows, schema)
    assert reconcile.reconcile(good, good.repartition(5).select("v", "id", "`t.x`")).count() == 0
    bad = [r for r in rows if r[0] != 9] + [rows[10]]            # lost and doubled: same count
    bad = [(i, "t4" if i == 20 else t, v) for i, t, v in bad]    # changed
    bad = [(i, t, {30: 15.5, 31: 15.0}.get(i, v)) for i, t, v in bad]     # swapped: same average
    got = reconcile.reconcile(good, spark.createDataFrame(bad, schema))
    want, have = Counter(rows), Counter(bad)
    assert {tuple(r) for r in got.collect()} == {
        (*k, want[k], have[k]) for k in want | have if want[k] != have[k]}
    hot = spark.createDataFrame([(5, "t", 1.0)] * 3000, schema)
    assert [r.expected_copies - r.actual_copies for r in
            reconcile.reconcile(hot, hot.limit(2999)).collect()] == [1]
    assert reconcile.reconcile(good.limit(0), good.limit(0)).count() == 0
    with pytest.raises(ValueError):
        reconcile.reconcile(good, good.drop("v"))


def test_states_merge_to_the_whole(spark):
    df = spark.range(20_000).select(
        "id", (F.col("id") % 700).cast("int").alias("k"), F.when(F.col("id") % 3 > 0, " ").alias("t"),
        (F.col("id") % 11 / 2).alias("d"), F.lit(None).cast("date").alias("nothing"))
    root = fresh_dir(spark, "states")
    for n in range(4):
        profile_state.save_state(df.where(F.col("id") % 4 == n), root, f"r{n}")
    profile_state.save_state(df.where(F.col("id") % 4 == 1), root, "r1")      # again: replaced
    got = {r["column"]: r for r in profile_state.merge_states(
        profile_state.read_states(spark, root)).collect()}
    assert {r["rows"] for r in got.values()} == {20_000}
    assert got["t"].null_count == 6667 and got["t"].blank_count == 13_333
    for c, exact in (("id", 20_000), ("k", 700), ("t", 2), ("d", 11), ("nothing", 1)):
        assert abs(got[c].distinct_estimate - exact) <= max(0.03 * exact, 0), c


def test_copies_across_files_and_restart(spark):
    """The third batch fails at every stage in turn; run again, it ends as if it had not."""
    raw = dirty_orders(spark, SF001).limit(60).cache()
    whole = Counter()
    for r in ORDERS_SPEC.apply(raw.union(raw.limit(20))).collect():
        whole[r] += 1
    layout = RunLayout(fresh_dir(spark, "across"), "parquet")
    some = [raw.where("`Order ID` < 'o3'"), raw.where("NOT coalesce(`Order ID` < 'o3', false)"), raw.limit(20)]
    for n, part in enumerate(some[:2]):
        assert ledger.run_across(part, ORDERS_SPEC, layout, f"r{n}") == []
    write, calls = ledger._write_ledger, []

    def breaks(*args):
        calls.append(args[3])
        if len(calls) < 3:
            raise RuntimeError("lost")
        write(*args)

    ledger._write_ledger = breaks
    try:
        for _ in range(2):
            with pytest.raises(RuntimeError, match="lost"):
                ledger.run_across(some[2], ORDERS_SPEC, layout, "r2")
        ledger.run_across(some[2], ORDERS_SPEC, layout, "r2")
    finally:
        ledger._write_ledger = write
    got = sinks.read_outputs(spark, layout.runs, "parquet").drop("run_id", "outcome")
    assert Counter(got.collect()) == whole
    assert ledger.run_across(some[2], ORDERS_SPEC, layout, "r2") == []        # nothing left to correct
    raw.unpersist()


def test_no_task_holds_a_whole_arrival(spark, tmp_path, monkeypatch):
    """Each arrival of the stream is many files and one run; copies across arrivals are found."""
    spark.range(3000).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice",
        "date'1996-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    started, start = [], ledger.start_ledger_stream
    monkeypatch.setattr(ledger, "start_ledger_stream", lambda *a, **k: started.append(a) or start(*a, **k))
    monkeypatch.setattr(catalog, "ARRIVAL_ROWS", 100)
    got = catalog.q_stream_duplicates(spark, str(tmp_path))
    source, layout = started[0][1], started[0][4]
    sizes = spark.read.options(**CSV_OPTIONS).csv(source).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 100 and len(sizes) >= 33
    assert spark.read.parquet(layout.runs).select("run_id").distinct().count() == 3
    want = tagged_table(dirty_orders(spark, str(tmp_path)), ORDERS_SPEC)
    assert Counter(got.select(want.columns).collect()) == Counter(want.collect())
    assert got.where("duplicate_row").count() > 0
