import os

from pyspark.sql import functions as F

from tablecare.plans.fixtures import dirty_orders
from tablecare.plans.run import RunLayout, run_table
from tablecare.plans.spec import ORDERS_SPEC
from tablecare.session import fresh_dir
from tablecare.sources import sinks
from tablecare.sources.files import string_schema
from tablecare.streaming.runs import batch_run_id, start_run_stream
from conftest import SF001

ARGS = ("order_type", "status", "base_price")


def test_run_end_to_end_and_rerun(spark):
    layout = RunLayout(fresh_dir(spark, "t_e2e"))
    raw = dirty_orders(spark, SF001)
    a = run_table(raw, ORDERS_SPEC, layout, "r1", *ARGS).collect()[0]
    assert (a.total_rows, a.clean_rows, a.quarantine_rows, a.load_complete) == (1650, 711, 939, True)
    run_table(raw, ORDERS_SPEC, layout, "r1", *ARGS).collect()  # same run again
    wh = spark.read.parquet(layout.warehouse)
    assert wh.where("run_id = 'r1'").count() == 711
    outs = sinks.read_outputs(spark, layout.runs, "csv", None)
    assert outs.where("run_id = 'r1'").count() == 1650
    rep = spark.read.parquet(layout.reports)
    assert rep.where("run_id = 'r1'").count() == 12


def test_stream_each_file_is_a_run(spark):
    src = fresh_dir(spark, "t_stream_src")
    raw = dirty_orders(spark, SF001)
    os.makedirs(src)
    # two raw files, written one after the other: two runs
    for i, part in enumerate([raw.where(F.col("Status").isin("o", "O")), raw.where(~F.col("Status").isin("o", "O"))]):
        tmp = fresh_dir(spark, "t_stream_part")
        part.coalesce(1).write.options(**sinks.CSV_WRITE_OPTIONS).csv(tmp)
        name = [f for f in os.listdir(tmp) if f.endswith(".csv")][0]
        os.link(os.path.join(tmp, name), os.path.join(src, f"file{i}.csv"))
    layout = RunLayout(fresh_dir(spark, "t_stream_out"))
    q = start_run_stream(spark, src, string_schema(raw.columns), ORDERS_SPEC, layout,
                         fresh_dir(spark, "t_stream_ckpt"), *ARGS)
    q.awaitTermination(300)
    wh = spark.read.parquet(layout.warehouse)
    runs = sorted(r.run_id for r in wh.select("run_id").distinct().collect())
    assert runs == [batch_run_id(0), batch_run_id(1)]
    outs = sinks.read_outputs(spark, layout.runs, "csv", None)
    assert outs.count() == 1650
