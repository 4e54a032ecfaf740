"""Registered queries: one per operator, each over the driver's tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose work grows
with the input tables. Cleaning operators run on ``dirty_orders`` (derived from
``orders``), one declared step at a time; the text operators run on
``documents``, ``pages``, ``events``, ``conversations`` and ``part``. Queries
that exercise sinks write into a fresh folder under the shared checkpoint root
and return what was written, read back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecare.functions.text import Rule, categorize as categorize_col, short_name as short_name_col
from tablecare.operators import (duplicates, frames, profile as prof, profile_state, reconcile,
                                 rule_table, search_index, split as sp, usage, validate)
from tablecare.plans.fixtures import dirty_orders, read_table
from tablecare.plans.run import RunLayout, run_table
from tablecare.plans.spec import ORDERS_SPEC, Spec, Step, clean_table, tagged_table
from tablecare.session import fresh_dir
from tablecare.sources import files, headers, manifest, sinks, versions
from tablecare.streaming import ledger

Query = Callable[[SparkSession, str], DataFrame]

SPEC = ORDERS_SPEC
REQUIRED = SPEC.required()
FLAG = SPEC.flag()
RAW_ID = "Order ID"
RAW_WATCH = ("Order Type", "Status", "Risk Level")
RUN_A, RUN_B = "run_a", "run_b"

# Fixed rule lists used by the categorising queries (first hit wins).
URL_RULES = (
    Rule("contains", "?page=", "paged"),
    Rule("suffix", "#top", "anchored"),
    Rule("prefix", "https://m.", "mobile"),
    Rule("prefix", "https://", "secure"),
)
PART_RULES = (
    Rule("exact", "ECONOMY", "budget"),
    Rule("set", ("SMALL", "MEDIUM"), "sized"),
    Rule("contains", "OMO", "promo"),
    Rule("prefix", "STAND", "standard"),
)
ARRIVAL_ROWS = 500_000      # of one file of a stream
INDEX_NEEDLES = ("Licen", "SECRET", "no such passage", "q.")
HOST_PATTERN = r"^[a-z]+://([^/?#]+)"


def _upto(step: str) -> Query:
    return lambda spark, d: SPEC.upto(step).apply(dirty_orders(spark, d))


def _cleaned(spark, d) -> DataFrame:
    """All value steps, before the duplicate flag."""
    return SPEC.upto("range_check").apply(dirty_orders(spark, d))


def _flagged(spark, d, null_safe=False) -> DataFrame:
    return SPEC.replace("flag_duplicates", null_safe=null_safe).upto("flag_duplicates").apply(
        dirty_orders(spark, d))


def _split(spark, d, with_reasons=False):
    return clean_table(dirty_orders(spark, d), SPEC, with_reasons)


def _tagged(spark, d) -> DataFrame:
    return tagged_table(dirty_orders(spark, d), SPEC)


# ---- sources and sinks -------------------------------------------------------

def q_scan_csv(spark, d):
    root = fresh_dir(spark, "scan_csv")
    raw = dirty_orders(spark, d)
    raw.write.options(**sinks.CSV_WRITE_OPTIONS).csv(root)
    return files.read_csv(spark, root, schema=files.string_schema(raw.columns))


def q_scan_csv_permissive(spark, d):
    """Explicit schema, PERMISSIVE mode, ragged lines kept whole in ``_corrupt_record``."""
    root = fresh_dir(spark, "scan_csv_permissive")
    raw = dirty_orders(spark, d)
    raw.write.options(**sinks.CSV_WRITE_OPTIONS).csv(root)
    return files.read_csv(spark, root, schema=files.string_schema(raw.columns),
                          corrupt_column="_corrupt_record")


def q_scan_csv_infer(spark, d):
    """The source pipeline's scan: header plus type inference (messy columns stay text)."""
    root = fresh_dir(spark, "scan_csv_infer")
    dirty_orders(spark, d).write.options(**sinks.CSV_WRITE_OPTIONS).csv(root)
    return files.read_csv(spark, root, infer=True)


def _write_two_runs(spark, d) -> tuple[str, DataFrame]:
    root = fresh_dir(spark, "runs")
    tagged = sinks.stage(_tagged(spark, d), "tagged")
    for run in (RUN_A, RUN_B, RUN_A):  # the repeated run must not double
        sinks.write_run(tagged, root, run)
    return root, sinks.read_outputs(spark, root, "csv", tagged.schema)


def q_sink_run_csv(spark, d):
    return _write_two_runs(spark, d)[1]


def q_run_summary(spark, d):
    return validate.run_summary(_write_two_runs(spark, d)[1])


def q_sink_latest_and_runs(spark, d):
    root = fresh_dir(spark, "publish")
    tagged = sinks.stage(_tagged(spark, d), "tagged")
    for run in (RUN_A, RUN_B):
        runs, latest = sinks.publish(tagged, root, run)
    schema = tagged.schema
    hist = sinks.read_outputs(spark, runs, "csv", schema).withColumn("copy", F.lit("runs"))
    last = (sinks.read_outputs(spark, latest, "csv", schema, partition_cols=("outcome",))
                 .withColumn("copy", F.lit("latest")))
    return hist.unionByName(last)


def q_scan_csv_ragged(spark, d):
    """Lines with too few or too many cells are kept whole in ``_corrupt_record``."""
    root = fresh_dir(spark, "scan_csv_ragged")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    line = (F.when(F.col("o_orderkey") % 7 == 0, key)
            .when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", key, status, F.lit("more")))
            .otherwise(F.concat_ws(",", key, status)))
    read_table(spark, d, "orders").select(line.alias("value")).write.text(root)
    return files.read_csv(spark, root, schema=files.string_schema(["o_orderkey", "o_orderstatus"]),
                          corrupt_column="_corrupt_record", header="false")


def q_scan_csv_headers(spark, d):
    """Files with three header orders, one without a column, one of them with ragged lines."""
    root = fresh_dir(spark, "scan_csv_headers")
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    part = lambda n: rows.where(F.col("o_orderkey") % 4 == n)
    whole = lambda df, names: df.toDF(*names).write.mode("append").options(
        **sinks.CSV_WRITE_OPTIONS).csv(root)
    whole(part(0), ["Order Key", "Cust Key", "Status"])
    whole(part(1).select("o_orderstatus", "o_orderkey", "o_custkey"), ["status", "order_key", "cust_key"])
    whole(part(2).select("o_custkey", "o_orderkey"), ["Cust Key", "Order Key"])
    key = F.col("o_orderkey")
    line = F.when(key % 7 == 0, F.concat_ws(",", "o_custkey", "o_orderstatus", key)).otherwise(
        F.concat_ws(",", "o_custkey", "o_orderstatus", key, F.lit("more")))
    lines = part(3).select(F.expr("o_orderkey div 4 % 8").alias("file"), key, line.alias("value"))
    heads = spark.range(8).select(F.col("id").alias("file"), F.lit(None).cast("long").alias("o_orderkey"),
                                  F.lit("CUST KEY,STATUS,ORDER KEY").alias("value"))
    (lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "o_orderkey")   # NULLs first
     .select("file", "value").write.partitionBy("file").text(f"{root}/ragged"))
    found = headers.read_csv_by_header(spark, root)
    ragged = F.col("_corrupt_record")
    return found.select("order_key", "cust_key", "status", ragged.isNotNull().alias("ragged"),
                        F.when(ragged.isNotNull(), F.col("source_line")).alias("line"))


def q_sink_csv_texts(spark, d):
    """Texts with line breaks, quotes, commas and backslashes, published and read back."""
    root = fresh_dir(spark, "publish_texts")
    docs = read_table(spark, d, "documents").select(
        "doc_id", F.concat("text", F.lit('\n"'), "source", F.lit('", end\\')).alias("text"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(sp.QUARANTINE)).otherwise(F.lit(sp.CLEAN)).alias("outcome"))
    _, latest = sinks.publish(docs, root, RUN_A)
    return sinks.read_outputs(spark, latest, "csv", docs.schema, partition_cols=("outcome",))


def q_rerun_replaces_run(spark, d):
    """A rerun without quarantine rows leaves none of the first try, in outputs and warehouse."""
    root = fresh_dir(spark, "rerun")
    rows = read_table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(sp.QUARANTINE))
        .otherwise(F.lit(sp.CLEAN)).alias("outcome"))
    for again in (rows, rows.where(F.col("outcome") == F.lit(sp.CLEAN))):
        sinks.write_run(again, f"{root}/runs", RUN_A)
    for run in (RUN_A, RUN_B):
        sinks.load_warehouse(rows, f"{root}/warehouse", run)
    sinks.load_warehouse(rows.where(F.lit(False)), f"{root}/warehouse", RUN_A)     # an empty reload
    kept = sinks.read_outputs(spark, f"{root}/runs", "csv", rows.schema)
    loaded = files.read_runs(spark, f"{root}/warehouse", schema=rows.schema)
    return (kept.withColumn("place", F.lit("runs"))
            .unionByName(loaded.withColumn("place", F.lit("warehouse"))))


def _warehouse(spark, d) -> str:
    root = fresh_dir(spark, "warehouse")
    clean = sinks.stage(_split(spark, d).clean, "clean")
    for run in (RUN_A, RUN_B, RUN_A):
        sinks.load_warehouse(clean, root, run)
    return root


def q_sink_warehouse(spark, d):
    return files.read_runs(spark, _warehouse(spark, d))


def q_read_run(spark, d):
    return files.read_run(spark, _warehouse(spark, d), RUN_B)


def q_latest_survives(spark, d):
    """A latest copy while its next version is broken off, and after the one that follows."""
    root = fresh_dir(spark, "versions")
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    read = lambda: sinks.read_outputs(spark, root, "parquet", rows.schema)
    versions.commit_version(spark, root, versions.write_version(rows.where("o_orderkey % 2 = 0"), root))
    versions.write_version(rows.where("o_orderkey % 3 = 0"), root)      # written, never committed
    during = read().withColumn("copy", F.lit("during"))
    versions.commit_version(spark, root, versions.write_version(rows.where("o_orderkey % 5 = 0"), root))
    return during.unionByName(read().withColumn("copy", F.lit("after"))).drop("run_id")


def q_read_run_manifest(spark, d):
    """One run's rows in a range of keys, from the files that its manifest names."""
    root = fresh_dir(spark, "manifest")
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for run in (RUN_A, RUN_B):
        sinks.load_warehouse(rows.repartitionByRange(6, "o_orderkey"), root, run)
        manifest.write_manifest(spark, root, run)
    return manifest.read_run_rows(spark, root, RUN_B, {"o_orderkey": (1000, 3000)})


def q_stream_duplicates(spark, d):
    """Copies that come in different files of one stream, the files of each arrival a run: outcomes of all runs."""
    root = fresh_dir(spark, "stream")
    raw = dirty_orders(spark, d)
    number = F.regexp_extract(F.col("`Order ID`"), r"\d+", 0).cast("long")
    first = raw.dropDuplicates([RAW_ID])
    again = raw.groupBy(*[f"`{c}`" for c in raw.columns]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = [first.where(number % 2 == 0), first.where(number % 2 == 1), again.drop("n")]
    layout = RunLayout(f"{root}/out", "parquet")
    for part in parts:      # files written by all tasks; the stream goes on with them as one run
        (part.write.mode("append").options(**sinks.CSV_WRITE_OPTIONS)
         .option("maxRecordsPerFile", ARRIVAL_ROWS).csv(f"{root}/in"))
        ledger.start_ledger_stream(spark, f"{root}/in", files.string_schema(raw.columns), SPEC, layout,
                                   f"{root}/checkpoint", files_per_run=None).awaitTermination()
    return sinks.read_outputs(spark, layout.runs, "parquet").drop("run_id")


def q_reconcile_load(spark, d):
    """Rows lost, doubled and changed by a load whose count agrees with its source."""
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    loaded = (rows.where(key % 97 != 5).unionByName(rows.where(key % 97 == 6))
              .withColumn("o_custkey", F.when(key % 97 == 7, F.col("o_custkey") + 1)
                          .otherwise(F.col("o_custkey"))))
    root = fresh_dir(spark, "reconcile")
    sinks.load_warehouse(loaded, root, RUN_A)
    return reconcile.reconcile(rows, files.read_run(spark, root, RUN_A).drop("run_id"))


def q_profile_merged(spark, d):
    """Profile of two runs from their stored states, its estimates held against exact counts."""
    root, rows = fresh_dir(spark, "states"), read_table(spark, d, "lineitem")
    for run, part in ((RUN_A, 0), (RUN_B, 1), (RUN_A, 0)):
        profile_state.save_state(rows.where(F.pmod("l_orderkey", F.lit(2)) == part), root, run)
    merged = profile_state.merge_states(profile_state.read_states(spark, root))
    exact = prof.distinct_counts(rows)
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.04 * F.col("distinct_count")
    return merged.join(exact, "column").select("column", "schema", "null_count", "blank_count",
                                               close.alias("distinct_close"))


def q_validate_load(spark, d):
    table = files.read_runs(spark, _warehouse(spark, d))
    return validate.validate_load(table, RUN_A, "order_type", "status", "base_price")


def q_validate_load_sql(spark, d):
    table = files.read_runs(spark, _warehouse(spark, d))
    return validate.validate_load_sql(spark, table, RUN_B, "order_type", "status", "base_price")


def q_stamp_run_id(spark, d):
    return frames.stamp_run_id(_split(spark, d).clean, RUN_A)


def q_run_end_to_end(spark, d):
    layout = RunLayout(fresh_dir(spark, "end_to_end"))
    raw = dirty_orders(spark, d)
    args = ("order_type", "status", "base_price")
    run_table(raw, SPEC, layout, RUN_A, *args).collect()
    return run_table(raw, SPEC, layout, RUN_B, *args)


def q_preview(spark, d):
    return frames.preview(read_table(spark, d, "orders"), 30, ["o_orderkey"])


# ---- cleaning steps ----------------------------------------------------------

def q_fill_default(spark, d):
    marked = duplicates.mark_duplicates_left(_cleaned(spark, d), flag=FLAG)
    return frames.fill_default(marked, False, [FLAG])


def q_null_check(spark, d):
    return sp.null_check(_cleaned(spark, d), REQUIRED)


def q_duplicate_groups(spark, d):
    return duplicates.duplicate_groups(_cleaned(spark, d))


def q_quarantine_rows(spark, d):
    return sp.quarantine_rows(_flagged(spark, d), REQUIRED, FLAG)


def q_clean_rows(spark, d):
    return sp.clean_rows(_flagged(spark, d), REQUIRED, FLAG)


def q_clean_table(spark, d):
    return _split(spark, d).clean


def q_quarantine_table(spark, d):
    q = _split(spark, d, with_reasons=True).quarantine
    return q.withColumn("reasons", F.array_join("reasons", ","))


def q_quarantine_unparsable(spark, d):
    """Prices with a currency sign, which no step takes off here, go to quarantine."""
    steps = [s for s in SPEC.steps if s.name != "clean_currency"]
    at = [s.name for s in steps].index("try_cast_double") + 1
    steps.insert(at, Step("flag_unparsable", ("base_price",), {"original": "preserve_price"}))
    q = clean_table(dirty_orders(spark, d), Spec(tuple(steps)), with_reasons=True).quarantine
    return q.withColumn("reasons", F.array_join("reasons", ","))


def q_flag_duplicates_first(spark, d):
    """All but the first order of a customer, status and price are flagged."""
    return duplicates.flag_duplicates(
        _cleaned(spark, d), ["customer_name", "status", "risk_level"], FLAG, keep="first",
        order=["created_date", "order_id"])


def q_split_summary(spark, d):
    return sp.split_summary(_flagged(spark, d), REQUIRED, FLAG)


def q_plan_steps(spark, d):
    return _tagged(spark, d)


# ---- profiles ----------------------------------------------------------------

def q_row_count(spark, d):
    return prof.row_count(dirty_orders(spark, d))


def q_distinct_counts(spark, d):
    return prof.distinct_counts(dirty_orders(spark, d))


def q_duplicate_ids(spark, d):
    return prof.duplicate_ids(dirty_orders(spark, d), RAW_ID)


def q_profile(spark, d):
    return prof.profile(_flagged(spark, d))


def q_profile_raw(spark, d):
    return prof.profile(dirty_orders(spark, d))


def q_profile_lineitem(spark, d):
    return prof.profile(read_table(spark, d, "lineitem"))


def q_findings(spark, d):
    return prof.findings(dirty_orders(spark, d), RAW_ID, RAW_WATCH)


def q_profile_diff(spark, d):
    return prof.profile_diff(dirty_orders(spark, d), _split(spark, d).clean)


# ---- re-aimed table operators ------------------------------------------------

def q_keyword_search(spark, d):
    docs = read_table(spark, d, "documents")
    return frames.keyword_search(docs, "Licen", ["text", "lang", "source"])


def q_keyword_search_pages(spark, d):
    pages = read_table(spark, d, "pages")
    return frames.keyword_search(pages, "Example.ORG", ["url", "html"]).select("page_id", "url")


def q_keyword_search_index(spark, d):
    """Needles looked up in the trigram index: in many texts, in few, in none, and too short for it."""
    root = fresh_dir(spark, "search_index")
    docs = read_table(spark, d, "documents").select("doc_id", "text", "source")
    search_index.build_index(docs, root, ["text", "source"])
    found = [search_index.search_index(spark, root, needle, ["text", "source"])
             .select(F.lit(needle).alias("needle"), "doc_id") for needle in INDEX_NEEDLES]
    return functools.reduce(DataFrame.unionByName, found)


def q_usage_index(spark, d):
    idx = usage.usage_index(read_table(spark, d, "events"), "event_type", "props", "user_id")
    return idx.select("key", "used", F.array_join("types", "|").alias("types"),
                      F.array_join(F.transform("examples", lambda x: x.cast("string")), ",")
                       .alias("examples"), "more")


def q_categorize(spark, d):
    pages = read_table(spark, d, "pages")
    return pages.select("page_id", "url", categorize_col("url", URL_RULES, "plain").alias("category"))


def q_categorize_parts(spark, d):
    part = read_table(spark, d, "part")
    return part.select("p_partkey", "p_type",
                       categorize_col("p_type", PART_RULES, "other").alias("category"))


def q_categorize_table(spark, d):
    """Urls by a rule table as long as the data is: whole urls, starts, ends and parts of some."""
    pages = read_table(spark, d, "pages")
    some = lambda n, r: pages.where(F.col("page_id") % n == r)
    rule = lambda rows, kind, pattern: rows.select(
        F.col("page_id").alias("number"), F.lit(kind).alias("kind"), pattern.alias("pattern"),
        F.concat(F.lit(kind[0]), F.col("page_id").cast("string")).alias("label"))
    url = F.col("url")
    rules = (rule(some(6, 1), "exact", url).unionByName(rule(some(12, 2), "prefix", F.substring(url, 1, 19)))
             .unionByName(rule(some(12, 3), "suffix", F.right(url, F.lit(2))))
             .unionByName(rule(some(12, 4), "contains", F.substring(url, 15, 7)))
             .unionByName(rule(some(60, 5), "contains", F.right(url, F.lit(2)))))
    return rule_table.categorize_by_table(pages.select("page_id", "url"), "url", rules, default="plain")


def q_named_entries(spark, d):
    return frames.named_entries(read_table(spark, d, "conversations"), ["conv_id"], "role", "text", "turn")


def q_usage_types(spark, d):
    return usage.usage_types(read_table(spark, d, "events"), "event_type", "props")


def q_short_name(spark, d):
    pages = read_table(spark, d, "pages")
    host = F.regexp_extract("url", HOST_PATTERN, 1)
    return pages.select("page_id", host.alias("host"), short_name_col(host).alias("short_name"))


def q_named_map(spark, d):
    conv = read_table(spark, d, "conversations")
    m = frames.named_map(conv, ["conv_id"], "role", "text", "turn", out="named")
    return m.select("conv_id", F.size("named").alias("names"),
                    F.col("named")["user"].alias("user_text"),
                    F.col("named")["assistant"].alias("assistant_text"),
                    F.col("named")["system"].alias("system_text"))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_csv": q_scan_csv,
    "scan_csv_infer": q_scan_csv_infer,
    "scan_csv_permissive": q_scan_csv_permissive,
    "scan_csv_ragged": q_scan_csv_ragged,
    "scan_csv_headers": q_scan_csv_headers,
    "sink_csv_texts": q_sink_csv_texts,
    "rerun_replaces_run": q_rerun_replaces_run,
    "read_run": q_read_run,
    "sink_run_csv": q_sink_run_csv,
    "sink_latest_and_runs": q_sink_latest_and_runs,
    "latest_survives": q_latest_survives,
    "read_run_manifest": q_read_run_manifest,
    "reconcile_load": q_reconcile_load,
    "categorize_table": q_categorize_table,
    "named_entries": q_named_entries,
    "usage_types": q_usage_types,
    "stream_duplicates": q_stream_duplicates,
    "profile_merged": q_profile_merged,
    "sink_warehouse": q_sink_warehouse,
    "stamp_run_id": q_stamp_run_id,
    "preview": q_preview,
    # projections, one declared step at a time
    "normalize_headers": _upto("normalize_headers"),
    "trim_strings": _upto("trim"),
    "blank_to_null": _upto("blank_to_null"),
    "case_upper": _upto("upper"),
    "case_title": _upto("initcap"),
    "case_lower": _upto("lower"),
    "preserve_original": _upto("preserve_original"),
    "clean_currency": _upto("clean_currency"),
    "cast_price": _upto("try_cast_double"),
    "flag_negative": _upto("flag_negative"),
    "fix_negative": _upto("fix_negative"),
    "parse_dates": _upto("try_parse_date"),
    "try_cast_int": _upto("try_cast_int"),
    "range_check": _upto("range_check"),
    "fill_default": q_fill_default,
    # filters, duplicates, split
    "null_check": q_null_check,
    "duplicate_groups": q_duplicate_groups,
    "flag_duplicates": lambda s, d: _flagged(s, d),
    "flag_duplicates_nullsafe": lambda s, d: _flagged(s, d, null_safe=True),
    "flag_duplicates_join": lambda s, d: SPEC.replace("flag_duplicates", method="join")
                                             .upto("flag_duplicates").apply(dirty_orders(s, d)),
    "flag_duplicates_fingerprint": lambda s, d: SPEC.replace("flag_duplicates", method="fingerprint")
                                                    .upto("flag_duplicates").apply(dirty_orders(s, d)),
    "quarantine_rows": q_quarantine_rows,
    "clean_rows": q_clean_rows,
    "clean_table": q_clean_table,
    "quarantine_table": q_quarantine_table,
    "quarantine_unparsable": q_quarantine_unparsable,
    "flag_duplicates_first": q_flag_duplicates_first,
    "split_summary": q_split_summary,
    "plan_steps": q_plan_steps,
    # aggregates and reports
    "row_count": q_row_count,
    "distinct_counts": q_distinct_counts,
    "duplicate_ids": q_duplicate_ids,
    "profile": q_profile,
    "profile_raw": q_profile_raw,
    "profile_lineitem": q_profile_lineitem,
    "findings": q_findings,
    "profile_diff": q_profile_diff,
    "validate_load": q_validate_load,
    "validate_load_sql": q_validate_load_sql,
    "run_summary": q_run_summary,
    "run_end_to_end": q_run_end_to_end,
    # re-aimed operators
    "keyword_search": q_keyword_search,
    "keyword_search_pages": q_keyword_search_pages,
    "keyword_search_index": q_keyword_search_index,
    "usage_index": q_usage_index,
    "categorize": q_categorize,
    "categorize_parts": q_categorize_parts,
    "short_name": q_short_name,
    "named_map": q_named_map,
}


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: how many rows of the dirty table are clean and how many quarantined."""
    return q_split_summary(spark, sf_dir)
