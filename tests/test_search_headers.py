import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablecare.operators import search_index
from tablecare.operators.duplicates import flag_duplicates
from tablecare.operators.frames import keyword_search
from tablecare.plans.spec import ORDERS_SPEC, Spec, Step, clean_table
from tablecare.session import fresh_dir
from tablecare.sources.headers import header_names, read_csv_by_header


@pytest.fixture(scope="module")
def indexed(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abAB é😀.\n") for _ in range(n))
    data = [(i, word(rng.randrange(0, 40)), word(5)) for i in range(300)]
    data += [(900, None, None), (901, "", None), (902, "x" * 40_000 + "needle" + "y" * 70_000, "b"),
             (903, "z" * (search_index.PIECE - 2) + "across", None), (900, None, None)]
    df = spark.createDataFrame(data, "id long, `t.x` string, u string").repartition(5)
    root = fresh_dir(spark, "index")
    search_index.build_index(df, root, ["t.x", "u"], blocks=4)
    return df, root


@pytest.mark.parametrize("needle", ["aba", "ABAB", "é😀.", "a", "", "needle", "across", "zacross", "ab\na", "qqq",
                                    "xneedley", "bab a"])
def test_index_gives_the_rows_of_the_scan(spark, indexed, needle):
    df, root = indexed
    got = search_index.search_index(spark, root, needle, ["t.x", "u"])
    assert got.columns == df.columns
    want = keyword_search(df, needle, ["t.x", "u"])
    assert rows(got.toDF("id", "t", "u")) == rows(want.toDF("id", "t", "u"))


def test_index_reads_blocks_with_candidates_only(spark, indexed):
    _, root = indexed
    got = search_index.search_index(spark, root, "needle", ["t.x", "u"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    rows_scan = next(x for x in plan.splitlines() if "FileScan" in x and "t.x" in x)
    assert "PartitionFilters: [isnotnull(__block" in rows_scan.replace("PartitionFilters: [(", "PartitionFilters: [")
    assert "__block#" in rows_scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "gram" in plan and "EqualTo(gram" in plan or "In(gram" in plan
    none = search_index.search_index(spark, root, "qqqqq", ["u"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in none and "Join" not in none


def test_postings_are_lists_made_in_one_pass(spark, indexed):
    """No entry is a row in a shuffle: a list a gram and chunk, each row once, whatever the alphabet."""
    df, root = indexed
    postings = search_index._postings(spark, root)
    assert postings.columns == ["gram", "block", "base", "rows", "bucket"]
    got = {(r.gram, r.row) for r in postings.select("gram", "base", F.explode("rows").alias("at"))
           .select("gram", (F.col("base") + F.col("at")).alias("row")).collect()}
    texts = search_index._rows(spark, root).select(search_index.ROW, "`t.x`", "u").collect()
    assert got == {(g, r[0]) for r in texts for t in r[1:] if t for g in search_index.grams_of(t.lower())}
    assert postings.count() < sum(r.entries for r in spark.read.parquet(f"{root}/counts").collect()) / 3


def test_chunks_with_many_letters_or_distant_rows_are_halved():
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 20_000)))
    row = np.array([5, 1 << 40, 6, 7], np.int64)
    many = [(wide, 5), ("abc", 1 << 40), (wide[::-1], 6), ("xabc", 7)]
    out = list(search_index._lists(row, 3, [t for t, _ in many]))
    got = {(g, b["base"] + at) for x in out for b in x.to_pylist() for g in [b["gram"]] for at in b["rows"]}
    assert len(out) > 1 and got == {(g, r) for t, r in many for g in search_index.grams_of(t)}
    assert list(search_index._lists(row[:2], 0, ["ab", ""])) == []


def test_index_refuses_bad_columns_and_takes_an_empty_table(spark):
    df = spark.createDataFrame([], "a string")
    with pytest.raises(ValueError, match="invalid search columns"):
        search_index.build_index(df, fresh_dir(spark, "index"), ["b"])
    with pytest.raises(ValueError, match="names of the index"):
        search_index.build_index(df.withColumn("__row", F.lit(1)), fresh_dir(spark, "index"), ["a"])
    root = fresh_dir(spark, "index")
    search_index.build_index(df, root, ["a"])
    assert search_index.search_index(spark, root, "abc", ["a"]).count() == 0
    assert search_index.search_index(spark, root, "a", ["a"]).count() == 0


def _files(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_files_with_differing_headers(spark, tmp_path):
    path = _files(tmp_path, a="﻿Order Key,Status\n1,x\n\n2,\"y,y\"\n3\n", b="status,order_key\nz,4\nw,5,6\n",
                  c="ORDER KEY,Extra\n7,e\n", d="", e="Status,Order Key\n")
    df = read_csv_by_header(spark, path)
    assert df.columns == ["order_key", "status", "extra", "source_file", "source_line", "_corrupt_record"]
    got = {(r.source_file[-5:], r.source_line): (r.order_key, r.status, r.extra, r._corrupt_record) for r in df.collect()}
    assert got == {("a.csv", 2): ("1", "x", None, None), ("a.csv", 4): ("2", "y,y", None, None),
                   ("a.csv", 5): ("3", None, None, "3"), ("b.csv", 2): ("4", "z", None, None),
                   ("b.csv", 3): ("5", "w", None, "w,5,6"), ("c.csv", 2): ("7", None, "e", None)}


def test_line_numbers_across_splits(spark, tmp_path):
    n = 5000
    path = _files(tmp_path, a="k,v\n" + "".join(f"{i},v{i}\n" for i in range(2, n + 2)),
                  b="v,k\n" + "".join(f"v{i},{i}\n" for i in range(2, n + 2)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        df = read_csv_by_header(spark, path)
        assert df.rdd.getNumPartitions() > 8
        bad = df.where((F.col("k").cast("long") != F.col("source_line")) | (F.col("v") != F.concat(F.lit("v"), "k"))
                       | F.col("_corrupt_record").isNotNull()).count()
        assert (bad, df.count()) == (0, 2 * n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_headers_that_cannot_be_united_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="names a column twice"):
        header_names("A b,a_B")
    path = _files(tmp_path, a="k\n1\n", b="v\n1\n")
    with pytest.raises(ValueError, match="more than 1 different headers"):
        read_csv_by_header(spark, path, max_headers=1)
    with pytest.raises(ValueError, match="named like those added"):
        read_csv_by_header(spark, path, line_column="k")


def test_keep_first(spark):
    data = [(k, o, n) for n, (k, o) in enumerate([("a", 2), ("a", 1), ("a", None), ("b", 5), (None, 1), (None, 2),
                                                 ("c", None), ("c", None)])]
    df = spark.createDataFrame(data, "k string, o int, n int").repartition(3)
    got = {r.n: r.dup for r in flag_duplicates(df, ["k"], "dup", keep="first", order=["o", "n"]).collect()}
    assert got == {0: True, 1: False, 2: True, 3: False, 4: False, 5: False, 6: False, 7: True}
    safe = {r.n: r.dup for r in flag_duplicates(df, ["k"], "dup", True, keep="first", order=["o", "n"]).collect()}
    assert safe == {**got, 5: True}
    ties = flag_duplicates(df.select("k", "o"), ["k", "o"], "dup", True, keep="first", order=["o"])
    assert ties.where("dup").count() == 1
    for bad in ({"keep": "first"}, {"keep": "first", "order": ["o"], "method": "join"}, {"keep": "last"}):
        with pytest.raises(ValueError):
            flag_duplicates(df, ["k"], "dup", **bad)


def test_keep_first_of_a_hot_group(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    got = flag_duplicates(df.repartition(6), ["k"], "dup", keep="first", order=["id"])
    assert rows(got.where("k = -1 AND NOT dup")) == [(-1, 0, False)] and got.where("dup").count() == 9_999


def test_unparsable_prices_are_quarantined_only_by_option(spark):
    steps = (Step("trim"), Step("blank_to_null"), Step("preserve_original", ("p",), {"names": {"p": "raw"}}),
             Step("try_cast_double", ("p",)))
    df = spark.createDataFrame([("1.5",), ("x",), (" ",), (None,)], "p string")
    assert clean_table(df, Spec(steps)).clean.count() == 4
    split = clean_table(df, Spec((*steps, Step("flag_unparsable", ("p",), {"original": "raw"}))), with_reasons=True)
    assert rows(split.quarantine) == [(None, "x", True, ["unparsable_p"])] and split.clean.count() == 3
    assert ORDERS_SPEC.rejects() == []
