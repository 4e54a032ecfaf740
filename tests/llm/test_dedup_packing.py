import hashlib
import os
from collections import Counter

import duckdb
import pytest

from tablecare.llm import exact_dedup, packing
from tablecare.llm.catalog import ORACLE_SQL, QUERIES


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_members_by_brute_force(awkward):
    data = [(r["doc_id"], r["text"] or "") for r in awkward.collect()]
    want = []
    for i, t in data:
        ids = [j for j, u in data if u == t]
        top = max((j for j in ids if j is not None), default=None)
        want.append((i, top, len(ids), i == top, hashlib.sha256(t.encode()).hexdigest()))
    assert _rows(exact_dedup.members(awkward, salts=3)) == sorted(want, key=repr)


def test_deduplicate_keeps_one_row_per_text(awkward):
    got = exact_dedup.deduplicate(awkward)
    assert got.columns == awkward.columns
    texts = [r["text"] or "" for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({r["text"] or "" for r in awkward.collect()})
    assert {r["doc_id"] for r in got.filter("text = 'a b c d e f'").collect()} == {2}


def test_hot_groups_are_joined_apart(spark):
    """A third of all rows in one group, others of one to six rows; hot and cold rows both come back."""
    texts = ["hot"] * 1500 + [f"text {i % 997}" for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = exact_dedup.members(docs)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    last, size = {}, Counter(texts)
    for i, t in enumerate(texts):
        last[t] = i
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows.collect()}
    assert got == {i: (last[t], size[t], last[t] == i) for i, t in enumerate(texts)}


def test_only_null_ids(spark):
    rows = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    assert exact_dedup.deduplicate(rows).count() == 1
    assert [r["kept"] for r in exact_dedup.members(rows).collect()] == [True, True]


def test_empty_tables(empty):
    assert exact_dedup.members(empty).count() == 0
    assert exact_dedup.deduplicate(empty).count() == 0
    assert packing.pack(empty).count() == 0


def _best(hist, buckets):
    lengths = sorted(hist)

    def cost(bounds):
        return sum(k * (min(b for b in bounds if b >= n) - n) for n, k in hist.items())
    import itertools
    k = min(buckets, len(lengths))
    return min(cost((*c, lengths[-1])) for c in itertools.combinations(lengths[:-1], k - 1))


@pytest.mark.parametrize("hist", [{3: 1}, {0: 5, 1: 2}, {1: 9, 4: 1, 5: 7, 9: 2, 20: 1, 21: 3},
                                  {i: (i * 7) % 5 + 1 for i in range(12)}])
@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_bounds_are_optimal(hist, buckets):
    bounds = packing.optimal_bounds(hist, buckets)
    got = sum(k * (min(b for b in bounds if b >= n) - n) for n, k in hist.items())
    assert got == _best(hist, buckets) and len(bounds) == min(buckets, len(hist))


def test_pack_holds_every_word_once(awkward):
    rows = packing.pack(awkward, max_len=100, buckets=3, token_budget=400, shard_rows=2).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len((r["text"] or "").split()) for r in awkward.collect())
    for r in rows:
        assert 0 <= r["n_tokens"] <= r["bucket_len"] <= 100
    batches = {}
    for r in rows:
        batches.setdefault((r["bucket_len"], r["batch"]), []).append(r["slot"])
    for (bound, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bound <= 400


def test_budget_below_a_sequence_is_refused(awkward):
    with pytest.raises(ValueError):
        packing.pack(awkward, max_len=100, token_budget=50)


@pytest.mark.parametrize("key", ["op1_exact_dedup", "op2_packing", "op10_jaccard_join"])
def test_oracle(spark, key):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf}/{name}'")
    want = con.sql(ORACLE_SQL[key])
    got = QUERIES[key](spark, sf).select(*want.columns)
    assert _rows(got) == sorted((tuple(r) for r in want.fetchall()), key=repr)
