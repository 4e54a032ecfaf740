"""Packing into optimal length buckets [native].

1. Every document becomes pieces of at most ``max_len`` words (no word is
   dropped; an empty document is one piece of length 0).
2. The global histogram of piece lengths, at most ``max_len + 1`` rows whatever
   the corpus size, goes to the driver. Dynamic programming over it picks the
   ``buckets`` upper bounds with the least total padding (ties: the smallest
   previous bound).
3. Inside a bucket every piece is padded to the bound, so a batch holds
   ``token_budget // bound`` pieces. Pieces are numbered in the order of
   md5(doc_id:piece), a fixed shuffle: shards are prefixes of that digest, a
   small table of (bucket, shard) counts gives each shard's first number, and
   only rows of one shard meet in a task. Shards grow with the corpus
   (``shard_rows`` rows each on average).

Defined cases: NULL text counts as '' (length 0); NULL doc_id sorts as ''; ties
(equal id, piece and length) are interchangeable; an empty table gives no rows;
other input columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecare.llm.common import id_text, stage

WORDS = r"[^\x20\x09-\x0D]+"


def pieces(docs: DataFrame, max_len: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, n_tokens): consecutive runs of at most max_len words."""
    n = id_text(docs, id_col, text_col).select(
        "doc_id", F.regexp_count("text", F.lit(WORDS)).cast("long").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0)).cast("int")
    return (n.select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
            .select("doc_id", "piece", (F.col("piece").cast("long") * max_len).alias("start"),
                    F.least(F.lit(max_len).cast("long"),
                            F.col("n") - F.col("piece").cast("long") * max_len).alias("n_tokens")))


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length ranges with the least padding.

    Only lengths that occur can be bounds, and one more bucket never adds
    padding, so exactly min(buckets, lengths) are used. ``best[j]`` is the least
    padding of the lengths up to the j-th with the j-th as last bound.
    """
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[int(v)] for v in lengths], dtype=np.int64)
    n = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = (lengths * n[1:] - tokens[1:]).astype(float)
    cuts = []
    for b in range(1, min(buckets, len(lengths))):
        new, cut = np.full(len(lengths), np.inf), np.full(len(lengths), -1)
        for j in range(b, len(lengths)):
            i = np.arange(b - 1, j)
            cost = best[i] + lengths[j] * (n[j + 1] - n[i + 1]) - (tokens[j + 1] - tokens[i + 1])
            at = int(np.argmin(cost))             # the first: the smallest previous bound
            new[j], cut[j] = cost[at], i[at]
        cuts.append(cut)
        best = new
    j = len(lengths) - 1
    bounds = [int(lengths[j])]
    for cut in reversed(cuts):
        j = int(cut[j])
        bounds.append(int(lengths[j]))
    return bounds[::-1]


def pack(docs: DataFrame, max_len: int = 2048, buckets: int = 8, token_budget: int = 16384,
         shard_rows: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bucket_len, batch, slot.

    ``batch`` counts from 0 inside a bucket, ``slot`` from 0 inside a batch;
    padding of a piece is ``bucket_len - n_tokens``.
    """
    if token_budget < max_len:
        raise ValueError("token_budget must hold at least one sequence of max_len")
    rows = stage(pieces(docs, max_len, id_col, text_col), "pieces")
    histogram = {r["n_tokens"]: r["n"] for r in      # at most max_len + 1 rows
                 rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = optimal_bounds(histogram, buckets)
    if not bounds:
        bounds = [max_len]
    digits = 1
    while 16 ** digits * shard_rows < sum(histogram.values()):
        digits += 1
    bound = F.lit(bounds[-1])
    for b in reversed(bounds[:-1]):
        bound = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bound)
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                           F.col("piece").cast("string")).cast("binary"))
    placed = (rows.withColumn("bucket_len", bound.cast("long")).withColumn("shuffle_key", order)
              .withColumn("shard", F.substring("shuffle_key", 1, digits)))
    sizes = placed.groupBy("bucket_len", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket_len").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = sizes.select("bucket_len", "shard",
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("bucket_len", "shard").orderBy(
        "shuffle_key", "doc_id", "piece", "n_tokens")
    per_batch = F.expr(f"{int(token_budget)} div greatest(bucket_len, 1)")
    return (placed.withColumn("at", F.row_number().over(inside) - 1)
            .join(firsts, ["bucket_len", "shard"])
            .withColumn("number", F.col("first") + F.col("at")).withColumn("capacity", per_batch)
            .select("doc_id", "piece", "start", "n_tokens", "bucket_len",
                    F.expr("number div capacity").alias("batch"),
                    F.expr("number % capacity").alias("slot")))


def oracle(max_len: int = 2048, buckets: int = 8, token_budget: int = 16384) -> str:
    """DuckDB SQL of ``pack`` over ``documents``; needs at least ``buckets`` distinct lengths."""
    steps = [f"""b{b} AS (SELECT j, min(c) AS c, arg_min(i, (c, i)) AS cut FROM (
        SELECT y.j, x.j AS i, p.c + y.l * (y.n - x.n) - (y.t - x.t) AS c
        FROM h x JOIN b{b - 1} p ON p.j = x.j JOIN h y ON x.j < y.j) GROUP BY y.j)"""
             .replace("GROUP BY y.j", "GROUP BY j") for b in range(2, buckets + 1)]
    ends = [f"e{buckets} AS (SELECT max(j) AS j FROM h)"] + [
        f"e{b} AS (SELECT cut AS j FROM b{b + 1} WHERE j = (SELECT j FROM e{b + 1}))"
        for b in range(buckets - 1, 0, -1)]
    bounds = " UNION ALL ".join(f"SELECT l FROM h WHERE j = (SELECT j FROM e{b})"
                                for b in range(1, buckets + 1))
    return f"""WITH w AS (SELECT doc_id,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
    p AS (SELECT doc_id, n, unnest(range(greatest(cast(ceil(n / {max_len}.0) AS BIGINT), 1))) AS piece
          FROM w),
    s AS (SELECT doc_id, cast(piece AS INTEGER) AS piece, piece * {max_len} AS start,
          least({max_len}, n - piece * {max_len}) AS n_tokens FROM p),
    h0 AS (SELECT n_tokens AS l, count(*) AS k FROM s GROUP BY 1),
    h AS (SELECT row_number() OVER (ORDER BY l) AS j, l,
          cast(sum(k) OVER (ORDER BY l) AS BIGINT) AS n,
          cast(sum(k * l) OVER (ORDER BY l) AS BIGINT) AS t FROM h0),
    b1 AS (SELECT j, l * n - t AS c, cast(NULL AS BIGINT) AS cut FROM h),
    {", ".join(steps)}, {", ".join(ends)}, bounds AS ({bounds}),
    placed AS (SELECT s.*, (SELECT min(l) FROM bounds WHERE l >= s.n_tokens) AS bucket_len FROM s),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY
        md5(coalesce(cast(doc_id AS VARCHAR), '') || ':' || cast(piece AS VARCHAR)),
        doc_id, piece, n_tokens) - 1 AS number,
        {token_budget} // greatest(bucket_len, 1) AS capacity FROM placed)
    SELECT doc_id, piece, start, n_tokens, bucket_len, number // capacity AS batch,
           number % capacity AS slot FROM numbered"""
