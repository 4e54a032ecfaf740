"""Keyword search by a stored index of three-character pieces (trigrams).

``frames.keyword_search`` reads every row for every query. Here a table is written
once with its postings, and a query reads the postings of its needle's rarest
trigrams, then only the blocks of rows that hold all of them. Every candidate is
tested with the same filter as the full scan, so both give the same rows.

``root`` holds three Parquet tables, and the names and types of the first in ``columns``:

* ``rows``: the table with a row number and a block. Each task writes its rows, unshuffled,
  into the folder of its block, one of at most ``blocks``;
* ``postings``: (gram, block, base, rows) in ``BUCKETS`` folders by the gram's hash, sorted by
  gram (row groups are skipped by their bounds). ``rows`` lists the rows of one chunk of
  the table that hold the gram, less ``base``; tasks make it from ``CHUNK`` characters at a
  time with numpy, so an entry is four bytes and no row of its own in the shuffle. A gram
  that every row holds has one short list a chunk, dealt over as many files as the size
  of the texts asks for;
* ``counts``: entries per gram, one row a gram.

A query collects the counts of its own trigrams (as many as the needle is long)
and the candidate blocks (at most ``blocks`` numbers). It intersects the ``USED``
rarest trigrams: more of them read more postings and drop few candidates.

Defined cases: a needle below three characters is in no posting and scans all
rows; a trigram that no row holds ends the query before any row is read; NULL
values match nothing; texts are cut in overlapping pieces of ``PIECE`` characters, so
one long text is no long array (its repeated grams may be listed once a chunk).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecare.operators.frames import keyword_search

GRAM = 3
PIECE = 32_768
CHUNK = 1 << 20
SHARE_BYTES = 512 << 20     # of text, for each part of a bucket
BUCKETS = 64
BLOCKS = 16_384
USED = 4
ROW, BLOCK = "__row", "__block"
POSTINGS = "gram string, block int, base long, rows array<int>"


def grams_of(text: str) -> list[str]:
    """Distinct trigrams of a needle, in order."""
    return list(dict.fromkeys(text[i:i + GRAM] for i in range(len(text) - GRAM + 1)))


def _text_pieces(c: Column) -> Column:
    """Overlapping pieces, so that each trigram lies in one; none for NULL."""
    last = F.floor(F.greatest(F.length(c) - 1, F.lit(0)) / F.lit(PIECE)).cast("int")
    return F.coalesce(
        F.transform(F.sequence(F.lit(0), last),
                    lambda i: F.substring(c, i * PIECE + 1, F.lit(PIECE + GRAM - 1))),
        F.array().cast("array<string>"))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{root}/columns").schema).parquet(f"{root}/rows")


def _postings(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{POSTINGS}, bucket int").parquet(f"{root}/postings")


def _lists(row: np.ndarray, block: int, texts: list[str]) -> Iterator[pa.RecordBatch]:
    """Postings of texts of one block: each gram with the distinct rows that hold it."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    if len(code) < GRAM:
        return
    known, place = np.unique(row, return_inverse=True)
    used = np.zeros(int(code.max()) + 1, np.int64)
    used[code] = 1
    letters = np.flatnonzero(used)
    a, n = len(letters), len(known)
    if n > 1 and (a ** GRAM * n >= 1 << 63 or known[-1] - known[0] >= 1 << 31):
        half = len(texts) // 2
        yield from _lists(row[:half], block, texts[:half])
        yield from _lists(row[half:], block, texts[half:])
        return
    used[letters] = np.arange(a)
    rank = used[code]
    text = np.repeat(np.arange(len(texts)), size)
    inside = text[:1 - GRAM] == text[GRAM - 1:]
    key = ((rank[:-2] * a + rank[1:-1]) * a + rank[2:]) * n + place[text[:1 - GRAM]]
    key = np.unique(key[inside])
    if not len(key):
        return
    gram = key // n
    first = np.flatnonzero(np.diff(gram, prepend=-1))
    of = gram[first]
    chars = letters[np.stack([of // (a * a), of // a % a, of % a], 1)].astype("<u4").tobytes().decode("utf-32-le")
    offsets = np.append(first, len(key)).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([chars[i:i + GRAM] for i in range(0, len(chars), GRAM)], pa.string()),
         pa.array(np.full(len(first), block, np.int32)), pa.array(np.full(len(first), known[0], np.int64)),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array((known[key % n] - known[0]).astype(np.int32)))],
        names=["gram", "block", "base", "rows"])


def _chunk_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of (row, block, piece), a chunk of at most ``CHUNK`` characters and one piece at a time."""
    for b in batches:
        row, block = b.column(0).to_numpy(), b.column(1).to_numpy()
        texts = [t.decode("utf-8", "replace") for t in b.column(2).cast(pa.binary()).to_pylist()]
        part = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))) // CHUNK
        cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(block) != 0)) + 1
        edges = [0, *cuts.tolist(), len(texts)]
        for i, j in zip(edges, edges[1:]):
            if j > i:
                yield from _lists(row[i:j], int(block[i]), texts[i:j])


def build_index(df: DataFrame, root: str, columns: Sequence[str], blocks: int = BLOCKS) -> None:
    """Write ``df`` with the postings of ``columns`` under ``root`` (a folder not in use)."""
    unknown = set(columns) - set(df.columns)
    if unknown or not columns:
        raise ValueError(f"invalid search columns: {sorted(unknown)}; choose from {sorted(df.columns)}")
    if {ROW, BLOCK} & set(df.columns):
        raise ValueError(f"{ROW} and {BLOCK} are names of the index")
    spark = df.sparkSession
    # numbers are fixed by this write: what reads them reads the written table
    numbered = df.select("*", F.monotonically_increasing_id().alias(ROW),
                         F.pmod(F.spark_partition_id(), F.lit(blocks)).alias(BLOCK))
    spark.createDataFrame([], numbered.schema).write.parquet(f"{root}/columns")
    numbered.write.partitionBy(BLOCK).parquet(f"{root}/rows")
    rows = _rows(spark, root)
    texts = F.concat(*[_text_pieces(F.lower(F.col(f"`{c}`").cast("string"))) for c in columns])
    size = rows.agg(F.sum(sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long")
                               for c in columns), F.lit(0)))).first()[0] or 0
    shares = 1 + size // SHARE_BYTES
    (rows.select(ROW, BLOCK, F.explode(F.array_distinct(texts)).alias("piece"))
     .where("piece IS NOT NULL")
     .mapInArrow(_chunk_postings, POSTINGS)
     .withColumn("bucket", _bucket(F.col("gram")))
     .repartition(16 * shares, "bucket", F.pmod(F.xxhash64("base"), F.lit(shares)))
     .sortWithinPartitions("bucket", "gram", "base")
     .write.partitionBy("bucket").parquet(f"{root}/postings"))
    (_postings(spark, root).groupBy("bucket", "gram").agg(F.sum(F.size("rows").cast("long")).alias("entries"))
     .write.parquet(f"{root}/counts"))


def _chosen(spark: SparkSession, root: str, needle: str, used: int) -> list[str] | None:
    """The needle's rarest trigrams; None when one of them is in no row."""
    wanted = grams_of(needle)
    counts = {r.gram: r.entries for r in spark.read.parquet(f"{root}/counts")
              .where(F.col("gram").isin(wanted)).select("gram", "entries").collect()}
    if len(counts) < len(wanted):
        return None
    return sorted(wanted, key=lambda g: (counts[g], g))[:used]


def search_index(spark: SparkSession, root: str, query: str, columns: Sequence[str],
                 used: int = USED, **options) -> DataFrame:
    """The rows that ``frames.keyword_search(table, query, columns, **options)`` gives, by the index.

    ``columns`` are those that the index was built with, or some of them.
    """
    rows = _rows(spark, root)
    columns_out = [c for c in rows.columns if c not in (ROW, BLOCK)]
    needle = query.lower()
    if len(needle) >= GRAM:
        grams = _chosen(spark, root, needle, used)
        if grams is None:
            rows = rows.where(F.lit(False))
        else:
            buckets = [r[0] for r in spark.range(1).select(F.explode(F.array_distinct(F.array(
                *[_bucket(F.lit(g)) for g in grams])))).collect()]
            found = (_postings(spark, root).where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
                     .select("gram", "block", "base", F.explode("rows").alias("at"))
                     .select("gram", "block", (F.col("base") + F.col("at")).alias("row"))
                     .groupBy("block", "row").agg(F.count_distinct("gram").alias("n"))
                     .where(F.col("n") == len(grams)).select("block", "row"))
            at = [r[0] for r in found.select("block").distinct().collect()]     # at most ``blocks``
            rows = rows.where(F.col(BLOCK).isin(at)).join(
                found, (F.col(BLOCK) == F.col("block")) & (F.col(ROW) == F.col("row")), "left_semi")
    return keyword_search(rows, query, columns, **options).select(*[F.col(f"`{c}`") for c in columns_out])
