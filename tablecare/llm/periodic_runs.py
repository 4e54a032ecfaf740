"""Periodic runs of words by maximal pairs of an LCP-interval tree.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and length >= max(6, 4 * q) that neither neighbour extends.

1. Words become numbers; a text where no five-word window occurs twice within
   two words or three times at all holds no run and is done (a run of length
   max(6, 4 * q) holds such windows; equal hashes only keep a text in).
2. Suffixes are ordered by prefix doubling; the ranks of every doubling give the
   longest common prefixes (LCP) of neighbours.
3. The LCP intervals are walked bottom up. An interval holds the starts of all
   suffixes that share its l words, in order, with the class of their left word.
   Where two children meet, pairs i < j of starts from both whose left words
   differ are maximal pairs: their l words extend to neither side.
4. A run (s, q, length) is the maximal pair s, s + q with l = length - q, so
   exactly pairs with distance q <= l / 3 are wanted, and no extension follows.
   Pairs at multiples of q give the same stretch; the smallest distance is the
   period. Starts that share l words within l / 3 lie in one run, q apart, and
   only the run's first start has another left word: below a start, classes
   are read from the far end of the window, above it from the near end, until
   the start's own class is met. So each look-up costs its finds, whose number
   is bounded by the sum of the runs' exponents.

The smaller child joins the larger. LCP below 5 cannot hold a run (l = length - q
is 5 at least), so the tree is walked only above that, and only where two starts
of one such interval lie within a third of its greatest LCP.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r; memory is linear in
one text's words. Defined cases: NULL and empty text have no words, no runs and
an empty collapsed text; NULL ids and repeated rows stay as they are; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import quoted

MIN_LENGTH, MIN_EXPONENT = 6, 4
MIN_LCP = 5          # least length - period of a run
FEW = 8              # so few starts are inserted one by one

RUNS = "array<struct<start: long, length: long, period: long>>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                 ("period", pa.int64())]))


def may_hold_runs(words: np.ndarray) -> bool:
    """False only where no run can be: see step 1."""
    n = len(words)
    if n < MIN_LENGTH:
        return False
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    window = np.zeros(n - MIN_LCP + 1, np.uint64)
    for k in range(MIN_LCP):
        window = window * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + len(window)]
        window ^= window >> np.uint64(29)
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return False
    return bool((same[1:] & same[:-1]).any() or (same & (np.diff(order) <= 2)).any())


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes in order, and the LCP of each with the one before (first: 0)."""
    n = len(words)
    rank, span, ranks = words.astype(np.int64), 1, []
    while True:
        ranks.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        after = np.zeros(n, np.int64)
        after[:max(n - span, 0)] = rank[span:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        span *= 2
        if rank[order[-1]] == n - 1:
            break
    lcp = np.zeros(n, np.int64)
    a, b, shared = order[:-1], order[1:], lcp[1:]
    for level in range(len(ranks) - 1, -1, -1):
        at_a, at_b = a + shared, b + shared
        inside = (at_a < n) & (at_b < n)
        equal = np.zeros(n - 1, bool)
        equal[inside] = ranks[level][at_a[inside]] == ranks[level][at_b[inside]]
        shared += equal.astype(np.int64) << level
    return order, lcp


def _meet(one: list[int], other: list[int], shared: int, left: list[int], runs: dict) -> list[int]:
    """Maximal pairs between two children of an interval with LCP ``shared``; their union."""
    if len(one) < len(other):
        one, other = other, one
    reach, n = shared // (MIN_EXPONENT - 1), len(one)
    for p in other:
        own = left[p]
        k = bisect_left(one, p - reach)
        while k < n and one[k] < p and left[one[k]] != own:
            _note(runs, one[k], p - one[k], shared)
            k += 1
        k = bisect_right(one, p)
        while k < n and one[k] <= p + reach and left[one[k]] != own:
            _note(runs, p, one[k] - p, shared)
            k += 1
    if one[-1] < other[0]:
        one.extend(other)
    elif len(other) <= FEW:
        for p in other:
            insort(one, p)
    else:
        one.extend(other)
        one.sort()
    return one


def _note(runs: dict, start: int, period: int, shared: int) -> None:
    key = (start, shared + period)
    if runs.get(key, period) >= period:
        runs[key] = period


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if not may_hold_runs(words):
        return []
    starts, lcp = suffix_order(words)
    interval = np.cumsum(lcp < MIN_LCP)             # suffixes sharing MIN_LCP words, numbered from 1
    by_place = np.lexsort((starts, interval))
    near = np.diff(starts[by_place])
    near[np.diff(interval[by_place]) != 0] = len(words)
    first = np.flatnonzero(np.diff(interval, prepend=0))
    most = np.maximum.reduceat(lcp, first)[interval - 1]
    hopeful = np.unique(interval[by_place][1:][near * (MIN_EXPONENT - 1) <= most[by_place][1:]])
    ends = np.append(first[1:], len(words))
    left = np.concatenate(([-1], words[:-1])).tolist()
    runs: dict[tuple[int, int], int] = {}
    for number in hopeful.tolist():
        at, end = int(first[number - 1]), int(ends[number - 1])
        open_: list[tuple[int, list[int]]] = []     # intervals on the way down: (LCP, starts)
        after = lcp[at + 1:end].tolist() + [0]
        for start, shared in zip(starts[at:end].tolist(), after):
            held = [start]
            while open_ and open_[-1][0] > shared:
                deeper, others = open_.pop()
                held = _meet(others, held, deeper, left, runs)
            if open_ and open_[-1][0] == shared:
                held = _meet(open_.pop()[1], held, shared, left, runs)
            open_.append((shared, held))
    return sorted(((s, length, q) for (s, length), q in runs.items()), key=lambda r: (r[0], r[2]))


def numbers(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(kept).tolist()]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              reorder: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period by start, then period)
    and the collapsed text (kept words joined by one space).

    ``reorder(doc_id, n)``, where given, names for each of a document's n words the word to
    read in its place (None: the text as it is).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, found, texts = [], [], []
            for doc_id, text in zip(b.column(0), b.column(1)):
                words = (text.as_py() or b"").split()
                places = reorder(doc_id.as_py(), len(words)) if reorder else None
                if places is not None:
                    words = [words[k] for k in places.tolist()]
                runs = runs_of(numbers(words))
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(collapse(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(found, RUNS_ARROW),
                 pa.array(texts, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])

    table = docs.select(quoted(id_col).cast("long").alias("doc_id"),
                        quoted(text_col).cast("binary").alias("text"))
    rows = table.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


def seeded_periods(doc_id: int | None, n: int) -> np.ndarray | None:
    """The rewriting that the registered query asks for: of documents with crc32(id) divisible by
    ten, words from word a on repeat the p words there. A NULL id counts as ''."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def digest(found: DataFrame) -> DataFrame:
    """Per document: n_runs, the run of greatest length / period (ties: smallest start, then
    period; NULLs without a run) and digests of all runs and of the collapsed text."""
    # no two ratios of texts below 2^31 words are closer than 2^-62, so compare them as products
    best = ("aggregate(runs, runs[0], (b, r) -> IF(r.length * b.period > b.length * r.period, r, b))")
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))))
    return found.withColumn("best", F.expr(f"IF(size(runs) > 0, {best}, NULL)")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
