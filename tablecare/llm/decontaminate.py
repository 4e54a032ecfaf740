"""Benchmark decontamination by the q-gram lemma.

Text is folded (lower case letters and digits; each run of anything else is one
space, so indents, rules and re-wrapped lines cost no edits) and the place of
every folded character is kept. A benchmark passage of m folded
characters found with at most k = floor(error_rate * m) edits shares at least
m + 1 - q * (k + 1) q-grams with the matching region, all on diagonals (text
position - passage position) within k of each other. Per document:

1. look up every q-gram in the passages' q-grams (a small bitmap of hashes
   first, then a sorted table); a stretch with more than ``HITS`` of them is halved
   and then taken a group of passages at a time, so memory stays bounded;
2. count hits per (passage, band), bands being 2(k + 1) diagonals wide and
   overlapping by half, so every such region lies whole in one band;
3. keep bands that reach the bound and verify them by banded alignment, which
   gives the edits and the exact region.

A q-gram with more than ``COMMON`` places in the benchmark says little and may hit
everywhere. A passage with z places of such q-grams still
shares its bound less z of the others; where that is 1 or more, this bound is
used for it and those q-grams are not looked up, and nothing is lost.

Passages for which the bound is below 1 get the largest k that keeps it at 1;
passages shorter than q are found only where they occur unchanged, as whole
words. Passages without a letter or digit are never found.

Documents go through in slices that overlap by the longest possible region, so
very long texts are covered whole in bounded memory. Passages are handled in
blocks of at most ``block_chars`` characters, one pass over the documents each,
so what a task holds stays bounded whatever the size of the benchmark.

Defined cases: NULL text counts as ''; NULL ids and repeated rows are searched
like others (repeated rows give repeated regions); NULL or empty passages are
never found; equal passages are each reported; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

import sys
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablecare.llm.common import id_text, quoted, worker_cache

SLICE = 1 << 18
HITS = 1 << 21                  # q-gram hits held at once
COMMON = 1024
SCHEMA = "doc_id long, item_id long, start long, end long, edits int, shared_qgrams int"
ONE = np.int64(1) << 32         # one edit in packed (edits, start) costs


def fold_table() -> np.ndarray:
    """Code point -> code point of its lower case letter or digit, else space."""
    table = np.full(sys.maxunicode + 1, 32, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalnum():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def fold_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters and the place of each in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = worker_cache("fold table", fold_table)[codes]
    space = codes == 32
    keep = ~space
    keep[:1] = True
    keep[1:] |= ~space[:-1]
    places = np.flatnonzero(keep)
    return codes[places], places


def fold(text: str) -> np.ndarray:
    return fold_places(text)[0]


def qgram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each window of q characters."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64)
    h = wide[:n].copy()
    for i in range(1, q):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += wide[i:i + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def banded_alignment(pattern: np.ndarray, texts: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(edits, start, end) of the best match of ``pattern`` in each row of ``texts``.

    Rows hold len(pattern) + width - 1 characters; the match may start on any of
    the ``width`` diagonals and only those are computed. Costs carry their start in
    the low bits, so the leftmost start among equal edits wins.
    """
    width = texts.shape[1] - len(pattern) + 1
    step = np.arange(width, dtype=np.int64) * ONE
    cost = np.tile(np.arange(width, dtype=np.int64), (len(texts), 1))
    for i, c in enumerate(pattern):
        new = cost + (texts[:, i:i + width] != c) * ONE
        np.minimum(new[:, :-1], cost[:, 1:] + ONE, out=new[:, :-1])
        new -= step
        np.minimum.accumulate(new, axis=1, out=new)
        new += step
        cost = new
    at = np.argmin(cost >> 32, axis=1)
    best = cost[np.arange(len(cost)), at]
    return best >> 32, best & (ONE - 1), at + len(pattern)


class Index:
    """The q-grams of a block of passages."""

    def __init__(self, items: list[tuple[int, str]], q: int, error_rate: float):
        self.q = q
        self.ids, self.texts = [], []
        for item_id, text in items:
            words = fold(text)
            keep = np.flatnonzero(words != 32)
            if len(keep):
                self.ids.append(item_id)
                self.texts.append(words[keep[0]:keep[-1] + 1])
        m = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.minimum((error_rate * m).astype(np.int64), np.maximum(m // q - 1, 0))
        self.need = np.maximum(m + 1 - q * (self.k + 1), 1)
        self.m = m
        long = [(i, t) for i, t in enumerate(self.texts) if len(t) >= q]
        self.short = [i for i, t in enumerate(self.texts) if len(t) < q]
        grams = [qgram_hashes(t, q) for _, t in long]
        self.hash = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.array([i for i, _ in long], np.int64), [len(g) for g in grams])
        pos = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.pos = self.hash[order], item[order], pos[order]
        self._leave_common()
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hash >> np.uint64(44)] = True
        self.reach = int((m + 4 * (self.k + 1)).max()) if len(m) else 0

    def _leave_common(self) -> None:
        """Drop common q-grams of passages whose bound allows it, and lower that bound."""
        _, places = np.unique(self.hash, return_counts=True)
        common = np.repeat(places > COMMON, places)
        lost = np.bincount(self.item[common], minlength=len(self.m))
        can = self.need - lost >= 1
        self.need = np.where(can, self.need - lost, self.need)
        keep = ~(common & can[self.item]) if len(self.item) else common
        self.hash, self.item, self.pos = self.hash[keep], self.item[keep], self.pos[keep]

    def find(self, codes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item, start, end, edits, shared q-grams) of all regions, each once."""
        found = {}
        step = max(SLICE, 2 * self.reach)
        for at in range(0, max(1, len(codes) - self.reach), step):
            for item, start, end, edits, shared in self._slice(codes[at:at + step + self.reach]):
                key = (item, at + start, at + end, edits)
                found[key] = max(shared, found.get(key, 0))
        return self._best([(*k, v) for k, v in found.items()])

    @staticmethod
    def _best(regions: list) -> list:
        """Of regions of one passage that overlap, the one with the fewest edits."""
        taken: dict[int, list] = {}     # per passage: disjoint (start, end, region), in order
        for r in sorted(regions, key=lambda r: (r[3], r[0], r[1], r[2])):
            mine = taken.setdefault(r[0], [])
            k = bisect_left(mine, (r[1], r[2]))
            if not (k and mine[k - 1][1] > r[1]) and not (k < len(mine) and mine[k][0] < r[2]):
                mine.insert(k, (r[1], r[2], r))
        return sorted(r for mine in taken.values() for _, _, r in mine)

    def _slice(self, codes: np.ndarray) -> list:
        out = self._exact(codes) if self.short else []
        return out + self._similar(codes)

    def _similar(self, codes: np.ndarray) -> list:
        h = qgram_hashes(codes, self.q)
        where = np.flatnonzero(self.seen[h >> np.uint64(44)]) if len(self.hash) else []
        if not len(where):
            return []
        h = h[where]
        lo = np.searchsorted(self.hash, h, "left")
        n = np.searchsorted(self.hash, h, "right") - lo
        where, lo, n = where[n > 0], lo[n > 0], n[n > 0]
        if not len(n):
            return []
        if n.sum() > HITS and len(codes) > 4 * self.reach:
            half = len(codes) // 2
            return (self._similar(codes[:half + self.reach])
                    + [(i, half + s, half + t, e, g) for i, s, t, e, g in self._similar(codes[half:])])
        keys, counts = [], []
        for passages in self._groups(lo, n):
            key, shared = self._count(len(codes), where, lo, n, passages)
            keys.append(key)
            counts.append(shared)
        bands = self._bands(len(codes))
        key, shared = np.concatenate(keys), np.concatenate(counts)
        return self._verify(codes, key // bands, key % bands, shared)

    def _bands(self, length: int) -> int:
        """More than any band number of a stretch of this length."""
        return length + int(self.m.max()) + 2

    def _groups(self, lo: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of passages with about ``HITS`` hits each (one passage at least)."""
        if n.sum() <= HITS:
            return [(0, len(self.m))]
        used = np.zeros(len(self.hash) + 1, np.int64)       # hits of each entry of the table
        np.add.at(used, lo, 1)
        np.add.at(used, lo + n, -1)
        per = np.bincount(self.item, np.cumsum(used)[:-1], minlength=len(self.m))
        run = np.cumsum(per) // HITS
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(self.m)]
        return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]

    def _count(self, length: int, where, lo, n,
               passages: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(passage and band, shared q-grams) of the bands of these passages that reach the bound."""
        size, shift = self.k + 1, int(self.m.max())
        bands = self._bands(length)
        everything = passages == (0, len(self.m))
        held: list[np.ndarray] = []
        run = np.cumsum(n) // HITS
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(n)]
        for a, b in zip(edges, edges[1:]):
            many = n[a:b]
            entry = np.repeat(lo[a:b] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            spot = np.repeat(where[a:b], many)
            if not everything:
                mine = (self.item[entry] >= passages[0]) & (self.item[entry] < passages[1])
                entry, spot = entry[mine], spot[mine]
            item = self.item[entry]
            band = (spot - self.pos[entry] + shift) // size[item]
            key = item * bands + band
            held.append(np.concatenate([key, key[band > 0] - 1]))
        key, shared = np.unique(np.concatenate(held), return_counts=True)
        keep = shared >= self.need[key // bands]
        return key[keep], shared[keep]

    def _verify(self, codes, item, band, shared) -> list:
        out, shift = [], int(self.m.max()) if len(self.m) else 0
        for i in np.unique(item):
            mine, size, m = item == i, int(self.k[i]) + 1, int(self.m[i])
            firsts, grams = band[mine] * size - shift, shared[mine]
            step = max(1, HITS // (m + 2 * size))
            for at in range(0, len(firsts), step):
                first = firsts[at:at + step]
                spot = first[:, None] + np.arange(m + 2 * size - 1)
                inside = (spot >= 0) & (spot < len(codes))
                window = np.where(inside, codes[np.clip(spot, 0, len(codes) - 1)], 0)
                edits, start, end = banded_alignment(self.texts[i], window, size - 1)
                for f, e, s, t, g in zip(first, edits, start, end, grams[at:at + step]):
                    if e <= self.k[i]:
                        s, t = max(0, f + s), min(len(codes), f + t)
                        out.append((int(i), int(s), int(t), int(e), int(g)))
        return out

    def _exact(self, codes: np.ndarray) -> list:
        """Passages shorter than a q-gram, unchanged and as whole words."""
        out, text = [], codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        text = f" {text} "
        for i in self.short:
            item = self.texts[i].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            at = text.find(f" {item} ")
            while at >= 0:
                out.append((i, at, at + len(item), 0, 0))
                at = text.find(f" {item} ", at + 1)
        return out


def blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark, in item order, in lists of at most about ``block_chars`` characters."""
    part, size = [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        if part and size + len(r["text"]) > block_chars:
            yield part
            part, size = [], 0
        part.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if part:
        yield part


def indexes(benchmark: DataFrame, q: int, error_rate: float, block_chars: int, item_col: str,
            item_text_col: str) -> Iterator[Callable[[], Index]]:
    """For each block of passages a function that makes its index, once per worker."""
    items = benchmark.select(quoted(item_col).cast("long").alias("item_id"),
                             quoted(item_text_col).alias("text")).filter("text IS NOT NULL")
    for part in blocks(items, block_chars):
        key = ("qgrams", uuid.uuid4().hex)
        shared = benchmark.sparkSession.sparkContext.broadcast(part)
        yield lambda key=key, shared=shared: worker_cache(
            key, lambda: Index(shared.value, q, error_rate))


def find(docs: DataFrame, benchmark: DataFrame, q: int = 8, error_rate: float = 0.1,
         block_chars: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per region: doc_id, item_id, start, end (code points), edits, shared_qgrams."""
    rows = id_text(docs, id_col, text_col)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64()] * 4 + [pa.int32()] * 2
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for make in indexes(benchmark, q, error_rate, block_chars, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], make=make) -> Iterator[pa.RecordBatch]:
            index = make()
            for b in batches:
                hits = []
                for doc_id, text in zip(b.column(0), b.column(1)):
                    codes, places = fold_places(text.as_py())
                    hits += [(doc_id.as_py(), index.ids[i], int(places[s]), int(places[t - 1]) + 1, *rest)
                             for i, s, t, *rest in index.find(codes)]
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*hits), types)], names=names)

        out = out.union(rows.mapInArrow(run, SCHEMA))
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = 8, error_rate: float = 0.1,
                        block_chars: int = 2_000_000, text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The input rows whose text holds no benchmark passage, unchanged; nothing is shuffled."""
    for make in indexes(benchmark, q, error_rate, block_chars, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], make=make) -> Iterator[pa.RecordBatch]:
            index = make()
            for b in batches:
                yield b.filter(pa.array([not (t and index.find(fold(t)))
                                         for t in b.column(at).to_pylist()], pa.bool_()))

        at = docs.columns.index(text_col)
        docs = docs.mapInArrow(run, docs.schema)
    return docs
