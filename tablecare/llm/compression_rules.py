"""Quality rules with compression bands: counting rules, then zstandard ratios.

Counting rules (the base): a text fails with fewer than ``min_words`` words, or
where words inside repeated three-word windows make up more than
``max_repeat_percent`` per cent of all words.

Compression bands (the method): the ratio compressed / plain bytes of the whole
text and of each fixed chunk of ``chunk`` bytes is held against limits for its
length. A ratio below the band means repetition, above it text without
redundancy (keys, encoded data, noise). A document is rejected where its whole
ratio leaves the band, or where chunks outside theirs hold more than
``max_bad_percent`` per cent of its bytes. Short text compresses badly whatever
it holds, so limits fall with length; pieces below ``MIN_JUDGED`` bytes, where
the frame header outweighs the text, are not judged.

The limits are fixed parameters, the same for every corpus and size: a ratio of
plain base64 is 0.76 or more and of random printable text 0.82 or more at any
length, prose in one-byte and two-byte scripts lies between 0.3 and 0.7, and a
text of one line repeated falls under 0.1 once it is a few lines long.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Work is on UTF-8
bytes, which these never split; code points are counted as bytes that start one.

Defined cases: NULL text counts as empty: no words, so the base fails. NULL ids
and repeated rows are judged like any other; an empty table gives no rows; other
columns are not read by ``judge`` and are all kept by ``keep``. Very long texts
are compressed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablecare.llm.common import quoted

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
MIN_JUDGED = 64


@dataclass(frozen=True)
class Rules:
    """All limits. ``bands``: (length in bytes below which it holds, least ratio, greatest ratio)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    chunk: int = 4096
    max_bad_percent: int = 25
    level: int = 3
    bands: tuple[tuple[float, float, float], ...] = (
        (256, 0.35, 1.05), (512, 0.30, 0.88), (1024, 0.25, 0.80), (4096, 0.20, 0.72),
        (16384, 0.16, 0.68), (65536, 0.12, 0.65), (float("inf"), 0.08, 0.64))

    def limits(self, length: int) -> tuple[float, float]:
        for below, low, high in self.bands:
            if length < below:
                return low, high
        raise ValueError("the last band must have no upper length")


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, first occurrences included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words))
    v = len(numbers)
    if v >= 1 << 21:                      # three numbers do not fit 63 bits: rank pairs first
        pairs = np.unique(w[:-1] * v + w[1:], return_inverse=True)[1]
        window = pairs[:-1] * v + w[2:]
    else:
        window = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
    order = np.argsort(window, kind="stable")
    same = np.diff(window[order]) == 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:k + len(window)] |= twice
    return int(inside.sum())


class Judge:
    """All figures of one text; one compressor per worker."""

    FIELDS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
              ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
              ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
              ("low_bytes", pa.int64()), ("high_bytes", pa.int64()), ("reason", pa.string()))

    def __init__(self, rules: Rules):
        import zstandard

        self.rules = rules
        self.compress = zstandard.ZstdCompressor(level=rules.level).compress

    def ratio(self, piece) -> float | None:
        return len(self.compress(piece)) / len(piece) if len(piece) >= MIN_JUDGED else None

    def outside(self, piece) -> tuple[float | None, int]:
        """(ratio, -1 below its band, 1 above, 0 inside or not judged)"""
        ratio = self.ratio(piece)
        if ratio is None:
            return None, 0
        low, high = self.rules.limits(len(piece))
        return ratio, (ratio > high) - (ratio < low)

    def chunks(self, text: bytes) -> tuple[int, int]:
        """Bytes in chunks below and above their band."""
        low = high = 0
        view = memoryview(text)
        for at in range(0, len(text), self.rules.chunk):
            piece = view[at:at + self.rules.chunk]
            side = self.outside(piece)[1]
            low += len(piece) * (side < 0)
            high += len(piece) * (side > 0)
        return low, high

    def of(self, text: bytes | None) -> tuple:
        text, rules = text or b"", self.rules
        words = text.split()
        points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
        lines = [x for x in text.split(b"\n") if x.strip()]
        repeats = repeated_words(words)
        failed = (len(words) < rules.min_words
                  or 100 * repeats > rules.max_repeat_percent * len(words))
        ratio, side = self.outside(text)
        low, high = self.chunks(text)
        reason = ("base" if failed else "repetitive" if side < 0 else "incompressible" if side > 0
                  else "chunks" if 100 * (low + high) > rules.max_bad_percent * len(text) else None)
        return (len(words), points - sum(text.count(c) for c in SPACES),
                sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeats,
                failed, reason is None, ratio, low, high, reason)


def judge(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, the whole ratio, bytes in
    chunks below and above their band, and the reason of a rejection (NULL: kept)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Judge(rules)
        for b in batches:
            columns = list(zip(*(worker.of(t.as_py()) for t in b.column(1)))) or [()] * len(Judge.FIELDS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, (_, t) in zip(columns, Judge.FIELDS))],
                names=["doc_id", *(name for name, _ in Judge.FIELDS)])

    table = docs.select(quoted(id_col).cast("long").alias("doc_id"),
                        quoted(text_col).cast("binary").alias("text"))
    return table.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, "
                                 "n_dup_lines long, n_repeat_words long, base_failed boolean, "
                                 "kept boolean, ratio double, low_bytes long, high_bytes long, "
                                 "reason string")


def keep(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Judge(rules)
        for b in batches:
            text = b.column(b.schema.get_field_index(text_col)).cast(pa.binary())
            yield b.filter(pa.array([worker.of(t.as_py())[6] for t in text], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
