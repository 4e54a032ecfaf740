"""Token ids as length-delimited binary records with masked checksums and an offset index.

Record layout (little-endian), one per document::

    u64  length of the payload
    u32  masked crc32 of the 8 length bytes
    payload: u8 flags (bit 0: doc_id is NULL; bits 4-7: bytes per id, 2 or 4),
             i64 doc_id, then the ids
    u32  masked crc32 of the payload
    u8   0x0A, end of record

mask(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2^32. Ids take two bytes when
the vocabulary allows it.

Writing: documents are range-partitioned and sorted by doc_id (equal ids by a
hash of the text, so that no id needs one task), encoded and framed in Arrow
batches, and written by Spark's own text writer, which ends each row with the
line separator: its commit protocol makes lost executors and repeated tasks
safe on any shared store. Part file p holds the p-th range of ids.

Reading: part files are read whole (their size is bounded by ``file_mb`` of
text), frames are walked and both checksums verified. The walk also yields the
offset index (file, record offset and length, ids, first token), written as
Parquet beside the data, so a shuffled reader can fetch any record by itself.

Encoding: the public tokenizer splits before a space or line feed that is
followed by a character that is no white space, and never merges across that
point. So each worker cuts texts there, encodes each distinct unit once and
keeps its ids; whole texts are then gathered from one flat array of ids.

Defined cases: NULL text counts as ''; every document ends with ``end_id``;
NULL ids sort first; rows with equal ids are all kept (``start`` among them
follows the text hash, exact repeats are interchangeable); an empty table gives
an empty index; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablecare.llm.common import id_text, min_partitions, worker_cache
from tablecare.session import fresh_dir

KEEP_CHARS = 48
SLICE_BYTES = 4 << 20
KEEP_UNITS = 600_000
HEAD, TAIL, PREFIX = "<QI", "<I", "<Bq"     # struct formats
HEAD_SIZE, TAIL_SIZE, PREFIX_SIZE = 12, 4, 9


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17 & 0xFFFFFFFF)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record without its end byte (the writer's line separator adds it)."""
    payload = struct.pack(PREFIX, (doc_id is None) | width << 4, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack(TAIL, masked(zlib.crc32(length))), payload,
                     struct.pack(TAIL, masked(zlib.crc32(payload)))))


def records(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, frame length, doc_id, ids) of each record; ValueError on any damage."""
    at, view = 0, memoryview(content)
    while at < len(view):
        if at + HEAD_SIZE > len(view):
            raise ValueError(f"cut record at {at}")
        length, check = struct.unpack_from(HEAD, view, at)
        if masked(zlib.crc32(view[at:at + 8])) != check:
            raise ValueError(f"bad length checksum at {at}")
        start, end = at + HEAD_SIZE, at + HEAD_SIZE + length
        if end + TAIL_SIZE + 1 > len(view) or view[end + TAIL_SIZE] != 10:
            raise ValueError(f"cut record at {at}")
        payload = view[start:end]
        if masked(zlib.crc32(payload)) != struct.unpack_from(TAIL, view, end)[0]:
            raise ValueError(f"bad payload checksum at {at}")
        flags, doc_id = struct.unpack_from(PREFIX, payload, 0)
        ids = np.frombuffer(payload[PREFIX_SIZE:], dtype=f"<u{flags >> 4}")
        yield at, end + TAIL_SIZE + 1 - at, None if flags & 1 else doc_id, ids
        at = end + TAIL_SIZE + 1


class Encoder:
    """Ids of texts. Arrow cuts and numbers the units of many texts at once, so that only distinct
    units reach Python; each unit is encoded once and its ids are kept in one flat array."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        # tokens that begin with a space or are a line feed: each joined unit starts with one
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t.startswith(("\u0120", "\u010a"))]] = True
        self.flat = np.empty(1 << 16, f"<u{self.width}")
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.starts, self.size = np.zeros(1 << 12, np.int64), 0    # unit k: flat[starts[k]:starts[k+1]]
        self.met = np.zeros(0, bool)                                # units met again since they were kept

    def _shrink(self) -> None:
        """Keep what was met again, half of what may be kept at most; the first are the longest kept."""
        kept = np.flatnonzero(self.met)[:KEEP_UNITS // 2]
        starts, lengths = self.starts[kept], self.starts[kept + 1] - self.starts[kept]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        units = list(self.number)       # in the order of their numbers
        units = [units[k] for k in kept.tolist()]
        self._forget()
        self._append(0, ids, lengths)
        self.number.update(zip(units, range(len(units))))

    def _append(self, first: int, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Ids of the units numbered from ``first``, one after the other."""
        while self.size + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(lengths) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
        self.flat[self.size:self.size + len(ids)] = ids
        self.starts[first] = self.size
        self.starts[first + 1:first + 1 + len(lengths)] = self.size + np.cumsum(lengths)
        self.size += len(ids)

    def _each(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tokenizer.encode_batch_fast([u.decode("utf-8") for u in units],
                                               add_special_tokens=False)
        ids = [e.ids for e in got]
        return (np.fromiter(chain.from_iterable(ids), self.flat.dtype),
                np.fromiter(map(len, ids), np.int64, len(ids)))

    def _joined(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units that start with a space or line feed and hold no other white space, in one go.
        Each has one token at least that opens it, so as many openings as units are one each."""
        ids = np.array(self.tokenizer.encode_batch_fast(
            [b"".join(units).decode("utf-8")], add_special_tokens=False)[0].ids, self.flat.dtype)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(units):
            return self._each(units)
        return ids, np.diff(starts, append=len(ids))

    def _encode_units(self, units: list[bytes], first: int) -> list[int]:
        """Number and keep units from ``first``; their order."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        data, ends = np.frombuffer(b"".join(units), np.uint8), np.cumsum(sizes)
        opening = data[ends - sizes]
        white = np.add.reduceat((data <= 32).view(np.int8), ends - sizes, dtype=np.int64)
        one = ((opening == 32) | (opening == 10)) & (white == 1) & (data[ends - 1] > 32)
        plain, rest = np.flatnonzero(one).tolist(), np.flatnonzero(~one).tolist()
        for some, encode in ([(plain[at:at + 1000], self._joined) for at in range(0, len(plain), 1000)]
                             + [(rest, self._each)] * bool(rest)):
            self._append(first, *encode([units[k] for k in some]))
            first += len(some)
        return plain + rest

    def _numbers(self, units: list[bytes]) -> tuple[np.ndarray, int]:
        """The number of each unit, encoding new ones, and the size to shrink to: long units are
        numbered last and not kept."""
        if len(self.number) + len(units) > KEEP_UNITS:
            self._shrink()
        found = np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))
        self.met = np.concatenate([self.met, np.zeros(len(self.number) - len(self.met), bool)])
        self.met[found[found >= 0]] = True
        new = np.flatnonzero(found < 0)
        long = np.array([len(units[k]) > KEEP_CHARS for k in new.tolist()], bool)
        at = len(self.number)
        for part, keep in ((new[~long], True), (new[long], False)):
            order = part[self._encode_units([units[k] for k in part.tolist()], at)] if len(part) else part
            found[order] = np.arange(at, at + len(order))
            if keep:
                self.number.update(zip([units[k] for k in order.tolist()], range(at, at + len(order))))
                size = self.size
            at += len(order)
        return found, size

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """The ids of each text, as little-endian bytes."""
        texts = (pa.array(texts, pa.string()) if isinstance(texts, list) else texts).cast(pa.binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        if offsets[0] == offsets[-1]:
            return [b""] * len(texts)
        values = texts.buffers()[2]
        data = np.frombuffer(values, np.uint8)[offsets[0]:offsets[-1]]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets - offsets[0]] = True
        edge[unit_starts(data, edge)] = True
        bounds = np.flatnonzero(edge) + offsets[0]
        units = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
            None, pa.py_buffer(bounds.astype(np.int32)), values]).dictionary_encode()
        numbers, size = self._numbers(units.dictionary.to_pylist())
        known = int(numbers.max()) + 1
        ids = pa.Array.from_buffers(pa.large_binary(), known, [
            None, pa.py_buffer(self.starts[:known + 1] * self.width), pa.py_buffer(self.flat)])
        taken = ids.take(pa.array(numbers[units.indices.to_numpy()]))
        ends, raw = np.frombuffer(taken.buffers()[1], np.int64), taken.buffers()[2].to_pybytes()
        self.size = size
        cuts = ends[np.searchsorted(bounds, offsets)]
        return [raw[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def unit_starts(data: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Places of a space or line feed right before a character that is no white space.

    The tokenizer parts its pieces there: of a run of white space it splits off the last character,
    which opens the next piece (a space) or is one (a line feed). ``edge`` marks where texts start
    and end: nothing is looked at across.
    """
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[~edge[at + 1]]
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    a, b, c = padded[at + 1], padded[at + 2], padded[at + 3]
    space = (a <= 0x20) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
    # white space of three bytes: U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
    space |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    space |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    space |= ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return at[~space]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``SLICE_BYTES`` of text, one row at least."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for i, j in zip(edges, edges[1:]):
        if j > i:
            yield batch.slice(i, j - i)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, file_mb: int = 48,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode and write all documents as part files in ascending doc_id order."""
    rows = id_text(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(min_partitions(rows), -(-size // (file_mb << 20)))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(parts, F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_cache(("encoder", tokenizer_path), lambda: Encoder(tokenizer_path))
        end = end_id.to_bytes(encoder.width, "little")
        for b in batches:
            for part in slices(b, 1):
                ids = encoder.encode(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([frame(d, i + end, encoder.width)
                               for d, i in zip(part.column(0).to_pylist(), ids)], pa.binary())],
                    names=["value"])

    # the cast keeps the bytes as they are; the line separator ends each record
    (ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\n").text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, offset, length, doc_id, n_tokens, start_in_file, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                rows, tokens = [], 0
                for offset, length, doc_id, ids in records(content.as_buffer()):
                    crc = zlib.crc32(ids.astype("<u4", copy=False).tobytes())
                    rows.append((name.as_py(), offset, length, doc_id, len(ids), tokens, crc))
                    tokens += len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 7)],
                        names=["file", "offset", "length", "doc_id", "n_tokens", "start_in_file",
                               "ids_crc32"])

    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(number.alias("file"), "content").mapInArrow(
        run, "file long, offset long, length long, doc_id long, n_tokens long, "
             "start_in_file long, ids_crc32 long")


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Verify all records and write the offset index; returns the index as written."""
    read(spark, path).write.parquet(index_path)
    return spark.read.parquet(index_path)


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``: tokens of all records before it in file order."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n"))   # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return index.join(firsts, "file").withColumn("start", F.col("first") + F.col("start_in_file"))


def write_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the corpus to the shared folder and read it back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "token-records")
    write(docs, f"{path}/data", tokenizer_path, end_id)
    index = write_index(spark, f"{path}/data", f"{path}/index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset",
                                     "length")
