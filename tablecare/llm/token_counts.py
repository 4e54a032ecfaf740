"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton of all pieces enumerates the matches that end at each
character; dynamic programming keeps, per position, only the best score and its
number of tokens (no back pointers, no token lists). Tie rules are those of the
public unigram tokenizer: candidates for one end position come in order of
their start, only a strictly better one replaces an earlier one (so the longest
of equal pieces wins), and where no one-character piece starts, an unknown
character costs the lowest score minus 10. An unknown character counts as its
UTF-8 bytes when the vocabulary has byte pieces, else a run of them as one.

A space becomes the mark of a word start and one is put in front of the text.
No piece crosses from another character into a mark (checked when the
vocabulary is read), so the best path splits at word starts; each worker keeps
counts of short words, and long ones are computed anew.

The box has no unigram vocabulary file: pieces and scores of the public
``piece_bpe_32k.model`` are read as one (its path is a parameter).

Defined cases: NULL and empty text have 0 tokens; NULL ids and repeated rows
stay as they are; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import id_text, worker_cache

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEEP_CHARS = 48          # longer units are not kept by the cache
KEEP_UNITS = 1_000_000   # the cache starts anew beyond this


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """unit -> number of tokens, filled on demand by ``viterbi``."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        if any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces):
            raise ValueError("a piece crosses a word start; units cannot be counted apart")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max(len(p) for p, _ in pieces)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.bytes = any(p == "<0x00>" for p, _ in pieces)

    def viterbi(self, unit: str) -> int:
        # only the positions that the longest piece can reach back to are kept, in a ring
        ring = min(self.longest, len(unit)) + 1
        score, count = [0.0] * ring, [0] * ring
        unknown_run = [False] * ring       # the best path ends in an unknown character
        matches = self.automaton.iter(unit)
        match = next(matches, None)
        for end in range(1, len(unit) + 1):
            found = []
            while match is not None and match[0] == end - 1:
                found.append(match[1])
                match = next(matches, None)
            best, k, unk, single = None, 0, False, False
            for length, s in sorted(found, reverse=True):
                single |= length == 1
                c = score[(end - length) % ring] + s
                if best is None or c > best:
                    best, k, unk = c, count[(end - length) % ring] + 1, False
            if not single:
                last = (end - 1) % ring
                c = score[last] + self.unknown
                if best is None or c > best:
                    best, unk = c, True
                    if self.bytes:
                        k = count[last] + len(unit[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        k = count[last] + (not unknown_run[last])
            score[end % ring], count[end % ring], unknown_run[end % ring] = best, k, unk
        return count[len(unit) % ring]

    def __missing__(self, unit: str) -> int:
        k = self.viterbi(unit)
        if len(unit) <= KEEP_CHARS:
            if len(self) >= KEEP_UNITS:
                self.clear()
            self[unit] = k
        return k

    def of(self, text: str) -> int:
        if not text:
            return 0
        if not self.bytes:      # a run of unknown characters may cross words
            return self.viterbi(MARK + text.replace(" ", MARK))
        return sum(map(self.__getitem__, UNITS.findall(MARK + text.replace(" ", MARK))))


UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens."""
    pieces = vocabulary(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(("unigram", model_path), lambda: Counter(pieces))
        for b in batches:
            counts = [counter.of(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long")
