"""Toxicity by a weighted lexicon.

Text is folded (lower case, compatibility forms, homoglyphs and digit
substitutions to plain letters, everything else to single spaces; accented
letters of a language stay) and matched by one
Aho-Corasick automaton of lexicon entries: `` word `` matches a whole word,
`` stem`` the start of a word. The score is a logistic function of the matched
weight, normalised by the length of the text; matches inside an exception
phrase do not count.

The lexicon is learned from a bounded sample of labelled rows: at most
``sample`` texts per label (those with the smallest hash of doc_id). Evidence
for a word is its number of distinct contexts (word before, word, word after)
per label, so copies of one text count once. Entries are the whole words and
shortest stems whose log odds among toxic against other contexts reach a
bound; the log odds are their weights. Exception
phrases are pairs of an entry's word and a neighbour seen in several contexts,
nearly all of them not toxic.

Defined cases: NULL and empty texts have no match and score like any text
without one; NULL ids and repeated rows stay; labels whose text or label is
missing are not learned from; without any toxic label the lexicon is empty and
every score is the prior; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import held_out, id_text, worker_cache

# Look-alike characters and substitutions, each with its plain letter.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ł": "l", "ø": "o", "đ": "d", "ı": "i", "ß": "ss", "æ": "ae",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "​": "", "‌": "", "‍": "", "­": "", "﻿": "",
}
LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7, 8)


class Folding(dict):
    """Code point -> folded text, filled on demand, for str.translate."""

    def __missing__(self, code: int) -> str:
        import unicodedata

        text = "".join(LOOK_ALIKE.get(c, c) for c in unicodedata.normalize("NFKC", chr(code).lower()))
        self[code] = text if not text or text.isalpha() else " "
        return self[code]


FOLDING = Folding()


def fold(text: str) -> str:
    """Folded words, each followed by one space, with one space in front."""
    return " " + " ".join(text.translate(FOLDING).split()) + " "


@dataclass
class Lexicon:
    entries: dict[str, float]       # " word " or " stem" -> weight
    exceptions: list[str]           # " word word "
    slope: float
    offset: float

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for e, w in self.entries.items():
            a.add_word(e, (len(e), w))
        for e in self.exceptions:
            a.add_word(e, (len(e), None))
        if len(a):
            a.make_automaton()
        return a

    def feature(self, automaton, text: str) -> float:
        """Matched weight over the log of the length; 0 without a match."""
        folded = fold(text)
        if not len(automaton):
            return 0.0
        hits, spared = {}, []
        for end, (length, weight) in automaton.iter(folded):
            start = end + 1 - length
            if weight is None:
                spared.append((start, end + 1))
            else:       # one weight per word, the largest
                hits[start] = max(weight, hits.get(start, 0.0))
        spared.sort()
        starts, ends = [a for a, _ in spared], list(accumulate((b - 1 for _, b in spared), max))
        total = 0.0
        for s, w in hits.items():       # spared: the furthest end of the phrases begun by then is beyond
            k = bisect_right(starts, s)
            if not (k and ends[k - 1] > s):
                total += w
        return total / math.log(math.e + folded.count(" "))

    def score(self, feature: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * feature + self.offset))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, remainder: int,
                    sample: int) -> DataFrame:
    """(doc_id, text, label): at most ``sample`` training rows per label, held-out ones never."""
    picks = None
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"), divisor, remainder))
    for v in (0, 1):
        some = (known.filter(F.col("label") == v).dropDuplicates(["doc_id"])
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
        picks = some if picks is None else picks.union(some)
    # at most 2 * sample rows of two numbers: small by construction
    return id_text(docs).join(F.broadcast(picks), "doc_id")


def _contexts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = set()
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = ["", *fold(text).split(), ""]
                seen.update(zip([label] * len(w), w, w[1:], w[2:]))
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*seen), [pa.int32()] + [pa.string()] * 3)],
                    names=["label", "before", "word", "after"])

    return rows.select("text", "label").mapInArrow(
        run, "label int, before string, word string, after string").distinct()


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 5,
          remainder: int = 0, sample: int = 2500, min_contexts: int = 5, min_log_odds: float = 3.0,
          max_entries: int = 200_000) -> Lexicon:
    """Fit the lexicon on a sample of at most ``2 * sample`` labelled rows.

    The sample alone bounds entries and exception phrases; more than ``max_entries`` of either,
    which the driver and each worker would hold, raise instead of being cut.
    """
    def bounded(rows: list, what: str) -> list:
        if len(rows) > max_entries:
            raise ValueError(f"more than {max_entries} {what}: take a smaller sample or more contexts")
        return rows

    rows = labelled_sample(docs, labels, label, divisor, remainder, sample).cache()
    contexts = _contexts(rows).cache()
    forms = [F.concat(F.lit(" "), F.col("word"), F.lit(" "))] + [
        F.when(F.length("word") >= k, F.concat(F.lit(" "), F.substring("word", 1, k))) for k in STEMS]
    counts = (contexts.filter(F.length("word") >= 3)
              .select("label", F.explode(F.array(*forms)).alias("entry")).filter("entry IS NOT NULL")
              .groupBy("entry").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")))
    whole = contexts.agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, good = (whole["bad"] or 0) + 1.0, whole["n"] - (whole["bad"] or 0) + 1.0
    odds = F.log(((F.col("bad") + 0.5) / bad) / ((F.col("n") - F.col("bad") + 0.5) / good))
    best = bounded(counts.withColumn("odds", odds)
                   .filter((F.col("bad") >= min_contexts) & (F.col("odds") >= min_log_odds))
                   .limit(max_entries + 1).collect(), "lexicon entries")
    chosen: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (len(r["entry"]), r["entry"])):
        stem = r["entry"].rstrip(" ")
        if not any(stem[:1 + k] in chosen for k in STEMS if k < len(stem)):   # a stem covers it
            chosen[r["entry"]] = r["odds"]
    pair_rows = []
    if chosen:
        # at most max_entries short strings
        known = docs.sparkSession.createDataFrame([(e,) for e in chosen], "entry string")
        found = (contexts.withColumn("entry", F.explode(F.array(*forms))).filter("entry IS NOT NULL")
                 .join(F.broadcast(known), "entry").drop("entry").distinct())
        pairs = found.select("label", F.explode(F.array(
            F.concat_ws(" ", F.lit(""), "before", "word", F.lit("")),
            F.concat_ws(" ", F.lit(""), "word", "after", F.lit("")))).alias("pair"))
        spares = (F.col("n") - F.col("bad") >= 3) & (F.col("bad") <= 0.05 * F.col("n"))
        pair_rows = bounded(
            pairs.groupBy("pair").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n"))
            .filter(spares).limit(max_entries + 1).collect(), "exception phrases")
    lexicon = Lexicon(chosen, [r["pair"] for r in pair_rows if "  " not in r["pair"]], 0.0, 0.0)
    lexicon = calibrate(rows, lexicon)
    contexts.unpersist()
    rows.unpersist()
    return lexicon


def calibrate(rows: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Logistic slope and offset on the sample (at most 2 * sample numbers on the driver)."""
    got = _features(rows.select("label", "text"), lexicon, "label int").collect()
    y = np.array([r[0] for r in got], dtype=float)
    x = np.array([r[1] for r in got], dtype=float)
    if not len(y) or y.min() == y.max():
        prior = float(y.mean()) if len(y) else 0.0
        return Lexicon(lexicon.entries, lexicon.exceptions, 0.0, 10.0 if prior > 0.5 else -10.0)
    a, b = 0.0, 0.0
    for _ in range(50):       # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((y - p) * x).sum() - 1e-3 * a, (y - p).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return Lexicon(lexicon.entries, lexicon.exceptions, float(a), float(b))


def _features(rows: DataFrame, lexicon: Lexicon, first: str) -> DataFrame:
    key = ("lexicon", uuid.uuid4().hex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_cache(key, lexicon.automaton)
        for b in batches:
            x = [lexicon.feature(automaton, t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64())],
                                             names=[first.split()[0], "feature"])

    return rows.mapInArrow(run, f"{first}, feature double")


def score(docs: DataFrame, lexicon: Lexicon, divisor: int = 5, remainder: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, matched weight by length."""
    x = F.least(F.greatest(F.col("feature") * lexicon.slope + lexicon.offset, F.lit(-60.0)),
                F.lit(60.0))
    p = 1.0 / (1.0 + F.exp(-x))
    return (_features(id_text(docs), lexicon, "doc_id long")
            .select("doc_id", held_out(F.col("doc_id"), divisor, remainder).alias("held_out"),
                    p.alias("score"), "feature")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def remove_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """The input rows with a score below 0.5, unchanged; nothing is shuffled."""
    at, key = docs.columns.index(text_col), ("lexicon", uuid.uuid4().hex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_cache(key, lexicon.automaton)
        for b in batches:
            yield b.filter(pa.array([lexicon.score(lexicon.feature(automaton, t or "")) < 0.5
                                     for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
