"""Compression rules, periodic runs and hard negatives against plain versions."""

import base64
import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tablecare.llm import catalog, compression_rules, hard_negatives, periodic_runs
from tablecare.llm.common import table

from .conftest import SF

WORD = re.compile("[^\x20\x09-\x0D]+")


# compression rules ------------------------------------------------------------------------

def plain_base(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
              for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(inside), failed


def plain_kept(text, failed, rules):
    def bad(piece):
        if len(piece) < 64:
            return False
        low, high = next((lo, hi) for below, lo, hi in rules.bands if len(piece) < below)
        return not low <= len(zstandard.compress(piece, rules.level)) / len(piece) <= high

    data = (text or "").encode()
    cuts = [data[k:k + rules.chunk] for k in range(0, len(data), rules.chunk)]
    share = sum(len(c) for c in cuts if bad(c))
    return not (failed or bad(data) or 100 * share > rules.max_bad_percent * len(data))


def check_rules(rows, texts):
    rules = compression_rules.Rules()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    expected = Counter()
    for i, t in texts:
        base = plain_base(t)
        expected[(i, *base, plain_kept(t, base[-1], rules))] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed, r.kept) for r in rows) == expected


def test_rules_on_documents(spark):
    rows = catalog.op11_quality_rules(spark, SF).collect()
    check_rules(rows, [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()])


def test_rules_awkward(spark, awkward, empty):
    rows = compression_rules.judge(awkward).collect()
    check_rules(rows, [(r.doc_id, r.text) for r in awkward.collect()])
    assert compression_rules.judge(empty).count() == 0
    kept = compression_rules.keep(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)
    assert compression_rules.keep(empty).count() == 0


def test_rules_reject_by_compression(spark):
    rng = random.Random(3)
    prose = [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
                      for _ in range(900)) for _ in range(2)]
    noise = " ".join(base64.b64encode(rng.randbytes(40)).decode() for _ in range(300))
    line = " ".join(f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr")
    # every line differs in one word, so few windows repeat within a half of the words
    near = "\n".join(" ".join(rng.sample(["x" * 60, "y" * 60, "z" * 60], 3)) for _ in range(400))
    mixed = prose[0][:4096] + noise[:3 * 4096]
    texts = [(1, prose[0]), (2, prose[1]), (3, noise), (4, near), (5, line), (6, mixed)]
    rows = {r.doc_id: r for r in compression_rules.judge(
        spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert rows[1].kept and rows[2].kept
    assert rows[3].reason == "incompressible"
    assert not rows[4].kept and rows[4].ratio < 0.1
    assert not rows[6].kept and rows[6].high_bytes > 0
    check_rules(rows.values(), texts)


# periodic runs ----------------------------------------------------------------------------

def plain_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                out.setdefault((start, i - start + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(4000):
        n, letters = rng.randrange(0, 70), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 8 and rng.random() < 0.5:
            a, p = rng.randrange(n // 2), rng.randrange(1, 6)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        got = periodic_runs.runs_of(np.array(words, np.int64))
        assert got == plain_runs(words), words


@pytest.mark.parametrize("words", [[0] * 200_000, [0, 1] * 100_000,
                                   list(range(40_000)) * 5, list(range(200_000))])
def test_long_texts(words):
    runs = periodic_runs.runs_of(np.array(words, np.int64))
    period = len(set(words))
    assert runs == ([] if period == len(words) else [(0, len(words), period)])


def plain_digest(doc_id, text):
    words = WORD.findall(text or "")
    h, n = crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
         "collapsed_sha256")


def test_runs_of_documents(spark):
    got = catalog.op13_periodic_runs(spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert Counter(tuple(r[n] for n in NAMES) for r in got) == Counter(
        plain_digest(i, t) for i, t in texts)
    assert any(r.n_runs for r in got)


def test_runs_awkward(spark, awkward, empty):
    rows = awkward.withColumn("runs", F.lit("clash")).withColumn("start", F.lit(1))
    rows = rows.unionByName(spark.createDataFrame(
        [(20, "a b " * 40), (21, "x " + "one two three\n" * 9), (22, "é é é é é é")],
        "doc_id long, text string"), allowMissingColumns=True).where("length(text) < 1000 OR text IS NULL")
    got = periodic_runs.digest(periodic_runs.find_runs(
        rows, reorder=periodic_runs.seeded_periods)).collect()
    assert Counter(tuple(r[n] for n in NAMES) for r in got) == Counter(
        plain_digest(r.doc_id, r.text) for r in rows.collect())
    assert periodic_runs.digest(periodic_runs.find_runs(empty)).count() == 0
    assert periodic_runs.find_runs(awkward).count() == awkward.count()


# hard negatives ---------------------------------------------------------------------------

def quantised(vec):
    return [int(np.floor(256 * float(x))) for x in vec]


def plain_negatives(rows, anchor):
    """rows: (vec_id, vec, label); ties by vec_id, NULL last, then place."""
    ok = [(i, quantised(v), label) for i, v, label in rows if label is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (i, v, label) in enumerate(ok):
        if not anchor(i):
            continue
        ranked = sorted(((-dot(v, w), j is None, j or 0, m) for m, (j, w, _) in enumerate(ok) if m != k))
        same = [r for r in ranked if ok[r[3]][2] == label][:5]
        for s, _, _, m in same:
            hits = [r for r in ranked if ok[r[3]][2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(i, ok[m][0], n, ok[r[3]][0], -s, -r[0]) for n, r in enumerate(hits, 1)]
    return Counter(out)


SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "clash", 0.5) for i, v, y in rows], SCHEMA)


@pytest.mark.parametrize("block_rows,part_rows", [(10_000, 10_000), (50, 16)])
def test_negatives_brute_force(spark, block_rows, part_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(400):
        v = (centres[i % 6] + rng.normal(size=12) * (0.05 if i % 2 else 0.6)).astype(np.float32)
        rows.append((i, v.tolist(), int(rng.integers(0, 3))))
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(60)]              # one hot vector
    got = hard_negatives.mine(frame(spark, rows), is_anchor=F.col("vec_id") % 10 == 0,
                              block_rows=block_rows, part_rows=part_rows).collect()
    assert Counter(map(tuple, got)) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.0, 0.0], 1), (200, [], 2),
            (300, [-1.0, -1.0], 2), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1),
            (4, [inf, 1.0], 2), (5, [1.0, 1.0], None), (None, [0.9, 0.4], 1), (None, [0.6, 0.3], 2),
            (6, [0.6, 0.3], 2), (7, [0.6, 0.3], 3), (8, [0.5], 2), (9, [0.2, 0.2, 9.0], 4),
            (10, [-0.5, 0.1], 3), (400, [0.7, 0.3], 3)]
    anchor = lambda i: i is not None and i % 100 == 0
    got = hard_negatives.mine(frame(spark, rows), is_anchor=F.col("vec_id") % 100 == 0).collect()
    assert Counter(map(tuple, got)) == plain_negatives(rows, anchor)
    nothing = frame(spark, rows).where("vec_id < -5")
    assert hard_negatives.mine(nothing).count() == 0
    assert hard_negatives.mine(frame(spark, rows).where("vec_id = 8")).count() == 0


def test_negatives_large_components(spark):
    rows = [(i, [float(2.0 ** (20 + i % 3)), float(i), 3e6 + i], i % 2) for i in range(40)]
    rows += [(100, [3e38, 3e38, 1.0], 0), (101, [-3e38, 1.0, 1.0], 1)]      # beyond any long: no crash
    small = rows[:40]
    got = hard_negatives.mine(frame(spark, small), is_anchor=F.col("vec_id") % 10 == 0).collect()
    assert Counter(map(tuple, got)) == plain_negatives(small, lambda i: i % 10 == 0)
    assert hard_negatives.mine(frame(spark, rows), is_anchor=F.col("vec_id") % 10 == 0).count() >= 0


def test_tree_covers_its_rows():
    rng = np.random.default_rng(0)
    vectors = np.floor(256 * np.vstack([rng.normal(size=(300, 6)), np.ones((40, 6))]))
    n = np.arange(len(vectors))
    tree = hard_negatives.CoverTree.build(n, n, n >= 0, n % 3, vectors)
    assert sorted(tree.rows.tolist()) == n.tolist()
    norm2 = (tree.vectors ** 2).sum(1)
    lifted = np.hstack([tree.vectors, np.sqrt(np.maximum(tree.top - norm2, 0))[:, None]])
    for node in range(len(tree.centre)):
        away = np.linalg.norm(lifted[tree.begin[node]:tree.end[node]] - lifted[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-3
    again = hard_negatives.CoverTree.unpack(tree.pack())
    assert (again.vectors == tree.vectors).all() and (again.child == tree.child).all()
