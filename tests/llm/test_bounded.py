"""Hard inputs in bounded time, and scorers against naive versions."""

import math
import random
import resource
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablecare.llm import binary_records, decontaminate, exact_dedup, quality_cnn, toxicity
from tablecare.llm.catalog import tokenizer

from .test_text_operators import _distance

# decontamination --------------------------------------------------------------------------

def code(n):
    return f"def f{n}(x):\n" + "".join(f"{' ' * 16}value_{n}_{k} = x{k * n} + {k}\n" for k in range(8))


def test_long_separator_runs():
    index = decontaminate.Index([(i, code(i)) for i in range(50)], 8, 0.1)
    text = "x" + " " * 500_000 + code(7) + "-" * 500_000
    start, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = index.find(decontaminate.fold(text))
    assert any(r[0] == 7 and r[3] == 0 for r in found)
    assert time.time() - start < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000     # KB


def test_a_qgram_in_every_passage():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfghjklm") for _ in range(6))
    items = [" ".join(["all rights reserved", *(word() for _ in range(12))]) for _ in range(2_000)]
    index = decontaminate.Index(list(enumerate(items)), 8, 0.1)
    start = time.time()
    found = index.find(decontaminate.fold("all rights reserved " * 20_000 + items[5]))
    assert [(r[0], r[3]) for r in found] == [(5, 0)] and time.time() - start < 60


@pytest.mark.parametrize("common,hits", [(2, 1 << 21), (1024, 64), (3, 50)])
def test_regions_with_common_qgrams_and_small_steps(monkeypatch, common, hits):
    monkeypatch.setattr(decontaminate, "COMMON", common)
    monkeypatch.setattr(decontaminate, "HITS", hits)
    r = np.random.default_rng(common)
    shared = "the same opening words "
    items = [shared + "".join(r.choice(list("abcdef  "), 80)) for _ in range(8)]
    texts = ["".join(r.choice(list("abcdef  "), r.integers(0, 1500))) for _ in range(16)]
    for n in range(16):
        p = list(items[n % 8])
        for _ in range(r.integers(0, 9)):
            p[r.integers(0, len(p))] = "x"
        at = r.integers(0, len(texts[n]) + 1)
        texts[n] = texts[n][:at] + shared * int(r.integers(0, 4)) + "".join(p) + texts[n][at:]
    index = decontaminate.Index(list(enumerate(items)), 8, 0.1)
    for t in texts:
        folded = decontaminate.fold(t)
        text = "".join(map(chr, folded))
        want = {i for i, p in enumerate(index.texts)
                if _distance("".join(map(chr, p)), text) <= index.k[i]}
        assert {g[0] for g in index.find(folded)} == want


# toxicity ---------------------------------------------------------------------------------

def naive_feature(lexicon, text):
    """Every entry at every place, without an automaton."""
    folded = toxicity.fold(text)
    spared = [(m, m + len(e)) for e in lexicon.exceptions for m in range(len(folded))
              if folded.startswith(e, m)]
    total = 0.0
    for start in range(len(folded)):
        weights = [w for e, w in lexicon.entries.items() if folded.startswith(e, start)]
        if weights and not any(a <= start < b - 1 for a, b in spared):
            total += max(max(weights), 0.0)
    return total / math.log(math.e + folded.count(" "))


def test_feature_against_naive():
    rng = random.Random(5)
    words = ["vile", "vilest", "mud", "mudlark", "calm", "sea", "v1le", "MUD", "the", "vi-le"]
    lexicon = toxicity.Lexicon({" vile": 2.0, " mud ": 1.5, " vilest ": 3.0, " sea ": 0.5},
                               [" mud sea ", " calm vile ", " the mud "], 1.0, -1.0)
    automaton = lexicon.automaton()
    for _ in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))
        assert lexicon.feature(automaton, text) == pytest.approx(naive_feature(lexicon, text)), text


def test_many_hits_in_one_text():
    lexicon = toxicity.Lexicon({" mud ": 1.5}, [" mud sea "], 1.0, -1.0)
    start = time.time()
    x = lexicon.feature(lexicon.automaton(), "mud sea mud " * 100_000)
    assert x == pytest.approx(100_000 * 1.5 / math.log(math.e + 300_001))
    assert time.time() - start < 20


def test_too_large_a_lexicon_raises(spark):
    docs = [(i, " ".join(f"w{i}x{k} bad{k}" for k in range(40))) for i in range(60)]
    labels = [(i, int(i < 30)) for i in range(60)]
    docs = [(i, t if y else t.replace("bad", "good")) for (i, t), (_, y) in zip(docs, labels)]
    with pytest.raises(ValueError, match="lexicon entries"):
        toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(labels, "doc_id long, toxic int"), max_entries=3)


def test_remove_toxic_awkward(spark, awkward, empty):
    lexicon = toxicity.Lexicon({" one ": 9.0}, [], 1.0, -1.0)
    left = toxicity.remove_toxic(awkward, lexicon)
    assert left.columns == awkward.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(
        r.doc_id for r in awkward.collect() if r.doc_id != 9)
    assert toxicity.remove_toxic(empty, lexicon).count() == 0


# quality network --------------------------------------------------------------------------

def naive_score(net, text):
    """One position, filter and chunk at a time."""
    k, w = net.p["k"], net.width
    block, span, hop = quality_cnn.BLOCK, quality_cnn.CHUNK_BLOCKS, quality_cnn.HOP_BLOCKS
    need = -(-(len(text) + w - 1) // block)
    blocks = span
    while blocks < need:
        blocks += hop
    data = text + bytes(blocks * block + w - len(text))
    tops = []
    for first in range(0, blocks - span + 1, hop):
        values = [sum(k[i][data[at + i]] for i in range(w))
                  for at in range(first * block, (first + span) * block)]
        tops.append(np.maximum(np.max(values, axis=0) + net.p["b"], 0))
    pooled = np.concatenate([np.mean(tops, axis=0), np.max(tops, axis=0)])
    h = np.maximum(pooled @ net.p["v"] + net.p["c"], 0)
    return 1 / (1 + math.exp(-float(np.clip(h @ net.p["u"] + net.p["d"][0], -30, 30))))


def test_network_against_naive():
    rng = random.Random(1)
    net = quality_cnn.Network(filters=4, width=8, hidden=5, seed=3)
    net.p["b"] += 0.1
    texts = [b"", b"a", rng.randbytes(256), rng.randbytes(257), rng.randbytes(900), b"zz " * 700]
    got = net.score(texts, net.pairs())
    assert got == pytest.approx([naive_score(net, t) for t in texts], abs=1e-4)


# exact dedup and encoding -----------------------------------------------------------------

def test_deduplicate_keeps_whole_winners(spark, empty):
    rows = [(i, t, f"r{i}", 1.0) for i, t in [
        (1, "a"), (5, "a"), (3, "a"), (None, "a"), (2, None), (7, ""), (None, "x"), (None, "x"),
        (4, "b" * 200_000), (6, "b" * 200_000), (8, "c"), (8, "c")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, `row.x` double")
    docs = docs.union(docs.where("doc_id = 1").crossJoin(spark.range(500)).drop("id"))
    got = exact_dedup.deduplicate(docs.repartition(7))
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text and r.text[:3], r.digest) for r in got.collect()) == Counter(
        [(5, "a", "r5"), (7, "", "r7"), (None, "x", "rNone"), (6, "bbb", "r6"), (8, "c", "r8")])
    null_wins = exact_dedup.deduplicate(docs.where("doc_id IN (2, 7)").withColumn(
        "doc_id", F.when(F.col("doc_id") == 2, 9).otherwise(F.col("doc_id"))))
    assert [(r.doc_id, r.text) for r in null_wins.collect()] == [(9, None)]
    assert exact_dedup.deduplicate(empty).count() == 0


def test_encoder_equals_tokenizer():
    rng = random.Random(0)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", " ", "\x1c", "\x85", "​",
             "a", "foo", "é", "日本", "'s", "don't", "12", "3.", "“x”", "¿", "ß", "!", "\x00", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 12))) for _ in range(6000)]
    texts += ["x" * 100, " " * 50 + "a", "", "\n" * 30, "y" * 5000 + " z"]
    encoder = binary_records.Encoder(tokenizer("byte_bpe_50k.json"))
    want = [np.array(e.ids, f"<u{encoder.width}").tobytes()
            for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    column = pa.array(["skipped", *texts])[1:]
    assert encoder.encode(column) == want and encoder.encode(column) == want
    binary_records.KEEP_UNITS, kept = 10, binary_records.KEEP_UNITS
    try:
        assert encoder.encode(texts) == want
    finally:
        binary_records.KEEP_UNITS = kept


def test_units_met_again_outlast_a_full_store(monkeypatch):
    monkeypatch.setattr(binary_records, "KEEP_UNITS", 20)
    encoder = binary_records.Encoder(tokenizer("byte_bpe_50k.json"))
    asked, each = [], encoder._encode_units
    monkeypatch.setattr(encoder, "_encode_units", lambda units, at: asked.extend(units) or each(units, at))
    for n in range(6):
        text = f"one same \t two {'x' * 60} " + " ".join(f"w{n}{k}" for k in range(4))
        assert encoder.encode([text, ""]) == [np.array(encoder.tokenizer.encode(
            text, add_special_tokens=False).ids, "<u2").tobytes(), b""]
    assert asked.count(b" two") == 1 and asked.count(b" w00") == 1 and len(encoder.number) <= 20
