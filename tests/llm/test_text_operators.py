import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecare.llm import binary_records as B
from tablecare.llm import decontaminate, quality_cnn, secrets, token_counts, toxicity
from tablecare.llm.catalog import tokenizer


# -- binary records -----------------------------------------------------------
def test_round_trip(awkward, spark):
    path = tokenizer("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["text"] or "") for r in awkward.collect()]
    want = []
    for i, t in rows:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = B.write_and_read(awkward, path).orderBy("start").collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    at = 0
    for r in got:                                   # starts follow on from each other, ids ascend
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert ids == sorted(ids) and got[0]["doc_id"] is None


def test_no_documents(empty):
    assert B.write_and_read(empty, tokenizer("byte_bpe_50k.json")).count() == 0


def test_damage_is_found():
    data = B.frame(7, b"\x01\x00\x02\x00", 2) + b"\n"
    assert [(d, i.tolist()) for _, _, d, i in B.records(data)] == [(7, [1, 2])]
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(B.records(bytes(broken)))
    with pytest.raises(ValueError):
        list(B.records(data[:-3]))


def test_encoder_equals_tokenizer():
    e = B.Encoder(tokenizer("byte_bpe_50k.json"))
    texts = ["", " ", "  a  b ", " \n x\n y", "<|endoftext|> x <|endoftext|>y", "é  \t\n 's don't  ",
             "日本 語", "x  y  z", "a" * 200, "\x1c \x1c a", "1 22  333 "]
    want = [np.array(x.ids, "<u2").tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert e.encode(texts) == want and e.encode(texts) == want


# -- token counts ---------------------------------------------------------------
def test_viterbi_equals_public_unigram(awkward):
    from tokenizers import Tokenizer, models

    pieces = token_counts.vocabulary(tokenizer("piece_bpe_32k.model"))
    exact = Tokenizer(models.Unigram(pieces, 0, True))
    counter = token_counts.Counter(pieces)
    texts = [r["text"] or "" for r in awkward.collect()] + [
        "The quick brown fox", "  two  spaces ", "▁▁ x▁y", "<0x41> <s> </s>", "日本語 テキスト",
        "x" * 300, "aaaa aaaa", "\n\n\t", "1234567890 3.14"]
    for t in texts:
        mark = "▁" + t.replace(" ", "▁") if t else ""
        want = len(exact.encode(mark).ids) if mark else 0
        assert counter.of(t) == want, t[:40]


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_ties(seed):
    from tokenizers import Tokenizer, models

    r = np.random.default_rng(seed)
    pieces = [("<unk>", -9.0), ("a", -1.0), ("b", -2.0), ("ab", -3.0), ("ba", -3.0), ("aa", -2.0),
              ("▁a", -2.0), ("▁", -1.0), ("aba", -4.0)]
    exact, counter = Tokenizer(models.Unigram(pieces, 0, False)), token_counts.Counter(pieces)
    for _ in range(60):
        t = "".join(r.choice(list("aab bc"), r.integers(1, 12)))
        assert counter.of(t) == len(exact.encode("▁" + t.replace(" ", "▁")).ids), t


def test_counts_of_awkward_rows(awkward):
    """NULL ids and texts, repeated rows and columns named like results: each row has its count."""
    path = tokenizer("piece_bpe_32k.model")
    counter = token_counts.Counter(token_counts.vocabulary(path))
    want = sorted(((r["doc_id"], counter.of(r["text"] or "")) for r in awkward.collect()), key=repr)
    out = token_counts.count_tokens(awkward, path)
    assert out.columns == ["doc_id", "n_tokens"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want


def test_a_long_unit_in_little_memory():
    """A text without spaces keeps a ring of positions, not its matches."""
    import tracemalloc

    from tokenizers import Tokenizer, models

    pieces = token_counts.vocabulary(tokenizer("piece_bpe_32k.model"))
    counter, text = token_counts.Counter(pieces), "abcdefghi123xyzé" * 5_000
    tracemalloc.start()
    got = counter.of(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000_000
    assert got == len(Tokenizer(models.Unigram(pieces, 0, True)).encode("▁" + text).ids)


def test_counts_of_nothing(empty):
    assert token_counts.count_tokens(empty, tokenizer("piece_bpe_32k.model")).count() == 0


# -- decontamination --------------------------------------------------------------
def _distance(p, t):
    """Fewest edits of p against any part of t."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_regions_by_brute_force(seed):
    r = np.random.default_rng(seed)
    letters = list("abcdef ")
    items = ["".join(r.choice(letters, r.integers(60, 120))) for _ in range(6)]
    texts = ["".join(r.choice(letters, r.integers(0, 900))) for _ in range(12)]
    for n in range(12):                              # plant an item with some edits
        p = list(items[n % 6])
        for _ in range(r.integers(0, 14)):
            at = r.integers(0, len(p))
            p[at:at + 1] = r.choice([[], ["x"], [p[at], "y"]][int(r.integers(0, 3))] or [""], 1).tolist()
        at = r.integers(0, len(texts[n]) + 1)
        texts[n] = texts[n][:at] + "".join(p) + texts[n][at:]
    index = decontaminate.Index(list(enumerate(items)), 8, 0.1)
    for t in texts:
        folded = decontaminate.fold(t)
        text = "".join(map(chr, folded))
        got = index.find(folded)
        want = set()
        for i, p in enumerate(index.texts):
            if _distance("".join(map(chr, p)), text) <= index.k[i]:
                want.add(i)
        assert {g[0] for g in got} == want
        for i, start, end, edits, _ in got:
            assert _distance("".join(map(chr, index.texts[i])), text[start:end]) <= edits


def test_long_text_and_short_items():
    item = "the quick brown fox jumps over the lazy dog and runs away again"
    index = decontaminate.Index([(5, item), (6, "abc"), (7, ""), (8, "?!")], 8, 0.1)
    long = "zz " * 200_000
    for at in (0, 262_100, 300_000, len(long)):      # also across slices
        text = long[:at] + " " + item.upper() + " " + long[at:]
        assert [(g[0], g[3]) for g in index.find(decontaminate.fold(text))] == [(0, 0)]
    assert [g[0] for g in index.find(decontaminate.fold("x abc y abcd"))] == [1]


def test_decontaminate_tables(spark, awkward, empty):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, "")], "item_id long, text string")
    got = decontaminate.find(awkward, bench)
    assert {r["doc_id"] for r in got.collect()} == {1, 2, 7, None}   # 7: runs of white space fold to one space
    assert {(r["start"], r["end"], r["edits"]) for r in got.collect()} == {(0, 11, 0), (0, 12, 0)}
    left = decontaminate.remove_contaminated(awkward, bench)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 5
    assert decontaminate.find(empty, bench).count() == 0
    assert decontaminate.find(awkward, bench.limit(0)).count() == 0
    assert decontaminate.find(awkward, bench, block_chars=1).count() == got.count()


# -- learned operators ---------------------------------------------------------------
def _toxic_table(spark):
    r = np.random.default_rng(0)
    words = ["the", "and", "river", "stone", "cloud", "tree", "walk", "north", "green", "paper"]
    docs, labels = [], []
    for i in range(400):
        w = r.choice(words, 60).tolist()
        bad = i % 4 == 0
        if bad:
            for form in r.choice(["grobnik", "GROBNIK", "gr0bnik", "grоbnik"], 2):
                w.insert(int(r.integers(0, 60)), str(form))
        elif i % 4 == 1:
            w.insert(int(r.integers(0, 60)), "grobnik museum")       # a harmless phrase
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad), int(not bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_toxicity_folds_and_spares_phrases(spark, awkward, empty):
    docs, labels = _toxic_table(spark)
    lexicon = toxicity.learn(docs, labels, min_log_odds=0.5)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = toxicity.score(docs, lexicon).collect()
    out = [r for r in got if r["held_out"]]
    assert out and np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.95
    assert any("museum" in e for e in lexicon.exceptions)
    assert {r["doc_id"] for r in toxicity.remove_toxic(docs, lexicon).collect()} == {
        r["doc_id"] for r in got if not r["predicted"]}
    assert toxicity.score(awkward, lexicon).count() == awkward.count()
    assert toxicity.score(empty, lexicon).count() == 0
    nothing = toxicity.learn(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(awkward, nothing).collect()} == {0}


def test_late_entries_have_exceptions_too(spark):
    r = np.random.default_rng(4)
    letters = "abcdefghijklm"
    bad = [a + b + c for a in letters for b in letters for c in letters][:520]
    clean = ["n" + "".join(r.choice(list("opqrstuvw"), 5)) for _ in range(2000)]
    docs, labels = [], []
    for i in range(45):
        if i < 15:
            words = list(r.permutation(bad + ["zzz"] * 20))
        else:
            words = list(r.choice(clean, 600)) + (["quick", "zzz"] if i < 24 else []) + list(r.choice(clean, 9))
        docs.append((i, " ".join(words)))
        labels.append((i, int(i < 15)))
    lexicon = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(lexicon.entries) > 500 and " zzz " in lexicon.entries
    assert " quick zzz " in lexicon.exceptions


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = _toxic_table(spark)
    rows = toxicity.labelled_sample(docs, labels, "toxic", 5, 0, 1000).collect()
    assert rows and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 for r in rows)
    assert len(toxicity.labelled_sample(docs, labels, "toxic", 5, 0, 7).collect()) == 14


def test_quality_network(spark, awkward, empty):
    r = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(300):
        good = i % 2
        text = " ".join(r.choice(["tree", "walk", "north", "paper"], 80)) + ("" if good else " ### %%% ###")
        docs.append((i, text)), labels.append((i, good))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    net = quality_cnn.learn(docs, labels, epochs=10)
    truth = {x["doc_id"]: x["quality"] for x in labels.collect()}
    out = [x for x in quality_cnn.score(docs, net).collect() if x["held_out"]]
    assert out and np.mean([x["predicted"] == truth[x["doc_id"]] for x in out]) > 0.9
    assert all(0 <= x["score"] <= 1 for x in quality_cnn.score(awkward, net).collect())
    assert quality_cnn.score(empty, net).count() == 0
    assert {x["score"] for x in quality_cnn.score(awkward, quality_cnn.learn(docs, labels.limit(0))).collect()} == {0.5}


def test_network_slices_and_gradient():
    net = quality_cnn.Network(filters=3, width=4, hidden=5)
    texts = [b"", b"ab", bytes(range(256)) * 4, b"xy" * 60_000]
    pairs = net.pairs()
    whole = net.pooled(texts, pairs)
    single = np.vstack([net.pooled([t], pairs) for t in texts])
    assert np.allclose(whole, single, atol=1e-5)
    texts = [b"q r s", b"ab cd", bytes(range(256)) * 4]      # an empty one sits on a kink
    y = np.array([0.0, 1.0, 1.0], np.float32)
    grads = net.gradients(texts, y)

    def loss():
        p = net.score(texts, net.pairs())
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    for name in ("u", "c", "v", "b"):
        flat, g = net.p[name].reshape(-1), np.asarray(grads[name]).reshape(-1)
        at = int(np.abs(g).argmax())
        keep = flat[at]
        flat[at] = keep + 1e-3
        up = loss()
        flat[at] = keep - 1e-3
        down = loss()
        flat[at] = keep
        assert (up - down) / 2e-3 == pytest.approx(g[at], rel=0.1, abs=1e-3)


# -- secrets -----------------------------------------------------------------------
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.I | re.A)


def _base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def test_secrets_base_by_brute_force(spark, awkward):
    texts = ["", None, "password=short", "PassWord : 'abcdefgh' token=\"12345678", "api_key=api_key=abcdefgh",
             "日本 secret = aaaaaaaa\u0001bbbb", "AKIAAKIA0123456789 AKIA012", "ab" * 40 + "x" + "0" * 31,
             "ſecret=abcdefgh toKen=abcdefgh", "x\U0001F600 token=abcdefghi",
             " ".join(f"token=value{i:08d}" for i in range(700)), "tokens=abcdefgh token==abcdefgh"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.digest(secrets.scan(docs)).collect():
        want = _base(texts[r["doc_id"]] or "")
        assert r["spans"].split(",") == (want or [""]) or set(want) <= set(r["spans"].split(",")), r["doc_id"]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), r["doc_id"]
        assert r["n_assign"] == sum(w.startswith("assign") for w in want)
    assert secrets.digest(secrets.scan(awkward)).count() == awkward.count()


def test_random_runs_are_told_from_words(spark, empty):
    r = np.random.default_rng(3)
    b64 = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    prose = " ".join(r.choice(["tree", "walking", "north", "paper", "the", "river"], 60))
    docs = []
    for i in range(60):
        run = "".join(r.choice(b64, 40)) if i % 2 else "thewalkingpapertreethewalkingpapernorth"
        docs.append((i, f"{prose} {run} {prose}"))
    rows = secrets.digest(secrets.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    found = {x["doc_id"] for x in rows if "random" in x["spans"]}
    assert len([i for i in found if i % 2]) >= 27 and not [i for i in found if not i % 2]
    assert secrets.digest(secrets.scan(empty)).count() == 0


def _random_spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["random"] for r in secrets.scan(docs).collect()}
    return [[t[s["start"]:s["end"]] for s in rows[i]] for i, t in enumerate(texts)]


def test_random_runs_do_not_hang_on_the_corpus(spark):
    r = np.random.default_rng(5)
    keys = ["".join(r.choice(list("0123456789abcdef"), 40)) for _ in range(33)]
    words = "the walking tree of the northern river and some paper, then again the tree. " * 5
    single = f"{words}{keys[0]} {words}"
    assert _random_spans(spark, [single]) == [[keys[0]]]                   # a table with one key
    dump = "\n".join(keys[13:])                                            # one key a line, no prose
    assert _random_spans(spark, [dump]) == [keys[13:]]
    some = [f"{words}{k} {words}" for k in keys[:13]]                      # fewer than 20 runs
    assert _random_spans(spark, [*some, dump]) == [[k] for k in keys[:13]] + [keys[13:]]


def test_runs_that_are_not_random(spark):
    texts = ["=" * 30, "-" * 40, "a" * 40, "0123456789" * 5, "abcdefghijklmnopqrstuvwxyz" * 2, "deadbeef" * 5,
             "getUserAccountManagerFactoryDefaultConfigHandler", "/usr/local/share/documents/paper/index/default",
             "SOME_VERY_LONG_CONSTANT_NAME_OF_THE_MODULE"]
    assert _random_spans(spark, [f"x {t} y" for t in texts]) == [[]] * len(texts)


def test_battery_by_brute_force(spark):
    r = np.random.default_rng(9)
    for k, (name, letters) in enumerate(secrets.ALPHABETS.items()):
        runs = ["".join(r.choice(list(letters), n)) for n in (20, 33, 90)]
        places = [[letters.index(c) for c in x] for x in runs]
        got = spark.createDataFrame([(x,) for x in runs], "run string").select(
            secrets.score(F.col("run")).alias("s")).collect()
        assert [x["s"]["alphabet"] for x in got] == [k] * 3, name
        want = [secrets.scores(np.array([p]), len(letters))[0] for p in places]
        assert np.allclose([x["s"]["score"] for x in got], want), name
