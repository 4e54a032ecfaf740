import re

import numpy as np
import pytest

from tablecare.llm import jaccard_join, quotes
from tablecare.llm.components import components


# -- components ----------------------------------------------------------------------
def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(5, 3), (3, 4), (100, 100), (200, 7)]
    got = {r["node"]: r["comp"] for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 10 for i in range(10, 41))
    assert got[5] == got[4] == got[3] == 3 and got[100] == 100 and got[200] == 7


# -- Jaccard join ------------------------------------------------------------------------
def _set(text):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def _brute(rows):
    sets = [_set(t) for _, t in rows]
    key = [i if i is not None else -(1 << 63) for i, _ in rows]
    at = {k: k for k in key}

    def root(k):
        while at[k] != k:
            k = at[k]
        return k
    for x in range(len(rows)):
        for y in range(x):
            k = len(sets[x] & sets[y])
            if k and 100 * k >= 80 * (len(sets[x]) + len(sets[y]) - k):
                a, b = sorted((root(key[x]), root(key[y])))
                at[b] = a
    real = lambda k: None if k == -(1 << 63) else k
    return sorted(((i, len(s), real(root(k))) for (i, _), s, k in zip(rows, sets, key)), key=repr)


def _check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.link_components(docs, **options)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(rows)


def _family(r, base, copies, edits, words):
    out = []
    for _ in range(copies):
        w = list(base)
        for at in r.choice(len(w), edits, replace=False):
            w[at] = str(r.choice(words)) + str(r.integers(0, 10_000))
        out.append(" ".join(w))
    return out


def test_awkward_rows(spark, awkward, empty):
    _check(spark, [(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert jaccard_join.link_components(empty).count() == 0
    kept = jaccard_join.keep_one_per_component(awkward)
    assert kept.columns == awkward.columns


@pytest.mark.parametrize("seed,rare,large", [(0, 3, 4), (1, 32, 64)])
def test_by_brute_force(spark, monkeypatch, seed, rare, large):
    """Families around the threshold, a shared passage, short texts; small limits reach all paths."""
    monkeypatch.setattr(jaccard_join, "LARGE_LIST", large)
    monkeypatch.setattr(jaccard_join, "TILE", 16)
    r = np.random.default_rng(seed)
    words = [f"v{i}" for i in range(300)]
    passage = " ".join(r.choice(words, 60))
    texts = []
    for size, copies, edits in ((40, 12, 1), (80, 25, 2), (120, 70, 3), (200, 10, 4)):
        texts += _family(r, r.choice(words, size), copies, edits, words)
    texts += [passage + " " + " ".join(r.choice(words, int(r.integers(5, 60)))) for _ in range(50)]
    texts += [" ".join(r.choice(words[:3], int(r.integers(0, 9)))) for _ in range(40)]
    texts += texts[:5] + [t.upper() for t in texts[40:45]]
    _check(spark, [(i * 3, t) for i, t in enumerate(texts)], rare=rare)


def test_one_of_near_copies_stays_whatever_the_ids(spark):
    def near(start):
        text = " ".join(f"w{start + i}" for i in range(100))
        return [text, text + " end", "begin " + text]

    rows = [(None, t) for t in near(0)] + [(7, t) for t in near(1000)]          # all NULL, all the same
    rows += [(i, t) for i, t in zip((9, None, 8), near(2000))] + [(i, t) for i, t in zip((5, 4, 6), near(3000))]
    rows += [(7, "alone under a repeated id"), (None, ""), (None, None), (3, " "), (7, "")]
    kept = jaccard_join.keep_one_per_component(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = {v: [r["doc_id"] for r in kept if f"w{v} " in (r["text"] or "")] for v in (50, 1050, 2050, 3050)}
    assert of == {50: [None], 1050: [7], 2050: [None], 3050: [4]}
    assert len(kept) == 4 + 5


# -- quotes ---------------------------------------------------------------------------------
def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nAnd how fast is it?"),
        (1, 1, "assistant", "> How do I  SORT?\n\nUse sort."),
        (1, 2, "user", "Unrelated words."),
        (1, 3, "assistant", ">> how do I sort?\n> Use sort.\nIt is stable."),
        (1, 4, "user", "> Unrelated words.\nThanks."),
        (1, 5, "user", "> never said\nHm."),
        (2, 0, "user", "> How do I sort?\nOther conversation."),
        (None, None, None, None), (None, 1, "user", ""),
        (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 1, "assistant", "> same\nyes"),
    ]
    data = spark.createDataFrame([(*x, 9) for x in rows], "conv_id long, turn long, role string, text string, depth int")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_quotes(data).collect()}
    assert quotes.link_quotes(data).count() == len(rows)
    assert got[1, 1]["reply_to"] == 0 and got[1, 1]["body"] == "Use sort."
    assert got[1, 3]["reply_to"] == 1 and got[1, 3]["body"] == "It is stable."
    assert [tuple(q) for q in got[1, 3]["quoted"]] == [(1, 1), (2, 0)]
    assert got[1, 3]["thread"] == 0 and got[1, 3]["depth"] == 2
    assert got[1, 4]["reply_to"] == 2 and got[1, 5]["reply_to"] is None
    assert got[2, 0]["reply_to"] is None and got[3, 1]["reply_to"] == 0
    order = sorted((r["position"], t) for (c, t), r in got.items() if c == 1)
    assert order == [(0, 0), (1, 1), (2, 3), (3, 2), (4, 4), (5, 5)]
    assert got[1, 1]["segment"] == "<|assistant|>\nUse sort.\n<|end|>\n"
    assert got[None, None]["body"] == "" and got[None, None]["position"] == 0


def test_quotes_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link_quotes(none).count() == 0


def test_a_long_chain_and_far_quotes(spark):
    rows = [(1, i, "user", (f"> message {i - 1}\n" if i else "") + f"message {i}") for i in range(60)]
    rows += [(2, 0, "user", "start"), (2, 5000, "user", "> start\nend"), (2, 9000, "user", "> start\n> end\nz")]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = {(r["conv_id"], r["turn"]): r for r in got.collect()}
    assert by[1, 59]["depth"] == 59 and by[1, 59]["thread"] == 0 and by[1, 59]["position"] == 59
    assert by[2, 9000]["reply_to"] == 0 or by[2, 9000]["reply_to"] == 5000
    assert by[2, 5000]["reply_to"] == 0


def test_sentences_and_wrapped_paragraphs(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nIt is slow\nhere.\n\nThanks."),
        (1, 1, "assistant", "> How do I sort? It is slow here.\n\nUse an index."),      # wrapped anew
        (2, 0, "user", "It rains (again.) Take a coat. Go early!"),
        (2, 1, "assistant", "Unrelated."),
        (2, 2, "assistant", "> Take a coat.\n\nWhich one?"),                            # one sentence
        (2, 3, "user", "> Take a\n> coat. Go\n> early!\n\nYes."),                     # two, wrapped
        (3, 0, "user", "First part\nof it.\n\nSecond part\nof it.\n\nThird."),
        (3, 1, "assistant", ">> never said\n> Second part of it.\nWell."),
        (3, 2, "user", "> Well.\n>\n> Not this one.\nHm."),
        (4, 0, "user", "今日は。元気ですか？「はい。」そう。"), (4, 1, "assistant", "> 元気ですか？\nはい"),
        (5, 0, "user", "Version 1.5 is out. Try it."), (5, 1, "user", "> 5 is out.\nNo sentence."),
    ]
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["reply_to"] for r in quotes.link_quotes(data).collect()}
    assert {k: v for k, v in got.items() if k[1]} == {
        (1, 1): 0, (2, 1): None, (2, 2): 0, (2, 3): 0, (3, 1): 0, (3, 2): 1, (4, 1): 0, (5, 1): None}


def _brute_links(messages):
    """{(conv, turn): ([(level, source)], thread, position)} by comparing every passage with every message."""
    def norm(t):
        return " ".join(t.lower().split())

    def pieces(lines):
        """Lines, sentences, paragraphs and the whole of one run."""
        paragraphs = [[]]
        for x in map(norm, lines):
            if x:
                paragraphs[-1].append(x)
            else:
                paragraphs.append([])
        paragraphs = [" ".join(p) for p in paragraphs]
        sentences = [x for p in paragraphs for x in re.findall(r".+?[.!?](?=\x20|$)|.+", p)]
        return {norm(x) for x in [*lines, *paragraphs, *sentences, " ".join(lines)]} - {""}

    parsed = {}
    for conv, turn, _, text in messages:
        runs = []
        for line in text.split("\n"):
            mark = re.match(r"((?: {0,3}>)+) ?", line)
            level = mark.group(1).count(">") if mark else 0
            if not runs or runs[-1][0] != level:
                runs.append((level, []))
            runs[-1][1].append(line[mark.end():] if mark else line)
        own = {p for level, x in runs if not level for p in pieces(x)}
        own.add(norm(" ".join(x for level, lines in runs if not level for x in lines)))
        quoted = {(level, p) for level, x in runs if level for p in pieces(x)}
        parsed.setdefault(conv, {})[turn] = own, quoted
    out = {}
    for conv, turns in parsed.items():
        thread = {}
        found = {}
        for turn in sorted(turns):
            sums = {}
            for level, p in turns[turn][1]:
                sources = [t for t in turns if t < turn and p in turns[t][0]]
                if sources:
                    key = level, max(sources)
                    sums[key] = sums.get(key, 0) + len(p)
            best = {v: max((n, s) for (u, s), n in sums.items() if u == v)[1] for v in {u for u, _ in sums}}
            found[turn] = sorted(best.items())
            thread[turn] = thread[found[turn][0][1]] if best else turn
        for i, turn in enumerate(sorted(turns, key=lambda t: (thread[t], t))):
            out[conv, turn] = found[turn], thread[turn], i
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_quotes_by_brute_force(spark, seed):
    """The given conversations hold no quotes: replies are made here from lines of earlier turns."""
    r = np.random.default_rng(seed)
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    texts = [x["text"] for x in given.orderBy("conv_id", "turn").collect() if x["text"]]
    hot = "Thank you all."
    rows = []
    for conv in range(6):
        said = []
        for turn in range(14):
            own = texts[r.integers(len(texts))].split("\n")
            own = own[:r.integers(1, 4)] + ["", hot] * int(r.integers(2))
            lines = []
            for _ in range(r.integers(0, 3) if said else 0):
                lines_of = said[r.integers(len(said))]
                kind = r.integers(5)
                if kind == 0:                                        # some lines
                    part = lines_of[:r.integers(1, len(lines_of) + 1)]
                elif kind == 1:                                      # one sentence
                    found = re.findall(r"[^.!?]+[.!?]", lines_of[r.integers(len(lines_of))])
                    part = [x.strip() for x in found[:1]] or lines_of
                elif kind == 2:                                      # wrapped anew
                    w = " ".join(lines_of).split()
                    part = [" ".join(w[i:i + 7]) for i in range(0, len(w), 7)]
                elif kind == 3:
                    part = [hot]
                else:
                    part = ["never said", *lines_of[:1]]
                lines += [">" * int(r.integers(1, 4)) + " " + x for x in part]
            said.append(own)
            rows.append((conv, turn, "user", "\n".join(lines + own)))
    got = {(x["conv_id"], x["turn"]): x for x in quotes.link_quotes(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    want = _brute_links(rows)
    assert sum(bool(v[0]) for v in want.values()) > 25
    assert {k: ([tuple(q) for q in x["quoted"] or []], x["thread"], x["position"])
            for k, x in got.items()} == want


# -- pipeline --------------------------------------------------------------------------------
def test_pipeline_by_brute_force(spark):
    import corpus_pipeline
    from tablecare.llm import decontaminate, toxicity
    from tablecare.llm.common import table

    sf = "/root/testdata/sf0.001"
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    lexicon = toxicity.learn(docs, table(spark, sf, "labels"))
    automaton = lexicon.automaton()
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    rows = [(i, t) for i, t in rows if lexicon.score(lexicon.feature(automaton, t)) < 0.5]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, -1))
    rows = [(i, t) for i, t in rows if last[t] == i]
    stays = {i for i, _, c in _brute(rows) if i == c}
    index = decontaminate.Index([(r["item_id"], r["text"]) for r in bench.collect()], 8, 0.1)
    want = {i: len(re.findall("[^\x20\x09-\x0D]+", t)) for i, t in rows
            if i in stays and not index.find(decontaminate.fold(t))}
    got = {}
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
    assert got == want
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]


def test_null_and_empty_conversations_are_apart(spark):
    rows = [(None, 0, "user", "the first thing that was said"), (None, 1, "user", "> the first thing that was said"),
            ("", 1, "user", "> the first thing that was said"), ("=", 0, "user", "the first thing that was said"),
            ("", 0, "user", "something else")]
    data = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["reply_to"], r["position"]) for r in quotes.link_quotes(data).collect()}
    assert got == {(None, 0): (None, 0), (None, 1): (0, 1), ("", 0): (None, 0), ("", 1): (None, 1), ("=", 0): (None, 0)}
