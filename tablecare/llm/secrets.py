"""Secret scan: fixed patterns plus a randomness test battery [native].

Base kinds are leftmost non-overlapping pattern matches (``assign``, ``access``,
``hex``), see ``BASE``. The method adds ``random`` spans: maximal runs of 20 or
more key characters whose characters pass for random.

Each run's encoding is inferred from its characters (digits, hex, lower or
upper letters, base32, else base64); over that alphabet three statistics, each
about standard normal for uniform characters, are computed:

* chi-squared of the character counts against uniformity;
* runs above and below the middle of the alphabet;
* serial correlation of neighbouring characters.

Their squared sum is the run's score (small: random). What a run is held against does
not come from the corpus: per length of ``LENGTHS``, ``NULL_SIZE`` seeded windows of text that is
not random (shuffled prose of four languages in lower, upper and mixed case, with the
joins of names and paths and with numbers, plain numbers, repeated short units and
alphabets in order) go through the same inference and tests. A run is held against the
longest windows that are not longer than it. T is the share of windows with the run's
alphabet and at most its score; its p-value is the sum over
alphabets of min(T, share of the alphabet), the chance of a T as small. Per length class
the Benjamini-Hochberg step at ``fdr`` over the p-values tells which runs are listed;
they are counted in bins (a fixed number of rows, whatever the corpus). The least
p-value is 8 / (NULL_SIZE + 1), so at fdr 0.05 a class in which fewer than one run in
750 is random lists none; keys of lower-case letters only pass from about 48 on.

Positions are code points. Matches are located without Python: every match is
framed by a mark character, the text split at the marks, and lengths summed.

Defined cases: NULL and empty texts have no spans; NULL ids and repeated rows
stay; a span found by two kinds is listed under both; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import id_text, stage

# The base kinds in order, each with its pattern, a pattern that every
# text with a counted match has, the group that is measured and its least length.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{12}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", r"[0-9a-f]{32}", 0, 32),   # a maximal run of 32 is one of any length kept
}
RUN = r"[A-Za-z0-9+/_=-]{20,}"
# The alphabets that are tried, in this order.
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "upper hex": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
LENGTH_CLASSES = (24, 32, 48, 80)      # a class ends below each of these
LENGTHS = (20, 22, 24, 28, 32, 36, 40, 44, 48, 64, 80)   # lengths of null windows; has all class ends
BINS_PER_UNIT, BINS = 4, 400
NULL_SIZE, NULL_WORDS, SEED = 120_000, 100_000, 7
PROSE = """
the river runs past our old house and every morning she walks along it with a small brown dog
because nobody else would take him out before breakfast what happens when people change their minds
about something they have always believed is that first they deny it then explain why it was never
important request user index value update service manager factory default config module handler
le matin je prends mon vélo pour aller au marché où les gens parlent toujours du temps qu'il fait
nous avons trouvé cette maison par hasard quand il pleuvait depuis trois jours sans aucune raison
die kinder spielen nach der schule im garten während ihre eltern noch zwischen küche und wohnzimmer
laufen wir haben gestern einen langen brief geschrieben weil niemand das telefon abnehmen wollte
cuando llegamos al pueblo ya era de noche y solamente quedaba abierta una pequeña tienda donde
vendían pan queso y algunas botellas de vino mientras los hombres jugaban a las cartas sin hablar
"""
MARK, STAND_IN = "\u0001", "\u0002"
BLOCK = 128


def running_starts(sizes: Column) -> Column:
    """Start offset of each part, from the parts' sizes; two levels keep long arrays cheap."""
    def add(acc: Column, x: Column) -> Column:
        return F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def scan(values: Column, first: Column) -> Column:
        return F.slice(F.aggregate(values, F.array(first), add), 1, F.size(values))

    starts = F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda i: F.slice(sizes, i, BLOCK))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda x, y: x + y))
    return F.flatten(F.zip_with(blocks, scan(sums, F.lit(0)), scan))


def matches(text: Column, pattern: str, present: str) -> Column:
    """array<struct<start, end, found>> of the leftmost non-overlapping matches, in order."""
    plain = F.translate(text, MARK, STAND_IN)          # the patterns match neither
    parts = F.split(F.regexp_replace(plain, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)
    starts = running_starts(F.transform(parts, lambda p: F.length(p)))
    spans = F.transform(F.arrays_zip(starts.alias("s"), parts.alias("p")), lambda x: F.struct(
        x["s"].alias("start"), (x["s"] + F.length(x["p"])).alias("end"), x["p"].alias("found")))
    inside = F.filter(spans, lambda _, i: i % 2 == 1)  # every second part is a match
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.when(F.translate(text, MARK, STAND_IN).rlike(present), inside).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """For each base kind its counted matches."""
    out = {}
    for kind, (pattern, present, group, least) in BASE.items():
        def counted(pattern: str, group: int, least: int):
            return lambda m: F.length(F.regexp_extract(m["found"], pattern, group)) >= least
        out[kind] = F.filter(matches(text, pattern, present), counted(pattern, group, least))
    return out


def score(run: Column) -> Column:
    """(alphabet, score): the inferred alphabet's place and the battery's squared sum.

    Less than two key characters (only ``=``) give no score.
    """
    bare = F.translate(F.regexp_replace(run, "=+$", ""), "-_", "+/")
    *tried, rest = ALPHABETS.values()
    alphabet, place = F.lit(rest), F.lit(len(tried))
    for i, letters in reversed(list(enumerate(tried))):
        fits = F.translate(bare, letters, "") == ""
        alphabet, place = F.when(fits, F.lit(letters)).otherwise(alphabet), F.when(fits, F.lit(i)).otherwise(place)

    def battery(x: Column) -> Column:
        places, a = x["places"], F.length(x["alphabet"]).cast("double")
        n = F.size(places).cast("double")
        sorted_ = F.array_sort(places)
        # sum of squared counts = n + 2 * equal pairs; equal pairs from runs of the sorted places
        squares = F.aggregate(
            sorted_, F.struct(F.lit(-1).alias("last"), F.lit(0).cast("long").alias("same"),
                              F.lit(0).cast("long").alias("total")),
            lambda s, v: F.struct(
                v.alias("last"),
                F.when(v == s["last"], s["same"] + 1).otherwise(F.lit(0).cast("long")).alias("same"),
                (s["total"] + F.when(v == s["last"], 2 * (s["same"] + 1) + 1)
                 .otherwise(F.lit(1))).cast("long").alias("total")),
            lambda s: s["total"]).cast("double")
        chi = a / n * squares - n
        z1 = (chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
        pairs = F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1),
                           F.slice(places, F.lit(2), F.size(places) - 1),
                           lambda u, v: F.struct(u.alias("u"), v.alias("v")))
        changes = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (
            (p["u"] * 2 >= a) != (p["v"] * 2 >= a)).cast("double"))
        z2 = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        mean = (a - 1) / 2
        products = F.aggregate(pairs, F.lit(0.0),
                               lambda s, p: s + (p["u"] - mean) * (p["v"] - mean))
        z3 = products / (F.sqrt(n - 1) * (a * a - 1) / 12)
        return F.struct(x["place"].alias("alphabet"),
                        F.when(n >= 2, z1 * z1 + z2 * z2 + z3 * z3).alias("score"))

    state = F.array(F.struct(alphabet.alias("alphabet"), place.alias("place"), bare.alias("bare")))
    with_places = F.transform(state, lambda x: F.struct(
        x["alphabet"].alias("alphabet"), x["place"].alias("place"),
        F.filter(F.transform(F.split(x["bare"], ""), lambda c: F.instr(x["alphabet"], c) - 1),
                 lambda p: p >= 0).alias("places")))
    return F.element_at(F.transform(with_places, battery), 1)


def _bin(value: Column) -> Column:
    return F.coalesce(F.least(F.floor(value * BINS_PER_UNIT), F.lit(BINS)), F.lit(BINS)).cast("int")


def _length(n: Column) -> Column:
    """Place in LENGTHS of the longest window that is not longer."""
    out = F.lit(len(LENGTHS) - 1)
    for i, end in reversed(list(enumerate(LENGTHS[1:]))):
        out = F.when(n < end, F.lit(i)).otherwise(out)
    return out


def candidates(text: Column) -> Column:
    """array<struct<start, end, length, alphabet, bin>> of the runs."""
    scored = F.transform(matches(text, RUN, RUN), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), score(m["found"]).alias("s")))
    return F.transform(scored, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), _length(x["end"] - x["start"]).alias("length"),
        x["s"]["alphabet"].alias("alphabet"), _bin(x["s"]["score"]).alias("bin")))


def scores(places: np.ndarray, a: int) -> np.ndarray:
    """The battery of ``score`` for rows of equally many places in an alphabet of ``a``."""
    n = places.shape[1]
    rows = np.arange(len(places))[:, None] * a
    counts = np.bincount((rows + places).ravel(), minlength=len(places) * a).reshape(-1, a)
    chi = a / n * (counts.astype(float) ** 2).sum(1) - n
    z1 = (chi - (a - 1)) / np.sqrt(2 * (a - 1) * (n - 1) / n)
    high, off = places * 2 >= a, places - (a - 1) / 2
    z2 = ((high[:, 1:] != high[:, :-1]).sum(1) - (n - 1) / 2) / np.sqrt((n - 1) / 4)
    z3 = (off[:, 1:] * off[:, :-1]).sum(1) / (np.sqrt(n - 1) * (a * a - 1) / 12)
    return z1 * z1 + z2 * z2 + z3 * z3


def _codes(text: str) -> np.ndarray:
    """The base64 characters of a text, as byte values."""
    codes = np.frombuffer(text.encode("ascii", "ignore"), dtype=np.uint8)
    return codes[np.isin(codes, np.frombuffer(ALPHABETS["base64"].encode(), dtype=np.uint8))]


def streams(r: np.random.Generator) -> list[np.ndarray]:
    """Long texts that are not random, as byte values."""
    words = r.choice(np.array(PROSE.split(), dtype=object), NULL_WORDS)
    numbers = np.floor(10 ** r.uniform(0, 6, NULL_WORDS)).astype(int).astype(str)
    use, case, joint = r.random(NULL_WORDS), r.random(NULL_WORDS), r.integers(0, 6, NULL_WORDS // 50 + 1)
    counted = "".join(m if u < 0.2 else w for w, m, u in zip(words, numbers, use))
    names = "".join(
        (m if u < 0.1 else w if c < 0.5 else w.title() if c < 0.9 else w.upper())
        + ("", "", "", "+", "/", "/")[joint[i // 50]]             # one way of joining for 50 words
        for i, (w, m, u, c) in enumerate(zip(words, numbers, use, case)))
    plain = "".join(words)
    return [_codes(t) for t in (plain, plain.upper(), counted, counted.upper(), names, "".join(numbers))]


def not_random(texts: list[np.ndarray], n: int, r: np.random.Generator) -> np.ndarray:
    """About NULL_SIZE windows of ``n`` characters, as byte values."""
    each, out = NULL_SIZE // (len(texts) + 2), []
    for s in texts:
        out.append(s[r.integers(0, len(s) - n + 1, each)[:, None] + np.arange(n)])
    letters = [_codes(x) for x in ALPHABETS.values()]
    sizes = np.array([len(x) for x in letters])
    table = np.stack([np.resize(x, 64) for x in letters])
    which, at = r.integers(0, len(letters), (each, 1)), np.arange(n)
    units = r.integers(0, 64, (each, 4)) % sizes[which]           # units of 1 to 4 characters
    out.append(table[which, np.take_along_axis(units, at % r.integers(1, 5, (each, 1)), 1)])
    out.append(table[which, (r.integers(0, 64, (each, 1)) + at) % sizes[which]])
    return np.concatenate(out)


@cache
def p_values() -> np.ndarray:
    """p-values by (length, alphabet, bin), from windows that are not random."""
    r = np.random.default_rng(SEED)
    texts, out = streams(r), np.ones((len(LENGTHS), len(ALPHABETS), BINS + 1))
    for i, n in enumerate(LENGTHS):
        windows = not_random(texts, n, r)
        open_, counts = np.ones(len(windows), dtype=bool), np.zeros((len(ALPHABETS), BINS + 1))
        for k, letters in enumerate(ALPHABETS.values()):
            place = np.full(128, -1)
            place[_codes(letters)] = range(len(letters))
            places = place[windows]
            fits = open_ & (places >= 0).all(1)
            open_ &= ~fits
            bins = np.minimum(np.floor(scores(places[fits], len(letters)) * BINS_PER_UNIT), BINS)
            counts[k] = np.bincount(bins.astype(int), minlength=BINS + 1)
        t = (np.cumsum(counts, axis=1) + 1) / (len(windows) + 1)
        shares = t[:, -1]
        out[i, :, :BINS] = np.minimum(t[:, :BINS, None], shares).sum(-1)
    return np.minimum(out, 1.0)


def thresholds(judged: DataFrame, fdr: float) -> dict[tuple[int, int], int]:
    """Per length and alphabet the largest bin that still counts as random.

    At most (lengths x alphabets x bins) rows are looked at, whatever the corpus.
    """
    p, classes = p_values(), {}
    for r in (judged.select(F.explode("candidates").alias("c"))
              .groupBy("c.length", "c.alphabet", "c.bin").count().collect()):
        cls = sum(LENGTHS[r["length"]] >= end for end in LENGTH_CLASSES)
        classes.setdefault(cls, []).append((p[r["length"], r["alphabet"], r["bin"]], r["count"]))
    most = {}
    for cls, some in classes.items():
        total, k, most[cls] = sum(n for _, n in some), 0, 0.0
        for value, n in sorted(some):
            k += n
            if value <= fdr * k / total:
                most[cls] = value
    out = {}
    for i, n in enumerate(LENGTHS):
        limit = most.get(sum(n >= end for end in LENGTH_CLASSES), 0.0)
        for alphabet in range(len(ALPHABETS)):      # p grows with the bin
            fit = int(np.searchsorted(p[i, alphabet], limit, side="right")) - 1
            if fit >= 0:
                out[i, alphabet] = fit
    return out


def scan(docs: DataFrame, fdr: float = 0.05, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the arrays assign, access, hex, random of (start, end)."""
    rows = id_text(docs, id_col, text_col)
    found = base_spans(F.col("text"))
    bare = {k: F.transform(v, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias(k)
            for k, v in found.items()}
    judged = stage(rows.select("doc_id", *bare.values(), candidates(F.col("text")).alias("candidates")),
                   "secrets")
    limit = thresholds(judged, fdr)

    def passes(c: Column) -> Column:
        most = F.lit(-1)
        for (length, alphabet), b in limit.items():
            most = F.when((c["length"] == length) & (c["alphabet"] == alphabet), F.lit(b)).otherwise(most)
        return c["bin"] <= most

    random = F.transform(F.filter("candidates", passes), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end")))
    return judged.select("doc_id", *BASE, random.alias("random"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans as text."""
    def ranked(i: int, kind: str):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("rank"),
                                  m["end"].alias("end"), F.lit(kind).alias("kind"))

    def listed(kinds: list[str]) -> Column:
        spans = F.flatten(F.array(*[F.transform(k, ranked(i, k)) for i, k in enumerate(kinds)]))
        return F.array_join(F.transform(F.array_sort(spans), lambda m: F.concat_ws(
            ":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")

    kinds = list(BASE)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(listed(kinds), 256).alias("base_sha256"), listed([*kinds, "random"]).alias("spans"))
