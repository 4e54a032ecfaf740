"""N-gram Jaccard join with token-combination prefixes; exact links, as components.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
Sets x, y link when ``100 * |x & y| >= threshold * |x | y|``. Writing n = |x| and
o(n) = ceil(threshold * n / 100), a linked pair shares at least o(n) tokens.

1. Documents with equal sets become one node (the smallest doc_id).
2. Extended prefixes. Tokens are ordered by hash. The first n - o(n) + s(n)
   tokens of two linked sets share at least min(s(n), s(m)) tokens; s grows with
   the size. One shuffle of packed tokens finds for each token in how many
   prefixes it occurs: once (dropped), up to ``rare`` times, or more (frequent).
   A token that is already frequent within one task is sent as a single mark,
   so a hot token does not gather in one place.
3. A node with fewer shared tokens than the least bound of any partner links
   with nothing. The others order their shared tokens rarest first: with
   ``shared`` tokens and a bound of b, every partner meets the first
   shared - b + 1. Where these are all rare, they serve as single signatures.
4. Nodes whose frequent tokens alone reach the bound (dense ones: large groups of
   copies, boilerplate) go through the same classes once more with their whole
   sets, counted among themselves. Again rare tokens serve singly; nodes whose
   frequent tokens still reach o(n) index combinations of two frequent tokens.
   Frequent tokens fall into g classes by hash and the prefix grows by g tokens, so
   linked sets share two tokens of one class; g grows with the set size (per size
   band, each node in its own band and the next), which keeps combinations
   linear in the set's size. Signatures with the same members count once.
5. Candidates: a signature's members are compared with one leader, in a few
   rounds with changing leaders; after each round links merge components, and
   only members of different components are compared again. Whatever signature
   still holds several components after that has all its remaining pairs of
   different components compared, so no link between components is lost: short
   lists by a join, long ones as blocks of nodes whose tiles are compared with each
   other, overlapping ones as one block where that is less work.
6. Every candidate is verified by its true intersection.

Hashes have 64 bits; two different shingles of one pair agree with a chance of
about n^2 / 2^64.

Defined cases: NULL and empty texts have the empty set and link with nothing;
a NULL doc_id counts as the smallest id (its component_id is NULL); rows of one
doc_id are one document, linked by any of their texts; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import (flag_hot, hot_size, id_text, join_hot_apart, min_partitions,
                                  quoted, stage, worker_cache)
from tablecare.llm.components import components

SMALLEST = -(1 << 63)                 # stands for a NULL id
BUCKET_TOKENS = 1_000_000             # tokens of one reduce group, on average
PACK_TOKENS = 2_000_000               # tokens packed at once by a task
STAR_ROUNDS = 3
LARGE_LIST = 64                       # longer lists may form blocks
TILE = 192                            # nodes of one tile
MANY = 1 << 40                        # order of a token that one task already found frequent


# -- shingles ----------------------------------------------------------------
def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    byte = r.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    byte[65:91] = byte[97:123]                       # A-Z as a-z
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return byte, space


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    byte, space = worker_cache("shingle tables", _tables)
    lens = np.array([len(t) for t in texts])
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~space[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    text_of = np.searchsorted(np.cumsum(lens + 1), starts, "right")
    size = ends - starts
    letters = data[inside]
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    power = np.full(int(size.max()) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    words = _mix(np.add.reduceat(byte[letters] * power[place], first) + size.astype(np.uint64))
    factor = _mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    n = max(0, len(words) - width + 1)
    full = np.zeros(n, np.uint64)
    for j in range(width):
        full += words[j:j + n] * factor[j]
    full = _mix(full)
    out = []
    for i in range(len(texts)):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= width:
            out.append(np.unique(full[a:b - width + 1]))
        elif b > a:
            out.append(_mix(np.array([(words[a:b] * factor[:b - a]).sum() + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# -- bounds, once for numpy and once for columns -----------------------------
class Bounds:
    def __init__(self, threshold: int):
        self.t = threshold

    def least(self, n):
        """o(n): shared tokens of any linked pair."""
        return (self.t * n + 99) // 100

    def extra(self, n):
        """s(n): shared tokens within the prefixes, 8 or a tenth of the set."""
        return np.minimum(self.least(n), np.maximum(8, n // 10))

    def prefix(self, n):
        return n - self.least(n) + self.extra(n)

    def smallest_partner(self, n):
        return self.least(n)

    # the same for columns
    def least_col(self, n: str) -> str:
        return f"(({self.t} * ({n}) + 99) div 100)"

    def extra_col(self, n: str) -> str:
        return f"least({self.least_col(n)}, greatest(8, ({n}) div 10))"

    def sizes_fit(self, a: str, b: str) -> Column:
        return F.expr(f"100 * least({a}, {b}) >= {self.t} * greatest({a}, {b})")


def _sets_pass(docs: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, n, digest, prefix) of each document; prefix: its first tokens, 8 bytes each."""
    bounds = Bounds(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = shingle_sets([t.as_buffer().to_pybytes() for t in part.column(1)])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                             pa.binary()),
                    pa.array([s[:int(bounds.prefix(len(s)))].tobytes() for s in sets], pa.binary())],
                    names=["doc_id", "n", "digest", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, prefix binary")


# -- token classes -----------------------------------------------------------
def _classes(tokens: DataFrame, buckets: int, rare: int) -> DataFrame:
    """(sig, node, n, count, frequent) for the tokens that at least two of the rows hold.

    ``count`` orders tokens the same way everywhere: in how many rows a token is, or
    MANY where one task alone saw it more than ``rare`` times.

    ``tokens`` has one row per node: node, n, tokens (8 bytes each).
    """
    schema = "key long, tokens binary, nodes binary, sizes binary"

    def flush(node, n, toks):
        t = np.concatenate(toks)
        own = np.repeat(np.array(node, np.int64), [len(x) for x in toks])
        size = np.repeat(np.array(n, np.int32), [len(x) for x in toks])
        order = np.argsort(t, kind="stable")
        t, own, size = t[order], own[order], size[order]
        run = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        count = np.diff(np.append(run, len(t)))
        hot = np.repeat(count > rare, count)
        keys = (_mix(t) % np.uint64(buckets)).astype(np.int64)
        # frequent already here: the rows go anywhere, their token leaves one mark (size 0)
        marks = t[run[count > rare]]
        spread = np.full(len(t), -1 - int(own[0] % buckets))
        keys = np.where(hot, spread, keys)
        t = np.concatenate([t, marks])
        own, size = np.append(own, np.zeros(len(marks), np.int64)), np.append(size, np.zeros(len(marks), np.int32))
        keys = np.append(keys, (_mix(marks) % np.uint64(buckets)).astype(np.int64))
        order = np.lexsort((own, keys))
        t, own, size, keys = t[order], own[order], size[order], keys[order]
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(cuts[1:], len(keys))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[cuts])] + [pa.array([x[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
                                      for x in (t, own, size)],
            names=["key", "tokens", "nodes", "sizes"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, n, toks, held = [], [], [], 0
        for b in batches:
            for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = np.frombuffer(t.as_buffer(), np.uint64)
                if len(t):
                    node.append(i), n.append(k), toks.append(t)
                    held += len(t)
                if held >= PACK_TOKENS:
                    yield flush(node, n, toks)
                    node, n, toks, held = [], [], [], 0
        if held:
            yield flush(node, n, toks)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t, own, size = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])
                        for name, kind in (("tokens", np.uint64), ("nodes", np.int64), ("sizes", np.int32)))
        if key[0].as_py() < 0:
            frequent, c = np.ones(len(t), bool), np.full(len(t), MANY)
        else:
            order = np.argsort(t, kind="stable")
            t, own, size = t[order], own[order], size[order]
            run = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            c = np.diff(np.append(run, len(t)))
            marked = np.add.reduceat((size == 0).astype(np.int64), run) > 0
            frequent = np.repeat((c > rare) | marked, c)
            keep = np.repeat((c > 1), c) & (size > 0)
            c = np.repeat(np.where(marked, MANY, c), c)
            t, own, size, frequent, c = t[keep], own[keep], size[keep], frequent[keep], c[keep]
        return pa.table({"sig": t.view(np.int64), "node": own, "n": size.astype(np.int64),
                         "count": c.astype(np.int64), "frequent": frequent})

    return (tokens.select("node", "n", "tokens").mapInArrow(pack, schema).groupBy("key")
            .applyInArrow(count, "sig long, node long, n long, count long, frequent boolean"))


def _prefixes(tokens: DataFrame, bound: str) -> DataFrame:
    """Per node its shared tokens, rarest first, and whether they can reach the bound.

    (node, n, tokens, shared, common, bound): a node with ``shared`` tokens that others hold and
    needing ``bound`` of them meets every partner within its first shared - bound + 1
    tokens. The list is at most the node's own set.
    """
    return (tokens.groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("count", "sig", "frequent"))).alias("tokens"))
        .select("node", "n", "tokens", F.size("tokens").alias("shared"),
                F.size(F.filter("tokens", lambda t: t["frequent"])).alias("common"),
                F.expr(bound).cast("int").alias("bound"))
        .filter("shared >= bound"))


def _singles(prefixes: DataFrame) -> DataFrame:
    """(sig, node, n): the rare tokens among the first shared - bound + 1."""
    first = F.expr("slice(tokens, 1, shared - bound + 1)")
    return (prefixes.select("node", "n", F.explode(first).alias("t")).filter("NOT t.frequent")
            .select("t.sig", "node", "n"))


def _combinations(prefixes: DataFrame, bounds: Bounds) -> DataFrame:
    """(sig, node, n): pairs of frequent tokens of one class, for nodes with common >= bound.

    With g classes the prefix grows by g tokens, so that linked sets share g + 1
    tokens of it: a rare one, or two frequent ones of one class.
    """
    ratio = 100 / bounds.t

    def band(n: int) -> int:
        return int(np.floor(np.log(n) / np.log(ratio) + 1e-9)) if n > 1 and ratio > 1 else 0

    def classes(z: int) -> int:
        """Classes of band z: below the least bound of any set of this band or the one below."""
        floor = max(1, int(np.ceil(ratio ** (z - 1) - 1e-6)))
        least = int(bounds.least(floor))
        return min(least - 1, max(1, least // 6))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, n, slack, toks in zip(*[b.column(i).to_pylist() for i in range(3)], b.column(3)):
                ordered = toks.values.to_numpy(zero_copy_only=False).view(np.uint64)
                sigs = []
                for z in (band(n), band(n) + 1):
                    g = classes(z)
                    seed = _mix(np.array([z + 1], np.uint64))[0]
                    if g < 1:                        # no combination is guaranteed: single tokens
                        sigs.append(_mix(ordered ^ seed))
                        continue
                    t = np.sort(ordered[:slack + g])
                    cls = _mix(t + np.uint64(77)) % np.uint64(g)
                    order = np.argsort(cls, kind="stable")
                    u, cls = t[order], cls[order]
                    for step in range(1, len(u)):    # tokens of one class, ``step`` places apart
                        same = cls[step:] == cls[:-step]
                        if not same.any():
                            break
                        sigs.append(_mix(_mix(u[:-step][same]) * np.uint64(3) + u[step:][same] ^ seed))
                sigs = np.unique(np.concatenate(sigs)) if sigs else np.zeros(0, np.uint64)
                if len(sigs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sigs.view(np.int64)), pa.array(np.full(len(sigs), node, np.int64)),
                         pa.array(np.full(len(sigs), n, np.int64))], names=["sig", "node", "n"])

    frequent = F.transform(F.filter("tokens", lambda t: t["frequent"]), lambda t: t["sig"])
    return (prefixes.filter("common >= bound")
            .select("node", "n", F.expr("shared - bound + 1 - (shared - common)").alias("slack"),
                    frequent.alias("tokens"))
            .mapInArrow(run, "sig long, node long, n long"))


# -- verification ------------------------------------------------------------
def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of the pairs (a, b), those that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
                pa.array(good, pa.bool_()))

    one = sets.select(F.col("node").alias("b"), F.col("tokens").alias("set_b"))
    two = sets.select(F.col("node").alias("a"), F.col("tokens").alias("set_a"))
    return (pairs.join(one, "b").join(two, "a").select("a", "b", "set_a", "set_b")
            .mapInArrow(run, "a long, b long"))


def _distinct_lists(signatures: DataFrame) -> DataFrame:
    """Of signatures with the same members one stays; those with one member go.

    Shingles of one shared passage have the same members. Members are compared
    by their number and two 64-bit sums of hashes, without collecting them. The result has
    a flag ``hot``: whether the signature is so frequent that its rows should not meet in one task.
    """
    lists = stage(signatures.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).filter("size > 1"), "list-sizes")
    total = lists.agg(F.sum("size")).first()[0]
    lists = lists.withColumn("hot", F.col("size") > hot_size(total))
    chosen = lists.groupBy("size", "x", "y", "hot").agg(F.min("sig").alias("sig"))
    rows = flag_hot(signatures, lists.filter("hot"), ["sig"])
    return stage(join_hot_apart(rows, chosen.select("sig", "hot"), ["sig"]), "lists")


def _blocks(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the open signatures: (block, node, comp) for tiles, and the short lists to join.

    A long list is a block of its nodes. Long lists that overlap can form one block instead:
    comparing its nodes with each other costs its size squared, list by list the sum of their
    sizes squared. The cheaper way is taken, both compare the same pairs.
    """
    sized = stage(join_hot_apart(left, left.groupBy("sig", "hot").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("first")), ["sig"]), "open")
    large, short = sized.filter(F.col("size") > LARGE_LIST), sized.filter(F.col("size") <= LARGE_LIST)
    if not large.limit(1).count():
        return large.select(F.col("node").alias("block"), "node", "comp"), short
    edges = large.filter("node <> first").select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    of = components(edges).withColumnRenamed("comp", "block")
    placed = large.join(of, "node")
    nodes = placed.select("block", "node", "comp").distinct()
    cost = (placed.groupBy("block").agg(F.sum("size").alias("by_list"))
            .join(nodes.groupBy("block").agg(F.count(F.lit(1)).alias("k")), "block")
            .filter("double(k) * k <= by_list"))
    dense = stage(cost.select("block"), "blocks")
    # should a signature's hash name two blocks, they are compared as one
    lists = placed.join(dense, "block", "left_anti").select(
        F.xxhash64("sig").alias("block"), "node", "comp")
    return stage(nodes.join(dense, "block", "left_semi").unionByName(lists), "block-nodes"), short


def _block_links(blocks: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between different components of a block, tile by tile.

    A block's nodes are dealt into tiles of about ``TILE`` nodes; every pair of tiles
    is one group of at most two tiles, compared by counting shared tokens.
    """
    counts = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("k")).select(
        "block", F.ceil(F.col("k") / TILE).alias("tiles"),
        (F.col("k") > hot_size(blocks.count())).alias("hot"))
    dealt = (join_hot_apart(flag_hot(blocks, counts.filter("hot"), ["block"]), counts, ["block"])
             .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .select("block", F.least("tile", "other").alias("low"),
                     F.greatest("tile", "other").alias("high"), "tile", "node", "comp"))
    filled = dealt.join(sets.select("node", "tokens"), "node")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        tile, node, comp = (table.column(c).to_numpy() for c in ("tile", "node", "comp"))
        toks = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("tokens")]
        size = np.array([len(t) for t in toks], np.int64)
        rows = np.repeat(np.arange(len(toks)), size)
        _, code = np.unique(np.concatenate(toks), return_inverse=True)
        order = np.argsort(code, kind="stable")
        rows, code = rows[order], code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        width = np.diff(np.append(first, len(code)))
        shared = np.zeros((len(toks), len(toks)), np.int32)
        for at, w in zip(first[width > 1], width[width > 1]):      # holders of one token
            held = rows[at:at + w]
            shared[np.ix_(held, held)] += 1
        union = size[:, None] + size[None, :] - shared
        good = (100 * shared >= threshold * union) & (comp[:, None] != comp[None, :])
        good &= (tile[:, None] == low) & (tile[None, :] == high)
        i, j = np.nonzero(good)
        return pa.table({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])})

    return filled.select("block", "low", "high", "tile", "node", "comp", "tokens").groupBy(
        "block", "low", "high").applyInArrow(compare, "a long, b long")


def _link(signatures: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """(node, comp) of all nodes that link with another one."""
    labels = stage(signatures.select("node").distinct().withColumn("comp", F.col("node")), "nodes")
    tried = None
    for turn in range(STAR_ROUNDS + 1):
        now = signatures.join(labels, "node")
        spans = (now.groupBy("sig", "hot").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.min_by(F.struct("node", "n", "comp"),
                     F.struct(F.xxhash64(F.col("node"), F.lit(turn)), "node")).alias("lead"))
            .filter("low <> high"))
        if turn < STAR_ROUNDS:
            found = join_hot_apart(now, spans, ["sig"]).select(
                F.col("lead.node").alias("x"), F.col("lead.n").alias("x_n"),
                F.col("lead.comp").alias("x_comp"), F.col("node").alias("y"),
                F.col("n").alias("y_n"), F.col("comp").alias("y_comp"))
        else:                                        # all that is left
            left = join_hot_apart(now, spans.select("sig", "hot"), ["sig"])
            blocks, left = _blocks(left)
            found = (left.select("sig", *[F.col(c).alias(f"x{s}") for c, s in
                                          (("node", ""), ("n", "_n"), ("comp", "_comp"))])
                     .join(left.select("sig", *[F.col(c).alias(f"y{s}") for c, s in
                                                (("node", ""), ("n", "_n"), ("comp", "_comp"))]), "sig")
                     .filter("x < y"))
        pairs = (found.filter("x_comp <> y_comp").filter(bounds.sizes_fit("x_n", "y_n"))
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        links = _verified(pairs, sets, bounds.t)
        if turn == STAR_ROUNDS:
            links = links.unionByName(_block_links(blocks, sets, bounds.t)).distinct()
        links = stage(links, "links")
        if links.limit(1).count():
            # between components of the last round
            ends = [labels.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp")) for c in "ab"]
            edges = links.join(ends[0], "a").join(ends[1], "b").select(
                F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
            merged = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
            labels = stage(labels.join(merged, "comp", "left").select(
                "node", F.coalesce("to", "comp").alias("comp")), "nodes")
    return labels


def link_components(docs: DataFrame, threshold: int = 80, rare: int = 32, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    bounds = Bounds(threshold)
    rows = id_text(docs, id_col, text_col).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(SMALLEST)))
    told = _sets_pass(rows, threshold)
    members = stage(told.select("doc_id", "n", "digest"), "members")
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = max(min_partitions(rows), -(-total // (3 * BUCKET_TOKENS)))
    # one node per distinct set; staged, since the marks of frequent tokens hang on the order of
    # rows, which a task that is run again must meet unchanged
    nodes = stage(told.filter("n > 0").groupBy("digest")
                  .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                       F.first("prefix").alias("tokens")), "nodes")
    alive = stage(_prefixes(_classes(nodes, buckets, rare),
                            bounds.extra_col(bounds.least_col("n"))), "prefixes")
    single = _singles(alive)

    # whole sets of the nodes that may link
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = shingle_sets([t.as_buffer().to_pybytes() for t in part.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), part.column(2),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "n", "dense", "tokens"])

    ids = alive.groupBy("node").agg(F.max(F.expr("common >= bound")).alias("dense"))
    sets = stage(rows.join(ids, rows["doc_id"] == ids["node"]).select("node", "text", "dense")
                 .mapInArrow(whole, "node long, n long, dense boolean, tokens binary"), "sets")

    # dense nodes: classes among themselves, over whole sets
    again = stage(_prefixes(_classes(sets.filter("dense"), buckets, rare), bounds.least_col("n")),
                  "dense")
    signatures = stage(single.unionByName(_singles(again)).unionByName(
        _combinations(again, bounds)).distinct(), "signatures")
    labels = _link(_distinct_lists(signatures), sets, bounds)

    classes = stage(members.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")), "digests")
    most = hot_size(classes.agg(F.sum("copies")).first()[0])
    classes = (classes.withColumn("hot", F.col("copies") > most).join(labels, "node", "left")
               .select("digest", "hot", F.coalesce("comp", "node").alias("comp")))
    copies = flag_hot(members, classes.filter("hot"), ["digest"])
    real = lambda c: F.when(F.col(c) != SMALLEST, F.col(c))
    joined = join_hot_apart(copies, classes, ["digest"]).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("comp")).alias("component_id"))
    return joined.select(real("doc_id").alias("doc_id"), "n_shingles",
                         real("component_id").alias("component_id"))


def keep_one_per_component(docs: DataFrame, threshold: int = 80, text_col: str = "text") -> DataFrame:
    """One input row of each component, with the input's columns: the first by (doc_id, NULL
    before all others, then hash of the text). Rows are linked by a number of their own, so
    NULL and repeated ids are rows like others; documents without words all stay.
    """
    rows = stage(docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
        F.monotonically_increasing_id().alias("at"),
        F.struct(quoted("doc_id").cast("long").alias("doc_id"),
                 F.xxhash64(quoted(text_col)).alias("hash")).alias("order")), "numbered")
    found = link_components(rows.select("at", F.col("row")[text_col].alias("text")), threshold,
                            id_col="at")
    stay = (rows.select("at", "order").join(found.withColumnRenamed("doc_id", "at"), "at")
            .groupBy("component_id").agg(F.min(F.struct("order", "at"))["at"].alias("at")))
    return rows.join(stay, "at", "left_semi").select("row.*")


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower_ascii, '[^\\x20\\x09-\\x0D]+') AS ws
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5
        THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y
      ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN z zx ON zx.doc_id = a JOIN z zy ON zy.doc_id = b
      WHERE 100 * k >= 80 * (zx.n + zy.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM z UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d WHERE r.c < e.b)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(min(r.c), w.doc_id) AS component_id
FROM w LEFT JOIN z USING (doc_id) LEFT JOIN r ON r.d = w.doc_id GROUP BY w.doc_id, z.n"""
