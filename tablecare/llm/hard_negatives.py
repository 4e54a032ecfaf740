"""Hard negatives by cover trees over norm-augmented vectors; exact.

For each anchor and each of its nearest rows of the same label (positives), the
best rows of other labels whose score lies in a window below the positive's.
Scores are integer inner products of quantised vectors.

1. Rows are quantised, numbered and dealt into blocks of ``block_rows`` rows.
   Each block becomes one cover tree, built where its rows are and staged.
   A vector v gets one more component sqrt(M^2 - |v|^2), M the block's greatest
   norm: all then have norm M, and for an anchor a (with 0 appended)
   distance^2 = |a|^2 + M^2 - 2 * inner product, so nearest is most similar.
2. The tree: a node covers its rows within a measured radius. Its children are a
   greedy net at ``1 / base`` of that radius, so each level's radii shrink;
   descent ends at nodes of a few rows or of equal vectors.
3. A node at distance d with radius r holds inner products between
   (|a|^2 + M^2 - (d + r)^2) / 2 and (|a|^2 + M^2 - max(0, d - r)^2) / 2. A search
   keeps a frontier of nodes, takes those of best upper bound first, skips
   every node outside all the anchor's windows or below the worst of enough
   finds, and scores the rows of the leaves exactly.
4. Anchors, a fixed share of the rows, are dealt into parts of ``part_rows`` and
   each (block, part) is one task of bounded size; the finds of all blocks are
   ranked. This is done twice: for the positives, then for the windows that
   their scores set. Nothing is broadcast and no row leaves Spark.

Defined cases: rows with a NULL label or vector, or any NULL or non-finite
component, take no part. A shorter vector counts as 0 beyond its end, an empty
one as 0. ``vec_id`` NULL is no anchor, keeps its label, and comes last among
ties. Repeated rows are rows of their own (a repeated anchor appears with each
copy, and finds its copies); ties under one vec_id go by row number. A positive
score below 0 gives an empty window. An empty table, or one without anchors,
gives no rows. Other columns are not read. Scores are exact while sums of
products stay below 2^63 and are held at the ends of a long beyond.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecare.llm.common import quoted, stage

BLOCK_ROWS = 16_384
PART_ROWS = 4_096
BATCH = 64            # anchors searched together
LEAF = 8              # rows of a node that is not split further
BASE = 1.3            # ratio of radii between levels
STEP = 2_048          # nodes taken from the frontier at a time
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
FARTHEST = np.iinfo(np.int64)


def eligible(embeddings: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row, vec_id, label, vec) of the rows that take part, staged so that numbers stay."""
    vec = quoted(vec_col)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where(quoted(label_col).isNotNull() & vec.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), quoted(id_col).cast("long").alias("vec_id"),
        quoted(label_col).cast("long").alias("label"), vec.alias("vec"))
    return stage(rows, "negatives-rows")


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Quantised vectors as rows, zeros beyond a vector's end, at least ``width`` wide."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a with all rows of b."""
    width = max(a.shape[1], b.shape[1])
    if a.shape[1] < width:
        a = np.pad(a, ((0, 0), (0, width - a.shape[1])))
    if b.shape[1] < width:
        b = np.pad(b, ((0, 0), (0, width - b.shape[1])))
    if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    wide = a.astype(np.longdouble) @ b.astype(np.longdouble).T
    inside = np.clip(wide, -2.0 ** 62, 2.0 ** 62)
    near = inside.astype(np.int64)
    big = inside != wide
    near[big] = [max(FARTHEST.min, min(FARTHEST.max, int(x))) if np.isfinite(x) else
                 (FARTHEST.max if x > 0 else FARTHEST.min) for x in wide[big]]
    return near


class CoverTree:
    """A block's rows in tree order, and per node its centre, radius, rows and children."""

    ARRAYS = ("rows", "ids", "has_id", "labels", "vectors", "top", "centre", "radius", "begin", "end",
              "child", "children")

    def __init__(self, **arrays):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, rows, ids, has_id, labels, vectors, base: float = BASE) -> "CoverTree":
        order = np.lexsort((rows, ids, ~has_id))
        scale = np.abs(vectors).max(initial=0) or 1.0       # keeps squares finite
        unit = vectors / scale
        norm2 = np.einsum("ij,ij->i", unit, unit)
        top = float(norm2.max(initial=0))
        lifted = np.hstack([unit, np.sqrt(np.maximum(top - norm2, 0))[:, None]])
        centre, radius, begin, end, child, children = [int(order[0])], [0.0], [0], [len(rows)], [0], [0]
        node = 0
        while node < len(centre):
            lo, hi = begin[node], end[node]
            members = order[lo:hi]
            if hi - lo > 1:
                radius[node] = float(cls._away(lifted, centre[node], members, top).max())
            if hi - lo > LEAF and (vectors[members] != vectors[members[0]]).any():
                groups, centres = cls._net(lifted, members, centre[node], radius[node] / base, top)
                child[node], children[node] = len(centre), len(centres)
                members = members[np.argsort(groups, kind="stable")]
                order[lo:hi] = members
                sizes = np.bincount(groups, minlength=len(centres))
                stops = lo + np.cumsum(sizes)
                for c, size, stop in zip(centres, sizes.tolist(), stops.tolist()):
                    centre.append(int(c))
                    radius.append(0.0)
                    begin.append(stop - size)
                    end.append(stop)
                    child.append(0)
                    children.append(0)
            node += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(rows=rows[order], ids=ids[order], has_id=has_id[order], labels=labels[order],
                   vectors=vectors[order], top=np.array([top * scale * scale]),
                   centre=place[np.array(centre)], radius=np.array(radius) * scale,
                   begin=np.array(begin), end=np.array(end), child=np.array(child),
                   children=np.array(children))

    @staticmethod
    def _away(lifted, centre, members, top) -> np.ndarray:
        return np.sqrt(np.maximum(2 * top - 2 * (lifted[members] @ lifted[centre]), 0))

    @classmethod
    def _net(cls, lifted, members, first, radius, top) -> tuple[np.ndarray, list[int]]:
        """Greedy net: each member belongs to the first centre within ``radius`` of it, and the
        parent's centre is the first. Where rounding leaves a net of one, only equal vectors stay
        together."""
        groups = np.full(len(members), -1)
        open_, centres = np.arange(len(members)), []
        points = lifted[members]
        centre = first
        while len(open_):
            near = np.sqrt(np.maximum(2 * top - 2 * (points @ lifted[centre]), 0)) <= radius
            near |= members[open_] == centre
            groups[open_[near]] = len(centres)
            centres.append(int(centre))
            open_, points = open_[~near], points[~near]
            if len(open_):
                centre = members[open_[0]]
        if len(centres) == 1:
            _, groups = np.unique(points_key(lifted[members]), return_inverse=True)
            centres = [int(members[np.flatnonzero(groups == g)[0]]) for g in range(groups.max() + 1)]
        return groups, centres

    def pack(self) -> bytes:
        out = io.BytesIO()
        arrays = {k: getattr(self, k) for k in self.ARRAYS}
        small = self.vectors.astype(np.int32) if np.abs(self.vectors).max(initial=0) < 2 ** 31 else None
        if small is not None:
            arrays["vectors"] = small
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> "CoverTree":
        with np.load(io.BytesIO(data)) as arrays:
            tree = cls(**{k: arrays[k] for k in cls.ARRAYS})
        tree.vectors = tree.vectors.astype(np.float64)
        return tree

    def bounds(self, anchors: np.ndarray, norm2: np.ndarray, nodes: np.ndarray):
        """Least and greatest inner product of each anchor with any row of each node."""
        width = max(anchors.shape[1], self.vectors.shape[1])
        a = np.pad(anchors, ((0, 0), (0, width - anchors.shape[1])))
        c = self.vectors[self.centre[nodes]]
        c = np.pad(c, ((0, 0), (0, width - c.shape[1])))
        both = norm2[:, None] + self.top[0]
        radius = self.radius[nodes]
        with np.errstate(over="ignore", invalid="ignore"):
            away = np.sqrt(np.maximum(both - 2 * (a @ c.T), 0))
            slack = 1e-9 * both + 1               # rounding; an integer score is never cut by it
            least = (both - (away + radius) ** 2) / 2 - slack
            most = (both - np.maximum(away - radius, 0) ** 2) / 2 + slack
        # squares beyond a double bound nothing
        return np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)

    def search(self, anchors, rows, labels, low, high, k: int, same_label: bool):
        """Best ``k`` rows of each window [low, high] (one or more per anchor) whose label is, or
        is not, the anchor's; an anchor never finds itself. Lists of (score, place in the tree)."""
        q, windows = low.shape
        with np.errstate(over="ignore"):
            norm2 = np.einsum("ij,ij->i", anchors, anchors)
        best = [[(np.empty(0, np.int64), np.empty(0, np.int64))] * windows for _ in range(q)]
        floor = low.astype(np.float64)            # raised to the k-th score once k are found
        nodes = np.zeros(1, np.int64)
        least, most = self.bounds(anchors, norm2, nodes)
        while len(nodes):
            need = np.zeros(least.shape, bool)
            hope = np.full(least.shape, -np.inf)
            for w in range(windows):
                top = np.minimum(most, high[:, w:w + 1])
                wanted = (top >= floor[:, w:w + 1]) & (least <= high[:, w:w + 1])
                need |= wanted
                hope = np.where(wanted, np.maximum(hope, top), hope)
            alive = need.any(0)
            nodes, least, most, need = nodes[alive], least[:, alive], most[:, alive], need[:, alive]
            if not len(nodes):
                break
            take = np.argsort(-hope[:, alive].max(0), kind="stable")[:STEP]
            taken, needed = nodes[take], need[:, take]
            leaf = self.children[taken] == 0
            if leaf.any():
                self._score(anchors, rows, labels, taken[leaf], needed[:, leaf], low, high, floor,
                            best, k, same_label)
            inner = taken[~leaf]
            rest = np.ones(len(nodes), bool)
            rest[take] = False
            nodes, least, most = nodes[rest], least[:, rest], most[:, rest]
            if len(inner):
                below = _ranges(self.child[inner], self.child[inner] + self.children[inner])
                lb, ub = self.bounds(anchors, norm2, below)
                nodes = np.concatenate([nodes, below])
                least, most = np.hstack([least, lb]), np.hstack([most, ub])
        return best

    def _score(self, anchors, rows, labels, leaves, needed, low, high, floor, best, k, same_label):
        places = _ranges(self.begin[leaves], self.end[leaves])
        scores = products(anchors, self.vectors[places])
        fits = np.repeat(needed, self.end[leaves] - self.begin[leaves], axis=1)
        fits &= (self.labels[places] == labels[:, None]) == same_label
        fits &= self.rows[places] != rows[:, None]
        for a in range(len(anchors)):
            open_ = np.flatnonzero(fits[a])
            if not len(open_):
                continue
            s, p = scores[a, open_], places[open_]
            for w in range(low.shape[1]):
                inside = (s >= floor[a, w]) & (s >= low[a, w]) & (s <= high[a, w])
                if not inside.any():
                    continue
                old_s, old_p = best[a][w]
                new_s, new_p = np.concatenate([old_s, s[inside]]), np.concatenate([old_p, p[inside]])
                if len(new_s) > k:
                    least = np.partition(new_s, len(new_s) - k)[len(new_s) - k]
                    new_s, new_p = new_s[new_s >= least], new_p[new_s >= least]
                order = np.lexsort((self.rows[new_p], self.ids[new_p], ~self.has_id[new_p], -new_s))[:k]
                best[a][w] = new_s[order], new_p[order]
                if len(order) == k:
                    floor[a, w] = max(floor[a, w], new_s[order[-1]])


def points_key(points: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(points + 0.0).view(f"V{points.shape[1] * 8}").ravel()


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    sizes = end - begin
    return np.repeat(begin - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


def _window(score: int) -> tuple[int, int]:
    """Scores s with low% * score <= 100 * s <= high% * score."""
    return -((-LOW_PERCENT * score) // 100), (HIGH_PERCENT * score) // 100


def build_trees(rows: DataFrame, blocks: int) -> DataFrame:
    """(block, tree): every row is in one tree."""
    def build(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].combine_chunks()
        tree = CoverTree.build(
            table["row"].to_numpy(), ids.fill_null(0).to_numpy(zero_copy_only=False),
            ids.is_valid().to_numpy(zero_copy_only=False), table["label"].to_numpy(),
            matrix(table["vec"]))
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()),
                         "tree": pa.array([tree.pack()], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return stage(dealt.groupBy("block").applyInArrow(build, "block int, tree binary"),
                 "negatives-trees")


FOUND = "row long, window int, score long, found_id long, found_row long"


def search_blocks(trees: DataFrame, anchors: DataFrame, blocks: int, parts: int, k: int,
                  same_label: bool) -> DataFrame:
    """Best ``k`` of each block for each window of each anchor, all blocks for all anchors.

    ``anchors``: row, label, vec, scores (the positives' scores; empty: one open window).
    """
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            tree = CoverTree.unpack(right["tree"][0].as_py())
            for at in range(0, left.num_rows, BATCH):
                _search_batch(tree, left.slice(at, BATCH), k, same_label, out)
        return pa.table([pa.array(c, t) for c, t in zip(
            out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            names=["row", "window", "score", "found_id", "found_row"])

    dealt = (anchors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    spread = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return (dealt.groupBy("block", "part").cogroup(spread.groupBy("block", "part"))
            .applyInArrow(search, FOUND))


def _search_batch(tree: CoverTree, batch: pa.Table, k: int, same_label: bool, out: list[list]) -> None:
    rows, labels = batch["row"].to_numpy(), batch["label"].to_numpy()
    scores = batch["scores"].to_pylist()
    most = max(1, max(map(len, scores)))
    low = np.full((len(rows), most), 1, np.int64)            # low > high: a window that is not there
    high = np.zeros((len(rows), most), np.int64)
    for a, given in enumerate(scores):
        if same_label:
            low[a, 0], high[a, 0] = FARTHEST.min, FARTHEST.max
        for w, score in enumerate(given):
            low[a, w], high[a, w] = _window(score)
    best = tree.search(matrix(batch["vec"]), rows, labels, low, high, k, same_label)
    for a, row in enumerate(rows.tolist()):
        for w in range(most):
            s, p = best[a][w]
            out[0] += [row] * len(s)
            out[1] += [w] * len(s)
            out[2] += s.tolist()
            out[3] += [i if ok else None for i, ok in zip(tree.ids[p].tolist(), tree.has_id[p].tolist())]
            out[4] += tree.rows[p].tolist()


def _ranked(found: DataFrame, k: int) -> DataFrame:
    first = Window.partitionBy("row", "window").orderBy(
        F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found_row")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _parts(n: int, size: int) -> int:
    return max(1, -(-n // size))


def mine(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", relabel: Column | None = None, is_anchor: Column | None = None,
         block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``relabel`` and ``is_anchor`` are expressions over vec_id and label (long); by default labels
    stay and every row is an anchor.
    """
    rows = eligible(embeddings, id_col, vec_col, label_col)
    if relabel is not None:
        rows = rows.withColumn("label", relabel)
    picked = rows if is_anchor is None else rows.where(is_anchor)
    blocks, parts = _parts(rows.count(), block_rows), _parts(picked.count(), part_rows)
    trees = build_trees(rows, blocks)
    open_windows = picked.withColumn("scores", F.array().cast("array<long>"))
    near = _ranked(search_blocks(trees, open_windows, blocks, parts, POSITIVES, True), POSITIVES)
    positives = near.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("rank", "found_id", "score"))).alias("positives"))         # five at most
    anchors = stage(picked.join(positives, "row").withColumn("scores", F.col("positives.score")),
                    "negatives-anchors")
    found = _ranked(search_blocks(trees, anchors.drop("positives"), blocks, parts, NEGATIVES, False),
                    NEGATIVES)
    names = anchors.select("row", F.col("vec_id").alias("anchor_id"),
                           F.posexplode("positives").alias("window", "positive"))
    return found.join(names, ["row", "window"]).select(
        "anchor_id", F.col("positive.found_id").alias("positive_id"), "rank",
        F.col("found_id").alias("negative_id"), F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"))


def shifted_label(divisor: int = 7, labels: int = 10) -> Column:
    """Label moved by one where vec_id is divisible by ``divisor`` (the registered query's rows)."""
    moved = (F.col("label") + F.lit(1).cast("long")) % F.lit(labels)
    return F.when(F.col("vec_id") % divisor == 0, moved).otherwise(F.col("label"))


ORACLE = f"""
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
               list_inner_product(a.v, b.v)::BIGINT AS score
        FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (
        SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
        FROM s WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
    n AS (
        SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                  ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> p.anchor_label
          AND {LOW_PERCENT} * positive_score <= 100 * s.score
          AND 100 * s.score <= {HIGH_PERCENT} * positive_score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= {NEGATIVES}"""
