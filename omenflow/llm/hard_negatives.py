"""Hard negatives by dual-tree search: anchors against candidates, exact, with integer scores.

Rows are dealt to cells by a routing tree of at most ``CELLS`` leaves, fitted on a bounded sample; every row gets a cell.
Large cells are dealt over blocks.  What is known of a cell (centre, radius, range of lengths and labels) bounds the inner
products of its anchors with another cell's candidates from both sides: pairs of cells whose interval can't hold a wanted score
go at once.  In a task a block's candidates and its anchors get trees of their own, and pairs of nodes are pruned by the same
intervals, whole groups of anchors at a time, against their windows and the worst of their best ``k`` so far; only pairs of leaves
are scored, by exact matrix products.

First each anchor searches its own block, so that it brings a good lower bound to the other cells.  Then it searches for
positives, then for negatives in the window of each positive's score.

Cases: rows with a null label, a null vector, or null or non-finite components take no part; an anchor is a row, so that rows with equal ids
are each an anchor with the other one among its other rows; ties go by id, null ids last, then by order of input; a row
with a null id is a candidate but no anchor; shorter vectors count as filled with zeros; an anchor without other rows of its label,
or a positive without negatives in its window (all of those with a score below 0), has no rows; an empty table gives none.
Scores are exact up to what a long holds.  Columns other than the three named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table
from .vectors import extent, fitted, matrix, quantised, usable

#: Leaves of the routing tree at most, and rows it is fitted on (expected).
CELLS, SAMPLE = 1024, 1 << 14
#: Rows of a block, at least and at most; between them a 512th of all rows.
BLOCK_ROWS = (1024, 1 << 18)
#: Rows of a leaf of anchors and of candidates.
LEAVES = (16, 256)
#: Anchors that are searched at once.
ANCHORS = 4096
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NO_ID = MOST


class Tree:
    """A tree over vectors: rows in ``order``, and for each node its rows, children, centre, radius, lengths and labels.

    Nodes with several labels are split by label first, then by which of two far rows is nearer (in halves where that
    would leave less than a sixteenth on one side); equal rows are split by id.
    """

    def __init__(self, x: np.ndarray, labels: np.ndarray, ids: np.ndarray, leaf: int):
        self.order = np.lexsort((ids, labels))
        x, norms = x[self.order], np.sqrt(np.einsum("ij,ij->i", x, x))[self.order]
        labels, ids = labels[self.order], ids[self.order]
        self.begin, self.end, self.left, self.right = [], [], [], []
        self.centre, self.radius, self.low, self.high = [], [], [], []
        self.label, self.first = [], []

        def permute(a, b, by):
            nonlocal x
            for v in (self.order, x, norms, labels, ids):
                v[a:b] = v[a:b][by]

        def new(a, b):
            self.begin.append(a)
            self.end.append(b)
            self.left.append(-1)
            self.right.append(-1)
            self.first.append(int(ids[a:b].min()))
            self.label.append((int(labels[a:b].min()), int(labels[a:b].max())))
            self.low.append(norms[a:b].min())
            self.high.append(norms[a:b].max())
            c = x[a].copy() if (x[a:b] == x[a]).all() else x[a:b].mean(axis=0)
            away = x[a:b] - c
            away = np.sqrt(np.einsum("ij,ij->i", away, away))
            self.centre.append(c)
            self.radius.append(away.max())
            return len(self.begin) - 1, away

        todo = [(*new(0, len(x)), leaf)] if len(x) else []
        while todo:
            k, away, size = todo.pop()
            a, b = self.begin[k], self.end[k]
            if b - a <= size:
                continue
            low, high = self.label[k]
            if low < high:
                permute(a, b, np.argsort(labels[a:b], kind="stable"))
                edge = labels[(a + b) // 2]
                cut = a + int(np.searchsorted(labels[a:b], edge))
                cut = cut if cut > a else a + int(np.searchsorted(labels[a:b], edge, side="right"))
            elif self.radius[k] > 0:
                far = x[a + int(away.argmax())]
                other = x[a + int(np.einsum("ij,ij->i", x[a:b] - far, x[a:b] - far).argmax())]
                along = (x[a:b] - (far + other) / 2) @ (far - other)
                permute(a, b, np.argsort(along, kind="stable"))
                cut = a + int((along < 0).sum())
                if min(cut - a, b - cut) * 16 < b - a:
                    cut = (a + b) // 2
            else:
                permute(a, b, np.argsort(ids[a:b], kind="stable"))
                cut = (a + b) // 2
            for side, (p, q) in (("left", (a, cut)), ("right", (cut, b))):
                child = new(p, q)
                getattr(self, side)[k] = child[0]
                todo.append((*child, size))
        self.x, self.ids, self.labels = x, ids, labels


def interval(centre_a, radius_a, low_a, high_a, centre_b, radius_b, low_b, high_b):
    """Bounds of the inner products of two balls' rows; arrays broadcast.  Rounding is allowed for, whole numbers stay whole."""
    mid = np.einsum("...i,...i->...", centre_a, centre_b)
    slack = radius_a * np.linalg.norm(centre_b, axis=-1) + radius_b * np.linalg.norm(centre_a, axis=-1) + radius_a * radius_b
    most = high_a * high_b
    fuzz = 1e-10 * (most + np.abs(mid) + slack) + 1e-6
    return np.maximum(mid - slack, -most) - fuzz, np.minimum(mid + slack, most) + fuzz


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of rows of whole numbers, in the narrowest type that holds ``bound`` of any partial sum."""
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, LEAST + 1, MOST - 1).astype(np.int64)


class Best:
    """The best ``k`` candidates so far of each anchor and window: falling scores, then rising ids and rows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.k, self.low, self.high = k, low, high
        shape = (*low.shape, k)
        self.score, self.id, self.row = np.full(shape, LEAST), np.full(shape, NO_ID), np.full(shape, MOST)
        self.floor, self.last = low.copy(), np.full(low.shape, NO_ID)

    def add(self, at: slice, w: int, scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        hit = np.flatnonzero(ok.any(axis=1))
        if not len(hit):
            return
        got = np.where(ok[hit], scores[hit], LEAST)
        if got.shape[1] > self.k:
            # Candidates are in the order of (id, row), so that of equal scores the first are the best.
            kth = np.partition(got, got.shape[1] - self.k, axis=1)[:, [-self.k]]
            above, tied = got > kth, got == kth
            keep = above | (tied & (np.cumsum(tied, axis=1) <= self.k - above.sum(axis=1, keepdims=True)))
            col = np.nonzero(keep)[1].reshape(len(hit), self.k)
        else:
            col = np.broadcast_to(np.arange(got.shape[1]), got.shape)
        one = np.arange(at.start, at.stop)[hit]
        taken = np.take_along_axis(got, col, axis=1)
        s = np.concatenate([self.score[one, w], taken], axis=1)
        i = np.concatenate([self.id[one, w], np.where(taken > LEAST, ids[col], NO_ID)], axis=1)
        r = np.concatenate([self.row[one, w], np.where(taken > LEAST, rows[col], MOST)], axis=1)
        best = np.lexsort((r, i, -np.maximum(s, LEAST + 1), s == LEAST), axis=-1)[:, : self.k]
        self.score[one, w], self.id[one, w], self.row[one, w] = (np.take_along_axis(v, best, axis=1) for v in (s, i, r))
        full = self.score[one, w, -1] > LEAST
        self.floor[one, w] = np.where(full, self.score[one, w, -1], self.low[one, w])
        self.last[one, w] = np.where(full, self.id[one, w, -1], NO_ID)


def search(anchors: Tree, low: np.ndarray, high: np.ndarray, own: np.ndarray, candidates: Tree, rows: np.ndarray, same: bool, k: int) -> Best:
    """The best ``k`` candidates in each anchor's windows (``low``, ``high``: anchors x windows), of the same label or of others.

    ``own``: an anchor's own row, which isn't its candidate.  Arrays are in the order of the anchors' tree.
    """
    best = Best(low, high, k)
    if not len(anchors.begin) or not len(candidates.begin):
        return best
    a, c = anchors, candidates
    stack_c = {n: np.array(getattr(c, n)) for n in ("centre", "radius", "low", "high")}
    stack_a = {n: np.array(getattr(a, n)) for n in ("centre", "radius", "low", "high")}

    def bounds(i, js):
        return interval(*(stack_a[n][i] for n in stack_a), *(stack_c[n][js] for n in stack_c))

    def wanted(i, js):
        """Which candidate nodes an anchors' node needs, and their upper bounds."""
        lows, highs = bounds(i, js)
        at = slice(a.begin[i], a.end[i])
        floor, last, top = best.floor[at], best.last[at], best.high[at]
        live = floor <= top
        if not live.any():
            return np.zeros(len(js), bool), highs
        least, most = int(floor[live].min()), int(top[live].max())
        whole = np.floor(highs)
        first = np.array([c.first[j] for j in js])
        fits = (whole > least) | ((whole == least) & (first <= int(last[live].max())))
        labels = np.array([c.label[j] for j in js])
        (la, ha) = a.label[i]
        kin = (labels[:, 0] <= ha) & (labels[:, 1] >= la) if same else ~((labels[:, 0] == labels[:, 1]) & (labels[:, 0] == la) & (la == ha))
        return fits & (lows <= most) & kin, highs

    # A pair is looked at again when its turn comes, as the best so far may have got better; the most promising come first.
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if not wanted(i, np.array([j]))[0][0]:
            continue
        leaf_a, leaf_c = a.left[i] < 0, c.left[j] < 0
        if leaf_a and leaf_c:
            at, to = slice(a.begin[i], a.end[i]), slice(c.begin[j], c.end[j])
            by = np.lexsort((rows[to], c.ids[to]))
            x, ids, row, lab = c.x[to][by], c.ids[to][by], rows[to][by], c.labels[to][by]
            s = products(a.x[at], x, float(a.high[i]) * float(c.high[j]) * (1 + 1e-9))
            kin = (a.labels[at][:, None] == lab) if same else (a.labels[at][:, None] != lab)
            kin &= own[at][:, None] != row
            for w in range(low.shape[1]):
                best.add(at, w, s, kin & (s >= best.floor[at, w][:, None]) & (s <= high[at, w][:, None]), ids, row)
            continue
        if leaf_c or (not leaf_a and a.end[i] - a.begin[i] >= c.end[j] - c.begin[j]):
            todo += [(a.left[i], j), (a.right[i], j)]
        else:
            js = np.array([c.left[j], c.right[j]])
            need, tops = wanted(i, js)
            todo += [(i, int(js[n])) for n in np.argsort(tops, kind="stable") if need[n]]
    return best


def routing(sample: np.ndarray, cells: int) -> list[tuple]:
    """Nodes (direction, threshold, left, right, cell) of a tree that halves a sample until it has ``cells`` leaves."""
    nodes: list[tuple] = []
    leaves = 0

    def build(x, share):
        nonlocal leaves
        at = len(nodes)
        nodes.append(None)
        away = x - x.mean(axis=0) if len(x) else x
        if share > 1 and len(x) > 1 and np.abs(away).max() > 0:
            _, _, v = np.linalg.svd(away[:: max(1, len(away) // 512)], full_matrices=False)
            along = x @ v[0]
            cut = np.median(along)
            side = along <= cut
            if 0 < side.sum() < len(x):
                nodes[at] = (v[0], cut, build(x[side], share // 2), build(x[~side], share - share // 2), -1)
                return at
        nodes[at] = (None, 0.0, -1, -1, leaves)
        leaves += 1
        return at

    build(sample.astype(np.float64), cells)
    return nodes


def route(nodes: list[tuple], x: np.ndarray) -> np.ndarray:
    """The cell of each row."""
    out = np.zeros(len(x), np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        k, rows = todo.pop()
        if not len(rows):
            continue
        axis, cut, left, right, cell = nodes[k]
        if axis is None:
            out[rows] = cell
        else:
            side = x[rows] @ axis <= cut
            todo += [(left, rows[side]), (right, rows[~side])]
    return out


def _search_blocks(candidates: DataFrame, anchors: DataFrame, blocks: int, d: int, same: bool, k: int) -> DataFrame:
    """``anchor, slot, id, row, score``: the best ``k`` of each anchor and window in each block that it is sent to.

    ``candidates``: block, row, id, label, x; ``anchors`` further have windows ``low`` and ``high`` and are sorted by
    ``home``, so that near ones are searched together.  A task holds one block's candidates and ``ANCHORS`` anchors.
    """
    both = candidates.select("block", F.lit(-1).alias("home"), "row", "id", "label", "x", F.lit(None).cast("array<bigint>").alias("low"), F.lit(None).cast("array<bigint>").alias("high"))
    both = both.unionByName(anchors.select("block", "home", "row", "id", "label", "x", "low", "high"))
    parts = max(blocks, int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = both.repartition(parts, "block").sortWithinPartitions("block", "home")
    out = ["anchor", "slot", "id", "row", "score"]

    def arrays(t: pa.Table):
        ids = t["id"].fill_null(NO_ID).to_numpy()
        return matrix(t["x"], d).astype(np.float64), t["label"].to_numpy().astype(np.int64), ids, t["row"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]):
        tree = rows = block = None
        for (now, is_anchor), t in _runs(batches):
            if now != block:
                tree, block = None, now
            if not is_anchor:
                x, labels, ids, rows = arrays(t)
                tree = Tree(x, labels, ids, LEAVES[1])
                rows = rows[tree.order]
                continue
            if tree is None:
                continue
            x, labels, ids, own = arrays(t)
            mine = Tree(x, labels, ids, LEAVES[0])
            low, high = (matrix(t[n], len(t[n][0].as_py()))[mine.order] for n in ("low", "high"))
            own = own[mine.order]
            best = search(mine, low, high, own, tree, rows, same, k)
            a, w, _ = np.nonzero(best.score > LEAST)
            got = best.score > LEAST
            ids = pa.array(best.id[got], mask=best.id[got] == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(w.astype(np.int32)), ids, pa.array(best.row[got]), pa.array(best.score[got])], out)

    return dealt.mapInArrow(run, "anchor long, slot int, id long, row long, score long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, bool], pa.Table]]:
    """A block's candidates as one table, then its anchors in tables of at most ``ANCHORS`` rows."""
    held: list[pa.RecordBatch] = []
    key, n = None, 0
    for batch in batches:
        block = batch.column(0).to_numpy()
        anchor = batch.column(1).to_numpy() >= 0
        edges = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (anchor[1:] != anchor[:-1])) + 1).tolist(), len(block)]
        for a, b in zip(edges, edges[1:], strict=False):
            while a < b:
                now = (int(block[a]), bool(anchor[a]))
                if held and (now != key or (now[1] and n >= ANCHORS)):
                    yield key, pa.Table.from_batches(held)
                    held, n = [], 0
                key = now
                size = min(b - a, ANCHORS - n) if now[1] else b - a
                held.append(batch.slice(a, size))
                a, n = a + size, n + size
    if held:
        yield key, pa.Table.from_batches(held)


def _reduce(hits: list[DataFrame], k: int) -> DataFrame:
    """The best ``k`` of each anchor and window over all blocks, with their ``rank``."""
    order = [F.desc("score"), F.asc_nulls_last("id"), "row"]
    ranked = reduce(DataFrame.unionByName, hits).withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256, cells: int = CELLS, block_rows: int | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor``: which rows are anchors, over the input's columns; ``share``: a negative's score is at least this
    fraction of the positive's, and at most all of it.
    """
    spark = df.sparkSession
    label = F.col("label") if label is None else label
    ok = usable(F.col(vector_col)) & label.isNotNull()
    rows = df.where(ok).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(is_anchor & F.col(id_col).isNotNull(), F.lit(False)).alias("is_anchor"), quantised(F.col(vector_col), scale).alias("x"))
    n, d, largest = extent(rows, "x")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    d = max(d, 1)
    rows = fitted(rows, "x", d, largest)
    size = block_rows or min(max(-(-n // 512), BLOCK_ROWS[0]), BLOCK_ROWS[1])
    sample = rows.select("x").sample(min(1.0, SAMPLE / n), seed=7).limit(2 * SAMPLE).toArrow()
    tree = routing(matrix(sample["x"], d), min(cells, -(-n // size)))

    def assign(batches):
        for b in batches:
            yield b.append_column("cell", pa.array(route(tree, matrix(b.column(3), d).astype(np.float64)), pa.int32()))

    placed = rows.mapInArrow(assign, f"id long, label long, is_anchor boolean, x {rows.schema['x'].dataType.simpleString()}, cell int")
    placed = stored(placed.withColumn("row", F.monotonically_increasing_id()))

    # A row for each cell and kind: sums of the vectors, then radii about their means.
    def sums(batches):
        seen: dict = {}
        for b in batches:
            x, cell, kind = matrix(b.column(0), d).astype(np.float64), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            for c in np.unique(cell):
                for f in (False, True):
                    at = (cell == c) & (kind == f)
                    if at.any():
                        was = seen.get((int(c), f), (0, 0.0))
                        seen[int(c), f] = (was[0] + int(at.sum()), was[1] + x[at].sum(axis=0))
        yield pa.RecordBatch.from_pylist([{"cell": c, "kind": f, "n": m, "x": v.tolist()} for (c, f), (m, v) in seen.items()], pa.schema([("cell", pa.int32()), ("kind", pa.bool_()), ("n", pa.int64()), ("x", pa.list_(pa.float64()))]))

    summed: dict = {}
    partial = placed.select("x", "cell", "is_anchor").mapInArrow(sums, "cell int, kind boolean, n long, x array<double>")
    by_place = partial.select("cell", "kind", "n", F.posexplode("x").alias("place", "v")).groupBy("cell", "kind", "place").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    for r in by_place.groupBy("cell", "kind").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "v"))).alias("x")).collect():  # two rows a cell
        summed[r.cell, r.kind] = (r.n, np.array([v.v for v in r.x]))
    counts: dict[int, int] = {}
    for (c, _), (m, _x) in summed.items():
        counts[c] = counts.get(c, 0) + m
    centre = {c: sum(summed[c, f][1] for f in (False, True) if (c, f) in summed) / counts[c] for c in counts}

    def measure(batches):
        for b in batches:
            x, cell = matrix(b.column(0), d).astype(np.float64), b.column(1).to_numpy()
            away, norm = np.zeros(len(x)), np.sqrt(np.einsum("ij,ij->i", x, x))
            for c in np.unique(cell):
                at = cell == c
                away[at] = np.linalg.norm(x[at] - centre[int(c)], axis=1)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(3), pa.array(away), pa.array(norm)], ["cell", "is_anchor", "label", "away", "norm"])

    measured = placed.select("x", "cell", "is_anchor", "label").mapInArrow(measure, "cell int, is_anchor boolean, label long, away double, norm double")
    ranges = lambda by: by.agg(F.max("away").alias("away"), F.min("norm").alias("low"), F.max("norm").alias("high"), F.min("label").alias("first"), F.max("label").alias("last"))
    by_kind = [(r, r.is_anchor) for r in ranges(measured.groupBy("cell", "is_anchor")).collect()]  # two rows a cell

    def balls(kinds):
        out: dict = {}
        for r, f in by_kind:
            if f in kinds:
                was = out.get(r.cell)
                mine_ = (r.away, r.low, r.high, r["first"], r["last"])
                out[r.cell] = mine_ if was is None else (max(was[0], mine_[0]), min(was[1], mine_[1]), max(was[2], mine_[2]), min(was[3], mine_[3]), max(was[4], mine_[4]))
        return out

    of_anchors, of_all = balls({True}), balls({False, True})
    parts = {c: max(1, -(-m // size)) for c, m in counts.items()}
    blocks = sum(parts.values())
    first = dict(zip(sorted(parts), np.cumsum([0, *(parts[c] for c in sorted(parts))]).tolist(), strict=False))
    places = F.broadcast(spark.createDataFrame([(c, first[c], parts[c]) for c in sorted(parts)], "cell int, first long, parts long"))  # a row a cell
    candidates = placed.join(places, "cell").withColumn("block", F.col("first") + F.pmod("row", "parts")).drop("first", "parts")
    anchors = candidates.where("is_anchor").withColumnRenamed("cell", "home").drop("is_anchor")

    def sent(queries: DataFrame, same: bool) -> DataFrame:
        """Anchors with their windows, once for each block of each cell that may hold what they want."""
        lows = F.array_min("low").alias("low"), F.array_max("high").alias("high")
        wants = {r.home: (r.low, r.high) for r in queries.select("home", *lows).groupBy("home").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()}  # a row a cell
        cs = sorted(of_all)
        ball_c = [np.array([centre[c] for c in cs]), *(np.array([of_all[c][p] for c in cs]) for p in range(3))]
        labels = np.array([of_all[c][3:] for c in cs])
        pairs = []
        for home, (low, high) in wants.items():
            away, least, most, la, ha = of_anchors[home]
            lo, hi = interval(centre[home], away, least, most, *ball_c)
            kin = (labels[:, 0] <= ha) & (labels[:, 1] >= la) if same else ~((labels[:, 0] == labels[:, 1]) & (labels[:, 0] == la) & (la == ha))
            pairs += [(home, first[cs[p]], parts[cs[p]]) for p in np.flatnonzero((hi >= low) & (lo <= high) & kin)]
        to = spark.createDataFrame(pairs, "home int, first long, parts long")  # CELLS x CELLS rows at most
        return queries.join(F.broadcast(to), "home").withColumn("block", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))).drop("first", "parts")

    window = lambda v: F.array(F.lit(v).cast("long"))
    open_anchors = anchors.withColumns({"low": window(LEAST + 1), "high": window(MOST)})
    near = stored(_search_blocks(candidates, open_anchors, blocks, d, True, positives))
    kth = near.groupBy("anchor").agg(F.when(F.count("*") >= positives, F.min("score")).alias("kth"))
    bounded = open_anchors.withColumnRenamed("block", "own").join(kth.withColumnRenamed("anchor", "row"), "row", "left").withColumn("low", F.array(F.coalesce("kth", F.lit(LEAST + 1)))).drop("kth")
    bounded = stored(bounded)
    elsewhere = sent(bounded, True).where("block <> own")
    found = stored(_reduce([near, _search_blocks(candidates, elsewhere, blocks, d, True, positives)], positives).select("anchor", (F.col("rank") - 1).alias("slot"), "id", "row", "score"))
    # Windows in the order of the positives; one that isn't there, or whose score is below 0, is empty.
    least = F.expr(f"cast(ceil(cast(score as decimal(38,0)) * {share[0]} / {share[1]}) as bigint)")
    windows = found.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", least.alias("low"), F.col("score").alias("high")))), lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high"))).alias("w"))  # ``positives`` at most
    missing = F.array_repeat(F.lit(LEAST + 1), F.lit(positives) - F.size("w"))
    asked = bounded.select("home", "row", "id", "label", "x").join(windows.withColumnRenamed("anchor", "row"), "row")
    asked = asked.withColumns({"low": F.concat(F.col("w.low"), F.array_repeat(F.lit(MOST), F.lit(positives) - F.size("w"))), "high": F.concat(F.col("w.high"), missing)}).drop("w")
    asked = stored(asked)
    hits = _reduce([_search_blocks(candidates, sent(asked, False), blocks, d, False, negatives)], negatives)
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    of = found.select("anchor", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hits.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(of, ["anchor", "slot"]).join(names, "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 100 == 0, label=label)
