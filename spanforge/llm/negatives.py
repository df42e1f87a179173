"""Hard negatives by an STR-packed R-tree: inner-product intervals of boxes, best-first search, score windows."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


@dataclass(frozen=True)
class Tree:
    """``leaf`` rows share a box, ``fan`` boxes share a parent; a subtree of about ``tile`` rows is searched by one task at a time.

    ``sample`` rows give the bounds by which rows are sent to subtrees; at most ``tiles`` subtrees
    are made, so that their root boxes stay small enough to be sent to every task.
    """

    leaf: int = 128
    fan: int = 16
    tile: int = 8192
    sample: int = 20000
    tiles: int = 4096
    seed: int = 12


LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def slices(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Sort-tile-recursive packing: row numbers of boxes of up to ``size`` rows.

    Rows are sorted along the coordinate that spreads most and cut into slabs, each slab along its
    next one, until boxes are small enough. Slabs hold whole boxes, so all boxes but the last are full.
    """
    todo, out = [(np.arange(len(x)), frozenset())], []
    while todo:
        rows, used = todo.pop()
        boxes = -(-len(rows) // size)
        if boxes <= 1:
            out.append(rows)
            continue
        here = x[rows]
        wide = here.max(0) - here.min(0)
        wide = np.where(np.isin(np.arange(x.shape[1]), list(used)), -1, wide) if len(used) < x.shape[1] else wide
        axis = int(wide.argmax())
        rows = rows[np.argsort(here[:, axis], kind="stable")]
        slabs = 2 if boxes < 9 else int(np.ceil(boxes**0.5))
        step = -(-boxes // slabs) * size
        todo += [(rows[at : at + step], used | {axis}) for at in range(0, len(rows), step)]
    return out


@dataclass
class Node:
    """Boxes of the children, and the children: nodes, or row numbers where the boxes are leaves."""

    low: np.ndarray
    high: np.ndarray
    children: list


def pack(x: np.ndarray, how: Tree) -> tuple[Node, np.ndarray]:
    """The tree of a tile, bottom up, and the order of its rows: a leaf's rows stand together."""
    leaves = slices(x, how.leaf)
    order = np.concatenate(leaves)
    ends = np.cumsum([len(v) for v in leaves])
    low = np.stack([x[v].min(0) for v in leaves])
    high = np.stack([x[v].max(0) for v in leaves])
    children: list = list(zip(ends - [len(v) for v in leaves], ends, strict=True))
    while len(children) > how.fan:
        groups = slices((low + high) / 2, how.fan)
        children = [Node(low[g], high[g], [children[i] for i in g]) for g in groups]
        low, high = np.stack([low[g].min(0) for g in groups]), np.stack([high[g].max(0) for g in groups])
    return Node(low, high, children), order


def intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, boxes) least and greatest inner product of each query with a point of each box, coordinate by coordinate."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _exact(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; by doubles where they hold every partial sum exactly."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[-1] < 2.0**52:
        return (x @ a).astype(np.int64)
    return x.astype(np.int64) @ a.astype(np.int64)


class _Windows:
    """The best ``k`` scores of a query in each of its windows; a full window's ``floor`` is its k-th score."""

    def __init__(self, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int):
        self.low, self.high, self.floor, self.k = low, high, floor.copy(), k
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in low]

    def reach(self, least: float, most: float) -> float:
        """The best score a box can still give any window; -inf where it lies outside all or strictly below all floors."""
        top = np.minimum(most, self.high)
        alive = (most >= self.low) & (least <= self.high) & (top >= self.floor)
        return float(top[alive].max()) if alive.any() else -np.inf

    def offer(self, score: np.ndarray, ids: np.ndarray, u: np.ndarray) -> None:
        for w, (lo, hi) in enumerate(zip(self.low, self.high, strict=True)):
            fit = np.flatnonzero((score >= max(lo, self.floor[w])) & (score <= hi))
            if not len(fit):
                continue
            if len(fit) > self.k:
                fit = fit[np.lexsort((ids[fit], -score[fit]))[: self.k]]
            self.best[w] = sorted([*self.best[w], *((-int(score[i]), int(ids[i]), int(u[i])) for i in fit)])[: self.k]
            if len(self.best[w]) == self.k:
                self.floor[w] = max(self.floor[w], -self.best[w][-1][0])


def search(root: Node, x: np.ndarray, ids: np.ndarray, u: np.ndarray, label: np.ndarray, a: np.ndarray, own: int, own_label: int, same: bool, windows: _Windows) -> None:
    """Best-first: boxes leave the queue by the best score they can give; the rest is dropped once none can."""
    slack = 1e-9 * (1 + np.abs(a).sum() * max(np.abs(root.low).max(), np.abs(root.high).max()))  # bounds are sums of doubles
    queue: list[tuple[float, int, object]] = []
    made = 0

    def push(node: Node) -> None:
        nonlocal made
        least, most = intervals(a[None], node.low, node.high)
        for child, lo, hi in zip(node.children, least[0], most[0], strict=True):
            can = windows.reach(lo - slack, hi + slack)
            if can > -np.inf:
                made += 1
                heapq.heappush(queue, (-can, made, lo, hi, child))

    push(root)
    while queue:
        _, _, lo, hi, child = heapq.heappop(queue)
        if windows.reach(lo - slack, hi + slack) == -np.inf:
            continue
        if isinstance(child, Node):
            push(child)
            continue
        s, e = child
        score = _exact(a, x[s:e])
        ok = ((label[s:e] == own_label) == same) & (u[s:e] != own)
        windows.offer(score[ok], ids[s:e][ok], u[s:e][ok])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _searched(batches: Iterator[pa.RecordBatch], same: bool, k: int, how: Tree) -> Iterator[pa.RecordBatch]:
    """Rows of each tile and then the queries sent there, to (q, w, score, id, u)."""
    key: tuple = ()
    held: list[tuple[np.ndarray, ...]] = []
    tree, code = None, {}
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        number = {n: col[n].to_numpy(zero_copy_only=False) for n in ("d", "tile", "chunk", "kind", "u", "id", "label")}
        change = np.zeros(batch.num_rows, bool)
        for n in ("d", "tile", "chunk", "kind"):
            change[1:] |= number[n][1:] != number[n][:-1]
        starts = np.r_[0, np.flatnonzero(change)]
        out: tuple[list, ...] = ([], [], [], [], [])
        for s, e in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            now = tuple(int(number[n][s]) for n in ("d", "tile", "chunk"))
            if now != key:
                key, held, tree = now, [], None
            x = _matrix(col["vec"].slice(s, e - s))
            if number["kind"][s] == 0:
                held.append((x, number["id"][s:e], number["u"][s:e], number["label"][s:e]))
                continue
            if not held:
                continue
            if tree is None:
                *whole, names = (np.concatenate(v) for v in zip(*held, strict=True))
                names, codes = np.unique(names, return_inverse=True)
                code = {name: i for i, name in enumerate(names)}
                tree, order = pack(whole[0], how)
                held = [tuple(v[order] for v in (*whole, codes))]
            bounds = [col[n].slice(s, e - s).to_pylist() for n in ("low", "high", "floor")]
            for i in range(e - s):
                w = _Windows(*(np.array(b[i], np.int64) for b in bounds), k)
                q = int(number["u"][s + i])
                search(tree, *held[0], x[i], q, code.get(number["label"][s + i], -1), same, w)
                for place, best in enumerate(w.best):
                    for minus, vec_id, u in best:
                        for to, value in zip(out, (q, place, -minus, vec_id, u), strict=True):
                            to.append(value)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names=["q", "w", "score", "id", "u"])


def _cuts(x: np.ndarray, parts: int) -> list:
    """Nested cuts (axis, bounds, subtrees) of a sample into ``parts`` tiles, numbered from 0 in order; None for one tile.

    As in ``slices``: along the widest spread, into about the square root of the tiles, or two of few.
    """
    if parts <= 1 or not len(x):
        return None
    axis = int((np.quantile(x, 0.95, axis=0) - np.quantile(x, 0.05, axis=0)).argmax())
    slabs = 2 if parts < 9 else int(np.ceil(parts**0.5))
    share = [parts // slabs + (i < parts % slabs) for i in range(slabs)]
    v = np.sort(x[:, axis])
    bounds = v[np.minimum(len(v) - 1, (np.cumsum(share)[:-1] / parts * len(v)).astype(int))]
    side = np.searchsorted(bounds, x[:, axis], "right")
    return [axis, bounds, [_cuts(x[side == i], share[i]) for i in range(slabs)], share]


def _place(x: np.ndarray, cuts: list | None) -> np.ndarray:
    """Tile of each row."""
    if cuts is None:
        return np.zeros(len(x), np.int64)
    axis, bounds, below, share = cuts
    side, first = np.searchsorted(bounds, x[:, axis], "right"), np.r_[0, np.cumsum(share)]
    out = np.zeros(len(x), np.int64)
    for i in np.unique(side):
        out[side == i] = first[i] + _place(x[side == i], below[i])
    return out


def _placed(batches: Iterator[pa.RecordBatch], cuts: dict[int, list]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        size = b.column(b.schema.get_field_index("d")).to_numpy()
        for d in np.unique(size):
            part = b.take(pa.array(np.flatnonzero(size == d)))
            tile = _place(_matrix(part.column(part.schema.get_field_index("vec"))), cuts.get(int(d)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(tile)], names=[*part.schema.names, "tile"])


def _boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, tile, vec) to one count and box per tile that the task has met."""
    met: dict[tuple[int, int], list] = {}
    for b in batches:
        d, tile = b.column(0).to_numpy(), b.column(1).to_numpy()
        for key in set(zip(d.tolist(), tile.tolist(), strict=True)):
            x = _matrix(b.column(2).take(pa.array(np.flatnonzero((d == key[0]) & (tile == key[1])))))
            n, low, high = met.get(key, (0, x[0], x[0]))
            met[key] = [n + len(x), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))]
    if met:
        rows = [{"d": d, "tile": t, "n": n, "low": low.tolist(), "high": high.tolist()} for (d, t), (n, low, high) in met.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("d", pa.int64()), ("tile", pa.int64()), ("n", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]))


def _routed(batches: Iterator[pa.RecordBatch], boxes: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """(q, d, vec, low, high, floor, home) to (q, tile) for all tiles but the home whose root box can add to a window."""
    for b in batches:
        size = b.column(1).to_numpy()
        q, home = b.column(0).to_numpy(), b.column(6).to_numpy()
        for d in np.unique(size):
            if int(d) not in boxes:
                continue
            tiles, low, high = boxes[int(d)]
            rows = np.flatnonzero(size == d)
            part = b.take(pa.array(rows))
            a = _matrix(part.column(2))
            least, most = intervals(a, low, high)
            slack = 1e-9 * (1 + np.abs(a).sum(1, keepdims=True) * max(np.abs(low).max(), np.abs(high).max()))
            lo, hi, floor = (part.column(i).to_pylist() for i in (3, 4, 5))
            width = max(map(len, lo))
            pad = lambda v, fill: np.array([[*w, *[fill] * (width - len(w))] for w in v], np.float64)
            lo, hi, floor = pad(lo, np.inf), pad(hi, -np.inf), pad(floor, np.inf)
            go = np.zeros(least.shape, bool)
            for w in range(width):
                go |= (most + slack >= np.maximum(lo, floor)[:, w : w + 1]) & (least - slack <= hi[:, w : w + 1]) & (hi >= floor)[:, w : w + 1]
            go &= tiles[None] != home[rows][:, None]
            i, j = np.nonzero(go)
            yield pa.RecordBatch.from_arrays([pa.array(q[rows][i]), pa.array(tiles[j])], names=["q", "tile"])


class Forest:
    """Rows of u, id, label, d, vec (doubles of whole numbers) in tiles of an R-tree that is packed by sort-tile-recursion.

    The upper levels are cut by a bounded sample; every row is placed. A tile that gets many more
    rows than it should, as with copies, is dealt into chunks with trees of their own.
    """

    def __init__(self, rows: DataFrame, how: Tree = Tree()):
        self.how, self.spark = how, rows.sparkSession
        rows = cut(rows)
        n = rows.count()
        # the few smallest of a hash of the rows, so that the tree is the same on any cluster
        drawn = rows.select("d", "vec", F.xxhash64("id", "vec", F.lit(how.seed)).alias("_h")).orderBy("_h").limit(how.sample).select("d", "vec").collect()
        self.cuts = {}
        for d in {r.d for r in drawn}:
            x = np.array([r.vec for r in drawn if r.d == d], np.float64)
            wanted = -(-n * len(x) // max(1, len(drawn)) // how.tile)
            self.cuts[int(d)] = _cuts(x, int(min(wanted, max(1, how.tiles * 64 // d), max(1, len(x) // 4))))
        cuts = self.cuts
        schema = "u long, id long, label string, d long, vec array<double>, tile long"
        placed = cut(rows.select("u", "id", "label", "d", "vec").mapInArrow(lambda it: _placed(it, cuts), schema))
        self.rows, spot = placed, ["d", "tile"]
        box = cut(self.rows.select(*spot, "vec").mapInArrow(_boxed, "d long, tile long, n long, low array<double>, high array<double>"))
        self.chunks = cut(box.groupBy(*spot).agg(F.ceil(F.sum("n") / (2 * how.tile)).alias("parts")))
        sides = box.select(*spot, F.posexplode(F.arrays_zip("low", "high")).alias("axis", "x"))
        axes = sides.groupBy(*spot, "axis").agg(F.min("x.low").alias("lo"), F.max("x.high").alias("hi"))
        # one box per tile, of which there are at most ``tiles`` of 64 coordinates or as much in all
        self.boxes = {}
        found: dict[int, dict] = {}
        for r in axes.collect():
            found.setdefault(int(r.d), {}).setdefault(int(r.tile), {})[r.axis] = (r.lo, r.hi)
        for d, tiles in found.items():
            names = sorted(tiles)
            low, high = (np.array([[tiles[t][i][side] for i in range(d)] for t in names]) for side in (0, 1))
            self.boxes[d] = (np.array(names, np.int64), low, high)

    def _run(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """``asks``: q, d, vec, label, low, high, floor, tile."""
        spot, how = ["d", "tile"], self.how
        empty = F.array().cast("array<bigint>")
        rows = self.rows.join(self.chunks, spot).withColumn("chunk", F.pmod(F.xxhash64("u"), "parts"))
        rows = rows.select(*spot, "chunk", F.lit(0).alias("kind"), "u", "id", "label", "vec", empty.alias("low"), empty.alias("high"), empty.alias("floor"))
        sent = asks.join(self.chunks, spot).select(
            *spot, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("chunk"), F.lit(1).alias("kind"),
            F.col("q").alias("u"), F.lit(0).cast("long").alias("id"), "label", "vec", "low", "high", "floor",
        )
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.unionByName(sent).repartition(parts, *spot, "chunk").sortWithinPartitions(*spot, "chunk", "kind")
        return dealt.mapInArrow(lambda it: _searched(it, same, k, how), "q long, w long, score long, id long, u long")

    def top(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """``q, w, score, id, u, rank`` of the best ``k`` rows per window, of the same label or of others.

        ``asks``: q, d, vec, label, low, high, with one entry of low and high per window. Each query
        first searches the tile it lies in; the k-th scores found there tell which others to visit.
        """
        cuts, boxes = self.cuts, self.boxes
        order = Window.partitionBy("q", "w").orderBy(F.col("score").desc(), "id", "u")
        lowest = F.transform("low", lambda _: F.lit(LOWEST))
        schema = "q long, d long, vec array<double>, label string, low array<long>, high array<long>, floor array<long>, tile long"
        asks = cut(asks.withColumn("floor", lowest).select("q", "d", "vec", "label", "low", "high", "floor").mapInArrow(lambda it: _placed(it, cuts), schema))
        first = cut(self._run(asks, same, k))
        best = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        floors = best.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct(F.col("w").cast("int"), "score"))).alias("_f"))  # one entry per window
        known = asks.join(floors, "q", "left").withColumn("floor", F.transform("low", lambda _, i: F.coalesce(F.try_element_at("_f", i), F.lit(LOWEST))))
        known = cut(known.select("q", "d", "vec", "label", "low", "high", "floor", F.col("tile").alias("home")))
        go = known.select("q", "d", "vec", "low", "high", "floor", "home").mapInArrow(lambda it: _routed(it, boxes), "q long, tile long")
        rest = self._run(known.join(go, "q"), same, k)
        return first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, anchors: Column, key: str = "vec_id", vec: str = "embedding", label: str = "label", scale: int = 256,
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, how: Tree = Tree(),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` holds.

    A component x counts as floor(scale * x); a score is the whole inner product with the anchor.
    Positives are an anchor's ``positives`` best other rows of its label; each gets the ``negatives``
    best rows of other labels with a score between ``least`` and ``most`` hundredths of its own.
    Higher scores come first, ties by smaller key.

    Rows with a null key, label or vector, or with a null or non-finite component, take no part, nor
    do empty vectors or those with a component beyond the square root of 2^63 by their length, whose
    scores a long can't hold. Vectors of different length are never compared. Rows with one key are
    rows of their own, and equal positives answer alike; a label may have any type that prints
    differently where it differs. Other columns are not read; an empty table gives an empty one.
    """
    x = F.col(vec)
    whole = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"))
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.filter(F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.size(x) > 0) & fit, F.lit(False)))
    rows = rows.select(F.monotonically_increasing_id().alias("u"), F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.size(x).cast("long").alias("d"), whole.alias("vec"), F.coalesce(anchors, F.lit(False)).alias("_asks"))
    rows = cut(rows.filter(F.forall("vec", lambda v: v * v < F.lit(2.0**63) / F.col("d"))))
    if rows.isEmpty():
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    tree = Forest(rows.drop("_asks"), how)
    asks = cut(rows.filter("_asks").select(F.col("u").alias("q"), F.col("id").alias("anchor_id"), "d", "vec", "label"))
    every = F.array(F.lit(LOWEST)), F.array(F.lit(HIGHEST))
    near = cut(tree.top(asks.select("q", "d", "vec", "label", every[0].alias("low"), every[1].alias("high")), True, positives))
    of = F.col("score").cast("decimal(30,0)")  # a score times a hundred may not fit a long
    bounds = near.select("q", "rank", F.ceil(of * least / 100).cast("long").alias("lo"), F.floor(of * most / 100).cast("long").alias("hi")).filter("lo <= hi")
    listed = bounds.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "lo", "hi"))).alias("b"))  # at most ``positives`` entries
    ranged = asks.join(listed, "q").select("q", "d", "vec", "label", F.col("b.lo").alias("low"), F.col("b.hi").alias("high"), "b")
    ranged = cut(ranged)
    far = tree.top(ranged.drop("b"), False, negatives)
    named = far.join(ranged.select("q", F.posexplode("b").alias("w", "of")), ["q", "w"]).select("q", "rank", "id", "score", F.col("of.rank").alias("of"))
    out = named.join(near.select("q", F.col("rank").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["q", "of"])
    out = out.join(asks.select("q", "anchor_id"), "q")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives_sql(every: int = 50) -> str:
    """The same rows by all pairs in DuckDB, with the query's labels."""
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.u, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.u <> b.u AND a.vec_id % {every} = 0 AND len(a.x) = len(b.x)),
positive AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id) AS place FROM scores WHERE same),
fit AS (
  SELECT p.u, p.place, p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positive p JOIN scores n ON p.u = n.u AND NOT n.same AND p.place <= 5 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score),
ranked AS (SELECT *, row_number() OVER (PARTITION BY u, place ORDER BY negative_score DESC, negative_id)::INTEGER AS rank FROM fit)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
