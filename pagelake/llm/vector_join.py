"""Near-duplicate vectors by cosine: an exact subspace pigeonhole join.

Of unit vectors, a cosine of at least c means a squared distance of at most D = 2 - 2c. A fixed random rotation
spreads what vectors have over all dimensions; the rotated dimensions are cut into blocks, and each block gets the part
of D that its width is of all dimensions. The blocks' squared distances add up to the whole one, so a pair within D is
within budget in one block at least: the union of one range join per block holds every pair, and the cosine of each
candidate is then computed from the vectors as they were given, in double precision.

A block's range join deals its points to the cells of a tree of median splits. A point stands in its own cell and
visits the lower-numbered cells whose box lies within the budget, so each pair meets in one cell. Cells are cut into
slices of bounded size, home points against home points and visitors, so a cell that holds a third of all rows is
many tasks. Tasks hand on what a vector links to as a count and one link of a spanning forest, never the pairs
themselves: a pair counts in its first block within budget only. Equal vectors are one point with a weight.

Rotated coordinates are whole numbers (in units of 2**-44), so they are the same in every task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import mix, small_batches, stored
from pagelake.llm.components import components

THRESHOLD = 0.9
#: Dimensions of a block: wide enough that few pairs are within its budget by chance.
BLOCK = 16
#: Points of a cell that splitting aims at, and of the slices that home points and visitors are dealt to.
CELL, HOMES, VISITORS = 4096, 4096, 16384
#: Sampled points per cell that the splits are taken from, and most points of a sample. They shape cells, not results.
PER_CELL, MOST_SAMPLED = 16, 1 << 17
#: Candidates that are verified at a time, and cells of a distance matrix.
AT_ONCE, MATRIX = 1 << 16, 1 << 22
#: What rounding may add to a squared distance.
SLACK = 1e-5
LINKS = "node bigint, n_links bigint, linked bigint"


def rotation(dims: int, seed: int = 13) -> np.ndarray:
    """A random rotation in whole units of 2**-20."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return np.rint(q * np.sign(np.diag(r)) * 2.0**20)


def units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


@dataclass
class Layout:
    """Blocks, budgets and cells of the vectors of one number of dimensions."""

    dims: int
    threshold: float
    turn: np.ndarray
    edges: np.ndarray
    budgets: np.ndarray
    trees: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    depth: int = 0
    homes: np.ndarray | None = None
    visitors: np.ndarray | None = None

    @staticmethod
    def of(dims: int, threshold: float, block: int) -> Layout:
        n_blocks = -(-dims // block)
        edges = np.rint(np.linspace(0, dims, n_blocks + 1)).astype(int)
        most = max(2 - 2 * threshold, 0) * (1 + SLACK) + SLACK
        return Layout(dims, threshold, rotation(dims), edges, most * np.diff(edges) / dims)

    def rotated(self, v: np.ndarray) -> np.ndarray:
        """Sums of whole numbers below 2**53 are exact in any order."""
        return (np.rint(units(v) * 2.0**24) @ self.turn) * 2.0**-44

    def parts(self, turned: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(turned[:, a:z]) for a, z in zip(self.edges, self.edges[1:])]

    def split(self, sample: np.ndarray, depth: int) -> None:
        """Median splits of each block along its widest dimension, ``depth`` times over."""
        self.depth = depth
        for points in self.parts(self.rotated(sample)):
            axis, value = np.zeros(2**depth - 1, int), np.zeros(2**depth - 1)
            groups = [points]
            for level in range(depth):
                below = []
                for i, group in enumerate(groups):
                    at = 2**level - 1 + i
                    if len(group):
                        axis[at] = np.ptp(group, axis=0).argmax()
                        value[at] = np.median(group[:, axis[at]])
                    left = group[:, axis[at]] < value[at]
                    below += [group[left], group[~left]]
                groups = below
            self.trees.append((axis, value))

    def cells(self, block: int, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home cell of each point, point and cell of every visit)."""
        axis, value = self.trees[block] if self.trees else (np.zeros(0, int), np.zeros(0))
        home = np.zeros(len(points), np.int64)
        for level in range(self.depth):
            at = 2**level - 1 + home
            home = 2 * home + (points[np.arange(len(points)), axis[at]] >= value[at])
        met, where = [], []
        off = np.zeros_like(points)
        todo = [(0, 0, np.arange(len(points)), off, np.zeros(len(points)))]
        while todo:
            level, i, rows, off, far = todo.pop()
            # only cells below the home cell are visited
            wanted = (i << (self.depth - level)) < home[rows]
            rows, off, far = rows[wanted], off[wanted], far[wanted]
            if not len(rows):
                continue
            if level == self.depth:
                met.append(rows)
                where.append(np.full(len(rows), i))
                continue
            at = 2**level - 1 + i
            d = points[rows, axis[at]] - value[at]
            crossed = far - off[:, axis[at]] ** 2 + d * d
            for side, beyond in ((0, d >= 0), (1, d < 0)):
                reach = np.where(beyond, crossed, far)
                near = reach <= self.budgets[block]
                moved = off[near]
                moved[beyond[near], axis[at]] = np.abs(d[near][beyond[near]])
                todo.append((level + 1, 2 * i + side, rows[near], moved, reach[near]))
        if not met:
            return home, np.zeros(0, np.int64), np.zeros(0, np.int64)
        return home, np.concatenate(met), np.concatenate(where)


def points(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vectors that can be compared: node, embedding, copies, least; other rows as they are)."""
    good = (F.size("embedding") > 0) & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(good, F.lit(False))
    grouped = rows.filter(good).groupBy("embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    return stored(grouped.withColumn("node", F.monotonically_increasing_id())), rows.filter(~good)


def _by_dims(batch: pa.RecordBatch, layouts: dict[int, Layout]):
    """(layout, row numbers, vectors) of each number of dimensions of a batch."""
    column = batch.column("embedding")
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for dims in np.unique(sizes):
        rows = np.flatnonzero(sizes == dims)
        yield layouts[int(dims)], rows, flat[starts[rows][:, None] + np.arange(dims)]


def layouts_of(found: DataFrame, threshold: float, block: int, cell: int, homes: int, visitors: int) -> dict[int, Layout]:
    """Blocks and cells for every number of dimensions, with the slices that exact counts of their points ask for."""
    out, context = {}, found.sparkSession.sparkContext
    for r in found.groupBy(F.size("embedding").alias("dims")).count().collect():
        layout = out[r["dims"]] = Layout.of(r["dims"], threshold, block)
        depth = max(0, int(np.ceil(np.log2(r["count"] / cell)))) if r["count"] else 0
        depth = min(depth, int(np.log2(MOST_SAMPLED / PER_CELL)))
        if depth:
            own = found.filter(F.size("embedding") == r["dims"]).orderBy(F.xxhash64("embedding")).limit(PER_CELL << depth)
            layout.split(np.array([x[0] for x in own.select("embedding").toLocalIterator()], np.float64), depth)
    shared = context.broadcast(out)

    def count(batches):
        total = {}
        for batch in batches:
            for layout, _, v in _by_dims(batch, shared.value):
                for b, part in enumerate(layout.parts(layout.rotated(v))):
                    home, _, where = layout.cells(b, part)
                    n = np.stack([np.bincount(x, minlength=2**layout.depth) for x in (home, where)], axis=1)
                    total[layout.dims, b] = total.get((layout.dims, b), 0) + n
        for (dims, b), n in total.items():
            k = np.flatnonzero(n.sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), dims)), pa.array(np.full(len(k), b)), pa.array(k), pa.array(n[k, 0]), pa.array(n[k, 1])],
                names=["dims", "block", "cell", "homes", "visits"])

    counted = small_batches(found).select("embedding").mapInArrow(count, "dims bigint, block bigint, cell bigint, homes bigint, visits bigint")
    for layout in out.values():
        layout.homes = np.zeros((len(layout.budgets), 2**layout.depth), np.int64)
        layout.visitors = np.zeros_like(layout.homes)
    for r in counted.groupBy("dims", "block", "cell").agg(F.sum("homes").alias("homes"), F.sum("visits").alias("visits")).collect():
        out[r["dims"]].homes[r["block"], r["cell"]] = -(-r["homes"] // homes)
        out[r["dims"]].visitors[r["block"], r["cell"]] = -(-r["visits"] // visitors)
    return out


#: Sides of a tile: left points meet each other in unit 0 and all right points everywhere.
LEFT, RIGHT = 0, 1


def _dealt(layout: Layout, block: int, points: np.ndarray, spread: np.ndarray):
    """(point, cell, slice, unit, side) of every tile that a point of a block takes part in.

    A tile is one slice of the home points of a cell against one unit: a slice of visitors, or, from the number
    of those on, a later slice of home points. Within the slice points meet in unit 0.
    """
    home, met, where = layout.cells(block, points)
    n_home, n_visit = layout.homes[block], np.maximum(layout.visitors[block], 1)
    own = (spread % np.maximum(n_home[home], 1).astype(np.uint64)).astype(np.int64)
    for unit in range(int(n_visit[home].max(initial=0))):
        at = np.flatnonzero(unit < n_visit[home])
        yield at, home[at], own[at], np.full(len(at), unit), LEFT
    for other in range(int(n_home[home].max(initial=0))):
        there = other < n_home[home]
        at = np.flatnonzero(there & (other > own))
        yield at, home[at], own[at], n_visit[home[at]] + other, LEFT
        at = np.flatnonzero(there & (other < own))
        yield at, home[at], np.full(len(at), other), n_visit[home[at]] + own[at], RIGHT
    unit = (spread[met] % n_visit[where].astype(np.uint64)).astype(np.int64)
    for part in range(int(n_home[where].max(initial=0))):
        at = np.flatnonzero(part < n_home[where])
        yield met[at], where[at], np.full(len(at), part), unit[at], RIGHT


def tiles(found: DataFrame, layouts: dict[int, Layout]) -> DataFrame:
    """(dims, block, cell, slice, unit, side, node, copies, embedding) of all tiles."""
    shared = found.sparkSession.sparkContext.broadcast(layouts)
    names = ["dims", "block", "cell", "slice", "unit", "side"]

    def run(batches):
        for batch in batches:
            node = batch.column("node").to_numpy()
            for layout, rows, v in _by_dims(batch, shared.value):
                spread = mix(node[rows].astype(np.uint64))
                for b, part in enumerate(layout.parts(layout.rotated(v))):
                    for at, cell, piece, unit, side in _dealt(layout, b, part, spread):
                        if len(at):
                            taken = batch.select(["node", "copies", "embedding"]).take(pa.array(rows[at]))
                            full = [np.full(len(at), layout.dims), np.full(len(at), b), cell, piece, unit, np.full(len(at), side)]
                            yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in full), *taken.columns],
                                                             names=[*names, "node", "copies", "embedding"])

    kind = dict(found.dtypes)["embedding"]
    ddl = ", ".join(f"{n} int" for n in names) + f", node bigint, copies bigint, embedding {kind}"
    return small_batches(found).select("node", "copies", "embedding").mapInArrow(run, ddl)


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``a`` and ``b`` in place; every entry points at the smallest of its tree."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            onward = root[root]
            if (onward == root).all():
                break
            root[:] = onward


class Tile:
    """The points of one tile and what they link to."""

    def __init__(self, layout: Layout, block: int, vectors: np.ndarray, copies: np.ndarray):
        self.layout, self.block, self.vectors, self.copies = layout, block, vectors, copies
        self.length = np.sqrt((vectors * vectors).sum(1))
        self.parts = layout.parts(layout.rotated(vectors))
        self.root, self.links = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)

    def near(self, block: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = self.parts[block][a] - self.parts[block][b]
        return (d * d).sum(1) <= self.layout.budgets[block]

    def verify(self, a: np.ndarray, b: np.ndarray) -> None:
        """Count the pairs that are within budget in this block first and whose cosine is large enough."""
        keep = self.near(self.block, a, b)
        for earlier in range(self.block):
            keep[keep] = ~self.near(earlier, a[keep], b[keep])
        a, b = a[keep], b[keep]
        cosine = (self.vectors[a] * self.vectors[b]).sum(1) / (self.length[a] * self.length[b])
        a, b = a[cosine >= self.layout.threshold], b[cosine >= self.layout.threshold]
        self.links += np.bincount(a, self.copies[b], len(self.links)).astype(np.int64)
        self.links += np.bincount(b, self.copies[a], len(self.links)).astype(np.int64)
        unite(self.root, a, b)

    def meet(self, left: np.ndarray, right: np.ndarray, within: bool) -> None:
        """All pairs of ``left`` and ``right``, or within ``left``, whose distance in the block may be in budget."""
        x, y = self.parts[self.block][left].astype(np.float32), self.parts[self.block][right].astype(np.float32)
        most = np.float32(self.layout.budgets[self.block] + SLACK)
        high = (y * y).sum(1)
        step = max(1, MATRIX // max(1, len(right)))
        for i in range(0, len(left), step):
            own = x[i:i + step]
            found = high[None, :] - 2 * (own @ y.T) <= most - (own * own).sum(1)[:, None]
            if within:
                found &= np.arange(len(right))[None, :] > np.arange(i, i + len(own))[:, None]
            at = np.flatnonzero(found)
            for k in range(0, len(at), AT_ONCE):
                a, b = np.divmod(at[k:k + AT_ONCE], len(right))
                self.verify(left[i + a], right[b])


def links(found: DataFrame, layouts: dict[int, Layout]) -> DataFrame:
    """(node, n_links, linked): rows that one tile links to a node, copies counted, and one of its links or itself."""
    shared = found.sparkSession.sparkContext.broadcast(layouts)

    def run(key, rows):
        dims, block, _, _, unit = (k.as_py() for k in key)
        layout = shared.value[dims]
        rows = rows.combine_chunks()
        node, copies, side = (rows.column(c).to_numpy() for c in ("node", "copies", "side"))
        vectors = rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        tile = Tile(layout, block, vectors.reshape(-1, dims), copies)
        left, right = np.flatnonzero(side == LEFT), np.flatnonzero(side == RIGHT)
        if unit == 0:
            tile.meet(left, left, True)
        if len(left) and len(right):
            tile.meet(left, right, False)
        at = np.flatnonzero(tile.links)
        return pa.table({"node": node[at], "n_links": tile.links[at], "linked": node[tile.root[at]]})

    grouped = tiles(found, layouts).groupBy("dims", "block", "cell", "slice", "unit")
    return grouped.applyInArrow(run, LINKS)


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, cell: int = CELL,
                 homes: int = HOMES, visitors: int = VISITORS) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Null, empty and zero vectors and those with null or non-finite components link with nothing; vectors link only
    with vectors of as many dimensions. Repeated rows are rows of their own, so equal rows link with each other. The
    smallest identifier of a component is its mark; a null one never is unless all are null. An empty table gives no
    rows; other columns are not looked at. The threshold must be above 0.
    """
    rows = rows.select("vec_id", "embedding")
    found, rest = points(rows)
    met = stored(links(found, layouts_of(found, threshold, block, cell, homes, visitors)))
    degree = met.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    linked = components(met.filter("node <> linked").select(F.col("node").alias("a"), F.col("linked").alias("b")))
    placed = found.join(linked.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = placed.join(names, "component").join(degree, "node", "left").select(
        "embedding", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    judged = rows.join(facts, "embedding").select("vec_id", "n_links", "component_id")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return judged.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), near AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id, min(top) AS component_id FROM (
    WITH RECURSIVE r(vec_id, top) AS (
      SELECT vec_id, vec_id FROM embeddings UNION SELECT near.a, r.top FROM r JOIN near ON near.b = r.vec_id
    ) SELECT * FROM r) GROUP BY vec_id
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN reach USING (vec_id) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM near GROUP BY a) USING (vec_id)
"""
