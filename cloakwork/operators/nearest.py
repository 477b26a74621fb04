"""Exact nearest-neighbour and cheapest-cluster search without comparing all pairs.

The searched rows are cut into cells: in up to FEW dimensions by a tree of halvings,
else around pivot rows picked by hash.  A cell keeps a tiny summary (its box; size and
radius; the extremes of its boxes) that bounds how close any of its rows can be, so a
query row only visits cells that may still hold an answer.  Walked down the tree, a query
meets few boxes however many cells there are, and cells stay small.  Neighbouring cells are packed into blocks, and a query travels once to a block,
with the list of its cells there: where little can be ruled out, as in many dimensions,
that is a copy for every CELL_ROWS rows and not for every cell.  Visits are shuffled by
(block, piece of the block, tile of its visitors): both sides of a task are bounded even
when one cell holds most rows or draws all queries.
The bounds only save work; every cell that could matter is visited.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloakwork.functions.hashing import unit_hash
from cloakwork.operators import encode
from cloakwork.operators.encode import q
from cloakwork.session import materialize

MOST_PIVOTS = 8192
CELL_ROWS = 8192  # rows of a block of cells, or of a piece of a larger cell
TILE_ROWS = 8192
CHUNK = 4_000_000
FEW = 8  # dimensions in which boxes rule out much
LEAF_ROWS = 256  # rows of a group in a cell of the tree, about
MOST_LEVELS = 13  # of the tree: 8192 cells
SAMPLED = 8  # rows for each cell that decide where the tree is cut


def minkowski(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Distance matrix, computed in slices so the difference tensor stays small."""
    out = np.empty((len(a), len(b)))
    if b.shape[1] < 8:  # sums as numpy adds up so few, without the tensor
        out[:] = 0.0
        for x, y in zip(a.T, b.T, strict=True):
            diff = np.abs(x[:, None] - y[None, :])
            out += diff * diff if p == 2 else diff if p == 1 else diff**p
        return out if p == 1 else np.sqrt(out) if p == 2 else out ** (1 / p)
    step = max(1, CHUNK // max(1, b.size))
    for i in range(0, len(a), step):
        diff = np.abs(a[i : i + step, None, :] - b[None, :, :])
        if p == 2:
            out[i : i + step] = np.sqrt((diff * diff).sum(axis=2))
        elif p == 1:
            out[i : i + step] = diff.sum(axis=2)
        else:
            out[i : i + step] = (diff**p).sum(axis=2) ** (1 / p)
    return out


def _length(gap: np.ndarray, p: float) -> np.ndarray:
    """Minkowski length of every row."""
    return gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1)) if p == 2 else (gap**p).sum(axis=1) ** (1 / p)


@dataclass
class Halved:
    """Points of few dimensions under a Minkowski distance, in the cells of a balanced tree.

    Node 1 is the root, 2i and 2i + 1 are the halves of node i; what is at most ``cut``
    along ``axis`` goes to the first.  The leaves are the cells.  A group keeps the size
    and the box of every node.
    """

    p: float
    levels: int
    axis: np.ndarray
    cut: np.ndarray
    summary: dict = field(default_factory=dict)

    @staticmethod
    def of(sample: np.ndarray, levels: int, p: float) -> Halved:
        axis, cut = np.zeros(1 << levels, int), np.zeros(1 << levels)
        parts = {1: sample}
        for node in range(1, 1 << levels):
            rows = parts.pop(node)
            if len(rows):
                axis[node] = rows.std(axis=0).argmax()
                x = rows[:, axis[node]]
                cut[node] = middle = np.partition(x, (len(x) - 1) // 2)[(len(x) - 1) // 2]
                if middle == x.max() and middle > x.min():  # a value that half of the rows have
                    cut[node] = x[x < middle].max()
                first = x <= cut[node]
            else:
                first = np.zeros(0, bool)
            parts[2 * node], parts[2 * node + 1] = rows[first], rows[~first]
        return Halved(p, levels, axis, cut)

    @property
    def places(self) -> np.ndarray:
        return np.arange(1 << self.levels)

    def home(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, row = np.ones(len(points), int), np.arange(len(points))
        for _ in range(self.levels):
            node = 2 * node + (points[row, self.axis[node]] > self.cut[node])
        return node - (1 << self.levels), np.zeros(len(points))

    def learn(self, cells: DataFrame, d: int) -> None:
        """One row per group and cell comes back; rows without a place (null, NaN) are no answers and do not count."""
        value = [F.when(~F.isnan(F.col("v")[i]), F.col("v")[i]) for i in range(d)]
        whole = F.lit(True)
        for v in value:
            whole = whole & v.isNotNull()
        ends = [f(F.when(whole, v)).alias(f"{n}{i}") for i, v in enumerate(value) for n, f in (("a", F.min), ("z", F.max))]
        size = 2 << self.levels
        for r in cells.groupBy("g", "cell").agg(F.count_if(whole).alias("n"), *ends).filter("n > 0").collect():
            n, lo, hi = self.summary.setdefault(r["g"], (np.zeros(size, int), np.full((size, d), np.inf), np.full((size, d), -np.inf)))
            leaf = r["cell"] + (1 << self.levels)
            n[leaf], lo[leaf], hi[leaf] = r["n"], [r[f"a{i}"] for i in range(d)], [r[f"z{i}"] for i in range(d)]
        for n, lo, hi in self.summary.values():
            for level in range(self.levels - 1, -1, -1):
                up = np.arange(1 << level, 2 << level)
                n[up] = n[2 * up] + n[2 * up + 1]
                lo[up], hi[up] = np.minimum(lo[2 * up], lo[2 * up + 1]), np.maximum(hi[2 * up], hi[2 * up + 1])

    def visits(self, points: np.ndarray, groups: list, k: int) -> tuple[np.ndarray, np.ndarray]:
        names, of = np.unique(np.array([str(g) for g in groups], dtype=object), return_inverse=True)
        found = [(np.zeros(0, int), np.zeros(0, int))]
        for i, g in enumerate(names):
            if g in self.summary:
                rows = np.flatnonzero((of == i) & [x is not None for x in groups])
                owner, cell = self._reached(points[rows], *self.summary[g], k)
                found.append((rows[owner], cell))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _reached(self, points: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of a point, cell) of all cells that may hold one of its k nearest."""
        far = lambda at, node: _length(np.maximum(np.abs(points[at] - lo[node]), np.abs(points[at] - hi[node])), self.p)
        near = lambda at, node: _length(np.maximum(np.maximum(lo[node] - points[at], points[at] - hi[node]), 0.0), self.p)
        need, every = min(k, n[1]), np.arange(len(points))
        node = self.home(points)[0] + (1 << self.levels)
        while (few := n[node] < need).any():
            node = np.where(few, node // 2, node)
        room = far(every, node) * (1 + 1e-9) + 1e-12  # so many rows are no farther
        at, node = every, np.ones(len(points), int)
        at = at[~np.isnan(points).any(axis=1)]
        node = node[: len(at)]
        for _ in range(self.levels):
            at, node = np.repeat(at, 2), np.repeat(2 * node, 2) + np.tile([0, 1], len(node))
            some = n[node] > 0
            at, node = at[some], node[some]
            some = near(at, node) <= room[at]
            at, node = at[some], node[some]
        # the ends of all of these boxes together draw a closer bound
        reach = far(at, node)
        order = np.lexsort((reach, at))
        total = np.cumsum(n[node[order]])
        first = np.flatnonzero(np.append(True, at[order][1:] != at[order][:-1])[: len(at)])
        before = np.repeat(total[first] - n[node[order]][first], np.diff(np.append(first, len(at))))
        enough = np.flatnonzero(total - before >= need)
        closest = np.full(len(points), np.inf)
        np.minimum.at(closest, at[order][enough], reach[order][enough])
        some = near(at, node) <= closest[at] * (1 + 1e-9) + 1e-12
        return at[some], node[some] - (1 << self.levels)

    def score(self, points: np.ndarray, data: np.ndarray) -> np.ndarray:
        return minkowski(points, data, self.p)

    def rough(self, points: np.ndarray, data: np.ndarray) -> None:
        return None


@dataclass
class Metric:
    """Points under a Minkowski distance; a cell is bounded by its radius."""

    p: float = 2.0
    pivots: np.ndarray | None = None
    summary: dict = field(default_factory=dict)

    @property
    def places(self) -> np.ndarray:
        return _along(self.pivots)

    def home(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dist = minkowski(points, self.pivots, self.p)
        cell = dist.argmin(axis=1)
        return cell, dist[np.arange(len(points)), cell]

    def learn(self, cells: DataFrame, d: int) -> None:
        """``cells`` has g, cell, far; one row per group and pivot comes back."""
        rows = cells.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()
        for r in rows:
            size, radius = self.summary.setdefault(r["g"], (np.zeros(len(self.pivots)), np.zeros(len(self.pivots))))
            size[r["cell"]], radius[r["cell"]] = r["n"], r["radius"] * (1 + 1e-9) + 1e-12

    def visits(self, points: np.ndarray, groups: list, k: int) -> tuple[np.ndarray, np.ndarray]:
        dist = minkowski(points, self.pivots, self.p)
        out = []
        for row, g in zip(dist, groups):
            if g not in self.summary:
                out.append([])
                continue
            size, radius = self.summary[g]
            used = np.flatnonzero(size)
            reach = row[used] + radius[used]
            order = np.argsort(reach)
            enough = np.searchsorted(np.cumsum(size[used][order]), min(k, size.sum()))
            bound = reach[order][min(enough, len(order) - 1)]
            out.append(used[row[used] - radius[used] <= bound].tolist())
        return _flat(out)

    def score(self, points: np.ndarray, data: np.ndarray) -> np.ndarray:
        return minkowski(points, data, self.p)

    def rough(self, points: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Squared distances from one matrix product, and by how much each row of them may be off."""
        if self.p != 2:
            return None
        a, b = (points * points).sum(axis=1), (data * data).sum(axis=1)
        off = (a + b.max()) * (points.shape[1] + 16) * 1e-15
        return a[:, None] + b[None, :] - 2 * (points @ data.T), off


@dataclass
class Boxes:
    """Clusters as boxes [lo.., hi.., category codes] under the stretch cost of a row.

    Row vectors are [numbers.., category codes].  A category takes as many codes as its
    tree has levels, from the root down; ``tables`` holds its cost by the number of
    codes that agree from the front (one code that costs 1/2 when equal and 1 when not,
    where there is no tree).  Code -1, a generalized category, never equals anything.
    A cell is bounded by its smallest upper and largest lower ends and by the ranges of
    its codes.
    """

    spans: np.ndarray
    weights: np.ndarray
    pivots: np.ndarray | None = None
    summary: dict = field(default_factory=dict)
    tables: list[np.ndarray] | None = None

    @property
    def d(self) -> int:
        return len(self.spans)

    @property
    def places(self) -> np.ndarray:
        return _along(self.pivots)

    def _categories(self) -> list[tuple[float, np.ndarray, slice]]:
        """Weight, cost table and place among the codes of every category."""
        at, out = 0, []
        flat = np.array([1.0, 0.5])
        for w, costs in zip(self.weights[self.d :], self.tables or [flat] * (len(self.weights) - self.d), strict=True):
            out.append((w, costs, slice(at, at + len(costs) - 1)))
            at += len(costs) - 1
        return out

    def _stretch(self, x, lo, hi) -> np.ndarray:
        w = np.where(self.spans > 0, self.weights[: self.d] / np.where(self.spans > 0, self.spans, 1), 0.0)
        return (np.maximum(hi, x) - np.minimum(lo, x)) * w

    def home(self, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mid = lambda b: (b[:, : self.d] + b[:, self.d : 2 * self.d]) / 2 / np.where(self.spans > 0, self.spans, 1)
        cats = lambda b: b[:, 2 * self.d :]
        gap = minkowski(mid(boxes), mid(self.pivots), 1)
        if cats(boxes).shape[1]:
            gap = gap + (cats(boxes)[:, None, :] != cats(self.pivots)[None, :, :]).sum(axis=2)
        cell = gap.argmin(axis=1)
        return cell, gap[np.arange(len(boxes)), cell]

    def learn(self, cells: DataFrame, d: int) -> None:
        width = self.pivots.shape[1]
        rows = (
            cells.groupBy("g", "cell")
            .agg(*[F.min(F.col("v")[i]).alias(f"a{i}") for i in range(width)], *[F.max(F.col("v")[i]).alias(f"z{i}") for i in range(width)])
            .collect()
        )  # one row per pivot
        for r in rows:
            least = np.array([r[f"a{i}"] for i in range(width)])
            most = np.array([r[f"z{i}"] for i in range(width)])
            self.summary.setdefault(r["g"], []).append((r["cell"], least, most))

    def visits(self, points: np.ndarray, groups: list, k: int) -> tuple[np.ndarray, np.ndarray]:
        d, out = self.d, []
        best = self.score(points, self.pivots).min(axis=1)  # pivots are clusters themselves
        cells = self.summary.get("", [])
        names = np.array([c for c, _, _ in cells])
        floor = np.empty((len(points), len(cells)))
        codes = points[:, d:]
        for i, (_, least, most) in enumerate(cells):
            cost = self._stretch(points[:, :d], most[:d], least[d : 2 * d])
            cost = np.maximum(cost, 0).sum(axis=1)
            maybe = (codes >= least[2 * d :]) & (codes <= most[2 * d :]) & (codes >= 0)
            for w, costs, at in self._categories():
                cost = cost + w * costs[np.logical_and.accumulate(maybe[:, at], axis=1).sum(axis=1)]
            floor[:, i] = cost
        for row, b in zip(floor, best):
            out.append(names[row <= b * (1 + 1e-9) + 1e-12].tolist())
        return _flat(out)

    def rough(self, points: np.ndarray, data: np.ndarray) -> None:
        return None

    def score(self, points: np.ndarray, data: np.ndarray) -> np.ndarray:
        d = self.d
        out = np.zeros((len(points), len(data)))
        for j in range(d):
            if self.spans[j] > 0:
                x, lo, hi = points[:, j, None], data[None, :, j], data[None, :, d + j]
                out += self.weights[j] * (np.maximum(hi, x) - np.minimum(lo, x)) / self.spans[j]
        for w, costs, at in self._categories():
            agree, same = np.zeros(out.shape, np.int64), np.ones(out.shape, bool)
            for c in range(at.start, at.stop):
                same &= (points[:, d + c, None] == data[None, :, 2 * d + c]) & (data[None, :, 2 * d + c] >= 0)
                agree += same
            out += w * costs[agree]
        return out


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in values])


def _flat(cells: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of cells as (place of the list, cell)."""
    return np.repeat(np.arange(len(cells)), [len(c) for c in cells]), np.array([x for c in cells for x in c], dtype=int)


def _along(pivots: np.ndarray) -> np.ndarray:
    """Place of every pivot along the widest direction of all."""
    middle = pivots - pivots.mean(axis=0)
    along = np.argsort(middle @ np.linalg.eigh(middle.T @ middle)[1][:, -1], kind="stable")
    place = np.empty(len(along), int)
    place[along] = np.arange(len(along))
    return place


def _packed(place: np.ndarray, sizes: list) -> dict[str, np.ndarray]:
    """Block of every cell, by group; cells follow each other by their ``place``."""
    out: dict[str, np.ndarray] = {}
    block, filled, group = -1, 0, None
    for g, cell, n in sorted(sizes, key=lambda r: (r[0], place[r[1]])):
        if g != group or filled + n > CELL_ROWS:
            block, filled, group = block + 1, 0, g
        out.setdefault(g, np.full(len(place), -1))[cell] = block
        filled += n
    return out


def _by_block(owner: np.ndarray, cell: np.ndarray, block: np.ndarray, n: int) -> list[list[tuple[int, list[int]]]]:
    """Visited cells as lists of (block, its cells), one for each of ``n`` queries."""
    order = np.lexsort((cell, block, owner))
    owner, cell, block = owner[order], cell[order], block[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (block[1:] != block[:-1]))[: len(owner)])
    ends, listed = np.append(first, len(owner)).tolist(), cell.tolist()
    trips = [(b, listed[x:y]) for b, x, y in zip(block[first].tolist(), ends, ends[1:])]
    upto = np.searchsorted(owner[first], np.arange(n + 1)).tolist()
    return [trips[x:y] for x, y in zip(upto, upto[1:])]


def _best(plan, points: np.ndarray, rows: np.ndarray, asks: np.ndarray, ids: np.ndarray, need: int, exclude_self: bool) -> list[tuple]:
    """(query, row, score) of the best rows of each query; ``rows`` are sorted by id."""
    out = []
    step, last = max(1, CHUNK // len(rows)), min(need, len(rows)) - 1
    for i in range(0, len(points), step):
        part = points[i : i + step]
        own = asks[i : i + step, None] == ids[None, :] if exclude_self else None
        if (rough := plan.rough(part, rows)) is not None:  # what may be among the best is measured exactly
            near, off = rough
            if own is not None:
                near[own] = np.inf
            r, c = np.nonzero((near <= (np.partition(near, last, axis=1)[:, last] + 4 * off)[:, None]) & np.isfinite(near))
            score = np.empty(len(r))
            for x in range(0, len(r), CHUNK // 64):
                gap = part[r[x : x + CHUNK // 64]] - rows[c[x : x + CHUNK // 64]]
                score[x : x + CHUNK // 64] = np.sqrt((gap * gap).sum(axis=1))
        else:
            near = plan.score(part, rows)
            if own is not None:
                near[own] = np.inf
            r, c = np.nonzero((near <= np.partition(near, last, axis=1)[:, last][:, None]) & np.isfinite(near))
            score = near[r, c]
        top = _first(r, score, c, need)
        out.append((i + r[top], c[top], score[top]))
    return out


def _first(query: np.ndarray, score: np.ndarray, row: np.ndarray, need: int) -> np.ndarray:
    """Places of the ``need`` best of each query, ties to the smaller row."""
    order = np.lexsort((row, score, query))
    new = np.flatnonzero(np.append(True, query[order][1:] != query[order][:-1])[: len(order)])
    rank = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return order[rank < need]


def search(queries: DataFrame, data: DataFrame, plan, k: int, exclude_self: bool = False) -> DataFrame:
    """The ``k`` best data rows per query row: (qid, did, score, rank), exact, ties to the smaller did.

    ``queries`` has (qid, v, g), ``data`` has (did, v, g); only rows with equal ``g`` meet.
    """
    size = data.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("g").alias("groups"), F.max(F.size("v")).alias("d")).first()
    n_data, d = size["rows"], size["d"]
    names = {"qid": queries.schema["qid"].dataType.simpleString(), "did": data.schema["did"].dataType.simpleString()}
    need = k + int(exclude_self)
    if not n_data:
        return queries.limit(0).selectExpr("qid", f"cast(null as {names['did']}) as did", "cast(0 as double) as score", "1 as rank")
    hashed = data.withColumn("_u", unit_hash("did", "pivot"))
    if isinstance(plan, Metric) and d <= FEW:
        cells = n_data / max(1, size["groups"]) / LEAF_ROWS
        levels = min(MOST_LEVELS, max(0, math.ceil(math.log2(cells)))) if cells > 1 else 0
        wanted = SAMPLED << levels
        found = hashed.filter(F.col("_u") < wanted / n_data).select("v").limit(2 * wanted).collect()  # a few vectors for each cell
        sample = np.array([r["v"] for r in found], float).reshape(-1, d)
        plan = Halved.of(sample[~np.isnan(sample).any(axis=1)], levels, plan.p)
    else:
        picked = hashed.orderBy("_u", "did").limit(max(1, min(MOST_PIVOTS, math.isqrt(n_data)))).select("v").collect()  # at most MOST_PIVOTS vectors
        plan.pivots = np.array([r["v"] for r in picked], float)
    shell = plan

    @F.pandas_udf("cell int, far double")
    def home(v: pd.Series) -> pd.DataFrame:
        if v.empty:
            return pd.DataFrame({"cell": [], "far": []})
        cell, far = shell.home(_matrix(v))
        return pd.DataFrame({"cell": cell.astype("int32"), "far": far})

    cells = materialize(data.withColumn("h", home("v")).select("did", "v", "g", "h.cell", "h.far"))
    plan.learn(cells, d)

    sizes = [tuple(r) for r in cells.groupBy("g", "cell").count().collect()]  # one row per group and pivot
    blocks = _packed(plan.places, [r for r in sizes if r[0] is not None])

    @F.pandas_udf("array<struct<block:int,cells:array<int>>>")
    def visits(v: pd.Series, g: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        owner, cell = shell.visits(_matrix(v), g.tolist(), need)
        block = np.empty(len(owner), int)
        of = g.to_numpy()[owner]
        for name in set(of):
            block[of == name] = blocks[name][cell[of == name]]
        return pd.Series(_by_block(owner, cell, block, len(v)), dtype=object)

    asked = materialize(queries.withColumn("visits", visits("v", "g")))
    trips = asked.select("qid", "v", F.explode("visits").alias("t")).select("qid", "v", "t.block", F.col("t.cells").alias("wanted"))
    listed = [(g, int(c), int(of[c])) for g, of in blocks.items() for c in np.flatnonzero(of >= 0)]
    cells = cells.join(F.broadcast(data.sparkSession.createDataFrame(listed, "g string, cell int, block int")), ["g", "cell"])
    # pieces of a block and tiles of its visitors: a small row per block
    pieces = cells.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("pieces"))
    tiles = trips.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("tiles"))
    grid = materialize(pieces.join(tiles, "block"))
    left = (
        trips.join(grid, "block")
        .withColumn("tile", F.pmod(F.xxhash64("qid"), F.col("tiles")))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
        .select("block", "tile", "piece", "qid", "v", "wanted")
    )
    right = (
        cells.join(grid, "block")
        .withColumn("piece", F.pmod(F.xxhash64("did"), F.col("pieces")))
        .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
        .select("block", "tile", "piece", "did", "v", "cell")
    )
    keys = ["block", "tile", "piece"]

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"qid": a["qid"][:0], "did": b["did"][:0], "score": np.empty(0)})
        b = b.sort_values("did", kind="stable")
        ids, asks = b["did"].to_numpy(), a["qid"].to_numpy()
        points, rows = _matrix(a["v"]), _matrix(b["v"])
        names, cell = np.unique(b["cell"].to_numpy(), return_inverse=True)
        wanted = np.zeros((len(a), len(names)), bool)
        owner, listed = np.repeat(np.arange(len(a)), [len(c) for c in a["wanted"]]), np.concatenate(a["wanted"].to_list())
        at = np.minimum(np.searchsorted(names, listed), len(names) - 1)
        wanted[owner[names[at] == listed], at[names[at] == listed]] = True
        if wanted.mean() > 0.5:  # a row more than needed does no harm
            out = _best(shell, points, rows, asks, ids, need, exclude_self)
        else:
            out = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
            order = np.argsort(cell, kind="stable")
            inside = np.split(order, np.searchsorted(cell[order], np.arange(1, len(names))))
            for c, asked in zip(inside, wanted.T, strict=True):
                r = np.flatnonzero(asked)
                if len(r):
                    out += [(r[x], c[y], score) for x, y, score in _best(shell, points[r], rows[c], asks[r], ids[c], need, exclude_self)]
        r, c, score = (np.concatenate(x) for x in zip(*out, strict=True))
        top = _first(r, score, c, need)
        return pd.DataFrame({"qid": asks[r[top]], "did": ids[c[top]], "score": score[top]})

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        meet, f"qid {names['qid']}, did {names['did']}, score double"
    )
    best = Window.partitionBy("qid").orderBy("score", "did")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def vectorize(df: DataFrame, key: str, cols: list[str], group: str | None = None, name: str = "qid") -> DataFrame:
    """Key and numeric columns as the (id, v, g) form of :func:`search`."""
    g = F.col(group).cast("string") if group else F.lit("")
    return df.select(F.col(key).alias(name), F.array(*[q(c).cast("double") for c in cols]).alias("v"), g.alias("g"))


def from_array(df: DataFrame, key: str, vector: str, group: str | None = None, name: str = "qid") -> DataFrame:
    g = F.col(group).cast("string") if group else F.lit("")
    return df.select(F.col(key).alias(name), F.col(vector).cast("array<double>").alias("v"), g.alias("g"))


def knn_graph(points: DataFrame, k: int, p: float = 2.0) -> DataFrame:
    """Edges (src, dst, rank, dist) to the k nearest other points; ``points`` has (qid, v, g)."""
    out = search(points, points.withColumnRenamed("qid", "did"), Metric(p), k, exclude_self=True)
    return out.select(F.col("qid").alias("src"), F.col("did").alias("dst"), "rank", F.col("score").alias("dist"))


def knn_columns(df: DataFrame, key: str, cols: list[str], k: int, scale: bool = False, p: float = 2.0) -> DataFrame:
    """kNN graph over mixed columns: texts become label codes, numbers optionally standardized."""
    text = [c for c, t in df.select(*cols).dtypes if t == "string"]
    coded = encode.fit_label_codes(df, text).apply(df.select(key, *cols)) if text else df.select(key, *cols)
    if scale:
        coded = encode.fit_standard(coded, cols).apply(coded)
    return knn_graph(vectorize(coded, key, cols), k, p)


def knn_classify(
    train: DataFrame, test: DataFrame, labels: DataFrame, k: int, weights: str = "uniform", p: float = 2.0
) -> DataFrame:
    """Majority label of the k nearest training points: (qid, prediction).

    ``labels`` has (did, label).  ``distance`` weights votes by 1/d; an exact hit
    outvotes everything else.  The smaller label wins ties.
    """
    near = search(test, train, Metric(p), k).join(labels, "did")
    return votes(near, [(k, weights)]).withColumnRenamed("p0", "prediction")


def votes(near: DataFrame, settings: list[tuple[int, str]]) -> DataFrame:
    """(qid, p0, p1, ...): the majority label of the first k neighbours for each (k, weights).

    ``near`` has (qid, label, score, rank) down to the largest k.  A query's nearest
    neighbour shows whether it has an exact hit, so one look serves every k.
    """
    near = near.withColumn("exact", F.min("score").over(Window.partitionBy("qid")) == 0)
    weighted = F.when(F.col("score") == 0, 1.0).when(F.col("exact"), 0.0).otherwise(1.0 / F.col("score"))
    vote = {"uniform": F.lit(1.0), "distance": weighted}
    counted = near.groupBy("qid", "label").agg(*[F.sum(F.when(F.col("rank") <= k, vote[w])).alias(f"v{i}") for i, (k, w) in enumerate(settings)])
    best = [F.min_by("label", F.when(F.col(f"v{i}").isNotNull(), F.struct(-F.col(f"v{i}"), F.col("label")))).alias(f"p{i}") for i in range(len(settings))]
    return counted.groupBy("qid").agg(*best)
