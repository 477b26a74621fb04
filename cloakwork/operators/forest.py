"""Classification and regression forests that never copy the rows per tree.

The rows are written once: values, value buckets, label, and how often each tree draws
the row.  A level of all trees is one pass over them.  Tasks walk every row down the
splits found so far, add up (node, feature, bucket) cells and pass the cells on; a cell
holds the weight, the sum of the label (of a class indicator per class), and the ends
of the values in it.  Sums up to a cell give the gain of every split between two cells
exactly.  A split inside a cell is looked for only where the cell could hold a better
one: the gain is convex in what goes left, so it is bounded by its corners.  Only the
values of such cells are counted one by one.

Nodes of at most ``local_rows`` rows are finished by one task each, many per task; the
more trees there are to be dealt out, the larger these nodes may be.  The driver sees one
row per open node.  Gini gain and variance gain are the same formula:
the squared label sums over the weight, left and right, less the same of the node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.hashing import poisson_hex
from cloakwork.functions.ranks import add_buckets, bucket_count, quantile_bounds
from cloakwork.operators.encode import fit_label_codes
from cloakwork.operators.tree import _subset_of
from cloakwork.session import discard, materialize

LOCAL_ROWS = 20_000  # a small node, times the trees that are grown together
LOCAL_VALUES = 1 << 21  # rows times features of a small node, at most
LOCAL_CODES = 1 << 23  # the same where classes are counted, features and classes together
DRAWS = 500_000  # rows times trees that a task draws
BLOCK_BYTES = 1 << 24  # compiled trees of a larger forest that walk together
WALK_ROWS = 50_000  # rows that walk at once
WALKS = 500_000  # rows times trees that a task walks
FINISHERS = 400  # tasks that finish small nodes
FINISHED = 16  # small nodes that a task finishes one after the other, however few rows they have
LEVEL_CELLS = 1 << 21  # cells of the roots of all trees, at most about
OPEN_NODES = 500_000  # open nodes of the trees grown together, at most about
PIECE_BYTES = 1 << 26  # values of the rows that meet a block, and of the sums that are added up at once
MODEL_BYTES = 1 << 26  # compiled trees that travel to the tasks together
MISSING = 8.9e307  # stands for a null feature, above all values
HELD = 200_000  # cells that a task adds up before it passes them on
HELD_BYTES = 1 << 25  # rows of small nodes that a task packs together
WIDE_BYTES = 1 << 30  # rows of all trees that are worth a look at what holds their values
PACK_BYTES = 1 << 20  # rows of a small node in one value, at most about
SEARCHED = 1 << 24  # cells times classes of a level that are judged at once
COUNTED = 256  # values of a feature that are counted one by one, not sorted, at most
SORTED = 1 << 18  # rows times features that are sorted at once, about
NODES = "tree int, node string, feature int, threshold double, value array<double>, n double"
BLOCKS = "tree int, node string, size long, blob binary"  # nodes below a node, or one split whose children are elsewhere


def at_least(setting: float, rows: int, floor: int) -> int:
    """A least size given as a count, or below 1 as a share of the rows."""
    return max(floor, math.ceil(setting * rows)) if isinstance(setting, float) and setting < 1 else max(floor, int(setting))


def features_of(setting: int | float | str | None, d: int) -> int:
    """How many features a node may look at."""
    if setting is None or setting == "all":
        return d
    if setting in ("sqrt", "log2"):
        return max(1, int(math.sqrt(d) if setting == "sqrt" else math.log2(d)))
    return max(1, min(d, int(setting * d) if isinstance(setting, float) else setting))


def small_node(rows: int, trees: int, width: int, values: int = LOCAL_VALUES) -> int:
    """Rows of a node that one task finishes: the same work a task however many trees there are."""
    return max(LOCAL_ROWS, min(LOCAL_ROWS * trees, values // max(1, width)))


def cell_rows(rows: int, trees: int, d: int) -> int:
    """Rows of a value bucket.  About the square root of all rows: the sums of so few move less than the noise
    of the whole, so bounds leave few buckets in the race."""
    return max(64, math.isqrt(rows), -(-rows * trees * d // LEVEL_CELLS))


def _filled(feature: str) -> Column:
    return F.coalesce(F.col(feature).cast("double"), F.lit(MISSING))


def gains(n: np.ndarray, s: np.ndarray, tn: np.ndarray, ts: np.ndarray) -> np.ndarray:
    """Impurity decrease of putting (n, s) of (tn, ts) to the left; rows of s are label sums.  Rounded, so that
    equal splits compare equal."""
    part = lambda n, s: (s * s).sum(axis=-1) / np.where(n > 0, n, 1.0)
    rest = tn - n
    out = (part(n, s) + part(rest, ts - s) - part(tn, ts)) / tn
    return np.round(np.where((n > 0) & (rest > 0), out, 0.0), 12)


def reach(n0, s0, n, s, tn, ts, lo, hi) -> np.ndarray:
    """No split inside a cell of weight n and sums s, with (n0, s0) before it, gains more.

    One label: what goes left lies in a four-cornered figure, between its least and its
    largest labels; a convex function is largest in a corner.  Several classes: each
    class is bounded by itself, with none or all of it gone left.
    """
    best = np.maximum(gains(n0, s0, tn, ts), gains(n0 + n, s0 + s, tn, ts))
    if s.shape[1] == 1:
        spread = np.where(hi > lo, hi - lo, 1.0)
        for first, other in ((hi, lo), (lo, hi)):
            m = np.clip((s[:, 0] - n * other) / np.where(first > other, spread, -spread), 0.0, n)
            best = np.maximum(best, gains(n0 + m, s0 + (m * first)[:, None], tn, ts))
        return np.where(hi > lo, best, np.maximum(gains(n0, s0, tn, ts), gains(n0 + n, s0 + s, tn, ts)))
    share = lambda a, m: np.where(m > 0, a * a / np.where(m > 0, m, 1.0), 0.0)
    n0, n, tn = n0[:, None], n[:, None], tn[:, None]
    left = np.maximum(share(s0, n0), share(s0 + s, n0 + s))
    after, rest = ts - s0 - s, tn - n0 - n
    right = np.maximum(share(after, rest), share(after + s, rest + s))
    return np.round((left + right).sum(axis=1) / tn[:, 0] - (ts * ts).sum(axis=1) / tn[:, 0] ** 2, 12)


@dataclass
class Splits:
    """The splits of one level by number of its open nodes, and where each side goes on.

    At least 0: number of an open node of the next level; -1: nowhere, a leaf;
    -(2 + i): the small node i.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray


@dataclass
class Growth:
    """What a pass over the rows has to know; travels with the job."""

    d: int
    k: int
    number: bool
    buckets: int
    root: np.ndarray
    levels: list[Splits] = field(default_factory=list)
    allowed: np.ndarray | None = None  # features of each open node, None for all
    wanted: np.ndarray | None = None  # sorted cells whose values are counted one by one
    kinds: tuple[str, ...] | None = None  # the narrowest numbers that hold each feature

    def rows(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(x, buckets, y, w, node): the nodes where the rows of a batch stand, per tree; slices of a batch."""
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            grid = lambda c: part.column(c).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            x, w = grid("x"), grid("w")
            node = np.where(w > 0, self.root[None, :], -1)
            for level in self.levels:
                r, t = np.nonzero(node >= 0)
                s = node[r, t]
                goes = x[r, level.feature[s]] <= level.threshold[s]
                node[r, t] = np.where(goes, level.left[s], level.right[s])
            yield x, grid("b"), part.column("y").to_numpy(), w, node

    def pairs(self, x, b, y, w, node) -> Iterator[tuple]:
        """(cell, value, label, weight) of every row, tree and feature."""
        r, t = np.nonzero(node >= 0)
        slot, weight = node[r, t].astype(np.int64), w[r, t].astype(float)
        for j in range(self.d):
            at = slice(None) if self.allowed is None else np.flatnonzero(self.allowed[slot, j])
            cell = (slot[at] * self.d + j) * self.buckets + b[r[at], j]
            if self.wanted is not None:
                place = np.minimum(np.searchsorted(self.wanted, cell), len(self.wanted) - 1)
                inside = np.flatnonzero(self.wanted[place] == cell)
                at = inside if self.allowed is None else at[inside]
                cell = cell[inside]
            yield cell, x[r[at], j], y[r[at]], weight[at]


def _summed(cell, value, y, w, k: int, number: bool, by_value: bool) -> list[np.ndarray]:
    """Cells (or cells and values) with weight, label sums, ends of values and of labels."""
    order = np.lexsort((value, cell)) if by_value else np.argsort(cell, kind="stable")
    cell, value, y, w = cell[order], value[order], y[order], w[order]
    new = np.append(True, cell[1:] != cell[:-1])
    if by_value:
        new[1:] |= value[1:] != value[:-1]
    first = np.flatnonzero(new)
    if number:
        s = np.add.reduceat(w * y, first)[:, None]
        lo, hi = np.minimum.reduceat(y, first), np.maximum.reduceat(y, first)
    else:
        s = np.bincount((np.cumsum(new) - 1) * k + y.astype(np.int64), w, len(first) * k).reshape(-1, k)
        lo, hi = np.zeros(len(first)), np.ones(len(first))
    return [cell[first], np.add.reduceat(w, first), s, np.minimum.reduceat(value, first), np.maximum.reduceat(value, first), lo, hi]


def _merged(parts: list[list[np.ndarray]], by_value: bool) -> list[np.ndarray]:
    """Cells of several batches as one sorted list."""
    cell, n, s, least, most, lo, hi = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((least, cell)) if by_value else np.argsort(cell, kind="stable")
    cell, n, s, least, most, lo, hi = (c[order] for c in (cell, n, s, least, most, lo, hi))
    new = np.append(True, cell[1:] != cell[:-1])
    if by_value:
        new[1:] |= least[1:] != least[:-1]
    first = np.flatnonzero(new)
    add, low, high = np.add.reduceat, np.minimum.reduceat, np.maximum.reduceat
    return [cell[first], add(n, first), add(s, first, axis=0), low(least, first), high(most, first), low(lo, first), high(hi, first)]


CELLS = "part long, cell long, n double, s array<double>, least double, most double, lo double, hi double"


def _cells(growth: Growth):
    """Cells of the rows of a task; with ``wanted``, one row per value of those cells."""
    by_value, width = growth.wanted is not None, growth.d * growth.buckets

    def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
        cell, n, s, *ends = found
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * s.shape[1]), pa.array(s.ravel()))
        part = cell if by_value else cell // width
        columns = [pa.array(part), pa.array(cell), pa.array(n), listed, *map(pa.array, ends)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CELLS.split(", ")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for rows in growth.rows(batch):
                for cell, value, y, w in growth.pairs(*rows):
                    if len(cell):
                        held.append(_summed(cell, value, y, w, growth.k, growth.number, by_value))
                        size += len(held[-1][0])
                if size > 2 * HELD:
                    held = [_merged(held, by_value)]
                    size = len(held[0][0])
                    if size > HELD:
                        yield batch_of(held[0])
                        held, size = [], 0
        if held:
            yield batch_of(_merged(held, by_value))

    return add


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    n = batch.column("n").to_numpy()
    s = batch.column("s").flatten().to_numpy().reshape(len(n), -1)
    return [batch.column("cell").to_numpy(), n, s, *(batch.column(c).to_numpy() for c in ("least", "most", "lo", "hi"))]


def _groups(batches: Iterator[pa.RecordBatch], by_value: bool) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Merged cells, whole parts at a time; the rows come sorted by part."""
    held: list[tuple[np.ndarray, list[np.ndarray]]] = []

    def whole() -> tuple[np.ndarray, list[np.ndarray]]:
        part = np.concatenate([p for p, _ in held])
        arrays = [np.concatenate(c) for c in zip(*(a for _, a in held), strict=True)]
        return part, arrays

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append((batch.column("part").to_numpy(), _arrays(batch)))
        if held[0][0][0] != held[-1][0][-1]:
            part, arrays = whole()
            cut = int(np.searchsorted(part, part[-1]))
            yield _merged([[a[:cut] for a in arrays]], by_value)
            held = [(part[cut:], [a[cut:] for a in arrays])]
    if held:
        yield _merged([whole()[1]], by_value)


SPLIT = "node long, cell long, gain double, feature int, threshold double, n double, s array<double>, tn double, ts array<double>, inside boolean"


def _best(node, gain, feature, threshold) -> np.ndarray:
    """Places of the best split of each node: largest gain, first feature, lowest threshold."""
    order = np.lexsort((threshold, feature, -gain, node))
    return order[np.append(True, node[order][1:] != node[order][:-1])]


def _rows_of(node, cell, gain, feature, threshold, n, s, tn, ts, inside) -> pa.RecordBatch:
    listed = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))
    columns = [pa.array(node), pa.array(cell), pa.array(gain), pa.array(feature.astype(np.int32)), pa.array(threshold), pa.array(n), listed(s), pa.array(tn), listed(ts)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(node), inside))], [c.split()[0] for c in SPLIT.split(", ")])


def _between(d: int, buckets: int, least_leaf: int):
    """Per node the best split between two cells, and the cells that could hold a better one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, n, s, least, most, lo, hi in _groups(batches, False):
            row = cell // buckets  # node and feature
            node, feature = row // d, row % d
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            run = np.cumsum(np.append(True, row[1:] != row[:-1])) - 1
            before = lambda a: np.cumsum(a, axis=0) - a
            n0, s0 = before(n), before(s)
            n0, s0 = n0 - n0[first][run], s0 - s0[first][run]
            tn, ts = np.add.reduceat(n, first)[run], np.add.reduceat(s, first, axis=0)[run]
            ahead = np.append(row[1:] == row[:-1], False)
            gain = gains(n0 + n, s0 + s, tn, ts)
            fits = ahead & (n0 + n >= least_leaf) & (tn - n0 - n >= least_leaf)
            gain = np.where(fits, gain, 0.0)
            threshold = np.where(ahead, (most + np.append(least[1:], 0.0)) / 2, 0.0)
            best = _best(node, gain, feature, threshold)
            out = (node, cell, gain, feature, threshold, n0 + n, s0 + s, tn, ts)
            yield _rows_of(*(c[best] for c in out), False)
            top = gain[best][np.searchsorted(node[best], node)]
            maybe = np.flatnonzero((most > least) & (reach(n0, s0, n, s, tn, ts, lo, hi) >= np.maximum(top, 1e-12)))
            if len(maybe):
                yield _rows_of(*(c[maybe] for c in (node, cell, gain, feature, threshold, n0, s0, tn, ts)), True)

    return find


def _within(d: int, buckets: int, least_leaf: int, known: dict[str, np.ndarray]):
    """Per cell the best split between two of its values; ``known`` has what stands before each cell."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, n, s, least, _, _, _ in _groups(batches, True):
            at = np.searchsorted(known["cell"], cell)
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            run = np.cumsum(np.append(True, cell[1:] != cell[:-1])) - 1
            n1, s1 = np.cumsum(n), np.cumsum(s, axis=0)
            n1, s1 = n1 - (n1 - n)[first][run] + known["n"][at], s1 - (s1 - s)[first][run] + known["s"][at]
            tn, ts = known["tn"][at], known["ts"][at]
            ahead = np.append(cell[1:] == cell[:-1], False)
            gain = np.where(ahead & (n1 >= least_leaf) & (tn - n1 >= least_leaf), gains(n1, s1, tn, ts), 0.0)
            threshold = (least + np.append(least[1:], 0.0)) / 2
            best = _best(cell, gain, cell, threshold)
            row = cell // buckets
            out = (row // d, cell, gain, row % d, threshold, n1, s1, tn, ts)
            yield _rows_of(*(c[best] for c in out), False)

    return find


# -- small nodes ------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    d: int
    k: int
    number: bool
    min_split: int
    min_leaf: int
    max_depth: int | None
    min_gain: float
    max_features: int
    seed: int
    centre: float

    def ends(self, n: float, s: np.ndarray, depth: int) -> bool:
        """A node is a leaf whatever its rows are."""
        pure = not self.number and s.max() >= n
        return n < self.min_split or n < 2 * self.min_leaf or pure or (self.max_depth is not None and depth >= self.max_depth)

    def value(self, n: float, s: np.ndarray) -> list[float]:
        return [float(v) for v in (s / max(n, 1.0) + (self.centre if self.number else 0.0))]

    def grow(self, tree: int, root: str, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> pa.Table:
        """Nodes of the tree below a small node, a level at a time."""
        if self.number:
            return self._grow_numbers(tree, root, x, y, w)
        ranks = [_ranked(column) for column in x.T]
        bits = [int(w.max()).bit_length(), (self.k - 1).bit_length(), max(len(values) for values, _ in ranks).bit_length()]
        if sum(bits) + (len(w) * self.max_features).bit_length() < 63:
            return self._grow_classes(tree, root, ranks, bits, y.astype(np.int64), w.astype(np.int64))
        return self._grow_sorted(tree, root, x, y, w)

    def _subsets(self, tree: int, names: list[str]) -> np.ndarray:
        """The features that each of the nodes may look at, in order."""
        if self.max_features >= self.d:
            return np.broadcast_to(np.arange(self.d), (len(names), self.d))
        return np.array([_subset_of(self.d, self.max_features, self.seed, tree, name) for name in names]).reshape(len(names), -1)

    def _grow_classes(self, tree: int, root: str, ranks: list, bits: list[int], y: np.ndarray, w: np.ndarray) -> pa.Table:
        """Counts of classes are whole numbers, so rows may be added up in any order: a level is one sort of numbers
        that hold node, feature, place of the value, class and weight of a row, only for the features a node looks at."""
        values = np.concatenate([v for v, _ in ranks])
        start = np.cumsum([0, *(len(v) for v, _ in ranks)])
        code = np.stack([c.astype(np.int32) for _, c in ranks], axis=1).ravel()
        live, node, names, size, depth, out = np.arange(len(w)), np.zeros(len(w), np.int64), [root], 1, len(root) - 1, []
        subsets = self.max_features < self.d
        tail = y << bits[0] | w
        while size:
            ts = np.bincount(node * self.k + y[live], w[live], size * self.k).reshape(size, self.k)
            tn = ts.sum(axis=1)
            deep = self.max_depth is not None and depth >= self.max_depth
            ends = (tn < self.min_split) | (tn < 2 * self.min_leaf) | (ts.max(axis=1) >= tn) | deep
            gain, feature, threshold, cut = np.zeros(size), np.full(size, -1), np.zeros(size), np.zeros(size, np.int32)
            opened = np.flatnonzero(~ends)
            if len(opened):
                stay = ~ends[node]
                live, node = live[stay], node[stay]
                at, base, last = (np.cumsum(~ends) - 1)[node], live * self.d, tail[live]
                looked = self._subsets(tree, [names[i] for i in opened] if subsets else opened)
                rows = np.bincount(at, minlength=len(opened))
                step = max(1, min(SEARCHED // (len(live) * self.k), -(-SORTED // len(live))))
                for a in range(0, looked.shape[1], step):
                    some = looked[:, a : a + step]
                    place = code[base[:, None] + some[at]]
                    many = np.diff(start)[some]
                    counted = many <= np.minimum(rows, COUNTED)[:, None]
                    lines, ways = np.nonzero(counted), []
                    if len(lines[0]):
                        begin = np.cumsum(np.where(counted, many, 0)).reshape(many.shape) - many
                        mine = counted[at]
                        whose = np.repeat(last, mine.sum(axis=1)) if some.shape[1] > 1 else last[mine[:, 0]]
                        cell = (begin[at] + place)[mine] * self.k + (whose >> bits[0])
                        ways.append(self._along_counts(cell, whose & (1 << bits[0]) - 1, lines[0], some[lines], many[lines], values, start, tn[opened], ts[opened]))
                    lines = np.nonzero(~counted)
                    if len(lines[0]):
                        number = np.cumsum(~counted).reshape(many.shape) - 1
                        key = number[at] << bits[2] | place
                        key = key << bits[0] + bits[1] | last[:, None]
                        key = key[~counted[at]] if len(ways) else key.ravel()
                        key.sort()
                        ways.append(self._along_codes(key, bits, lines[0], some[lines], rows[lines[0]], values, start, tn[opened], ts[opened]))
                    for found in ways:
                        better = (found[0] > gain[opened]) | (found[0] == gain[opened]) & (found[0] > 0) & (found[1] < feature[opened])
                        gain[opened[better]], feature[opened[better]], threshold[opened[better]], cut[opened[better]] = (f[better] for f in found)
            split = (feature >= 0) & (gain >= self.min_gain)
            out.append((np.where(split, feature, -1), threshold, ts / np.maximum(tn, 1.0)[:, None], tn))
            stay = split[node]
            live, node = live[stay], node[stay]
            right = code[live * self.d + feature[node]] > cut[node]
            node = 2 * (np.cumsum(split) - 1)[node] + right
            size, depth = 2 * int(split.sum()), depth + 1
            if subsets:
                names = [names[i] + side for i in np.flatnonzero(split) for side in "01"]
        return _grown(out)

    def _along_counts(self, cell, w, node, looked, many, values, start, tn, ts) -> tuple[np.ndarray, ...]:
        """The same as :func:`_along_codes` for lines of ``many`` values each, few enough to count the classes at each."""
        gain, feature, threshold, cut = np.zeros(len(tn)), np.full(len(tn), -1), np.zeros(len(tn)), np.zeros(len(tn), np.int32)
        sums = np.bincount(cell, w, int(many.sum()) * self.k).reshape(-1, self.k)
        held = np.flatnonzero(sums.sum(axis=1) > 0)
        sums, line = sums[held], np.repeat(np.arange(len(many)), many)[held]
        place = held - np.repeat(np.cumsum(many) - many, many)[held]
        ahead = np.flatnonzero(line[1:] == line[:-1])
        if not len(ahead):
            return gain, feature, threshold, cut
        left = np.cumsum(sums, axis=0)
        first = _starts(line)
        left = left[ahead] - (left[first] - sums[first])[line[ahead]]
        line, at = line[ahead], node[line[ahead]]
        right, n, total = ts[at] - left, left.sum(axis=1), tn[at]
        found = ((left * left).sum(axis=1) / n + (right * right).sum(axis=1) / (total - n) - (ts * ts).sum(axis=1)[at] / total) / total
        return self._chosen(found, n, at, looked[line], place[ahead], place[ahead + 1], values, start, tn, (gain, feature, threshold, cut))

    def _chosen(self, found, n, at, looked, here, after, values, start, tn, best) -> tuple[np.ndarray, ...]:
        """Fill in the best split of each node: ``found`` is what each gains, between the places ``here`` and ``after``."""
        gain, feature, threshold, cut = best
        if self.min_leaf > 1:
            found[(n < self.min_leaf) | (tn[at] - n < self.min_leaf)] = 0.0
        if np.isnan(values).any():
            found[~(values[start[looked] + after] > values[start[looked] + here])] = 0.0
        hit, top = _highest(found, at)
        of, j, here, after = at[hit], looked[hit], here[hit], after[hit]
        gain[of], feature[of], cut[of] = top, j, here
        threshold[of] = _halfway(values[start[j] + here], values[start[j] + after])
        return gain, feature, threshold, cut

    def _along_codes(self, key, bits, node, looked, size, values, start, tn, ts) -> tuple[np.ndarray, ...]:
        """Per node the largest gain, its first feature, lowest threshold and the place of the value before it; ``key`` is sorted.

        A line is one feature of one node, with ``size`` rows.  What the squared sums of the classes grow by from row
        to row is known from the weight that the row's own class has before it, so no sums of all classes are needed.
        """
        low, k = lambda n: (1 << n) - 1, self.k
        gain, feature, threshold, cut = np.zeros(len(tn)), np.full(len(tn), -1), np.zeros(len(tn)), np.zeros(len(tn), np.int32)
        w, y, cell = key & low(bits[0]), key >> bits[0] & low(bits[1]), key >> bits[0] + bits[1]
        new = cell[1:] != cell[:-1]
        new[np.cumsum(size)[:-1] - 1] = False
        ahead = np.flatnonzero(new)
        if not len(ahead):
            return gain, feature, threshold, cut
        total = ts.astype(np.int64)[node]  # of a line
        before = lambda a: np.cumsum(a) - a
        order = np.argsort(y.astype(np.uint8 if k <= 256 else np.int64), kind="stable")  # numbers of a byte are counted
        own = np.empty_like(w)
        own[order] = np.cumsum(w[order])
        kind = y * len(size) + np.repeat(np.arange(len(size)), size)
        own -= before(total.T.ravel())[kind]  # weight of the row's class up to it
        squares = np.cumsum(w * (2 * own - w))
        mixed = np.cumsum(w * total.T.ravel()[kind])
        n = np.cumsum(w)
        line = np.repeat(np.arange(len(size)), np.add.reduceat(np.append(new, False), np.cumsum(size) - size, dtype=np.int64))
        at, whole = node[line], (total * total).sum(axis=1)
        begun = before(whole)[line]
        left, both = squares[ahead] - begun, mixed[ahead] - begun
        n = n[ahead] - before(tn.astype(np.int64)[node])[line]
        whole, all_ = whole[line], tn[at]
        found = (left / n + (whole - 2 * both + left) / (all_ - n) - whole / all_) / all_
        here, after = cell[ahead] & low(bits[2]), cell[ahead + 1] & low(bits[2])
        return self._chosen(found, n, at, looked[line], here, after, values, start, tn, (gain, feature, threshold, cut))

    def _grow_numbers(self, tree: int, root: str, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> pa.Table:
        """Rows lie sorted by node and value once per feature, and stay so: a level cuts every node's run of rows in
        two, so what is known of a node is repeated along its rows, not looked up for each of them."""
        names, size, depth, out = [root], 1, len(root) - 1, []
        subsets = self.max_features < self.d
        kept = [(np.arange(len(w), dtype=np.int32), w, w * y)]  # rows, weights and sums, in the order of the rows
        for j in range(self.d):
            order = np.argsort(x[:, j], kind="stable").astype(np.int32)
            kept.append((order, w[order], kept[0][2][order], x[order, j]))
        rows, right = np.array([len(w)]), np.zeros(len(w), bool)
        tn, ts = np.array([w.sum()]), np.add.reduceat(kept[0][2], [0])
        while size:
            deep = self.max_depth is not None and depth >= self.max_depth
            ends = (tn < self.min_split) | (tn < 2 * self.min_leaf) | deep
            feature, threshold = np.full(size, -1), np.zeros(size)
            opened = np.flatnonzero(~ends)
            if len(opened):
                looked = np.ones((len(opened), self.d), bool)
                if subsets:
                    looked[:] = False
                    np.put_along_axis(looked, self._subsets(tree, [names[i] for i in opened]), True, axis=1)
                gain, chosen, half, last = np.zeros(len(opened)), np.full(len(opened), -1), np.zeros(len(opened)), np.zeros(len(opened), np.int64)
                for j in range(self.d):
                    found = self._along(kept[j + 1], rows, looked[:, j], tn[opened], ts[opened])
                    better = found[0] > gain
                    chosen[better] = j
                    for mine, new in zip((gain, half, last), found, strict=True):
                        mine[better] = new[better]
                chosen[gain < self.min_gain] = -1
                feature[opened], threshold[opened] = chosen, half
            split = feature >= 0
            out.append((feature, threshold, (ts / np.maximum(tn, 1.0) + self.centre)[:, None], tn))
            size, depth = 2 * int(split.sum()), depth + 1
            if not size:
                break
            names = [names[i] + side for i in np.flatnonzero(split) for side in "01"] if subsets else names
            first = np.cumsum(rows) - rows
            for j in range(self.d):
                mine = chosen == j
                right[kept[j + 1][0][_ranges(last[mine] + 1, first[mine] + rows[mine])]] = True
            cut = chosen >= 0
            lefts = np.where(cut, last + 1 - first, 0)
            sides = np.stack([lefts, np.where(cut, rows - lefts, 0)], axis=1)
            kept[0] = _parted(kept[0], right, rows, sides)
            counts = sides[cut].ravel()
            begin = np.cumsum(counts) - counts
            tn, ts = np.add.reduceat(kept[0][1], begin), np.add.reduceat(kept[0][2], begin)
            deep = self.max_depth is not None and depth >= self.max_depth
            ends = (tn < self.min_split) | (tn < 2 * self.min_leaf) | deep  # their rows are done with
            goes = np.zeros_like(sides)
            goes[cut] = np.where(ends, 0, counts).reshape(-1, 2)
            kept[1:] = [_parted(k, right, rows, sides, goes) for k in kept[1:]]
            gone = np.repeat(~ends, counts)
            right[:] = False
            kept[0] = tuple(a[gone] for a in kept[0])
            rows = counts[~ends]
        return _grown(out)

    def _along(self, kept, rows, looked, tn, ts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per node the largest gain along one feature, its lowest threshold, and the place of the last row before it."""
        gain, threshold, last = np.zeros(len(tn)), np.zeros(len(tn)), np.zeros(len(tn), np.int64)
        _, w, s, v = kept
        begin = np.cumsum(rows) - rows
        nodes, places = np.arange(len(tn)), None
        if not looked.all():
            nodes = np.flatnonzero(looked)
            if not len(nodes):
                return gain, threshold, last
            places = _ranges(begin[nodes], begin[nodes] + rows[nodes])
            w, s, v, rows, tn, ts = w[places], s[places], v[places], rows[nodes], tn[nodes], ts[nodes]
            begin = np.cumsum(rows) - rows
        new = v[1:] > v[:-1]
        new[begin[1:] - 1] = False
        ahead = np.flatnonzero(new)
        if not len(ahead):
            return gain, threshold, last
        many = np.add.reduceat(np.append(new, False), begin, dtype=np.int64)
        along = lambda a: np.repeat(a, many)
        n, sums = np.cumsum(w), np.cumsum(s)
        n = n[ahead] - along(n[begin] - w[begin])
        sums = sums[ahead] - along(sums[begin] - s[begin])
        total = along(tn)
        rest, after = total - n, along(ts) - sums
        found = sums * sums
        found /= n
        after *= after
        after /= rest
        found += after
        found -= along(ts * ts / tn)
        found /= total
        if self.min_leaf > 1:
            found[(n < self.min_leaf) | (rest < self.min_leaf)] = 0.0
        at = along(np.arange(len(tn)))
        hit, top = _highest(found, at)
        of, place = at[hit], ahead[hit]
        gain[nodes[of]] = top
        threshold[nodes[of]] = _halfway(v[place], v[place + 1])
        last[nodes[of]] = place if places is None else places[place]
        return gain, threshold, last

    def _grow_sorted(self, tree: int, root: str, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> pa.Table:
        """For classes whose rows do not fit a number: rows are sorted once per feature; a level orders those that are
        left by node, so sums that run along the values give the gains of all its nodes at once.
        """
        sums = w[:, None] * (y.astype(np.int64)[:, None] == np.arange(self.k))
        by, node, names, out = np.arange(len(w)), np.zeros(len(w), np.int64), [root], []
        orders = [np.argsort(x[:, j], kind="stable") for j in range(self.d)]
        while names:
            size = len(names)
            first = _starts(node[by])
            tn, ts = np.add.reduceat(w[by], first), np.add.reduceat(sums[by], first, axis=0)
            pure = ts.max(axis=1) >= tn
            deep = self.max_depth is not None and len(names[0]) - 1 >= self.max_depth
            ends = (tn < self.min_split) | (tn < 2 * self.min_leaf) | pure | deep
            allowed = ~ends[:, None] & np.ones(self.d, bool)
            if self.max_features < self.d:
                allowed[:] = False
                for i in np.flatnonzero(~ends):
                    allowed[i, _subset_of(self.d, self.max_features, self.seed, tree, names[i])] = True
            gain, feature, threshold = np.zeros(size), np.full(size, -1), np.zeros(size)
            for j in range(self.d):
                found = self._along_rows(x[:, j], w, sums, orders[j], node, allowed[:, j], tn, ts)
                better = found[0] > gain
                gain, threshold = np.where(better, found[0], gain), np.where(better, found[1], threshold)
                feature[better] = j
            split = (feature >= 0) & (gain >= self.min_gain)
            out.append((np.where(split, feature, -1), threshold, ts / np.maximum(tn, 1.0)[:, None], tn))
            by, *orders = (order[split[node[order]]] for order in (by, *orders))
            here = node[by]
            node[by] = 2 * (np.cumsum(split) - 1)[here] + (x[by, feature[here]] > threshold[here])
            names = [names[i] + side for i in np.flatnonzero(split) for side in "01"]
            by, *orders = (_grouped(order, node, len(names)) for order in (by, *orders))
        return _grown(out)

    def _along_rows(self, v, w, sums, order, node, allowed, tn, ts) -> tuple[np.ndarray, np.ndarray]:
        """Per node the largest gain along one feature, and its lowest threshold; ``order`` is by node and value."""
        gain, threshold = np.zeros(len(tn)), np.zeros(len(tn))
        if not allowed.all():
            order = order[allowed[node[order]]]
        if not len(order):
            return gain, threshold
        at, v = node[order], v[order]
        new = np.append(True, at[1:] != at[:-1])
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        weight, part = w[order], sums[order]
        n, s = np.cumsum(weight), np.cumsum(part, axis=0)
        ahead = np.flatnonzero(~new[1:] & (v[1:] > v[:-1]))
        n = n[ahead] - (n[first] - weight[first])[run[ahead]]
        s = s[ahead] - (s[first] - part[first])[run[ahead]]
        total = tn[at[ahead]]
        fits = (n >= self.min_leaf) & (total - n >= self.min_leaf)
        if not fits.all():
            ahead, n, s, total = ahead[fits], n[fits], s[fits], total[fits]
        if not len(ahead):
            return gain, threshold
        at = at[ahead]
        found = gains(n, s, total, ts[at])
        first = _starts(at)
        top = np.maximum.reduceat(found, first)
        hit = np.flatnonzero(found == np.repeat(top, np.diff(np.append(first, len(at)))))
        hit = hit[_starts(at[hit])]
        gain[at[first]] = top
        threshold[at[first]] = (v[ahead[hit]] + v[ahead[hit] + 1]) / 2
        return gain, threshold


def _starts(run: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.append(True, run[1:] != run[:-1])[: len(run)])


def _ranked(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each row's value among them; whole numbers close together are counted."""
    least, most = column.min(), column.max()
    if not most - least <= 4 * len(column) or not (column == np.floor(column)).all():
        return np.unique(column, return_inverse=True)
    code = (column - least).astype(np.int64)
    held = np.bincount(code) > 0
    return least + np.flatnonzero(held), (np.cumsum(held) - 1)[code]


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from each begin to its end, one after the other."""
    many = end - begin
    return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())


def _halfway(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between two values; the lower one where there is no number between them."""
    half = (a + b) / 2
    return np.where(half < b, half, a)


def _highest(found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of the largest gain of each node with one above 0, and that gain; rounded, so that equal splits compare equal."""
    first = _starts(at)
    top = np.maximum.reduceat(found, first)
    least = top - 2e-12 - 2e-15 * np.abs(top)  # only what may round to the largest one is rounded
    near = np.flatnonzero(found >= np.repeat(least, np.diff(np.append(first, len(at)))))
    rounded, top = np.round(found[near], 12), np.round(top, 12)
    begin = _starts(at[near])
    near = near[rounded == np.repeat(top, np.diff(np.append(begin, len(near))))]
    hit = near[_starts(at[near])]
    return hit[top > 0], top[top > 0]


def _parted(kept: tuple[np.ndarray, ...], right: np.ndarray, rows: np.ndarray, sides: np.ndarray, goes: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The rows of every node cut in two, left ones first; a node has ``rows`` rows, ``sides`` of them on either side, of
    which ``goes``, all or none of a side, go on."""
    goes = sides if goes is None else goes
    side = right[kept[0]]
    after = np.cumsum(goes.ravel()).reshape(-1, 2)
    order = np.empty(int(after[-1, 1]), np.intp)
    for i, mine in enumerate((~side, side)):
        taken = goes[:, i]
        mine &= np.repeat(taken > 0, rows)
        order[_ranges(after[:, i] - taken, after[:, i])] = np.flatnonzero(mine)
    return tuple(a[order] for a in kept)


def _grouped(order: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
    """``order`` by node, otherwise as it is; numbers of two bytes are sorted by their digits."""
    key = node[order]
    return order[np.argsort(key.astype(np.uint16) if nodes <= 1 << 16 else key, kind="stable")]


def _groups_of(d: int, kinds: tuple[str, ...] | None) -> dict[str, list[int]]:
    """The features by the kind of number that holds them."""
    kinds = kinds or ("f8",) * d
    return {kind: [j for j in range(d) if kinds[j] == kind] for kind in sorted(set(kinds))}


def _packed(d: int, kinds: tuple[str, ...] | None = None) -> np.dtype:
    """A row of a small node, as it travels: many rows of a node lie in one binary value."""
    groups = _groups_of(d, kinds)
    name = lambda kind: "x" if len(groups) == 1 else kind
    return np.dtype([*((name(kind), kind, (len(columns),)) for kind, columns in groups.items()), ("y", "f8"), ("w", "i1")])


def _features_in(rows: np.ndarray, d: int, kinds: tuple[str, ...] | None) -> np.ndarray:
    """The features of packed rows."""
    groups = _groups_of(d, kinds)
    if len(groups) == 1:
        return np.ascontiguousarray(rows["x"], np.float64)
    x = np.empty((len(rows), d))
    for kind, columns in groups.items():
        x[:, columns] = rows[kind]
    return x


def _kinds(work: DataFrame, d: int) -> tuple[str, ...]:
    """The narrowest kind of number that holds every value of each feature exactly."""
    both = lambda f, j: f(f"x{j}").alias(f"{f.__name__}{j}")
    as_float = lambda j: F.bool_and(F.col(f"x{j}").cast("float").cast("double") == F.col(f"x{j}")).alias(f"single{j}")
    whole = lambda j: F.bool_and(F.rint(f"x{j}") == F.col(f"x{j}")).alias(f"whole{j}")
    found = work.agg(*[c for j in range(d) for c in (both(F.min, j), both(F.max, j), as_float(j), whole(j))]).first()

    def kind(j: int) -> str:
        if found[f"whole{j}"]:
            for name in ("i1", "i2", "i4"):
                if np.iinfo(name).min <= found[f"min{j}"] and found[f"max{j}"] <= np.iinfo(name).max:
                    return name
        return "f4" if found[f"single{j}"] else "f8"

    return tuple(kind(j) for j in range(d))


def _small_rows(growth: Growth):
    """Rows of the small nodes, packed: (small, rows)."""
    kind, groups = _packed(growth.d, growth.kinds), _groups_of(growth.d, growth.kinds)
    most = max(1, PACK_BYTES // kind.itemsize)

    def batch_of(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        small, rows = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(small, kind="stable")
        small, rows = small[order], rows[order]
        first = _starts(small)
        run = np.diff(np.append(first, len(small)))
        cut = np.concatenate([np.arange(a, a + n, most) for a, n in zip(first, run, strict=True)])
        ends = np.append(cut, len(small)).astype(np.int32) * kind.itemsize
        packed = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(small[cut]), packed], ["small", "rows"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for x, _, y, w, node in growth.rows(batch):
                r, t = np.nonzero(node <= -2)
                if len(r):
                    rows = np.empty(len(r), kind)
                    for name, columns in groups.items():
                        part = x if len(columns) == growth.d else x[:, columns]
                        rows["x" if len(groups) == 1 else name] = part.astype(name)[r]
                    rows["y"], rows["w"] = y[r], w[r, t]
                    held.append((-2 - node[r, t].astype(np.int64), rows))
                    size += rows.nbytes
                if size > HELD_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    return send


def _finish(rules: Rules, small: list[tuple[int, str]], kinds: tuple[str, ...] | None):
    def finish(blocks: pa.Table) -> pa.Table:
        tree, node = small[blocks.column("small")[0].as_py()]
        rows = np.frombuffer(b"".join(blocks.column("rows").to_pylist()), _packed(rules.d, kinds))
        x, y, w = _features_in(rows, rules.d, kinds), np.ascontiguousarray(rows["y"]), rows["w"].astype(float)
        if rules.number:  # the order of the rows must not decide: equal values are split alike, sums are rounded where compared
            order = np.lexsort((w, y, *x.T[::-1]))
            x, y, w = x[order], y[order], w[order]
        got = rules.grow(tree, node, x, y, w)
        columns = [got.column(c).to_numpy() for c in ("feature", "threshold", "n")]
        blob = _block(*columns, got.column("value").combine_chunks().flatten().to_numpy())
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": [node], "size": [got.num_rows], "blob": pa.array([blob], pa.binary())})

    return finish


def _grown(levels: list[tuple]) -> pa.Table:
    """Nodes level by level, the two children of every split in its order; ``feature`` is -1 at a leaf."""
    feature, threshold, value, n = (np.concatenate(c) for c in zip(*levels, strict=True))
    listed = pa.FixedSizeListArray.from_arrays(pa.array(value.ravel()), value.shape[1])
    return pa.table([pa.array(feature.astype(np.int32)), pa.array(np.where(feature < 0, 0.0, threshold)), pa.array(n), listed], ["feature", "threshold", "n", "value"])


def _block(feature: np.ndarray, threshold: np.ndarray, n: np.ndarray, value: np.ndarray) -> bytes:
    """Nodes as :func:`_grown` puts them, without their paths, which grow with the depth."""
    kinds = (np.int32, np.float64, np.float64, np.float64)
    return b"".join(np.ascontiguousarray(p, kind).tobytes() for p, kind in zip((feature, threshold, n, value), kinds, strict=True))


def _arrays_of(size: int, blob: bytes) -> tuple[np.ndarray, ...]:
    """Feature, threshold, size and value of the nodes of a block."""
    numbers = np.frombuffer(blob, np.float64, offset=4 * size)
    return np.frombuffer(blob, np.int32, size), numbers[:size], numbers[size : 2 * size], numbers[2 * size :].reshape(size, -1)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node, with its path."""
    for batch in batches:
        for tree, root, size, blob in zip(*(batch.column(c).to_pylist() for c in ("tree", "node", "size", "blob")), strict=True):
            feature, threshold, n, value = _arrays_of(size, blob)
            names, at = [root], 0
            if size > 1:  # a split that stands alone has its children in other blocks
                for goes_on in (feature >= 0).tolist():
                    if goes_on:
                        names += [names[at] + "0", names[at] + "1"]
                    at += 1
            columns = [
                pa.array(np.full(size, tree, np.int32)),
                pa.array(names, pa.string()),
                pa.array(feature),
                pa.array(threshold, mask=feature < 0),
                pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * value.shape[1]), pa.array(value.ravel())),
                pa.array(n),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")])


# -- fitting ----------------------------------------------------------------------------


def draws(key: str, trees: int, seed: int) -> Column:
    """How often each tree draws a row: an array of Poisson counts by a hash of the key, a byte a tree."""
    name = F.col(key).cast("string")
    # hashed once, then compared: an expression inside a lambda is worked out wherever it stands
    names = F.array(*[F.lit(f"{t + seed}|bootstrap") for t in range(trees)])
    hashed = F.transform(names, lambda t: F.md5(F.concat_ws(":", name, t)))
    return F.transform(hashed, lambda h: poisson_hex(h))


def with_draws(df: DataFrame, key: str, trees: int, seed: int, name: str) -> DataFrame:
    """Add the :func:`draws` of each row, dealt out so that a task makes about DRAWS of them; a written table."""
    df = materialize(df)
    return materialize(df.repartition(max(1, -(-df.count() * trees // DRAWS))).withColumn(name, draws(key, trees, seed)))


def fit(
    df: DataFrame,
    key: str,
    features: list[str],
    label: str,
    kind: str = "class",
    trees: int = 100,
    max_depth: int | None = None,
    min_split: float = 2,
    min_leaf: float = 1,
    min_gain: float = 0.0,
    max_features: int | float | str | None = None,
    seed: int = 42,
    bootstrap: bool = True,
    local_rows: int | None = None,
    per_bucket: int | None = None,
    drawn: str | None = None,
) -> Forest:
    """A forest of ``kind`` class (gini) or number (variance).

    ``min_split`` and ``min_leaf`` are weights of a node, or shares of all rows where
    they are floats below 1.  A tree draws a row by a hash of its key as often as a
    Poisson draw of mean one says (exactly once without ``bootstrap``); ``max_features``
    picks the features of a node by a hash of tree and node.  Ties go to the first
    feature and the lowest threshold.  Null features count as the largest value.  The
    result does not depend on partitioning, ``local_rows`` or ``per_bucket``, which only
    decide how the work is cut, except where sums of doubles round differently.
    ``drawn`` names a column with the :func:`draws` of at least these trees, where several
    forests share them.
    """
    spark, d, number = df.sparkSession, len(features), kind == "number"
    if kind not in ("class", "number"):
        raise ValueError(f"unknown kind {kind}: choose class or number")
    df = df.filter(F.col(label).isNotNull())
    rows = df.count()
    codes = None
    if number:
        centre = df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
        work, k = df.withColumn("_y", F.col(label).cast("double") - F.lit(centre)), 1
    else:
        centre, codes = 0.0, fit_label_codes(df, [label])
        coded = codes.apply(df.select(key, *features, label, *([drawn] if drawn else [])))
        work, k = coded.withColumn("_y", F.col(label).cast("double")), codes.tables[label].count()
    asked = F.slice(drawn, 1, trees) if drawn else F.lit(None)
    work = work.select(F.col(key).cast("string").alias("id"), "_y", asked.alias("_w"), *[_filled(f).alias(f"x{i}") for i, f in enumerate(features)])
    local_rows = small_node(rows, trees, d + k, LOCAL_VALUES if number else LOCAL_CODES) if local_rows is None else local_rows
    buckets = 1 if rows <= local_rows else bucket_count(rows, per_bucket or cell_rows(rows, trees, d))  # a whole tree is finished in a task
    kinds = _kinds(work, d) if 8 * d * rows * trees > WIDE_BYTES else None
    work = add_buckets(work, quantile_bounds(work, [f"x{i}" for i in range(d)], buckets))
    work = work.repartition(max(1, -(-rows * trees // DRAWS)))
    once = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.lit(1).cast("byte"))
    data = materialize(
        work.select(
            F.col("_y").alias("y"),
            F.array(*[f"x{i}" for i in range(d)]).alias("x"),
            F.array(*[F.col(f"x{i}__b").cast("int") for i in range(d)]).alias("b"),
            (once if not bootstrap else F.col("_w") if drawn else draws("id", trees, seed)).alias("w"),
        )
    )
    rules = Rules(
        d, k, number, at_least(min_split, rows, 2), at_least(min_leaf, rows, 1), max_depth, min_gain, features_of(max_features, d), seed, centre
    )
    together = max(1, min(trees, OPEN_NODES * local_rows // max(1, rows)))
    found = [_grow_trees(spark, data, rules, list(range(a, min(a + together, trees))), trees, rows, buckets, local_rows, kinds) for a in range(0, trees, together)]
    blocks = found[0]
    for part in found[1:]:
        blocks = blocks.unionByName(part)
    discard(data)
    return Forest(tuple(features), trees, kind, codes.tables[label] if codes else None, blocks, k)


def _grow_trees(spark, data: DataFrame, rules: Rules, numbers: list[int], trees: int, rows: int, buckets: int, local_rows: int, kinds: tuple[str, ...] | None) -> DataFrame:
    """The nodes of some of the trees, in blocks, as a written table."""
    small: list[tuple[int, str]] = []
    done: list[tuple] = []
    root = np.full(trees, -1, np.int64)
    nodes: list[tuple[int, str]] = []
    for t in numbers:
        if rows <= local_rows:
            root[t] = -2 - len(small)
            small.append((t, "r"))
        else:
            root[t] = len(nodes)
            nodes.append((t, "r"))
    growth = Growth(rules.d, rules.k, rules.number, buckets, root, kinds=kinds)
    while nodes:
        if rules.max_features < rules.d:
            growth.allowed = np.zeros((len(nodes), rules.d), bool)
            for i, (t, node) in enumerate(nodes):
                growth.allowed[i, _subset_of(rules.d, rules.max_features, rules.seed, t, node)] = True
        nodes = _level(data, growth, rules, nodes, small, done, local_rows)
    growth.allowed = None
    alone = lambda tree, node, feature, threshold, value, n: (tree, node, 1, _block([feature], [threshold or 0.0], [n], [value]))
    upper = spark.createDataFrame([alone(*r) for r in done], BLOCKS) if done else None
    if small:
        sent = data.select("x", "b", "y", "w").mapInArrow(_small_rows(growth), "small long, rows binary")
        sent = sent.repartition(min(FINISHERS, max(-(-len(small) // FINISHED), min(len(small), rows * len(numbers) // DRAWS * 3))), "small")
        lower = sent.groupBy("small").applyInArrow(_finish(rules, small, growth.kinds), BLOCKS)
        upper = lower if upper is None else upper.unionByName(lower)
    return materialize(upper)


def _level(data, growth: Growth, rules: Rules, nodes: list, small: list, done: list, local_rows: int) -> list[tuple[int, str]]:
    """One pass: the splits of all open nodes; returns the open nodes of the next level."""
    rows = data.select("x", "b", "y", "w")

    def dealt(found: DataFrame, find) -> DataFrame:
        return found.repartition("part").sortWithinPartitions("part", "cell").mapInArrow(find, SPLIT)

    growth.wanted = None
    edges = materialize(dealt(rows.mapInArrow(_cells(growth), CELLS), _between(rules.d, growth.buckets, rules.min_leaf)))
    best = {r["node"]: r for r in edges.filter("not inside").collect()}  # one row per open node
    maybe = edges.filter("inside").orderBy("cell").toPandas()  # cells of open nodes that may win, without their values
    if len(maybe):
        known = {c: maybe[c].to_numpy() for c in ("cell", "n", "tn")} | {c: np.stack(maybe[c].to_numpy()) for c in ("s", "ts")}
        growth.wanted = known["cell"]
        inner = dealt(rows.mapInArrow(_cells(growth), CELLS), _within(rules.d, growth.buckets, rules.min_leaf, known))
        for r in inner.collect():  # one row per such cell
            old = best[r["node"]]
            if (-r["gain"], r["feature"], r["threshold"]) < (-old["gain"], old["feature"], old["threshold"]):
                best[r["node"]] = r
    discard(edges)
    size = len(nodes)
    level = Splits(np.zeros(size, np.int64), np.zeros(size), np.full(size, -1), np.full(size, -1))
    ahead: list[tuple[int, str]] = []
    for i, (tree, node) in enumerate(nodes):
        split = best.get(i)
        if split is None:  # nothing was drawn
            done.append((tree, node, -1, None, [0.0] * rules.k, 0.0))
            continue
        tn, ts = split["tn"], np.array(split["ts"])
        depth = len(node) - 1
        if rules.ends(tn, ts, depth) or split["gain"] <= 0 or split["gain"] < rules.min_gain:
            done.append((tree, node, -1, None, rules.value(tn, ts), tn))
            continue
        done.append((tree, node, split["feature"], split["threshold"], rules.value(tn, ts), tn))
        level.feature[i], level.threshold[i] = split["feature"], split["threshold"]
        n, s = split["n"], np.array(split["s"])
        for side, goes, cn, cs in (("0", level.left, n, s), ("1", level.right, tn - n, ts - s)):
            if rules.ends(cn, cs, depth + 1):
                done.append((tree, node + side, -1, None, rules.value(cn, cs), cn))
            elif cn <= local_rows:
                goes[i] = -2 - len(small)
                small.append((tree, node + side))
            else:
                goes[i] = len(ahead)
                ahead.append((tree, node + side))
    growth.levels.append(level)
    return ahead


# -- using a forest ---------------------------------------------------------------------


def _compiled(rows: pa.Table) -> pa.Table:
    """A tree as flat arrays: feature (-1 at a leaf), threshold, both children, size, value; the root comes first."""
    paths, sizes, blobs = (rows.column(c).to_pylist() for c in ("node", "size", "blob"))
    order = sorted(range(len(paths)), key=paths.__getitem__)
    begin = dict(zip((paths[i] for i in order), np.cumsum([0, *(sizes[i] for i in order)]).tolist()))
    feature, threshold, n, value = (np.concatenate(c) for c in zip(*(_arrays_of(sizes[i], blobs[i]) for i in order), strict=True))
    left, right = np.arange(len(feature), dtype=np.int32), np.arange(len(feature), dtype=np.int32)
    for i in order:
        at, path = begin[paths[i]], paths[i]
        if sizes[i] > 1:  # the two children of every split, in its order
            parents = at + np.flatnonzero(feature[at : at + sizes[i]] >= 0)
            left[parents] = at + 1 + 2 * np.arange(len(parents))
            right[parents] = left[parents] + 1
        elif feature[at] >= 0:
            left[at], right[at] = begin[path + "0"], begin[path + "1"]
    blob = b"".join(np.ascontiguousarray(p).tobytes() for p in (feature, left, right, threshold, n, value))
    return pa.table({"tree": pa.array([rows.column("tree")[0].as_py()], pa.int32()), "size": [len(feature)], "blob": pa.array([blob], pa.binary())})


class Tree:
    def __init__(self, size: int, blob: bytes):
        self.feature, self.left, self.right = np.frombuffer(blob, np.int32, 3 * size).reshape(3, size)
        numbers = np.frombuffer(blob, np.float64, offset=12 * size)
        self.threshold, self.n, self.value = numbers[:size], numbers[size : 2 * size], numbers[2 * size :].reshape(size, -1)

    def values(self, x: np.ndarray, settings: list[tuple[int | None, int]]) -> list[np.ndarray]:
        """The value of every row where the walk stops, for each (deepest level, least size of a split node).

        Sizes only fall on the way down, so a row that has come to a small node has stopped for good.
        """
        flat, d = np.ascontiguousarray(x).ravel(), x.shape[1]
        node, live = np.zeros(len(x), np.int32), np.arange(len(x))
        base, here, level = live * d, node, 0
        # every split node has two rows or more
        small = {least: (np.zeros(len(x), np.int32), np.ones(len(x), bool)) for _, least in settings if least > 2}
        stops: dict[tuple[int | None, int], np.ndarray] = {}

        def at(least: int) -> np.ndarray:
            return np.where(small[least][1], node, small[least][0]) if least > 2 else node.copy()

        while True:
            for deep, least in settings:
                if deep == level:
                    stops[(deep, least)] = at(least)
            feature = self.feature[here]
            on = np.flatnonzero(feature >= 0)
            if not len(on):
                break
            if len(on) < len(live):
                live, base, here, feature = live[on], base[on], here[on], feature[on]
            for least, (stopped, goes_on) in small.items():
                ends = live[(self.n[here] < least) & goes_on[live]]
                stopped[ends], goes_on[ends] = node[ends], False
            here = np.where(flat[base + feature] <= self.threshold[here], self.left[here], self.right[here])
            node[live] = here
            level += 1
        return [self.value[stops[s] if s in stops else at(s[1])] for s in settings]


def _sums(trees: list[tuple[int, int, bytes]], x: np.ndarray, settings: list[tuple[int, int | None, int]]) -> np.ndarray:
    """Summed values of every row for each setting, side by side; a tree is (number, size, blob), in the order of the numbers."""
    walks = sorted({(deep, least) for _, deep, least in settings}, key=str)
    running, total = None, [None] * len(settings)
    for number, size, blob in trees:
        tree = Tree(size, blob)
        if running is None:
            running = {walk: np.zeros((len(x), tree.value.shape[1])) for walk in walks}
        for i, (most, deep, least) in enumerate(settings):
            if number >= most and total[i] is None:  # its last tree is behind
                total[i] = running[(deep, least)].copy()
        for walk, got in zip(walks, tree.values(x, walks), strict=True):
            running[walk] += got
    total = [running[(deep, least)] if sums is None else sums for sums, (_, deep, least) in zip(total, settings, strict=True)]
    return np.stack(total, axis=1).reshape(len(x), -1)


def _judged(sums: np.ndarray, settings: list[tuple[int, int | None, int]], number: bool) -> np.ndarray:
    """For each setting the mean of its trees, or the code of the class of the largest sum, the first on ties."""
    sums = sums.reshape(len(sums), len(settings), -1)
    if number:
        return sums[:, :, 0] / np.array([float(s[0]) for s in settings])
    return np.floor(sums * 1e9 + 0.5).argmax(axis=2).astype(np.float64)


def _adder(trees: list[tuple[int, int, bytes]], settings: list[tuple[int, int | None, int]], number: bool):
    def add(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(list(_judged(_sums(trees, np.stack(vectors.to_numpy()), settings), settings, number)) if len(vectors) else [], dtype=object)

    return add


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch packed by piece: every block is sent a few values, not every row."""
    for batch in batches:
        if batch.num_rows:
            ids, piece = batch.column("_row").to_numpy(), batch.column("piece").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            order = np.argsort(piece, kind="stable")
            parts = np.split(order, _starts(piece[order])[1:])
            columns = [pa.array([piece[p[0]] for p in parts], pa.int32()), *(pa.array([a[p].tobytes() for p in parts], pa.binary()) for a in (ids, x))]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "ids", "x"])


def _walker(settings: list[tuple[int, int | None, int]], most: int):
    """Sums over the trees of a block, at most ``most`` rows of a piece in one value."""

    def walk(rows: pa.Table, trees: pa.Table) -> pa.Table:
        if not (rows.num_rows and trees.num_rows):
            rows = rows.slice(0, 0)
        ids, x = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in (("ids", np.int64), ("x", np.float64)))
        x, out = x.reshape(len(ids), -1) if len(ids) else x, []
        order = np.argsort(ids)  # the rows of a piece, cut alike in every block
        listed = sorted(zip(*(trees.column(c).to_pylist() for c in ("tree", "size", "blob")), strict=True))
        for a in range(0, len(order), WALK_ROWS):
            some = order[a : a + WALK_ROWS]
            sums = _sums(listed, x[some], settings)
            for b in range(0, len(some), most):
                out.append((a + b, ids[some[b : b + most]].tobytes(), np.ascontiguousarray(sums[b : b + most]).tobytes()))
        tag = lambda c: pa.array([rows.column(c)[0].as_py()] * len(out) if out else [], pa.int32())
        cut, rows_, parts = zip(*out) if out else ([], [], [])
        return pa.table({"piece": tag("piece"), "cut": pa.array(cut, pa.int64()), "block": tag("block"), "rows": pa.array(rows_, pa.binary()), "part": pa.array(parts, pa.binary())})

    return walk


def _gathered(settings: list[tuple[int, int | None, int]], number: bool):
    """The sums of all blocks, added up in their order, and what they say."""

    def gather(parts: pa.Table) -> pa.Table:
        ids = np.frombuffer(parts.column("rows")[0].as_py(), np.int64)
        total = None
        for _, part in sorted(zip(parts.column("block").to_pylist(), parts.column("part").to_pylist(), strict=True)):
            sums = np.frombuffer(part, np.float64)
            total = sums if total is None else total + sums
        judged = _judged(total.reshape(len(ids), -1), settings, number)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * judged.shape[1]), pa.array(judged.ravel()))
        return pa.table({"_row": pa.array(ids), "found": listed})

    return gather


@dataclass(frozen=True)
class Forest:
    """Fitted trees: ``blocks`` of nodes, ``labels`` (value, code) of the classes."""

    features: tuple[str, ...]
    trees: int
    kind: str
    labels: DataFrame | None
    blocks: DataFrame
    width: int

    @property
    def nodes(self) -> DataFrame:
        """One row per node: (tree, node, feature, threshold, value, n); ``node`` is the path from the root."""
        return self.blocks.mapInArrow(_unpacked, NODES)

    def judged(self, df: DataFrame, settings: list[tuple[int, int | None, int]], name: str = "_found") -> DataFrame:
        """Add an array with, for each (trees, deepest level, least split size), the mean or the class code that the
        first trees say.

        A tree cut at a level, or where nodes get small, is the tree that would have
        been grown so: splits do not depend on either.  One walk answers all settings.
        A forest of at most MODEL_BYTES travels to the rows; of a larger one, blocks of
        trees meet pieces of the rows.
        """
        number = self.kind == "number"
        vector = F.array(*[_filled(f) for f in self.features])
        size = self.blocks.agg(F.sum("size")).first()[0] or 0
        blocks = self.blocks.repartition(max(1, min(self.trees, FINISHERS, size // DRAWS * 4)), "tree")
        compiled = materialize(blocks.groupBy("tree").applyInArrow(_compiled, "tree int, size long, blob binary"))
        if (compiled.agg(F.sum(F.length("blob"))).first()[0] or 0) <= MODEL_BYTES:
            trees = sorted((r["tree"], r["size"], r["blob"]) for r in compiled.collect())  # at most MODEL_BYTES
            spread = df.repartition(max(1, -(-df.count() * self.trees // WALKS)))
            # else the filter that Spark puts before an explode walks once more
            walk = F.pandas_udf(_adder(trees, settings, number), "array<double>").asNondeterministic()
            return spread.withColumn(name, walk(vector))
        sizes = compiled.select("tree", F.length("blob").alias("bytes")).collect()  # two numbers a tree
        block, filled, of = 0, 0, [0] * self.trees
        for tree, size in sorted(tuple(r) for r in sizes):
            if filled and filled + size > BLOCK_BYTES:
                block, filled = block + 1, 0
            of[tree], filled = block, filled + size
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
        # rows are mostly smaller than the trees: a piece is as large as a task can take
        pieces = max(1, -(-rows.count() * 8 * len(self.features) // PIECE_BYTES))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        asked = rows.select("_row", vector.alias("x"), F.pmod(F.xxhash64("_row"), F.lit(pieces)).cast("int").alias("piece"))
        asked = asked.mapInArrow(_chunked, "piece int, ids binary, x binary").withColumn("block", every(block + 1))
        blocks = compiled.withColumn("block", F.get(F.array(*[F.lit(b) for b in of]), F.col("tree"))).withColumn("piece", every(pieces))
        pairs = (block + 1) * pieces
        met = [t.repartition(min(pairs, FINISHERS), "block", "piece").groupBy("block", "piece") for t in (asked, blocks)]
        most = max(1, PIECE_BYTES // (8 * self.width * len(settings) * (block + 1)))
        walked = met[0].cogroup(met[1]).applyInArrow(_walker(settings, most), "piece int, cut long, block int, rows binary, part binary")
        found = walked.groupBy("piece", "cut").applyInArrow(_gathered(settings, number), "_row long, found array<double>")
        return rows.join(found.withColumnRenamed("found", name), "_row").drop("_row")

    def predict_settings(self, df: DataFrame, settings: list[tuple[int, int | None, int]]) -> DataFrame:
        """Rows times settings: adds ``setting`` (its place) and ``prediction``."""
        each = self.judged(df, settings).select(*df.columns, F.posexplode("_found").alias("setting", "_code"))
        if self.labels is None:
            return each.withColumnRenamed("_code", "prediction")
        named = each.withColumn("_code", F.col("_code").cast("int")).join(self.labels.select(F.col("value").alias("prediction"), F.col("code").alias("_code")), "_code", "left")
        return named.select(*df.columns, "setting", "prediction")

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``: the mean of all trees, or the class of the largest mean share (the first on ties)."""
        return self.predict_settings(df, [(self.trees, None, 0)]).drop("setting")


def best_split(df: DataFrame, features: list[str], label: str, kind: str = "class", min_leaf: float = 1) -> DataFrame:
    """(column, threshold, gain, n_left, n) of the best split of all rows; no row where nothing gains."""
    spark, d = df.sparkSession, len(features)
    keyed = df.select(*features, label).withColumn("_key", F.lit(0))
    forest = fit(keyed, "_key", features, label, kind, 1, 1, 2, min_leaf, bootstrap=False, local_rows=0)
    nodes = {r["node"]: r for r in forest.nodes.collect()}  # three at most
    top = nodes.get("r")
    if top is None or top["feature"] < 0:
        return spark.createDataFrame([], "column string, threshold double, gain double, n_left double, n double")
    centred = lambda r: np.array(r["value"]) * r["n"]
    gain = float(gains(np.array(nodes["r0"]["n"]), centred(nodes["r0"]), np.array(top["n"]), centred(top)))
    row = (features[top["feature"]], top["threshold"], gain, nodes["r0"]["n"], top["n"])
    return spark.createDataFrame([row], "column string, threshold double, gain double, n_left double, n double")
