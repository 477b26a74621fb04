"""Local recoding and microaggregation by greedy clusters of at least k rows.

Greedy growth is sequential, so it runs inside blocks, many at a time: either those of
a given column, or the classes of relaxed median splits, which hold similar rows.
Bounds and weights are global, so costs of different blocks are comparable.

A category without a tree costs half its weight where all values of a cluster are
equal, else all of it.  With a tree it costs the share of the levels that are lost by
going up to the common ancestor; the cluster's value is that ancestor.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakwork.operators import encode, hierarchy
from cloakwork.operators.clean import clip_to
from cloakwork.operators.encode import q
from cloakwork.operators.mondrian import mondrian
from cloakwork.operators.nearest import Boxes, search
from cloakwork.operators.profile import bounds_of, mode_of
from cloakwork.session import materialize


def level_costs(levels: int) -> np.ndarray:
    """Cost of a tree category by the number of levels, root included, that cluster and row share."""
    shared = np.arange(levels + 2)
    return np.where(shared > 1, (levels - (shared - 1)) / max(1, levels), 1.0) * (levels > 0)


class Stretch:
    """What it costs rows to join a cluster.

    A cluster is (lo, hi, c, nodes): the ends of its numbers, its plain category codes
    (-1 where they differ), and per tree the path of its node with -1 below it.
    """

    def __init__(self, num: np.ndarray, cat: np.ndarray, paths: list[np.ndarray], tables: list[np.ndarray], spans: np.ndarray, weights: np.ndarray):
        d, flat = num.shape[1], cat.shape[1]
        self.num, self.cat, self.paths, self.tables = num, cat, paths, tables
        self.wn = np.where(spans > 0, weights[:d] / np.where(spans > 0, spans, 1), 0.0)
        self.wc, self.wt = weights[d : d + flat], weights[d + flat :]

    def start(self, row: int) -> tuple:
        return self.num[row].copy(), self.num[row].copy(), self.cat[row].copy(), [p[row].copy() for p in self.paths]

    @staticmethod
    def _shared(paths: np.ndarray, node: np.ndarray) -> np.ndarray:
        return np.logical_and.accumulate((paths == node) & (node >= 0), axis=-1)

    def cost(self, rows: np.ndarray | int, lo, hi, c, nodes) -> np.ndarray:
        out = (np.maximum(hi, self.num[rows]) - np.minimum(lo, self.num[rows])) @ self.wn
        out = out + np.where((self.cat[rows] == c) & (c >= 0), 0.5, 1.0) @ self.wc
        for w, table, path, node in zip(self.wt, self.tables, self.paths, nodes, strict=True):
            out = out + w * table[self._shared(path[rows], node).sum(axis=-1)]
        return out

    def grown(self, row: int, lo, hi, c, nodes) -> tuple:
        up = [np.where(self._shared(p[row], node), node, -1) for p, node in zip(self.paths, nodes, strict=True)]
        return np.minimum(lo, self.num[row]), np.maximum(hi, self.num[row]), np.where(self.cat[row] == c, c, -1), up


def greedy(stretch: Stretch, k: int, leftover: str) -> np.ndarray:
    """Cluster number per row, rows in id order.

    The next free row starts a cluster; the free row that stretches it least joins
    (first row on ties) until it has k rows.  ``leftover``: ``keep`` leaves a short
    last cluster, ``merge`` moves its rows into their cheapest other cluster.
    """
    n = len(stretch.num)
    label = np.full(n, -1)
    made = []
    for seed in range(n):
        if label[seed] >= 0:
            continue
        state = stretch.start(seed)
        label[seed] = len(made)
        for _ in range(k - 1):
            free = np.flatnonzero(label < 0)
            if not len(free):
                break
            pick = free[np.argmin(stretch.cost(free, *state))]
            label[pick] = label[seed]
            state = stretch.grown(pick, *state)
        made.append(state)
    last = len(made) - 1
    short = np.flatnonzero(label == last)
    if leftover == "merge" and last > 0 and len(short) < k:
        lo, hi, c = (np.array([m[i] for m in made[:-1]]) for i in range(3))
        nodes = [np.array([m[3][t] for m in made[:-1]]) for t in range(len(stretch.paths))]
        for r in short:
            label[r] = np.argmin(stretch.cost(r, lo, hi, c, nodes))
    return label


@dataclass(frozen=True)
class Clusters:
    """Fitted clusters: ``members`` (key, cluster_id) and ``boxes`` with one row per cluster."""

    key: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    bounds: dict[str, tuple[float, float]]
    weights: dict[str, float]
    members: DataFrame
    boxes: DataFrame
    output: str = "box"
    trees: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def flat(self) -> list[str]:
        return [c for c in self.categorical if c not in self.trees]

    def _values(self) -> DataFrame:
        """Columns a row receives: bounds and categories, or mean and mode."""
        if self.output == "box":
            ends = [f"{c}_{e}" for c in self.numeric for e in ("min", "max")]
            return self.boxes.select("cluster_id", *ends, *[q(c) for c in self.categorical])
        means = [F.col(f"{c}_mean").alias(c) for c in self.numeric]
        return self.boxes.select("cluster_id", *means, *[q(f"{c}_mode").alias(c) for c in self.categorical])

    def _replace(self, labelled: DataFrame) -> DataFrame:
        rest = labelled.drop(*self.numeric, *self.categorical)
        return rest.join(self._values(), "cluster_id", "left")

    def publish(self, df: DataFrame, keep_raw: bool = False) -> DataFrame:
        """Member rows with their own cluster's values: the k-anonymous output.

        Every training row is a member; other rows belong in :meth:`apply`.  With
        ``keep_raw`` rows outside all clusters are appended as they are, in their own
        columns.
        """
        inside = self._replace(df.join(self.members, self.key))
        if not keep_raw:
            return inside
        outside = df.join(self.members, self.key, "left_anti")
        return inside.unionByName(outside, allowMissingColumns=True)

    def on_training(self, df: DataFrame) -> DataFrame:
        """The rows of the fit, every one with the values of its own cluster, in the columns of :meth:`apply`."""
        return self.publish(df).drop("cluster_id")

    def assign(self, df: DataFrame) -> DataFrame:
        """Any rows to their cheapest cluster: (key, cluster_id, cost), first cluster on ties."""
        order = (*self.numeric, *self.flat, *self.trees)
        clipped = clip_to(df.select(F.col(self.key).alias("_id"), *order), {c: self.bounds[c] for c in self.numeric})
        codes = encode.fit_label_codes(self.boxes, self.flat)
        rows = codes.apply(clipped).na.fill(-2, self.flat)
        raw = self.boxes.withColumns({f"{c}__raw": q(c) for c in self.flat})
        boxes, tables = codes.apply(raw), [np.array([1.0, 0.5]) for _ in self.flat]
        for c, tree in self.trees.items():
            known, levels = hierarchy.paths(tree), hierarchy.depth(tree)
            tables.append(level_costs(levels))
            rows = hierarchy.with_paths(rows, c, known, levels + 1, f"{c}__path")
            boxes = hierarchy.with_paths(boxes, c, known, levels + 1, f"{c}__path")
        nodes = [F.col(f"{c}__path").cast("array<double>") for c in self.trees]
        star = lambda c: F.when(q(f"{c}__raw") == "*", -1.0).otherwise(q(c).cast("double"))
        ends = lambda e: [F.col(f"{c}_{e}").cast("double") for c in self.numeric]
        plain = [*ends("min"), *ends("max"), *[F.coalesce(star(c), F.lit(-1.0)) for c in self.flat]]
        asked = F.concat(F.array(*[q(c).cast("double") for c in (*self.numeric, *self.flat)]).cast("array<double>"), *nodes)
        rows = rows.select(F.col("_id").alias("qid"), asked.alias("v"), F.lit("").alias("g"))
        boxes = boxes.select(F.col("cluster_id").alias("did"), F.concat(F.array(*plain).cast("array<double>"), *nodes).alias("v"), F.lit("").alias("g"))
        spans = np.array([self.bounds[c][1] - self.bounds[c][0] for c in self.numeric], float)
        weights = np.array([self.weights.get(c, 1.0) for c in order], float)
        best = search(rows, boxes, Boxes(spans, weights, tables=tables), 1)
        return best.select(F.col("qid").alias(self.key), F.col("did").alias("cluster_id"), F.col("score").alias("cost"))

    def apply(self, df: DataFrame) -> DataFrame:
        """Unseen rows recoded by their cheapest cluster."""
        return self._replace(df.join(self.assign(df).drop("cost"), self.key)).drop("cluster_id")


def cluster_boxes(df: DataFrame, by: str, numeric: list[str], categorical: list[str], trees: dict[str, DataFrame] | None = None) -> DataFrame:
    """Ranges, means and generalized categories per cluster.

    A mixed or null category becomes ``*``, one with a tree the deepest common ancestor
    (the root where a value is not in the tree).
    """
    trees = trees or {}
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in numeric:
        aggs += [F.min(q(c)).alias(f"{c}_min"), F.max(q(c)).alias(f"{c}_max"), F.avg(q(c)).alias(f"{c}_mean")]
    for c in categorical:
        if c not in trees:
            one = (F.min(q(c)) == F.max(q(c))) & (F.count(q(c)) == F.count(F.lit(1)))
            aggs.append(F.when(one, F.min(q(c))).otherwise("*").alias(c))
    out = df.groupBy(by).agg(*aggs)
    for c, tree in trees.items():
        root = tree.filter("level = 0").first()["value"]
        up = hierarchy.group_lca(df, [by], c, hierarchy.closure(tree)).select(by, F.coalesce("lca", F.lit(root)).alias(c))
        out = out.join(up, by, "left").fillna(root, [c])
    if categorical:
        modes = mode_of(df, [by], list(categorical)).groupBy(by).agg(
            *[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(f"{c}_mode") for c in categorical]
        )
        out = out.join(modes, by, "left")
    return out


def fit_clusters(
    df: DataFrame,
    key: str,
    numeric: list[str],
    categorical: list[str],
    k: int,
    weights: dict[str, float] | None = None,
    block: str | None = None,
    block_rows: int | None = None,
    leftover: str = "merge",
    output: str = "box",
    trees: dict[str, DataFrame] | None = None,
) -> Clusters:
    """Greedy clusters of at least k rows (``keep`` may leave one shorter per block).

    ``block`` names a column whose groups are clustered each by itself; choose one with
    groups that a task can hold.  ``block_rows`` instead makes blocks by relaxed median
    splits, as small as possible with at least so many rows each.  One of the two is
    needed, whatever the size of the table.  ``trees`` has (value, parent, level, name)
    of the categories that go up a tree; a value that is not in it stands at the root.
    """
    if (block is None) == (block_rows is None):
        raise ValueError("name either a block column or the least rows of a block")
    weights, trees = weights or {}, {c: trees[c] for c in categorical if c in (trees or {})}
    flat, nn = [c for c in categorical if c not in trees], list(numeric)
    order = [*nn, *flat, *trees]
    bounds = bounds_of(df, nn) if nn else {}
    spans = np.array([bounds[c][1] - bounds[c][0] for c in nn], float)
    w = np.array([weights.get(c, 1.0) for c in order], float)
    coded = df.select(key, *order, *([F.coalesce(F.col(block).cast("string"), F.lit("")).alias("block")] if block else []))
    coded = encode.fit_label_codes(df, flat).apply(coded).na.fill(-2, flat)
    tables, nodes = [], {}
    for c, tree in trees.items():
        levels = hierarchy.depth(tree)
        tables.append(level_costs(levels))
        coded = hierarchy.with_paths(coded, c, hierarchy.paths(tree), levels + 1, f"{c}__path")
        nodes[c] = f"{c}__path"
        coded = coded.withColumn(c, F.array_max(nodes[c]))  # numbers grow down a path
    if block:
        blocks, lumps = coded, None
    else:
        classes = mondrian(coded.select(key, *order), order, max(block_rows, k), strict=False)
        named = classes.label(coded, key).withColumnRenamed("ec_id", "block")
        named = materialize(named)
        # classes made of one repeated row need no search, however many rows they have
        lumps = classes.tuples.groupBy("ec_id").agg(F.count(F.lit(1)).alias("m"), F.sum("w").alias("n"))
        lumps = lumps.filter((F.col("m") == 1) & (F.col("n") >= k)).select(F.col("ec_id").alias("block"))
        blocks = named.join(lumps, "block", "left_anti")
    kind = df.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        num = pdf[nn].to_numpy(float)
        cat = pdf[flat].to_numpy(float).reshape(len(pdf), len(flat))
        paths = [np.stack(pdf[name].to_numpy()) for name in nodes.values()]
        label = greedy(Stretch(num, cat, paths, tables, spans, w), k, leftover)
        ids = pdf["block"] + ":" + pd.Series(label, index=pdf.index).map("{:06d}".format)
        return pd.DataFrame({key: pdf[key], "cluster_id": ids})

    members = blocks.groupBy("block").applyInPandas(run, f"{key} {kind}, cluster_id string")
    if lumps is not None:
        same = named.join(lumps, "block").select(key, F.col("block").alias("cluster_id"))
        members = members.unionByName(same)
    members = materialize(members)
    boxes = materialize(cluster_boxes(df.join(members, key), "cluster_id", nn, list(categorical), trees))
    return Clusters(key, tuple(numeric), tuple(categorical), bounds, weights, members, boxes, output, trees)
