"""Regression trees and forests with an exact split search.

A node's best split comes from running sums of (n, y, y^2) over the distinct values
of each feature, for all open nodes of all trees together; one round per tree level.
Nodes that became small are finished independently, many per task.
"""

from __future__ import annotations

from dataclasses import dataclass

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.hashing import poisson_one, unit_hash
from cloakwork.functions.ranks import add_buckets, bucket_count, exact_quantiles, melt, quantile_bounds, running_sums
from cloakwork.operators import deviation
from cloakwork.session import discard, materialize

LOCAL_ROWS = 50_000
MODEL_NODES = 500_000
REWRITE_EVERY = 3
NODES = "tree int, node string, feature int, threshold double, value double, n bigint"


def impurity(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Variance, mean absolute deviation from the mean, and from the median."""
    by = by or []
    y = df.select(*by, F.col(label).cast("double").alias("y"))
    mean = y.groupBy(*by).agg(F.avg("y").alias("mean"))
    median = exact_quantiles(y, ["y"], [0.5], by).select(*by, F.col("quantile").alias("median"))
    if by:
        # written, so its size is known: with few groups no row is moved to the task of its group
        y = y.join(materialize(mean.join(median, by)), by)
    else:
        y = y.withColumns({"mean": F.lit(mean.first()[0]), "median": F.lit(median.first()[0])})
    return y.groupBy(*by).agg(
        F.var_pop("y").alias("mse"),
        F.avg(F.abs(F.col("y") - F.col("mean"))).alias("mae"),
        F.avg(F.abs(F.col("y") - F.col("median"))).alias("mad"),
    )


def _moments() -> list[Column]:
    w, y = F.col("w"), F.col("y")
    return [F.sum(w).cast("double").alias("n"), F.sum(w * y).alias("s"), F.sum(w * y * y).alias("q"), F.count(F.lit(1)).alias("r")]


def _candidates(long: DataFrame, by: list[str], totals: DataFrame, bucketed: bool) -> DataFrame:
    """Gain of every mid-point threshold from (by..., column, value, y, w[, bucket]) rows.

    ``totals`` has (by..., tn, ts, tq), the moments of each node, which are the same
    for all of its features.
    """
    keys = [*by, "column"]
    freq = long.groupBy(*keys, *(["bucket"] if bucketed else []), "value").agg(*_moments())
    runs = running_sums(freq, keys, "value", ["n", "s", "q", "r"], "bucket" if bucketed else None)
    runs = runs.filter(F.col("next_value").isNotNull())
    spread = lambda n, s, q: q - F.try_divide(s * s, n)  # an empty side has no gain
    n, s, q = F.col("run_n"), F.col("run_s"), F.col("run_q")
    tn, ts, tq = F.col("tn"), F.col("ts"), F.col("tq")
    gain = (spread(tn, ts, tq) - spread(n, s, q) - spread(tn - n, ts - s, tq - q)) / tn
    if by:
        runs = runs.join(totals, by)
    else:
        runs = runs.withColumns({c: F.lit(v) for c, v in totals.first().asDict().items()})
    return runs.select(
        *keys, ((F.col("value") + F.col("next_value")) / 2).alias("threshold"), gain.alias("gain"), n.alias("n_left"), tn.alias("n"),
        F.col("run_r").alias("rows_left"), s.alias("s_left"), q.alias("q_left"),
    )


def _strips(rows: int) -> int:
    return max(1, min(deviation.MOST_STRIPS, -(-rows // deviation.STRIP_ROWS)))


def _absolute(long: DataFrame, by: list[str], totals: DataFrame, loss: str) -> DataFrame:
    """Candidates of an absolute loss in the form of :func:`_candidates`; ``long`` also has yb."""
    one = long.join(long.groupBy(*by).agg(F.min("column").alias("column")), [*by, "column"])  # each row once
    whole = deviation.node_deviation(one.select(*by, "y", "yb", "w"), by, loss)
    found = deviation.candidates(long, by, loss).join(whole, by).join(totals, by)
    gain = (F.col("whole") - F.col("loss")) / F.col("tn")
    return found.select(
        *by, "column", "threshold", gain.alias("gain"), "n_left", F.col("tn").alias("n"), "rows_left", "s_left", "q_left"
    )


def best_split(df: DataFrame, features: list[str], label: str, by: list[str] | None = None, loss: str = "mse") -> DataFrame:
    """Feature and threshold with the largest loss reduction (first feature, lowest threshold on ties)."""
    by = by or []
    rows = df.count()
    centre = df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    buckets = bucket_count(rows) if loss == "mse" else _strips(rows)
    work = df.select(*by, *features, (F.col(label).cast("double") - F.lit(centre)).alias("y"))
    work = add_buckets(work, quantile_bounds(work, features if loss == "mse" else [*features, "y"], buckets)).withColumn("w", F.lit(1))
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("column"))
    if loss == "mse":
        totals = work.groupBy(*by).agg(*_moments()).select(*by, F.col("n").alias("tn"), F.col("s").alias("ts"), F.col("q").alias("tq"))
        cand = _candidates(melt(work, features, [*by, "y", "w"], "__b"), by, totals, buckets > 1)
    else:
        keys = by or ["_all"]
        work = work if by else work.withColumn("_all", F.lit(0))
        totals = work.groupBy(*keys).agg(F.sum("w").cast("double").alias("tn"))
        long = melt(work.withColumnRenamed("y__b", "yb"), features, [*keys, "y", "yb", "w"], "__b")
        cand = _absolute(long, keys, totals, loss)
    best = F.max_by(
        F.struct("column", "threshold", "gain", "n_left", "n"), F.struct(F.round("gain", 12), -place, -F.col("threshold"))
    )
    return cand.filter(F.col("gain") > 0).groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


@dataclass(frozen=True)
class Forest:
    features: tuple[str, ...]
    nodes: DataFrame

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Mean of all trees.

        A model of checked size travels to the tasks and is walked for whole batches;
        a larger one is walked level by level with joins on (tree, node).
        """
        if self.nodes.count() <= MODEL_NODES:
            walk = _walker(self.nodes.toPandas())
            return df.withColumn(name, walk(F.array(*[F.col(f).cast("double") for f in self.features])))
        return self._predict_by_joins(df, name)

    def _predict_by_joins(self, df: DataFrame, name: str) -> DataFrame:
        vector = F.array(*[F.col(f).cast("double") for f in self.features])
        keyed = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
        trees = self.nodes.select("tree").distinct()
        roots = materialize(self.nodes.filter(F.length("node") == 1).select("tree", "node"))
        depth = self.nodes.agg(F.max(F.length("node"))).first()[0]
        numbers = sorted(r["tree"] for r in trees.collect())  # one per tree
        at = keyed.select("_row", vector.alias("x")).withColumn("tree", F.explode(F.array(*[F.lit(t) for t in numbers])))
        at = at.join(roots, "tree")
        for level in range(depth - 1):
            here = self.nodes.filter(F.length("node") == level + 1).select("tree", "node", "feature", "threshold")
            at = at.join(here, ["tree", "node"], "left")
            left = F.element_at("x", F.col("feature") + 1) <= F.col("threshold")
            step = F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.concat("node", F.when(left, "0").otherwise("1")))
            at = at.withColumn("node", step).drop("feature", "threshold")
            if level % REWRITE_EVERY == REWRITE_EVERY - 1:
                at = materialize(at)
        values = at.join(self.nodes.select("tree", "node", "value"), ["tree", "node"])
        mean = values.groupBy("_row").agg(F.avg("value").alias(name))
        return keyed.join(mean, "_row").drop("_row")


def _walker(nodes: pd.DataFrame):
    trees = []
    for _, t in nodes.groupby("tree"):
        t = t.sort_values("node").reset_index(drop=True)
        place = {n: i for i, n in enumerate(t["node"])}
        leaf = t["feature"].isna().to_numpy() | (t["feature"].to_numpy() < 0)
        child = lambda side: np.array([i if leaf[i] else place[n + side] for i, n in enumerate(t["node"])])
        trees.append((np.where(leaf, 0, t["feature"].fillna(0)).astype(int), t["threshold"].to_numpy(float), child("0"), child("1"), t["value"].to_numpy(float), place["r"], leaf))

    @F.pandas_udf("double")
    def walk(x: pd.Series) -> pd.Series:
        if x.empty:
            return pd.Series([], dtype=float)
        m = np.stack([np.asarray(v, float) for v in x])
        total = np.zeros(len(m))
        for feature, threshold, left, right, value, root, leaf in trees:
            at = np.full(len(m), root)
            live = ~leaf[at]
            while live.any():
                i = at[live]
                at[live] = np.where(m[live, feature[i]] <= threshold[i], left[i], right[i])
                live = ~leaf[at]
            total += value[at]
        return pd.Series(total / len(trees))

    return walk


def _local_split(x: np.ndarray, y: np.ndarray, w: np.ndarray, columns, loss: str):
    """Best (gain, feature, threshold) of one small node."""
    best = (0.0, None, None)
    n = w.sum()
    for j in columns:
        order = np.argsort(x[:, j], kind="stable")
        v, yo, wo = x[order, j], y[order], w[order]
        ends = np.flatnonzero(v[1:] > v[:-1])
        if not len(ends):
            continue
        if loss == "mse":
            cn, cs, cq = np.cumsum(wo), np.cumsum(wo * yo), np.cumsum(wo * yo * yo)
            spread = lambda a, b, c: c - b * b / a
            inner = spread(cn[ends], cs[ends], cq[ends]) + spread(n - cn[ends], cs[-1] - cs[ends], cq[-1] - cq[ends])
            gains = (spread(n, cs[-1], cq[-1]) - inner) / n
        else:
            losses = deviation.threshold_losses(v, yo, wo, loss)[2]
            whole = deviation.threshold_losses(np.zeros(len(yo)), yo, wo, loss, next_x=1.0)[2][0]
            gains = (whole - losses) / n
        gains = np.round(gains, 12)  # as the rounds compare them
        i = int(np.argmax(gains))
        if gains[i] > best[0]:
            best = (float(gains[i]), j, float((v[ends[i]] + v[ends[i] + 1]) / 2))
    return best


def _finish_small(d: int, opts: dict):
    """Grow one small node to the end inside a task, with the rules of the rounds."""

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, root = int(pdf["tree"].iloc[0]), pdf["node"].iloc[0]
        x = np.stack([np.asarray(v, float) for v in pdf["x"]])
        y, w = pdf["y"].to_numpy(float), pdf["w"].to_numpy(float)
        out, todo = [], [(root, np.arange(len(y)))]
        while todo:
            node, idx = todo.pop()
            n = w[idx].sum()
            value = (w[idx] * y[idx]).sum() / n
            gain, j, at = 0.0, None, None
            if n >= opts["min_split"] and (opts["max_depth"] is None or len(node) - 1 < opts["max_depth"]):
                pick = _subset_of(d, opts["max_features"], opts["seed"], tree, node)
                gain, j, at = _local_split(x[idx], y[idx], w[idx], pick, opts["loss"])
            if j is None or gain < opts["min_gain"]:
                out.append((tree, node, -1, np.nan, value + opts["centre"], int(n)))
                continue
            out.append((tree, node, int(j), at, value + opts["centre"], int(n)))
            left = x[idx, j] <= at
            todo += [(node + "0", idx[left]), (node + "1", idx[~left])]
        return pd.DataFrame(out, columns=["tree", "node", "feature", "threshold", "value", "n"])

    return finish


def _subset_of(d: int, m: int, seed: int, tree: int, node: str) -> list[int]:
    """The same features as :func:`_feature_subset`, for a node that is finished inside a task."""
    if m >= d:
        return list(range(d))
    name, md5 = f"{seed}:{tree}:{node}:".encode(), hashlib.md5
    drawn = [md5(name + b"%d" % j).digest() for j in range(d)]
    return sorted(sorted(range(d), key=drawn.__getitem__)[:m])


def _drawn(df: DataFrame, seed: int) -> DataFrame:
    """Column ``w``, the Poisson draws of row ``id`` by tree ``tree``; rows never drawn are dropped."""
    draw = F.concat_ws(":", F.col("id").cast("string"), (F.col("tree") + seed).cast("string"))
    out = df.withColumn("_u", unit_hash(draw, "bootstrap")).withColumn("w", poisson_one(F.col("_u")))
    return out.filter(F.col("w") > 0).drop("_u")


def _feature_subset(d: int, m: int, seed: int) -> Column:
    """Features a node may split on: the m smallest of a hash of (tree, node, feature)."""
    name = F.concat_ws(":", F.lit(str(seed)), F.col("tree").cast("string"), F.col("node"))
    draws = [F.concat(F.md5(F.concat(name, F.lit(f":{j}"))), F.lit(f":{j}")) for j in range(d)]
    return F.transform(F.slice(F.array_sort(F.array(*draws)), 1, m), lambda s: F.substring_index(s, ":", -1).cast("int"))


def fit_forest(
    df: DataFrame,
    key: str,
    features: list[str],
    label: str,
    trees: int = 100,
    max_depth: int | None = None,
    min_split: int = 2,
    min_gain: float = 0.0,
    max_features: int | None = None,
    loss: str = "mse",
    seed: int = 42,
    bootstrap: bool = True,
    local_rows: int | None = None,
) -> Forest:
    """Trees on Poisson bootstrap samples (one plain tree with ``bootstrap=False``).

    ``local_rows`` is the node size below which a node is finished inside one task.
    """
    d = len(features)
    if loss not in ("mse", "mae", "mad"):
        raise ValueError(f"unknown loss {loss}: choose mse, mae or mad")
    rows, centre = df.agg(F.count(F.lit(1)), F.avg(F.col(label).cast("double"))).first()
    local = max(1, min(LOCAL_ROWS, rows // 8)) if local_rows is None else local_rows
    m = d if max_features is None else min(d, max_features)
    opts = {"seed": seed, "min_split": min_split, "max_depth": max_depth, "max_features": m, "loss": loss, "min_gain": min_gain, "centre": centre}
    buckets = bucket_count(rows) if loss == "mse" else _strips(rows)
    data = df.select(
        F.col(key).alias("_id"), *[F.col(f).cast("double").alias(f) for f in features], (F.col(label).cast("double") - F.lit(centre)).alias("_y")
    )
    data = add_buckets(data, quantile_bounds(data, [*features, "_y"], buckets))
    data = data.select(
        F.col("_id").alias("id"),
        F.col("_y").alias("y"),
        F.col("_y__b").alias("yb"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
        F.array(*[F.col(f"{f}__b") for f in features]).alias("b"),
    )
    data = data.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    if bootstrap:
        data = _drawn(data, seed)
    else:
        data = data.withColumn("w", F.lit(1))
    state = owned = materialize(data.drop("id").withColumn("node", F.lit("r")))
    nodes = state.groupBy("tree", "node").agg(*_moments()).withColumnRenamed("r", "rows")
    nodes = materialize(nodes)  # one row per open node
    value = (F.col("s") / F.col("n") + F.lit(centre)).alias("value")
    finished, small, depth, stale = [], [], 0, 0
    while True:
        may = (F.col("n") >= min_split) & (F.col("rows") > 1) & F.lit(max_depth is None or depth < max_depth)
        big, fits = may & (F.col("rows") > local), may & (F.col("rows") <= local)
        n_leaf, n_small, n_big = nodes.agg(F.count_if(~may), F.count_if(fits), F.count_if(big)).first()
        if n_leaf:
            none = F.lit(None).cast("double").alias("threshold")
            finished.append(nodes.filter(~may).select("tree", "node", F.lit(-1).alias("feature"), none, value, F.col("n").cast("bigint").alias("n")))
        if n_small:
            small.append(nodes.filter(fits).select("tree", "node"))
        if not n_big:
            break
        open_big = nodes.filter(big)
        subset = _feature_subset(d, m, seed).alias("f") if m < d else F.lit(None).alias("f")
        active = state.join(open_big.select("tree", "node"), ["tree", "node"])
        long = active.select("tree", "node", "y", "yb", "w", subset, F.posexplode(F.arrays_zip("x", "b")).alias("column", "c"))
        if m < d:
            long = long.filter(F.array_contains("f", F.col("column")))
        long = long.select("tree", "node", "column", F.col("c.x").alias("value"), F.col("c.b").alias("bucket"), "y", "yb", "w")
        totals = open_big.select("tree", "node", F.col("n").alias("tn"), F.col("s").alias("ts"), F.col("q").alias("tq"))
        at = ["tree", "node"]
        cand = _candidates(long, at, totals, buckets > 1) if loss == "mse" else _absolute(long, at, totals, loss)
        cand = cand.filter((F.col("gain") > 0) & (F.col("gain") >= min_gain))
        best = cand.groupBy("tree", "node").agg(
            F.max_by(
                F.struct("column", "threshold", "n_left", "rows_left", "s_left", "q_left"),
                F.struct(F.round("gain", 12), -F.col("column"), -F.col("threshold")),
            ).alias("b")
        )
        splits = materialize(
            open_big.join(best, ["tree", "node"], "left").select(
                "tree", "node", "rows", "n", "s", "q", F.coalesce("b.column", F.lit(-1)).alias("feature"),
                "b.threshold", "b.n_left", "b.rows_left", "b.s_left", "b.q_left",
            )
        )
        finished.append(splits.select("tree", "node", "feature", "threshold", value, F.col("n").cast("bigint").alias("n")))
        go = splits.filter(F.col("feature") >= 0)

        left = [F.col("rows_left"), F.col("n_left"), F.col("s_left"), F.col("q_left")]
        right = [F.col(c) - l for c, l in zip(("rows", "n", "s", "q"), left)]

        def child(side, values):
            named = [v.alias(c) for v, c in zip(values, ("rows", "n", "s", "q"))]
            return F.struct("tree", F.concat("node", F.lit(side)).alias("node"), *named)

        nodes = go.select(F.inline(F.array(child("0", left), child("1", right))))
        side = F.when(F.element_at("x", F.col("feature") + 1) <= F.col("threshold"), "0").otherwise("1")
        moved = state.join(go.select("tree", "node", "feature", "threshold"), ["tree", "node"], "left")
        state = moved.withColumn("node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.concat("node", side)))
        state = state.drop("feature", "threshold")
        stale, depth = stale + 1, depth + 1
        if stale == REWRITE_EVERY:
            fresh = materialize(state)
            discard(owned)
            state = owned = fresh
            stale = 0
    if small:
        rest = small[0]
        for part in small[1:]:
            rest = rest.unionByName(part)
        rows_left = state.select("tree", "node", "x", "y", "w").join(rest, ["tree", "node"])
        finished.append(rows_left.groupBy("tree", "node").applyInPandas(_finish_small(d, opts), NODES))
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    out = materialize(out)
    discard(owned)
    return Forest(tuple(features), out)


def bootstrap_weights(df: DataFrame, key: str, trees: int, seed: int = 42) -> DataFrame:
    """(key, tree, w): how often each tree draws a row, without the rows it never draws."""
    out = df.select(F.col(key).alias("id")).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return _drawn(out, seed)


def fit_tree(df: DataFrame, key: str, features: list[str], label: str, **options) -> Forest:
    """A single tree on all rows."""
    return fit_forest(df, key, features, label, trees=1, bootstrap=False, **options)
