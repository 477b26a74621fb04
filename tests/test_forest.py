"""Trees against a plain recursion, and forests against their own trees."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cloakwork.operators import forest


def rows(n, seed, classes=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b, c = int(rng.integers(0, 6)), float(round(rng.normal(), 2)), float(rng.integers(0, 40))
        out.append((i, a, b, c, "pqr"[int((a > 2) + (b > 0.3) * rng.integers(0, classes - 1))], round(a * 2 + b + rng.normal() / 3, 2)))
    return out


SCHEMA = "id long, a int, b double, c double, job string, y double"


def by_hand(data, kind, min_split, min_leaf, max_depth, node="r", total=None):
    """(node, feature, threshold, n) of a plain tree; data has (x, label)."""
    def score(part):
        if kind == "class":
            return sum(v * v for v in Counter(y for _, y in part).values()) / len(part)
        return sum(y for _, y in part) ** 2 / len(part)

    best = None
    if len(data) >= min_split and (max_depth is None or len(node) - 1 < max_depth):
        for j in range(len(data[0][0])):
            values = sorted({x[j] for x, _ in data})
            for lo, hi in zip(values, values[1:]):
                t = (lo + hi) / 2
                left, right = [r for r in data if r[0][j] <= t], [r for r in data if r[0][j] > t]
                if min(len(left), len(right)) >= min_leaf:
                    gain = round((score(left) + score(right) - score(data)) / len(data), 12)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, j, t, left, right)
    if best is None:
        return [(node, -1, None, len(data))]
    _, j, t, left, right = best
    args = (kind, min_split, min_leaf, max_depth)
    return [(node, j, t, len(data)), *by_hand(left, *args, node + "0"), *by_hand(right, *args, node + "1")]


@pytest.mark.parametrize("kind, label", [("class", "job"), ("number", "y")])
@pytest.mark.parametrize(
    "min_split, min_leaf, max_depth, local, per_bucket",
    [(0.1, 3, None, 0, 20), (2, 0.05, 3, 0, 50), (2, 1, None, 30, 20), (2, 1, None, 1000, 1000), (0.1, 0.05, None, 1000, 1000), (2, 3, 4, 1000, 1000)],
)
def test_tree_equals_recursion(spark, kind, label, min_split, min_leaf, max_depth, local, per_bucket):
    data = rows(160, 5)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    if local == 0 and max_depth is None:
        max_depth = 6  # one pass a level
    got = forest.fit(df, "id", ["a", "b", "c"], label, kind, 1, max_depth, min_split, min_leaf, bootstrap=False, local_rows=local, per_bucket=per_bucket)
    centre = sum(r[5] for r in data) / len(data)
    plain = [((r[1], r[2], r[3]), r[4] if kind == "class" else r[5] - centre) for r in data]
    split = math.ceil(min_split * 160) if min_split < 1 else min_split
    leaf = math.ceil(min_leaf * 160) if min_leaf < 1 else min_leaf
    want = by_hand(plain, kind, split, leaf, max_depth)
    norm = lambda t: None if t is None else round(t, 9)
    found = sorted((r.node, r.feature, norm(r.threshold), int(r.n)) for r in got.nodes.collect())
    if kind == "class":  # a pure node ends, which a plain recursion finds out by itself
        assert found == sorted((a, b, norm(c), d) for a, b, c, d in want)
    else:
        assert found == sorted((a, b, norm(c), d) for a, b, c, d in want)


def test_forest_does_not_depend_on_how_the_work_is_cut(spark):
    df = spark.createDataFrame(rows(300, 8), SCHEMA)
    make = lambda part, local, per: forest.fit(df.repartition(part), "id", ["a", "b", "c"], "job", trees=6, max_features="sqrt", local_rows=local, per_bucket=per)
    listed = lambda f: sorted((r.tree, r.node, r.feature, r.threshold, tuple(r.value), r.n) for r in f.nodes.collect())
    one = listed(make(2, 40, 30))
    assert one == listed(make(5, 300, 1000)) == listed(make(3, 100, 300))
    assert len({t for t, *_ in one}) == 6 and len(one) > 60


def test_trees_grown_in_groups(spark, monkeypatch):
    df = spark.createDataFrame(rows(200, 3), SCHEMA)
    whole = forest.fit(df, "id", ["a", "b"], "y", "number", trees=4, local_rows=50, max_depth=5)
    monkeypatch.setattr(forest, "OPEN_NODES", 4)
    parts = forest.fit(df, "id", ["a", "b"], "y", "number", trees=4, local_rows=50, max_depth=5)
    listed = lambda f: sorted((r.tree, r.node, r.feature, r.threshold) for r in f.nodes.collect())
    assert listed(whole) == listed(parts)
    got = {r.id: r.prediction for r in whole.predict(df).collect()}
    monkeypatch.setattr(forest, "MODEL_BYTES", 1)
    assert got == pytest.approx({r.id: r.prediction for r in parts.predict(df).collect()})


def test_one_forest_answers_shallower_and_coarser_ones(spark):
    df = spark.createDataFrame(rows(250, 4), SCHEMA)
    features = ["a", "b", "c"]
    big = forest.fit(df, "id", features, "job", trees=5, min_leaf=2)
    settings = [(3, 4, 2), (5, None, 20), (5, 2, 30), (1, None, 2)]
    got = {(r.id, r.setting): r.prediction for r in big.predict_settings(df, settings).collect()}
    for i, (trees, deep, least) in enumerate(settings):
        own = forest.fit(df, "id", features, "job", trees=trees, max_depth=deep, min_split=least, min_leaf=2).predict(df)
        assert {r.id: r.prediction for r in own.collect()} == {a: p for (a, s), p in got.items() if s == i}


def test_forest_learns_and_handles_odd_input(spark):
    data = rows(400, 6, 2)
    df = spark.createDataFrame(data, SCHEMA)
    holes = df.withColumn("b", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("b"))).withColumn("job", F.when(F.col("id") == 9, None).otherwise(F.col("job")))
    fitted = forest.fit(holes, "id", ["a", "b", "c"], "job", trees=20)
    hits = fitted.predict(holes).filter("prediction = job").count()
    assert hits > 360
    one = forest.fit(df.withColumn("job", F.lit("x")), "id", ["a"], "job", trees=2)
    assert {r.prediction for r in one.predict(df).collect()} == {"x"}
    far = forest.fit(df, "id", ["a", "c"], "y", "number", trees=10, max_depth=6)
    error = far.predict(df).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    assert error < df.agg(F.stddev_pop("y")).first()[0] / 2
    with pytest.raises(ValueError, match="kind"):
        forest.fit(df, "id", ["a"], "job", "ranks")


def test_draws_are_hashed_once_and_trees_fit_a_task(spark):
    """A draw is one hash, not one for each step of the Poisson sum; many trees are finished whole, few by levels."""
    assert forest.small_node(100_000, 100, 3) >= 100_000 > forest.small_node(100_000, 1, 3)
    assert forest.small_node(10**9, 300, 64) * 64 <= forest.LOCAL_VALUES
    assert forest.cell_rows(1_000_000, 1, 2) == 1000 and forest.cell_rows(1_000_000, 100, 64) > 3000
    df = spark.createDataFrame(rows(90, 2), SCHEMA)
    seen = []
    real = forest.materialize
    try:
        forest.materialize = lambda t: seen.append(t._jdf.queryExecution().optimizedPlan().toString()) or real(t)
        forest.fit(df, "id", ["a", "b"], "y", "number", trees=3)
    finally:
        forest.materialize = real
    assert seen[0].count("md5(") == 1


def test_large_forest_meets_rows_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame(rows(120, 7), SCHEMA)
    fitted = forest.fit(df, "id", ["a", "b", "c"], "job", trees=7)
    settings = [(7, None, 0), (3, 2, 10)]
    listed = lambda: sorted((r.id, r.setting, r.prediction) for r in fitted.predict_settings(df, settings).collect())
    want = listed()
    monkeypatch.setattr(forest, "MODEL_BYTES", 1)
    monkeypatch.setattr(forest, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(forest, "WALK_ROWS", 50)
    assert listed() == want and len(want) == 240


def test_shared_draws_give_the_same_forest_and_small_trees_are_dealt_out(spark):
    df = spark.range(200).selectExpr("id", "cast(id * 37 % 101 as double) a", "cast(id * 11 % 7 as double) b", "cast(id % 3 as string) y")
    own = forest.fit(df, "id", ["a", "b"], "y", trees=64, max_features=1)
    shared = forest.fit(forest.with_draws(df, "id", 80, 42, "d"), "id", ["a", "b"], "y", trees=64, max_features=1, drawn="d")
    listed = lambda f: sorted(map(str, f.nodes.collect()))
    assert listed(own) == listed(shared)
    assert len(own.nodes.inputFiles()) > 1


def test_rows_of_small_nodes_travel_packed():
    """One value per node and task, not a row per row and tree."""
    rng = np.random.default_rng(7)
    n, d, trees = 3000, 4, 10
    x, y, w = rng.normal(size=(n, d)), rng.integers(0, 3, n).astype(float), rng.poisson(1, (n, trees)).astype(np.int8)
    listed = lambda a, kind: pa.array(a.tolist(), pa.list_(kind))
    batch = pa.RecordBatch.from_arrays([listed(x, pa.float64()), listed(np.zeros((n, d), int), pa.int32()), pa.array(y), listed(w, pa.int8())], ["x", "b", "y", "w"])
    sent = list(forest._small_rows(forest.Growth(d, 3, False, 1, -2 - np.arange(trees)))(iter([batch])))
    assert sum(b.num_rows for b in sent) == trees
    for tree, packed in zip(sent[0].column("small").to_pylist(), sent[0].column("rows").to_pylist(), strict=True):
        rows = np.frombuffer(packed, forest._packed(d))
        drawn = w[:, tree] > 0
        assert np.array_equal(rows["x"], x[drawn]) and np.array_equal(rows["y"], y[drawn]) and np.array_equal(rows["w"], w[drawn, tree])


@pytest.mark.parametrize("max_features,min_leaf", [(2, 1), (6, 1), (2, 9)])
def test_counted_classes_grow_the_tree_of_sorted_rows(max_features, min_leaf):
    rng = np.random.default_rng(11)
    n = 800
    x = np.column_stack([rng.normal(size=(n, 3)), rng.integers(0, 2, (n, 2)), np.where(rng.random(n) < 0.2, forest.MISSING, rng.integers(0, 9, n))])
    y, w = rng.integers(0, 4, n).astype(float), 1.0 + rng.poisson(1, n)
    rules = forest.Rules(6, 4, False, 2, min_leaf, None, 0.0, max_features, 42, 0.0)
    ranks = [np.unique(column, return_inverse=True) for column in x.T]
    counted = rules._grow_classes(3, "r", ranks, [4, 2, 10], y.astype(int), w.astype(int))
    assert counted.num_rows > 50 and counted.equals(rules._grow_sorted(3, "r", x, y, w))
    forest.SEARCHED, before = 1, forest.SEARCHED  # a feature at a time
    try:
        assert rules._grow_classes(3, "r", ranks, [4, 2, 10], y.astype(int), w.astype(int)).equals(counted)
    finally:
        forest.SEARCHED = before


def test_deep_trees_travel_without_paths(spark):
    """A node is a few numbers however deep it lies; its path is put together where nodes are asked for."""
    df = spark.range(300).selectExpr("id", "cast(id as double) a", "pow(1.5D, id) y")  # every split cuts off one row
    fitted = forest.fit(df, "id", ["a"], "y", "number", 1, bootstrap=False)
    nodes = fitted.nodes.collect()
    assert max(len(r.node) for r in nodes) > 20
    assert fitted.blocks.agg(F.sum(F.length("blob"))).first()[0] == 28 * len(nodes)
    by = {r.node: r for r in nodes}

    def walked(a, deep, least):
        path = "r"
        while by[path].feature >= 0 and len(path) - 1 < deep and by[path].n >= least:
            path += "0" if a <= by[path].threshold else "1"
        return by[path].value[0]

    settings = [(1, None, 0), (1, 3, 2), (1, 9, 292)]
    found = fitted.predict_settings(df, settings).collect()
    assert len(found) == 900
    for r in found:
        _, deep, least = settings[r.setting]
        assert r.prediction == walked(r.a, deep or 300, least)


def test_few_values_are_counted_not_sorted(monkeypatch):
    rng = np.random.default_rng(5)
    n = 900
    x = np.column_stack([rng.integers(0, 2, (n, 3)), rng.integers(0, 9, n)]).astype(float)
    y, w = rng.integers(0, 3, n).astype(float), 1.0 + rng.poisson(1, n)
    rules = forest.Rules(4, 3, False, 40, 1, None, 0.0, 4, 42, 0.0)
    want = rules._grow_sorted(0, "r", x, y, w)
    monkeypatch.setattr(forest.Rules, "_along_codes", None)
    assert rules.grow(0, "r", x, y, w).equals(want) and want.num_rows > 20


def test_rows_travel_in_the_narrowest_numbers(spark):
    df = spark.range(50).selectExpr("cast(id % 2 as double) x0", "cast(id * 1000 as double) x1", "id / 4D x2", "id / 3D x3", "8.9e307D x4")
    kinds = forest._kinds(df, 5)
    assert kinds == ("i1", "i4", "f4", "f8", "f8")
    x = np.array(df.collect(), dtype=float)
    columns = [pa.array(x.tolist()), pa.array([[0] * 5] * 50, pa.list_(pa.int32())), pa.array(np.arange(50.0)), pa.array([[1, 0]] * 50, pa.list_(pa.int8()))]
    batch = pa.RecordBatch.from_arrays(columns, ["x", "b", "y", "w"])
    (sent,) = forest._small_rows(forest.Growth(5, 1, True, 1, np.array([-2, -3]), kinds=kinds))(iter([batch]))
    rows = np.frombuffer(sent.column("rows")[0].as_py(), forest._packed(5, kinds))
    assert rows.itemsize == 1 + 4 + 4 + 8 + 8 + 9 and np.array_equal(forest._features_in(rows, 5, kinds), x)


def test_draws_by_digits_are_the_poisson_draws(spark):
    from cloakwork.functions.hashing import poisson_one, unit_hash

    df = spark.range(3000).selectExpr("if(id = 7, null, id) id")
    want = F.array(*[poisson_one(unit_hash(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(t + 42))), "bootstrap")) for t in range(4)])
    got = df.select(forest.draws("id", 4, 42).alias("a"), want.alias("b")).collect()
    assert all(r.a == r.b for r in got) and max(max(r.a) for r in got) > 4
    plan = df.select(forest.draws("id", 4, 42))._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" not in plan


def test_rows_walk_once(spark):
    """No filter before the explode that asks the trees a second time."""
    df = spark.createDataFrame(rows(60, 7), SCHEMA)
    fitted = forest.fit(df, "id", ["a", "b"], "job", trees=3)
    plan = fitted.predict(df).filter("prediction = job")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan


def test_rows_are_packed_for_the_blocks():
    ids, piece, x = np.arange(50), np.arange(50) % 3, np.arange(100.0).reshape(50, 2)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(piece, pa.int32()), pa.array(x.tolist())], ["_row", "piece", "x"])
    (sent,) = forest._chunked(iter([batch]))
    assert sent.column("piece").to_pylist() == [0, 1, 2]
    for k, (i, v) in enumerate(zip(sent.column("ids").to_pylist(), sent.column("x").to_pylist(), strict=True)):
        assert np.array_equal(np.frombuffer(i, np.int64), ids[piece == k]) and np.array_equal(np.frombuffer(v).reshape(-1, 2), x[piece == k])
