import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakwork.operators import balance, nearest


def frame(spark, points, groups=None):
    rows = [(i, [float(x) for x in p], groups[i] if groups else "") for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "qid long, v array<double>, g string")


def brute(points, k, p, groups=None):
    out = {}
    for i, a in enumerate(points):
        d = (np.abs(points - a) ** p).sum(axis=1) ** (1 / p)
        order = sorted((round(float(d[j]), 9), j) for j in range(len(points)) if j != i and (not groups or groups[i] == groups[j]))
        out[i] = [x[0] for x in order[:k]]
    return out


@pytest.mark.parametrize("p", [1, 2, 3])
def test_graph_equals_brute_force(spark, monkeypatch, p):
    monkeypatch.setattr(nearest, "CELL_ROWS", 7)
    monkeypatch.setattr(nearest, "TILE_ROWS", 5)
    rng = np.random.default_rng(p)
    # a third of the points are copies of one point: one hot cell, cut into pieces and tiles
    points = np.round(np.concatenate([np.tile([[1.0, 2.0, 3.0]], (40, 1)), rng.normal(0, 3, (80, 3))]), 3)
    got = {}
    for r in nearest.knn_graph(frame(spark, points), 4, p).collect():
        got.setdefault(r["src"], []).append((r["rank"], round(r["dist"], 9)))
    want = brute(points, 4, p)
    assert {i: [d for _, d in sorted(v)] for i, v in got.items()} == {i: pytest.approx(d, abs=1e-7) for i, d in want.items()}


def test_groups_do_not_mix_and_small_groups_work(spark):
    rng = np.random.default_rng(0)
    points, groups = rng.normal(0, 1, (50, 2)), ["a"] * 45 + ["b"] * 4 + ["c"]
    pts = frame(spark, points, groups)
    out = nearest.search(pts, pts.withColumnRenamed("qid", "did"), nearest.Metric(), 5, exclude_self=True).collect()
    for r in out:
        assert groups[r["qid"]] == groups[r["did"]] and r["qid"] != r["did"]
    per = {}
    for r in out:
        per[r["qid"]] = per.get(r["qid"], 0) + 1
    assert all(per.get(i, 0) == {"a": 5, "b": 3, "c": 0}[groups[i]] for i in range(50))


def test_exact_hit_outvotes_the_rest(spark):
    train = spark.createDataFrame([(0, [0.0], ""), (1, [0.1], ""), (2, [0.1], "")], "did long, v array<double>, g string")
    labels = spark.createDataFrame([(0, "x"), (1, "y"), (2, "y")], "did long, label string")
    test = spark.createDataFrame([(9, [0.0], "")], "qid long, v array<double>, g string")
    assert nearest.knn_classify(train, test, labels, 3, "distance").first()["prediction"] == "x"
    assert nearest.knn_classify(train, test, labels, 3, "uniform").first()["prediction"] == "y"


def test_balancing(spark, monkeypatch):
    monkeypatch.setattr(balance, "COPIES_PER_ROW", 4)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 2)], "big" if i < 50 else "mid" if i < 62 else "tiny") for i in range(65)]
    df = spark.createDataFrame(rows, "qid long, v array<double>, label string")
    out = balance.smote(df, "label").collect()
    sizes = {}
    for r in out:
        sizes[r["label"]] = sizes.get(r["label"], 0) + 1
    assert sizes == {"big": 50, "mid": 50, "tiny": 50}
    raw = {r[0]: np.array(r[1]) for r in rows}
    same = {r[0]: [np.array(o[1]) for o in rows if o[2] == r[2] and o[0] != r[0]] for r in rows}
    for r in out:
        if r["copy"] == 0:
            assert r["v"] == list(raw[r["qid"]])
            continue
        x, a = np.array(r["v"]), raw[r["qid"]]
        on = [abs(np.linalg.norm(x - a) + np.linalg.norm(x - b) - np.linalg.norm(a - b)) < 1e-9 for b in same[r["qid"]]]
        assert any(on)


def test_a_query_travels_once_to_a_block_of_cells(spark, monkeypatch):
    """In many dimensions every cell is visited; rows sent grow with blocks, not with cells."""
    monkeypatch.setattr(nearest, "CELL_ROWS", 60)
    rng = np.random.default_rng(4)
    points = rng.normal(0, 1, (200, 12))
    written = []
    real = nearest.materialize
    monkeypatch.setattr(nearest, "materialize", lambda t: written.append(real(t)) or written[-1])
    got = {}
    for r in nearest.knn_graph(frame(spark, points), 3).collect():
        got.setdefault(r["src"], []).append((r["rank"], round(r["dist"], 9)))
    want = brute(points, 3, 2)
    assert {i: [d for _, d in sorted(v)] for i, v in got.items()} == {i: pytest.approx(d, abs=1e-7) for i, d in want.items()}
    asked = next(t for t in written if "visits" in t.columns)
    assert asked.agg(F.max(F.size("visits"))).first()[0] <= 8  # of 14 cells


@pytest.mark.parametrize("p", [1, 2])
def test_tree_of_halvings_equals_brute_force(spark, monkeypatch, p):
    """Cells of few rows, groups, values that half of the rows have, rows without a place, a far query."""
    monkeypatch.setattr(nearest, "LEAF_ROWS", 4)
    monkeypatch.setattr(nearest, "CELL_ROWS", 16)
    rng = np.random.default_rng(9)
    points = np.round(rng.normal(0, 3, (240, 2)) * [1, 100], 1)
    points[:100, 0] = 1.0
    points[100:130] = [2.0, 5.0]
    points[-1] = [900.0, -5000.0]
    groups = ["a" if i % 3 else "b" for i in range(240)]
    rows = [(i, [float(x) for x in v], g) for i, (v, g) in enumerate(zip(points, groups))]
    gone = [(1000, [None, 1.0], "a"), (1001, [1.0, float("nan")], "a"), (1002, [1.0, 1.0], None)]
    pts = spark.createDataFrame(rows + gone, "qid long, v array<double>, g string")
    got = {}
    for r in nearest.search(pts, pts.withColumnRenamed("qid", "did"), nearest.Metric(p), 3, exclude_self=True).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["did"]))
    for i, v in enumerate(points):
        d = [(nearest.minkowski(v[None], points[j][None], p)[0, 0], j) for j in range(240) if j != i and groups[j] == groups[i]]
        assert [j for _, j in sorted(got[i])] == [j for _, j in sorted(d)[:3]]
    assert set(got) == set(range(240))


def test_a_query_of_few_dimensions_meets_few_cells():
    """With eight times the rows in eight times the cells a query visits about as many as before."""
    rng = np.random.default_rng(3)
    visited = []
    for levels in (5, 8):
        points = rng.uniform(0, 1, (64 << levels, 2))
        tree = nearest.Halved.of(points, levels, 2.0)
        n, d = 2 << levels, 2
        count, lo, hi = np.zeros(n, int), np.full((n, d), np.inf), np.full((n, d), -np.inf)
        node = tree.home(points)[0] + (1 << levels)
        while node[0] > 0:
            np.add.at(count, node, 1), np.minimum.at(lo, node, points), np.maximum.at(hi, node, points)
            node = node // 2
        tree.summary[""] = (count, lo, hi)
        owner, _ = tree.visits(points[:500], [""] * 500, 5)
        visited.append(len(owner) / 500)
    assert visited[1] < 1.5 * visited[0] and visited[1] < 10


def test_products_measure_only_what_may_be_among_the_best():
    """Far from the origin products are off by more than neighbours differ; what comes back is exact all the same."""
    rng = np.random.default_rng(6)
    rows = 1000 + np.round(rng.normal(0, 1e-3, (300, 12)), 5)
    rows[200:] = rows[:100]
    ids = np.arange(300)
    parts = nearest._best(nearest.Metric(2.0), rows, rows, ids, ids, 4, True)
    q, r, score = (np.concatenate(x) for x in zip(*parts))
    exact = nearest.minkowski(rows, rows, 2.0)
    np.fill_diagonal(exact, np.inf)
    for i in range(300):
        want = np.lexsort((ids, exact[i]))[:4]
        assert r[q == i].tolist() == want.tolist() and score[q == i].tolist() == exact[i][want].tolist()
