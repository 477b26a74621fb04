import numpy as np
import pytest

from cloakwork.operators import tree


def data(n, seed=4):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n), np.round(rng.normal(0, 1, n), 2), rng.integers(0, 2, n)], axis=1).astype(float)
    y = np.round(x[:, 0] * 2 + 3 * (x[:, 1] > 0.3) + rng.normal(0, 0.5, n), 3)
    return x, y


def deviation(y, loss):
    centre = np.median(y) if loss == "mad" else y.mean()
    return ((y - centre) ** 2).mean() if loss == "mse" else np.abs(y - centre).mean()


def split_by_hand(x, y, loss):
    best = (0.0, None, None)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for at in (values[:-1] + values[1:]) / 2:
            left = x[:, j] <= at
            share = left.mean()
            gain = deviation(y, loss) - share * deviation(y[left], loss) - (1 - share) * deviation(y[~left], loss)
            if gain > best[0] + 1e-9:
                best = (gain, j, at)
    return best


def grow_by_hand(x, y, depth, min_split, loss="mse"):
    gain, j, at = split_by_hand(x, y, loss) if depth > 0 and len(y) >= min_split else (0, None, None)
    if j is None:
        return lambda r: y.mean()
    left = x[:, j] <= at
    a, b = grow_by_hand(x[left], y[left], depth - 1, min_split, loss), grow_by_hand(x[~left], y[~left], depth - 1, min_split, loss)
    return lambda r: a(r) if r[j] <= at else b(r)


def frame(spark, x, y):
    rows = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


@pytest.mark.parametrize("local", [0, 25])
def test_tree_equals_recursion(spark, local):
    x, y = data(160)
    df = frame(spark, x, y)
    model = tree.fit_tree(df, "id", ["a", "b", "c"], "y", max_depth=4, min_split=8, local_rows=local)
    walk = grow_by_hand(x, y, 4, 8)
    got = {r["id"]: r["prediction"] for r in model.predict(df).collect()}
    assert all(got[i] == pytest.approx(walk(x[i]), abs=1e-9) for i in range(len(y)))
    joined = {r["id"]: r["prediction"] for r in model._predict_by_joins(df, "prediction").collect()}
    assert joined == {i: pytest.approx(v, abs=1e-9) for i, v in got.items()}


def test_feature_subsets_do_not_depend_on_where_a_node_is_finished(spark):
    x, y = data(200)
    df, found = frame(spark, x, y), []
    for local in (0, 20, 400):
        model = tree.fit_forest(df, "id", ["a", "b", "c"], "y", trees=3, max_depth=4, max_features=2, local_rows=local)
        found.append(sorted((r["tree"], r["node"], r["feature"], r["threshold"] and round(r["threshold"], 9), r["n"]) for r in model.nodes.collect() if r["feature"] >= 0))
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("loss", ["mse", "mae", "mad"])
def test_split_of_every_loss(spark, loss):
    x, y = data(120, seed=8)
    gain, j, at = split_by_hand(x, y, loss)
    r = tree.best_split(frame(spark, x, y), ["a", "b", "c"], "y", loss=loss).first()
    assert (r["column"], r["threshold"]) == ("abc"[j], pytest.approx(at)) and r["gain"] == pytest.approx(gain, abs=1e-9)


def test_bootstrap_is_poisson_and_forest_beats_the_mean(spark):
    x, y = data(300)
    df = frame(spark, x, y)
    w = tree.bootstrap_weights(df, "id", 20).groupBy("tree").sum("w").collect()
    assert all(200 < r[1] < 400 for r in w)
    model = tree.fit_forest(df, "id", ["a", "b", "c"], "y", trees=6, max_features=2, min_gain=0.001)
    pred = model.predict(df).toPandas()
    assert ((pred["prediction"] - pred["y"]) ** 2).mean() < 0.3 * y.var()


def test_unknown_loss(spark):
    x, y = data(10)
    with pytest.raises(ValueError):
        tree.fit_forest(frame(spark, x, y), "id", ["a"], "y", loss="huber")


@pytest.mark.parametrize("loss", ["mae", "mad"])
def test_absolute_losses_over_many_strips(spark, monkeypatch, loss):
    """Strips and bands of a few rows each give the same best split as all rows at once."""
    from cloakwork.operators import deviation

    monkeypatch.setattr(deviation, "STRIP_ROWS", 12)
    monkeypatch.setattr(deviation, "CHUNK_ROWS", 5)
    for seed in (2,):
        x, y = data(150, seed)
        y[::3] = 1.25  # a third of the labels are equal
        gain, j, at = split_by_hand(x, y, loss)
        r = tree.best_split(frame(spark, x, y), ["a", "b", "c"], "y", loss=loss).first()
        assert r["gain"] == pytest.approx(gain, abs=1e-9) and r["column"] == "abc"[j]
        assert r["threshold"] == pytest.approx(at)


@pytest.mark.parametrize("loss", ["mae", "mad"])
def test_absolute_tree_rounds(spark, loss):
    x, y = data(140, 6)
    df = frame(spark, x, y)
    model = tree.fit_tree(df, "id", ["a", "b", "c"], "y", max_depth=2, min_split=8, loss=loss, local_rows=0)
    walk = grow_by_hand(x, y, 2, 8, loss)
    got = {r["id"]: r["prediction"] for r in model.predict(df).collect()}
    assert all(got[i] == pytest.approx(walk(x[i]), abs=1e-9) for i in range(len(y)))


@pytest.mark.parametrize("loss", ["mae", "mad"])
def test_no_task_gathers_the_rows_of_one_value(spark, monkeypatch, loss):
    """A value that many rows have is judged by sums over bands, with the same result as the rows themselves."""
    from cloakwork.operators import deviation

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.choice([0.0, 1.0, 3.0], 400), rng.integers(0, 9, 60) / 2.0])
    y = np.round(rng.normal(0, 5, 460) + 3 * (x > 1), 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    whole = tree.best_split(df, ["x"], "y", loss=loss).first()
    seen = []
    monkeypatch.setattr(deviation, "STRIP_ROWS", 20)
    heads = deviation._single
    monkeypatch.setattr(deviation, "_single", lambda *a: seen.append(heads(*a)) or seen[-1])
    cut = tree.best_split(df, ["x"], "y", loss=loss).first()
    centre = np.mean if loss == "mae" else lambda v: np.sort(v)[(len(v) - 1) // 2]
    off = lambda v: np.abs(v - centre(v)).sum()
    cuts = sorted(set(x))
    gain, at = max((round((off(y) - off(y[x <= a]) - off(y[x > a])) / 460, 9), -(a + b) / 2) for a, b in zip(cuts, cuts[1:]))
    assert cut["threshold"] == whole["threshold"] == -at and cut["gain"] == pytest.approx(gain) and whole["gain"] == pytest.approx(gain)
    assert seen[0].count() >= 3


def test_impurity_moves_no_row_to_the_task_of_its_group(spark):
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in range(9)], "g string, y double")
    out = tree.impurity(df, "y", ["g"])
    assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    assert {(r["g"], round(r["mad"], 6)) for r in out.collect()} == {("a", 2.222222), ("b", 2.222222)}
