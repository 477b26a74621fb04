"""Grids whose points share their work, against fits of their own."""

import threading

from cloakwork.plans import evaluate
from cloakwork.plans.catalog import files
from cloakwork.plans.evaluate import Problem


def test_logistic_fits_that_ended_by_themselves_serve_longer_limits(spark, monkeypatch):
    df = spark.range(60).selectExpr("id", "cast(id * 37 % 11 as double) - 5 a", "cast(id * 7 % 13 as double) - 6 b", "cast(id % 5 > id * 37 % 11 % 4 as string) y", "cast(id % 2 as int) fold")
    p, made, plain = Problem(df, "id", "y"), [], evaluate.logistic_regression

    def counted(**setting):
        made.append(setting)
        return plain(**setting)

    monkeypatch.setattr(evaluate, "logistic_regression", counted)
    settings = [{"solver": "lbfgs", "tol": 1e-4, "c": 1, "max_iter": n} for n in (1, 200, 1000)]
    got = evaluate.logistic_predictions(p, df, settings)
    assert sorted(s["max_iter"] for s in made) == [1, 1, 200, 200]
    for i, setting in enumerate(settings):
        for fold in (0, 1):
            predict = plain(**setting)(p, df.filter(f"fold <> {fold}").drop("fold"))
            want = predict(df.filter(f"fold = {fold}").drop("fold")).select("y", "prediction").collect()
            found = got.filter(f"setting = {i} and fold = {fold}").select("label", "prediction").collect()
            assert sorted(map(tuple, found)) == sorted(map(tuple, want))


def test_folds_are_recoded_side_by_side(spark, sf, monkeypatch):
    """No fold waits for the one before: all five stand at the fit of their clusters together."""
    meet, fit = threading.Barrier(5, timeout=60), files.clusters.fit_clusters
    monkeypatch.setattr(files.clusters, "fit_clusters", lambda *args, **options: (meet.wait(), fit(*args, **options))[1])
    rows = files.anonymity_in_folds(spark, sf).collect()
    assert sorted(r["fold"] for r in rows) == list(range(5)) and all(r["at_least_k"] for r in rows)


def test_steps_of_a_fold_are_fitted_once_for_all_models(spark):
    df = spark.range(40).selectExpr("id", "cast(id as double) a", "cast(id % 2 as string) y", "cast(id % 4 as int) fold")
    p, made = Problem(df.drop("fold"), "id", "y"), []
    steps = lambda: evaluate.Steps([lambda rows: made.append(1) or evaluate.Mapping(lambda d: d.withColumn("a", d.a * 2))])
    models = {name: evaluate.stump() for name in ("one", "two", "three")}
    scores = evaluate.cross_validate(p, models, df, "doubled", steps).filter("metric = 'accuracy'").collect()
    assert len(made) == 4 and len({(r.model, r.fold) for r in scores}) == 12
