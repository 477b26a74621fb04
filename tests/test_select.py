import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakwork.operators import select


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def by_hand(values, labels, k):
    """All distances: the k-th neighbour of the class, then the rows of any class nearer than it."""
    sizes = {c: labels.count(c) for c in set(labels)}
    rows = [(v, c) for v, c in zip(values, labels) if sizes[c] > 1 and v is not None]
    total = 0.0
    for i, (v, c) in enumerate(rows):
        own = sorted(abs(v - w) for j, (w, b) in enumerate(rows) if b == c and j != i)
        kk = min(k, len(own))
        d = own[kk - 1]
        near = sum(abs(v - w) < d if d > 0 else v == w for w, _ in rows)
        total += psi(kk) - psi(len(own) + 1) - psi(near)
    return max(0.0, psi(len(rows)) + total / len(rows))


@pytest.mark.parametrize("per_bucket", [7, 40, 1000])
def test_neighbour_information(spark, per_bucket):
    rng = np.random.default_rng(3)
    labels = ["abc"[int(x)] for x in rng.integers(0, 3, 120)] + ["rare", "two", "two"]
    rows = []
    for c in labels:
        shift = {"a": 0, "b": 1, "c": 3}.get(c, 2)
        # powers of two keep the differences of doubles exact
        rows.append((c, float(shift + rng.integers(0, 64) / 16), float(rng.integers(0, 5)), float(rng.integers(0, 4096) / 64)))
    df = spark.createDataFrame(rows, "c string, x double, y double, z double").repartition(4)
    got = {r["column"]: r["mutual_information"] for r in select.neighbour_information(df, ["x", "y", "z"], "c", per_bucket=per_bucket).collect()}
    for j, name in enumerate("xyz", 1):
        assert got[name] == pytest.approx(by_hand([r[j] for r in rows], labels, 3), abs=1e-9), name


def test_select_best(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 2, float(rng.normal() + 4 * (i % 2)), float(rng.normal()), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "c int, x double, y double, flat double")
    for score in ("mutual_information", "f_value"):
        kept, names = select.select_best(df, ["x", "y"] if score == "f_value" else ["x", "y", "flat"], "c", 1, score)
        assert names == ["x"] and "y" not in kept.columns
    holes = df.withColumn("x", F.when(F.rand(1) < 0.3, None).otherwise(F.col("x")))
    assert select.neighbour_information(holes, ["x", "flat"], "c").count() == 2
    assert math.isclose(select.neighbour_information(df, ["flat"], "c").first()[1], 0.0, abs_tol=1e-9)


def test_buckets_follow_distinct_values(spark, monkeypatch):
    """Rows that repeat a value make neither more buckets nor more work for the quantiles."""
    seen = []
    plain = select.quantile_bounds
    monkeypatch.setattr(select, "quantile_bounds", lambda df, cols, buckets: seen.append((df.count(), buckets)) or plain(df, cols, buckets))
    df = spark.range(4000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 2).alias("y"))
    got = {r["column"]: r["mutual_information"] for r in select.neighbour_information(df, ["a", "b"], "y", per_bucket=100).collect()}
    assert seen == [(24, 1)]
    monkeypatch.undo()
    fine = {r["column"]: r["mutual_information"] for r in select.neighbour_information(df, ["a", "b"], "y", per_bucket=3).collect()}
    assert set(got) == set(fine) == {"a", "b"} and all(abs(got[c] - fine[c]) < 1e-12 for c in got)
