import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakwork.functions import ranks


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; the rest has a long tail."""
    rng = np.random.default_rng(3)
    hot = np.full(400, 7.5)
    rest = np.round(np.exp(rng.normal(0, 4, 800)), 3)
    values = np.concatenate([hot, rest])
    rng.shuffle(values)
    rows = [(i, "a" if i % 3 else "b", float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, g string, v double"), rows


@pytest.mark.parametrize("per_bucket", [10_000, 50])
def test_quantiles_equal_numpy(skewed, monkeypatch, per_bucket):
    df, rows = skewed
    monkeypatch.setattr(ranks, "bucket_count", lambda n, per=per_bucket: max(1, -(-n // per_bucket)))
    got = {(r["g"], r["prob"]): r["quantile"] for r in ranks.exact_quantiles(df, ["v"], [0, 0.1, 0.5, 0.77, 1], ["g"]).collect()}
    for g in "ab":
        values = [r[2] for r in rows if r[1] == g]
        for p in (0, 0.1, 0.5, 0.77, 1):
            assert got[(g, p)] == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("bucketed", [False, True])
def test_rank_select_with_weights(spark, bucketed):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(v), int(w)) for g, v, w in zip(rng.integers(0, 3, 300), rng.integers(0, 40, 300), rng.integers(1, 9, 300))]
    df = spark.createDataFrame(rows, "g int, v double, w long").withColumn("b", F.floor(F.col("v") / 7).cast("int"))
    targets = df.groupBy("g").agg((F.floor(F.sum("w") / 2)).alias("rank"))
    out = ranks.rank_select(df, ["g"], "v", targets, "w", "b" if bucketed else None).collect()
    assert len(out) == 3
    for r in out:
        mine = sorted((v, w) for g, v, w in rows if g == r["g"])
        flat = [v for v, w in mine for _ in range(w)]
        value = flat[r["rank"] - 1]
        assert r["value"] == value
        assert r["below"] == sum(v < value for v in flat) and r["upto"] == sum(v <= value for v in flat)
        assert r["next_value"] == min((v for v in flat if v > value), default=None)
        assert (r["least"], r["most"], r["rows_all"]) == (flat[0], flat[-1], len(mine))


def test_ties_case(spark):
    """Median of 1,2,3,4,4,4,4: the split value is 3 and the next one 4."""
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 4, 4, 4)], "v double").withColumn("g", F.lit(0))
    targets = df.groupBy("g").agg(F.floor(F.count("*") / 2).alias("rank"))
    r = ranks.rank_select(df, ["g"], "v", targets).first()
    assert (r["value"], r["next_value"], r["upto"]) == (3.0, 4.0, 3)


@pytest.mark.parametrize("per_bucket", [10_000, 30])
def test_rank_within_hot_group(spark, per_bucket):
    df = spark.range(600).withColumn("g", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)))
    df = df.withColumn("u", F.rand(1))
    df = spark.createDataFrame(df.toPandas())
    out = ranks.rank_within(df, ["g"], "u", "id", 600, "r", per_bucket).toPandas()
    for _, part in out.groupby("g"):
        part = part.sort_values(["u", "id"])
        assert part["r"].tolist() == list(range(1, len(part) + 1))


def test_number_rows(spark):
    df = spark.createDataFrame([(w,) for w in "pear apple fig kiwi lime apricot".split()], "w string")
    got = {r["w"]: r["idx"] for r in ranks.number_rows(df, ["w"]).collect()}
    assert got == {w: i for i, w in enumerate(sorted(got))}


def test_running_sums_in_buckets(spark):
    rng = np.random.default_rng(0)
    pairs = sorted({float(v) for v in rng.integers(0, 500, 200)})
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(pairs)], "v double, s double")
    df = df.withColumn("b", F.floor(F.col("v") / 60).cast("int")).withColumn("g", F.lit(1))
    out = ranks.running_sums(df, ["g"], "v", ["s"], "b").orderBy("v").toPandas()
    assert np.allclose(out["run_s"], np.cumsum(np.arange(len(pairs))))
    assert out["next_value"].tolist()[:-1] == pairs[1:] and np.isnan(out["next_value"].iloc[-1])
