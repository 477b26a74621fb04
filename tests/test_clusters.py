import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakwork.operators import cost, nearest
from cloakwork.operators.clusters import fit_clusters


def people(n, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), float(rng.integers(18, 60)), float(rng.normal()), str(rng.choice(list("abc")))) for i in range(n)]


SCHEMA = "id long, age double, score double, job string"


def greedy_by_hand(rows, k):
    span = [max(r[c] for r in rows) - min(r[c] for r in rows) for c in (1, 2)]
    free, groups = list(rows), []

    def stretch(group, r):
        total = sum((max(x[c] for x in [*group, r]) - min(x[c] for x in [*group, r])) / s for c, s in zip((1, 2), span))
        return total + (0.5 if {x[3] for x in group} == {r[3]} else 1.0)

    while free:
        group = [free.pop(0)]
        while len(group) < k and free:
            best = min(free, key=lambda r: (round(stretch(group, r), 12), r[0]))
            free.remove(best)
            group.append(best)
        groups.append(sorted(r[0] for r in group))
    return sorted(groups)


def test_single_block_equals_sequential_greedy(spark):
    rows = people(43)
    df = spark.createDataFrame(rows, SCHEMA)
    fitted = fit_clusters(df.withColumn("all", F.lit(1)), "id", ["age", "score"], ["job"], 4, leftover="keep", block="all")
    members = {}
    for r in fitted.members.collect():
        members.setdefault(r["cluster_id"], []).append(r["id"])
    assert sorted(map(sorted, members.values())) == greedy_by_hand(rows, 4)


@pytest.mark.parametrize("block", [12, 500])
def test_published_groups_have_k_rows(spark, block):
    df = spark.createDataFrame(people(130), SCHEMA)
    fitted = fit_clusters(df, "id", ["age", "score"], ["job"], 5, block_rows=block)
    out = fitted.publish(df)
    assert out.count() == 130
    groups = out.groupBy("age_min", "age_max", "score_min", "score_max", "job").count()
    assert groups.agg(F.min("count")).first()[0] >= 5
    inside = out.join(df.select("id", "age", "score", F.col("job").alias("raw")), "id")
    bad = inside.filter(~F.col("age").between(F.col("age_min"), F.col("age_max")) | ((F.col("job") != "*") & (F.col("job") != F.col("raw"))))
    assert bad.count() == 0


def test_repeated_rows_are_one_cluster_without_search(spark):
    rows = [(i, 30.0, 1.0, "a") for i in range(400)] + [(1000 + r[0], *r[1:]) for r in people(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    fitted = fit_clusters(df, "id", ["age", "score"], ["job"], 5, block_rows=20)
    sizes = fitted.members.groupBy("cluster_id").count()
    assert sizes.agg(F.sum("count"), F.min("count")).first()[0] == 460
    assert sizes.agg(F.min("count")).first()[0] >= 5


def test_microaggregated_values_are_means_and_modes(spark):
    df = spark.createDataFrame(people(60), SCHEMA)
    fitted = fit_clusters(df, "id", ["age", "score"], ["job"], 6, block_rows=20, output="mean")
    joined = fitted.publish(df).join(df.select("id", F.col("age").alias("raw")), "id")
    gap = joined.groupBy("cluster_id").agg(F.abs(F.avg("raw") - F.first("age")).alias("g"), F.count("*").alias("n"))
    assert gap.agg(F.max("g")).first()[0] < 1e-9 and gap.agg(F.min("n")).first()[0] >= 6


def test_assignment_equals_full_comparison(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL_ROWS", 3)
    monkeypatch.setattr(nearest, "TILE_ROWS", 4)
    df = spark.createDataFrame(people(150), SCHEMA)
    fitted = fit_clusters(df, "id", ["age", "score"], ["job"], 5, weights={"score": 0.3}, block_rows=30)
    new = people(80, seed=9) + [(500, 99.0, 9.0, "z")]
    got = {r["id"]: (r["cluster_id"], r["cost"]) for r in fitted.assign(spark.createDataFrame(new, SCHEMA)).collect()}
    boxes = sorted(fitted.boxes.collect(), key=lambda b: b["cluster_id"])
    (a0, a1), (s0, s1) = fitted.bounds["age"], fitted.bounds["score"]
    for r in new:
        age, score = min(max(r[1], a0), a1), min(max(r[2], s0), s1)
        costs = [
            (max(b["age_max"], age) - min(b["age_min"], age)) / (a1 - a0)
            + 0.3 * (max(b["score_max"], score) - min(b["score_min"], score)) / (s1 - s0)
            + (0.5 if b["job"] == r[3] else 1.0)
            for b in boxes
        ]
        i = int(np.argmin(np.round(costs, 12)))
        assert got[r[0]][1] == pytest.approx(min(costs), abs=1e-9)
        assert got[r[0]][0] == boxes[i]["cluster_id"]


def test_smoke_table(spark):
    """Five rows, k = 2: two clusters, nobody lost."""
    rows = [(0, 25.0, 1.0, "m"), (1, 30.0, 1.0, "m"), (2, 45.0, 0.0, "f"), (3, 35.0, 0.0, "f"), (4, 50.0, 1.0, "m")]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = fit_clusters(df, "id", ["age", "score"], ["job"], 2, block_rows=2).members.groupBy("cluster_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [2, 3]


JOBS = {  # value: parent, level
    "all": ("all", 0), "office": ("all", 1), "field": ("all", 1), "clerk": ("office", 2), "boss": ("office", 2),
    "farm": ("field", 2), "crop": ("farm", 3), "herd": ("farm", 3), "mine": ("field", 2),
}


def up(v):
    return [v] if JOBS[v][1] == 0 else [v, *up(JOBS[v][0])]


def lca(a, b):
    return next(x for x in up(a) if x in up(b))


def tree_by_hand(rows, k):
    """The sequential greedy over an age range and a tree of three levels; the cluster goes up node by node."""
    span = max(r[1] for r in rows) - min(r[1] for r in rows)
    free, groups = list(rows), []
    while free:
        first = free.pop(0)
        ids, lo, hi, node = [first[0]], first[1], first[1], first[2]
        while len(ids) < k and free:
            loss = lambda r: (max(hi, r[1]) - min(lo, r[1])) / span + 0.7 * (3 - JOBS[lca(node, r[2])][1]) / 3
            best = min(free, key=lambda r: (round(loss(r), 12), r[0]))
            free.remove(best)
            ids.append(best[0])
            lo, hi, node = min(lo, best[1]), max(hi, best[1]), lca(node, best[2])
        groups.append((tuple(sorted(ids)), lo, hi, node))
    return sorted(groups)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_greedy_equals_sequential_greedy(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, float(rng.integers(18, 60)), str(rng.choice(["clerk", "boss", "crop", "herd", "mine", "farm"]))) for i in range(37)]
    df = spark.createDataFrame(rows, "id long, age double, job string").withColumn("all", F.lit(1))
    tree = spark.createDataFrame([(v, p, n, v) for v, (p, n) in JOBS.items()], "value string, parent string, level int, name string")
    fitted = fit_clusters(df, "id", ["age"], ["job"], 4, {"job": 0.7}, block="all", leftover="keep", trees={"job": tree})
    out = fitted.publish(df).groupBy("cluster_id", "age_min", "age_max", "job").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    want = tree_by_hand(rows, 4)
    assert sorted((tuple(r.ids), r.age_min, r.age_max, r.job) for r in out.collect()) == want
    new = [(100 + i, float(20 + 3 * i), j) for i, j in enumerate(["crop", "herd", "boss", "mine", "pilot", "farm"])]
    got = {r.id: (r.cluster_id, r.cost) for r in fitted.assign(spark.createDataFrame(new, "id long, age double, job string")).collect()}
    boxes = sorted(fitted.boxes.collect(), key=lambda b: b["cluster_id"])
    lo, hi = min(r[1] for r in rows), max(r[1] for r in rows)
    for i, age, job in new:
        age = min(max(age, lo), hi)
        level = lambda b: JOBS[lca(b["job"], job)][1] if job in JOBS else 0
        costs = [(max(b["age_max"], age) - min(b["age_min"], age)) / (hi - lo) + 0.7 * (3 - level(b)) / 3 for b in boxes]
        assert got[i][1] == pytest.approx(min(costs), abs=1e-9)
        assert got[i][0] == boxes[int(np.argmin(np.round(costs, 12)))]["cluster_id"]


def test_blocks_are_named(spark):
    df = spark.createDataFrame(people(20), SCHEMA)
    with pytest.raises(ValueError, match="block"):
        fit_clusters(df, "id", ["age"], ["job"], 2)


@pytest.mark.parametrize("n", [400, 4000])
def test_blocks_follow_one_rule_at_every_size(spark, n):
    """Blocks have at least 50 rows and, as splits of 100 and more rows go on, fewer than 200."""
    df = spark.createDataFrame(people(n), SCHEMA)
    fitted = fit_clusters(df, "id", ["age", "score"], ["job"], 5, block_rows=50)
    sizes = fitted.members.groupBy(F.substring_index("cluster_id", ":", 1).alias("b")).count().agg(F.min("count"), F.max("count")).first()
    assert sizes[0] >= 50 and sizes[1] < 200


def test_costs(spark):
    df = spark.createDataFrame([(3.0, 5.0, "a", "a"), (0.0, 10.0, "a", "b"), (2.0, 2.0, "*", "*")], "lo double, hi double, v string, c string")
    out = df.select(
        cost.range_cost(F.col("lo"), F.col("hi"), 0, 10).alias("r"),
        cost.range_cost(F.col("lo"), F.col("hi"), 4, 4).alias("constant"),
        cost.flat_cost(F.col("v"), F.col("c")).alias("f"),
    ).collect()
    assert [tuple(r) for r in out] == [(0.2, 0.0, 0.5), (1.0, 0.0, 1.0), (0.0, 0.0, 1.0)]
    with pytest.raises(Exception, match="outside"):
        df.select(cost.range_cost(F.col("hi"), F.col("lo"), 0, 10, check=True)).collect()
