import random

import pytest
from pyspark.sql import functions as F

from cloakwork.operators.mondrian import anonymity_report, mondrian, ncp_percent


def by_hand(rows, k, strict):
    """Recursive re-derivation.  ``rows`` are (tie order, values...); returns class boxes."""
    d = len(rows[0]) - 1
    at = lambda r, j: r[j + 1]
    full = [max(at(r, j) for r in rows) - min(at(r, j) for r in rows) for j in range(d)]
    out = []

    def grow(members, lo, hi):
        lo, hi, open_dims, n = list(lo), list(hi), set(range(d)), len(members)
        norm = lambda j: 1.0 if hi[j] - lo[j] == full[j] else (hi[j] - lo[j]) / full[j]
        while open_dims:
            j = min(open_dims, key=lambda j: (-norm(j), j))
            open_dims.discard(j)
            ordered = sorted(members, key=lambda r: (at(r, j), r[0]))
            lo[j], hi[j] = at(ordered[0], j), at(ordered[-1], j)
            if n // 2 < k or lo[j] == hi[j]:
                continue
            split = at(ordered[n // 2 - 1], j)
            left = [r for r in ordered if at(r, j) <= split] if strict else ordered[: n // 2]
            right = [r for r in ordered if at(r, j) > split] if strict else ordered[n // 2 :]
            if len(left) < k or len(right) < k:
                continue
            up, down = list(hi), list(lo)
            up[j], down[j] = split, at(right[0], j)
            grow(left, lo, up)
            grow(right, down, hi)
            return
        out.append(members)

    start = [min(at(r, j) for r in rows) for j in range(d)], [max(at(r, j) for r in rows) for j in range(d)]
    grow(list(rows), *start)
    box = lambda m: tuple(x for j in range(d) for x in (min(at(r, j) for r in m), max(at(r, j) for r in m)))
    return sorted((len(m), *box(m)) for m in out)


def random_rows(seed, n, d, span, constant=False):
    rnd = random.Random(seed)
    pick = lambda j: 7.0 if constant and j == d - 1 else float(rnd.choice([rnd.randint(-span, span), 0, span]))
    return [tuple(pick(j) for j in range(d)) for _ in range(n)]


CASES = [(120, 2, 5, 3, False), (70, 3, 3, 8, True), (5, 2, 3, 5, False)]


@pytest.mark.parametrize("n,d,k,span,constant", CASES)
@pytest.mark.parametrize("local,per_bucket", [(1, 500_000), (12, 500_000), (8, 9)])
def test_strict_equals_recursion(spark, n, d, k, span, constant, local, per_bucket):
    data = random_rows(n, n, d, span, constant)
    qi = [f"x{j}" for j in range(d)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], ["id", *qi])
    result = mondrian(df, qi, k, True, local_tuples=local, tuples_per_bucket=per_bucket)
    got = sorted(tuple(r)[1:] for r in result.table().collect())
    assert got == by_hand([(i, *r) for i, r in enumerate(data)], k, True)
    labelled = result.label(df, "id")
    assert sorted(r["count"] for r in labelled.groupBy("ec_id").count().collect()) == sorted(g[0] for g in got)


@pytest.mark.parametrize("local,per_bucket", [(1, 500_000), (12, 500_000), (10, 9)])
@pytest.mark.parametrize("n,d,k,span,constant", CASES[1:2])
def test_relaxed_equals_recursion(spark, n, d, k, span, constant, local, per_bucket):
    data = random_rows(n, n, d, span, constant)
    qi = [f"x{j}" for j in range(d)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], ["id", *qi])
    result = mondrian(df, qi, k, False, local_tuples=local, tuples_per_bucket=per_bucket)
    got = sorted(tuple(r)[1:] for r in result.table().collect())
    # ties go left in the order of the tuples' values
    assert got == by_hand([(r, *r) for r in data], k, False)
    sizes = result.label(df, "id").groupBy("ec_id").count().collect()
    assert sorted(r["count"] for r in sizes) == sorted(g[0] for g in got)
    assert len({r["id"] for r in result.label(df, "id").collect()}) == n


def test_relaxed_classes_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(random_rows(3, 150, 3, 3))], ["id", "a", "b", "c"])
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (1, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            result = mondrian(df.repartition(parts, "b"), ["a", "b", "c"], 4, False, local_tuples=5 * parts)
            found.append(sorted(tuple(r) for r in result.table().collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_hot_combination_and_small_table(spark):
    """A third of the rows share all values: they stay together and nothing is lost."""
    df = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.col("id") * 1.0).alias("a"), F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") % 7 * 1.0).alias("b")
    )
    for strict in (True, False):
        result = mondrian(df, ["a", "b"], 10, strict)
        labelled = result.label(df, "id")
        report = anonymity_report(labelled, ["ec_id"], 10).first()
        assert labelled.count() == 900 and report["violating_rows"] == 0
        loss = ncp_percent(result.table(), ["a", "b"], result.ranges).first()
        assert 0 <= loss["ncp_percent"] <= 100
    few = mondrian(df.limit(5), ["a", "b"], 10)
    assert few.table().count() == 1


def test_null_quasi_identifier_is_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id int, a double")
    with pytest.raises(ValueError):
        mondrian(df, ["a"], 2)
