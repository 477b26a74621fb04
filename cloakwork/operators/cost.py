"""Information loss of putting a row into a cluster."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: attribute weights of the person table, per named emphasis
WEIGHT_VECTORS = {
    "equal": {
        "workclass": 1 / 6,
        "native-country": 1 / 6,
        "sex": 1 / 6,
        "race": 1 / 6,
        "marital-status": 1 / 6,
        "age": 1 / 6,
    },
    "emph_race": {
        "workclass": 0.02,
        "native-country": 0.02,
        "sex": 0.02,
        "race": 0.9,
        "marital-status": 0.02,
        "age": 0.02,
    },
    "emph_age": {
        "workclass": 0.02,
        "native-country": 0.02,
        "sex": 0.02,
        "race": 0.02,
        "marital-status": 0.02,
        "age": 0.9,
    },
}
# fixed values: weights of the information and of the structural loss
ALPHA, BETA = 1.0, 0.0


def range_cost(lo: Column, hi: Column, least: float, most: float, check: bool = False) -> Column:
    """Share of the column's whole range that [lo, hi] covers; a constant column costs nothing.

    ``check`` raises on inverted intervals and on values outside the column's range.
    """
    cost = (hi - lo) / F.lit(float(most - least)) if most > least else F.lit(0.0)
    if not check:
        return cost
    bad = (lo > hi) | (lo < F.lit(least)) | (hi > F.lit(most))
    return F.when(bad, F.raise_error(F.lit("interval is inverted or outside the range")).cast("double")).otherwise(cost)


def expanded_cost(value: Column, lo: Column, hi: Column, least: float, most: float) -> Column:
    """Range cost after stretching the interval to take in a value."""
    return range_cost(F.least(lo, value), F.greatest(hi, value), least, most)


def tree_cost(lca_level: Column, levels: int) -> Column:
    """Share of the tree's levels lost by generalizing to a common ancestor."""
    return (F.lit(float(levels)) - lca_level) / F.lit(float(levels))


def flat_cost(value: Column, cluster_value: Column) -> Column:
    """Two-level tree: half for the same value, all of it for ``*``."""
    return F.when((value == cluster_value) & (value != "*"), 0.5).otherwise(1.0)


def information_loss(costs: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    """Weighted sum of per-column costs; columns without a weight count one."""
    weights = weights or {}
    return sum((F.lit(float(weights.get(c, 1.0))) * cost for c, cost in costs.items()), F.lit(0.0))


def node_cost(loss: Column, alpha: float = ALPHA, beta: float = BETA) -> Column:
    """alpha * information loss + beta * structural loss; the structural part is zero by definition."""
    return F.lit(alpha) * loss + F.lit(beta) * F.lit(0.0)
