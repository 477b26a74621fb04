"""Train/validation splits as columns; membership is a hash of the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.hashing import unit_hash
from cloakwork.functions.ranks import rank_within


def holdout(df: DataFrame, key: str, frac: float = 0.2, seed: object = 42) -> DataFrame:
    """Column ``part``: ``valid`` for about ``frac`` of the rows, else ``train``."""
    return df.withColumn("part", F.when(unit_hash(key, seed) < frac, "valid").otherwise("train"))


def kfold(df: DataFrame, key: str, folds: int = 5, seed: object = 42) -> DataFrame:
    """Column ``fold`` in 0..folds-1, equal sizes in expectation, no shuffle."""
    return df.withColumn("fold", F.floor(unit_hash(key, seed) * folds).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, folds: int = 5, seed: object = 42) -> DataFrame:
    """Column ``fold`` with class counts that differ by at most one between folds."""
    ranked = rank_within(df.withColumn("_u", unit_hash(key, seed)), [label], "_u", key, df.count(), "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_u", "_rank")
