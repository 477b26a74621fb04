"""Writers.  All of them write one file per task; nothing passes the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.scalar import cluster_category, cluster_interval
from cloakwork.roles import AnonSpec


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> str:
    df.write.option("header", True).option("sep", sep).mode(mode).csv(path)
    return path


def write_grid_overview(results: DataFrame, path: str, by: str) -> str:
    """Search results, best first."""
    return write_csv(results.orderBy(F.desc(by), *[c for c in results.columns if c != by]), path)


def write_scores(scored: DataFrame, path: str, id_col: str = "ID", label: str = "class") -> str:
    return write_csv(scored.select(id_col, F.col("prediction").alias(label)), path)


def write_anonymized(df: DataFrame, spec: AnonSpec, folder: str, dataset: str) -> str:
    """``;`` separated, quasi-identifiers then sensitive attribute."""
    path = f"{folder}/{dataset}_global_k{spec.k}.csv"
    return write_csv(spec.project(df), path, sep=";")


def write_features(df: DataFrame, info: dict, path: str) -> str:
    """Features and target in one parquet table (lists stay lists) plus a metadata side file."""
    df.write.parquet(f"{path}/data")
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(info),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return path


def cluster_lines(members: DataFrame, numeric: list[str], categorical: list[str], root: str = "all") -> DataFrame:
    """One generalized line per member: ranges first, then categories."""
    cells = [cluster_interval(f"{c}_min", f"{c}_max") for c in numeric]
    cells += [cluster_category(c, root) for c in categorical]
    return members.select(F.concat_ws(", ", *cells).alias("value"))


def write_clusters(members: DataFrame, numeric: list[str], categorical: list[str], path: str) -> str:
    cluster_lines(members, numeric, categorical).write.text(path)
    return path
