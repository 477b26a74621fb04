"""Scans."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakwork.functions.hashing import unit_hash
from cloakwork.functions.scalar import coerce_timestamp
from cloakwork.roles import AnonSpec, numeric_columns


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    null_token: str | None = None,
) -> DataFrame:
    """Header CSV; pass a schema at scale, inference costs a second scan."""
    reader = spark.read.option("header", True).option("sep", sep)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles}) if doubles else df


def split_lines(lines: DataFrame, sep: str = ",", column: str = "value") -> DataFrame:
    return lines.withColumn("fields", F.split(F.col(column), f"\\Q{sep}\\E", -1))


def wide_enough(lines: DataFrame, fields: int, sep: str = ",", column: str = "value") -> DataFrame:
    """Lines with at least ``fields`` fields; empty lines go as well."""
    out = split_lines(lines, sep, column)
    return out.filter((F.trim(F.col(column)) != "") & (F.size("fields") >= fields))


def complete_lines(lines: DataFrame, sep: str = ",", column: str = "value") -> DataFrame:
    """Lines without ``?`` and without an empty field, fields trimmed."""
    out = split_lines(lines, sep, column).filter(~F.col(column).contains("?"))
    out = out.withColumn("fields", F.transform("fields", lambda x: F.trim(x)))
    return out.filter(~F.exists("fields", lambda x: x == ""))


def parse_microdata(
    lines: DataFrame,
    qi: dict[str, tuple[int, str]],
    sa: tuple[str, int],
    sep: str = ",",
    time_format: str = "yyyy-MM-dd HH:mm:ss",
    column: str = "value",
) -> DataFrame:
    """Quasi-identifiers by position, then the sensitive attribute.

    ``qi`` maps a name to (index, kind) with kind ``number``, ``category`` or
    ``datetime``.  Categories stay text here; code them with a fitted dictionary.
    """
    def parsed(index: int, kind: str) -> Column:
        raw = F.get(F.col("fields"), F.lit(index))
        if kind == "number":
            return raw.try_cast("double")
        return coerce_timestamp(raw, time_format) if kind == "datetime" else raw

    out = complete_lines(lines, sep, column)
    return out.select(
        *[parsed(i, kind).alias(name) for name, (i, kind) in qi.items()],
        F.get(F.col("fields"), F.lit(sa[1])).alias(sa[0]),
    )


def read_microdata(spark: SparkSession, path: str, qi, sa, header: bool = True, sep: str = ",", **kw) -> DataFrame:
    """Microdata from a delimited file; the header line repeats per file and is dropped by content."""
    lines = spark.read.text(path)
    if header:
        first = spark.read.text(path).limit(1).first()
        lines = lines.filter(F.col("value") != (first["value"] if first else ""))
    return parse_microdata(lines, qi, sa, sep, **kw)


def read_persons(spark: SparkSession, path: str) -> DataFrame:
    """Keyed person table with one numeric and five category columns."""
    schema = (
        "id bigint, age bigint, workclass string, `native-country` string, sex string, race string, `marital-status` string"
    )
    df = read_csv(spark, path, schema)
    return df.withColumns({c: F.trim(F.col(f"`{c}`")) for c in df.columns[2:]})


def parse_adjacency(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id,n1,n2,...,`` lines to edges (src, dst, position); the last token is dropped."""
    parts = F.split(F.col(column), ",")
    body = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    return lines.select(
        F.trim(parts[0]).cast("bigint").alias("src"), F.posexplode(body).alias("position", "token")
    ).select("src", F.trim("token").cast("bigint").alias("dst"), "position")


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return parse_adjacency(spark.read.text(path))


def sample(df: DataFrame, key: str, frac: float, seed: object = 42) -> DataFrame:
    """Row sample decided by a hash of the key: repeatable, no shuffle."""
    return df.filter(unit_hash(key, seed) < frac)


def load_features(spark: SparkSession, path: str, target: str) -> tuple[DataFrame, dict]:
    """Features with target plus the stored column roles.

    Without a metadata file every numeric column counts as numeric.
    """
    df = spark.read.parquet(f"{path}/data")
    try:
        text = "".join(r["value"] for r in spark.read.text(f"{path}/metadata").collect())  # one small JSON file
        info = json.loads(text)
    except Exception as e:  # missing side file
        if "PATH_NOT_FOUND" not in str(e):
            raise
        info = {
            "range_cols": [],
            "cat_cols": [],
            "num_cols": [c for c in numeric_columns(df) if c != target],
            "processed_columns": [c for c in df.columns if c != target],
            "target_col": target,
        }
    return df, info


def spec_from(config: dict) -> AnonSpec:
    """AnonSpec from a plain dictionary of options."""
    return AnonSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in config.items()})
