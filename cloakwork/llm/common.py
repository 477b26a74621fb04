"""What the operators share: the register of queries, guarded joins, prefix sums."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rows of a side that may be sent to every executor; wider sides are shuffled.
BROADCAST_ROWS = 500_000


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: str, size: int = 1 << 20, lower: bool = False) -> Iterator[list[bytes]]:
    """Stretches between ASCII blanks, in lists that stand for ``size`` bytes and one word at most; ``lower`` maps A-Z."""
    data = text.encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        blank = _BLANK.search(data, at + size)
        end = blank.start() if blank else len(data)
        piece = data[at:end]
        yield (piece.lower() if lower else piece).split()
        at = end


def text_key(text: Column | str) -> list[Column]:
    """Two 64-bit hashes that stand for a text (null counts as empty)."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows with columns c0, c1, ..., so that added names cannot clash; the new name of each column."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()]), names


def shown(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the original columns, under their names."""
    return df.select(*[F.col(x).alias(c) for c, x in names.items()])


def guarded(side: DataFrame, rows: int) -> DataFrame:
    """Mark a written table of narrow rows for broadcast only while it is small."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    """Join condition under which null equals null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def slices_for(rows: int) -> int:
    """So many slices that neither a slice nor the list of slices grows beyond the root of the rows."""
    return max(1, math.ceil(rows / max(1000, math.isqrt(rows))))


def prefix_sums(df: DataFrame, by: list[str], u: str, tie: list[str], value: Column, name: str, rows: int) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, in the order of ``u`` in [0, 1) and ``tie``.

    A group is cut by ``u`` into slices, so no task sorts more than a slice, however
    large the group is.
    """
    slices = slices_for(rows)
    df = df.withColumn("_slice", F.floor(F.col(u) * slices).cast("int")).withColumn("_value", value)
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*by, "_slice").agg(F.sum("_value").alias("_sum"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inner = Window.partitionBy(*by, "_slice").orderBy(u, *tie).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_in", F.coalesce(F.sum("_value").over(inner), F.lit(0)))
    return df.join(starts, [*by, "_slice"]).withColumn(name, F.col("_in") + F.col("_start")).drop("_slice", "_value", "_in", "_start")
