"""Exact order statistics without ever sorting a whole group in one task.

A group of any size is cut into value buckets whose bounds are rough quantiles of
the column (one mergeable sketch per column, at most ``MOST_BUCKETS`` numbers on the
driver).  Bucket totals are tiny, so their running sums are cheap; only inside a
bucket are single values sorted, after equal values were merged on the map side.
The sketch decides how even the work is, never what the answer is.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakwork.session import materialize

ROWS_PER_BUCKET = 100_000
MOST_BUCKETS = 4096


def bucket_count(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, min(MOST_BUCKETS, math.ceil(rows / per_bucket)))


def quantile_bounds(df: DataFrame, cols: list[str], buckets: int) -> dict[str, list[float]]:
    """Inner bucket bounds per column; empty lists when one bucket is enough."""
    if buckets <= 1 or not cols:
        return {c: [] for c in cols}
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10 * buckets).alias(c) for c in cols]).first()
    return {c: sorted(set(row[c] or [])) for c in cols}


def add_buckets(df: DataFrame, bounds: dict[str, list[float]], suffix: str = "__b") -> DataFrame:
    """Add ``<col>__b``, the bucket number of each column (0 without bounds)."""
    plain = [c for c, b in bounds.items() if not b]
    cut = [c for c, b in bounds.items() if b]
    df = df.withColumns({c + suffix: F.lit(0) for c in plain}) if plain else df
    if cut:
        inf = float("inf")
        df = df.withColumns({c + suffix + "x": F.col(c).cast("double") for c in cut})
        df = Bucketizer(
            splitsArray=[[-inf, *bounds[c], inf] for c in cut],
            inputCols=[c + suffix + "x" for c in cut],
            outputCols=[c + suffix for c in cut],
            handleInvalid="keep",
        ).transform(df)
        df = df.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in cut})
        df = df.drop(*[c + suffix + "x" for c in cut])
    return df


def running_sums(
    df: DataFrame, by: list[str], value: str, sums: list[str], bucket: str | None = None
) -> DataFrame:
    """Inclusive running sums ``run_<s>`` and the following value ``next_value``.

    ``df`` has one row per (by, value).  With ``bucket`` (a monotone function of the
    value) sums run inside buckets and are lifted by the totals of earlier buckets.
    """
    if bucket is None:
        win = Window.partitionBy(*by).orderBy(value)
        return df.withColumns(
            {f"run_{s}": F.sum(s).over(win) for s in sums} | {"next_value": F.lead(value).over(win)}
        )
    totals = df.groupBy(*by, bucket).agg(*[F.sum(s).alias(f"t_{s}") for s in sums], F.min(value).alias("t_min"))
    win = Window.partitionBy(*by).orderBy(bucket)
    totals = totals.select(
        *by,
        bucket,
        *[(F.sum(f"t_{s}").over(win) - F.col(f"t_{s}")).alias(f"o_{s}") for s in sums],
        F.lead("t_min").over(win).alias("o_next"),
    )
    inner = Window.partitionBy(*by, bucket).orderBy(value)
    local = df.withColumns(
        {f"run_{s}": F.sum(s).over(inner) for s in sums} | {"next_value": F.lead(value).over(inner)}
    )
    out = local.join(totals, [*by, bucket])
    return out.withColumns(
        {f"run_{s}": F.col(f"run_{s}") + F.col(f"o_{s}") for s in sums}
        | {"next_value": F.coalesce("next_value", "o_next")}
    ).drop(*[f"o_{s}" for s in sums], "o_next")


def rank_select(
    items: DataFrame,
    by: list[str],
    value: str,
    targets: DataFrame | list[float],
    weight: str | None = None,
    bucket: str | None = None,
) -> DataFrame:
    """Value at a 1-based rank, for every row (by..., rank) of ``targets``.

    ``targets`` may also be a list of probabilities; then the rank follows from the
    size of each group and ``prob`` and ``frac`` (the way to the next rank) are added.

    Adds ``value``, ``below`` and ``upto`` (weight strictly before it and including
    it), ``rows_below`` and ``rows_upto`` (the same in rows), ``next_value`` (the
    following distinct value, null at the end) and the ends of the whole group:
    ``least``, ``most`` and ``rows_all``.
    """
    n = F.count(F.lit(1))
    w = F.sum(weight) if weight else n
    group = Window.partitionBy(*by)
    found = ["value", "below", "upto", "rows_below", "rows_upto", "next_value", "least", "most", "rows_all"]
    names = [*by, "prob", "rank", "frac"] if isinstance(targets, list) else list(targets.columns)

    def aimed(df: DataFrame, below: Column, upto: Column, total: Column) -> DataFrame:
        """Keep the rows whose span (below, upto] holds a target."""
        if not isinstance(targets, list):
            return df.join(targets, by).filter((upto >= F.col("rank")) & (below < F.col("rank")))
        spots = []
        for p in targets:
            pos = F.lit(float(p)) * (total - 1)
            rank = (F.floor(pos) + 1).cast("bigint")
            spots.append(F.struct(F.lit(float(p)).alias("prob"), rank.alias("rank"), (pos - F.floor(pos)).alias("frac")))
        hits = F.filter(F.array(*spots), lambda x: (upto >= x["rank"]) & (below < x["rank"]))
        return df.withColumn("_hit", F.explode(hits)).select("*", "_hit.*").drop("_hit")

    if bucket is None:
        freq = items.groupBy(*by, F.col(value).alias("value")).agg(w.alias("w"), n.alias("r"))
        runs = running_sums(freq, by, "value", ["w", "r"]).withColumns(
            {
                "least": F.min("value").over(group),
                "most": F.max("value").over(group),
                "rows_all": F.sum("r").over(group),
                "total": F.sum("w").over(group),
            }
        )
        runs = runs.withColumns(
            {
                "upto": F.col("run_w"),
                "below": F.col("run_w") - F.col("w"),
                "rows_upto": F.col("run_r"),
                "rows_below": F.col("run_r") - F.col("r"),
            }
        )
        return aimed(runs, F.col("below"), F.col("upto"), F.col("total")).select(*names, *found)
    hist = items.groupBy(*by, bucket).agg(
        w.alias("bw"), n.alias("br"), F.min(value).alias("bmin"), F.max(value).alias("bmax")
    )
    win = Window.partitionBy(*by).orderBy(bucket)
    edges = hist.withColumns(
        {
            "b_w": F.sum("bw").over(win),
            "b_r": F.sum("br").over(win),
            "b_next": F.lead("bmin").over(win),
            "least": F.min("bmin").over(group),
            "most": F.max("bmax").over(group),
            "rows_all": F.sum("br").over(group),
            "total": F.sum("bw").over(group),
        }
    )
    hit = (
        aimed(edges, F.col("b_w") - F.col("bw"), F.col("b_w"), F.col("total"))
        .withColumns({"w0": F.col("b_w") - F.col("bw"), "r0": F.col("b_r") - F.col("br")})
        .drop("b_w", "bw", "b_r", "br", "bmin", "bmax", "total")
    )
    hit = materialize(hit)  # one small row per target, read twice below
    freq = (
        items.join(hit.select(*by, bucket).distinct(), [*by, bucket], "left_semi")
        .groupBy(*by, bucket, F.col(value).alias("value"))
        .agg(w.alias("w"), n.alias("r"))
    )
    runs = running_sums(freq, [*by, bucket], "value", ["w", "r"]).join(hit, [*by, bucket])
    runs = runs.withColumns(
        {
            "upto": F.col("w0") + F.col("run_w"),
            "below": F.col("w0") + F.col("run_w") - F.col("w"),
            "rows_upto": F.col("r0") + F.col("run_r"),
            "rows_below": F.col("r0") + F.col("run_r") - F.col("r"),
        }
    )
    return (
        runs.filter((F.col("upto") >= F.col("rank")) & (F.col("below") < F.col("rank")))
        .withColumn("next_value", F.coalesce("next_value", "b_next"))
        .select(*names, *found)
    )


def melt(df: DataFrame, cols: list[str], by: list[str] | None = None, suffix: str | None = None) -> DataFrame:
    """Wide numeric columns to rows (by..., column, value[, bucket]); nulls dropped."""
    parts = []
    for c in cols:
        fields = [F.lit(c).alias("column"), F.col(c).cast("double").alias("value")]
        if suffix:
            fields.append(F.col(c + suffix).alias("bucket"))
        parts.append(F.struct(*fields))
    long = df.select(*(by or []), F.explode(F.array(*parts)).alias("m")).select(*(by or []), "m.*")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None, rows: int | None = None
) -> DataFrame:
    """Linear-interpolation quantiles, long form (by..., column, prob, quantile)."""
    by = by or []
    buckets = bucket_count(df.count() if rows is None else rows)
    bounds = quantile_bounds(df, cols, buckets)
    long = melt(add_buckets(df.select(*by, *cols), bounds), cols, by, "__b")
    keys = [*by, "column"]
    found = rank_select(long, keys, "value", [float(p) for p in probs], bucket="bucket" if buckets > 1 else None)
    after = F.when(F.col("upto") > F.col("rank"), F.col("value")).otherwise(F.coalesce("next_value", "value"))
    return found.select(*keys, "prob", (F.col("value") + F.col("frac") * (after - F.col("value"))).alias("quantile"))


def quantile_table(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, dict[float, float]]:
    """Exact quantiles of a few columns on the driver (cols x probs numbers)."""
    out: dict[str, dict[float, float]] = {c: {} for c in cols}
    for r in exact_quantiles(df, cols, probs).collect():
        out[r["column"]][r["prob"]] = r["quantile"]
    return out


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: q.get(0.5) for c, q in quantile_table(df, cols, [0.5]).items()}


def number_rows(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """0-based position of every row in a global order, counted partition by partition."""
    parts = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    offset, pairs = 0, []
    for r in parts.groupBy("_part").count().orderBy("_part").collect():  # one row per partition
        pairs.append((r["_part"], offset))
        offset += r["count"]
    cells = [F.struct(F.lit(p).alias("_part"), F.lit(o).cast("bigint").alias("_start")) for p, o in pairs or [(0, 0)]]
    starts = df.sparkSession.range(1).select(F.inline(F.array(*cells)))
    win = Window.partitionBy("_part").orderBy(*order)
    return (
        parts.join(starts, "_part")
        .withColumn(name, F.row_number().over(win) - 1 + F.col("_start"))
        .drop("_part", "_start")
    )


def rank_within(
    df: DataFrame, by: list[str], u: str, tie: str, rows: int, name: str = "rank", per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """1-based rank by a uniform column ``u`` inside each group, hot groups included.

    Groups are cut by ``u`` into equal slices, so no task holds more than about
    ``per_bucket`` rows even if one group is the whole table.
    """
    slices = max(1, math.ceil(rows / per_bucket))
    if slices == 1:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(u, tie)).cast("bigint"))
    df = df.withColumn("_slice", F.floor(F.col(u) * slices).cast("int"))
    win = Window.partitionBy(*by).orderBy("_slice")
    starts = df.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select(*by, "_slice", (F.sum("_n").over(win) - F.col("_n")).alias("_start"))
    inner = Window.partitionBy(*by, "_slice").orderBy(u, tie)
    return (
        df.join(starts, [*by, "_slice"])
        .withColumn(name, F.row_number().over(inner) + F.col("_start"))
        .drop("_slice", "_start")
    )
