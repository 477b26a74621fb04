"""Profiling reports.  One pass over the data each, results have a handful of rows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakwork.functions.ranks import exact_quantiles, number_rows
from cloakwork.functions.scalar import coerce_number
from cloakwork.session import materialize


def _whole() -> Window:
    """Window over a whole report; only used where the report has a bounded number of rows."""
    return Window.partitionBy()


def _rows_from(stats: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """One wide row of aggregates ``<field>_<i>`` to one row per name."""
    cells = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{f}_{i}").alias(f) for f in fields]) for i, n in enumerate(names)
    ]
    return stats.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    stats = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_null_{i}") for i, c in enumerate(cols)])
    return _rows_from(stats, cols, {"n_null": "bigint"})


def missing_in_row(cols: list[str]) -> Column:
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def null_histogram(df: DataFrame, cols: list[str], max_missing: int = 15) -> DataFrame:
    """Rows by number of missing values, their share, and whether cleaning keeps them."""
    counts = df.groupBy(missing_in_row(cols).cast("bigint").alias("n_missing")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(
        "n_missing",
        "n_rows",
        (100.0 * F.col("n_rows") / F.sum("n_rows").over(_whole())).alias("percent"),
        F.when(F.col("n_missing") <= max_missing, "KEEP").otherwise("DROP").alias("decision"),
    )


def preserved(df: DataFrame, cols: list[str], max_missing: int = 15) -> DataFrame:
    kept = F.count_if(missing_in_row(cols) <= max_missing)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), kept.alias("n_kept"), (100.0 * kept / F.count(F.lit(1))).alias("percent_kept")
    )


def describe(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    base = _rows_from(df.agg(*aggs), cols, dict.fromkeys(["count", "mean", "std", "min", "max"], ""))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    pick = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    q = q.groupBy("column").agg(pick(0.25).alias("q25"), pick(0.5).alias("q50"), pick(0.75).alias("q75"))
    out = base.join(q, "column", "left")
    return out.select(
        "column", "count", *[F.round(c, digits).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]]
    )


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts
    total = df.filter(F.col(col).isNotNull()).count()  # a scalar, so no global window over all values
    return counts.withColumn("share", F.col("n") / F.lit(float(total)))


def sorted_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts with their 0-based places by value (``by_key``) and by count, the largest first (``by_count``)."""
    counts = materialize(value_counts(df, col))
    return number_rows(number_rows(counts, ["value"], "by_key"), [F.desc("n"), "value"], "by_count")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and percent per class next to the largest and smallest class."""
    counts = materialize(df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")))
    total, most, least = counts.agg(F.sum("n"), F.max("n"), F.min("n")).first()  # three numbers
    return counts.select(
        "label",
        "n",
        (100.0 * F.col("n") / F.lit(total)).alias("percent"),
        F.lit(most).alias("majority"),
        F.lit(least).alias("minority"),
    )


def positive_rate(df: DataFrame, flag: Column) -> DataFrame:
    x = flag.cast("int")
    return df.agg(F.sum(x).alias("positives"), F.avg(x).alias("rate"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct counts: values are melted and merged on the map side first."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    long = df.select(F.explode(F.array(*cells)).alias("m")).select("m.*").filter(F.col("value").isNotNull())
    return long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def column_bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"lo_{i}"), F.max(x).alias(f"hi_{i}"), F.avg(x).alias(f"mean_{i}")]
    return _rows_from(df.agg(*aggs), cols, dict.fromkeys(["lo", "hi", "mean"], ""))


def bounds_of(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Column minima and maxima on the driver (two numbers per column)."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(cols)}


def group_profile(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def two_group_difference(df: DataFrame, flag: Column, cols: list[str]) -> DataFrame:
    """Mean of each column where the flag holds and where it does not."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.avg(F.when(flag, F.col(c))).alias(f"mean_true_{i}"),
            F.avg(F.when(~flag, F.col(c))).alias(f"mean_false_{i}"),
        ]
    out = _rows_from(df.agg(*aggs), cols, {"mean_true": "", "mean_false": ""})
    return out.withColumn("difference", F.col("mean_true") - F.col("mean_false"))


def most_least_common(df: DataFrame, col: str) -> DataFrame:
    """Most and least frequent value (smallest value wins ties) and their ratio."""
    counts = value_counts(df, col)
    return counts.agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("most_common"),
        F.max("n").alias("most_n"),
        F.min_by("value", F.struct(F.col("n"), F.col("value"))).alias("least_common"),
        F.min("n").alias("least_n"),
    ).withColumn("ratio", F.col("most_n") / F.col("least_n"))


def mode_of(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Most frequent value per group and column, smallest value on ties.

    Counting by (group, column, value) first keeps every aggregation buffer tiny.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols]
    long = df.select(*by, F.explode(F.array(*cells)).alias("m")).select(*by, "m.*").filter(F.col("value").isNotNull())
    counts = long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by, "column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair a < b (pairwise complete), one aggregate."""
    pairs = list(combinations(sorted(cols), 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"corr_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"corr_{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def target_correlations(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    cols = [c for c in cols if c != target]
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"corr_{i}") for i, c in enumerate(cols)])
    return _rows_from(row, cols, {"corr": ""})


def strongest(corrs: DataFrame, k: int = 5) -> DataFrame:
    """The k largest and the k smallest correlations."""
    top = corrs.orderBy(F.desc("corr"), "column").limit(k).withColumn("side", F.lit("top"))
    low = corrs.orderBy(F.asc("corr"), "column").limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(low)


def correlation_band(corrs: DataFrame, high: float = 0.8, low: float = 0.2) -> DataFrame:
    """Columns strongly (> high) or barely (< low) correlated with the target."""
    size = F.abs("corr")
    kind = F.when(size > high, "high").when(size < low, "low")
    return corrs.withColumn("band", kind).filter(F.col("band").isNotNull())


def explore(df: DataFrame, target: str) -> DataFrame:
    """Exploration report after coercing every column to a number: pairs and target bands."""
    numbers = df.select(*[coerce_number(F.col(c).cast("string")).alias(c) for c in df.columns])
    pairs = correlations(numbers, numbers.columns)
    hit = (F.col("a") == target) | (F.col("b") == target)
    size = F.abs("corr")
    return pairs.withColumn("with_target", hit).withColumn(
        "band", F.when(hit & (size > 0.8), "high").when(hit & (size < 0.2), "low")
    )


def crosstab(df: DataFrame, rows: str, cols: str, most: int = 1000) -> DataFrame:
    """Counts of ``rows`` x ``cols``; the column domain becomes the header."""
    head = [r[0] for r in df.select(cols).distinct().orderBy(cols).limit(most + 1).collect()]
    if len(head) > most:
        raise ValueError(f"{cols} has more than {most} values, too wide for a cross table")
    counts = df.groupBy(rows, cols).count()
    return counts.groupBy(rows).pivot(cols, head).agg(F.sum("count")).na.fill(0)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed."""
    lo, hi = bounds_of(df, [col])[col]
    width = (hi - lo) / bins or 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n"
    )


def box_stats(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR whisker ends and the number of points outside them."""
    by = by or []
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], by)
    pick = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    q = q.groupBy(*by, "column").agg(pick(0.25).alias("q25"), pick(0.5).alias("q50"), pick(0.75).alias("q75")).drop("column")
    x, iqr = F.col(col), F.col("q75") - F.col("q25")
    inside = (x >= F.col("q25") - 1.5 * iqr) & (x <= F.col("q75") + 1.5 * iqr)
    aggs = [
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outside"),
    ]
    if by:  # group medians travel with the rows: small side, Spark broadcasts it when it fits
        joined = df.select(*by, col).join(q, by)
        return joined.groupBy(*by, "q25", "q50", "q75").agg(*aggs)
    s = q.first()
    fixed = df.select(col).withColumns({c: F.lit(s[c]) for c in ["q25", "q50", "q75"]})
    return fixed.groupBy("q25", "q50", "q75").agg(*aggs)


def fold_summary(scores: DataFrame, by: list[str], value: str, ddof: int, digits: int | None = None) -> DataFrame:
    """Mean and spread over folds; ``ddof`` 0 for the population, 1 for the sample form."""
    spread = {0: F.stddev_pop, 1: F.stddev_samp}[ddof](value)
    mean = F.avg(value)
    if digits is not None:
        mean, spread = F.round(mean, digits), F.round(spread, digits)
    return scores.groupBy(*by).agg(mean.alias("mean"), spread.alias("std"))
