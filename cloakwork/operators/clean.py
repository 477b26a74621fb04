"""Row filters, column drops and imputation."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.ranks import exact_medians
from cloakwork.functions.scalar import clip
from cloakwork.operators.profile import missing_in_row
from cloakwork.roles import numeric_columns


def drop_columns(df: DataFrame, names: list[str] = (), regex: str | None = None) -> DataFrame:
    """Trim names, drop the given ones (missing ones are ignored) and those matching a pattern."""
    df = df.toDF(*[c.strip() for c in df.columns])
    df = df.drop(*names)
    return df.drop(*[c for c in df.columns if regex and re.search(regex, c)])


def drop_family(df: DataFrame, prefixes: list[str], numbers: range = range(24)) -> DataFrame:
    """Drop generated columns such as WSR0..WSR23."""
    return df.drop(*[f"{p}{i}" for p in prefixes for i in numbers])


def keep_dense_rows(df: DataFrame, cols: list[str], max_missing: int = 15) -> DataFrame:
    return df.filter(missing_in_row(cols) <= max_missing)


def drop_sparse_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows with at least half of the columns present."""
    return df.na.drop(thresh=math.ceil(len(cols) / 2), subset=cols)


def median_impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """Remaining nulls become the exact column median."""
    medians = {c: m for c, m in exact_medians(df, cols).items() if m is not None}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def clean_sparse(df: DataFrame, cols: list[str] | None = None, max_missing: int = 15) -> DataFrame:
    """Drop rows with too many nulls, then fill what is left with medians."""
    kept = keep_dense_rows(df, cols or df.columns, max_missing)
    return median_impute(kept, [c for c in numeric_columns(df) if c in (cols or df.columns)])


def clip_to(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()})


def month_means(df: DataFrame, date: str | Column, cols: list[str]) -> DataFrame:
    """Fitted fill values: (ym, month, <col>__fill), one row per month and, with null ym, per calendar month.

    The first choice is the mean of that year-month; a month without data falls back
    to the mean of the same calendar month over all years, taken after the first
    fill.  Both come from one map-side combined aggregate, because after filling a
    month with its own mean the calendar-month mean is a weighted mean of months.
    """
    date = F.col(date) if isinstance(date, str) else date
    ym = F.date_trunc("month", date)
    months = df.groupBy(ym.alias("ym")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)]
    )
    filled = lambda i: F.sum(F.col(f"m_{i}") * F.col("n")) / F.sum(F.when(F.col(f"m_{i}").isNotNull(), F.col("n")))
    calendar = months.groupBy(F.month("ym").alias("month")).agg(*[filled(i).alias(f"c_{i}") for i in range(len(cols))])
    each = months.withColumn("month", F.month("ym")).join(calendar, "month")
    each = each.select("ym", "month", *[F.coalesce(f"m_{i}", f"c_{i}").alias(f"{c}__fill") for i, c in enumerate(cols)])
    unseen = calendar.select(F.lit(None).cast(each.schema["ym"].dataType).alias("ym"), "month", *[F.col(f"c_{i}").alias(f"{c}__fill") for i, c in enumerate(cols)])
    return each.unionByName(unseen)


def month_mean_impute(df: DataFrame, date: str, cols: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """Fill nulls by month means; pass ``fitted`` from the training rows to avoid leaks.

    A month that the fitted rows do not have takes the mean of its calendar month.
    The fitted table has one row per month on record (hundreds), so it is broadcast
    by size and a month that holds most of the rows causes no skew.
    """
    fitted = month_means(df, date, cols) if fitted is None else fitted
    own = fitted.filter(F.col("ym").isNotNull()).drop("month")
    season = fitted.filter(F.col("ym").isNull()).select(F.col("month").alias("_month"), *[F.col(f"{c}__fill").alias(f"{c}__season") for c in cols])
    out = df.withColumns({"ym": F.date_trunc("month", F.col(date)), "_month": F.month(F.col(date))})
    out = out.join(own, "ym", "left").join(season, "_month", "left")
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}__fill"), F.col(f"{c}__season")) for c in cols})
    return out.drop("ym", "_month", *[f"{c}__{x}" for c in cols for x in ("fill", "season")])
