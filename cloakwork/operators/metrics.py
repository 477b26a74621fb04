"""Model quality from label and prediction columns; one aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.ranks import exact_quantiles

CLASSIFICATION = [
    "accuracy",
    "precision_macro",
    "recall_macro",
    "f1_macro",
    "precision_weighted",
    "recall_weighted",
    "f1_weighted",
]


def confusion(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or []), F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy, and precision, recall, F1 in macro and weighted form.

    Classes are the union of true and predicted ones.  Precision of a class nobody
    predicted and recall of a class without true rows count 1, its F1 counts 0.
    """
    by = by or []
    cells = confusion(df, label, pred, by)
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("pred").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    long = cells.select(*by, hit.alias("hit"), F.posexplode(sides).alias("side", "s"))
    per = long.groupBy(*by, F.col("s.c").alias("c")).agg(
        F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("tp"),
        F.sum("s.actual").alias("actual"),
        F.sum("s.predicted").alias("predicted"),
    )
    per = per.withColumns(
        {
            "p": F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(1.0),
            "r": F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(1.0),
            "f": 2.0 * F.col("tp") / (F.col("predicted") + F.col("actual")),
        }
    )
    weighted = lambda c: F.sum(F.col(c) * F.col("actual")) / F.sum("actual")
    return per.groupBy(*by).agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        F.avg("p").alias("precision_macro"),
        F.avg("r").alias("recall_macro"),
        F.avg("f").alias("f1_macro"),
        weighted("p").alias("precision_weighted"),
        weighted("r").alias("recall_weighted"),
        weighted("f").alias("f1_weighted"),
    )


def regression_metrics(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(pred)
    return df.groupBy(*(by or [])).agg(
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1.0 - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"),
    )


def median_absolute_error(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    errors = df.select(*by, F.abs(F.col(label) - F.col(pred)).alias("median_abs_error"))
    out = exact_quantiles(errors, ["median_abs_error"], [0.5], by)
    return out.select(*by, F.col("quantile").alias("median_abs_error"))


def long_scores(wide: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return wide.select(*by, F.explode(F.array(*cells)).alias("s")).select(*by, "s.*")
