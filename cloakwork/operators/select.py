"""Feature scores for feature selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakwork.functions.ranks import ROWS_PER_BUCKET, add_buckets, bucket_count, melt, quantile_bounds, quantile_table, running_sums
from cloakwork.session import materialize


def explode_vector(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """Array column to rows (keep..., column, value)."""
    long = df.select(*keep, F.posexplode(vector).alias("column", "value"))
    return long.withColumn("value", F.col("value").cast("double"))


def anova_f(long: DataFrame, label: str) -> DataFrame:
    """ANOVA F per feature from (label, column, value) rows.

    Class moments are combined on the map side, so the shuffle carries one row per
    class and feature whatever the class sizes are.
    """
    per_class = long.groupBy("column", label).agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v")
    )
    total = per_class.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("g"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.collect_list(F.struct("n", "m")).alias("classes"),  # one entry per class
    )
    between = F.aggregate(
        "classes", F.lit(0.0), lambda acc, x: acc + x["n"] * (x["m"] - F.col("grand")) * (x["m"] - F.col("grand"))
    )
    return total.select(
        "column", ((between / (F.col("g") - 1)) / (F.col("within") / (F.col("n") - F.col("g")))).alias("f_value")
    )


def mutual_information(df: DataFrame, cols: list[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) between quantile bins of each column and the label."""
    probs = [i / bins for i in range(1, bins)]
    cuts = quantile_table(df, cols, probs)
    binned = df.select(
        F.col(label).alias("label"),
        *[
            sum(((F.col(c) >= F.lit(v)).cast("int") for v in sorted(set(cuts[c].values()))), F.lit(0)).alias(c)
            for c in cols
        ],
    )
    joint = melt(binned, cols, ["label"]).groupBy("column", "value", "label").agg(F.count(F.lit(1)).alias("n"))
    # at most bins x classes rows per column from here on
    by_bin = joint.groupBy("column", "value").agg(F.sum("n").alias("nb"))
    by_label = joint.groupBy("column", "label").agg(F.sum("n").alias("nl"))
    total = joint.groupBy("column").agg(F.sum("n").alias("nt"))
    cell = joint.join(by_bin, ["column", "value"]).join(by_label, ["column", "label"]).join(total, "column")
    p = F.col("n") / F.col("nt")
    ratio = F.col("n") * F.col("nt") / (F.col("nb") * F.col("nl"))
    return cell.groupBy("column").agg(F.sum(p * F.log(ratio)).alias("mutual_information"))


def digamma(x: Column) -> Column:
    """Logarithmic derivative of the gamma function for x >= 1: ten steps up, then the asymptotic series."""
    y = x + 10.0
    series = F.log(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * y**4) - 1 / (252 * y**6)
    return series - sum(((1.0 / (x + i)) for i in range(1, 10)), 1.0 / x)


def _to_kth(points: DataFrame, k: int) -> DataFrame:
    """Add ``d``, the distance from every value to the k-th nearest of its class, the class's own size permitting.

    ``points`` has one row (column, label, bucket, value, n, size) per distinct value.
    Neighbours stand within k distinct values.  They are looked up inside value
    buckets; rows at the ends of a bucket look them up among the ends of all buckets,
    at most 2k rows each, so no task sorts a class.
    """
    keys = ["column", "label"]
    inner = Window.partitionBy(*keys, "bucket").orderBy("value")
    ends = Window.partitionBy(*keys).orderBy("value")

    def around(win, step) -> Column:
        return F.array_compact(F.array(*[step(F.struct("value", "n"), i).over(win) for i in range(1, k + 1)]))

    rows = points.withColumns({"first": F.row_number().over(inner), "size_b": F.count(F.lit(1)).over(Window.partitionBy(*keys, "bucket"))})
    rows = rows.withColumns({"head": F.col("first") <= k, "tail": F.col("first") > F.col("size_b") - k, "before": around(inner, F.lag), "after": around(inner, F.lead)})
    rows = materialize(rows.drop("first", "size_b"))
    edge = rows.filter("head or tail").select(*keys, "value", around(ends, F.lag).alias("edge_before"), around(ends, F.lead).alias("edge_after"))
    rows = rows.join(edge, [*keys, "value"], "left")
    near = F.concat(F.when(F.col("head"), F.col("edge_before")).otherwise(F.col("before")), F.when(F.col("tail"), F.col("edge_after")).otherwise(F.col("after")))
    near = F.array_sort(F.transform(near, lambda s: F.struct(F.abs(s["value"] - F.col("value")).alias("d"), s["n"].alias("n"))))
    need = F.least(F.lit(k), F.col("size") - 1) - (F.col("n") - 1)
    start = F.struct(need.alias("left"), F.lit(0.0).alias("d"))
    walk = F.aggregate(near, start, lambda acc, s: F.struct((acc["left"] - s["n"]).alias("left"), F.when(acc["left"] > 0, s["d"]).otherwise(acc["d"]).alias("d")))
    return rows.withColumn("d", walk["d"]).drop("head", "tail", "before", "after", "edge_before", "edge_after")


def neighbour_information(df: DataFrame, cols: list[str], label: str, k: int = 3, per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Mutual information (nats) between each column and a class, by nearest neighbours.

    For every row the distance to its k-th neighbour of the same class is taken, and
    the rows of any class nearer than that are counted (itself included; equal ones
    where the distance is 0):

        I = digamma(N) + mean(digamma(k)) - mean(digamma(rows of the class)) - mean(digamma(nearer rows))

    and at least 0.  Classes of one row are left out, in classes of fewer than k + 1
    rows k is what they have.  Nulls are left out column by column.  Values are counted
    before anything is sorted; a column that is constant scores 0.
    """
    long = melt(df.filter(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("string")), cols, ["_label"])
    points = materialize(long.groupBy("column", F.col("_label").alias("label"), "value").agg(F.count(F.lit(1)).alias("n")))
    # what is sorted are distinct values, so their number and their quantiles decide the buckets
    buckets = bucket_count(points.count(), per_bucket)
    bounds = quantile_bounds(points.select(*[F.when(F.col("column") == c, F.col("value")).alias(c) for c in cols]), cols, buckets)

    def placed(long: DataFrame) -> DataFrame:
        wide = long.withColumns({f"_v{i}": F.col("value") for i in range(len(cols))})
        wide = add_buckets(wide, {f"_v{i}": bounds[c] for i, c in enumerate(cols)})
        which = F.coalesce(*[F.when(F.col("column") == c, F.col(f"_v{i}__b")) for i, c in enumerate(cols)])
        return wide.withColumn("bucket", which).drop(*[f"_v{i}{e}" for i in range(len(cols)) for e in ("", "__b")])

    points = materialize(placed(points))
    sizes = points.groupBy("column", "label").agg(F.sum("n").alias("size")).filter("size > 1")
    points = materialize(_to_kth(points.join(sizes, ["column", "label"]), k))
    lo, hi = (F.when(F.col("d") > 0, e).otherwise(F.col("value")) for e in (F.col("value") - F.col("d"), F.col("value") + F.col("d")))
    points = points.withColumns({"lo": lo, "hi": hi})
    none = F.lit(0).cast("bigint").alias("n")
    asked = points.select("column", F.explode(F.array("lo", "hi")).alias("value"), none).distinct()
    freq = placed(points.select("column", "value", "n").unionByName(asked)).groupBy("column", "bucket", "value").agg(F.sum("n").alias("n"))
    runs = materialize(running_sums(freq, ["column"], "value", ["n"], "bucket" if buckets > 1 else None))
    low = runs.select("column", F.col("value").alias("lo"), F.col("run_n").alias("run_lo"))
    high = runs.select("column", F.col("value").alias("hi"), F.col("run_n").alias("run_hi"), F.col("n").alias("n_hi"))
    met = points.join(low, ["column", "lo"]).join(high, ["column", "hi"])
    nearer = F.when(F.col("d") > 0, F.col("run_hi") - F.col("n_hi") - F.col("run_lo")).otherwise(F.col("n_hi"))
    own = digamma(F.least(F.lit(k), F.col("size") - 1).cast("double")) - digamma(F.col("size").cast("double")) - digamma(nearer.cast("double"))
    sums = met.groupBy("column").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * own).alias("own"))
    score = digamma(F.col("rows").cast("double")) + F.col("own") / F.col("rows")
    return sums.select("column", F.greatest(F.lit(0.0), score).alias("mutual_information"))


def select_best(df: DataFrame, cols: list[str], label: str, k: int, score: str = "mutual_information", **options) -> tuple[DataFrame, list[str]]:
    """The table with only the k best of ``cols``, and their names, best first.

    ``score`` is ``mutual_information`` (by neighbours) or ``f_value``.
    """
    if score == "f_value":
        scores = anova_f(melt(df, cols, [label]), label)
    else:
        scores = neighbour_information(df, cols, label, **options)
    names = [r["column"] for r in best(scores, score, k).collect()]  # k names
    return df.drop(*[c for c in cols if c not in names]), names


def best(scores: DataFrame, score: str, k: int) -> DataFrame:
    """The k best features; the smaller name wins ties."""
    return scores.orderBy(F.desc(score), "column").limit(k)
