"""Feature transformers: ``fit_*(df, ...)`` returns a small frozen model with ``apply(df)``.

Fitting is one aggregate (or one distinct); a model holds a few numbers per column,
and ``apply`` only adds column expressions, so any number of models fuse into one
projection and also work on streaming frames.  Only :class:`Codes` joins, because a
dictionary may be as large as the column's domain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.ranks import number_rows, quantile_table
from cloakwork.functions.scalar import first_digits, log1p_shifted


def q(name: str) -> Column:
    """Column by literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


# --- scaling ------------------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    center: dict[str, float]
    scale: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (q(c).cast("double") - F.lit(m)) / F.lit(self.scale[c]) for c, m in self.center.items() if c in df.columns}
        )


def fit_standard(df: DataFrame, cols: list[str]) -> Scaler:
    """Mean and population deviation; nulls ignored, zero deviation divides by one."""
    if not cols:
        return Scaler({}, {})
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    known = [(i, c) for i, c in enumerate(cols) if row[f"m{i}"] is not None]
    return Scaler({c: row[f"m{i}"] for i, c in known}, {c: row[f"s{i}"] or 1.0 for i, c in known})


def fit_robust(df: DataFrame, cols: list[str]) -> Scaler:
    """Median and inter-quartile range, exact quantiles."""
    table = quantile_table(df, cols, [0.25, 0.5, 0.75])
    known = {c: t for c, t in table.items() if t}
    return Scaler({c: t[0.5] for c, t in known.items()}, {c: (t[0.75] - t[0.25]) or 1.0 for c, t in known.items()})


# --- categories ---------------------------------------------------------------------


@dataclass(frozen=True)
class OneHot:
    """0/1 columns ``<col>_<value>`` per fitted value; unknown values give all zeros."""

    domains: dict[str, list[str]]
    drop_binary: bool = False

    def columns(self, c: str) -> list[str]:
        values = self.domains[c]
        return [f"{c}_{v}" for v in (values[1:] if self.drop_binary and len(values) == 2 else values)]

    def names(self) -> list[str]:
        return [n for c in self.domains for n in self.columns(c)]

    def apply(self, df: DataFrame) -> DataFrame:
        flags = {}
        for c in self.domains:
            for n in self.columns(c):
                flags[n] = F.coalesce((q(c).cast("string") == F.lit(n[len(c) + 1 :])).cast("int"), F.lit(0))
        return df.withColumns(flags).drop(*self.domains)


def fit_one_hot(df: DataFrame, cols: list[str], drop_binary: bool = False, most: int = 2000) -> OneHot:
    """Sorted distinct values per column.  Wider domains belong in a sparse vector."""
    domains: dict[str, list[str]] = {c: [] for c in cols}
    if not cols:
        return OneHot({}, drop_binary)
    cells = [F.struct(F.lit(c).alias("c"), q(c).cast("string").alias("v")) for c in cols]
    pairs = df.select(F.explode(F.array(*cells)).alias("m")).select("m.*").filter(F.col("v").isNotNull()).distinct()
    found = pairs.limit(most * len(cols) + 1).collect()  # names of new columns, size checked below
    for r in found:
        domains[r["c"]].append(r["v"])
    if len(found) > most * len(cols):
        raise ValueError(f"more than {most} values per column: use fit_sparse_one_hot")
    return OneHot({c: sorted(v) for c, v in domains.items()}, drop_binary)


def fit_sparse_one_hot(df: DataFrame, col: str):
    """Wide domains: one sparse vector column instead of one column per value."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    index = StringIndexer(
        inputCol=col, outputCol=f"{col}_index", stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return Pipeline(stages=[index, OneHotEncoder(inputCol=f"{col}_index", outputCol=f"{col}_vector")]).fit(df)


@dataclass(frozen=True)
class Ordinal:
    """Position in a declared order; unknown values raise, or give null with ``strict=False``."""

    orders: dict[str, list[str]]
    strict: bool = True

    def apply(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, order in self.orders.items():
            pairs = [x for i, v in enumerate(order) for x in (F.lit(v), F.lit(float(i)))]
            code = F.try_element_at(F.create_map(*pairs), q(c))
            if self.strict:
                bad = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), q(c)))
                code = F.when(code.isNull() & q(c).isNotNull(), bad.cast("double")).otherwise(code)
            out[c] = code
        return df.withColumns(out)


@dataclass(frozen=True)
class Codes:
    """Dictionary tables (value, code), one per column."""

    tables: dict[str, DataFrame]

    def apply(self, df: DataFrame) -> DataFrame:
        for c, t in self.tables.items():
            t = t.select(F.col("value").alias("_v"), F.col("code").alias("_code"))
            names = df.columns
            df = df.join(t, q(c).cast("string") == F.col("_v"), "left").withColumn(c, F.col("_code")).select(*[q(n) for n in names])
        return df

    def decode(self, df: DataFrame, col: str, out: str) -> DataFrame:
        t = self.tables[col].select(F.col("value").alias(out), F.col("code").alias("_code"))
        return df.join(t, q(col) == F.col("_code"), "left").drop("_code")

    def decode_spans(self, df: DataFrame, col: str, lo: str, hi: str, out: str, sep: str = "~") -> DataFrame:
        """Add the labels of the codes lo..hi, joined in code order; each distinct span is spelled once."""
        spans = df.select(F.col(lo).cast("long").alias("_lo"), F.col(hi).cast("long").alias("_hi")).filter("_lo <= _hi").distinct()
        each = spans.withColumn("_code", F.explode(F.sequence("_lo", "_hi")))
        each = each.join(self.tables[col].select(F.col("code").alias("_code"), "value"), "_code")
        listed = F.array_sort(F.collect_list(F.struct("_code", "value")))
        texts = each.groupBy("_lo", "_hi").agg(F.array_join(F.transform(listed, lambda s: s["value"]), sep).alias(out))
        met = df.join(texts, (F.col(lo).cast("long") == F.col("_lo")) & (F.col(hi).cast("long") == F.col("_hi")), "left")
        return met.drop("_lo", "_hi")


def _dictionary(values: DataFrame, order: list) -> DataFrame:
    return number_rows(values, order, "code").select("value", "code")


def fit_label_codes(df: DataFrame, cols: list[str]) -> Codes:
    """Sorted distinct values numbered from 0."""
    out = {}
    for c in cols:
        values = df.select(q(c).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct()
        out[c] = _dictionary(values, ["value"])
    return Codes(out)


def fit_first_codes(df: DataFrame, cols: list[str], order: str) -> Codes:
    """Values numbered by their first appearance in the given row order."""
    out = {}
    for c in cols:
        values = (
            df.filter(q(c).isNotNull()).groupBy(q(c).cast("string").alias("value")).agg(F.min(order).alias("_first"))
        )
        out[c] = _dictionary(values, ["_first", "value"])
    return Codes(out)


# --- shape of a distribution ---------------------------------------------------------


@dataclass(frozen=True)
class SkewLog:
    """Replace skewed columns by ``log_<col>``, shifted to be positive."""

    lowest: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        logs = {f"log_{c}": log1p_shifted(q(c), lo) for c, lo in self.lowest.items()}
        return df.withColumns(logs).drop(*self.lowest) if logs else df


def skewness_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bias-corrected skewness per column."""
    aggs = []
    for i, c in enumerate(cols):
        n = F.count(c).cast("double")
        g = F.skewness(q(c).cast("double")) * F.sqrt(n * (n - 1)) / (n - 2)
        aggs += [g.alias(f"g_{i}"), F.min(q(c).cast("double")).alias(f"lo_{i}")]
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"g_{i}").alias("skewness"), F.col(f"lo_{i}").alias("lowest"))
        for i, c in enumerate(cols)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def fit_skew_log(df: DataFrame, cols: list[str], threshold: float = 3.0) -> SkewLog:
    rows = skewness_table(df, cols).collect()  # one row per column
    return SkewLog({r["column"]: r["lowest"] for r in rows if r["skewness"] is not None and abs(r["skewness"]) >= threshold})


# --- composition ---------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """A stateless step."""

    fn: object

    def apply(self, df: DataFrame) -> DataFrame:
        return self.fn(df)


@dataclass
class Steps:
    """Ordered fit/apply steps.

    ``steps`` are functions from the rows seen so far to a fitted model.  A step
    listed in ``train_only`` (a resampler) changes the training rows and is skipped
    when other rows pass through.  A model that treats the rows it was fitted on in
    another way than new ones has ``on_training``: an anonymizer gives its members
    their own group, and assigns only unseen rows.
    """

    steps: list
    train_only: set[int] = field(default_factory=set)
    models: list = field(default_factory=list)

    def fit(self, df: DataFrame) -> tuple[Steps, DataFrame]:
        """Fit every step on the output of the previous one; returns the model and the training rows."""
        fitted = Steps(self.steps, self.train_only)
        for make in self.steps:
            model = make(df)
            fitted.models.append(model)
            df = model.on_training(df) if hasattr(model, "on_training") else model.apply(df)
        return fitted, df

    def apply(self, df: DataFrame) -> DataFrame:
        for i, model in enumerate(self.models):
            if i not in self.train_only:
                df = model.apply(df)
        return df


def grade_number(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, first_digits(col))
