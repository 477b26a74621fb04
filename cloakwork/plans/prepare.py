"""Preparing microdata for partitioning: roles, codes, numbers, and what turns codes back into text.

A :class:`Prepared` table holds a key, the quasi-identifiers as numbers and the sensitive
attribute.  Its specification (roles, and a code table per coded column, numbered by
first appearance) can be written beside the data and read again, so later runs code and
decode alike.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.functions.scalar import number_or_code
from cloakwork.operators.encode import Codes, fit_first_codes, q
from cloakwork.operators.profile import distinct_counts
from cloakwork.roles import AnonSpec, text_columns
from cloakwork.session import materialize
from cloakwork.sources.tables import sample


@dataclass(frozen=True)
class Recipe:
    """How one table is prepared.

    ``categorical`` are always coded; with ``few`` columns of fewer distinct values are
    too, but for those in ``exempt``; with ``texts`` all text columns.  ``share`` keeps a
    hash sample of the rows.  What is no number in another column gets a code of its
    own, or 0 with ``zero``.
    """

    sa: str
    identifiers: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    exempt: tuple[str, ...] = ()
    few: int | None = None
    texts: bool = False
    share: float = 1.0
    zero: bool = False
    k: int = 5
    strict: bool = True


@dataclass(frozen=True)
class Prepared:
    rows: DataFrame
    spec: AnonSpec
    codes: Codes = field(default_factory=lambda: Codes({}))

    def code_table(self) -> DataFrame:
        """(column, code, value) of all coded columns."""
        out = None
        for c, t in sorted(self.codes.tables.items()):
            part = t.select(F.lit(c).alias("column"), "code", "value")
            out = part if out is None else out.unionByName(part)
        return out


def categorical_of(df: DataFrame, recipe: Recipe, qi: list[str]) -> list[str]:
    """The coded columns of a recipe, in the order of the quasi-identifiers."""
    found = set(recipe.categorical)
    if recipe.texts:
        found |= set(text_columns(df.select(*map(q, qi))))
    if recipe.few is not None:
        counts = distinct_counts(df, qi).collect()  # one row per column
        found |= {r["column"] for r in counts if r["n_distinct"] < recipe.few and r["column"] not in recipe.exempt}
    return [c for c in qi if c in found]


def prepare(df: DataFrame, recipe: Recipe, key: str) -> Prepared:
    """Identifiers go, categories and other texts become codes by first appearance in ``key`` order."""
    if recipe.share < 1:
        df = sample(df, key, recipe.share)
    qi = [c for c in df.columns if c not in (*recipe.identifiers, recipe.sa, key)]
    coded = categorical_of(df, recipe, qi)
    plain = [c for c in qi if c not in coded]
    texts = [c for c in text_columns(df.select(*map(q, plain))) if not recipe.zero] if plain else []
    df = df.withColumns({c: F.trim(q(c)) for c in [*texts, *(c for c in coded if c in text_columns(df))]}) if texts or coded else df
    words = df
    for c in texts:  # only what is no number is coded
        words = words.withColumn(c, F.when(q(c).try_cast("double").isNull(), q(c)))
    codes = Codes({**fit_first_codes(df, coded, key).tables, **fit_first_codes(words, texts, key).tables})
    out = Codes({c: codes.tables[c] for c in coded}).apply(df)
    for c in texts:
        looked = Codes({f"{c}__code": codes.tables[c]}).apply(out.withColumn(f"{c}__code", q(c)))
        out = looked.withColumn(c, number_or_code(q(c), q(f"{c}__code"))).drop(f"{c}__code")
    for c in plain:
        if c not in texts:
            out = out.withColumn(c, F.coalesce(q(c).try_cast("double") if c in text_columns(df) else q(c).cast("double"), F.lit(0.0) if recipe.zero else F.lit(None)))
    spec = AnonSpec(tuple(qi), recipe.sa, recipe.identifiers, tuple(coded), recipe.k, recipe.strict)
    kept = {c: t for c, t in codes.tables.items() if c in coded or t.limit(1).count()}
    return Prepared(materialize(out.select(key, *map(q, qi), q(recipe.sa))), spec, Codes(kept))


# fixed values: the roles of the four prepared tables
PLACEMENT = Recipe("Placement_Status", ("Student_ID",), ("Gender", "Degree", "Branch"), share=0.2)
BREAST_CANCER = Recipe("class", ("ID",), zero=True)
TEEN_PHONE = Recipe("Addiction_Level", ("ID", "Name", "Location"), ("Gender", "Phone_Usage_Purpose"), ("Age", "School_Grade"), few=10)
PERSONALITY = Recipe("Personality", (), ("Gender", "Interest"), texts=True, share=0.05)


def save(prepared: Prepared, path: str) -> None:
    """Rows, roles and code tables under one folder."""
    spark = prepared.rows.sparkSession
    prepared.rows.write.mode("overwrite").parquet(f"{path}/rows")
    spark.createDataFrame([(json.dumps(asdict(prepared.spec)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")
    table = prepared.code_table()
    if table is None:
        table = spark.createDataFrame([], "column string, code bigint, value string")
    table.write.mode("overwrite").parquet(f"{path}/codes")


def load(spark: SparkSession, path: str) -> Prepared:
    """What :func:`save` has written."""
    raw = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/spec").collect()))  # one small file
    spec = AnonSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})
    codes = spark.read.parquet(f"{path}/codes")
    names = [r[0] for r in codes.select("column").distinct().collect()]  # coded columns
    return Prepared(spark.read.parquet(f"{path}/rows"), spec, Codes({c: codes.filter(F.col("column") == c).select("value", "code") for c in names}))
