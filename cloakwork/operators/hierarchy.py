"""Category trees: loading, checking, ancestor closure, lowest common ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.functions.ranks import number_rows
from cloakwork.operators.encode import q
from cloakwork.session import materialize

ENTRY = "name string, entries map<string, struct<name: string, gen: string, level: int>>"


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """JSON ``{name, entries: {key: {name, gen, level}}}`` to rows (value, parent, level, name)."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", ENTRY).alias("d"))
    rows = doc.select(F.explode("d.entries").alias("value", "e"))
    return checked(rows.select("value", F.col("e.gen").alias("parent"), F.col("e.level").alias("level"), F.col("e.name").alias("name")))


def checked(tree: DataFrame) -> DataFrame:
    roots = tree.agg(F.count_if(F.col("level") == 0)).first()[0]
    if roots != 1:
        raise ValueError(f"a hierarchy needs exactly one level-0 entry, found {roots}")
    return tree


def flat_hierarchy(df: DataFrame, col: str) -> DataFrame:
    """Two levels from the data itself: root ``*`` and every distinct value below it."""
    leaves = df.select(q(col).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct()
    leaves = leaves.select("value", F.lit("*").alias("parent"), F.lit(1).alias("level"), F.col("value").alias("name"))
    root = df.sparkSession.range(1).select(
        F.lit("*").alias("value"), F.lit("*").alias("parent"), F.lit(0).alias("level"), F.lit("*").alias("name")
    )
    return root.unionByName(leaves)


def closure(tree: DataFrame) -> DataFrame:
    """Every value with each of its ancestors (itself included) and the ancestor's level."""
    levels = tree.agg(F.max("level")).first()[0] or 0  # depth of the tree, a handful
    up = tree.select(F.col("value").alias("_v"), F.col("parent").alias("_p"), F.col("level").alias("_l"))
    step = tree.select("value", F.col("value").alias("ancestor"), "level")
    out = step
    for _ in range(levels):
        above = step.filter(F.col("level") > 0).join(up, F.col("ancestor") == F.col("_v")).select("value", F.col("_p").alias("ancestor"))
        step = above.join(up.select(F.col("_v").alias("ancestor"), F.col("_l").alias("level")), "ancestor").select("value", "ancestor", "level")
        out = out.unionByName(step)
    return out


def group_lca(df: DataFrame, by: list[str], col: str, closed: DataFrame) -> DataFrame:
    """Deepest ancestor shared by all values of a group.

    Values are counted per group first, so the join with the closure sees one row per
    distinct value; the answer is the deepest ancestor that covers the whole group, null
    for a group with a value that the tree does not know.
    """
    counts = df.groupBy(*by, q(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    size = counts.groupBy(*by).agg(F.sum("n").alias("size"))
    cover = counts.join(closed, "value").groupBy(*by, "ancestor", "level").agg(F.sum("n").alias("covered"))
    full = size.join(cover, by, "left")
    whole = F.when(F.col("covered") == F.col("size"), F.col("level"))
    return full.groupBy(*by, "size").agg(F.max_by("ancestor", whole).alias("lca"), F.max(whole).alias("lca_level")).select(*by, "lca", "lca_level", F.col("size").alias("n"))


def depth(tree: DataFrame) -> int:
    """The deepest level, the root being 0."""
    return tree.agg(F.max("level")).first()[0] or 0


def paths(tree: DataFrame) -> DataFrame:
    """(value, code, path): every node with its number and the numbers from the root down to it; written.

    Nodes are numbered along the tree, parents first, so a subtree is a range of numbers
    and the common ancestor of two nodes is the common start of their paths.
    """
    up = closure(tree).groupBy("value").agg(F.array_sort(F.collect_list(F.struct("level", "ancestor"))).alias("up"))
    found = materialize(number_rows(up.select("value", "up", F.col("up.ancestor").alias("names")), ["names"], "code"))
    broken = found.filter(F.col("up.level") != F.sequence(F.lit(0), F.size("up") - 1)).select("value").first()
    if broken:
        raise ValueError(f"the levels above {broken['value']!r} do not lead to the root one by one")
    steps = found.select("value", "code", F.posexplode("names").alias("at", "ancestor"))
    steps = steps.join(found.select(F.col("value").alias("ancestor"), F.col("code").alias("number")), "ancestor")
    listed = F.array_sort(F.collect_list(F.struct("at", "number")))
    return materialize(steps.groupBy("value", "code").agg(F.transform(listed, lambda s: s["number"]).alias("path")))


def with_paths(df: DataFrame, col: str, known: DataFrame, width: int, name: str) -> DataFrame:
    """Add the path of a column's value, filled up with -1; a value that the tree does not know stands at the root."""
    side = known.select(F.col("value").alias("_value"), F.col("path").alias("_path"))
    root = F.array(F.lit(0).cast("bigint"))  # the root is numbered first
    filled = F.coalesce("_path", root)
    out = df.join(side, q(col).cast("string") == F.col("_value"), "left")
    out = out.withColumn(name, F.concat(filled, F.array_repeat(F.lit(-1).cast("bigint"), F.lit(width) - F.size(filled))))
    return out.drop("_value", "_path")
