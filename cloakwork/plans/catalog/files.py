"""Scans and writers, each over a whole table that is written and read back, and pipelines as a whole."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.hashing import unit_hash_sql
from cloakwork.operators import clean, clusters, encode, folds, hierarchy, profile
from cloakwork.operators.encode import Steps
from cloakwork.plans import evaluate
from cloakwork.plans.anonymize import global_anonymize
from cloakwork.plans.catalog import ORACLES, register
from cloakwork.plans.catalog.learning import grid_search
from cloakwork.plans.catalog.privacy import CUSTOMER, _nation_tree
from cloakwork.plans.evaluate import Problem
from cloakwork.session import materialize, scratch_root
from cloakwork.sources import sinks, tables
from cloakwork.sources.tables import table

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _fresh(spark):
    """A folder of its own under the shared one."""
    return f"{scratch_root(spark)}/files/{uuid.uuid4().hex}"


@register("csv_round_trip", "select * from customer")
def csv_round_trip(spark, sf):
    path = sinks.write_csv(table(spark, sf, "customer"), _fresh(spark))
    return tables.read_csv(spark, path, CUSTOMER_SCHEMA)


@register("csv_null_token", "select c_custkey, case when c_custkey % 5 <> 0 then c_acctbal end as c_acctbal from customer")
def csv_null_token(spark, sf):
    """Unknown values are written as a question mark and come back as nulls."""
    c = table(spark, sf, "customer")
    balance = F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal").cast("string")).otherwise("?")
    path = sinks.write_csv(c.select("c_custkey", balance.alias("c_acctbal")), _fresh(spark))
    return tables.read_csv(spark, path, "c_custkey bigint, c_acctbal double", null_token="?")


@register("anonymized_file", ORACLES["global_anonymize"])
def anonymized_file(spark, sf):
    """The anonymized table as a file with semicolons, read again."""
    done = global_anonymize(table(spark, sf, "customer"), CUSTOMER, "c_custkey").rows
    path = sinks.write_anonymized(done, CUSTOMER, _fresh(spark), "customer")
    return tables.read_csv(spark, path, "c_nationkey string, c_acctbal string, c_mktsegment string", sep=";")


@register(
    "person_table",
    """select c_custkey as id, cast(c_nationkey + 18 as bigint) as age, c_mktsegment as workclass, n_name as "native-country",
      case when c_custkey % 2 = 0 then 'F' else 'M' end as sex, r_name as race, 'Single' as "marital-status"
    from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey""",
)
def person_table(spark, sf):
    """Keyed persons with blanks around the categories."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    c = c.join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    blank = lambda col: F.concat(F.lit(" "), col, F.lit(" "))
    persons = c.select(
        F.col("c_custkey").alias("id"),
        (F.col("c_nationkey") + 18).alias("age"),
        blank("c_mktsegment").alias("workclass"),
        blank("n_name").alias("native-country"),
        blank(F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M")).alias("sex"),
        blank("r_name").alias("race"),
        F.lit(" Single").alias("marital-status"),
    )
    path = _fresh(spark)
    persons.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.read_persons(spark, path)


@register(
    "hierarchy_file",
    """select n_name as value, r_name as parent, 2 as level, n_name as name from nation join region on n_regionkey = r_regionkey
    union all select r_name, 'all', 1, r_name from region union all select 'all', 'all', 0, '*'""",
)
def hierarchy_file(spark, sf):
    """The nations' tree written as one JSON document and loaded again."""
    entry = F.struct("name", F.col("parent").alias("gen"), "level")
    listed = F.map_from_entries(F.collect_list(F.struct("value", entry)))  # the tree is a specification, one document
    doc = _nation_tree(spark, sf).agg(F.to_json(F.struct(F.lit("nations").alias("name"), listed.alias("entries"))).alias("value"))
    path = _fresh(spark)
    doc.coalesce(1).write.text(path)
    return hierarchy.read_hierarchy(spark, path)


@register("feature_files", "select c_custkey, c_acctbal, c_nationkey, c_mktsegment, 'c_acctbal,c_nationkey' as num_cols from customer")
def feature_files(spark, sf):
    """Features and target in one table with the column roles beside it."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    info = {"num_cols": ["c_acctbal", "c_nationkey"], "target_col": "c_mktsegment"}
    df, roles = tables.load_features(spark, sinks.write_features(c, info, _fresh(spark)), "c_mktsegment")
    return df.withColumn("num_cols", F.lit(",".join(roles["num_cols"])))


@register("feature_files_without_roles", "select c_custkey, c_acctbal, c_mktsegment, 'c_custkey,c_acctbal' as num_cols from customer")
def feature_files_without_roles(spark, sf):
    """Without the roles every number is a feature."""
    path = _fresh(spark)
    table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").write.parquet(f"{path}/data")
    df, roles = tables.load_features(spark, path, "c_mktsegment")
    return df.withColumn("num_cols", F.lit(",".join(roles["num_cols"])))


@register("score_file", f"select o_orderkey as ID, prediction as class from ({ORACLES['score_batch_keys']})")
def score_file(spark, sf):
    """Predictions of a batch as the file that is handed in."""
    o = folds.holdout(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus"), "o_orderkey")
    p = Problem(o, "o_orderkey", "o_orderstatus")
    train, new = o.filter("part = 'train'").drop("part"), o.filter("part = 'valid'").drop("part", "o_orderstatus")
    scored = evaluate.score_batch(p, train, new, evaluate.stump()).withColumnRenamed("o_orderkey", "ID")
    return tables.read_csv(spark, sinks.write_scores(scored, _fresh(spark)), "ID bigint, class string")


@register("grid_overview", ORACLES["grid_search"])
def grid_overview(spark, sf):
    """The results of a search as a file, best first, read again."""
    path = sinks.write_grid_overview(grid_search(spark, sf), _fresh(spark), "f1_macro_mean")
    return tables.read_csv(spark, path)


@register(
    "sorted_counts",
    """with c as (select p_type as value, count(*) as n from part group by 1)
    select value, n, row_number() over (order by value) - 1 as by_key, row_number() over (order by n desc, value) - 1 as by_count from c""",
)
def sorted_counts(spark, sf):
    """Counts with their place in the order of the values and in that of the counts."""
    return profile.sorted_counts(table(spark, sf, "part"), "p_type")


_FAMILY = 64


@register("drop_family", f"select vec_id, {', '.join(f'embedding[{i + 1}]::double as e{i}' for i in range(24, _FAMILY))} from embeddings")
def drop_family(spark, sf):
    """A family of numbered columns goes: e0 to e23."""
    e = table(spark, sf, "embeddings")
    wide = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_FAMILY)])
    return clean.drop_family(wide, ["e"])


_RICH = "case when c_acctbal > 8000 then 'true' else 'false' end"


@register(
    "pipeline_rows",
    f"""with s as (select {_RICH} as rich, {unit_hash_sql('c_custkey', 42)} < 0.2 as held from customer), c as (select held, rich, count(*) as n from s group by 1, 2)
    select case when held then 'valid' else 'train' end as part, rich, case when held then n else max(n) over (partition by held) end as n from c""",
)
def pipeline_rows(spark, sf):
    """Scaling, then balancing that works on the training rows only."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", (F.col("c_acctbal") > 8000).cast("string").alias("rich"))
    split = folds.holdout(c, "c_custkey")
    p = Problem(c, "c_custkey", "rich")
    steps = Steps([lambda df: encode.fit_standard(df, p.features(df)), evaluate.balanced(p)], {1})
    fitted, train = steps.fit(split.filter("part = 'train'").drop("part"))
    valid = fitted.apply(split.filter("part = 'valid'").drop("part"))
    both = train.select(F.lit("train").alias("part"), "rich").unionByName(valid.select(F.lit("valid").alias("part"), "rich"))
    return both.groupBy("part", "rich").agg(F.count(F.lit(1)).alias("n"))


@register(
    "anonymity_in_folds",
    f"""with f as (select cast(floor({unit_hash_sql('c_custkey', 42)} * 5) as int) as fold from customer)
    select fold, true as at_least_k, (select count(*) from customer) - count(*) as n_rows from f group by 1""",
)
def anonymity_in_folds(spark, sf):
    """The rows that a model is trained on inside each fold stand in groups of five and more."""
    c = folds.kfold(table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), "c_custkey", 5)

    def one(fold):
        train = c.filter(F.col("fold") != fold).drop("fold")
        recode = lambda df: clusters.fit_clusters(df, "c_custkey", ["c_acctbal"], ["c_mktsegment"], 5, block_rows=100)
        _, seen = Steps([recode]).fit(train)
        groups = seen.groupBy("c_acctbal_min", "c_acctbal_max", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
        return materialize(groups.agg(F.lit(fold).alias("fold"), (F.min("n") >= 5).alias("at_least_k"), F.sum("n").alias("n_rows")))

    with ThreadPoolExecutor(5) as pool:  # the rounds of a fold leave most cores idle
        lines = list(pool.map(one, range(5)))
    return reduce(DataFrame.unionByName, lines)
