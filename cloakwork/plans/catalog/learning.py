"""Neighbours, balancing, splits, metrics, trees and model studies."""

from pyspark.sql import functions as F

from cloakwork.functions.hashing import unit_hash_sql
from cloakwork.operators import balance, clusters, encode, folds, forest, metrics, nearest, tree
from cloakwork.operators.encode import Steps
from cloakwork.plans import evaluate, presets
from cloakwork.plans.catalog import register
from cloakwork.plans.catalog.common import LINE_NUM, PREDICTED_FLAG_SQL, predicted_flag, rounded
from cloakwork.plans.evaluate import Problem
from cloakwork.sources.tables import table

_E = "(select vec_id, embedding::double[] as e, label from embeddings)"
_MANHATTAN = "list_sum(list_transform(list_zip(a.e, b.e), lambda x: abs(x[1] - x[2])))"


@register(
    "knn_graph",
    f"""with d as (select a.vec_id as src, b.vec_id as dst, list_distance(a.e, b.e) as dist from {_E} a, {_E} b where a.vec_id <> b.vec_id)
    select src, dst, cast(row_number() over (partition by src order by dist, dst) as int) as "rank", round(dist, 6) as dist from d
    qualify row_number() over (partition by src order by dist, dst) <= 10""",
)
def knn_graph(spark, sf):
    pts = nearest.from_array(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return rounded(nearest.knn_graph(pts, 10), 6)


@register(
    "knn_graph_scaled",
    """with c as (select c_custkey, c_acctbal, c_nationkey, dense_rank() over (order by c_mktsegment) - 1 as seg from customer),
    m as (select avg(c_acctbal) a, stddev_pop(c_acctbal) sa, avg(c_nationkey) n, stddev_pop(c_nationkey) sn, avg(seg) g, stddev_pop(seg) sg from c),
    s as (select c_custkey, (c_acctbal - a) / sa as x, (c_nationkey - n) / sn as y, (seg - g) / sg as z from c, m),
    d as (select p.c_custkey as src, q.c_custkey as dst, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2) as dist
      from s p, s q where p.c_custkey <> q.c_custkey)
    select src, cast(row_number() over (partition by src order by dist, dst) as int) as "rank", round(dist, 6) as dist from d
    qualify row_number() over (partition by src order by dist, dst) <= 5""",
)
def knn_graph_scaled(spark, sf):
    cols = ["c_acctbal", "c_nationkey", "c_mktsegment"]
    return rounded(nearest.knn_columns(table(spark, sf, "customer"), "c_custkey", cols, 5, scale=True).drop("dst"), 6)


def _split_sql(part):
    return f"(select * from {_E} where {unit_hash_sql('vec_id', 42)} {'<' if part == 'valid' else '>='} 0.2)"


def _vote_sql(dist, weight):
    return f"""with d as (select a.vec_id, b.label, b.vec_id as other, {dist} as dist from {_split_sql('valid')} a, {_split_sql('train')} b),
    n as (select * from d qualify row_number() over (partition by vec_id order by dist, other) <= 5),
    v as (select vec_id, label, sum({weight}) as vote from n group by 1, 2)
    select vec_id, label as prediction from v qualify row_number() over (partition by vec_id order by vote desc, label) = 1"""


def _knn_classify(spark, sf, weights, p):
    e = folds.holdout(table(spark, sf, "embeddings"), "vec_id")
    train, valid = e.filter("part = 'train'"), e.filter("part = 'valid'")
    labels = train.select(F.col("vec_id").alias("did"), "label")
    out = nearest.knn_classify(
        nearest.from_array(train, "vec_id", "embedding", name="did"), nearest.from_array(valid, "vec_id", "embedding"), labels, 5, weights, p
    )
    return out.withColumnRenamed("qid", "vec_id")


@register("knn_classify", _vote_sql("list_distance(a.e, b.e)", "1.0::double"))
def knn_classify(spark, sf):
    return _knn_classify(spark, sf, "uniform", 2.0)


@register("knn_classify_weighted", _vote_sql(_MANHATTAN, "1.0 / dist"))
def knn_classify_weighted(spark, sf):
    return _knn_classify(spark, sf, "distance", 1.0)


def _thinned(spark, sf):
    """Embeddings with most rows of the higher labels left out, so classes are uneven."""
    e = table(spark, sf, "embeddings")
    uneven = F.col("vec_id") % (F.col("label") + 1) == 0
    return e.withColumn("label", F.when(uneven, F.col("label")).otherwise(0))


@register("smote_balance")
def smote_balance(spark, sf):
    e = _thinned(spark, sf)
    out = balance.smote(nearest.from_array(e, "vec_id", "embedding").join(e.select(F.col("vec_id").alias("qid"), "label"), "qid").drop("g"), "label")
    return out.select("qid", "copy", "label", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register(
    "smote_class_counts",
    """with t as (select case when vec_id % (label + 1) = 0 then label else 0 end as label from embeddings),
    c as (select label, count(*) as n from t group by 1)
    select label, n as original, (select max(n) from c) as balanced from c""",
)
def smote_class_counts(spark, sf):
    counts = smote_balance(spark, sf).groupBy("label")
    return counts.agg(F.count_if(F.col("copy") == 0).alias("original"), F.count(F.lit(1)).alias("balanced"))


# --- splits ----------------------------------------------------------------------------


@register(
    "holdout_split",
    f"select o_orderkey, case when {unit_hash_sql('o_orderkey', 42)} < 0.2 then 'valid' else 'train' end as part from orders",
)
def holdout_split(spark, sf):
    return folds.holdout(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@register(
    "kfold_sizes",
    f"select cast(floor({unit_hash_sql('o_orderkey', 42)} * 5) as int) as fold, count(*) as n from orders group by 1",
)
def kfold_sizes(spark, sf):
    return folds.kfold(table(spark, sf, "orders"), "o_orderkey").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register(
    "stratified_folds",
    f"""with u as (select o_orderkey, o_orderpriority, {unit_hash_sql('o_orderkey', 42)} as u from orders)
    select o_orderkey, o_orderpriority,
      cast((row_number() over (partition by o_orderpriority order by u, o_orderkey) - 1) % 5 as int) as fold from u""",
)
def stratified_folds(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return folds.stratified_kfold(t, "o_orderkey", "o_orderpriority")


# --- metrics ---------------------------------------------------------------------------

_CONFUSION = f"c as (select l_returnflag as label, {PREDICTED_FLAG_SQL} as pred, count(*) as n from lineitem group by 1, 2)"


@register("confusion", f"with {_CONFUSION} select * from c")
def confusion(spark, sf):
    t = table(spark, sf, "lineitem").withColumn("guess", predicted_flag())
    return metrics.confusion(t, "l_returnflag", "guess")


def _metric_sql(cells):
    return f"""{cells},
    k as (select label as c from c union select pred from c),
    p as (select k.c, coalesce(sum(n) filter (label = k.c and pred = k.c), 0) as tp, coalesce(sum(n) filter (label = k.c), 0) as a,
      coalesce(sum(n) filter (pred = k.c), 0) as b from k, c group by 1),
    m as (select tp, a, case when b > 0 then tp / b else 1 end as p, case when a > 0 then tp / a else 1 end as r, 2 * tp / (a + b) as f from p)
    select round(sum(tp) / sum(a), 6) as accuracy, round(avg(p), 6) as precision_macro, round(avg(r), 6) as recall_macro, round(avg(f), 6) as f1_macro,
      round(sum(p * a) / sum(a), 6) as precision_weighted, round(sum(r * a) / sum(a), 6) as recall_weighted, round(sum(f * a) / sum(a), 6) as f1_weighted from m"""


@register("classification_metrics", _metric_sql("with " + _CONFUSION))
def classification_metrics(spark, sf):
    t = table(spark, sf, "lineitem").withColumn("guess", predicted_flag())
    return rounded(metrics.classification_metrics(t, "l_returnflag", "guess"), 6)


@register(
    "classification_metrics_empty_class",
    _metric_sql(
        """with c as (select case when o_orderpriority = '1-URGENT' then 'P' else o_orderstatus end as label,
        case when o_totalprice > 250000 then 'F' when o_totalprice > 100000 then 'O' else 'X' end as pred, count(*) as n from orders group by 1, 2)"""
    ),
)
def classification_metrics_empty_class(spark, sf):
    label = F.when(F.col("o_orderpriority") == "1-URGENT", "P").otherwise(F.col("o_orderstatus"))
    pred = F.when(F.col("o_totalprice") > 250000, "F").when(F.col("o_totalprice") > 100000, "O").otherwise("X")
    t = table(spark, sf, "orders").select(label.alias("label"), pred.alias("pred"))
    return rounded(metrics.classification_metrics(t, "label", "pred"), 6)


_GUESS = "l_quantity * 1500 + l_discount * 1000"


@register(
    "regression_metrics",
    f"""with e as (select l_returnflag, l_extendedprice as y, l_extendedprice - ({_GUESS}) as e from lineitem)
    select l_returnflag, round(avg(e * e), 2) as mse, round(sqrt(avg(e * e)), 4) as rmse, round(avg(abs(e)), 4) as mae,
      round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) as r2 from e group by 1""",
)
def regression_metrics(spark, sf):
    t = table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 1500 + F.col("l_discount") * 1000)
    out = metrics.regression_metrics(t, "l_extendedprice", "guess", ["l_returnflag"])
    return out.select("l_returnflag", F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@register(
    "median_abs_error",
    f"select l_returnflag, round(median(abs(l_extendedprice - ({_GUESS}))), 4) as median_abs_error from lineitem group by 1",
)
def median_abs_error(spark, sf):
    t = table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 1500 + F.col("l_discount") * 1000)
    return rounded(metrics.median_absolute_error(t, "l_extendedprice", "guess", ["l_returnflag"]))


# --- trees -----------------------------------------------------------------------------


@register(
    "node_impurity",
    """with m as (select l_returnflag, avg(l_extendedprice) as a, median(l_extendedprice) as d from lineitem group by 1)
    select l_returnflag, round(var_pop(l_extendedprice), 2) as mse, round(avg(abs(l_extendedprice - a)), 4) as mae,
      round(avg(abs(l_extendedprice - d)), 4) as mad from lineitem join m using (l_returnflag) group by 1""",
)
def node_impurity(spark, sf):
    out = tree.impurity(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", F.round("mse", 2).alias("mse"), F.round("mae", 4).alias("mae"), F.round("mad", 4).alias("mad"))


def _best_sql(src, features, y, by):
    key = f"{by}, " if by else ""
    part = f"partition by {key}col" if by else "partition by col"
    melted = " union all ".join(f"select {key}{i} as pos, '{c}' as col, {c}::double as v, {y} as y from {src}" for i, c in enumerate(features))
    return f"""with x as ({melted}), f as (select {key}pos, col, v, count(*)::double as n, sum(y) as s, sum(y * y) as q from x group by all),
    r as (select *, sum(n) over w as cn, sum(s) over w as cs, sum(q) over w as cq, lead(v) over w as nv, sum(n) over a as tn, sum(s) over a as ts,
      sum(q) over a as tq from f window w as ({part} order by v), a as ({part})),
    g as (select *, (v + nv) / 2 as threshold, ((tq - ts * ts / tn) - (cq - cs * cs / cn) - ((tq - cq) - (ts - cs) * (ts - cs) / (tn - cn))) / tn as gain
      from r where nv is not null)
    select {key}col as "column", threshold, round(gain, 2) as gain, cn as n_left, tn as n from g
    qualify row_number() over ({'partition by ' + by if by else ''} order by gain desc, pos, threshold) = 1"""


@register("best_split_mse", _best_sql("lineitem", ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "(l_extendedprice - 50000)", ""))
def best_split_mse(spark, sf):
    out = tree.best_split(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice")
    return out.withColumn("gain", F.round("gain", 2))


@register("best_split_by_node", _best_sql("part", ["p_size", "p_partkey"], "(p_retailprice - 1000)", "p_type"))
def best_split_by_node(spark, sf):
    out = tree.best_split(table(spark, sf, "part"), ["p_size", "p_partkey"], "p_retailprice", ["p_type"])
    return out.withColumn("gain", F.round("gain", 2))


def _absolute_sql(centre):
    """Every threshold of two low-cardinality columns, both sides re-aggregated from the rows."""
    melted = " union all ".join(f"select {i} as pos, '{c}' as col, {c} as v, l_extendedprice as y from lineitem" for i, c in enumerate(["l_tax", "l_discount"]))
    return f"""with x as ({melted}), d as (select distinct pos, col, v from x),
    t as (select pos, col, (v + lead(v) over (partition by col order by v)) / 2 as threshold from d),
    j as (select t.pos, t.col, threshold, v <= threshold as side, y from t join x on t.col = x.col where threshold is not null),
    c as (select pos, col, threshold, side, {centre}(y) as c from j group by all),
    l as (select pos, col, threshold, sum(abs(y - c)) as loss, count(*) filter (side) as n_left, count(*) as n
      from j join c using (pos, col, threshold, side) group by all),
    w as (select sum(abs(l_extendedprice - (select {centre}(l_extendedprice) from lineitem))) as whole from lineitem)
    select col as "column", round(threshold, 6) as threshold, round((whole - loss) / n, 4) as gain, n_left::double as n_left, n::double as n from l, w
    order by whole - loss desc, pos, threshold limit 1"""


def _absolute_split(spark, sf, loss):
    out = tree.best_split(table(spark, sf, "lineitem"), ["l_tax", "l_discount"], "l_extendedprice", loss=loss)
    return out.withColumns({"gain": F.round("gain", 4), "threshold": F.round("threshold", 6)})


@register("best_split_mae", _absolute_sql("avg"))
def best_split_mae(spark, sf):
    return _absolute_split(spark, sf, "mae")


@register("best_split_mad", _absolute_sql("median"))
def best_split_mad(spark, sf):
    return _absolute_split(spark, sf, "mad")


@register(
    "tree_stump_predict",
    f"""with b as ({_best_sql('lineitem', ['l_quantity', 'l_discount', 'l_tax'], '(l_extendedprice - 50000)', '')}),
    s as (select l_orderkey, l_partkey, l_extendedprice, case b."column" when 'l_quantity' then l_quantity when 'l_discount' then l_discount
      else l_tax end <= b.threshold as side from lineitem, b)
    select l_orderkey, l_partkey, round(avg(l_extendedprice) over (partition by side), 4) as prediction from s""",
)
def tree_stump_predict(spark, sf):
    t = table(spark, sf, "lineitem")
    features = ["l_quantity", "l_discount", "l_tax"]
    stump = tree.fit_tree(t, "l_orderkey", features, "l_extendedprice", max_depth=1)
    return rounded(stump.predict(t.select("l_orderkey", "l_partkey", *features)).select("l_orderkey", "l_partkey", "prediction"))


_FLAGS = ("A", "N", "R")
_GINI_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _gini_ctes(src, features, label, classes):
    """The gain of every threshold of every column, as table g."""
    melted = " union all ".join(f"select {i} as pos, '{c}' as col, {c}::double as v, {label} as y from {src}" for i, c in enumerate(features))
    counts = ", ".join(f"count(*) filter (y = '{c}')::double as k{i}" for i, c in enumerate(classes))
    runs = ", ".join(f"sum(k{i}) over w as l{i}, sum(k{i}) over a as t{i}" for i in range(len(classes)))
    squares = lambda f: " + ".join(f"({f(i)}) ** 2" for i in range(len(classes)))
    left, right, whole = squares(lambda i: f"l{i}"), squares(lambda i: f"t{i} - l{i}"), squares(lambda i: f"t{i}")
    return f"""x as ({melted}), f as (select pos, col, v, count(*)::double as n, {counts} from x group by all),
    r as (select pos, col, v, sum(n) over w as cn, sum(n) over a as tn, lead(v) over w as nv, {runs} from f
      window w as (partition by col order by v), a as (partition by col)),
    g as (select *, (v + nv) / 2 as threshold, (({left}) / cn + ({right}) / (tn - cn) - ({whole}) / tn) / tn as gain from r where nv is not null)"""


_FIRST = "order by round(gain, 12) desc, pos, threshold limit 1"


def _gini_sql(src, features, label, classes):
    return f"""with {_gini_ctes(src, features, label, classes)}
    select col as "column", threshold, round(gain, 9) as gain, cn as n_left, tn as n from g {_FIRST}"""


@register("gini_split", _gini_sql("lineitem", _GINI_COLUMNS, "l_returnflag", _FLAGS))
def gini_split(spark, sf):
    """The first split of a classification tree."""
    return rounded(forest.best_split(table(spark, sf, "lineitem"), _GINI_COLUMNS, "l_returnflag"), 9, ["gain"])


_STUMP = _gini_sql("lineitem", _GINI_COLUMNS, "l_returnflag", _FLAGS)


@register(
    "gini_stump_predict",
    f"""with b as ({_STUMP}), s as (select l_orderkey, l_linenumber, l_returnflag as y, case b."column" when 'l_quantity' then l_quantity
      when 'l_extendedprice' then l_extendedprice when 'l_discount' then l_discount else l_tax end <= b.threshold as side from lineitem, b),
    c as (select side, y, count(*) as n from s group by 1, 2),
    m as (select side, y as prediction from c qualify row_number() over (partition by side order by n desc, y) = 1)
    select l_orderkey, l_linenumber, prediction from s join m using (side)""",
)
def gini_stump_predict(spark, sf):
    t = table(spark, sf, "lineitem")
    keyed = t.withColumn("id", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    stump = forest.fit(keyed, "id", _GINI_COLUMNS, "l_returnflag", trees=1, max_depth=1, bootstrap=False)
    return stump.predict(t.select("l_orderkey", "l_linenumber", *_GINI_COLUMNS)).select("l_orderkey", "l_linenumber", "prediction")


_DRAW = unit_hash_sql("(cast(p_partkey as varchar) || ':' || cast(t + 42 as varchar))", "bootstrap")


@register(
    "bootstrap_sizes",
    f"""with d as (select t, {_DRAW} as u from part, range(4) r(t)),
    c as (select sum(p) over (order by i) as cdf from (select i, exp(-1.0) / factorial(i::int) as p from range(12) x(i)))
    select cast(t as int) as tree, count(*) as n_rows, cast(sum(w) as bigint) as n_draws from
      (select t, (select count(*) from c where u >= cdf) as w from d) where w > 0 group by 1""",
)
def bootstrap_sizes(spark, sf):
    w = tree.bootstrap_weights(table(spark, sf, "part"), "p_partkey", 4)
    return w.groupBy("tree").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("w").alias("n_draws"))


_PART_FEATURES = ["p_size", "p_partkey"]


def _fit_error(spark, sf, **options):
    """Error of a forest of a hundred trees on its own rows."""
    part = table(spark, sf, "part")
    fitted = forest.fit(part, "p_partkey", _PART_FEATURES, "p_retailprice", "number", **options)
    scored = fitted.predict(part.select("p_partkey", "p_size", "p_retailprice"))
    return rounded(metrics.regression_metrics(scored, "p_retailprice", "prediction"))


@register("forest_regress")
def forest_regress(spark, sf):
    return _fit_error(spark, sf, trees=100)


@register("forest_standalone")
def forest_standalone(spark, sf):
    """Feature subsets per node and a minimum gain."""
    return _fit_error(spark, sf, trees=100, max_features="sqrt", min_gain=0.01)


_MELTED = " union all ".join(f"select t, {i} as pos, {c}::double as v, w, y, w * y as wy from d" for i, c in enumerate(_PART_FEATURES))


@register(
    "forest_stumps",
    f"""with u as (select p_partkey, p_size, t, p_retailprice as price, p_retailprice - (select avg(p_retailprice) from part) as y, {_DRAW} as u from part, range(20) r(t)),
    cdf as (select sum(p) over (order by i) as c from (select i, exp(-1.0) / factorial(i::int) as p from range(12) x(i))),
    d as (select * from (select *, (select count(*) from cdf where u >= c) as w from u) where w > 0),
    f as (select t, pos, v, sum(w) as n, sum(wy) as s from ({_MELTED}) group by 1, 2, 3),
    r as (select *, sum(n) over p as ln, sum(s) over p as ls, sum(n) over a as tn, sum(s) over a as ts, lead(v) over p as nv from f
      window p as (partition by t, pos order by v), a as (partition by t, pos)),
    g as (select t, pos, (v + nv) / 2 as threshold, (ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn) / tn as gain, ls / ln as l, (ts - ls) / (tn - ln) as h
      from r where nv is not null),
    b as (select * from g qualify row_number() over (partition by t order by round(gain, 12) desc, pos, threshold) = 1)
    select p_partkey, round(avg(case when case pos when 0 then p_size else p_partkey end <= threshold then l else h end) + (select avg(p_retailprice) from part), 4) as prediction
    from part, b group by 1""",
)
def forest_stumps(spark, sf):
    """Twenty trees of one split, each on its own draw of the rows."""
    part = table(spark, sf, "part")
    fitted = forest.fit(part, "p_partkey", _PART_FEATURES, "p_retailprice", "number", 20, 1)
    return rounded(fitted.predict(part.select("p_partkey", "p_size")).select("p_partkey", "prediction"))


# --- studies ---------------------------------------------------------------------------


def _customer_problem(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return Problem(c, "c_custkey", "c_mktsegment")


def _part_problem(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", F.crc32("p_name").alias("name_code"), "p_retailprice")
    return Problem(p, "p_partkey", "p_retailprice")


MODELS = {
    "random_forest": evaluate.random_forest(100),
    "logistic_regression": evaluate.logistic_regression(),
    "knn": evaluate.knn(5),
}


def _valid_means(scores):
    keep = scores.filter((F.col("part") == "valid") & (F.col("metric") != "fit_time"))
    return rounded(evaluate.summarize(keep), 4)


@register("cv_compare")
def cv_compare(spark, sf):
    """Three classifiers on five folds."""
    p = _customer_problem(spark, sf)
    steps = lambda: Steps([lambda df: encode.fit_standard(df, p.features(df))])
    scores = evaluate.cross_validate(p, MODELS, folds.kfold(p.df, p.key, 5), "scaled", steps)
    return _valid_means(scores)


@register("cv_regression")
def cv_regression(spark, sf):
    """Boosting, the library's forest and the own one, 100 trees each on five folds."""
    p = _part_problem(spark, sf)
    steps = lambda: presets.car_price((p.key, p.label))
    models = {
        "boosting": evaluate.gradient_boosting(),
        "forest": evaluate.forest_regression(),
        "own_forest": evaluate.own_forest_regression(),
    }
    return _valid_means(evaluate.cross_validate(p, models, folds.kfold(p.df, p.key, 5), "one_hot", steps, "number"))


def _knn_grid_sql(rows, name):
    """Five stratified folds of (id, a, b, label); every (k, weights, p) judged as the library judges it: table ``{name}_means``."""
    part = f"partition by {{}}p, k, weights"
    return f"""{name}_r as (select *, (row_number() over (partition by label order by {unit_hash_sql('id', 42)}, id) - 1) % 5 as fold from ({rows})),
    {name}_d as (select x.id, x.fold, x.label, y.label as other, y.id as oid, pw as p,
      case when pw = 1 then abs(x.a - y.a) + abs(x.b - y.b) else sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2) end as dist
      from {name}_r x join {name}_r y on x.fold <> y.fold, (select unnest([1, 2]) as pw)),
    {name}_n as (select *, row_number() over (partition by p, id order by dist, oid) as rk, min(dist) over (partition by p, id) = 0 as exact from {name}_d qualify rk <= 21),
    {name}_v as (select p, k, weights, id, fold, label, other, sum(case when weights = 'uniform' or dist = 0 then 1.0::double when exact then 0.0 else 1.0 / dist end) as vote
      from {name}_n join (select k, weights from (select unnest([3, 5, 7, 9, 11, 15, 21]) as k), (select unnest(['uniform', 'distance']) as weights)) on rk <= k group by all),
    {name}_c as (select p, k, weights, fold, label, pred, count(*) as n from
      (select p, k, weights, fold, label, other as pred from {name}_v qualify row_number() over (partition by p, k, weights, id order by vote desc, other) = 1) group by all),
    {name}_k as (select distinct p, k, weights, fold, label as c from {name}_c union select distinct p, k, weights, fold, pred from {name}_c),
    {name}_s as (select p, k, weights, fold, x.c, coalesce(sum(n) filter (label = x.c and pred = x.c), 0) as tp, coalesce(sum(n) filter (label = x.c), 0) as a,
      coalesce(sum(n) filter (pred = x.c), 0) as b from {name}_k as x join {name}_c using (p, k, weights, fold) group by all),
    {name}_f as (select p, k, weights, fold, sum(tp) / sum(a) as accuracy, avg(2 * tp / (a + b)) as f1_macro, avg(case when b > 0 then tp / b else 1 end) as precision_macro,
      avg(case when a > 0 then tp / a else 1 end) as recall_macro from {name}_s group by all),
    {name}_means as (select p, k, weights, {", ".join(f"avg({m}) as {m}_mean, stddev_pop({m}) as {m}_std" for m in _GRID_METRICS)} from {name}_f group by all)"""


_GRID_METRICS = ["accuracy", "f1_macro", "precision_macro", "recall_macro"]
_KNN_POINTS = """(select k, weights, metric, pp, case metric when 'euclidean' then 2 when 'manhattan' then 1 else pp end as p,
      'k=' || k || ', metric=' || metric || ', p=' || pp || ', weights=' || weights as params,
      row_number() over (order by ki, wi, mi, pp) as place
    from (select unnest([3, 5, 7, 9, 11, 15, 21]) as k, unnest(range(7)) as ki), (select unnest(['uniform', 'distance']) as weights, unnest(range(2)) as wi),
      (select unnest(['euclidean', 'manhattan', 'minkowski']) as metric, unnest(range(3)) as mi), (select unnest([1, 2]) as pp))"""


@register(
    "grid_search",
    f"""with {_knn_grid_sql("select c_custkey as id, c_nationkey::double as a, c_acctbal as b, c_mktsegment as label from customer", "g")}
    select params, {", ".join(f"round({m}_{s}, 4) as {m}_{s}" for m in _GRID_METRICS for s in ("mean", "std"))}
    from {_KNN_POINTS} join g_means using (p, k, weights)""",
)
def grid_search(spark, sf):
    """All 84 settings of the neighbour classifier on five folds."""
    p = _customer_problem(spark, sf)
    out = evaluate.shared_grid(p, "knn", evaluate.grid(evaluate.KNN_GRID), folds.stratified_kfold(p.df, p.key, p.label, 5))
    return rounded(out.select("params", *[f"{m}_{s}" for m in _GRID_METRICS for s in ("mean", "std")]), 4)


@register("grid_search_forest")
def grid_search_forest(spark, sf):
    """All 81 settings of the forest on five folds."""
    p = _customer_problem(spark, sf)
    out = evaluate.shared_grid(p, "random_forest", evaluate.grid(evaluate.RANDOM_FOREST_GRID), folds.stratified_kfold(p.df, p.key, p.label, 5))
    return rounded(out.drop("setting"), 4)


@register("grid_search_logistic")
def grid_search_logistic(spark, sf):
    """The 45 settings of the one solver there is, on five folds of scaled rows."""
    p = _customer_problem(spark, sf)
    features = p.features(p.df)
    p = Problem(encode.fit_standard(p.df, features).apply(p.df), p.key, p.label)
    settings = evaluate.grid({**evaluate.LOGISTIC_GRID, "solver": ["lbfgs"]})
    out = evaluate.shared_grid(p, "logistic_regression", settings, folds.stratified_kfold(p.df, p.key, p.label, 5))
    return rounded(out.drop("setting"), 4)


@register("forest_sweep")
def forest_sweep(spark, sf):
    """One parameter at a time around the defaults: nine settings, five folds, read off one forest a fold."""
    p = _part_problem(spark, sf)
    p = Problem(p.df.drop("p_type"), p.key, p.label)
    settings = evaluate.one_at_a_time(evaluate.SWEEP_DEFAULTS, evaluate.SWEEP_VALUES)
    return rounded(evaluate.forest_sweep(p, settings, folds.kfold(p.df, p.key, 5)), 4)


_HELD = f"{unit_hash_sql('c_custkey', 42)} < 0.2"
_PLAIN = "select c_custkey as id, c_nationkey::double as a, c_acctbal as b, c_mktsegment as label from customer"


@register(
    "refit_best",
    f"""with {_knn_grid_sql(f"{_PLAIN} where not ({_HELD})", "g")},
    w as (select params, p, k, weights from {_KNN_POINTS} join g_means using (p, k, weights) order by round(f1_macro_mean, 9) desc, place limit 1),
    n as (select x.id, x.label, y.label as other, y.id as oid, w.*, case when w.p = 1 then abs(x.a - y.a) + abs(x.b - y.b)
      else sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2) end as dist from ({_PLAIN} where {_HELD}) x, g_r y, w
      qualify row_number() over (partition by x.id order by dist, y.id) <= w.k),
    e as (select *, min(dist) over (partition by id) = 0 as exact from n),
    v as (select params, id, label, other, sum(case when weights = 'uniform' or dist = 0 then 1.0::double when exact then 0.0 else 1.0 / dist end) as vote from e group by all),
    c as (select params, label, other as pred from v qualify row_number() over (partition by id order by vote desc, other) = 1)
    select any_value(params) as params, count(*) as n, round(avg(case when label = pred then 1.0 else 0.0 end), 6) as accuracy from c""",
)
def refit_best(spark, sf):
    """The winner of the whole grid, fitted on all training rows and judged on the rows held out."""
    p = _customer_problem(spark, sf)
    split = folds.holdout(p.df, p.key)
    train, valid = split.filter("part = 'train'").drop("part"), split.filter("part = 'valid'").drop("part")
    best, scores = evaluate.refit_winner(p, "knn", evaluate.grid(evaluate.KNN_GRID), train, valid)
    out = scores.filter("metric = 'accuracy'").select(F.lit(evaluate.named(best)).alias("params"), F.lit(valid.count()).cast("long").alias("n"), F.round("value", 6).alias("accuracy"))
    return out


_NEW = f"{unit_hash_sql('o_orderkey', 42)} < 0.2"


@register(
    "score_batch_keys",
    f"""with {_gini_ctes(f"(select * from orders where not ({_NEW}))", ["o_totalprice", "o_custkey"], "o_orderstatus", ("F", "O", "P"))},
    b as (select col, threshold from g {_FIRST}),
    s as (select o_orderkey, o_orderstatus as y, {_NEW} as held, case b.col when 'o_totalprice' then o_totalprice else o_custkey end <= b.threshold as side from orders, b),
    c as (select side, y, count(*) as n from s where not held group by 1, 2),
    m as (select side, y as prediction from c qualify row_number() over (partition by side order by n desc, y) = 1)
    select o_orderkey, prediction from s join m using (side) where held""",
)
def score_batch_keys(spark, sf):
    """A tuned model (here a single split) gives every row of the unlabelled part its class."""
    o = folds.holdout(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus"), "o_orderkey")
    p = Problem(o, "o_orderkey", "o_orderstatus")
    train, new = o.filter("part = 'train'").drop("part"), o.filter("part = 'valid'").drop("part", "o_orderstatus")
    return evaluate.score_batch(p, train, new, evaluate.stump())


def _best_forest(p, cut):
    """The winner of the forest grid on the same folds."""
    settings = evaluate.grid(evaluate.RANDOM_FOREST_GRID)
    return evaluate.winner(evaluate.shared_grid(p, "random_forest", settings, cut), settings)


@register("balancing_study")
def balancing_study(spark, sf):
    """The default forest on the rows as they are, on balanced rows, and the best forest on balanced rows; five folds."""
    o = table(spark, sf, "customer").withColumn("rich", (F.col("c_acctbal") > 8000).cast("string"))
    p = Problem(o.select("c_custkey", "c_nationkey", F.crc32("c_name").alias("name_code"), "rich"), "c_custkey", "rich")
    scale = lambda df: encode.fit_standard(df, p.features(df))
    plain, smote = (lambda: Steps([scale])), (lambda: Steps([scale, evaluate.balanced(p)], {1}))
    cut = folds.stratified_kfold(p.df, p.key, p.label, 5)
    default, best = evaluate.random_forest(), evaluate.random_forest(**_best_forest(p, cut))
    scores = evaluate.compare_variants(p, {"default": default}, {"plain": plain}, cut)
    return _valid_means(scores.unionByName(evaluate.compare_variants(p, {"default": default, "best": best}, {"smote": smote}, cut)))


@register("feature_reduction_study")
def feature_reduction_study(spark, sf):
    """All 64 columns of a vector, the 30 best ones, and those left when a family of names is dropped; five folds."""
    e = table(spark, sf, "embeddings")
    p = Problem(e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)], "label"), "vec_id", "label")
    variants = {
        "all": None,
        "best_30": lambda: Steps([evaluate.k_best(p, 30)]),
        "dropped": lambda: Steps([evaluate.without([f"e{i}" for i in range(40, 64)])]),
    }
    return _valid_means(evaluate.compare_variants(p, {"random_forest": MODELS["random_forest"]}, variants, folds.kfold(p.df, p.key, 5)))


@register("utility_compare")
def utility_compare(spark, sf):
    """The same models and folds on raw rows, on rows recoded inside each fold, and on rows recoded before."""
    p = _customer_problem(spark, sf)
    p = Problem(p.df.withColumn("c_nationkey", F.col("c_nationkey").cast("string")), p.key, p.label)
    recode = lambda df: clusters.fit_clusters(df, p.key, ["c_acctbal"], ["c_nationkey"], 5, block_rows=500)
    make = lambda anonymizer: lambda: presets.anonymizing(("c_nationkey",), (p.key, p.label, "fold"), anonymizer)
    cut = folds.kfold(p.df, p.key, 5)
    inside = evaluate.compare_variants(p, MODELS, {"original": make(None), "anonymized inside": make(recode)}, cut)
    before = evaluate.materialize(recode(cut).publish(cut).drop("cluster_id"))
    ready = Problem(before, p.key, p.label)
    kept = lambda: presets.anonymizing(("c_nationkey",), (p.key, p.label, "fold"), already_anonymized=True)
    return _valid_means(inside.unionByName(evaluate.compare_variants(ready, MODELS, {"anonymized before": kept}, before)))
