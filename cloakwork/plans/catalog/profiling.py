"""Profiling, cleaning, filtering and correlation reports."""

from pyspark.sql import functions as F

from cloakwork.operators import clean, profile
from cloakwork.plans.catalog import register
from cloakwork.plans.catalog.common import (
    LINE_NUM,
    ORDER_HOLES,
    ORDERS_WITH_EMPTY_MONTHS_SQL,
    ORDERS_WITH_HOLES_SQL,
    orders_with_empty_months,
    orders_with_holes,
    rounded,
)
from cloakwork.roles import is_categorical, numeric_columns
from cloakwork.sources.tables import table

HOLES = list(ORDER_HOLES)


def _union(parts):
    return "\nunion all\n".join(parts)


@register("table_shape", "select count(*) as n_rows, cast(11 as bigint) as n_columns from lineitem")
def table_shape(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


@register(
    "null_counts",
    f"with t as ({ORDERS_WITH_HOLES_SQL}) "
    + _union(f"select '{c}' as \"column\", count(*) - count({c}) as n_null from t" for c in HOLES),
)
def null_counts(spark, sf):
    return profile.null_counts(orders_with_holes(table(spark, sf, "orders")), HOLES)


_MISSING = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in HOLES)


@register(
    "null_histogram",
    f"""with t as ({ORDERS_WITH_HOLES_SQL}), m as (select {_MISSING} as k from t)
    select cast(k as bigint) as n_missing, count(*) as n_rows,
      round(100.0 * count(*) / (select count(*) from m), 4)::double as percent,
      case when k <= 1 then 'KEEP' else 'DROP' end as decision
    from m group by k""",
)
def null_histogram(spark, sf):
    return rounded(profile.null_histogram(orders_with_holes(table(spark, sf, "orders")), HOLES, 1))


@register(
    "rows_preserved",
    f"""with t as ({ORDERS_WITH_HOLES_SQL}), m as (select {_MISSING} as k from t)
    select count(*) as n_rows, count(*) filter (k <= 1) as n_kept,
      round(100.0 * count(*) filter (k <= 1) / count(*), 4)::double as percent_kept from m""",
)
def rows_preserved(spark, sf):
    return rounded(profile.preserved(orders_with_holes(table(spark, sf, "orders")), HOLES, 1))


@register(
    "keep_dense_rows",
    f"""with t as ({ORDERS_WITH_HOLES_SQL})
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from t where {_MISSING} <= 1""",
)
def keep_dense_rows(spark, sf):
    out = clean.keep_dense_rows(orders_with_holes(table(spark, sf, "orders")), HOLES, 1)
    return out.select("o_orderkey", *HOLES)


@register(
    "drop_sparse_rows",
    f"""with t as ({ORDERS_WITH_HOLES_SQL})
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from t where 4 - ({_MISSING}) >= 2""",
)
def drop_sparse_rows(spark, sf):
    out = clean.drop_sparse_rows(orders_with_holes(table(spark, sf, "orders")), HOLES)
    return out.select("o_orderkey", *HOLES)


@register(
    "median_impute",
    f"""with t as ({ORDERS_WITH_HOLES_SQL})
    select o_orderkey, round(coalesce(o_totalprice, (select median(o_totalprice) from t)), 4) as o_totalprice,
      round(coalesce(o_custkey, (select median(o_custkey) from t)), 4) as o_custkey from t""",
)
def median_impute(spark, sf):
    cols = ["o_totalprice", "o_custkey"]
    out = clean.median_impute(orders_with_holes(table(spark, sf, "orders")).select("o_orderkey", *cols), cols)
    return rounded(out)


@register(
    "clean_sparse",
    f"""with t as ({ORDERS_WITH_HOLES_SQL}), d as (select * from t where {_MISSING} <= 1)
    select o_orderkey, o_orderstatus, o_orderpriority,
      round(coalesce(o_totalprice, (select median(o_totalprice) from d)), 4) as o_totalprice,
      round(coalesce(o_custkey, (select median(o_custkey) from d)), 4) as o_custkey from d""",
)
def clean_sparse(spark, sf):
    out = clean.clean_sparse(orders_with_holes(table(spark, sf, "orders")), HOLES, 1)
    return rounded(out.select("o_orderkey", *HOLES))


@register(
    "month_mean_impute",
    f"""with t as ({ORDERS_WITH_EMPTY_MONTHS_SQL}),
    a as (select o_orderkey, o_orderdate, coalesce(o_totalprice,
            avg(o_totalprice) over (partition by date_trunc('month', o_orderdate))) as p from t)
    select o_orderkey, round(coalesce(p, avg(p) over (partition by month(o_orderdate))), 4) as o_totalprice from a""",
)
def month_mean_impute(spark, sf):
    t = orders_with_empty_months(table(spark, sf, "orders"))
    return rounded(clean.month_mean_impute(t, "o_orderdate", ["o_totalprice"]).select("o_orderkey", "o_totalprice"))


_DESCRIBE = _union(
    f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 2) as mean, round(stddev_samp({c}), 2) as std,
    round(min({c}), 2) as "min", round(quantile_cont({c}, 0.25), 2) as q25, round(quantile_cont({c}, 0.5), 2) as q50,
    round(quantile_cont({c}, 0.75), 2) as q75, round(max({c}), 2) as "max" from lineitem"""
    for c in LINE_NUM
)


@register("describe_numeric", _DESCRIBE)
def describe_numeric(spark, sf):
    return profile.describe(table(spark, sf, "lineitem"), LINE_NUM)


@register("value_counts", "select o_orderpriority as value, count(*) as n from orders group by 1")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@register(
    "value_counts_normalized",
    """select c_mktsegment as value, count(*) as n, round(count(*) / (select count(*) from customer)::double, 6) as share
    from customer group by 1""",
)
def value_counts_normalized(spark, sf):
    return rounded(profile.value_counts(table(spark, sf, "customer"), "c_mktsegment", True), 6)


@register(
    "class_distribution",
    """with c as (select l_returnflag as label, count(*) as n from lineitem group by 1)
    select label, n, round(100.0 * n / (select sum(n) from c), 4)::double as percent,
      (select max(n) from c) as majority, (select min(n) from c) as minority from c""",
)
def class_distribution(spark, sf):
    return rounded(profile.class_distribution(table(spark, sf, "lineitem"), "l_returnflag"))


@register(
    "positive_rate",
    """select count(*) filter (l_linestatus = 'F') as positives,
    round(avg(case when l_linestatus = 'F' then 1.0 else 0.0 end), 6)::double as rate from lineitem""",
)
def positive_rate(spark, sf):
    return rounded(profile.positive_rate(table(spark, sf, "lineitem"), F.col("l_linestatus") == "F"), 6)


@register(
    "distinct_counts",
    _union(
        f"select '{c}' as \"column\", count(distinct {c}) as n_distinct from part"
        for c in ["p_brand", "p_type", "p_size", "p_name"]
    ),
)
def distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "part"), ["p_brand", "p_type", "p_size", "p_name"])


@register(
    "column_bounds",
    _union(
        f"select '{c}' as \"column\", min({c}) as lo, max({c}) as hi, round(avg({c}), 4) as mean from lineitem"
        for c in LINE_NUM
    ),
)
def column_bounds(spark, sf):
    return rounded(profile.column_bounds(table(spark, sf, "lineitem"), LINE_NUM))


@register(
    "group_profile",
    """select event_type, count(*) as n, round(avg("value"), 4) as mean_value, round(avg(user_id), 4) as mean_user_id
    from events group by 1""",
)
def group_profile(spark, sf):
    return rounded(profile.group_profile(table(spark, sf, "events"), "event_type", ["value", "user_id"]))


_DIFF = ["l_quantity", "l_extendedprice", "l_discount"]


@register(
    "two_group_diff",
    _union(
        f"""select '{c}' as "column", round(avg({c}) filter (l_linestatus = 'F'), 4) as mean_true,
        round(avg({c}) filter (l_linestatus <> 'F'), 4) as mean_false,
        round(avg({c}) filter (l_linestatus = 'F') - avg({c}) filter (l_linestatus <> 'F'), 4) as difference from lineitem"""
        for c in _DIFF
    ),
)
def two_group_diff(spark, sf):
    return rounded(profile.two_group_difference(table(spark, sf, "lineitem"), F.col("l_linestatus") == "F", _DIFF))


@register(
    "most_least_common",
    """with c as (select p_brand as v, count(*) as n from part group by 1)
    select (select v from c order by n desc, v limit 1) as most_common, (select max(n) from c) as most_n,
      (select v from c order by n, v limit 1) as least_common, (select min(n) from c) as least_n,
      round((select max(n) from c) / (select min(n) from c)::double, 6) as ratio""",
)
def most_least_common(spark, sf):
    return rounded(profile.most_least_common(table(spark, sf, "part"), "p_brand"), 6)


@register(
    "group_mode",
    """with c as (select p_type, p_size, count(*) as n from part group by 1, 2)
    select p_type, 'p_size' as "column", p_size as mode from c
    qualify row_number() over (partition by p_type order by n desc, p_size) = 1""",
)
def group_mode(spark, sf):
    return profile.mode_of(table(spark, sf, "part"), ["p_type"], ["p_size"])


def _pairs(cols):
    s = sorted(cols)
    return [(a, b) for i, a in enumerate(s) for b in s[i + 1 :]]


@register(
    "corr_matrix",
    _union(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from lineitem" for a, b in _pairs(LINE_NUM)
    ),
)
def corr_matrix(spark, sf):
    return rounded(profile.correlations(table(spark, sf, "lineitem"), LINE_NUM), 6)


_LINE_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_NUM]
_TARGET_CORR = _union(
    f"select '{c}' as \"column\", round(corr({c}, l_extendedprice), 6) as corr from lineitem"
    for c in _LINE_ALL
    if c != "l_extendedprice"
)


@register(
    "corr_target_topk",
    f"""with c as ({_TARGET_CORR})
    select * from (select "column", corr, 'top' as side from c order by corr desc, "column" limit 3)
    union all
    select * from (select "column", corr, 'bottom' as side from c order by corr, "column" limit 3)""",
)
def corr_target_topk(spark, sf):
    corrs = profile.target_correlations(table(spark, sf, "lineitem"), "l_extendedprice", _LINE_ALL)
    return profile.strongest(rounded(corrs, 6), 3)


@register(
    "corr_threshold",
    f"""with c as ({_TARGET_CORR})
    select "column", corr, case when abs(corr) > 0.8 then 'high' else 'low' end as band
    from c where abs(corr) > 0.8 or abs(corr) < 0.2""",
)
def corr_threshold(spark, sf):
    corrs = profile.target_correlations(table(spark, sf, "lineitem"), "l_extendedprice", _LINE_ALL)
    return profile.correlation_band(rounded(corrs, 6))


_PART_NUM = ["p_partkey", "p_retailprice", "p_size"]


@register(
    "explore_report",
    _union(
        f"""select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr, {'true' if 'p_retailprice' in (a, b) else 'false'} as with_target,
        case when {'true' if 'p_retailprice' in (a, b) else 'false'} and abs(corr({a}, {b})) > 0.8 then 'high'
             when {'true' if 'p_retailprice' in (a, b) else 'false'} and abs(corr({a}, {b})) < 0.2 then 'low' end as band from part"""
        for a, b in _pairs(_PART_NUM)
    ),
)
def explore_report(spark, sf):
    return rounded(profile.explore(table(spark, sf, "part").select(*_PART_NUM), "p_retailprice"), 6)


_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register(
    "crosstab",
    "select o_orderstatus, "
    + ", ".join(f"count(*) filter (o_orderpriority = '{p}') as \"{p}\"" for p in _PRIO)
    + " from orders group by 1",
)
def crosstab(spark, sf):
    return profile.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@register(
    "histogram_bins",
    """with b as (select min("value") as lo, (max("value") - min("value")) / 20 as w from events),
    h as (select least(cast(floor(("value" - lo) / w) as bigint), 19) as bin, lo, w from events, b)
    select bin, round(lo + bin * w, 6) as lo, round(lo + (bin + 1) * w, 6) as hi, count(*) as n
    from h group by bin, lo, w""",
)
def histogram_bins(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "events"), "value", 20), 6)


def _box(src, col, by=""):
    key = f"{by}, " if by else ""
    part = f"group by {by}" if by else ""
    match = f"using ({by})" if by else "on true"
    return f"""with q as (select {key}quantile_cont({col}, 0.25) as q25, quantile_cont({col}, 0.5) as q50,
      quantile_cont({col}, 0.75) as q75 from {src} {part}),
    j as (select *, {col} between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) as ok from {src} join q {match})
    select {key}round(q25, 4) as q25, round(q50, 4) as q50, round(q75, 4) as q75, min({col}) filter (ok) as whisker_lo,
      max({col}) filter (ok) as whisker_hi, count(*) filter (not ok) as n_outside from j group by {key}q25, q50, q75"""


@register("box_stats", _box("events", '"value"'))
def box_stats(spark, sf):
    return rounded(profile.box_stats(table(spark, sf, "events"), "value"))


@register("box_stats_by_group", _box("lineitem", "l_extendedprice", "l_returnflag"))
def box_stats_by_group(spark, sf):
    return rounded(profile.box_stats(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"]))


@register(
    "date_range",
    """select strftime(min(o_orderdate), '%Y-%m-%d') as first_day, strftime(max(o_orderdate), '%Y-%m-%d') as last_day,
    strftime(min(o_orderdate) filter (o_orderstatus = 'F'), '%Y-%m-%d') as first_filled from orders""",
)
def date_range(spark, sf):
    day, o = lambda c: F.date_format(c, "yyyy-MM-dd"), table(spark, sf, "orders")
    filled = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return o.agg(
        day(F.min("o_orderdate")).alias("first_day"), day(F.max("o_orderdate")).alias("last_day"), day(F.min(filled)).alias("first_filled")
    )


@register("drop_named_columns", "select c_nationkey, c_acctbal, c_mktsegment from customer")
def drop_named_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "customer"), ["c_custkey", "c_name", "not_there"])


@register("drop_by_regex", "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem")
def drop_by_regex(spark, sf):
    return clean.drop_columns(table(spark, sf, "lineitem"), ["l_shipdate"], "price|discount|tax|status|part|supp")


@register(
    "clip_to_bounds",
    """select s_suppkey, least(greatest(s_acctbal, (select min(c_acctbal) from customer)),
      (select max(c_acctbal) from customer)) as s_acctbal from supplier""",
)
def clip_to_bounds(spark, sf):
    bounds = profile.bounds_of(table(spark, sf, "customer"), ["c_acctbal"])["c_acctbal"]
    out = clean.clip_to(table(spark, sf, "supplier"), {"s_acctbal": bounds})
    return out.select("s_suppkey", "s_acctbal")


@register(
    "detect_categorical",
    """select "column" from (
      select 'p_type' as "column" union all
      select 'p_brand' where (select count(distinct p_brand) from part) < 26 union all
      select 'p_size' where (select count(distinct p_size) from part) < 26)""",
)
def detect_categorical(spark, sf):
    found = profile.distinct_counts(table(spark, sf, "part"), ["p_type", "p_brand", "p_size"])
    return found.filter(is_categorical(F.col("column"), F.col("n_distinct"), forced=("p_type",), below=26)).select("column")


@register("select_numeric", "select p_partkey, p_size, p_retailprice from part")
def select_numeric(spark, sf):
    part = table(spark, sf, "part")
    return part.select(*numeric_columns(part))


@register(
    "fold_summary",
    """with f as (select l_linenumber as fold, l_returnflag as model, avg(l_quantity) as score from lineitem group by 1, 2)
    select model, round(avg(score), 3) as mean, round(stddev_samp(score), 3) as std from f group by 1""",
)
def fold_summary(spark, sf):
    scores = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("fold"), F.col("l_returnflag").alias("model"))
    return profile.fold_summary(scores.agg(F.avg("l_quantity").alias("score")), ["model"], "score", 1, 3)


@register(
    "fold_summary_population",
    """with f as (select l_linenumber as fold, l_returnflag as model, avg(l_quantity) as score from lineitem group by 1, 2)
    select model, round(avg(score), 6) as mean, round(stddev_pop(score), 6) as std from f group by 1""",
)
def fold_summary_population(spark, sf):
    scores = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("fold"), F.col("l_returnflag").alias("model"))
    return profile.fold_summary(scores.agg(F.avg("l_quantity").alias("score")), ["model"], "score", 0, 6)
