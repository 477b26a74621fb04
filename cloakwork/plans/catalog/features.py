"""Feature transformers, presets and feature scores."""

from pyspark.sql import functions as F

from cloakwork.functions.scalar import format_interval
from cloakwork.operators import encode, select
from cloakwork.plans import presets
from cloakwork.plans.catalog import register
from cloakwork.plans.catalog.common import (
    LINE_NUM,
    ORDERS_WITH_EMPTY_MONTHS_SQL,
    orders_with_empty_months,
    rounded,
)
from cloakwork.sources.tables import table

LINE_KEY = ["l_orderkey", "l_linenumber"]


def _std(c, src, digits=6):
    return f"round(({c} - (select avg({c}) from {src})) / (select stddev_pop({c}) from {src}), {digits})"


def _rob(c, src, digits=6):
    return f"""round(({c} - (select median({c}) from {src})) /
    (select quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) from {src}), {digits})"""


@register(
    "standard_scale",
    "select l_orderkey, l_linenumber, " + ", ".join(f"{_std(c, 'lineitem')} as {c}" for c in LINE_NUM) + " from lineitem",
)
def standard_scale(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, *LINE_NUM)
    return rounded(encode.fit_standard(t, LINE_NUM).apply(t), 6)


@register(
    "robust_scale",
    "select l_orderkey, l_linenumber, " + ", ".join(f"{_rob(c, 'lineitem')} as {c}" for c in LINE_NUM) + " from lineitem",
)
def robust_scale(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, *LINE_NUM)
    return rounded(encode.fit_robust(t, LINE_NUM).apply(t), 6)


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_FLAGS = ["A", "N", "R"]


def _hot(c, values):
    return ", ".join(f"cast({c} = '{v}' as int) as \"{c}_{v}\"" for v in values)


@register("one_hot", f"select p_partkey, {_hot('p_type', _TYPES)} from part")
def one_hot(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", "p_type")
    return encode.fit_one_hot(t, ["p_type"]).apply(t)


@register(
    "one_hot_unknown",
    f"""with t as (select p_partkey, case when p_size > 40 then 'NEW' else p_type end as p_type from part)
    select p_partkey, {_hot('p_type', _TYPES)} from t""",
)
def one_hot_unknown(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    seen = t.withColumn("p_type", F.when(F.col("p_size") > 40, "NEW").otherwise(F.col("p_type"))).drop("p_size")
    return encode.fit_one_hot(t, ["p_type"]).apply(seen)


@register(
    "one_hot_if_binary",
    f"""select l_orderkey, l_linenumber, {_hot('l_returnflag', _FLAGS)}, cast(l_linestatus = 'O' as int) as "l_linestatus_O"
    from lineitem""",
)
def one_hot_if_binary(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag", "l_linestatus")
    return encode.fit_one_hot(t, ["l_returnflag", "l_linestatus"], drop_binary=True).apply(t)


_PRIO = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@register(
    "ordinal_encode",
    "select o_orderkey, cast(5 - cast(left(o_orderpriority, 1) as int) as double) as o_orderpriority from orders",
)
def ordinal_encode(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return encode.Ordinal({"o_orderpriority": _PRIO}).apply(t)


@register(
    "label_encode",
    """with d as (select v, row_number() over (order by v) - 1 as code from (select distinct p_brand as v from part))
    select p_partkey, code as p_brand from part join d on p_brand = v""",
)
def label_encode(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encode.fit_label_codes(t, ["p_brand"]).apply(t)


@register(
    "first_appearance_encode",
    """with d as (select p_brand as v, row_number() over (order by min(p_partkey)) - 1 as code from part group by 1)
    select p_partkey, code as p_brand from part join d on p_brand = v""",
)
def first_appearance_encode(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encode.fit_first_codes(t, ["p_brand"], "p_partkey").apply(t)


@register(
    "skewness",
    " union all ".join(
        f"select '{c}' as \"column\", round(skewness({c}), 6) as skewness from lineitem" for c in LINE_NUM
    ),
)
def skewness(spark, sf):
    return rounded(encode.skewness_table(table(spark, sf, "lineitem"), LINE_NUM).drop("lowest"), 6)


@register(
    "skew_log",
    """with t as (select event_id, "value", power("value", 3) as cubed from events),
    s as (select skewness("value") as a, skewness(cubed) as b, min(cubed) as lo, min("value") as lo1 from t)
    select event_id, "value", round(ln(1 + cubed + case when lo <= 0 then 1 - lo else 0 end), 6) as log_cubed from t, s""",
)
def skew_log(spark, sf):
    t = table(spark, sf, "events").select("event_id", "value", F.pow("value", F.lit(3.0)).alias("cubed"))
    return rounded(encode.fit_skew_log(t, ["value", "cubed"]).apply(t), 6, ["log_cubed"])


# --- presets on the stand-in tables ---------------------------------------------------


@register(
    "preset_personality",
    f"""with h as (select l_orderkey, l_linenumber, l_quantity, l_discount, {_hot('l_returnflag', _FLAGS)} from lineitem)
    select l_orderkey, l_linenumber, {', '.join(f'{_std(c, "h")} as "{c.strip(chr(34))}"' for c in
      ['l_quantity', 'l_discount', '"l_returnflag_A"', '"l_returnflag_N"', '"l_returnflag_R"'])} from h""",
)
def preset_personality(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_discount", "l_returnflag")
    _, out = presets.personality(("l_returnflag",), tuple(LINE_KEY)).fit(t)
    return rounded(out, 6)


@register(
    "preset_ozone",
    f"""with t as ({ORDERS_WITH_EMPTY_MONTHS_SQL}),
    a as (select o_orderkey, o_orderdate, coalesce(o_totalprice,
            avg(o_totalprice) over (partition by date_trunc('month', o_orderdate))) as p from t),
    b as (select o_orderkey, coalesce(p, avg(p) over (partition by month(o_orderdate))) as p from a)
    select o_orderkey, {_std('p', 'b', 5)} as o_totalprice from b""",
)
def preset_ozone(spark, sf):
    t = orders_with_empty_months(table(spark, sf, "orders"))
    _, out = presets.ozone("o_orderdate", ("o_orderkey",)).fit(t)
    return rounded(out.drop("o_orderdate"), 5)


@register(
    "preset_breast_cancer",
    f"select l_orderkey, l_linenumber, {_rob('l_quantity', 'lineitem')} as l_quantity, {_rob('l_discount', 'lineitem')} as l_discount from lineitem",
)
def preset_breast_cancer(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, "l_partkey", *LINE_NUM)
    _, out = presets.breast_cancer(tuple(LINE_KEY), drop=("l_partkey",), regex="price|tax").fit(t)
    return rounded(out, 6)


@register(
    "preset_loan",
    f"""with d as (select v, row_number() over (order by v) - 1 as code from (select distinct o_orderpriority as v from orders)),
    t as (select o_orderkey, o_orderstatus, o_totalprice, code as p from orders join d on o_orderpriority = v)
    select o_orderkey, o_orderstatus, {_std('o_totalprice', 't')} as o_totalprice, {_std('p', 't')} as o_orderpriority from t""",
)
def preset_loan(spark, sf):
    t = table(spark, sf, "orders")
    _, out = presets.loan(("o_orderkey", "o_orderstatus"), drop=("o_custkey", "o_orderdate")).fit(t)
    return rounded(out, 6)


@register(
    "preset_house_price",
    """select o_orderkey, o_totalprice, cast(5 - cast(left(o_orderpriority, 1) as int) as double) as o_orderpriority, """
    + _hot("o_orderstatus", ["F", "O", "P"])
    + " from orders",
)
def preset_house_price(spark, sf):
    t = table(spark, sf, "orders").drop("o_orderdate")
    steps = presets.house_price(("o_orderkey",), {"o_orderpriority": _PRIO}, ("o_custkey",))
    return steps.fit(t)[1]


@register(
    "preset_phone_addiction",
    f"""select p_partkey, p_size, p_retailprice, cast(regexp_extract(p_brand, '(\\d+)', 1) as bigint) as p_brand,
    {_hot('p_type', _TYPES)} from part""",
)
def preset_phone_addiction(spark, sf):
    steps = presets.phone_addiction(("p_partkey",), grade="p_brand", drop=("p_name",))
    return steps.fit(table(spark, sf, "part"))[1]


@register(
    "preset_car_price",
    f"""select l_orderkey, l_linenumber, l_quantity, l_extendedprice, {_hot('l_returnflag', _FLAGS)},
    cast(l_linestatus = 'O' as int) as "l_linestatus_O" from lineitem""",
)
def preset_car_price(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    return presets.car_price(tuple(LINE_KEY)).fit(t)[1]


@register(
    "preset_student_plain",
    f"""select l_orderkey, l_linenumber, {_std('l_quantity', 'lineitem')} as l_quantity,
    {_std('l_extendedprice', 'lineitem')} as l_extendedprice, {_hot('l_returnflag', _FLAGS)} from lineitem""",
)
def preset_student_plain(spark, sf):
    t = table(spark, sf, "lineitem").select(*LINE_KEY, "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    steps = presets.anonymizing(("l_returnflag",), tuple(LINE_KEY), drop=("l_suppkey",))
    return rounded(steps.fit(t)[1], 6)


@register(
    "preset_already_anonymized",
    f"""with b as (select p_brand, min(p_retailprice) as lo, max(p_retailprice) as hi from part group by 1),
    t as (select p_partkey, lo, hi, p_type from part join b using (p_brand))
    select p_partkey, {_std('lo', 't')} as price_min, {_std('hi', 't')} as price_max, {_hot('p_type', _TYPES)} from t""",
)
def preset_already_anonymized(spark, sf):
    part = table(spark, sf, "part")
    box = part.groupBy("p_brand").agg(F.min("p_retailprice").alias("price_min"), F.max("p_retailprice").alias("price_max"))
    t = part.select("p_partkey", "p_type", "p_brand").join(box, "p_brand").drop("p_brand")
    steps = presets.anonymizing(("p_type",), ("p_partkey",), already_anonymized=True)
    return rounded(steps.fit(t)[1], 6)


@register(
    "preset_global_features",
    f"""with b as (select p_brand, trunc(min(p_retailprice)) as lo, trunc(max(p_retailprice)) as hi from part group by 1),
    t as (select p_partkey, lo, hi, p_type from part join b using (p_brand))
    select p_partkey, {_std('lo', 't')} as price_min, {_std('hi', 't')} as price_max, {_hot('p_type', _TYPES)} from t""",
)
def preset_global_features(spark, sf):
    part = table(spark, sf, "part")
    box = part.groupBy("p_brand").agg(format_interval(F.min("p_retailprice"), F.max("p_retailprice")).alias("price"))
    texts = part.select("p_partkey", "p_type", "p_brand").join(box, "p_brand").drop("p_brand")
    df, info = presets.featurize_anonymized(texts, ["price"], ["p_type"], "p_partkey")
    return rounded(presets.anonymized_features(info, ("p_partkey",)).fit(df)[1], 6)


# --- feature scores -------------------------------------------------------------------

_ANOVA = """with x as ({src}), g as (select "column", label, count(*) as n, avg(v) as m, var_pop(v) as s from x group by 1, 2),
t as (select "column", avg(v) as grand, count(*) as n from x group by 1)
select "column", round((sum(g.n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum(g.n * s) / (any_value(t.n) - count(*))), 6) as f_value
from g join t using ("column") group by 1"""


@register(
    "anova_f",
    _ANOVA.format(
        src=" union all ".join(f"select '{c}' as \"column\", l_returnflag as label, {c} as v from lineitem" for c in LINE_NUM)
    ),
)
def anova_f(spark, sf):
    long = select.melt(table(spark, sf, "lineitem"), LINE_NUM, ["l_returnflag"])
    return rounded(select.anova_f(long, "l_returnflag"), 6)


@register(
    "select_k_best_f",
    "select * from ("
    + _ANOVA.format(
        src="""select cast(generate_subscripts(embedding, 1) - 1 as int) as "column", label, cast(unnest(embedding) as double) as v
        from embeddings"""
    )
    + ') order by f_value desc, "column" limit 30',
)
def select_k_best_f(spark, sf):
    long = select.explode_vector(table(spark, sf, "embeddings"), "embedding", ["label"])
    return select.best(rounded(select.anova_f(long, "label"), 6), "f_value", 30)


def _mi(c):
    cuts = " + ".join(
        f"(case when {c} >= (select quantile_cont({c}, {i / 10}) from lineitem) then 1 else 0 end)" for i in range(1, 10)
    )
    return f"select '{c}' as \"column\", l_returnflag as label, {cuts} as b from lineitem"


@register(
    "mutual_info_binned",
    f"""with x as ({' union all '.join(_mi(c) for c in ['l_extendedprice', 'l_quantity'])}),
    j as (select "column", label, b, count(*) as n from x group by 1, 2, 3),
    p as (select "column", n, sum(n) over (partition by "column") as nt, sum(n) over (partition by "column", b) as nb,
      sum(n) over (partition by "column", label) as nl from j)
    select "column", round(sum(n / nt * ln(n * nt / (nb * nl))), 8) as mutual_information from p group by 1""",
)
def mutual_info_binned(spark, sf):
    out = select.mutual_information(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], "l_returnflag")
    return rounded(out, 8)


_MI_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _digamma(x):
    y = f"({x} + 10.0)"
    steps = " - ".join(f"1.0 / ({x} + {i})" for i in range(10))
    return f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} * {y}) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6) - {steps})"


#: The third neighbour among sorted rows: the best of four windows of three steps; nearer rows by running counts.
_NEIGHBOUR_SQL = f"""with x as ({" union all ".join(f"select '{c}' as col, {c}::double as v, l_returnflag as cls from lineitem" for c in _MI_COLUMNS)}),
    l as (select col, cls, v, count(*) over (partition by col, cls) as size, lag(v, 1) over w as a1, lag(v, 2) over w as a2, lag(v, 3) over w as a3,
      lead(v, 1) over w as b1, lead(v, 2) over w as b2, lead(v, 3) over w as b3 from x window w as (partition by col, cls order by v)),
    d as (select col, cls, v, size, least(coalesce(v - a3, 'inf'::double), coalesce(greatest(v - a2, b1 - v), 'inf'::double),
      coalesce(greatest(v - a1, b2 - v), 'inf'::double), coalesce(b3 - v, 'inf'::double)) as d
      from (select col, cls, v, size, a1, a2, a3, b1, b2, b3 from l where size > 3)),
    c as (select col, v, n, sum(n) over (partition by col order by v) as le from (select col, v, count(*) as n from x group by 1, 2)),
    q as (select distinct col, v, d, case when d > 0 then v - d else v end as lo, case when d > 0 then v + d else v end as hi from d),
    lo as (select q.col, q.v, q.d, coalesce(c.le, 0) as le from q asof left join c on q.col = c.col and q.lo >= c.v),
    hi as (select q.col, q.v, q.d, coalesce(c.le, 0) as lt from q asof left join c on q.col = c.col and q.hi > c.v),
    m as (select d.col, d.size, case when d.d > 0 then hi.lt - lo.le else c.n end as m
      from d join lo using (col, v, d) join hi using (col, v, d) join c on c.col = d.col and c.v = d.v),
    s as (select col, count(*)::double as n, {_digamma("3.0")} - avg({_digamma("size")}) - avg({_digamma("m")}) as own from m group by 1),
    i as (select col as "column", round(greatest(0, {_digamma("n")} + own), 8) as mutual_information from s)"""


@register("mutual_info_neighbours", f"{_NEIGHBOUR_SQL} select * from i")
def mutual_info_neighbours(spark, sf):
    return rounded(select.neighbour_information(table(spark, sf, "lineitem"), _MI_COLUMNS, "l_returnflag"), 8)


@register(
    "select_k_best_mi",
    f"""{_NEIGHBOUR_SQL}, k as (select "column" from i order by mutual_information desc, "column" limit 2)
    select l_orderkey, l_linenumber, {", ".join(f"case when '{c}' in (select * from k) then {c} end as {c}" for c in _MI_COLUMNS)} from lineitem""",
)
def select_k_best_mi(spark, sf):
    """Rows with the two columns that tell most about the return flag; the others are null."""
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *_MI_COLUMNS)
    kept, names = select.select_best(t, _MI_COLUMNS, "l_returnflag", 2)
    gone = {c: F.lit(None).cast("double") for c in _MI_COLUMNS if c not in names}
    return kept.withColumns(gone).select("l_orderkey", "l_linenumber", *_MI_COLUMNS)
