"""Sources and scalar expressions, run over whole tables."""

from pyspark.sql import functions as F

from cloakwork.functions import scalar as s
from cloakwork.functions.hashing import unit_hash_sql
from cloakwork.operators import encode
from cloakwork.plans import presets
from cloakwork.plans.catalog import register
from cloakwork.plans.catalog.common import rounded
from cloakwork.sources import tables as src
from cloakwork.sources.sinks import cluster_lines
from cloakwork.sources.tables import table

# Text lines made from customer rows; some carry '?' or an empty field.
_LINE = """concat_ws(',', cast(c_custkey as varchar), c_name, cast(c_nationkey as varchar),
  case when c_custkey % 7 = 3 then '?' else ' ' || c_mktsegment || ' ' end,
  case when c_custkey % 11 = 5 then '' else c_mktsegment end)"""


def _customer_lines(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.concat_ws(
            ",",
            F.col("c_custkey").cast("string"),
            "c_name",
            F.col("c_nationkey").cast("string"),
            F.when(F.col("c_custkey") % 7 == 3, "?").otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))),
            F.when(F.col("c_custkey") % 11 == 5, "").otherwise(F.col("c_mktsegment")),
        ).alias("value")
    )


@register(
    "microdata_scan",
    """select cast(c_nationkey as double) as nation, c_name as name, c_mktsegment as segment from customer
    where c_custkey % 7 <> 3 and c_custkey % 11 <> 5""",
)
def microdata_scan(spark, sf):
    qi = {"nation": (2, "number"), "name": (1, "category")}
    return src.parse_microdata(_customer_lines(spark, sf), qi, ("segment", 4))


@register(
    "width_guard",
    """select c_custkey, c_mktsegment from customer where c_custkey % 11 <> 5""",
)
def width_guard(spark, sf):
    lines = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 11 == 5, F.col("c_custkey").cast("string"))
        .otherwise(F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"))
        .alias("value")
    )
    wide = src.wide_enough(lines, 3, ";")
    return wide.select(F.col("fields")[0].cast("bigint").alias("c_custkey"), F.col("fields")[2].alias("c_mktsegment"))


@register(
    "adjacency_edges",
    """select l_orderkey as src, l_partkey as dst, 0 as "position" from lineitem
    union all select l_orderkey, l_suppkey, 1 from lineitem where l_quantity > 10""",
)
def adjacency_edges(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(
            ",",
            F.col("l_orderkey").cast("string"),
            F.col("l_partkey").cast("string"),
            F.when(F.col("l_quantity") > 10, F.col("l_suppkey").cast("string")),
            F.lit(""),
        ).alias("value")
    )
    return src.parse_adjacency(lines)


@register("null_token", "select event_id, case when event_type <> 'error' then event_type end as event_type from events")
def null_token(spark, sf):
    marked = table(spark, sf, "events").select("event_id", F.regexp_replace("event_type", "^error$", "?").alias("event_type"))
    return marked.select("event_id", F.nullif("event_type", F.lit("?")).alias("event_type"))


@register("hash_sample", f"select o_orderkey, o_custkey, o_totalprice from orders where {unit_hash_sql('o_orderkey', 42)} < 0.2")
def hash_sample(spark, sf):
    return src.sample(table(spark, sf, "orders"), "o_orderkey", 0.2, 42).select("o_orderkey", "o_custkey", "o_totalprice")


@register(
    "coerce_numeric",
    """select c_custkey, try_cast(c_mktsegment as double) as segment_number, try_cast(right(c_name, 9) as double) as name_number,
    coalesce(try_cast(c_mktsegment as double), 0.0) as segment_or_zero from customer""",
)
def coerce_numeric(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        s.coerce_number("c_mktsegment").alias("segment_number"),
        s.coerce_number(F.right("c_name", F.lit(9))).alias("name_number"),
        s.number_or_zero("c_mktsegment").alias("segment_or_zero"),
    )


@register(
    "date_parts",
    """select o_orderkey, cast(month(o_orderdate) as bigint) as m, cast(year(o_orderdate) as bigint) as y,
    strftime(o_orderdate, '%Y-%m') as ym, cast(epoch(o_orderdate) as double) as seconds from orders""",
)
def date_parts(spark, sf):
    o = table(spark, sf, "orders")
    parsed = s.coerce_timestamp(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"), "dd/MM/yyyy HH:mm")
    return o.select(
        "o_orderkey",
        F.month(parsed).cast("bigint").alias("m"),
        F.year(parsed).cast("bigint").alias("y"),
        F.date_format(s.year_month(parsed), "yyyy-MM").alias("ym"),
        s.numeric_image("o_orderdate", "timestamp_ntz").alias("seconds"),
    )


@register(
    "digits_first",
    "select p_partkey, try_cast(nullif(regexp_extract(p_brand || 'a7', '(\\d+)', 1), '') as bigint) as digits from part",
)
def digits_first(spark, sf):
    return table(spark, sf, "part").select("p_partkey", s.first_digits(F.concat("p_brand", F.lit("a7"))).alias("digits"))


@register(
    "digits_all",
    """select p_partkey, coalesce(try_cast(nullif(regexp_replace(p_brand || 'a7', '\\D', '', 'g'), '') as bigint), 0) as digits,
    coalesce(try_cast(nullif(regexp_replace(p_name, '\\D', '', 'g'), '') as bigint), 0) as name_digits from part""",
)
def digits_all(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        s.all_digits(F.concat("p_brand", F.lit("a7"))).alias("digits"),
        s.all_digits("p_name").alias("name_digits"),
    )


@register(
    "log1p_shift",
    """select c_custkey, round(ln(1 + c_acctbal + (select case when min(c_acctbal) <= 0 then 1 - min(c_acctbal) else 0 end
    from customer)), 6) as log_balance from customer""",
)
def log1p_shift(spark, sf):
    c = table(spark, sf, "customer")
    lowest = c.agg(F.min("c_acctbal")).first()[0]
    return c.select("c_custkey", F.round(s.log1p_shifted("c_acctbal", lowest), 6).alias("log_balance"))


@register("half_even_round", "select l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) as half from lineitem")
def half_even_round(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", s.half_even(F.col("l_quantity") / 2).alias("half"))


@register("trim_text", "select c_custkey, c_mktsegment as segment from customer")
def trim_text(spark, sf):
    padded = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))
    return table(spark, sf, "customer").select("c_custkey", F.trim(padded).alias("segment"))


@register(
    "interval_format",
    """select p_type, p_brand,
      case when min(p_retailprice) = max(p_retailprice) then cast(cast(trunc(min(p_retailprice)) as bigint) as varchar)
        else cast(cast(trunc(min(p_retailprice)) as bigint) as varchar) || '~' || cast(cast(trunc(max(p_retailprice)) as bigint) as varchar) end as price,
      case when min(p_name) = max(p_name) then min(p_name) else min(p_name) || '~' || max(p_name) end as name
    from part group by 1, 2""",
)
def interval_format(spark, sf):
    g = table(spark, sf, "part").groupBy("p_type", "p_brand")
    box = g.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ["p_retailprice", "p_name"] for f in (F.min, F.max)])
    return box.select(
        "p_type",
        "p_brand",
        s.format_interval("min_p_retailprice", "max_p_retailprice").alias("price"),
        s.format_interval("min_p_name", "max_p_name", "text").alias("name"),
    )


@register(
    "interval_format_datetime",
    """select o_orderpriority, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') || '~' ||
    strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as days from orders group by 1""",
)
def interval_format_datetime(spark, sf):
    box = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return box.select("o_orderpriority", s.format_interval("a", "b", "datetime").alias("days"))


def _interval_text():
    lo, hi = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("string")
    third = F.concat(lo, F.lit("~x~"), hi)
    return (
        F.when(F.col("l_returnflag") == "A", F.concat(lo, F.lit("~"), hi))
        .when(F.col("l_linestatus") == "F", third)
        .when(F.col("l_quantity") > 40, F.concat(F.lit("a~"), hi))
        .when(F.col("l_quantity") > 2, hi)
    )


@register(
    "interval_split",
    """select l_orderkey, l_linenumber,
      case when l_returnflag = 'A' or l_linestatus = 'F' then cast(l_linenumber as double)
           when l_quantity > 40 then null when l_quantity > 2 then l_quantity end as v_min,
      case when l_returnflag = 'A' or l_linestatus = 'F' then l_quantity
           when l_quantity > 40 then null when l_quantity > 2 then l_quantity end as v_max from lineitem""",
)
def interval_split(spark, sf):
    lo, hi = s.interval_bounds(_interval_text())
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", lo.alias("v_min"), hi.alias("v_max"))


@register(
    "category_split",
    """select p_partkey, case when p_size > 45 then 'missing'
      when p_size > 20 then p_type || '|' || p_brand else p_type end as key,
      cast(case when p_size > 45 then 1 when p_size > 20 then 2 else 1 end as bigint) as n_labels from part""",
)
def category_split(spark, sf):
    text = F.when(F.col("p_size") > 45, F.lit(None)).when(
        F.col("p_size") > 20, F.concat("p_type", F.lit(" ~ "), "p_brand")
    ).otherwise(F.col("p_type"))
    out = table(spark, sf, "part").select("p_partkey", s.category_list(text).alias("labels"))
    return out.select("p_partkey", s.list_key("labels").alias("key"), F.size("labels").cast("bigint").alias("n_labels"))


@register(
    "decode_codes",
    """with d as (select p_type as v, row_number() over (order by min(p_partkey)) - 1 as code from part group by 1),
    b as (select p_brand, min(d.code) as lo, max(d.code) as hi from part join d on p_type = v group by 1)
    select p_brand, string_agg(v, '~' order by code) as types from b join d on code between lo and hi group by 1""",
)
def decode_codes(spark, sf):
    part = table(spark, sf, "part")
    codes = encode.fit_first_codes(part, ["p_type"], "p_partkey")
    box = codes.apply(part).groupBy("p_brand").agg(F.min("p_type").alias("lo"), F.max("p_type").alias("hi"))
    return codes.decode_spans(box, "p_type", "lo", "hi", "types").select("p_brand", "types")


@register(
    "number_or_code",
    """with t as (select p_partkey, case when p_size > 25 then cast(p_size as varchar) else p_type end as v from part),
    d as (select v, row_number() over (order by min(p_partkey)) - 1 as code from t where try_cast(v as double) is null group by 1)
    select p_partkey, coalesce(try_cast(t.v as double), cast(code as double)) as number from t left join d on t.v = d.v""",
)
def number_or_code(spark, sf):
    mixed = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(F.col("p_type")).alias("v")
    )
    codes = encode.fit_first_codes(mixed.filter(F.col("v").try_cast("double").isNull()), ["v"], "p_partkey")
    out = codes.apply(mixed.withColumn("raw", F.col("v")))
    return out.select("p_partkey", s.number_or_code("raw", F.col("v")).alias("number"))


@register(
    "numeric_aware_bounds",
    """select l_returnflag, cast(min(cast(l_quantity as bigint)) as varchar) as first_value,
    cast(max(cast(l_quantity as bigint)) as varchar) as last_value from lineitem group by 1""",
)
def numeric_aware_bounds(spark, sf):
    t = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("bigint").cast("string").alias("v"))
    return t.groupBy("l_returnflag").agg(
        F.min(s.numeric_aware_key("v"))["s"].alias("first_value"), F.max(s.numeric_aware_key("v"))["s"].alias("last_value")
    )


@register(
    "cluster_lines",
    """with b as (select c_mktsegment, min(c_nationkey) as lo, max(c_nationkey) as hi from customer group by 1)
    select (case when lo = hi then cast(lo as varchar) else '[' || lo || ' - ' || hi || ']' end) || ', ' ||
      (case when c.c_mktsegment = 'BUILDING' then '*' else c.c_mktsegment end) as value
    from customer c join b on c.c_mktsegment = b.c_mktsegment""",
)
def cluster_lines_query(spark, sf):
    c = table(spark, sf, "customer")
    box = c.groupBy("c_mktsegment").agg(F.min("c_nationkey").alias("c_nationkey_min"), F.max("c_nationkey").alias("c_nationkey_max"))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "all").otherwise(F.col("c_mktsegment"))
    members = c.select("c_mktsegment").join(box, "c_mktsegment").withColumn("c_mktsegment", segment)
    return cluster_lines(members, ["c_nationkey"], ["c_mktsegment"])


@register(
    "featurize_anonymized",
    """with b as (select l_shipdate, min(l_quantity) as lo, max(l_quantity) as hi, min(l_returnflag) as a, max(l_returnflag) as z
      from lineitem group by 1)
    select l_orderkey, l_linenumber, l_linestatus, trunc(lo) as qty_min, trunc(hi) as qty_max,
      case when a = z then a else a || '|' || z end as flag from lineitem join b using (l_shipdate)""",
)
def featurize_anonymized(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate", "l_quantity", "l_returnflag")
    box = t.groupBy("l_shipdate").agg(
        s.format_interval(F.min("l_quantity"), F.max("l_quantity")).alias("qty"),
        s.format_interval(F.min("l_returnflag"), F.max("l_returnflag"), "text").alias("flag"),
    )
    texts = t.drop("l_quantity", "l_returnflag").join(box, "l_shipdate").drop("l_shipdate")
    out, _ = presets.featurize_anonymized(texts, ["qty"], ["flag"], "l_linestatus")
    return out.withColumn("flag", s.list_key("flag"))


@register(
    "error_terms",
    """select l_orderkey, l_linenumber, round(abs(l_extendedprice - l_quantity * 1500), 4) as abs_error,
    round(sqrt(abs(l_extendedprice - l_quantity * 1500)), 4) as root from lineitem""",
)
def error_terms(spark, sf):
    e = F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1500)
    out = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", e.alias("abs_error"), F.sqrt(e).alias("root"))
    return rounded(out, 4, ["abs_error", "root"])
