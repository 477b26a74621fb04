"""k-anonymity: class reports, recoding, hierarchies, costs, clusters."""

from pyspark.sql import functions as F

from cloakwork.operators import clusters, cost, hierarchy, mondrian
from cloakwork.operators.profile import bounds_of
from cloakwork.functions.hashing import unit_hash_sql
from cloakwork.plans.anonymize import global_anonymize, run_summary
from cloakwork.plans.catalog import register
from cloakwork.plans.catalog.common import rounded
from cloakwork.plans.prepare import Recipe, prepare
from cloakwork.roles import AnonSpec
from cloakwork.sources.tables import parse_microdata, table

CUSTOMER = AnonSpec(
    qi=("c_nationkey", "c_acctbal"), sa="c_mktsegment", identifiers=("c_custkey", "c_name"), k=5
)
LINE_QI = ["l_quantity", "l_discount", "l_tax"]


def _banded(spark, sf):
    return table(spark, sf, "customer").withColumn("band", F.floor(F.col("c_acctbal") / 1000))


@register(
    "role_projection", "select c_nationkey, c_acctbal, c_mktsegment from customer"
)
def role_projection(spark, sf):
    return CUSTOMER.project(table(spark, sf, "customer"))


@register(
    "k_anonymity_report",
    """with g as (select c_nationkey, cast(floor(c_acctbal / 1000) as bigint) as band, count(*) as n from customer group by 1, 2)
    select count(*) as n_groups, min(n) as smallest, count(*) filter (n < 5) as violating_groups,
      cast(coalesce(sum(n) filter (n < 5), 0) as bigint) as violating_rows, cast(sum(n * n) as bigint) as discernibility from g""",
)
def k_anonymity_report(spark, sf):
    return mondrian.anonymity_report(_banded(spark, sf), ["c_nationkey", "band"], 5)


@register(
    "k_anonymity_sizes",
    """select c_nationkey, cast(floor(c_acctbal / 1000) as bigint) as band, count(*) as n, count(*) < 5 as violates
    from customer group by 1, 2""",
)
def k_anonymity_sizes(spark, sf):
    sizes = _banded(spark, sf).groupBy("c_nationkey", "band").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("violates", F.col("n") < 5)


def _band_classes(spark, sf):
    c = _banded(spark, sf)
    box = [f(c).alias(f"{c}_{n}") for c in CUSTOMER.qi for n, f in (("min", F.min), ("max", F.max))]
    classes = c.groupBy(F.concat_ws("/", F.floor(F.col("c_nationkey") / 5), "band").alias("ec_id")).agg(F.count(F.lit(1)).alias("n"), *box)
    ranges = {k: hi - lo for k, (lo, hi) in bounds_of(c, list(CUSTOMER.qi)).items()}
    return classes, ranges


_BANDS = """c as (select count(*) as n, (cast(floor(c_nationkey / 5) as bigint) || '/' || cast(floor(c_acctbal / 1000) as bigint)) as ec_id,
  min(c_nationkey) as a0, max(c_nationkey) as a1, min(c_acctbal) as b0, max(c_acctbal) as b1 from customer group by 2),
r as (select max(c_nationkey) - min(c_nationkey) as ra, max(c_acctbal) - min(c_acctbal) as rb from customer),
w as (select ec_id, n, case when a1 - a0 = ra then 1 else (a1 - a0) / ra end as wa,
  case when b1 - b0 = rb then 1 else (b1 - b0) / rb end as wb from c, r)"""


@register(
    "ncp_fixed_bands",
    f"""with {_BANDS} select round(100.0 * sum((wa + wb) * n) / (2 * sum(n)), 6)::double as ncp_percent,
    cast(sum(n * n) as bigint) as discernibility, count(*) as n_classes, cast(sum(n) as bigint) as n_records from w""",
)
def ncp_fixed_bands(spark, sf):
    classes, ranges = _band_classes(spark, sf)
    return rounded(mondrian.ncp_percent(classes, list(CUSTOMER.qi), ranges), 6)


@register(
    "class_widths",
    f"""with {_BANDS} select ec_id, 0 as dim, 'c_nationkey' as "column", round(wa, 6)::double as width from w
    union all select ec_id, 1, 'c_acctbal', round(wb, 6) from w""",
)
def class_widths(spark, sf):
    classes, ranges = _band_classes(spark, sf)
    return rounded(mondrian.widths(classes, list(CUSTOMER.qi), ranges), 6)


@register(
    "widest_dimension",
    f"""with {_BANDS} select ec_id, case when wa >= wb then 0 else 1 end as dim, round(greatest(wa, wb), 6)::double as width from w""",
)
def widest_dimension(spark, sf):
    classes, ranges = _band_classes(spark, sf)
    long = mondrian.widths(classes, list(CUSTOMER.qi), ranges)
    best = long.groupBy("ec_id").agg(F.max_by(F.struct("dim", "width"), F.struct("width", -F.col("dim"))).alias("b"))
    return rounded(best.select("ec_id", "b.*"), 6)


@register(
    "frequency_set",
    " union all ".join(
        f"select l_returnflag, {j} as dim, {c} as value, count(*) as n from lineitem group by 1, 3" for j, c in enumerate(LINE_QI)
    ),
)
def frequency_set(spark, sf):
    return mondrian.frequency_set(table(spark, sf, "lineitem"), ["l_returnflag"], LINE_QI)


@register(
    "cumulative_to_median",
    "with f as ("
    + " union all ".join(
        f"select l_returnflag, {j} as dim, {c} as value, count(*) as n from lineitem group by 1, 3" for j, c in enumerate(LINE_QI)
    )
    + """), r as (select *, cast(sum(n) over w as bigint) as cumulative, lead(value) over w as next_value,
      cast(sum(n) over (partition by l_returnflag, dim) // 2 as bigint) as middle
      from f window w as (partition by l_returnflag, dim order by value))
    select * from r where cumulative - n < middle""",
)
def cumulative_to_median(spark, sf):
    freq = mondrian.frequency_set(table(spark, sf, "lineitem"), ["l_returnflag"], LINE_QI)
    return mondrian.cumulative_to_median(freq, ["l_returnflag", "dim"])


_FIRST = " union all ".join(
    f"""select {j} as dim, '{c}' as "column", value, n, sum(n) over (order by value) as cum, lead(value) over (order by value) as nxt,
    sum(n) over () as total from (select {c} as value, count(*) as n from lineitem group by 1)"""
    for j, c in enumerate(LINE_QI)
)


@register(
    "mondrian_first_split",
    f"""with f as ({_FIRST}), s as (select dim, "column", 1.0::double as width, value as split_value, nxt as next_value,
      cast(cum as bigint) as n_left, cast(total - cum as bigint) as n_right,
      nxt is not null and total // 2 >= 5 and cum >= 5 and total - cum >= 5 as feasible
      from f where cum >= total // 2 and cum - n < total // 2)
    select *, feasible and row_number() over (order by feasible desc, width desc, dim) = 1 as chosen from s""",
)
def mondrian_first_split(spark, sf):
    return mondrian.first_splits(table(spark, sf, "lineitem"), LINE_QI, 5)


def _recursive_splits(source: str, q0: str, q1: str, k: int, strict: bool) -> str:
    """Row-wise recursion over two columns: every step splits all open classes by one median."""
    side = "{v} <= s{i}" if strict else "r{i} <= half"
    stage = []
    for i, v in ((0, "v0"), (1, "v1")):
        left = side.format(v=v, i=i)
        stage.append(
            f"""count(*) filter ({left}) over c as n{i}, min({v}) filter (not ({left})) over c as x{i}, {left} as left{i}"""
        )
    fits = (
        "half >= {k} and x{i} is not null and n{i} >= {k} and n - n{i} >= {k}" if strict else "half >= {k} and lo{i} < hi{i}"
    )
    ok = [fits.format(i=i, k=k) for i in (0, 1)]
    lows = lambda i: f"case when left{i} then lo{i} else x{i} end"
    highs = lambda i: f"case when left{i} then s{i} else hi{i} end"
    # v0 is the wider column, v1 the other one; f says which of the two that is
    chosen = {
        "a0": f"case when ok0 then {lows(0)} when ok1 then lo0 end",
        "b0": f"case when ok0 then {highs(0)} when ok1 then hi0 end",
        "a1": f"case when ok0 then w1a when ok1 then {lows(1)} end",
        "b1": f"case when ok0 then w1b when ok1 then {highs(1)} end",
    }
    return f"""
with recursive base as (select cast({q0} as double) as q0, cast({q1} as double) as q1 from {source}),
rng as (select max(q0) - min(q0) as r0, max(q1) - min(q1) as r1, min(q0) as l0, max(q0) as h0, min(q1) as l1, max(q1) as h1 from base),
t as (
  select q0, q1, 'r' as ec, l0, h0, l1, h1, r0, r1, false as done from base, rng
  union all
  select q0, q1, case when ok0 then ec || case when left0 then '0' else '1' end when ok1 then ec || case when left1 then '0' else '1' end else ec end,
    case when f = 0 then a0 else a1 end, case when f = 0 then b0 else b1 end,
    case when f = 0 then a1 else a0 end, case when f = 0 then b1 else b0 end, r0, r1, not (ok0 or ok1)
  from (select *, {', '.join(f'{e} as {c}' for c, e in chosen.items())} from (
    select *, {ok[0]} as ok0, {ok[1]} as ok1 from (
      select *, {', '.join(stage)} from (
        select *, max(v0) filter (r0_ = half) over c as s0, max(v1) filter (r1_ = half) over c as s1, r0_ as r0x, r1_ as r1x,
          min(v0) over c as lo0, max(v0) over c as hi0, min(v1) over c as lo1, max(v1) over c as hi1 from (
          select *, row_number() over (partition by ec order by v0, q0, q1) as r0_, row_number() over (partition by ec order by v1, q0, q1) as r1_ from (
            select *, case when f = 0 then q0 else q1 end as v0, case when f = 0 then q1 else q0 end as v1,
              case when f = 0 then l1 else l0 end as w1a, case when f = 0 then h1 else h0 end as w1b from (
              select *, count(*) over (partition by ec) as n, count(*) over (partition by ec) // 2 as half,
                case when (case when h1 - l1 = r1 then 1.0 else (h1 - l1) / r1 end) > (case when h0 - l0 = r0 then 1.0 else (h0 - l0) / r0 end) then 1 else 0 end as f
              from t where not done)))
        window c as (partition by ec))
      window c as (partition by ec)))))
select ec as ec_id, count(*) as n, min(q0) as {q0}_min, max(q0) as {q0}_max, min(q1) as {q1}_min, max(q1) as {q1}_max
from t where done group by ec
""".replace("r0 <= half", "r0x <= half").replace("r1 <= half", "r1x <= half")


@register("mondrian_strict", _recursive_splits("customer", "c_nationkey", "c_acctbal", 5, True))
def mondrian_strict(spark, sf):
    return mondrian.mondrian(table(spark, sf, "customer"), list(CUSTOMER.qi), 5).table()


@register("mondrian_relaxed", _recursive_splits("customer", "c_nationkey", "c_acctbal", 5, False))
def mondrian_relaxed(spark, sf):
    return mondrian.mondrian(table(spark, sf, "customer"), list(CUSTOMER.qi), 5, strict=False).table()


@register("mondrian_strict_lineitem")
def mondrian_strict_lineitem(spark, sf):
    return mondrian.mondrian(table(spark, sf, "lineitem"), [*LINE_QI, "l_extendedprice"], 10).table()


_STRICT = _recursive_splits("customer", "c_nationkey", "c_acctbal", 5, True)


@register("mondrian_class_sizes", f"select n as size, count(*) as classes from ({_STRICT}) group by 1")
def mondrian_class_sizes(spark, sf):
    """How many classes have how many rows, every row labelled."""
    c = table(spark, sf, "customer")
    labelled = mondrian.mondrian(c, list(CUSTOMER.qi), 5).label(c, "c_custkey")
    sizes = labelled.groupBy("ec_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("classes"))


def _whole(lo, hi):
    """The text of a range in whole numbers."""
    one = lambda v: f"cast(cast(trunc({v}) as bigint) as varchar)"
    return f"case when {lo} = {hi} then {one(lo)} else {one(lo)} || '~' || {one(hi)} end"


@register(
    "global_anonymize",
    f"""select {_whole("c_nationkey_min", "c_nationkey_max")} as c_nationkey, {_whole("c_acctbal_min", "c_acctbal_max")} as c_acctbal, c_mktsegment
    from customer join ({_STRICT}) on c_nationkey between c_nationkey_min and c_nationkey_max and c_acctbal between c_acctbal_min and c_acctbal_max""",
)
def global_anonymize_query(spark, sf):
    """Rows of the anonymized customer table: generalized texts, then the sensitive attribute."""
    return global_anonymize(table(spark, sf, "customer"), CUSTOMER, "c_custkey").rows


_CODED_PART = """(select p_partkey, p_retailprice, t.code as p_type, p_size from part
  join (select p_type as v, row_number() over (order by min(p_partkey)) - 1 as code from part group by 1) as t on v = p_type)"""


@register(
    "global_anonymize_categorical",
    f"""with t as (select p_type as v, row_number() over (order by min(p_partkey)) - 1 as code from part group by 1),
    k as ({_recursive_splits(_CODED_PART, "p_type", "p_size", 10, True)}),
    s as (select k.ec_id, string_agg(v, '~' order by code) as types from k join t on code between p_type_min and p_type_max group by 1)
    select s.types as p_type, {_whole("p_size_min", "p_size_max")} as p_size, p_retailprice
    from {_CODED_PART} as p join k on p.p_type between p_type_min and p_type_max and p.p_size between p_size_min and p_size_max join s using (ec_id)""",
)
def global_anonymize_categorical(spark, sf):
    spec = AnonSpec(qi=("p_type", "p_size"), sa="p_retailprice", categorical=("p_type",), k=10)
    return global_anonymize(table(spark, sf, "part"), spec, "p_partkey").rows


@register(
    "global_anonymize_summary",
    f"""with r as (select (max(c_nationkey) - min(c_nationkey))::double as rn, max(c_acctbal) - min(c_acctbal) as ra from customer)
    select 'customer' as dataset, round(100 * sum(n * ((c_nationkey_max - c_nationkey_min) / rn + (c_acctbal_max - c_acctbal_min) / ra)) / (2 * sum(n)), 6) as ncp_percent,
      count(*) as n_classes, cast(sum(n) as bigint) as n_records, 2 as n_qi, 'c_mktsegment' as sa, 5 as k from ({_STRICT}), r""",
)
def global_anonymize_summary(spark, sf):
    result = global_anonymize(table(spark, sf, "customer"), CUSTOMER, "c_custkey")
    return rounded(run_summary([("customer", result, CUSTOMER)], spark).drop("seconds"), 6)


# --- preparing microdata --------------------------------------------------------------


def _first_codes(src, col, key):
    return f"(select {col} as v, row_number() over (order by min({key})) - 1 as code from {src} group by 1)"


_FIFTH = f"(select * from part where {unit_hash_sql('p_partkey', 42)} < 0.2)"


@register(
    "prepare_sampled",
    f"select p_partkey, code as p_type, p_size::double as p_size, p_retailprice, p_brand from {_FIFTH} join {_first_codes(_FIFTH, 'p_type', 'p_partkey')} on v = p_type",
)
def prepare_sampled(spark, sf):
    """A sample of rows; the listed categories are coded."""
    recipe = Recipe("p_brand", ("p_name",), ("p_type",), share=0.2)
    return prepare(table(spark, sf, "part"), recipe, "p_partkey").rows


_NOISY = "select c_custkey, c_nationkey, case when c_custkey % 5 = 0 then 'x' || c_custkey else cast(c_acctbal as varchar) end as balance, c_mktsegment from customer"


def _noisy(spark, sf):
    c = table(spark, sf, "customer")
    balance = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_acctbal").cast("string"))
    return c.select("c_custkey", "c_nationkey", balance.alias("balance"), "c_mktsegment")


@register("prepare_zeroed", f"select c_custkey, c_nationkey::double as c_nationkey, coalesce(try_cast(balance as double), 0) as balance, c_mktsegment from ({_NOISY})")
def prepare_zeroed(spark, sf):
    """All columns are numbers; what is none counts 0."""
    return prepare(_noisy(spark, sf), Recipe("c_mktsegment", zero=True), "c_custkey").rows


@register(
    "prepare_detected",
    f"""select o_orderkey, code as o_orderstatus, o_totalprice, o_orderpriority from orders
    join {_first_codes("orders", "o_orderstatus", "o_orderkey")} on v = o_orderstatus""",
)
def prepare_detected(spark, sf):
    """Columns of fewer than ten values are coded."""
    recipe = Recipe("o_orderpriority", ("o_custkey", "o_orderdate"), exempt=("o_totalprice",), few=10)
    return prepare(table(spark, sf, "orders"), recipe, "o_orderkey").rows


@register(
    "prepare_texts",
    f"""with h as (select * from customer where {unit_hash_sql('c_custkey', 42)} < 0.05)
    select c_custkey, code as c_name, c_nationkey::double as c_nationkey, c_acctbal, c_mktsegment from h join {_first_codes("h", "c_name", "c_custkey")} on v = c_name""",
)
def prepare_texts(spark, sf):
    """All text columns are coded."""
    return prepare(table(spark, sf, "customer"), Recipe("c_mktsegment", texts=True, share=0.05), "c_custkey").rows


@register(
    "prepare_mixed",
    f"""with n as ({_NOISY}), d as (select balance as v, row_number() over (order by min(c_custkey)) - 1 as code from n where try_cast(balance as double) is null group by 1)
    select c_custkey, c_nationkey::double as c_nationkey, coalesce(try_cast(balance as double), code::double) as balance, c_mktsegment from n left join d on v = balance""",
)
def prepare_mixed(spark, sf):
    """Numbers stay, other texts of the same column get codes."""
    return prepare(_noisy(spark, sf), Recipe("c_mktsegment"), "c_custkey").rows


@register(
    "microdata_codes",
    """select 'segment' as "column", row_number() over (order by min(c_custkey)) - 1 as code, c_mktsegment as value from customer where c_custkey % 7 <> 3 group by 3
    union all select 'name', row_number() over (order by min(c_custkey)) - 1, c_name from customer where c_custkey % 7 <> 3 group by 3""",
)
def microdata_codes(spark, sf):
    """The code lists that a scan of delimited lines leaves; lines with an empty field are skipped."""
    c = table(spark, sf, "customer")
    name = F.when(F.col("c_custkey") % 7 == 3, "").otherwise(F.col("c_name"))
    lines = c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), name, "c_mktsegment", F.col("c_nationkey").cast("string")).alias("value"))
    rows = parse_microdata(lines, {"id": (0, "number"), "name": (1, "category"), "segment": (2, "category")}, ("nation", 3))
    return prepare(rows, Recipe("nation", categorical=("name", "segment")), "id").code_table()


# --- category trees -------------------------------------------------------------------


def _nation_tree(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    leaf = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_name").alias("value"), F.col("r_name").alias("parent"), F.lit(2).alias("level"), F.col("n_name").alias("name")
    )
    mid = r.select(F.col("r_name").alias("value"), F.lit("all").alias("parent"), F.lit(1).alias("level"), F.col("r_name").alias("name"))
    root = r.agg(F.min(F.lit("all")).alias("value")).select(
        "value", F.col("value").alias("parent"), F.lit(0).alias("level"), F.lit("*").alias("name")
    )
    return hierarchy.checked(leaf.unionByName(mid).unionByName(root))


_TREE = """t as (select n_name as value, r_name as parent, 2 as level from nation join region on n_regionkey = r_regionkey
  union all select r_name, 'all', 1 from region union all select 'all', 'all', 0),
closed as (select value, value as ancestor, level from t
  union all select value, parent, level - 1 from t where level >= 1
  union all select n_name, 'all', 0 from nation)"""


@register("hierarchy_closure", f"with {_TREE} select * from closed")
def hierarchy_closure(spark, sf):
    return hierarchy.closure(_nation_tree(spark, sf))


@register(
    "flat_hierarchy",
    """select distinct c_mktsegment as value, '*' as parent, 1 as level, c_mktsegment as name from customer
    union all select '*', '*', 0, '*'""",
)
def flat_hierarchy(spark, sf):
    return hierarchy.flat_hierarchy(table(spark, sf, "customer"), "c_mktsegment")


_GROUPS = """g as (select c_mktsegment || '/' || cast(floor(c_acctbal / 50) as bigint) as grp, n_name as v from customer join nation on c_nationkey = n_nationkey),
cov as (select grp, ancestor, level, count(*) as covered from g join closed on v = value group by 1, 2, 3),
full_cov as (select cov.* from cov join (select grp, count(*) as n from g group by 1) s on cov.grp = s.grp and covered = n)"""


def _nation_groups(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    grp = F.concat_ws("/", "c_mktsegment", F.floor(F.col("c_acctbal") / 50))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(grp.alias("grp"), "n_name")


@register(
    "group_lca",
    f"""with {_TREE}, {_GROUPS} select grp, arg_max(ancestor, level) as lca, max(level) as lca_level, max(covered) as n
    from full_cov group by 1""",
)
def group_lca(spark, sf):
    return hierarchy.group_lca(_nation_groups(spark, sf), ["grp"], "n_name", hierarchy.closure(_nation_tree(spark, sf)))


@register(
    "lca_cost",
    f"""with {_TREE}, {_GROUPS}, l as (select grp, max(level) as level from full_cov group by 1)
    select grp, round((2.0 - level) / 2.0, 6)::double as cost from l""",
)
def lca_cost(spark, sf):
    lca = hierarchy.group_lca(_nation_groups(spark, sf), ["grp"], "n_name", hierarchy.closure(_nation_tree(spark, sf)))
    return rounded(lca.select("grp", cost.tree_cost(F.col("lca_level"), 2).alias("cost")), 6)


# --- costs and clusters ---------------------------------------------------------------


@register(
    "range_cost",
    """with b as (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer)
    select c_nationkey, round((max(c_acctbal) - min(c_acctbal)) / any_value(hi - lo), 6) as cost from customer, b group by 1""",
)
def range_cost(spark, sf):
    c = table(spark, sf, "customer")
    lo, hi = bounds_of(c, ["c_acctbal"])["c_acctbal"]
    box = c.groupBy("c_nationkey").agg(F.min("c_acctbal").alias("a"), F.max("c_acctbal").alias("z"))
    return rounded(box.select("c_nationkey", cost.range_cost(F.col("a"), F.col("z"), lo, hi, check=True).alias("cost")), 6)


_CLUSTERS = """k as (select lpad(cast(c_nationkey as varchar), 3, '0') as cluster_id, min(c_acctbal) as b0, max(c_acctbal) as b1,
  min(c_custkey) as k0, max(c_custkey) as k1,
  case when min(c_mktsegment) = max(c_mktsegment) then min(c_mktsegment) else '*' end as seg, count(*) as n
  from customer group by c_nationkey, c_mktsegment, floor(c_acctbal / 2000))"""


def _fixed_clusters(spark, sf):
    """Boxes of fixed groups of customers, to assign rows to."""
    c = table(spark, sf, "customer").withColumn(
        "cluster_id",
        F.concat_ws("/", F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.floor(F.col("c_acctbal") / 2000), F.col("c_custkey") % 3),
    )
    numeric, categorical = ["c_acctbal", "c_custkey"], ["c_mktsegment"]
    boxes = clusters.cluster_boxes(c, "cluster_id", numeric, categorical)
    members = c.select("c_custkey", "cluster_id")
    bounds = bounds_of(c, numeric)
    weights = {"c_acctbal": 1.0, "c_custkey": 0.5, "c_mktsegment": 0.25}
    return clusters.Clusters("c_custkey", tuple(numeric), tuple(categorical), bounds, weights, members, boxes)


_FIXED = """k as (select lpad(cast(c_nationkey as varchar), 3, '0') || '/' || cast(floor(c_acctbal / 2000) as bigint) || '/' || (c_custkey % 3) as cluster_id,
  min(c_acctbal) as b0, max(c_acctbal) as b1, min(c_custkey) as k0, max(c_custkey) as k1,
  case when min(c_mktsegment) = max(c_mktsegment) then min(c_mktsegment) else '*' end as seg, count(*) as n from customer group by 1),
r as (select max(c_acctbal) - min(c_acctbal) as rb, max(c_custkey) - min(c_custkey) as rk from customer)"""


@register(
    "cluster_state",
    f"""with {_FIXED} select cluster_id, b0 as "c_acctbal_min", b1 as "c_acctbal_max", k0 as "c_custkey_min",
    k1 as "c_custkey_max", seg as c_mktsegment, n from k""",
)
def cluster_state(spark, sf):
    ends = ["c_acctbal_min", "c_acctbal_max", "c_custkey_min", "c_custkey_max"]
    return _fixed_clusters(spark, sf).boxes.select("cluster_id", *ends, "c_mktsegment", "n")


@register(
    "gil_cost",
    f"""with {_FIXED}, j as (select c.c_custkey, k.*, c.c_acctbal as a, c.c_mktsegment as s, rb, rk from customer c
      join k on cluster_id = lpad(cast((c_nationkey + 1) % 25 as varchar), 3, '0') || '/' || cast(floor(c_acctbal / 2000) as bigint) || '/' || (c_custkey % 3), r)
    select c_custkey, cluster_id, round((greatest(b1, a) - least(b0, a)) / rb + 0.5 * (greatest(k1, c_custkey) - least(k0, c_custkey)) / rk
      + 0.25 * case when s = seg then 0.5 else 1.0 end, 6) as loss from j""",
)
def gil_cost(spark, sf):
    fixed = _fixed_clusters(spark, sf)
    other = F.concat_ws(
        "/",
        F.lpad(((F.col("c_nationkey") + 1) % 25).cast("string"), 3, "0"),
        F.floor(F.col("c_acctbal") / 2000),
        F.col("c_custkey") % 3,
    )
    rows = table(spark, sf, "customer").withColumn("cluster_id", other)
    boxes = fixed.boxes.withColumnRenamed("c_mktsegment", "seg")
    costs = {c: cost.expanded_cost(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max"), *fixed.bounds[c]) for c in fixed.numeric}
    costs["c_mktsegment"] = cost.flat_cost(F.col("c_mktsegment"), F.col("seg"))
    loss = cost.node_cost(cost.information_loss(costs, fixed.weights))
    return rounded(rows.join(boxes, "cluster_id").select("c_custkey", "cluster_id", loss.alias("loss")), 6)


@register(
    "gil_weight_vectors",
    """with b as (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer)
    select c_custkey, round((c_acctbal - lo) / (hi - lo) * (1 / 6::double) + 0.5 * (1 / 6::double), 6) as equal,
      round((c_acctbal - lo) / (hi - lo) * 0.02 + 0.5 * 0.9, 6) as emph_race,
      round((c_acctbal - lo) / (hi - lo) * 0.9 + 0.5 * 0.02, 6) as emph_age from customer, b""",
)
def gil_weight_vectors(spark, sf):
    """Loss of stretching from the lowest balance, with the balance as age and the segment as race."""
    c = table(spark, sf, "customer")
    lo, hi = bounds_of(c, ["c_acctbal"])["c_acctbal"]
    costs = {
        "age": cost.range_cost(F.lit(lo), F.col("c_acctbal"), lo, hi),
        "race": cost.flat_cost(F.col("c_mktsegment"), F.col("c_mktsegment")),
    }
    return rounded(
        c.select("c_custkey", *[cost.information_loss(costs, w).alias(n) for n, w in cost.WEIGHT_VECTORS.items()]), 6
    )


@register(
    "sangreea_assign",
    f"""with {_FIXED}, x as (select c.c_custkey, cluster_id, (greatest(b1, c_acctbal) - least(b0, c_acctbal)) / rb
      + 0.5 * (greatest(k1, c_custkey) - least(k0, c_custkey)) / rk + 0.25 * case when c_mktsegment = seg then 0.5 else 1.0 end as cost
      from customer c, k, r)
    select c_custkey, arg_min(cluster_id, round(cost, 9)) as cluster_id, round(min(cost), 6) as cost from x group by 1""",
)
def sangreea_assign(spark, sf):
    return rounded(_fixed_clusters(spark, sf).assign(table(spark, sf, "customer")), 6)


@register(
    "sangreea_publish",
    f"""with {_FIXED}, m as (select c_custkey, c_name, c_nationkey, lpad(cast(c_nationkey as varchar), 3, '0') || '/' ||
      cast(floor(c_acctbal / 2000) as bigint) || '/' || (c_custkey % 3) as cluster_id from customer)
    select c_name, c_nationkey, m.cluster_id, b0 as "c_acctbal_min", b1 as "c_acctbal_max", seg as c_mktsegment
    from m join k using (cluster_id)""",
)
def sangreea_publish(spark, sf):
    fixed = _fixed_clusters(spark, sf)
    one = clusters.Clusters("c_custkey", ("c_acctbal",), fixed.categorical, fixed.bounds, fixed.weights, fixed.members, fixed.boxes)
    out = one.publish(table(spark, sf, "customer"))
    return out.select("c_name", "c_nationkey", "cluster_id", "c_acctbal_min", "c_acctbal_max", "c_mktsegment")


@register(
    "publish_unassigned_raw",
    """select c_custkey, case when c_custkey % 4 = 0 then c_acctbal end as c_acctbal,
      case when c_custkey % 4 <> 0 then min(c_acctbal) filter (c_custkey % 4 <> 0) over (partition by c_nationkey) end as "c_acctbal_min",
      case when c_custkey % 4 <> 0 then max(c_acctbal) filter (c_custkey % 4 <> 0) over (partition by c_nationkey) end as "c_acctbal_max"
    from customer""",
)
def publish_unassigned_raw(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    known = c.filter(F.col("c_custkey") % 4 != 0).withColumn("cluster_id", F.col("c_nationkey").cast("string"))
    boxes = clusters.cluster_boxes(known, "cluster_id", ["c_acctbal"], [])
    fixed = clusters.Clusters(
        "c_custkey", ("c_acctbal",), (), bounds_of(c, ["c_acctbal"]), {}, known.select("c_custkey", "cluster_id"), boxes
    )
    return fixed.publish(c, keep_raw=True).select("c_custkey", "c_acctbal", "c_acctbal_min", "c_acctbal_max")


@register(
    "microaggregate_groups",
    """with s as (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2),
    m as (select c_nationkey, c_mktsegment as mode from s qualify row_number() over (partition by c_nationkey order by n desc, c_mktsegment) = 1)
    select c_custkey, round(avg(c_acctbal) over (partition by c_nationkey), 4) as c_acctbal, mode as c_mktsegment
    from customer join m using (c_nationkey)""",
)
def microaggregate_groups(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    known = c.withColumn("cluster_id", F.col("c_nationkey").cast("string"))
    boxes = clusters.cluster_boxes(known, "cluster_id", ["c_acctbal"], ["c_mktsegment"])
    fixed = clusters.Clusters(
        "c_custkey", ("c_acctbal",), ("c_mktsegment",), {}, {}, known.select("c_custkey", "cluster_id"), boxes, "mean"
    )
    return rounded(fixed.publish(c).select("c_custkey", "c_acctbal", "c_mktsegment"))


def _fit(spark, sf, output):
    c = table(spark, sf, "customer")
    return c, clusters.fit_clusters(c, "c_custkey", ["c_acctbal", "c_nationkey"], ["c_mktsegment"], 5, block_rows=500, output=output)


@register("local_recode")
def local_recode(spark, sf):
    c, fitted = _fit(spark, sf, "box")
    return fitted.publish(c)


@register("microaggregate")
def microaggregate(spark, sf):
    c, fitted = _fit(spark, sf, "mean")
    return fitted.publish(c)


def _greedy_sql(rows, k, loss, state, start, grown):
    """The greedy, block by block and row by row: every step of a block takes the first free row or the cheapest one.

    ``rows`` has (id, block, x, ...); a state row holds the numbers used so far and the cluster as it is.
    """
    fresh = f"s.size % {k} = 0"
    keep = ", ".join(f"case when {fresh} then {s0} else {g} end as {c}" for c, s0, g in zip(state, start, grown))
    return f"""with recursive p as ({rows}), g as (select max(x) - min(x) as span from p),
    s as (
      select block, []::bigint[] as used, -1 as cluster, 0 as size, cast(null as bigint) as pick, {", ".join(f"cast(null as {t}) as {c}" for c, t in state.items())}
      from (select distinct block from p)
      union all
      select s.block, list_append(s.used, p.id), s.cluster + case when {fresh} then 1 else 0 end, s.size % {k} + 1, p.id, {keep}
      from s join p on p.block = s.block and not list_contains(s.used, p.id), g
      qualify row_number() over (partition by s.block order by case when {fresh} then 0 else round({loss}, 9) end, p.id) = 1),
    m as (select pick as c_custkey, block || ':' || lpad(cast(cluster as varchar), 6, '0') as cluster_id from s where pick is not null)"""


_TREE_GREEDY = _greedy_sql(
    """select c_custkey as id, cast(c_custkey // 50 as varchar) as block, c_acctbal as x, n_name as n, r_name as r
      from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey""",
    5,
    "(greatest(s.hi, p.x) - least(s.lo, p.x)) / g.span + 0.5 * case when s.n = p.n then 0.0 when s.r = p.r then 0.5 else 1.0 end",
    {"lo": "double", "hi": "double", "n": "varchar", "r": "varchar"},
    ["p.x", "p.x", "p.n", "p.r"],
    ["least(s.lo, p.x)", "greatest(s.hi, p.x)", "case when s.n = p.n then s.n end", "case when s.r = p.r then s.r end"],
)


def _block(df):
    """Blocks of fifty neighbouring keys, so that SQL can follow the greedy."""
    return df.withColumn("block", F.expr("c_custkey div 50"))


@register(
    "tree_greedy",
    f"""{_TREE_GREEDY}
    select c_custkey, cluster_id, min(x) over c as "c_acctbal_min", max(x) over c as "c_acctbal_max",
      case when min(n) over c = max(n) over c then n when min(r) over c = max(r) over c then r else 'all' end as n_name
    from m join p on p.id = m.c_custkey window c as (partition by cluster_id)""",
)
def tree_greedy(spark, sf):
    """Clusters whose nations go up to their region, and beyond that to the root."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = _block(c.select("c_custkey", "c_acctbal", "n_name"))
    trees = {"n_name": _nation_tree(spark, sf)}
    fitted = clusters.fit_clusters(c, "c_custkey", ["c_acctbal"], ["n_name"], 5, {"n_name": 0.5}, block="block", trees=trees)
    return fitted.publish(c).select("c_custkey", "cluster_id", "c_acctbal_min", "c_acctbal_max", "n_name")


_FLAT_GREEDY = _greedy_sql(
    "select c_custkey as id, cast(c_custkey // 50 as varchar) as block, c_acctbal as x, c_mktsegment as n from customer",
    5,
    "(greatest(s.hi, p.x) - least(s.lo, p.x)) / g.span + case when s.n = p.n then 0.5 else 1.0 end",
    {"lo": "double", "hi": "double", "n": "varchar"},
    ["p.x", "p.x", "p.n"],
    ["least(s.lo, p.x)", "greatest(s.hi, p.x)", "case when s.n = p.n then s.n end"],
)


def _fit_block(spark, sf, output):
    c = _block(table(spark, sf, "customer"))
    return c, clusters.fit_clusters(c, "c_custkey", ["c_acctbal"], ["c_mktsegment"], 5, block="block", output=output)


@register(
    "local_recode_block",
    f"""{_FLAT_GREEDY}
    select c_custkey, cluster_id, min(x) over c as "c_acctbal_min", max(x) over c as "c_acctbal_max",
      case when min(n) over c = max(n) over c then n else '*' end as c_mktsegment
    from m join p on p.id = m.c_custkey window c as (partition by cluster_id)""",
)
def local_recode_block(spark, sf):
    c, fitted = _fit_block(spark, sf, "box")
    return fitted.publish(c).select("c_custkey", "cluster_id", "c_acctbal_min", "c_acctbal_max", "c_mktsegment")


@register(
    "microaggregate_block",
    f"""{_FLAT_GREEDY},
    f as (select cluster_id, n, count(*) as w from m join p on p.id = m.c_custkey group by all),
    o as (select cluster_id, n as mode from f qualify row_number() over (partition by cluster_id order by w desc, n) = 1)
    select c_custkey, cluster_id, round(avg(x) over (partition by cluster_id), 4) as c_acctbal, mode as c_mktsegment
    from m join p on p.id = m.c_custkey join o using (cluster_id)""",
)
def microaggregate_block(spark, sf):
    c, fitted = _fit_block(spark, sf, "mean")
    return rounded(fitted.publish(c).select("c_custkey", "cluster_id", "c_acctbal", "c_mktsegment"))


@register(
    "tree_assign",
    f"""{_TREE_GREEDY},
    b as (select cluster_id, min(x) as lo, max(x) as hi, case when min(n) = max(n) then min(n) end as n, case when min(r) = max(r) then min(r) end as r
      from m join p on p.id = m.c_custkey group by 1),
    a as (select s_suppkey, least(greatest(s_acctbal, (select min(x) from p)), (select max(x) from p)) as x, n_name as n, r_name as r
      from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey),
    j as (select s_suppkey, cluster_id, (greatest(hi, a.x) - least(lo, a.x)) / span
        + 0.5 * case when b.n = a.n then 0.0 when b.r = a.r then 0.5 else 1.0 end as cost from a, b, g)
    select s_suppkey, arg_min(cluster_id, (round(cost, 9), cluster_id)) as cluster_id, round(min(cost), 6) as cost from j group by 1""",
)
def tree_assign(spark, sf):
    """Suppliers to the cheapest cluster of customers."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    c = _block(c.select("c_custkey", "c_acctbal", "n_name"))
    trees = {"n_name": _nation_tree(spark, sf)}
    fitted = clusters.fit_clusters(c, "c_custkey", ["c_acctbal"], ["n_name"], 5, {"n_name": 0.5}, block="block", trees=trees)
    s = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    out = fitted.assign(s.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), "n_name"))
    return rounded(out.withColumnRenamed("c_custkey", "s_suppkey"), 6)


@register(
    "local_recode_gate",
    """select cast(c_custkey // 60 as varchar) as block, greatest(1, count(*) // 7) as clusters, least(7, count(*)) as least, count(*) as n_rows
    from customer group by 1""",
)
def local_recode_gate(spark, sf):
    """Blocks of sixty rows make clusters of seven, the rows left over join them, and no row is lost."""
    c = table(spark, sf, "customer").withColumn("block", F.expr("c_custkey div 60"))
    fitted = clusters.fit_clusters(c, "c_custkey", ["c_acctbal", "c_nationkey"], ["c_mktsegment"], 7, block="block")
    sizes = fitted.members.groupBy(F.substring_index("cluster_id", ":", 1).alias("block"), "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("block").agg(F.count(F.lit(1)).alias("clusters"), F.min("n").alias("least"), F.sum("n").alias("n_rows"))
