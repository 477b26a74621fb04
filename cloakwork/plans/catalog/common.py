"""Inputs shared by several registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakwork.functions.hashing import unit_hash, unit_hash_sql

LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# orders has no nulls, so some are put in by hash; column -> (hash seed, share)
ORDER_HOLES = {
    "o_custkey": ("h1", 0.25),
    "o_orderstatus": ("h2", 0.20),
    "o_totalprice": ("h3", 0.15),
    "o_orderpriority": ("h4", 0.30),
}
EMPTY_MONTHS = ("1997-03-01", "1999-07-01")


def orders_with_holes(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {c: F.when(unit_hash("o_orderkey", seed) >= share, F.col(c)) for c, (seed, share) in ORDER_HOLES.items()}
    )


ORDERS_WITH_HOLES_SQL = (
    "select o_orderkey, o_orderdate, "
    + ", ".join(
        f"case when {unit_hash_sql('o_orderkey', s)} >= {p} then {c} end as {c}" for c, (s, p) in ORDER_HOLES.items()
    )
    + " from orders"
)


def orders_with_empty_months(orders: DataFrame) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM-01")
    empty = month.isin(*EMPTY_MONTHS) | (unit_hash("o_orderkey", "m1") < 0.1)
    return orders.select("o_orderkey", "o_orderdate", F.when(~empty, F.col("o_totalprice")).alias("o_totalprice"))


ORDERS_WITH_EMPTY_MONTHS_SQL = f"""
select o_orderkey, o_orderdate,
  case when strftime(o_orderdate, '%Y-%m-01') in {EMPTY_MONTHS} or {unit_hash_sql('o_orderkey', 'm1')} < 0.1
       then null else o_totalprice end as o_totalprice
from orders"""


def rounded(df: DataFrame, digits: int = 4, only: list[str] | None = None) -> DataFrame:
    doubles = [c for c, t in df.dtypes if t == "double" and (only is None or c in only)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def predicted_flag() -> Column:
    """Rule-based guess of l_returnflag used by the metric queries."""
    return F.when(F.col("l_quantity") <= 17, "A").when(F.col("l_discount") <= 0.05, "N").otherwise("R")


PREDICTED_FLAG_SQL = "case when l_quantity <= 17 then 'A' when l_discount <= 0.05 then 'N' else 'R' end"
