"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points of a ring of ``TICKS`` ticks.  A row's ``doc_id``
picks a tick; the shards met clockwise from there are the row's order of choice.  Rows
arrive in cells: larger texts first, and in a hashed order within a size class.  A
shard that has reached (1 + ``SLACK``) times the mean number of bytes is full, and rows
that come later continue clockwise to the next shard with room.

Because all shards see the rows in the same order, the outcome is fixed by the cell at
which each shard became full.  These few numbers follow from the bytes per (cell, arc)
of the ring, a table whose size depends on the parameters only, so the walk round the
ring costs the same for any number of rows.  Placing a row is then a plain expression.

``cell`` depends on the whole row and on its number among equal rows, so a key that
holds a third of all rows spreads over all cells and overflows like any other load.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.functions.ranks import rank_within
from cloakwork.llm.common import register, slices_for, table
from cloakwork.session import materialize

SHARDS = 8
VNODES = 16
TICKS = 4096
CELLS = 256  # per size class; sizes are classed by powers of four
CLASSES = 20
SLACK = 0.002
COPIES = 4096  # equal rows numbered by one piece of a sequence


def ring(shards: int, vnodes: int = VNODES) -> tuple[list[int], list[list[int]]]:
    """Arc of each tick, and the order of shards met clockwise from each arc.

    The points of a shard do not depend on how many shards there are; a taken tick is
    passed over to the next free one.
    """
    owner: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            at = int(hashlib.md5(f"{shard}:{v}".encode()).hexdigest()[:8], 16) % TICKS
            while at in owner:
                at = (at + 1) % TICKS
            owner[at] = shard
    points = sorted(owner)
    orders = []
    for i in range(len(points)):
        met = dict.fromkeys(owner[points[(i + k) % len(points)]] for k in range(len(points)))
        orders.append(list(met))
    arcs, arc = [], 0
    for tick in range(TICKS):
        while arc < len(points) and points[arc] < tick:
            arc += 1
        arcs.append(arc % len(points))
    return arcs, orders


def close_cells(loads: list[tuple[int, int, int]], orders: list[list[int]], shards: int, slack: float) -> list[int]:
    """For every shard the first cell it no longer takes rows of.

    ``loads`` holds (cell, arc, bytes).  Cells are dealt in order; a shard is full once
    it has reached its bound.  The last open shard stays open.
    """
    never = CLASSES * CELLS
    closed, have = [never] * shards, [0] * shards
    bound = (1 + slack) * sum(x for _, _, x in loads) / shards
    by_cell: dict[int, list[tuple[int, int]]] = {}
    for cell, arc, size in loads:
        by_cell.setdefault(cell, []).append((arc, size))
    for cell in sorted(by_cell):
        for arc, size in by_cell[cell]:
            have[next(s for s in orders[arc] if closed[s] > cell)] += size
        for s in sorted(range(shards), key=lambda s: -have[s]):
            if closed[s] == never and have[s] >= bound and closed.count(never) > 1:
                closed[s] = cell + 1
    return closed


def _listed(values: list[int]) -> Column:
    return F.expr(f"array({','.join(map(str, values))})")


def _cell(size: str, h: Column) -> Column:
    rank = F.lit(CLASSES - 1) - F.least(F.floor(F.log2(F.col(size).cast("double")) / 2), F.lit(CLASSES - 1))
    return (rank * CELLS + F.pmod(F.shiftrightunsigned(h, 20), F.lit(CELLS))).cast("int")


def place(rows: DataFrame, key: str, size: str, ties: list[str], shards: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """Add ``shard`` and ``slot`` (0, 1, ... inside each shard) to narrow rows.

    ``key`` picks the place on the ring, ``size`` (1 or more) is what is balanced,
    ``ties`` tell rows of a key apart.  Nulls are a value like any other.  Equal rows are
    numbered, so they spread as different ones do; which of them is which does not
    matter.  An empty table gives an empty one.
    """
    cols = list(dict.fromkeys([key, size, *ties]))
    units = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    units = units.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES))))
    first = F.col("_piece") * COPIES
    units = units.withColumn("_copy", F.explode(F.sequence(first, F.least(F.col("_copies") - 1, first + COPIES - 1))))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols]
    arcs, orders = ring(shards)
    units = units.select(
        *cols,
        F.xxhash64(*named, "_copy").alias("_h"),
        F.element_at(_listed(arcs), (F.pmod(F.xxhash64(F.lit("ring"), named[0]), F.lit(TICKS)) + 1).cast("int")).alias("_arc"),
    )
    units = materialize(units.withColumn("_cell", _cell(size, F.col("_h"))))
    loads = units.groupBy("_cell", "_arc").agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("rows"))
    found = loads.orderBy("_cell", "_arc").collect()  # at most CLASSES * CELLS * shards * VNODES rows
    closed = close_cells([(r["_cell"], r["_arc"], r["size"]) for r in found], orders, shards, slack)
    order = F.element_at(F.expr(f"array({','.join(f'array{tuple(o)}' for o in orders)})"), F.col("_arc") + 1)
    ends = _listed(closed)
    open_ones = F.filter(order, lambda s: F.element_at(ends, s + 1) > F.col("_cell"))
    units = units.withColumn("shard", F.element_at(open_ones, 1)).withColumn("_u", F.pmod("_h", F.lit(1 << 40)) / F.lit(float(1 << 40)))
    total = sum(r["rows"] for r in found)
    units = units.withColumn("_tie", F.struct("_h", *cols))
    placed = rank_within(units, ["shard"], "_u", "_tie", total, "slot", -(-max(total, 1) // slices_for(total)))
    return placed.select(*cols, "shard", (F.col("slot") - 1).alias("slot"))


def shards_of(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row; size is the text's UTF-8 bytes plus 1, null counts as empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(value) + 1).cast("bigint").alias("size"), F.crc32(value).alias("text_crc32"))
    return place(rows, "doc_id", "size", ["text_crc32"], shards)


@register("op2_ring_shards")
def query(spark: SparkSession, folder: str) -> DataFrame:
    df = shards_of(table(spark, folder, "documents"))
    return df.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
