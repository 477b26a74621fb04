"""Mixing sources to target weights by a low-discrepancy schedule.

Slot n of the mix lies at the n-th van der Corput point; the point falls into one
source's stretch of the cumulative weights, so at every length of the mix each source
has its share up to a few slots.  The r-th slot of a source takes the r-th block of
that source.  Blocks are equal runs of ``BLOCK`` words of the source's documents in a
shuffled order; after the last block the next pass begins.  Slots after a source's
quota are skipped, the last one is cut to fit, and the few slots that the points leave
short are added at the end, so every source gives exactly its quota.

The schedule, the blocks and the documents meet in equi-joins on (source, block).  A
source of any size is spread over its blocks and slices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cloakwork.functions.ranks import number_rows, rank_within
from cloakwork.llm.common import prefix_sums, register, slices_for, table
from cloakwork.session import materialize

BLOCK = 1024
PASSES = 3
BITS = 40  # slots are numbered below 2 ** BITS
BINS = 1024
WORDS = r"[^\x20\x09-\x0D]+"
COPIES = 4096


def van_der_corput(n: Column) -> Column:
    """n's BITS binary digits read backwards, as an integer below 2 ** BITS."""
    return F.conv(F.reverse(F.lpad(F.bin(n), BITS, "0")), 2, 10).cast("bigint")


def targets(sources: DataFrame, passes: int = PASSES) -> DataFrame:
    """Add ``target``: shares by weight, none above ``passes`` times the source's size.

    ``sources`` has size and weight.  What a capped source cannot give is dealt to the
    others by weight, until none is above.  Only three sums per round reach the driver.
    """
    cap = F.lit(passes) * F.col("size")
    level, capped = 0.0, -1
    total = sources.agg(F.sum("size")).first()[0] or 0
    while True:
        over = cap < F.col("weight") * level
        r = sources.agg(F.sum(F.when(over, cap)).alias("cap"), F.sum(F.when(~over, F.col("weight"))).alias("w"), F.count_if(over).alias("n")).first()
        if r["n"] == capped or not r["w"]:
            break
        capped, level = r["n"], (total - (r["cap"] or 0)) / float(r["w"])
    share = F.col("weight") * F.lit(float(level))
    return sources.withColumn("target", F.when(cap < share, cap.cast("double")).otherwise(share))


def by_code_point(rows: DataFrame) -> DataFrame:
    """One row per source with its size, its place by code point (null last) and weight 1, 2, 3, 1, ..."""
    sources = materialize(rows.groupBy("source").agg(F.sum("size").alias("size")))
    listed = number_rows(sources, [F.col("source").isNull(), F.col("source")], "idx")
    return listed.withColumns({"idx": F.col("idx").cast("bigint"), "weight": (F.col("idx") % 3 + 1).cast("bigint")})


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as rows (n, idx, rank, pass, block, words); ``plan`` has idx, size and quota.

    ``n`` is the slot (null for the closing slots), ``rank`` counts a source's slots.
    """
    stats = plan.agg(F.sum("quota").alias("all"), F.count(F.lit(1)).alias("n")).first()
    total, sources = stats["all"] or 0, stats["n"]
    slots = math.ceil(total / block)
    blocks, rest = F.ceil(F.col("size") / block), F.col("quota") % F.col("size")
    plan = plan.filter("quota > 0").withColumns({"blocks": blocks, "rest": rest, "full": F.floor(F.col("quota") / F.col("size"))})
    plan = plan.withColumn("needed", F.col("full") * F.col("blocks") + F.ceil(F.col("rest") / block))
    # stretches of the cumulative weights, in integers below 2 ** BITS
    slices = slices_for(sources)
    plan = prefix_sums(plan.withColumn("_u", F.col("idx") / F.lit(float(max(sources, 1)))), [], "_u", ["idx"], F.col("quota"), "before", sources) if slices > 1 else plan.withColumn(
        "before", F.coalesce(F.sum("quota").over(Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    edge = lambda c: F.floor(c / F.lit(float(max(total, 1))) * F.lit(float(1 << BITS))).cast("bigint")
    plan = materialize(plan.withColumns({"low": edge(F.col("before")), "high": edge(F.col("before") + F.col("quota"))}))
    wide = (1 << BITS) // BINS
    stretch = plan.select("idx", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / wide), F.floor((F.col("high") - 1) / wide))).alias("bin"))
    n = plan.sparkSession.range(slots).withColumnRenamed("id", "n").withColumn("x", van_der_corput(F.col("n")))
    met = n.withColumn("bin", F.floor(F.col("x") / wide)).join(stretch, "bin").filter("x >= low and x < high")
    met = met.select("n", "idx", (F.col("n") / F.lit(float(max(slots, 1)))).alias("u"))
    ranked = rank_within(met, ["idx"], "u", "n", slots, "rank", -(-max(slots, 1) // slices_for(slots)))
    ranked = materialize(ranked.select("n", "idx", (F.col("rank") - 1).alias("rank")))
    counts = ranked.groupBy("idx").agg(F.count(F.lit(1)).alias("have"))
    short = plan.join(counts, "idx", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < needed")
    closing = short.select(F.lit(None).cast("bigint").alias("n"), "idx", F.explode(F.sequence(F.col("have"), F.col("needed") - 1)).alias("rank"))
    made = ranked.unionByName(closing).join(plan.select("idx", "size", "blocks", "rest", "full", "needed"), "idx").filter("rank < needed")
    number = F.col("rank") % F.col("blocks")
    length = F.least(F.lit(block), F.col("size") - number * block)
    last = (F.col("rank") == F.col("needed") - 1) & (F.col("rest") > 0)
    words = F.when(last, F.col("rest") - number * block).otherwise(length)
    return made.select("n", "idx", "rank", F.floor(F.col("rank") / F.col("blocks")).alias("pass"), number.alias("block"), length.alias("length"), words.alias("words"))


def taken(rows: DataFrame, block: int = BLOCK, passes: int = PASSES) -> DataFrame:
    """(key columns..., source, size, source_size, target, taken) for narrow rows with ``source`` and ``size``.

    Rows of size 0 and sources without words take part with 0.  Equal rows are
    numbered and shuffled like different ones.  A null source is a source.
    """
    keys = [c for c in rows.columns if c not in ("source", "size")]
    plan = targets(by_code_point(rows), passes)
    plan = materialize(plan.withColumn("quota", F.floor("target").cast("bigint")))
    units = rows.groupBy("source", "size", *keys).agg(F.count(F.lit(1)).alias("_copies"))
    match = plan.select(F.col("source").alias("_s"), "idx", F.col("size").alias("source_size"), "target")
    units = units.join(match, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    named = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in [*keys, "size"]]
    units = materialize(units.withColumn("_u", F.pmod(F.xxhash64(*named), F.lit(1 << 50)) / F.lit(float(1 << 50))))
    n = units.count()
    starts = prefix_sums(units, ["idx"], "_u", ["size", *keys], F.col("size") * F.col("_copies"), "_at", n)
    starts = starts.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES))))
    first = F.col("_piece") * COPIES
    starts = starts.withColumn("_copy", F.explode(F.sequence(first, F.least(F.col("_copies") - 1, first + COPIES - 1))))
    starts = starts.withColumn("_at", F.col("_at") + F.col("_copy") * F.col("size")).drop("_copies", "_piece", "_u")
    spans = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block)))
    parts = starts.withColumn("block", F.explode_outer(spans))
    parts = parts.withColumns(
        {
            "_from": F.greatest(F.col("_at") - F.col("block") * block, F.lit(0)),
            "_to": F.least(F.col("_at") + F.col("size") - F.col("block") * block, F.lit(block)),
        }
    )
    slots = schedule(plan.select("idx", "size", "quota"), block)
    whole = F.col("words") == F.col("length")
    uses = slots.groupBy("idx", "block").agg(F.count_if(whole).alias("_whole"), F.coalesce(F.sum(F.when(~whole, F.col("words"))), F.lit(0)).alias("_cut"))
    got = F.col("_whole") * (F.col("_to") - F.col("_from")) + F.greatest(F.lit(0), F.least("_cut", "_to") - F.col("_from"))
    used = parts.join(uses, ["idx", "block"], "left").withColumn("_got", F.coalesce(got, F.lit(0)))
    cols = [*keys, "source", "size", "source_size", "target"]
    return used.groupBy(*cols, "_at", "_copy").agg(F.sum("_got").cast("bigint").alias("taken")).select(*cols, "taken")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Narrow rows (key, text hash, source, size); a null text has no words."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("bigint")
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("crc"), F.col(source).alias("source"), size.alias("size"))


@register("op6_source_mix")
def query(spark: SparkSession, folder: str) -> DataFrame:
    return taken(sized(table(spark, folder, "documents"))).select("doc_id", "size", "source_size", "target", "taken", "source")
