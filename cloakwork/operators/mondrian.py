"""Multidimensional global recoding: k-anonymous classes by recursive median splits.

Rows with equal quasi-identifiers always behave alike, so the work is done on the
distinct tuples with their weight; a value combination shared by a third of the table
is one tuple.  All open classes are split together, one round per tree level:

* a node table (one row per open class) carries size, inherited bounds and the
  dimensions already tried,
* the median of the chosen dimension comes from :func:`rank_select`,
* the split table is written to the scratch area and the tuples are relabelled by a
  join with it.

Classes that became small are finished independently of each other, many per task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakwork.functions.hashing import unit_hash
from cloakwork.functions.ranks import add_buckets, bucket_count, number_rows, quantile_bounds, rank_select, rank_within, running_sums
from cloakwork.operators.profile import bounds_of
from cloakwork.session import discard, materialize

LOCAL_TUPLES = 100_000
TIED_TUPLES = 100_000  # tied tuples that are ranked together
REWRITE_EVERY = 3


@dataclass(frozen=True)
class Classes:
    """Result of a partitioning run.

    ``tuples`` has one row per (tuple, class): q0..qN, weight ``w`` and ``ec_id``.
    """

    qi: tuple[str, ...]
    tuples: DataFrame
    ranges: dict[str, float]
    strict: bool
    rounds: int

    def table(self) -> DataFrame:
        """One row per class: ``ec_id``, ``n`` and the tight ``<qi>_min``/``<qi>_max``."""
        box = []
        for j, c in enumerate(self.qi):
            box += [F.min(f"q{j}").alias(f"{c}_min"), F.max(f"q{j}").alias(f"{c}_max")]
        return self.tuples.groupBy("ec_id").agg(F.sum("w").alias("n"), *box)

    def label(self, df: DataFrame, key: str) -> DataFrame:
        """Every row of ``df`` with its ``ec_id``.

        Equal rows meet one dictionary row, so a hot combination only makes the probe
        side large and adaptive skew handling can cut it.  After relaxed splits a
        tuple may belong to several classes; its rows are dealt out by a hash rank.
        """
        side = self.tuples.select(*[F.col(f"q{j}").alias(f"_q{j}") for j in range(len(self.qi))], "w", "ec_id")
        match = [F.col(c).cast("double") == F.col(f"_q{j}") for j, c in enumerate(self.qi)]
        if self.strict:
            return df.join(side.drop("w"), match).drop(*[f"_q{j}" for j in range(len(self.qi))])
        keys = [f"_q{j}" for j in range(len(self.qi))]
        shares = side.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("ec_id", "w"))).alias("parts"))
        joined = df.join(shares, match).withColumn("_u", unit_hash(key, "deal"))
        whole = joined.filter(F.size("parts") == 1).withColumn("ec_id", F.col("parts")[0]["ec_id"])
        cut = rank_within(joined.filter(F.size("parts") > 1), keys, "_u", key, df.count(), "_rank")
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("string").alias("ec"))
        dealt = F.aggregate(
            "parts",
            start,
            lambda acc, p: F.struct(
                (acc["seen"] + p["w"]).alias("seen"),
                F.coalesce(acc["ec"], F.when(F.col("_rank") <= acc["seen"] + p["w"], p["ec_id"])).alias("ec"),
            ),
            lambda acc: acc["ec"],
        )
        out = whole.unionByName(cut.withColumn("ec_id", dealt).drop("_rank"))
        return out.drop(*keys, "parts", "_u")

    def generalize(self, df: DataFrame, key: str) -> DataFrame:
        """Rows with their class and its bounds instead of the quasi-identifiers."""
        return self.label(df, key).drop(*self.qi).join(self.table().drop("n"), "ec_id")


def width(lo: Column, hi: Column, full: float) -> Column:
    """Normalized width; a width equal to the whole range counts one, so constants do too."""
    w = hi - lo
    return F.when(w == F.lit(full), F.lit(1.0)).otherwise(w / F.lit(full or 1.0))


def _choose(ranges: list[float]) -> Column:
    """Widest dimension not tried yet, lowest index on ties; null when all were tried."""
    cells = [
        F.when(~F.col("tried")[j], F.struct(width(F.col("lo")[j], F.col("hi")[j], r).alias("w"), F.lit(-j).alias("j")))
        for j, r in enumerate(ranges)
    ]
    return -F.array_max(F.array(*cells))["j"]


def _with(array: str, dim: Column, value: Column, d: int) -> Column:
    return F.array(*[F.when(dim == j, value).otherwise(F.col(array)[j]) for j in range(d)])


def _splits(tuples: DataFrame, nodes: DataFrame, k: int, strict: bool, d: int, bucketed: bool) -> DataFrame:
    """Try the chosen dimension of every open class; one row per class."""
    dim = F.col("dim")
    v = F.element_at(F.array(*[F.col(f"q{j}") for j in range(d)]), dim + 1)
    b = F.element_at(F.array(*[F.col(f"q{j}__b") for j in range(d)]), dim + 1) if bucketed else F.lit(0)
    items = tuples.join(nodes.select("ec", "dim"), "ec").select("ec", "tid", "w", v.alias("v"), b.alias("b"))
    targets = nodes.withColumn("rank", F.floor(F.col("n") / 2))
    out = rank_select(items, ["ec"], "v", targets, "w", "b" if bucketed else None)
    if strict:
        ok = F.col("next_value").isNotNull() & (F.col("upto") >= k) & (F.col("n") - F.col("upto") >= k)
        return out.withColumns({"ok": ok, "cut_tid": F.lit(None).cast("bigint"), "cut_left": F.lit(0).cast("bigint")})
    out = out.withColumns({"ok": F.col("least") < F.col("most"), "need": F.col("rank") - F.col("below")})
    tied = out.filter(F.col("ok") & (F.col("need") < F.col("upto") - F.col("below")))
    tied = tied.select("ec", F.col("value").alias("v"), "need")
    ties = items.join(tied, ["ec", "v"]).select("ec", "tid", "w", F.floor(F.col("tid") / TIED_TUPLES).alias("part"))
    shared = rank_select(ties, ["ec"], "tid", tied.select("ec", F.col("need").alias("rank")), "w", "part" if bucketed else None)
    shared = shared.select("ec", F.col("value").alias("cut_tid"), (F.col("rank") - F.col("below")).alias("cut_left"))
    return out.join(shared, "ec", "left")


def _children(splits: DataFrame, k: int, strict: bool, d: int) -> DataFrame:
    """Node rows after a round: two children of a split class, or the class itself with one dimension less."""
    dim, tried = F.col("dim"), F.array(*[F.lit(False)] * d)
    lo, hi = _with("lo", dim, F.col("least"), d), _with("hi", dim, F.col("most"), d)
    spent = F.array(*[F.col("tried")[j] | (dim == j) for j in range(d)])
    n_left = F.col("upto") if strict else F.col("rank")
    right_lo = F.col("next_value") if strict else F.when(F.col("cut_tid").isNull(), F.col("next_value")).otherwise(F.col("value"))
    m_right = F.col("rows_all") - (F.col("rows_upto") if strict else F.col("rows_below"))

    def node(ec, n, m, lo, hi, tried):
        return F.struct(ec.alias("ec"), n.alias("n"), m.alias("m"), lo.alias("lo"), hi.alias("hi"), tried.alias("tried"))

    left_hi = F.array(*[F.when(dim == j, F.col("value")).otherwise(F.col("hi0")[j]) for j in range(d)])
    right = F.array(*[F.when(dim == j, F.col("right_lo")).otherwise(F.col("lo0")[j]) for j in range(d)])
    s = splits.withColumns({"lo0": lo, "hi0": hi, "right_lo": right_lo})
    two = F.array(
        node(F.concat("ec", F.lit("0")), n_left, F.col("rows_upto"), F.col("lo0"), left_hi, tried),
        node(F.concat("ec", F.lit("1")), F.col("n") - n_left, m_right, right, F.col("hi0"), tried),
    )
    one = F.array(node(F.col("ec"), F.col("n"), F.col("rows_all"), F.col("lo0"), F.col("hi0"), spent))
    return s.select(F.inline(F.when(F.col("ok"), two).otherwise(one)))


def _relabel(tuples: DataFrame, splits: DataFrame, strict: bool, d: int) -> DataFrame:
    """Move tuples into the children; a tuple on a relaxed cut is shared by both sides."""
    s = splits.filter("ok").select("ec", "dim", F.col("value").alias("at"), "cut_tid", "cut_left")
    v = F.element_at(F.array(*[F.col(f"q{j}") for j in range(d)]), F.col("dim") + 1)
    joined = tuples.join(s, "ec", "left")
    left, right = F.concat("ec", F.lit("0")), F.concat("ec", F.lit("1"))
    keep = [c for c in tuples.columns if c not in ("ec", "w")]
    if strict:
        ec = F.when(F.col("dim").isNull(), F.col("ec")).when(v <= F.col("at"), left).otherwise(right)
        return joined.withColumn("ec", ec).select("ec", "w", *keep)
    part = lambda ec, w: F.struct(ec.alias("ec"), w.alias("w"))
    w = F.col("w")
    on_cut = (v == F.col("at")) & (F.col("tid") == F.col("cut_tid")) & (F.col("cut_left") < w)
    go_left = (v < F.col("at")) | ((v == F.col("at")) & (F.col("cut_tid").isNull() | (F.col("tid") <= F.col("cut_tid"))))
    parts = (
        F.when(F.col("dim").isNull(), F.array(part(F.col("ec"), w)))
        .when(on_cut, F.array(part(left, F.col("cut_left")), part(right, w - F.col("cut_left"))))
        .when(go_left, F.array(part(left, w)))
        .otherwise(F.array(part(right, w)))
    )
    return joined.withColumn("parts", parts).select(F.inline("parts"), *keep)


def _finish_small(ranges: list[float], k: int, strict: bool):
    """Split one small class to the end, inside a task, with the same rules as the rounds."""
    full = np.asarray(ranges)

    def finish(tuples: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
        if tuples.empty or node.empty:
            return tuples.assign(ec_id=tuples["ec"]) if node.empty else pd.DataFrame()
        q = tuples[[f"q{j}" for j in range(len(full))]].to_numpy(float)
        n0 = node.iloc[0]
        ids, take, weight = [], [], []
        todo = [(
            n0["ec"], np.arange(len(q)), tuples["w"].to_numpy(),
            np.array(n0["lo"], float), np.array(n0["hi"], float), np.array(n0["tried"], bool),
        )]
        while todo:
            ec, idx, w, lo, hi, tried = todo.pop()
            half, n = w.sum() // 2, w.sum()
            span = hi - lo
            norm = np.where(span == full, 1.0, span / np.where(full == 0, 1.0, full))
            for j in sorted(np.flatnonzero(~tried), key=lambda j: (-norm[j], j)) if half >= k else ():
                vals, pos = np.unique(q[idx, j], return_inverse=True)
                lo[j], hi[j] = vals[0], vals[-1]
                run = np.cumsum(np.bincount(pos, weights=w)).astype(np.int64)
                at = int(np.searchsorted(run, half))
                left_hi, right_lo = hi.copy(), lo.copy()
                left_hi[j] = vals[at]
                if strict:
                    if at == len(vals) - 1 or run[at] < k or n - run[at] < k:
                        continue
                    wl = np.where(pos <= at, w, 0)
                else:
                    if len(vals) == 1:
                        continue
                    wl = np.where(pos < at, w, 0)
                    tied = np.flatnonzero(pos == at)
                    tied = tied[np.argsort(tuples["tid"].to_numpy()[idx[tied]], kind="stable")]
                    room = half - wl.sum() - (np.cumsum(w[tied]) - w[tied])
                    wl[tied] = np.clip(room, 0, w[tied])
                wr = w - wl
                right_lo[j] = vals[pos[wr > 0].min()]
                fresh = np.zeros(len(full), bool)
                todo.append((ec + "0", idx[wl > 0], wl[wl > 0], lo.copy(), left_hi, fresh))
                todo.append((ec + "1", idx[wr > 0], wr[wr > 0], right_lo, hi.copy(), fresh.copy()))
                break
            else:
                ids.append(np.repeat(ec, len(idx)))
                take.append(idx)
                weight.append(w)
        out = tuples.iloc[np.concatenate(take)].copy()
        out["w"] = np.concatenate(weight)
        out["ec_id"] = np.concatenate(ids)
        return out

    return finish


def mondrian(
    df: DataFrame, qi: list[str], k: int, strict: bool = True, local_tuples: int | None = None,
    tuples_per_bucket: int = 500_000,
) -> Classes:
    """Partition the rows of ``df`` into classes of at least ``k`` rows.

    ``local_tuples`` is the class size below which a class is finished inside one
    task; by default a quarter of the tuples, never more than ``LOCAL_TUPLES``.
    """
    d, names = len(qi), [f"q{j}" for j in range(len(qi))]
    base = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(qi, names)])
    base = base.groupBy(*names).agg(F.count(F.lit(1)).alias("w"))
    # tied tuples of a relaxed cut are dealt in the order of their values, whatever the partitioning
    base = materialize(base.withColumn("tid", F.monotonically_increasing_id())) if strict else materialize(number_rows(base, names, "tid"))
    head = base.agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("w").alias("n"),
        F.count_if(sum((F.col(c).isNull().cast("int") for c in names), F.lit(0)) > 0).alias("bad"),
        *[f(c).alias(f"{c}_{e}") for c in names for e, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    if head["bad"]:
        raise ValueError("quasi-identifiers must not be null: fill or drop them first")
    m, n = head["m"], head["n"] or 0
    bounds = {c: (head[f"{c}_lo"] or 0.0, head[f"{c}_hi"] or 0.0) for c in names}
    ranges = [bounds[c][1] - bounds[c][0] for c in names]
    local = max(1, min(LOCAL_TUPLES, m // 4)) if local_tuples is None else local_tuples
    bucketed = bucket_count(m, tuples_per_bucket) > 1
    tuples = base.withColumn("ec", F.lit("r")).select("ec", "w", "tid", *names)
    if bucketed:
        tuples = add_buckets(tuples, quantile_bounds(base, names, bucket_count(m, tuples_per_bucket)))

    spark = df.sparkSession
    nodes = spark.range(1).select(
        F.lit("r").alias("ec"),
        F.lit(n).cast("bigint").alias("n"),
        F.lit(m).cast("bigint").alias("m"),
        F.array(*[F.lit(float(bounds[c][0])) for c in names]).alias("lo"),
        F.array(*[F.lit(float(bounds[c][1])) for c in names]).alias("hi"),
        F.array(*[F.lit(False)] * d).alias("tried"),
    )
    splittable = (F.floor(F.col("n") / 2) >= k) & (F.col("m") > 1) & F.array_contains("tried", False)
    big = splittable & (F.col("m") > local)
    rounds, stale, owned = 0, 0, base
    open_big, small = nodes.filter(big), [nodes.filter(splittable & ~big)]
    n_big = int(m > local and n // 2 >= k and m > 1)
    while n_big:
        rounds += 1
        chosen = open_big.withColumn("dim", _choose(ranges))
        splits = materialize(_splits(tuples, chosen, k, strict, d, bucketed))
        after = _children(splits, k, strict, d)
        # two numbers per round decide whether to go on
        n_big, n_small = after.agg(F.count_if(big), F.count_if(splittable & ~big)).first()
        open_big = after.filter(big)
        if n_small:
            small.append(after.filter(splittable & ~big))
        tuples = _relabel(tuples, splits, strict, d)
        stale += 1
        if stale == REWRITE_EVERY:
            fresh = materialize(tuples)
            discard(owned)
            owned = tuples = fresh
            stale = 0
    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    rest = materialize(rest)
    final = tuples.select("ec", "w", "tid", *names)
    schema = ", ".join(["ec string", "w bigint", "tid bigint", *[f"{c} double" for c in names], "ec_id string"])
    busy = final.join(rest.select("ec"), "ec", "left_semi")
    done = final.join(rest.select("ec"), "ec", "left_anti").withColumn("ec_id", F.col("ec"))
    finished = busy.groupBy("ec").cogroup(rest.groupBy("ec")).applyInPandas(
        _finish_small(ranges, k, strict), schema
    )
    result = materialize(done.unionByName(finished))
    discard(owned)
    discard(rest)
    return Classes(tuple(qi), result, dict(zip(qi, ranges)), strict, rounds)


def ncp_percent(classes: DataFrame, qi: list[str], ranges: dict[str, float], size: str = "n") -> DataFrame:
    """Information loss: size-weighted mean normalized width over all classes and columns, in percent."""
    loss = sum((width(F.col(f"{c}_min"), F.col(f"{c}_max"), ranges[c]) for c in qi), F.lit(0.0))
    return classes.agg(
        (100.0 * F.sum(loss * F.col(size)) / (F.lit(len(qi)) * F.sum(size))).alias("ncp_percent"),
        F.sum(F.col(size) * F.col(size)).alias("discernibility"),
        F.count(F.lit(1)).alias("n_classes"),
        F.sum(size).alias("n_records"),
    )


def anonymity_report(df: DataFrame, qi: list[str], k: int) -> DataFrame:
    """Smallest group and the number of groups and rows that break k-anonymity."""
    groups = df.groupBy(*qi).agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < k
    return groups.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("n").alias("smallest"),
        F.count_if(small).alias("violating_groups"),
        F.coalesce(F.sum(F.when(small, F.col("n"))), F.lit(0)).alias("violating_rows"),
        F.sum(F.col("n") * F.col("n")).alias("discernibility"),
    )


def widths(classes: DataFrame, qi: list[str], ranges: dict[str, float]) -> DataFrame:
    """Normalized width of every class on every column, long form."""
    cells = [
        F.struct(F.lit(j).alias("dim"), F.lit(c).alias("column"), width(F.col(f"{c}_min"), F.col(f"{c}_max"), ranges[c]).alias("width"))
        for j, c in enumerate(qi)
    ]
    return classes.select("ec_id", F.explode(F.array(*cells)).alias("m")).select("ec_id", "m.*")


def frequency_set(df: DataFrame, by: list[str], qi: list[str]) -> DataFrame:
    """Counts of every value per class and column."""
    cells = [F.struct(F.lit(j).alias("dim"), F.col(c).cast("double").alias("value")) for j, c in enumerate(qi)]
    long = df.select(*by, F.explode(F.array(*cells)).alias("m")).select(*by, "m.*")
    return long.groupBy(*by, "dim", "value").agg(F.count(F.lit(1)).alias("n"))


def cumulative_to_median(freq: DataFrame, by: list[str]) -> DataFrame:
    """Running counts and the following value, cut at the first value that reaches half of the rows."""
    total = freq.groupBy(*by).agg(F.floor(F.sum("n") / 2).alias("middle"))
    buckets = bucket_count(freq.count())
    cuts = quantile_bounds(freq, ["value"], buckets)
    runs = running_sums(add_buckets(freq, cuts), by, "value", ["n"], "value__b" if buckets > 1 else None).drop("value__b")
    runs = runs.withColumnRenamed("run_n", "cumulative").join(total, by)
    return runs.filter(F.col("cumulative") - F.col("n") < F.col("middle"))


def first_splits(df: DataFrame, qi: list[str], k: int) -> DataFrame:
    """Median split of the whole table on every column, with its feasibility and the chosen column."""
    bounds = bounds_of(df, qi)
    rows = df.count()
    cuts = quantile_bounds(df, qi, bucket_count(rows))
    work = add_buckets(df.select(*qi), cuts)
    cells = [
        F.struct(F.lit(j).alias("dim"), F.lit(c).alias("column"), F.col(c).cast("double").alias("v"), F.col(f"{c}__b").alias("b"))
        for j, c in enumerate(qi)
    ]
    items = work.select(F.explode(F.array(*cells)).alias("m")).select("m.*")
    targets = items.groupBy("dim", "column").agg(F.floor(F.count(F.lit(1)) / 2).alias("rank"))
    out = rank_select(items, ["dim", "column"], "v", targets, bucket="b" if bucket_count(rows) > 1 else None)
    ok = F.col("next_value").isNotNull() & (F.col("rank") >= k) & (F.col("upto") >= k) & (F.lit(rows) - F.col("upto") >= k)
    spread = F.lit(0.0)
    for c in qi:
        lo, hi = bounds[c]
        spread = F.when(F.col("column") == c, width(F.lit(lo), F.lit(hi), hi - lo)).otherwise(spread)
    out = out.select(
        "dim",
        "column",
        spread.alias("width"),
        F.col("value").alias("split_value"),
        "next_value",
        F.col("upto").alias("n_left"),
        (F.lit(rows) - F.col("upto")).alias("n_right"),
        ok.alias("feasible"),
    )
    # one row per column from here on
    best = Window.partitionBy().orderBy(F.desc("feasible"), F.desc("width"), "dim")
    return out.withColumn("chosen", F.col("feasible") & (F.row_number().over(best) == 1))
