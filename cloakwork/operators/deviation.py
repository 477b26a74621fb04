"""Exact split search for absolute losses (deviation from the mean or the median).

The left side of a threshold is every row up to it, so its centre moves slowly along a
feature.  Rows are cut into strips by the feature and into bands by the label.  For a
strip, all centres of its thresholds lie in a narrow band: rows of other strips below
or above the band enter as two totals, only rows inside it travel to the strip's task.
A task therefore sees its own strip plus about as many band rows, and every threshold
is evaluated exactly.

A value that many rows have is a strip of its own, of any size, with one threshold only:
behind it.  Its two centres are known from totals or from one band each, so its loss is
added up by bands; no task gathers its rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloakwork.functions.ranks import rank_select
from cloakwork.session import materialize

STRIP_ROWS = 20_000
MOST_STRIPS = 256
CHUNK_ROWS = 512

EMPTY = {"n": 0.0, "s": 0.0, "nb": 0.0, "sb": 0.0, "y": np.empty(0), "w": np.empty(0)}


class _Side:
    """Rows that are wholly on one side of every threshold of a chunk, sorted by label."""

    def __init__(self, far: dict, y: np.ndarray, w: np.ndarray):
        order = np.argsort(y, kind="stable")
        self.y, w = y[order], w[order]
        self.n = np.concatenate([[0.0], np.cumsum(w)]) + far["nb"]
        self.s = np.concatenate([[0.0], np.cumsum(w * self.y)]) + far["sb"]

    def upto(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.y, c, side="right")
        return self.n[at], self.s[at]


def _deviations(side: _Side, inside: np.ndarray, y, w, n, s, loss: str) -> np.ndarray:
    """Sum of |y - centre| for each threshold; ``inside`` marks the chunk rows on this side."""
    wi = inside * w

    def upto(c):
        n0, s0 = side.upto(c)
        hit = wi * (y[None, :] <= c[:, None])
        return n0 + hit.sum(axis=1), s0 + (hit * y).sum(axis=1)

    if loss == "mae":
        centre = s / np.where(n > 0, n, 1)
    else:
        values = np.unique(np.concatenate([side.y, y]))
        need = np.ceil(n / 2)
        lo, hi = np.zeros(len(n), int), np.full(len(n), len(values) - 1)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            enough = upto(values[mid])[0] >= need
            hi, lo = np.where(enough, mid, hi), np.where(enough, lo, np.minimum(mid + 1, hi))
        centre = values[lo]
    n_le, s_le = upto(centre)
    return centre * n_le - s_le + (s - s_le) - centre * (n - n_le)


def threshold_losses(x, y, w, loss: str, before: dict = EMPTY, after: dict = EMPTY, next_x: float | None = None):
    """Loss of both sides for every threshold of one strip.

    Returns (index of the last row on the left, threshold, loss, weight left, label sum
    left), rows sorted by ``x``.
    """
    ends = np.flatnonzero(np.append(x[1:] > x[:-1], next_x is not None))
    if not len(ends):
        return (np.empty(0, int),) + (np.empty(0),) * 4
    follow = np.append(x[1:], np.nan if next_x is None else next_x)[ends]
    cw, cs = np.cumsum(w), np.cumsum(w * y)
    n_l, s_l = before["n"] + cw[ends], before["s"] + cs[ends]
    n_r, s_r = after["n"] + cw[-1] - cw[ends], after["s"] + cs[-1] - cs[ends]
    total = np.empty(len(ends))
    i = 0
    while i < len(ends):
        first = ends[i - 1] + 1 if i else 0
        j = max(i + 1, int(np.searchsorted(ends, first + CHUNK_ROWS)))
        part, stop = ends[i:j], ends[j - 1] + 1
        left = np.arange(first, stop)[None, :] <= part[:, None]
        yc, wc = y[first:stop], w[first:stop]
        low = _Side(before, np.concatenate([before["y"], y[:first]]), np.concatenate([before["w"], w[:first]]))
        high = _Side(after, np.concatenate([after["y"], y[stop:]]), np.concatenate([after["w"], w[stop:]]))
        total[i:j] = _deviations(low, left, yc, wc, n_l[i:j], s_l[i:j], loss) + _deviations(
            high, ~left, yc, wc, n_r[i:j], s_r[i:j], loss
        )
        i = j
    return ends, (x[ends] + follow) / 2, total, n_l, s_l


def node_deviation(rows: DataFrame, by: list[str], loss: str) -> DataFrame:
    """(by..., whole): summed deviation of a node from its own centre; ``rows`` has y, w and the bucket yb."""
    total = rows.groupBy(*by).agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("s"))
    if loss == "mae":
        centre = total.select(*by, (F.col("s") / F.col("n")).alias("centre"))
    else:
        targets = total.select(*by, F.ceil(F.col("n") / 2).cast("bigint").alias("rank"))
        centre = rank_select(rows, by, "y", targets, "w", "yb").select(*by, F.col("value").alias("centre"))
    return rows.join(centre, by).groupBy(*by).agg(F.sum(F.col("w") * F.abs(F.col("y") - F.col("centre"))).alias("whole"))


def _reach(n, s, m, lo, hi, loss: str) -> dict:
    """Where the centres of a strip's thresholds can lie, given the rows outside it on one side."""
    if loss == "mae":
        mean = F.try_divide(s, n)
        drift = F.col(m) / (n + F.col(m))
        return {
            "least": mean - F.greatest(mean - F.col(lo), F.lit(0.0)) * drift - F.abs(mean) * 1e-9 - 1e-12,
            "most": mean + F.greatest(F.col(hi) - mean, F.lit(0.0)) * drift + F.abs(mean) * 1e-9 + 1e-12,
        }
    top = F.ceil((n + F.col(m)) / 2)
    return {"least": top - F.col(m), "most": top}


def _split_heads(freq: DataFrame, g: list[str]) -> DataFrame:
    """Strips numbered anew, so that a least value with more than STRIP_ROWS rows is a strip of its own."""
    values = freq.groupBy(*g, "i", "value").agg(F.count(F.lit(1)).alias("c"))
    heads = values.groupBy(*g, "i").agg(F.min(F.struct("value", "c")).alias("h"), F.count(F.lit(1)).alias("v"))
    heads = materialize(heads.filter((F.col("h.c") > STRIP_ROWS) & (F.col("v") > 1)).select(*g, "i", F.col("h.value").alias("head")))  # a row per strip at most
    if heads.isEmpty():
        return freq
    return freq.join(heads, [*g, "i"], "left").withColumn("i", 2 * F.col("i") + F.coalesce((F.col("value") > F.col("head")).cast("int"), F.lit(0))).drop("head")


def _single(freq: DataFrame, grid: DataFrame, g: list[str], loss: str) -> DataFrame:
    """The threshold behind every strip of one value, by sums over bands; ``grid`` has all strips and bands."""
    key = [*g, "i", "side"]
    ends = grid.filter("x_lo = x_hi and next_x is not null")
    n, s = F.col("um"), F.col("ums")
    parts = [
        ends.withColumns({"side": F.lit("l"), "n": n, "s": s, "zn": F.col("gn"), "zs": F.col("gs")}),
        ends.withColumns({"side": F.lit("r"), "n": F.col("tm") - n, "s": F.col("ts") - s, "zn": F.col("bn") - F.col("gn"), "zs": F.col("bs") - F.col("gs")}),
    ]
    at = parts[0].unionByName(parts[1]).filter(F.col("zn") > 0).select(*key, "yb", "n", "s", "zn", "zs", "b_lo", "b_hi")
    if loss == "mae":
        at = at.withColumn("centre", F.col("s") / F.col("n"))
        below, cut = F.col("b_hi") <= F.col("centre"), (F.col("b_lo") <= F.col("centre")) & (F.col("b_hi") > F.col("centre"))
    else:
        upto = F.sum("zn").over(Window.partitionBy(*key).orderBy("yb"))  # a row per band
        at = at.withColumns({"upto": upto, "half": F.ceil(F.col("n") / 2)}).withColumn("need", F.col("half") - (F.col("upto") - F.col("zn")))
        below, cut = F.col("upto") < F.col("half"), (F.col("upto") >= F.col("half")) & (F.col("need") > 0)
    at = materialize(at.withColumns({"below": below, "cut": cut}))  # strips times bands
    aim = "centre" if loss == "mae" else "need"
    cuts = at.filter("cut").select(*g, "yb", "side", F.col("i").alias("to"), aim)  # a row per strip and side
    inside = freq.join(cuts, [*g, "yb"]).filter("(side = 'l' and i <= to) or (side = 'r' and i > to)")
    inside = inside.groupBy(*g, F.col("to").alias("i"), "side", aim, "y").agg(F.sum("w").alias("w"))
    w, y = F.col("w"), F.col("y")
    if loss == "mae":
        inside = inside.filter(y <= F.col("centre")).groupBy(*key).agg(F.sum(w).alias("in_n"), F.sum(w * y).alias("in_s"))
    else:
        run = F.sum("w").over(Window.partitionBy(*key).orderBy("y"))  # the rows of one band
        inside = inside.withColumn("run", run).filter(F.col("run") - w < F.col("need"))
        inside = inside.groupBy(*key).agg(F.max("y").alias("centre"), F.sum(w).alias("in_n"), F.sum(w * y).alias("in_s"))
    sides = at.groupBy(*key, "n", "s", *(["centre"] if loss == "mae" else [])).agg(
        F.coalesce(F.sum(F.when(F.col("below"), F.col("zn"))), F.lit(0.0)).alias("nb"), F.coalesce(F.sum(F.when(F.col("below"), F.col("zs"))), F.lit(0.0)).alias("sb")
    )
    sides = sides.join(inside, key, "left")
    n_le, s_le = F.col("nb") + F.coalesce("in_n", F.lit(0.0)), F.col("sb") + F.coalesce("in_s", F.lit(0.0))
    c = F.col("centre")
    off = c * n_le - s_le + (F.col("s") - s_le) - c * (F.col("n") - n_le)
    both = sides.groupBy(*g, "i").agg(F.sum(off).alias("loss"))
    known = ends.select(*g, "i", "x_lo", "next_x", "um", "umr", "ums", "umq").distinct()
    return both.join(known, [*g, "i"]).select(
        *g, ((F.col("x_lo") + F.col("next_x")) / 2).alias("threshold"), "loss", F.col("um").alias("n_left"),
        F.col("umr").cast("bigint").alias("rows_left"), F.col("ums").alias("s_left"), F.col("umq").alias("q_left"),
    )


def candidates(long: DataFrame, by: list[str], loss: str) -> DataFrame:
    """Exact loss of every strip's best threshold.

    ``long`` has (by..., column, value, bucket, y, yb, w).  Result: (by..., column,
    threshold, loss, n_left, rows_left, s_left, q_left), one row per strip.
    """
    g = [*by, "column"]
    w, y = F.col("w"), F.col("y")
    freq = long.groupBy(*g, F.col("bucket").alias("i"), "value", "yb", "y").agg(F.sum(w).cast("double").alias("w"), F.count(F.lit(1)).alias("r"))
    freq = _split_heads(materialize(freq), g)  # read several times below
    strips = freq.groupBy(*g, "i").agg(
        F.sum(w).alias("m"), F.sum(w * y).alias("ms"), F.sum(w * y * y).alias("mq"), F.sum("r").alias("mr"),
        F.min(y).alias("y_lo"), F.max(y).alias("y_hi"), F.min("value").alias("x_lo"), F.max("value").alias("x_hi"),
    )
    order, whole = Window.partitionBy(*g).orderBy("i"), Window.partitionBy(*g)  # at most twice MOST_STRIPS rows
    upto = {f"u{c}": F.sum(c).over(order) for c in ("m", "ms", "mq", "mr")}
    strips = strips.withColumns(upto | {"next_x": F.lead("x_lo").over(order), "tm": F.sum("m").over(whole), "ts": F.sum("ms").over(whole)})
    strips = strips.withColumns(
        {"ln": F.col("um") - F.col("m"), "ls": F.col("ums") - F.col("ms"), "lq": F.col("umq") - F.col("mq"), "lr": F.col("umr") - F.col("mr"),
         "rn": F.col("tm") - F.col("um"), "rs": F.col("ts") - F.col("ums")}
    )
    # summary grid of strips x label bands, at most twice MOST_STRIPS^2 small rows per node and feature
    cells = freq.groupBy(*g, "i", "yb").agg(F.sum(w).alias("cn"), F.sum(w * y).alias("cs"))
    bands = freq.groupBy(*g, "yb").agg(F.sum(w).alias("bn"), F.sum(w * y).alias("bs"), F.min(y).alias("b_lo"), F.max(y).alias("b_hi"))
    grid = strips.join(bands, g).join(cells, [*g, "i", "yb"], "left").na.fill(0.0, ["cn", "cs"])
    along = Window.partitionBy(*g, "yb").orderBy("i")
    grid = grid.withColumns({"gn": F.sum("cn").over(along), "gs": F.sum("cs").over(along)})
    grid = materialize(grid)
    alone, several = _single(freq, grid, g, loss), F.col("x_lo") < F.col("x_hi")
    sides = []
    for side, n, s in (("l", F.col("ln"), F.col("ls")), ("r", F.col("rn"), F.col("rs"))):
        count = F.col("gn") - F.col("cn") if side == "l" else F.col("bn") - F.col("gn")
        total = F.col("gs") - F.col("cs") if side == "l" else F.col("bs") - F.col("gs")
        part = grid.filter(several).withColumns({"zn": count, "zs": total} | _reach(n, s, "m", "y_lo", "y_hi", loss)).filter(F.col("zn") > 0)
        if loss == "mae":
            below, inside = F.col("b_hi") < F.col("least"), (F.col("b_hi") >= F.col("least")) & (F.col("b_lo") <= F.col("most"))
        else:
            run = Window.partitionBy(*g, "i").orderBy("yb")
            part = part.withColumn("rank_hi", F.sum("zn").over(run))
            below = F.col("rank_hi") < F.col("least")
            inside = ~below & (F.col("rank_hi") - F.col("zn") < F.greatest(F.col("most"), F.lit(1)))
        sides.append(part.select(*g, "i", "yb", F.lit(side).alias("side"), "zn", "zs", below.alias("below"), inside.alias("inside")))
    sides = sides[0].unionByName(sides[1])
    far = sides.groupBy(*g, "i").agg(
        *[F.coalesce(F.sum(F.when((F.col("side") == x) & F.col("below"), F.col(f"z{c}"))), F.lit(0.0)).alias(f"{x}{c}b") for x in "lr" for c in "ns"]
    )
    wanted = sides.filter("inside").select(*g, "yb", "side", F.col("i").alias("to"))
    # one band may serve most strips: its rows are spread over pieces before they meet them
    piece = F.pmod(F.xxhash64("value", "y"), F.lit(8)).cast("int")
    band = (
        freq.withColumn("piece", piece)
        .join(wanted.withColumn("piece", F.explode(F.array(*[F.lit(p) for p in range(8)]))), [*g, "yb", "piece"])
        .filter(((F.col("side") == "l") & (F.col("i") < F.col("to"))) | ((F.col("side") == "r") & (F.col("i") > F.col("to"))))
        .groupBy(*g, F.col("to").alias("i"), "side", "y")
        .agg(F.sum(w).alias("w"))
    )
    band = band.select(*[F.col(c).alias(f"b_{c}") for c in band.columns])
    plain = ["next_x", "ln", "ls", "lq", "lr", "rn", "rs"]
    own = freq.join(strips.filter(several).select(*g, "i", *plain), [*g, "i"]).join(far, [*g, "i"], "left").na.fill(0.0, ["lnb", "lsb", "rnb", "rsb"])
    own = own.select(*g, "i", "value", "y", "w", "r", *plain, "lnb", "lsb", "rnb", "rsb")

    def best(own: pd.DataFrame, band: pd.DataFrame) -> pd.DataFrame:
        cols = [*g, "threshold", "loss", "n_left", "rows_left", "s_left", "q_left"]
        if own.empty:
            return pd.DataFrame(columns=cols)
        own = own.sort_values(["value", "y"], kind="stable")
        h = own.iloc[0]

        def outside(x):
            b = band[band["b_side"] == x]
            return {"n": h[f"{x}n"], "s": h[f"{x}s"], "nb": h[f"{x}nb"], "sb": h[f"{x}sb"], "y": b["b_y"].to_numpy(float), "w": b["b_w"].to_numpy(float)}

        v, yv, wv = (own[c].to_numpy(float) for c in ("value", "y", "w"))
        next_x = None if pd.isna(h["next_x"]) else float(h["next_x"])
        ends, at, total, n_l, s_l = threshold_losses(v, yv, wv, loss, outside("l"), outside("r"), next_x)
        if not len(ends):
            return pd.DataFrame(columns=cols)
        i = int(np.argmin(np.round(total, 9)))
        rows_left = int(h["lr"] + own["r"].to_numpy()[: ends[i] + 1].sum())
        q_left = float(h["lq"] + (wv * yv * yv)[: ends[i] + 1].sum())
        return pd.DataFrame([[*h[g], at[i], total[i], n_l[i], rows_left, s_l[i], q_left]], columns=cols)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*g).schema)
    schema = f"{types}, threshold double, loss double, n_left double, rows_left bigint, s_left double, q_left double"
    searched = own.groupBy(*g, "i").cogroup(band.groupBy(*[f"b_{c}" for c in (*g, "i")])).applyInPandas(best, schema)
    return searched.unionByName(alone)
