"""Near duplicates by BagMinHash over multisets of five-word shingles.

**Signature.**  A text is a multiset of shingles.  The weight axis is cut into dyadic
intervals (0, 1], (1, 2], (2, 4], ...; every (shingle, interval) pair owns a Poisson
process whose points have a time, one of ``BANDS * ROWS`` registers, and a unit cell of
the interval.  A shingle that occurs w times uses the points whose cell lies below w.
A register keeps its earliest point, so two texts agree in a register with probability
equal to their weighted Jaccard similarity.  Points are drawn in order of time and a
process stops as soon as its time passes the latest register, so a long text costs
little more than one draw per shingle.  All texts of a chunk are drawn together in
numpy.

**Search.**  Equal texts are one text.  Registers are grouped into bands; texts with
equal bands meet in buckets.  Of the texts in buckets, the shingles that no other such
text has are counted; they bound what a text can share with any partner, and texts that
cannot reach the threshold with anyone leave.  In a few turns every text is compared
with one leader of another class: that of the buckets it shares most with one leader.
Links found that way join a group of any size with a few comparisons per text.  Then
only buckets that still hold several classes are looked at: their pairs of different
classes that the bound allows are candidates, those whose registers put them ``SLACK``
below the threshold (over five standard errors) go, so do those whose parity sketches
differ in more bits than the texts may in tokens (every token flips one bit, so the bits
never differ more than the multisets do), and the rest is verified by the overlap of the
multisets.

A pair of the threshold similarity is missed by all bands with a probability of
(1 - 0.8^6)^36 = 2e-5.

**Classes** are the connected components of the links, found by alternating star
contraction over written edge tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import guarded, hidden, register, same, shown, table, text_key
from cloakwork.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 36, 6
PACKED = -(-BANDS * ROWS // 7)
SLACK = 0.16
PARITY = 8  # integers of 64 bits in a parity sketch; a join with more terms is a method too long to be compiled well
EDGES = 50_000  # links that one task contracts by itself
STARS, SPREAD = 4, 0.05  # turns of star links, and how far a turn may look past the best leader
CHUNK = 1 << 20  # bytes of text drawn together

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _step(i: int) -> np.uint64:
    return np.uint64(i * int(_GOLD) % (1 << 64))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_PLACE = mix(np.arange(301, 301 + SHINGLE, dtype=np.uint64) * _GOLD) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; words are parted by the six ASCII blanks."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(np.concatenate(([False], inside[:-1]))[at] == 0) - 1
    place = at - begin[word]
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(place.max()), _BASE))))
    first = np.flatnonzero(place == 0)
    sums = np.add.reduceat(_BYTE[raw[at]] * power[place], first)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return mix(sums), np.searchsorted(bounds, begin, side="right")


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count), sorted; a text of 1 to 4 words is one shingle."""
    words, doc = word_hashes(texts)
    n = len(words)
    if n >= SHINGLE:
        whole = np.flatnonzero(doc[: n - SHINGLE + 1] == doc[SHINGLE - 1 :])
        sh = np.zeros(len(whole), np.uint64)
        for k in range(SHINGLE):
            sh += words[whole + k] * _PLACE[k]
    else:
        whole, sh = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = doc[whole]
    sizes = np.bincount(doc, minlength=len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    short = [(d, (words[starts[d] : starts[d + 1]] * _PLACE[: sizes[d]]).sum(dtype=np.uint64)) for d in np.flatnonzero((sizes > 0) & (sizes < SHINGLE))]
    if short:
        owner = np.concatenate((owner, np.array([d for d, _ in short], dtype=owner.dtype)))
        sh = np.concatenate((sh, np.array([s for _, s in short], dtype=np.uint64)))
    sh = mix(sh)
    order = np.lexsort((sh, owner))
    owner, sh = owner[order], sh[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (sh[1:] != sh[:-1])))[: len(sh)]
    first = np.flatnonzero(new)
    return owner[first], sh[first], np.diff(np.concatenate((first, [len(sh)])))


def registers(doc: np.ndarray, sh: np.ndarray, count: np.ndarray, texts: int, m: int = BANDS * ROWS) -> np.ndarray:
    """Earliest time per text and register; infinite for texts without words."""
    h = np.full((texts, m), np.inf)
    parts, level = [], 0
    rest = np.ones(len(doc), dtype=bool)
    while rest.any():  # interval ``level`` is (low, low + width]
        low, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        parts.append((doc[rest], mix(sh[rest] + _step(level + 1)), count[rest] - low, np.full(int(rest.sum()), width)))
        rest = count > low + width
        level += 1
    if not parts:
        return h
    doc, seed, room, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    room, width, time = room.astype(np.uint64), width.astype(np.uint64), np.zeros(len(doc))
    flat, turn = h.reshape(-1), 0
    while len(doc):
        r = mix(seed + _step(turn))
        time = time - np.log1p(-(r >> np.uint64(11)).astype(np.float64) * 2.0**-53) / (width.astype(np.float64) * m)
        r = mix(r ^ _BASE)
        register_ = ((r >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        used = (((r & np.uint64(0xFFFFFFFF)) * width) >> np.uint64(32)) < room
        np.minimum.at(flat, (doc * m + register_.astype(np.int64))[used], time[used])
        turn += 1
        if turn < 4 or turn % 8 == 0:  # later points of a stopped process change nothing
            open_, back = np.unique(doc, return_inverse=True)
            stay = time < h[open_].max(axis=1)[back]
            doc, seed, room, width, time = doc[stay], seed[stay], room[stay], width[stay], time[stay]
    return h


def chunks(values: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes."""
    start, size = 0, 0
    for i, v in enumerate(values):
        size += len(v) + 1
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Stretches of batches of about CHUNK bytes of text, and their texts."""
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False) + 1) // CHUNK
        for first in np.flatnonzero(np.diff(size, prepend=-1)):
            n = int((size == size[first]).sum())
            yield batch.slice(first, n), [x or b"" for x in text.slice(first, n).to_pylist()]


def _lists(rows: np.ndarray) -> pa.Array:
    """A matrix as an array of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


SIGNED = "k1 long, k2 long, n long, bands array<long>, sketch array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, bands and sketch of each text, from rows (k1, k2, text); a chunk at a time."""
    place = mix(np.arange(701, 701 + ROWS, dtype=np.uint64) * _GOLD) | np.uint64(1)
    for part, values in _slices(batches):
        texts = len(values)
        doc, sh, count = shingles(values)
        bits = registers(doc, sh, count, texts).view(np.uint64)
        sizes = np.bincount(doc, weights=count, minlength=texts).astype(np.int64)
        bands = (bits.reshape(texts, BANDS, ROWS) * place).sum(axis=2, dtype=np.uint64)
        bands = mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD).view(np.int64)
        # a byte per register, seven to an integer that is never negative
        sketch = np.zeros((texts, PACKED * 7), np.uint64)
        sketch[:, : BANDS * ROWS] = mix(bits) >> np.uint64(56)
        sketch = (sketch.reshape(texts, PACKED, 7) << (np.arange(7, dtype=np.uint64) * np.uint64(8))).sum(axis=2, dtype=np.uint64).view(np.int64)
        ends = np.append(0, np.cumsum(np.where(sizes > 0, BANDS, 0))).astype(np.int32)  # no words, no bands
        kept = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[sizes > 0].ravel()))
        columns = [part.column("k1"), part.column("k2"), pa.array(sizes), kept, _lists(sketch)]
        yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n", "bands", "sketch"])


def _agreement(x: str, y: str) -> Column:
    """Share of equal registers in two sketches, in bit operations: zero bytes of the difference.

    Written as a loop: with a term for each integer the compiled join is too long a method for the JVM to speed up.
    """
    low = int.from_bytes(b"\x7f" * 7, "little")

    def equal(a: Column, b: Column) -> Column:
        diff = a.bitwiseXOR(b)
        return F.lit(56) - F.bit_count((diff.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(diff).bitwiseOR(F.lit(low)))

    padding = F.lit(-(PACKED * 7 - BANDS * ROWS))  # it is always equal
    return F.aggregate(F.zip_with(x, y, equal), padding, lambda a, b: a + b) / F.lit(float(BANDS * ROWS))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, and where each text's tokens end; the j-th occurrence of a shingle is a token of its own."""
    doc, sh, count = shingles(texts)
    copy = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    sizes = np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)
    return mix(np.repeat(sh, count) + copy.astype(np.uint64) * _GOLD), np.concatenate(([0], np.cumsum(sizes)))


def overlap(a: list[bytes], b: list[bytes]) -> list[float]:
    """Weighted Jaccard similarity of the pairs (a[i], b[i])."""
    known = {t: i for i, t in enumerate(dict.fromkeys([*a, *b]))}
    token, ends = tokens(list(known))
    out = []
    for x, y in zip(a, b, strict=True):
        s, t = (token[ends[known[v]] : ends[known[v] + 1]] for v in (x, y))
        both = len(np.intersect1d(s, t, assume_unique=True))
        out.append(both / max(len(s) + len(t) - both, 1))
    return out


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, root, token) from rows (k, root, text); a chunk at a time."""
    for part, values in _slices(batches):
        token, ends = tokens(values)
        owner = pa.array(np.repeat(np.arange(len(values)), np.diff(ends)))
        columns = [part.column("k").take(owner), part.column("root").take(owner), pa.array(token.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["k", "root", "token"])


def _parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, parity) from rows (k, text): bits that each token of the text flips one of."""
    width = PARITY * 64
    for part, values in _slices(batches):
        token, ends = tokens(values)
        owner = np.repeat(np.arange(len(values)), np.diff(ends))
        bit = (mix(token ^ _BASE) % np.uint64(width)).astype(np.int64)
        odd = np.bincount(owner * width + bit, minlength=len(values) * width).astype(np.uint8) & 1
        sketch = np.packbits(odd.reshape(len(values), width), axis=1, bitorder="little").view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column("k"), _lists(sketch)], ["k", "parity"])


def _differing(x: str, y: str) -> Column:
    """Bits in which two parity sketches differ: at most the tokens that only one of the texts has."""
    bits = [F.bit_count(F.get(F.col(x), F.lit(i)).bitwiseXOR(F.get(F.col(y), F.lit(i)))) for i in range(PARITY)]
    return sum(bits[1:], bits[0])


def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = ([v.encode("utf-8", "surrogatepass") for v in s] for s in (a, b))
    out: list[float] = []
    for s, e in chunks([p + q for p, q in zip(x, y, strict=True)]):
        out += overlap(x[s:e], y[s:e])
    return pd.Series(out, dtype=float)


def linked(pairs: DataFrame, texts: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Those of the (a, b) pairs whose multisets overlap enough, as a written table."""
    one = sketches.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sketches.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    near = pairs.join(one, "a").join(two, "b")
    near = near.filter((F.col("na") >= similarity * F.col("nb")) & (F.col("nb") >= similarity * F.col("na")))
    near = near.filter(_agreement("sa", "sb") >= similarity - SLACK).select("a", "b")
    both = near.join(texts.select(F.col("k").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("k").alias("b"), F.col("text").alias("tb")), "b")
    return materialize(both.filter(F.pandas_udf(_overlap, "double")("ta", "tb") >= similarity).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(k, root) for every end of the (a, b) edges; root is the least key of the component.

    At most EDGES of them are contracted in one task, without a shuffle for each step.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == state or not mark[0]:
            break
        state = mark
        if mark[0] <= EDGES:
            edges = edges.coalesce(1)
        # every larger neighbour is tied to the least of the neighbourhood, then every smaller one
        ways = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("u").alias("k"), F.col("v").alias("root"))
    return materialize(roots.union(edges.select(F.col("v").alias("k"), F.col("v").alias("root"))).distinct())


def _allowed(similarity: float) -> Column:
    """Sizes and unshared shingles of x and y leave room for the similarity."""
    most = F.least("x.most", "y.most")
    return most >= similarity * (F.col("x.n") + F.col("y.n") - most)


def _exploded(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, root, token) of the texts in ``roots`` (k, root), as a written table."""
    key = "struct<k1:long,k2:long>"
    return materialize(texts.join(roots, "k").select("k", "root", "text").mapInArrow(_tokens, f"k {key}, root {key}, token long"))


def _unshared(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, own): how many tokens of each text in ``roots`` (k, root) no text of another root in it has."""
    each = _exploded(texts, roots)
    lone = each.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 = r1").select("token")
    return each.join(lone, "token").groupBy("k").agg(F.count(F.lit(1)).alias("own"))


def _bounded(left: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Add ``most``, the tokens that a text can share with texts of other roots; texts that cannot reach anyone leave."""
    own = _unshared(texts, left.select("k", "root").distinct())
    left = left.join(own, "k", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
    return materialize(left.filter(F.col("most") >= similarity * F.col("n")))


def _stars(left: DataFrame, turn: int, similarity: float) -> DataFrame:
    """At most one pair (a, b) per text: with the leader of another class that it shares most buckets with.

    The text with the fewest unshared tokens leads a bucket, so it is close to many;
    every turn draws leaders anew among the better half.
    """
    order = F.struct((F.col("n") - F.col("most")) / F.col("n") + F.pmod(F.xxhash64("k", F.lit(turn)), F.lit(1000)) / 1000 * SPREAD * turn, "k")
    leaders = left.groupBy("band").agg(F.min(F.struct(order.alias("o"), "k", "root", "n", "most")).alias("l"))
    y = leaders.select("band", "l.k", "l.root", "l.n", "l.most").alias("y")
    met = left.alias("x").join(y, F.col("x.band") == F.col("y.band")).filter("x.root <> y.root").filter(_allowed(similarity))
    best = met.groupBy(F.col("x.k").alias("a"), F.col("y.k").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    best = best.groupBy("a").agg(F.max(F.struct("c", "b")).alias("m"))
    return materialize(best.select("a", F.col("m.b").alias("b")))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row (doc_id, k1, k2, root) per row of ``docs``; equal roots are one class.

    ``k1, k2`` stand for the text.  Texts without words are near only to equal ones;
    null counts as empty.  Rows equal in key and text are in the same class.  An empty
    table gives an empty one.
    """
    ids = docs.select(F.col(key).alias("doc_id"), *text_key(text))
    uniq = docs.select(*text_key(text), F.col(text).alias("text")).mapInArrow(_signed, SIGNED).dropDuplicates(["k1", "k2"])
    uniq = materialize(uniq.select(F.struct("k1", "k2").alias("k"), "n", "bands", "sketch"))
    bands = uniq.select("k", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("band")
    members = materialize(bands.join(buckets, "band", "left_semi"))
    wanted = materialize(members.select("k").distinct().select("k.*"))
    n = wanted.count()
    texts = docs.select(*text_key(text), F.col(text).alias("text")).join(guarded(wanted, n), ["k1", "k2"], "left_semi")
    texts = materialize(texts.dropDuplicates(["k1", "k2"]).select(F.struct("k1", "k2").alias("k"), "text"))
    sketches = uniq.select("k", "n", "sketch")
    left = members.join(sketches.select("k", "n"), "k").select("band", "k", "n", F.col("k").alias("root"))
    left = _bounded(left, texts, similarity)
    links = None
    for turn in range(STARS):
        found = linked(_stars(left, turn, similarity), texts, sketches, similarity)
        links = found if links is None else materialize(links.union(found))
        if found.isEmpty():
            break
        roots = components(links)
        left = left.drop("root").join(roots, "k", "left").withColumn("root", F.coalesce("root", "k"))
        mixed = left.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("band")
        left = materialize(left.join(mixed, "band", "left_semi"))
    left = _bounded(left.drop("most"), texts, similarity)
    open_ = texts.join(left.select("k").distinct(), "k", "left_semi")
    parity = materialize(open_.mapInArrow(_parity, "k struct<k1:long,k2:long>, parity array<long>"))
    left = left.join(uniq.select("k", "bands", "sketch"), "k").join(parity, "k").withColumn("at", F.array_position("bands", F.col("band")))
    x, y = left.alias("x"), left.alias("y")
    met = x.join(y, F.col("x.band") == F.col("y.band")).filter("x.k < y.k and x.root <> y.root")
    apart = (F.col("x.n") + F.col("y.n")) * F.lit((1 - similarity) / (1 + similarity) + 1e-9)  # tokens that only one of a near pair may have
    met = met.filter(_allowed(similarity)).filter(_differing("x.parity", "y.parity") <= apart)
    met = met.filter(_agreement("x.sketch", "y.sketch") >= similarity - SLACK)
    shared = F.array_position(F.zip_with("x.bands", "y.bands", lambda a, b: a == b), F.lit(True))
    met = met.filter((shared == 0) | (shared >= F.col("x.at")))  # a pair is formed in the first bucket that it shares
    pairs = materialize(met.select(F.col("x.k").alias("a"), F.col("y.k").alias("b")))
    more = linked(pairs, texts, sketches, similarity)
    roots = components(links.union(more))
    flat = roots.select(F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2"), "root")
    ids = ids.join(flat, ["k1", "k2"], "left")
    return materialize(ids.withColumn("root", F.coalesce("root", F.struct("k1", "k2"))).select("doc_id", "k1", "k2", "root"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class: the least key (null last), then the least text hash; the columns stay.

    Of rows equal in key and text one stays.
    """
    rows = classes(docs, key, text, similarity)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    each = rows.groupBy("root", "doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("c")).join(first, "root")
    goes = ~order.eqNullSafe(F.col("first"))
    marks = materialize(each.select("doc_id", "k1", "k2", goes.alias("goes"), "c").filter("goes or c > 1"))
    n = marks.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("goes")).alias("repeated")).first()
    plain, names = hidden(docs)
    named = plain.select("*", F.col(names[key]).alias("doc_id"), *text_key(names[text]))
    side = guarded(marks, n["n"])
    cols = ["k1", "k2", "doc_id"]
    kept = named.join(side, same(named, side, cols), "left_anti")
    if n["repeated"]:
        twice = marks.filter("not goes")
        kept = kept.unionByName(named.join(twice, same(named, twice, cols), "left_semi").dropDuplicates(cols))
    return shown(kept, names)


@register("op5_bag_minhash")
def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = classes(table(spark, folder, "documents").select("doc_id", "text"))
    of = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_rows"))
    return rows.join(of, "root").select("doc_id", "class_id", "class_rows")
