"""Benchmark decontamination by a broadcast set of test n-grams.

Every window of ``n`` consecutive words of a test item is hashed; the set of hashes
travels with the plan to every task.  Training texts are cut into words, all their
windows are hashed inside the row, hits are compared word by word, and the covered
words are counted.  Nothing of the corpus is shuffled to decide about a text.

An item of fewer than ``n`` words is one window of its own length.  Beyond
``SET_WINDOWS`` windows the set is no longer sent to the tasks; window hashes are
joined instead (:func:`_hits_by_join`), with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import hidden, register, shown, table
from cloakwork.session import materialize

N = 13
SET_WINDOWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and non-ASCII characters; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _glued(a: str, b: str, step: int) -> Column:
    """Hashes of windows of a's length followed, ``step`` words on, by windows of b's length."""
    n = F.greatest(F.lit(0), F.size(b) - step)
    return F.zip_with(F.slice(F.col(a), F.lit(1), n), F.slice(F.col(b), F.lit(step + 1), n), lambda x, y: F.xxhash64(x, y))


def window_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``_w<length>``: the hash of every window, from hashes of 1, 2, 4, 8, ... words."""
    df = df.withColumn("_p1", F.transform("_words", lambda w: F.xxhash64(w)))
    power = 1
    while power * 2 <= max(lengths, default=0):
        df = df.withColumn(f"_p{2 * power}", _glued(f"_p{power}", f"_p{power}", power))
        power *= 2
    for length in lengths:
        parts = [p for p in (1 << k for k in range(length.bit_length())) if length & p][::-1]
        df, done = df.withColumn(f"_w{length}", F.col(f"_p{parts[0]}")), parts[0]
        for p in parts[1:]:
            df, done = df.withColumn(f"_w{length}", _glued(f"_w{length}", f"_p{p}", done)), done + p
    return df.drop(*[c for c in df.columns if c.startswith("_p") and c[2:].isdigit()])


def test_windows(items: DataFrame, item: str = "item_id", text: str = "text", n: int = N) -> DataFrame:
    """Distinct (length, hash, words, item) of all windows of the test items."""
    df = items.select(F.col(item).alias("item"), words(text).alias("_words"))
    df = df.withColumn("length", F.least(F.lit(n), F.size("_words"))).filter("length > 0")
    df = df.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("_words") - F.col("length") + 1)))
    df = df.withColumn("_words", F.slice("_words", F.col("at"), F.col("length")))
    lengths = list(range(1, n + 1))  # a window has one of n lengths; its own is picked
    df = window_hashes(df, lengths)
    pick = F.coalesce(*[F.when(F.col("length") == k, F.get(f"_w{k}", F.lit(0))) for k in lengths])
    return df.select("length", pick.alias("hash"), F.array_join("_words", " ").alias("window"), "item").distinct()


def _literals(values: list) -> str:
    return ",".join(f"'{v}'" if isinstance(v, str) else f"{v}L" for v in values)


def _hits_by_set(df: DataFrame, found: list, lengths: list[int]) -> DataFrame:
    """Add ``_hits``, an array of (at, length, window), from sets that travel with the plan."""
    parts = []
    for length in lengths:
        hashes = _literals(sorted({r["hash"] for r in found if r["length"] == length}))
        texts = _literals(sorted({r["window"] for r in found if r["length"] == length}))
        places = f"filter(transform(_w{length}, (h, i) -> if(h in ({hashes}), i, null)), i -> i is not null)"
        cut = f"transform({places}, i -> named_struct('at', i, 'length', {length}, 'window', array_join(slice(_words, i + 1, {length}), ' ')))"
        parts.append(F.expr(f"filter({cut}, x -> x.window in ({texts}))"))
    none = F.expr("cast(array() as array<struct<at:int,length:int,window:string>>)")
    return df.withColumn("_hits", F.concat(*parts) if parts else none)


def _hits_by_join(df: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """The same by joins, for sets of any size: narrow (row, place, hash) rows are shuffled, texts are not repeated."""
    cols = [c for c in df.columns if not c.startswith("_w")]
    rows = materialize(df.select(*cols, "_words").withColumn("_row", F.monotonically_increasing_id()))
    hashed = window_hashes(rows.select("_row", "_words"), lengths)
    each = [F.expr(f"transform(_w{k}, (h, i) -> named_struct('at', i, 'length', {k}, 'hash', h))") for k in lengths]
    places = hashed.select("_row", F.explode(F.concat(*each)).alias("_p")).select("_row", "_p.*")
    maybe = places.join(windows.select("length", "hash").distinct(), ["length", "hash"], "left_semi")
    maybe = maybe.groupBy("_row").agg(F.collect_list(F.struct("at", "length")).alias("_maybe"))
    cut = rows.select("_row", "_words").join(maybe, "_row").withColumn("_p", F.explode("_maybe"))
    cut = cut.select("_row", "_p.*", F.array_join(F.slice("_words", F.col("_p.at") + 1, F.col("_p.length")), " ").alias("window"))
    hits = cut.join(windows.select("window").distinct(), "window", "left_semi")
    hits = hits.groupBy("_row").agg(F.collect_list(F.struct("at", "length", "window")).alias("_hits"))
    none = F.expr("cast(array() as array<struct<at:int,length:int,window:string>>)")
    return rows.join(hits, "_row", "left").withColumn("_hits", F.coalesce("_hits", none)).drop("_row")


def annotate(docs: DataFrame, windows: DataFrame, text: str = "text", set_windows: int = SET_WINDOWS) -> DataFrame:
    """Add ``n_words``, ``hit_words`` (covered word positions) and ``hit_windows`` (texts) to every row.

    Rows with a null or empty text have no words and no hits; equal rows get equal
    answers; an empty test table hits nothing.  Columns named like the added ones are
    replaced.
    """
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most n
    few = windows.select("length", "hash", "window").distinct().limit(set_windows + 1)
    found = few.collect()  # at most set_windows + 1 rows; more takes the other way
    df = docs.drop("n_words", "hit_words", "hit_windows").withColumn("_words", words(text))
    if len(found) <= set_windows:
        df = _hits_by_set(window_hashes(df, lengths), found, lengths)
    else:
        df = _hits_by_join(df, windows, lengths)
    covered = F.array_distinct(F.flatten(F.transform("_hits", lambda x: F.sequence(x["at"], x["at"] + x["length"] - 1))))
    df = df.withColumns({"n_words": F.size("_words").cast("bigint"), "hit_words": covered, "hit_windows": F.array_distinct("_hits.window")})
    return df.drop("_words", "_hits", *[f"_w{k}" for k in lengths])


def contaminated(df: DataFrame) -> Column:
    """A twentieth of the words or more is covered."""
    n_hit = F.size("hit_words")
    return (n_hit > 0) & (n_hit * 20 >= F.col("n_words"))


def drop_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Remove contaminated rows; the columns stay as they are."""
    plain, names = hidden(docs)
    df = annotate(plain, materialize(test_windows(items)), names[text])
    # the row number keeps the test where it is; moved below, it would hash every window many times over
    df = df.withColumn("_row", F.monotonically_increasing_id())
    return shown(df.filter((F.col("_row") >= 0) & ~contaminated(df)), names)


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Cut the covered words out of the texts; what stands between the words stays."""
    plain, names = hidden(docs)
    value = names[text]
    df = annotate(plain, materialize(test_windows(items)), value)
    pieces = F.regexp_extract_all(F.col(value), F.lit(PIECES), F.lit(0))
    first = F.when(F.regexp_like(F.col(value), F.lit(rf"^{PIECES.split('|')[0]}")), 0).otherwise(1)
    keep = F.filter(pieces, lambda p, i: (i % 2 != first) | ~F.array_contains("hit_words", F.floor(i / 2).cast("int")))
    return shown(df.withColumn(value, F.when(F.size("hit_words") > 0, F.array_join(keep, "")).otherwise(F.col(value))), names)


SQL = rf"""
with dw as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w from benchmark),
win as (
  select distinct item_id, least({N}, len(w)) as m, array_to_string(w[i:i + least({N}, len(w)) - 1], ' ') as t
  from (select *, unnest(range(1, greatest(1, len(w) - {N - 1}) + 1)) as i from iw where len(w) > 0)),
occ as (
  select d.r, d.i, win.m, win.item_id from
    (select r, m, i, array_to_string(w[i:i + m - 1], ' ') as t
     from (select r, w, m, unnest(range(1, len(w) - m + 2)) as i
           from dw, (select distinct m from win) as ms where len(w) >= m)) as d
  join win using (m, t)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + m)) as p from occ) group by r),
its as (
  select r, count(*) as n_items, string_agg(s, ',' order by s) as ids
  from (select distinct r, cast(item_id as varchar) as s from occ) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join hit using (r) left join its using (r)
"""


@register("op10_decontamination", SQL)
def query(spark: SparkSession, folder: str) -> DataFrame:
    windows = materialize(test_windows(table(spark, folder, "benchmark")))
    df = annotate(table(spark, folder, "documents"), windows)
    df = df.select("doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"), contaminated(df).alias("contaminated"), "hit_windows")
    df = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("window", F.explode_outer("hit_windows"))
    items = windows.filter(F.col("item").isNotNull()).select("window", F.col("item").cast("string").alias("item"))
    ids = F.array_sort(F.collect_set("item"))
    df = df.join(items, "window", "left").groupBy("_row", "doc_id", "n_words", "n_hit", "contaminated").agg(ids.alias("ids"))
    return df.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )
