"""How far the sources of a language are apart, by chunk factorization.

Texts are counted in chunks between blanks, A-Z lower-cased and without the ASCII
characters at their ends that no term has.  A chunk that stands in a million texts is
taken apart into terms once: tasks pass on (language, chunk) counts, a number for each
source beside them, the distinct chunks of the whole corpus are tokenized, and their
terms are joined back to the counts.  A term's occurrences are the sum over its chunks.

The documents of a term are those of its chunks together, each counted once.  For the
question whether there are ``least`` of them the sizes of the chunks mostly decide: one
chunk with as many documents says yes, fewer in all chunks together says no.  Only for
terms in between the document numbers are compared, and such a chunk has fewer than
``least`` of them, which its counts carry along.  No text and no (document, term) row
is shuffled.

All shares are whole numbers of 1e-9 and are worked out in exact integers.  The value
of two sources is summed over whole rows of shares, one row per term with a share for
each source of the language; a task keeps one number per pair of sources, the answer's
own size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cloakwork.llm.common import guarded, register, table, word_lists
from cloakwork.session import materialize

LEAST, TOP = 10, 10
UNIT = 1_000_000_000
HELD, HELD_WORDS = 5_000_000, 700_000  # occurrences that a task keeps before it adds them up, and different words
HELD_BYTES = 1 << 25  # of these words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BARE = bytes(c for c in range(128) if not chr(c).isalpha())
COUNTS = "lang string, chunk string, docs long, ids array<long>, sources array<string>, n array<long>"


class Chunks(dict):
    """Numbers of words by their chunk; a word without a chunk is 0."""

    def __init__(self) -> None:
        super().__init__()
        self.numbers: dict[bytes, int] = {b"": 0}
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        chunk = word.strip(BARE)
        self[word] = n = self.numbers.setdefault(chunk, len(self.numbers))
        self.size += len(word)
        return n


class Held:
    """Occurrences of one language: their chunks in order, and row, source and length of each text."""

    def __init__(self) -> None:
        self.chunks, self.found = Chunks(), []
        self.rows, self.sources, self.lengths = [], [], []

    def add(self, row: int, source: str, text: str) -> int:
        n = 0
        for words in word_lists(text, lower=True):
            self.found.append(np.fromiter(map(self.chunks.__getitem__, words), np.int32, len(words)))
            n += len(words)
        self.rows.append(row)
        self.sources.append(source)
        self.lengths.append(n)
        return n

    def summed(self, lang: str, least: int) -> pa.RecordBatch:
        """A row per chunk: its documents, their numbers while few, its occurrences by source."""
        code = np.concatenate(self.found) if self.found else np.zeros(0, np.int32)
        doc = np.repeat(np.arange(len(self.rows), dtype=np.int32), self.lengths)
        order = np.argsort(code, kind="stable")  # the texts of a chunk stay in order
        code, doc = code[order], doc[order]
        first = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        n = np.diff(np.append(first, len(code)))
        code, doc = code[first], doc[first]
        n, doc, code = n[code > 0], doc[code > 0], code[code > 0]
        chunk, docs = np.unique(code, return_counts=True)
        few = np.repeat(docs < least, docs)
        rows = np.array(self.rows, np.int64)[doc[few]]
        names, source = np.unique(np.array(self.sources, dtype=object), return_inverse=True)
        pair, back = np.unique(code.astype(np.int64) * len(names) + source[doc], return_inverse=True)
        sums = np.bincount(back, n, len(pair)).astype(np.int64)
        held = np.searchsorted(pair // len(names), np.append(chunk, np.iinfo(np.int32).max)).astype(np.int32)
        ends = np.append(0, np.cumsum(np.where(docs < least, docs, 0))).astype(np.int32)
        texts = pa.array(list(self.chunks.numbers), pa.binary()).take(pa.array(chunk)).cast(pa.string())
        columns = [
            pa.array([lang] * len(chunk), pa.string()),
            texts,
            pa.array(docs.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(rows)),
            pa.ListArray.from_arrays(pa.array(held), pa.array(names.tolist(), pa.string()).take(pa.array(pair % len(names)))),
            pa.ListArray.from_arrays(pa.array(held), pa.array(sums)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "docs", "ids", "sources", "n"])


def _counted(least: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Held] = {}
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                lang, source, row, text = (batch.column(c)[i].as_py() for c in ("lang", "source", "row", "text"))
                own = held.setdefault(lang, Held())
                size += own.add(row, source, text)
                words = sum(len(h.chunks) for h in held.values()) if len(own.chunks) > HELD_WORDS // 8 else 0
                if size >= HELD or words >= HELD_WORDS or own.chunks.size >= HELD_BYTES:
                    yield from (h.summed(name, least) for name, h in held.items())
                    held, size = {}, 0
        yield from (h.summed(name, least) for name, h in held.items())

    return count


def chunk_terms(parts: DataFrame) -> DataFrame:
    """(chunk, langs, terms): of each distinct chunk its documents by language, and its terms, repeated ones repeatedly."""
    # tasks have counted before; a chunk has one row per language and task, so none is hot
    by_lang = parts.select("chunk", "lang", "docs").repartition("chunk").groupBy("chunk", "lang").agg(F.sum("docs").alias("docs"))
    each = by_lang.groupBy("chunk").agg(F.collect_list(F.struct("lang", "docs")).alias("langs"))
    return each.withColumn("terms", F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0)))


def term_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Written (lang, source, term, count) of the kept terms, and written (lang, term) of all kept ones.

    ``docs`` has (lang, source, text) without nulls; rows, not keys, are documents.
    """
    rows = docs.select("lang", "source", F.monotonically_increasing_id().alias("row"), "text")
    # row numbers live in this one written table only, so a repeated task cannot mix them up
    parts = materialize(rows.mapInArrow(_counted(least), COUNTS))
    chunks = materialize(chunk_terms(parts))
    each = chunks.withColumn("of", F.explode("langs")).select("chunk", "of.lang", "of.docs", "terms")
    bounds = each.withColumn("term", F.explode(F.array_distinct("terms"))).groupBy("lang", "term").agg(F.max("docs").alias("most"), F.sum("docs").alias("all"))
    bounds = materialize(bounds.filter(F.col("all") >= least))
    between = bounds.filter(F.col("most") < least).select("lang", "term")
    pairs = each.select("lang", "chunk", F.explode("terms").alias("term"))
    some = each.filter(F.col("docs") < least).select("lang", "chunk", F.explode(F.array_distinct("terms")).alias("term"))
    few = materialize(some.join(guarded(between, between.count()), ["lang", "term"]))
    few = parts.filter(F.col("docs") < least).select("lang", "chunk", "ids").join(guarded(few, few.count()), ["lang", "chunk"])
    few = few.select("lang", "term", F.explode("ids").alias("row")).distinct().groupBy("lang", "term").agg(F.count(F.lit(1)).alias("all"))
    kept = materialize(bounds.filter(F.col("most") >= least).select("lang", "term").unionByName(few.filter(F.col("all") >= least).select("lang", "term")))
    wanted = pairs.join(guarded(kept, kept.count()), ["lang", "term"]).groupBy("lang", "chunk", "term").agg(F.count(F.lit(1)).alias("k"))
    wanted = materialize(wanted)
    met = parts.select("lang", "chunk", "sources", "n").join(guarded(wanted, wanted.count()), ["lang", "chunk"])
    each = met.withColumn("of", F.explode(F.arrays_zip("sources", "n"))).select("lang", F.col("of.sources").alias("source"), "term", (F.col("of.n") * F.col("k")).alias("n"))
    return materialize(each.groupBy("lang", "source", "term").agg(F.sum("n").alias("count"))), kept


def share(count: Column, n: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (n + 2 * terms)), in integers of 38 digits."""
    top = (count.cast("decimal(20,0)") + 2) * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", top, (n + 2 * terms).cast("decimal(20,0)"))


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, i, j, value): the values of the sources i < j over all rows of the task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in set(langs):
            shares = batch.column("shares").filter(pa.array(langs == lang)).flatten().to_numpy()
            shares = shares.reshape(int((langs == lang).sum()), -1)
            width = shares.shape[1]
            total = sums.setdefault(lang, np.zeros((width, width), np.int64))
            for i in range(width - 1):
                p, q = shares[:, i : i + 1], shares[:, i + 1 :]
                total[i, i + 1 :] += ((p - q) * (p - q) // (p + q)).sum(axis=0)
    for lang, total in sums.items():
        for i in range(len(total) - 1):
            j = np.arange(i + 1, len(total), dtype=np.int32)
            columns = [pa.array([lang] * len(j), pa.string()), pa.array(np.full(len(j), i, np.int32)), pa.array(j), pa.array(total[i, i + 1 :])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "i", "j", "value"])


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and by which terms.

    Part ``pair`` has a row for every other source of the language; its value is the sum
    over all kept terms of floor((p - q)^2 / (p + q)), 0 where none is kept.  Part
    ``term`` has the ``top`` terms that the source uses more than its language does.
    Kept are the terms in ``least`` documents of the language.  Nulls count as empty
    texts, every row is a document (repeated ones too), groups without any term take
    part, ties are ranked by the item's bytes.  An empty table gives no rows; chunks of
    any length are handled; other columns are not looked at.
    """
    names = {"lang": lang, "source": source, "text": text}
    docs = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in names.items()])
    counts, kept = term_counts(docs, least)
    groups = materialize(docs.select("lang", "source").distinct())
    groups = groups.join(counts.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
    groups = groups.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left")
    groups = materialize(groups.fillna(0, ["n", "terms"]))
    size = groups.count()
    listed = F.array_sort(F.collect_list(F.struct("source", "n")))
    langs = materialize(groups.groupBy("lang").agg(listed.alias("groups"), F.sum("n").alias("n_lang"), F.max("terms").alias("terms")))

    # a row per kept term: its share in every source of the language
    held = F.map_from_entries(F.collect_list(F.struct("source", "count")))
    wide = counts.groupBy("lang", "term").agg(held.alias("held")).join(guarded(langs, size), "lang")
    filled = lambda g: share(F.coalesce(F.try_element_at("held", g["source"]), F.lit(0)), g["n"], F.col("terms"))
    sums = wide.select("lang", F.transform("groups", filled).alias("shares")).mapInArrow(_pair_sums, "lang string, i int, j int, value long")
    sums = materialize(sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))
    ends = langs.select("lang", F.posexplode("groups").alias("a", "from"), "groups").select("lang", "a", F.col("from.source").alias("source"), F.posexplode("groups").alias("b", "to"))
    ends = ends.filter("a <> b").select("lang", "source", F.col("to.source").alias("item"), F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"))
    pairs = ends.join(sums, ["lang", "i", "j"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    whole = counts.groupBy("lang", "term").agg(F.sum("count").alias("all"))
    narrow = guarded(groups.join(langs.select("lang", "n_lang"), "lang"), size)
    used = counts.join(whole, ["lang", "term"]).join(narrow, ["lang", "source"])
    used = used.withColumns({"p": share(F.col("count"), F.col("n"), F.col("terms")), "q": share(F.col("all"), F.col("n_lang"), F.col("terms"))})
    used = used.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", place).unionByName(used.withColumn("rank", place).filter(F.col("rank") <= top))


SQL = rf"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as w from documents),
g as (select distinct lang, source from d),
t as (select r, lang, source, unnest(w) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct r) >= {LEAST}),
c as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
v as (select lang, count(*) as v from kept group by lang),
gn as (select lang, source, coalesce(sum(n), 0) as n from g left join c using (lang, source) group by all),
ln as (select lang, coalesce(sum(n), 0) as n from gn group by lang),
lc as (select lang, term, sum(n) as n from c group by all),
p as (
  select k.lang, g.source, k.term, coalesce(c.n, 0) as cnt,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (gn.n + 2 * v.v) as p,
    1 + (1000000000::hugeint * (lc.n + 2)) // (ln.n + 2 * v.v) as q
  from kept as k join g on g.lang = k.lang join v on v.lang = k.lang join lc on lc.lang = k.lang and lc.term = k.term
  join gn on gn.lang = k.lang and gn.source = g.source join ln on ln.lang = k.lang
  left join c on c.lang = k.lang and c.source = g.source and c.term = k.term),
pv as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p as a join p as b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pr as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pv.value, 0) as value
  from g as a join g as b on a.lang = b.lang and a.source <> b.source
  left join pv on pv.lang = a.lang and pv.source = a.source and pv.item = b.source),
tr as (
  select lang, source, 'term' as part, term as item, (p - q) * (p - q) // (p + q) as value from p where cnt > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank
  from (select * from pr union all select * from tr))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= {TOP}
"""


@register("op12_divergence", SQL)
def query(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
