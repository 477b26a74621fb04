"""Personal data, and the terms that give it away.

Four kinds of personal data are found by their form.  Each distinct value is an entity.
A term that stands in the documents of an entity may reveal it even when the value
itself is masked: over the whole corpus the documents with the entity, with the term,
and with both are counted, wherever in the document they stand.  The term discloses the
entity when

    PMI(entity; term) >= DISCLOSURE * IC(entity),   IC(e) = log2(N / n(e)),
    PMI(e; t) = log2(n(e, t) * N / (n(e) * n(t)))

that is, when knowing the term tells (nearly) all there is to know about the entity,
and at least ``SUPPORT`` different texts say so.  Such terms are marked in every text
that holds them, with or without the entity, and generalised by :func:`sanitise`.

Term counts are combined per task before they are shuffled.  Terms meet entities only in
texts with an entity that ``SUPPORT`` texts have.  Few disclosing words travel to the
tasks as a set; beyond ``TOLD`` of them the words of the texts are joined with them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Collection, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import guarded, hidden, register, shown, table, text_key
from cloakwork.session import materialize

KINDS = ("email", "ip", "card", "phone")
NEAR = 8
DISCLOSURE = 0.95
SUPPORT = 2
HELD = 200_000  # terms counted by a task before it passes them on
SENT = 20_000  # (text, term) rows passed on together
TOLD = 50_000  # disclosing words that are sent to the tasks as a set

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), leftmost and non-overlapping per kind, by kind and start."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((0, start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def contexts(text: str, spans: list[tuple[int, int, int]]) -> dict[str, set[str]]:
    """Terms within NEAR words of each entity, outside all found values."""
    words = [(m.start(), m.end(), m[0].lower()) for m in _TERM.finditer(text)]
    words = [w for w in words if not any(s < w[1] and w[0] < e for _, s, e in spans)]
    out: dict[str, set[str]] = {}
    for kind, s, e in spans:
        before = [w for w in words if w[1] <= s][-NEAR:]
        after = [w for w in words if w[0] >= e][:NEAR]
        out.setdefault(f"{KINDS[kind]}:{text[s:e].lower()}", set()).update(w[2] for w in before + after)
    return out


def outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The terms of a text that touch none of the found values."""
    values, i, reach = sorted((s, e) for _, s, e in spans), 0, -1
    for m in _TERM.finditer(text):
        while i < len(values) and values[i][0] < m.end():
            reach = max(reach, values[i][1])
            i += 1
        if reach <= m.start():
            yield m


def _long(text: str) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def _longs(words: pd.Series) -> pd.Series:
    return words.map(_long)


EVIDENCE = "entity long, term long, k1 long, n long"


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (entity, term, k1, n): an entity (term null), a term count (entity null)."""
    names = [c.split()[0] for c in EVIDENCE.split(", ")]
    counted: Counter = Counter()

    def terms() -> pa.RecordBatch:
        term, n = pa.array([_long(t) for t in counted], pa.int64()), pa.array(list(counted.values()), pa.int64())
        none = pa.nulls(len(counted), pa.int64())
        counted.clear()
        return pa.RecordBatch.from_arrays([none, term, none, n], names)

    for batch in batches:
        entities, keys = [], []
        for k1, text in zip(batch.column("k1"), batch.column("text"), strict=True):
            text = text.as_py() or ""
            spans = base_spans(text)
            counted.update({m[0].lower() for m in outside(text, spans)})
            if len(counted) > HELD:
                yield terms()
            own = {f"{KINDS[k]}:{text[a:b].lower()}" for k, a, b in spans}
            entities += map(_long, own)
            keys += [k1.as_py()] * len(own)
        if keys:
            columns = [pa.array(entities, pa.int64()), pa.nulls(len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array([1] * len(keys), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
    if counted:
        yield terms()


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, word): the distinct terms of each text outside its values."""
    words, keys = [], []

    def send() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.string())], ["k1", "word"])
        words.clear()
        keys.clear()
        return out

    for batch in batches:
        for k1, text in zip(batch.column("k1"), batch.column("text"), strict=True):
            text = text.as_py() or ""
            own = {m[0].lower() for m in outside(text, base_spans(text))}
            words += own
            keys += [k1.as_py()] * len(own)
            if len(words) > SENT:
                yield send()
    if words:
        yield send()


def disclosing(docs: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(word): the distinct terms that disclose an entity; written."""
    rows = docs.select(text_key(text)[0], F.col(text).alias("text"))
    seen = materialize(rows.mapInArrow(_evidence, EVIDENCE))
    total = docs.count()
    held = materialize(seen.filter("term is null").groupBy("entity", "k1").agg(F.sum("n").alias("n")))
    entities = held.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
    entities = materialize(entities.filter(F.col("texts") >= support).drop("texts"))
    held = materialize(held.join(guarded(entities.select("entity"), entities.count()), "entity", "left_semi"))
    texts = materialize(held.select("k1").distinct())
    words = rows.join(guarded(texts, texts.count()), "k1", "left_semi").mapInArrow(_terms, "k1 long, word string").distinct()
    pairs = held.join(words, "k1").groupBy("entity", "word").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("texts"))
    pairs = pairs.filter(F.col("texts") >= support)
    pairs = materialize(pairs.withColumn("term", F.pandas_udf(_longs, "long")("word")))
    asked = materialize(pairs.select("term").distinct())
    # added up before the join: a task's counts are many rows per term, the sums are one; a semi join would be
    # moved below the sums again
    counts = seen.filter("entity is null").groupBy("term").agg(F.sum("n").alias("n_term"))
    counts = counts.join(guarded(asked, asked.count()), "term")
    told = pairs.join(counts, "term").join(entities, "entity")
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    return materialize(told.filter((information > 0) & (shared >= disclosure * information)).select("word").distinct())


def all_spans(text: str, terms: Collection[str] | None) -> list[tuple[int, int, int]]:
    """Base spans and the places of disclosing terms (kind 4), by kind and start."""
    base = base_spans(text)
    if terms is None or not len(terms):
        return base
    wanted = terms if isinstance(terms, frozenset) else set(terms)
    return base + [(4, m.start(), m.end()) for m in outside(text, base) if m[0].lower() in wanted]


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_terms long, clean string"


def _report(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    names = (*KINDS, "term")
    for texts, lists in batches:
        rows = []
        for text, terms in zip(texts, lists, strict=True):
            text = text or ""
            every = all_spans(text, terms)
            told = [f"{names[k]}:{s}:{e}" for k, s, e in every]
            base = [t for t, x in zip(told, every, strict=True) if x[0] < 4]
            counts = [sum(x[0] == k for x in every) for k in range(4)]
            clean, at = [], 0
            for k, s, e in sorted(every, key=lambda x: (x[1], x[0])):
                if s >= at:
                    clean += [text[at:s], f"<{names[k]}>"]
                at = max(at, e)
            clean = "".join(clean) + text[at:] if every else None
            rows.append((*counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(told), len(every) - len(base), clean))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts, digest and places of personal data, and ``clean``: the sanitised text (null where nothing is masked).

    A null text is an empty one.  Equal texts get equal answers.  Columns named like
    the added ones are replaced.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    told = disclosing(docs, text)
    df = docs.drop(*names)
    if told.count() <= TOLD:
        every = docs.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in told.collect()))

        def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            return _report((texts, [every.value] * len(texts)) for texts in batches)

        return df.withColumn("_r", F.pandas_udf(report, SCHEMA)(text)).select("*", "_r.*").drop("_r")
    rows = docs.select(text_key(text)[0], F.col(text).alias("text")).mapInArrow(_terms, "k1 long, word string").distinct()
    marks = materialize(rows.join(told, "word").groupBy("k1").agg(F.array_sort(F.collect_set("word")).alias("terms")))
    df = df.withColumn("_k", text_key(text)[0])
    side = guarded(marks.select(F.col("k1").alias("_k"), F.col("terms").alias("_terms")), marks.count())
    return df.join(side, "_k", "left").withColumn("_r", F.pandas_udf(_report, SCHEMA)(text, "_terms")).select("*", "_r.*").drop("_k", "_terms", "_r")


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace personal data and disclosing terms by the name of their kind; the columns stay."""
    plain, names = hidden(docs)
    df = find(plain, names[text])
    return shown(df.withColumn(names[text], F.coalesce("clean", names[text])), names)


@register("op4_disclosing_terms")
def query(spark: SparkSession, folder: str) -> DataFrame:
    return find(table(spark, folder, "documents").select("doc_id", "text")).drop("text", "clean")
