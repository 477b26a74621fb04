"""Substring deduplication over sliding runs of sentences.

Sentences of more than ``LONG`` words are cut into pieces: after the word of least hash
in each window of ``WINDOW`` words, so that a passage is cut alike wherever it stands,
but for ``WINDOW - 1`` words at its ends.  A run starts at every piece and takes as many
as needed to hold two pieces and ``WORDS`` words.  All runs are hashed; a hash that
occurs more than once anywhere has a first occurrence (least key, text, place), and
every piece covered by another occurrence is removed.

A passage of 51 words always shares a run, also when it starts and ends inside a
sentence: its first piece border in common comes after 15 words at most, the last one
14 words before the end at least, and the 22 words between hold a run, since a run that
starts at a border ends after at most two pieces of ``LONG`` words.

Only (hash, key, place) rows are shuffled, combined on the map side first; a passage
that a third of the texts share is one hash with one first occurrence.  Texts are read
again to be cut, not shuffled, while the list of cuts is small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import guarded, hidden, register, same, table, text_key
from cloakwork.llm.near import mix
from cloakwork.session import materialize

PIECES, WORDS, LONG, WINDOW = 2, 12, 11, 8
CHUNK = 1 << 18  # characters of text cut together
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse
_BLANK = np.array([c for c in range(0x3001) if re.match(r"\s", chr(c))], np.uint32)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2^64."""
    bases = (_BASE, pow(_BASE, -1, 1 << 64))
    up, down = (np.cumprod(np.append(np.uint64(1), np.full(n, x, np.uint64))) for x in bases)
    return up, down


def _hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from begin to end: a polynomial of the values, wherever the stretch stands."""
    total = np.append(np.uint64(0), np.cumsum(values * up[: len(values)]))
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _words(codes: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, start, end and number of the sentence of every word; stops belong to the word or sentence before them."""
    stop = (codes == 46) | (codes == 33) | (codes == 63)
    letter = ~(stop | np.isin(codes, _BLANK))
    edge = np.diff(np.concatenate(([0], letter.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    edge = np.diff(np.concatenate(([0], stop.view(np.int8), [0])))
    first, final = np.flatnonzero(edge == 1), np.append(np.flatnonzero(edge == -1), 0)
    after = np.append(start[1:], len(codes))
    run = np.searchsorted(first, end)  # the next stops after the word
    first = np.append(first, len(codes) + 1)
    line = np.append(np.flatnonzero(codes == 10), len(codes) + 1)
    line = line[np.searchsorted(line, end)]
    ended = (first[run] < after) & (first[run] < line)
    bare = np.where(first[run] == end, final[run], end)
    hashes = _hashes(codes.astype(np.uint64), start, bare, up, down)
    closed = ended | (line < after)
    sentence = np.concatenate(([0], np.cumsum(closed[:-1])))
    return hashes, start, np.where(ended, final[run], end), sentence


def _cuts(hashes: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Numbers of the words that end a piece."""
    last = np.append(sentence[1:] != sentence[:-1], True)
    if len(hashes) >= WINDOW:
        long = np.bincount(sentence)[sentence] > LONG
        first = np.flatnonzero((sentence[: 1 - WINDOW] == sentence[WINDOW - 1 :]) & long[: 1 - WINDOW])
        windows = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)[first]
        last[first + WINDOW - 1 - windows[:, ::-1].argmin(axis=1)] = True  # of equal words the last
    return np.flatnonzero(last)


def all_runs(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Number of the text, hash, start and end of the run that starts at each piece, where the text holds a full one."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    up, down = _powers(len(codes))
    hashes, starts, ends, sentence = _words(codes, up, down)
    if not len(hashes):
        return (np.zeros(0, np.int64),) * 4
    origin = np.cumsum([0, *(len(x) + 1 for x in texts)])
    place = np.searchsorted(origin, starts, side="right") - 1
    final = _cuts(hashes, sentence)
    begin = np.append(0, final[:-1] + 1)  # of the pieces, in words
    inner = (begin > 0) & (sentence[begin] == sentence[begin - 1])
    at = np.where(inner, ends[begin - 1], starts[begin])
    border = np.append(begin, len(hashes))
    after = np.maximum(np.searchsorted(border, begin + WORDS), np.arange(len(begin)) + PIECES)
    i = np.flatnonzero(after <= np.searchsorted(place[begin], place[begin], side="right"))
    a, b = begin[i], border[after[i]]
    key = _hashes(hashes, a, b, up, down).view(np.int64)
    t = place[a]
    return t, key, at[i] - origin[t], ends[b - 1] - origin[t]


def runs(text: str) -> list[tuple[int, int, int]]:
    """(hash, start, end) of the runs of one text."""
    return list(zip(*(x.tolist() for x in all_runs([text])[1:]), strict=True))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, doc_id, k1, start, end) from rows (doc_id, k1, text), a chunk of text at a time."""
    for batch in batches:
        lengths = np.array([len(x or "") for x in batch.column("text").to_pylist()])
        chunk = np.cumsum(lengths) // CHUNK
        for first in np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else ():
            part = batch.slice(first, int((chunk == chunk[first]).sum()))
            t, h, start, end = all_runs([x or "" for x in part.column("text").to_pylist()])
            keys = [part.column(c).take(pa.array(t)) for c in ("doc_id", "k1")]
            columns = [pa.array(h), *keys, pa.array(start, pa.int32()), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "k1", "start", "end"])


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, k1, spans) of the rows that hold a non-first occurrence, as a written table.

    ``spans`` are merged (start, end) pairs in code points.  Rows equal in key and text
    count as one occurrence.
    """
    rows = docs.select(F.col(key).alias("doc_id"), text_key(text)[0], F.col(text).alias("text"))
    occ = rows.mapInArrow(_runs, f"h long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, k1 long, start int, end int")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "start")
    first = occ.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("final"))
    again = materialize(first.filter(~F.col("first").eqNullSafe(F.col("final"))).select("h", "first"))
    later = occ.join(again, "h").filter(~place.eqNullSafe(F.col("first")))
    spans = later.groupBy("doc_id", "k1").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("s"))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")

    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        joined = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))
        return F.when(x["start"] <= last["end"], joined).otherwise(F.concat(done, F.array(x)))

    return materialize(spans.select("doc_id", "k1", F.aggregate("s", none, add).alias("spans")))


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``spans`` (removed stretches, null where there are none) and cut them out of the text.

    A null text stays null and an empty one empty; a text of fewer than ``WORDS`` words
    has no run and stays whole.  Columns named ``spans`` are replaced.
    """
    marks = repeated(docs, key, text)
    n = marks.count()
    plain, names = hidden(docs)
    value = names[text]
    named = plain.select("*", F.col(names[key]).alias("doc_id"), text_key(value)[0])
    side = guarded(marks, n)
    df = named.join(side, same(named, side, ["k1", "doc_id"]), "left").drop("doc_id", "k1")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    kept = F.aggregate(
        "spans",
        zero,
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(F.col(value), acc["at"] + 1, s["start"] - acc["at"])).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col(value), acc["at"] + 1, F.length(value))),
    )
    df = df.withColumn(value, F.when(F.col("spans").isNull(), F.col(value)).otherwise(kept))
    out = [F.col(x).alias(c) for c, x in names.items() if c != "spans"]
    return df.select(*out, "spans")


@register("op1_sentence_spans")
def query(spark: SparkSession, folder: str) -> DataFrame:
    df = cut(table(spark, folder, "documents").select("doc_id", "text"))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return df.select("doc_id", F.coalesce(F.size("spans"), F.lit(0)).alias("n_removed"), F.coalesce(listed, F.lit("")).alias("removed"), "text")
