"""Interpolated Kneser-Ney language model with three discounts, counted in Spark.

The model is a row of sorted arrays in the shared folder.  Words are keys by their
64-bit hash and numbered in the order of the hashes; an n-gram's key packs the number
of its first n - 1 words (itself a place in the array one level below) and the number
of its last word, mixed by a bijection, so keys spread evenly and no two n-grams share
one.  A level is cut by the upper bits of its keys into files of about ``SHARD``
entries; tasks memory-map them, and one batch of keys, sorted, meets each file once.

Counting: tasks number the n-grams of ``CHUNK`` tokens at a time, merge equal ones and
pass on one packed block per file.  Keys are uniform, so no file and no task is hot,
whichever word or pair holds a third of the text.  The task that merges a file knows
each distinct n-gram once; it adds up how often its context goes on, with how many
words seen once, twice and more, and how many n-grams end in the same shorter one
(the continuation count that takes the place of the count below the highest order).
These sums, too, go on as one block per range of numbers.

    p(w | c) = (a(cw) - D(a(cw))) / a(c.) + (D1 N1(c) + D2 N2(c) + D3 N3(c)) / a(c.) * p(w | shorter c)

The word level is interpolated with an equal share for every word and the unknown one.
A text is read as order - 1 starts, its words, one end.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import hidden, register, table, word_lists
from cloakwork.session import materialize, scratch_root

ORDER = 2
CHUNK = 1 << 19  # tokens numbered together
SHARD = 1 << 20  # entries of a file, about
RANGE = 1 << 18  # numbers whose sums one task adds up
HELD = 200_000  # words that a task counts before it passes them on
END = b"\n"  # no word has a blank in it
FOLDS, HELD_OUT = 7, 2
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB  # odd
_I1, _I2 = (np.uint64(pow(m, -1, 1 << 64)) for m in (_M1, _M2))
ADDED = ("n_tokens", "n_known", "base_score", "score")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose upper bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mix`."""
    for shift, factor in ((31, _I2), (27, _I1), (30, np.uint64(1))):
        x = x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))
        x = x * factor
    return x


# -- blocks and files -------------------------------------------------------------------


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers by byte planes, without the planes that are all zero."""
    out = [np.array([len(columns[0])], "<u8").tobytes()]
    for c in columns:
        planes = c.astype("<u8").view(np.uint8).reshape(-1, 8).T
        used = planes.any(axis=1)
        out += [np.packbits(used).tobytes(), planes[used].tobytes()]
    return b"".join(out)


def unpacked(block: bytes, width: int) -> list[np.ndarray]:
    size, at, out = int(np.frombuffer(block, "<u8", 1)[0]), 8, []
    for _ in range(width):
        used = np.flatnonzero(np.unpackbits(np.frombuffer(block, np.uint8, 1, at)))
        planes = np.zeros((size, 8), np.uint8)
        planes[:, used] = np.frombuffer(block, np.uint8, len(used) * size, at + 1).reshape(len(used), size).T
        out.append(planes.view("<u8").reshape(-1).astype(np.uint64))
        at += 1 + len(used) * size
    return out


def _store(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _write(root: str, arrays: list[np.ndarray]) -> str:
    """A new file under the shared folder; a repeated task writes another one, and only one is listed."""
    store, folder = _store(root)
    store.create_dir(folder, recursive=True)
    path = f"{folder}/{uuid.uuid4().hex}"
    with store.open_output_stream(path) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return path


def _open(root: str, path: str) -> np.ndarray:
    """The bytes of a file: mapped where the folder is mounted, else read (one file at a time)."""
    store, _ = _store(root)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), np.uint8)


@dataclass
class Level:
    """Sorted keys with counts, in files by the upper bits of the key."""

    root: str
    bits: int
    files: list[tuple[str, int, int]] = field(default_factory=list)  # path, entries, counts of 255 and more

    def __post_init__(self):
        self.first = np.cumsum([0, *(n for _, n, _ in self.files)])

    @property
    def size(self) -> int:
        return int(self.first[-1])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 where it is not there) and count of each key; the keys are sorted."""
        number, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        edge = np.searchsorted(shard_of(keys, self.bits), np.arange(len(self.files) + 1))
        for s, (path, n, over) in enumerate(self.files):
            a, b = edge[s], edge[s + 1]
            if a == b or not n:
                continue
            raw = _open(self.root, path)
            held = raw[: 8 * n].view("<u8")
            at = np.minimum(np.searchsorted(held, keys[a:b]), n - 1)
            hit = np.flatnonzero(held[at] == keys[a:b])
            at = at[hit]
            where, large = raw[8 * n : 8 * (n + 2 * over)].view("<i8").reshape(2, over)
            c = raw[8 * (n + 2 * over) :][at].astype(np.int64)
            if over:
                place = np.minimum(np.searchsorted(where, at), over - 1)
                c = np.where(where[place] == at, large[place], c)
            number[a + hit], count[a + hit] = self.first[s] + at, c
        return number, count


    def entries(self, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, keys and counts of a file."""
        path, n, over = self.files[s]
        raw = _open(self.root, path) if n else np.zeros(0, np.uint8)
        where, large = raw[8 * n : 8 * (n + 2 * over)].view("<i8").reshape(2, over)
        counts = raw[8 * (n + 2 * over) :].astype(np.int64)
        counts[where] = large
        return np.arange(self.first[s], self.first[s] + n), raw[: 8 * n].view("<u8").astype(np.uint64), counts

    def keys_at(self, numbers: np.ndarray) -> np.ndarray:
        """Keys of sorted numbers; 0 for negative ones."""
        out = np.zeros(len(numbers), np.uint64)
        edge = np.searchsorted(numbers, self.first)
        for s, (path, n, _) in enumerate(self.files):
            if edge[s] < edge[s + 1]:
                at = slice(edge[s], edge[s + 1])
                out[at] = _open(self.root, path)[: 8 * n].view("<u8")[numbers[at] - self.first[s]]
        return out


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _bits(entries: int) -> int:
    return max(0, (entries // SHARD).bit_length())


def _level_file(root: str, keys: np.ndarray, counts: np.ndarray) -> tuple[str, int, int]:
    where = np.flatnonzero(counts >= 255)
    arrays = [keys.astype("<u8"), where.astype("<i8"), counts[where].astype("<i8"), np.minimum(counts, 255).astype(np.uint8)]
    return _write(root, arrays), len(keys), len(where)


# -- words ------------------------------------------------------------------------------


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, n), one per word and task while the task can hold them."""
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        columns = [pa.array(_hash(list(held)).view(np.int64)), pa.array(list(held.values()), pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, ["h", "n"])

    for batch in batches:
        for text in batch.column("text"):
            held[END] += 1
            for words in word_lists(text.as_py() or "", lower=True):
                held.update(words)
                if len(held) > HELD:
                    yield flush()
    if held:
        yield flush()


def _word_level(root: str):
    def write(rows: pa.Table) -> pa.Table:
        keys = rows.column("h").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        path, n, over = _level_file(root, keys[order], rows.column("n").to_numpy()[order])
        return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "path": [path], "n": [n], "over": [over]})

    return write


class Coder(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _chunks(texts: Iterator[tuple[int, str]], order: int, most: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(codes, row of each code, words by code) of at most about ``most`` tokens.

    Code 0 is the start.  The row is -1 where a code is context only: at a start, and
    where a chunk goes on with a text that the chunk before has begun.
    """
    start = [0] * (order - 1)

    def fresh() -> tuple[Coder, list, list]:
        coder = Coder()
        coder[b" "] = 0
        return coder, [], []

    coder, codes, rows = fresh()
    size = 0
    for row, text in texts:
        codes.append(np.array(start, np.int32))
        rows.append(np.full(order - 1, -1, np.int32))
        behind: list[bytes] = [b" "] * (order - 1)
        for words in (*word_lists(text, lower=True), [END]):
            codes.append(np.fromiter(map(coder.__getitem__, words), np.int32, len(words)))
            rows.append(np.full(len(words), row, np.int32))
            size += len(words)
            behind = [*behind, *words[1 - order :]][1 - order :] if order > 1 else []
            if size >= most:
                yield np.concatenate(codes), np.concatenate(rows), list(coder)
                coder, codes, rows = fresh()
                size = 0
                codes.append(np.fromiter(map(coder.__getitem__, behind), np.int32, len(behind)))
                rows.append(np.full(len(behind), -1, np.int32))
    if size:
        yield np.concatenate(codes), np.concatenate(rows), list(coder)


# -- the model --------------------------------------------------------------------------


@dataclass
class Model:
    """Levels 1 to ``order``, sums of contexts and continuations below the highest, discounts."""

    order: int
    root: str
    tokens: int
    levels: list[Level]
    sums: list[list[str]] = field(default_factory=list)  # per level but the last: files of RANGE numbers
    discounts: list[tuple[float, float, float]] = field(default_factory=list)  # of levels 1, 2, ...
    kinds: int = 0  # distinct pairs, the sum of all continuation counts of words
    ones: list[int] = field(default_factory=lambda: [0, 0, 0, 0])  # words with 1, 2, 3, 4 continuations

    @property
    def words(self) -> int:
        return self.levels[0].size

    @property
    def width(self) -> int:
        """Bits of a word's number; two more numbers stand for the start and the unknown word."""
        return (self.words + 1).bit_length()

    @property
    def spare(self) -> float:
        """What the discounts of the words leave for all words alike."""
        once, twice = self.ones[:2]
        first, second, third = self.discounts[0]
        return (first * once + second * twice + third * (self.words - once - twice)) / self.kinds

    def numbered(self, codes: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of the word of every code: the start is ``words``, an unknown word one more."""
        keys = _hash(words)
        order = np.argsort(keys)
        number, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        number[order], count[order] = self.levels[0].find(keys[order])
        number[number < 0] = self.words + 1
        number[0], count[0] = self.words, 0
        return number[codes], count[codes]

    def keys(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        return mix((before.astype(np.uint64) << np.uint64(self.width)) | word.astype(np.uint64))

    def parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the context and of the last word of each key."""
        plain = unmix(keys)
        return (plain >> np.uint64(self.width)).astype(np.int64), (plain & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def spelled(self, level: int, numbers: np.ndarray) -> list[np.ndarray]:
        """The numbers of the words of each n-gram of a level, in order."""
        if level == 1:
            return [numbers]
        starts = numbers == self.levels[level - 1].size
        held, back = np.unique(np.where(starts, -1, numbers), return_inverse=True)
        before, word = self.parts(self.levels[level - 1].keys_at(held)[back])
        before = np.where(starts, self.levels[level - 2].size, before)
        return [*self.spelled(level - 1, before), np.where(starts, self.words, word)]

    def without_first(self, k: int, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Numbers of the last k - 1 words of k-grams given by the number of the first k - 1 and the last word."""
        number, *others = [*self.spelled(k - 1, before)[1:], word]
        for level, w in enumerate(others, 2):
            starts = (number == self.levels[level - 2].size) & (w == self.words)
            asked, back = np.unique(self.keys(number, w), return_inverse=True)
            number = np.where(starts, self.levels[level - 1].size, self.levels[level - 1].find(asked)[0][back])
        return number

    def up_to(self, codes: np.ndarray, words: list[bytes], level: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Numbers and counts of the k-gram that ends at every code, for k up to ``level``; -1 where there is none."""
        number, count = self.numbered(codes, words)
        numbers, counts, word = [number], [count], number
        for k in range(1, level):
            before = np.append(-1, numbers[-1][:-1])
            ok = np.flatnonzero((before >= 0) & (word < self.words) & ((before <= self.words) if k == 1 else True))
            asked, back = np.unique(self.keys(before[ok], word[ok]), return_inverse=True)
            number, count = np.full(len(codes), -1, np.int64), np.zeros(len(codes), np.int64)
            at, c = self.levels[k].find(asked)
            number[ok], count[ok] = at[back], c[back]
            if k + 1 < self.order:  # starts only are a context, though nobody counted them
                starts = np.flatnonzero((word == self.words) & (before == self.words if k == 1 else before == self.levels[k - 1].size))
                number[starts] = self.levels[k].size
            numbers.append(number)
            counts.append(count)
        return numbers, counts

    def sums_of(self, level: int, numbers: np.ndarray) -> list[np.ndarray]:
        """Of the numbers of a level: total as a context, N1, N2, N3, continuations; all 0 for negative numbers."""
        held, back = np.unique(numbers, return_inverse=True)
        out = np.zeros((5, len(held)), np.int64)
        edge = np.searchsorted(held, np.arange(len(self.sums[level - 1]) + 1) * RANGE)
        for r, path in enumerate(self.sums[level - 1]):
            if path and edge[r] < edge[r + 1]:
                at = slice(edge[r], edge[r + 1])
                out[:, at] = _open(self.root, path).view("<i8").reshape(5, -1)[:, held[at] - r * RANGE]
        return [column[back] for column in out]

    def discount(self, level: int, count: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.discounts[level - 1]])[np.minimum(count, 3)]

    def probabilities(self, codes: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """p(word | the words before it) at every code, and the count of its word; starts get any value."""
        numbers, counts = self.up_to(codes, words, self.order)
        a = self.sums_of(1, np.where(numbers[0] < self.words, numbers[0], -1))[4]
        p = np.full(len(codes), 1.0 / (self.words + 1))
        if self.kinds:
            p = (a - self.discount(1, a)) / self.kinds + self.spare * p
        for k in range(2, self.order + 1):
            before = np.append(-1, numbers[k - 2][:-1])
            total, *ones = self.sums_of(k - 1, np.where(before <= self.words, before, -1) if k == 2 else before)[:4]
            a = counts[k - 1] if k == self.order else self.sums_of(k, numbers[k - 1])[4]
            spare = sum(d * n for d, n in zip(self.discounts[k - 1], ones, strict=True))
            seen = np.maximum(total, 1)
            p = np.where(total > 0, (a - self.discount(k, a) + spare * p) / seen, p)
        return p, counts[0]


def discounts(ones: list[int]) -> tuple[float, float, float]:
    """The three discounts of a level from the numbers of n-grams seen 1, 2, 3 and 4 times.

    Where one of them is 0, as in tiny tables, 1/2, 1 and 3/2 stand in.
    """
    if min(ones) == 0:
        return 0.5, 1.0, 1.5
    y = ones[0] / (ones[0] + 2 * ones[1])
    return tuple(min(float(k), max(0.0, k - (k + 1) * y * ones[k] / ones[k - 1])) for k in (1, 2, 3))


# -- counting ---------------------------------------------------------------------------


def _ones(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _grams(model: Model, k: int, bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((0, text.as_py() or "") for batch in batches for text in batch.column("text"))
        for codes, rows, words in _chunks(texts, k):
            numbers, _ = model.up_to(codes, words, k - 1)
            at = np.flatnonzero(rows >= 0)
            keys, counts = np.unique(model.keys(numbers[-1][at - 1], numbers[0][at]), return_counts=True)
            shard = shard_of(keys, bits)
            edge = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(keys))
            blocks = [packed(np.diff(keys[a:b], prepend=np.uint64(0)), counts[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            for i, block in enumerate(blocks):
                yield pa.RecordBatch.from_arrays([pa.array([shard[edge[i]]], pa.int32()), pa.array([block], pa.binary())], ["shard", "block"])

    return count


def _gram_level(root: str):
    def merge(rows: pa.Table) -> pa.Table:
        parts = [unpacked(block.as_py(), 2) for block in rows.column("block")]
        keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        at = np.cumsum([0, *(len(p[0]) for p in parts)])
        for a, b in zip(at[:-1], at[1:], strict=True):
            keys[a:b] = np.cumsum(keys[a:b])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.add.reduceat(counts, first)
        path, n, over = _level_file(root, keys[first], counts)
        shard = pa.array([rows.column("shard")[0].as_py()], pa.int32())
        return pa.table({"shard": shard, "path": [path], "n": [n], "over": [over], "ones": pa.array([_ones(counts)], pa.list_(pa.int64()))})

    return merge


def _sum_blocks(model: Model, k: int):
    """Of the files of level k: blocks (range, sums) of the numbers of level k - 1."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.column("id").to_pylist():
                numbers, keys, a = model.levels[k - 1].entries(s)
                if k < model.order:
                    a = model.sums_of(k, numbers)[4]
                before, word = model.parts(keys)
                after = word if k == 2 else model.without_first(k, before, word)
                held, back = np.unique(np.concatenate((before, after)), return_inverse=True)
                size, n = len(held), len(before)
                added = [np.bincount(back[:n], w, size).astype(np.int64) for w in (a, a == 1, a == 2, a > 2)]
                added.append(np.bincount(back[n:], minlength=size))
                part = held // RANGE
                edge = np.append(np.flatnonzero(np.diff(part, prepend=-1)), size)
                for x, y in zip(edge[:-1], edge[1:], strict=True):
                    block = packed(np.diff(held[x:y], prepend=part[x] * RANGE), *(c[x:y] for c in added))
                    yield pa.RecordBatch.from_arrays([pa.array([part[x]], pa.int32()), pa.array([block], pa.binary())], ["range", "block"])

    return add


def _sum_ranges(root: str, size: int):
    def add(rows: pa.Table) -> pa.Table:
        r = rows.column("range")[0].as_py()
        sums = np.zeros((5, min(RANGE, size - r * RANGE)), np.int64)
        for block in rows.column("block"):
            at, *columns = unpacked(block.as_py(), 6)
            at = np.cumsum(at).astype(np.int64)
            for total, c in zip(sums, columns, strict=True):
                total[at] += c.astype(np.int64)
        ones = pa.array([_ones(sums[4])], pa.list_(pa.int64()))
        return pa.table({"shard": pa.array([r], pa.int32()), "path": [_write(root, [sums.astype("<i8")])], "kinds": [int(sums[4].sum())], "ones": ones})

    return add


def _listed(made: DataFrame, size: int, none: tuple, *columns: str) -> tuple[list[tuple], list[int]]:
    """What the files are (one row a file comes to the driver), and the sum of their ``ones``."""
    out, ones = [none] * size, [0, 0, 0, 0]
    for row in made.collect():
        out[row["shard"]] = tuple(row[c] for c in columns)
        if "ones" in made.columns:
            ones = [a + b for a, b in zip(ones, row["ones"], strict=True)]
    return out, ones


def fit(train: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count the n-grams of all rows up to ``order`` (2 or more); a null text is an empty one.

    The files stay under the folder that ``spark.checkpoint.dir`` names, as long as a
    result that reads them is wanted.  An empty table gives the model that knows no word.
    """
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = train.sparkSession
    root = f"{scratch_root(spark)}/models/{uuid.uuid4().hex}"
    rows = train.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = materialize(rows.mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    kinds, tokens = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = _bits(kinds)
    shard = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    made = materialize(words.withColumn("shard", shard).groupBy("shard").applyInArrow(_word_level(root), "shard int, path string, n long, over long"))
    files, _ = _listed(made, 1 << bits, ("", 0, 0), "path", "n", "over")
    model = Model(order, root, tokens, [Level(root, bits, files)])
    for k in range(2, order + 1):
        if (model.levels[-1].size + 1).bit_length() + model.width > 64:
            raise ValueError(f"{k}-grams of so many words have no 64-bit key; take a lower order")
        bits = _bits(tokens)
        blocks = rows.mapInArrow(_grams(model, k, bits), "shard int, block binary")
        made = materialize(blocks.groupBy("shard").applyInArrow(_gram_level(root), "shard int, path string, n long, over long, ones array<long>"))
        files, ones = _listed(made, 1 << bits, ("", 0, 0), "path", "n", "over")
        model.levels.append(Level(root, bits, files))
    model.sums, model.discounts = [[] for _ in range(order)], [discounts(ones)] * order
    for k in range(order, 1, -1):
        size = model.levels[k - 2].size + 1  # and the start
        ranges = -(-size // RANGE)
        blocks = spark.range(0, len(model.levels[k - 1].files), 1, len(model.levels[k - 1].files)).mapInArrow(_sum_blocks(model, k), "range int, block binary")
        made = materialize(blocks.groupBy("range").applyInArrow(_sum_ranges(root, size), "shard int, path string, kinds long, ones array<long>"))
        found, ones = _listed(made, ranges, ("", 0), "path", "kinds")
        model.sums[k - 2] = [path for path, _ in found]
        model.discounts[k - 2] = discounts(ones)
        model.kinds = sum(n for _, n in found)
        model.ones = ones
    return model


# -- scoring ----------------------------------------------------------------------------


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 probabilities) to every row.

    ``base_score`` adds one to the count of every word and knows no context.  A null or
    empty text is its end alone; equal texts get equal scores; texts of any length are
    read in whole, ``CHUNK`` tokens at a time.  Columns named like the added ones are
    replaced.  The perplexity is ``10 ** (-score / n_tokens)``.
    """
    top = float(model.tokens + model.words + 1)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = np.zeros((4, len(texts)), np.longdouble)
            for codes, rows, words in _chunks(((i, text or "") for i, text in enumerate(texts)), model.order):
                p, c = model.probabilities(codes, words)
                at = np.flatnonzero(rows >= 0)
                first = np.flatnonzero(np.diff(rows[at], prepend=-1))
                c = c[at]
                parts = (np.ones(len(at)), c > 0, np.log10((c + 1) / top), np.log10(p[at]))
                for total, part in zip(out, parts, strict=True):
                    total[rows[at][first]] += np.add.reduceat(part.astype(np.longdouble), first)
            frame = {"n_tokens": out[0].astype(np.int64), "n_known": out[1].astype(np.int64)}
            yield pd.DataFrame(frame | {"base_score": out[2].astype(float), "score": out[3].astype(float)})

    plain, names = hidden(docs)
    judged = F.pandas_udf(judge, "n_tokens long, n_known long, base_score double, score double")
    df = plain.withColumn("_judged", judged(names[text])).select("*", "_judged.*")
    return df.select(*[F.col(x).alias(c) for c, x in names.items() if c not in ADDED], *ADDED)


def held_out(key: str = "doc_id") -> Column:
    """One of ``FOLDS`` parts by the checksum of the key's text; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


_ONES = ", ".join(f"count(*) filter (a = {i}) as o{i}" for i in (1, 2, 3, 4))
_D = "case when least(o1, o2, o3, o4) = 0 then {k} / 2.0 else least({k}.0, greatest(0.0, {k} - {l} * (o1 / (o1 + 2.0 * o2)) * o{l} / o{k})) end as d{k}"
_DISCOUNTS = ", ".join(_D.format(k=k, l=k + 1) for k in (1, 2, 3))
SQL = rf"""
with d as (
  select row_number() over () as r, doc_id,
    xor(list_reduce(flatten([[4294967295::bigint]] || [[ord(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]
        for x in string_split(cast(doc_id as varchar), '')]),
      lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % {FOLDS} as part,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') || [chr(10)] as w
  from documents),
t as (
  select r, coalesce(part, 0) = {HELD_OUT} as held_out, w[i] as w, case when i = 1 then ' ' else w[i - 1] end as v
  from (select *, unnest(range(1, len(w) + 1)) as i from d)),
uni as (select w, count(*) as c from t where not held_out group by w),
size as (select coalesce(sum(c), 0) as n, count(*) as v from uni),
bi as (select v, w, count(*) as a from t where not held_out group by v, w),
ctx as (select v, sum(a) as total, count(*) filter (a = 1) as n1, count(*) filter (a = 2) as n2, count(*) filter (a > 2) as n3 from bi group by v),
cont as (select w, count(*) as a from bi group by w),
d2 as (select {_DISCOUNTS} from (select {_ONES} from bi)),
d1 as (select {_DISCOUNTS}, kinds, (d1 * o1 + d2 * o2 + d3 * (words - o1 - o2)) / kinds as spare
  from (select {_ONES}, count(*) as words, sum(a) as kinds from cont)),
p1 as (
  select w, (a - case when a = 1 then d1 when a = 2 then d2 else d3 end) / kinds + spare / (v + 1) as p, c from cont join uni using (w), d1, size),
s as (
  select t.r, t.held_out, coalesce(p1.c, 0) as c,
    coalesce(p1.p, spare / (size.v + 1), 1.0 / (size.v + 1)) as low,
    coalesce(bi.a - case when bi.a = 1 then d2.d1 when bi.a = 2 then d2.d2 else d2.d3 end, 0) as top,
    ctx.total, d2.d1 * ctx.n1 + d2.d2 * ctx.n2 + d2.d3 * ctx.n3 as gamma, size.n, size.v
  from t left join p1 on p1.w = t.w left join bi on bi.v = t.v and bi.w = t.w left join ctx on ctx.v = t.v, d1, d2, size)
select doc_id, held_out, count(*) as n_tokens, count(*) filter (c > 0) as n_known, cast(any_value(n) as bigint) as train_tokens,
  round(fsum(log10((c + 1) / (n + v + 1))), 9) as base_score,
  round(fsum(log10(case when total > 0 then (top + gamma * low) / total else low end)), 9) as score
from s join d using (r) group by r, doc_id, held_out
"""


@register("op11_language", SQL)
def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs.filter(~held_out()))
    df = score(docs.withColumn("held_out", held_out()), model)
    return df.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), *[F.round(c, 9).alias(c) for c in ("base_score", "score")])
