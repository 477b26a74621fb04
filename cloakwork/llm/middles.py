"""Fill-in-the-middle: a text is cut in two places and its middle is moved to the end.

A text is a row of units, runs of letters A-Z or single other characters.  It is laid
out in fixed blocks of ``BLOCK`` code points; a Fenwick tree over the blocks holds how
many units start in each and how many code points it has.  A cut after ``k`` units is
found by a binary-lifting descent of the tree to the block in which unit ``k`` starts,
and then by counting inside that block alone.

Tasks return places, three numbers a text; the new text is put together by SQL
functions, and :func:`restored` takes it apart again.  Every row is handled by itself:
nothing is shuffled, and a long text costs its task one slice of ``SLICE`` code points
beside the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import hidden, register, table

BLOCK, SLICE = 512, 1 << 20
RATE, SUFFIX_FIRST = 90, 20  # per cent of texts cut, and of those with the suffix first
MARKS = ("<P>", "<S>", "<M>")
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def unit_starts(piece: str, before: str) -> np.ndarray:
    """True where a unit starts; ``before`` is the character ahead of the piece, if any."""
    codes = np.frombuffer((before + piece).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    if not before:
        letter = np.append(False, letter)
    return ~(letter[1:] & letter[:-1])


class BlockTree:
    """Fenwick tree over the blocks of a text: units that start there, code points."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        units, points = [0], [0]
        step = max(block, SLICE // block * block)
        for at in range(0, len(text), step):
            starts = unit_starts(text[at : at + step], text[at - 1 : at] if at else "")
            units += np.add.reduceat(starts.astype(np.int64), np.arange(0, len(starts), block)).tolist()
            points += [min(block, len(starts) - i) for i in range(0, len(starts), block)]
        self.total = sum(units)
        for i in range(1, len(units)):
            up = i + (i & -i)
            if up < len(units):
                units[up] += units[i]
                points[up] += points[i]
        self.units, self.points = units, points

    def cut(self, k: int) -> int:
        """Code points before unit ``k``, all of them where there are ``k`` units."""
        if k >= self.total:
            return len(self.text)
        node, at, left = 0, 0, k
        for level in reversed(range(len(self.units).bit_length())):
            ahead = node + (1 << level)
            if ahead < len(self.units) and self.units[ahead] <= left:
                node, at, left = ahead, at + self.points[ahead], left - self.units[ahead]
        starts = unit_starts(self.text[at : at + self.block], self.text[at - 1 : at] if at else "")
        return at + int(np.flatnonzero(starts)[left])


def _places(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Number of units, and the two cuts that the draws name, in code points."""
    for texts, one, two in batches:
        rows = []
        for text, a, b in zip(texts, one, two, strict=True):
            tree = BlockTree(text or "")
            a, b = sorted((a % (tree.total + 1), b % (tree.total + 1)))
            rows.append((tree.total, tree.cut(a), tree.cut(b)))
        yield pd.DataFrame(rows, columns=["n", "first", "second"])


def draws(key: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of the key; a null key counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return [F.conv(F.substring(F.sha2(text, 256), 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def rearranged(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Add ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to every row.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix first) or ``plain``:
    the text stays as it is where it is empty, where it holds one of ``MARKS``, and in
    ``100 - rate`` per cent of the rest; lengths are null then.  A null text is an empty
    one.  Cuts depend on key, seed and text only, so equal rows get equal answers.  An
    empty table stays empty; texts of any length are cut in whole.  Columns named like
    the added ones are replaced.
    """
    plain, names = hidden(docs)
    h1, h2, h3, h4 = draws(names[key], seed)
    value = F.coalesce(names[text], F.lit(""))
    places = F.pandas_udf(_places, "n long, first int, second int")
    df = plain.withColumn("_cut", places(value, h1, h2)).select("*", "_cut.*")
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains(value, F.lit(mark))
    stays = (value == "") | marked | (h3 % 100 >= rate)
    df = df.withColumn("form", F.when(stays, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm"))
    head, body = F.substring(value, F.lit(1), F.col("first")), F.substring(value, F.col("first") + 1, F.col("second") - F.col("first"))
    tail = F.substring(value, F.col("second") + 1, F.length(value))
    p, s, m = map(F.lit, MARKS)
    output = F.when(F.col("form") == "psm", F.concat(p, head, s, tail, m, body)).when(F.col("form") == "spm", F.concat(s, tail, p, head, m, body)).otherwise(value)
    cut = F.col("form") != "plain"
    made = {
        "n": F.col("n"),
        "form": F.col("form"),
        "prefix_chars": F.when(cut, F.col("first").cast("long")),
        "middle_chars": F.when(cut, (F.col("second") - F.col("first")).cast("long")),
        "output": output,
    }
    return df.select(*[F.col(x).alias(c) for c, x in names.items() if c not in ADDED], *[c.alias(name) for name, c in made.items()])


def restored(form: Column | str = "form", output: Column | str = "output") -> Column:
    """The text that ``output`` was made of: no mark stands inside a part, so the marks part it exactly."""
    form, output = (F.col(c) if isinstance(c, str) else c for c in (form, output))
    part = F.split(output, "|".join(MARKS), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


SQL = rf"""
with d as (
  select coalesce(text, '') as text, doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
e as (
  select *, len(u) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) % 100 as h3, cast('0x' || h[25:32] as bigint) % 100 as h4 from d),
f as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= {RATE} then 'plain'
      when h4 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form from e),
g as (
  select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from f)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m
    else text end) as output_sha256,
  sha256(text) as restored_sha256
from g
"""


@register("op13_middles", SQL)
def query(spark: SparkSession, folder: str) -> DataFrame:
    df = rearranged(table(spark, folder, "documents").select("doc_id", "text"))
    return df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))
