"""Secret scan through nested encodings.

Every text is searched for three kinds of secrets.  Then a worklist unwraps what may
hide more: percent escapes, backslash escapes, base64 runs, and zlib or gzip data
inside base64.  Each decoded layer is searched again and unwrapped in turn until
nothing new appears; a layer whose content was seen before in the same text is not
opened twice, so nested or repeating encodings end.  Every character of a layer knows
the span of the original text it came from, so a finding in any depth is reported by
its place in the original.

A base64 run is decoded in its four phases, so it may be glued to other characters, and
with its following lines where it is wrapped; bytes that are no UTF-8 are read as Latin-1.

A compressed layer that unpacks to more than ``LAYER_BYTES`` is read in pieces, each with
the end of the one before, and counted in ``n_refused`` (the name is older): it is not
held as a whole, but scanned to its end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import register, table

LAYER_BYTES = 1 << 24
PIECE, OVERLAP = 1 << 20, 1 << 12
KINDS = ("assign", "access", "hex")
# fixed values: names that an assignment must carry
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_SEPARATOR = re.compile(r"[:=]")
_VALUE = re.compile(r" *[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
_ESCAPE = re.compile(r"\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")

_LINE = re.compile(r"[ \t]*\r?\n[ \t>]*([A-Za-z0-9+/_-]+={0,2})(?=[ \t]*(?:\r?\n|$))")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets in a plain text, by start, then by kind as listed.

    An assignment is found from its separator: the name must end just before it
    (one quote and blanks between are allowed), which gives the same leftmost,
    non-overlapping matches as scanning for the names.
    """
    out, last = [], 0
    for m in _SEPARATOR.finditer(text):
        at = m.start()
        if at < last:
            continue
        end = at
        while end > last and text[end - 1] == " ":
            end -= 1
        if end > last and text[end - 1] in "\"'":
            end -= 1
        tail = text[max(last, end - 8) : end]
        tail = tail.lower() if tail.isascii() else "".join(c.lower() if c < "\x80" else c for c in tail)
        name = next((n for n in NAMES if tail.endswith(n)), None)
        value = _VALUE.match(text, at + 1) if name else None
        if value:
            last = value.end()
            if len(value[1]) >= 12:
                out.append((end - len(name), last, 0))
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


class _Places:
    """Places of a text in itself: character i stands at (i, i + 1)."""

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [(k, k + 1) for k in range(i.start or 0, i.stop)]
        return i, i + 1


def _escapes(text: str, spots: list) -> Iterator[tuple[str, list]]:
    """The text with its percent escapes, and with its backslash escapes, replaced."""
    if "%" in text:
        parts, where, at, n = [], [], 0, 0
        for run in re.finditer(r"(?:%[0-9A-Fa-f]{2})+", text):
            parts.append(text[at : run.start()])
            where += spots[at : run.start()]
            raw = bytes.fromhex(run[0].replace("%", ""))
            k = 0
            while k < len(raw):  # one character at a time keeps its span
                width = 1 if raw[k] < 0x80 else 2 if raw[k] < 0xE0 else 3 if raw[k] < 0xF0 else 4
                try:
                    char = raw[k : k + width].decode()
                except UnicodeDecodeError:
                    width, char = 1, "�"
                width = min(width, len(raw) - k)
                parts.append(char)
                first, final = run.start() + 3 * k, run.start() + 3 * (k + width) - 1
                where.append((spots[first][0], spots[final][1]))
                k += width
            at, n = run.end(), n + 1
        if n:
            yield "".join(parts) + text[at:], where + spots[at : len(text)]
    if "\\" in text:
        parts, where, at, n = [], [], 0, 0
        for m in _ESCAPE.finditer(text):
            parts += [text[at : m.start()], chr(int(m[0][2:], 16))]
            where += spots[at : m.start()]
            where.append((spots[m.start()][0], spots[m.end() - 1][1]))
            at, n = m.end(), n + 1
        if n:
            yield "".join(parts) + text[at:], where + spots[at : len(text)]


class _Same:
    """Places of a layer whose characters all stand for one stretch."""

    def __init__(self, place: tuple[int, int], n: int):
        self.place, self.n = place, n

    def __getitem__(self, i):
        return [self.place] * len(range(*i.indices(self.n))) if isinstance(i, slice) else self.place


def _stream(data: bytes) -> Iterator[bytes]:
    """Contents of zlib or gzip data, of all members, in pieces; what came before an error counts."""
    while data:
        opened, got = zlib.decompressobj(47), False
        try:
            while data and not opened.eof:
                out = opened.decompress(data, PIECE)
                data = opened.unconsumed_tail
                if out:
                    got = True
                    yield out
            while not opened.eof and (out := opened.decompress(b"", PIECE)):
                yield out
        except zlib.error:
            return
        data = opened.unused_data if got and opened.unused_data[:2] == b"\x1f\x8b" else b""


def _pieces(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Unpacked data as a whole, or beyond LAYER_BYTES in overlapping pieces; whether it is the start of a large one.

    Blanks are squeezed in the pieces; an open base64 run is carried on up to PIECE.
    """
    held, size, large, begun = [], 0, False, False
    for out in _stream(data):
        held.append(out)
        size += len(out)
        if size > LAYER_BYTES or large:
            large = True
            text = re.sub(rb" {2,}", b" ", b"".join(held))
            yield text, not begun
            begun = True
            run = re.search(rb"[A-Za-z0-9+/_=\r\n-]*\Z", text[-PIECE:])[0]
            held, size = [text[-OVERLAP - (len(run) if len(run) < PIECE else 0) :]], 0
    if not large and held:
        yield b"".join(held), False


def _runs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, characters) of base64 runs, and of wrapped ones with their lines joined."""
    covered = 0
    for m in _BASE64.finditer(text):
        yield m.start(), m.end(), m[0]
        if m.start() < covered or m[0].endswith("="):
            continue
        lines, at, width = [m[0]], m.end(), None
        while line := _LINE.match(text, at):
            width = width or len(line[1])
            if len(line[1]) > width:
                break
            lines.append(line[1])
            at = line.end()
            if len(line[1]) < width or line[1].endswith("="):
                break
        if len(lines) > 1:
            covered = at
            yield m.start(), at, "".join(lines)


def _opens(layer: str) -> bool:
    """Whether a layer that is no UTF-8 or out of phase holds a secret or something to open."""
    return bool(_BASE64.search(layer) or _PERCENT.search(layer) or _ESCAPE.search(layer) or base_spans(layer))


def _wrapped(text: str, spots: list) -> Iterator[tuple[str | None, list]]:
    """What base64 runs hold, compressed or not; None beside a layer that is read in pieces."""
    for start, end, run in _runs(text):
        run = run.rstrip("=").replace("-", "+").replace("_", "/")
        place = (spots[start][0], spots[end - 1][1])
        after = [m.end() for m in re.finditer("[+/]", run)]
        for phase in range(4):
            part = run[phase:]
            part = part[: len(part) - (len(part) % 4 == 1)]
            data = base64.b64decode(part + "=" * (-len(part) % 4))
            heads = {0, *((q - phase) // 4 * 3 for q in after if q % 4 == phase), *(m.start() for m in re.finditer(b"\x1f\x8b\x08", data))}
            for h in sorted(heads):
                if data[h : h + 2] != b"\x1f\x8b" and not (data[h : h + 1] == b"\x78" and int.from_bytes(data[h : h + 2]) % 31 == 0):
                    continue
                for out, large in _pieces(data[h:]):
                    if large:
                        yield None, []
                    try:
                        layer = out.decode()
                    except UnicodeDecodeError:
                        layer = out.decode("latin-1")
                    yield layer, _Same(place, len(layer))
            try:
                layer = data.decode()
            except UnicodeDecodeError:
                layer = data.decode("latin-1")
                if not _opens(layer):
                    continue
            if not phase or _opens(layer):
                yield layer, _Same(place, len(layer))


def _inner(text: str, spots: list) -> Iterator[tuple[str | None, list]]:
    yield from _escapes(text, spots)
    yield from _wrapped(text, spots)


def scan(text: str) -> dict:
    """Base spans, all spans, and the number of layers of one text."""
    base = base_spans(text)
    spans, layers, refused = {(s, e, k) for s, e, k in base}, 0, 0
    if "%" in text or "\\" in text or _BASE64.search(text):
        seen = {hashlib.sha256(text.encode()).digest()}
        work = [_inner(text, _Places())]  # open layers, one inside the other
        while work:
            inner, where = next(work[-1], ("", None))
            if where is None:
                work.pop()
                continue
            if inner is None:
                refused += 1
                continue
            digest = hashlib.sha256(inner.encode("utf-8", "surrogatepass") + repr(where[:1] + where[-1:]).encode()).digest()
            if not inner or digest in seen:
                continue
            seen.add(digest)
            layers += 1
            spans |= {(where[s][0], where[e - 1][1], k) for s, e, k in base_spans(inner)}
            work.append(_inner(inner, where))
    ordered = sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return {"base": base, "all": ordered, "layers": layers, "refused": refused}


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long, n_layers long, n_refused long"


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts of base findings, their digest, all spans and the number of layers.

    A null text is an empty one: zero counts, the digest of nothing, no spans.  Equal
    rows get equal answers.  Columns named like the added ones are replaced.
    """

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                found = scan(value or "")
                kinds = [k for _, _, k in found["base"]]
                listed = ",".join(f"{k}:{s}:{e}" for s, e, k in found["base"])
                every = ",".join(f"{k}:{s}:{e}" for s, e, k in found["all"])
                counts = [kinds.count(k) for k in KINDS]
                digest = hashlib.sha256(listed.encode()).hexdigest()
                rows.append((*counts, digest, every, len(found["all"]) - len(found["base"]), found["layers"], found["refused"]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return docs.drop(*names).withColumn("_f", run(text)).select("*", "_f.*").drop("_f")


@register("op3_secrets")
def query(spark: SparkSession, folder: str) -> DataFrame:
    return find(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
