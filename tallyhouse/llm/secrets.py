"""Secrets in texts, also inside URL escapes, Unicode escapes, base64 and compressed layers.

A worklist starts with the text. Every layer taken from it is scanned, and each run of an encoding in it makes a new
layer: escapes are undone in place, base64 runs, also wrapped ones, are decoded from each of their first four characters,
and compressed data are unwrapped wherever they begin in decoded bytes or escapes. A layer whose text was seen before at
the same place is not taken again, so nested and self-reproducing encodings end at a fixpoint. Each layer maps
its stretches to the spans of the text they stem from; matches are reported as spans of the text. Inflated data are
read in overlapping windows of bounded size.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import sliced, strings

# The kinds, in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

_KEY_END = re.compile(r"""(?ai:d|t|n|y)["']?\x20*[:=]""")
_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});|&[A-Za-z][A-Za-z0-9]{1,31};")
_UNIT = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})")
_B64 = "A-Za-z0-9+/_-"
#: A run of one line, and one with the lines that follow; its last line may be short.
_BASE64 = re.compile(rf"(?<![{_B64}])[{_B64}]{{16,}}={{0,2}}")
_WRAPPED = re.compile(rf"(?<![{_B64}])[{_B64}]{{4,}}(?:\r?\n[ \t]*[{_B64}]+)+={{0,2}}")
_LINE_BEFORE = re.compile(rf"[{_B64}]+\r?\n[ \t]*\Z")
_B64_PART = re.compile(rf"[{_B64}]+")
_URL_SAFE = str.maketrans("-_", "+/")
#: No secret and no encoding of one is shorter.
LEAST_LAYER = 16
_VALID = re.compile(rf"[^\udc80-\udcff]{{{LEAST_LAYER},}}")
_WIDE = re.compile(rb"(?:[\t-~]\x00){16,}|(?:\x00[\t-~]){16,}")
_MAGIC = re.compile(rb"(\x1f\x8b\x08)|(x[\x01\x5e\x9c\xda])|(BZh[1-9])|(\xfd7zXZ\x00)")
_UNPACK = (lambda: zlib.decompressobj(31), zlib.decompressobj, bz2.BZ2Decompressor, lzma.LZMADecompressor)
#: Bytes of inflated data that are held at a time, and those that two such windows share. A layer inside must fit a window.
WINDOW, SHARED = 1 << 22, 1 << 16
#: Escapes of bytes: of addresses, of forms, of string literals.
_PERCENT = re.compile(r"%([0-9A-Fa-f]{2})")
_FORM = re.compile(r"%([0-9A-Fa-f]{2})|\+")
_LITERAL = re.compile(r"""\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([0-3]?[0-7]{1,2})|([abfnrtv\\'"]))""")
_LETTERS = dict(zip("abfnrtv\\'\"", b"\a\b\f\n\r\t\v\\'\"", strict=True))

Span = tuple[int, int, int]


def scan(text: str) -> list[Span]:
    """(kind, start, end) of the matches, leftmost and non-overlapping in each kind."""
    found = []
    if (":" in text or "=" in text) and _KEY_END.search(text):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [(2, m.start(), m.end()) for m in HEX.finditer(text)]


Place = Callable[[int, int], tuple[int, int]]


class _Layer:
    """A text, where each stretch of it stems from, and whether a decoding made any of a stretch."""

    __slots__ = ("text", "span", "made")

    def __init__(self, text: str, span: Place = lambda a, b: (a, b), made: Callable[[int, int], bool] = lambda a, b: False):
        self.text, self.span, self.made = text, span, made


class _Mended:
    """A layer with some stretches replaced: memory goes by their number, not by the length of the text."""

    def __init__(self, layer: _Layer):
        self.layer, self.parts, self.length, self.at = layer, [], 0, 0
        self.first, self.source, self.wide, self.before = [], [], [], [0]  # by segment; wide: 0 if unchanged; before: replaced ones

    def _add(self, text: str, source: int, wide: int) -> None:
        if text:
            self.parts.append(text)
            self.first.append(self.length)
            self.source.append(source)
            self.wide.append(wide)
            self.before.append(self.before[-1] + (wide > 0))
            self.length += len(text)

    def replace(self, start: int, end: int, by: str) -> None:
        self._add(self.layer.text[self.at : start], self.at, 0)
        self._add(by, start, end - start)
        self.at = end

    def done(self) -> _Layer:
        self._add(self.layer.text[self.at :], self.at, 0)
        first, source, wide, before, layer = self.first, self.source, self.wide, self.before, self.layer

        def within(a: int, b: int) -> tuple[int, int, int, int]:
            i, j = bisect.bisect_right(first, a) - 1, bisect.bisect_right(first, b - 1) - 1
            return i, j, source[i] + (0 if wide[i] else a - first[i]), source[j] + (wide[j] or b - first[j])

        def span(a: int, b: int) -> tuple[int, int]:
            return layer.span(*within(a, b)[2:])

        def made(a: int, b: int) -> bool:
            i, j, start, end = within(a, b)
            return before[j + 1] > before[i] or layer.made(start, end)

        return _Layer("".join(self.parts), span, made)


def _all(a: int, b: int) -> bool:
    return True


def _unescaped(run: str) -> list[tuple[int, int, str]] | None:
    """Pieces (start, end, characters) that a run of escapes stands for; None if it stands for nothing."""
    if run[0] == "%":
        raw, out, at = binascii.unhexlify(run.replace("%", "")), [], 0
        while at < len(raw):
            n = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
            try:
                out.append((3 * at, 3 * (at + n), raw[at : at + n].decode()))
            except UnicodeDecodeError:
                n = 1
                out.append((3 * at, 3 * at + 3, run[3 * at : 3 * at + 3]))
            at += n
        return [(a, min(b, len(run)), c) for a, b, c in out]
    if run[0] == "&":
        return [(0, len(run), html.unescape(run))]
    out, high = [], None
    for m in _UNIT.finditer(run):
        code = int(m[1] or m[2] or m[3] or m[4], 16)
        if high and 0xDC00 <= code < 0xE000:
            out[-1] = (high[0], m.end(), chr(0x10000 + ((high[1] - 0xD800) << 10) + code - 0xDC00))
        else:
            out.append((m.start(), m.end(), m[0] if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)))
        high = (m.start(), code) if 0xD800 <= code < 0xDC00 else None
    return out


def _pieces(data: memoryview, make: Callable) -> Iterator[bytes | int]:
    """What one compressed stream at the start of some bytes holds, piece by piece, then the number of bytes behind it;
    ends without a number if the stream is broken off or none."""
    undo = make()
    try:
        given = data
        while not undo.eof:
            piece = undo.decompress(given, WINDOW)
            if piece:
                yield piece
            given = undo.unconsumed_tail if hasattr(undo, "unconsumed_tail") else b""
            if not undo.eof and not piece and not given and getattr(undo, "needs_input", True):
                return
    except (zlib.error, OSError, ValueError, lzma.LZMAError, EOFError):
        return
    yield len(undo.unused_data)


def _end(raw: bytes, at: int, make: Callable, kind: int | None) -> int | None:
    """Where the streams that begin there end, all members of one kind; None if there is none."""
    end, view = None, memoryview(raw)
    while end is None or kind is not None and (m := _MAGIC.match(raw, end)) and m.lastindex == kind:
        left = None
        for x in _pieces(view[at if end is None else end :], make):
            left = x if isinstance(x, int) else None
        if left is None:
            break
        end = len(raw) - left
    return end


def _windows(raw: bytes, at: int, end: int, make: Callable) -> Iterator[bytes]:
    """The contents of the streams between two places, in overlapping windows."""
    held, view = b"", memoryview(raw)
    while at < end:
        for x in _pieces(view[at:end], make):
            if isinstance(x, int):
                at = end - x
            else:
                held += x
                if len(held) >= WINDOW:
                    yield held
                    held = held[-SHARED:]
    yield held


def _streams(raw: bytes, whole: bool) -> Iterator[tuple[int, int, Callable]]:
    """Compressed streams in some bytes: those with a mark, or else, if asked for, one without that fills them."""
    upto = 0
    for m in _MAGIC.finditer(raw):
        make = _UNPACK[m.lastindex - 1]
        if m.start() >= upto and (end := _end(raw, m.start(), make, m.lastindex)) is not None:
            upto = end
            yield m.start(), end, make
    if whole and not upto and len(raw) >= LEAST_LAYER and not raw.isascii() and _end(raw, 0, _raw, None) == len(raw):
        yield 0, len(raw), _raw


def _raw():
    return zlib.decompressobj(-15)


def _held(raw: bytes, place: Place, whole: bool = False) -> Iterator[_Layer]:
    """The texts in the compressed streams of some bytes, also of those within."""
    work, seen = [(raw, place)], set()
    while work:
        raw, place = work.pop()
        for start, end, make in _streams(raw, whole):
            span = place(start, end)
            fixed = lambda a, b, span=span: span
            for inner in _windows(raw, start, end, make):
                if (mark := (hashlib.sha256(inner).digest(), span)) not in seen:
                    seen.add(mark)
                    yield from _readable(inner, fixed)
                    work.append((inner, fixed))


def _readable(raw: bytes, place: Place) -> Iterator[_Layer]:
    """The stretches of valid UTF-8 in some bytes, and those of plain letters in two bytes each."""
    text, at, byte = raw.decode("utf-8", "surrogateescape"), 0, 0
    for m in _VALID.finditer(text):
        byte += len(text[at : m.start()].encode("utf-8", "surrogateescape"))
        at, body = m.end(), m[0]
        if body.isascii():
            yield _Layer(body, lambda a, b, byte=byte: place(byte + a, byte + b), _all)
            byte += len(body)
            continue
        code = np.frombuffer(body.encode("utf-32-le"), "<u4")
        ends = byte + np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), dtype=np.int64)
        yield _Layer(body, lambda a, b, byte=byte, ends=ends: place(int(ends[a - 1]) if a else byte, int(ends[b - 1])), _all)
        byte = int(ends[-1])
    for m in _WIDE.finditer(raw):
        low = 0 if m[0][1] == 0 else 1
        yield _Layer(m[0][low::2].decode(), lambda a, b, start=m.start(): place(start + 2 * a, start + 2 * b), _all)


def _decoded(layer: _Layer, start: int, end: int) -> Iterator[_Layer]:
    """The texts in a base64 run, decoded from each of its first four characters: one of these falls in with any payload
    that begins later in the run."""
    first, source, n = [], [], 0  # by line of the run
    for m in _B64_PART.finditer(layer.text, start, end):
        first.append(n)
        source.append(m.start())
        n += m.end() - m.start()
    whole = "".join(_B64_PART.findall(layer.text, start, end)).translate(_URL_SAFE)

    def at(i: int) -> int:
        line = bisect.bisect_right(first, i) - 1
        return source[line] + i - first[line]

    for k in range(4):
        body = whole[k:]
        if len(body) % 4 == 1:
            body = body[:-1]
        raw = base64.b64decode(body + "=" * (-len(body) % 4))

        def place(a: int, b: int, k: int = k, n: int = len(raw)) -> tuple[int, int]:
            return layer.span(at(k + a * 4 // 3), end if b == n else at(k - (-b * 4 // 3) - 1) + 1)

        yield from _readable(raw, place)
        yield from _held(raw, place, whole=True)


def _bytes_of(layer: _Layer, escape: re.Pattern) -> tuple[bytes, Place]:
    """The bytes of a text whose escapes stand for one byte each, all else as UTF-8."""
    text, parts, first, froms, at, n = layer.text, [], [0], [0], 0, 0
    wide: set[int] = set()

    def add(piece: bytes, start: int) -> None:
        nonlocal n
        if piece:
            parts.append(piece)
            first.append(n)
            froms.append(start)
            n += len(piece)

    for m in escape.finditer(text):
        add(text[at : m.start()].encode("utf-8", "replace"), at)
        groups = [g for g in m.groups() if g]
        code = 32 if m[0] == "+" else _LETTERS[groups[0]] if m.lastindex == 4 else int(groups[0], 8 if m.lastindex == 3 else 16)
        wide.add(len(first))
        add(bytes([code]), m.start())
        at = m.end()
    add(text[at:].encode("utf-8", "replace"), at)
    ends = [*froms[1:], len(text)]

    def place(a: int, b: int) -> tuple[int, int]:
        i, j = bisect.bisect_right(first, a) - 1, bisect.bisect_right(first, b - 1) - 1
        start = froms[i] if i in wide else min(froms[i] + a - first[i], ends[i] - 1)
        return layer.span(start, ends[j] if j in wide else min(froms[j] + b - first[j], ends[j]))

    return b"".join(parts), place


def _layers(layer: _Layer) -> Iterator[_Layer]:
    text = layer.text
    if "%" in text or "\\" in text or "&" in text:
        mended = _Mended(layer)
        for m in _ESCAPE.finditer(text):
            for a, b, c in _unescaped(m[0]):
                if c != text[m.start() + a : m.start() + b]:
                    mended.replace(m.start() + a, m.start() + b, c)
        if mended.at:
            yield mended.done()
        for escape, present in ((_PERCENT, "%" in text), (_FORM, "%" in text and "+" in text), (_LITERAL, "\\x" in text or "\\u00" in text)):
            if present and escape.search(text):
                yield from _held(*_bytes_of(layer, escape))
    for m in _BASE64.finditer(text):
        yield from _decoded(layer, *m.span())
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            start, lines = m.start(), m[0].count("\n") + 1
            alone = start == 0 or text[start - 1] == "\n" or not text[max(0, text.rfind("\n", 0, start)) : start].strip()
            # a word at a line's end and one at the next line's beginning are no run
            if m.end() - start < LEAST_LAYER or lines == 2 and not alone and m[0].index("\n") < LEAST_LAYER:
                continue
            while before := _LINE_BEFORE.search(text, max(0, start - 100), start):
                start = before.start()
            yield from _decoded(layer, start, m.end())


def secrets(text: str) -> tuple[list[Span], list[Span]]:
    """The spans in the text as it stands, and these with those of all layers below it; both by start, kind, end."""
    base = sorted(scan(text), key=lambda s: (s[1], s[0], s[2]))
    every, work, seen = set(base), [_Layer(text)], {(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), (0, len(text)))}
    while work:
        for inner in _layers(work.pop()):
            mark = hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest(), inner.span(0, len(inner.text))
            if mark in seen:
                continue
            seen.add(mark)
            every.update((kind, *inner.span(a, b)) for kind, a, b in scan(inner.text) if inner.made(a, b))
            work.append(inner)
    return base, sorted(every, key=lambda s: (s[1], s[0], s[2]))


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by a mark."""
    parts, at = [], 0
    for _, a, b in spans:
        if a >= at:
            parts += text[at:a], "[secret]"
        at = max(at, b)
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex and base_sha256 of the text's own spans, n_spans and spans of all.

    Null and empty texts have no span. Rows are independent: repeated rows and ids give a row each, other columns are
    not read, texts are taken whole and layers are followed to the end.
    """
    kinds = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("n_spans", pa.int64()), ("spans", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            cols = [[] for _ in range(6)]
            for text in strings(batch.column(1)):
                base, every = secrets(text)
                of = [k for k, _, _ in base]
                row = of.count(0), of.count(1), of.count(2), hashlib.sha256(spelled(base).encode()).hexdigest(), len(every), spelled(every)
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t.type) for c, t in zip(cols, list(kinds)[1:], strict=True))], schema=kinds)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(find, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, n_spans long, spans string")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows with every secret replaced by [secret] and, if there is such a column, the number of characters adjusted.
    Rows without a secret come back as they are, nulls included."""
    names = docs.columns
    at, n = names.index(text_col), names.index(chars_col) if chars_col in names else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, cols = batch.column(at).to_pylist(), list(batch.columns)
            found = {i: redacted(t, s) for i, t in enumerate(texts) if t and (s := secrets(t)[1])}
            if found:
                cols[at] = pa.array([found.get(i, t) for i, t in enumerate(texts)], batch.schema.field(at).type)
                if n is not None:
                    cols[n] = pa.array([len(found[i]) if i in found else x for i, x in enumerate(cols[n].to_pylist())], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
