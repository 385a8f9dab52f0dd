"""Secret scan with a worklist of nested encodings.

Every layer of a text is scanned for three kinds of secrets. Percent escapes and Unicode escapes are replaced in the
whole text of a layer; base64, wrapped lines and parts of longer runs included, and compressed bytes anywhere in a
decoded layer are unwrapped into further layers, until nothing new appears. A layer of the same text from the same places of the original is not entered again,
so cycles end; other copies of it are. Spans are code points of the original text: a layer keeps, for each of its
characters, the stretch of the original text it came from.

Defined cases: a null or empty text has no spans. Equal spans of one kind are listed once. Bytes need be
no text, control characters are kept; a compressed stream that lacks its end is not entered, any other is read in whole.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.llm.arrays import fresh, map_text

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Any match of the first pattern holds one of these.
HINT = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
#: Maximal runs, so the least length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

PERCENT = re.compile(r"%([0-9A-Fa-f]{2})")
ESCAPED = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}")
#: Base64 letters, also over line ends (written out or as \\n) with the indents and quote marks of mails.
BREAK = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[ \t>]*")
BASE64 = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{16,}}+(?:{BREAK.pattern}[A-Za-z0-9+/_-]++)*+|[A-Za-z0-9+/_-]{{1,15}}+(?:{BREAK.pattern}[A-Za-z0-9+/_-]++)++)={{0,2}}")
LEAST_BASE64 = 16
URL_LETTERS = str.maketrans("-_", "+/")
#: First two bytes of zlib data of any window and level: a multiple of 31, and no dictionary is asked for.
_LEVELS = {c: bytes(f for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 0x20) for c in range(0x08, 0x80, 0x10)}
_ZLIB = b"|".join(re.escape(bytes([c])) + b"[" + re.escape(f) + b"]" for c, f in _LEVELS.items())
#: How gzip, zlib, zstd, bzip2 and xz data begin.
MAGIC = re.compile(rb"\x1f\x8b\x08|" + _ZLIB + rb"|\x28\xb5\x2f\xfd|BZh[1-9]|\xfd7zXZ\x00")
_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key", b"\\u", b"\\x", b"%", b"\n", b"\\n")
_RUN, _WIDE = re.compile(rb"[A-Za-z0-9+/_-]{16}"), re.compile(rb"[!-~]\x00[!-~]\x00")


def telling(data: bytes) -> bool:
    """False for bytes that certainly hold no secret and no further layer; the tests go from quick to slow."""
    low = data.lower()
    return any(x in low for x in _HINTS) or (b"\0" in data and bool(_WIDE.search(data))) or bool(MAGIC.search(data) or _RUN.search(data))


#: Bytes that inflated data may have to be held whole; more are read as a stream, in steps that overlap.
WHOLE, STEP, OVERLAP = 8 << 20, 1 << 20, 1 << 18
#: Bytes that no secret, escape or run of base64 goes across.
BREAKS = re.compile(rb"[^A-Za-z0-9+/_.=\-\"':%\\ \t\r\n>{}]")
#: What broken compressed data raise.
BROKEN = (zlib.error, zstandard.ZstdError, OSError, lzma.LZMAError, ValueError, EOFError)


@dataclass(frozen=True)
class Layer:
    """Text of a layer; character i comes from the original's code points low[i] to high[i]. None: the original."""

    text: str
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.low is None else (int(self.low[start:end].min()), int(self.high[start:end].max()))

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        if self.low is None:
            at = np.arange(len(self.text) + 1, dtype=np.int32)
            return at[:-1], at[1:]
        return self.low, self.high

    def key(self) -> tuple:
        """Equal for layers of equal text from equal places."""
        if not self.text or (self.low[0] == self.low[-1] and self.high[0] == self.high[-1]):
            return (self.text, *(int(x[0]) for x in (self.low, self.high) if self.text))
        return self.text, self.low.astype(np.int32).tobytes(), self.high.astype(np.int32).tobytes()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets that stand in the text as it is."""
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    return sorted(found)


def swapped(layer: Layer, one: re.Pattern, value) -> Layer | None:
    """The whole text with each escape replaced by the one character it stands for."""
    first = np.ones(len(layer.text), bool)

    def new(m: re.Match) -> str:
        got = value(m)
        if got is not None:
            first[m.start() + 1 : m.end()] = False
        return m[0] if got is None else got

    text = one.sub(new, layer.text)
    if first.all():
        return None
    low, high = layer.places()
    at = np.flatnonzero(first)
    return Layer(text, low[at], high[np.append(at[1:], len(first)) - 1])


def byte(code: int) -> str:
    """A byte as a character; those beyond ASCII become lone surrogates, so that the bytes can be had back."""
    return chr(code if code < 0x80 else 0xDC00 + code)


def percent_value(m: re.Match) -> str:
    return byte(int(m[1], 16))


def escape_value(m: re.Match) -> str | None:
    if m[3]:
        return byte(int(m[3], 16))
    code = int(m[1] or m[2] or m[4], 16)
    return None if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


class Inflater:
    """One compressed stream, read in bounded steps."""

    def __init__(self, start: bytes):
        makers = {b"\x28\xb5": lambda: zstandard.ZstdDecompressor().decompressobj(), b"BZ": bz2.BZ2Decompressor, b"\xfd7": lzma.LZMADecompressor, b"": partial(zlib.decompressobj, -15)}
        self.reader = makers.get(start[:2], partial(zlib.decompressobj, 47))()
        # A few bytes of zstd can stand for a block of 128 KB each, and its reader has no bound of its own.
        self.bounded, self.step = start[:2] != b"\x28\xb5", 64 if start[:2] == b"\x28\xb5" else 1 << 12
        self.eof = self.failed = False
        self.taken = 0

    def pieces(self, data: memoryview) -> Iterator[bytes]:
        """What the next bytes hold; ``taken`` counts the bytes of the stream so far."""
        for at in range(0, len(data), self.step):
            part = bytes(data[at : at + self.step])
            self.taken += len(part)
            while True:
                try:
                    got = self.reader.decompress(part, STEP) if self.bounded else self.reader.decompress(part)
                except BROKEN:
                    self.failed = True
                    return
                if got:
                    yield got
                if self.reader.eof:
                    self.eof = True
                    self.taken -= len(self.reader.unused_data)
                    return
                part = getattr(self.reader, "unconsumed_tail", b"")
                if not (part or (self.bounded and len(got) == STEP)):
                    break


class Stream:
    """Scans inflated bytes as they come. All stand for the same stretch of the original, so the kinds found are all that
    is kept; data packed inside go to a stream of their own."""

    def __init__(self) -> None:
        self.tail, self.kinds, self.open, self.seen = b"", set(), [], set()
        self.waiting, self.size = [], 0

    def feed(self, data: bytes) -> None:
        if len(self.kinds) < len(KINDS):
            self.waiting.append(data)
            self.size += len(data)
            if self.size >= STEP:
                self.read()

    def read(self) -> set[int]:
        """Scan what has come; the kinds so far."""
        data = b"".join(self.waiting)
        self.waiting, self.size = [], 0
        if len(self.kinds) == len(KINDS):
            return self.kinds
        self.open = [x for x in self.open if self.pass_on(*x, memoryview(data))]
        window, old = self.tail + data, len(self.tail)
        for m in MAGIC.finditer(window, max(0, old - 5)):
            inner = Inflater(m[0]), Stream()
            if m.end() > old and self.pass_on(*inner, memoryview(window)[m.start() :]):
                self.open.append(inner)
        # The same bytes again, as in data made to inflate, hold nothing new.
        mark = hashlib.blake2b(window, digest_size=16).digest()
        if mark not in self.seen and telling(window):
            place = (np.broadcast_to(np.int32(x), len(window)) for x in (0, 1))
            self.kinds.update(kind for _, kind, _ in explored(Layer(window.decode("ascii", "surrogateescape"), *place), set(), packed=False))
        if len(self.seen) < 1 << 16:
            self.seen.add(mark)
        cut = max(0, len(window) - OVERLAP)
        if m := BREAKS.search(window, cut):
            cut = m.end()
        self.tail = window[cut:]
        return self.kinds

    def pass_on(self, inflater: Inflater, inner: Stream, data: memoryview) -> bool:
        """Whether the stream inside goes on; only one that ends as it should counts."""
        for piece in inflater.pieces(data):
            inner.feed(piece)
        if inflater.eof:
            self.kinds |= inner.read()
        return not (inflater.eof or inflater.failed)


def inflated(data: memoryview) -> tuple[bytes, set[int], int] | None:
    """What the compressed data at the start of the bytes hold, with whole streams right behind, the kinds found in it if
    it is too much to be held, and the bytes these streams take."""
    out, size, taken, stream, kinds = [], 0, 0, None, set()
    while m := MAGIC.match(data[taken : taken + 8]):
        inflater, parts, n = Inflater(m[0]), [], 0
        for piece in inflater.pieces(data[taken:]):
            if stream is None:
                parts.append(piece)
                n += len(piece)
                if size + n > WHOLE:
                    stream = Stream()
                    for held in out + parts:
                        stream.feed(held)
                    out, parts = [], []
            else:
                stream.feed(piece)
        if not inflater.eof:
            break
        out, size, taken = out + parts, size + n, taken + inflater.taken
        kinds = set(stream.read()) if stream else kinds
    return (b"".join(out), kinds, taken) if taken else None


def unpacked(layer: Layer, found: set) -> list[Layer]:
    """What compressed data anywhere in the bytes of a decoded layer hold; all of it comes from the whole data."""
    data = layer.text.encode("utf-8", "surrogateescape")
    out, at, ends = [], 0, None
    while m := MAGIC.search(data, at):
        got = inflated(memoryview(data)[m.start() :])
        at = m.start() + 1
        if got is None:
            continue
        if ends is None:
            code = np.frombuffer(layer.text.encode("utf-32-le", "surrogatepass"), "<u4")
            # A byte beyond ASCII stands as a lone surrogate.
            ends = np.cumsum(np.where(code >> 7 == 0xDC80 >> 7, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)))
        held, kinds, taken = got
        first, last = np.searchsorted(ends, [m.start(), m.start() + taken - 1], "right").tolist()
        a, b = layer.span(first, last + 1)
        found.update((a, kind, b) for kind in kinds)
        if telling(held):
            out.append(Layer(held.decode("ascii", "surrogateescape"), *(np.broadcast_to(np.int32(x), len(held)) for x in (a, b))))
        at = m.start() + taken
    return out


def deflated(data: bytes, low: int, high: int, found: set) -> list[Layer]:
    """What raw deflate data hold, which have no mark of their own: all the bytes must be one stream."""
    inflater, stream, parts, size = Inflater(b""), None, [], 0
    for piece in inflater.pieces(memoryview(data)):
        parts.append(piece)
        size += len(piece)
        if stream is None and size > WHOLE:
            stream = Stream()
        if stream is not None:
            for held in parts:
                stream.feed(held)
            parts = []
    if not inflater.eof or inflater.taken < len(data):
        return []
    found.update((low, kind, high) for kind in (stream.read() if stream else ()))
    held = b"".join(parts)
    return [Layer(held.decode("ascii", "surrogateescape"), *(np.broadcast_to(np.int32(x), len(held)) for x in (low, high)))] if telling(held) else []


def from_base64(layer: Layer, start: int, end: int, found: set) -> list[Layer]:
    """Bytes of a stretch of base64 letters from each of its first four letters on, so that whatever stands before, behind
    or between is no hindrance; every byte comes from its group of four."""
    text, letter = layer.text[start:end], np.ones(end - start, bool)
    if "\n" in text or "\\" in text:
        for m in BREAK.finditer(text):
            letter[m.start() : m.end()] = False
        text = BREAK.sub("", text)
    body, out = text.rstrip("=").translate(URL_LETTERS), []
    if len(body) < LEAST_BASE64:
        return out
    place = None
    for first in range(4):
        n = len(body) - first
        n -= n % 4 == 1
        data = binascii.a2b_base64(body[first : first + n] + "=" * (-n % 4))
        if first == 0:
            out += deflated(data, *layer.span(start, end), found)
        if not telling(data):
            continue
        if place is None:
            low, high = layer.places()
            place = start + np.flatnonzero(letter)
        group = first + np.arange(len(data)) // 3 * 4
        out.append(Layer(data.decode("ascii", "surrogateescape"), low[place[group]], high[place[np.minimum(group + 4, len(text)) - 1]]))
    return out


def without_nulls(layer: Layer) -> Layer:
    """Text of two bytes a letter as it reads."""
    kept = np.frombuffer(layer.text.encode("utf-32-le", "surrogatepass"), "<u4") != 0
    low, high = layer.places()
    return Layer(layer.text.replace("\0", ""), low[kept], high[kept])


def unwrapped(layer: Layer, done: set, found: set, packed: bool = True) -> list[Layer]:
    """Layers directly inside this one; ``done``: stretches of base64 already decoded; ``found`` gets spans of data too
    large to be a layer. Without ``packed`` compressed data are left to the caller."""
    text, out = layer.text, []
    if "%" in text:
        out.append(swapped(layer, PERCENT, percent_value))
    if "\\" in text:
        out.append(swapped(layer, ESCAPED, escape_value))
    for m in BASE64.finditer(text):
        a, b = m.span()
        if b - a < LEAST_BASE64:
            continue
        # The same letters stand in every layer that differs from this one elsewhere.
        key = (m[0], a) if layer.low is None else (m[0], int(layer.low[a])) if exact(layer, a, b) else Layer(m[0], layer.low[a:b], layer.high[a:b]).key()
        if key not in done:
            done.add(key)
            out += from_base64(layer, a, b, found)
    if layer.low is not None and "\0" in text:
        out.append(without_nulls(layer))
    if layer.low is not None and packed:
        out += unpacked(layer, found)
    return [x for x in out if x is not None]


def exact(layer: Layer, start: int, end: int) -> bool:
    """Whether each character of the stretch is one of the original."""
    low, high = layer.low[start:end], layer.high[start:end]
    return bool((high - low == 1).all() and (np.diff(low) == 1).all())


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the text as it is, and these with the ones of all nested layers."""
    base, found = base_spans(text), set()
    return base, sorted(explored(Layer(text), found) | set(base))


def explored(first: Layer, found: set, packed: bool = True) -> set[tuple[int, int, int]]:
    """Spans of the secrets of a layer and of all layers inside it."""
    done, seen = set(), set()
    found.update(place(first, nested) for nested in base_spans(first.text))
    todo = unwrapped(first, done, found, packed)
    while todo:
        layer = todo.pop()
        # Another copy of a layer has its places elsewhere and is entered too; the same one again finds nothing new.
        if (key := layer.key()) in seen:
            continue
        seen.add(key)
        found.update(place(layer, nested) for nested in base_spans(layer.text))
        todo += unwrapped(layer, done, found)
    return found


def place(layer: Layer, nested: tuple[int, int, int]) -> tuple[int, int, int]:
    start, kind, end = nested
    low, high = layer.span(start, end)
    return low, kind, high


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def find(docs: DataFrame, text: str = "text", base: str = "base", spans: str = "spans", keep: bool = True) -> DataFrame:
    """Adds the secrets that stand in each whole text and all spans, nested ones included, by start and kind."""

    def work(col: pa.Array) -> list:
        both = [scan(t) for t in col.to_pylist()]
        return [[[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in row] for row in side] for side in ([b for b, _ in both], [s for _, s in both])]

    return map_text(docs, text, [T.StructField(base, T.ArrayType(SPAN)), T.StructField(spans, T.ArrayType(SPAN))], work, keep)


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: number of secrets of each kind in the text as it is, their digest, and all spans."""
    found = find(docs.select("doc_id", "text"), keep=False)
    counts = [F.size(F.filter(F.col("base.kind"), partial(operator.eq, F.lit(k)))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", chars: str | None = None) -> DataFrame:
    """The same rows with every span, nested ones included, replaced by its kind in brackets; null stays null.

    ``chars``: name of a column that holds the number of characters and is set anew.
    """
    new = fresh(docs, "clean")

    def work(col: pa.Array) -> list:
        return [[covered(t) for t in col.to_pylist()]]

    out = map_text(docs, text, [T.StructField(new, T.StringType())], work)
    clean = F.when(F.col(text).isNotNull(), F.col(new))
    length = {chars: F.when(F.col(text).isNotNull(), F.length(F.col(new))).otherwise(F.col(chars)).cast(docs.schema[chars].dataType)} if chars in docs.columns else {}
    return out.withColumns({**length, text: clean}).drop(new)


def covered(text: str) -> str:
    """The text with overlapping spans merged and replaced; the first kind names the merged span."""
    _, spans = scan(text)
    out, at = [], 0
    merged: list[list[int]] = []
    for a, k, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([a, k, b])
    for a, k, b in merged:
        out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join([*out, text[at:]])
