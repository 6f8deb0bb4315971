"""Secret scans: base kinds on the text itself, and the same kinds on every layer that decoding unwraps.

A worklist starts with the text. Each layer is scanned; then it is decoded to new layers, unless a layer of that content
at that place was seen for this text already (which ends cycles). All percent escapes, or all \\u escapes, are decoded
at once over the whole layer; base64 runs, over line breaks and at each of the four alignments, are layers of their own, as
is zlib, gzip, bz2 or xz data in decoded bytes, and deflate data without a head that they begin with. Other escapes (HTML, quoted-printable),
other base64 letters, base32, hex, zstd, lz4 and archives' directories are out. Compressed data is read as a stream, in pieces that end where no finding or run can
stand, so that memory doesn't grow with what it unpacks to; nothing of it is left out. Each letter of a layer keeps its place in the text itself: exact for escapes and base64,
the whole run for compressed data. A finding that touches nothing decoded by its layer's step is its parent's and not repeated.
Base findings always stay.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import lean

# The kinds in their listed order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same as [0-9a-f]+ and then 32 or more
LEAST_VALUE, LEAST_ACCESS = 8, 16

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
PERCENT_RUN = re.compile(r"[^\s%\"'<>]?%[0-9A-Fa-f]{2}(?:[^\s%\"'<>]|%[0-9A-Fa-f]{2})*")  # one letter before: zlib data starts with x
#: Code points as \\uXXXX (or two of them), \\u{X...}, \\UXXXXXXXX, \\xXX and %uXXXX.
ESCAPED = re.compile(r"[\\%]u[dD][89abAB][0-9A-Fa-f]{2}[\\%]u[dD][c-fC-F][0-9A-Fa-f]{2}|[\\%]u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
ESCAPES = ("\\u", "\\U", "\\x", "%u")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
NO_BASE64 = re.compile(r"[^A-Za-z0-9+/_-]")
BASE64_LETTER = np.array([bool(re.match("[A-Za-z0-9+/_-]", chr(c))) for c in range(128)])
PERCENT_BYTE = re.compile(rb"%([0-9A-Fa-f]{2})")
#: A zlib stream begins with two bytes: method 8 and a window of at most 32 KB, no dictionary, and together a multiple of 31.
ZLIB = [re.escape(bytes([a])) + b"[" + b"".join(re.escape(bytes([b])) for b in range(256) if (256 * a + b) % 31 == 0 and not b & 0x20) + b"]" for a in range(0x08, 0x80, 0x10)]
PACKED = re.compile(b"|".join([rb"\x1f\x8b\x08", rb"BZh[1-9](?:1AY&SY|\x17rE8P\x90)", rb"\xfd7zXZ\0", *ZLIB]))
LONGEST_HEAD = 10
#: Memory that an xz stream may ask for at most; others are out.
MOST_XZ = 80 << 20
#: Bytes that are unpacked at once, and of a piece of a stream.
STEP, PIECE = 1 << 16, 1 << 19
#: Bytes that no finding, escape or base64 run holds: a stream may be cut after them.
CUT = np.array([c > 127 or chr(c) in ",;(){}<>|!?*&#@^~$[]" for c in range(256)])
LONE = re.compile("[\ud800-\udfff]")
MARKS = re.compile("pass|secret|token|api", re.I | re.A)

Span = tuple[str, int, int]
NAMES = ("kind", "start", "end", "path", "inner_start", "inner_end")


def scan(text: str) -> list[Span]:
    """Findings of the base kinds in one layer, by start and then by kind."""
    found = []
    if MARKS.search(text):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


@dataclass
class Layer:
    """A text whose letter i comes from start[i]:end[i] of the text itself; fresh[i]: by this layer's own step. base: the
    letters of its stream before it, where it's a piece of one."""

    text: str
    start: np.ndarray
    end: np.ndarray
    fresh: np.ndarray
    path: str = ""
    exact: bool = True
    base: int = 0

    @staticmethod
    def whole_run(text: str, lo: int, hi: int, path: str, base: int) -> Layer:
        """A layer of which only the outermost run is known, without an array for its letters."""
        n = len(text)
        return Layer(text, np.broadcast_to(np.int64(lo), n), np.broadcast_to(np.int64(hi), n), np.broadcast_to(True, n), path, False, base)

    def key(self) -> tuple[bytes, int, int]:
        return _head(self.text.encode(errors="surrogatepass")), int(self.start[0]), self.base

    def touched(self, lo: int, hi: int) -> bool:
        return bool(self.fresh[lo:hi].any())

    def place(self, lo: int, hi: int) -> tuple[int, int]:
        return int(self.start[lo:hi].min()), int(self.end[lo:hi].max())


def _head(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _letters(raw: bytes) -> tuple[str, np.ndarray]:
    """Bytes as UTF-8, each that doesn't fit as U+FFFD, and how many bytes each letter takes."""
    text = raw.decode(errors="surrogateescape")
    return LONE.sub("\ufffd", text), np.array([1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text], np.int64)


def _spliced(layer: Layer, name: str, pattern: re.Pattern, decode: Callable[[str], tuple[str, np.ndarray]]) -> Layer | None:
    """The whole layer with each match decoded, to letters that take so many of the match's letters each."""
    out, start, end, fresh, last = [], [], [], [], 0
    for m in pattern.finditer(layer.text):
        new, widths = decode(m[0])
        edge = m.start() + np.r_[0, np.cumsum(widths)]
        out += [layer.text[last : m.start()], new]
        if layer.exact:
            start += [layer.start[last : m.start()], layer.start[edge[:-1]]]
            end += [layer.end[last : m.start()], layer.end[edge[1:] - 1]]
        fresh += [np.zeros(m.start() - last, bool), np.ones(len(new), bool)]
        last = m.end()
    if not out:
        return None
    rest = len(layer.text) - last
    text = "".join([*out, layer.text[last:]])
    if not layer.exact:  # findings that touch nothing decoded are the parent's
        lo, hi = layer.place(0, len(layer.text))
        return Layer(text, np.broadcast_to(np.int64(lo), len(text)), np.broadcast_to(np.int64(hi), len(text)), np.concatenate([*fresh, np.zeros(rest, bool)]),
                     f"{layer.path}/{name}", False, layer.base)
    return Layer(text, np.concatenate([*start, layer.start[last:]]), np.concatenate([*end, layer.end[last:]]),
                 np.concatenate([*fresh, np.zeros(rest, bool)]), f"{layer.path}/{name}", layer.exact)


def _percent(run: str) -> tuple[str, np.ndarray]:
    text, widths = _letters(bytes.fromhex(run.replace("%", "")))
    return text, 3 * widths


def _unit(run: str) -> tuple[str, np.ndarray]:
    if run[1] in "Ux" or run[2] == "{":
        code = int(run[2:].strip("{}"), 16)
        return (chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"), np.array([len(run)])
    run = run.replace("%u", "\\u")
    out = b"".join(int(u, 16).to_bytes(2, "little") for u in run.split("\\u")[1:]).decode("utf-16-le", "replace")
    return out[:1], np.array([len(run)])


def _utf16(raw: bytes, odd: int) -> str:
    return LONE.sub("\ufffd", raw[odd : len(raw) - (len(raw) - odd) % 2].decode("utf-16-le", "surrogatepass"))


def _last_cut(raw: np.ndarray) -> int:
    """Where the last place is at which a stream may be cut, or 0: after such a byte, but not inside a UTF-8 letter, or in zeros."""
    ok = CUT[raw[:-1]] & ((raw[1:] < 0x80) | (raw[1:] > 0xBF))
    zero = raw == 0
    ok[3:] |= zero[:-4] & zero[1:-3] & zero[2:-2] & zero[3:-1]
    at = np.flatnonzero(ok)
    return int(at[-1]) + 1 if len(at) else 0


class _Buffered:
    """A bz2 or xz stream as zlib's objects are: what it can't give out at once it keeps."""

    unconsumed_tail = b""

    def __init__(self, z: bz2.BZ2Decompressor | lzma.LZMADecompressor):
        self.z = z

    eof = property(lambda self: self.z.eof)
    unused_data = property(lambda self: self.z.unused_data)

    def decompress(self, data: bytes, most: int) -> bytes:
        return self.z.decompress(data, most)


def _opened(data: bytes) -> zlib._Decompress | _Buffered | None:
    """What reads a stream that begins so."""
    if not PACKED.match(data):
        return None
    if data[:3] == b"BZh":
        return _Buffered(bz2.BZ2Decompressor())
    if data[:1] == b"\xfd":
        return _Buffered(lzma.LZMADecompressor(lzma.FORMAT_XZ, memlimit=MOST_XZ))
    return zlib.decompressobj(47)


class _Unpacker:
    """Reads one compressed stream, or some that follow each other, fed in parts; yields the layers of what they hold. raw: deflate
    data without any head, just one stream."""

    def __init__(self, lo: int, hi: int, path: str, above: frozenset[bytes], raw: bool = False):
        self.pieces, self.held, self.done, self.some, self.used = _Pieces(lo, hi, path, above), b"", False, False, 0
        self.z, self.raw = zlib.decompressobj(-15) if raw else None, raw

    def feed(self, data: bytes) -> Iterator[Layer]:
        data, self.held = self.held + data, b""
        more = True
        while more and not self.done:
            if self.z is None:
                if len(data) < LONGEST_HEAD and self.some and not self.raw:
                    self.held = data
                    return
                self.z = None if self.raw else _opened(data)
                if self.z is None:
                    self.done = True
                    return
            before = len(data)
            try:
                out = self.z.decompress(data, STEP)
            except (zlib.error, OSError, EOFError, lzma.LZMAError):
                self.done = True
                return
            data = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            self.used += before - len(data)
            if out:
                self.some = True
                yield from self.pieces.feed(out)
            more = bool(data) or len(out) == STEP
            if self.z.eof:
                self.z = None

    def close(self) -> Iterator[Layer]:
        yield from self.pieces.close()


class _Pieces:
    """A stream of bytes, fed in parts, as layers of pieces; compressed data inside is unpacked as it comes."""

    def __init__(self, lo: int, hi: int, path: str, above: frozenset[bytes], base: int = 0):
        self.lo, self.hi, self.path, self.above = lo, hi, path, above
        self.held, self.least, self.end, self.inner = bytearray(), PIECE, b"", []
        self.base, self.letters, self.bytes, self.read = base, 0, 0, 0

    def feed(self, part: bytes) -> Iterator[Layer]:
        for u in self.inner:
            yield from u.feed(part)
        near = self.end + part
        for m in PACKED.finditer(near):
            # A stream that begins like one that it stands in is a cycle.
            if m.end() > len(self.end) and (head := _head(near[m.start() :])) not in self.above:
                at = self.read - len(self.end) + m.start()
                self.inner.append(_Unpacker(self.lo, self.hi, f"{self.path}/packed@{at}" if at else f"{self.path}/packed", self.above | {head}))
                yield from self.inner[-1].feed(near[m.start() :])
        for u in self.inner:
            if u.done:
                yield from u.close()
        self.inner = [u for u in self.inner if not u.done]
        self.read += len(part)
        self.end = near[1 - LONGEST_HEAD :]
        self.held += part
        if len(self.held) >= self.least:
            cut = _last_cut(np.frombuffer(bytes(self.held), np.uint8))
            if cut:
                yield from self._layers(bytes(self.held[:cut]))
                del self.held[:cut]
            self.least = PIECE if cut else 2 * self.least

    def close(self) -> Iterator[Layer]:
        for u in self.inner:
            yield from u.close()
        if self.held:
            yield from self._layers(bytes(self.held))
        self.held = bytearray()

    def _layers(self, raw: bytes) -> Iterator[Layer]:
        text = LONE.sub("\ufffd", raw.decode(errors="surrogateescape"))
        yield Layer.whole_run(text, self.lo, self.hi, self.path, self.base + self.letters)
        if 4 * raw.count(0) >= len(raw) > 1:
            for odd in (0, 1):
                yield Layer.whole_run(_utf16(raw, odd), self.lo, self.hi, f"{self.path}/utf16", self.base + self.bytes // 2)
        self.letters += len(text)
        self.bytes += len(raw)


def _packed(raw: bytes, lo: int, hi: int, path: str) -> Iterator[Layer]:
    """Layers of what each zlib or gzip stream in the bytes holds."""
    at = 0
    while m := PACKED.search(raw, at):
        at, begin = m.start() + 1, m.start()
        u = _Unpacker(lo, hi, f"{path}/packed@{begin}" if begin else f"{path}/packed", frozenset([_head(raw[begin : begin + STEP])]))
        for k in range(begin, len(raw), STEP):
            yield from u.feed(raw[k : k + STEP])
            if u.done:
                break
        yield from u.close()
        if u.some:
            at = max(at, begin + u.used)
    if at == 0 and len(raw) > 2:  # nothing begins as a stream does: deflate data may do without
        u = _Unpacker(lo, hi, f"{path}/deflate", frozenset([_head(raw[:STEP])]), raw=True)
        for k in range(0, len(raw), STEP):
            yield from u.feed(raw[k : k + STEP])
            if u.done:
                break
        yield from u.close()


def _layers(raw: bytes, start: np.ndarray, end: np.ndarray, path: str) -> Iterator[Layer]:
    """The texts that decoded bytes, each with its exact place, may be: UTF-8, UTF-16 and what compressed data in them holds."""
    text, widths = _letters(raw)
    edge = np.r_[0, np.cumsum(widths)]
    yield Layer(text, start[edge[:-1]], end[edge[1:] - 1], np.ones(len(text), bool), path)
    for odd in (0, 1) if 4 * raw.count(0) >= len(raw) > 1 else ():
        text = _utf16(raw, odd)
        unit = np.cumsum([0, *(2 if c > "\uffff" else 1 for c in text)])
        yield Layer(text, start[odd::2][unit[:-1]], end[odd + 1 :: 2][unit[1:] - 1], np.ones(len(text), bool), f"{path}/utf16")
    yield from _packed(raw, int(start.min()), int(end.max()), path)


def decoded(layer: Layer) -> Iterator[Layer]:
    """The layers that one decoding turns this one into."""
    text = layer.text
    if "%" in text:
        if (out := _spliced(layer, "percent", PERCENT, _percent)) is not None:
            yield out
        for m in PERCENT_RUN.finditer(text):
            if layer.touched(*m.span()):
                raw = PERCENT_BYTE.sub(lambda x: bytes([int(x[1], 16)]), m[0].encode(errors="replace"))
                lo, hi = layer.place(*m.span())
                yield from _packed(raw, lo, hi, f"{layer.path}/percent")
    if any(e in text for e in ESCAPES) and (out := _spliced(layer, "u", ESCAPED, _unit)) is not None:
        yield out
    for m in BASE64.finditer(text):
        if not layer.touched(*m.span()):
            continue
        if not layer.exact:  # decoded as a stream; places in it count from the run's own
            lo, hi = layer.place(*m.span())
            for k in range(4):
                yield from _base64_pieces(text, m.start(), m.end(), k, _Pieces(lo, hi, f"{layer.path}/base64", frozenset(), layer.base + m.start()))
            continue
        run = np.frombuffer(m[0].encode("ascii"), np.uint8)
        at = m.start() + np.flatnonzero(BASE64_LETTER[run])
        body = _base64_letters(m[0])
        for k in range(4):
            own = body[k:]
            own = own[: len(own) - (len(own) % 4 == 1)]
            raw = base64.b64decode(own + "=" * (-len(own) % 4))
            bit = 8 * np.arange(len(raw))
            if len(raw):
                yield from _layers(raw, layer.start[at[k + bit // 6]], layer.end[at[k + (bit + 7) // 6]], f"{layer.path}/base64")


def _base64_letters(run: str) -> str:
    return NO_BASE64.sub("", run).replace("-", "+").replace("_", "/")


def _base64_pieces(text: str, lo: int, hi: int, skip: int, pieces: _Pieces) -> Iterator[Layer]:
    """Layers of a base64 run, text[lo:hi], of which the first letters are skipped."""
    rest = ""
    for at in range(lo, hi, STEP):
        rest += _base64_letters(text[at : min(at + STEP, hi)])
        rest, skip = rest[skip:], max(0, skip - len(rest))
        whole = len(rest) // 4 * 4
        yield from pieces.feed(base64.b64decode(rest[:whole]))
        rest = rest[whole:]
    if len(rest) > 1:
        yield from pieces.feed(base64.b64decode(rest + "=" * (-len(rest) % 4)))
    yield from pieces.close()


def findings(text: str | None) -> tuple[list[Span], list[tuple]]:
    """(base findings, all as (kind, start, end, path, inner start, inner end)) in code points of the text, one for each
    secret; path names the decodings of its layer, and the inner ones are its place there."""
    text = text or ""
    base = scan(text)
    found = {f: (*f, "", f[1], f[2]) for f in base}
    if not ("%" in text or any(e in text for e in ESCAPES) or BASE64.search(text)):
        return base, list(found.values())
    every = np.arange(len(text) + 1)
    first = Layer(text, every[:-1], every[1:], np.ones(len(text), bool))
    # The deepest layers first: what waits are generators, not layers.
    work, seen = [decoded(first)], {first.key()}
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text or (key := layer.key()) in seen:
            continue
        seen.add(key)
        for kind, lo, hi in scan(layer.text):
            if layer.touched(lo, hi):
                place, inner = (kind, *layer.place(lo, hi)), (lo + layer.base, hi + layer.base)
                found.setdefault(place if layer.exact else (*place, layer.path, *inner), (*place, layer.path, *inner))
        work.append(decoded(layer))
    return base, sorted(found.values(), key=lambda f: (f[1], KINDS.index(f[0]), *f[2:]))


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base findings, all findings) by place alone."""
    base, every = findings(text)
    return base, [f[:3] for f in every]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): base has (kind, start, end), and spans also (path, inner_start, inner_end), for every whole text;
    null is empty and has none. Each row is scanned by itself, however long: repeated rows get equal results, null ids stay, no rows
    give none. Findings that begin at one place stand in the order of KINDS. Only the two named columns are read."""

    def lists(found: list[list[tuple]], names: tuple[str, ...]) -> pa.Array:
        flat = [f for part in found for f in part]
        columns = [pa.array([f[k] for f in flat], pa.string() if n in ("kind", "path") else pa.int32()) for k, n in enumerate(names)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.StructArray.from_arrays(columns, list(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [findings(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), lists([f[0] for f in found], NAMES[:3]), lists([f[1] for f in found], NAMES)], ["id", "base", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    one = "array<struct<kind:string,start:int,end:int>>"
    more = "array<struct<kind:string,start:int,end:int,path:string,inner_start:int,inner_end:int>>"
    return lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, base {one}, spans {more}").withColumnRenamed("id", id_col)


def digest(found: DataFrame) -> DataFrame:
    """From find_secrets(): counts of each base kind, a digest of the base spans, and all spans as text."""
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    keep = [c for c in found.columns if c not in ("base", "spans")]
    return found.select(*keep, *(count(k) for k in KINDS), F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))
