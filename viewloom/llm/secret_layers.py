"""Secrets in texts and in what the texts hold in encoded form.

A worklist starts with the text. Every layer is scanned, and its URL-escaped, Unicode-escaped, base64 and
compressed parts are unwrapped into further layers until nothing new turns up; a layer that holds itself
ends its branch, and a layer that stands in several places is scanned once and mapped to each.

Layers are bytes, written as strings with one character per byte, so that what an escape, a base64 run or
a compressed part hides may be text, UTF-16 or compressed again, in any order. Each byte of a layer knows
the span of the layer it came from, so a secret found three layers down is reported at the place in the
text that hides it. Compressed parts are unfolded piece by piece, however large, through all their members.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import sys
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.arrays import carried_types, pieces, runs, texts_of, with_short_batches

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_LAST_KEYWORD = re.compile(r"(?:password|passwd|secret|token|api_?key)=?\Z", re.A | re.I)
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")

#: Bytes of an unfolded part that are scanned at once, and how many of them are scanned again with the
#: next ones. What crosses such a border and is longer than the latter is seen in two parts.
PIECE = 16 << 20
OVERLAP = 1 << 20
#: Bytes of what base64 runs hold that a text keeps, should they come again.
REMEMBERED = 8 << 20
#: Characters of a base64 run worth decoding: the shortest secret has 14 bytes, which take 19.
BASE64_RUN = 16

_PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
_PERCENT_CHAIN = re.compile("%(?:25){3,}+")
_UNICODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_BASE64_LINE = re.compile("[A-Za-z0-9+/_-]{%d,}={0,2}" % BASE64_RUN)
#: A run and the runs on the lines around it; of those before, only one shorter line.
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/_-]{1,%d}+\r?\n[\x20\t]*+)?+[A-Za-z0-9+/_-]{%d,}+(?:\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)*+={0,2}" % (BASE64_RUN - 1, BASE64_RUN))
_LINE_END = re.compile(r"\r?\n[\x20\t]*")
#: What gzip, zlib, bzip2, xz and Zstandard bytes begin with.
_MAGIC = re.compile(r"\x1f\x8b\x08|x[\x01^\x9c\xda]|BZh[1-9](?=1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Bytes that each have a zero after or before them, as ASCII and other low characters do in UTF-16.
_WIDE = re.compile(r"(?:[\x00-\xff]\x00){12,}+|(?:\x00[\x00-\xff]){12,}+")
#: Bytes of whole UTF-8 characters without control characters, as many as a base64 run worth decoding has.
_READABLE = re.compile(
    r"(?:[\t\r\n\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    r"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}+"
)

#: Texts without any of these hold neither a secret nor a layer (a run of base64 letters is looked for apart).
_TRIGGER = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{12}|%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f{]|x[\x01^]|BZh[1-9]|\x00"""
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True

FOUND = (
    "base array<struct<kind: string, start: int, stop: int>>, "
    "spans array<struct<kind: string, start: int, stop: int>>, n_layers int"
)


@dataclass
class Layer:
    """Bytes as a string, and where those from a to b stand in what they were unwrapped from."""

    text: str
    place: Callable[[int, int], tuple[int, int]]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Secrets in one text: kind, start and end in code points."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def inner_spans(text: str) -> list[tuple[str, int, int]]:
    """Secrets in an unwrapped text. Text around a part may end a match inside it, so the search goes
    on from a keyword at a match's end; what it holds before that lies in the match."""
    found, at = base_spans(text), 0
    while m := ASSIGN.search(text, at):
        if len(m[2]) >= 8:
            found.append(("assign", *m.span()))
        last = _LAST_KEYWORD.search(text, max(m.start() + 1, m.end() - 9), m.end())
        at = last.start() if last else m.end()
    return found


def _replaced(text: str, escapes: Iterator[tuple[int, int, str, list[int]]]) -> Layer:
    """A text with its escapes (start, stop, characters, where each of them starts and the last ends)
    replaced; characters between them stand for themselves."""
    out, size, at = [], 0, 0
    where, lo, hi = [], [], []  # of the replaced characters only
    for start, stop, characters, starts in escapes:
        out += (text[at:start], characters)
        size += start - at
        where += range(size, size + len(characters))
        lo += starts[:-1]
        hi += starts[1:]
        size += len(characters)
        at = stop
    out.append(text[at:])

    def edge(i: int, ends: list[int], own: int) -> int:
        k = bisect_right(where, i) - 1
        if k < 0:
            return i + own
        return ends[k] if where[k] == i else hi[k] + i - where[k] - 1 + own

    return Layer("".join(out), lambda a, b: (edge(a, lo, 0), edge(b - 1, hi, 1)))


def unescape_url(text: str) -> Layer:
    """A layer with its percent escapes replaced by the bytes they stand for."""

    def escapes() -> Iterator[tuple[int, int, str, list[int]]]:
        for m in _PERCENT.finditer(text):
            decoded = bytes.fromhex(m[0].replace("%", "")).decode("latin-1")
            yield m.start(), m.end(), decoded, list(range(m.start(), m.end() + 1, 3))

    return _replaced(text, escapes())


def unescape_unicode(text: str) -> Layer:
    """A layer with its backslash escapes replaced: ``\\x`` by a byte, the others by the UTF-8 bytes of
    their character. A surrogate pair is one character; half of one is U+FFFD."""

    def shown(start: int, stop: int, point: int) -> tuple[int, int, str, list[int]]:
        point = 0xFFFD if point > 0x10FFFF or 0xD800 <= point < 0xE000 else point
        decoded = chr(point).encode().decode("latin-1")
        return start, stop, decoded, [start] * len(decoded) + [stop]

    def escapes() -> Iterator[tuple[int, int, str, list[int]]]:
        high: tuple[int, int, int] | None = None
        for m in _UNICODE.finditer(text):
            point = int(next(g for g in m.groups() if g), 16)
            if high and high[1] == m.start() and 0xDC00 <= point < 0xE000:
                yield shown(high[0], m.end(), 0x10000 + ((high[2] - 0xD800) << 10) + point - 0xDC00)
                high = None
                continue
            if high:
                yield shown(*high)
                high = None
            if 0xD800 <= point < 0xDC00:
                high = m.start(), m.end(), point
            elif m[4]:
                yield m.start(), m.end(), chr(point), [m.start(), m.end()]
            else:
                yield shown(m.start(), m.end(), point)
        if high:
            yield shown(*high)

    return _replaced(text, escapes())


class _Zstd:
    """Zstandard with the interface of the other decompressors."""

    def __init__(self):
        import zstandard

        self.inner, self.rest, self.unused_data = zstandard.ZstdDecompressor().decompressobj(), memoryview(b""), b""

    @property
    def eof(self) -> bool:
        return self.inner.eof

    @property
    def needs_input(self) -> bool:
        return not len(self.rest)

    def decompress(self, raw, limit: int) -> bytes:
        # A kilobyte unfolds to 32 MiB at most.
        self.rest = memoryview(raw) if len(raw) else self.rest
        part, self.rest = self.rest[:1024], self.rest[1024:]
        out = self.inner.decompress(part)
        if self.inner.eof:
            self.unused_data = self.inner.unused_data + bytes(self.rest)
        return out


class _Zlib:
    """gzip and zlib with the interface of the other decompressors."""

    def __init__(self, bits: int):
        self.inner = zlib.decompressobj(bits)

    @property
    def eof(self) -> bool:
        return self.inner.eof

    @property
    def unused_data(self) -> bytes:
        return self.inner.unused_data

    @property
    def needs_input(self) -> bool:
        return not self.inner.unconsumed_tail

    def decompress(self, raw, limit: int) -> bytes:
        return self.inner.decompress(raw if len(raw) else self.inner.unconsumed_tail, limit)


def _member(raw: memoryview):
    """A decompressor for what the bytes begin with, and how much of it other members begin with too."""
    head = bytes(raw[:6])
    if head[:3] == b"\x1f\x8b\x08":
        return _Zlib(31), head[:3]
    if head[:1] == b"x" and head[1:2] in (b"\x01", b"^", b"\x9c", b"\xda"):
        return _Zlib(15), head[:1]
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor(), head[:3]
    if head == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(), head
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return _Zstd(), head[:4]
    return None, b""


def _errors() -> tuple[type[Exception], ...]:
    try:
        import zstandard
    except ImportError:
        return zlib.error, OSError, EOFError, lzma.LZMAError
    return zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError


def unfold(raw: memoryview, used: list[int]) -> Iterator[bytes]:
    """What compressed bytes hold, in pieces of up to ``PIECE`` (or what one step gives), through all
    members that follow each other. ``used`` gets how many bytes they are, or 0 if they break off. What
    comes before an error counts; bytes that are none of these, or broken from the start, give nothing."""
    errors, at, held, size = _errors(), 0, [], 0
    opened, begin = _member(raw)
    while opened is not None:
        fed: memoryview | bytes = raw[at:]
        try:
            while not opened.eof:
                out = opened.decompress(fed, PIECE - size)
                fed = b""
                if out:
                    held.append(out)
                    size += len(out)
                elif opened.needs_input:
                    break  # cut short
                if size >= PIECE:
                    yield b"".join(held)
                    held, size = [], 0
        except errors:
            break
        if not opened.eof:
            break
        at = used[0] = len(raw) - len(opened.unused_data)
        if bytes(raw[at : at + len(begin)]) != begin:
            break
        opened, begin = _member(raw[at:])
    if held:
        yield b"".join(held)


def _compressed(text: str) -> Iterator[tuple[int, int, str]]:
    """The compressed parts of a layer: where they stand (a broken one up to the layer's end), and what
    they hold, in pieces that overlap. Within a broken part the search goes on."""
    raw, at = None, 0
    while m := _MAGIC.search(text, at):
        raw = text.encode("latin-1") if raw is None else raw
        used, before, held = [0], "", None
        for piece in unfold(memoryview(raw)[m.start() :], used):
            if held is not None:
                yield m.start(), len(text), held
            held = before + piece.decode("latin-1")
            before = held[-OVERLAP:]
        at = m.start() + max(used[0], 1)
        if held is not None:  # the last piece; only now it is known where the part ends
            yield m.start(), at if used[0] else len(text), held


def _narrow(wide: str) -> str:
    """Every other byte of a wide run, those that are not its zeros."""
    return wide[1::2] if not wide[::2].strip("\0") else wide[::2]


def _inside(raw: str, place: Callable[[int, int], tuple[int, int]], whole: Callable[[int, int], tuple[int, int]]) -> Iterator[Layer]:
    """Layers in decoded bytes: what is compressed, UTF-16 or readable. ``place`` says where bytes stand,
    ``whole`` where a compressed part does."""
    for a, b, held in _compressed(raw):
        lo, hi = whole(a, b)
        yield Layer(held, lambda x, y, lo=lo, hi=hi: (lo, hi))
    for m in _WIDE.finditer(raw):
        start = m.start()
        yield Layer(_narrow(m[0]), lambda a, b, start=start: place(start + 2 * a, start + 2 * b))
    for m in _READABLE.finditer(raw):
        start = m.start()
        yield Layer(m[0], lambda a, b, start=start: place(start + a, start + b))


def decode_base64(part: str) -> Iterator[Layer]:
    """What a base64 run holds, compressed, UTF-16 or readable.

    Something may be glued to either end of the run, so each of the four alignments is tried, readable
    bytes need not fill the run, and compressed ones may begin anywhere in it. Line ends are skipped.
    """
    breaks, kept, skipped = [], [], []  # the places in the joined lines after which so much was left out
    at = out = 0
    for m in _LINE_END.finditer(part):
        kept.append(part[at : m.start()])
        at = m.end()
        out += m.end() - m.start()
        breaks.append(m.end() - out)
        skipped.append(out)
    body = "".join([*kept, part[at:]]).rstrip("=")
    own = lambda i: i + (skipped[k - 1] if (k := bisect_right(breaks, i)) else 0)
    plain = body.replace("-", "+").replace("_", "/")
    for shift in range(4):
        n = len(plain) - shift
        n -= n % 4 == 1
        raw = base64.b64decode(plain[shift : shift + n] + "=" * (-n % 4)).decode("latin-1")

        def place(a: int, b: int, shift: int = shift) -> tuple[int, int]:
            return own(shift + 4 * (a // 3) + a % 3), own(shift + 4 * ((b - 1) // 3) + (b - 1) % 3 + 1) + 1

        def whole(a: int, b: int, size: int = len(raw), place=place) -> tuple[int, int]:
            lo, hi = place(a, b)
            return lo, hi if b < size else len(part)

        yield from _inside(raw, place, whole)


def _base64(run: str, opened: dict[str, list[Layer]]) -> Iterator[Layer]:
    """The layers of a run; those of a small one are kept for when it comes again."""
    if run in opened:
        yield from opened[run]
        return
    found, size = [], len(run)
    for layer in decode_base64(run):
        size += len(layer.text)
        if size <= REMEMBERED:
            found.append(layer)
        yield layer
    if size + sum(map(len, opened)) <= REMEMBERED:
        opened[run] = found


def _parts(text: str, opened: dict[str, list[Layer]]) -> Iterator[tuple[int, Layer]]:
    """What a layer unwraps to: the start of a part, and the layer in it. URL and Unicode escapes are
    replaced in the whole layer, as a secret's keyword may stand outside them."""
    if _PERCENT_CHAIN.search(text):  # escapes of escapes of escapes: all but the last at once
        yield 0, _replaced(text, ((m.start(), m.end(), "%25", [m.start(), m.start() + 1, m.start() + 2, m.end()]) for m in _PERCENT_CHAIN.finditer(text)))
    elif _PERCENT.search(text):
        yield 0, unescape_url(text)
    if _UNICODE.search(text):
        yield 0, unescape_unicode(text)
    for a, b, held in _compressed(text):
        yield a, Layer(held, lambda x, y, size=b - a: (0, size))
    for m in _WIDE.finditer(text):
        yield m.start(), Layer(_narrow(m[0]), lambda a, b: (2 * a, 2 * b))
    for m in _BASE64.finditer(text):
        for run in [m] if "\n" not in m[0] else [m, *_BASE64_LINE.finditer(text, *m.span())]:
            for layer in _base64(run[0], opened):
                yield run.start(), layer


class _Opened:
    """A layer whose parts are being opened: what was found in it so far, in its own places."""

    def __init__(self, key: bytes, spans: list[tuple[str, int, int]], parts: Iterator, start: int = 0, via: Layer | None = None):
        self.key, self.start, self.via = key, start, via
        self.found, self.parts = set(spans), parts
        self.cycle = sys.maxsize  # least depth of the layers below which this one holds again

    def add(self, start: int, inner: Layer, spans: set[tuple[str, int, int]]) -> None:
        for kind, a, b in spans:
            lo, hi = inner.place(a, b)
            self.found.add((kind, start + lo, start + hi))


def _key(text: str) -> bytes:
    return hashlib.blake2b(text.encode("latin-1"), digest_size=16).digest()


def _root(text: str) -> Layer:
    """The text's UTF-8 bytes, and the characters they belong to. A lone surrogate counts as three bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        return Layer(text, lambda a, b: (a, b))
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    own = lambda i: int(np.searchsorted(starts, i, "right")) - 1
    return Layer(raw.decode("latin-1"), lambda a, b: (own(a), own(b - 1) + 1))


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans, all spans, and how many different layers were opened."""
    order = {k: i for i, k in enumerate(KINDS)}
    ranked = lambda found: sorted(found, key=lambda x: (x[1], order[x[0]], x[2]))
    base, root = base_spans(text), _root(text)
    done: dict[bytes, set[tuple[str, int, int]]] = {}  # spans of a layer, in its own places
    opened: dict[str, list[Layer]] = {}  # base64 runs
    path = [_Opened(_key(root.text), [], _parts(root.text, opened))]
    depths, layers = {path[0].key: 0}, set()
    while True:
        here = path[-1]
        for start, inner in here.parts:
            key = _key(inner.text)
            if key in depths:
                here.cycle = min(here.cycle, depths[key])
            elif key in done:
                here.add(start, inner, done[key])
            else:
                layers.add(key)
                depths[key] = len(path)
                path.append(_Opened(key, inner_spans(inner.text), _parts(inner.text, opened), start, inner))
                break
        else:
            path.pop()
            del depths[here.key]
            if not path:
                deep = {(kind, *root.place(a, b)) for kind, a, b in here.found}
                return ranked(base), ranked({*base, *deep}), len(layers)
            path[-1].add(here.start, here.via, here.found)
            if here.cycle >= len(path):  # whole: no layer above it was left out of it
                done[here.key] = here.found
            else:
                path[-1].cycle = min(path[-1].cycle, here.cycle)


def _scan(batches: Iterator[pa.RecordBatch], carried: tuple[str, ...] = ("doc_id", "text")) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for piece in pieces(batches):
        column = piece.column("text").combine_chunks()
        texts = texts_of(column)
        wanted = pc.fill_null(pc.match_substring_regex(column, _TRIGGER), False).to_numpy(zero_copy_only=False).copy()
        starts, ends = runs(_RUN[texts.data], texts.at)
        wanted[np.searchsorted(texts.at, starts[ends - starts >= BASE64_RUN], "right") - 1] = True
        rows = [([], [], 0)] * len(texts)
        for i in np.flatnonzero(wanted).tolist():
            rows[i] = scan(texts.bytes_of(i).decode())
        base, spans, layers = zip(*rows)
        as_rows = lambda lists: pa.array([[dict(zip(("kind", "start", "stop"), s)) for s in x] for x in lists], shape)
        yield pa.RecordBatch.from_arrays(
            [*(piece.column(c).combine_chunks() for c in carried), as_rows(base), as_rows(spans), pa.array(layers, pa.int32())],
            names=[*carried, "base", "spans", "n_layers"],
        )


def find_secrets(docs: DataFrame, carried: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Rows (doc_id, text, base, spans, n_layers), one per document; ``carried`` names other
    columns to keep, among them the text.

    ``base`` are the secrets of the text itself, ``spans`` also those of its layers, as (kind, start,
    stop) in code points. Null text counts as empty; null or repeated ids stay rows of their own;
    columns that are not carried are ignored. Nothing is shuffled; a worker holds one piece of the
    scan at a time.
    """
    return with_short_batches(docs).select(*carried).mapInArrow(lambda batches: _scan(batches, carried), carried_types(docs, carried) + FOUND)


def joined_spans(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, by: str = "[secret]") -> Column:
    """The text with every span replaced, spans that overlap or touch once."""

    def step(state: Column, s: Column) -> Column:
        apart = (s["start"] > state["at"]) | (F.size(state["out"]) == 0)
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        shown = F.when(apart, F.concat(state["out"], F.array(between, F.lit(by)))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), shown.alias("out"))

    def rest(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substr(text, state["at"] + 1))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, first, step, rest)).otherwise(text)
