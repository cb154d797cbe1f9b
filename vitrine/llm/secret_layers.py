r"""Secret scan through nested encodings.

A text is a layer whose characters know where they come from. Each layer is scanned, and what it hides
goes on a worklist as further layers: percent escapes, Unicode escapes, base64 and compressed bytes.
That goes on until nothing new appears; a layer of equal content and place is not taken up twice, so
content that unpacks to itself ends. A finding of any layer is given by its place in the original
text: the characters that its first and last character stem from.

- Percent escapes (`%41`) and Unicode escapes (`\u0041`, `\u{41}`, `\U00000041`, `\x41`, `&#65;`, `&#x41;`) are
  unwrapped line by line: no secret spans lines. Runs of escaped bytes are UTF-8, else one character a byte;
  then a second layer has every escaped byte as one character, for compressed bytes in escapes.
- Base64 (both alphabets, padded or not, also in lines of 60 or more) is tried on every run of 16 or more.
- Compressed bytes are gzip, zlib, bzip2, xz and zstandard, behind any of the above.

A compressed layer is unpacked up to LAYER_BYTES, and the layers of a text up to TEXT_BYTES together; what would
need more is not passed over but reported as a finding of kind `packed` over its place. Chains of
`%2525...` and `\u005c...` longer than CHAIN are unwrapped in one step.

Defined cases: a null text is empty and has no findings; repeated rows each get theirs; equal findings
of several layers count once, by the layer found first. Other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens

#: Kinds in the order in which findings of one start are listed.
KINDS = ("assign", "access", "hex", "packed")
LEAST_VALUE = 6
LAYER_BYTES = 64 << 20
TEXT_BYTES = 256 << 20
CHAIN = 16
#: Compressed bytes unpacked at a time.
STEP_BYTES = 4_096
#: Letters of the names in either case, ASCII only.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: A run that is long enough; shorter ones have no longer part, so least lengths may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Texts without any of these have no base finding, or nothing to unwrap (superset, for RE2).
BASE_HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
LAYER_HINT = r"%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}"

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?P<bytes>(?:\\x[0-9A-Fa-f]{2})+)|(?P<units>(?:\\u[0-9A-Fa-f]{4})+)|\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}"
    r"|\\U(?P<long>[0-9A-Fa-f]{8})|&#x(?P<entity>[0-9A-Fa-f]{1,6});|&#(?P<decimal>[0-9]{1,7});")
_CHAINS = (re.compile(r"%%(?:25){%d,}" % CHAIN), re.compile(r"\\u005[cC](?:u005[cC]){%d,}" % CHAIN), re.compile(r"\\x5[cC](?:x5[cC]){%d,}" % CHAIN))
_CHAIN_HEADS = (3, 6, 4)
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/_-]{60,}\r?\n)*[A-Za-z0-9+/_-]{4,}={0,2}")
_LONG_ENOUGH = 16
_URL_SAFE = str.maketrans("-_", "+/", "\r\n")
_MAGIC = re.compile(r"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_BYTES = re.compile(r"[\x00-\xff]+")


@dataclass(frozen=True)
class Layer:
    """A text and, for each character, where its origin starts and ends in the original."""

    text: str
    lo: np.ndarray
    hi: np.ndarray
    path: str

    def part(self, a: int, b: int) -> tuple[int, int]:
        return int(self.lo[a]), int(self.hi[b - 1])


class Oversize(Exception):
    """Compressed bytes that hold more than the limit."""


# ------------------------------------------------------------------------------- unwrapping
def _as_text(data: bytes) -> tuple[str, list[int] | None]:
    """The bytes as UTF-8 and the length of each character in bytes, or one character a byte (None)."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1"), None
    return text, None if len(text) == len(data) else [len(c.encode()) for c in text]


class _Rewriter:
    """Puts a layer together from kept and replaced stretches of another."""

    def __init__(self, layer: Layer, step: str):
        self.layer, self.step = layer, step
        self.text: list[str] = []
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.at = 0

    def keep(self, until: int) -> None:
        if until > self.at:
            self.text.append(self.layer.text[self.at : until])
            self.lo.append(self.layer.lo[self.at : until])
            self.hi.append(self.layer.hi[self.at : until])
        self.at = until

    def put(self, start: int, end: int, text: str, edges: np.ndarray) -> None:
        """Replace [start, end) by a text whose character k stems from [edges[k], edges[k + 1])."""
        self.keep(start)
        self.text.append(text)
        self.lo.append(self.layer.lo[edges[:-1]])
        self.hi.append(self.layer.hi[edges[1:] - 1])
        self.at = end

    def done(self) -> Layer:
        self.keep(len(self.layer.text))
        if not self.lo:
            return Layer("", self.layer.lo[:0], self.layer.hi[:0], self.step)
        path = f"{self.layer.path}>{self.step}" if self.layer.path else self.step
        return Layer("".join(self.text), np.concatenate(self.lo), np.concatenate(self.hi), path)


def _edges(start: int, step: int, lengths: list[int] | None, n: int) -> np.ndarray:
    sizes = np.ones(n, np.int64) if lengths is None else np.array(lengths, np.int64)
    return start + step * np.concatenate(([0], np.cumsum(sizes)))


def shorten(layer: Layer) -> Layer:
    """Long chains of escaped escapes as one escape, which stems from the whole chain."""
    for pattern, head in zip(_CHAINS, _CHAIN_HEADS):
        if pattern.search(layer.text):
            made = _Rewriter(layer, "chain")
            for m in pattern.finditer(layer.text):
                edges = np.concatenate((np.arange(m.start(), m.start() + head), [m.end()]))
                made.put(m.start(), m.end(), m.group()[:head], edges)
            layer = made.done()
    return layer


def percent(layer: Layer) -> list[Layer]:
    """The layer without one level of percent escapes."""
    return _unescaped(layer, _PERCENT, "url", lambda m: (bytes.fromhex(m.group().replace("%", "")), 3))


def _units(digits: list[str]) -> tuple[str, list[int]]:
    """Characters of UTF-16 units and how many units each takes; lone halves stay as U+FFFD."""
    values = [int(d, 16) for d in digits]
    out, sizes, k = [], [], 0
    while k < len(values):
        one = values[k]
        if 0xD800 <= one < 0xDC00 and k + 1 < len(values) and 0xDC00 <= values[k + 1] < 0xE000:
            out.append(chr(0x10000 + ((one - 0xD800) << 10) + values[k + 1] - 0xDC00))
            sizes.append(2)
        else:
            out.append("�" if 0xD800 <= one < 0xE000 else chr(one))
            sizes.append(1)
        k += sizes[-1]
    return "".join(out), sizes


def unicode(layer: Layer) -> list[Layer]:
    """The layer without one level of Unicode escapes and character references."""
    def of(m: re.Match):
        if m["bytes"]:
            return bytes.fromhex(m["bytes"].replace("\\x", "")), 4
        if m["units"]:
            return _units(m["units"][2:].split("\\u")), 6
        code = int(m["decimal"]) if m["decimal"] else int(m["braced"] or m["long"] or m["entity"], 16)
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            return None
        return (chr(code), [1]), len(m.group())

    return _unescaped(layer, _ESCAPE, "unicode", of)


def _unescaped(layer: Layer, pattern: re.Pattern, step: str, of) -> list[Layer]:
    """Layers in which escapes are replaced: as UTF-8, and as single bytes if some are not UTF-8."""
    as_text, as_bytes = _Rewriter(layer, step), _Rewriter(layer, step + "-bytes")
    changed = raw = False
    for m in pattern.finditer(layer.text):
        found = of(m)
        if found is None:
            continue
        changed = True
        (value, width) = found
        if isinstance(value, bytes):
            text, lengths = _as_text(value)
            plain = value.decode("latin-1")
            raw = raw or (lengths is None and not value.isascii())
            as_bytes.put(m.start(), m.end(), plain, _edges(m.start(), width, None, len(plain)))
        else:
            text, lengths = value
            as_bytes.put(m.start(), m.end(), text, _edges(m.start(), width, lengths, len(text)))
        as_text.put(m.start(), m.end(), text, _edges(m.start(), width, lengths, len(text)))
    if not changed:
        return []
    return [as_text.done(), as_bytes.done()] if raw else [as_text.done()]


def base64_runs(text: str) -> Iterator[tuple[int, int, bytes, np.ndarray | None]]:
    """Start, end, bytes, and for runs over several lines the places of their digits."""
    for m in _BASE64.finditer(text):
        run = m.group()
        if len(run) < _LONG_ENOUGH:
            continue
        digits = run.translate(_URL_SAFE).rstrip("=")
        if len(digits) % 4 == 1:
            digits = digits[:-1]
        try:
            data = base64.b64decode(digits + "=" * (-len(digits) % 4))
        except binascii.Error:
            continue
        places = None
        if "\n" in run:
            places = np.flatnonzero(~np.isin(np.frombuffer(run.encode(), np.uint8), (10, 13)))
        yield m.start(), m.end(), data, places


def unbase64(layer: Layer, start: int, data: bytes, places: np.ndarray | None) -> Layer:
    """The decoded run; byte k stems from the digits that hold its bits."""
    text, lengths = _as_text(data)
    ends = np.cumsum(np.ones(len(text), np.int64) if lengths is None else lengths)
    begins = ends - (1 if lengths is None else np.array(lengths))
    first, last = begins * 8 // 6, (ends * 8 - 1) // 6
    if places is not None:
        first, last = places[first], places[last]
    path = f"{layer.path}>base64" if layer.path else "base64"
    return Layer(text, layer.lo[start + first], layer.hi[start + last], path)


def decompress(data: memoryview, limit: int) -> tuple[str, bytes, int] | None:
    """Name, content and length of compressed bytes, which others may follow; None if they are not."""
    head = bytes(data[:6])
    if head[:3] == b"\x1f\x8b\x08":
        name, one = "gzip", zlib.decompressobj(31)
    elif head[:1] == b"x" and len(head) > 1 and int.from_bytes(head[:2], "big") % 31 == 0:
        name, one = "zlib", zlib.decompressobj(15)
    elif head[:3] == b"BZh":
        name, one = "bzip2", bz2.BZ2Decompressor()
    elif head == b"\xfd7zXZ\x00":
        name, one = "xz", lzma.LZMADecompressor(lzma.FORMAT_XZ, memlimit=256 << 20)
    elif head[:4] == b"\x28\xb5\x2f\xfd":
        name, one = "zstandard", zstandard.ZstdDecompressor(max_window_size=128 << 20).decompressobj()
    else:
        return None
    out, size, at = [], 0, 0
    try:
        # In steps, so that no more than a step's output stands beyond the limit. zlib says by itself how
        # much it left; of the others a step that ends the stream leaves its rest in `unused_data`.
        while at < len(data) and not one.eof:
            step = data[at : at + STEP_BYTES]
            out.append(one.decompress(step))
            size += len(out[-1])
            at += len(step)
            if size > limit:
                raise Oversize(name)
    except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return None
    content = b"".join(out)
    return (name, content, at - len(one.unused_data)) if content else None


# ---------------------------------------------------------------------------------- scanning
def findings(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the base findings of a text: leftmost, non-overlapping per kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def _lines(layer: Layer, pattern: re.Pattern) -> Iterator[Layer]:
    """The lines of a layer in which a pattern occurs."""
    text, at = layer.text, 0
    while (m := pattern.search(text, at)) is not None:
        begin = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.start())
        end = len(text) if end < 0 else end
        yield Layer(text[begin:end], layer.lo[begin:end], layer.hi[begin:end], layer.path)
        at = end + 1


class Scan:
    """The worklist of one text."""

    def __init__(self, layer_bytes: int = LAYER_BYTES, text_bytes: int = TEXT_BYTES):
        self.layer_bytes, self.text_bytes = layer_bytes, text_bytes

    def run(self, text: str) -> list[tuple[str, int, int, str]]:
        """Findings (kind, start, end, path of the layer) of all layers; the path of a base one is empty."""
        places = np.arange(len(text) + 1)
        out = {f: "" for f in findings(text)}
        self.seen: set[tuple[str, int, int]] = set()
        self.left = self.text_bytes
        self.work = [Layer(text, places[:-1], places[1:], "")]
        while self.work:
            layer = self.work.pop()
            if layer.path:
                for kind, a, b in findings(layer.text):
                    out.setdefault((kind, *layer.part(a, b)), layer.path)
            for start, end in self.unwrap(layer):
                out.setdefault(("packed", *layer.part(start, end)), layer.path)
        order = {kind: i for i, kind in enumerate(KINDS)}
        return sorted(((*f, path) for f, path in out.items()), key=lambda f: (f[1], order[f[0]], f[2]))

    def add(self, layer: Layer) -> None:
        """Take up a layer, unless one of this content and place was taken up before."""
        if len(layer.text):
            key = (layer.text, int(layer.lo[0]), int(layer.hi[-1]))
            if key not in self.seen:
                self.seen.add(key)
                self.work.append(layer)

    def unwrap(self, layer: Layer) -> list[tuple[int, int]]:
        """Put what the layer hides on the worklist; places that would hold more than the limits."""
        packed = []
        for pattern, decode in ((_PERCENT, percent), (_ESCAPE, unicode)):
            for line in _lines(layer, pattern):
                for made in decode(shorten(line)):
                    self.add(made)
        for start, end, data, places in base64_runs(layer.text):
            self.add(unbase64(layer, start, data, places))
        for run in _BYTES.finditer(layer.text) if layer.path and _MAGIC.search(layer.text) else ():
            data = memoryview(run.group().encode("latin-1"))
            passed = 0
            for m in _MAGIC.finditer(run.group()):
                if m.start() < passed:
                    continue
                start = run.start() + m.start()
                try:
                    found = decompress(data[m.start() :], min(self.layer_bytes, self.left))
                except Oversize:
                    packed.append((start, run.end()))
                    passed = len(data)
                    continue
                if found:
                    name, content, used = found
                    passed = m.start() + used
                    self.left -= len(content)
                    a, b = layer.part(start, run.start() + passed)
                    text = _as_text(content)[0]
                    self.add(Layer(text, np.full(len(text), a), np.full(len(text), b), f"{layer.path}>{name}"))
        return packed


FOUND = "array<struct<kind: string, start: long, end: long, layers: string>>"
_FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layers", pa.string())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layer_bytes: int = LAYER_BYTES,
                 text_bytes: int = TEXT_BYTES) -> DataFrame:
    """`_id` and `found` of every row: kind, start and end (code points of the text, end exclusive) and `layers`, the
    path of decodings to the finding (`url>base64>gzip`), empty for one of the text itself.

    No shuffle: texts are read once, and two patterns that run over a whole batch say which need a look.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(layer_bytes, text_bytes)
        for batch in batches:
            for piece in tokens.pieces(batch, "_text"):
                texts = piece.column("_text")
                asked = pc.or_(pc.match_substring_regex(texts, BASE_HINT), pc.match_substring_regex(texts, LAYER_HINT))
                found = [[] for _ in range(len(texts))]
                for at in np.flatnonzero(asked.to_numpy(zero_copy_only=False)).tolist():
                    found[at] = [dict(zip(("kind", "start", "end", "layers"), f)) for f in scan.run(texts[at].as_py())]
                yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(found, _FOUND_TYPE)], ["_id", "found"])

    return rows.mapInArrow(run, f"_id long, found {FOUND}")


def redact(text: str, found: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """The text with the union of the spans replaced by a mark."""
    out, at = [], 0
    for start, end in sorted(found):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
