"""Secret scan: recursive decoding worklist (operator 1).

Every text is a first layer. A layer is scanned with the rules, then unwrapped:
percent escapes, ``\\u``/``\\x``/``&#`` escapes, base64 runs, and packed data (gzip,
zlib, bzip2, raw deflate) whose bytes are written as any of these, each giving a new
layer that goes back on the worklist until nothing new appears. A layer whose content already occurs among its
ancestors is not entered again, so self-reproducing data ends.

Every decoded layer is scanned, whatever its characters: bytes that are not
UTF-8 are read as Latin-1, and a layer with NUL characters (UTF-16, UTF-32) also
gives one without them; the rules decide. A base64 run is decoded from each of
its first four characters on, so that text which begins after a path or another
prefix is in phase in one of them; packed data is looked for at the start of each
and after each separator, in escaped bytes at each place that looks like a head; raw
deflate has no head and is looked for at the beginning of a run, where it must end
with the run. ``n_layers`` counts base64 layers that are
printable UTF-8, unpacked or hold a finding, and what is unwrapped from them.

Packed data is unpacked in blocks, over all members of a gzip file and without a
limit. A block ends after a line that no pattern crosses, and what follows goes
with the next one; without such a line for ``MAX_HELD`` bytes it is cut there,
with ``OVERLAP`` bytes repeated, and counted in ``n_oversize``: there, only packed
data inside a base64 run that crosses the cut is not seen.

Each layer keeps
a map of its stretches to the text it came from, so every finding ends as a
span of the original text in code points.

Rows are independent: the scan is a narrow Arrow map, with no shuffle.

Edge cases: a null text is an empty text (no findings); repeated rows each give
a row; extra columns are ignored; ``doc_id`` may be null. Packed data that is
broken off or damaged is scanned up to there.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from prefweave.llm.tables import need

# The rules' patterns, kinds in their order, and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
                    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
DECIMAL_GROUP = 6
SPACES = {9: " ", 10: " ", 13: " "}
BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{16,}|[A-Za-z0-9_-]{16,})={0,2}")
# Base64 in lines; tried once where a run begins, so that a long run costs its length.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{60,}+\r?\n)+[A-Za-z0-9+/]+={0,2}")
# Bytes written as text: percent escapes and what they leave as it is, or escapes of string literals and of markup.
# A stretch begins at most 16 characters before its first escape.
_PERCENT, _KEPT = r"%[0-9A-Fa-f]{2}", r"[A-Za-z0-9_.~*!'()/+-]"
PERCENT_BYTES = re.compile(f"{_KEPT}{{0,16}}+{_PERCENT}(?:{_PERCENT}|{_KEPT})*+")
_LITERAL = r"""(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[0abfnrtv'"\\/]|&#[xX]0*[0-9A-Fa-f]{1,2};|&#[0-9]{1,3};)"""
_PLAIN = r"[ !#-&(-\[\]-~\x80-\xff]"
ANY_PERCENT, ANY_LITERAL = re.compile(_PERCENT), re.compile(_LITERAL)
LITERAL_BYTES = re.compile(f"{_PLAIN}{{0,16}}{_LITERAL}(?:{_LITERAL}|{_PLAIN})*+")
PERCENT_UNIT = re.compile(r"%(..)|(\+)")
LITERAL_UNIT = re.compile(r"\\(?:x|u00)([0-9A-Fa-f]{2})|\\(.)|&#[xX]([0-9A-Fa-f]+);|&#([0-9]+);")
SHORT_ESCAPES = dict(zip("0abfnrtv'\"\\/", b"\0\a\b\f\n\r\t\v'\"\\/"))
HEAD = re.compile(rb"\x1f\x8b\x08|[\x08\x18\x28\x38\x48\x58\x68\x78](?=[\x00-\xff])|BZh[1-9]1AY&SY")
SEPARATOR = re.compile(r"[/+_-]")
NUL = re.compile("\0+")
BLOCK = 4 << 20                # bytes unpacked at once
FEED = 1 << 16                 # packed bytes given at once
MAX_HELD = 64 << 20            # longest stretch without a place to cut
OVERLAP = 64 << 10
LINE = re.compile(rb"[A-Za-z0-9+/]{60,}\r?\n\Z")

Span = tuple[int, int, int]          # start, kind number, end


def scan(text: str) -> list[Span]:
    """Spans the rules find in one layer, leftmost and non-overlapping by kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


class Stretches:
    """Where each part of a layer lies in the original text. A part is copied
    (characters correspond) or decoded (the whole part stands for the whole
    source range)."""

    def __init__(self, parts: list[tuple[int, int, int, bool]]):
        self.parts = parts                       # layer start, source start, source end, copied
        self.starts = [p[0] for p in parts]

    def source(self, start: int, end: int) -> tuple[int, int]:
        a = self.parts[max(0, bisect_right(self.starts, start) - 1)]
        b = self.parts[max(0, bisect_right(self.starts, end - 1) - 1)]
        lo = a[1] + (start - a[0]) if a[3] else a[1]
        hi = b[1] + (end - b[0]) if b[3] else b[2]
        return lo, hi


def _replaced(text: str, pieces: list[tuple[int, int, str]]) -> tuple[str, Stretches] | None:
    """``text`` with ranges exchanged for decoded strings, and its map."""
    if not pieces:
        return None
    out, parts, at, length = [], [], 0, 0
    for start, end, new in pieces:
        if start > at:
            parts.append((length, at, start, True))
            out.append(text[at:start])
            length += start - at
        if new:
            parts.append((length, start, end, False))
            out.append(new)
            length += len(new)
        at = end
    if at < len(text):
        parts.append((length, at, len(text), True))
        out.append(text[at:])
    return ("".join(out), Stretches(parts)) if parts else None


def _decoded(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _readable(data: bytes) -> bool:
    try:
        return data.decode("utf-8").translate(SPACES).isprintable()
    except UnicodeDecodeError:
        return False


def _percent(text: str):
    pieces = []
    for m in PERCENT.finditer(text):
        # Bytes that are not UTF-8 stand alone, as Latin-1.
        pieces += _by_character(m.start(), bytes.fromhex(m.group().replace("%", "")).decode("utf-8", "surrogateescape"))
    return _replaced(text, pieces)


def _by_character(at: int, decoded: str) -> list[tuple[int, int, str]]:
    """One piece per decoded character of a percent run, so spans stay exact."""
    out = []
    for c in decoded:
        escaped = "\udc80" <= c <= "\udcff"
        end = at + 3 * (1 if escaped else len(c.encode("utf-8")))
        out.append((at, end, chr(ord(c) - 0xDC00) if escaped else c))
        at = end
    return out


def _escapes(text: str):
    pieces = []
    for m in ESCAPE.finditer(text):
        code = int(m.group(m.lastindex), 10 if m.lastindex == DECIMAL_GROUP else 16)
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            pieces.append((m.start(), m.end(), chr(code)))
    return _replaced(text, pieces)


def _without_nul(text: str):
    return _replaced(text, [(m.start(), m.end(), "") for m in NUL.finditer(text)]) if "\0" in text else None


def _packed(data: bytes, at: int) -> bool:
    head = data[at:at + 10]
    return len(head) >= 3 and (head[:2] == b"\x1f\x8b"
                               or head[0] & 15 == 8 and (head[0] * 256 + head[1]) % 31 == 0
                               or head[:3] == b"BZh" and head[4:] == b"1AY&SY")


def _unpacked(data: bytes, at: int, raw: bool = False) -> Iterator[bytes]:
    """Pieces of all members of the packed data that begins at ``at``; ``raw``:
    of a deflate stream without a head."""
    view = memoryview(data)
    while raw or _packed(data, at):
        if raw:
            unpack = zlib.decompressobj(-15)
        else:
            unpack = bz2.BZ2Decompressor() if data[at] == ord("B") else zlib.decompressobj(47)
        try:
            while not unpack.eof:
                fed = view[at:at + FEED]
                at += len(fed)
                piece = unpack.decompress(fed, BLOCK)
                while piece:
                    yield piece
                    piece = b"" if unpack.eof else unpack.decompress(getattr(unpack, "unconsumed_tail", b""), BLOCK)
                if not fed:
                    break
        except (zlib.error, OSError):
            return
        at -= len(unpack.unused_data)
        if raw or not unpack.eof:
            return
        while at < len(data) and not data[at]:     # a file may be padded between members
            at += 1


def _is_deflate(data: bytes) -> bool:
    """Whether the bytes are one deflate stream without a head, from first to last."""
    if len(data) < 3 or data[0] & 6 == 6 or _readable(data):
        return False
    unpack, at, view = zlib.decompressobj(-15), 0, memoryview(data)
    try:
        while not unpack.eof:
            fed = unpack.unconsumed_tail or view[at:at + FEED]
            at += 0 if unpack.unconsumed_tail else len(fed)
            if not unpack.decompress(fed, BLOCK) and not len(fed):
                return False
    except zlib.error:
        return False
    return at == len(data) and not unpack.unused_data


def _code(unit: re.Match) -> int:
    """The byte that an escape stands for."""
    if unit.re is PERCENT_UNIT:
        return int(unit[1], 16) if unit[1] else 32
    if unit[2]:
        return SHORT_ESCAPES.get(unit[2], 92)
    return min(255, int(unit[4]) if unit[4] else int(unit[1] or unit[3], 16))


def _escaped_bytes(text: str) -> Iterator[tuple[bytes, Stretches, int, int]]:
    """(bytes, where they lie in the stretch, start, end) of the stretches that write
    bytes as percent escapes or as escapes of literals and markup."""
    for escape, stretch, unit in ((ANY_PERCENT, PERCENT_BYTES, PERCENT_UNIT), (ANY_LITERAL, LITERAL_BYTES, LITERAL_UNIT)):
        if escape.search(text):
            for m in stretch.finditer(text):
                data, where = _replaced(m.group(), [(u.start(), u.end(), chr(_code(u))) for u in unit.finditer(m.group())])
                yield data.encode("latin-1"), where, m.start(), m.end()


def _packed_layers(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(decoded layer, start, end, cut) of packed data in escaped bytes."""
    for data, where, start, end in _escaped_bytes(text):
        for head in HEAD.finditer(data):
            at = head.start()
            if _packed(data, at):
                for block, cut in _blocks(_unpacked(data, at)):
                    yield _decoded(block), start + where.source(at, at + 1)[0], end, cut
        if _is_deflate(data):
            for block, cut in _blocks(_unpacked(data, 0, raw=True)):
                yield _decoded(block), start, end, cut


def _blocks(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    """(block, whether it is cut inside a line) of the joined pieces."""
    held = b""
    for piece in pieces:
        held += piece
        end = len(held)
        # A cut goes after a line that can't be part of a base64 run over lines.
        while (end := held.rfind(b"\n", 0, end)) >= 0 and LINE.search(held, max(0, held.rfind(b"\n", 0, end)), end + 1):
            pass
        if end >= 0:
            yield held[:end + 1], False
            held = held[end + 1:]
        elif len(held) >= MAX_HELD:
            yield held, True
            held = held[-OVERLAP:]
    if held:
        yield held, False


def _base64_layers(text: str) -> Iterator[tuple[str, int, int, bool, bool]]:
    """(decoded layer, start, end, cut, whether it is text) of each base64 run,
    in every phase."""
    for m in chain(BASE64.finditer(text), WRAPPED.finditer(text) if "\n" in text else ()):
        run = re.sub(r"\s", "", m.group()).rstrip("=")
        plain = run.replace("-", "+").replace("_", "/")
        for phase in range(4):
            body = plain[phase:]
            if len(body) % 4 == 1:
                body = body[:-1]
            data = base64.b64decode(body + "=" * (-len(body) % 4))
            yield _decoded(data), m.start(), m.end(), False, _readable(data)
            after = [x.end() - phase for x in SEPARATOR.finditer(run) if x.end() >= phase and (x.end() - phase) % 4 == 0]
            for at in dict.fromkeys([0, *(i // 4 * 3 for i in after)]):
                if _packed(data, at):
                    for block, cut in _blocks(_unpacked(data, at)):
                        yield _decoded(block), m.start(), m.end(), cut, True
            if phase == 0 and _is_deflate(data):
                for block, cut in _blocks(_unpacked(data, 0, raw=True)):
                    yield _decoded(block), m.start(), m.end(), cut, _readable(block)


def find_all(text: str) -> tuple[list[Span], list[Span], int, int]:
    """(base spans, all spans, layers entered, oversize layers) of one text."""
    base = sorted(scan(text))
    found = set(base)
    layers = oversize = 0
    if not (BASE64.search(text) or "%" in text or "\\" in text or "&#" in text or "\0" in text):
        return base, base, 0, 0
    entered = set()                              # contents found before in the same place
    # Layers still to come, with maps back to the text, ancestors and whether
    # they count as text, level by level.
    work = [iter([(text, None, frozenset(), True)])]
    while work:
        layer, maps, above, is_text = next(work[-1], (None,) * 4)
        if layer is None:
            work.pop()
            continue
        digest = hashlib.sha256(layer.encode("utf-8", "surrogatepass")).digest()
        if digest in above:
            continue
        if maps is not None:
            whole = (0, len(layer))
            decoded = len(maps[0].parts) == 1 and not maps[0].parts[0][3]
            if decoded:                          # one part stands for all of it
                for stretch in maps:
                    whole = stretch.source(*whole)
                if (digest, whole) in entered:
                    continue
                entered.add((digest, whole))
            spans = scan(layer)
            layers += is_text or bool(spans)
            for start, kind, end in spans:
                for stretch in maps:
                    start, end = stretch.source(start, end)
                found.add((start, kind, end))

        def inside(layer=layer, back=maps or (), above=above | {digest}, own=is_text):
            nonlocal oversize
            for unwrap in (_percent, _escapes, _without_nul):
                new = unwrap(layer)
                if new:
                    yield new[0], (new[1], *back), above, own
            for decoded, start, end, cut in _packed_layers(layer):
                oversize += cut
                yield decoded, (Stretches([(0, start, end, False)]), *back), above, True
            for decoded, start, end, cut, is_text in _base64_layers(layer):
                oversize += cut
                if decoded:
                    yield decoded, (Stretches([(0, start, end, False)]), *back), above, is_text

        work.append(inside())
    return base, sorted(found), layers, oversize


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


OUT = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
       "n_layers bigint, n_oversize bigint, base_spans string")


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers",
                                "n_oversize", "base_spans")}
        for value in batch.column(1):
            base, spans, layers, oversize = find_all(value.as_py() or "")
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                rows[name].append(sum(s[1] == k for s in base))
            text = as_text(base)
            rows["base_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
            rows["spans"].append(as_text(spans))
            rows["n_layers"].append(layers)
            rows["n_oversize"].append(oversize)
            rows["base_spans"].append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64())]
            + [pa.array(v, pa.int64() if n.startswith("n_") else pa.string()) for n, v in rows.items()],
            ["doc_id", *rows])


def scan_secrets(documents: DataFrame) -> DataFrame:
    """One row per document: counts of the base findings, their digest, and all
    spans with those found in decoded layers."""
    docs = need(documents, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return docs.mapInArrow(_scan_batches, OUT)
