"""Secret scans with recursive decoding.

A worklist starts with the text. Each layer is scanned, then unwrapped: percent escapes and
Unicode escapes are decoded in place, and runs of base64, compressed or not, become layers of
their own. Lines of a run are joined, and a run is decoded from each of its first four
characters, as what stands before the base64 may belong to the same run; all stretches of
text in it are layers, and compressed data (gzip, zlib) may begin anywhere in it. Raw deflate, which has no
header, is tried from the run's first character. Bytes may also be written as percent escapes or as the escapes of a
string literal; compressed data is looked for in those as well. New layers are taken until
nothing new comes up; a layer seen before at the same place is not taken again, so cycles
end. Each layer knows for all its characters which characters of the text they come from, and
what is found in it is reported there.

Inflated data may be a thousand times the text. It is a stream of pieces that can be read
again, and what lies in it comes from one place; runs longer than a piece are streams too.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds of secrets, in the order of the report.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this is each run of 16 or more
MIN_ASSIGNED, MIN_ACCESS = 12, 18

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
# A line end, also as it is written in JSON, and blanks around it.
BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
ONE = "[A-Za-z0-9+/_-]"
# Lines of 16 characters or more and a last one of any length.
BASE64 = re.compile(rf"{ONE}{{16,}}(?:{BREAK.pattern}{ONE}{{16,}})*(?:{BREAK.pattern}{ONE}+(?!{ONE}))?={{0,2}}")
GOES_ON = re.compile(rf"(?:{ONE}+|{BREAK.pattern}(?={ONE}))*")
# UTF-8 without control characters, enough of it to hold a secret.
TEXT = re.compile(
    rb"(?:[\t\n\r\x20-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){16,}"
)
# Bytes as percent escapes, or as in a string literal of Python, C or JSON; the printable ones may stand for themselves.
PERCENT_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~+/*()!'-])+")
PERCENT_BYTE = re.compile(r"%([0-9A-Fa-f]{2})")
LITERAL_RUN = re.compile(r"""(?:\\(?:x[0-9A-Fa-f]{2}|u00[0-9A-Fa-f]{2}|[abfnrtv0\\'"/])|[ -\[\]-~])+""")
LITERAL_BYTE = re.compile(r"""\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([abfnrtv0\\'"/]))""")
UNWRITTEN = re.compile(r"[^ -~]")
LETTERED = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "0": "\0"}
HEADER = re.compile(rb"(?=\x1f\x8b\x08|[\x18\x28\x38\x48\x58\x68\x78][\x00-\xff])")
# Streams are read in pieces; what may straddle two pieces is read with the second again. A
# compressed beginning is tried on so many bytes, and a line end or escape fits into a margin.
PIECE, OVERLAP, TRIED, MARGIN = 1 << 22, 1 << 16, 1 << 16, 12
CONVINCING = 256


@dataclass
class Layer:
    """``begin[i]`` and ``end[i]`` are where character ``i`` comes from; none for the text itself, one value for all alike."""

    text: str
    begin: np.ndarray | int | None = None
    end: np.ndarray | int | None = None

    def source(self, low: int, high: int) -> tuple[int, int]:
        if self.begin is None:
            return low, high
        if isinstance(self.begin, int):
            return self.begin, self.end
        return int(self.begin[low]), int(self.end[high - 1])

    def positions(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.text)
        if self.begin is None:
            return np.arange(n), np.arange(1, n + 1)
        if isinstance(self.begin, int):
            return np.full(n, self.begin), np.full(n, self.end)
        return self.begin, self.end

    def part(self, text: str, first: np.ndarray, last: np.ndarray) -> Layer:
        """A layer whose characters come from the characters ``first`` to ``last`` of this one."""
        if self.begin is None:
            return Layer(text, first, last + 1)
        if isinstance(self.begin, int):
            return Layer(text, self.begin, self.end)
        return Layer(text, self.begin[first], self.end[last])


@dataclass
class Stream:
    """Text in pieces, all of it from one place. ``pieces`` starts anew with each call."""

    pieces: Callable[[], Iterator[str]]
    begin: int
    end: int


def scan(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns: leftmost matches per kind, short ones dropped afterwards."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _in_place(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match replaced; ``decode`` gives the characters and how many source characters each took."""
    parts, begins, ends, at = [], [], [], 0
    begin = end = None
    for m in pattern.finditer(layer.text):
        decoded = decode(m)
        if decoded is None:
            continue
        if begin is None:
            begin, end = layer.positions()
        chars, widths = decoded
        stops = m.start() + np.cumsum(widths)
        parts += [layer.text[at : m.start()], chars]
        begins += [begin[at : m.start()], begin[stops - widths]]
        ends += [end[at : m.start()], end[stops - 1]]
        at = m.end()
    if begin is None:
        return None
    parts.append(layer.text[at:])
    return Layer("".join(parts), np.concatenate([*begins, begin[at:]]), np.concatenate([*ends, end[at:]]))


def _percent(m: re.Match) -> tuple[str, np.ndarray]:
    chars = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape")
    chars = chars.encode("utf-8", "surrogateescape").decode("latin-1") if any("\udc80" <= c <= "\udcff" for c in chars) else chars
    if 3 * len(chars) == len(m[0]):
        return chars, np.full(len(chars), 3)
    return chars, np.array([3 * len(c.encode()) for c in chars])


def _escape(m: re.Match) -> tuple[str, np.ndarray] | None:
    code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), np.array([len(m[0])])


def _inflated(chunks: Iterable[bytes], raw: bool = False) -> Iterator[bytes]:
    """What zlib or gzip data, also of several members, inflates to, as far as it goes."""
    reader, rest = zlib.decompressobj(-15 if raw else 47), b""
    try:
        for chunk in chunks:
            data = rest + chunk
            while True:
                if reader.eof:
                    if raw or len(data) > 1 and data[:2] != b"\x1f\x8b":
                        return
                    if len(data) < 2:
                        break
                    reader = zlib.decompressobj(47)
                piece = reader.decompress(data, PIECE)
                data = reader.unused_data if reader.eof else reader.unconsumed_tail
                if piece:
                    yield piece
                elif not data:
                    break
            rest = data
    except zlib.error:
        return


def _as_text(chunks: Iterable[bytes]) -> Iterator[str]:
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for chunk in chunks:
        yield decoder.decode(chunk)
    yield decoder.decode(b"", True)


def _inflates(data: bytes, at: int) -> bool:
    """Whether compressed data begins there. The two bytes of zlib come up by chance, so a zlib stream must reach its
    checksum or go on well for ``CONVINCING`` bytes; a gzip member may be cut anywhere."""
    gzipped = data[at] == 0x1F
    if not gzipped and (data[at] << 8 | data[at + 1]) % 31:
        return False
    reader, begun = zlib.decompressobj(47), data[at : at + TRIED]
    try:
        inflated = reader.decompress(begun, TRIED)
    except zlib.error:
        return False
    taken = len(begun) - len(reader.unconsumed_tail)
    return bool(inflated) and (gzipped or reader.eof or len(inflated) >= TRIED or taken >= CONVINCING)


def _compressed(data: bytes) -> Iterator[int]:
    """Where compressed data begins; other bytes may stand before it."""
    return (m.start() for m in HEADER.finditer(data) if _inflates(data, m.start()))


def _extent(data: bytes) -> int:
    """How many bytes the compressed data takes that the bytes begin with."""
    reader, left = zlib.decompressobj(47), data
    try:
        while left and not reader.eof:
            reader.decompress(left, PIECE)
            left = reader.unconsumed_tail
    except zlib.error:
        return len(data)
    return len(data) - len(reader.unused_data)


def _raw_deflate(chunks: Iterable[bytes]) -> bool:
    """Whether bytes without any header inflate, to what begins as text, and come to an end as deflate does."""
    chunks, first = iter(chunks), b""
    for data in chunks:
        first += data
        if len(first) >= CONVINCING:
            break
    reader = zlib.decompressobj(-15)
    try:
        begun = zlib.decompressobj(-15).decompress(first[:TRIED], 64)
        found = TEXT.match(begun)
        if found is None or found.end() < len(begun) - 3:  # a character may be cut
            return False
        for data in chain([first], chunks):
            while data and not reader.eof:
                reader.decompress(data, PIECE)
                data = reader.unconsumed_tail
            if reader.eof:
                return True
    except zlib.error:
        pass
    return False


def _byte(m: re.Match) -> str:
    written = m[m.lastindex]
    return chr(int(written, 16)) if len(written) == 2 else LETTERED.get(written, written)


def _unescaped(text: str, pattern: re.Pattern) -> bytes:
    """Bytes of escaped text. What no escaped text has, such as bytes decoded before, is a zero that ends compressed data."""
    text = UNWRITTEN.sub("\0", text)
    text = text.replace("+", " ") if pattern is PERCENT_BYTE else text
    return pattern.sub(_byte, text).encode("latin-1", "replace")


def _escaped_bytes(layer: Layer) -> Iterator[Stream]:
    """Compressed data whose bytes are written as escapes."""
    for mark, runs, pattern in (("%", PERCENT_RUN, PERCENT_BYTE), ("\\", LITERAL_RUN, LITERAL_BYTE)):
        for run in runs.finditer(layer.text) if mark in layer.text else ():
            if mark not in run[0]:
                continue
            data = _unescaped(run[0], pattern)
            for begin in _compressed(data):
                rest = data[begin:]
                # An escape is several characters for a byte: walk up to the first byte and behind the last.
                places, wider = [], 0
                escapes = pattern.finditer(run[0])
                escape = next(escapes, None)
                for byte in (begin, begin + _extent(rest)):
                    while escape and escape.start() - wider < byte:
                        wider += len(escape[0]) - 1
                        escape = next(escapes, None)
                    places.append(run.start() + byte + wider)
                yield Stream(lambda rest=rest: _as_text(_inflated([rest])), *layer.source(*places))


def _bytes_of(run: str) -> bytes:
    run = run[: len(run) - (len(run) % 4 == 1)]
    return base64.urlsafe_b64decode(run.replace("+", "-").replace("/", "_") + "=" * (-len(run) % 4))


def _plain(data: bytes) -> str | None:
    """The text of decoded base64, or None where the run was no base64 of text."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(c < " " and c not in "\t\n\r" for c in text)
    return text if text and odd == 0 else None


def _decoded(layer: Layer, low: int, high: int) -> Iterator[Layer | Stream]:
    """What the base64 run from ``low`` to ``high`` holds, from each of its first four characters on."""
    text, places, at = layer.text[low:high].rstrip("="), [], 0
    for m in BREAK.finditer(text):
        places.append(np.arange(at, m.start()))
        at = m.end()
    place = low + np.concatenate([*places, np.arange(at, len(text))])
    run = BREAK.sub("", text) if places else text
    for shift in range(min(4, len(run) - 15)):
        data = _bytes_of(run[shift:])
        if shift == 0 and _raw_deflate([data]):
            yield Stream(lambda rest=data: _as_text(_inflated([rest], raw=True)), *layer.source(low, high))
        for begin in _compressed(data):
            source = layer.source(int(place[shift + begin * 4 // 3]), high)
            yield Stream(lambda rest=data[begin:]: _as_text(_inflated([rest])), *source)
        whole = _plain(data) if shift == 0 else None
        for begin, plain in [(0, whole)] if whole else [(m.start(), m[0].decode()) for m in TEXT.finditer(data)]:
            byte = begin + np.cumsum([0] + [len(c.encode()) for c in plain])
            first = shift + byte[:-1] * 8 // 6
            last = np.minimum(shift + -(-byte[1:] * 8 // 6), len(run)) - 1
            yield layer.part(plain, place[first], place[last])


def _unwrapped(layer: Layer) -> Iterator[Layer | Stream]:
    text = layer.text
    if "%" in text and (new := _in_place(layer, PERCENT, _percent)):
        yield new
    if ("\\" in text or "&#" in text) and (new := _in_place(layer, ESCAPE, _escape)):
        yield new
    yield from _escaped_bytes(layer)
    for m in BASE64.finditer(text):
        yield from _decoded(layer, *m.span())


def _cut(text: str) -> int:
    """Where an escape may begin that goes on in the next piece; a row of backslashes stays together."""
    cut = next((i for i in range(max(0, len(text) - MARGIN), len(text)) if text[i] in "%\\&"), len(text))
    row = re.search(r"\\{0,24}$", text[max(0, cut - 24) : cut])
    return cut - len(row[0])


def _replaced(pieces: Iterator[str], pattern: re.Pattern, decode) -> Iterator[str]:
    """A stream with every match decoded; an escape that may go on is held back."""

    def put(m: re.Match) -> str:
        decoded = decode(m)
        return m[0] if decoded is None else decoded[0]

    held = ""
    for piece in pieces:
        text = held + piece
        cut = _cut(text)
        held = text[cut:]
        yield pattern.sub(put, text[:cut])
    yield pattern.sub(put, held)


def _long_run(pieces: Iterator[str], start: int) -> Iterator[str]:
    """The characters of the base64 run that starts there, without line ends."""
    held = ""
    for piece in pieces:
        skipped = min(start, len(piece))
        start -= skipped
        text = held + piece[skipped:]
        end = GOES_ON.match(text).end()
        yield BREAK.sub("", text[:end])
        if end < len(text) - MARGIN:
            return
        held = text[end:]
    yield BREAK.sub("", held[: GOES_ON.match(held).end()])


def _long_bytes(run: Iterator[str], shift: int, start: int = 0) -> Iterator[bytes]:
    """The run decoded from character ``shift`` on, without the first ``start`` bytes."""
    skip, extra, held = shift + start // 3 * 4, start % 3, ""
    for chars in run:
        skipped = min(skip, len(chars))
        skip -= skipped
        held += chars[skipped:]
        whole = len(held) // 4 * 4
        data = _bytes_of(held[:whole])
        yield data[extra:]
        extra = max(0, extra - len(data))
        held = held[whole:]
    yield _bytes_of(held)[extra:]


def _inflating(decoded: Callable[[int], Iterator[bytes]], stream: Stream) -> Iterator[Stream]:
    """Compressed data in bytes that come in chunks; ``decoded(at)`` gives them from one byte on."""

    def inflated(at: int) -> Stream:
        return Stream(lambda: _as_text(_inflated(decoded(at))), stream.begin, stream.end)

    offset, held = 0, b""
    for chunk in decoded(0):
        data = held + chunk
        done = max(0, len(data) - TRIED)
        yield from (inflated(offset + at) for at in _compressed(data) if at < done)
        offset, held = offset + done, data[done:]
    yield from (inflated(offset + at) for at in _compressed(held))


def _long_escaped(stream: Stream, pattern: re.Pattern) -> Iterator[Stream]:
    """Compressed data whose bytes are written as escapes anywhere in a stream."""

    def unescaped(start: int) -> Iterator[bytes]:
        held = ""
        for piece in stream.pieces():
            text = held + piece
            cut = _cut(text)
            data, held = _unescaped(text[:cut], pattern), text[cut:]
            yield data[start:]
            start = max(0, start - len(data))
        yield _unescaped(held, pattern)[start:]

    yield from _inflating(unescaped, stream)


def _long_decoded(stream: Stream, start: int) -> Iterator[Stream]:
    """What a run longer than a piece holds, from each of its first four characters on."""

    def decoded(shift: int, at: int = 0) -> Iterator[bytes]:
        return _long_bytes(_long_run(stream.pieces(), start), shift, at)

    for shift in range(4):
        yield Stream(lambda shift=shift: _as_text(decoded(shift)), stream.begin, stream.end)
        if shift == 0 and _raw_deflate(decoded(0)):
            yield Stream(lambda: _as_text(_inflated(decoded(0), raw=True)), stream.begin, stream.end)
        yield from _inflating(lambda at, shift=shift: decoded(shift, at), stream)


def _streamed(stream: Stream, spans: set[tuple[int, int, int]]) -> Iterator[Layer | Stream]:
    """Adds what is found in a stream to ``spans``, and unwraps it."""
    percent = escaped = False
    held, offset, goes_on, long = "", 0, False, []
    pieces = stream.pieces()
    piece = next(pieces, None)
    while piece is not None:
        following = next(pieces, None)
        text = held + piece
        spans.update((stream.begin, kind, stream.end) for _, kind, _ in scan(text))
        percent |= "%" in text and PERCENT.search(text) is not None
        escaped |= ("\\" in text or "&#" in text) and ESCAPE.search(text) is not None
        keep, layer = max(0, len(text) - OVERLAP), Layer(text, stream.begin, stream.end)
        cut_run = keep > 0 and GOES_ON.match(text, keep - 1).end() > keep
        for m in BASE64.finditer(text):
            ends = following is None or m.end() < len(text) - MARGIN
            if m.start() == 0 and goes_on:
                cut_run |= not ends  # the rest of a run that was taken before, and may still go on
            elif ends:
                yield from _decoded(layer, *m.span())
            elif len(text) - m.start() > PIECE:
                long.append(offset + m.start())
                cut_run = True
            else:
                keep, cut_run = min(keep, m.start()), m.start() > keep and cut_run
        held, offset, goes_on = text[keep:], offset + keep, cut_run
        piece = following
    if percent:
        yield Stream(lambda: _replaced(stream.pieces(), PERCENT, _percent), stream.begin, stream.end)
    if escaped:
        yield Stream(lambda: _replaced(stream.pieces(), ESCAPE, _escape), stream.begin, stream.end)
    for mark, pattern in ((percent, PERCENT_BYTE), (escaped, LITERAL_BYTE)):
        if mark:
            yield from _long_escaped(stream, pattern)
    for start in long:
        yield from _long_decoded(stream, start)


def _key(layer: Layer | Stream) -> tuple[bytes, int, int]:
    """The text and the place of a layer."""
    digest = hashlib.blake2b(digest_size=16)
    if isinstance(layer, Stream):
        for piece in layer.pieces():
            digest.update(piece.encode("utf-8", "replace"))
        return digest.digest(), layer.begin, layer.end
    digest.update(layer.text.encode("utf-8", "replace"))
    return digest.digest(), *layer.source(0, len(layer.text))


def _expanded(layer: Layer | Stream, spans: set[tuple[int, int, int]]) -> Iterator[Layer | Stream]:
    if isinstance(layer, Stream):
        yield from _streamed(layer, spans)
        return
    if layer.begin is not None:
        for low, kind, high in scan(layer.text):
            begin, end = layer.source(low, high)
            spans.add((begin, kind, end))
    yield from _unwrapped(layer)


def find_secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Spans of the text as it is, all spans with those of decoded layers, and the number of layers."""
    base = scan(text)
    spans, seen, layers = set(base), set(), 1
    worklist = [_expanded(Layer(text), spans)]  # depth first, so that few layers are held at a time
    while worklist:
        new = next(worklist[-1], None)
        if new is None:
            worklist.pop()
        elif isinstance(new, Stream) or new.text != text:
            key = _key(new)
            if key not in seen:
                seen.add(key)
                layers += 1
                worklist.append(_expanded(new, spans))
    return base, sorted(spans), layers


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{low}:{high}" for low, kind, high in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [find_secrets(text.as_py() or "") for text in batch.column("text")]
        counts = [[sum(k == kind for _, k, _ in base) for base, _, _ in rows] for kind in range(len(KINDS))]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                **{f"n_{name}": pa.array(n, pa.int64()) for name, n in zip(KINDS, counts, strict=True)},
                "base_sha256": pa.array([hashlib.sha256(_told(base).encode()).hexdigest() for base, _, _ in rows], pa.string()),
                "spans": pa.array([_told(spans) for _, spans, _ in rows], pa.string()),
                "n_layers": pa.array([n for _, _, n in rows], pa.int64()),
            }
        )


def scan_secrets(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Secrets of every text, one row per input row; one pass, no shuffle.

    ``n_assign``, ``n_access``, ``n_hex`` and ``base_sha256`` are about the text as it is;
    ``spans`` has the spans of decoded layers too; ``n_layers`` counts the text and its layers.

    Defined cases: a null text is empty and has no spans. Null and repeated ids keep their
    rows. Equal spans of several layers are one. An empty table gives an empty table. Other
    columns are not read.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long"
    return rows.mapInArrow(_scan_batches, schema)
