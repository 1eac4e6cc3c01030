"""Secret scans through nested encodings.

Each text is a first layer.  A worklist holds layers still to be opened: percent escapes, Unicode escapes
and UTF-16 or UTF-32 are decoded in place (the rest of the layer stays around them), base64 runs, also over
line breaks and from each of their first four letters, become layers of their own, and so do the gzip, zlib,
bzip2 and xz streams in them or in any layer's own bytes, all members and to any depth, read in pieces that overlap.
Of bytes only the printable stretches that a match or an encoding fits into are looked at further.  A layer of a text and origin seen before is not opened again, so cycles end;
the list is empty at the fixpoint.  Every layer is scanned with the base patterns.
Each of its characters knows which characters of the document it came from, so a find is reported as a
span of the document; what came out of a compressed stream has the span of the base64 run from where the stream
begins, or else of the stream's own bytes.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, small_batches

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run of 24 or more
LEAST_VALUE, LEAST_ACCESS = 6, 20

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_UNICODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
WIDE = re.compile(r"[\t\r\n -~](?:(?:\0[\t\r\n -~]){11,}|(?:\0{3}[\t\r\n -~]){11,})")  # the shortest base match has 12 letters
LETTER = r"[A-Za-z0-9+/_-]"
BASE64 = re.compile(LETTER + r"{16,}={0,2}")
BREAK = re.compile(r"[ \t]*+(?:(?:[\r\n]|\\[rn])[ \t]*+)++")
WRAPPED = re.compile(rf"(?<!{LETTER}){LETTER}++(?:{BREAK.pattern}{LETTER}++)++={{0,2}}")
#: Heads of zlib streams without a dictionary: method 8, a window of 256 bytes to 32 KiB, and a check that makes both
#: bytes a multiple of 31.
ZLIB = [bytes([a, b]) for a in range(0x08, 0x88, 0x10) for b in range(256) if (a << 8 | b) % 31 == 0 and not b & 0x20]
PACKED = re.compile(b"|".join([rb"\x1f\x8b|BZh[1-9]|\xfd7zXZ\0", *map(re.escape, ZLIB)]))
PACKED_TEXT = re.compile(PACKED.pattern.decode("latin-1"))
BYTES = re.compile("[\0-\xff]+")
#: Where a match, or an encoding that text may be in, can lie in bytes; the shortest match has 12 letters.
ISLAND = re.compile(rb"[\0\t\n\r -~]{12,}")
STEP = 1 << 20  # bytes that a stream gives at a time
PIECE, OVERLAP = 1 << 22, 1 << 16  # new bytes in a piece of a stream's contents, and bytes of the piece before
LONGEST = 1 << 24  # bytes of an encoded run that is kept whole over pieces; rows with a longer one are marked
BOMB = 1 << 32  # bytes that the streams of one text may unpack to; rows with more are marked
#: The end of an encoded run, read backwards.
TAIL = re.compile(rb"(?:\0{0,3}+[A-Za-z0-9+/_=%\\-]|[ \t]*+[\r\n][ \t\r\n]*+)*+")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base matches: leftmost, not overlapping within a kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if has_long_run(text):
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def has_long_run(text: str, least: int = 16) -> bool:
    """Whether some run without white space is long enough for a key or an encoded layer."""
    return max(map(len, text.split()), default=0) >= least


class Layer:
    """A text whose i-th character came from the document's characters first[i] to last[i] - 1; ``flat``
    where that is one span for all of them."""

    def __init__(self, text: str, first: np.ndarray, last: np.ndarray, flat: tuple[int, int] | None = None):
        self.text, self.first, self.last, self.flat = text, first, last, flat

    @classmethod
    def of_span(cls, text: str, first: int, last: int) -> Layer:
        spread = lambda x: np.broadcast_to(np.int64(x), (len(text),))
        return cls(text, spread(first), spread(last), (first, last))

    def span(self, start: int, kind: int, end: int) -> Span:
        return int(self.first[start:end].min()), kind, int(self.last[start:end].max())

    def key(self) -> bytes:
        """Tells layers apart by text and origin: equal layers from two places are two layers."""
        own = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16)
        for origin in self.flat and map(np.int64, self.flat) or (self.first, self.last):
            own.update(origin.tobytes())
        return own.digest()


def in_place(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every run of ``pattern`` decoded; None if there is none."""
    parts: list[str] = []
    firsts: list[np.ndarray] = []
    lasts: list[np.ndarray] = []
    at, changed = 0, False
    for m in pattern.finditer(layer.text):
        got = decode(m.group(), layer.first[m.start() : m.end()], layer.last[m.start() : m.end()])
        changed = True
        parts += [layer.text[at : m.start()], got[0]]
        firsts += [layer.first[at : m.start()], np.array(got[1], np.int64)]
        lasts += [layer.last[at : m.start()], np.array(got[2], np.int64)]
        at = m.end()
    if not changed:
        return None
    parts.append(layer.text[at:])
    if layer.flat:
        return Layer.of_span("".join(parts), *layer.flat)
    return Layer("".join(parts), np.concatenate([*firsts, layer.first[at:]]), np.concatenate([*lasts, layer.last[at:]]))


def percent(run: str, first: np.ndarray, last: np.ndarray):
    return bytes.fromhex(run.replace("%", "")).decode("latin-1"), first[::3], last[2::3]


def wide(run: str, first: np.ndarray, last: np.ndarray):
    """UTF-16 and UTF-32, of either byte order."""
    step = 4 if run[2] == "\0" else 2
    return run[::step], first[::step], last[::step]


def unicode(run: str, first: np.ndarray, last: np.ndarray):
    units, firsts, lasts = [], [], []
    for m in ONE_UNICODE.finditer(run):
        code = int(m[1] or m[2] or m[3], 16)
        if units and 0xDC00 <= code < 0xE000 and 0xD800 <= units[-1] < 0xDC00:
            units[-1] = 0x10000 + ((units[-1] - 0xD800) << 10) + code - 0xDC00
            lasts[-1] = int(last[m.end() - 1])
            continue
        units.append(code)
        firsts.append(int(first[m.start()]))
        lasts.append(int(last[m.end() - 1]))
    return "".join("\ufffd" if 0xD800 <= u < 0xE000 or u > 0x10FFFF else chr(u) for u in units), firsts, lasts


def unpacker(head: bytes):
    """A fresh decompressor for a stream that begins with ``head``, or None."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:2] in ZLIB:
        return zlib.decompressobj(15)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor(lzma.FORMAT_XZ)
    return None


def unpacked(chunks: Iterator[memoryview]) -> Iterator[bytes]:
    """The contents, a step at a time, of a compressed stream at the start of ``chunks`` and of those that
    follow it at once or after zeros; up to the first fault."""
    data, began = memoryview(b""), False

    def fill(n: int) -> None:
        nonlocal data
        while len(data) < n and (more := next(chunks, None)) is not None:
            data = memoryview(bytes(data) + bytes(more)) if len(data) else memoryview(more)

    while True:
        fill(6)
        while began and len(data) and not data[0]:
            some = bytes(data[:4096])
            data = data[len(some) - len(some.lstrip(b"\0")) :]
            fill(6)
        own = unpacker(bytes(data[:6]))
        if own is None:
            return
        began, before, n = True, data, 0
        try:
            while not own.eof:
                feed = getattr(own, "unconsumed_tail", b"")
                if not feed and getattr(own, "needs_input", True):
                    fill(1)
                    before, n = data, min(1024, len(data))
                    feed, data = data[:n], data[n:]
                out = own.decompress(feed, STEP)
                if out:
                    yield out
                elif not n:
                    return
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return
        data = before[n - len(own.unused_data) :]


def starts(head: bytes) -> bool:
    """Whether the first bytes of a stream can be read without a fault."""
    own = unpacker(head[:6])
    try:
        if own is not None:
            own.decompress(head, 1)
        return own is not None
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return False


def used(data: bytes) -> int:
    """How many bytes the streams at the start of ``data`` take up, those that follow at once or after zeros among them;
    all of them where a stream does not come to its end."""
    at = 0
    while (own := unpacker(data[at : at + 6])) is not None:
        try:
            feed, size = data[at:], 0
            while not own.eof:
                size += len(out := own.decompress(feed, STEP))
                feed = getattr(own, "unconsumed_tail", b"")
                if size > BOMB or not out and not feed and getattr(own, "needs_input", True) and not own.eof:
                    return len(data)
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return len(data) if at == 0 else at
        at = len(data) - len(own.unused_data)
        zeros = len(data) - at - len(data[at:].lstrip(b"\0"))
        if unpacker(data[at + zeros : at + zeros + 6]) is None:
            return at
        at += zeros
    return at


def streams_of(layer: Layer, tally: Tally) -> Iterator[Stream]:
    """The compressed streams whose bytes are characters of a layer.  What comes out of one has the span of its bytes."""
    runs = list(BYTES.finditer(layer.text)) if not layer.text.isascii() else [re.match("(?s).*", layer.text)]
    for run in runs:
        data = None
        for m in PACKED_TEXT.finditer(layer.text, run.start(), run.end()):
            data = data or run.group().encode("latin-1")
            own = data[m.start() - run.start() :]
            if not starts(own[:512]):
                continue
            end = m.start() + used(own)
            yield Stream(partial(lambda own: iter([memoryview(own)]), own), int(layer.first[m.start() : end].min()), int(layer.last[m.start() : end].max()), tally)


def islands(raw: bytes) -> Iterator[tuple[int, str]]:
    """Where in ``raw`` something may be found, and that as text."""
    for m in ISLAND.finditer(raw):
        text = m.group().decode("latin-1")
        if base_spans(text) or openable(text):
            yield m.start(), text


class Tally:
    """What the streams of one text have unpacked to, and whether a guard fired."""

    def __init__(self):
        self.size, self.cut = 0, False


class Stream:
    """The contents of a compressed stream, which came from the document's characters first to last - 1.
    It can be read again from any place, so a stream in it that runs over pieces is read on."""

    def __init__(self, chunks: Callable[[], Iterator[memoryview]], first: int, last: int, tally: Tally):
        self.chunks, self.first, self.last, self.tally = chunks, first, last, tally
        self.left = self.pieces()

    def contents(self) -> Iterator[bytes]:
        for part in unpacked(self.chunks()):
            self.tally.size += len(part)
            if self.tally.size > BOMB:
                self.tally.cut = True
                return
            yield part

    def after(self, at: int) -> Iterator[memoryview]:
        for part in self.contents():
            if at < len(part):
                yield memoryview(part)[at:]
            at = max(0, at - len(part))

    def pieces(self) -> Iterator[tuple[bytes, int | None]]:
        """Pieces, and where each ends (None for the last).  A piece begins with what may go on from the one before."""
        held, fresh, end = bytearray(), 0, 0
        for part in self.contents():
            held += part
            fresh, end = fresh + len(part), end + len(part)
            if fresh >= PIECE:
                yield bytes(held), end
                run = TAIL.match(held[::-1]).end()
                if run > LONGEST:
                    self.tally.cut = True
                    run = 0
                held, fresh = held[-max(run, OVERLAP) :], 0
        if fresh:
            yield bytes(held), None

    def opened(self) -> tuple[bytes, list[Layer | Stream]] | None:
        """What tells the next piece apart, and its layers and the streams that begin in it; None at the end."""
        piece, end = next(self.left, (b"", None))
        if not piece:
            return None
        own = hashlib.blake2b(piece, digest_size=16, salt=b"piece")
        own.update(np.array([self.first, self.last]).tobytes())
        on = lambda at: itertools.chain([memoryview(piece)[at:]], self.after(end) if end is not None else ())
        inner = [Stream(partial(on, m.start()), self.first, self.last, self.tally) for m in PACKED.finditer(piece) if starts(piece[m.start() : m.start() + 512])]
        return own.digest(), [*[Layer.of_span(text, self.first, self.last) for _, text in islands(piece)], *inner]


def base64_runs(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """The places of the letters of each base64 run, and the run's end: unbroken runs, and runs joined
    over line breaks (also ones written as escapes)."""
    if has_long_run(text):
        for m in BASE64.finditer(text):
            yield np.arange(m.start(), m.start() + len(m.group().rstrip("="))), m.end()
    if "\n" in text or "\r" in text or "\\" in text:
        for m in WRAPPED.finditer(text):
            if m.end() - m.start() > 16:
                keep = np.ones(m.end() - m.start(), bool)
                keep[len(m.group().rstrip("=")) :] = False
                for gap in BREAK.finditer(m.group()):
                    keep[gap.start() : gap.end()] = False
                if keep.sum() >= 16:
                    yield m.start() + np.flatnonzero(keep), m.end()


def openable(text: str) -> bool:
    """Whether some layer may come out of a text."""
    return "%" in text and PERCENT.search(text) is not None or "\\" in text and UNICODE.search(text) is not None or "\0" in text and WIDE.search(text) is not None or next(base64_runs(text), None) is not None


def base64_layers(layer: Layer, tally: Tally) -> Iterator[Layer | Stream]:
    """Layers for each base64 run, read from each of its first four letters, as letters before the encoded
    part (a path, a word) may belong to the run.  Every byte is one character, which finds the same as UTF-8
    would, as all patterns are ASCII; compressed streams are unpacked wherever they begin."""
    for place, end in base64_runs(layer.text):
        letters = "".join(map(layer.text.__getitem__, place)) if place[-1] - place[0] >= len(place) else layer.text[place[0] : place[-1] + 1]
        letters = letters.translate({45: 43, 95: 47})
        for shift in range(4):
            run = letters[shift:]
            if len(run) % 4 == 1:
                run = run[:-1]
            raw = base64.b64decode(run + "=" * (-len(run) % 4))
            left = lambda at: place[shift + at * 4 // 3]  # noqa: B023, E731
            for m in PACKED.finditer(raw):
                if not starts(raw[m.start() : m.start() + 512]):
                    continue
                begin = left(m.start())
                first, last = int(layer.first[begin:end].min()), int(layer.last[begin:end].max())
                yield Stream(partial(lambda raw, at: iter([memoryview(raw)[at:]]), raw, m.start()), first, last, tally)
            for begin, text in islands(raw):
                if layer.flat:
                    yield Layer.of_span(text, *layer.flat)
                else:
                    at = np.arange(begin, begin + len(text))
                    right = place[shift + np.minimum(((at + 1) * 4 + 2) // 3, len(run)) - 1]
                    yield Layer(text, layer.first[left(at)], layer.last[right])


def scan(text: str) -> tuple[list[Span], list[Span], bool]:
    """The base spans of a text, all spans (those of every layer, mapped back), and whether a guard fired."""
    base = base_spans(text)
    if not openable(text) and (text.isascii() or PACKED_TEXT.search(text) is None):
        return base, base, False
    found = set(base)
    at = np.arange(len(text))
    whole = Layer(text, at, at + 1)
    work: list[Layer | Stream] = [whole]
    seen = {whole.key()}
    tally = Tally()
    while work:
        layer = work.pop()
        opened: list[Layer | Stream | None] = []
        if isinstance(layer, Stream):
            piece = layer.opened()
            if piece is not None:
                work.append(layer)
                if piece[0] not in seen:  # a piece that is known has known streams in it
                    seen.add(piece[0])
                    opened = piece[1]
        else:
            if "%" in layer.text:
                opened.append(in_place(layer, PERCENT, percent))
            if "\\" in layer.text:
                opened.append(in_place(layer, UNICODE, unicode))
            if "\0" in layer.text:
                opened.append(in_place(layer, WIDE, wide))
            if layer is not whole or not text.isascii():
                opened += streams_of(layer, tally)
            opened += base64_layers(layer, tally)
        for new in opened:
            if isinstance(new, Stream):
                work.append(new)
            elif new is not None and new.text and (key := new.key()) not in seen:
                seen.add(key)
                found.update(new.span(s, k, e) for s, k, e in base_spans(new.text))
                work.append(new)
    return base, sorted(found), tally.cut


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans of a text, and all spans."""
    return scan(text)[:2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of each row: ``spans`` (array of kind, start, end: code points, end exclusive, base: whether
    a base pattern finds it in the text itself), and ``cut``: whether a guard left something unread, as its
    streams unpack to over ``BOMB`` bytes or hold an encoded run of over ``LONGEST``.

    A null text counts as empty; a null id is kept; repeated rows give repeated results; other columns
    are left out, whatever their names; an empty table gives an empty one.  Spans that two layers give
    alike count once.
    """
    small_batches(docs.sparkSession)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    schema = pa.schema([("id", pa.int64()), ("spans", pa.list_(kind)), ("cut", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                out, cuts = [], []
                for text in part.column(1).to_pylist():
                    base, spans, cut = scan(text) if text else ([], [], False)
                    cuts.append(cut)
                    own = set(base)
                    out.append([{"kind": KINDS[k], "start": s, "end": e, "base": (s, k, e) in own} for s, k, e in spans])
                yield batch(schema, id=part.column(0), spans=out, cut=cuts)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    spans = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
    return rows.mapInArrow(run, f"id long, spans {spans}, cut boolean").withColumnRenamed("id", id_col)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, and the mark of guards, for every whole text of ``documents``."""
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), "cut")
