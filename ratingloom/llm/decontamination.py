"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are the runs of ASCII digits, ASCII letters (lower-cased) and non-ASCII characters.  A *window* is
``window`` consecutive words of an item; an item of fewer words, but not none, is one window.

The automaton is built over the items' words and marks the states at which windows end.  Documents are
streamed through it; at each word it holds the longest item substring that ends there, and the marked
states on its suffix path give the windows that end there.  A word that no item has sends the automaton
back to its root, so only runs of known words, as long as the shortest window at least, take steps; the
runs are found on whole batches with numpy, by a table of word hashes that errs on one side only.

Items are taken in blocks of ``BLOCK`` characters, one automaton and one broadcast each.  Further blocks are
further passes, each over the saved result of the one before, so only one automaton is held at a time however
long the list of items is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, slices, small_batches

WINDOW = 10
BLOCK = 300_000
TABLE = 22  # bits of the hash table of words
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Bytes of words, lower-cased; 0 for the rest.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256))
MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


class Automaton:
    """Generalised suffix automaton over words; states have transitions, a suffix link and a length."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW):
        self.word: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(id, [self.word.setdefault(w.encode(), len(self.word)) for w in words]) for id, words in items if words]
        for _, item in coded:
            last = 0
            for w in item:
                last = self._extend(last, w)
        found: dict[int, dict[int, set[str]]] = {}
        for id, item in coded:
            n, v = min(window, len(item)), 0
            for i, w in enumerate(item):
                v = self.next[v][w]
                while self.link[v] >= 0 and self.length[self.link[v]] >= n:
                    v = self.link[v]
                if i + 1 >= n:
                    # a state may hold windows of two lengths, of short items and of long ones
                    found.setdefault(v, {}).setdefault(n, set()).add(id)
        self.own = {v: [(n, sorted(ids)) for n, ids in sorted(marks.items())] for v, marks in found.items()}
        self.least = min((min(window, len(item)) for _, item in coded), default=0)
        self.table = np.zeros(1 << TABLE, np.bool_)
        if self.word:
            raw = b"\0".join(self.word) + b"\0" * 9
            ends = np.cumsum([len(w) + 1 for w in self.word]) - 1
            begins = ends - np.array([len(w) for w in self.word])
            self.table[hashes(raw, begins, ends)] = True
        self.above: dict[int, list[tuple[int, list[str]]]] = {}

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, length: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        new = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[new], self.link[q] = self.link[q], new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def _path(self, v: int) -> list[tuple[int, list[str]]]:
        """Windows marked at the states above ``v``; all of them end where ``v`` ends."""
        if v not in self.above:
            out, u = [], self.link[v]
            while u > 0:
                out += self.own.get(u, [])
                u = self.link[u]
            self.above[v] = out
        return self.above[v]

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, last word, item ids) of each window that occurs in ``words``."""
        v = length = 0
        for i, raw in enumerate(words):
            w = self.word.get(raw, -1)
            while v and w not in self.next[v]:
                v = self.link[v]
                length = self.length[v]
            if w in self.next[v]:
                v, length = self.next[v][w], length + 1
            else:
                v = length = 0
            if length >= self.least:
                for n, ids in self.own.get(v, ()):
                    if n <= length:
                        yield i - n + 1, i, ids
                for n, ids in self._path(v):
                    yield i - n + 1, i, ids


def hashes(raw: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Slot of each word raw[begin:end]: from its first and last 8 bytes and its length.  ``raw`` has to
    go on for 8 bytes after the last word."""
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    n = ends - begins
    short = MASKS[np.minimum(n, 8)]
    head = eight[begins] & short
    tail = eight[np.maximum(begins, ends - 8)] & short
    return ((head * MIX[0] ^ (tail * MIX[1] + n.astype(np.uint64) * MIX[2])) * MIX[1] >> np.uint64(64 - TABLE)).astype(np.int64)


def matches(automaton: Automaton, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int, int]], set[str]]]:
    """For each text its number of words, its spans (first and last word, start and end character;
    overlapping windows joined, touching ones not), and the items whose windows occur in it."""
    raw = [b"" if t is None else t.encode() for t in texts]
    whole = b"\n".join(raw) + b"\0" * 9
    letters = np.frombuffer(whole.translate(BYTES), np.uint8)
    is_word = (letters != 0).astype(np.int8)
    change = np.diff(is_word, prepend=0)
    begins, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    origin = np.cumsum([0, *(len(r) + 1 for r in raw)])
    first = np.searchsorted(begins, origin)  # index of each text's first word
    found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    if automaton.least and len(begins):
        lower = letters.tobytes()
        known = automaton.table[hashes(lower, begins, ends)]
        # runs of known words, cut at the texts' borders
        edge = np.diff(known.astype(np.int8), prepend=0, append=0)
        run_from, run_to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = run_to - run_from >= automaton.least
        for a, b in zip(run_from[long].tolist(), run_to[long].tolist()):
            text = int(np.searchsorted(first, a, "right")) - 1
            while a < b:
                stop = min(b, int(first[text + 1]))
                if stop - a >= automaton.least:
                    run = [lower[s:e] for s, e in zip(begins[a:stop].tolist(), ends[a:stop].tolist())]
                    for x, y, ids in automaton.stream(run):
                        spans, items = found.setdefault(text, ([], set()))
                        spans.append((a + x - int(first[text]), a + y - int(first[text])))
                        items.update(ids)
                a, text = stop, text + 1
    for i, text in enumerate(texts):
        n = int(first[i + 1] - first[i])
        if i not in found:
            yield n, [], set()
            continue
        joined = merged(found[i][0])
        at = lambda byte: len(raw[i][: byte - int(origin[i])].decode("utf-8", "ignore"))
        f = int(first[i])
        yield n, [(x, y, at(int(begins[f + x])), at(int(ends[f + y]))) for x, y in joined], found[i][1]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of first and last words, with overlapping ones joined."""
    out: list[list[int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return [tuple(s) for s in out]


def joined_spans(a: list[dict], b: list[tuple[int, int, int, int]]) -> list[dict]:
    """Spans of two passes over one text, overlapping ones joined."""
    out: list[dict] = []
    names = ("first", "last", "start", "end")
    for s in sorted([*a, *(dict(zip(names, x)) for x in b)], key=lambda s: s["first"]):
        if out and s["first"] <= out[-1]["last"]:
            if s["last"] > out[-1]["last"]:
                out[-1] |= {"last": s["last"], "end": s["end"]}
        else:
            out.append(dict(s))
    return out


SPAN = pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])
FOUND = "n_words bigint, spans array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>, item_ids array<string>"


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, list[str]]]]:
    """The items' words, in blocks of about ``BLOCK`` characters (a longer item is a block)."""
    held, size = [], 0
    for id, text in items.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")).filter(f"`{text_col}` is not null").toLocalIterator():
        if held and size + len(text) > BLOCK:
            yield held
            held, size = [], 0
        held.append(("" if id is None else id, words_of(text)))
        size += len(text)
    yield held


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add n_words, spans and item_ids (sorted) to each row of ``docs``, replacing columns so named.

    ``spans`` has first and last word (from 0), start and end character of each maximal stretch covered by
    overlapping windows.  Null texts have no words; items without text or words have no windows; an item
    without id has the id ''; repeated rows and repeated items change nothing but the rows; without items
    or documents the result is plain or empty.
    """
    small_batches(docs.sparkSession)
    new = ["n_words", "spans", "item_ids"]
    kept = [c for c in docs.columns if c not in new]
    place = kept.index(text_col)
    out = docs.select(*[F.col(f"`{c}`") for c in kept])
    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema], FOUND])
    scratch = Scratch(docs.sparkSession, "decontamination")
    shared = None
    for number, block in enumerate(blocks(items, item_id, item_text)):
        if shared is not None:
            saved = scratch.save(out)
            scratch.clear(saved)
            shared.unpersist()
            out = saved
        shared = docs.sparkSession.sparkContext.broadcast(Automaton(block, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, again=number > 0) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for whole in batches:
                texts = whole.column(place).to_pylist()
                got = [x for part, _ in slices(texts, texts, 1_000_000) for x in matches(automaton, part)]
                spans = [joined_spans([], s) for _, s, _ in got]
                ids = [sorted(i) for _, _, i in got]
                if again:
                    before_spans, before_ids = (whole.column(len(kept) + k).to_pylist() for k in (1, 2))
                    spans = [joined_spans(a, [tuple(x.values()) for x in b]) for a, b in zip(before_spans, spans)]
                    ids = [sorted({*a, *b}) for a, b in zip(before_ids, ids)]
                own = [pa.array([n for n, _, _ in got], pa.int64()), pa.array(spans, pa.list_(SPAN)), pa.array(ids, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*whole.columns[: len(kept)], *own], names=[*kept, *new])

        out = out.mapInArrow(run, fields)
    return out


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", longest: int = WINDOW - 1, coverage: float = 0.5, **options) -> DataFrame:
    """Cut benchmark passages out of ``docs``; its columns stay as they are.

    Spans of more than ``longest`` words are cut, and a document of whose words more than ``coverage`` are
    hit goes altogether.  A shorter item counts for the coverage but is not cut by itself, as a few words
    are no passage; a smaller ``longest`` cuts it too.  Rows without spans come back unchanged, nulls included.
    """
    found = find_contamination(docs, items, text_col, **options)
    text = F.col(f"`{text_col}`")
    cut = F.filter("spans", lambda s: s["last"] - s["first"] + 1 > longest)
    # the pieces before, between and after the spans that are cut
    edges = F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform(cut, lambda s: F.array(s["start"], s["end"]))), F.array(F.length(text).cast("long")))
    pieces = F.transform(F.sequence(F.lit(0), F.size(cut)), lambda i: F.substr(text, (F.get(edges, 2 * i) + 1).cast("int"), (F.get(edges, 2 * i + 1) - F.get(edges, 2 * i)).cast("int")))
    left = F.when(F.size(cut) > 0, F.array_join(pieces, "")).otherwise(text)
    kept = found.filter(hit_words() <= F.lit(coverage) * F.col("n_words"))
    return kept.select(*[(left.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns])


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every whole text of ``documents`` against ``benchmark``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    n = hit_words()
    return found.select("doc_id", "n_words", n.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (n > 0).alias("contaminated"))
