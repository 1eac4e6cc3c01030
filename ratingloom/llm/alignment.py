"""Tokens of two vocabularies aligned by the byte offsets at which both end.

Two ascending lists of end offsets are walked along a *diagonal*: while the next token of one list ends where
the next of the other does, the shift between the two indexes stands, and the stretch is measured by probing
1, 2, 4, ... further pairs at that shift and halving back to the first that differs.  An irregular group, whose
tokens end apart, is resolved on the spot by moving the list that is behind; it sets the new shift.

Texts are cut into segments before single spaces that stand between two characters other than white space.
Both vocabularies start a new token there whatever stands around it (the byte-level pattern splits there, and
no piece of the other has a space inside), so a segment is encoded and aligned once for a worker's batches and
its groups and links are used again wherever it recurs; a text without such places is one segment.

A pair of tokens is *linked* where both end at the same offset.  The shorter one's bytes then end the longer
one, so the pairs there can be follow from the vocabularies alone: fewer than the bytes of all tokens.  That
bounds the table of counts, which is broadcast, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_vocabulary, merges
from .common import Scratch, batch, read_table, small_batches

MEMO = 250_000  # segments that a worker remembers before it starts afresh
KEPT = 400  # characters of the longest segment that it remembers
JOINED = 50  # segments that are encoded as one text


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def stretch(a: list[int], i: int, b: list[int], j: int) -> int:
    """How many ends from a[i] and b[j] on are equal one by one: doubling probes, then halving."""
    most = min(len(a) - i, len(b) - j)
    done, step = 0, 1
    while done < most:
        step = min(step, most - done)
        if a[i + done : i + done + step] == b[j + done : j + done + step]:
            done += step
            step *= 2
        elif step == 1:
            break
        else:
            step //= 2
            most = min(most, done + 2 * step)  # the first difference lies within the probe that failed
    return done


def aligned_groups(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """(tokens of a, tokens of b) that end at each common end, for two ascending lists with the same last end."""
    out: list[tuple[int, int]] = []
    i = j = 0
    while i < len(a) and j < len(b):
        run = stretch(a, i, b, j) if a[i] == b[j] else 0
        out += [(i + k + 1, j + k + 1) for k in range(run)]
        i, j = i + run, j + run
        if i < len(a) and j < len(b):  # the shift ends here: the list that is behind moves until both meet
            while a[i] != b[j]:
                if a[i] < b[j]:
                    i += 1
                else:
                    j += 1
            i, j = i + 1, j + 1
            out.append((i, j))
    return out


class Vocabularies:
    """The two tokenizers, the bytes of their tokens, and the pairs that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = merges(path_a).token
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = [len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a, default=-1) + 1)]
        self.size_b = list(map(len, self.bytes_b))
        self.names = list(map(str, range(max(len(self.size_a), len(self.size_b)))))
        self.pairs = self._linkable()

    def spelt(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether the tokens' bytes are those of the text."""
        raw = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def _linkable(self) -> np.ndarray:
        """a << 32 | b of each pair of which one's bytes end the other's, ascending."""
        by_bytes: tuple[dict, dict] = ({}, {})
        for i, w in self.bytes_a.items():
            by_bytes[0].setdefault(w, []).append(i)
        for i, w in enumerate(self.bytes_b):
            by_bytes[1].setdefault(w, []).append(i)
        found = set()
        for w, own in by_bytes[0].items():
            for k in range(len(w)):
                found.update(a << 32 | b for b in by_bytes[1].get(w[k:], ()) for a in own)
        for w, own in by_bytes[1].items():
            for k in range(len(w)):
                found.update(a << 32 | b for a in by_bytes[0].get(w[k:], ()) for b in own)
        return np.array(sorted(found), np.int64)


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


Segment = tuple[int, int, int, str, bytes]  # tokens of a, of b, groups, the groups as text, linked pairs' numbers
WRONG: Segment = (-1, 0, 0, "", b"")  # the tokens' bytes are not those of the text


BESIDE_SPACE = re.compile(r"\s | \s|^ | $")


def segments(text: str) -> list[str]:
    """`` `` + ``text`` cut before stable spaces, each segment without the space that it starts with."""
    words = text.split(" ")
    if not BESIDE_SPACE.search(text):
        return words
    out: list[str] = []
    whole = True  # whether the last segment ends with a character other than white space
    for word in words:
        if out and (not whole or not word or word[0].isspace()):
            out[-1] += " " + word
        else:
            out.append(word)
        whole = bool(word) and not word[-1].isspace()
    return out


class Aligner:
    """Aligns texts segment by segment, and remembers segments between batches."""

    def __init__(self, path_a: str, path_b: str):
        self.own = vocabularies(path_a, path_b)
        self.memo: dict[str, Segment] = {}

    def new_segments(self, texts: list[str]) -> list[Segment]:
        """The segments space + text.  Those that begin and end with characters other than white space are encoded
        ``JOINED`` at a time, with the spaces that they were cut at; one by one where that does not spell them."""
        stable = [t and not t[0].isspace() and not t[-1].isspace() for t in texts]
        joined = list(compress(texts, stable))
        units = [joined[k : k + JOINED] for k in range(0, len(joined), JOINED)]
        found: dict[str, Segment] = {}
        again = self._walk(units + [[t] for t, s in zip(texts, stable) if not s], found)
        self._walk([[t] for unit in again if len(unit) > 1 for t in unit], found)
        return [found.get(t, WRONG) for t in texts]

    def _walk(self, units: list[list[str]], known: dict[str, Segment]) -> list[list[str]]:
        """Puts the segments of ``units`` into ``known``, walked end to end; gives back the units that are not spelt by
        their tokens, or in which a segment does not end where tokens of both do."""
        own = self.own
        texts = [" ".join(unit) for unit in units]
        ids_b = own.b.encode(texts, num_threads=1)
        texts = [" " + t for t in texts]
        ids_a = [e.ids for e in own.a.encode_batch_fast(texts, add_special_tokens=False)]
        spelt = [own.spelt(text, a, b) for text, a, b in zip(texts, ids_a, ids_b)]
        refused = [unit for unit, right in zip(units, spelt) if not right]
        units = list(compress(units, spelt))
        if not units:
            return refused
        all_a, all_b = list(chain.from_iterable(compress(ids_a, spelt))), list(chain.from_iterable(compress(ids_b, spelt)))
        ends_a = list(accumulate(map(own.size_a.__getitem__, all_a)))
        groups = aligned_groups(ends_a, list(accumulate(map(own.size_b.__getitem__, all_b))))
        last = np.array(groups, np.int64) - 1
        ends = np.array(ends_a, np.int64)[last[:, 0]]
        segment_ends = np.cumsum([len(s.encode()) + 1 for unit in units for s in unit])
        stops = np.searchsorted(ends, segment_ends, "right")
        if (ends[stops - 1] != segment_ends).any():
            return refused + [unit for unit in units if len(unit) > 1] + self._walk([unit for unit in units if len(unit) == 1], known)
        names_a, names_b = list(map(own.names.__getitem__, all_a)), list(map(own.names.__getitem__, all_b))
        as_text, i, j = [], 0, 0
        for to_i, to_j in groups:
            if to_i - i == 1 == to_j - j:
                as_text.append(names_a[i] + "|" + names_b[j])
            else:
                as_text.append(f"{','.join(names_a[i:to_i])}|{','.join(names_b[j:to_j])}")
            i, j = to_i, to_j
        links = np.array(all_a, np.int64)[last[:, 0]] << 32 | np.array(all_b, np.int64)[last[:, 1]]
        numbers = np.searchsorted(own.pairs, links).astype("<i4").tobytes()
        sizes = np.diff(last[stops - 1], axis=0, prepend=-1).tolist()
        at = 0
        for segment, (n_a, n_b), to in zip(chain.from_iterable(units), sizes, stops.tolist()):
            known[segment] = (n_a, n_b, to - at, ";".join(as_text[at:to]), numbers[4 * at : 4 * to])
            at = to
        return refused

    def align(self, texts: list[str | None]) -> list[list[Segment]]:
        """The segments of each text; none where the text is null or empty."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        cut = [segments(t) if t else [] for t in texts]
        known = self.memo
        missing = list(set(chain.from_iterable(cut)).difference(known))
        fresh = dict(zip(missing, self.new_segments(missing)))
        known.update((s, f) for s, f in fresh.items() if len(s) <= KEPT)
        longer = {s: f for s, f in fresh.items() if len(s) > KEPT}
        return [[longer[s] if s in longer else known[s] for s in c] if longer else list(map(known.__getitem__, c)) for c in cut]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


LINKED = "n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


def align_documents(docs: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None, digest: bool = False) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``; its SHA-256 with ``digest``, empty
    without tokens) and links (the linked pairs' numbers among ``linkable_pairs``, packed and compressed).

    A byte-level vocabulary encodes space + text, a piece vocabulary text, both with special strings as plain
    text.  A null or empty text, or one whose tokens do not spell space + text, has no tokens.  Rows stay as
    they are, so repeated rows give repeated results; an empty table gives an empty one; texts of any length
    are taken whole; columns of ``docs`` with the new names are replaced.
    """
    small_batches(docs.sparkSession)
    paths = path_a or default_vocabulary(), path_b or default_pieces()
    names = [part.split()[0] for part in LINKED.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    place = kept.index(text_col)
    source = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, codec = aligner(*paths), pa.Codec("zstd")
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                part = whole.slice(at, 200)
                rows = []
                for found in own.align(part.column(place).to_pylist()):
                    if not found or WRONG in found:
                        rows.append((0, 0, 0, 0, "", b""))
                        continue
                    *n, texts, links = zip(*found)
                    text, links = ";".join(texts), b"".join(links)
                    rows.append((*map(sum, n), len(links) // 4, hashlib.sha256(text.encode()).hexdigest() if digest else text, codec.compress(links, asbytes=True)))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), [*[pa.int64()] * 4, pa.string(), pa.binary()])] if rows else []
                if rows:
                    yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*kept, *names])

    return source.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema], LINKED]))


def unpacked(links: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(links, 4 * n, asbytes=True), "<i4") if n else np.empty(0, np.int32)


def pair_counts(aligned: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """id_a, id_b, n (links that hold the pair) and best (n is the highest of id_b) over all rows of ``aligned``.

    Tasks count into one array of all linkable pairs, a few MB, and send what is not zero.
    """
    spark = aligned.sparkSession
    paths = path_a or default_vocabulary(), path_b or default_pieces()
    schema = pa.schema([("pair", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(vocabularies(*paths).pairs), np.int64)
        for b in batches:
            parts = [unpacked(x, n) for x, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if parts:
                seen += np.bincount(np.concatenate(parts), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield batch(schema, pair=at.astype(np.int32), n=seen[at])

    counts = aligned.select("links", "n_links").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = vocabularies(*paths).pairs[counts.column("pair").to_numpy()]
    n, b = counts.column("n").to_numpy(), pairs & 0xFFFFFFFF
    highest = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b, n)
    table = pa.table({"pair": counts.column("pair"), "id_a": (pairs >> 32).astype(np.int32), "id_b": b.astype(np.int32), "n": n, "best": n == highest[b]})
    return spark.createDataFrame(table)


def with_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` without its links, with n_best and count_sum: over a row's links, how many are a best pair of
    their id_b, and the sum of the pairs' counts."""
    got = counts.select("pair", "n", "best").toArrow()  # bounded by the vocabularies
    size = int(got.column("pair").to_numpy().max(initial=-1)) + 1
    n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    n[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    best[got.column("pair").to_numpy()] = got.column("best").to_numpy(zero_copy_only=False)
    shared = aligned.sparkSession.sparkContext.broadcast((n, best))
    kept = [c for c in aligned.columns if c not in ("links", "n_best", "count_sum")]
    source = aligned.select(*[F.col(f"`{c}`") for c in kept], "links")
    place = kept.index("n_links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = shared.value
        for b in batches:
            links = [unpacked(x, k) for x, k in zip(b.column(len(kept)).to_pylist(), b.column(place).to_pylist())]
            own = [pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(n[x].sum()) for x in links], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *own], names=[*kept, "n_best", "count_sum"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "links"]
    return source.mapInArrow(run, ", ".join([*fields, "n_best long", "count_sum long"]))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of every whole text of ``documents``, with corpus-wide counts of the linked pairs."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = Scratch(spark, "alignment").save(align_documents(docs, digest=True).drop("text"))
    out = with_counts(aligned, pair_counts(aligned))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
