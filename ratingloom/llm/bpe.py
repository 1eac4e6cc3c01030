"""Byte-pair encoding and decoding with a transducer lexicon of frequent words.

A *word* here is a run without spaces together with the one space before it.  In the vocabularies'
split pattern such a run starts a new piece whenever the character before its space and the one
after it are not white space, so words can be encoded one at a time and their ids joined.  Texts
where that does not hold (double spaces, a space beside a line break, a word at the very start)
are split by the full pattern instead.

1. Spark counts the words of the whole corpus; the ``lexicon_size`` most frequent ones are merged
   on the driver and compiled into a minimal acyclic transducer: common prefixes and suffixes share
   states, and the sum of the numbers on a word's arcs is its place in a table of id sequences.
2. The compiled arrays (bounded by ``lexicon_size``) are broadcast as bytes; each worker maps them
   from one file of its own temporary folder.
3. Workers look words up in the transducer, a batch at a time, and merge the rest exactly.
"""

from __future__ import annotations

import hashlib
import io
import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, small_batches

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
LEXICON_SIZE = 60_000
MAX_WORD = 48  # bytes of the longest word that the lexicon takes
NO_RANK = 1 << 30
MEMO = 400_000  # words that a worker remembers before it starts afresh
COUNT_FLUSH = 250_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: character -> byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merge table of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.token = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        self.byte_id = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int32)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.pair_rank = np.argsort(key).astype(np.int32)
        self.pair = key[self.pair_rank]
        self.byte_rank = self._rank(*np.broadcast_arrays(self.byte_id[:, None], self.byte_id[None, :])).astype(np.int32)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token |= {i: s.encode() for s, i in self.special.items()}
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.split = regex.compile(SPLIT)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece.  Pieces of like length take their merges together: in each round
        every piece joins its leftmost pair of least rank, until no pair of it has a rank."""
        out: list[bytes] = [b""] * len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(length, kind="stable")
        at = int(np.searchsorted(length[order], 1))
        while at < len(order):
            n = int(length[order[at]])
            upto = int(np.searchsorted(length[order], n + n // 4, "right"))
            upto = min(upto, at + max(1, 400_000 // n))
            rows = order[at:upto]
            for row, ids in zip(rows.tolist(), self._merge_block([pieces[i] for i in rows], length[rows])):
                out[row] = ids
            at = upto
        return out

    def _merge_block(self, pieces: list[bytes], length: np.ndarray) -> list[bytes]:
        width = int(length.max())
        inside = np.arange(width) < length[:, None]
        letters = np.zeros((len(pieces), width), np.uint8)
        letters[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.byte_id[letters]
        rank = np.full((len(pieces), width), NO_RANK, np.int32)
        rank[:, :-1] = self.byte_rank[letters[:, :-1], letters[:, 1:]]
        rank[:, :-1][~inside[:, 1:]] = NO_RANK
        left = length.copy()
        live = np.arange(len(pieces))
        column = np.arange(width)
        while len(live):
            best = rank[live].argmin(axis=1)
            least = rank[live, best]
            go = least < NO_RANK
            live, best, least = live[go], best[go], least[go]
            if not len(live):
                break
            later = np.minimum(column + (column > best[:, None]), width - 1)
            ids[live] = np.take_along_axis(ids[live], later, 1)
            shifted = np.take_along_axis(rank[live], later, 1)
            shifted[:, -1] = NO_RANK
            rank[live] = shifted
            ids[live, best] = self.merged[least]
            left[live] -= 1
            has_next = best + 1 < left[live]
            after = ids[live, np.minimum(best + 1, width - 1)]
            rank[live, best] = np.where(has_next, self._rank(ids[live, best], after), NO_RANK)
            back = best > 0
            rank[live[back], best[back] - 1] = self._rank(ids[live[back], best[back] - 1], ids[live[back], best[back]])
        ids = ids.astype("<u4")
        return [ids[i, :n].tobytes() for i, n in enumerate(left.tolist())]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], NO_RANK)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of texts without special strings: split by the full pattern, each distinct piece
        merged once."""
        split = [self.split.findall(w) for w in words]
        distinct = list({p for s in split for p in s})
        known = dict(zip(distinct, self.merge_all([p.encode() for p in distinct])))
        return [b"".join([known[p] for p in s]) for s in split]


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def is_plain(word: str) -> bool:
    """Whether a word neither starts nor ends with white space (``str.isspace`` covers all of \\s)."""
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


# The lexicon --------------------------------------------------------------------------------------


def compile_lexicon(entries: dict[bytes, bytes]) -> bytes:
    """A minimal acyclic transducer over ``entries``, as the bytes of an .npz-like archive.

    Words are added in sorted order; a state is frozen, and merged with an equal one, as soon as no
    later word can reach it.  An arc's number counts the words that sort before those below it, so the
    numbers on a word's path sum to its rank.
    """
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, list[tuple[int, int]]]] = []

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(frozen)
            frozen.append((final, arcs))
        return register[key]

    words = sorted(entries)
    path: list[list] = [[False, []]]  # open states from the root: final, frozen arcs
    labels: list[int] = []
    for word in words:
        shared = 0
        while shared < min(len(labels), len(word)) and labels[shared] == word[shared]:
            shared += 1
        while len(labels) > shared:
            final, arcs = path.pop()
            path[-1][1].append((labels.pop(), freeze(final, arcs)))
        for b in word[shared:]:
            labels.append(b)
            path.append([False, []])
        path[-1][0] = True
    while labels:
        final, arcs = path.pop()
        path[-1][1].append((labels.pop(), freeze(final, arcs)))
    root = freeze(*path[0])

    below = np.zeros(len(frozen), np.int64)  # a frozen state's arcs lead to states frozen before it
    keys, targets, numbers = [], [], []
    for s, (final, arcs) in enumerate(frozen):
        n = int(final)
        for label, target in arcs:
            keys.append(s * 256 + label)
            targets.append(target)
            numbers.append(n)
            n += int(below[target])
        below[s] = n
    sequences = [entries[w] for w in words]
    arrays = {
        "root": np.array([root], np.int64),
        "key": np.array(keys, np.int64),
        "target": np.array(targets, np.int32),
        "number": np.array(numbers, np.int32),
        "final": np.array([f for f, _ in frozen], np.bool_),
        "at": np.cumsum([0, *(len(s) // 4 for s in sequences)]).astype(np.int32),
        "ids": np.frombuffer(b"".join(sequences), "<u4"),
    }
    head = json.dumps([[k, str(a.dtype), len(a)] for k, a in arrays.items()]).encode()
    out = io.BytesIO()
    out.write(len(head).to_bytes(8, "little") + head + b" " * (-len(head) % 8))
    for a in arrays.values():
        raw = a.tobytes()
        out.write(raw + b"\0" * (-len(raw) % 8))
    return out.getvalue()


class Lexicon:
    """A compiled lexicon, read through a memory map."""

    def __init__(self, buffer):
        n = int.from_bytes(buffer[:8], "little")
        at = 8 + n + (-n % 8)
        for name, kind, size in json.loads(bytes(buffer[8 : 8 + n])):
            array = np.frombuffer(buffer, kind, size, at)
            setattr(self, name, array)
            at += array.nbytes + (-array.nbytes % 8)

    def look_up(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word as little-endian 32-bit integers, or None; all words take a step at once."""
        if not words or not len(self.key):
            return [None] * len(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.zeros((len(words), int(length.max())), np.uint8)
        letters[np.arange(letters.shape[1]) < length[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(len(words), self.root[0])
        place = np.zeros(len(words), np.int64)
        live = np.arange(len(words))
        for i in range(letters.shape[1]):
            live = live[(length[live] > i) & (state[live] >= 0)]
            if not len(live):
                break
            key = state[live] * 256 + letters[live, i]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[arc] == key
            state[live] = np.where(hit, self.target[arc], -1)
            place[live] += np.where(hit, self.number[arc], 0)
        known = (state >= 0) & self.final[np.maximum(state, 0)]
        return [self.ids[self.at[p] : self.at[p + 1]].tobytes() if k else None for k, p in zip(known.tolist(), place.tolist())]


_mapped: dict[str, Lexicon] = {}


def mapped_lexicon(data: bytes) -> Lexicon:
    """The lexicon, mapped from a file of the worker's temporary folder, written once for all workers
    beside each other and renamed into place."""
    name = hashlib.sha256(data).hexdigest()
    if name not in _mapped:
        path = os.path.join(tempfile.gettempdir(), f"lexicon-{name[:24]}")
        if not (os.path.exists(path) and os.path.getsize(path) == len(data)):
            os.makedirs(os.path.dirname(path), exist_ok=True)
            part = f"{path}.{os.getpid()}"
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, path)
        with open(path, "rb") as f:
            _mapped.clear()
            _mapped[name] = Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    return _mapped[name]


# Encoding -----------------------------------------------------------------------------------------


class Encoder:
    """Encodes texts to packed ids; remembers words between batches."""

    def __init__(self, table: Merges, lexicon: Lexicon | None):
        self.table, self.lexicon = table, lexicon
        self.memo: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def pack(self, text: str) -> bytes:
        return self.table.encode_words([text])[0]

    def learn(self, texts: Iterable[str | None]) -> None:
        """Look up or merge the words of a batch that the memo lacks."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        if len(self.first) > MEMO // 10:
            self.first.clear()
        special = self.table.split_special.search
        missing: set[str] = set()
        heads: set[str] = set()
        for text in texts:
            if text and not special(text):
                words = text.split(" ")
                heads.add(words[0])
                missing.update(words[1:])
        new = [w for w in missing if w not in self.memo and is_plain(w)]
        if self.lexicon is not None:
            raw = [b" " + w.encode() for w in new]
            short = [i for i, r in enumerate(raw) if len(r) <= MAX_WORD]
            for i, ids in zip(short, self.lexicon.look_up([raw[i] for i in short])):
                if ids is not None:
                    self.memo[new[i]] = ids
            new = [w for w in new if w not in self.memo]
        self.memo.update(zip(new, self.table.encode_words([" " + w for w in new])))
        new = [w for w in heads if w not in self.first and is_plain(w)]
        self.first.update(zip(new, self.table.encode_words(new)))

    def plain(self, text: str) -> bytes:
        """Packed ids of a text without special strings."""
        words = text.split(" ")
        try:
            return self.first[words[0]] + b"".join(map(self.memo.__getitem__, words[1:]))
        except KeyError:
            return self.pack(text)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        special = self.table.split_special
        if not special.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in special.finditer(text):
            out += [self.pack(text[at : m.start()]), self.table.special[m.group()].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self.pack(text[at:])])

    def decode(self, packed: bytes) -> str:
        table = self.table.token
        return b"".join(map(table.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


# Spark --------------------------------------------------------------------------------------------


def count_words(texts: DataFrame) -> DataFrame:
    """How often each word occurs in the whole column ``text``; partial counts leave the tasks."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    seen.update(text.split(" ")[1:])
                if len(seen) > COUNT_FLUSH:
                    yield batch(schema, word=list(seen.keys()), n=list(seen.values()))
                    seen.clear()
        if seen:
            yield batch(schema, word=list(seen.keys()), n=list(seen.values()))

    return texts.mapInArrow(partial, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, lexicon_size: int = LEXICON_SIZE) -> bytes:
    """Compile the ``lexicon_size`` most frequent words (ties: the smaller word) with their ids.

    Words over ``MAX_WORD`` bytes, and those touching white space other than their own space, stay out
    and are merged when met.  What reaches the driver is bounded by ``lexicon_size * MAX_WORD``.
    """
    small_batches(docs.sparkSession)
    table = merges(vocabulary or default_vocabulary())
    counts = count_words(docs.select(F.col(text_col).alias("text")))
    usable = counts.filter((F.octet_length("word") < MAX_WORD) & (F.length("word") > 0) & (F.col("n") > 1))
    usable = Scratch(docs.sparkSession, "lexicon").save(usable.withColumn("step", F.floor(8 * F.log2("n")).cast("int")))
    # the least step of frequency that the lexicon reaches; only words from there on are sorted
    least, room = 0, lexicon_size
    for step, n in sorted(usable.groupBy("step").count().collect(), reverse=True):
        least, room = step, room - n
        if room <= 0:
            break
    top = usable.filter(F.col("step") >= least).orderBy(F.desc("n"), F.asc("word")).limit(lexicon_size).select("word").toArrow().column(0).to_pylist()
    plain = [w for w in top if is_plain(w) and not table.split_special.search(w)]
    return compile_lexicon(dict(zip([b" " + w.encode() for w in plain], table.encode_words([" " + w for w in plain]))))


def encode_documents(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, lexicon: bytes | None = None, digest: bool = False) -> DataFrame:
    """Add ids and their decoding to each row of ``docs``.

    With ``digest`` the columns n_tokens, ids_sha256, decoded_sha256 are added, else ids (array) and
    decoded (text).  A null text counts as empty.  Columns of ``docs`` with the new names are replaced.
    Rows stay as they are, so repeated rows give repeated results; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if lexicon is None:
        lexicon = fit_lexicon(docs, text_col, vocabulary)
    shared = spark.sparkContext.broadcast(lexicon)
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, n_tokens long, decoded string"
    names = [part.split()[0] for part in new.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    place = kept.index(text_col) if text_col in kept else None
    if place is None:
        raise ValueError(f"{text_col} is among the new columns")
    source = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary, shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                texts = part.column(place).to_pylist()
                encoder.learn(texts)
                packed = [encoder.encode(t or "") for t in texts]
                decoded = [encoder.decode(p) for p in packed]
                n = pa.array([len(p) // 4 for p in packed], pa.int64())
                if digest:
                    own = [n, pa.array([hashlib.sha256(p).hexdigest() for p in packed]), pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded])]
                else:
                    own = [pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in packed], pa.list_(pa.int32())), n, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *own], names=[*kept, *names])

    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema], new])
    return source.mapInArrow(run, fields)


_encoders: dict[tuple, Encoder] = {}


def worker_encoder(vocabulary: str | None, lexicon: bytes | None) -> Encoder:
    """One encoder for a worker process, kept from task to task."""
    path = vocabulary or default_vocabulary()
    key = (path, hashlib.sha256(lexicon or b"").digest())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(merges(path), None if lexicon is None else mapped_lexicon(lexicon))
    return _encoders[key]


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of ids and of their decoding for every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs, digest=True).drop("text")
