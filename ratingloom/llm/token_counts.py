"""Token counts by a public tokenizer, exact for documents of any length.

Documents up to ``huge`` characters are counted in one go.  Longer ones are cut into overlapping
chunks, which Spark deals out to all tasks; each chunk is encoded with offsets.  Two neighbours are
spliced at the first *stable* boundary after the start of the right one: a space between two
characters that are not white space.  No piece of the split pattern crosses such a place, whatever
stands before or after, so the left chunk's tokens up to it and the right chunk's tokens from it are
those of the whole text.  Both chunks must report a token boundary at that very offset; a document in
which some overlap has none is done again with an overlap ``WIDEN`` times as long, in the end as one
chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_vocabulary, is_plain
from .common import Scratch, batch, small_batches

HUGE = 32_768
CHUNK = 16_384
OVERLAP = 256
WIDEN = 8
MEMO = 600_000
DEALT = 64  # chunks of a task, and the most tasks they are dealt to
PARTS = 20_000


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The vocabulary's tokenizer, on the calling thread alone, without truncation or padding."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class Counter:
    """Counts tokens word by word where a text's words are separated by stable boundaries, and by whole
    texts elsewhere; a worker remembers its words."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str | None]) -> list[int]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, split, missing = self.memo, [], set()
        for text in texts:
            words = None
            if text and not any(s in text for s in self.special):
                words = [" " + w for w in text.split(" ")]
                words[0] = words[0][1:]
                missing.update(words)
            split.append(words)
        missing = [w for w in missing if w not in memo]
        plain = [w for w in missing if is_plain(w.removeprefix(" "))]
        memo.update(zip(plain, self.lengths(plain)))
        out = []
        for text, words in zip(texts, split):
            try:
                out.append(0 if not text else sum(map(memo.__getitem__, words)) if words else self.lengths([text])[0])
            except KeyError:
                out.append(self.lengths([text])[0])
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def stable_from(text: str, at: int) -> int | None:
    """The first stable boundary at or after ``at``, which is 1 or more."""
    while (at := text.find(" ", at)) >= 0 and at + 1 < len(text):
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        at += 1
    return None


def small_counts(docs: DataFrame, path: str) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                yield batch(schema, id=part.column(0), n_bytes=part.column(2), n_tokens=own.count(part.column(1).to_pylist()))

    return docs.mapInArrow(run, "id long, n_bytes long, n_tokens long")


def cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """One row for each chunk, keyed by the stored number of its document."""
    kinds = [("number", pa.int64()), ("id", pa.int64()), ("n_bytes", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("text", pa.string())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for number, id, text, n in zip(*(c.to_pylist() for c in whole.columns)):
                if overlap >= len(text):
                    starts = [0]
                else:
                    starts = range(0, max(1, len(text) - overlap), chunk)
                for k, start in enumerate(starts):
                    last = k == len(starts) - 1
                    piece = text[start:] if last else text[start : start + chunk + overlap]
                    yield batch(schema, number=[number], id=[id], n_bytes=[n], chunk=[k], last=[last], text=[piece])

    return docs.select("number", "id", "text", "n_bytes").mapInArrow(run, "number long, id long, n_bytes long, chunk int, last boolean, text string")


def edges(chunks: DataFrame, path: str, chunk: int) -> DataFrame:
    """For each chunk, its left and right edge: the splice offset within the document, and what the
    chunk adds to the count when it is cut there."""
    kinds = [("number", pa.int64()), ("id", pa.int64()), ("n_bytes", pa.int64()), ("edge", pa.int32()), ("at", pa.int64()), ("n", pa.int64())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for whole in batches:
            for number, id, n, k, last, text in zip(*(c.to_pylist() for c in whole.columns)):
                found = encode(text, add_special_tokens=False)
                before = {start: i for i, (start, _) in reversed(list(enumerate(found.offsets)))} if k or not last else {}
                own = [(-1, None, len(found.ids))] if last else []
                for edge, at, sign in ((k, 1, -1), (k + 1, chunk + 1, 1)):
                    if edge == 0 or sign > 0 and last:
                        continue
                    # with add_prefix_space off and offsets trimmed, a token that starts with a space has
                    # the offset after it
                    b = stable_from(text, at)
                    i = None if b is None else before.get(b, before.get(b + 1))
                    own.append((edge, None if i is None else k * chunk + b, 0 if i is None else sign * i))
                yield batch(schema, number=[number] * len(own), id=[id] * len(own), n_bytes=[n] * len(own), edge=[e for e, _, _ in own], at=[a for _, a, _ in own], n=[x for _, _, x in own])

    return chunks.mapInArrow(run, "number long, id long, n_bytes long, edge int, at long, n long")


def huge_counts(docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of the huge documents, spliced; widened until every document is whole.

    The documents are numbered and saved first, so a chunk that is cut again belongs to the same document.
    Chunks are dealt to as many tasks as their number asks for, as encoding costs time, not bytes.
    """
    scratch = Scratch(docs.sparkSession, "token-counts")
    left = scratch.save(docs.withColumn("number", F.monotonically_increasing_id()))
    done = None
    while True:
        size = left.agg(F.sum(F.ceil(F.length("text") / chunk)).alias("n")).first().n or 0
        dealt = cut(left, chunk, overlap).repartition(min(PARTS, max(1, -(-int(size) // DEALT))), "number", "chunk")
        spliced = (
            edges(dealt, path, chunk)
            .groupBy("number", "id", "n_bytes", "edge")
            .agg(F.sum("n").alias("n"), ((F.col("edge") == -1) | ((F.count("at") == 2) & (F.min("at") == F.max("at")))).alias("ok"))
            .groupBy("number", "id", "n_bytes")
            .agg(F.sum("n").alias("n_tokens"), F.every("ok").alias("ok"))
        )
        saved = scratch.save(spliced)
        good = saved.filter("ok").select("id", "n_bytes", "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = saved.filter("not ok").select("number")
        if failed.isEmpty():
            scratch.drop(left)
            return done
        again = scratch.save(left.join(failed, "number", "left_semi"))
        scratch.drop(left)
        left = again
        overlap *= WIDEN


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = 512, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """n_bytes, n_tokens and over_limit (n_tokens > ``limit``) for each row of ``docs``, under its id.

    A null text counts as empty (0 and 0); a null id is kept; repeated rows give repeated results; other
    columns are left out, whatever their names.  An empty table gives an empty one.
    """
    if overlap < 2 or overlap > chunk:
        raise ValueError("the overlap has to be between 2 characters and a chunk")
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    small = small_counts(rows.filter(F.length("text") <= huge), path)
    large = huge_counts(rows.filter(F.length("text") > huge), path, chunk, overlap)
    return small.unionByName(large).select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of ``documents``."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
