"""Exact removal of long repeats by bucket-pointer refinement of a sampled suffix array.

A byte goes if some string of ``LENGTH`` bytes covers it that starts anywhere else as well.

*Sampling.*  The ``GRAM``-byte string of least hash in a window of ``LENGTH`` bytes (the leftmost of equals)
is the window's *anchor*; equal windows have it at the same offset, so windows can be compared by the
suffixes at their anchors.  Neighbouring windows share anchors: about one suffix in 85 is kept, with the
range of offsets it serves.

*Refinement.*  Suffixes start in buckets by their first q-gram (``GRAM`` bytes).  The bucket of a longer
string is named by bucket pointers: the pair of the bucket at its offset and the bucket at the later offset
where its other half begins, and so on recursively (``naming.Names``), so every step uses the names of the
steps before.  As only equality counts here, not order, Spark sorts and groups suffixes by these names instead
of ranking all of them; what is compared is the pair of a q-gram's name and a string's name, 128 bits.
Steps go from long ranges of offsets to short ones, and only buckets that are still open go on:

1. Buckets of one suffix are closed: no window at that anchor is repeated.
2. Suffixes whose whole range (all windows together) is in one bucket are repeated everywhere; one of them
   stands for the rest from here on.
3. Open ranges are cut into ``STRIDE`` offsets.  If the string that all windows of a piece share is in no
   other bucket, the piece is closed; if the string that they cover together is, the piece is repeated.
4. What is left is refined to single windows.

Nothing gathers a bucket in one task: each step is a grouped count and an equality join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, small_batches, with_few
from .naming import Names, paired

LENGTH = 200
GRAM = 32
STRIDE = 16
SEGMENT = 400_000  # bytes that are named at a time


def anchors_of(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, place, last place, least and greatest offset, bucket, name of the range, and number of the anchors
    of ``texts``: windows start at place - offset.

    Anchors that follow each other at one distance with equal ranges and names, as in periodic text, are one row.
    """
    size = np.array([len(t) for t in texts], np.int64)
    origin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(size) or size.max() < length:
        return tuple(np.zeros(0, np.int64) for _ in range(8))
    names = Names(data)
    grams = names.grams(gram)
    # hash above, place below: the least is leftmost among equals
    least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    width, done = length - gram + 1, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if width > done:
        least = np.minimum(least[: -(width - done)], least[width - done :])
    own = np.flatnonzero(size >= length)
    n = size[own] - length + 1
    window = np.repeat(origin[own] - np.cumsum(n) + n, n) + np.arange(n.sum())  # those that cross no border
    least = least[window]
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    start, stop = window[first], window[np.append(first[1:], len(least)) - 1]
    place = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo, hi = place - stop, place - start
    name = paired(names.of(start, stop + length), (lo * length + hi).astype(np.uint64))
    text = np.searchsorted(origin, start, "right") - 1
    # equal neighbours at equal distances
    same = np.append(False, (text[1:] == text[:-1]) & (name[1:] == name[:-1]) & (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1]))
    step = np.append(0, np.diff(place))
    same[1:] &= ~same[:-1] | (step[1:] == step[:-1])
    head = np.flatnonzero(~same)
    run = np.diff(np.append(head, len(place)))
    tail = head + run - 1
    return text[head], place[head] - origin[text[head]], place[tail] - origin[text[head]], lo[head], hi[head], grams[place[head]].view(np.int64), name[head].view(np.int64), run


def segments(texts: list[str | None], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Row, first byte and bytes of the parts of texts, in groups of about ``SEGMENT`` bytes.  A longer text is
    cut into parts that share no window and lose none; an anchor at a border then has two ranges."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        raw = (text or "").encode()
        for base in range(0, max(1, len(raw) - length + 1), SEGMENT):
            part = raw[base : base + SEGMENT + length - 1]
            if held and size + len(part) > SEGMENT:
                yield held
                held, size = [], 0
            held.append((row, base, part))
            size += len(part)
    if held:
        yield held


def find_anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The anchors of each row (id, print, text)."""
    columns = ["id", "print", "place", "last", "lo", "hi", "bucket", "name", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in segments(whole.column(2).to_pylist(), length):
                own, place, last, lo, hi, bucket, name, n = anchors_of([t for _, _, t in part], length, gram)
                row, base = (np.array([x[k] for x in part], np.int64)[own] for k in (0, 1))
                keys = [whole.column(k).take(pa.array(row)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(place + base), pa.array(last + base), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(bucket), pa.array(name), pa.array(n)], names=columns)

    return rows.select("id", "print", "text").mapInArrow(run, "id long, print long, place long, last long, lo int, hi int, bucket long, name long, run long")


def contexts(rows: DataFrame, records: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """``records`` with ``context``, the bytes that their windows cover."""
    own = F.struct("place", "lo", "hi", "bucket", "single")
    wanted = scratch.save(records.groupBy("id", "print").agg(F.collect_list(own).alias("records")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "lo", "hi", "bucket", "single"]
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                texts = [t.encode() for t in part.column(2).to_pylist()]
                lists = part.column(3).to_pylist()
                row = pa.array([i for i, x in enumerate(lists) for _ in x], pa.int64())
                flat = [x for own in lists for x in own]
                cut = [texts[i][x["place"] - x["hi"] : x["place"] - x["lo"] + length] for i, own in enumerate(lists) for x in own]
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), *(pa.array([x[n] for x in flat], t) for n, t in zip(names, types)), pa.array(cut, pa.binary())], names=["id", "print", *names, "context"])

    fields = "id long, print long, place long, lo int, hi int, bucket long, single boolean, context binary"
    return with_few(rows, wanted, "inner").select("id", "print", "text", "records").mapInArrow(run, fields)


def _arrays(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """lo, hi, and the contexts in one array with the place where each record's anchor is."""
    lo, hi = (part.column(part.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("lo", "hi"))
    raw = part.column(part.schema.get_field_index("context")).to_pylist()
    begin = np.cumsum([0, *map(len, raw)])[:-1]
    return lo, hi, begin + hi, np.frombuffer(b"".join(raw), np.uint8)


def pieces(found: DataFrame, length: int, stride: int) -> DataFrame:
    """The pieces of ``stride`` offsets of each record, named by the string their windows share (core) and
    by the string they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                part = whole.slice(at, 2_000)
                lo, hi, anchor, data = _arrays(part)
                names = Names(data)
                n = hi // stride - lo // stride + 1
                row = np.repeat(np.arange(len(lo)), n)
                piece = lo[row] // stride + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first, last = np.maximum(lo[row], piece * stride), np.minimum(hi[row], piece * stride + stride - 1)
                core = paired(names.of(anchor[row] - piece * stride, anchor[row] - piece * stride - (stride - 1) + length), piece.astype(np.uint64))
                cover = paired(names.of(anchor[row] - last, anchor[row] - first + length), (first * length + last).astype(np.uint64))
                take = [part.column(part.schema.get_field_index(c)).take(pa.array(row)) for c in ("id", "print", "place", "bucket", "single")]
                yield pa.RecordBatch.from_arrays([*take, pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(cover.view(np.int64))], names=["id", "print", "place", "bucket", "single", "lo", "hi", "core", "cover"])

    return found.mapInArrow(run, "id long, print long, place long, bucket long, single boolean, lo int, hi int, core long, cover long")


def single_windows(found: DataFrame, length: int) -> DataFrame:
    """Each window of each record, named by its string.  ``open`` lists the ranges still to be refined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                part = whole.slice(at, 2_000)
                _, _, anchor, data = _arrays(part)
                names = Names(data)
                lists = part.column(part.schema.get_field_index("open")).to_pylist()
                pairs = [(i, o) for i, own in enumerate(lists) for r in own for o in range(r["lo"], r["hi"] + 1)]
                row, offset = np.array([i for i, _ in pairs], np.int64), np.array([o for _, o in pairs], np.int64)
                begin = anchor[row] - offset
                take = [part.column(part.schema.get_field_index(c)).take(pa.array(row)) for c in ("id", "print", "place", "bucket", "single")]
                yield pa.RecordBatch.from_arrays([*take, pa.array(offset.astype(np.int32)), pa.array(names.of(begin, begin + length).view(np.int64))], names=["id", "print", "place", "bucket", "single", "offset", "name"])

    return found.mapInArrow(run, "id long, print long, place long, bucket long, single boolean, offset int, name long")


def repeated_spans(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """The rows (id, print, text) of ``docs``, and id, print, start and end (bytes) of repeated strings, read
    from tables of ``scratch``."""
    if not 8 <= gram <= length - STRIDE:
        raise ValueError("the gram has to be from 8 bytes to the length less a stride")
    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    anchors = scratch.save(find_anchors(rows, length, gram))
    buckets = anchors.groupBy("bucket").agg(F.sum("run").alias("n"), F.min("name").alias("one"), F.max("name").alias("another"))
    # tables to join with are saved first: Spark can then split what a hot bucket brings to the join
    kept = scratch.save(buckets.filter("n > 1").select("bucket", (F.col("one") != F.col("another")).alias("open")))
    shared = scratch.save(anchors.join(kept, "bucket"))

    scratch.drop(anchors, kept)
    classes = scratch.save(shared.groupBy("bucket", "name").agg(F.sum("run").alias("n")))
    placed = scratch.save(shared.join(classes, ["bucket", "name"]))
    scratch.drop(shared, classes)
    cut = lambda df, lo, hi, last="place": df.select("id", "print", (F.col("place") - F.col(hi)).alias("start"), (F.col(last) - F.col(lo) + length).alias("end"))
    whole = cut(placed.filter("n > 1"), "lo", "hi", "last")

    records = placed.filter("open").withColumn("single", F.col("n") == 1)
    one = records.filter("single").unionByName(records.filter("not single").dropDuplicates(["bucket", "name"]))
    found = scratch.save(contexts(rows, one.select("id", "print", "place", "lo", "hi", "bucket", "single"), length, scratch))

    every = pieces(found, length, STRIDE)
    cores = every.groupBy("bucket", "core").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("some")).filter("n > 1 and some").select("bucket", "core")
    cores = scratch.save(cores)
    alive = scratch.save(every.join(cores, ["bucket", "core"]))
    covers = scratch.save(alive.groupBy("bucket", "cover").agg(F.count(F.lit(1)).alias("n")))
    met = scratch.save(alive.join(covers, ["bucket", "cover"]))
    scratch.drop(cores, alive, covers)
    parts = cut(met.filter("n > 1 and single"), "lo", "hi")

    # of equal pieces one goes on, and only where something is left to be told apart
    left = met.filter("n = 1").unionByName(met.filter("n > 1").dropDuplicates(["bucket", "cover"]))
    mixed_up = left.groupBy("bucket", "core").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("single") & (F.col("n") == 1)).alias("some")).filter("n > 1 and some").select("bucket", "core")
    open_ones = left.join(mixed_up, ["bucket", "core"]).withColumn("single", F.col("single") & (F.col("n") == 1))
    lists = open_ones.groupBy("id", "print", "place").agg(F.collect_set(F.struct("lo", "hi")).alias("open"))
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}")) for c in ("id", "print", "place")]
    last = scratch.save(found.dropDuplicates(["id", "print", "place"]).alias("f").join(lists.alias("l"), same[0] & same[1] & same[2]).select("f.*", "l.open"))
    windows = single_windows(last, length)
    again = windows.groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("some")).filter("n > 1 and some").select("bucket", "name")
    hits = windows.join(scratch.save(again), ["bucket", "name"])
    singles = cut(hits, "offset", "offset")
    return rows, whole.unionByName(parts).unionByName(singles)


def merged(spans: np.ndarray) -> np.ndarray:
    """Start and end of the maximal runs that spans (start, end) cover."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > end[:-1])
    return np.column_stack([spans[new, 0], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (bytes) of each row of ``docs``.

    Null texts count as empty; texts shorter than ``length`` stay whole.  Rows that repeat id and text are
    different rows, so each goes as far as it is long enough; of equal strings none is spared, so there are no
    ties; a null id is kept; other columns are left out, whatever their names; an empty table gives an empty
    one.  Texts of any length are named in parts of ``SEGMENT`` bytes.  Cuts may fall inside a character.
    """
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    rows, spans = repeated_spans(docs, scratch, id_col, text_col, **options)
    lists = scratch.save(spans.groupBy("id", "print").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    scratch.clear(lists)
    joined = with_few(rows, lists, "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                out = []
                for text, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = (text or "").encode()
                    cuts = merged(np.array([(s["start"], s["end"]) for s in own or []], np.int64).reshape(-1, 2)).tolist()
                    edges = [0, *(x for c in cuts for x in c), len(raw)]
                    out.append((len(raw), sum(e - s for s, e in cuts), len(cuts), b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))))
                n = [pa.array([o[k] for o in out], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(0), *n, pa.array([o[3] for o in out], pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_col)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes cut from every whole text of ``documents``."""
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
