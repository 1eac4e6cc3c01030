"""A Katz backoff model of words, and the log-probability of every text under it.

An n-gram seen c times in training has probability d(c) * c / c(context), where d is the Simple Good-Turing
discount of its order: the ratio of adjusted to raw count, (r + 1) n(r + 1) / (r n(r)), as long as it differs
from the fitted line of log n(r) significantly, and the line's ratio from there on.  The ratio is under 1 for
every r, so each context keeps mass for what it has not seen; it is handed to the order below by the weight

    alpha(h) = (1 - sum of d(c) c / c(h) over seen w) / (1 - sum of P(w | shorter h) over seen w),

computed from sums over exactly those n-grams, so every conditional distribution adds up to 1.  The lowest
order keeps its mass for one unknown word.  Evaluation recurses per token: the seen n-gram, or alpha times the
order below.

On Spark the tokenised corpus is stored once, in *blocks* of about ``BLOCK`` tokens: word hashes, and codes into
them.  For each order the blocks ask a table of counts, dealt out by key into buckets that grow in number with
the corpus: a block sends each of its distinct n-grams once with its count in training, a bucket adds up and
answers in the order asked, marking one asker of each n-gram as its *owner*.  A hot word is one key a block.
Owners contribute an n-gram's terms to the sums of its context, summed within the block before they are
shuffled.  Contexts and words stand for 64-bit hashes of their bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, read_table, small_batches

BLOCK = 1_000_000
BUCKET = 1_500_000  # tokens of the corpus for each bucket
LEAST_BUCKETS = 48
PIECE = 4_000_000  # bytes of a text that are split at once
MEMO = 400_000
FITTED = 200  # counts up to here fit the line of the discounts
SPACE = re.compile(rb"[\t-\r ]")
START, END = b" ", b"\n"  # not words: white space


# Words and keys -----------------------------------------------------------------------------------


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit key of two, order mattering."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lowered, split at ASCII white space, some megabytes at a time."""
    raw = text.encode().lower()
    at = 0
    while at < len(raw):
        cut = SPACE.search(raw, at + PIECE)
        to = cut.start() if cut else len(raw)
        yield raw[at:to].split()
        at = to


class Codes(dict):
    """Word -> place in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Packed:
    """Integer arrays as compressed bytes."""

    kinds = [np.uint8, np.uint16, np.uint32, np.uint64]

    def __init__(self):
        self.codec = pa.Codec("zstd")

    def pack(self, values: np.ndarray) -> bytes:
        top = int(values.max(initial=0))
        kind = next(i for i, k in enumerate(self.kinds) if top <= np.iinfo(k).max)
        raw = values.astype(self.kinds[kind]).tobytes()
        return bytes([kind]) + len(raw).to_bytes(8, "little") + self.codec.compress(raw, asbytes=True)

    def unpack(self, data: bytes) -> np.ndarray:
        size = int.from_bytes(data[1:9], "little")
        return np.frombuffer(self.codec.decompress(data[9:], size, asbytes=True), self.kinds[data[0]]) if size else np.empty(0, self.kinds[data[0]])


# Blocks -------------------------------------------------------------------------------------------

BLOCKS = "block long, tokens long, uid array<long>, held array<boolean>, size array<long>, lead array<int>, hashes binary, codes binary, row array<{row}>"


def blocks(docs: DataFrame, order: int, block: int) -> DataFrame:
    """``docs`` (uid, held, row, text) as blocks.  A piece of a document is held, size tokens, and lead tokens
    before them (starts, or words of the piece before) that only serve as context; its first piece has its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        packed, memo = Packed(), {}
        kinds = [("block", pa.int64()), ("tokens", pa.int64()), ("uid", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("size", pa.list_(pa.int64())), ("lead", pa.list_(pa.int32())), ("hashes", pa.binary()), ("codes", pa.binary())]
        schema = None
        name = TaskContext.get().partitionId() << 33
        codes, parts, pieces, n = Codes(), [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal codes, parts, pieces, n, name
            for w in codes:
                if w not in memo:
                    memo[w] = xxhash.xxh3_64_intdigest(w)
            hashes = np.fromiter(map(memo.__getitem__, codes), np.uint64, len(codes))
            out = batch(schema, block=[name], tokens=[n], **{k: [list(v)] for k, v in zip(("uid", "held", "size", "lead", "row"), zip(*pieces))}, hashes=[packed.pack(hashes)], codes=[packed.pack(np.concatenate(parts))])
            codes, parts, pieces, n, name = Codes(), [], [], 0, name + 1
            if len(memo) > MEMO:
                memo.clear()
            return out

        for whole in batches:
            schema = schema or pa.schema([*kinds, ("row", pa.list_(whole.schema.field("row").type))])
            for uid, held, row, text in zip(*(c.to_pylist() for c in whole.columns)):
                before = [START] * (order - 1)
                for words in words_of(text or ""):
                    parts.append(np.fromiter(map(codes.__getitem__, before + words), np.int64, len(before) + len(words)))
                    pieces.append((uid, held, len(words), len(before), row))
                    row = None
                    n += len(words)
                    before = (before + words)[len(before) + len(words) - order + 1 :]
                    if n >= block:
                        yield flush()
                parts.append(np.fromiter(map(codes.__getitem__, [*before, END]), np.int64, len(before) + 1))
                pieces.append((uid, held, 1, len(before), row))
                n += 1
                if n >= block:
                    yield flush()
        if pieces:
            yield flush()

    return docs.mapInArrow(run, BLOCKS.format(row=docs.schema["row"].dataType.simpleString()))


class Block:
    """One stored block: for each order, a key at every place and the distinct keys."""

    def __init__(self, row: dict, order: int):
        packed = Packed()
        self.uid, self.held = np.array(row["uid"], np.int64), np.array(row["held"], bool)
        size, lead = np.array(row["size"], np.int64), np.array(row["lead"], np.int64)
        each = size + lead
        starts = np.cumsum(each) - each
        self.piece = np.repeat(np.arange(len(each)), each)
        self.counted = np.arange(int(each.sum())) - np.repeat(starts, each) >= np.repeat(lead, each)
        hashes = packed.unpack(row["hashes"]).astype(np.uint64)
        self.at = [packed.unpack(row["codes"]).astype(np.int64)]  # by order from 1: the distinct key at each place
        self.keys = [hashes]
        if len(hashes):
            order_of = np.argsort(hashes, kind="stable")
            self.keys[0] = hashes[order_of]
            back = np.empty_like(order_of)
            back[order_of] = np.arange(len(order_of))
            self.at[0] = back[self.at[0]]
        whole = self.keys[0][self.at[0]]
        key = whole
        for m in range(2, order + 1):
            # places whose n-gram would reach over the start of a piece are no counted ones
            key = mixed(np.concatenate([key[:1], key[:-1]]), whole)
            distinct, inverse = np.unique(key, return_inverse=True)
            self.keys.append(distinct)
            self.at.append(inverse.reshape(-1))

    def trained(self, m: int) -> np.ndarray:
        """How often each distinct key of order m stands at a counted place in training."""
        go = self.counted & ~self.held[self.piece]
        return np.bincount(self.at[m - 1][go], minlength=len(self.keys[m - 1]))

    def asked(self, m: int, as_context: bool) -> np.ndarray:
        """The distinct keys of order m that stand at counted places, or before them as their context."""
        go = self.counted | np.append(self.counted[1:], False) if as_context else self.counted
        return np.flatnonzero(np.bincount(self.at[m - 1][go], minlength=len(self.keys[m - 1])))


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


# Counts -------------------------------------------------------------------------------------------


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The buckets of ascending keys, ascending."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def counted(stored: DataFrame, m: int, order: int, buckets: int) -> DataFrame:
    """The answers to each block's question for its n-grams of order m: block, m, bucket, counts, owner."""
    ask = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
    answer = pa.schema([("block", pa.int64()), ("m", pa.int32()), ("bucket", pa.int64()), ("counts", pa.binary()), ("owner", pa.binary())])

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = Packed()
        for row in block_rows(batches):
            own = Block(row, m)
            asked = own.asked(m, m < order)
            keys, n = own.keys[m - 1][asked], own.trained(m)[asked]
            place = buckets_of(keys, buckets)
            edges = np.flatnonzero(np.diff(place, prepend=np.uint64(buckets), append=np.uint64(buckets)))
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            yield batch(ask, bucket=[int(place[i]) for i, _ in spans], block=[row["block"]] * len(spans), keys=[keys[i:j].tobytes() for i, j in spans], counts=[packed.pack(n[i:j]) for i, j in spans])

    def answers(table: pa.Table) -> pa.Table:
        packed = Packed()
        keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
        n = np.concatenate([packed.unpack(c).astype(np.int64) for c in table.column("counts").to_pylist()])
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        inverse = inverse.reshape(-1)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, n)
        owner, there = np.zeros(len(n), bool), np.flatnonzero(n)
        owner[there[np.unique(inverse[there], return_index=True)[1]]] = True
        ends = np.cumsum([len(k) for k in keys])
        spans = list(zip((ends - [len(k) for k in keys]).tolist(), ends.tolist()))
        return pa.table(
            {
                "block": table.column("block"), "m": [m] * len(keys), "bucket": table.column("bucket"),
                "counts": [packed.pack(total[inverse[i:j]]) for i, j in spans], "owner": [packed.pack(np.packbits(owner[i:j])) for i, j in spans],
            },
            schema=answer,
        )

    asked = stored.mapInArrow(questions, "bucket long, block long, keys binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answers, "block long, m int, bucket long, counts binary, owner binary")


def histogram(answers: DataFrame) -> DataFrame:
    """For each order m and count r, how many n-grams there are."""
    schema = pa.schema([("m", pa.int32()), ("r", pa.int64()), ("types", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = Packed()
        for b in batches:
            for m, counts, owner in zip(*(c.to_pylist() for c in b.columns)):
                n = packed.unpack(counts)
                r, types = np.unique(n[np.unpackbits(packed.unpack(owner), count=len(n)).astype(bool)], return_counts=True)
                yield batch(schema, m=[m] * len(r), r=r.astype(np.int64), types=types)

    return answers.select("m", "counts", "owner").mapInArrow(run, "m int, r long, types long").groupBy("m", "r").agg(F.sum("types").alias("types"))


class Discount:
    """Simple Good-Turing: Turing's ratios while they differ from the line's by over 1.65 deviations, then the line's."""

    def __init__(self, types: dict[int, int]):
        r = np.array(sorted(types), float)
        n = np.array([types[int(x)] for x in r], float)
        self.slope = -2.0
        if len(r) > 1:
            last = np.concatenate([[0], r[:-1]])
            following = np.concatenate([r[1:], [2 * r[-1] - last[-1]]])
            self.slope = float(np.polyfit(np.log(r), np.log(2 * n / (following - last)), 1)[0])
        self.slope = min(self.slope, -1.05)  # a flatter line would raise counts: too little data for it
        head = []
        while (k := len(head) + 1) in types and k + 1 in types:
            ratio = (k + 1) * types[k + 1] / (k * types[k])
            deviation = (k + 1) / k * np.sqrt(types[k + 1] / types[k] ** 2 * (1 + types[k + 1] / types[k]))
            if not 0 < ratio < 1 or abs(ratio - float(self._line(np.array([k]))[0])) <= 1.65 * deviation:
                break
            head.append(ratio)
        self.head = np.array(head)

    def _line(self, r: np.ndarray) -> np.ndarray:
        return (1 + 1 / np.maximum(r, 1)) ** (self.slope + 1)

    def __call__(self, r: np.ndarray) -> np.ndarray:
        out = self._line(r)
        known = (r > 0) & (r <= len(self.head))
        out[known] = self.head[r[known] - 1]
        return out


# Probabilities ------------------------------------------------------------------------------------

TERMS = "kind string, uid long, n_tokens long, n_known long, base double, score double, m int, context long, seen double, lower double, times long"


def terms(stored: DataFrame, answers: DataFrame, order: int, discounts: list[Discount], total: int, vocabulary: int, documents: int, unknown: float) -> DataFrame:
    """What blocks give once their counts are known, by kind:

    * doc: a piece's tokens, known tokens, base score, and the part of the score that needs no alpha;
    * context: an n-gram context's sums over the n-grams that this block owns;
    * backoff: how often a piece backs off from a context (its alpha is still to be added).
    """
    schema = pa.schema([("kind", pa.string()), ("uid", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("m", pa.int32()), ("context", pa.int64()), ("seen", pa.float64()), ("lower", pa.float64()), ("times", pa.int64())])

    def rows(kind: str, n: int, **columns) -> pa.RecordBatch:
        empty = lambda f: pa.nulls(n, f.type)
        return pa.RecordBatch.from_arrays([pa.array([kind] * n) if f.name == "kind" else pa.array(columns[f.name], f.type) if f.name in columns else empty(f) for f in schema], schema=schema)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        packed = Packed()
        own = Block(left.to_pylist()[0], order)
        count, owned = [], []
        for m in range(1, order + 1):
            part = right.filter(pc.equal(right.column("m"), m)).sort_by("bucket")
            n = [packed.unpack(c).astype(np.int64) for c in part.column("counts").to_pylist()]
            asked = own.asked(m, m < order)
            count.append(np.zeros(len(own.keys[m - 1]), np.int64))
            owned.append(np.zeros(len(own.keys[m - 1]), bool))
            count[-1][asked] = np.concatenate(n) if n else 0
            owned[-1][asked] = np.concatenate([np.unpackbits(packed.unpack(o), count=len(c)).astype(bool) for o, c in zip(part.column("owner").to_pylist(), n)]) if n else False
        start_hash = _hash(START)
        # contexts: a run of starts stands as often as there are documents
        here = [c[a] for c, a in zip(count, own.at)]  # by order: the count of the n-gram that ends at each place
        starts = own.keys[0][own.at[0]] == start_hash
        run_of_starts = starts
        for m in range(1, order):
            if m > 1:
                run_of_starts = np.concatenate([[False], run_of_starts[:-1]]) & starts
            here[m - 1] = np.where(run_of_starts, documents, here[m - 1])
        places = np.flatnonzero(own.counted)
        piece, pieces = own.piece[places], len(own.uid)
        c1 = here[0][places]
        # p: the probability of each token by the orders so far, without the alphas that are still unknown
        p = np.where(c1 > 0, discounts[0](c1) * c1 / total, unknown)
        out, pending = [], []
        for m in range(2, order + 1):
            c, context = here[m - 1][places], here[m - 2][places - 1]
            mass = discounts[m - 1](c) * c
            mine = np.zeros(len(places), bool)
            kept = owned[m - 1][own.at[m - 1][places]]
            first = np.unique(own.at[m - 1][places][kept], return_index=True)[1]
            mine[np.flatnonzero(kept)[first]] = True
            context_at = own.at[m - 2][places - 1]
            size = len(own.keys[m - 2])
            there = np.flatnonzero(np.bincount(context_at[mine], minlength=size))
            out.append(
                rows(
                    "context", len(there), m=np.full(len(there), m), context=own.keys[m - 2][there].view(np.int64),
                    seen=np.bincount(context_at[mine], (mass / np.maximum(context, 1))[mine], size)[there], lower=np.bincount(context_at[mine], p[mine], size)[there],
                )
            )
            back = (c == 0) & (context > 0)
            pending = [(k, f & (c == 0), at) for k, f, at in pending]  # alphas of lower orders count where this order backs off too
            pending.append((m, back, context_at))
            p = np.where(c > 0, mass / np.maximum(context, 1), p)
        for m, back, context_at in pending:
            pairs, times = np.unique(piece[back].astype(np.int64) * len(own.keys[m - 2]) + context_at[back], return_counts=True)
            at, ctx = np.divmod(pairs, max(1, len(own.keys[m - 2])))
            out.append(rows("backoff", len(pairs), uid=own.uid[at], m=np.full(len(pairs), m), context=own.keys[m - 2][ctx].view(np.int64), times=times))
        base = np.log10((c1 + 1) / (total + vocabulary + 1))
        out.append(
            rows(
                "doc", pieces, uid=own.uid, n_tokens=np.bincount(piece, minlength=pieces), n_known=np.bincount(piece[c1 > 0], minlength=pieces),
                base=np.bincount(piece, base, pieces), score=np.bincount(piece, np.log10(p), pieces),
            )
        )
        return pa.Table.from_batches(out)

    return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, TERMS)


def _hash(word: bytes) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest(word))


# The whole ----------------------------------------------------------------------------------------


def katz_scores(docs: DataFrame, held: Column, text_col: str = "text", order: int = 2, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with held_out, n_tokens, n_known, train_tokens, base_score, score: the texts' log10 probability
    under the Katz model of the rows where ``held`` is not true, and under add-one smoothed words.

    A null or empty text is its end alone.  Rows stay as they are: repeated rows are learnt from as often as
    they are there and score alike; where ``held`` is null the row is learnt from; texts of any length are taken
    whole; columns of ``docs`` with the new names are replaced.  Without training rows every token is the
    unknown word, of probability 1; an empty table gives an empty one.
    """
    if order < 2:
        raise ValueError("the order has to be 2 or more")
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "katz")
    new = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c not in new and c != text_col]
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.coalesce(held, F.lit(False)).alias("held"), row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    stored = scratch.save(blocks(rows, order, block))
    names = stored.select(F.inline(F.arrays_zip("uid", "held", "row"))).filter("row IS NOT NULL")
    stored = stored.drop("row")
    size = stored.agg(F.sum("tokens").alias("n")).first().n or 0
    buckets = max(LEAST_BUCKETS, -(-size // bucket))
    documents = names.filter("not held").count()
    answers = [scratch.save(counted(stored, m, order, buckets)) for m in range(1, order + 1)]
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    types = scratch.save(histogram(every))
    low = {m: {} for m in range(1, order + 1)}
    for m, r, n in types.filter(F.col("r") <= FITTED).collect():
        low[m][r] = n
    discounts = [Discount(low[m]) for m in range(1, order + 1)]
    total, vocabulary, known = seen_mass(types.filter("m = 1"), discounts[0])
    unknown = 1 - known / total if total else 1.0
    found = scratch.save(terms(stored, every, order, discounts, total, vocabulary, documents, unknown))
    contexts = found.filter("kind = 'context'").groupBy("m", "context").agg(F.sum("seen").alias("seen"), F.sum("lower").alias("lower"))
    alpha = contexts.select("m", "context", F.log10((1 - F.col("seen")) / (1 - F.col("lower"))).alias("alpha"))
    back = found.filter("kind = 'backoff'").select("uid", "m", "context", "times").join(alpha, ["m", "context"], "left")
    own = found.filter("kind = 'doc'").select("uid", "n_tokens", "n_known", "base", "score")
    both = own.unionByName(back.select("uid", (F.col("times") * F.coalesce("alpha", F.lit(0.0))).alias("score")), allowMissingColumns=True)
    summed = both.groupBy("uid").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    out = names.join(summed, "uid")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)], F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def seen_mass(types: DataFrame, discount: Discount) -> tuple[int, int, float]:
    """All tokens, all words, and the discounted tokens, from how many words there are of each count."""
    ratio = F.pow(1 + 1 / F.col("r"), F.lit(discount.slope + 1))
    for k, x in enumerate(discount.head.tolist(), 1):
        ratio = F.when(F.col("r") == k, F.lit(x)).otherwise(ratio)
    got = types.agg(F.sum(F.col("r") * F.col("types")).alias("n"), F.sum("types").alias("v"), F.sum(F.col("r") * F.col("types") * ratio).alias("known")).first()
    return got.n or 0, got.v or 0, got.known or 0.0


def op12_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every whole text of ``documents``, learnt from six rows in seven."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return katz_scores(read_table(spark, sf_dir, "documents").select("doc_id", "text"), held)
