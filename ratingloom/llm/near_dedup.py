"""Near-duplicate documents by a signature-coordinate inverted join.

1. Each text's word shingles become a set of hashes, and the set a MinHash signature of ``COORDINATES``
   values.  Texts with equal sets are one *class*; classes go on, documents do not.
2. Every class is posted under each coordinate-value pair; the lists' lengths are counted over the whole
   corpus.  A pair of Jaccard similarity 0.8 agrees in fewer than ``MATCHES`` of the coordinates once in
   5 million times.  If two classes agree in ``MATCHES`` places, they meet in one of the
   ``COORDINATES - MATCHES + 1`` rarest values of either (the prefix), so all commoner values are skipped;
   a value that no other class has takes a place of the prefix and posts nothing.
3. Collisions are counted list by list.  A pair is counted in the list of its rarest common value alone.  Pairs
   with ``MATCHES`` collisions are confirmed on full sets; what leaves a task is a forest of links, not the pairs.
4. Short lists (``SHORT`` classes or fewer) are counted at once.  In a longer list every class first meets one of
   the list, its centre; classes that end up in one component need not meet again, which settles lists of copies in
   steps that grow with the list.  Lists that hold several components after ``ROUNDS`` such steps are split
   by the next rarest common value where that makes fewer pairs, made one where they have nearly the same members, so
   that these meet once and not in every list they share, cut into blocks of ``BLOCK`` to ``LARGEST`` classes, and counted
   block against block, again but for pairs within one component.
5. Components come from alternating large-star and small-star steps on tables; nothing of them reaches the
   driver but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, slices, small_batches
from .naming import mixed

COORDINATES = 32
MATCHES = 13
SHINGLE = 5
PERCENT = 80
SHORT = 8  # classes of a list that are counted at once
STAR = 64  # classes that meet a centre in one group
ROUNDS = 2
UNIONS = 3  # orders in which lists of the same members are looked for
BLOCK = 250  # classes of a block in a list of up to 1,000
LARGEST = 1_000  # classes of a block in any list; between the two, a list is cut into four
BLOCK_SHINGLES = 500_000  # shingles of a block or group, but for a longer text
HELD = 8_192  # rows that are counted at a time
COLUMNS = 8_192  # of an incidence matrix at a time
FILE_ROWS = 250_000
STAR_ROWS = 300_000  # edges, of 32 bytes, up to which least neighbours are broadcast
BROADCAST_ROWS = 300_000  # keys of 40 bytes: what may be broadcast after it was counted
UNRANKED = 99

_random = np.random.default_rng(7_919)
STEPS = _random.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
FACTOR = _random.integers(1, 1 << 63, COORDINATES, np.uint64) | np.uint64(1)
SHIFT = _random.integers(1, 1 << 63, COORDINATES, np.uint64)
CODE = _random.integers(1, 1 << 63, 256, np.uint64)
PLACE = _random.integers(1, 1 << 63, 1, np.uint64) | np.uint64(1)
IS_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])


def word_names(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the words data[begin:end]: the sum of what each byte is at its place in the word, by a
    mixer that is not linear, so no two words are built to have one name."""
    size = end - begin
    place = (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(CODE[data[IS_WORD[data]]] + place * PLACE), dtype=np.uint64)])
    stop = np.cumsum(size)
    return mixed(total[stop] - total[stop - size] + size.astype(np.uint64))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted, distinct 64-bit hashes of each text's shingles of ``width`` words; of all its words, if
    they are fewer.  Words are runs without ASCII white space, with A-Z lower-cased."""
    raw = [b"" if t is None else t.encode().lower() for t in texts]
    whole = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    change = np.diff(IS_WORD[whole].astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    word = word_names(whole, begin, end)
    n = max(0, len(word) - width + 1)
    run = np.zeros(n, np.uint64)
    for j in range(width):
        run += word[j : j + n] * STEPS[j]
    run = mixed(run)
    first = np.searchsorted(begin, np.cumsum([0, *(len(r) + 1 for r in raw)])).tolist()
    out = []
    for f, g in zip(first, first[1:]):
        if g - f >= width:
            out.append(np.unique(run[f : g - width + 1]))
        elif g > f:
            few = np.full(1, g - f, np.uint64)
            for j in range(g - f):
                few += word[f + j : f + j + 1] * STEPS[width + j]
            out.append(mixed(few))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, list[bytes | None]]:
    """MinHash signature (a row of ``COORDINATES`` values) and 128-bit name of each set; none if empty."""
    size = np.array([len(s) for s in sets])
    full = np.flatnonzero(size)
    values = np.zeros((len(sets), COORDINATES), np.int64)
    names: list[bytes | None] = [None] * len(sets)
    if len(full):
        every = np.concatenate([sets[i] for i in full])
        at = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        for k in range(COORDINATES):
            values[full, k] = np.minimum.reduceat(every * FACTOR[k] + SHIFT[k], at).view(np.int64)
        name = np.stack([np.add.reduceat(mixed(every + STEPS[s]), at) for s in (62, 63)], 1)
        for i, n in zip(full.tolist(), name):
            names[i] = n.tobytes()
    return values, names


def sign(docs: DataFrame, width: int) -> DataFrame:
    """id, print (hash of the text), n_shingles, node (the set's name), signature and sketch (the low halves of
    the signature's values) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            texts = whole.column(2).to_pylist()
            for part, _ in slices(texts, texts, 500_000):
                sets = shingle_sets(part, width)
                values, names = signatures(sets)
                signature = [v if n is not None else None for v, n in zip(values, names)]
                sketch = pa.array([v.astype("<u4").tobytes() for v in values.view(np.uint64) & np.uint64(0xFFFFFFFF)], pa.binary())
                own = [pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(signature, pa.list_(pa.int64())), sketch]
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(part)) for c in whole.columns[:2]), *own], names=["id", "print", "n_shingles", "node", "signature", "sketch"])
                at += len(part)

    return docs.select("id", "print", "text").mapInArrow(run, "id long, print long, n_shingles long, node binary, signature array<bigint>, sketch binary")


def collisions(group: np.ndarray, at: np.ndarray, side: np.ndarray, label: np.ndarray, size: np.ndarray, sketch: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """Which members of groups (rows in their order) have a partner: another label, the other side where
    the group has two, a size that allows the threshold, and ``MATCHES`` common coordinates.  A group that is
    a list (``at`` > 0) only counts pairs whose rarest common values are those of the list."""
    used = np.zeros(len(group), bool)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    length = np.diff(np.append(first, len(group)))
    two = np.repeat(np.minimum.reduceat(side, first) != np.maximum.reduceat(side, first), length)
    for d in range(1, int(length.max())):
        i = np.flatnonzero(group[d:] == group[:-d])
        j = i + d
        ok = (label[i] != label[j]) & (~two[i] | (side[i] != side[j])) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
        i, j = i[ok], j[ok]
        common = sketch[i] == sketch[j]
        ok = common.sum(axis=1) >= MATCHES
        i, j, common = i[ok], j[ok], common[ok]
        if len(i) and at[i].any():
            rarest = np.argsort(np.where(common, rank[i], UNRANKED), axis=1, kind="stable")[:, :2] + 1
            ok = (at[i] == 0) | (at[i] == rarest[:, 0]) | (at[i] == rarest[:, 0] + (COORDINATES + 1) * rarest[:, 1])
            i, j = i[ok], j[ok]
        used[i] = used[j] = True
    return used


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections."""
    every, count = np.unique(np.concatenate(sets), return_counts=True)
    shared = every[count > 1]
    out = np.zeros((len(sets), len(sets)), np.float64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value = np.concatenate(sets)
    at = np.searchsorted(shared, value)
    hit = (at < len(shared)) & (shared[np.minimum(at, max(0, len(shared) - 1))] == value) if len(shared) else np.zeros(len(value), bool)
    row, at = row[hit], at[hit]
    for start in range(0, len(shared), COLUMNS):
        part = (at >= start) & (at < start + COLUMNS)
        matrix = np.zeros((len(sets), min(COLUMNS, len(shared) - start)), np.float32)
        matrix[row[part], at[part] - start] = 1
        out += matrix @ matrix.T
    return out


def forest(pairs: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Of linked pairs, those that join labels not joined before."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            x = above[x]
        return x

    out = []
    for i, j in pairs.tolist():
        a, b = top(label[i]), top(label[j])
        if a != b:
            above[a] = b
            out.append((i, j))
    return out


def links_of(texts: list[str], node: list[bytes], label: np.ndarray, side: np.ndarray, width: int, percent: int) -> list[tuple[bytes, bytes]]:
    """A forest of confirmed links between members of one group, across its sides if it has two."""
    if label.min() == label.max():
        return []
    sets: list[np.ndarray] = []
    for part, _ in slices(texts, texts, 500_000):
        sets += shingle_sets(part, width)
    n = np.array([len(x) for x in sets])
    i, j = np.triu_indices(len(sets), 1) if side.min() == side.max() else (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1)))
    ok = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
    i, j = i[ok], j[ok]
    if len(i) < 4 * len(sets):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())], np.int64)
    else:
        both = intersections(sets)[i, j]
    ok = 100 * both >= percent * (n[i] + n[j] - both)
    return [(node[a], node[b]) for a, b in forest(np.column_stack([i[ok], j[ok]]), label)]


def whole_groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of at least ``least`` rows (but the last) that hold whole groups, with the number of each row's
    group; batches are sorted by the group's two columns, the first ones."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def numbered(table: pa.Table) -> np.ndarray:
        g, part = (table.column(k).to_numpy() for k in (0, 1))
        return np.cumsum(np.append(0, (g[1:] != g[:-1]) | (part[1:] != part[:-1])))

    for whole in batches:
        if whole.num_rows:
            held.append(whole)
            rows += whole.num_rows
        if rows >= least:
            table = pa.Table.from_batches(held)
            number = numbered(table)
            cut = int(np.searchsorted(number, number[-1]))
            if cut:
                yield table.slice(0, cut), number[:cut]
            held, rows = table.slice(cut).to_batches(), rows - cut
            least = max(least, 2 * rows)  # a group longer than that is not looked through again for every batch
    if held:
        table = pa.Table.from_batches(held)
        yield table, numbered(table)


def codes(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that are equal where the column's values are."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


MEETING = "g long, part int, at int, side int, node binary"


def counted(meetings: DataFrame, classes: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """The rows of ``meetings`` (``MEETING``) that have a partner by their signatures."""
    wide = meetings.join(classes.select("node", "n", "sketch", F.col("own.c").cast("array<tinyint>").alias("coordinates")), "node")
    wide = labelled(wide, labels)
    dealt = wide.repartition("g", "part").sortWithinPartitions("g", "part").select("g", "part", "at", "side", "node", "label", "n", "sketch", "coordinates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, HELD):
            at, side, size = (table.column(c).to_numpy() for c in ("at", "side", "n"))
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u4").reshape(-1, COORDINATES)
            lists = table.column("coordinates").combine_chunks()
            length = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(length)), length)
            rank = np.full((len(length), COORDINATES), UNRANKED, np.int8)
            rank[row, lists.flatten().to_numpy()] = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
            used = collisions(group, at, side, codes(table.column("label")), size, sketch, rank, percent)
            yield from table.select(["g", "part", "at", "side", "node"]).filter(pa.array(used)).combine_chunks().to_batches()

    return dealt.mapInArrow(run, MEETING)


def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the label of each node; its own name if it has none."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def confirmed(meetings: DataFrame, texts: DataFrame, labels: DataFrame | None, width: int, percent: int) -> DataFrame:
    """Links within each group of ``meetings``, by the full sets of the members' ``texts``."""
    wide = labelled(meetings.join(texts, "node"), labels)
    dealt = wide.repartition("g", "part").sortWithinPartitions("g", "part").select("g", "part", "side", "node", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, 1):
            side, label = table.column("side").to_numpy(), codes(table.column("label"))
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            out = []
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                own = table.slice(a, b - a)
                out += links_of(own.column("text").to_pylist(), own.column("node").to_pylist(), label[a:b], side[a:b], width, percent)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node and label (its component's smallest node) of every node of ``edges`` (a, b) but those that are
    their own label.

    Large-star and small-star steps run until every node has one parent, then parents are followed, twice as
    far each time, to the roots.  Tables are kept in few files, by their counted rows, and the table of
    least neighbours is broadcast while it is counted as small.
    """
    now = scratch.save(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def measured() -> tuple[int, bool]:
        n, nodes = now.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        return n, n == nodes

    def step(new: DataFrame) -> DataFrame:
        saved = scratch.save(new.coalesce(max(1, -(-n // FILE_ROWS))))
        scratch.drop(now)
        return saved

    n, one_parent = measured()
    small = lambda df: F.broadcast(df) if n <= STAR_ROWS else df
    while not one_parent:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(small(least), "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(small(least), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = step(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        n, one_parent = measured()
    while n:
        above = now.select(F.col("u").alias("v"), F.col("v").alias("w"))
        now = step(now.join(small(above), "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")))
        if not now.agg(F.max("moved")).first()[0]:
            break
        now = now.drop("moved")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def ordered(classes: DataFrame) -> DataFrame:
    """node, n, sketch and own: the coordinate-value pairs that other classes have as well, rarest first; of
    the classes that have ``MATCHES`` of them."""
    posted = classes.select("node", F.posexplode("signature").alias("c", "value"))
    shared = posted.groupBy("c", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = posted.join(shared, ["c", "value"]).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "value", "c"))).alias("own"))
    return own.filter(F.size("own") >= MATCHES).join(classes.select("node", "n", "sketch"), "node")


def prefix(depth: int, after: Column) -> Column:
    """The places of ``own`` beyond ``after`` in which the ``depth``-th common pair of two classes stands."""
    room = F.size("own") - MATCHES + depth
    return F.posexplode(F.slice("own", after + 1, F.greatest(room - after, F.lit(0))))


def key(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def groups_of(size: str = "m", shingles: str = "shingles", most: int | None = None) -> Column:
    """How many groups members are dealt to, by their number and their shingles.  Without ``most`` these are blocks: a
    member is sent to each of them, so blocks grow with the list."""
    held = F.least(F.lit(LARGEST), F.greatest(F.lit(BLOCK), F.ceil(F.col(size) / 4))) if most is None else F.lit(most)
    return F.greatest(F.ceil(F.col(size) / held), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1)).cast("int")


def stars(posts: DataFrame, labels: DataFrame | None, number: int, scratch: Scratch) -> DataFrame:
    """Each class of a list meets the list's centre, if that has another label.  Lists choose their centres by
    one of three orders of the classes, so that lists of one family choose few."""
    known = labelled(posts, labels)
    order = F.xxhash64("node", F.pmod("g", F.lit(3)), F.lit(number))
    # tables that hot lists join with are saved first: Spark can then broadcast them or split what a list brings
    centre = scratch.save(known.groupBy("g").agg(F.min(F.struct(order.alias("order"), "node", "label")).alias("centre")))
    pairs = known.join(centre, "g").filter(F.col("label") != F.col("centre.label")).select("node", "n", F.col("centre.node").alias("centre")).distinct()
    pairs = scratch.save(pairs)
    count = scratch.save(pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles")).select("centre", groups_of(most=STAR).alias("groups")))
    members = pairs.join(count, "centre").select("node", "centre", F.xxhash64("centre").alias("g"), F.pmod(F.xxhash64("node"), F.col("groups")).cast("int").alias("part"))
    zero = F.lit(0).alias("at")
    centres = members.select("g", "part", zero, F.lit(1).alias("side"), F.col("centre").alias("node")).distinct()
    return members.select("g", "part", zero, F.lit(0).alias("side"), "node").unionByName(centres)


def blocked(lists: DataFrame, scratch: Scratch) -> DataFrame:
    """The members of lists (g, at, node, n) against each other, in pairs of blocks where a list is long."""
    count = lists.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles")).filter("m > 1").select("g", groups_of().alias("blocks"))
    count = scratch.save(count)
    own = lists.join(count, "g").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    return met.select("g", (lo * F.col("blocks") + hi).cast("int").alias("part"), "at", (F.col("block") == hi).cast("int").alias("side"), "node")


def families(lists: DataFrame, scratch: Scratch) -> DataFrame:
    """``lists`` (g, at, node, n, pairs: what the list costs) with lists of nearly the same members made one, where all pairs
    of the union are no more than the lists' own together.  Lists that have the same first member in an
    order of the classes are tried, in ``UNIONS`` orders; pairs of a union count whatever their rarest common values."""
    for number in range(UNIONS):
        first = scratch.save(lists.groupBy("g").agg(F.min(F.xxhash64("node", F.lit(number))).alias("first"), F.first("pairs").alias("pairs")))
        cost = first.groupBy("first").agg(F.sum("pairs").alias("pairs"), F.count(F.lit(1)).alias("several")).filter("several > 1")
        size = lists.join(first.join(cost.select("first"), "first", "left_semi").select("g", "first"), "g").select("first", "node").distinct().groupBy("first").agg(F.count(F.lit(1)).cast("double").alias("m"))
        chosen = size.join(cost, "first").filter("m * m <= pairs").select("first", (F.col("m") * F.col("m")).alias("all"))
        chosen = scratch.save(first.select("g", "first").join(chosen, "first"))
        if chosen.isEmpty():
            continue
        united = lists.join(chosen, "g").select(F.xxhash64("first", F.lit(number)).alias("g"), F.lit(0).alias("at"), "node", "n", F.col("all").alias("pairs")).distinct()
        lists = scratch.save(lists.join(chosen, "g", "left_anti").unionByName(united))
    return lists


def residue(posts: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """All members of lists against each other.  A list of over ``BLOCK`` members is split by the next common
    pair, where that halves the pairs at least, or made one with lists of the same members."""
    count = scratch.save(posts.groupBy("g").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > BLOCK))
    long = scratch.save(posts.join(count, "g"))
    if long.isEmpty():
        return blocked(posts, scratch)
    place = F.col("place") + 1
    split = long.join(classes.select("node", "own"), "node").select("g", "at", "m", "node", "n", prefix(2, place).alias("pos", "p"))
    split = scratch.save(split.select("g", "m", (F.col("at") + (COORDINATES + 1) * (F.col("p.c") + 1)).cast("int").alias("at"), key(F.col("g"), F.col("p.c"), F.col("p.value")).alias("sub"), "node", "n"))
    pairs = split.groupBy("g", "m", "sub").agg(F.count(F.lit(1)).cast("double").alias("s")).groupBy("g", "m").agg(F.sum(F.col("s") * F.col("s")).alias("pairs"))
    better = scratch.save(pairs.filter(2 * F.col("pairs") < F.col("m").cast("double") * F.col("m")).select("g", "pairs"))
    own = F.coalesce("pairs", F.col("m").cast("double") * F.col("m"))
    lists = families(scratch.save(long.join(better, "g", "left").select("g", "at", "node", "n", own.alias("pairs"))), scratch).drop("pairs")
    better = scratch.save(better.join(lists, "g", "left_semi").select("g"))
    rest = posts.select("g", "at", "node", "n").join(count, "g", "left_anti").unionByName(lists.join(better, "g", "left_anti"))
    return blocked(rest.unionByName(split.join(better, "g", "left_semi").select(F.col("sub").alias("g"), "at", "node", "n")), scratch)


def linked(posts: DataFrame, classes: DataFrame, texts_of, scratch: Scratch, width: int, percent: int) -> DataFrame | None:
    """node and label of every class that is linked with another."""
    labels = None

    def meet(meetings: DataFrame) -> DataFrame | None:
        near = scratch.save(counted(meetings, classes, labels, percent))
        links = scratch.save(confirmed(near, texts_of(near), labels, width, percent))
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        return components(links, scratch)

    count = scratch.save(posts.groupBy("g").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    short = posts.join(count.filter(F.col("m") <= SHORT), "g").drop("m")
    long = scratch.save(posts.join(count.filter(F.col("m") > SHORT), "g").drop("m"))
    for number in range(ROUNDS):
        meetings = stars(long, labels, number, scratch)
        labels = meet(meetings.unionByName(blocked(short, scratch)) if number == 0 else meetings)
        several = labelled(long, labels).groupBy("g").agg(F.min("label").alias("one"), F.max("label").alias("another")).filter("one <> another").select("g")
        long = scratch.save(long.join(scratch.save(several), "g", "left_semi"))
        if long.isEmpty():
            return labels
    return meet(residue(long, classes, scratch))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """id, print (hash of the text), n_shingles and component_id (the smallest id reachable by links) of each
    row of ``docs``.

    Texts without words, and null texts, have an empty set and are linked with nothing: their component is
    their own id.  Rows that repeat an id with another text are documents of their own, and rows that repeat
    both come out alike; a null id is never the smallest, and a component of null ids alone has a null id.
    Ties cannot arise, as a component's name is its smallest id.  An empty table gives an empty one; other
    columns are left out, whatever their names; texts of any length are taken whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "near-dedup")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    signed = scratch.save(sign(rows, width))
    classes = signed.filter("node is not null").groupBy("node").agg(F.min(F.struct("id", "print")).alias("rep"), F.min("id").alias("least"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"))
    classes = scratch.save(classes)
    posting = scratch.save(ordered(classes))
    posts = scratch.save(posting.select("node", "n", prefix(1, F.lit(0)).alias("place", "p")).select(key(F.col("p.c"), F.col("p.value")).alias("g"), (F.col("p.c") + 1).cast("int").alias("at"), "place", "node", "n"))

    def texts_of(near: DataFrame) -> DataFrame:
        """The text of each node of ``near``, once."""
        keys = classes.select("node", F.col("rep.id").alias("id"), F.col("rep.print").alias("print")).join(near.select("node").distinct(), "node", "left_semi")
        keys = scratch.save(keys)
        if keys.count() <= BROADCAST_ROWS:
            keys = F.broadcast(keys)
        same = rows.alias("r").join(keys.alias("w"), F.col("r.id").eqNullSafe(F.col("w.id")) & (F.col("r.print") == F.col("w.print")))
        return same.groupBy("node").agg(F.first("text").alias("text"))

    labels = linked(posts, posting, texts_of, scratch, width, percent)
    named = classes.select("node", "least").join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = scratch.save(named.join(smallest, "label").select("node", "component_id"))
    placed = signed.select("id", "print", "n_shingles", "node")
    scratch.clear(signed, of_node)
    return placed.join(of_node, "node", "left").select("id", "print", "n_shingles", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; all columns stay as they are, whatever
    their names.  Nulls, repeats and empty tables are as for ``near_components``: rows that repeat a kept id and
    text stay."""
    found = near_components(docs, id_col, text_col, **options)
    gone = found.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "print").distinct()
    gone = Scratch(docs.sparkSession, "near-dedup").save(gone)
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = F.col(f"rows.`{id_col}`").eqNullSafe(F.col("gone.id")) & (F.xxhash64(F.col(f"rows.`{text_col}`")) == F.col("gone.print"))
    return docs.alias("rows").join(gone.alias("gone"), same, "left_anti")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` under four-word shingles and a similarity of 0.8."""
    found = near_components(read_table(spark, sf_dir, "documents"), width=4)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
