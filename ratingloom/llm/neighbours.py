"""Approximate nearest neighbours from a forest of random-projection trees.

* Equal vectors are one *point*: it keeps as many of its smallest ids as an answer can need.
* ``trees`` trees are grown on a bounded sample of points (the first by a hash).  A node halves its points
  at the median of their projections on the difference of two of them; nodes of ``leaf`` points or fewer are
  leaves.  A tree holds its planes alone, so the forest's size is bounded by the sample.
* Every point is dropped down every tree, and the rows (tree, leaf, point) are the index.
* A query walks all trees from one priority queue: the node whose worst margin on its path is best comes
  first, whichever tree it is of, until the leaves found hold ``search`` sample points.  As leaves grow with
  the data, ``search`` is a share of it: ``share`` of the sample.  It is fitted: ``PROBES`` points of the sample walk the
  trees, and ``share`` is what finds ``RECALL`` of their nearest within the sample.  All rows together hold nearer
  ones, which are found no later.  Near-isotropic vectors have no cells that hold their neighbours, so most rows are
  visited there whatever the forest (figures in the README); vectors with structure take a smaller share.
* Queries meet the points of their leaves by an equality join on (tree, leaf); leaf tables are salted into
  blocks of at most ``BLOCK`` points.  Each block is reranked exactly, in double precision, against the
  block's queries at once, and only its best few go on.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table

TREES = 4
LEAF = 48
SAMPLE = 8_192
PROBES = 256  # points of the sample that the share is fitted on
RECALL = 0.96  # of their nearest points within the sample that it has to find
BLOCK = 2_000
DEALT = 256  # queries of a task, and the most tasks they are dealt to
PARTS = 20_000


class Forest:
    """Trees over unit vectors: planes and thresholds by node; children below 0 are leaves."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.size = len(sample)
        self.trees = [self._grow(sample, leaf, rng) for _ in range(trees if len(sample) else 0)]

    @staticmethod
    def _grow(points: np.ndarray, leaf: int, rng):
        planes, cuts, children, sizes = [], [], [], []

        def grow(own: np.ndarray) -> int:
            if len(own) > leaf:
                for _ in range(5):
                    a, b = points[rng.choice(own, 2, replace=False)]
                    plane = a - b
                    norm = np.linalg.norm(plane)
                    if norm == 0:
                        continue
                    side = points[own] @ (plane / norm)
                    cut = float(np.median(side))
                    right = side > cut
                    if right.any() and not right.all():
                        node = len(planes)
                        planes.append(plane / norm)
                        cuts.append(cut)
                        children.append([0, 0])
                        children[node] = [grow(own[~right]), grow(own[right])]
                        return node
            sizes.append(len(own))
            return -len(sizes)

        root = grow(np.arange(len(points)))
        width = points.shape[1]
        return root, np.array(planes).reshape(-1, width), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), np.array(sizes)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, from 0."""
        out = np.empty((len(vectors), len(self.trees)), np.int32)
        for t, (root, planes, cuts, children, _) in enumerate(self.trees):
            node = np.full(len(vectors), root)
            while (live := np.flatnonzero(node >= 0)).size:
                at = node[live]
                right = np.einsum("nd,nd->n", vectors[live], planes[at]) > cuts[at]
                node[live] = children[at, right.astype(int)]
            out[:, t] = -node - 1
        return out

    def walk(self, vector: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(tree, leaf, sample points of the leaves before) in the order of one queue for all trees."""
        margins = [planes @ vector - cuts for _, planes, cuts, _, _ in self.trees]
        queue = [(-np.inf, t, tree[0]) for t, tree in enumerate(self.trees)]
        held = 0
        while queue:
            worst, t, node = heapq.heappop(queue)
            if node < 0:
                yield t, -node - 1, held
                held += int(self.trees[t][4][-node - 1])
                continue
            m = float(margins[t][node])
            left, right = self.trees[t][3][node]
            heapq.heappush(queue, (max(worst, m), t, int(left)))
            heapq.heappush(queue, (max(worst, -m), t, int(right)))

    def search(self, vector: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """The leaves of a walk until their sample points reach ``budget``."""
        return [(t, leaf) for t, leaf, _ in itertools.takewhile(lambda x: x[2] < budget, self.walk(vector))]


def fitted_share(forest: Forest, sample: np.ndarray, k: int, recall: float = RECALL) -> float:
    """The least share of the sample at which probes find ``recall`` of their ``k`` nearest in it; all of it for a
    sample of few points."""
    if len(sample) <= k + 1:
        return float(len(forest.trees))
    where = forest.leaves(sample)
    needed: list[int] = []
    for p in np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int):
        near = sample @ sample[p]
        near[p] = -np.inf
        left = set(np.argpartition(-near, k)[:k].tolist())
        for t, leaf, before in forest.walk(sample[p]):
            met = [i for i in left if where[i, t] == leaf]
            needed += [before] * len(met)
            left.difference_update(met)
            if not left:
                break
    return (float(np.quantile(needed, recall, method="higher")) + 1) / len(sample)


def usable(vector: Column) -> Column:
    """Vectors that are neither null, empty nor zero, and hold neither null nor non-finite components."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, number) & F.exists(vector, lambda x: x != 0)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("nd,nd->n", rows, rows))[:, None]


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def best_of_block(asked: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest rows of a block for each query.  A product of unit vectors picks the points that
    can be among them; their cosines are then computed on the original vectors, each in the same order
    of summation wherever it is computed."""
    a, b = matrix(asked.v), matrix(points.v)
    size_a, size_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    rough = (a / size_a[:, None]) @ (b / size_b[:, None]).T
    m = min(k + 1, len(b))  # one more, as a query's own row may be among them
    least = np.partition(rough, len(b) - m, axis=1)[:, len(b) - m] - 1e-9
    ids = [np.asarray(i) for i in points.ids]
    out = []
    for row, (q, size) in enumerate(zip(asked.id.tolist(), size_a)):
        own = [(-float((a[row] * b[p]).sum() / (size * size_b[p])), i) for p in np.flatnonzero(rough[row] >= least[row]).tolist() for i in ids[p].tolist() if i != q]
        out += [(q, i, -s) for s, i in sorted(own)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, share: float | None = None) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for each row of ``queries``: query_id, rank, vec_id, score.

    Unusable vectors (see ``usable``), rows without id and vectors of another length than the query take no
    part.  A row with the query's id is its own row, not a candidate.  Of rows that repeat an id, a query is
    the one with the smallest vector, and a candidate counts with its best.  Ties go to the smaller id.  Ids may be of
    any type with an order, the same on both sides.
    Without queries or candidates the result is empty.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    pick = lambda df: df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    # Spark limits each task's rows of a vector before the shuffle, so one that a third of all rows share
    # stays small
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = pick(vectors).distinct().withColumn("nr", first).filter(F.col("nr") <= k + 1)
    points = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points = scratch.save(points.withColumn("point", F.xxhash64("v")).withColumn("width", F.size("v")))
    asked = scratch.save(pick(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v")))
    found = None
    for width, n in sorted(points.groupBy("width").count().collect()):
        own, ask = points.filter(F.col("width") == width), asked.filter(F.col("width") == width)
        rows = own.orderBy("point", "ids").limit(sample).select("v").toArrow().column(0).to_pylist()
        grown = unit(matrix(rows))
        forest = Forest(grown, trees, leaf)
        part = _search(forest, own, n, ask, k, fitted_share(forest, grown, k) if share is None else share)
        found = part if found is None else found.unionByName(part)
    if found is None:
        of = lambda df: df.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {of(queries)}, rank int, vec_id {of(vectors)}, score double")
    return found.select("query_id", "rank", "vec_id", "score")


def _search(forest: Forest, points: DataFrame, n_points: int, asked: DataFrame, k: int, share: float) -> DataFrame:
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast(forest)
    n_leaves = sum(len(t[4]) for t in forest.trees)
    salts = max(1, -(-n_points * len(forest.trees) // (n_leaves * BLOCK)))
    n_asked = asked.count()
    parts = max(1, -(-int(n_asked * min(1.0, share / len(forest.trees)) * len(forest.trees)) // (len(forest.trees) * BLOCK)))
    vector, ids, asked_id = points.schema["v"].dataType.simpleString(), points.schema["ids"].dataType.simpleString(), asked.schema["id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                part = whole.slice(at, 2_000)
                where = shared.value.leaves(unit(matrix(part.column(0).to_pylist())))
                n, t = where.shape
                row = pa.array(np.repeat(np.arange(n), t))
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(t, dtype=np.int32), n)), pa.array(where.ravel()), *(c.take(row) for c in part.columns)], names=["tree", "leaf", "v", "ids", "point"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in range(whole.num_rows):
                one = whole.slice(row, 1)
                got = shared.value.search(unit(matrix(one.column(1).to_pylist()))[0], share * shared.value.size)
                again = pa.array(np.zeros(len(got), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in got], pa.int32()), pa.array([x for _, x in got], pa.int32()), *(c.take(again) for c in one.columns)], names=["tree", "leaf", "id", "v"])

    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    leaves = points.select("v", "ids", "point").mapInArrow(index, f"tree int, leaf int, v {vector}, ids {ids}, point long")
    leaves = leaves.withColumn("salt", F.pmod("point", F.lit(salts)).cast("int")).withColumn("part", spread(parts))
    # walking the trees takes time, not bytes, so queries are dealt by their number
    dealt = asked.select("id", "v").repartition(min(PARTS, max(1, -(-n_asked // DEALT))), "id")
    probes = dealt.mapInArrow(probe, f"tree int, leaf int, id {asked_id}, v {vector}")
    probes = probes.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("salt", spread(salts))
    key = ["tree", "leaf", "salt", "part"]

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": left["id"][:0], "vec_id": pd.Series([], dtype=left["id"].dtype), "score": pd.Series([], dtype=float)})
        return best_of_block(left, right, k)

    pairs = probes.groupBy(*key).cogroup(leaves.groupBy(*key)).applyInPandas(rerank, f"query_id {asked_id}, vec_id {ids[6:-1]}, score double")
    single = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return single.withColumn("rank", rank).filter(F.col("rank") <= k)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of each vector of ``embeddings`` whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
