import numpy as np
import pytest

from ratingloom.llm import neighbours as N


def exact(rows, k=5):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    u = v / np.linalg.norm(v, axis=1)[:, None]
    return {int(ids[q]): sorted((-float(s), int(i)) for i, s in zip(ids, u @ u[q]) if i != ids[q])[:k] for q in np.flatnonzero(ids % 50 == 0)}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_recall_and_scores(spark, small, size):
    small = small.replace("sf0.001", size)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = exact(rows)
    got = {}
    for r in N.op10_neighbours(spark, small).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hit = sum(len({i for i, _ in got[q].values()} & {i for _, i in w}) for q, w in want.items())
    assert hit >= 0.9 * 5 * len(want)
    vector = dict(rows)
    for q, own in got.items():
        for i, s in own.values():
            a, b = np.array(vector[q], float), np.array(vector[i], float)
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_ties_copies_and_odd_vectors(spark):
    same, other = [1.0, 2.0], [2.0, -1.0]
    rows = [(i, same) for i in range(0, 300)] + [(1000, other), (1001, None), (1002, [0.0, 0.0]), (1003, [float("nan"), 1.0]), (1004, [1.0, None]), (1005, [1.0]), (None, same), (50, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in N.nearest(df, df.filter("vec_id in (0, 50, 1000, 1001, 1003, 1005)")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 1000: [0, 1, 2, 3, 4]}
    assert N.nearest(df.limit(0), df).count() == 0 and N.nearest(df, df.limit(0)).count() == 0
    few = df.filter("vec_id < 3").withColumnRenamed("embedding", "v")
    assert N.nearest(few, few, vector_col="v").count() == 6


@pytest.mark.parametrize("n", [2_000, 40_000])
def test_clustered_vectors_visit_few_rows(n):
    """The share fitted on the sample, on clusters of 100 vectors: recall over all rows, and rows visited."""
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(n // 100, 32))
    rows = np.repeat(centres, 100, axis=0) + 0.3 * rng.normal(size=(n, 32))
    rows = N.unit(rows[rng.permutation(n)])
    sample = rows[: N.SAMPLE]
    forest = N.Forest(sample, N.TREES, N.LEAF)
    share = N.fitted_share(forest, sample, 5)
    where = forest.leaves(rows)
    hit = visited = 0
    asked = range(0, n, n // 40)
    for q in asked:
        cosine = rows @ rows[q]
        cosine[q] = -np.inf
        near = np.argpartition(-cosine, 5)[:5]
        seen = np.zeros(n, bool)
        for t, leaf in forest.search(rows[q], share * forest.size):
            seen |= where[:, t] == leaf
        hit += int(seen[near].sum())
        visited += int(seen.sum())
    assert hit >= 0.9 * 5 * len(asked) and visited < 0.3 * n * len(asked)


def test_text_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(f"a-{i}", rng.normal(size=8).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "name string, embedding array<double>")
    got = N.nearest(df, df.filter("name IN ('a-1', 'a-2')"), id_col="name").collect()
    v = {n: np.array(x) / np.linalg.norm(x) for n, x in rows}
    for q in ("a-1", "a-2"):
        want = sorted((-(v[q] @ v[n]), n) for n in v if n != q)[:5]
        assert len({r.vec_id for r in got if r.query_id == q} & {n for _, n in want}) >= 4
    assert N.nearest(df.limit(0), df.limit(0), id_col="name").count() == 0
