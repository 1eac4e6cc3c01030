"""Key tables against the array forms, and against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import linked, matching

SCHEMA = "id long, kind string, key array<string>, nested array<array<string>>, x array<int>, set string, name string, legendgroup string, colour string, opacity double"


def traces(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "d", None])
    rows = []
    for i in range(n):
        key = None if rng.random() < 0.1 else [word() for _ in range(rng.randint(0, 4))]
        nested = None if key is None else [rng.choice([[word() for _ in range(rng.randint(0, 2))], None]) if rng.random() < 0.9 else [] for _ in key]
        rows.append((i, rng.choice(["flat", "simple", "nested", None]), key, nested, None if key is None else list(range(len(key))), rng.choice(["s", "t", None]), rng.choice(["", "n", None]), rng.choice(["g", None]), "blue", rng.choice([0.0, None])))
    return rows


def expected(kind, key, nested, needles):
    inside = lambda k: k is None or k in needles
    if key is None:
        return [], False
    if kind == "nested":
        return [i for i, inner in enumerate(nested) if all(map(inside, inner or []))], False
    if kind == "simple":
        hit = all(map(inside, key))
        return (list(range(len(key))) if hit else []), hit
    return [i for i, k in enumerate(key) if inside(k)], False


@pytest.mark.parametrize("few", [0, 9])
@pytest.mark.parametrize("needles", [[], ["a"], ["a", "b", "b", None], ["a", "b", "c", "d"]])
def test_match_by_table(spark, monkeypatch, needles, few):
    """As a hash set in the rows, and as a join."""
    monkeypatch.setattr(matching, "FEW", few)
    rows = traces(len(needles), 120)
    keys = spark.createDataFrame([(n,) for n in needles], "k string")
    got = matching.match_index(spark.createDataFrame(rows, SCHEMA), keys, "id", "key", "kind", "nested").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["index"], r.whole) == expected(r.kind, r.key, r.nested, set(needles) - {None}), r


@pytest.mark.parametrize("few", [0, 9])
@pytest.mark.parametrize("needles", [["a"], ["a", "b", "c"]])
def test_filter_and_copies(spark, monkeypatch, needles, few):
    monkeypatch.setattr(matching, "FEW", few)
    rows = traces(9, 150)
    frame, keys = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(n,) for n in needles], "k string")
    want = {}
    for r in rows:
        hits, whole = expected(r[1], r[2], r[3], set(needles))
        if r[5] == "s" and r[2] is not None and (hits or whole):
            want[r[0]] = r[4] if whole else [r[4][i] for i in hits]
    got = matching.filter_by_keys(frame, keys, "id", "s", "key", "kind", "nested")
    assert got.columns == frame.columns and {r.id: r.x for r in got.collect()} == want
    copies = matching.selected_copies(frame, keys, "id", "s", "red", matching.joined_keys(keys), "key", "kind", "nested").collect()
    label = "<br />".join(sorted(needles))
    by_id = {r[0]: r for r in rows}
    assert {r._original: r.x for r in copies} == want
    assert all(r.name == (by_id[r.id][6] or label) and r.legendgroup == (by_id[r.id][7] or label) and r.colour == "red" and r.opacity == (1.0 if by_id[r.id][9] is None else 0.0) for r in copies)
    assert matching.filter_by_keys(frame, None, "id", "s").count() == len(rows)
    assert matching.match_index(frame.limit(0), keys, "id", "key").count() == 0


def test_many_keys_need_no_array(spark):
    frame = spark.range(200).select("id", F.array(F.col("id"), F.col("id") * 10_000, F.lit(-1).cast("long")).alias("key"))
    got = matching.match_index(frame, spark.range(1_000_000), "id", "key").collect()
    assert all(r["index"] == ([0, 1] if r.id < 100 else [0]) for r in got)


def test_points_to_keys(spark):
    t = spark.createDataFrame([(1, "flat", ["a", "b"], None, "s"), (2, "simple", ["a", "c", None], None, "s"), (3, "nested", ["x"], [["a", "d"], ["e"]], "t"), (4, "flat", ["z"], None, ""), (5, "flat", None, None, "s")], "t int, kind string, key array<string>, nested array<array<string>>, set string")
    points = [(1, 0, None), (1, 0, None), (1, None, [0, 1]), (1, 9, None), (2, None, None), (3, 0, None), (3, None, [0, 1]), (4, 0, None), (5, 0, None), (6, 0, None), (1, None, None)]
    got = matching.selected_keys(spark.createDataFrame(points, "t int, number int, numbers array<int>"), t, "t", "key", "number", "numbers", "kind", "nested")
    assert {(r.set, r.key): r.n for r in got.collect()} == {("s", "a"): 4, ("s", "b"): 1, ("s", None): 2, ("s", "c"): 1, ("t", "a"): 2, ("t", "d"): 2, ("t", "e"): 1}


def test_diff_refuses_repeats(spark):
    once, twice = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    assert {(r.k, r.change) for r in linked.key_diff(once, twice, "k").collect()} == {(1, "removed")}
    assert linked.key_diff(once, once, "k", unique=True).count() == 0
    with pytest.raises(ValueError, match="repeated"):
        linked.key_diff(once, twice, "k", unique=True)
