import itertools

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import linked, reshape


def values(df, c="key"):
    return sorted(r[c] for r in df.collect())


def test_handles(spark):
    keys = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", "z")], "handle_id string, key string")
    table = lambda *ids: spark.createDataFrame([(i,) for i in ids], "handle_id string")
    for order in itertools.permutations("ab"):
        assert values(linked.intersect_handles(table(*order), keys)) == ["y"]
    assert values(linked.intersect_handles(table("a", "b", "empty"), keys)) == []
    assert linked.intersect_handles(table(), keys) is None
    assert values(linked.intersect_handles(linked.clear_handle(table("a", "b"), "b"), keys)) == ["x", "y"]
    assert values(linked.clear_handle(table("a"), "unknown"), "handle_id") == ["a"]
    assert linked.apply_keys(keys, None).count() == 4


def test_matches(spark):
    row = spark.createDataFrame([(["a", None, "c"], [["a"], ["a", "q"], []], ["a", None])], "flat array<string>, nested array<array<string>>, needles array<string>")
    got = row.select(linked.flat_matches(F.col("flat"), F.col("needles")), linked.simple_match(F.col("flat"), F.col("needles")), linked.nested_matches(F.col("nested"), F.col("needles")), linked.simple_match(F.array().cast("array<string>"), F.col("needles"))).first()
    assert tuple(got) == ([0, 1], False, [0, 2], True)


def test_groups(spark):
    groups = spark.createDataFrame([({"g": ["b", "a"], "h": ["a"]},)], "m map<string,array<string>>")
    flat = linked.explode_groups(groups, "m")
    assert [r.key for r in linked.group_keys(flat, ["g", "h"]).collect()] == ["a", "b"]
    assert linked.group_keys(flat, []) is None


def test_differences(spark):
    old, new = (spark.createDataFrame([(x,) for x in s], "k string") for s in ("ab", "bc"))
    assert sorted(tuple(r) for r in linked.key_diff(old, new, "k").collect()) == [("a", "removed"), ("c", "added")]
    with pytest.raises(ValueError):
        linked.assert_unique(spark.createDataFrame([("a",), ("a",)], "k string"), "k")
    linked.assert_unique(old, "k")
    got = spark.range(1).select(linked.only_new(F.array(F.lit(1)), F.array(F.lit(2), F.lit(1), F.lit(2))), linked.append_absent(F.array(F.lit(1)), F.array(F.lit(2), F.lit(1)))).first()
    assert tuple(got) == ([2, 2], [1, 2])


def test_filter_traces(spark):
    rows = [("s", ["a", "b"], [1, 2], [9, 8]), ("s", None, [1], [1]), ("t", ["a"], [1], [1])]
    traces = spark.createDataFrame(rows, "set string, key array<string>, x array<int>, _raw array<int>")
    got = linked.filter_traces(traces, "s", F.array(F.lit("b"))).collect()
    assert [(r["key"], r["x"], r["_raw"]) for r in got] == [(["b"], [2], [9, 8])]
    assert linked.filter_traces(traces, "s", None).count() == 3
    assert linked.filter_traces(traces, "s", F.array().cast("array<string>")).count() == 0


def test_selected_copies_and_dimming(spark):
    rows = [(1, "s", ["a", "b"], [1, 2], None, "g", None), (2, "s", ["c"], [3], "n", None, 0.0), (3, "t", ["a"], [4], "m", None, 0.5)]
    traces = spark.createDataFrame(rows, "i int, set string, key array<string>, x array<int>, name string, legendgroup string, opacity double")
    got = linked.selected_copies(traces, "i", "s", F.array(F.lit("b"), F.lit("c")), "red").orderBy("i").collect()
    assert [(r["_original"], r.x, r.name, r.legendgroup, r.colour, r.opacity) for r in got] == [(1, [2], "b<br />c", "g", "red", 1.0), (2, [3], "n", "b<br />c", "red", 0.0)]
    overlay = traces.select("i", "set", F.lit("original").alias("kind"), F.coalesce("opacity", F.lit(1.0)).alias("opacity"))
    dim = linked.dim_rest(overlay, traces.filter("set = 's'"), "set", 0.2).orderBy("i").collect()
    assert [r.opacity for r in dim] == [0.2, 0.0, 0.5]


def test_legend_and_points(spark):
    traces = spark.createDataFrame([(1, "g"), (2, "g"), (3, None)], "i int, g string")
    expand = lambda *ids: sorted(r.i for r in linked.expand_legend(traces, traces.filter(F.col("i").isin(*ids)), "i", "g").collect())
    assert [expand(1), expand(1, 2), expand(3), expand(2, 3), expand(9)] == [[1, 2], [1, 2], [3], [1, 2, 3], []]
    assert sorted(tuple(r) for r in linked.legend_sizes(traces, "i", "g").collect()) == [(1, 2, 1, 2), (2, 2, 1, 2), (3, 1, 3, 3)]
    row = spark.createDataFrame([([["a"], ["b", "c"]],)], "k array<array<string>>")
    got = row.select(linked.point_keys(F.lit("simple"), F.col("k"), F.lit(0)), linked.point_keys(F.lit("nested"), F.col("k"), F.lit(1)), linked.point_keys(F.lit("nested"), F.col("k"), F.lit(9))).first()
    assert tuple(got) == (["a", "b", "c"], ["b", "c"], [])
    got = row.select(linked.point_keys_at_pair(F.col("k"), F.lit(1), F.lit(0)), linked.point_keys_at_list(F.flatten("k"), F.array(F.lit(2), F.lit(0)))).first()
    assert tuple(got) == ("b", ["c", "a"])


def test_changes_and_history(spark):
    events = spark.createDataFrame([("k", 1, None), ("k", 2, "a"), ("k", 3, "a"), ("k", 4, "b"), ("k", 5, "a")], "key string, seq int, value string")
    assert [r.seq for r in linked.change_only(events, "key", ["seq"], "value").orderBy("seq").collect()] == [2, 4, 5]
    assert values(linked.first_of_history(events, F.to_json(F.struct("key", "value")), ["seq"]), "seq") == [1, 2, 4]


def test_reshape(spark):
    long = spark.createDataFrame([("p", 1, "A", 5), ("p", 2, "B", 6)], "player string, idx int, period string, rating int")
    wide = reshape.wide(long, ["player", "idx"], "period", ["A", "B"], "rating")
    assert sorted(tuple(r) for r in reshape.long(wide, ["player", "idx"], ["A", "B"], "period", "rating").collect()) == sorted(tuple(r) for r in long.collect())
    joined = reshape.with_connectors(long, "player", "idx", "period")
    assert sorted((r.idx, r.period) for r in joined.collect()) == [(1, "A"), (2, "A"), (2, "B")]
    m = spark.createDataFrame([([[1, 2, 3], [4, 5, 6]],), ([],)], "m array<array<int>>")
    got = m.select("m", reshape.transpose(F.col("m")).alias("t")).select("m", "t", reshape.transpose(F.col("t")).alias("tt")).collect()
    assert all(r.m == r.tt for r in got) and [[1, 4], [2, 5], [3, 6]] in [r.t for r in got]
    bad = spark.createDataFrame([([1, 2], [1])], "a array<int>, b array<int>")
    with pytest.raises(Exception, match="differ in length"):
        reshape.rows_from_columns(bad, [], ["a", "b"]).collect()
