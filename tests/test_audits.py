"""Audits that search, against plain Python."""

import datetime as dt
import random
from bisect import bisect_right
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.operators import audits, linked, prefix, ratings, reshape


def longest(values):
    """Kept places by the definition: lengths by comparing all pairs, then back from the last greatest."""
    length = []
    for i, v in enumerate(values):
        length.append(1 + max([length[j] for j in range(i) if values[j] <= v], default=0))
    kept, at = set(), len(values)
    for want in range(max(length, default=0), 0, -1):
        at = max(j for j in range(at) if length[j] == want)
        kept.add(at)
    return [i in kept for i in range(len(values))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=30))
def test_piles(values):
    kept = audits._in_order(values)
    assert kept == longest(values)
    chosen = [v for v, k in zip(values, kept) if k]
    assert chosen == sorted(chosen)
    tops = []
    for v in values:
        k = bisect_right(tops, v)
        tops[k : k + 1] = [v]
    assert len(chosen) == len(tops)


def test_order_faults(spark):
    rng = random.Random(6)
    rows = [(1, i, d) for i, d in enumerate(["2020-01-01", "2021-01-05", "2020-01-06", "2020-01-07"])]
    rows += [(2, i, None if i % 7 == 3 else f"2020-{1 + i // 28:02d}-{1 + (i + rng.choice([0, 0, 0, 9])) % 28:02d}") for i in range(120)]
    rows += [(None, 0, "2020-02-02"), (None, 1, "2020-02-01"), (3, 0, None)]
    frame = spark.createDataFrame([(k, p, d and dt.date.fromisoformat(d), "x") for k, p, d in rows], "player int, pos int, day date, _high string").repartition(5)
    got = audits.order_faults(frame, "player", "pos", "day")
    assert got.columns == frame.columns
    want = set()
    for key in (1, 2, None):
        own = [(p, d) for k, p, d in rows if k == key and d]
        want |= {(key, p) for (p, _), kept in zip(own, longest([d for _, d in own])) if not kept}
    assert {(r.player, r.pos) for r in got.collect()} == want and (1, 1) in want
    assert audits.order_faults(frame.limit(0), "player", "pos", "day").count() == 0


def dice(a, b):
    g = lambda s: {f" {s.lower()} "[i : i + 3] for i in range(max(1, len(s)))}
    return 2 * len(g(a) & g(b)) / (len(g(a)) + len(g(b)))


@pytest.mark.parametrize("least", [0.5, 0.7])
def test_similar_names(spark, least):
    rng = random.Random(3)
    names = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"Dave McGhee", "Dave MgGhee", "Josh McKenna", "Joshua McKenna", ""}
    frame = spark.createDataFrame([(n,) for n in [*names, None, "ab"]], "n string")
    got = {(r.name, r.other): r.alike for r in audits.similar_names(frame, "n", least).collect()}
    names.add("ab")
    want = {(a, b): dice(a, b) for p in combinations(sorted(names), 2) for a, b in (p, p[::-1]) if dice(a, b) >= least}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_nearly_mirrored(spark):
    day = dt.date
    games = [
        (1, "Dave McGhee", "Josh McKenna", day(2022, 3, 1), 1.0), (2, "Josh McKenna", "Dave MgGhee", day(2022, 3, 1), 0.0),  # spelling
        (3, "Ann Lee", "Bob Stone", day(2022, 5, 1), 0.5), (4, "Bob Stone", "Ann Lee", day(2022, 5, 3), 0.5),  # date
        (5, "Ann Lee", "Bob Stone", day(2022, 5, 2), 0.5),  # as near, but the larger id
        (6, "Cy Gray", "Di Blue", day(2021, 7, 1), 1.0), (7, "Di Blue", "Cy Gray", day(2022, 7, 1), 0.0),  # year
        (8, "Eve Moss", "Fay Nash", day(2022, 1, 1), 1.0), (9, "Fay Nash", "Eve Moss", day(2022, 1, 2), 1.0),  # scores do not add up
        (10, "Gil Park", "Hal Rowe", day(2022, 1, 1), 1.0), (11, "Hal Rowe", "Gil Park", day(2022, 1, 1), 0.0),  # exact
        (12, None, "Hal Rowe", None, None),
    ]
    frame = spark.createDataFrame(games, "id int, p string, o string, d date, s double")
    got = {(r.id, r.other_id): r.days for r in audits.nearly_mirrored(frame, "id", "p", "o", "d", "s").collect()}
    assert got == {(1, 2): 0, (4, 5): 1, (6, 7): 4}
    assert audits.nearly_mirrored(frame.limit(0), "id", "p", "o", "d", "s").count() == 0


@pytest.mark.parametrize("least", [0.45, 0.6, 0.85])
def test_names_meet_by_three_grams(spark, monkeypatch, least):
    """More grams for more names, fewer for short and for long ones; forced here for a few names."""
    monkeypatch.setattr(audits, "PAIRS_A_ROW", 1e-9)
    monkeypatch.setattr(audits, "COUNTED", 1)
    monkeypatch.setattr(audits, "MOST_KEYS", 60)
    rng = random.Random(9)
    names = {"".join(rng.choice("abcdef") for _ in range(rng.choice([1, 2, 3, 4, 7, 9, 12, 16, 40]))) for _ in range(120)}
    for n in sorted(names):
        at = rng.randrange(len(n))
        names.add(n[:at] + n[at + 1 :])
        names.add(n[:at] + "g" + n[at:])
        names.add(n.upper())
    got = [(r.name, r.other, r.alike) for r in audits.similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", least).collect()]
    want = {(a, b): dice(a, b) for p in combinations(sorted(names), 2) for a, b in (p, p[::-1]) if dice(a, b) >= least}
    assert len(got) == len(want) and all(abs(want[a, b] - c) < 1e-12 for a, b, c in got)
    sizes = sorted({len(grams) for grams in ({f" {n.lower()} "[i : i + 3] for i in range(max(1, len(n)))} for n in names)})
    meeting = audits._meeting(sizes, least, 3)
    assert {level for _, level, _, _ in meeting} == {1, 2, 3} and not all(own for *_, own in meeting)


def test_names_that_meet_do_not_grow_with_their_square(spark):
    """40,000 names of random digits share many grams and are hardly ever alike: bytes are shuffled for names, not for pairs."""

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    before = written()
    names = spark.range(40_000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 10).alias("n"))
    assert audits.similar_names(names, "n").count() < 100
    assert written() - before < 1_000 * 40_000


def test_nearly_mirrored_by_greed(spark):
    """Random games of a few names that are much alike, some against themselves, with names, dates and scores missing."""
    rng = random.Random(12)
    names = ["abcdefgh", "abcdefg", "abcdefghi", "bcdefgh", "Abcdefgh", "vwxyzuvs", "vwxyzuv", None]
    days = [dt.date(2021, 3, 1), dt.date(2021, 3, 2), dt.date(2021, 3, 5), dt.date(2022, 3, 1), dt.date(2022, 3, 30), None]
    games = [(i, rng.choice(names), rng.choice(names), rng.choice(days), rng.choice([0.0, 0.5, 1.0, None])) for i in range(90)]
    alone = [x for x in games if None not in x[1:4] and not any((y[1], y[2], y[3]) == (x[2], x[1], x[3]) for y in games)]

    def alike(a, b):
        return 1.0 if a == b else dice(a, b)

    pairs = []
    for x, y in combinations([x for x in alone if x[4] is not None], 2):
        a, b, apart = alike(x[1], y[2]), alike(x[2], y[1]), abs((x[3] - y[3]).days)
        days_off = apart if apart <= 3 else 4 if (x[3].month, x[3].day) == (y[3].month, y[3].day) else None
        if min(a, b) >= 0.6 and days_off is not None and x[4] + y[4] == 1.0:
            pairs.append((-min(a, b), -(a + b), days_off, x[0], y[0]))
    want, taken = [], set()
    for least, _, days_off, i, j in sorted(pairs):
        if not {i, j} & taken:
            want.append((i, j, round(-least, 9), days_off, 1.0))
            taken |= {i, j}
    frame = spark.createDataFrame(games, "id int, p string, o string, d date, s double")
    got = [(r.id, r.other_id, round(r.alike, 9), r.days, r.total) for r in audits.nearly_mirrored(frame, "id", "p", "o", "d", "s").collect()]
    assert sorted(got) == sorted(want) and len(want) > 8


def test_best_pairs_by_greed(spark):
    rng = random.Random(8)
    pairs = [(a, b, rng.randint(1, 5)) for a in range(12) for b in range(12) if rng.random() < 0.4]
    got = {(r.a, r.b) for r in audits.best_pairs(spark.createDataFrame(pairs, "a int, b int, w int"), "a", "b", [F.desc("w"), F.asc("a"), F.asc("b")]).collect()}
    want, left, right = set(), set(), set()
    for a, b, _ in sorted(pairs, key=lambda x: (-x[2], x[0], x[1])):
        if a not in left and b not in right:
            want.add((a, b))
            left.add(a)
            right.add(b)
    assert got == want


def test_copied_blocks(spark):
    rows = [("p", 1, i + 1, v) for i, v in enumerate("abcdefa")] + [("p", 2, i + 1, v) for i, v in enumerate("xbcdya" + "ab")] + [("q", 2, 1, "a"), ("q", 3, 1, None), ("q", 2, 2, None)]
    frame = spark.createDataFrame(rows, "who string, no int, pos int, v string")
    blocks = audits.copied_blocks(frame, "who", "no", "pos", ["v"])
    assert {tuple(r) for r in blocks.collect()} == {("p", 2, 2, 2, 3), ("p", 2, 7, 1, 2)}
    left = audits.without_copies(frame, blocks, "who", "no", "pos").filter("who = 'p' AND no = 2").orderBy("pos").collect()
    assert "".join(r.v for r in left) == "xya"


@pytest.mark.parametrize("ranges", [1, 7])
def test_running_equals_window(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.choice([None, rng.randint(-9, 9)])) for i in range(400)]
    frame = spark.createDataFrame(rows, "k string, i int, v int").repartition(ranges)
    w = linked.Window.partitionBy("k").orderBy("i").rowsBetween(linked.Window.unboundedPreceding, linked.Window.currentRow)
    before = linked.Window.partitionBy("k").orderBy("i").rowsBetween(linked.Window.unboundedPreceding, -1)
    after = linked.Window.partitionBy("k").orderBy(F.desc("i")).rowsBetween(linked.Window.unboundedPreceding, linked.Window.currentRow)
    want = frame.select("k", "i", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.count("v").over(w).alias("n"), F.max("v").over(before).alias("m"), F.min("v").over(after).alias("l"))
    got = prefix.running(frame, ["k"], ["i"], {"s": ("sum", F.col("v")), "n": ("count", F.col("v"))})
    got = prefix.running(got, ["k"], ["i"], {"m": ("max", F.col("v"))}, own=False)
    got = prefix.running(got, ["k"], ["i"], {"l": ("min", F.col("v"))}, backward=True)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_one_key_spreads_over_ranges(spark):
    games = spark.range(20_000).select(F.lit("one").alias("player"), "id", (F.col("id") % 3 / 2.0).alias("score"), (1400.0 + F.col("id") % 300).alias("opp"), F.lit(1500).alias("opening"), F.lit(24).alias("k"))
    args = (["player"], ["id"], "score", "opp", "opening", "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be put together
    try:
        got = prefix.running_rating_any(games, *args)
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = ratings.running_rating(games, *args)
    assert {(r.id, r.new_rating) for r in got.collect()} == {(r.id, r.new_rating) for r in want.collect()}
    index = prefix.game_index_any(games, "player", ["id"])
    assert {(r.id, r.idx) for r in index.collect()} == {(r.id, r.idx) for r in reshape.game_index(games, "player", ["id"]).collect()}
