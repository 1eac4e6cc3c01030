"""Feeds with stored state against the batch operators, after every batch."""

import random

from pyspark.sql import functions as F

from ratingloom.operators import linked, ratings
from ratingloom.streaming import stored


def test_handles_after_every_batch(spark, tmp_path):
    rng = random.Random(66)
    state = stored.HandleFeed(spark, "int", str(tmp_path / "handles"))
    now, seq = {}, 0
    shown = set()
    for batch in range(9):
        events = []
        for _ in range(rng.randint(1, 3)):
            handle = rng.choice(["a", "b", "c", "never"])
            keys = None if handle == "never" or rng.random() < 0.3 or batch == 7 else rng.choice([[], [rng.randint(0, 5) for _ in range(12)], [rng.randint(0, 3) for _ in range(30)]])
            events.append((seq, handle, keys))
            seq += 1
            now[handle] = keys
        if batch == 7:
            events += [(seq + i, h, None) for i, h in enumerate(now)]
            seq += len(now)
            now = dict.fromkeys(now)
        frame = spark.createDataFrame(events, "seq long, handle_id string, keys array<int>")
        for _ in range(2 if batch % 3 == 0 else 1):  # some batches are replayed
            state.process(frame, batch)
        live = {h: set(k) for h, k in now.items() if k is not None}
        got = state.members(batch)
        handles = spark.createDataFrame([(h,) for h in live], "handle_id string")
        pairs = spark.createDataFrame([(h, k) for h, ks in live.items() for k in ks], "handle_id string, key int")
        want = linked.intersect_handles(handles, pairs)
        assert (got is None) == (want is None)
        flips = [(r.key, r.shown) for r in state.flips.upto(batch).filter(F.col("_batch") == batch).collect()]
        assert all((k in shown) != s for k, s in flips if s is not None), "only what flips comes out"
        if got is None:
            shown = set()
            continue
        shown = {r.key for r in got.collect()}
        assert shown == {r.key for r in want.collect()}


def test_chained_after_every_batch(spark, tmp_path):
    rng = random.Random(5)
    starts = spark.createDataFrame([(p, 1400 + 37 * p, 24 if p % 2 else 32) for p in range(6)], "player int, opening int, k int")
    state = stored.ChainedFeed(spark, starts, "int", str(tmp_path / "chained"))
    so_far = []
    for batch in range(4):
        games = [(rng.choice([0, 1, 2, batch]), f"20{rng.randint(10, 14)}P{rng.randint(1, 2)}", rng.choice([0.0, 0.5, 1.0, None]), float(rng.randint(1000, 2000))) for _ in range(25)]
        so_far += games
        frame = spark.createDataFrame(games, "player int, period string, score double, opponent double")
        for _ in range(2 if batch == 1 else 1):
            state.process(frame, batch)
        every = spark.createDataFrame(so_far, frame.schema).join(starts, "player")
        want = ratings.chained_closing(every, "player", "period", "score", "opponent", "opening", "k")
        assert {tuple(r) for r in state.latest(batch).collect()} == {(r.player, r.period, r.opening, r.closing) for r in want.collect()}
    assert state.closings.upto(3).filter("player = 3 AND _batch < 3").count() == 0


def test_run_batches(spark, tmp_path):
    for n in range(3):
        spark.createDataFrame([(n, "h", [n, n + 1])], "seq long, handle_id string, keys array<int>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema("seq long, handle_id string, keys array<int>").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    state = stored.HandleFeed(spark, "int")
    last = stored.run_batches(feed, state.process)
    assert last == 2 and {r.key for r in state.members(last).collect()} == {2, 3}
