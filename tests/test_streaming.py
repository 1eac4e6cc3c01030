import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import linked
from ratingloom.plans.registry import ORACLES, QUERIES
from ratingloom.streaming import feeds

ZERO = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def feed_of(spark, path, batches, schema):
    """A stream that gives one batch a file, in order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_streams_equal_their_batch_twins(spark, small):
    for stream, batch, columns in (("stream_change", "change_only", ["event_id", "old_value", "event_type"]), ("stream_closing", "rating_closing", ["o_custkey", "period", "closing"])):
        a, b = (sorted(map(str, QUERIES[q](spark, small).select(*columns).collect())) for q in (stream, batch))
        assert a == b


def test_nulls_between_batches(spark, tmp_path):
    """Four batches of one key: a value, null, the value again, and once more."""
    batches = [[(1, n, ZERO + dt.timedelta(seconds=n), value)] for n, value in enumerate(["a", None, "a", "a"])]
    closable = feeds.Closable(feed_of(spark, f"{tmp_path}/t.parquet", batches, "k long, id long, ts timestamp, v string"), "ts")
    got = feeds.drain(feeds.changes(closable.feed, "k", "ts", "id", "v"), closable=closable)
    assert [(r.old_value, r.v) for r in got.orderBy("id").collect()] == [(None, "a"), ("a", None), (None, "a")]
    assert feeds.drain(feeds.read_feed(spark, str(tmp_path), "t")).count() == 4


def test_change_of_numbers_rounds_ties_as_its_sql(spark, tmp_path):
    """Ties to either side of zero, values beside a tie, an unscored event and no number."""
    values = [0.0, 25.0, 75.0, 125.0, 124.99, 24.999999999999996, 175.0, -10.0, -25.0, -75.0, -125.0, None, float("nan"), 25.0, 20.0]
    rows = [(i, ZERO.replace(tzinfo=None) + dt.timedelta(minutes=i), user, v) for user in (0, 1) for i, v in ((100 * user + n, v) for n, v in enumerate(values[:: 1 - 2 * user]))]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["stream_change_numbers"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.sql(ORACLES["stream_change_numbers"]).fetchall()))


KINDS = {
    "double": lambda rng: rng.choice([1.5, 2.5, float("nan"), None]),
    "timestamp": lambda rng: rng.choice([ZERO, ZERO + dt.timedelta(microseconds=7), None]),
    "date": lambda rng: rng.choice([dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]),
    "boolean": lambda rng: rng.choice([True, False, None]),
    "decimal(9,2)": lambda rng: rng.choice([__import__("decimal").Decimal("1.10"), None]),
    "string": lambda rng: rng.choice(["a", "", None]),
    "array<int>": lambda rng: rng.choice([[1], [1, 2], None]),
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_changes_of_any_type_in_event_time(spark, tmp_path, kind):
    """Shuffled files, the last two late but within the delay."""
    rng = random.Random(kind)
    rows = [(rng.choice(["x", "y", None]), i, ZERO + dt.timedelta(minutes=i), KINDS[kind](rng)) for i in range(60)]
    late = [rows[52], rows[55]]
    early = [r for r in rows if r not in late]
    parts = [early[0:25], early[25:45], early[45:]]
    for p in parts:
        rng.shuffle(p)
    closable = feeds.Closable(feed_of(spark, f"{tmp_path}/t.parquet", [*parts, [late[1]], [late[0]]], f"k string, id long, ts timestamp, v {kind}"), "ts")
    got = feeds.drain(feeds.changes(closable.feed, "k", "ts", "id", "v", late="30 minutes"), closable=closable)
    want = linked.change_only(spark.read.parquet(f"{tmp_path}/t.parquet"), "k", ["ts", "id"], "v")
    assert got.schema["v"].dataType.simpleString() == kind
    assert sorted(map(str, got.select("k", "id", "old_value", "v").collect())) == sorted(map(str, want.select("k", "id", "old_value", "v").collect()))


def test_debounce_gives_all_closed_bursts(spark, small):
    """Without a closing signal just the bursts over by the watermark; with one all."""
    for first, name in ((True, "debounce_first"), (False, "debounce_last")):
        every = QUERIES[name](spark, small).collect()
        feed = feeds.read_feed(spark, small, "events").select("user_id", "ts", "event_id")
        got = feeds.drain(feeds.debounced(feed, "user_id", "ts", "event_id", "2 hours", "1 hour", first=first)).collect()
        events = spark.read.parquet(f"{small}/events.parquet")
        end = events.agg(F.max("ts")).first()[0]
        w = linked.debounce(events, "user_id", "ts", "event_id", "2 hours", first=first).join(
            events.groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg((F.max if not first else F.min)("ts").alias("t"), F.max("ts").alias("over")), "user_id"
        )
        assert w.count() > 0 and got
        over = {r.event_id for r in events.groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg((F.min_by if first else F.max_by)("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("over")).collect() if r.over + dt.timedelta(hours=3) <= end}
        assert {r.event_id for r in got} == over and over < {r.event_id for r in every}


def test_edges_as_they_happen(spark, tmp_path):
    """First events come out in the batch that brings them, last ones when the gap is over."""
    at = lambda k, id, minute: (k, id, ZERO + dt.timedelta(minutes=minute))
    batches = [[at("x", 1, 0), at("x", 2, 5), at("y", 3, 1)], [at("x", 4, 9)], [at("x", 5, 40)], [at("x", 6, 90), at("y", 7, 91)]]
    feed = feed_of(spark, f"{tmp_path}/t.parquet", batches, "k string, id long, ts timestamp")
    closable = feeds.Closable(feed, "ts")
    edges = feeds.debounced_now(closable.feed, "k", "ts", "id", 600, "1 minute")
    seen = {}
    root = f"{tmp_path}/state"

    def note(rows, n):
        seen.setdefault(n, []).extend((r.k, r.edge, r.id, r.n_events) for r in rows.collect())

    for again in range(2):
        if again:
            closable.close()
        edges.writeStream.option("checkpointLocation", root).trigger(availableNow=True).foreachBatch(note).start().awaitTermination()
    firsts = [[x for x in seen[n] if x[1] == "first"] for n in sorted(seen)]
    assert [sorted(f) for f in firsts[:4]] == [[("x", "first", 1, 1), ("y", "first", 3, 1)], [], [("x", "first", 5, 1)], [("x", "first", 6, 1), ("y", "first", 7, 1)]]
    lasts = sorted(x for rows in seen.values() for x in rows if x[1] == "last")
    assert lasts == [("x", "last", 4, 3), ("x", "last", 5, 1), ("x", "last", 6, 1), ("y", "last", 3, 1), ("y", "last", 7, 1)]
    assert not [x for n in sorted(seen)[:2] for x in seen[n] if x[:3] == ("x", "last", 4)]


def test_history_replayed(spark, tmp_path):
    batches = [[("a", 1), ("a", 2), ("b", 3)], [("b", 4), ("c", 5), (None, 6)], [("a", 7), (None, 8), ("d", 9)]]
    feed = feed_of(spark, f"{tmp_path}/t.parquet", batches, "v string, id int")
    assert sorted(r.id for r in feeds.deduplicated_ever(feed, ["v"], ["id"]).collect()) == [1, 3, 5, 6, 9]
    history, out = feeds.History(spark, ["v"], ["id"], f"{tmp_path}/prints"), lambda n: f"{tmp_path}/out-{n}"
    for n, rows in enumerate(batches):
        for _ in range(2):  # each batch is run again
            history.fresh(spark.createDataFrame(rows, "v string, id int"), n, out(n))
    history.fresh(spark.createDataFrame(batches[1], "v string, id int"), 1, out(1))
    assert [sorted(r.id for r in spark.read.parquet(out(n)).collect()) for n in range(3)] == [[1, 3], [5, 6], [9]]
