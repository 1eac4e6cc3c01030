"""Stream forms of the change, debounce, history and closing-rating operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ratingloom.functions.scalars import fingerprint
from ratingloom.operators.ratings import DELTA, delta
from ratingloom.sources.shared import is_folder, new_path


def read_feed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder, one file or a folder of files, as a file stream; local timestamps become instants,
    as watermarks need them."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    single = reader.parquet(path) if is_folder(spark, path) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return single.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in schema])


# Closing signals ----------------------------------------------------------------------------------

END = "2200-01-01 00:00:00"  # later than any event, and within what Python's timestamps hold


class Closable:
    """A feed that can be told that nothing more will come.

    ``feed`` has the same columns and ``closing``, false for events.  ``close`` drops one row without values into a
    folder that the feed also watches; its time is past all others, so it takes the watermark past everything
    that an operator still holds.
    """

    def __init__(self, feed: DataFrame, ts: str):
        self.spark, self.ts, self.path = feed.sparkSession, ts, new_path(feed.sparkSession, "signal")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.schema)
        self.schema = f"{kinds}, closing boolean"
        none = self.spark.createDataFrame([], self.schema)
        none.write.parquet(self.path)
        signals = self.spark.readStream.schema(self.schema).parquet(self.path)
        self.feed = feed.withColumn("closing", F.lit(False)).unionByName(signals)

    def close(self) -> None:
        row = self.spark.range(1).select(*[(F.lit(END) if f.name == self.ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.feed.schema if f.name != "closing"], F.lit(True).alias("closing"))
        row.write.mode("append").parquet(self.path)


# State of a key -----------------------------------------------------------------------------------


def frozen(rows: pa.Table) -> bytes:
    """Rows of any types as bytes, for a key's state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def thawed(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _events(batches: Iterator[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    """The events of a batch, without signals, with the types of ``schema``."""
    parts = [pa.Table.from_pandas(b.loc[~b["closing"].fillna(False).astype(bool), schema.names], schema=schema, preserve_index=False) for b in batches]
    return pa.concat_tables(parts) if parts else schema.empty_table()


def _millis(ts: pa.ChunkedArray) -> list[int]:
    """Milliseconds, rounded up: an event is due once the watermark has reached all of it."""
    return [-(-t // 1000) for t in pc.cast(ts, pa.int64()).to_pylist()]


def changes(feed: DataFrame, key: str, ts: str, id_col: str, value: str, late: str = "1 hour") -> DataFrame:
    """Events whose value differs from the one before it in the key's event time, with ``old_value``; a first value
    counts unless it is null.

    Each key holds its events back until the watermark, ``late`` behind the latest event of the feed, has passed
    them, and then releases them in order of time and id; so events may arrive in any order and in any batch
    within ``late``.  Those later still are dropped by Spark.  Key, id and value may be of any type with an
    equality; NaN equals NaN, and is told from null in a value that is itself a number.  The state of a key is its events within ``late`` and one value.  ``feed`` may have a
    ``closing`` column (see ``Closable``); without one, the last events come out when later ones arrive.
    """
    names = {"key": key, "ts": ts, "id": id_col, "value": value}
    own = feed.withWatermark(ts, late).select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()], (F.col("closing") if "closing" in feed.columns else F.lit(False)).alias("closing"))
    kinds = {n: own.schema[n].dataType for n in names}
    # pandas has one mark for NaN and for null, so NaN goes beside the value
    floating = kinds["value"].typeName() in ("float", "double")
    own = own.withColumn("nan", F.coalesce(F.isnan("value"), F.lit(False)) if floating else F.lit(False))
    held_schema = pa.schema([("ts", pa.timestamp("us", "UTC")), ("id", to_arrow_type(kinds["id"])), ("value", to_arrow_type(kinds["value"])), ("nan", pa.bool_())])
    last_schema = pa.schema([held_schema.field("value"), held_schema.field("nan")])
    text = {n: k.simpleString() for n, k in kinds.items()}
    out_schema = f"key {text['key']}, id {text['id']}, old_value {text['value']}, value {text['value']}, old_nan boolean, nan boolean"

    def step(key_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, last = (thawed(x) for x in state.get) if state.exists else (held_schema.empty_table(), pa.table({"value": [None], "nan": [False]}, schema=last_schema))
        if not state.hasTimedOut:
            held = pa.concat_tables([held, _events(batches, held_schema)])
        now = state.getCurrentWatermarkMs()
        due = pa.array([t <= now for t in _millis(held["ts"])], pa.bool_())
        ready = held.filter(due).sort_by([("ts", "ascending"), ("id", "ascending")])
        held = held.filter(pc.invert(due))
        every = pa.concat_tables([last, ready.select(["value", "nan"])])
        values, nans = every["value"].to_pylist(), every["nan"].to_pylist()
        there = [i for i in range(1, len(values)) if (values[i], nans[i]) != (values[i - 1], nans[i - 1])]
        state.update((frozen(held), frozen(every.slice(len(values) - 1))))
        if len(held):
            state.setTimeoutTimestamp(max(min(_millis(held["ts"])), now + 1))
        ids = ready["id"].to_pylist()
        rows = {"key": [key_[0]] * len(there), "id": [ids[i - 1] for i in there]}
        rows |= {"old_value": [values[i - 1] for i in there], "value": [values[i] for i in there], "old_nan": [nans[i - 1] for i in there], "nan": [nans[i] for i in there]}
        yield pd.DataFrame({n: pd.Series(v, dtype=object) for n, v in rows.items()})

    found = own.groupBy("key").applyInPandasWithState(step, out_schema, "held binary, last binary", "append", GroupStateTimeout.EventTimeTimeout)
    back = lambda v, nan: F.when(F.col(nan), F.lit(float("nan")).cast(kinds["value"])).otherwise(F.col(v)) if floating else F.col(v)
    return found.select(F.col("key").alias(key), F.col("id").alias(id_col), back("old_value", "old_nan").alias("old_value"), back("value", "nan").alias(value))


def debounced(feed: DataFrame, key: str, ts: str, id_col: str, gap: str, late: str, first: bool = False) -> DataFrame:
    """One event for each burst; the watermark closes a burst.  Bursts that are open at the end come out when the
    feed is closed (``Closable``)."""
    pick = F.min_by if first else F.max_by
    own = feed if "closing" in feed.columns else feed.withColumn("closing", F.lit(False))
    burst = own.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(pick(id_col, F.struct(ts, id_col)).alias(id_col), F.count(F.lit(1)).alias("n_events"), F.max("closing").alias("closing"))
    # the signal's own burst goes after the grouping: a filter on rows would be pushed below the watermark
    return burst.filter(~F.col("closing")).select(key, id_col, "n_events")


def debounced_now(feed: DataFrame, key: str, ts: str, id_col: str, gap_seconds: float, late: str) -> DataFrame:
    """Both edges of each burst as they happen: key, edge (``first`` or ``last``), id, n_events.

    A key keeps its open bursts and a timer.  An event that belongs to no open burst starts one and comes out at
    once, in the batch that brought it, as ``first`` (n_events 1).  Each further event moves the timer; when the
    watermark has passed a burst's last event by the gap, that event comes out as ``last`` with the burst's number
    of events.  Late events may extend a burst to the front or join two; what came out as first stands.  Events of
    one batch are taken in order of time and id.  A key without open bursts has no state.
    """
    own = feed.withWatermark(ts, late).select(F.col(f"`{key}`").alias("key"), F.col(f"`{ts}`").alias("ts"), F.col(f"`{id_col}`").alias("id"), (F.col("closing") if "closing" in feed.columns else F.lit(False)).alias("closing"))
    kinds = {n: own.schema[n].dataType for n in ("key", "id")}
    id_type, gap = to_arrow_type(kinds["id"]), round(gap_seconds * 1_000_000)
    events_schema = pa.schema([("ts", pa.timestamp("us", "UTC")), ("id", id_type)])
    open_schema = pa.schema([("start", pa.int64()), ("end", pa.int64()), ("last", id_type), ("n", pa.int64())])

    def step(key_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bursts = [tuple(r.values()) for r in thawed(state.get[0]).to_pylist()] if state.exists else []
        out = []
        if not state.hasTimedOut:
            rows = _events(batches, events_schema).sort_by([("ts", "ascending"), ("id", "ascending")])
            for t, id in zip(pc.cast(rows["ts"], pa.int64()).to_pylist(), rows["id"].to_pylist()):
                near = [b for b in bursts if b[0] - gap < t < b[1] + gap]
                if not near:
                    out.append(("first", id, 1))
                merged = [*near, (t, t, id, 1)]
                end, last = max((b[1], b[2]) for b in merged)
                bursts = [b for b in bursts if b not in near] + [(min(b[0] for b in merged), end, last, sum(b[3] for b in merged))]
        now = state.getCurrentWatermarkMs() * 1000
        over = sorted(b for b in bursts if b[1] + gap <= now)
        out += [("last", last, n) for _, _, last, n in over]
        bursts = [b for b in bursts if b[1] + gap > now]
        if bursts:
            state.update((frozen(pa.Table.from_pylist([dict(zip(open_schema.names, b)) for b in bursts], open_schema)),))
            state.setTimeoutTimestamp(max(-(-min(b[1] + gap for b in bursts) // 1000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        rows = {"key": [key_[0]] * len(out), "edge": [e for e, _, _ in out], "id": [i for _, i, _ in out], "n_events": [n for _, _, n in out]}
        yield pd.DataFrame({n: pd.Series(v, dtype=object) for n, v in rows.items()})

    schema = f"key {kinds['key'].simpleString()}, edge string, id {kinds['id'].simpleString()}, n_events long"
    found = own.groupBy("key").applyInPandasWithState(step, schema, "bursts binary", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.col("key").alias(key), "edge", F.col("id").alias(id_col), "n_events")


def deduplicated(feed: DataFrame, ts: str, late: str, fingerprint: list[str]) -> DataFrame:
    """Events that differ from all seen within the watermark."""
    return feed.withWatermark(ts, late).dropDuplicatesWithinWatermark(fingerprint)


# History without end ------------------------------------------------------------------------------

BUCKETS = 64
SLOTS = 1 << 16


class History:
    """All fingerprints ever seen, as Parquet in the shared folder: a file set a batch and bucket.

    A batch reads only the buckets it falls into, of batches before its own, and of those only the rows whose slot
    it fills (a Bloom filter of one hash and ``SLOTS`` bits, broadcast); the rest is an anti join.  A batch that is
    replayed sees the same earlier batches, and writes over what it wrote before.
    """

    def __init__(self, spark: SparkSession, columns: list[str], order: list[str], path: str | None = None):
        self.spark, self.columns, self.order = spark, columns, order
        self.path = path or new_path(spark, "history")

    def _printed(self, rows: DataFrame) -> DataFrame:
        own = rows.withColumn("_print", F.sha2(fingerprint(*self.columns), 256))
        hashed = F.xxhash64("_print")
        return own.withColumn("_bucket", F.pmod(hashed, F.lit(BUCKETS)).cast("int")).withColumn("_slot", F.pmod(F.shiftright(hashed, 8), F.lit(SLOTS)).cast("int"))

    def _before(self, batch: int) -> DataFrame:
        kinds = "_print string, _slot int, _batch long, _bucket int"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).option("basePath", self.path).parquet(self.path).filter(F.col("_batch") < batch)

    def fresh(self, rows: DataFrame, batch: int, to: str) -> None:
        """Write to ``to`` the rows of a batch that no earlier batch had, each different one where it is first in the
        batch; their fingerprints are stored under the batch's number."""
        first = Window.partitionBy("_print").orderBy(*self.order)
        own = self._printed(rows).withColumn("_nr", F.row_number().over(first)).filter("_nr = 1").drop("_nr").persist()
        buckets = [r[0] for r in own.select("_bucket").distinct().collect()]  # at most BUCKETS
        slots = F.broadcast(own.select("_slot").distinct())  # at most SLOTS numbers
        seen = self._before(batch).filter(F.col("_bucket").isin(buckets)).join(slots, "_slot", "left_semi").select("_bucket", "_print")
        new = own.join(seen, ["_bucket", "_print"], "left_anti")
        new.select("_print", "_slot", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/_batch={batch}")
        new.select(*rows.columns).write.mode("overwrite").parquet(to)
        own.unpersist()


def deduplicated_ever(feed: DataFrame, columns: list[str], order: list[str], history: History | None = None) -> DataFrame:
    """Run the feed over what is there and return the events that differ from all before them, without a watermark
    and with no state in memory."""
    own = history or History(feed.sparkSession, columns, order)
    root = new_path(feed.sparkSession, "feed")

    def write(rows: DataFrame, batch: int) -> None:
        own.fresh(rows, batch, f"{root}/rows/batch-{batch}")

    feed.writeStream.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return feed.sparkSession.read.schema(feed.schema).parquet(f"{root}/rows/batch-*")


def closings(games: DataFrame, periods: DataFrame, keys: list[str], score: str, opponent: str, opening: str, k: str) -> DataFrame:
    """Closing ratings as games are appended: a plain sum, so their order is of no matter."""
    rows = games.join(periods, keys).withColumn("_delta", delta(F.col(score), F.col(opening), F.col(opponent), F.col(k)))
    total = rows.groupBy(*keys).agg(F.max(opening).alias("opening"), F.count(F.lit(1)).alias("n_games"), F.sum(F.coalesce("_delta", F.lit(0).cast(DELTA))).alias("_total"))
    return total.select(*keys, "n_games", F.floor(F.col("opening") + F.col("_total").cast("double") + 0.5).cast("long").alias("closing"))


def drain(stream: DataFrame, keys: list[str] | None = None, closable: Closable | None = None) -> DataFrame:
    """Run a stream over what is there and return its rows, from Parquet in the shared folder.  With ``keys`` the
    stream updates rows, and each key's last update is returned.  A closable feed is then closed, and the stream
    goes on from where it was."""
    root = new_path(stream.sparkSession, "feed")
    for again in range(2 if closable else 1):
        if again:
            closable.close()
        writer = stream.writeStream.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
        if keys is None:
            query = writer.outputMode("append").format("parquet").option("path", f"{root}/rows").start()
        else:
            query = writer.outputMode("update").foreachBatch(lambda df, n: df.withColumn("_batch", F.lit(n)).write.mode("overwrite").parquet(f"{root}/rows/batch-{n}")).start()
        query.awaitTermination()
    spark = stream.sparkSession
    if keys is None:
        return spark.read.schema(stream.schema).parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows/batch-*")
    rest = [c for c in rows.columns if c not in (*keys, "_batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("r")).select(*keys, "r.*")
