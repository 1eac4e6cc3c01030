"""Feeds whose state is tables in the shared folder: filter handles set and cleared, and chained closing ratings.

Each batch writes tables under its own number and reads those of batches before it, so a batch that is replayed
finds what it found the first time and writes over what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.operators.ratings import chained_closing
from ratingloom.sources.shared import new_path


class Tables:
    """A table of rows by batch: ``add`` writes a batch's rows, ``before`` reads those of earlier batches."""

    def __init__(self, spark: SparkSession, path: str, schema: str, parts: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.parts = spark, path, schema, parts

    def add(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").partitionBy(*self.parts).parquet(f"{self.path}/_batch={batch}")

    def upto(self, batch: int) -> DataFrame:
        """Rows of batches up to this one, with ``_batch``."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        kinds = f"{self.schema}, _batch long"
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).option("basePath", self.path).parquet(self.path).filter(F.col("_batch") <= batch)

    def before(self, batch: int) -> DataFrame:
        return self.upto(batch - 1)


# Handles ------------------------------------------------------------------------------------------


class HandleFeed:
    """Keys in every active handle, kept as handles are set and cleared one by one.

    Events are (seq, handle_id, keys): keys set the handle, an empty array sets it to nothing, null clears it; of a
    handle's events in a batch the last one counts, and a clear of an unknown handle is none.  For the handles that
    change, old and new keys give differences of +1 and -1; a key's number of handles is the sum of its differences,
    and only keys whose membership flips come out: (batch, key, shown).  While no handle is active there is no
    filter; a batch that takes the last one away gives one row of null key and null shown, after which the set starts
    afresh.
    """

    def __init__(self, spark: SparkSession, key_type: str, path: str | None = None):
        self.spark, root = spark, path or new_path(spark, "handles")
        self.key_type = key_type
        self.handles = Tables(spark, f"{root}/handles", "handle_id string, active boolean")
        self.keys = Tables(spark, f"{root}/keys", f"key {key_type}, handle_id string", ("handle_id",))
        self.changes = Tables(spark, f"{root}/changes", f"key {key_type}, change long")
        self.flips = Tables(spark, f"{root}/flips", f"key {key_type}, shown boolean")

    def active(self, batch: int) -> DataFrame:
        """handle_id and the batch that last set it, for the handles that are active after a batch."""
        last = self.handles.upto(batch).groupBy("handle_id").agg(F.max_by("active", "_batch").alias("active"), F.max("_batch").alias("_batch"))
        return last.filter("active").select("handle_id", "_batch")

    def held(self, batch: int) -> DataFrame:
        """handle_id and key of the active handles."""
        return self.keys.upto(batch).join(F.broadcast(self.active(batch)), ["handle_id", "_batch"], "left_semi").select("handle_id", "key")

    def process(self, events: DataFrame, batch: int) -> None:
        """Take in a batch of events; its flips are in ``flips`` under its number."""
        last = events.groupBy("handle_id").agg(F.max_by(F.struct("keys"), "seq").alias("e")).select("handle_id", F.col("e.keys").alias("keys"))
        self._take(last.select("handle_id", F.col("keys").isNotNull().alias("active")), last.select("handle_id", F.explode("keys").alias("key")), batch)

    def process_table(self, handle_id: str, keys: DataFrame | None, batch: int) -> None:
        """Take in one set or clear whose keys are a table (of one column) of any size."""
        one = self.spark.createDataFrame([(handle_id, keys is not None)], "handle_id string, active boolean")
        none = self.spark.createDataFrame([], f"handle_id string, key {self.key_type}")
        self._take(one, none if keys is None else keys.select(F.lit(handle_id).alias("handle_id"), F.col(keys.columns[0]).alias("key")), batch)

    def _take(self, handles: DataFrame, keys: DataFrame, batch: int) -> None:
        known = self.active(batch - 1)
        self.handles.add(handles.join(known, "handle_id", "left").filter(F.col("active") | F.col("_batch").isNotNull()).select("handle_id", "active").coalesce(1), batch)
        self.keys.add(keys.filter(F.col("key").isNotNull()).distinct(), batch)
        touched = self.handles.upto(batch).filter(F.col("_batch") == batch).select("handle_id")
        old = self.held(batch - 1).join(F.broadcast(touched), "handle_id", "left_semi").select("key", F.lit(-1).alias("change"))
        new = self.keys.upto(batch).filter(F.col("_batch") == batch).select("key", F.lit(1).alias("change"))
        self.changes.add(old.unionByName(new).groupBy("key").agg(F.sum("change").alias("change")).filter("change <> 0"), batch)
        n_old, n_new = self.active(batch - 1).count(), self.active(batch).count()
        self.flips.add(self._flipped(n_old, n_new, batch), batch)

    def _flipped(self, n_old: int, n_new: int, batch: int) -> DataFrame:
        if n_new == 0:
            shown = [(None, None)] if n_old else []
            return self.spark.createDataFrame(shown, f"key {self.key_type}, shown boolean")
        log = self.changes.upto(batch)
        if n_old == n_new:  # only keys that this batch counts anew can flip
            log = log.join(log.filter(F.col("_batch") == batch).select("key"), "key", "left_semi")
        counts = log.groupBy("key").agg(F.sum(F.when(F.col("_batch") < batch, F.col("change")).otherwise(0)).alias("was"), F.sum("change").alias("now"))
        was, now = (F.col("was") == n_old) & F.lit(n_old > 0), F.col("now") == n_new
        return counts.filter(was != now).select("key", now.alias("shown"))

    def members(self, batch: int) -> DataFrame | None:
        """The keys that pass after a batch, from the flips alone; None where there is no filter."""
        flips = self.flips.upto(batch)
        cleared = flips.filter(F.col("shown").isNull()).agg(F.max("_batch").alias("b")).first().b
        if self.active(batch).isEmpty():
            return None
        live = flips.filter(F.col("_batch") > (-1 if cleared is None else cleared))
        return live.groupBy("key").agg(F.max_by("shown", "_batch").alias("shown")).filter("shown").select("key")


# Chained closings ---------------------------------------------------------------------------------

BUCKETS = 64


class ChainedFeed:
    """Closing ratings that feed the next opening, kept as games arrive in any order of periods.

    A batch's games are counted by pairing and stored by bucket of players.  For each player of a batch the chain is
    computed anew from the first period that the batch touches: its opening is the stored closing before it.  Other
    players' buckets are not opened, and of the players' games those before that period are left out.
    """

    def __init__(self, spark: SparkSession, starts: DataFrame, player_type: str, path: str | None = None):
        """``starts`` has player, opening (before the first period) and k."""
        self.spark, self.starts, root = spark, starts, path or new_path(spark, "chained")
        self.games = Tables(spark, f"{root}/games", f"player {player_type}, period string, score double, opponent double, n long, _bucket int", ("_bucket",))
        self.closings = Tables(spark, f"{root}/closings", f"player {player_type}, period string, opening long, closing long, _bucket int", ("_bucket",))

    def latest(self, batch: int) -> DataFrame:
        """player, period, opening and closing after a batch."""
        last = self.closings.upto(batch).groupBy("player", "period").agg(F.max_by(F.struct("opening", "closing"), "_batch").alias("c"))
        return last.select("player", "period", "c.opening", "c.closing")

    def process(self, games: DataFrame, batch: int) -> None:
        """Take in games (player, period, score, opponent); the closings that they change are stored."""
        bucket = F.pmod(F.xxhash64("player"), F.lit(BUCKETS)).cast("int")
        counted = games.groupBy("player", "period", "score", "opponent").agg(F.count(F.lit(1)).alias("n")).withColumn("_bucket", bucket)
        self.games.add(counted, batch)
        fresh = self.games.upto(batch).filter(F.col("_batch") == batch)
        since = fresh.groupBy("_bucket", "player").agg(F.min("period").alias("since")).persist()
        buckets = [r[0] for r in since.select("_bucket").distinct().collect()]  # at most BUCKETS
        touched = since.select("player", "since")
        later = self.games.upto(batch).filter(F.col("_bucket").isin(buckets)).join(touched, "player").filter(F.col("period") >= F.col("since"))
        before = self.closings.before(batch).filter(F.col("_bucket").isin(buckets)).join(touched, "player").filter(F.col("period") < F.col("since"))
        newest = Window.partitionBy("player", "period").orderBy(F.desc("_batch"))
        carried = before.withColumn("_nr", F.row_number().over(newest)).filter("_nr = 1").groupBy("player").agg(F.max_by("closing", "period").alias("carried"))
        opened = later.join(self.starts, "player").join(carried, "player", "left").withColumn("opening", F.coalesce("carried", "opening"))
        closed = chained_closing(opened, "player", "period", "score", "opponent", "opening", "k", times="n")
        self.closings.add(closed.withColumn("_bucket", bucket), batch)
        since.unpersist()


def run_batches(feed: DataFrame, process) -> int:
    """Run a feed over what is there through ``process(rows, batch)``; returns the number of the last batch."""
    last = [-1]

    def step(rows: DataFrame, batch: int) -> None:
        process(rows, batch)
        last[0] = batch

    root = new_path(feed.sparkSession, "feed")
    feed.writeStream.option("checkpointLocation", root).trigger(availableNow=True).foreachBatch(step).start().awaitTermination()
    return last[0]
