"""Small helpers that the text operators share: shared scratch tables and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    ``spark.checkpoint.dir`` names it.  Where that is unset (tests, one machine), a folder next
    to the warehouse is used and set for checkpoints.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(own)
    return own


BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand at most ``BATCH_ROWS`` rows at a time to Python: texts are long, and a worker's and an
    executor's buffers hold a batch several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


class Scratch:
    """Intermediate tables, written to the shared folder so that a lost executor costs no rerun of
    the whole lineage.  ``drop`` removes those that no later plan reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as read back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, *saved: DataFrame) -> None:
        for df in saved:
            self._delete(self.paths.pop(id(df), None))

    def clear(self, *but: DataFrame) -> None:
        """Drop all saved tables except ``but``, which a result still reads."""
        kept = {id(df) for df in but}
        for key in [k for k in self.paths if k not in kept]:
            self._delete(self.paths.pop(key))

    def _delete(self, path: str | None) -> None:
        if path is None:
            return
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def slices(texts: list, rows: list, limit: int) -> Iterator[tuple[list, list]]:
    """Cut one Arrow batch into runs of about ``limit`` characters, so that working arrays stay small
    whatever the batch size; a longer text is a run of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        n = len(text) if text is not None else 0
        if i > start and held + n > limit:
            yield texts[start:i], rows[start:i]
            start, held = i, 0
        held += n
    if start < len(texts):
        yield texts[start:], rows[start:]


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of the given columns, in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


SLOTS = 1 << 19


def with_few(rows: DataFrame, keyed: DataFrame, how: str) -> DataFrame:
    """``rows`` (id, print and others) joined with the saved table ``keyed`` on id and print, inner or left.

    Only rows whose key falls into a slot that ``keyed`` fills take part in the shuffle.  The slots are
    broadcast: they are ``SLOTS`` numbers at most, whatever the data; with more keys more rows pass.
    """
    slot = F.pmod(F.xxhash64("id", "print"), F.lit(SLOTS)).cast("int")
    slots = F.broadcast(keyed.select(slot.alias("_slot")).distinct())
    slotted = rows.withColumn("_slot", slot)
    renamed = keyed.withColumnsRenamed({"id": "_id", "print": "_print"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print"))
    near = slotted.join(slots, "_slot", "left_semi").join(renamed.hint("merge"), same, how).drop("_id", "_print", "_slot")
    if how == "inner":
        return near
    far = slotted.join(slots, "_slot", "left_anti").drop("_slot")
    return near.unionByName(far, allowMissingColumns=True)
