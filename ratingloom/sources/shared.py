"""The folder that all executors share, and tables saved in it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or one beside the warehouse if unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared").rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def saved(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written as Parquet to the shared folder and read back, so that later steps see one evaluation."""
    path = new_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def forget(rows: DataFrame) -> None:
    """Delete the files of a table that ``saved`` returned, which no later plan reads."""
    spark = rows.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in rows.inputFiles()}:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()
