"""Series, long and wide form, columns and rows, transposes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series(points: DataFrame, key: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """One row a key with parallel arrays in order.  A key's points have to fit in a row."""
    item = F.struct(*order, *[F.col(c).alias(f"_{n}") for n, c in values.items()])
    whole = points.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_s"))
    field = lambda n: F.transform("_s", lambda x: x[f"_{n}"]).alias(n)
    return whole.select(key, *[field(n) for n in values])


def write_series(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """One record a key, as Parquet or JSON lines."""
    rows.write.mode("overwrite").format(form).save(path)


def game_index(games: DataFrame, player: str, order: list[str], out: str = "idx") -> DataFrame:
    return games.withColumn(out, F.row_number().over(Window.partitionBy(player).orderBy(*order)))


def with_connectors(games: DataFrame, player: str, idx: str, period: str) -> DataFrame:
    """Each game under its period, and the first game of a later period also under the one before, so that
    the periods' lines touch."""
    before = games.withColumn("_before", F.lag(period).over(Window.partitionBy(player).orderBy(idx)))
    periods = F.when(F.col("_before") != F.col(period), F.array(period, "_before")).otherwise(F.array(period))
    return before.withColumn(period, F.explode(periods)).drop("_before")


def wide(rows: DataFrame, keys: list[str], period: str, periods: list[str], value: str) -> DataFrame:
    """One column for each listed period, null elsewhere."""
    return rows.groupBy(*keys).pivot(period, periods).agg(F.max(value))


def long(rows: DataFrame, keys: list[str], periods: list[str], period: str, value: str) -> DataFrame:
    """Back from wide form, without nulls."""
    return rows.unpivot(keys, periods, period, value).filter(F.col(value).isNotNull())


def rows_from_columns(rows: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """Equal-length arrays to records; an error where lengths differ."""
    same = [F.size(a) == F.size(arrays[0]) for a in arrays[1:]]
    ok = same[0]
    for s in same[1:]:
        ok = ok & s
    checked = rows.withColumn(arrays[0], F.when(F.assert_true(ok, F.lit("arrays differ in length")).isNull(), F.col(arrays[0])))
    return checked.select(*keep, F.inline(F.arrays_zip(*arrays)))


def transpose(matrix: Column) -> Column:
    """Array of rows to array of columns; the first row gives the width; empty stays empty."""
    width = F.size(F.get(matrix, F.lit(0)))
    return F.when(F.size(matrix) == 0, matrix).otherwise(F.transform(F.sequence(F.lit(0), width - 1), lambda j: F.transform(matrix, lambda r: F.get(r, j))))


def transposed_long(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(dim, id, value) of vectors, for matrices too large for a row."""
    return rows.select(id_col, F.posexplode(vector).alias("dim", "value")).select("dim", id_col, "value")
