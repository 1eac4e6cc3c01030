"""Rating bands: classification, members, visibility, overlapping overlays, palettes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.sources.shared import saved

#: The five bands, from high to low.
BANDS = (">2200", "2000-2200", "1800-2000", "1600-1800", "<1600")

#: Overlays of overlapping bands (name, first year, least and greatest rating).
OVERLAYS = (
    ("2015-1200+", 2015, 1200, None),
    ("2015-1600+", 2015, 1600, None),
    ("2015-1900+", 2015, 1900, None),
    ("2022-1500-1800", 2022, 1500, 1800),
    ("2022-1600+", 2022, 1600, None),
    ("2022-1700-2000", 2022, 1700, 2000),
    ("2022-1900+", 2022, 1900, None),
)


def band(rating: Column) -> Column:
    """The band of a rating; 2200 itself is in 2000-2200; NaN and null are in the lowest, as no comparison
    holds for them (Spark would rank NaN above every number)."""
    known = rating.isNotNull() & ~F.isnan(rating.cast("double"))
    return F.when(~known, BANDS[4]).when(rating > 2200, BANDS[0]).when(rating >= 2000, BANDS[1]).when(rating >= 1800, BANDS[2]).when(rating >= 1600, BANDS[3]).otherwise(BANDS[4])


def latest(points: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """The value of each key's last row by ``order``, in one grouped pass for all keys."""
    return points.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias("latest"))


def distinct_keys(points: DataFrame, key: str) -> DataFrame:
    return points.select(key).distinct()


def band_members(banded: DataFrame, name: str, band_col: str = "band") -> DataFrame:
    """Each band, empty ones too, with its members in case-insensitive order.  One array a band is the
    feature; only names are collected.  ``band_places`` gives the same lists as rows, for bands of any size."""
    bands = banded.sparkSession.createDataFrame([(i, b) for i, b in enumerate(BANDS)], "band_no int, band string")
    sorted_names = F.array_sort(F.collect_list(F.struct(F.lower(name).alias("k"), F.col(name).alias("n"))))
    members = banded.groupBy(F.col(band_col).alias("band")).agg(F.transform(sorted_names, lambda x: x["n"]).alias("members"))
    return F.broadcast(bands).join(members, "band", "left").select("band_no", "band", F.coalesce("members", F.array().cast("array<string>")).alias("members"))


def band_places(banded: DataFrame, name: str, band_col: str = "band") -> DataFrame:
    """Each member's place, from 0, in its band's case-insensitive order: rows in place of ``band_members``'
    arrays, numbered by ranges, so that no row and no task holds a band."""
    own = banded.select(F.col(band_col).alias("band"), F.col(name).alias("member"))
    numbered = places(own, [F.col("band"), F.lower("member"), F.col("member")])
    first = numbered.groupBy("band").agg(F.min("place").alias("_first"))  # a row a band
    return numbered.join(F.broadcast(first), "band").select("band", "member", (F.col("place") - F.col("_first")).alias("place"))


def visibility(banded: DataFrame, chosen: str | None, band_col: str = "band", show_all: bool | None = None) -> DataFrame:
    """Add ``visible``: shown for members of the chosen band, legendonly for the rest; or all alike."""
    if show_all is not None:
        return banded.withColumn("visible", F.lit("shown" if show_all else "legendonly"))
    return banded.withColumn("visible", F.when(F.col(band_col) == chosen, "shown").otherwise("legendonly"))


def overlay_members(rated: DataFrame, rating: str, overlays: DataFrame, year: str | None = None) -> DataFrame:
    """Rows in each overlapping overlay (overlay, since, lo, hi; null for no bound): membership is by the rating
    given, the latest in our queries, and, for rows with a ``year``, by the overlay's window of years as well.
    The catalogue is a handful of rows, so it is broadcast."""
    r = F.col(rating)
    inside = (F.col("lo").isNull() | (r >= F.col("lo"))) & (F.col("hi").isNull() | (r <= F.col("hi")))
    if year is not None:
        inside = inside & (F.col("since").isNull() | (F.col(year) >= F.col("since")))
    return rated.join(F.broadcast(overlays), inside)


def palette_index(keys: DataFrame, key: str, size: int) -> DataFrame:
    """Place of each distinct key in case-insensitive order, and that modulo the palette's size."""
    place = F.col("place")
    return places(keys.select(key).distinct(), [F.lower(key), F.col(key)]).select(key, place, (place % size).alias("colour_no"))


def places(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, their number from 0 in the given order.

    The running number comes from ranges: each range is numbered by itself and shifted by the counts of
    those before, so no task sees all rows.  The ranges are saved, so that both uses see the same ones.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    numbered = saved(ranged.withColumn("_nr", F.row_number().over(Window.partitionBy("_part").orderBy(*order))), "places")
    counts = numbered.groupBy("_part").agg(F.max("_nr").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    place = (F.col("_before") + F.col("_nr") - 1).cast("long")
    return numbered.join(F.broadcast(before), "_part").withColumn("place", place).drop("_part", "_nr", "_before")


def reader_order(key: str) -> list[Column]:
    """Lower case under the Unicode collation, as a reader expects; ties by the key itself."""
    return [F.collate(F.lower(key), "UNICODE"), F.col(key)]


def collated(rows: DataFrame, key: str) -> DataFrame:
    """Rows sorted in a reader's order."""
    return rows.orderBy(*reader_order(key))
