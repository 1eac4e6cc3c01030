"""Readers: rating points from CSV; ledgers, periods, charts and links from HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.functions.scalars import clean_cell, day_first_date, event_name, event_round, period_label, to_number

HEADER = r"(\d{4}\s*-?\s*Part\s*\d+)\s*///\s*([EW])1\s*=\s*(\d+)\s*///\s*k\s*=\s*(\d+)"
ROW = r"(?is)<td[^>]*>(.*?)</td>"


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """name, date, elo_smooth, src_pos of a CSV of Name, Date, ELO_smooth.

    Position counts a name's rows in the order of the file: by file, by where the part of it that a task reads
    begins, and by the running number within the task, which follows the part.
    """
    rows = spark.read.schema("Name string, Date string, ELO_smooth string").option("mode", "FAILFAST").csv(path, header=True)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nr")]
    typed = rows.select(F.col("Name").alias("name"), F.try_to_date(F.col("Date"), "yyyy-MM-dd").alias("date"), to_number(F.coalesce("ELO_smooth", F.lit(""))).alias("elo_smooth"), *place)
    order = Window.partitionBy("name").orderBy("file", "block", "nr")
    return typed.select("name", "date", "elo_smooth", F.row_number().over(order).cast("long").alias("src_pos"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page (file name without ending) and html, one row a file."""
    text = spark.read.text(path, wholetext=True).withColumn("page", F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.html?)?$", 1))
    return text.select(F.regexp_replace(F.url_decode("page"), "_", " ").alias("page"), F.col("value").alias("html"))


def _marks(pages: DataFrame) -> DataFrame:
    """page, pos and text of every period heading and six-cell row, in the order of the page.  Rows are
    matched one by one, as pages leave tags open."""
    mark = r"(?is)(\d{4}\s*-?\s*Part\s*\d+\s*///[^<]*k\s*=\s*\d+|<td[^>]*>(?:(?!<tr|<td).)*?</td>(?:\s*<td[^>]*>(?:(?!<tr|<td).)*?</td>){5})"
    return pages.select("page", F.posexplode(F.regexp_extract_all("html", F.lit(mark), F.lit(1))).alias("pos", "mark"))


def extract_periods(pages: DataFrame) -> DataFrame:
    """player, period, list_type, opening, k of each heading."""
    part = lambda i: F.regexp_extract("mark", HEADER, i)
    heads = _marks(pages).filter(F.col("mark").rlike(HEADER))
    return heads.select(F.col("page").alias("player"), period_label(part(1)).alias("period"), part(2).alias("list_type"), part(3).cast("int").alias("opening"), part(4).cast("int").alias("k"), "pos")


def extract_ledger(pages: DataFrame) -> DataFrame:
    """Every six-cell row under the nearest heading above: player, period, pos and typed cells."""
    marks = _marks(pages)
    head = F.when(F.col("mark").rlike(HEADER), period_label(F.regexp_extract("mark", HEADER, 1)))
    above = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = marks.withColumn("period", F.last(head, ignorenulls=True).over(above)).filter(~F.col("mark").rlike(HEADER))
    cells = rows.withColumn("c", F.transform(F.regexp_extract_all("mark", F.lit(ROW), F.lit(1)), lambda c: F.regexp_replace(c, r"<[^>]*>|&nbsp;", " ")))
    cell = lambda i: F.get("c", F.lit(i))
    number = lambda i: clean_cell(cell(i)).try_cast("int")
    name = clean_cell(cell(1))
    pos = F.row_number().over(Window.partitionBy("page", "period").orderBy("pos")).cast("int")
    return cells.filter(F.size("c") == 6).select(
        F.col("page").alias("player"), "period", pos.alias("pos"), F.trim(cell(0)).alias("date_raw"), day_first_date(cell(0)).alias("date"),
        event_name(name).alias("event"), event_round(name).alias("round"), clean_cell(cell(2)).alias("opponent"),
        clean_cell(cell(3)).try_cast("decimal(2,1)").alias("result"), number(4).alias("opp_rating"), number(5).alias("new_rating"),
    )


def extract_chart(pages: DataFrame) -> DataFrame:
    """player, idx, col, value of the chart literal: rows ``['', 1, null]``; the label may be a missing slot."""
    rows = pages.select("page", F.posexplode(F.regexp_extract_all("html", F.lit(r"\[\s*(?:''|\"\")?\s*,((?:\s*(?:null|-?\d+(?:\.\d+)?)?\s*,?)+)\]"), F.lit(1))).alias("idx", "cells"))
    values = rows.select(F.col("page").alias("player"), "idx", F.posexplode(F.split("cells", ",")).alias("col", "cell"))
    return values.filter(F.trim("cell") != "").select("player", "idx", "col", F.nullif(F.trim("cell"), F.lit("null")).try_cast("int").alias("value"))


def extract_links(pages: DataFrame, id_col: str = "page", comments: bool = True) -> DataFrame:
    """id, pos, href, text and the nearest heading above of each link; without ``comments``, those inside
    HTML comments are left out."""
    html = F.col("html") if comments else F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    mark = r"(?is)(<h[1-6][^>]*>.*?</h[1-6]>|<a\s[^>]*href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>)"
    marks = pages.select(id_col, F.posexplode(F.regexp_extract_all(html, F.lit(mark), F.lit(1))).alias("pos", "mark"))
    plain = F.trim(F.regexp_replace(F.regexp_replace("mark", r"<[^>]*>", ""), r"\s+", " "))
    is_head = F.lower("mark").startswith("<h")
    above = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = marks.withColumn("heading", F.last(F.when(is_head, plain), ignorenulls=True).over(above)).filter(~is_head)
    return rows.select(id_col, F.row_number().over(Window.partitionBy(id_col).orderBy("pos")).alias("nr"), F.regexp_extract("mark", r"(?is)href\s*=\s*[\"']([^\"']*)[\"']", 1).alias("href"), plain.alias("text"), "heading")
