"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a text (split at line feeds) are hashed.  Of all equal windows in the
corpus the first by (id, place) stays; each later one covers its three lines, and a line that any such
window covers goes.  Windows of blank lines alone do not count, and texts of fewer lines have no window.

The hashes are written once and pre-aggregated before they are shuffled; the table of repeated windows (one
row each) is joined back by sort-merge, where Spark splits a window that fills a partition.  Only texts that
lose lines cross a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, with_few

LINES = 3


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(rows: DataFrame) -> DataFrame:
    """id, print, pos and hash of each window of ``rows`` (id, print, text) that is not blank."""
    lines = rows.select("id", "print", text_lines(F.col("text")).alias("lines")).filter(F.size("lines") >= LINES)
    window = F.transform(F.sequence(F.lit(0), F.size("lines") - LINES), lambda i: F.array_join(F.slice("lines", i + 1, LINES), "\n"))
    every = lines.select("id", "print", F.posexplode(window).alias("pos", "window"))
    return every.filter(F.trim(F.translate("window", "\n\t\r", "   ")) != "").select("id", "print", "pos", F.unhex(F.md5("window")).alias("hash"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with later copies of windows cut from the text, and n_lines, n_removed added.

    Null texts stay null (no lines removed; n_lines 1, as for the empty text).  Rows with the same id and
    text are one document and come out alike; rows with the same id and other texts are told apart by the
    text's hash; a null id sorts first.  Columns named like the new ones are replaced, other names are free;
    texts of any length are taken whole; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = F.col(f"`{text_col}`")
    print_ = F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("print")
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), print_, F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    every = scratch.save(windows(docs.select(F.col(f"`{id_col}`").alias("id"), print_, text.alias("text"))))
    place = F.struct("id", "print", "pos")
    repeated = every.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash", "first")
    later = every.join(scratch.save(repeated).hint("merge"), "hash").filter(place > F.col("first"))
    covered = later.select("id", "print", F.explode(F.sequence(F.col("pos"), F.col("pos") + LINES - 1)).alias("line"))
    cut = scratch.save(covered.groupBy("id", "print").agg(F.collect_set("line").alias("cut")))
    scratch.clear(cut)
    both = with_few(keyed, cut, "left")
    own = F.col(f"row.`{text_col}`")
    lines = text_lines(own)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("cut"))
    new = F.when(F.col("cut").isNull() | own.isNull(), own).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    out = [new.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in kept]
    return both.select(*out, F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_removed"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, lines removed and hash of what is left of every whole text of ``documents``."""
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP6_SQL = """
WITH lines AS (SELECT doc_id, unhex(md5(coalesce(text, ''))) AS fp, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
places AS (SELECT doc_id, fp, l, unnest(range(len(l) - 2)) AS pos FROM lines WHERE len(l) >= 3),
wins AS (SELECT doc_id, fp, pos, l[pos + 1] || chr(10) || l[pos + 2] || chr(10) || l[pos + 3] AS w FROM places),
hashed AS (SELECT doc_id, fp, pos, md5(w) AS h FROM wins WHERE trim(translate(w, chr(10) || chr(9) || chr(13), '   ')) <> ''),
ranked AS (SELECT doc_id, fp, pos, rank() OVER (PARTITION BY h ORDER BY doc_id, fp, pos) AS r FROM hashed),
cut AS (SELECT DISTINCT doc_id, fp, pos + unnest([0, 1, 2]) AS line FROM ranked WHERE r > 1),
every AS (SELECT doc_id, fp, unnest(l) AS line_text, unnest(range(len(l))) AS line FROM lines),
marked AS (SELECT e.doc_id, e.fp, e.line, e.line_text, c.line IS NOT NULL AS gone FROM every e LEFT JOIN cut c ON e.doc_id = c.doc_id AND e.fp = c.fp AND e.line = c.line)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line_text, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, fp
"""
