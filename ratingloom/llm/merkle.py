"""A Merkle manifest of a table: one digest a row, one subroot a group, one root, and a proof for every row.

Rows of a group are numbered by ranges, so that no task sees a whole group, and dealt out in *blocks* of
``2 ** LEVELS`` consecutive leaves.  Inside a block each level of the tree is a pair of window columns: the
node of level l lies in the row of its first leaf, so its siblings are ``2 ** l`` rows before and after.  The
lag holds for the second slot of a run, the lead for the first one where the run has two nodes, and rows of
a first slot hash the parent.  One shuffle and one sort serve all levels of a block.

The tops of the blocks are the leaves of the next round, of which there are 4,096 times fewer, until each
group has one: its subroot.  The subroots climb to the root in the same way.  What a round adds to the proofs
is joined back by group and block, on which the leaves are already dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table

LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FIRST, SECOND, ALONE = "0", "1", "2"  # a step's mark: which slot the node had, and whether the run had another


def field_text(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with pos, the place of a row in its group from 0, and n, the group's size.

    Rows are dealt out by ranges of (group, order, a number of their own), so a large group, and even one of
    equal rows, spreads over tasks; what lies before a range is the sum of the counts of the ranges before.
    """
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(group, *order, "tie")
    saved = scratch.save(dealt.withColumn("part", F.spark_partition_id()))
    counts = saved.groupBy(group, "part").agg(F.count(F.lit(1)).alias("held"))
    by_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("held").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(group, "part", before.alias("before"), F.sum("held").over(by_group).alias("n"))
    own = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order, "tie"))
    return saved.withColumn("own", own).join(offsets, [group, "part"]).withColumn("pos", F.col("before") + F.col("own") - 1).drop("own", "before", "part", "tie")


def climbed(nodes: DataFrame, group: str, digest: str, levels: int) -> DataFrame:
    """``nodes`` (group, pos, n, digest and others) with block, steps (of each level inside the block, from
    below) and, in the block's first row, top: the digest of the block's highest node."""
    kept = [*nodes.columns, "block"]
    in_block = Window.partitionBy(group, "block").orderBy("pos")
    out = nodes.withColumn("block", F.shiftright("pos", levels)).withColumn("node", F.col(digest))
    for level in range(levels):
        run = 1 << level
        is_node, slot = F.col("pos") % run == 0, F.shiftright("pos", level) % 2
        live = F.col("n") > run  # more than one node is left at this level
        out = out.select("*", F.lag("node", run).over(in_block).alias("back"), F.lead("node", run).over(in_block).alias("ahead"))
        step = F.when(slot == 1, F.concat(F.lit(SECOND), "back")).when(F.col("ahead").isNotNull(), F.concat(F.lit(FIRST), "ahead")).otherwise(F.lit(ALONE))
        parent = F.when(~live, F.col("node")).when(is_node & (slot == 0), F.sha2(F.concat("node", F.coalesce("ahead", F.lit(""))), 256))
        out = out.select(*kept, *[f"step_{i}" for i in range(level)], F.when(is_node & live, step).alias(f"step_{level}"), parent.alias("node"))
    # the rows of a node's other leaves take its step from its first row
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = out.select(*kept, F.col("node").alias("top"), *[F.last(f"step_{i}", ignorenulls=True).over(so_far).alias(f"step_{i}") for i in range(levels)])
    steps = F.filter(F.array(*[F.when(F.col("n") > (1 << i), F.col(f"step_{i}")) for i in range(levels)]).cast("array<string>"), lambda x: x.isNotNull())
    return filled.select(*kept, "top", steps.alias("steps"))


def trees(nodes: DataFrame, group: str, digest: str, levels: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with steps up to the top of their group's tree; and the tops (group, top)."""
    largest = nodes.agg(F.max("n").alias("n")).first().n or 0
    if largest <= 1:
        return nodes.withColumn("steps", F.array().cast("array<string>")), nodes.select(group, F.col(digest).alias("top"))
    levels = min(levels, (largest - 1).bit_length())
    mine = scratch.save(climbed(nodes, group, digest, levels))
    first = mine.filter(F.col("pos") % (1 << levels) == 0)
    tops = scratch.save(first.select(group, F.col("block").alias("pos"), (F.shiftright(F.col("n") - 1, levels) + 1).alias("n"), F.col("top").alias("digest")))
    higher, roots = trees(tops, group, "digest", levels, scratch)
    above = higher.select(group, F.col("pos").alias("block"), F.col("steps").alias("above"))
    return mine.drop("top").join(above, [group, "block"]).withColumn("steps", F.concat("steps", "above")).drop("block", "above"), roots


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""

    def up(node: Column, step: Column) -> Column:
        mark, other = F.substring(step, 1, 1), F.substring(step, 2, 64)
        return F.sha2(F.when(mark == FIRST, F.concat(node, other)).when(mark == SECOND, F.concat(other, node)).otherwise(node), 256)

    return F.aggregate(steps, leaf, up)


def siblings(steps: Column) -> Column:
    """The sibling digests of a proof, from below, joined as text."""
    return F.array_join(F.transform(steps, lambda s: F.substring(s, 2, 64)), "")


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", order_col: str = "doc_id", also: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs``: order_col, leaf, subroot, root, steps (the proof, level by level, each a mark
    of the slot and the sibling's digest), and the columns ``also`` (name to expression over ``docs``).

    A leaf is the SHA-256 of the fields' texts, each ``-`` if null, else byte count, colon, value, so null and
    the empty text differ and texts of any length are hashed whole.  Leaves of a group ascend by order_col
    (null first), then by digest; equal rows are leaves of their own, in any order, which changes nothing but
    which of them has which proof.  A null group is a group and comes first.  An empty table gives an empty
    manifest.  Columns of ``docs`` other than the fields take no part, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    extra = [c.alias(f"also_{i}") for i, c in enumerate((also or {}).values())]
    source = [F.col(f"`{c}`") for c in fields]
    grp = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group_col}`").cast("string")), F.lit(""))  # null before all texts
    leaves = docs.select(grp.alias("grp"), F.col(f"`{order_col}`").alias("id"), leaf_hash(source).alias("leaf"), *extra)
    own, subroots = trees(numbered(leaves, "grp", ["id", "leaf"], scratch), "grp", "leaf", levels, scratch)
    forest = numbered(subroots.select("grp", F.col("top").alias("subroot"), F.lit(0).alias("all")), "all", ["grp"], scratch)
    upper, roots = trees(forest, "all", "subroot", levels, scratch)
    ends = scratch.save(upper.join(roots.withColumnRenamed("top", "root"), "all").select("grp", "subroot", "root", F.col("steps").alias("last_steps")))
    joined = own.join(F.broadcast(ends), "grp") if ends.count() <= BROADCAST_GROUPS else own.join(ends, "grp")
    named = [F.col(f"also_{i}").alias(name) for i, name in enumerate(also or {})]
    return joined.select(F.col("id").alias(order_col), "leaf", "subroot", "root", F.concat("steps", "last_steps").alias("steps"), *named)


BROADCAST_GROUPS = 10_000  # rows of at most about 3 KB each


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every row of ``documents``, and whether it still verifies once tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = [F.when(hit, F.col(c) + 1).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in FIELDS]
    manifest = merkle_manifest(docs, also={"tampered": leaf_hash(changed)})
    end = manifest.withColumn("folded_root", folded(F.col("tampered"), F.col("steps")))
    return end.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         list_reduce(list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ascii((doc_id::VARCHAR)[i + 1])::BIGINT), lambda c, b:
           list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
         sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(changed::VARCHAR) || ':' || changed END || tail) AS tampered
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed FROM fields)),
leaves AS (
  SELECT *, coalesce('+' || lang, '') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
low AS (
  SELECT 0 AS level, grp, pos, leaf AS node FROM leaves
  UNION ALL
  SELECT level + 1, grp, pos // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM low
  WHERE grp IN (SELECT grp FROM low GROUP BY grp HAVING count(*) > 1) GROUP BY level, grp, pos // 2),
subroots AS (
  SELECT grp, node AS subroot, level AS height, row_number() OVER (ORDER BY grp) - 1 AS pos FROM low WHERE (grp, level) IN (SELECT (grp, max(level)) FROM low GROUP BY grp)),
high AS (
  SELECT 0 AS level, pos, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE (SELECT count(*) FROM high) > 1 GROUP BY level, pos // 2),
root AS (SELECT node AS root, level AS height FROM high WHERE level = (SELECT max(level) FROM high)),
nodes AS (
  SELECT low.level, low.grp, low.pos, low.node FROM low JOIN subroots ON low.grp = subroots.grp WHERE low.level < subroots.height
  UNION ALL BY NAME
  SELECT s.height + h.level AS level, s.grp, h.pos, h.node FROM subroots s, root r, high h WHERE h.level < r.height),
paths AS (
  SELECT l.doc_id, l.leaf, l.tampered, l.grp, l.pos, s.subroot, r.root, s.height, s.height + r.height AS depth, s.pos AS place,
         list_transform(range(s.height + r.height), lambda i: struct_pack(level := i, own := CASE WHEN i < s.height THEN l.pos >> i ELSE s.pos >> (i - s.height) END)) AS way
  FROM leaves l JOIN subroots s USING (grp), root r),
steps AS (SELECT grp, pos, unnest(way) AS at FROM paths),
found AS (
  SELECT s.grp, s.pos, list(struct_pack(second := s.at.own % 2 = 1, other := coalesce(n.node, '')) ORDER BY s.at.level) AS sib
  FROM steps s LEFT JOIN nodes n ON n.grp = s.grp AND n.level = s.at.level AND n.pos = xor(s.at.own, 1::BIGINT) GROUP BY s.grp, s.pos),
folds AS (
  SELECT 0 AS done, p.grp, p.pos, p.tampered AS node FROM paths p
  UNION ALL
  SELECT done + 1, f.grp, f.pos, sha256(CASE WHEN s.sib[done + 1].second THEN s.sib[done + 1].other || f.node ELSE f.node || s.sib[done + 1].other END)
  FROM folds f JOIN found s USING (grp, pos) WHERE done < len(s.sib))
SELECT p.doc_id, p.leaf, p.subroot, p.root, sha256(coalesce(array_to_string(list_transform(f.sib, lambda x: x.other), ''), '')) AS proof_sha256,
       o.node AS folded_root, o.node = p.root AS verified
FROM paths p LEFT JOIN found f USING (grp, pos) JOIN folds o ON o.grp = p.grp AND o.pos = p.pos AND o.done = p.depth
"""
