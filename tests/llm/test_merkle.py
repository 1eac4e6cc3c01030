"""Against a plain tree, built node by node, and against the query's SQL (in test_lines_licences)."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import merkle as M


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def one(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top, and for each node its (side, sibling) pairs from below."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, p in enumerate(at):
            q = p ^ 1
            proofs[i].append(("alone", "") if q >= len(level) else (("left" if q < p else "right"), level[q]))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], proofs


def brute(rows: list[tuple]) -> dict:
    """(doc_id, leaf) -> the result row; rows are (doc_id, source, lang, n_chars, text)."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], sha("".join(map(one, r))), sha("".join(map(one, (*r[:3], r[3] if r[3] is None or zlib.crc32(str(r[0]).encode()) % 7 else r[3] + 1, r[4]))))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = climb([leaf for _, leaf, _ in groups[g]])
    root, upper = climb([trees[g][0] for g in order])
    out = {}
    for g, up in zip(order, upper):
        for (i, leaf, changed), proof in zip(groups[g], trees[g][1]):
            node = changed
            for side, other in proof + up:
                node = sha(other + node if side == "left" else node + other)
            out[i, leaf] = (trees[g][0], root, sha("".join(o for _, o in proof + up)), node, node == root)
    return out


def result(spark, rows, levels, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumns({c: F.lit(9) for c in ("pos", "n", "grp", "block", "node", "step", "steps", "top", "leaf", "id", "all", "tie", "part")})
    path = str(tmp_path / "t")
    docs.write.parquet(f"{path}/documents.parquet")
    kept = M.LEVELS
    M.merkle_manifest.__defaults__ = (*M.merkle_manifest.__defaults__[:-1], levels)
    try:
        got = M.op13_merkle(spark, path).collect()
    finally:
        M.merkle_manifest.__defaults__ = (*M.merkle_manifest.__defaults__[:-1], kept)
    return {(r.doc_id, r.leaf): tuple(r)[2:] for r in got}, len(got)


@pytest.mark.parametrize("levels", [2, 12])
def test_against_a_plain_tree(spark, tmp_path, levels):
    rng = random.Random(levels)
    langs = [None, "", "en", "é", "zz", "Z"]
    sizes = [1, 2, 3, 7, 8, 33]
    rows, at = [], 0
    for lang, n in zip(rng.sample(langs, 6), sizes):
        for _ in range(n):
            rows.append((at, rng.choice([None, "web", ""]), lang, rng.choice([None, 5, 0]), rng.choice([None, "", "é" * 9, "long " * 40_000 if at == 3 else "x"])))
            at += rng.randint(1, 3)
    rows.append((None, None, "en", 3, "no id"))
    got, n = result(spark, rows, levels, tmp_path)
    assert n == len(rows) and got == brute(rows)
    assert any(not r[4] for r in got.values()) and any(r[4] for r in got.values())


def test_one_group_one_row_no_row(spark, tmp_path):
    rows = [(7, "a", "en", 1, "x")]
    got, _ = result(spark, rows, 12, tmp_path / "one")
    assert got == brute(rows)
    (own,) = got.values()
    assert own[0] == own[1] and own[2] == sha("")
    assert result(spark, [], 12, tmp_path / "none") == ({}, 0)


def test_repeated_rows_are_leaves_of_their_own(spark, tmp_path):
    rows = [(5, "a", "en", 1, "x")] * 9 + [(6, "a", "en", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = M.merkle_manifest(docs, levels=2).withColumn("end", M.folded(F.col("leaf"), F.col("steps"))).collect()
    leaves = [sha("".join(map(one, r))) for r in rows]
    assert len(got) == 10 and {r.root for r in got} == {climb(leaves)[0]} and all(r.end == r.root for r in got)
    assert len({tuple(r.steps) for r in got}) == 10
