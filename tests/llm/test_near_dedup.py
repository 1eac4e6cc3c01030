"""Against all pairs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import near_dedup as N


def brute(rows, width):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    above = {i: i for i in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    lists, both = {}, Counter()
    for i, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(i)
    for own in lists.values():
        both.update((a, b) for n, a in enumerate(own) for b in own[n + 1 :])
    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("block", "short", "rounds"), [(10, 8, 2), (1000, 8, 1), (5, 2, 1)])
def test_random_copies(spark, monkeypatch, block, short, rounds):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "SHORT", short)
    monkeypatch.setattr(N, "ROUNDS", rounds)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randint(0, 60))] for _ in range(10)]
    rows = []
    for i in range(250):
        b = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            if b:
                b[rng.randrange(len(b))] = rng.choice(words)
        rows.append((i, " ".join(b)))
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE  two"), (1004, " ")]
    found = N.near_components(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert {r.id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(rows, 4)


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.op4_near_dedup(spark, small).collect()}
    assert got == brute(rows, 4)


def test_components_of_a_chain(spark):
    nodes = list(range(60))
    random.Random(1).shuffle(nodes)
    name = lambda i: bytes([i]) * 16
    edges = spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in zip(nodes, nodes[1:])], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in N.components(edges, N.Scratch(spark, "test")).collect()}
    assert got == {name(i): name(0) for i in range(1, 60)}
    assert N.components(edges.limit(0), N.Scratch(spark, "test")).count() == 0


def test_drop_keeps_columns_and_handles_nulls(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(2, text, 1), (1, text, 2), (None, text, 3), (None, None, 4), (7, "", 5), (2, "other words than these here", 6), (2, text, 7)], "doc_id long, text string, label int")
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.label for r in left.collect()) == [2, 4, 5, 6]
    assert N.drop_near_duplicates(docs.limit(0)).count() == 0
    assert N.near_components(docs).filter(F.col("component_id") == 1).count() == 4


def test_chain_of_low_similarity(spark, monkeypatch):
    """Neighbours share one value in a few; a common passage puts all of them into long lists."""
    monkeypatch.setattr(N, "BLOCK", 20)
    rng = random.Random(3)
    common = [f"c{i}" for i in range(25)]
    rows = []
    for i in range(150):
        own = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        rows.append((i, " ".join(common + own if i % 3 else own[:20] + common + own[20:])))
        if i % 10 == 0:
            own[rng.randrange(40)] = "x"
            rows.append((1000 + i, " ".join(common + own if i % 3 else own[:20] + common + own[20:])))
    found = N.near_components(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert {r.id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(rows, 4)


def test_many_repeats_of_one_row(spark):
    text = " ".join(f"w{i}" for i in range(50))
    near = spark.createDataFrame([(7, text + " more"), (9, text)], "doc_id long, text string")
    df = spark.range(16_000).selectExpr("id * 0 + 8 AS doc_id", f"'{text}' AS text").unionByName(near)
    got = N.near_components(df, width=4).groupBy("id", "component_id").count().collect()
    assert sorted(map(tuple, got)) == [(7, 7, 1), (8, 7, 16_000), (9, 7, 1)]


def test_words_with_equal_sums_of_powers(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"{word} one two three"), (4, f"{other} one two three")]
    got = N.near_components(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert {r.id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_columns_with_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(30))
    names = ["_id", "_print", "id", "print", "node", "label", "g"]
    docs = spark.createDataFrame([(2, text, *range(7)), (1, text, *range(7))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    assert [(r.doc_id, r._print) for r in N.drop_near_duplicates(docs).collect()] == [(1, 1)]


def test_lists_of_one_family_meet_once(spark, monkeypatch):
    """Copies with a few words of their own share most values, so that one list after another holds nearly all of them."""
    monkeypatch.setattr(N, "BLOCK", 20)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(240):
        words = list(base)
        for _ in range(rng.randint(2, 6)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    sent, blocked = [], N.blocked

    def watched(lists, scratch):
        sent.append((lists.count(), lists.select("node").distinct().count()))
        return blocked(lists, scratch)

    monkeypatch.setattr(N, "blocked", watched)
    found = N.near_components(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    found = {r.id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert found == brute(rows, 4) and 1 < len({c for _, c in found.values()})
    posts, classes = sent[-1]
    assert len(sent) == 2 and posts <= 4 * classes
