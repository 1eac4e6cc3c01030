"""Against a plain search for every window."""

import random

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import decontamination as D


def brute(docs, items, window):
    windows = {}
    for i, t in items:
        w = D.words_of(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = {}
    for i, t in docs:
        w, hit, found = D.words_of(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= ids
        out[i] = (len(w), len(hit), sorted(found))
    return out


def measured(found):
    return {r.doc_id: (r.n_words, sum(s["last"] - s["first"] + 1 for s in r.spans), r.item_ids) for r in found.collect()}


@pytest.mark.parametrize("block", [300_000, 30])
def test_random_words(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK", block)
    rng = random.Random(3)
    words = "a b c d É 漢 e1 ThisIsAWordOfMoreThanSixteenLetters".split()
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(12)] + [(99, None), (5, "a b")]
    docs = [(i, ", ".join(rng.choice([*words, "Q"]) for _ in range(rng.randint(0, 60)))) for i in range(120)] + [(1000, None), (1001, "")]
    found = D.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=4)
    assert measured(found) == brute(docs, items, 4)


def test_whole_table(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    assert measured(D.find_contamination(docs, items)) == want
    got = {r.doc_id: r for r in D.op1_decontamination(spark, small).collect()}
    assert all((got[i].n_words, got[i].n_hit, got[i].n_items) == (n, h, len(x)) for i, (n, h, x) in want.items())
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert D.find_contamination(left, items).filter(F.size("spans") > 0).count() == 0
    clean = {i for i, (_, h, _) in want.items() if not h}
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in left.collect()}
    assert all(after[i] == before[i] for i in clean)


def test_empty_tables_nulls_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, None, 1, ["x"]), (1, "one two", 2, None), (1, "one two", 2, None)], "doc_id long, text string, n_words int, spans array<string>")
    none = spark.createDataFrame([], "item_id long, text string")
    got = D.find_contamination(docs, none).collect()
    assert sorted(r.n_words for r in got) == [0, 2, 2] and all(r.spans == [] and r.item_ids == [] for r in got)
    assert D.find_contamination(docs.limit(0), none).count() == 0
    two = spark.createDataFrame([(None, "one two"), (7, "one two")], "item_id long, text string")
    assert [r.item_ids for r in D.find_contamination(docs.filter("doc_id = 1"), two).collect()] == [["", "7"]] * 2
    assert D.decontaminate(docs, two).columns == docs.columns
