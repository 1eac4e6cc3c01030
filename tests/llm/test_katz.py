"""Against a model held in dictionaries, which is also summed up over all its words."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import katz as K

START, END = ("<s>",), ("</s>",)


def tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^ \t-\r]+", lower), END]


class Plain:
    """The same definitions, word by word."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [Counter() for _ in range(order)]
        self.followers = defaultdict(set)
        self.context = Counter()
        for text in texts:
            seq = [START] * (order - 1) + tokens(text)
            for i in range(order - 1, len(seq)):
                for m in range(1, order + 1):
                    gram = tuple(seq[i - m + 1 : i + 1])
                    self.counts[m - 1][gram] += 1
                    self.followers[gram[:-1]].add(gram[-1])
                    self.context[gram[:-1]] += 1
        self.discounts = []
        for c in self.counts:
            types = Counter(c.values())
            self.discounts.append(K.Discount({r: n for r, n in types.items() if r <= K.FITTED}))
        self.total = sum(self.counts[0].values())
        self.words = {g[0] for g in self.counts[0]}
        self.unknown = 1 - sum(self.d(1, n) * n for n in self.counts[0].values()) / self.total if self.total else 1.0

    def d(self, m, n):
        return float(self.discounts[m - 1](np.array([n]))[0])

    def p(self, gram):
        m = len(gram)
        n = self.counts[m - 1][gram]
        if m == 1:
            return self.d(1, n) * n / self.total if n else self.unknown
        if n:
            return self.d(m, n) * n / self.context[gram[:-1]]
        return self.alpha(gram[:-1]) * self.p(gram[1:])

    def alpha(self, h):
        if not self.context[h]:
            return 1.0
        seen = [self.d(len(h) + 1, self.counts[len(h)][(*h, w)]) * self.counts[len(h)][(*h, w)] / self.context[h] for w in self.followers[h]]
        return (1 - sum(seen)) / (1 - sum(self.p((*h[1:], w)) for w in self.followers[h]))

    def score(self, text):
        seq = [START] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(seq)))


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"W{int(rng.paretovariate(0.7))}" for _ in range(400)]
    sep = [" ", "\n", "\t ", "\x0b", " \r\n"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(sep) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "É é Ünseen word"), (n + 3, "É é Ünseen word"), (None, "w1 w2 w1")]


@pytest.mark.parametrize("order,block", [(2, 50), (3, 700)])
def test_against_dictionaries(spark, monkeypatch, order, block):
    monkeypatch.setattr(K, "PIECE", 40)  # texts go on in further pieces
    rows = corpus(150, order)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    plain = Plain([t for i, t in rows if not out(i)], order)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, score string, uid int").repartition(3)
    got = K.katz_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, order=order, block=block, bucket=500)
    assert got.columns == ["doc_id", "uid", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = got.collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for i, t in rows:
        own = tokens(t)
        c = [plain.counts[0][(w,)] for w in own]
        base = sum(math.log10((x + 1) / (plain.total + len(plain.words) + 1)) for x in c)
        want[i].append((out(i), len(own), sum(x > 0 for x in c), plain.total, base, plain.score(t)))
    for r in got:
        assert any(tuple(r)[2:6] == w[:4] and tuple(r)[6:] == pytest.approx(w[4:], rel=1e-9) for w in want[r.doc_id]), r
    assert any(r.held_out for r in got)


@pytest.mark.parametrize("order", [2, 3])
def test_distributions_add_up_to_one(order):
    plain = Plain([t for _, t in corpus(60, 5)], order)
    contexts = [h for h in plain.context if h] + [(("never",),) * (order - 1)]
    for h in random.Random(1).sample(contexts, 40):
        assert sum(plain.p((*h, w)) for w in [*plain.words, ("unknown",)]) == pytest.approx(1, abs=1e-9)


def test_discounts():
    falling = K.Discount({r: int(1e6 / r**2.2) for r in range(1, 150)})
    d = falling(np.arange(1, 1000))
    assert (d > 0).all() and (d < 1).all() and d[0] < d[50] < d[900]
    for few in ({}, {1: 3}, {7: 1}, {1: 1, 2: 50}):
        d = K.Discount(few)(np.arange(1, 50))
        assert (d > 0).all() and (d < 1).all()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string")
    rows = {r.id: r for r in K.katz_scores(docs, F.lit(True)).collect()}
    assert rows[1].n_tokens == 3 and rows[1].n_known == 0 and rows[1].train_tokens == 0 and rows[1].score == 0 and rows[2].n_tokens == 1
    assert K.katz_scores(docs.limit(0), F.lit(False)).count() == 0


def test_one_long_text(spark):
    words = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = spark.createDataFrame([(1, words), (2, "w1 w2 w3")], "doc_id long, text string")
    got = {r.doc_id: r for r in K.katz_scores(docs, F.lit(False), block=7_000).collect()}
    plain = Plain([words, "w1 w2 w3"], 2)
    assert got[1].n_tokens == 60_001 and got[1].score == pytest.approx(plain.score(words), rel=1e-9)
    assert got[2].score == pytest.approx(plain.score("w1 w2 w3"), rel=1e-9)
