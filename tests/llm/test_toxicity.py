import random
import zlib

import pytest

from ratingloom.llm import toxicity as T

CALM = "the river ran past old houses while people talked about weather food music gardens and small repairs".split()
RUDE = "gribbler snolter fuzzwack".split()


def sentence(rng, toxic):
    words = [rng.choice(CALM) for _ in range(rng.randint(5, 40))]
    for _ in range(3 if toxic else 0):
        words.insert(rng.randrange(len(words)), rng.choice(RUDE))
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(i, sentence(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(600)]


def test_held_out_accuracy_and_gaps(rows):
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    test = [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 5]
    model = T.fit([r[1] for r in train], [r[2] for r in train])
    score = model.scores([r[1] for r in test])
    assert sum((s >= 0.5) == r[2] for s, r in zip(score, test)) >= 0.97 * len(test)
    assert model.scores(["you gr.ibb.ler and sn-olt-er", "gribblerish snolterish"]).min() > 0.5
    assert model.scores(["", None]).max() < 0.5
    long = " ".join(["river"] * 400_000) + " gribbler snolter fuzzwack"
    assert model.scores([long])[0] > 0.5


def test_kernel_by_definition():
    rng = random.Random(2)
    text = T.symbols("".join(rng.choice("ab.") for _ in range(T.WINDOW)))
    index, weight = T.subsequences(T.fragments(text, T.np.array([0])))
    want = {}
    for places in T.itertools.combinations(range(len(text)), T.ORDER):
        span = places[-1] - places[0] + 1
        if span <= T.SPAN and all(text[p] for p in places):
            key = 0
            for p in places:
                key = key << 5 | int(text[p])
            want[key] = want.get(key, 0) + T.DECAY ** (span - T.ORDER)
    got = {}
    for i, w in zip(index[0].tolist(), weight[0].tolist()):
        if w:
            got[i] = got.get(i, 0) + w
    assert got == pytest.approx(want)


def test_query_and_edges(spark, rows, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (424242, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in T.op3_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) + 2
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    assert sum(got[i].predicted == y for i, _, y in rows) >= 0.97 * len(rows)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit_toxicity(docs, labels)
    clash = docs.withColumnRenamed("doc_id", "score")
    assert T.score_toxicity(clash, model).columns == ["text", "score"]
    assert T.score_toxicity(docs.limit(0), model).count() == 0


def test_characters_between_all_letters(rows):
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    model = T.fit([r[1] for r in train], [r[2] for r in train])
    pairs = [(a, b) for a in RUDE for b in RUDE if a != b]
    assert model.scores([f"you {a} and {b}" for a, b in pairs]).min() > 0.5
    for gap in (".", " ", "-", "*", " . ", "---", "\n"):
        assert model.scores([f"you {gap.join(a)} and {gap.join(b)}" for a, b in pairs]).min() > 0.5
        assert model.scores([f"the {gap.join(a)} and {gap.join(b)}" for a in CALM for b in CALM]).max() < 0.5
    assert model.scores(["you s.n.o.l..ter and f u z zwack"])[0] > 0.5
    long = " ".join(["river"] * 400_000)
    text = f"{long} {' '.join('.'.join(word) for word in RUDE)}"
    whole = model.figures(text)
    assert whole[0] > 0 and model.scores([text])[0] == pytest.approx(T.sigmoid(T.shaped(T.np.array([whole])) @ model.logit)[0])


def test_spread_words_by_definition():
    show = lambda text: "".join(chr(96 + c) if c else " " for c in T.spread_words(T.symbols(text)).tolist()).split()
    assert show("so i.d.i-o  t you. I am a man") == ["soidiotyou"]
    assert show("a b cd, x y z") == ["cdxyz"] and show("a b") == show("") == show("plain words only") == []
    assert show("s t u pid and then more w o w") == ["stupid", "morewow"]


def test_words_in_pieces(rows):
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    model = T.fit([r[1] for r in train], [r[2] for r in train])
    assert model.scores(["you g.r.i.b.b.l.e.r", "you g r i b b l e r", "you gr.ib.bl.er", "fu_zz_wa_ck", "f*u*z*z*w*a*c*k"]).min() >= 0.5
    cut = lambda w: ".".join(w[i : i + 2] for i in range(0, len(w), 2))
    assert model.scores([f"the {cut(a)} and {b}" for a in CALM for b in CALM]).max() < 0.5
    assert T.pieced_words("a.b.c x-y " + "z" * 300_000).tolist() == [1, 2, 3] and len(T.pieced_words("a.b")) == 0


def test_folded_weights_are_the_landmark_sum(rows):
    rng = T.np.random.default_rng(3)
    codes, label = [T.symbols(t) for _, t, _ in rows[:200]], T.np.array([y for _, _, y in rows[:200]], bool)
    weight = T.log_odds(codes, label)
    windows, positive = T.choose(codes, label, T.np.ones(200, bool), weight, rng)
    folded, _, (landmark, alpha) = T.machine(windows, positive, rng)

    def values(window):
        index, w = T.subsequences(window[None])
        out = {}
        for i, x in zip(index[0].tolist(), w[0].tolist()):
            out[i] = out.get(i, 0) + x
        return out

    marks = [values(x) for x in landmark]
    for window in windows[:40]:
        own = values(window)
        by_landmarks = sum(a * sum(x * m.get(i, 0) for i, x in own.items()) for a, m in zip(alpha, marks))
        assert sum(x * float(folded[i]) for i, x in own.items()) == pytest.approx(by_landmarks, rel=1e-3, abs=1e-3)


def test_sample_is_taken_from_labels_that_meet_documents(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(40)], "doc_id long, text string")
    labels = spark.range(60_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    got = T.training_rows(docs, labels, sample=100).collect()
    assert {r.id for r in got} == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5}
