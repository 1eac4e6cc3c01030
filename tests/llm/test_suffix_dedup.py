"""Against a table of all windows."""

import hashlib
import random

from ratingloom.llm import suffix_dedup as S


def brute(rows, length):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        cut = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                cut[s : s + length] = b"\1" * length
        runs = sum(1 for k in range(len(cut)) if cut[k] and (k == 0 or not cut[k - 1]))
        out.append((i, len(b), sum(cut), runs, hashlib.sha256(bytes(x for x, y in zip(b, cut) if not y)).hexdigest()))
    return sorted(out)


def measured(df, **options):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in S.remove_repeats(df, **options).collect())


def test_random_texts(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcd é") for _ in range(900)) for _ in range(6)] + ["xyz " * 120, "a" * 700]
    rows = []
    for i in range(120):
        t = ""
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            x = rng.randrange(len(b))
            t += b[x : x + rng.randint(50, 500)] + "".join(rng.choice("qrst") for _ in range(rng.choice([0, 0, 1, 100])))
        rows.append((i, t))
    rows += [(500, None), (501, ""), (502, base[0]), (502, base[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert measured(df) == brute(rows, 200)
    assert measured(df, length=90, gram=20) == brute(rows, 90)


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in S.op2_suffix_dedup(spark, small).collect())
    assert got == brute(rows, 200)


def test_empty_table_null_ids_and_other_columns(spark):
    long = "".join(map(str, range(200)))
    df = spark.createDataFrame([(None, long, 1), (None, long, 2), (3, None, 3)], "doc_id long, text string, place int")
    assert sorted((r.doc_id is None, r.n_bytes - r.n_removed) for r in S.remove_repeats(df).collect()) == [(False, 0), (True, 0), (True, 0)]
    assert S.remove_repeats(df.limit(0)).count() == 0


def test_long_runs_and_segments(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 1_000)
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    rows = [(1, "a" * 4000), (2, base), (3, base[500:2500] + "x" + base[900:1200]), (4, "xy z" * 700), (5, "b" * 199)]
    assert measured(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 200)


def test_five_megabytes_of_one_character(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, c string").selectExpr("doc_id", "repeat(c, 5000000) AS text")
    got = S.remove_repeats(df).collect()[0]
    assert (got.n_bytes, got.n_removed, got.n_spans, bytes(got.kept)) == (5_000_000, 5_000_000, 1, b"")


def test_names_tell_complements_of_thue_morse_strings_apart():
    import numpy as np

    from ratingloom.llm.naming import Names

    word = b"a"
    while len(word) < 1024:
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    both = word + word.translate(bytes.maketrans(b"ab", b"ba"))
    names = Names(np.frombuffer(both, np.uint8))
    begin = np.array([0, 1024])
    assert len(set(names.of(begin, begin + 1024).tolist())) == 2
