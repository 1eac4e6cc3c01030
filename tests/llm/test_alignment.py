"""Against whole texts encoded by the two libraries and aligned by sets of ends."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratingloom.llm import alignment as A
from ratingloom.llm.bpe import byte_alphabet


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def brute(libraries, texts):
    """Per text (n_a, n_b, groups text, links), then the counts of all pairs."""
    a, b = libraries
    alphabet = byte_alphabet()
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ba = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not text or b"".join(ba) != raw or b"".join(bb) != raw:
            out.append((0, 0, "", []))
            continue
        ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))]
        ea, eb = ends(ba), ends(bb)
        common = sorted(set(ea) & set(eb))
        groups, links, i, j = [], [], 0, 0
        for e in common:
            ti, tj = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, ia[i:ti])) + "|" + ",".join(map(str, ib[j:tj])))
            links.append((ia[ti - 1], ib[tj - 1]))
            i, j = ti, tj
        out.append((len(ia), len(ib), ";".join(groups), links))
    return out, Counter(x for *_, links in out for x in links)


def odd_texts(rng, n):
    parts = ["the", "word", " ", "  ", "\n", "\t", "é", "　", "▁", "<|endoftext|>", "<s>", "</s>", "x" * 9, "1234", "'s", "日本", "\U0001f600", "é", "\x00", " ", ".", ", ", " a", "b "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_query_against_brute_force(spark, tmp_path, libraries):
    rng = random.Random(11)
    texts = [None, "", " ", *odd_texts(rng, 400), *[" ".join(rng.choice(["alpha", "betagamma", "Straße", "naïve", "x,y"]) for _ in range(60)) for _ in range(20)]]
    texts += [texts[-1], "long " * 30_000, "no-space" * 5_000]
    rows = [(i if i else None, t, 7) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, links int").write.parquet(f"{tmp_path}/documents.parquet")
    short = [t if not t or len(t) < 20_000 else None for t in texts]
    want, _ = brute(libraries, short)
    got = {r.doc_id: r for r in A.op11_alignment(spark, str(tmp_path)).collect()}
    # the long texts by segments that are checked above: their counts join those of all others
    whole = A.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    pairs = whole.own.pairs
    for k, text in enumerate(texts):
        if text and len(text) >= 20_000:
            (found,) = whole.new_segments([text])
            numbers = A.np.frombuffer(found[4], "<i4")
            want[k] = (found[0], found[1], found[3], [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs[numbers]])
    counts = Counter(x for *_, links in want for x in links)
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    assert len(got) == len(texts)
    for (i, _, _), (na, nb, groups, links) in zip(rows, want):
        r = got[i]
        expect = (na, nb, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert tuple(r)[1:] == expect, (i, texts[i or 0])


def test_general_form(spark):
    docs = spark.createDataFrame([("x-1", "hello there", 5), ("x-1", "hello there", 5), (None, None, 6)], "name string, body string, n_a int")
    aligned = A.align_documents(docs, "body").cache()
    rows = sorted(aligned.drop("links").collect(), key=str)
    assert aligned.columns == ["name", "body", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    assert rows[0] == rows[1] and rows[1].groups.count("|") == rows[1].n_groups and rows[2].groups == ""
    table = {(r.id_a, r.id_b): (r.n, r.best) for r in A.pair_counts(aligned).collect()}
    assert table and all(n == 2 for n, _ in table.values())
    empty = A.align_documents(docs.limit(0), "body")
    assert A.with_counts(empty, A.pair_counts(empty)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60), min_size=1), st.sets(st.integers(1, 60), min_size=1), st.lists(st.integers(61, 99)))
def test_groups_by_sets(a, b, tail):
    end = 100
    a, b = sorted({*a, *tail, end}), sorted({*b, *tail, end})
    assert A.aligned_groups(a, b) == [(a.index(e) + 1, b.index(e) + 1) for e in sorted(set(a) & set(b))]


def test_stretch_probes():
    for n in range(70):
        a, b = list(range(100)), [*range(n), *range(200, 300)]
        assert A.stretch(a, 0, b, 0) == n
        assert A.stretch(a, 0, a[:n], 0) == n


def test_pairs_are_bounded():
    own = A.vocabularies(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    assert 0 < len(own.pairs) <= sum(map(len, own.bytes_a.values())) + sum(map(len, own.bytes_b))


def test_segments_are_encoded_many_at_a_time(monkeypatch):
    """What a segment has does not depend on those it is encoded with; one that is not spelt spoils no other."""
    own = A.Aligner(A.default_vocabulary(), A.default_pieces())
    texts = [f"w{i}ord{i * i}" for i in range(200)] + ["don't", "'s", "１２", "é.", "<s>", "▁a", "a▁", "x\x00y", "ﬁ", "", "a\tb ", "a  b", "\n", "z" * 500]
    alone = {t: own.new_segments([t])[0] for t in texts}
    assert A.WRONG in alone.values() and own.new_segments([]) == []
    encoded, walk = [], A.aligned_groups
    monkeypatch.setattr(A, "aligned_groups", lambda a, b: encoded.append(len(a)) or walk(a, b))
    assert own.new_segments(texts[:200]) == [alone[t] for t in texts[:200]]
    assert len(encoded) == 1
    assert own.new_segments(texts) == [alone[t] for t in texts]
