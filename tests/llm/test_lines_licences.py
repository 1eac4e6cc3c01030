"""Against plain Python, and against the queries' SQL."""

import random
import re

import duckdb
import pytest

from ratingloom.llm import licences as L
from ratingloom.llm import line_dedup as D
from ratingloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, small).select(*want.columns).collect()
    text = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert text(got) == text(want.fetchall())


def test_lines_by_hand(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " "]) for _ in range(rng.randint(0, 9)))) for i in range(200)] + [(900, None), (901, "")]
    first, cut = {}, set()
    for i, t in rows:
        lines = (t or "").split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if any(x.strip() for x in w) and first.setdefault(w, (i, k)) != (i, k):
                cut |= {(i, k + j) for j in range(3)}
    want = {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in cut) for i, t in rows}
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_lines string")
    got = D.dedup_lines(docs)
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert D.dedup_lines(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "q\nb\nc"), (1, "a\nb\nc\nd")], "doc_id long, text string")
    # which of the two texts under id 1 is first goes by their hashes
    assert sorted(r.n_removed for r in D.dedup_lines(twice).collect()) in ([0, 0, 0, 3], [0, 0, 3, 3])


def test_licences_by_hand(spark):
    lines = [*L.TEMPLATES.values(), "RELEASED under -- the MIT license", "released under the mitt license", "", "licensed", "nothing of the kind, under the sun", "Licensed under CC BY 4.1."]
    rows = [(i, t) for i, t in enumerate(lines)] + [(100, "first\n" + lines[1] + "\nlast"), (101, None), (None, lines[15])]
    header = L.PARAGRAPHS["GPL-3.0-Header"].split()
    wrapped = "\n".join(" * " + " ".join(header[i : i + 8]) for i in range(0, len(header), 8))
    whole = "\n\n".join(L.PARAGRAPHS[n] for n in ("MIT-Permission", "MIT-Notice", "MIT-Disclaimer"))
    rows += [(102, f"/* a file\n\n{wrapped}\n \n\n code */"), (103, wrapped), (104, whole)]
    want = set()
    for i, t in rows:
        lines, parts = (t or "").split("\n"), re.split(L.BLANK, t or "")
        units = [("text", 0, t or "")] * (len(lines) > 1) + [("line", k, u) for k, u in enumerate(lines, 1)] + [("paragraph", k, u) for k, u in enumerate(parts, 1) if len(parts) > 1 and "\n" in u]
        for kind, k, u in units:
            own = set(L.template_bigrams(u))
            scored = sorted((-2 * len(own & set(b)) / (len(own) + len(b)), name) for name, b in ((n, L.template_bigrams(x)) for n, x in L.TEMPLATES.items())) if own else []
            if scored and -scored[0][0] >= L.THRESHOLD:
                want.add((i, kind, k, scored[0][1]))
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, line string, id int")
    got = {(r.doc_id, r.unit, r.line, r.licence) for r in L.scan_licences(docs).collect()}
    assert got == want and len(got) >= len(L.TEMPLATES) + 2
    assert {(102, "paragraph", 2, "GPL-3.0-Header"), (103, "text", 0, "GPL-3.0-Header"), (104, "line", 3, "MIT-Notice")} <= got
    assert L.scan_licences(docs.limit(0)).count() == 0


def test_lines_with_clashing_names(spark):
    names = ["_id", "_print", "id", "print", "row", "cut", "_cut", "_lines", "_null", "_slot"]
    rows = [(1, "a\nb\nc", *range(10)), (2, "x\na\nb\nc", *range(10)), (3, None, *range(10))]
    got = D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)))
    assert got.columns == ["doc_id", "text", *names, "n_lines", "n_removed"]
    assert {(r.doc_id, r.text, r._id, r.cut) for r in got.collect()} == {(1, "a\nb\nc", 0, 5), (2, "x", 0, 5), (3, None, 0, 5)}


@pytest.mark.parametrize("mark", ["# ", "// ", " * ", "-- ", ";; "])
def test_headers_as_they_stand_in_files(spark, mark):
    """Each paragraph's header in a comment of a file of 200 lines, paragraphs divided by lines of comment marks alone."""
    import textwrap

    rows = []
    for i, (name, text) in enumerate(sorted(L.PARAGRAPHS.items())):
        head = [mark + x for x in textwrap.wrap(text, 66)]
        above = [mark + "Copyright 2020 The Authors", mark.rstrip()]
        code = [f"let value_{k} = compute({k}) + {k * 7}" for k in range(200 - len(head))]
        rows.append((i, "\n".join([*above, *head, mark.rstrip(), "", *code])))
    got = {(r.doc_id, r.licence) for r in L.scan_licences(spark.createDataFrame(rows, "doc_id int, text string")).filter("unit = 'paragraph' OR unit = 'line'").collect()}
    assert {(i, name) for i, (name, text) in enumerate(sorted(L.PARAGRAPHS.items())) if len(text) > 66} <= got


def test_tags(spark):
    rows = [(i, f"#!/bin/sh\n# SPDX-License-Identifier: {name}\necho {i}") for i, name in enumerate(L.TAGGED)] + [(100, "/* SPDX-License-Identifier: Nobody */\nx"), (101, "// SPDX-License-Identifier: MIT */")]
    got = {(r.doc_id, r.licence) for r in L.scan_licences(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {(i, f"Tag-{name}") for i, name in enumerate(L.TAGGED)} | {(101, "Tag-MIT")}
