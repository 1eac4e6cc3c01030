import pytest
from pyspark.sql import functions as F

from ratingloom.functions import scalars as S
from ratingloom.sources import pages

PAGE = """<script>data([ ['Game', '2022 Part 1','2022 Part 2'],
 [, 1500,null],
 ['', 1512,null],
 ['',null,1490]
]);</script>
<h3>2022 - Part 1 /// E1 = 1500 /// k = 32</h3>
<table><tr><th>Date</th><th>Event</th><th>Name</th><th>Result</th><th>Opponent Rating</th><th>New Rating</th>
<tr><td>15/02/2022</td><td>Open - Rd 2</td><td>\tSome  One</td><td>1</td><td>1500\t</td><td>1516</td></tr>
<tr><td>91/07/2022</td><td>Correction</td><td>NA</td><td>NA</td><td>NA</td><td>1512</td></tr></table></table>
<h3>2022 - Part 2 /// W1 = 1512 /// k = 24</h3>
<table><tr><td>07/09/2022</td><td>League</td><td>Two</td><td>0.5</td><td>1600</td><td>1515</td></tr></table>
<!-- <h2>Old</h2><a href="x.html">gone</a> --><h2>Links</h2><a class="c" href='y.html'> <b>kept</b>
 here</a>
"""


@pytest.fixture(scope="module")
def page(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    (folder / "A_B.html").write_text(PAGE)
    return pages.read_pages(spark, str(folder))


def test_periods_and_ledger(page):
    got = [(r.player, r.period, r.list_type, r.opening, r.k) for r in pages.extract_periods(page).orderBy("pos").collect()]
    assert got == [("A B", "2022P1", "E", 1500, 32), ("A B", "2022P2", "W", 1512, 24)]
    rows = [(r.period, r.pos, str(r.date), r.event, r["round"], r.opponent, None if r.result is None else float(r.result), r.opp_rating, r.new_rating) for r in pages.extract_ledger(page).orderBy("period", "pos").collect()]
    assert rows == [
        ("2022P1", 1, "2022-02-15", "Open", 2, "Some One", 1.0, 1500, 1516),
        ("2022P1", 2, "None", "Correction", None, None, None, None, 1512),
        ("2022P2", 1, "2022-09-07", "League", None, "Two", 0.5, 1600, 1515),
    ]


def test_chart(page):
    got = [(r.idx, r.col, r.value) for r in pages.extract_chart(page).orderBy("idx", "col").collect()]
    assert got == [(0, 0, 1500), (0, 1, None), (1, 0, 1512), (1, 1, None), (2, 0, None), (2, 1, 1490)]


def test_links(page):
    assert [(r.href, r.text, r.heading) for r in pages.extract_links(page).orderBy("nr").collect()] == [("x.html", "gone", "Old"), ("y.html", "kept here", "Links")]
    assert [r.href for r in pages.extract_links(page, comments=False).collect()] == ["y.html"]


def test_points(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Name,Date,ELO_smooth\nb,2022-01-02,1500.5\nb,2022-01-01, \na,bad,x\n")
    got = [(r.name, str(r.date), str(r.elo_smooth), r.src_pos) for r in pages.read_points(spark, str(tmp_path / "p.csv")).orderBy("name", "src_pos").collect()]
    assert got == [("a", "None", "nan", 1), ("b", "2022-01-02", "1500.5", 1), ("b", "2022-01-01", "0.0", 2)]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(S.round_half_up(F.lit(-2.5), 0)) == -2 and one(S.round_half_up(F.lit(1.005), 2)) == 1.0
    assert one(S.zero_pad(F.lit("123"), 2)) == "123" and one(S.zero_pad(F.lit("7"), 2)) == "07"
    assert one(S.period_label(F.lit("2022 - Part 1"))) == one(S.period_label(F.lit("2022 Part 1"))) == "2022P1"
    assert [one(S.event_round(F.lit(x))) for x in ("X - Rd 3", "X Rd 4", "XRd5", "X")] == [3, 4, 5, None]
    assert one(S.hover_label(F.lit("n"), F.lit(1234.4))) == "n: 1234"
    assert one(S.first_non_empty(F.lit(""), F.lit(None).cast("string"), F.lit("c"))) == "c"
    assert one(S.opacity(F.lit(0.0))) == 0 and one(S.opacity(F.lit(None).cast("double"))) == 1
    assert one(S.utc_day(F.lit(86_400_000).cast("long"))) == "1970-01-02"
