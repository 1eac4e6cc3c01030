import pytest
from pyspark.sql import functions as F

from ratingloom.operators import audits, bands, ratings

# Opening, and (score, opponent's rating, published rating) of one player's four periods, k = 24.
PUBLISHED = {
    "2022P1": (1877, [(1, 1749, 1885), (1, 1134, 1887), (0, 1807, 1873), (1, 1709, 1879), (1, 1134, 1882), (1, 1704, 1888), (1, 1769, 1897), (0, 1634, 1877), (1, 1487, 1880)]),
    "2022P2": (1880, [(0, 1605, 1860), (1, 1751, 1868), (1, 1510, 1870), (0.5, 1962, 1873), (0.5, 1848, 1872), (1, 1600, 1876), (1, 1746, 1884)]),
    "2023P1": (1884, [(0, 1605, 1864), (1, 1810, 1873), (1, 1679, 1879), (1, 1823, 1889), (0, 2220, 1886), (1, 1604, 1890), (1, 1656, 1895)]),
    "2023P2": (1895, [(0, 1643, 1876), (1, 1624, 1880), (1, 1679, 1885), (0, 1733, 1868), (1, 1679, 1873), (0.5, 1773, 1869), (1, 1532, 1872), (0.5, 1974, 1875)]),
}


@pytest.fixture(scope="module")
def games(spark):
    rows = [("p", period, i, float(s), o, opening, 24, r) for period, (opening, own) in PUBLISHED.items() for i, (s, o, r) in enumerate(own)]
    return spark.createDataFrame(rows, "player string, period string, pos int, score double, opponent int, opening int, k int, published long")


def test_published_ratings(games):
    rated = ratings.running_rating(games, ["player", "period"], ["pos"], "score", "opponent", "opening", "k")
    assert audits.rating_differences(rated, "new_rating", "published", 1).count() == 0
    assert rated.filter("new_rating = published").count() >= 29


def test_order_is_of_no_matter(games):
    a = ratings.closing_rating(games, ["player", "period"], "score", "opponent", "opening", "k")
    b = ratings.closing_rating(games.orderBy(F.desc("opponent")), ["player", "period"], "score", "opponent", "opening", "k")
    assert sorted(a.collect()) == sorted(b.collect())
    assert {r.period: r.closing for r in a.collect()} == {"2022P1": 1880, "2022P2": 1884, "2023P1": 1895, "2023P2": 1875}


def test_carry_and_chain(games):
    closed = ratings.closing_rating(games, ["player", "period"], "score", "opponent", "opening", "k")
    carried = {r.period: r.carried for r in ratings.carried_opening(closed, "player", "period").collect()}
    assert carried == {"2022P1": None, "2022P2": 1880, "2023P1": 1884, "2023P2": 1895}
    first = games.withColumn("opening", F.lit(1877))
    chained = {r.period: (r.opening, r.closing) for r in ratings.chained_closing(first, "player", "period", "score", "opponent", "opening", "k").collect()}
    assert chained["2022P1"] == (1877, 1880) and chained["2022P2"] == (1880, 1884)
    adjusted = ratings.with_adjustments(closed, games.sparkSession.createDataFrame([("p", "2023P2", 1900)], "player string, period string, adjusted long"), ["player", "period"])
    assert {r.period: r.closing for r in adjusted.collect()}["2023P2"] == 1900


def test_expectation_is_held(spark):
    got = spark.range(1).select(ratings.expected_score(F.lit(1258), F.lit(2004)).alias("low"), ratings.expected_score(F.lit(2400), F.lit(1000)).alias("high"), ratings.expected_score(F.lit(1500), F.lit(1500)).alias("even")).first()
    assert tuple(got) == (0.1, 0.9, 0.5)


def test_bands_at_their_edges(spark):
    values = [1599.9, 1600.0, 1800.0, 2000.0, 2200.0, 2200.1, float("nan"), None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, r double").select("i", bands.band(F.col("r")).alias("b"))
    assert [r.b for r in rows.orderBy("i").collect()] == ["<1600", "1600-1800", "1800-2000", "2000-2200", "2000-2200", ">2200", "<1600", "<1600"]


def test_members_cover_all_keys_once(spark):
    rows = spark.createDataFrame([("b", "<1600"), ("A", "<1600"), ("c", ">2200")], "name string, band string")
    got = {r.band: r.members for r in bands.band_members(rows, "name").collect()}
    assert got == {">2200": ["c"], "2000-2200": [], "1800-2000": [], "1600-1800": [], "<1600": ["A", "b"]}


def test_places_in_bands(spark):
    rows = spark.createDataFrame([("b", "<1600"), ("A", "<1600"), ("c", ">2200"), ("b", "<1600")], "name string, band string")
    got = sorted(map(tuple, bands.band_places(rows, "name").collect()))
    assert got == [("<1600", "A", 0), ("<1600", "b", 1), ("<1600", "b", 2), (">2200", "c", 0)]
    assert bands.band_places(rows.limit(0), "name").count() == 0


def test_chain_with_repeated_and_unscored_games(spark):
    games = [("p", "1", 1.0, 1500.0)] * 3 + [("p", "1", None, 1500.0), ("p", "2", 0.0, 1400.0), ("p", "2", 0.0, 1400.0), ("q", "2", None, None)]
    rows = spark.createDataFrame(games, "player string, period string, score double, opponent double").withColumn("opening", F.lit(1500)).withColumn("k", F.lit(24))
    got = sorted(map(tuple, ratings.chained_closing(rows, "player", "period", "score", "opponent", "opening", "k").collect()))
    expected = 1 / (1 + 10 ** ((1400 - 1536) / 400))
    assert got == [("p", "1", 1500, 1536), ("p", "2", 1536, int(1536 - 48 * expected + 0.5)), ("q", "2", 1500, 1500)]


def test_palette_and_collation(spark):
    names = spark.createDataFrame([("b",), ("á",), ("A",), ("C",), ("b",)], "n string")
    got = bands.palette_index(names, "n", 2).orderBy("place").collect()
    assert [(r.n, r.place, r.colour_no) for r in got] == [("A", 0, 0), ("b", 1, 1), ("C", 2, 0), ("á", 3, 1)]
    assert [r.n for r in bands.collated(names.distinct(), "n").collect()] == ["A", "á", "b", "C"]


def test_audits(spark):
    periods = spark.createDataFrame([("p", 1, 1500, 1510), ("p", 2, 1510, 1520), ("p", 3, 1519, 1530)], "player string, period int, opening int, closing int")
    assert [r.period for r in audits.opening_breaks(periods, "player", "period", "opening", "closing").collect()] == [3]
    games = spark.createDataFrame([("a", "b", "d1", 1.0, 1400, 1), ("b", "a", "d1", 0.0, 1500, 1), ("a", "c", "d2", 1.0, 1400, 1)], "player string, opponent string, day string, score double, opp_rating int, period int")
    assert [r.total for r in audits.mirrored(games, "player", "opponent", "day", "score").collect()] == [1.0, 1.0]
    assert audits.unmirrored(games, spark.createDataFrame([("c",), ("a",)], "player string"), "player", "opponent", "day").count() == 1
    listed = spark.createDataFrame([("b", 1, 1401), ("a", 1, 1500)], "player string, period int, opening int")
    assert [r.opponent for r in audits.list_mismatches(games, listed).collect()] == ["b"]
    one, two = spark.createDataFrame([(1, 5), (2, 6)], "i int, v int"), spark.createDataFrame([(1, 5), (2, 7), (3, 8)], "i int, v int")
    assert sorted(r.i for r in audits.chart_differences(one, two, ["i"], "v").collect()) == [2, 3]
