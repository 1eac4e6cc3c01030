"""Audits of game tables: recomputed ratings, openings, mirrored and repeated games, dates, charts."""

from __future__ import annotations

import math
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.operators.prefix import running
from ratingloom.sources.shared import forget, saved


def rating_differences(rated: DataFrame, computed: str, published: str, tolerance: int = 1) -> DataFrame:
    """Rows whose recomputed rating is off by more than the tolerance."""
    return rated.withColumn("difference", F.col(computed) - F.col(published)).filter(F.abs("difference") > tolerance)


def opening_breaks(periods: DataFrame, player: str, period: str, opening: str, closing: str) -> DataFrame:
    """Periods whose opening is not the closing before."""
    before = F.lag(closing).over(Window.partitionBy(player).orderBy(period))
    return periods.withColumn("previous_closing", before).filter(F.col("previous_closing") != F.col(opening))


def list_mismatches(games: DataFrame, periods: DataFrame, opponent: str = "opponent", rating: str = "opp_rating") -> DataFrame:
    """Games whose opponent is listed for the period with another opening than the game says."""
    listed = periods.select(F.col("player").alias(opponent), "period", F.col("opening").alias("listed"))
    return games.join(listed, [opponent, "period"]).filter(F.col("listed") != F.col(rating))


def mirrored(games: DataFrame, player: str, opponent: str, when: str, score: str) -> DataFrame:
    """Games met by the opponent's own row on the same date, with the sum of both scores."""
    other = games.select(F.col(player).alias(opponent), F.col(opponent).alias(player), when, F.col(score).alias("other_score"))
    return games.join(other, [player, opponent, when]).withColumn("total", F.col(score) + F.col("other_score"))


def unmirrored(games: DataFrame, listed: DataFrame, player: str, opponent: str, when: str) -> DataFrame:
    """Games against listed players without a row of theirs."""
    own = games.join(listed.select(F.col(player).alias(opponent)).distinct(), opponent, "left_semi")
    other = games.select(F.col(player).alias(opponent), F.col(opponent).alias(player), when)
    return own.join(other, [player, opponent, when], "left_anti")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def date_faults(games: DataFrame, player: str, pos: str, raw: str, day: str, first: str, last: str) -> DataFrame:
    """Unparsable dates, dates outside the period, and dates before the one above."""
    above = F.lag(day).over(Window.partitionBy(player).orderBy(pos))
    fault = F.when(F.col(day).isNull() & F.col(raw).isNotNull(), "unparsable").when(~F.col(day).between(F.col(first), F.col(last)), "outside").when(F.col(day) < above, "out of order")
    return games.withColumn("fault", fault).filter(F.col("fault").isNotNull())


def chart_differences(ledger: DataFrame, chart: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values of two copies that differ, or stand in one alone."""
    both = ledger.select(*keys, F.col(value).alias("in_ledger")).join(chart.select(*keys, F.col(value).alias("in_chart")), keys, "full_outer")
    return both.filter(~F.col("in_ledger").eqNullSafe(F.col("in_chart")))


# Games that do not meet exactly -------------------------------------------------------------------

GRAM = 3
ALIKE = 0.6


def grams(name: Column, q: int = GRAM) -> Column:
    """The distinct q-grams of a name in lower case, padded by a blank on either side."""
    text = F.concat(F.lit(" "), F.lower(name), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - q + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(q))))


#: Grams that names meet by at most, the most keys of a name beyond which it meets by fewer, the pairs a key's row may
#: bring before more grams are tried, one in how many keys is counted for that, and rows broadcast at most.
MEET_BY, MOST_KEYS, PAIRS_A_ROW, COUNTED, BROADCAST_ROWS = 3, 400, 16, 64, 100_000


def _meeting(sizes: list[int], least: float, by: int) -> list[tuple[int, int, int, bool]]:
    """n, level, prefix and own: by how many grams names of n grams meet others, and among how many of their rarest.

    Names of n and m grams at ``least`` share need(n, m) grams, and the first ``level`` of these are among the first
    n - need(n, m) + level of both.  Two sizes meet at the lesser of their own levels, so a size has rows for its own
    level and, as a guest, for lower ones of sizes that it may be alike to.
    """
    need = lambda n, m: max(1, math.ceil(least * (n + m) / 2 - 1e-9))
    partners = {n: [m for m in sizes if need(n, m) <= min(n, m)] for n in sizes}
    own = {}
    for n in sizes:
        t = min(need(n, m) for m in partners[n])
        own[n] = max([j for j in range(1, min(by, t) + 1) if math.comb(n - t + j, j) <= MOST_KEYS], default=1)
    out = []
    for n in sizes:
        for level in sorted({min(own[n], own[m]) for m in partners[n]}):
            t = min(need(n, m) for m in partners[n] if min(own[n], own[m]) == level)
            out.append((n, level, n - t + level, level == own[n]))
    return out


def _keys(level: Column, prefix: Column) -> Column:
    """Structs of key and the last gram's place: all ways to take ``level`` grams, in order, of the first ``prefix``."""
    gram, many = (lambda i: F.element_at("grams", i)), (lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>")))
    key = lambda last, *chosen: F.struct(F.xxhash64(*[gram(i) for i in chosen]).alias("key"), last.alias("place"))
    one = F.transform(many(F.lit(1), prefix), lambda i: key(i, i))
    two = F.flatten(F.transform(many(F.lit(2), prefix), lambda j: F.transform(F.sequence(F.lit(1), j - 1), lambda i: key(j, i, j))))
    three = F.flatten(F.flatten(F.transform(many(F.lit(3), prefix), lambda k: F.transform(F.sequence(F.lit(2), k - 1), lambda j: F.transform(F.sequence(F.lit(1), j - 1), lambda i: key(k, i, j, k))))))
    return F.when(level == 1, one).when(level == 2, two).otherwise(three)


def similar_names(names: DataFrame, name: str, least: float = ALIKE) -> DataFrame:
    """name, other and alike: pairs of different names (both ways) whose q-grams have a Dice coefficient of ``least``.

    Names meet in keys of one, two or three of their rarest q-grams (``_meeting``); more names meet by more grams, so
    that the pairs that meet grow with the rows of keys and not with the square of the names.  The pairs of a key
    that are left by places and marks (bits of grams) are compared in full where they meet.
    """
    spark = names.sparkSession
    sets = saved(names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct().withColumn("grams", grams(F.col("name"))), "names")
    each = sets.select("name", F.explode("grams").alias("gram"))
    rarity = saved(each.groupBy("gram").agg(F.count(F.lit(1)).alias("often")), "rarity")
    if rarity.count() <= BROADCAST_ROWS:
        rarity = F.broadcast(rarity)
    by_rarity = each.join(rarity, "gram").groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("often", "gram"))), lambda g: g["gram"]).alias("grams"))
    marks = F.aggregate("grams", F.lit(0).cast("long"), lambda bits, g: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(g), F.lit(63)).cast("int"))))
    ranked = saved(by_rarity.select("name", "grams", F.size("grams").alias("n"), marks.alias("marks")), "name-grams")
    sizes = sorted(r.n for r in ranked.select("n").distinct().collect())  # as many as lengths of names
    meeting, posts, cost = [], None, None
    for by in range(1, MEET_BY + 1):
        trial = _meeting(sizes, least, by)
        if trial == meeting or not sizes:
            break
        plan = F.broadcast(spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, trial))} AS t(n, level, prefix, own)"))
        dealt = ranked.join(plan, "n").select("name", "n", "marks", "level", "own", F.explode(_keys(F.col("level"), F.col("prefix"))).alias("k"))
        dealt = dealt.select("level", "own", "n", "name", "k.place", "k.key", "marks")
        # a few of the keys, with all their rows, tell how many pairs there are
        met = dealt.filter(F.pmod("key", F.lit(COUNTED)) == 0) if by > 1 else dealt
        counted = met.groupBy("level", "key").agg(F.count(F.lit(1)).alias("c")).agg(F.sum("c").alias("rows"), F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).first()
        rows, pairs = ((x or 0) * (COUNTED if by > 1 else 1) for x in counted)
        if cost is not None and rows + pairs / PAIRS_A_ROW >= cost:
            break
        meeting, posts, cost = trial, dealt, rows + pairs / PAIRS_A_ROW
        if pairs <= PAIRS_A_ROW * rows:
            break
    if posts is None:
        return spark.createDataFrame([], "name string, other string, alike double")
    guests = not all(own for *_, own in meeting)
    once = F.col("x.name") < F.col("y.name")
    if guests:
        once = once | (~F.col("y.own") & (F.col("x.name") != F.col("y.name")))
    # in common are no more than these, where the grams of the key are the first ones in common
    left = lambda s: F.col(f"{s}.level") + F.col(f"{s}.n") - F.col(f"{s}.place")
    shared = lambda s, t: F.col(f"{s}.n") - F.bit_count(F.col(f"{s}.marks").bitwiseAND(F.bitwise_not(F.col(f"{t}.marks"))))
    need = F.ceil(F.lit(least) * (F.col("x.n") + F.col("y.n")) / 2 - 1e-9)
    fits = once & (F.least(left("x"), left("y"), shared("x", "y"), shared("y", "x")) >= need)
    same = (F.col("x.level") == F.col("y.level")) & (F.col("x.key") == F.col("y.key"))
    met = (posts.filter("own") if guests else posts).alias("x").join(posts.alias("y"), same & fits)
    # exploded, as a filter on it alone would go into the join's condition, where it is made for every pair
    alike = 2.0 * F.size(F.array_intersect(grams(F.col("x.name")), grams(F.col("y.name")))) / (F.col("x.n") + F.col("y.n"))
    pairs = met.select(F.least("x.name", "y.name").alias("name"), F.greatest("x.name", "y.name").alias("other"), F.explode_outer(F.array(alike)).alias("alike")).filter(F.col("alike") >= least).distinct()
    pairs = saved(pairs, "similar")
    return pairs.unionByName(pairs.select(F.col("other").alias("name"), F.col("name").alias("other"), "alike"))


def best_pairs(pairs: DataFrame, left: str, right: str, order: list[Column]) -> DataFrame:
    """One-to-one pairs: the best by ``order`` (which tells all pairs apart), then the best of what is left without its
    two, and so on.  Each round takes every pair that is the best of both its sides, at least one a component."""
    names = pairs.columns
    left_over = saved(pairs, "pairs")
    taken = None
    while not left_over.isEmpty():
        ranked = left_over.withColumn("_l", F.row_number().over(Window.partitionBy(left).orderBy(*order))).withColumn("_r", F.row_number().over(Window.partitionBy(right).orderBy(*order)))
        best = saved(ranked.filter("_l = 1 AND _r = 1").select(*names), "best-pairs")
        taken = best if taken is None else taken.unionByName(best)
        rest = saved(left_over.join(best.select(left), left, "left_anti").join(best.select(right), right, "left_anti"), "pairs")
        forget(left_over)
        left_over = rest
    return left_over if taken is None else taken


def day_distance(a: Column, b: Column, band: int) -> Column:
    """Days between two dates where they are at most ``band``, ``band`` + 1 where only the year differs, else null."""
    apart = F.abs(F.datediff(a, b))
    return F.when(apart <= band, apart).when((F.month(a) == F.month(b)) & (F.dayofmonth(a) == F.dayofmonth(b)), F.lit(band + 1))


def nearly_mirrored(games: DataFrame, id_col: str, player: str, opponent: str, day: str, score: str, band: int = 3, least: float = ALIKE, total: float = 1.0) -> DataFrame:
    """id, other_id, alike, days and total: games without a mirrored row, each with the game most like one.

    Two games may be one if each player's name is like the other's opponent's (Dice of q-grams), their dates are
    at most ``band`` days apart or differ in the year alone, and their scores add up to ``total``.  Best first:
    names more alike (the lesser of the two, then the sum), fewer days, smaller ids; each game is in one pair at
    most.  id_col is unique; the smaller id comes first.
    """
    own = games.select(F.col(id_col).alias("id"), F.col(player).alias("player"), F.col(opponent).alias("opponent"), F.col(day).alias("day"), F.col(score).alias("score")).dropna(subset=["player", "opponent", "day"])
    # the rows of two players on a day meet once; who is the player of a row is kept as two marks
    sides = own.select("id", F.least("player", "opponent").alias("one"), F.greatest("player", "opponent").alias("two"), (F.col("player") <= F.col("opponent")).alias("up"), (F.col("player") >= F.col("opponent")).alias("down"), "day", "score")
    there = Window.partitionBy("one", "two", "day")
    kept = sides.select("*", (F.max("up").over(there) & F.max("down").over(there)).alias("met")).filter("NOT met AND score IS NOT NULL")
    alone = saved(kept.select("id", F.when(F.col("up"), F.col("one")).otherwise(F.col("two")).alias("player"), F.when(F.col("up"), F.col("two")).otherwise(F.col("one")).alias("opponent"), "day", "score"), "alone")
    names = alone.select(F.col("player").alias("name")).union(alone.select("opponent"))
    similar = similar_names(names, "name", least).filter(F.col("other") < F.col("name"))
    # two games meet at the lesser of each two names: a game is dealt to its names and to lesser ones that are like them
    lesser = saved(similar.groupBy("name").agg(F.collect_list(F.struct(F.col("other").alias("key"), "alike", F.lit(False).alias("same"))).alias("lesser")), "lesser-names")
    few = similar.count() <= BROADCAST_ROWS
    dealt = alone
    for c in ("player", "opponent"):
        of = lesser.select(F.col("name").alias(c), "lesser")
        itself = F.array(F.struct(F.col(c).alias("key"), F.lit(1.0).alias("alike"), F.lit(True).alias("same")))
        every = F.when(F.col("lesser").isNull(), itself).otherwise(F.concat(itself, F.col("lesser")))
        dealt = dealt.join(F.broadcast(of) if few else of, c, "left").withColumn(f"_{c}", F.explode(every)).drop("lesser")
    mine, its = F.col("_player"), F.col("_opponent")
    up = mine["key"] <= its["key"]
    side = dealt.select("id", "day", "score", F.least(mine["key"], its["key"]).alias("one"), F.greatest(mine["key"], its["key"]).alias("two"), up.alias("up"), mine["alike"].alias("a"), mine["same"].alias("p"), its["alike"].alias("b"), its["same"].alias("o"))
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    across = ((x("one") == x("two")) | (x("up") != y("up"))) & (x("p") | y("o")) & (x("o") | y("p"))
    met = side.alias("x").join(side.alias("y"), (x("one") == y("one")) & (x("two") == y("two")) & across & (x("id") < y("id")))
    a, b = F.least(x("a"), y("b")), F.least(x("b"), y("a"))
    scored = met.select(x("id").alias("id"), y("id").alias("other_id"), F.least(a, b).alias("alike"), (a + b).alias("both"), day_distance(x("day"), y("day"), band).alias("days"), (x("score") + y("score")).alias("total"))
    pairs = scored.filter(F.col("days").isNotNull() & (F.col("total") == total))
    # a game may be on either side, so both ends take part in both rankings
    both_ways = pairs.unionByName(pairs.select(F.col("other_id").alias("id"), F.col("id").alias("other_id"), "alike", "both", "days", "total"))
    order = [F.desc("alike"), F.desc("both"), F.asc("days"), F.least("id", "other_id").asc(), F.greatest("id", "other_id").asc()]
    return best_pairs(both_ways, "id", "other_id", order).filter(F.col("id") < F.col("other_id")).select("id", "other_id", "alike", "days", "total")


# Rows out of order --------------------------------------------------------------------------------


def _in_order(values: list) -> list[bool]:
    """Which of the values are in the longest run that never falls: by piles, the last row of the greatest length
    and before each the last earlier row of one less."""
    tops, at, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_right(tops, v)
        before.append(at[k - 1] if k else -1)
        tops[k : k + 1] = [v]
        at[k : k + 1] = [i]
    kept, i = [False] * len(values), at[-1] if at else -1
    while i >= 0:
        kept[i] = True
        i = before[i]
    return kept


def order_faults(rows: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """Rows of ``rows`` that are really out of order: outside the longest subsequence of the key's rows, by ``pos``
    (unique in a key), in which ``value`` never falls.  Null values take no part.

    Of several longest ones that with the last possible end counts, and before each of its rows the last earlier
    row that a longest one can have there.  A row that no earlier one exceeds and no later one undercuts is in
    every such subsequence and cuts the key's rows in two; running extremes, of keys of any size, find these
    rows, and only the stretches between them are searched, each by patience piles.
    """
    names = rows.columns
    known = rows.filter(F.col(value).isNotNull())
    high = running(known, [key], [pos], {"_high": ("max", F.col(value))}, own=False)
    low = running(high, [key], [pos], {"_low": ("min", F.col(value))}, backward=True, own=False)
    cuts = F.coalesce(F.col("_high") <= F.col(value), F.lit(True)) & F.coalesce(F.col("_low") >= F.col(value), F.lit(True))
    stretch = running(low.withColumn("_cuts", F.when(cuts, 1).otherwise(0)), [key], [pos], {"_stretch": ("sum", F.col("_cuts"))}).filter("_cuts = 0")
    listed = stretch.groupBy(key, "_stretch").agg(F.array_sort(F.collect_list(F.struct(pos, F.col(value).alias("_value"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")))).alias("_rows"))

    @F.pandas_udf("array<boolean>")
    def kept(values: pd.Series) -> pd.Series:
        return values.map(lambda v: _in_order(list(v)))

    marked = listed.withColumn("_kept", kept(F.transform("_rows", lambda r: r["_value"])))
    each = marked.select(F.inline(F.arrays_zip(F.transform("_rows", lambda r: r["_row"]).alias("r"), F.col("_kept").alias("k"))))
    return each.filter("not k").select("r.*")


# Copied blocks ------------------------------------------------------------------------------------


def copied_blocks(games: DataFrame, player: str, period_no: str, pos: str, what: list[str], least: int = 2) -> DataFrame:
    """player, period_no, first_pos, from_pos and n: maximal runs of a period's rows that repeat, row by row, rows of
    the period before (``period_no`` one less), ``least`` rows or more.

    Rows equal in ``what`` (null equals null) and adjacent in both periods keep the same distance of positions, so
    the runs of one distance are numbered by position less row number.  ``pos`` counts rows of a period from 1.
    """
    own = games.select(F.col(player).alias("player"), F.col(period_no).alias("period_no"), F.col(pos).alias("pos"), F.xxhash64(*what).alias("mark"), F.struct(*what).alias("what"))
    before = own.select("player", (F.col("period_no") + 1).alias("period_no"), F.col("pos").alias("from_pos"), "mark", F.col("what").alias("was"))
    met = own.join(before, ["player", "period_no", "mark"]).filter(F.col("what").eqNullSafe(F.col("was"))).withColumn("shift", F.col("pos") - F.col("from_pos"))
    along = Window.partitionBy("player", "period_no", "shift").orderBy("pos")
    runs = met.withColumn("run", F.col("pos") - F.row_number().over(along)).groupBy("player", "period_no", "shift", "run")
    found = runs.agg(F.min("pos").alias("first_pos"), F.min("from_pos").alias("from_pos"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return found.select(F.col("player").alias(player), F.col("period_no").alias(period_no), "first_pos", "from_pos", "n")


def without_copies(games: DataFrame, blocks: DataFrame, player: str, period_no: str, pos: str) -> DataFrame:
    """``games`` without the rows that the blocks of ``copied_blocks`` cover."""
    covered = blocks.select(player, period_no, F.explode(F.sequence("first_pos", F.col("first_pos") + F.col("n") - 1)).alias(pos))
    return games.join(covered.distinct(), [player, period_no, pos], "left_anti")
