"""Rating arithmetic: expected scores, running, closing and chained ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOW, HIGH = 0.1, 0.9
DELTA = "decimal(18,6)"


def expected_score(own: Column, opponent: Column) -> Column:
    """Expected score on the 400-point logistic curve, held within [0.1, 0.9]."""
    raw = 1.0 / (1.0 + F.pow(F.lit(10.0), (opponent - own) / 400.0))
    return F.least(F.lit(HIGH), F.greatest(F.lit(LOW), raw))


def delta(score: Column, own: Column, opponent: Column, k: Column) -> Column:
    """Rating points of one game, as an exact decimal, so that sums do not depend on their order."""
    return (k * (score - expected_score(own, opponent))).cast(DELTA)


def published(opening: Column, total: Column) -> Column:
    """Opening plus the unrounded sum, rounded to the nearest integer, halves up."""
    return F.floor(opening + total.cast("double") + 0.5).cast("long")


def running_rating(games: DataFrame, keys: list[str], order: list[str], score: str, opponent: str, opening: str, k: str, out: str = "new_rating") -> DataFrame:
    """Add the rating after each game.  The opening stays the own rating for the whole period, so the deltas
    are independent and one window over (keys) by (order) sums them."""
    rows = games.withColumn("_delta", delta(F.col(score), F.col(opening), F.col(opponent), F.col(k)))
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, published(F.col(opening), F.sum(F.coalesce("_delta", F.lit(0).cast(DELTA))).over(upto))).drop("_delta")


def attach_periods(games: DataFrame, periods: DataFrame, keys: list[str]) -> DataFrame:
    """Opening and factor of each game's period."""
    return games.join(periods, keys)


def closing_rating(games: DataFrame, keys: list[str], score: str, opponent: str, opening: str, k: str) -> DataFrame:
    """keys, opening, n_games and closing: one grouped sum, combined before the shuffle."""
    rows = games.withColumn("_delta", delta(F.col(score), F.col(opening), F.col(opponent), F.col(k)))
    total = rows.groupBy(*keys).agg(F.max(opening).alias("opening"), F.count(F.lit(1)).alias("n_games"), F.sum(F.coalesce("_delta", F.lit(0).cast(DELTA))).alias("_total"))
    return total.select(*keys, "opening", "n_games", published(F.col("opening"), F.col("_total")).alias("closing"))


def carried_opening(closings: DataFrame, player: str, period: str, closing: str = "closing") -> DataFrame:
    """Add the closing of the player's previous period."""
    return closings.withColumn("carried", F.lag(closing).over(Window.partitionBy(player).orderBy(period)))


def with_adjustments(closings: DataFrame, adjustments: DataFrame, keys: list[str]) -> DataFrame:
    """Closings set directly by adjustment rows (keys, adjusted) take the place of computed ones."""
    return closings.join(adjustments, keys, "left").withColumn("closing", F.coalesce("adjusted", "closing")).drop("adjusted")


def chained_closing(games: DataFrame, player: str, period: str, score: str, opponent: str, opening: str, k: str, times: str | None = None) -> DataFrame:
    """Closings recomputed period by period, each being the next opening.

    A recurrence over a player's periods, folded inside one row.  A period's games are first counted by score
    and opponent's rating, before the shuffle, so a row holds a period's different pairings, however many games
    they stand for.  Unscored games change nothing.  Players go in parallel.  ``times`` names a column with the number
    of games that a row stands for already.
    """
    pairing = games.groupBy(player, period, F.col(score).cast("double").alias("_s"), F.col(opponent).cast("double").alias("_o"))
    counted = pairing.agg((F.count(F.lit(1)) if times is None else F.sum(times)).cast("decimal(18,0)").alias("_n"), F.max(opening).alias("_start"), F.max(k).cast("double").alias("_k"))
    game = F.struct(F.col("_s").alias("s"), F.col("_o").alias("o"), F.col("_n").alias("n"))
    periods = counted.groupBy(player, period).agg(F.collect_list(game).alias("g"), F.max("_start").alias("start"), F.max("_k").alias("k"))
    whole = periods.groupBy(player).agg(F.array_sort(F.collect_list(F.struct(F.col(period).alias("p"), "g", "k"))).alias("periods"), F.max("start").cast("double").alias("start"))
    zero = F.lit(0).cast(DELTA)

    def close(own: Column, x: Column) -> Column:
        total = F.aggregate(x["g"], zero, lambda t, g: (t + F.coalesce(delta(g["s"], own, g["o"], x["k"]), zero) * g["n"]).cast(DELTA))
        return F.floor(own + total.cast("double") + 0.5).cast("double")

    seed = F.struct(F.col("start").alias("own"), F.array().cast("array<struct<p:string,opening:double,closing:double>>").alias("rows"))

    def fold(state: Column, x: Column) -> Column:
        row = F.struct(x["p"].cast("string").alias("p"), state["own"].alias("opening"), close(state["own"], x).alias("closing"))
        return F.struct(row["closing"].alias("own"), F.concat(state["rows"], F.array(row)).alias("rows"))

    folded = whole.select(player, F.aggregate("periods", seed, fold, lambda s: s["rows"]).alias("rows"))
    return folded.select(player, F.inline("rows")).select(player, F.col("p").alias(period), F.col("opening").cast("long").alias("opening"), F.col("closing").cast("long").alias("closing"))
