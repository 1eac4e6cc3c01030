"""Running aggregates of keys of any size, and what rests on them.

A window runs a key's rows through one task.  Here rows are dealt out by ranges of (key, order) instead, so a key's
rows spread over as many tasks as they fill.  Each range aggregates its own rows, the few rows of (range, key)
aggregates are run over in order, and what lies before a range is added to the running value inside it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.operators.ratings import DELTA, delta, published
from ratingloom.sources.shared import saved

#: Aggregates that may be run over: how one is taken, and how two of them join.
KINDS: dict[str, tuple[Callable, Callable]] = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


def running(rows: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[str, Column]], backward: bool = False, own: bool = True) -> DataFrame:
    """``rows`` with a running aggregate for each of ``columns`` (name to kind and value) by ``order`` within ``keys``.

    Kinds are sum, count, max and min; nulls take no part.  ``backward`` runs from the end; without ``own`` the row
    itself is left out.  (keys, order) should tell rows apart; rows that it does not may be taken in any order.
    """
    values = {f"_v{i}": value for i, (_, value) in enumerate(columns.values())}
    dealt = rows.withColumns(values).repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    base = saved(dealt, "running")
    kinds = [kind for kind, _ in columns.values()]
    part = base.groupBy(*keys, "_part").agg(*[KINDS[k][0](v).alias(v) for k, v in zip(kinds, values)])
    among = Window.partitionBy(*keys).orderBy(F.desc("_part") if backward else F.asc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    joined = [(F.sum if k == "count" else KINDS[k][0])(v).over(among).alias(f"{v}_outside") for k, v in zip(kinds, values)]
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    # a key has rows before a range only where it straddles ranges: no more rows than ranges
    outside = part.select(*named, F.col("_part").alias("_of"), *joined).filter(F.coalesce(*[F.col(f"{v}_outside") for v in values]).isNotNull())
    inside = Window.partitionBy(*keys, "_part").orderBy(*[F.desc(o) if backward else F.asc(o) for o in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow if own else -1)
    ran = base.withColumns({f"{v}_inside": KINDS[k][0](v).over(inside) for k, v in zip(kinds, values)})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_part") == F.col("_of"))
    both = ran.join(F.broadcast(outside), same, "left")
    out = {name: KINDS[k][1](F.col(f"{v}_outside"), F.col(f"{v}_inside")) for (name, (k, _)), v in zip(columns.items(), values)}
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in out]
    return both.select(*kept, *[c.alias(n) for n, c in out.items()])


def running_rating_any(games: DataFrame, keys: list[str], order: list[str], score: str, opponent: str, opening: str, k: str) -> DataFrame:
    """``ratings.running_rating`` for keys of any number of games."""
    change = F.coalesce(delta(F.col(score), F.col(opening), F.col(opponent), F.col(k)), F.lit(0).cast(DELTA))
    ran = running(games, keys, order, {"_so_far": ("sum", change)})
    return ran.withColumn("new_rating", published(F.col(opening), F.col("_so_far"))).drop("_so_far")


def game_index_any(games: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``reshape.game_index`` for keys of any number of rows."""
    return running(games, [key], order, {"idx": ("count", F.lit(1))})


def accumulate_selection_any(events: DataFrame, group: str, key: str, order: list[str], is_clear: Column) -> DataFrame:
    """``linked.accumulate_selection`` for groups of any number of events: the clears after each event are counted
    from the end."""
    later = running(events.withColumn("_clear", F.when(is_clear, 1).otherwise(0)), [group], order, {"_later": ("sum", F.col("_clear"))}, backward=True)
    return later.filter("_later = 0").groupBy(group, key).agg(F.min(F.struct(*order)).alias("first_seen"))
