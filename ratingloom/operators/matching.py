"""Key matches, trace filters and selected copies against a table of keys.

Each trace has *units*, the places that match or fail as one: a point of a flat key, an inner list of a nested
one, all points of a simple one.  The units' keys are exploded and meet the key table in a semi join, and a unit
matches if as many of its keys are met as it has; null keys, and units without keys, match whatever the table
holds.  The table may hold any number of keys, and one key may be on any number of traces: no needles are
gathered in an array, and a hot key is split by Spark's skew join.  A table of at most ``FEW`` rows is counted first and
looked up as a hash set inside each row instead, which needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import first_non_empty, opacity
from ratingloom.operators.linked import JOINER, subset_parallel

INDEX = "array<int>"
FEW = 5_000  # keys that are looked up in a hash set in each row; more of them are joined


def _every(keys: Column) -> Column:
    """All indexes of an array, from 0."""
    return F.when(F.size(keys) > 0, F.sequence(F.lit(0), F.size(keys) - 1)).otherwise(F.array().cast(INDEX))


def _met(units: DataFrame, keys: DataFrame) -> DataFrame:
    """``_hits`` (ascending indexes) for each ``_id`` of ``units`` (_id, _units: each a list of non-null keys) that
    has any unit met in full."""
    each = units.select("_id", F.posexplode("_units").alias("_place", "_keys")).filter(F.size("_keys") > 0)
    rows = each.select("_id", "_place", F.size("_keys").alias("_need"), F.explode("_keys").alias("_key"))
    found = rows.join(keys.select(F.col(f"`{keys.columns[0]}`").alias("_key")), "_key", "left_semi")
    # both groupings need a trace's rows together, so they share one exchange
    full = found.repartition("_id").groupBy("_id", "_place", "_need").agg(F.count(F.lit(1)).alias("_n")).filter("_n = _need")
    return full.groupBy("_id").agg(F.array_sort(F.collect_list("_place")).alias("_hits"))


def _looked_up(keys: list) -> Column:
    """The matching units' places for a few keys, without a shuffle: a set of literals is hashed once a task."""
    real = [k for k in keys if k is not None]
    inside = lambda k: k.isin(real) if real else F.lit(False)
    flags = F.transform("_units", lambda u, i: F.when(F.forall(u, inside), i))
    return F.coalesce(F.filter(flags, lambda i: i.isNotNull()), F.array().cast(INDEX))


def match_index(traces: DataFrame, keys: DataFrame, id_col: str, flat: str, kind: str | None = None, nested: str | None = None, index: str = "index") -> DataFrame:
    """``traces`` with ``index``: the points, from 0, that match the first column of ``keys``.

    ``kind`` names the column that says how a trace is matched: ``nested`` by the lists of ``nested``, ``simple``
    as a whole (all points or none; an empty key list matches, with no points to show), else point by point.
    ``whole`` is added, true where a simple trace matches.  ``id_col`` is unique.  A trace whose keys are null
    matches nothing.  Repeated and null rows of ``keys`` change nothing.
    """
    own, how = F.col(f"`{flat}`"), F.lit("flat") if kind is None else F.coalesce(F.col(f"`{kind}`"), F.lit("flat"))
    one = lambda k: F.when(k.isNull(), F.array().cast(own_type)).otherwise(F.array(k))
    own_type = traces.schema[flat].dataType.simpleString()
    real = lambda a: F.filter(a, lambda k: k.isNotNull())
    lists = F.transform(own, one)
    units = F.when(how == "simple", F.when(own.isNotNull(), F.array(real(own)))).otherwise(lists)
    if nested is not None:
        units = F.when(how == "nested", F.transform(F.col(f"`{nested}`"), lambda inner: real(F.coalesce(inner, F.array().cast(own_type))))).otherwise(units)
    keyed = traces.withColumn("_id", F.col(f"`{id_col}`")).withColumn("_units", units).withColumn("_how", how)
    few = [r[0] for r in keys.select(F.col(f"`{keys.columns[0]}`")).limit(FEW + 1).collect()]
    if len(few) <= FEW:
        found, hits = keyed, _looked_up(few)
    else:
        found = keyed.join(_met(keyed.select("_id", "_units"), keys), "_id", "left")
        # units without a key to look up match by themselves
        free = F.filter(F.transform("_units", lambda u, i: F.when(F.size(u) == 0, i)), lambda i: i.isNotNull())
        hits = F.array_sort(F.concat(F.coalesce("_hits", F.array().cast(INDEX)), F.coalesce(free, F.array().cast(INDEX))))
    found = found.withColumn("_found", hits)
    hits = F.col("_found")
    simple = (F.col("_how") == "simple") & (F.size(hits) > 0)
    out = F.when(simple, _every(own)).otherwise(hits)
    kept = [F.col(f"`{c}`") for c in traces.columns if c not in (index, "whole")]
    return found.select(*kept, out.alias(index), F.coalesce(simple, F.lit(False)).alias("whole"))


def filter_by_keys(traces: DataFrame, keys: DataFrame | None, id_col: str, chosen_set: str, flat: str = "key", kind: str | None = None, nested: str | None = None) -> DataFrame:
    """Without a key table all traces; else the keyed traces of the set that have matches, cut to them, or whole
    where the key is a simple one."""
    if keys is None:
        return traces
    has_key = F.col(f"`{flat}`").isNotNull()
    if nested is not None and kind is not None:
        has_key = F.when(F.col(f"`{kind}`") == "nested", F.col(f"`{nested}`").isNotNull()).otherwise(has_key)
    own = traces.filter((F.col("set") == chosen_set) & has_key)
    hit = match_index(own, keys, id_col, flat, kind, nested, "_index").filter((F.size("_index") > 0) | F.col("whole"))
    names = [F.col(f"`{c}`") for c in traces.columns]
    cut = subset_parallel(hit.filter("not whole"), "_index").select(*names)
    return cut.unionByName(hit.filter("whole").select(*names))


def joined_keys(keys: DataFrame) -> Column:
    """The label of a selection: its keys in order, joined.  The label holds every key, so it is for selections that
    are shown by their keys; give ``selected_copies`` another label for larger ones."""
    (text,) = keys.agg(F.array_join(F.array_sort(F.collect_set(F.col(f"`{keys.columns[0]}`").cast("string"))), JOINER)).first()
    return F.lit(text)


def selected_copies(traces: DataFrame, keys: DataFrame, id_col: str, chosen_set: str, colour: str, label: Column, flat: str = "key", kind: str | None = None, nested: str | None = None) -> DataFrame:
    """Copies of the set's matching traces, cut to their matches (simple ones whole), in the selection's colour and
    with ``_original``, the trace they come from.  Name and legend group default to ``label``."""
    hit = filter_by_keys(traces.withColumn("_original", F.col(f"`{id_col}`")), keys, id_col, chosen_set, flat, kind, nested)
    named = hit.withColumns({c: first_non_empty(F.col(c), label) for c in ("name", "legendgroup")})
    return named.withColumns({"colour": F.lit(colour), "opacity": opacity(F.col("opacity"))})


def selected_keys(points: DataFrame, traces: DataFrame, trace_col: str, flat: str, number: str | None = None, numbers: str | None = None, kind: str | None = None, nested: str | None = None, set_col: str = "set") -> DataFrame:
    """set, key and n: how often each key is selected, by points that name their trace (``trace_col``).

    A point of a simple trace selects the trace's whole key; one of a nested trace its inner list, one level
    flattened; else the key at its number, or at each of its ``numbers`` where it stands for several and has no
    number of its own.  Traces without key or set are skipped, and so are points without a trace; numbers beyond
    the keys select null, as do null keys, but for a nested trace's single number, which selects nothing.  Counts come out, not lists, so a set may be of any size.
    """
    how = F.lit("flat") if kind is None else F.coalesce(F.col(f"`{kind}`"), F.lit("flat"))
    own = traces.filter(F.col(set_col).isNotNull() & (F.col(set_col) != ""))
    several = F.col(numbers) if numbers else F.lit(None).cast("array<int>")
    at = F.when(F.col(number).isNotNull(), F.array(F.col(number).cast("int"))).otherwise(several.cast("array<int>")) if number else several
    # what points choose is counted before it meets the traces: a point chosen again and again is one row
    one = F.col(number).isNotNull() if number else F.lit(False)
    chosen = points.select(trace_col, F.when(at.isNotNull() & (F.size(at) > 0), at).alias("_at"), one.alias("_one")).groupBy(trace_col, "_at", "_one").agg(F.count(F.lit(1)).alias("_times"))
    lists = {"simple": F.col(flat), "flat": F.transform("_at", lambda i: F.get(F.col(flat), i.cast("int")))}
    keys = F.when(how == "simple", lists["simple"])
    has_key = F.col(flat).isNotNull()
    if nested is not None:
        keys = keys.when(how == "nested", F.flatten(F.transform("_at", lambda i: F.coalesce(F.get(F.col(nested), i.cast("int")), F.when(F.col("_one"), F.array()).otherwise(F.array(F.lit(None)))))))
        has_key = F.when(how == "nested", F.col(nested).isNotNull()).otherwise(has_key)
    both = chosen.join(own.filter(has_key), trace_col)
    picked = both.select(F.col(set_col).alias("set"), F.explode(keys.otherwise(lists["flat"])).alias("key"), "_times")
    return picked.groupBy("set", "key").agg(F.sum("_times").alias("n"))
