"""Linked views: key filters, selections, matches, overlays, and change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.scalars import first_non_empty, opacity


#: Attributes that are not parallel to the points, the one whose items are cut one by one, and what joins
#: the keys of a selection's name.
KEPT = ("colorscale",)
TRANSFORMS = "transforms"
JOINER = "<br />"

# Filters ------------------------------------------------------------------------------------------


def range_keys(rows: DataFrame, key: str, value: str, low, high) -> DataFrame:
    """Sorted distinct keys whose value lies in the closed range."""
    return rows.filter(F.col(value).between(low, high)).select(key).distinct().orderBy(key)


def group_keys(groups: DataFrame, chosen: list[str] | None, group: str = "group", key: str = "key") -> DataFrame | None:
    """Distinct sorted keys of the chosen groups; None (no filter) if nothing is chosen."""
    if not chosen:
        return None
    return groups.filter(F.col(group).isin(chosen)).select(key).distinct().orderBy(key)


def explode_groups(groups: DataFrame, column: str) -> DataFrame:
    """(group, key) rows of a map from group to keys."""
    return groups.select(F.explode(column).alias("group", "keys")).select("group", F.explode("keys").alias("key"))


def handle_counts(handle_keys: DataFrame) -> DataFrame:
    """How many handles have each key."""
    return handle_keys.groupBy("key").agg(F.count_distinct("handle_id").alias("n_handles"))


def intersect_handles(handles: DataFrame, handle_keys: DataFrame) -> DataFrame | None:
    """Keys in every handle; None (all rows pass) without handles.  Handles have a table of their own, so one
    without keys still counts, and lets nothing pass."""
    n = handles.select("handle_id").distinct().count()
    if n == 0:
        return None
    live = handle_keys.join(handles.select("handle_id").distinct(), "handle_id", "left_semi")
    return handle_counts(live).filter(F.col("n_handles") == n).select("key")


def clear_handle(handles: DataFrame, handle_id: str) -> DataFrame:
    """All handles but one; an unknown id changes nothing."""
    return handles.filter(~F.col("handle_id").eqNullSafe(handle_id))


def apply_keys(rows: DataFrame, keys: DataFrame | None, key: str = "key") -> DataFrame:
    """Rows whose key is in ``keys``; all rows where that is None."""
    return rows if keys is None else rows.join(keys.select(F.col(keys.columns[0]).alias(key)), key, "left_semi")


# Matches ------------------------------------------------------------------------------------------


def _in(key: Column, needles: Column) -> Column:
    return key.isNull() | F.coalesce(F.array_contains(needles, key), F.lit(False))


def flat_matches(keys: Column, needles: Column) -> Column:
    """Indexes (from 0) of keys that are null or among the needles."""
    at = F.filter(F.arrays_zip(keys.alias("k"), F.sequence(F.lit(0), F.size(keys) - 1).alias("i")), lambda z: _in(z["k"], needles))
    return F.when(F.size(keys) == 0, F.array().cast("array<int>")).otherwise(F.transform(at, lambda z: z["i"]))


def simple_match(keys: Column, needles: Column) -> Column:
    """Whether all keys are null or needles; true of an empty list."""
    return F.forall(keys, lambda k: _in(k, needles))


def nested_matches(keys: Column, needles: Column) -> Column:
    """Indexes (from 0) of inner lists whose keys all match."""
    flags = F.transform(keys, lambda inner, i: F.when(simple_match(inner, needles), i))
    return F.filter(flags, lambda i: i.isNotNull())


def matches(kind: Column, flat: Column, nested: Column, needles: Column) -> Column:
    """By the key's kind: nested before simple before flat; a simple key gives all indexes or none."""
    every = F.when(F.size(flat) > 0, F.sequence(F.lit(0), F.size(flat) - 1)).otherwise(F.array().cast("array<int>"))
    simple = F.when(simple_match(flat, needles), every).otherwise(F.array().cast("array<int>"))
    return F.when(kind == "nested", nested_matches(nested, needles)).when(kind == "simple", simple).otherwise(flat_matches(flat, needles))


def subset(array: Column, index: Column) -> Column:
    """The elements at the given places (from 0), in their order; null beyond the end."""
    return F.transform(index, lambda i: F.get(array, i))


def subset_parallel(rows: DataFrame, index: str, keep: tuple[str, ...] = KEPT) -> DataFrame:
    """Every array column cut by the index column; scalars, columns with a leading underscore and ``keep``
    stay; structs are treated field by field, and so is each struct of an array named ``TRANSFORMS``."""

    def cut(c: Column, name: str, kind) -> Column:
        if name.startswith("_") or name in keep or name == index:
            return c
        if name == TRANSFORMS and kind.typeName() == "array" and kind.elementType.typeName() == "struct":
            return F.transform(c, lambda s: F.struct(*[cut(s[f.name], f.name, f.dataType).alias(f.name) for f in kind.elementType.fields]))
        if kind.typeName() == "array":
            return subset(c, F.col(index))
        if kind.typeName() == "struct":
            return F.struct(*[cut(c[f.name], f.name, f.dataType).alias(f.name) for f in kind.fields])
        return c

    return rows.select(*[cut(F.col(f"`{f.name}`"), f.name, f.dataType).alias(f.name) for f in rows.schema.fields])


def filter_traces(traces: DataFrame, chosen_set: str, needles: Column | None, kind: Column | None = None, nested: Column | None = None, flat: Column | None = None) -> DataFrame:
    """No needles: all traces.  Else only keyed traces of the set, cut to their matching points.

    ``kind`` says how a trace's key is matched: a flat key (also without ``kind``) point by point, a nested one
    (``nested``) by its inner lists, and a simple one as a whole: the trace stays uncut, or goes.  ``flat`` is
    ``key`` unless given.
    """
    if needles is None:
        return traces
    flat = F.col("key") if flat is None else flat
    kind = F.lit("flat") if kind is None else kind
    own = traces.filter((F.col("set") == chosen_set) & F.when(kind == "nested", (flat if nested is None else nested).isNotNull()).otherwise(flat.isNotNull()))
    nested = F.transform(flat, lambda k: F.array(k)) if nested is None else nested
    stays = (kind == "simple") & simple_match(flat, needles)
    hit = own.withColumn("_index", matches(kind, flat, nested, needles)).withColumn("_whole", stays).filter((F.size("_index") > 0) | F.col("_whole"))
    cut = subset_parallel(hit, "_index")
    names = [c for c in traces.columns]
    whole = hit.filter("_whole").select(*[F.col(f"`{c}`") for c in names])
    return cut.filter("not _whole").select(*[F.col(f"`{c}`") for c in names]).unionByName(whole)


# Joins and differences ----------------------------------------------------------------------------


def key_diff(old: DataFrame, new: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """key and change (removed or added) between two key tables; repeats count once, and null is a key.  With
    ``unique`` a repeated key is refused."""
    if unique:
        assert_unique(old, key)
        assert_unique(new, key)
    sides = [rows.select(F.col(key).alias("key")).distinct().withColumn("here", F.lit(True)).alias(name) for rows, name in ((old, "old"), (new, "new"))]
    both = sides[0].join(sides[1], F.col("old.key").eqNullSafe(F.col("new.key")), "full_outer")
    gone, fresh = F.col("new.here").isNull(), F.col("old.here").isNull()
    return both.filter(gone | fresh).select(F.when(gone, F.col("old.key")).otherwise(F.col("new.key")).alias(key), F.when(gone, "removed").otherwise("added").alias("change"))


def assert_unique(rows: DataFrame, key: str) -> None:
    """Raise if a key is repeated."""
    again = rows.groupBy(key).count().filter("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"{key} is repeated: {again[0][0]!r}")


def only_new(old: Column, new: Column) -> Column:
    """Elements of ``new`` that ``old`` lacks; repeats stay."""
    return F.filter(new, lambda x: ~F.coalesce(F.array_contains(old, x), F.lit(False)))


def expand_legend(traces: DataFrame, chosen: DataFrame, id_col: str, group: str) -> DataFrame:
    """The traces of the chosen ones' legend groups, each once; a chosen trace without a group is alone in it."""
    picked = traces.join(chosen.select(id_col).distinct(), id_col, "left_semi")
    groups = picked.filter(F.col(group).isNotNull()).select(group).distinct()
    alone = picked.filter(F.col(group).isNull()).select(id_col).distinct()
    return traces.join(groups, group, "left_semi").select(id_col).distinct().unionByName(alone)


def legend_sizes(traces: DataFrame, id_col: str, group: str) -> DataFrame:
    """Each trace with the number, the least and the greatest of its legend group's traces: a row a group, counted
    before the shuffle, goes to the traces instead of all pairs of a group."""
    own = traces.filter(F.col(group).isNotNull()).select(id_col, group)
    sizes = own.groupBy(group).agg(F.count(F.lit(1)).alias("n_members"), F.min(id_col).alias("least"), F.max(id_col).alias("greatest"))
    alone = traces.filter(F.col(group).isNull()).select(id_col, F.lit(1).cast("long").alias("n_members"), F.col(id_col).alias("least"), F.col(id_col).alias("greatest"))
    return own.join(sizes, group).select(id_col, "n_members", "least", "greatest").unionByName(alone)


# Selections ---------------------------------------------------------------------------------------


def distinct_sets(traces: DataFrame, set_col: str, order: str) -> DataFrame:
    """Non-empty sets by where they are first seen."""
    seen = traces.filter(F.col(set_col).isNotNull() & (F.col(set_col) != "")).groupBy(set_col).agg(F.min(order).alias("first_seen"))
    return seen.orderBy("first_seen", set_col)


def point_keys(kind: Column, keys: Column, number: Column) -> Column:
    """Keys of a point: the whole key of a simple trace, the inner list of a nested one, else the key at
    the point's number."""
    whole = F.flatten(keys)
    return F.when(kind == "simple", whole).otherwise(F.coalesce(F.get(keys, number), F.array().cast("array<string>")))


def point_keys_at_pair(keys: Column, row: Column, column: Column) -> Column:
    """The key of a point numbered by row and column of a nested list."""
    return F.get(F.get(keys, row), column)


def point_keys_at_list(keys: Column, numbers: Column) -> Column:
    """The keys of a point that stands for several numbers."""
    return subset(keys, numbers)


def points_to_keys(points: DataFrame, set_col: str, key: str) -> DataFrame:
    """How often each key of each set is selected; points without key or set are skipped."""
    return points.filter(F.col(set_col).isNotNull() & F.col(key).isNotNull()).groupBy(set_col, key).agg(F.count(F.lit(1)).alias("n_points"))


def accumulate_selection(events: DataFrame, group: str, key: str, order: list[str], is_clear: Column) -> DataFrame:
    """Keys selected since the group's last clear, with the order in which each was first seen."""
    clears = Window.partitionBy(group).orderBy(*[F.desc(o) for o in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    live = events.withColumn("_clear", F.when(is_clear, 1).otherwise(0)).withColumn("_later", F.sum("_clear").over(clears)).filter("_later = 0")
    return live.groupBy(group, key).agg(F.min(F.struct(*order)).alias("first_seen"))


def append_absent(old: Column, new: Column) -> Column:
    return F.array_distinct(F.concat(old, new))


def selection_overlay(traces: DataFrame, selected: DataFrame, key: str, colour: str) -> DataFrame:
    """Originals and, for keys selected, copies in the selection's colour: kind, key, name, colour, opacity."""
    hit = traces.join(selected.select(key).distinct(), key, "left_semi")
    copies = hit.select(F.lit("selected").alias("kind"), key, first_non_empty(F.col("name"), F.col(key)).alias("name"), F.lit(colour).alias("colour"), opacity(F.col("opacity")).alias("opacity"))
    originals = traces.select(F.lit("original").alias("kind"), key, "name", "colour", opacity(F.col("opacity")).alias("opacity"))
    return originals.unionByName(copies)


def selected_copies(traces: DataFrame, id_col: str, chosen_set: str, needles: Column, colour: str, kind: Column | None = None, nested: Column | None = None) -> DataFrame:
    """Copies of the set's matching traces, cut to their matches, in the selection's colour and with a link to
    the original; name and legend group default to the keys, joined."""
    label = F.concat_ws(JOINER, needles)
    cut = filter_traces(traces.withColumn("_original", F.col(id_col)), chosen_set, needles, kind, nested)
    named = cut.withColumns({c: first_non_empty(F.col(c), label) for c in ("name", "legendgroup")})
    return named.withColumns({"colour": F.lit(colour), "opacity": opacity(F.col("opacity"))})


def dim_rest(overlay: DataFrame, sets_selected: DataFrame, set_col: str, factor: float) -> DataFrame:
    """Opacity of originals whose set has a selection times the factor; 1 changes nothing."""
    mark = sets_selected.select(set_col).distinct().withColumn("_dim", F.lit(True))
    dim = F.col("_dim").isNotNull() & (F.col("kind") == "original") & F.lit(factor != 1.0)
    return overlay.join(mark, set_col, "left").withColumn("opacity", F.when(dim, F.col("opacity") * factor).otherwise(F.col("opacity"))).drop("_dim")


# Events -------------------------------------------------------------------------------------------


def change_only(events: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Events whose value differs from the key's one before, with ``old_value``; a first value counts unless
    it is null."""
    w = Window.partitionBy(key).orderBy(*order)
    return events.withColumn("old_value", F.lag(value).over(w)).filter(~F.col(value).eqNullSafe(F.col("old_value")))


def first_of_history(events: DataFrame, fingerprint: Column, order: list[str]) -> DataFrame:
    """Each different event where it is first seen."""
    w = Window.partitionBy("_print").orderBy(*order)
    return events.withColumn("_print", fingerprint).withColumn("_nr", F.row_number().over(w)).filter("_nr = 1").drop("_nr", "_print")


def debounce(events: DataFrame, key: str, ts: str, id_col: str, gap: str, first: bool = False) -> DataFrame:
    """One event for each burst without a pause of ``gap``: the last, or the first."""
    pick = F.min_by if first else F.max_by
    burst = events.groupBy(key, F.session_window(ts, gap).alias("w")).agg(pick(id_col, F.struct(ts, id_col)).alias(id_col), F.count(F.lit(1)).alias("n_events"))
    return burst.select(key, id_col, "n_events")
