"""Every query of the rating and linked-view operators over the driver's tables, with its SQL.

A player is a customer or a user, a period the half-year of an order, a rating a total or a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions import scalars as S
from ratingloom.operators import audits, bands, linked, matching, prefix, ratings, reshape
from ratingloom.sources import pages as sources
from ratingloom.sources.shared import new_path
from ratingloom.streaming import feeds, stored

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EXPECTED = "least(0.9, greatest(0.1, 1.0 / (1.0 + pow(10.0, ({opp} - {own}) / 400.0))))"
PERIODS = [f"{y}P{p}" for y in range(1992, 1999) for p in (1, 2)]
PERIOD_SQL = "(year(o_orderdate)::VARCHAR || 'P' || (CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END))"
BAND_SQL = "CASE WHEN {r} IS NULL OR isnan({r}) THEN '<1600' WHEN {r} > 2200 THEN '>2200' WHEN {r} >= 2000 THEN '2000-2200' WHEN {r} >= 1800 THEN '1800-2000' WHEN {r} >= 1600 THEN '1600-1800' ELSE '<1600' END"
LATEST_SQL = "SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS latest FROM orders GROUP BY o_custkey"
RATED_SQL = f"SELECT o_custkey, latest, 1200.0::DOUBLE + latest / 200.0 AS rating FROM ({LATEST_SQL})"


# Ratings ------------------------------------------------------------------------------------------


def _event_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    score = F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type") == "click", 0.5).otherwise(0.0)
    return e.select("event_id", "user_id", "ts", score.alias("score"), (1300.0 + F.coalesce("value", F.lit(0.0))).alias("opponent"), F.lit(1500).alias("opening"), F.lit(24).alias("k"))


@query(f"""
SELECT event_id, user_id, CAST(floor(1500 + CAST(sum(CAST(24 * (score - {EXPECTED.format(opp='opp', own='1500')}) AS DECIMAL(18,6))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) + 0.5) AS BIGINT) AS new_rating
FROM (SELECT *, CASE event_type WHEN 'purchase' THEN 1.0::DOUBLE WHEN 'click' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score, 1300.0::DOUBLE + coalesce(value, 0.0) AS opp FROM events)
""")
def rating_running(spark, sf_dir):
    games = _event_games(spark, sf_dir)
    return ratings.running_rating(games, ["user_id"], ["ts", "event_id"], "score", "opponent", "opening", "k").select("event_id", "user_id", "new_rating")


def _period(day: str) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("P"), F.when(F.month(day) <= 6, "1").otherwise("2"))


def _order_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    score = F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "P", 0.5).otherwise(0.0)
    return o.select("o_orderkey", "o_custkey", "o_orderdate", _period("o_orderdate").alias("period"), score.alias("score"), (1000.0 + F.pmod(F.col("o_orderkey"), F.lit(1000))).alias("opponent"))


def _openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    opening = (1500 + F.floor(F.col("c_acctbal") / 20)).cast("int")
    return c.select(F.col("c_custkey").alias("o_custkey"), opening.alias("opening"), F.when(opening >= 1600, 24).otherwise(32).alias("k"))


ORDER_GAMES = f"""
games AS (SELECT o_orderkey, o_custkey, {PERIOD_SQL} AS period, CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'P' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score, 1000.0::DOUBLE + (o_orderkey % 1000) AS opp FROM orders),
openings AS (SELECT c_custkey AS o_custkey, CAST(1500 + floor(c_acctbal / 20) AS INTEGER) AS opening FROM customer),
factors AS (SELECT *, CASE WHEN opening >= 1600 THEN 24 ELSE 32 END AS k FROM openings)"""
CLOSED = f"""{ORDER_GAMES},
closed AS (SELECT o_custkey, period, max(opening) AS opening, count(*) AS n_games, CAST(floor(max(opening) + CAST(sum(CAST(k * (score - {EXPECTED.format(opp='opp', own='opening')}) AS DECIMAL(18,6))) AS DOUBLE) + 0.5) AS BIGINT) AS closing FROM games JOIN factors USING (o_custkey) GROUP BY o_custkey, period)"""


@query(f"WITH {CLOSED} SELECT o_custkey, period, opening, n_games, closing FROM closed")
def rating_closing(spark, sf_dir):
    games = ratings.attach_periods(_order_games(spark, sf_dir), _openings(spark, sf_dir), ["o_custkey"])
    return ratings.closing_rating(games, ["o_custkey", "period"], "score", "opponent", "opening", "k")


@query(f"WITH {CLOSED} SELECT o_custkey, period, closing, lag(closing) OVER (PARTITION BY o_custkey ORDER BY period) AS carried FROM closed")
def rating_carry(spark, sf_dir):
    return ratings.carried_opening(rating_closing(spark, sf_dir), "o_custkey", "period").select("o_custkey", "period", "closing", "carried")


@query(f"""WITH RECURSIVE {ORDER_GAMES},
nos AS (SELECT o_custkey, period, row_number() OVER (PARTITION BY o_custkey ORDER BY period) AS nr FROM (SELECT DISTINCT o_custkey, period FROM games JOIN factors USING (o_custkey))),
lists AS (SELECT o_custkey, period, list(score) AS s, list(opp) AS o FROM games GROUP BY o_custkey, period),
chain AS (
  SELECT n.o_custkey, n.nr, n.period, f.opening::BIGINT AS opening, CAST(floor(f.opening + CAST(list_sum([CAST(f.k * (l.s[i] - {EXPECTED.format(opp='l.o[i]', own='f.opening')}) AS DECIMAL(18,6)) for i in range(1, len(l.s) + 1)]) AS DOUBLE) + 0.5) AS BIGINT) AS closing, f.k
  FROM nos n JOIN factors f USING (o_custkey) JOIN lists l ON l.o_custkey = n.o_custkey AND l.period = n.period WHERE n.nr = 1
  UNION ALL
  SELECT n.o_custkey, n.nr, n.period, c.closing AS opening, CAST(floor(c.closing + CAST(list_sum([CAST(c.k * (l.s[i] - {EXPECTED.format(opp='l.o[i]', own='c.closing')}) AS DECIMAL(18,6)) for i in range(1, len(l.s) + 1)]) AS DOUBLE) + 0.5) AS BIGINT) AS closing, c.k
  FROM chain c JOIN nos n ON n.o_custkey = c.o_custkey AND n.nr = c.nr + 1 JOIN lists l ON l.o_custkey = n.o_custkey AND l.period = n.period)
SELECT o_custkey, period, opening, closing FROM chain""")
def rating_chained(spark, sf_dir):
    games = ratings.attach_periods(_order_games(spark, sf_dir), _openings(spark, sf_dir), ["o_custkey"])
    return ratings.chained_closing(games, "o_custkey", "period", "score", "opponent", "opening", "k")


# Bands and series ---------------------------------------------------------------------------------


@query(LATEST_SQL)
def latest_per_key(spark, sf_dir):
    return bands.latest(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", ["o_orderdate", "o_orderkey"])


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(spark, sf_dir).withColumn("rating", 1200.0 + F.col("latest") / 200.0)


@query(f"SELECT o_custkey, rating, {BAND_SQL.format(r='rating')} AS band FROM ({RATED_SQL})")
def band_assign(spark, sf_dir):
    return _rated(spark, sf_dir).select("o_custkey", "rating", bands.band(F.col("rating")).alias("band"))


@query(f"""WITH b(band_no, band) AS (VALUES (0, '>2200'), (1, '2000-2200'), (2, '1800-2000'), (3, '1600-1800'), (4, '<1600')),
m AS (SELECT {BAND_SQL.format(r='rating')} AS band, count(*) AS n, string_agg(c_name, ',' ORDER BY lower(c_name), c_name) AS names FROM ({RATED_SQL}) JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT b.band_no::INTEGER AS band_no, b.band, coalesce(n, 0)::INTEGER AS n_members, coalesce(names, '') AS names FROM b LEFT JOIN m USING (band)""")
def band_members(spark, sf_dir):
    named = band_assign(spark, sf_dir).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    return bands.band_members(named, "c_name").select("band_no", "band", F.size("members").alias("n_members"), F.array_join("members", ",").alias("names"))


@query(f"SELECT band, c_name AS member, row_number() OVER (PARTITION BY band ORDER BY lower(c_name), c_name) - 1 AS place FROM (SELECT {BAND_SQL.format(r='rating')} AS band, c_name FROM ({RATED_SQL}) JOIN customer ON c_custkey = o_custkey)")
def band_listing(spark, sf_dir):
    named = band_assign(spark, sf_dir).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    return bands.band_places(named, "c_name")


@query(f"SELECT o_custkey, band, CASE WHEN band = '1800-2000' THEN 'shown' ELSE 'legendonly' END AS visible FROM (SELECT o_custkey, {BAND_SQL.format(r='rating')} AS band FROM ({RATED_SQL}))")
def band_visibility(spark, sf_dir):
    return bands.visibility(band_assign(spark, sf_dir), "1800-2000").select("o_custkey", "band", "visible")


def _values(rows) -> str:
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


@query(f"""WITH o(overlay, since, lo, hi) AS (VALUES {_values(bands.OVERLAYS)})
SELECT overlay, count(*) AS n_members, min(rating) AS least, max(rating) AS greatest FROM ({RATED_SQL}) JOIN o ON (lo IS NULL OR rating >= lo) AND (hi IS NULL OR rating <= hi) GROUP BY overlay""")
def overlay_bands(spark, sf_dir):
    overlays = spark.createDataFrame(bands.OVERLAYS, "overlay string, since int, lo int, hi int")
    return bands.overlay_members(_rated(spark, sf_dir), "rating", overlays).groupBy("overlay").agg(F.count(F.lit(1)).alias("n_members"), F.min("rating").alias("least"), F.max("rating").alias("greatest"))


@query("""SELECT user_id, count(*)::INTEGER AS n, md5(string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id)) AS order_md5, list(value ORDER BY ts, event_id)[1] AS first_value, list(value ORDER BY ts, event_id)[-1] AS last_value FROM events GROUP BY user_id""")
def key_series(spark, sf_dir):
    s = reshape.series(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], {"ids": "event_id", "values": "value"})
    ids = F.transform("ids", lambda i: i.cast("string"))
    return s.select("user_id", F.size("ids").alias("n"), F.md5(F.array_join(ids, ",")).alias("order_md5"), F.get("values", F.lit(0)).alias("first_value"), F.element_at("values", -1).alias("last_value"))


@query("SELECT c_name, place, place % 45 AS colour_no FROM (SELECT c_name, row_number() OVER (ORDER BY lower(c_name), c_name) - 1 AS place FROM (SELECT DISTINCT c_name FROM customer))")
def palette_assign(spark, sf_dir):
    return bands.palette_index(table(spark, sf_dir, "customer"), "c_name", 45)


@query("""SELECT o_orderkey, o_orderpriority || ': ' || CAST(CAST(round(o_totalprice, 0) AS BIGINT) AS VARCHAR) AS hover, floor(o_totalprice * 10 + 0.5) / 10.0::DOUBLE AS rounded, CASE WHEN length(o_orderkey::VARCHAR) >= 6 THEN o_orderkey::VARCHAR ELSE lpad(o_orderkey::VARCHAR, 6, '0') END AS padded FROM orders""")
def hover_label(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.hover_label(F.col("o_orderpriority"), F.col("o_totalprice")).alias("hover"), S.round_half_up(F.col("o_totalprice"), 1).alias("rounded"), S.zero_pad(F.col("o_orderkey").cast("string"), 6).alias("padded"))


# Reshape ------------------------------------------------------------------------------------------

INDEXED = f"""indexed AS (SELECT o_custkey, {PERIOD_SQL} AS period, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INTEGER AS idx FROM orders),
joined AS (SELECT *, lag(period) OVER (PARTITION BY o_custkey ORDER BY idx) AS before FROM indexed),
connected AS (SELECT o_custkey, idx, period, o_totalprice FROM joined UNION ALL SELECT o_custkey, idx, before, o_totalprice FROM joined WHERE before <> period)"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", _period("o_orderdate").alias("period"), "o_totalprice")
    games = reshape.game_index(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    return reshape.wide(reshape.with_connectors(games, "o_custkey", "idx", "period"), ["o_custkey", "idx"], "period", PERIODS, "o_totalprice")


@query(f"""WITH {INDEXED} SELECT o_custkey, idx, {', '.join(f"max(o_totalprice) FILTER (WHERE period = '{p}') AS \"{p}\"" for p in PERIODS)} FROM connected GROUP BY o_custkey, idx""")
def wide_by_period(spark, sf_dir):
    return _wide(spark, sf_dir)


@query(f"WITH {INDEXED} SELECT o_custkey, idx, period, max(o_totalprice) AS total FROM connected WHERE period IN ({', '.join(repr(p) for p in PERIODS)}) GROUP BY ALL")
def long_from_wide(spark, sf_dir):
    return reshape.long(_wide(spark, sf_dir), ["o_custkey", "idx"], PERIODS, "period", "total")


@query("SELECT user_id, event_id AS ids, event_type AS kinds FROM events")
def rows_from_columns(spark, sf_dir):
    s = reshape.series(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], {"ids": "event_id", "kinds": "event_type"})
    return reshape.rows_from_columns(s, ["user_id"], ["ids", "kinds"])


@query("SELECT label, (i - 1)::INTEGER AS dim, count(*) AS n, min(embedding[i]) AS least, max(embedding[i]) AS greatest FROM embeddings, range(1, 65) t(i) GROUP BY label, i")
def transpose_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("row", F.struct("label", "vec_id"))
    long = reshape.transposed_long(e, "row", "embedding")
    return long.groupBy(F.col("row.label").alias("label"), "dim").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest"))


# Linked views -------------------------------------------------------------------------------------


@query("SELECT DISTINCT event_id FROM events WHERE value BETWEEN 20 AND 40")
def range_keys(spark, sf_dir):
    return linked.range_keys(table(spark, sf_dir, "events"), "event_id", "value", 20, 40)


@query("SELECT DISTINCT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#34')")
def group_keys(spark, sf_dir):
    return linked.group_keys(table(spark, sf_dir, "part"), ["Brand#11", "Brand#23", "Brand#34"], "p_brand", "p_partkey")


@query("SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity >= 25 INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount >= 0.05 INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def handles_intersect(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    of = lambda name, cond: l.filter(cond).select(F.lit(name).alias("handle_id"), F.col("l_partkey").alias("key"))
    keys = of("quantity", F.col("l_quantity") >= 25).unionByName(of("discount", F.col("l_discount") >= 0.05)).unionByName(of("flag", F.col("l_returnflag") == "R")).unionByName(of("cleared", F.col("l_tax") > 1))
    handles = linked.clear_handle(spark.createDataFrame([("quantity",), ("discount",), ("flag",), ("cleared",)], "handle_id string"), "cleared")
    return linked.intersect_handles(handles, keys)


def _order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("s"))
    of = lambda name: F.transform("s", lambda x: x[name])
    return lines.select("l_orderkey", of("l_linenumber").alias("line"), of("l_partkey").alias("part"), of("l_suppkey").alias("supp"), of("l_quantity").alias("quantity"))


def _low_parts(spark: SparkSession) -> DataFrame:
    return spark.range(400).toDF("key")


@query("""WITH k AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS p, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS s FROM lineitem GROUP BY 1),
m AS (SELECT l_orderkey, CASE l_orderkey % 3 WHEN 0 THEN 'nested' WHEN 1 THEN 'simple' ELSE 'flat' END AS kind, len(p) AS n, [i - 1 for i in range(1, len(p) + 1) if p[i] < 400] AS flat, len([x for x in p if x >= 400]) = 0 AS every, [i - 1 for i in range(1, len(p) + 1) if p[i] < 400 AND s[i] < 400] AS nested FROM k)
SELECT l_orderkey, kind, array_to_string(CASE kind WHEN 'nested' THEN nested WHEN 'simple' THEN CASE WHEN every THEN range(0, n) ELSE [] END ELSE flat END, ',') AS hits FROM m""")
def match_modes(spark, sf_dir):
    k = _order_keys(spark, sf_dir)
    nested = F.zip_with("part", "supp", lambda p, s: F.array(p, s))
    kind = F.when(F.col("l_orderkey") % 3 == 0, "nested").when(F.col("l_orderkey") % 3 == 1, "simple").otherwise("flat")
    rows = matching.match_index(k.withColumn("nested", nested).withColumn("kind", kind), _low_parts(spark), "l_orderkey", "part", "kind", "nested", "hits")
    return rows.select("l_orderkey", "kind", F.array_join(F.transform("hits", lambda i: i.cast("string")), ",").alias("hits"))


@query("""SELECT l_orderkey, count(*)::INTEGER AS n, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS parts, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS lines FROM lineitem WHERE l_partkey < 400 GROUP BY 1""")
def subset_parallel(spark, sf_dir):
    traces = _order_keys(spark, sf_dir).withColumn("set", F.lit("parts")).withColumn("key", F.col("part"))
    cut = matching.filter_by_keys(traces, _low_parts(spark), "l_orderkey", "parts")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return cut.select("l_orderkey", F.size("part").alias("n"), text("part").alias("parts"), text("line").alias("lines"))


@query("""WITH w AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), b AS (SELECT min(d) AS first FROM w),
o AS (SELECT user_id FROM w, b WHERE d = first + 7), n AS (SELECT user_id FROM w, b WHERE d = first + 14)
SELECT user_id, 'removed' AS change FROM o WHERE user_id NOT IN (SELECT user_id FROM n) UNION ALL SELECT user_id, 'added' FROM n WHERE user_id NOT IN (SELECT user_id FROM o)""")
def key_diff(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    first = days.agg(F.min("day").alias("first"))
    of = lambda n: days.join(F.broadcast(first), F.col("day") == F.date_add("first", n)).select("user_id")
    return linked.key_diff(of(7), of(14), "user_id")


@query("SELECT l_returnflag, l_partkey, count(*) AS n_points FROM lineitem WHERE l_quantity > 45 GROUP BY 1, 2")
def points_to_keys(spark, sf_dir):
    return linked.points_to_keys(table(spark, sf_dir, "lineitem").filter("l_quantity > 45"), "l_returnflag", "l_partkey")


@query("SELECT l_returnflag, min(l_orderkey * 10 + l_linenumber) AS first_seen FROM lineitem GROUP BY 1")
def distinct_sets(spark, sf_dir):
    return linked.distinct_sets(table(spark, sf_dir, "lineitem").withColumn("place", F.col("l_orderkey") * 10 + F.col("l_linenumber")), "l_returnflag", "place")


@query("""WITH c AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS later FROM events)
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS first_id FROM c WHERE later = 0 GROUP BY 1, 2""")
def selection_accumulate(spark, sf_dir):
    kept = linked.accumulate_selection(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"], F.col("event_type") == "signup")
    return kept.select("user_id", "event_type", F.col("first_seen.event_id").alias("first_id"))


@query("SELECT a.p_partkey, count(*) AS n_members, min(b.p_partkey) AS least, max(b.p_partkey) AS greatest FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size GROUP BY 1")
def legend_expand(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("legend", F.concat_ws("/", "p_brand", "p_size"))
    return linked.legend_sizes(parts, "p_partkey", "legend")


@query("SELECT p_partkey FROM part WHERE (p_brand, p_size) IN (SELECT (p_brand, p_size) FROM part WHERE p_partkey % 997 = 0)")
def legend_chosen(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("legend", F.concat_ws("/", "p_brand", "p_size"))
    return linked.expand_legend(parts, parts.filter("p_partkey % 997 = 0"), "p_partkey", "legend")


@query("""WITH o AS (SELECT 'original' AS kind, p_partkey, p_name AS name, 'blue' AS colour, p_brand AS set_name, CASE WHEN p_size > 5 THEN p_size / 50.0::DOUBLE ELSE 1.0 END AS opacity FROM part)
SELECT kind, p_partkey, name, colour, set_name, CASE WHEN set_name IN (SELECT p_brand FROM part WHERE p_partkey % 97 = 0) THEN opacity * 0.2 ELSE opacity END AS opacity FROM o
UNION ALL SELECT 'selected', p_partkey, name, 'red', set_name, opacity FROM o WHERE p_partkey % 97 = 0""")
def selection_overlay(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.when(F.col("p_size") > 5, F.col("p_size") / F.lit(50.0))
    traces = p.select(F.struct("p_partkey", "p_brand").alias("key"), F.col("p_name").alias("name"), F.lit("blue").alias("colour"), size.alias("opacity"))
    chosen = traces.filter(F.col("key.p_partkey") % 97 == 0)
    both = linked.selection_overlay(traces.withColumn("key", F.col("key").cast("struct<p_partkey:string,p_brand:string>")).withColumn("key", F.concat_ws("|", "key.p_partkey", "key.p_brand")), chosen.select(F.concat_ws("|", F.col("key.p_partkey").cast("string"), "key.p_brand").alias("key")), "key", "red")
    out = both.withColumn("set_name", F.substring_index("key", "|", -1))
    dimmed = linked.dim_rest(out, chosen.select(F.col("key.p_brand").alias("set_name")), "set_name", 0.2)
    return dimmed.select("kind", F.substring_index("key", "|", 1).cast("long").alias("p_partkey"), "name", "colour", "set_name", "opacity")


CHANGE_SQL = "SELECT event_id, user_id, old_value, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_value FROM events) WHERE event_type IS DISTINCT FROM old_value"


@query(CHANGE_SQL)
def change_only(spark, sf_dir):
    return linked.change_only(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "user_id", "old_value", "event_type")


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY ts, event_id) AS nr FROM events) WHERE nr = 1")
def history_dedupe(spark, sf_dir):
    return linked.first_of_history(table(spark, sf_dir, "events"), S.fingerprint("user_id", "event_type", "props"), ["ts", "event_id"]).select("event_id")


SESSIONS = """WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS burst FROM g)
SELECT user_id, {pick}(event_id, (ts, event_id)) AS event_id, count(*) AS n_events FROM s GROUP BY user_id, burst"""


@query(SESSIONS.format(pick="arg_max"))
def debounce_last(spark, sf_dir):
    return linked.debounce(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "2 hours")


@query(SESSIONS.format(pick="arg_min"))
def debounce_first(spark, sf_dir):
    return linked.debounce(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", "2 hours", first=True)


# Sources, labels, audits --------------------------------------------------------------------------


@query(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>') AS m FROM pages),
u AS (SELECT page_id, unnest(m) AS mark, unnest(range(1, len(m) + 1))::INTEGER AS nr FROM a)
SELECT page_id, nr, regexp_extract(mark, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS href, trim(regexp_replace(regexp_replace(mark, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS text FROM u""")
def page_links(spark, sf_dir):
    return sources.extract_links(table(spark, sf_dir, "pages"), "page_id").select("page_id", "nr", "href", "text")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, (epoch_us(ts) // 1000) / 1000.0::DOUBLE AS seconds, strftime(ts + INTERVAL 2 HOUR, '%H:%M') AS label, CAST(strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed FROM events""")
def date_labels(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    millis = F.unix_millis(ts)
    return table(spark, sf_dir, "events").select("event_id", S.utc_day(millis).alias("day"), S.millis_to_seconds(millis).alias("seconds"), S.time_label(ts, "Etc/GMT-2", "HH:mm").alias("label"), S.day_first_date(F.date_format(ts, "dd/MM/yyyy")).alias("parsed"))


@query(r"""SELECT event_id, CASE WHEN trim(d) = '' THEN 0.0 ELSE coalesce(TRY_CAST(d AS DOUBLE), 'nan'::DOUBLE) END AS number, nullif(trim(regexp_replace(props, '\s+', ' ', 'g')), '') AS cleaned FROM (SELECT *, regexp_extract(props, '(\d+)', 1) AS d FROM events)""")
def coerce_numbers(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.to_number(F.regexp_extract("props", r"(\d+)", 1)).alias("number"), S.clean_cell(F.col("props")).alias("cleaned"))


@query("SELECT DISTINCT a.l_orderkey, a.l_partkey, a.l_suppkey FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_suppkey AND a.l_suppkey = b.l_partkey AND year(a.l_shipdate) = year(b.l_shipdate)")
def audit_mirror(spark, sf_dir):
    games = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.year("l_shipdate").alias("season"), "l_quantity")
    return audits.mirrored(games, "l_partkey", "l_suppkey", "season", "l_quantity").select("l_orderkey", "l_partkey", "l_suppkey").distinct()


@query("SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def audit_duplicates(spark, sf_dir):
    return audits.duplicates(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"])


@query("SELECT event_id, CASE WHEN CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-28' THEN 'outside' ELSE 'out of order' END AS fault FROM (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY event_id) AS above FROM events) WHERE CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-28' OR CAST(ts AS DATE) < above")
def audit_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("string").alias("raw"), F.to_date("ts").alias("day"), F.to_date(F.lit("2024-01-02")).alias("first"), F.to_date(F.lit("2024-01-28")).alias("last"))
    return audits.date_faults(e, "user_id", "event_id", "raw", "day", "first", "last").select("event_id", "fault")


# Streams ------------------------------------------------------------------------------------------


@query(CHANGE_SQL)
def stream_change(spark, sf_dir):
    closable = feeds.Closable(feeds.read_feed(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "ts")
    return feeds.drain(feeds.changes(closable.feed, "user_id", "ts", "event_id", "event_type"), closable=closable).select("event_id", "user_id", "old_value", "event_type")


@query("SELECT event_id, user_id, old_value, value FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_value FROM (SELECT event_id, user_id, ts, round(value / 50) AS value FROM events)) WHERE value IS DISTINCT FROM old_value")
def stream_change_numbers(spark, sf_dir):
    rows = feeds.read_feed(spark, sf_dir, "events").select("user_id", "ts", "event_id", S.round_half_away(F.col("value") / 50).alias("value"))
    closable = feeds.Closable(rows, "ts")
    return feeds.drain(feeds.changes(closable.feed, "user_id", "ts", "event_id", "value"), closable=closable).select("event_id", "user_id", "old_value", "value")


# a burst comes out once the watermark, an hour behind the last event, has passed two hours after its end
@query(SESSIONS.format(pick="arg_max") + " HAVING max(ts) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events)")
def stream_debounce(spark, sf_dir):
    feed = feeds.read_feed(spark, sf_dir, "events")
    return feeds.drain(feeds.debounced(feed, "user_id", "ts", "event_id", "2 hours", "1 hour"))


@query("SELECT DISTINCT user_id, event_type, props FROM events")
def stream_dedupe(spark, sf_dir):
    feed = feeds.read_feed(spark, sf_dir, "events")
    return feeds.deduplicated_ever(feed, ["user_id", "event_type", "props"], ["ts", "event_id"]).select("user_id", "event_type", "props")


@query("SELECT event_id FROM (SELECT *, lag(event_type || props) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE event_type || props IS DISTINCT FROM before")
def stream_dedupe_previous(spark, sf_dir):
    rows = feeds.read_feed(spark, sf_dir, "events").select("user_id", "ts", "event_id", S.fingerprint("event_type", "props").alias("print"))
    closable = feeds.Closable(rows, "ts")
    return feeds.drain(feeds.changes(closable.feed, "user_id", "ts", "event_id", "print"), closable=closable).select("event_id")


@query(SESSIONS.format(pick="arg_max"))
def stream_debounce_closed(spark, sf_dir):
    closable = feeds.Closable(feeds.read_feed(spark, sf_dir, "events").select("user_id", "ts", "event_id"), "ts")
    return feeds.drain(feeds.debounced(closable.feed, "user_id", "ts", "event_id", "2 hours", "1 hour"), closable=closable)


@query(SESSIONS.format(pick="arg_min").replace("SELECT user_id, arg_min", "SELECT user_id, 'first' AS edge, 1 AS n_events, arg_min").replace(", count(*) AS n_events", "") + " UNION ALL BY NAME " + SESSIONS[SESSIONS.index("SELECT user_id, {pick}") :].format(pick="arg_max").replace("SELECT user_id, ", "SELECT user_id, 'last' AS edge, "))
def stream_edges(spark, sf_dir):
    closable = feeds.Closable(feeds.read_feed(spark, sf_dir, "events").select("user_id", "ts", "event_id"), "ts")
    return feeds.drain(feeds.debounced_now(closable.feed, "user_id", "ts", "event_id", 7200, "1 hour"), closable=closable)


@query(f"WITH {CLOSED} SELECT o_custkey, period, n_games, closing FROM closed")
def stream_closing(spark, sf_dir):
    feed = feeds.read_feed(spark, sf_dir, "orders")
    score = F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "P", 0.5).otherwise(0.0)
    games = feed.select("o_custkey", _period("o_orderdate").alias("period"), score.alias("score"), (1000.0 + F.pmod(F.col("o_orderkey"), F.lit(1000))).alias("opponent"))
    periods = table(spark, sf_dir, "orders").select("o_custkey", _period("o_orderdate").alias("period")).distinct().join(_openings(spark, sf_dir), "o_custkey")
    return feeds.drain(feeds.closings(games, periods, ["o_custkey", "period"], "score", "opponent", "opening", "k"), ["o_custkey", "period"])


@query("SELECT event_id, user_id, old_value, kind FROM (SELECT *, lag(kind) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_value FROM (SELECT *, nullif(event_type, 'click') AS kind FROM events)) WHERE kind IS DISTINCT FROM old_value")
def stream_change_nulls(spark, sf_dir):
    rows = feeds.read_feed(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.nullif("event_type", F.lit("click")).alias("kind"))
    closable = feeds.Closable(rows, "ts")
    return feeds.drain(feeds.changes(closable.feed, "user_id", "ts", "event_id", "kind"), closable=closable).select("event_id", "user_id", "old_value", "kind")


# Pages, CSV and series written and read -----------------------------------------------------------

#: What a page of orders says about an order, as it is rendered and as it is read back.
ORDER_ROW_SQL = f"""orders_of AS (SELECT o_orderkey, o_custkey, o_orderdate, {PERIOD_SQL} AS period, o_orderkey % 11 = 0 AS bad_day, o_orderkey % 4 AS form, (o_orderkey % 9 + 1)::INTEGER AS round_no, o_orderkey % 13 = 0 AS unscored,
  CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'P' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score, (1000 + o_orderkey % 1000)::INTEGER AS opp, floor(o_totalprice / 100)::INTEGER AS total FROM orders)"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page a customer: headings of periods, tables of orders, and a chart, as rating pages have them."""
    games = _order_games(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 100).cast("int").alias("total")), "o_orderkey")
    games = games.join(_openings(spark, sf_dir), "o_custkey")
    key, text = F.col("o_orderkey"), lambda c: c.cast("string")
    round_no = text(key % 9 + 1)
    event = F.when(key % 4 == 0, F.concat(F.lit("League - Rd "), round_no)).when(key % 4 == 1, F.concat(F.lit("League Rd "), round_no)).when(key % 4 == 2, F.concat(F.lit("LeagueRd"), round_no)).otherwise("League")
    score = F.when(key % 13 == 0, "NA").when(F.col("score") == 1, "1").when(F.col("score") == 0.5, "0.5").otherwise("0")
    day = F.when(key % 11 == 0, "91/07/2022").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    cells = [day, event, F.concat(F.lit("\tPlayer  "), text(key % 1000)), score, F.when(key % 13 == 0, "NA").otherwise(text(F.col("opponent").cast("int"))), text(F.col("total"))]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("\n"))
    year, part = F.substring("period", 1, 4), F.substring("period", 6, 1)
    name = F.concat(year, F.when(F.col("o_custkey") % 2 == 0, " - Part ").otherwise(" Part "), part)
    head = F.concat(F.lit("<h3>"), name, F.lit(" /// "), F.when(part == "1", "E").otherwise("W"), F.lit("1 = "), text(F.col("opening")), F.lit(" /// k = "), text(F.col("k")), F.lit("</h3>\n<table>\n"))
    point = F.concat(F.when(key % 2 == 0, "[''").otherwise("["), F.lit(","), F.when(part == "1", text(F.col("total"))).otherwise("null"), F.lit(", "), F.when(part == "2", text(F.col("total"))).otherwise("null"), F.lit("],\n"))
    listed = games.select("o_custkey", "period", head.alias("head"), F.struct("o_orderdate", "o_orderkey", row.alias("row"), point.alias("point")).alias("x"))
    joined = lambda a, field: F.array_join(F.transform(a, lambda x: x[field]), "")
    periods = listed.groupBy("o_custkey", "period", "head").agg(F.array_sort(F.collect_list("x")).alias("x"))
    table_of = F.concat("head", joined("x", "row"), F.lit("</table>\n"))
    whole = periods.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("period", table_of.alias("table"), joined("x", "point").alias("points")))).alias("p"))
    html = F.concat(F.lit("<script>data([ ['Game', 'Part 1', 'Part 2'],\n"), joined("p", "points"), F.lit("]);</script>\n"), joined("p", "table"))
    return whole.select(text(F.col("o_custkey")).alias("page"), html.alias("html"))


@query(f"""WITH {ORDER_ROW_SQL}
SELECT o_custkey::VARCHAR AS player, period, row_number() OVER (PARTITION BY o_custkey, period ORDER BY o_orderdate, o_orderkey)::INTEGER AS pos, CASE WHEN NOT bad_day THEN o_orderdate::DATE END AS date, 'League' AS event, CASE WHEN form < 3 THEN round_no END AS round,
       'Player ' || (o_orderkey % 1000)::VARCHAR AS opponent, CASE WHEN NOT unscored THEN score END AS result, CASE WHEN NOT unscored THEN opp END AS opp_rating, total AS new_rating FROM orders_of WHERE o_custkey IN (SELECT c_custkey FROM customer)""")
def page_ledger(spark, sf_dir):
    found = sources.extract_ledger(_pages(spark, sf_dir))
    return found.select("player", "period", "pos", "date", "event", "round", "opponent", F.col("result").cast("double").alias("result"), "opp_rating", "new_rating")


@query(f"WITH {ORDER_GAMES} SELECT DISTINCT o_custkey::VARCHAR AS player, period, CASE WHEN period LIKE '%P1' THEN 'E' ELSE 'W' END AS list_type, opening, k FROM games JOIN factors USING (o_custkey)")
def page_periods(spark, sf_dir):
    return sources.extract_periods(_pages(spark, sf_dir)).select("player", "period", "list_type", "opening", "k")


@query(f"""WITH {ORDER_ROW_SQL}, numbered AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY period, o_orderdate, o_orderkey) - 1)::INTEGER AS idx FROM orders_of WHERE o_custkey IN (SELECT c_custkey FROM customer))
SELECT o_custkey::VARCHAR AS player, idx, col::INTEGER AS col, CASE WHEN right(period, 1) = (col + 1)::VARCHAR THEN total END AS value FROM numbered, range(2) t(col)""")
def page_chart(spark, sf_dir):
    return sources.extract_chart(_pages(spark, sf_dir))


@query("""SELECT o_custkey::VARCHAR AS name, CASE WHEN o_orderkey % 17 > 0 THEN o_orderdate::DATE END AS date, CASE WHEN o_orderkey % 10 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 10 = 1 THEN 'nan'::DOUBLE ELSE o_totalprice END AS elo_smooth,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS src_pos FROM orders""")
def points_from_csv(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    value = F.when(key % 20 == 0, "").when(key % 20 == 10, " ").when(key % 10 == 1, "junk").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(key % 17 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("bad")
    path = new_path(spark, "points")
    dealt = o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    dealt.select(F.col("o_custkey").alias("Name"), day.alias("Date"), value.alias("ELO_smooth")).write.csv(path, header=True)
    return sources.read_points(spark, path)


@query("""SELECT user_id, count(*)::INTEGER AS n, md5(string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id)) AS order_md5 FROM events GROUP BY user_id""")
def series_written(spark, sf_dir):
    whole = reshape.series(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], {"ids": "event_id", "kinds": "event_type"})
    path = new_path(spark, "series")
    reshape.write_series(whole, path, "json")
    ids = F.transform("ids", lambda i: i.cast("string"))
    return spark.read.schema(whole.schema).json(path).select("user_id", F.size("ids").alias("n"), F.md5(F.array_join(ids, ",")).alias("order_md5"))


# The rest of the linked views, bands and audits ---------------------------------------------------


@query(f"SELECT o_custkey, 'legendonly' AS hidden, 'shown' AS shown FROM ({RATED_SQL})")
def show_all(spark, sf_dir):
    hidden = bands.visibility(band_assign(spark, sf_dir), None, show_all=False).withColumnRenamed("visible", "hidden")
    return bands.visibility(hidden, None, show_all=True).select("o_custkey", "hidden", F.col("visible").alias("shown"))


@query(f"""WITH o(overlay, since, lo, hi) AS (VALUES {_values(bands.OVERLAYS)}), r AS ({RATED_SQL})
SELECT overlay, count(*) AS n_points, count(DISTINCT o_custkey) AS n_members, min(year(o_orderdate) + 25)::INTEGER AS first_year FROM orders JOIN r USING (o_custkey) JOIN o ON (lo IS NULL OR rating >= lo) AND (hi IS NULL OR rating <= hi) AND year(o_orderdate) + 25 >= since GROUP BY overlay""")
def overlay_windows(spark, sf_dir):
    overlays = spark.createDataFrame(bands.OVERLAYS, "overlay string, since int, lo int, hi int")
    points = table(spark, sf_dir, "orders").select("o_custkey", (F.year("o_orderdate") + 25).alias("year")).join(_rated(spark, sf_dir), "o_custkey")
    return bands.overlay_members(points, "rating", overlays, "year").groupBy("overlay").agg(F.count(F.lit(1)).alias("n_points"), F.count_distinct("o_custkey").alias("n_members"), F.min("year").alias("first_year"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY lower(c_name), c_name) - 1 AS place FROM customer")
def collated_places(spark, sf_dir):
    return bands.places(table(spark, sf_dir, "customer"), bands.reader_order("c_name")).select("c_custkey", "place")


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#34'))")
def apply_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return linked.apply_keys(lines, group_keys(spark, sf_dir), "l_partkey").select("l_orderkey", "l_partkey", "l_suppkey")


LISTED = """k AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS p, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS s, list(l_linenumber ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem GROUP BY 1)"""


@query(f"""WITH {LISTED} SELECT l_orderkey, array_to_string([x for x in s if NOT list_contains(p, x)], ',') AS fresh, array_to_string(list_sort(list_distinct(list_concat(p, s))), ',') AS appended, array_to_string(list_concat(p, s), ',') AS flat,
  CASE WHEN l_orderkey % 2 = 0 THEN array_to_string(flatten([[p[i], s[i]] for i in range(1, len(p) + 1)]), ',') ELSE p[1]::VARCHAR || ',' || s[1]::VARCHAR END AS of_point, s[1]::VARCHAR AS of_pair, p[1]::VARCHAR || coalesce(',' || p[3]::VARCHAR, '') AS of_list FROM k""")
def array_edits(spark, sf_dir):
    k = _order_keys(spark, sf_dir)
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    nested = F.zip_with("part", "supp", lambda p, s: F.array(p.cast("string"), s.cast("string")))
    kind = F.when(F.col("l_orderkey") % 2 == 0, "simple").otherwise("nested")
    zero = F.lit(0)
    return k.select(
        "l_orderkey", text(linked.only_new(F.col("part"), F.col("supp"))).alias("fresh"), text(F.array_sort(linked.append_absent(F.col("part"), F.col("supp")))).alias("appended"), text(F.flatten(F.array("part", "supp"))).alias("flat"),
        F.array_join(linked.point_keys(kind, nested, zero), ",").alias("of_point"), linked.point_keys_at_pair(nested, zero, F.lit(1)).alias("of_pair"), text(linked.point_keys_at_list(F.col("part"), F.array(zero, F.lit(2)))).alias("of_list"),
    )


@query(f"""WITH {LISTED}, h AS (SELECT *, l_orderkey % 3 AS kind, [i for i in range(1, len(p) + 1) if p[i] < 400] AS flat, [i for i in range(1, len(p) + 1) if p[i] < 400 AND s[i] < 400] AS nested, len([x for x in p if x >= 400]) = 0 AS every FROM k),
i AS (SELECT *, CASE kind WHEN 0 THEN nested WHEN 1 THEN CASE WHEN every THEN range(1, len(p) + 1) ELSE [] END ELSE flat END AS hit FROM h)
SELECT l_orderkey, array_to_string([p[j] for j in hit], ',') AS parts, array_to_string([n[j] for j in hit], ',') AS inner_lines, array_to_string([s[j] for j in hit], ',') AS inner_supps, array_to_string(n, ',') AS scale FROM i WHERE len(hit) > 0""")
def traces_by_kind(spark, sf_dir):
    k = _order_keys(spark, sf_dir)
    nested = F.zip_with("part", "supp", lambda p, s: F.array(p, s))
    kind = F.when(F.col("l_orderkey") % 3 == 0, "nested").when(F.col("l_orderkey") % 3 == 1, "simple").otherwise("flat")
    traces = k.select("l_orderkey", "part", F.col("part").alias("key"), nested.alias("_nested"), kind.alias("kind"), F.lit("parts").alias("set"), F.col("line").alias("colorscale"), F.struct("line", F.lit(1).alias("width")).alias("marker"), F.array(F.struct("supp")).alias("transforms"))
    cut = matching.filter_by_keys(traces, _low_parts(spark), "l_orderkey", "parts", "key", "kind", "_nested")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return cut.select("l_orderkey", text("part").alias("parts"), text("marker.line").alias("inner_lines"), text(F.get("transforms", F.lit(0))["supp"]).alias("inner_supps"), text("colorscale").alias("scale"))


#: Keys of a table as needles: the parts of three brands, one in sixteen or so.
CHOSEN = "(SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#34'))"


@query(f"""WITH {LISTED}, c AS (SELECT p_partkey FROM part WHERE p_partkey % 199 = 0), label AS (SELECT string_agg(p_partkey::VARCHAR, '<br />' ORDER BY p_partkey::VARCHAR) AS label FROM c),
h AS (SELECT l_orderkey, unnest(range(1, len(p) + 1)) AS i, p, n FROM k), m AS (SELECT l_orderkey, i, p[i] AS part, n[i] AS line FROM h WHERE p[i] IN (SELECT p_partkey FROM c)),
w AS (SELECT l_orderkey, count(*) AS hits, string_agg(part::VARCHAR, ',' ORDER BY i) AS parts, string_agg(line::VARCHAR, ',' ORDER BY i) AS lines FROM m GROUP BY 1)
SELECT k.l_orderkey AS original, CASE WHEN k.l_orderkey % 4 = 0 THEN array_to_string(p, ',') ELSE parts END AS parts, CASE WHEN k.l_orderkey % 4 = 0 THEN array_to_string(n, ',') ELSE lines END AS lines,
  CASE WHEN k.l_orderkey % 3 = 0 THEN 'order' ELSE label END AS name, CASE WHEN k.l_orderkey % 5 = 0 THEN 'group' ELSE label END AS legendgroup, 'red' AS colour, CASE WHEN k.l_orderkey % 2 = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS opacity
FROM k JOIN w USING (l_orderkey), label WHERE k.l_orderkey % 4 > 0 OR hits = len(p)""")
def selected_copies(spark, sf_dir):
    key = F.col("l_orderkey")
    traces = _order_keys(spark, sf_dir).select(
        "l_orderkey", "part", "line", F.col("part").alias("key"), F.lit("parts").alias("set"), F.when(key % 4 == 0, "simple").otherwise("flat").alias("kind"),
        F.when(key % 3 == 0, "order").otherwise("").alias("name"), F.when(key % 5 == 0, "group").alias("legendgroup"), F.lit("blue").alias("colour"), F.when(key % 2 == 0, 0.0).alias("opacity"),
    )
    keys = table(spark, sf_dir, "part").filter("p_partkey % 199 = 0").select("p_partkey")
    cut = matching.selected_copies(traces, keys, "l_orderkey", "parts", "red", matching.joined_keys(keys), kind="kind")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return cut.select(F.col("_original").alias("original"), text("part").alias("parts"), text("line").alias("lines"), "name", "legendgroup", "colour", "opacity")


@query(f"""WITH {LISTED} SELECT l_orderkey, string_agg(p[i]::VARCHAR, ',' ORDER BY i) AS parts FROM (SELECT l_orderkey, p, unnest(range(1, len(p) + 1)) AS i FROM k) WHERE p[i] IN {CHOSEN} GROUP BY 1""")
def traces_by_table(spark, sf_dir):
    traces = _order_keys(spark, sf_dir).select("l_orderkey", "part", F.col("part").alias("key"), F.lit("parts").alias("set"))
    cut = matching.filter_by_keys(traces, group_keys(spark, sf_dir), "l_orderkey", "parts")
    return cut.select("l_orderkey", F.array_join(F.transform("part", lambda x: x.cast("string")), ",").alias("parts"))


@query(f"""WITH {LISTED}, t AS (SELECT *, CASE WHEN l_orderkey % 7 > 0 THEN 'set' || (l_orderkey % 4)::VARCHAR END AS set_name, l_orderkey % 3 AS kind FROM k),
points AS (SELECT l_orderkey, (l_linenumber - 1)::INTEGER AS i FROM lineitem WHERE l_quantity > 45),
picked AS (SELECT set_name, unnest(CASE kind WHEN 0 THEN CASE WHEN i < len(p) THEN [p[i + 1], s[i + 1]] ELSE [] END WHEN 1 THEN p ELSE CASE WHEN i % 2 = 0 THEN [p[i + 1]] ELSE [p[i + 1], p[1]] END END) AS key FROM points JOIN t USING (l_orderkey) WHERE set_name IS NOT NULL)
SELECT set_name, key, count(*) AS n FROM picked GROUP BY ALL""")
def points_through_traces(spark, sf_dir):
    key = F.col("l_orderkey")
    kind = F.when(key % 3 == 0, "nested").when(key % 3 == 1, "simple").otherwise("flat")
    pairs = F.zip_with("part", "supp", lambda p, s: F.array(p, s))
    traces = _order_keys(spark, sf_dir).select("l_orderkey", "part", pairs.alias("pairs"), kind.alias("kind"), F.when(key % 7 > 0, F.concat(F.lit("set"), (key % 4).cast("string"))).alias("set"))
    i = F.col("l_linenumber") - 1
    several = (key % 3 == 2) & (i % 2 == 1)
    points = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select("l_orderkey", F.when(~several, i).alias("number"), F.when(several, F.array(i, F.lit(0))).alias("numbers"))
    return matching.selected_keys(points, traces, "l_orderkey", "part", "number", "numbers", "kind", "pairs").select(F.col("set").alias("set_name"), "key", "n")


@query("""SELECT event_id, d AS difference FROM (SELECT event_id, (2 - event_id % 5)::BIGINT AS d FROM events) WHERE abs(d) > 1""")
def audit_ratings(spark, sf_dir):
    rated = rating_running(spark, sf_dir).withColumn("published", F.col("new_rating") + F.col("event_id") % 5 - 2)
    return audits.rating_differences(rated, "new_rating", "published").select("event_id", "difference")


@query(f"WITH {CLOSED} SELECT o_custkey, period, opening, previous_closing FROM (SELECT *, lag(closing) OVER (PARTITION BY o_custkey ORDER BY period) AS previous_closing FROM closed) WHERE previous_closing <> opening")
def audit_openings(spark, sf_dir):
    return audits.opening_breaks(rating_closing(spark, sf_dir), "o_custkey", "period", "opening", "closing").select("o_custkey", "period", "opening", "previous_closing")


@query(f"""WITH {ORDER_GAMES}, listed AS (SELECT DISTINCT o_custkey, period, opening FROM games JOIN openings USING (o_custkey)),
met AS (SELECT o_orderkey, period, o_orderkey % 97 + 1 AS opponent, 1500 + o_orderkey % 40 AS opp_rating FROM games)
SELECT o_orderkey, opening AS listed FROM met m JOIN listed l ON l.o_custkey = m.opponent AND l.period = m.period WHERE opening <> opp_rating""")
def audit_lists(spark, sf_dir):
    games = _order_games(spark, sf_dir)
    met = games.select("o_orderkey", "period", (F.col("o_orderkey") % 97 + 1).alias("opponent"), (1500 + F.col("o_orderkey") % 40).alias("opp_rating"))
    periods = games.select("o_custkey", "period").distinct().join(_openings(spark, sf_dir), "o_custkey").select(F.col("o_custkey").alias("player"), "period", "opening")
    return audits.list_mismatches(met, periods).select("o_orderkey", "listed")


@query("""WITH d AS (SELECT *, CASE WHEN o_orderkey % 11 > 0 THEN o_orderdate::DATE END AS day FROM orders), a AS (SELECT *, lag(day) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS above FROM d),
f AS (SELECT o_orderkey, CASE WHEN day IS NULL THEN 'unparsable' WHEN day NOT BETWEEN DATE '1993-01-01' AND DATE '1997-12-31' THEN 'outside' WHEN day < above THEN 'out of order' END AS fault FROM a) SELECT * FROM f WHERE fault IS NOT NULL""")
def audit_dates(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 11 > 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("91/07/2022")
    bound = lambda d: F.lit(d).cast("date")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", raw.alias("raw"), S.day_first_date(raw).alias("day"), bound("1993-01-01").alias("first"), bound("1997-12-31").alias("last"))
    return audits.date_faults(o, "o_custkey", "o_orderkey", "raw", "day", "first", "last").select("o_orderkey", "fault")


@query(f"""WITH {INDEXED} SELECT o_custkey, idx, o_totalprice AS in_ledger, CASE WHEN idx % 10 > 0 THEN o_totalprice + 1 END AS in_chart FROM indexed WHERE idx % 10 = 0 OR idx % 7 = 0""")
def audit_chart(spark, sf_dir):
    ledger = reshape.game_index(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "idx", "o_totalprice")
    chart = ledger.filter("idx % 10 > 0").withColumn("o_totalprice", F.when(F.col("idx") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return audits.chart_differences(ledger, chart, ["o_custkey", "idx"], "o_totalprice")


# Keys of any size ---------------------------------------------------------------------------------


@query(ORACLES["rating_running"])
def rating_running_ranges(spark, sf_dir):
    games = _event_games(spark, sf_dir)
    return prefix.running_rating_any(games, ["user_id"], ["ts", "event_id"], "score", "opponent", "opening", "k").select("event_id", "user_id", "new_rating")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS idx FROM orders")
def game_index_ranges(spark, sf_dir):
    return prefix.game_index_any(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


@query(ORACLES["selection_accumulate"])
def selection_accumulate_ranges(spark, sf_dir):
    kept = prefix.accumulate_selection_any(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"], F.col("event_type") == "signup")
    return kept.select("user_id", "event_type", F.col("first_seen.event_id").alias("first_id"))


# Audits that search -------------------------------------------------------------------------------

#: Each order as a game of its customer against another, and that one's own row of it: one in seven is missing, and
#: names, days and years slip at other rates.
TWO_SIDED = """md AS (SELECT o_orderkey AS k, substr(md5(o_custkey::VARCHAR), 1, 10) AS a, substr(md5((o_orderkey % 97 + 1)::VARCHAR), 1, 10) AS b, o_orderdate::DATE AS day, CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'P' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score FROM orders),
g AS (SELECT 2 * k AS id, a AS player, b AS opponent, day, score FROM md
  UNION ALL SELECT 2 * k + 1, CASE WHEN k % 5 = 0 THEN substr(b, 1, 3) || substr(b, 5) ELSE b END, a, (CASE WHEN k % 9 = 0 THEN day + INTERVAL 1 YEAR WHEN k % 4 = 1 THEN day + INTERVAL 2 DAY ELSE day END)::DATE, 1.0 - score FROM md WHERE k % 7 > 0)"""


def _two_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, score = F.col("o_orderkey"), F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "P", 0.5).otherwise(0.0)
    name = lambda c: F.substring(F.md5(c.cast("string")), 1, 10)
    a, b, day = name(F.col("o_custkey")), name(k % 97 + 1), F.to_date("o_orderdate")
    slipped = F.when(k % 5 == 0, F.concat(F.substring(b, 1, 3), F.substring(b, 5, 10))).otherwise(b)
    moved = F.when(k % 9 == 0, F.add_months(day, 12)).when(k % 4 == 1, F.date_add(day, 2)).otherwise(day)
    one = o.select((2 * k).alias("id"), a.alias("player"), b.alias("opponent"), day.alias("day"), score.alias("score"))
    return one.unionByName(o.filter(k % 7 > 0).select((2 * k + 1).alias("id"), slipped.alias("player"), a.alias("opponent"), moved.alias("day"), (1.0 - score).alias("score")))


@query(f"WITH {TWO_SIDED} SELECT x.id, x.score + y.score AS total FROM g x JOIN g y ON y.player = x.opponent AND y.opponent = x.player AND y.day = x.day")
def audit_totals(spark, sf_dir):
    return audits.mirrored(_two_sided(spark, sf_dir), "player", "opponent", "day", "score").select("id", "total")


@query(f"WITH {TWO_SIDED} SELECT id FROM g x WHERE opponent IN (SELECT player FROM g) AND NOT EXISTS (SELECT 1 FROM g y WHERE y.player = x.opponent AND y.opponent = x.player AND y.day = x.day)")
def audit_unmirrored(spark, sf_dir):
    games = _two_sided(spark, sf_dir)
    return audits.unmirrored(games, games, "player", "opponent", "day").select("id")


@query(f"""WITH RECURSIVE {TWO_SIDED},
alone AS (SELECT * FROM g x WHERE NOT EXISTS (SELECT 1 FROM g y WHERE y.player = x.opponent AND y.opponent = x.player AND y.day = x.day)),
posts AS (SELECT name, unnest(grams) AS gram, len(grams) AS n FROM (SELECT name, list_distinct([(' ' || lower(name) || ' ')[i:i + 2] for i in range(1, length(name) + 1)]) AS grams FROM (SELECT player AS name FROM alone UNION SELECT opponent FROM alone))),
sim AS (SELECT p.name, q.name AS other, 2.0::DOUBLE * count(*) / (max(p.n) + max(q.n)) AS alike FROM posts p JOIN posts q USING (gram) GROUP BY 1, 2 HAVING 2.0::DOUBLE * count(*) / (max(p.n) + max(q.n)) >= 0.6),
met AS (SELECT x.id, y.id AS other_id, least(p.alike, q.alike) AS alike, p.alike + q.alike AS both_alike, x.score + y.score AS total,
  CASE WHEN abs(date_diff('day', x.day, y.day)) <= 3 THEN abs(date_diff('day', x.day, y.day)) WHEN month(x.day) = month(y.day) AND day(x.day) = day(y.day) THEN 4 END AS days
  FROM alone x JOIN sim p ON p.name = x.player JOIN sim q ON q.name = x.opponent JOIN alone y ON y.opponent = p.other AND y.player = q.other AND x.id < y.id),
pairs AS (SELECT *, row_number() OVER (ORDER BY alike DESC, both_alike DESC, days, id, other_id) AS rk FROM met WHERE days IS NOT NULL AND total = 1.0),
r AS (
  SELECT 0 AS step, rk, id, other_id FROM pairs
  UNION ALL
  SELECT step + 1, rk, id, other_id FROM r WHERE NOT EXISTS (
    SELECT 1 FROM r t JOIN (SELECT node, min(rk) AS best FROM (SELECT id AS node, rk FROM r UNION ALL SELECT other_id, rk FROM r) GROUP BY node) u ON u.node = t.id AND u.best = t.rk
    JOIN (SELECT node, min(rk) AS best FROM (SELECT id AS node, rk FROM r UNION ALL SELECT other_id, rk FROM r) GROUP BY node) v ON v.node = t.other_id AND v.best = t.rk
    WHERE t.id IN (r.id, r.other_id) OR t.other_id IN (r.id, r.other_id))),
least_of AS (SELECT step, node, min(rk) AS best FROM (SELECT step, id AS node, rk FROM r UNION ALL SELECT step, other_id, rk FROM r) GROUP BY ALL),
taken AS (SELECT DISTINCT r.rk FROM r JOIN least_of u ON u.step = r.step AND u.node = r.id AND u.best = r.rk JOIN least_of v ON v.step = r.step AND v.node = r.other_id AND v.best = r.rk)
SELECT id, other_id, alike, days::INTEGER AS days, total FROM pairs WHERE rk IN (SELECT rk FROM taken)""")
def audit_near_mirror(spark, sf_dir):
    return audits.nearly_mirrored(_two_sided(spark, sf_dir), "id", "player", "opponent", "day", "score")


@query("""WITH RECURSIVE d AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderkey % 11 > 0),
g AS (SELECT o_custkey, list(day ORDER BY o_orderkey) AS d, list(o_orderkey ORDER BY o_orderkey) AS k FROM d GROUP BY 1),
f AS (SELECT o_custkey, 1 AS i, [1] AS l FROM g
  UNION ALL SELECT f.o_custkey, i + 1, list_append(l, 1 + coalesce(list_max([l[j] for j in range(1, i + 1) if g.d[j] <= g.d[i + 1]]), 0)) FROM f JOIN g ON g.o_custkey = f.o_custkey WHERE i < len(g.d)),
whole AS (SELECT f.* FROM f JOIN g USING (o_custkey) WHERE i = len(d)),
b AS (SELECT o_custkey, l, list_max(l) AS want, i + 1 AS place FROM whole
  UNION ALL SELECT o_custkey, l, want - 1, list_max([j for j in range(1, place) if l[j] = want]) FROM b WHERE want >= 1),
kept AS (SELECT g.k[b.place] AS o_orderkey FROM b JOIN g USING (o_custkey) WHERE b.place <= len(g.k))
SELECT o_orderkey FROM d WHERE o_orderkey NOT IN (SELECT o_orderkey FROM kept)""")
def audit_disorder(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 11 > 0, F.to_date("o_orderdate")).alias("day"))
    return audits.order_faults(o, "o_custkey", "o_orderkey", "day").select("o_orderkey")


#: Orders by customer and half-year, where every third customer's first three rows of a half-year stand once more at
#: the end of the next one; a few half-years have their closing set by an adjustment.
COPIED = f"""{ORDER_GAMES},
own AS (SELECT o_custkey, (2 * substr(period, 1, 4)::BIGINT + (period LIKE '%P2')::BIGINT) AS period_no, row_number() OVER (PARTITION BY o_custkey, period ORDER BY o_orderkey) AS pos, score, opp FROM games),
listed AS (SELECT * FROM own UNION ALL SELECT o_custkey, period_no + 1, 100 + pos, score, opp FROM own WHERE o_custkey % 3 = 0 AND pos <= 3),
met AS (SELECT x.o_custkey, x.period_no, x.pos, x.pos - y.pos AS shift, y.pos AS from_pos FROM listed x JOIN listed y ON y.o_custkey = x.o_custkey AND y.period_no + 1 = x.period_no AND y.score = x.score AND y.opp = x.opp),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY o_custkey, period_no, shift ORDER BY pos) AS run FROM met),
blocks AS (SELECT o_custkey, period_no, min(pos) AS first_pos, min(from_pos) AS from_pos, count(*) AS n FROM runs GROUP BY o_custkey, period_no, shift, run HAVING count(*) >= 2)"""


def _copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _order_games(spark, sf_dir)
    no = 2 * F.substring("period", 1, 4).cast("long") + F.col("period").endswith("P2").cast("long")
    own = prefix.game_index_any(games.withColumn("place", F.struct("o_custkey", "period")), "place", ["o_orderkey"]).select("o_custkey", no.alias("period_no"), F.col("idx").alias("pos"), "score", "opponent")
    again = own.filter("o_custkey % 3 = 0 AND pos <= 3").select("o_custkey", (F.col("period_no") + 1).alias("period_no"), (100 + F.col("pos")).alias("pos"), "score", "opponent")
    return own.unionByName(again)


@query(f"WITH {COPIED} SELECT * FROM blocks")
def audit_copies(spark, sf_dir):
    return audits.copied_blocks(_copied(spark, sf_dir), "o_custkey", "period_no", "pos", ["score", "opponent"])


@query(f"""WITH {COPIED}, clean AS (SELECT * FROM listed l WHERE NOT EXISTS (SELECT 1 FROM blocks b WHERE b.o_custkey = l.o_custkey AND b.period_no = l.period_no AND l.pos BETWEEN b.first_pos AND b.first_pos + b.n - 1))
SELECT o_custkey, period_no, count(*) AS n_games, CASE WHEN o_custkey % 11 = 0 AND period_no % 3 = 0 THEN 1500 + o_custkey % 100 ELSE CAST(floor(max(opening) + CAST(sum(CAST(k * (score - {EXPECTED.format(opp='opp', own='opening')}) AS DECIMAL(18,6))) AS DOUBLE) + 0.5) AS BIGINT) END AS closing FROM clean JOIN factors USING (o_custkey) GROUP BY o_custkey, period_no""")
def repaired_closings(spark, sf_dir):
    games = _copied(spark, sf_dir)
    clean = audits.without_copies(games, audits.copied_blocks(games, "o_custkey", "period_no", "pos", ["score", "opponent"]), "o_custkey", "period_no", "pos")
    closed = ratings.closing_rating(ratings.attach_periods(clean, _openings(spark, sf_dir), ["o_custkey"]), ["o_custkey", "period_no"], "score", "opponent", "opening", "k")
    set_directly = clean.select("o_custkey", "period_no").distinct().filter("o_custkey % 11 = 0 AND period_no % 3 = 0").withColumn("adjusted", 1500 + F.col("o_custkey") % 100)
    return ratings.with_adjustments(closed, set_directly, ["o_custkey", "period_no"]).select("o_custkey", "period_no", "n_games", "closing")


# Feeds with stored state --------------------------------------------------------------------------


@query("SELECT l_partkey AS key FROM lineitem WHERE l_quantity >= 25 INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount >= 0.05 INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def stream_handles(spark, sf_dir):
    """The three filters of ``handles_intersect`` set one after the other, a fourth set and cleared, the first set anew."""
    line = table(spark, sf_dir, "lineitem")
    state = stored.HandleFeed(spark, "long")
    steps = [("quantity", "l_quantity >= 45"), ("discount", "l_discount >= 0.05"), ("flag", "l_returnflag = 'R'"), ("line", "l_linenumber = 1"), ("line", None), ("never", None), ("quantity", "l_quantity >= 25")]
    for n, (handle, where) in enumerate(steps):
        state.process_table(handle, None if where is None else line.filter(where).select(F.col("l_partkey").alias("key")), n)
    return state.members(len(steps) - 1)


@query(ORACLES["rating_chained"])
def stream_chained(spark, sf_dir):
    """Games in three batches, dealt by order number, so later batches change periods in the middle."""
    games = _order_games(spark, sf_dir).join(_openings(spark, sf_dir).select("o_custkey"), "o_custkey", "left_semi")
    state = stored.ChainedFeed(spark, _openings(spark, sf_dir).withColumnRenamed("o_custkey", "player"), "long")
    for n in range(3):
        state.process(games.filter(F.pmod(F.hash("o_orderkey"), F.lit(3)) == n).select(F.col("o_custkey").alias("player"), "period", "score", "opponent"), n)
    return state.latest(2).withColumnRenamed("player", "o_custkey")


# Forms that the queries above do not reach --------------------------------------------------------

BUILT = """built AS (SELECT page_id, '<h2>Top ' || page_id::VARCHAR || '</h2><!-- <h3>Old</h3><a href="old.html">gone</a> -->' || html || '<H3 class="x">The  End</H3><a href=''end.html''>the <b>end</b></a>' AS h FROM pages)"""


@query(rf"""WITH {BUILT}, a AS (SELECT page_id, regexp_extract_all(regexp_replace(h, '(?s)<!--.*?-->', '', 'g'), '(?is)(<h[1-6][^>]*>.*?</h[1-6]>|<a\s[^>]*href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>)', 1) AS m FROM built),
u AS (SELECT page_id, unnest(m) AS mark, unnest(range(len(m))) AS pos FROM a),
t AS (SELECT *, lower(mark)[1:2] = '<h' AS head, trim(regexp_replace(regexp_replace(mark, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS plain FROM u),
w AS (SELECT *, last_value(CASE WHEN head THEN plain END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS heading FROM t)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos)::INTEGER AS nr, regexp_extract(mark, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS href, plain AS text, heading FROM w WHERE NOT head""")
def page_links_headed(spark, sf_dir):
    """Links under their headings, without what stands in comments."""
    text = lambda t: F.lit(t)
    built = F.concat(text("<h2>Top "), F.col("page_id").cast("string"), text('</h2><!-- <h3>Old</h3><a href="old.html">gone</a> -->'), "html", text("<H3 class=\"x\">The  End</H3><a href='end.html'>the <b>end</b></a>"))
    return sources.extract_links(table(spark, sf_dir, "pages").withColumn("html", built), "page_id", comments=False)


@query("SELECT p_partkey, coalesce(nullif(CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN p_name END, ''), nullif(CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END, ''), p_type) AS name FROM part")
def first_names(spark, sf_dir):
    key = F.col("p_partkey")
    name = S.first_non_empty(F.when(key % 3 == 0, "").when(key % 3 == 1, F.col("p_name")), F.when(key % 2 == 0, F.col("p_brand")).otherwise(""), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


#: First letters in a reader's order: letters first, then accents, whatever the case.
LETTERS = ["a", "A", "\u00e1", "\u00c4", "b", "e", "\u00c9", "\u00ea", "n", "\u00f1", "o", "\u00d6", "z"]
PLAIN_LETTERS = "aaaabeeennooz"


@query(f"""WITH l(i, letter, plain) AS (VALUES {', '.join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(zip(LETTERS, PLAIN_LETTERS)))})
SELECT c_custkey, letter || right(c_name, 9) AS name, row_number() OVER (ORDER BY plain, right(c_name, 9)) - 1 AS place FROM customer JOIN l ON i = c_custkey % {len(LETTERS)}""")
def collated_accents(spark, sf_dir):
    letters = F.array(*[F.lit(x) for x in LETTERS])
    name = F.concat(F.get(letters, (F.col("c_custkey") % len(LETTERS)).cast("int")), F.substring("c_name", -9, 9))
    return bands.places(table(spark, sf_dir, "customer").select("c_custkey", name.alias("name")), bands.reader_order("name")).select("c_custkey", "name", "place")


@query(ORACLES["key_diff"])
def key_diff_unique(spark, sf_dir):
    """``key_diff`` of lists that are refused if a key is repeated."""
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    first = days.agg(F.min("day").alias("first"))
    of = lambda n: days.join(F.broadcast(first), F.col("day") == F.date_add("first", n)).select("user_id")
    return linked.key_diff(of(7), of(14), "user_id", unique=True)
