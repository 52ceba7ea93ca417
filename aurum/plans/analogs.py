"""Bronze-shaped inputs derived from the driver's TPC-H-style tables.

The football feeds are not available as data, so each bronze table is derived from a
driver table with Spark (joins and aggregations that grow with the data):

  teams         nation + region, plus a per-nation customer aggregate
  players       customer LEFT JOIN a per-customer season aggregate of orders x lineitem
  gameweeks     orders grouped by period (7-day steps since 1995-01-01)
  fixtures      lineitem x orders x customer x supplier; home = customer nation,
                away = supplier nation, period of the ship date
  gameweek_live orders x lineitem grouped by (customer, order period)

The same definitions are written once more as SQL in ``aurum.registry.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.functions.scalars import period_of

# ---- fixed values of the analog (shared with the SQL oracle) -----------------------
PERIOD_ORIGIN = "1995-01-01"
PERIOD_DAYS = 7
LAST_FINISHED = 300          # periods <= 300 are finished; 300 is previous, 301 current, 302 next
LAST_CHECKED = 299           # periods <= 299 are finished and data-checked
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}  # others -> 5
# -----------------------------------------------------------------------------------

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


_LOADED: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name``; the DataFrame is reused per session so the file listing
    and footer read happen once (it stays lazy: every query still scans the files)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _LOADED:
        _LOADED[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _LOADED[key]


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _dec(whole: Column | str, frac: Column | str) -> Column:
    """Numeric text '<whole>.<frac>' as the feed delivers it (NULL if a part is NULL)."""
    return F.concat(_s(whole), F.lit("."), _s(frac))


def period(ts: str) -> Column:
    return period_of(ts, PERIOD_ORIGIN, PERIOD_DAYS)


def _line_stats(prefix: str = "") -> list[Column]:
    """Per-group counters shared by the season and the per-period aggregates."""
    ci = F.count_if
    return [
        ci(F.col("l_linenumber") == 1).alias("starts"),
        ci(F.col("l_returnflag") == "R").alias("goals_scored"),
        ci(F.col("l_returnflag") == "A").alias("assists"),
        ci(F.col("l_discount") == 0.0).alias("clean_sheets"),
        ci(F.col("l_linestatus") == "O").alias("goals_conceded"),
        ci(F.col("l_quantity") == 1.0).alias("own_goals"),
        ci(F.col("l_quantity") == 50.0).alias("penalties_saved"),
        ci(F.col("l_quantity") == 2.0).alias("penalties_missed"),
        ci(F.col("l_discount") >= 0.09).alias("yellow_cards"),
        ci(F.col("l_tax") >= 0.08).alias("red_cards"),
        ci(F.col("l_linenumber") >= 6).alias("saves"),
        ci(F.col("l_tax") == 0.0).alias("bonus"),
        F.sum("l_linenumber").cast("long").alias("bps"),
        F.sum("l_quantity").cast("long").alias("total_points"),
        F.count(F.lit(1)).alias("n_lines"),
    ]


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")


def bronze_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    bal = F.col("c_acctbal")
    cs = load(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(bal >= 5000.0).alias("win"),
        F.count_if((bal >= 2000.0) & (bal < 5000.0)).alias("draw"))
    t = (n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
          .join(cs, n["n_nationkey"] == cs["c_nationkey"], "left"))
    k = F.col("n_nationkey").cast("long")
    return t.select(
        k.alias("id"),
        F.col("n_regionkey").cast("long").alias("code"),
        F.col("n_name").alias("name"),
        F.concat(F.substring("r_name", 1, 3), _s(k)).alias("short_name"),
        (k + 1).alias("position"),
        "played", "win", "draw",
        (F.col("played") - F.col("win") - F.col("draw")).alias("loss"),
        (F.col("win") * 3 + F.col("draw")).alias("points"),
        (k % 5 + 1).alias("strength"),
        (k * 10 + 1000).alias("strength_overall_home"),
        (k * 10 + 1010).alias("strength_overall_away"),
        (k + 1100).alias("strength_attack_home"),
        (k + 1150).alias("strength_attack_away"),
        (k + 1200).alias("strength_defence_home"),
        (k + 1250).alias("strength_defence_away"),
        F.when(k % 7 == 3, F.lit("n/a")).otherwise(_dec(F.col("played") % 10, k % 10)).alias("form"),
    )


def bronze_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    season = _order_lines(spark, sf_dir).groupBy("o_custkey").agg(*_line_stats())
    c = load(spark, sf_dir, "customer")
    p = c.join(season, c["c_custkey"] == season["o_custkey"], "left")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    elem = None
    for name, code in SEGMENT_CODES.items():
        elem = F.when(seg == name, F.lit(code)) if elem is None else elem.when(seg == name, F.lit(code))
    now_cost = F.floor(F.col("c_acctbal") / F.lit(100.0)).cast("long")
    last = key % 10
    status = (F.when(last == 4, "d").when(last == 5, "i").when(last == 6, "s")
               .when(last == 7, "u").when(last == 8, "n").when(last == 9, "x").otherwise("a"))
    pct = (F.when(key % 13 == 0, F.lit(""))
            .when(key % 17 == 0, F.lit("abc"))
            .when(key % 19 == 0, F.concat(_s(key % 20), F.lit("d")))
            .otherwise(_dec(key % 20, key % 10)))
    g, a, nl = F.col("goals_scored"), F.col("assists"), F.col("n_lines")
    return p.select(
        key.alias("id"),
        F.col("c_nationkey").cast("long").alias("team"),
        elem.otherwise(F.lit(5)).cast("long").alias("element_type"),
        F.when(key % 50 == 7, F.lit(None).cast("string")).otherwise(F.substring("c_name", 1, 8)).alias("first_name"),
        F.substring("c_name", 10, 1 << 20).alias("second_name"),
        F.col("c_name").alias("web_name"),
        now_cost.alias("now_cost"),
        (now_cost % 7 - 3).alias("cost_change_start"),
        (now_cost % 3 - 1).alias("cost_change_event"),
        (nl * 3).alias("transfers_in_event"),
        (F.col("starts") * 5).alias("transfers_out_event"),
        (nl * 100).alias("transfers_in"),
        (F.col("total_points") * 2).alias("transfers_out"),
        "total_points",
        (F.col("total_points") % 17).alias("event_points"),
        (nl * 30).alias("minutes"),
        "starts", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals",
        "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus", "bps",
        F.when(last <= 3, F.lit(100)).when(last == 4, F.lit(50)).cast("long").alias("chance_of_playing_next_round"),
        (F.col("starts") % 3).alias("dreamteam_count"),
        pct.alias("selected_by_percent"),
        _dec(F.col("total_points") % 9, nl % 10).alias("points_per_game"),
        _dec(nl % 8, key % 10).alias("form"),
        _dec(g % 5, a % 10).alias("value_form"),
        _dec(F.col("total_points") % 30, F.col("bps") % 10).alias("value_season"),
        _dec(F.col("bps"), F.col("starts") % 10).alias("influence"),
        F.concat(_s(a * 7), F.lit(".5")).alias("creativity"),
        _dec(g * 11, F.col("clean_sheets") % 10).alias("threat"),
        _dec(nl, F.col("bonus") % 10).alias("ict_index"),
        _dec(g, key % 100).alias("expected_goals"),
        _dec(a, key % 7).alias("expected_assists"),
        _dec(g + a, key % 9).alias("expected_goal_involvements"),
        F.concat(_s(F.col("goals_conceded")), F.lit(".25")).alias("expected_goals_conceded"),
        status.alias("status"),
        F.when(last == 5, F.concat(F.lit("Knock - "), F.col("c_name"))).otherwise(F.lit("")).alias("news"),
        (F.col("total_points") > 1000).alias("in_dreamteam"),
    )


def bronze_gameweeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").withColumn("gw", period("o_orderdate"))
    g = o.groupBy("gw").agg(
        F.min("o_orderdate").alias("deadline_time"),
        F.count_if(F.col("o_orderstatus") == "F").alias("average_entry_score"),
        F.max(F.floor(F.col("o_totalprice") / F.lit(1000.0))).cast("long").alias("highest_score"),
        F.count(F.lit(1)).alias("ranked_count"),
        F.min("o_custkey").alias("most_selected"),
        F.max("o_custkey").alias("most_captained"),
        (F.min("o_custkey") + 1).alias("most_vice_captained"),
        (F.max("o_custkey") - F.min("o_custkey")).alias("most_transferred_in"),
        (F.min("o_custkey") + F.max("o_custkey")).alias("top_element"),
        F.sum(F.col("o_orderkey") % 10).cast("long").alias("transfers_made"),
    )
    gw = F.col("gw")
    return g.select(
        gw.alias("id"),
        F.concat(F.lit("Gameweek "), _s(gw)).alias("name"),
        "deadline_time",
        (gw <= LAST_FINISHED).alias("finished"),
        (gw <= LAST_CHECKED).alias("data_checked"),
        "average_entry_score", "highest_score", "ranked_count", "most_selected", "most_captained",
        "most_vice_captained", "most_transferred_in", "top_element", "transfers_made",
        (gw == LAST_FINISHED).alias("is_previous"),
        (gw == LAST_FINISHED + 1).alias("is_current"),
        (gw == LAST_FINISHED + 2).alias("is_next"),
    )


def bronze_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus",
        "l_returnflag", "l_shipdate")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # attach the customer's nation at order grain first (a quarter of the line rows), so
    # the line-sized rows are shuffled once for the order join and once for the supplier join
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_nationkey")
    f = (li.join(oc, li["l_orderkey"] == oc["o_orderkey"])
           .join(s, F.col("l_suppkey") == s["s_suppkey"]))
    fin = F.col("l_linestatus") == "F"
    return f.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("code"),
        period("l_shipdate").alias("event"),
        F.col("l_shipdate").alias("kickoff_time"),
        F.col("c_nationkey").cast("long").alias("team_h"),
        F.col("s_nationkey").cast("long").alias("team_a"),
        F.col("l_linenumber").cast("long").alias("team_h_score"),
        (F.col("l_quantity").cast("long") % 8).alias("team_a_score"),
        (F.col("l_partkey") % 5 + 1).alias("team_h_difficulty"),
        (F.col("l_suppkey") % 5 + 1).alias("team_a_difficulty"),
        F.lit(90).cast("long").alias("minutes"),
        fin.alias("finished"),
        (fin | (F.col("l_returnflag") == "N")).alias("started"),
    )


def bronze_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _order_lines(spark, sf_dir).withColumn("gw", period("o_orderdate"))
    mins = F.sum(F.when(F.col("l_linestatus") == "F", F.lit(30)).otherwise(F.lit(0))).cast("long")
    g = lo.groupBy("o_custkey", "gw").agg(mins.alias("minutes"), *_line_stats())
    key, gw = F.col("o_custkey"), F.col("gw")
    ga, a, nl = F.col("goals_scored"), F.col("assists"), F.col("n_lines")
    return g.select(
        key.alias("id"), gw.alias("gameweek"),
        "minutes", "starts", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals",
        "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus", "bps",
        "total_points",
        _dec(F.col("bps"), nl % 10).alias("influence"),
        F.concat(_s(a * 7), F.lit(".5")).alias("creativity"),
        F.concat(_s(ga * 11), F.lit(".0")).alias("threat"),
        _dec(nl, F.col("bonus") % 10).alias("ict_index"),
        _dec(ga, key % 100).alias("expected_goals"),
        _dec(a, gw % 10).alias("expected_assists"),
        _dec(ga + a, key % 9).alias("expected_goal_involvements"),
        _dec(F.col("goals_conceded"), gw % 4).alias("expected_goals_conceded"),
        (F.col("total_points") > 100).alias("in_dreamteam"),
    )
