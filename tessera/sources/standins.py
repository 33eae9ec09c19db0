"""Reference-shaped inputs derived from the driver tables.

The reference's inputs (player seasons, actor films, games, events with hosts
and devices, match CSVs) are not shipped; these views derive equivalent inputs
from the TPC-H-like tables with plain projections and aggregations, so every
pipeline reads whole driver tables and its work grows with them.

Fixed derivation values (the same numbers appear in the oracle SQL):
  host        = event_type || ':' || (user_id % 50)
  device_id   = props.k
  browser     = 'b' || (k % 4); NULL when k % 17 = 0; a second browser
                'b' || (k % 4 + 1) when k % 10 = 0 (device fan-out)
  home team   = 1 + (o_custkey % 7)
  map id      = o_custkey % 25
  hot match   = a third of all line items (l_orderkey % 3 = 0) belong to match 0, one player each (l_orderkey * 8 + l_linenumber);
                half of its medal rows (l_linenumber % 2 = 0) are of player 8, who has one more detail row
  medal player = l_suppkey; -l_suppkey (a player without details) when l_partkey % 11 = 0
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import load


# ---------------------------------------------------------------- cumulative
def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, year): the 'player season' stand-in."""
    o = load(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey", F.year("o_orderdate").alias("year"))
             .agg(F.count(F.lit(1)).alias("n_orders"),
                  F.sum("o_totalprice").alias("total_price"),
                  F.avg("o_totalprice").alias("avg_price")))


def customer_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static per-entity attributes (the 'height, college ...' stand-in)."""
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per (customer, year): the 'actor films' stand-in."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_custkey", F.year("o_orderdate").alias("year"),
                    "o_orderkey", "o_totalprice", "o_orderpriority")


# ---------------------------------------------------------------- events
def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a host and a device id, as the datelist pipelines expect."""
    e = load(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id", "ts",
        F.concat(F.col("event_type"), F.lit(":"),
                 (F.col("user_id") % 50).cast("string")).alias("host"),
        F.get_json_object("props", "$.k").cast("int").alias("device_id"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device dimension derived from the device ids seen in events."""
    k = activity_events(spark, sf_dir).select("device_id").distinct()
    primary = k.select(
        "device_id",
        F.when(F.col("device_id") % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("b"), (F.col("device_id") % 4).cast("string")))
         .alias("browser_type"))
    second = (k.where(F.col("device_id") % 10 == 0)
               .select("device_id",
                       F.concat(F.lit("b"), (F.col("device_id") % 4 + 1).cast("string"))
                        .alias("browser_type")))
    return primary.unionByName(second)


# ---------------------------------------------------------------- games
def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"),
        (F.lit(1) + F.col("o_custkey") % 7).cast("int").alias("home_team_id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("comment"))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as player-in-game rows; the player name comes from supplier."""
    li = load(spark, sf_dir, "lineitem")
    s = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("player_name"))
    return (li.join(s, "l_suppkey", "left")
              .select(F.col("l_orderkey").alias("game_id"),
                      F.col("l_linenumber").alias("team_id"),
                      F.col("l_suppkey").alias("player_id"),
                      "player_name",
                      F.col("l_returnflag").alias("team_abbreviation"),
                      F.col("l_linestatus").alias("start_position"),
                      F.format_string("%d:%02d", F.col("l_quantity").cast("int"),
                                      (F.col("l_extendedprice").cast("bigint") % 60)
                                      .cast("int")).alias("min"),
                      F.col("l_quantity").cast("int").alias("pts"),
                      "l_partkey", "l_extendedprice", "l_discount", "l_tax",
                      "l_shipdate"))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands with duplicate rows (one per part): the 'teams' stand-in."""
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("team_id"), F.col("p_partkey"),
                    F.col("p_name").alias("nickname"), F.col("p_type").alias("city"),
                    F.col("p_size").alias("year_founded"))


# ---------------------------------------------------------------- matches
def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("match_id"),
                    (F.col("o_custkey") % 25).cast("int").alias("mapid"),
                    F.col("o_orderpriority").alias("playlist_id"),
                    F.to_date("o_orderdate").alias("completion_date"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"),
                     F.col("l_suppkey").alias("player_gamertag"),
                     F.col("l_quantity").cast("int").alias("player_total_kills"),
                     F.col("l_linenumber").alias("player_total_deaths"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("medal_id"), F.col("p_name").alias("name"))


def medal_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"),
                     F.when(F.col("l_partkey") % 11 == 0, -F.col("l_suppkey"))
                      .otherwise(F.col("l_suppkey")).alias("player_gamertag"),
                     F.col("l_partkey").alias("medal_id"),
                     F.col("l_quantity").cast("int").alias("count"))


def hot_matches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matches, details, medal rows) of which a third belong to match 0, and half of its medals to one player."""
    o, li = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    hot = F.col("l_orderkey") % 3 == 0
    match = F.when(hot, F.lit(0)).otherwise(F.col("l_orderkey")).cast("bigint").alias("match_id")
    own = F.when(hot, F.col("l_orderkey") * 8 + F.col("l_linenumber")).otherwise(F.col("l_suppkey"))
    star = F.when(hot & (F.col("l_linenumber") % 2 == 0), F.lit(8)).otherwise(own)
    game = F.when(F.col("o_orderkey") == 3, F.lit(0)).otherwise(F.col("o_orderkey")).cast("bigint").alias("match_id")
    kept = (F.col("o_orderkey") % 3 != 0) | (F.col("o_orderkey") == 3)
    matches_ = o.where(kept).select(game, (F.col("o_custkey") % 25).cast("int").alias("mapid"),
                                    F.col("o_orderpriority").alias("playlist_id"))
    details = li.select(match, own.cast("bigint").alias("player_gamertag"), F.col("l_quantity").cast("int").alias("player_total_kills"))
    star_row = matches_.where("match_id = 0").select("match_id", F.lit(8).cast("bigint").alias("player_gamertag"),
                                                     F.lit(1).alias("player_total_kills"))
    medal_rows = li.select(match, star.cast("bigint").alias("player_gamertag"), F.col("l_partkey").alias("medal_id"),
                           F.col("l_quantity").cast("int").alias("count"))
    return matches_, details.unionByName(star_row), medal_rows
