"""Fact table (ops 20, 21): line items as player-in-game rows, orders as games.

Flags search the game's priority text: 'URGENT' -> dim_did_not_play,
'HIGH' -> dim_did_not_dress, 'NOT SPECIFIED' -> dim_not_with_team.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.facts import absence_report, build_fact
from tessera.sources import standins as S

# fixed values: flag name -> substring of the priority text
FLAGS = {"dim_did_not_play": "URGENT", "dim_did_not_dress": "HIGH",
         "dim_not_with_team": "NOT SPECIFIED"}
GRAIN = ["game_id", "team_id", "player_id"]
ORDER = ["l_partkey", "pts", "l_extendedprice", "l_discount", "l_tax", "team_abbreviation",
         "start_position", "l_shipdate"]


def fact(spark, d):
    return build_fact(
        S.game_details(spark, d), S.games(spark, d), "game_id", GRAIN, ORDER,
        dims={"dim_game_date": "game_date",
              "dim_season": F.col("season").cast("bigint"),
              "dim_team_id": F.col("team_id").cast("bigint"),
              "dim_player_id": "player_id",
              "dim_player_name": "player_name",
              "dim_start_position": "start_position"},
        flags=FLAGS, text_col="comment",
        measures={"m_pts": F.col("pts").cast("bigint"),
                  "m_extendedprice": "l_extendedprice",
                  "m_discount": "l_discount",
                  "m_tax": "l_tax"},
        minutes_col="min", home_flag=("team_id", "home_team_id"))


def q_fact_build(spark, d):
    return fact(spark, d)


def q_fact_report(spark, d):
    r = absence_report(fact(spark, d), "dim_player_name", "m_pts", "dim_not_with_team")
    return r.select("dim_player_name", F.col("num_games").cast("bigint").alias("num_games"),
                    F.col("total_pts").cast("bigint").alias("total_pts"),
                    F.col("bailed_num").cast("bigint").alias("bailed_num"),
                    "bailed_pct")


QUERIES = {"fact_build": q_fact_build, "fact_report": q_fact_report}

GD_SQL = """
  gd AS (
    SELECT l.l_orderkey AS game_id, l.l_linenumber AS team_id, l.l_suppkey AS player_id,
           s.s_name AS player_name, l.l_returnflag AS team_abbreviation,
           l.l_linestatus AS start_position,
           printf('%d:%02d', CAST(trunc(l.l_quantity) AS INTEGER),
                  CAST(trunc(l.l_extendedprice) AS BIGINT) % 60) AS "min",
           CAST(trunc(l.l_quantity) AS INTEGER) AS pts,
           l.l_partkey, l.l_extendedprice, l.l_discount, l.l_tax, l.l_shipdate
    FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey)"""

FACT_SQL = f"""
  WITH {GD_SQL},
  d AS (
    SELECT * FROM (
      SELECT gd.*, row_number() OVER (
          PARTITION BY game_id, team_id, player_id
          ORDER BY l_partkey, pts, l_extendedprice, l_discount, l_tax, team_abbreviation,
                   start_position, l_shipdate) AS rn
      FROM gd) WHERE rn = 1),
  g AS (
    SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
           year(o_orderdate) AS season, CAST(1 + o_custkey % 7 AS INTEGER) AS home_team_id,
           o_orderpriority AS comment
    FROM orders),
  f AS (
    SELECT g.game_date AS dim_game_date, CAST(g.season AS BIGINT) AS dim_season,
           CAST(d.team_id AS BIGINT) AS dim_team_id, d.player_id AS dim_player_id,
           d.player_name AS dim_player_name, d.start_position AS dim_start_position,
           d.team_id = g.home_team_id AS dim_is_playing_at_home,
           coalesce(position('URGENT' IN g.comment), 0) > 0 AS dim_did_not_play,
           coalesce(position('HIGH' IN g.comment), 0) > 0 AS dim_did_not_dress,
           coalesce(position('NOT SPECIFIED' IN g.comment), 0) > 0 AS dim_not_with_team,
           TRY_CAST(split_part(d."min", ':', 1) AS DOUBLE)
             + coalesce(TRY_CAST(split_part(d."min", ':', 2) AS DOUBLE), 0) / 60.0 AS m_minutes,
           CAST(d.pts AS BIGINT) AS m_pts, d.l_extendedprice AS m_extendedprice,
           d.l_discount AS m_discount, d.l_tax AS m_tax
    FROM d JOIN g USING (game_id))"""

ORACLE = {
    "fact_build": f"{FACT_SQL} SELECT * FROM f",
    "fact_report": f"""{FACT_SQL}
        SELECT dim_player_name, CAST(count(*) AS BIGINT) AS num_games,
               CAST(sum(m_pts) AS BIGINT) AS total_pts,
               CAST(count(CASE WHEN dim_not_with_team THEN 1 END) AS BIGINT) AS bailed_num,
               CAST(count(CASE WHEN dim_not_with_team THEN 1 END) AS DOUBLE) / count(*)
                 AS bailed_pct
        FROM f GROUP BY dim_player_name""",
}
