"""Graph tables (ops 10-13, 15-17): games = orders, players = suppliers in line
items, teams = part brands (with duplicate rows), plays_in = line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.stored import stored
from tessera.operators.graph import (edge_property_max, edge_ratio_report, edges_from_rows,
                                     variant_properties, vertex_counts, vertices_dedup,
                                     vertices_from_agg, vertices_from_rows)
from tessera.sources import standins as S


def game_vertices(spark, d):
    g = S.games(spark, d)
    return vertices_from_rows(g, "game_id", "game",
                              {"customer": "customer", "status": "status",
                               "priority": "comment", "home_team_id": "home_team_id"})


def player_vertices(spark, d):
    return vertices_from_agg(S.game_details(spark, d), "player_id", "player", {
        "player_name": F.min("player_name"),
        "number_of_games": F.count(F.lit(1)),
        "total_points": F.sum(F.col("pts").cast("bigint")),
        "teams": F.sort_array(F.collect_set("team_id")),
    })


def team_vertices(spark, d):
    return vertices_dedup(S.teams(spark, d), "team_id", "team",
                          {"nickname": "nickname", "city": "city",
                           "year_founded": "year_founded"}, ["p_partkey"])


def plays_in_edges(spark, d):
    gd = S.game_details(spark, d)
    return edges_from_rows(gd, "player_id", "player", "game_id", "game", "plays_in",
                           {"start_position": "start_position", "pts": "pts",
                            "team_id": "team_id", "team_abbreviation": "team_abbreviation"},
                           ["team_id", "l_partkey", "pts", "l_extendedprice", "l_discount",
                            "l_tax", "team_abbreviation", "start_position", "l_shipdate"])


def q_graph_game_vertices(spark, d):
    return game_vertices(spark, d)


def q_graph_player_vertices(spark, d):
    return player_vertices(spark, d)


def q_graph_team_vertices(spark, d):
    return team_vertices(spark, d)


def q_graph_plays_in_edges(spark, d):
    return plays_in_edges(spark, d)


def q_graph_vertex_counts(spark, d):
    v = game_vertices(spark, d).unionByName(player_vertices(spark, d)) \
                               .unionByName(team_vertices(spark, d))
    return vertex_counts(v).withColumn("n", F.col("n").cast("bigint"))


def graph_tables(spark, d):
    """Player vertices and plays-in edges written once, as the reports find them."""
    return (stored(spark, player_vertices(spark, d), "type"),
            stored(spark, plays_in_edges(spark, d), "edge_type"))


def q_graph_edge_max(spark, d):
    r = edge_property_max(*graph_tables(spark, d), "player_name", "pts")
    return r.select("player_name", F.col("max_pts").cast("bigint").alias("max_pts"))


def q_graph_edge_ratio(spark, d):
    r = edge_ratio_report(*graph_tables(spark, d), "game",
                          "player_name", "number_of_games", "total_points", ["pts", "team_id"])
    return r.select("player_name", "object_identifier", "ratio",
                    "pts", "team_id")


def variant_tables(spark, d):
    """The same tables, stored with VARIANT properties."""
    return (stored(spark, variant_properties(player_vertices(spark, d)), "type"),
            stored(spark, variant_properties(plays_in_edges(spark, d)), "edge_type"))


def q_graph_edge_max_variant(spark, d):
    r = edge_property_max(*variant_tables(spark, d), "player_name", "pts")
    return r.select("player_name", F.col("max_pts").cast("bigint").alias("max_pts"))


def q_graph_edge_ratio_variant(spark, d):
    return edge_ratio_report(*variant_tables(spark, d), "game", "player_name", "number_of_games", "total_points",
                             ["pts", "team_id"]).select("player_name", "object_identifier", "ratio", "pts", "team_id")


QUERIES = {
    "graph_game_vertices": q_graph_game_vertices,
    "graph_player_vertices": q_graph_player_vertices,
    "graph_team_vertices": q_graph_team_vertices,
    "graph_plays_in_edges": q_graph_plays_in_edges,
    "graph_vertex_counts": q_graph_vertex_counts,
    "graph_edge_max": q_graph_edge_max,
    "graph_edge_ratio": q_graph_edge_ratio,
    "graph_edge_max_variant": q_graph_edge_max_variant,
    "graph_edge_ratio_variant": q_graph_edge_ratio_variant,
}

GD = """
  gd AS (
    SELECT l.l_orderkey AS game_id, l.l_linenumber AS team_id, l.l_suppkey AS player_id,
           s.s_name AS player_name, l.l_returnflag AS team_abbreviation,
           l.l_linestatus AS start_position, CAST(trunc(l.l_quantity) AS INTEGER) AS pts,
           l.l_partkey, l.l_extendedprice, l.l_discount, l.l_tax, l.l_shipdate
    FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey)"""

GAME_V = """
  SELECT CAST(o_orderkey AS VARCHAR) AS identifier, 'game' AS type,
         CAST(to_json(struct_pack(customer := o_custkey, status := o_orderstatus,
                                  priority := o_orderpriority,
                                  home_team_id := CAST(1 + o_custkey % 7 AS INTEGER)))
              AS VARCHAR) AS properties
  FROM orders"""

PLAYER_V = f"""
  WITH {GD}
  SELECT CAST(player_id AS VARCHAR) AS identifier, 'player' AS type,
         CAST(to_json(struct_pack(player_name := min(player_name),
                                  number_of_games := count(*),
                                  total_points := CAST(sum(pts) AS BIGINT),
                                  teams := list_sort(list_distinct(list(team_id)))))
              AS VARCHAR) AS properties
  FROM gd GROUP BY player_id"""

TEAM_V = """
  SELECT p_brand AS identifier, 'team' AS type,
         CAST(to_json(struct_pack(nickname := p_name, city := p_type,
                                  year_founded := p_size)) AS VARCHAR) AS properties
  FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)
  WHERE rn = 1"""

EDGES = f"""
  WITH {GD}
  SELECT CAST(player_id AS VARCHAR) AS subject_identifier, 'player' AS subject_type,
         CAST(game_id AS VARCHAR) AS object_identifier, 'game' AS object_type,
         'plays_in' AS edge_type,
         CAST(to_json(struct_pack(start_position := start_position, pts := pts,
                                  team_id := team_id, team_abbreviation := team_abbreviation))
              AS VARCHAR) AS properties
  FROM (SELECT *, row_number() OVER (
            PARTITION BY player_id, game_id
            ORDER BY team_id, l_partkey, pts, l_extendedprice, l_discount, l_tax,
                     team_abbreviation, start_position, l_shipdate) AS rn FROM gd)
  WHERE rn = 1"""

ORACLE = {
    "graph_game_vertices": GAME_V,
    "graph_player_vertices": PLAYER_V,
    "graph_team_vertices": TEAM_V,
    "graph_plays_in_edges": EDGES,
    "graph_vertex_counts": f"""
        SELECT type, CAST(count(*) AS BIGINT) AS n FROM (
          SELECT type FROM ({GAME_V}) UNION ALL SELECT type FROM ({PLAYER_V})
          UNION ALL SELECT type FROM ({TEAM_V})) GROUP BY type""",
    "graph_edge_max": f"""
        SELECT v.properties->>'player_name' AS player_name,
               CAST(max(CAST(e.properties->>'pts' AS INTEGER)) AS BIGINT) AS max_pts
        FROM ({PLAYER_V}) v JOIN ({EDGES}) e
          ON e.subject_identifier = v.identifier AND e.subject_type = v.type
        GROUP BY 1""",
    "graph_edge_ratio": f"""
        SELECT v.properties->>'player_name' AS player_name, e.object_identifier,
               CAST(v.properties->>'number_of_games' AS DOUBLE) /
                     CASE WHEN CAST(v.properties->>'total_points' AS DOUBLE) = 0 THEN 1
                          ELSE CAST(v.properties->>'total_points' AS DOUBLE) END AS ratio,
               e.properties->>'pts' AS pts, e.properties->>'team_id' AS team_id
        FROM ({PLAYER_V}) v JOIN ({EDGES}) e
          ON v.identifier = e.subject_identifier AND v.type = e.subject_type
        WHERE e.object_type = 'game'""",
}
ORACLE["graph_edge_max_variant"] = ORACLE["graph_edge_max"]
ORACLE["graph_edge_ratio_variant"] = ORACLE["graph_edge_ratio"]
