import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.facts import absence_report, build_fact, minutes_from_text
from tessera.operators.graph import (edge_property_max, edge_ratio_report, edges_from_rows,
                                     vertex_counts, vertices_dedup, vertices_from_agg,
                                     vertices_from_rows)


def test_minutes_parsing(spark):
    df = spark.createDataFrame([("34:30",), ("34",), ("",), (None,), ("x:1",)], "m string")
    got = [r[0] for r in df.select(minutes_from_text("m")).collect()]
    assert got == [34.5, 34.0, None, None, None]


def _details(spark):
    return spark.createDataFrame([
        (1, 10, 100, "ann", "12:30", 10, 1), (1, 10, 100, "ann", "12:30", 10, 2),  # duplicate
        (1, 20, 200, "bob", "5", 0, 3), (2, 10, 100, "ann", None, 7, 4)],
        "game_id long, team_id int, player_id long, player_name string, min string, pts int, "
        "tie int")


def _games(spark):
    return spark.createDataFrame([
        (1, dt.date(2020, 1, 1), 10, "DNP - rest"), (2, dt.date(2020, 1, 2), 20, None)],
        "game_id long, game_date date, home_team_id int, comment string")


def test_fact_build_and_report(spark):
    f = build_fact(_details(spark), _games(spark), "game_id", ["game_id", "team_id", "player_id"],
                   ["tie"], dims={"dim_game_date": "game_date", "dim_player_name": "player_name",
                                  "dim_team_id": "team_id"},
                   flags={"dim_did_not_play": "DNP", "dim_not_with_team": "NWT"},
                   text_col="comment", measures={"m_pts": "pts"}, minutes_col="min",
                   home_flag=("team_id", "home_team_id"))
    got = rows(f, "dim_player_name", "dim_game_date", "dim_is_playing_at_home",
               "dim_did_not_play", "dim_not_with_team", "m_minutes", "m_pts")
    assert got == [("ann", dt.date(2020, 1, 1), True, True, False, 12.5, 10),
                   ("ann", dt.date(2020, 1, 2), False, False, False, None, 7),
                   ("bob", dt.date(2020, 1, 1), False, True, False, 5.0, 0)]
    rep = absence_report(f, "dim_player_name", "m_pts", "dim_did_not_play").collect()
    assert [(r["dim_player_name"], r["num_games"], r["bailed_num"]) for r in rep] == \
        [("bob", 1, 1), ("ann", 2, 1)]


def test_vertices_keep_null_props_and_dedup(spark):
    g = spark.createDataFrame([(1, None, 3)], "id long, a int, b int")
    v = vertices_from_rows(g, "id", "game", {"a": "a", "b": "b"}).collect()[0]
    assert v["properties"] == '{"a":null,"b":3}'
    teams = spark.createDataFrame([("t1", 2, "x"), ("t1", 1, "y"), ("t2", 5, "z")],
                                  "team_id string, k int, nick string")
    tv = vertices_dedup(teams, "team_id", "team", {"nick": "nick"}, ["k"])
    assert rows(tv, "identifier", "properties") == [("t1", '{"nick":"y"}'), ("t2", '{"nick":"z"}')]
    assert rows(vertex_counts(tv)) == [("team", 2)]


def test_edges_and_reports(spark):
    gd = _details(spark)
    pv = vertices_from_agg(gd, "player_id", "player", {
        "player_name": F.min("player_name"), "number_of_games": F.count(F.lit(1)),
        "total_points": F.sum("pts"), "teams": F.sort_array(F.collect_set("team_id"))})
    p = {r["identifier"]: json.loads(r["properties"]) for r in pv.collect()}
    assert p["100"] == {"player_name": "ann", "number_of_games": 3, "total_points": 27,
                        "teams": [10]}
    e = edges_from_rows(gd, "player_id", "player", "game_id", "game", "plays_in",
                        {"pts": "pts", "team_id": "team_id"}, ["tie"])
    assert e.count() == 3                                 # duplicate (player, game) removed
    mx = rows(edge_property_max(pv, e, "player_name", "pts"))
    assert mx == [("ann", 10), ("bob", 0)]
    rr = {(r["player_name"], r["object_identifier"]): r["ratio"]
          for r in edge_ratio_report(pv, e, "game", "player_name", "number_of_games",
                                     "total_points", ["pts"]).collect()}
    assert rr[("bob", "1")] == 1.0                        # zero points -> denominator 1
    assert abs(rr[("ann", "2")] - 3 / 27) < 1e-12
