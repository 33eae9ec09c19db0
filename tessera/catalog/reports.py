"""Match reports (ops 33-41): orders as matches, nation as maps, line items as
match details and medal rows, part names as medal names."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tessera.operators.reports import (match_view, match_view_hot, top_by_avg, top_by_count,
                                       top_by_distinct, top_for_label)
from tessera.plans.footers import column_report, parquet_footers
from tessera.plans.joins import enrich
from tessera.plans.layout import (bucket_count, file_stats, layout_report, write_bucketed,
                                  write_partitioned)
from tessera.session import fresh_path
from tessera.sources import standins as S
from tessera.sources.tables import load, table_path

# fixed values: the reference tables' bucket count (a floor here) and the medal label reported
BUCKETS = 16
# rows of the largest table that a bucket holds: a task sorts a bucket of every table of a join
BUCKET_ROWS = 1_000_000
LABEL = "red plate"


def _name(table, d):
    """Table name of an input folder: a later write of the same table replaces it."""
    return f"{table}_{hashlib.md5(d.encode()).hexdigest()[:8]}"


def _bytes(spark, d, table):
    return file_stats(spark, table_path(d, table)).first()["total_bytes"]


INPUTS = {
    "matches_bucketed": lambda spark, d: S.matches(spark, d).select("match_id", "mapid", "playlist_id"),
    "match_details_bucketed": S.match_details,
    "medal_matches_players_bucketed": S.medal_matches_players,
}


def bucketed(spark, d, *tables):
    """The match tables bucketed on match_id, written anew; all share the largest table's bucket count."""
    n = bucket_count(max(load(spark, d, t).count() for t in ("orders", "lineitem")), BUCKET_ROWS, BUCKETS)
    return tuple(write_bucketed(INPUTS[t](spark, d), _name(t, d), "match_id", n, fresh_path(spark, t))
                 for t in tables or INPUTS)


def q_enrich_matches_maps(spark, d):
    return enrich(S.matches(spark, d), S.maps(spark, d), "mapid", ["name"]).select(
        "match_id", "mapid", "name")


def q_enrich_medal_rows(spark, d):
    return enrich(S.medal_matches_players(spark, d), S.medals(spark, d), "medal_id",
                  ["name"]).select("match_id", "player_gamertag", "medal_id", "name")


def q_top_map_by_matches(spark, d):
    m = S.matches(spark, d).select("match_id", "mapid")
    return top_by_distinct(m, S.maps(spark, d).withColumnRenamed("name", "map_name"), "mapid",
                           ["mapid", "map_name"], "match_id", "top_played") \
        .withColumn("top_played", F.col("top_played").cast("bigint"))


def q_top_playlist(spark, d):
    return top_by_count(S.matches(spark, d), "playlist_id", "match_id", "top_played") \
        .withColumn("top_played", F.col("top_played").cast("bigint"))


def q_top_player_avg_kills(spark, d):
    r = top_by_avg(S.match_details(spark, d), "player_gamertag", "player_total_kills",
                   "avg_kills")
    return r


def q_top_player_avg_kills_int(spark, d):
    r = top_by_avg(S.match_details(spark, d), "player_gamertag", "player_total_kills",
                   "avg_kills", as_int=True)
    return r.withColumn("avg_kills", F.col("avg_kills").cast("bigint"))


def _matches_maps(spark, d):
    return enrich(S.matches(spark, d), S.maps(spark, d).withColumnRenamed("name", "map_name"),
                  "mapid", ["map_name"]).select("match_id", "mapid", "map_name")


def q_top_map_for_medal(spark, d):
    medals = S.medals(spark, d).withColumnRenamed("name", "medal_name")
    return top_for_label(S.medal_matches_players(spark, d), medals, "medal_id", "medal_name",
                         LABEL, _matches_maps(spark, d), "match_id", ["mapid", "map_name"],
                         "count", ["match_id"],
                         select=["match_id", "mapid", "map_name", "medal_name", "count"]) \
        .withColumn("count", F.col("count").cast("bigint"))


def _view(spark, d, how):
    m, md, mmp = bucketed(spark, d)
    return match_view(m, md, mmp, "match_id", "player_gamertag", ["mapid", "playlist_id"],
                      ["player_total_kills"], [("medal_id", "medal_id"), ("count", "medal_count")], how)


def _view_cols(v):
    return v.select("match_id", F.col("mapid").cast("bigint").alias("mapid"), "playlist_id",
                    "player_gamertag",
                    F.col("player_total_kills").cast("bigint").alias("player_total_kills"),
                    "medal_id", F.col("medal_count").cast("bigint").alias("medal_count"))


def q_match_view_left(spark, d):
    return _view_cols(_view(spark, d, "left"))


def q_match_view_inner(spark, d):
    return _view_cols(_view(spark, d, "inner"))


def _hot_view(spark, d, how):
    """The view of tables of which one match holds a third, bucketed; matches of over a sixteenth of the rows, or of more
    than a bucket should hold, are hot. A hot match's bucket is dealt to several tasks and files."""
    n_rows = load(spark, d, "lineitem").count()
    n, most = bucket_count(n_rows, BUCKET_ROWS, BUCKETS), max(1, min(BUCKET_ROWS, n_rows // 16))
    paths = {k: fresh_path(spark, f"hot_{k}") for k in ("matches", "details", "medals")}
    m, md, mmp = (write_bucketed(t, _name(f"hot_{k}", d), "match_id", n, paths[k], max_rows=BUCKET_ROWS)
                  for k, t in zip(paths, S.hot_matches(spark, d)))
    return match_view_hot(m, md, mmp, "match_id", "player_gamertag", ["mapid", "playlist_id"], ["player_total_kills"],
                          [("medal_id", "medal_id"), ("count", "medal_count")], most, how,
                          unbucketed=[spark.read.schema(t.schema).parquet(paths[k]) for k, t in zip(paths, (m, md, mmp))])


def q_match_view_hot_left(spark, d):
    return _view_cols(_hot_view(spark, d, "left"))


def q_match_view_hot_inner(spark, d):
    return _view_cols(_hot_view(spark, d, "inner"))


def q_top_map_from_view(spark, d):
    v = _view(spark, d, "left").select("match_id", "mapid")
    return top_by_distinct(v, S.maps(spark, d).withColumnRenamed("name", "map_name"), "mapid",
                           ["mapid", "map_name"], "match_id", "top_played") \
        .withColumn("top_played", F.col("top_played").cast("bigint"))


def q_top_map_for_medal_from_view(spark, d):
    v = _view(spark, d, "left").select("match_id", "medal_id", "medal_count")
    medals = S.medals(spark, d).withColumnRenamed("name", "medal_name")
    return top_for_label(v, medals, "medal_id", "medal_name", LABEL, _matches_maps(spark, d),
                         "match_id", ["mapid", "map_name"], "medal_count", ["match_id"],
                         select=["match_id", "mapid", "map_name", "medal_name",
                                 "medal_count"]) \
        .withColumn("medal_count", F.col("medal_count").cast("bigint"))


def q_match_view_medals(spark, d):
    """The distinct (match, medal row) pairs of the left view."""
    v = _view_cols(_view(spark, d, "left"))
    return v.where("medal_id IS NOT NULL").select("match_id", "mapid", "playlist_id", "medal_id",
                                                  "medal_count").distinct()


def q_bucketed_matches(spark, d):
    return bucketed(spark, d, "matches_bucketed")[0].select("match_id", "mapid", "playlist_id")


def q_bucketed_match_details(spark, d):
    return bucketed(spark, d, "match_details_bucketed")[0].select(
        "match_id", "player_gamertag", "player_total_kills", "player_total_deaths")


def q_bucketed_medal_rows(spark, d):
    return bucketed(spark, d, "medal_matches_players_bucketed")[0].select(
        "match_id", "player_gamertag", "medal_id", "count")


FILE_BYTES = 256 << 20           # of a date's files


def q_partitioned_matches(spark, d):
    m = S.matches(spark, d)
    rows, dates = m.agg(F.count(F.lit(1)), F.approx_count_distinct("completion_date")).first()
    stored = _bytes(spark, d, "orders")
    n = bucket_count(stored // max(1, dates))
    t = write_partitioned(m, _name("matches_partitioned", d), "completion_date",
                          "match_id", n, fresh_path(spark, "matches_partitioned"),
                          max_rows=max(1, FILE_BYTES * rows // max(1, stored)))
    return t.select("match_id", "mapid", "playlist_id", "completion_date")


def q_partitioned_hot_date(spark, d):
    """Matches of which a third were played on one day, in files of a sixteenth of the rows at most."""
    day = F.when(F.col("match_id") % 3 == 0, F.lit("1995-01-01").cast("date")).otherwise(F.trunc("completion_date", "year"))
    m = S.matches(spark, d).withColumn("completion_date", day)
    t = write_partitioned(m, _name("matches_hot_date", d), "completion_date", "match_id", 2, fresh_path(spark, "matches_hot_date"),
                          max_rows=max(1, m.count() // 16))
    return t.select("match_id", "mapid", "playlist_id", "completion_date")


def q_layout_report(spark, d):
    tables = {"matches": S.matches(spark, d).select("match_id", "mapid", "playlist_id"),
              "match_details": S.match_details(spark, d),
              "medal_matches_players": S.medal_matches_players(spark, d),
              "medals": S.medals(spark, d)}
    cands = {"matches": ["playlist_id", "mapid"], "match_details": ["match_id"],
             "medal_matches_players": ["medal_id", "match_id"], "medals": ["medal_id"]}
    r = layout_report(spark, tables, cands, fresh_path(spark, "layout"))
    # how many files and bytes a write makes depends on the machine; that it makes some doesn't
    return r.select("table", "sort_column", "n_rows", (F.col("n_files") > 0).alias("has_files"),
                    (F.col("total_bytes") > 0).alias("has_bytes"))


def q_layout_footers(spark, d):
    """What the footers say of the match details, written unsorted and sorted by match."""
    out = None
    for name, order in (("unsorted", None), ("sorted", "match_id")):
        path = fresh_path(spark, f"footers-{name}")
        md = S.match_details(spark, d)
        (md.repartitionByRange(order).sortWithinPartitions(order) if order else md).write.parquet(path)
        one = column_report(parquet_footers(spark, path)).select(
            F.lit(name).alias("layout"), "column", "n_rows", "n_nulls", F.col("min_number").cast("bigint").alias("low"),
            F.col("max_number").cast("bigint").alias("high"), (F.col("compressed_bytes") > 0).alias("has_bytes"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "enrich_matches_maps": q_enrich_matches_maps,
    "enrich_medal_rows": q_enrich_medal_rows,
    "top_map_by_matches": q_top_map_by_matches,
    "top_playlist": q_top_playlist,
    "top_player_avg_kills": q_top_player_avg_kills,
    "top_player_avg_kills_int": q_top_player_avg_kills_int,
    "top_map_for_medal": q_top_map_for_medal,
    "match_view_left": q_match_view_left,
    "match_view_inner": q_match_view_inner,
    "match_view_hot_left": q_match_view_hot_left,
    "match_view_hot_inner": q_match_view_hot_inner,
    "top_map_from_view": q_top_map_from_view,
    "top_map_for_medal_from_view": q_top_map_for_medal_from_view,
    "match_view_medals": q_match_view_medals,
    "bucketed_matches": q_bucketed_matches,
    "bucketed_match_details": q_bucketed_match_details,
    "bucketed_medal_rows": q_bucketed_medal_rows,
    "partitioned_matches": q_partitioned_matches,
    "partitioned_hot_date": q_partitioned_hot_date,
    "layout_report": q_layout_report,
    "layout_footers": q_layout_footers,
}

M = """(SELECT o_orderkey AS match_id, CAST(o_custkey % 25 AS INTEGER) AS mapid,
               o_orderpriority AS playlist_id, CAST(o_orderdate AS DATE) AS completion_date
        FROM orders)"""
MD = """(SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag,
                CAST(l_quantity AS INTEGER) AS player_total_kills,
                l_linenumber AS player_total_deaths FROM lineitem)"""
MMP = """(SELECT l_orderkey AS match_id,
                 CASE WHEN l_partkey % 11 = 0 THEN -l_suppkey ELSE l_suppkey END AS player_gamertag,
                 l_partkey AS medal_id,
                 CAST(l_quantity AS INTEGER) AS "count" FROM lineitem)"""


# a third of all rows in match 0
HOT_M = """(SELECT CASE WHEN o_orderkey = 3 THEN 0 ELSE o_orderkey END AS match_id, CAST(o_custkey % 25 AS INTEGER) AS mapid,
                   o_orderpriority AS playlist_id FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey = 3)"""
HOT_MD = """(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS match_id,
                    CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey * 8 + l_linenumber ELSE l_suppkey END AS player_gamertag,
                    CAST(l_quantity AS INTEGER) AS player_total_kills FROM lineitem
             UNION ALL SELECT 0, 8, 1 FROM orders WHERE o_orderkey = 3)"""
HOT_MMP = """(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS match_id,
                     CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey WHEN l_linenumber % 2 = 0 THEN 8
                          ELSE l_orderkey * 8 + l_linenumber END AS player_gamertag,
                     l_partkey AS medal_id, CAST(l_quantity AS INTEGER) AS "count" FROM lineitem)"""


def _view_sql(how, M=M, MD=MD, MMP=MMP):
    lone = f"""
        SELECT m.match_id, CAST(m.mapid AS BIGINT) AS mapid, m.playlist_id, NULL AS player_gamertag,
               NULL AS player_total_kills, x.medal_id, CAST(x."count" AS BIGINT) AS medal_count
        FROM {M} m JOIN {MMP} x ON x.match_id = m.match_id
        WHERE NOT EXISTS (SELECT 1 FROM {MD} md WHERE md.match_id = x.match_id
                          AND md.player_gamertag = x.player_gamertag)"""
    if how == "INNER":
        lone += f" AND EXISTS (SELECT 1 FROM {MD} md WHERE md.match_id = m.match_id)"
    return f"""
        SELECT a.match_id, CAST(a.mapid AS BIGINT) AS mapid, a.playlist_id, a.player_gamertag,
               CAST(a.player_total_kills AS BIGINT) AS player_total_kills, x.medal_id,
               CAST(x."count" AS BIGINT) AS medal_count
        FROM (SELECT m.match_id, m.mapid, m.playlist_id, md.player_gamertag,
                     md.player_total_kills
              FROM {M} m {how} JOIN {MD} md ON m.match_id = md.match_id) a
        {how} JOIN {MMP} x ON a.match_id = x.match_id AND a.player_gamertag = x.player_gamertag
        UNION ALL {lone}"""


# the pairs of a join of details and medal rows on the match alone
PAIRS_SQL = f"""
    SELECT DISTINCT a.match_id, CAST(a.mapid AS BIGINT) AS mapid, a.playlist_id, x.medal_id,
           CAST(x."count" AS BIGINT) AS medal_count
    FROM (SELECT m.match_id, m.mapid, m.playlist_id, md.player_gamertag
          FROM {M} m LEFT JOIN {MD} md ON m.match_id = md.match_id) a
    LEFT JOIN {MMP} x ON a.match_id = x.match_id WHERE x.medal_id IS NOT NULL"""

TOP_MAP = f"""
    SELECT m.mapid, n.n_name AS map_name, CAST(count(DISTINCT m.match_id) AS BIGINT) AS top_played
    FROM {M} m LEFT JOIN nation n ON n.n_nationkey = m.mapid
    GROUP BY m.mapid, n.n_name ORDER BY top_played DESC, m.mapid, map_name LIMIT 1"""

ORACLE = {
    "enrich_matches_maps": f"""
        SELECT m.match_id, m.mapid, n.n_name AS name
        FROM {M} m LEFT JOIN nation n ON n.n_nationkey = m.mapid""",
    "enrich_medal_rows": f"""
        SELECT x.match_id, x.player_gamertag, x.medal_id, p.p_name AS name
        FROM {MMP} x LEFT JOIN part p ON p.p_partkey = x.medal_id""",
    "top_map_by_matches": TOP_MAP,
    "top_playlist": f"""
        SELECT playlist_id, CAST(count(match_id) AS BIGINT) AS top_played FROM {M}
        GROUP BY playlist_id ORDER BY top_played DESC, playlist_id LIMIT 1""",
    "top_player_avg_kills": f"""
        SELECT player_gamertag, avg(player_total_kills) AS avg_kills FROM {MD}
        GROUP BY player_gamertag ORDER BY avg(player_total_kills) DESC, player_gamertag LIMIT 1""",
    "top_player_avg_kills_int": f"""
        SELECT player_gamertag, CAST(trunc(avg(player_total_kills)) AS BIGINT) AS avg_kills
        FROM {MD} GROUP BY player_gamertag
        ORDER BY avg_kills DESC, player_gamertag LIMIT 1""",
    "top_map_for_medal": f"""
        SELECT x.match_id, m.mapid, n.n_name AS map_name, p.p_name AS medal_name,
               CAST(x."count" AS BIGINT) AS "count"
        FROM {MMP} x JOIN part p ON p.p_partkey = x.medal_id AND p.p_name = '{LABEL}'
        LEFT JOIN {M} m ON m.match_id = x.match_id
        LEFT JOIN nation n ON n.n_nationkey = m.mapid
        ORDER BY "count" DESC, x.match_id LIMIT 1""",
    "match_view_left": _view_sql("LEFT"),
    "match_view_inner": _view_sql("INNER"),
    "match_view_hot_left": _view_sql("LEFT", HOT_M, HOT_MD, HOT_MMP),
    "match_view_hot_inner": _view_sql("INNER", HOT_M, HOT_MD, HOT_MMP),
    "top_map_from_view": TOP_MAP,
    "top_map_for_medal_from_view": f"""
        SELECT v.match_id, m.mapid, n.n_name AS map_name, p.p_name AS medal_name,
               v.medal_count
        FROM ({PAIRS_SQL}) v
        JOIN part p ON p.p_partkey = v.medal_id AND p.p_name = '{LABEL}'
        LEFT JOIN {M} m ON m.match_id = v.match_id
        LEFT JOIN nation n ON n.n_nationkey = m.mapid
        ORDER BY v.medal_count DESC, v.match_id LIMIT 1""",
    "match_view_medals": PAIRS_SQL,
    "bucketed_match_details": f"SELECT * FROM {MD}",
    "bucketed_medal_rows": f"SELECT * FROM {MMP}",
    "layout_report": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS sort_column, CAST(count(*) AS BIGINT) AS n_rows,
                   true AS has_files, true AS has_bytes FROM {src}"""
        for t, src, cols in (("matches", "orders", ["", "playlist_id", "mapid"]),
                             ("match_details", "lineitem", ["", "match_id"]),
                             ("medal_matches_players", "lineitem", ["", "medal_id", "match_id"]),
                             ("medals", "part", ["", "medal_id"]))
        for c in cols),
    "bucketed_matches": f"SELECT match_id, mapid, playlist_id FROM {M}",
    "partitioned_hot_date": f"""
        SELECT match_id, mapid, playlist_id, CASE WHEN match_id % 3 = 0 THEN DATE '1995-01-01'
               ELSE CAST(date_trunc('year', completion_date) AS DATE) END AS completion_date FROM {M}""",
    "partitioned_matches": f"SELECT match_id, mapid, playlist_id, completion_date FROM {M}",
}
ORACLE["layout_footers"] = " UNION ALL ".join(
    f"""SELECT '{layout}' AS layout, '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
               CAST(min({c}) AS BIGINT) AS low, CAST(max({c}) AS BIGINT) AS high, true AS has_bytes FROM {MD}"""
    for layout in ("unsorted", "sorted")
    for c in ("match_id", "player_gamertag", "player_total_kills", "player_total_deaths"))
