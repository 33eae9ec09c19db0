"""Keys family: dedup (19), duplicate keys (18), constraint checks (43), CSV (32)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegerType, LongType, StringType,
                               StructField, StructType)

from tessera.operators.keys import check_keys, check_values, dedup, duplicate_keys
from tessera.session import fresh_path
from tessera.sources import load, load_csv, write_csv
from tessera.sources import standins as S

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus", "l_shipdate"]


def q_dedup_lineitem(spark, d):
    li = load(spark, d, "lineitem")
    # all columns as the order: the kept row is fully determined
    out = dedup(li, ["l_orderkey", "l_linenumber"],
                [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")])
    return out.withColumn("row_num", F.col("row_num").cast("bigint"))


def q_duplicate_keys(spark, d):
    li = load(spark, d, "lineitem")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"]).withColumn(
        "n", F.col("n").cast("bigint"))


def q_duplicate_game_details(spark, d):
    """Duplicate check on the fact grain (game, team, player)."""
    gd = S.game_details(spark, d)
    return duplicate_keys(gd, ["game_id", "team_id", "player_id"]).withColumn(
        "n", F.col("n").cast("bigint"))


def q_duplicate_player_game(spark, d):
    """Duplicate check on the plays_in edge key (player, game)."""
    gd = S.game_details(spark, d)
    return duplicate_keys(gd, ["player_id", "game_id"]).withColumn(
        "n", F.col("n").cast("bigint"))


def q_check_keys(spark, d):
    return check_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_check_values(spark, d):
    o = load(spark, d, "orders")
    return check_values(o, "o_orderstatus", ["F", "O"]).withColumn(
        "n_rows", F.col("n_rows").cast("bigint"))


MATCH_SCHEMA = StructType([
    StructField("match_id", LongType()), StructField("mapid", IntegerType()),
    StructField("playlist_id", StringType()), StructField("completion_date", DateType()),
])


def q_load_csv(spark, d):
    path = fresh_path(spark, "matches-csv")
    write_csv(S.matches(spark, d), path)
    return load_csv(spark, path, MATCH_SCHEMA)


QUERIES = {
    "dedup_lineitem": q_dedup_lineitem,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_game_details": q_duplicate_game_details,
    "duplicate_player_game": q_duplicate_player_game,
    "check_keys": q_check_keys,
    "check_values": q_check_values,
    "load_csv": q_load_csv,
}

ORACLE = {
    "dedup_lineitem": """
        SELECT * FROM (
          SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                       l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_num
          FROM lineitem) t
        WHERE row_num = 1""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_game_details": """
        SELECT l_orderkey AS game_id, l_linenumber AS team_id, l_suppkey AS player_id,
               count(*) AS n
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_suppkey HAVING count(*) > 1""",
    "duplicate_player_game": """
        SELECT l_suppkey AS player_id, l_orderkey AS game_id, count(*) AS n
        FROM lineitem GROUP BY l_suppkey, l_orderkey HAVING count(*) > 1""",
    "check_keys": """
        WITH k AS (
          SELECT count(*) AS n,
                 (l_orderkey IS NULL OR l_linenumber IS NULL) AS nk
          FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
               CAST(coalesce(sum(CASE WHEN nk THEN n END), 0) AS BIGINT) AS n_null_key_rows,
               CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_duplicate_keys,
               CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS n_excess_rows
        FROM k""",
    "check_values": """
        SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n_rows
        FROM orders
        WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
        GROUP BY o_orderstatus""",
    "load_csv": """
        SELECT o_orderkey AS match_id, CAST(o_custkey % 25 AS INTEGER) AS mapid,
               o_orderpriority AS playlist_id, CAST(o_orderdate AS DATE) AS completion_date
        FROM orders""",
}
