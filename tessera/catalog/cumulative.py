"""Cumulative snapshot family (ops 1-6) on the orders stand-in.

Entity = customer, period = order year, entry = (year, n_orders, total_price,
avg_price) for the one-row-per-period variant and (o_orderkey, o_totalprice,
o_orderpriority) for the many-rows variant. Classes come from the average order
price: > 350000 star, > 250000 good, > 150000 average, else bad.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.columns import classify, join_values
from tessera.catalog.stored import stored
from tessera.operators.cumulative import (cumulate_backfill, cumulate_step,
                                          cumulate_step_multi, cumulate_step_rows, history_ratio,
                                          rows_summary_as_of, snapshot_multi_as_of, unnest_history)
from tessera.operators.chunks import chunk_backfill, chunk_step
from tessera.operators.upsert import upsert
from tessera.session import fresh_path
from tessera.sources import load
from tessera.sources import standins as S

# first and last year of the orders
LO_SQL = "(SELECT CAST(min(year(o_orderdate)) AS BIGINT) FROM orders)"
HI_SQL = "(SELECT CAST(max(year(o_orderdate)) AS BIGINT) FROM orders)"
# fixed values: the class ladder
BINS = [(350000, "star"), (250000, "good"), (150000, "average")]
ELSE = "bad"
ENTRY = ["year", "n_orders", "total_price", "avg_price"]
STATIC = ["c_name", "c_mktsegment"]
KEY = "o_custkey"


def year_span(spark, d):
    """First and last year of the orders (one aggregate, one row)."""
    year = F.year("o_orderdate")
    return tuple(load(spark, d, "orders").agg(F.min(year), F.max(year)).first())


def seasons(spark, d):
    """Player-season stand-in: one row per (customer, year) with static columns."""
    return S.customer_years(spark, d).join(S.customer_static(spark, d), KEY)


def backfill(spark, d, hi=None):
    lo, last = year_span(spark, d)
    return cumulate_backfill(seasons(spark, d), KEY, "year", ENTRY, lo, hi or last, "avg_price",
                             BINS, ELSE, static_cols=STATIC, current_col="current_year")


def flat(snap):
    """Scalar projection of a snapshot for comparison and export."""
    return snap.select(
        KEY, *STATIC,
        F.col("current_year").cast("bigint").alias("current_year"),
        F.size("history").cast("bigint").alias("n_periods"),
        join_values(F.transform("history", lambda e: e["year"])).alias("history_years"),
        join_values(F.transform("history", lambda e: e["n_orders"])).alias("history_orders"),
        "class",
        F.col("years_since_last_active").cast("bigint").alias("years_since_last_active"),
        "is_active")


def q_cumulative_backfill(spark, d):
    return flat(backfill(spark, d))


def q_cumulative_step(spark, d):
    # the step reads one partition of the stored snapshots
    _, last = year_span(spark, d)
    prev = stored(spark, backfill(spark, d, last - 1), "current_year")
    step = cumulate_step(prev, seasons(spark, d), KEY, "year", ENTRY, last, "avg_price", BINS,
                         ELSE, static_cols=STATIC, current_col="current_year")
    return flat(step)


FILM = ["o_orderkey", "o_totalprice", "o_orderpriority"]


def q_cumulative_step_multi(spark, d):
    _, last = year_span(spark, d)
    films = S.customer_orders(spark, d)
    prev = snapshot_multi_as_of(films, KEY, "year", FILM, "o_totalprice", last - 1, BINS, ELSE,
                                current_col="current_year")
    step = cumulate_step_multi(stored(spark, prev, "current_year"), films, KEY, "year", FILM, "o_totalprice",
                               last, BINS, ELSE, current_col="current_year")
    return step.select(
        KEY, F.col("current_year").cast("bigint").alias("current_year"),
        F.size("history").cast("bigint").alias("n_films"),
        join_values(F.transform("history", lambda e: e["o_orderkey"])).alias("film_keys"),
        "class", "is_active",
        F.col("years_since_last_active").cast("bigint").alias("years_since_last_active"))


def q_cumulative_step_rows(spark, d):
    """The many-rows step with the history kept as rows: no row grows with a busy entity."""
    _, last = year_span(spark, d)
    films = S.customer_orders(spark, d)
    prev = rows_summary_as_of(films, KEY, "year", "o_totalprice", last - 1, BINS, ELSE,
                              current_col="current_year")
    step = cumulate_step_rows(stored(spark, prev, "current_year"), films, KEY, "year", "o_totalprice", last,
                              BINS, ELSE, current_col="current_year")
    return step.select(KEY, F.col("current_year").cast("bigint").alias("current_year"),
                       F.col("n_entries").alias("n_films"), "class", "is_active",
                       F.col("years_since_last_active").cast("bigint").alias("years_since_last_active"))


PER_CHUNK = 4                   # entries of a chunk, few here so that customers have several


def q_chunked_history(spark, d):
    """The films of all years as chunks: the table up to the year before the last, and the last year's step upserted."""
    _, last = year_span(spark, d)
    films, path = S.customer_orders(spark, d), fresh_path(spark, "chunks")
    chunk_backfill(films, KEY, "year", FILM, last - 1, PER_CHUNK).write.parquet(path)
    prev = spark.read.parquet(path)
    table = upsert(prev, chunk_step(prev, films, KEY, "year", FILM, last, PER_CHUNK), [KEY, "chunk"])
    flat = table.select(KEY, "chunk", "n_entries", F.posexplode("history").alias("place", "e"))
    return flat.select(KEY, "chunk", "n_entries", F.col("place").cast("bigint").alias("place"), "e.o_orderkey", "e.o_totalprice")


def q_classify_orders(spark, d):
    o = load(spark, d, "orders")
    return o.select("o_orderkey", classify("o_totalprice", BINS, ELSE).alias("class"))


def q_unnest_history(spark, d):
    _, last = year_span(spark, d)
    snap = backfill(spark, d).where(F.col("current_year") == last)
    return unnest_history(snap, KEY).select(
        KEY, F.col("year").cast("bigint").alias("year"),
        F.col("n_orders").cast("bigint").alias("n_orders"),
        F.round("total_price", 2).alias("total_price"))


def q_history_ratio(spark, d):
    _, last = year_span(spark, d)
    snap = backfill(spark, d).where((F.col("current_year") == last) & (F.col("class") == "star"))
    return history_ratio(snap, KEY, "total_price").select(
        KEY, F.round("ratio", 6).alias("ratio"))


QUERIES = {
    "cumulative_backfill": q_cumulative_backfill,
    "cumulative_step": q_cumulative_step,
    "cumulative_step_multi": q_cumulative_step_multi,
    "cumulative_step_rows": q_cumulative_step_rows,
    "chunked_history": q_chunked_history,
    "classify_orders": q_classify_orders,
    "unnest_history": q_unnest_history,
    "history_ratio": q_history_ratio,
}

# ---------------------------------------------------------------- oracle SQL
CLASS_SQL = """CASE WHEN {v} > 350000 THEN 'star' WHEN {v} > 250000 THEN 'good'
                    WHEN {v} > 150000 THEN 'average' ELSE 'bad' END"""

SNAP_SQL = f"""
  cy AS (
    SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS yr, count(*) AS n_orders,
           sum(o_totalprice) AS total_price, avg(o_totalprice) AS avg_price
    FROM orders GROUP BY ALL),
  seasons AS (
    SELECT cy.*, c.c_name, c.c_mktsegment FROM cy JOIN customer c ON c.c_custkey = cy.o_custkey),
  grid AS (
    SELECT o_custkey, unnest(generate_series(first_yr, {HI_SQL})) AS current_year
    FROM (SELECT o_custkey, min(yr) AS first_yr FROM seasons
          WHERE yr BETWEEN {LO_SQL} AND {HI_SQL} GROUP BY o_custkey)),
  snap AS (
    SELECT g.o_custkey, max(s.c_name) AS c_name, max(s.c_mktsegment) AS c_mktsegment,
           CAST(g.current_year AS BIGINT) AS current_year,
           CAST(count(*) AS BIGINT) AS n_periods,
           string_agg(CAST(s.yr AS VARCHAR), ',' ORDER BY s.yr) AS history_years,
           string_agg(CAST(s.n_orders AS VARCHAR), ',' ORDER BY s.yr) AS history_orders,
           max(s.yr) AS last_year,
           arg_max(s.avg_price, s.yr) AS last_avg,
           arg_max(s.total_price, s.yr) AS last_total,
           arg_min(s.total_price, s.yr) AS first_total
    FROM grid g JOIN seasons s
      ON s.o_custkey = g.o_custkey AND s.yr <= g.current_year AND s.yr >= {LO_SQL}
    GROUP BY g.o_custkey, g.current_year),
  snapc AS (
    SELECT *, {CLASS_SQL.format(v='last_avg')} AS class,
           CAST(current_year - last_year AS BIGINT) AS years_since_last_active,
           last_year = current_year AS is_active
    FROM snap)"""

FLAT_COLS = """o_custkey, c_name, c_mktsegment, current_year, n_periods, history_years,
               history_orders, class, years_since_last_active, is_active"""

ORACLE = {
    "cumulative_backfill": f"WITH {SNAP_SQL} SELECT {FLAT_COLS} FROM snapc",
    "cumulative_step": f"WITH {SNAP_SQL} SELECT {FLAT_COLS} FROM snapc WHERE current_year = {HI_SQL}",
    "cumulative_step_multi": f"""
        WITH py AS (
          SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS yr, avg(o_totalprice) AS v
          FROM orders WHERE year(o_orderdate) <= {HI_SQL} GROUP BY ALL),
        last_py AS (SELECT o_custkey, max(yr) AS last_year, arg_max(v, yr) AS last_v
                    FROM py GROUP BY o_custkey),
        films AS (
          SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_films,
                 string_agg(CAST(o_orderkey AS VARCHAR), ','
                            ORDER BY year(o_orderdate), o_orderkey) AS film_keys
          FROM orders WHERE year(o_orderdate) <= {HI_SQL} GROUP BY o_custkey)
        SELECT f.o_custkey, CAST({HI_SQL} AS BIGINT) AS current_year, f.n_films, f.film_keys,
               {CLASS_SQL.format(v='l.last_v')} AS class,
               l.last_year = {HI_SQL} AS is_active,
               CAST({HI_SQL} - l.last_year AS BIGINT) AS years_since_last_active
        FROM films f JOIN last_py l USING (o_custkey)""",
    "classify_orders": f"""
        SELECT o_orderkey, {CLASS_SQL.format(v='o_totalprice')} AS class FROM orders""",
    "unnest_history": f"""
        WITH {SNAP_SQL}
        SELECT s.o_custkey, s.yr AS year, CAST(s.n_orders AS BIGINT) AS n_orders,
               round(s.total_price, 2) AS total_price
        FROM seasons s JOIN snapc c ON c.o_custkey = s.o_custkey AND c.current_year = {HI_SQL}
        WHERE s.yr BETWEEN {LO_SQL} AND {HI_SQL}""",
    "history_ratio": f"""
        WITH {SNAP_SQL}
        SELECT o_custkey,
               round(last_total / CASE WHEN first_total = 0 THEN 1 ELSE first_total END, 6)
                 AS ratio
        FROM snapc WHERE current_year = {HI_SQL} AND class = 'star'""",
}
ORACLE["cumulative_step_rows"] = f"SELECT * EXCLUDE (film_keys) FROM ({ORACLE['cumulative_step_multi']})"
ORACLE["chunked_history"] = f"""
    WITH films AS (
      SELECT o_custkey, o_orderkey, o_totalprice,
             row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate), o_orderkey) - 1 AS n
      FROM orders WHERE year(o_orderdate) <= {HI_SQL})
    SELECT o_custkey, n // {PER_CHUNK} AS chunk, count(*) OVER (PARTITION BY o_custkey, n // {PER_CHUNK}) AS n_entries,
           n % {PER_CHUNK} AS place, o_orderkey, o_totalprice FROM films"""
