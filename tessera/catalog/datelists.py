"""Datelist family (ops 22-26, 42) on the events table.

Users are keyed by ``user_id`` (as text, like the reference's users table);
hosts are ``event_type || ':' || user_id % 50``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.catalog.stored import stored
from tessera.operators.datelist import (activity_flags, activity_mask_from_events, active_on,
                                        datelist_as_of, datelist_history, datelist_step,
                                        event_range, on_day)
from tessera.operators.upsert import upsert, write_upsert
from tessera.session import fresh_path
from tessera.sources import load
from tessera.sources import standins as S

ONE = dt.timedelta(days=1)
# the first and last day of the events, and the last day's month
FIRST_SQL = "(SELECT CAST(min(ts) AS DATE) FROM events)"
LAST_SQL = "(SELECT CAST(max(ts) AS DATE) FROM events)"
MONTH_SQL = "(SELECT CAST(date_trunc('month', max(ts)) AS DATE) FROM events)"


def event_days(spark, d):
    """First and last day of the events (one aggregate, one row)."""
    r = event_range(S.activity_events(spark, d)).first()
    return r["min_ts"].date(), r["max_ts"].date()


def late(day):
    """Events of ``day`` that a first load doesn't see yet (every fifth)."""
    return on_day("ts", day) & (F.col("event_id") % 5 == 0)



def user_events(spark, d):
    return S.activity_events(spark, d).withColumn("user_id", F.col("user_id").cast("string"))


def _flat(df, key, list_col):
    return df.select(key, F.col("date"),
                     F.size(list_col).cast("bigint").alias("n_dates"),
                     F.array_join(F.transform(list_col, lambda x: x.cast("string")), ",")
                      .alias("dates"))


def q_event_range(spark, d):
    return event_range(S.activity_events(spark, d))


def q_user_datelist_step(spark, d):
    _, last = event_days(spark, d)
    ev = user_events(spark, d)
    prev = stored(spark, datelist_as_of(ev, "user_id", last - ONE), "date")
    return _flat(datelist_step(prev, ev, "user_id", last), "user_id", "dates_active")


KW = dict(list_col="host_activity_datelist", not_null=("user_id",))


def _first_load(spark, d, first, last):
    """hosts_cumulated up to the day before ``last``, loaded before that day's late events came in."""
    ev = S.activity_events(spark, d).where(~late(last - ONE))
    return datelist_history(ev, "host", first, last - ONE, **KW)


def q_host_datelist_upsert(spark, d):
    """hosts_cumulated as a date-partitioned table: a first load, the re-run of its last day with late
    events, and the new day, each an upsert (dynamic partition overwrite of that day only)."""
    first, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    path = fresh_path(spark, "hosts_cumulated")
    _first_load(spark, d, first, last).write.partitionBy("date").parquet(path)
    for day in (last - ONE, last):
        table = spark.read.parquet(path)
        write_upsert(datelist_step(table, ev, "host", day, **KW), path, "date", ["host", "date"],
                     existing=table, partitions=[day])
    return _flat(spark.read.parquet(path), "host", "host_activity_datelist")


def q_host_datelist_upsert_frame(spark, d):
    """The same load expressed as DataFrame upserts (anti join + union) of a stored table."""
    first, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    target = stored(spark, _first_load(spark, d, first, last), "date")
    rerun = datelist_step(target, ev, "host", last - ONE, **KW)
    step = datelist_step(rerun, ev, "host", last, **KW)
    out = upsert(target, rerun.unionByName(step), ["host", "date"], partition_col="date",
                 partitions=[last - ONE, last])
    return _flat(out, "host", "host_activity_datelist")


def q_datelist_history_from(spark, d):
    """Snapshots from the fourth day on: lists go back to the first event."""
    first, last = event_days(spark, d)
    out = datelist_history(S.activity_events(spark, d), "host", first + 3 * ONE, last, **KW)
    return _flat(out, "host", "host_activity_datelist")


def q_upsert_keeps_other_keys(spark, d):
    """Half the customers of a nation-partitioned table updated, without naming the stored rows."""
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    path = fresh_path(spark, "customers")
    c.write.partitionBy("c_nationkey").parquet(path)
    new = c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.lit(0.0))
    write_upsert(new, path, "c_nationkey", ["c_nationkey", "c_custkey"])
    return spark.read.parquet(path).select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
                                           "c_acctbal")


def q_active_on(spark, d):
    _, last = event_days(spark, d)
    snap = datelist_as_of(user_events(spark, d), "user_id", last)
    return active_on(snap, last - ONE).select("user_id", "date")


def _flags_cols(df):
    return df.select("user_id", "bitmask", "bits", "dim_is_monthly_active",
                     "dim_is_weekly_active", "dim_is_daily_active", "n_active_days")


def q_activity_flags(spark, d):
    _, last = event_days(spark, d)
    snap = datelist_as_of(user_events(spark, d), "user_id", last)
    return _flags_cols(activity_flags(snap, "user_id", last))


def q_activity_flags_from_events(spark, d):
    _, last = event_days(spark, d)
    return _flags_cols(activity_mask_from_events(user_events(spark, d), "user_id", last))


QUERIES = {
    "event_range": q_event_range,
    "user_datelist_step": q_user_datelist_step,
    "host_datelist_upsert": q_host_datelist_upsert,
    "host_datelist_upsert_frame": q_host_datelist_upsert_frame,
    "datelist_history_from": q_datelist_history_from,
    "upsert_keeps_other_keys": q_upsert_keeps_other_keys,
    "active_on": q_active_on,
    "activity_flags": q_activity_flags,
    "activity_flags_from_events": q_activity_flags_from_events,
}

USER_DAYS = f"""
  ud AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, CAST(ts AS DATE) AS d
         FROM events WHERE user_id IS NOT NULL AND CAST(ts AS DATE) <= {LAST_SQL})"""

FLAGS_SQL = f"""
  WITH {USER_DAYS},
  m AS (
    SELECT user_id,
           CAST(sum(CASE WHEN date_diff('day', d, {LAST_SQL}) BETWEEN 0 AND 31
                         THEN CAST(1 AS BIGINT) << (31 - date_diff('day', d, {LAST_SQL}))
                         ELSE 0 END) AS BIGINT) AS bitmask
    FROM ud GROUP BY user_id)
  SELECT user_id, bitmask, lpad(bin(bitmask), 32, '0') AS bits,
         bitmask <> 0 AS dim_is_monthly_active,
         (bitmask & 4261412864) <> 0 AS dim_is_weekly_active,
         (bitmask & 2147483648) <> 0 AS dim_is_daily_active,
         CAST(bit_count(bitmask) AS BIGINT) AS n_active_days
  FROM m"""

HISTORY_SQL = f"""
        WITH hd AS (
          SELECT DISTINCT event_type || ':' || CAST(user_id % 50 AS VARCHAR) AS host,
                 CAST(ts AS DATE) AS d
          FROM events
          WHERE user_id IS NOT NULL AND CAST(ts AS DATE) BETWEEN {FIRST_SQL} AND {LAST_SQL}),
        firsts AS (SELECT host, min(d) AS f FROM hd GROUP BY host),
        grid AS (
          SELECT host, CAST(g AS DATE) AS date
          FROM (SELECT host, unnest(generate_series(CAST(f AS TIMESTAMP),
                                                     CAST({LAST_SQL} AS TIMESTAMP),
                                                     INTERVAL 1 DAY)) AS g FROM firsts))
        SELECT g.host, g.date, CAST(count(*) AS BIGINT) AS n_dates,
               string_agg(CAST(h.d AS VARCHAR), ',' ORDER BY h.d DESC) AS dates
        FROM grid g JOIN hd h ON h.host = g.host AND h.d <= g.date
        GROUP BY g.host, g.date"""

ORACLE = {
    "event_range": "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events",
    "user_datelist_step": f"""
        WITH {USER_DAYS}
        SELECT user_id, {LAST_SQL} AS date, CAST(count(*) AS BIGINT) AS n_dates,
               string_agg(CAST(d AS VARCHAR), ',' ORDER BY d DESC) AS dates
        FROM ud GROUP BY user_id""",
    "host_datelist_upsert": HISTORY_SQL,
    "datelist_history_from": f"SELECT * FROM ({HISTORY_SQL}) WHERE date >= {FIRST_SQL} + 3",
    "upsert_keeps_other_keys": """
        SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
               CASE WHEN c_custkey % 2 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer""",
    "active_on": f"""
        WITH {USER_DAYS}
        SELECT user_id, {LAST_SQL} AS date FROM ud WHERE d = {LAST_SQL} - 1""",
    "activity_flags": FLAGS_SQL,
    "activity_flags_from_events": FLAGS_SQL,
}
ORACLE["host_datelist_upsert_frame"] = ORACLE["host_datelist_upsert"]
