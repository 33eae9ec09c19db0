"""Monthly array metrics (ops 29-31) on events, flattened for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.datelists import LAST_SQL, MONTH_SQL, ONE, event_days, late
from tessera.catalog.stored import stored
from tessera.operators.month_arrays import (host_month_as_of, host_month_step, host_visitor_bitmaps_as_of,
                                            host_visitor_bitmaps_of_day, host_visitors_as_of,
                                            host_visitors_of_day, merge_visitor_bitmaps, month_array_step,
                                            month_arrays_as_of, month_visitor_counts, month_visitors,
                                            unpack_month_arrays)
from tessera.operators.upsert import write_upsert
from tessera.plans.versions import VersionedTable
from tessera.session import fresh_path
from tessera.sources import standins as S

METRIC = "site_hits"


def _ints(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def _total(c):
    return F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _flat_metric(t):
    return t.select("user_id", "month_start", "metric_name",
                    F.size("metric_array").cast("bigint").alias("n_days"),
                    _ints("metric_array").alias("metric"),
                    _total("metric_array").alias("total"))


def _flat_hosts(hits, visitors):
    n = month_visitors(visitors).groupBy("host", "month_start").agg(F.count(F.lit(1)).alias("n_visitors"))
    return hits.join(n, ["host", "month_start"], "left").select(
        "host", "month_start", F.size("hit_array").cast("bigint").alias("n_days"),
        _ints("hit_array").alias("hits"), F.coalesce("n_visitors", F.lit(0).cast("bigint")).alias("n_visitors"))


def q_month_array_step(spark, d):
    _, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    prev = stored(spark, month_arrays_as_of(ev, "user_id", METRIC, last - ONE), "month_start")
    return _flat_metric(month_array_step(prev, ev, "user_id", METRIC, last))


def q_stored_month_arrays(spark, d):
    """Month table loaded day by day; the day before the last is loaded without its late events and re-run
    with them after the last day is in."""
    _, last = event_days(spark, d)
    ev, path = S.activity_events(spark, d), fresh_path(spark, "array_metrics")
    keys = ["user_id", "month_start", "metric_name"]
    month_arrays_as_of(ev, "user_id", METRIC, last - 2 * ONE).write.partitionBy("month_start").parquet(path)
    for day, seen in ((last - ONE, ev.where(~late(last - ONE))), (last, ev), (last - ONE, ev)):
        step = month_array_step(spark.read.parquet(path), seen, "user_id", METRIC, day)
        write_upsert(step, path, "month_start", keys, partitions=[day.replace(day=1)])
    return _flat_metric(spark.read.parquet(path))


def q_host_month_step(spark, d):
    _, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    prev = stored(spark, host_month_as_of(ev, last - ONE), "month_start")
    return _flat_hosts(host_month_step(prev, ev, last), host_visitors_as_of(ev, last))


def _stored_host_month(spark, d):
    """Hit arrays per month and visitor rows per day, loaded like ``q_stored_month_arrays``."""
    _, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    hits, visitors = fresh_path(spark, "host_hits"), fresh_path(spark, "host_visitors")
    host_month_as_of(ev, last - 2 * ONE).write.partitionBy("month_start").parquet(hits)
    host_visitors_as_of(ev, last - 2 * ONE).write.partitionBy("date").parquet(visitors)
    for day, seen in ((last - ONE, ev.where(~late(last - ONE))), (last, ev), (last - ONE, ev)):
        write_upsert(host_month_step(spark.read.parquet(hits), seen, day), hits, "month_start",
                     ["host", "month_start"], partitions=[day.replace(day=1)])
        write_upsert(host_visitors_of_day(seen, day), visitors, "date", ["host", "date", "visitor"],
                     partitions=[day])
    return spark.read.parquet(hits), spark.read.parquet(visitors)


def q_stored_host_month(spark, d):
    return _flat_hosts(*_stored_host_month(spark, d))


def q_stored_host_visitors(spark, d):
    return month_visitors(_stored_host_month(spark, d)[1])


def q_host_visitor_bitmaps(spark, d):
    """Distinct visitors of the month: the bitmaps up to two days before the last, and three daily merges, one of them a re-run."""
    _, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    table = VersionedTable(spark, fresh_path(spark, "visitor_bitmaps"), "month_start")
    table.replace(host_visitor_bitmaps_as_of(ev, last - 2 * ONE))
    for day, seen in ((last - ONE, ev.where(~late(last - ONE))), (last, ev), (last - ONE, ev)):
        table.replace(merge_visitor_bitmaps(table.read().where(F.col("month_start") == day.replace(day=1)),
                                            host_visitor_bitmaps_of_day(seen, day)))
    return month_visitor_counts(table.read())


def q_unpack_month_arrays(spark, d):
    _, last = event_days(spark, d)
    t = month_arrays_as_of(S.activity_events(spark, d), "user_id", METRIC, last)
    return unpack_month_arrays(t).select("metric_name", "date",
                                         F.col("value").cast("bigint").alias("value"))


QUERIES = {
    "month_array_step": q_month_array_step,
    "stored_month_arrays": q_stored_month_arrays,
    "host_month_step": q_host_month_step,
    "stored_host_month": q_stored_host_month,
    "stored_host_visitors": q_stored_host_visitors,
    "host_visitor_bitmaps": q_host_visitor_bitmaps,
    "unpack_month_arrays": q_unpack_month_arrays,
}

GRID = f"""unnest(generate_series(CAST({MONTH_SQL} AS TIMESTAMP), CAST({LAST_SQL} AS TIMESTAMP),
                                 INTERVAL 1 DAY))"""

ORACLE = {
    "month_array_step": f"""
        WITH daily AS (
          SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS c FROM events
          WHERE user_id IS NOT NULL AND CAST(ts AS DATE) BETWEEN {MONTH_SQL} AND {LAST_SQL}
          GROUP BY ALL),
        users AS (SELECT DISTINCT user_id FROM daily),
        grid AS (SELECT user_id, CAST(g AS DATE) AS d FROM (SELECT user_id, {GRID} AS g FROM users))
        SELECT g.user_id, {MONTH_SQL} AS month_start, '{METRIC}' AS metric_name,
               CAST(count(*) AS BIGINT) AS n_days,
               string_agg(CAST(coalesce(dl.c, 0) AS VARCHAR), ',' ORDER BY g.d) AS metric,
               CAST(sum(coalesce(dl.c, 0)) AS BIGINT) AS total
        FROM grid g LEFT JOIN daily dl ON dl.user_id = g.user_id AND dl.d = g.d
        GROUP BY g.user_id""",
    "host_month_step": f"""
        WITH ev AS (
          SELECT event_type || ':' || CAST(user_id % 50 AS VARCHAR) AS host, user_id,
                 CAST(ts AS DATE) AS d
          FROM events WHERE CAST(ts AS DATE) BETWEEN {MONTH_SQL} AND {LAST_SQL}),
        daily AS (SELECT host, d, count(*) AS c FROM ev WHERE host IS NOT NULL GROUP BY ALL),
        hosts AS (SELECT DISTINCT host FROM daily),
        vis AS (
          SELECT host, CAST(count(*) AS BIGINT) AS n_visitors
          FROM (SELECT DISTINCT host, CAST(user_id AS VARCHAR) AS u FROM ev
                WHERE host IS NOT NULL AND user_id IS NOT NULL)
          GROUP BY host),
        grid AS (SELECT host, CAST(g AS DATE) AS d FROM (SELECT host, {GRID} AS g FROM hosts)),
        hits AS (
          SELECT g.host, CAST(count(*) AS BIGINT) AS n_days,
                 string_agg(CAST(coalesce(dl.c, 0) AS VARCHAR), ',' ORDER BY g.d) AS hits
          FROM grid g LEFT JOIN daily dl ON dl.host = g.host AND dl.d = g.d GROUP BY g.host)
        SELECT h.host, {MONTH_SQL} AS month_start, h.n_days, h.hits,
               coalesce(v.n_visitors, 0) AS n_visitors
        FROM hits h LEFT JOIN vis v USING (host)""",
    "unpack_month_arrays": f"""
        WITH daily AS (
          SELECT CAST(ts AS DATE) AS d, count(*) AS c FROM events
          WHERE user_id IS NOT NULL AND CAST(ts AS DATE) BETWEEN {MONTH_SQL} AND {LAST_SQL}
          GROUP BY ALL),
        days AS (SELECT CAST(g AS DATE) AS d FROM (SELECT {GRID} AS g))
        SELECT '{METRIC}' AS metric_name, days.d AS date,
               CAST(coalesce(daily.c, 0) AS BIGINT) AS value
        FROM days LEFT JOIN daily USING (d)""",
}
ORACLE["stored_month_arrays"] = ORACLE["month_array_step"]
ORACLE["stored_host_month"] = ORACLE["host_month_step"]
ORACLE["stored_host_visitors"] = f"""
    SELECT DISTINCT event_type || ':' || CAST(user_id % 50 AS VARCHAR) AS host, {MONTH_SQL} AS month_start,
           CAST(user_id AS VARCHAR) AS visitor
    FROM events WHERE CAST(ts AS DATE) BETWEEN {MONTH_SQL} AND {LAST_SQL}
      AND event_type IS NOT NULL AND user_id IS NOT NULL"""
ORACLE["host_visitor_bitmaps"] = f"""
    SELECT event_type || ':' || CAST(user_id % 50 AS VARCHAR) AS host, {MONTH_SQL} AS month_start,
           CAST(count(DISTINCT user_id) AS BIGINT) AS n_visitors
    FROM events WHERE CAST(ts AS DATE) BETWEEN {MONTH_SQL} AND {LAST_SQL} AND event_type IS NOT NULL AND user_id IS NOT NULL
    GROUP BY ALL"""
