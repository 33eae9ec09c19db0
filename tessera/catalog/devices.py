"""Per-browser datelist and bitmask maps (ops 27, 28), flattened for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.datelists import LAST_SQL, MONTH_SQL, ONE, event_days, late
from tessera.functions.columns import bits_text
from tessera.operators.devices import device_datelist, device_datelist_int, explode_map
from tessera.operators.upsert import write_upsert
from tessera.session import fresh_path
from tessera.sources import standins as S


def _flat_dates(m):
    flat = explode_map(m, "user_id", "device_activity_datelist", "browser_type", "_dates")
    return flat.select("user_id", "browser_type", "date",
                       F.size("_dates").cast("bigint").alias("n_dates"),
                       F.array_join(F.transform("_dates", lambda x: x.cast("string")), ",")
                        .alias("dates"))


def _flat_masks(m):
    flat = explode_map(m, "user_id", "datelist_int", "browser_type", "datelist_int")
    return flat.select("user_id", "browser_type", "date", "datelist_int",
                       bits_text("datelist_int").alias("bits"))


def q_device_datelist(spark, d):
    _, last = event_days(spark, d)
    return _flat_dates(device_datelist(S.activity_events(spark, d), S.devices(spark, d), last))


def q_device_datelist_int(spark, d):
    _, last = event_days(spark, d)
    return _flat_masks(device_datelist_int(S.activity_events(spark, d), S.devices(spark, d),
                                           last.replace(day=1), last))


def _stored(spark, d, name, snapshot):
    """Two daily loads of a date-partitioned table; the first day is loaded without its late events
    and re-run with them."""
    _, last = event_days(spark, d)
    ev, dev, path = S.activity_events(spark, d), S.devices(spark, d), fresh_path(spark, name)
    for day, seen in ((last - ONE, ev.where(~late(last - ONE))), (last, ev), (last - ONE, ev)):
        write_upsert(snapshot(seen, dev, day), path, "date", ["user_id", "date"], partitions=[day])
    return spark.read.parquet(path)


def q_stored_device_datelist(spark, d):
    return _flat_dates(_stored(spark, d, "device_datelist", device_datelist))


def q_stored_device_datelist_int(spark, d):
    _, last = event_days(spark, d)
    month = last.replace(day=1)
    return _flat_masks(_stored(spark, d, "device_masks",
                               lambda ev, dev, day: device_datelist_int(ev, dev, month, day)))


QUERIES = {
    "device_datelist": q_device_datelist,
    "device_datelist_int": q_device_datelist_int,
    "stored_device_datelist": q_stored_device_datelist,
    "stored_device_datelist_int": q_stored_device_datelist_int,
}

MAPPED_SQL = f"""
  ev AS (SELECT user_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS device_id
         FROM events),
  k AS (SELECT DISTINCT device_id FROM ev),
  dev AS (
    SELECT device_id,
           CASE WHEN device_id % 17 = 0 THEN NULL
                ELSE 'b' || CAST(device_id % 4 AS VARCHAR) END AS browser_type
    FROM k
    UNION ALL
    SELECT device_id, 'b' || CAST(device_id % 4 + 1 AS VARCHAR) FROM k WHERE device_id % 10 = 0),
  dd AS (SELECT DISTINCT device_id, browser_type FROM dev),
  mapped AS (
    SELECT DISTINCT e.user_id, dd.browser_type, CAST(e.ts AS DATE) AS d
    FROM ev e JOIN dd ON e.device_id = dd.device_id
    WHERE CAST(e.ts AS DATE) <= {LAST_SQL}
      AND e.user_id IS NOT NULL AND dd.browser_type IS NOT NULL)"""

def _dates_sql(day):
    return f"""
        WITH {MAPPED_SQL}
        SELECT user_id, browser_type, {day} AS date, CAST(count(*) AS BIGINT) AS n_dates,
               string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates
        FROM mapped WHERE d <= {day} GROUP BY user_id, browser_type"""


def _masks_sql(day):
    return f"""
        WITH {MAPPED_SQL},
        m AS (
          SELECT user_id, browser_type,
                 CAST(sum(CAST(1 AS BIGINT) << date_diff('day', {MONTH_SQL}, d)) AS BIGINT)
                   AS datelist_int
          FROM mapped WHERE d <= {day} AND date_diff('day', {MONTH_SQL}, d) BETWEEN 0 AND 31
          GROUP BY user_id, browser_type)
        SELECT user_id, browser_type, {day} AS date, datelist_int,
               lpad(bin(datelist_int), 32, '0') AS bits
        FROM m"""


def _both(sql):
    return f"SELECT * FROM ({sql(LAST_SQL)}) UNION ALL SELECT * FROM ({sql(f'({LAST_SQL} - 1)')})"


ORACLE = {
    "device_datelist": _dates_sql(LAST_SQL),
    "device_datelist_int": _masks_sql(LAST_SQL),
    "stored_device_datelist": _both(_dates_sql),
    "stored_device_datelist_int": _both(_masks_sql),
}
