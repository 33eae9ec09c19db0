"""Loads that are published atomically (ops 24, 27, 29, 42, 43): the stored snapshots as versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog import datelists, devices, month_arrays
from tessera.catalog.datelists import ONE, event_days, late
from tessera.operators.datelist import datelist_history, datelist_step
from tessera.operators.devices import device_datelist
from tessera.operators.month_arrays import month_array_step, month_arrays_as_of
from tessera.operators.upsert import write_upsert
from tessera.plans.versions import Checks, DirtyLoad, VersionedTable
from tessera.session import fresh_path
from tessera.sources import load
from tessera.sources import standins as S


def q_published_host_datelist(spark, d):
    """hosts_cumulated, one version a load: the backfill, its last day again with late events, the new day."""
    first, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    table = VersionedTable(spark, fresh_path(spark, "hosts_published"), "date")
    table.replace(datelist_history(ev.where(~late(last - ONE)), "host", first, last - ONE, **datelists.KW))
    for day in (last - ONE, last):
        table.upsert(datelist_step(table.read(), ev, "host", day, **datelists.KW), ["host", "date"], [day],
                     checks=Checks(keys=["host", "date"]))
    return datelists._flat(table.read(), "host", "host_activity_datelist")


def q_published_device_datelist(spark, d):
    """The device snapshots of two days, the first one loaded twice."""
    _, last = event_days(spark, d)
    ev, dev = S.activity_events(spark, d), S.devices(spark, d)
    table = VersionedTable(spark, fresh_path(spark, "devices_published"), "date")
    for day, seen in ((last - ONE, ev.where(~late(last - ONE))), (last, ev), (last - ONE, ev)):
        table.upsert(device_datelist(seen, dev, day), ["user_id", "date"], [day])
    return devices._flat_dates(table.read())


def q_published_month_arrays(spark, d):
    """The month's arrays, a version a day; the day before the last is loaded again after it."""
    _, last = event_days(spark, d)
    ev = S.activity_events(spark, d)
    table = VersionedTable(spark, fresh_path(spark, "arrays_published"), "month_start")
    table.replace(month_arrays_as_of(ev, "user_id", month_arrays.METRIC, last - 2 * ONE))
    for day, seen in ((last - ONE, ev.where(~late(last - ONE))), (last, ev), (last - ONE, ev)):
        table.upsert(month_array_step(table.read(), seen, "user_id", month_arrays.METRIC, day),
                     ["user_id", "month_start", "metric_name"], [day.replace(day=1)])
    return month_arrays._flat_metric(table.read())


def _orders(spark, d):
    """Orders with the year as partition; pending ones have none."""
    o = load(spark, d, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("year"))


def q_upsert_null_partition(spark, d):
    """A third of all orders updated, in the years and among the pending ones, which have none: two loads of the same rows."""
    path = fresh_path(spark, "orders_by_year")
    _orders(spark, d).write.partitionBy("year").parquet(path)
    new = _orders(spark, d).where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0))
    for _ in range(2):
        write_upsert(new, path, "year", ["o_orderkey", "year"])
    return spark.read.schema(new.schema).parquet(path).select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("year").cast("bigint").alias("year"))


def q_gated_load(spark, d):
    """Finished and open orders are published; a load with pending ones, which the gate's list doesn't hold, changes nothing."""
    table = VersionedTable(spark, fresh_path(spark, "orders_gated"), "year")
    gate = Checks(keys=["o_orderkey"], not_null=["o_custkey"], values={"o_orderstatus": ["F", "O"]})
    table.replace(_orders(spark, d).where("o_orderstatus <> 'P'"), gate)
    faults = {}
    try:
        table.upsert(_orders(spark, d).withColumn("o_totalprice", F.lit(-1.0)), ["o_orderkey", "year"], checks=gate)
    except DirtyLoad as e:
        faults = e.faults
    return table.read().groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        F.lit(faults.get("value:o_orderstatus", 0)).cast("bigint").alias("refused"))


QUERIES = {
    "published_host_datelist": q_published_host_datelist,
    "published_device_datelist": q_published_device_datelist,
    "published_month_arrays": q_published_month_arrays,
    "upsert_null_partition": q_upsert_null_partition,
    "gated_load": q_gated_load,
}

ORACLE = {
    "published_host_datelist": datelists.ORACLE["host_datelist_upsert"],
    "published_device_datelist": devices.ORACLE["stored_device_datelist"],
    "published_month_arrays": month_arrays.ORACLE["stored_month_arrays"],
    "upsert_null_partition": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS BIGINT) END AS year
        FROM orders""",
    "gated_load": """
        SELECT o_orderstatus, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
               (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) AS refused
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus""",
}
