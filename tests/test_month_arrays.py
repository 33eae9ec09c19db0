import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.catalog.datelists import event_days
from tessera.operators.devices import device_datelist, device_datelist_int
from tessera.operators.month_arrays import (host_month_as_of, host_month_step, host_visitors_as_of,
                                            host_visitors_of_day, month_array_step,
                                            month_arrays_as_of, month_visitors, unpack_month_arrays)
from tessera.sources import standins as S

M = dt.date(2023, 1, 1)


def _ev(spark, spec):
    """spec: (user, host, day-of-month)."""
    data = [(u, h, dt.datetime(2023, 1, d, 10)) for u, h, d in spec]
    return spark.createDataFrame(data, "user_id long, host string, ts timestamp_ntz")


def test_first_seen_day3_absent_today_and_rerun(spark):
    ev = _ev(spark, [(1, "h", 1), (1, "h", 2), (2, "h", 3), (2, "g", 3), (1, "h", 4)])
    t = None
    empty = spark.createDataFrame([], "user_id long, month_start date, metric_name string, "
                                      "metric_array array<bigint>")
    t = empty
    for day in range(1, 5):
        t = month_array_step(t, ev, "user_id", "hits", dt.date(2023, 1, day)).checkpoint()
    got = {r["user_id"]: r["metric_array"] for r in t.collect()}
    assert got == {1: [1, 1, 0, 1], 2: [0, 0, 2, 0]}   # user 2: two leading zeros
    again = month_array_step(t, ev, "user_id", "hits", dt.date(2023, 1, 4))
    assert {r["user_id"]: r["metric_array"] for r in again.collect()} == got   # idempotent
    direct = month_arrays_as_of(ev, "user_id", "hits", dt.date(2023, 1, 4))
    assert rows(direct) == rows(t.select(*direct.columns))


def test_rerun_of_an_earlier_day_keeps_later_days(spark):
    days = [(1, "h", d) for d in range(1, 8)] + [(2, "h", 3)]
    ev = _ev(spark, days)
    seven = month_arrays_as_of(_ev(spark, days[:-1]), "user_id", "hits", dt.date(2023, 1, 7))
    out = month_array_step(seven, ev, "user_id", "hits", dt.date(2023, 1, 3))
    assert {r["user_id"]: r["metric_array"] for r in out.collect()} == {1: [1] * 7, 2: [0, 0, 1]}
    gone = month_array_step(seven, _ev(spark, [(9, "h", 9)]), "user_id", "hits", dt.date(2023, 1, 3))
    assert gone.collect()[0]["metric_array"] == [1, 1, 0, 1, 1, 1, 1]
    hosts = host_month_as_of(ev, dt.date(2023, 1, 7))
    assert host_month_step(hosts, ev, dt.date(2023, 1, 2)).collect()[0]["hit_array"] == [1, 1, 2, 1, 1, 1, 1]


def test_host_visitor_rows(spark):
    ev = _ev(spark, [(1, "h", 1), (2, "h", 1), (1, "h", 2), (None, "h", 2)])
    prev = host_month_as_of(ev, dt.date(2023, 1, 2))
    out = host_month_step(prev, ev, dt.date(2023, 1, 3)).collect()[0]
    assert out["hit_array"] == [2, 2, 0]
    v = host_visitors_as_of(ev, dt.date(2023, 1, 2))
    assert rows(month_visitors(v), "visitor") == [("1",), ("2",)]
    one = host_visitors_of_day(ev, dt.date(2023, 1, 1)).unionByName(host_visitors_of_day(ev, dt.date(2023, 1, 2)))
    assert rows(one) == rows(v)


def test_unpack_equals_daily_counts(spark):
    ev = S.activity_events(spark, SF_SMALL)
    last = event_days(spark, SF_SMALL)[0] + dt.timedelta(days=9)
    t = month_arrays_as_of(ev, "user_id", "hits", last)
    un = unpack_month_arrays(t)
    daily = (ev.where(F.to_date("ts") <= last)
               .groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("value")))
    assert rows(un, "date", "value") == rows(daily, "date", "value")


def test_devices_fanout_and_nulls(spark):
    ev = spark.createDataFrame([
        (1, 10, dt.datetime(2023, 1, 1, 1)), (1, 10, dt.datetime(2023, 1, 1, 9)),
        (1, 11, dt.datetime(2023, 1, 3, 1)), (None, 10, dt.datetime(2023, 1, 2, 1)),
        (2, 99, dt.datetime(2023, 1, 2, 1)), (3, 12, dt.datetime(2023, 1, 2, 1))],
        "user_id long, device_id int, ts timestamp_ntz")
    dev = spark.createDataFrame([(10, "chrome"), (10, "chrome"), (10, "edge"), (11, "safari"),
                                 (12, None)], "device_id int, browser_type string")
    m = {r["user_id"]: r["device_activity_datelist"]
         for r in device_datelist(ev, dev, dt.date(2023, 1, 31)).collect()}
    assert set(m) == {1}                                   # NULL user, unknown device, NULL browser
    assert m[1] == {"chrome": [dt.date(2023, 1, 1)], "edge": [dt.date(2023, 1, 1)],
                    "safari": [dt.date(2023, 1, 3)]}
    b = {r["user_id"]: r["datelist_int"]
         for r in device_datelist_int(ev, dev, M, dt.date(2023, 1, 31)).collect()}
    assert b[1] == {"chrome": 1, "edge": 1, "safari": 4}   # two events on day 0 -> one bit


def test_devices_json_form(spark):
    ev = spark.createDataFrame([(1, 10, dt.datetime(2023, 1, 2, 1))],
                               "user_id long, device_id int, ts timestamp_ntz")
    dev = spark.createDataFrame([(10, "chrome")], "device_id int, browser_type string")
    r = device_datelist(ev, dev, dt.date(2023, 1, 31), as_json=True).collect()[0]
    assert r["device_activity_datelist"]["browser_dates"] == '{"chrome":["2023-01-02"]}'
    r = device_datelist_int(ev, dev, M, dt.date(2023, 1, 31), as_json=True).collect()[0]
    assert r["datelist_int"]["browser_dates"] == '{"chrome":2}'
