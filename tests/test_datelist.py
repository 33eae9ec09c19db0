import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tessera.catalog import datelists as L
from tessera.operators.datelist import (activity_flags, activity_mask_from_events, active_on,
                                        datelist_as_of, datelist_history, datelist_step)
from tessera.operators.upsert import upsert, write_upsert
from tessera.session import fresh_path

D = dt.date(2023, 1, 31)
# first and last day of the events tables at hand
FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 30)


def _ev(spark, spec):
    """spec: list of (user, days_before_D, hour)."""
    data = [(u, dt.datetime.combine(D - dt.timedelta(days=a), dt.time(h))) for u, a, h in spec]
    return spark.createDataFrame(data, "user_id string, ts timestamp_ntz")


def test_bits_for_ages(spark):
    ev = _ev(spark, [("today", 0, 1), ("yday", 1, 2), ("d31", 31, 3), ("d32", 32, 4),
                     ("two", 0, 1), ("two", 0, 5), ("null", 0, 1)])
    ev = ev.union(spark.createDataFrame([(None, dt.datetime(2023, 1, 31, 1))],
                                        "user_id string, ts timestamp_ntz"))
    snap = datelist_as_of(ev, "user_id", D)
    f = {r["user_id"]: r for r in activity_flags(snap, "user_id", D).collect()}
    assert None not in f
    assert f["today"]["bitmask"] == 1 << 31 and f["today"]["dim_is_daily_active"]
    assert f["yday"]["bitmask"] == 1 << 30 and f["yday"]["dim_is_weekly_active"] \
        and not f["yday"]["dim_is_daily_active"]
    assert f["d31"]["bitmask"] == 1 and not f["d31"]["dim_is_weekly_active"]
    assert f["d32"]["bitmask"] == 0 and not f["d32"]["dim_is_monthly_active"]
    assert f["two"]["n_active_days"] == 1
    assert f["today"]["bits"] == "1" + "0" * 31
    direct = {r["user_id"]: r["bitmask"]
              for r in activity_mask_from_events(ev, "user_id", D).collect()}
    assert direct == {k: v["bitmask"] for k, v in f.items() if v["bitmask"]}


def test_step_prepends_and_advances(spark):
    ev = _ev(spark, [("a", 1, 1), ("a", 0, 1), ("b", 1, 1), ("c", 0, 2)])
    prev = datelist_as_of(ev, "user_id", D - dt.timedelta(days=1))
    out = {r["user_id"]: r for r in datelist_step(prev, ev, "user_id", D).collect()}
    assert out["a"]["dates_active"] == [D, D - dt.timedelta(days=1)]
    assert out["b"]["dates_active"] == [D - dt.timedelta(days=1)] and out["b"]["date"] == D
    assert out["c"]["dates_active"] == [D]
    assert rows(active_on(datelist_as_of(ev, "user_id", D), D), "user_id") == [("a",), ("c",)]


def test_fold_steps_equals_as_of_and_history(spark):
    ev = L.user_events(spark, SF_SMALL)
    snap = datelist_as_of(ev, "user_id", FIRST)
    day = FIRST
    while day < FIRST + dt.timedelta(days=6):
        day += dt.timedelta(days=1)
        snap = datelist_step(snap, ev, "user_id", day).checkpoint()
    assert rows(snap) == rows(datelist_as_of(ev, "user_id", day).select(*snap.columns))
    hist = datelist_history(ev, "user_id", FIRST, day).where(F.col("date") == day)
    assert rows(hist) == rows(snap.select(*hist.columns))


def test_upsert_replaces_only_keys(spark):
    t = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), ("a", 2, "old")],
                              "k string, d int, v string")
    u = spark.createDataFrame([("a", 1, "new"), ("c", 1, "new")], "k string, d int, v string")
    want = [("a", 1, "new"), ("a", 2, "old"), ("b", 1, "old"), ("c", 1, "new")]
    assert rows(upsert(t, u, ["k", "d"])) == want
    assert rows(upsert(t, u, ["k", "d"], partition_col="d")) == want
    assert rows(upsert(t, u, ["k", "d"], partition_col="d", partitions=[1])) == want


def test_write_upsert_dynamic_overwrite(spark):
    p = fresh_path(spark, "upsert")
    t = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), ("a", 2, "old")],
                              "k string, d int, v string")
    t.write.partitionBy("d").parquet(p)
    u = spark.createDataFrame([("a", 1, "new")], "k string, d int, v string")
    existing = spark.read.parquet(p)
    write_upsert(u, p, "d", ["k", "d"], existing=existing)
    back = spark.read.parquet(p).select("k", "d", "v")
    assert rows(back) == [("a", 1, "new"), ("a", 2, "old"), ("b", 1, "old")]
    u2 = spark.createDataFrame([("b", 1, "newer")], "k string, d int, v string")
    existing = spark.read.parquet(p)
    write_upsert(u2, p, "d", ["k", "d"], existing=existing, partitions=[1])   # static pruning
    back = spark.read.parquet(p).select("k", "d", "v")
    assert rows(back) == [("a", 1, "new"), ("a", 2, "old"), ("b", 1, "newer")]


def test_day_filter_is_pushed_down(spark):
    snap = datelist_as_of(L.user_events(spark, SF_SMALL), "user_id", LAST)
    assert "LessThan(ts,2024-01-31T00:00)]" in plan_text(snap)   # in PushedFilters
    f = activity_flags(snap, "user_id", LAST)
    assert "CartesianProduct" not in plan_text(f) and "NestedLoopJoin" not in plan_text(f)


def test_persisted_daily_run_is_idempotent(spark):
    from tessera.sources import standins as S
    ev = S.activity_events(spark, SF_SMALL)
    kw = dict(not_null=("user_id",), list_col="host_activity_datelist")
    p = fresh_path(spark, "daily")
    first, today = FIRST, FIRST + dt.timedelta(days=5)
    datelist_history(ev, "host", first, today - dt.timedelta(days=1), **kw) \
        .write.partitionBy("date").parquet(p)
    for _ in range(2):                      # the second load of the day changes nothing
        table = spark.read.parquet(p)
        write_upsert(datelist_step(table, ev, "host", today, **kw), p, "date",
                     ["host", "date"], existing=table)
    final = spark.read.parquet(p)
    want = datelist_history(ev, "host", first, today, **kw)
    assert rows(final.select(*want.columns)) == rows(want)


def test_daily_step_prunes_partitions(spark):
    from tessera.sources import standins as S
    ev = S.activity_events(spark, SF_SMALL)
    kw = dict(not_null=("user_id",), list_col="host_activity_datelist")
    p = fresh_path(spark, "prune")
    datelist_history(ev, "host", FIRST, FIRST + dt.timedelta(days=4), **kw) \
        .write.partitionBy("date").parquet(p)
    table = spark.read.parquet(p)
    day = FIRST + dt.timedelta(days=5)
    step = datelist_step(table, ev, "host", day, **kw)
    # the previous day's partition only (static pruning)
    assert f"(date#" in plan_text(step) and f"= {day - dt.timedelta(days=1)})]" in plan_text(step)
    # the upsert's read of existing rows is pruned at runtime to the touched days
    cur = table.join(step.select("date").distinct(), "date", "left_semi")
    assert "dynamicpruning" in plan_text(cur)


def test_history_from_a_later_day_equals_as_of(spark):
    ev = _ev(spark, [("a", 5, 1), ("a", 1, 1), ("early", 6, 1), ("b", 0, 1)])
    hist = datelist_history(ev, "user_id", D - dt.timedelta(days=2), D)
    for back in range(3):
        day = D - dt.timedelta(days=back)
        want = datelist_as_of(ev, "user_id", day)
        assert rows(hist.where(F.col("date") == day).select(*want.columns)) == rows(want)


def test_write_upsert_without_existing_keeps_other_keys(spark):
    p = fresh_path(spark, "upsert-default")
    t = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), ("c", 2, "old")], "k string, d int, v string")
    write_upsert(t, p, "d", ["k", "d"])                     # nothing stored yet
    write_upsert(t.where("k = 'a'").withColumn("v", F.lit("new")), p, "d", ["k", "d"])
    assert rows(spark.read.parquet(p).select("k", "d", "v")) == [("a", 1, "new"), ("b", 1, "old"), ("c", 2, "old")]


def test_write_upsert_rejects_uncovered_partitions(spark):
    import pytest
    p = fresh_path(spark, "upsert-covered")
    t = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, d int, v string")
    t.write.partitionBy("d").parquet(p)
    conf = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        with pytest.raises(ValueError, match="outside"):
            write_upsert(t.withColumn("v", F.lit("new")), p, "d", ["k", "d"], partitions=[1])
        write_upsert(t.where("d = 1").withColumn("v", F.lit("new")), p, "d", ["k", "d"], partitions=[1])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", conf)
    assert rows(spark.read.parquet(p).select("k", "d", "v")) == [("a", 1, "new"), ("b", 2, "old")]
