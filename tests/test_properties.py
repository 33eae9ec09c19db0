"""Property: the activity mask from a datelist equals the mask from raw events,
and both equal a brute-force Python computation, for random event sets."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.datelist import activity_flags, activity_mask_from_events, datelist_as_of

DAY = dt.date(2024, 3, 31)
events_st = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 40), st.integers(0, 23)),
                     min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spec=events_st)
def test_mask_from_list_equals_mask_from_events(spark, spec):
    rows = [(u, dt.datetime.combine(DAY - dt.timedelta(days=a), dt.time(h))) for u, a, h in spec]
    ev = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz")
    from_list = {r["user_id"]: r["bitmask"]
                 for r in activity_flags(datelist_as_of(ev, "user_id", DAY), "user_id", DAY)
                 .collect()}
    from_events = {r["user_id"]: r["bitmask"]
                   for r in activity_mask_from_events(ev, "user_id", DAY).collect()}
    brute = {}
    for u, a, _ in spec:
        brute.setdefault(u, 0)
        if a <= 31:
            brute[u] |= 1 << (31 - a)
    assert from_list == brute
    assert from_events == {u: m for u, m in brute.items() if m}


month_st = st.lists(st.tuples(st.integers(0, 4), st.integers(1, 5)), min_size=1, max_size=25)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spec=month_st, rerun=st.integers(1, 5))
def test_month_array_fold_with_rerun_equals_as_of(spark, spec, rerun):
    from tessera.operators.month_arrays import month_array_step, month_arrays_as_of
    rows = [(u, dt.datetime(2024, 1, d, 12)) for u, d in spec]
    ev = spark.createDataFrame(rows, "user_id int, ts timestamp_ntz")
    t = spark.createDataFrame([], "user_id int, month_start date, metric_name string, "
                                  "metric_array array<bigint>")
    days = list(range(1, 6))
    days.append(rerun)                                 # one day again after the last: the later days stay
    for d in days:
        t = month_array_step(t, ev, "user_id", "hits", dt.date(2024, 1, d)).checkpoint()
    got = {r["user_id"]: r["metric_array"] for r in t.collect()}
    want = {r["user_id"]: r["metric_array"]
            for r in month_arrays_as_of(ev, "user_id", "hits", dt.date(2024, 1, 5)).collect()}
    assert got == want


scd_st = st.lists(st.tuples(st.integers(1, 3),                       # first period
                            st.lists(st.tuples(st.sampled_from(["a", "b"]), st.booleans()),
                                     min_size=4, max_size=4)),
                  min_size=1, max_size=6)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spec=scd_st)
def test_scd_fold_equals_backfill(spark, spec):
    from tessera.operators.scd2 import scd2_backfill, scd2_increment
    rows = [(f"k{i}", p, attrs[p - 1][0], attrs[p - 1][1])
            for i, (first, attrs) in enumerate(spec) for p in range(first, 5)]
    snaps = spark.createDataFrame(rows, "k string, p int, cls string, act boolean")
    scd = scd2_backfill(snaps, "k", ["cls", "act"], "p", 1)
    for p in range(2, 5):
        scd = scd2_increment(scd, snaps, "k", ["cls", "act"], p - 1, p, "p").checkpoint()
    full = scd2_backfill(snaps, "k", ["cls", "act"], "p", 4)
    cols = ["k", "cls", "act", "start_period", "end_period", "current_period"]
    key = lambda r: tuple(str(r[c]) for c in cols)     # noqa: E731
    assert sorted(scd.select(*cols).collect(), key=key) == \
        sorted(full.select(*cols).collect(), key=key)
