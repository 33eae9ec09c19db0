from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.catalog import cumulative as C
from tessera.functions.columns import classify, concat_arrays
from tessera.session import cut_lineage
from tessera.operators.cumulative import (cumulate_backfill, cumulate_step, cumulate_step_multi,
                                          history_ratio, snapshot_multi_as_of, unnest_history)

BINS = [(20, "star"), (15, "good"), (10, "average")]
SCHEMA = "name string, season int, pts double, college string"


def _facts(spark):
    return spark.createDataFrame([
        ("a", 2000, 25.0, "x"), ("a", 2001, 12.0, "x"),          # both periods
        ("b", 2000, 16.0, "y"),                                  # only in prev
        ("c", 2001, 5.0, "z"),                                   # only today
        ("d", 1999, 11.0, "w"), ("d", 2001, None, "w"),          # gap + NULL value
    ], SCHEMA)


def _bf(facts, hi):
    return cumulate_backfill(facts, "name", "season", ["season", "pts"], 1999, hi, "pts", BINS,
                             "bad", static_cols=["college"])


def test_classify_null_falls_to_else(spark):
    df = spark.createDataFrame([(21.0,), (20.0,), (None,)], "v double")
    assert [r[0] for r in df.select(classify("v", BINS, "bad")).collect()] == \
        ["star", "good", "bad"]


def test_concat_arrays_null_is_empty(spark):
    df = spark.createDataFrame([([1], None)], "a array<int>, b array<int>")
    assert df.select(concat_arrays("a", "b")).collect()[0][0] == [1]


def test_backfill_edge_rows(spark):
    snap = _bf(_facts(spark), 2001)
    got = {(r["name"], r["current_period"]): r for r in snap.collect()}
    assert ("c", 2000) not in got                         # starts at its first period
    b = got[("b", 2001)]
    assert (b["class"], b["years_since_last_active"], b["is_active"]) == ("good", 1, False)
    d = got[("d", 2000)]
    assert (d["class"], d["years_since_last_active"], len(d["history"])) == ("average", 1, 1)
    d1 = got[("d", 2001)]
    assert d1["class"] == "bad" and d1["is_active"] and len(d1["history"]) == 2


def test_step_equals_backfill(spark):
    facts = _facts(spark)
    prev = _bf(facts, 2000)
    step = cumulate_step(prev, facts, "name", "season", ["season", "pts"], 2001, "pts", BINS,
                         "bad", static_cols=["college"])
    full = _bf(facts, 2001).where(F.col("current_period") == 2001)
    assert rows(step) == rows(full.select(*step.columns))


def test_step_multi_equals_as_of(spark):
    films = spark.createDataFrame([
        ("a", 1970, "f2", 9.0), ("a", 1970, "f1", 7.0), ("a", 1972, "f3", 6.5),
        ("b", 1971, "g1", 5.0), ("c", 1972, "h1", 8.5)], "actor string, year int, film string, rating double")
    bins = [(8, "star"), (7, "good"), (6, "average")]
    prev = snapshot_multi_as_of(films, "actor", "year", ["film", "rating"], "rating", 1971,
                                bins, "bad")
    step = cumulate_step_multi(prev, films, "actor", "year", ["film", "rating"], "rating",
                               1972, bins, "bad")
    direct = snapshot_multi_as_of(films, "actor", "year", ["film", "rating"], "rating", 1972,
                                  bins, "bad")
    assert rows(step) == rows(direct.select(*step.columns))
    a = [r for r in step.collect() if r["actor"] == "a"][0]
    assert [f["film"] for f in a["history"]] == ["f1", "f2", "f3"]
    assert a["class"] == "average" and a["is_active"]
    b = [r for r in step.collect() if r["actor"] == "b"][0]
    assert (b["is_active"], b["years_since_last_active"]) == (False, 1)


def test_unnest_and_ratio(spark):
    snap = _bf(_facts(spark), 2001).where(F.col("current_period") == 2001)
    u = unnest_history(snap, "name")
    assert rows(u.where(F.col("name") == "a"), "season", "pts") == [(2000, 25.0), (2001, 12.0)]
    r = {x["name"]: x["ratio"] for x in history_ratio(snap, "name", "pts").collect()}
    assert r["a"] == 12.0 / 25.0


def test_ratio_zero_denominator(spark):
    df = spark.createDataFrame([("z", [(1, 0.0), (2, 5.0)])],
                               "name string, history array<struct<season:int,pts:double>>")
    assert history_ratio(df, "name", "pts").collect()[0]["ratio"] == 5.0


def test_fold_of_steps_equals_backfill_on_orders(spark):
    facts = C.seasons(spark, SF_SMALL)
    lo, hi = C.year_span(spark, SF_SMALL)
    snap = C.backfill(spark, SF_SMALL, lo).where(F.col("current_year") == lo)
    for y in range(lo + 1, hi + 1):
        snap = cumulate_step(snap, facts, C.KEY, "year", C.ENTRY, y, "avg_price", C.BINS,
                             C.ELSE, static_cols=C.STATIC, current_col="current_year")
        snap = cut_lineage(snap)  # reliable checkpoint per period, as a daily job would
    full = C.backfill(spark, SF_SMALL).where(F.col("current_year") == hi)
    assert rows(C.flat(snap)) == rows(C.flat(full))


def test_backfill_plan_has_no_cartesian(spark):
    plan = C.backfill(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
