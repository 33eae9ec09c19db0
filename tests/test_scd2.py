from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.catalog import cumulative as C
from tessera.catalog import scd as D
from tessera.operators.scd2 import scd2_backfill, scd2_increment

SCHEMA = "k string, p int, cls string, act boolean"
SNAPS = [
    ("same", 1, "a", True), ("same", 2, "a", True), ("same", 3, "a", True),
    ("cls", 1, "a", True), ("cls", 2, "b", True), ("cls", 3, "b", True),
    ("flag", 1, "a", True), ("flag", 2, "a", False), ("flag", 3, "a", False),
    ("back", 1, "a", True), ("back", 2, "b", True), ("back", 3, "a", True),
    ("nul", 1, None, True), ("nul", 2, "a", True), ("nul", 3, "a", True),
]


def _scd(spark, as_of, **kw):
    s = spark.createDataFrame(SNAPS, SCHEMA)
    return scd2_backfill(s, "k", ["cls", "act"], "p", as_of, **kw)


def test_backfill_streaks(spark):
    got = rows(_scd(spark, 3), "k", "cls", "act", "start_period", "end_period")
    assert ("same", "a", True, 1, 3) in got
    assert ("cls", "a", True, 1, 1) in got and ("cls", "b", True, 2, 3) in got
    assert ("flag", "a", True, 1, 1) in got and ("flag", "a", False, 2, 3) in got
    # flip back to an earlier value is a new streak, not merged with the first
    assert [r for r in got if r[0] == "back"] == [("back", "a", True, 1, 1),
                                                  ("back", "a", True, 3, 3),
                                                  ("back", "b", True, 2, 2)]
    # NULL -> value is a change (NULL-safe)
    assert ("nul", None, True, 1, 1) in got and ("nul", "a", True, 2, 3) in got
    assert {r["current_period"] for r in _scd(spark, 3).collect()} == {3}


def test_single_attribute_variants(spark):
    lit = _scd(spark, 3, change_on=["cls"], collapse=False)
    assert lit.count() == len(SNAPS)
    assert rows(lit.where(F.col("k") == "same"), "start_period", "end_period", "current_period") \
        == [(1, 1, 1), (2, 2, 2), (3, 3, 3)]
    col = rows(_scd(spark, 3, change_on=["cls"]), "k", "cls", "act", "start_period", "end_period")
    # a flag change alone opens no streak but the grouping still splits by the flag
    assert [r for r in col if r[0] == "flag"] == [("flag", "a", False, 2, 3),
                                                  ("flag", "a", True, 1, 1)]


def test_increment_branches_and_missing_key(spark):
    scd = _scd(spark, 2)
    today = spark.createDataFrame([
        ("same", 3, "a", True), ("cls", 3, "c", True), ("new", 3, "z", False),
        ("nul", 3, "a", True), ("back", 3, "a", True)], SCHEMA)   # 'flag' missing today
    inc = scd2_increment(scd, today, "k", ["cls", "act"], 2, 3, "p", with_branch=True)
    got = rows(inc, "k", "cls", "act", "start_period", "end_period", "branch")
    assert ("same", "a", True, 1, 3, "unchanged") in got
    assert ("cls", "b", True, 2, 2, "changed") in got and ("cls", "c", True, 3, 3, "changed") in got
    assert ("cls", "a", True, 1, 1, "historical") in got
    assert ("new", "z", False, 3, 3, "new") in got
    assert ("flag", "a", False, 2, 2, "missing") in got          # kept, closed
    assert {r["current_period"] for r in inc.collect()} == {3}


def test_increment_equals_backfill(spark):
    full = spark.createDataFrame(SNAPS, SCHEMA)
    inc = scd2_increment(_scd(spark, 2), full, "k", ["cls", "act"], 2, 3, "p")
    assert rows(inc) == rows(_scd(spark, 3).select(*inc.columns))


def test_fold_increments_equals_backfill_on_orders(spark):
    snaps = C.backfill(spark, SF_SMALL)
    lo, hi = C.year_span(spark, SF_SMALL)
    scd = D.scd_as_of(spark, SF_SMALL, lo)
    for y in range(lo + 1, hi + 1):
        scd = scd2_increment(scd, snaps, C.KEY, D.TRACKED, y - 1, y, "current_year", **D.NAMES)
        scd = scd.checkpoint()
    assert rows(D._flat(scd)) == rows(D.q_scd2_backfill(spark, SF_SMALL))


def test_null_key_is_a_key(spark):
    cols = "k string, cls string, act boolean, p int"
    snaps = spark.createDataFrame([(None, "a", True, 1), ("x", "a", True, 1), (None, "b", True, 2), ("y", "c", False, 2)], cols)
    scd = scd2_backfill(snaps, "k", ["cls", "act"], "p", 1)
    out = scd2_increment(scd, snaps, "k", ["cls", "act"], 1, 2, "p", with_branch=True)
    assert rows(out, "k", "cls", "start_period", "end_period", "branch") == sorted(
        [("x", "a", 1, 1, "missing"), ("y", "c", 2, 2, "new"), (None, "a", 1, 1, "changed"), (None, "b", 2, 2, "changed")], key=repr)
