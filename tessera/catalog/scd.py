"""SCD type 2 family (ops 7-9), tracking (class, is_active) of the customer snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.cumulative import HI_SQL, KEY, SNAP_SQL, backfill, year_span
from tessera.catalog.stored import stored
from tessera.operators.scd2 import scd2_backfill, scd2_increment

TRACKED = ["class", "is_active"]
NAMES = dict(start_col="start_year", end_col="end_year", current_col="current_year")


def _flat(df):
    return df.select(KEY, *TRACKED,
                     *[F.col(c).cast("bigint").alias(c)
                       for c in ("start_year", "end_year", "current_year")])


def scd_as_of(spark, d, as_of, **kw):
    snaps = backfill(spark, d, as_of)
    return scd2_backfill(snaps, KEY, TRACKED, "current_year", as_of, **NAMES, **kw)


def q_scd2_backfill(spark, d):
    return _flat(scd_as_of(spark, d, year_span(spark, d)[1]))


def q_scd2_backfill_single(spark, d):
    """Single-attribute variant, one record per year (literal form)."""
    return _flat(scd_as_of(spark, d, year_span(spark, d)[1], change_on=["class"], collapse=False))


def q_scd2_backfill_single_collapsed(spark, d):
    """Single-attribute variant grouped by (key, class, is_active, streak)."""
    return _flat(scd_as_of(spark, d, year_span(spark, d)[1], change_on=["class"], collapse=True))


def _increment(spark, d, with_branch=False):
    # the records of the year before are stored by year, as a daily load finds them
    _, last = year_span(spark, d)
    scd = stored(spark, scd_as_of(spark, d, last - 1), "current_year")
    return scd2_increment(scd, backfill(spark, d), KEY, TRACKED, last - 1, last, "current_year",
                          with_branch=with_branch, **NAMES)


def q_scd2_increment(spark, d):
    return _flat(_increment(spark, d))


def q_scd2_increment_branches(spark, d):
    inc = _increment(spark, d, with_branch=True)
    return inc.groupBy("branch").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


QUERIES = {
    "scd2_backfill": q_scd2_backfill,
    "scd2_backfill_single": q_scd2_backfill_single,
    "scd2_backfill_single_collapsed": q_scd2_backfill_single_collapsed,
    "scd2_increment": q_scd2_increment,
    "scd2_increment_branches": q_scd2_increment_branches,
}


def _streak_sql(change_cond: str) -> str:
    return f"""
      lagged AS (
        SELECT o_custkey, current_year, class, is_active,
               CASE WHEN row_number() OVER w = 1 THEN 1
                    WHEN {change_cond} THEN 1 ELSE 0 END AS chg
        FROM snapc WHERE current_year <= {HI_SQL}
        WINDOW w AS (PARTITION BY o_custkey ORDER BY current_year)),
      streaks AS (
        SELECT *, sum(chg) OVER (PARTITION BY o_custkey ORDER BY current_year
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
        FROM lagged)"""


BOTH = ("class IS DISTINCT FROM lag(class) OVER w "
        "OR is_active IS DISTINCT FROM lag(is_active) OVER w")
CLASS_ONLY = "class IS DISTINCT FROM lag(class) OVER w"

SCD_AT_HI = f"""
    WITH {SNAP_SQL}, {_streak_sql(BOTH)}
    SELECT o_custkey, class, is_active, CAST(min(current_year) AS BIGINT) AS start_year,
           CAST(max(current_year) AS BIGINT) AS end_year, CAST({HI_SQL} AS BIGINT) AS current_year
    FROM streaks GROUP BY o_custkey, streak, class, is_active"""

ORACLE = {
    "scd2_backfill": SCD_AT_HI,
    "scd2_backfill_single": f"""
        WITH {SNAP_SQL}
        SELECT o_custkey, class, is_active, current_year AS start_year,
               current_year AS end_year, current_year
        FROM snapc WHERE current_year <= {HI_SQL}""",
    "scd2_backfill_single_collapsed": f"""
        WITH {SNAP_SQL}, {_streak_sql(CLASS_ONLY)}
        SELECT o_custkey, class, is_active, CAST(min(current_year) AS BIGINT) AS start_year,
               CAST(max(current_year) AS BIGINT) AS end_year,
               CAST({HI_SQL} AS BIGINT) AS current_year
        FROM streaks GROUP BY o_custkey, streak, class, is_active""",
    "scd2_increment": SCD_AT_HI,
    "scd2_increment_branches": f"""
        WITH scd AS ({SCD_AT_HI}),
        tagged AS (
          SELECT CASE
                   WHEN end_year < ({HI_SQL} - 1) THEN 'historical'
                   WHEN end_year = ({HI_SQL} - 1) THEN 'changed'
                   WHEN start_year < {HI_SQL} THEN 'unchanged'
                   WHEN EXISTS (SELECT 1 FROM scd p WHERE p.o_custkey = s.o_custkey
                                AND p.start_year < {HI_SQL}) THEN 'changed'
                   ELSE 'new' END AS branch
          FROM scd s)
        SELECT branch, CAST(count(*) AS BIGINT) AS n FROM tagged GROUP BY branch""",
}
