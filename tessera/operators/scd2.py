"""Slowly changing dimension, type 2.

``scd2_backfill`` turns a run of snapshots into streak records with a window
over each entity's periods (partition size = number of periods, bounded).
``scd2_increment`` folds one new period into the SCD table with ONE full outer
join of the open records and today's rows; closed records never shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _differs(a: Column, b: Column) -> Column:
    # NULL-safe: a NULL attribute compared to a value is a change
    return ~a.eqNullSafe(b)


def scd2_backfill(snapshots: DataFrame, key: str, tracked: Sequence[str], period: str,
                  as_of: int, change_on: Sequence[str] | None = None, collapse: bool = True,
                  start_col: str = "start_period", end_col: str = "end_period",
                  current_col: str = "current_period") -> DataFrame:
    """Streak records from snapshots up to ``as_of`` (ops 7 and 8).

    ``change_on`` (default: all ``tracked``) are the columns whose change opens a
    new streak. ``collapse=True`` groups by streak (start/end span the streak,
    stamped ``as_of``); ``collapse=False`` keeps one record per period, stamped
    with that period (the literal single-attribute variant).
    """
    change_on = list(change_on) if change_on is not None else list(tracked)
    w = Window.partitionBy(key).orderBy(period)
    s = snapshots.where(F.col(period) <= as_of).select(key, period, *tracked)
    changed = F.lit(False)
    for c in change_on:
        changed = changed | _differs(F.col(c), F.lag(c, 1).over(w))
    first = F.row_number().over(w) == 1
    s = s.withColumn("_chg", F.when(first | changed, 1).otherwise(0))
    s = s.withColumn("_streak", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if collapse:
        return (s.groupBy(key, "_streak", *tracked)
                 .agg(F.min(period).alias(start_col), F.max(period).alias(end_col))
                 .select(key, *tracked, start_col, end_col, F.lit(as_of).alias(current_col)))
    return s.select(key, *tracked, F.col(period).alias(start_col), F.col(period).alias(end_col),
                    F.col(period).alias(current_col))


def scd2_increment(scd: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str],
                   prev_period: int, period: int, snapshot_period_col: str,
                   start_col: str = "start_period", end_col: str = "end_period",
                   current_col: str = "current_period", with_branch: bool = False) -> DataFrame:
    """Fold period ``period``'s snapshot into the SCD table stamped ``prev_period`` (op 9).

    Branches: historical (closed before ``prev_period``, passed through),
    unchanged (open record's end moves to ``period``), changed (open record
    closed + new record opened), new (key not open before), and missing (open
    record whose key is absent today: kept, closed at ``prev_period``).
    Keys and attributes compare NULL-safely so every row lands in exactly one
    branch; a NULL key is a key like any other.
    """
    last = scd.where(F.col(current_col) == prev_period)
    historical = last.where(F.col(end_col) < prev_period).select(
        key, *tracked, start_col, end_col, F.lit("historical").alias("_branch"))
    o = last.where(F.col(end_col) == prev_period).alias("o")
    t = (snapshot.where(F.col(snapshot_period_col) == period)
                 .select(key, *tracked, F.lit(True).alias("_here")).alias("t"))
    o = o.withColumn("_here", F.lit(True)).alias("o")
    j = t.join(o, F.col(f"t.{key}").eqNullSafe(F.col(f"o.{key}")), "full_outer")

    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}"))
    in_t, in_o = F.col("t._here").isNotNull(), F.col("o._here").isNotNull()

    def rec(src, start, end, branch):
        return F.struct(*[F.col(f"{src}.{c}").alias(c) for c in tracked],
                        start.alias(start_col), end.alias(end_col),
                        F.lit(branch).alias("_branch"))

    p = F.lit(period)
    old = rec("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}"), "changed")
    records = (F.when(in_t & ~in_o, F.array(rec("t", p, p, "new")))
                .when(in_t & same, F.array(rec("t", F.col(f"o.{start_col}"), p, "unchanged")))
                .when(in_t, F.array(old, rec("t", p, p, "changed")))
                .otherwise(F.array(rec("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}"),
                                       "missing"))))
    merged = j.select(F.coalesce(F.col(f"t.{key}"), F.col(f"o.{key}")).alias(key),
                      F.inline(records))
    out = historical.unionByName(merged).withColumn(current_col, F.lit(period))
    cols = [key, *tracked, start_col, end_col, current_col]
    if with_branch:
        return out.select(*cols, F.col("_branch").alias("branch"))
    return out.select(*cols)
