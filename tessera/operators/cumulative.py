"""Cumulative snapshots: one row per (entity, period) holding the whole history.

Snapshot columns (names configurable):
  <key>, <static...>, history (array<struct>), <class_col>, years_since_last_active,
  is_active, <current_col>

Shuffle plan
------------
* ``cumulate_backfill``: a single ``groupBy(key)`` (map-side partial
  ``collect_list``) builds each entity's entry list once; every period row is
  then produced by ``explode(sequence(first, hi))`` and a ``filter`` over that
  list -- no theta join, no window, no second shuffle.
* ``cumulate_step`` / ``cumulate_step_multi``: one full outer join of the
  previous period's partition with today's rows on the key.
* ``snapshot_multi_as_of``: two partial aggregations (per entity-period, then per
  entity); a hot entity is reduced on the mappers before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import classify, concat_arrays, first_elem, last_elem, safe_ratio


def _entry(period: str, entry_cols: Sequence[str]) -> Column:
    # the period goes first so sort_array orders entries chronologically
    return F.struct(*([F.col(period)] + [F.col(c) for c in entry_cols if c != period]))


def cumulate_backfill(facts: DataFrame, key: str, period: str, entry_cols: Sequence[str],
                      lo: int, hi: int, class_on: str, bins, else_label: str,
                      static_cols: Sequence[str] = (), history_col: str = "history",
                      class_col: str = "class", current_col: str = "current_period") -> DataFrame:
    """One-shot backfill of every snapshot period ``lo..hi`` (op 3).

    ``facts`` holds at most one row per (key, period). Each entity gets a row for
    every period from its first period in ``[lo, hi]`` to ``hi``; the history holds
    the entries up to that period; class, activity and gap come from the last
    entry. Static columns take their ``max`` over the entity's rows.
    """
    f = facts.where(F.col(period).between(lo, hi))
    aggs = [F.sort_array(F.collect_list(_entry(period, entry_cols))).alias("_all"),
            F.min(period).alias("_first")]
    aggs += [F.max(c).alias(c) for c in static_cols]
    per_key = f.groupBy(key).agg(*aggs)
    cur = F.col(current_col)
    rows = per_key.select(key, *static_cols, "_all",
                          F.explode(F.sequence(F.col("_first"), F.lit(hi))).alias(current_col))
    hist = F.filter(F.col("_all"), lambda e: e[period] <= cur)
    return _finish(rows.withColumn(history_col, hist).drop("_all"), key, period, class_on,
                   bins, else_label, static_cols, history_col, class_col, current_col)


def _finish(df, key, period, class_on, bins, else_label, static_cols, history_col,
            class_col, current_col):
    last = last_elem(history_col)
    cur = F.col(current_col)
    return df.select(
        key, *static_cols, history_col,
        classify(last[class_on], bins, else_label).alias(class_col),
        (cur - last[period]).alias("years_since_last_active"),
        (last[period] == cur).alias("is_active"),
        cur.alias(current_col))


def cumulate_step(prev: DataFrame, facts: DataFrame, key: str, period: str,
                  entry_cols: Sequence[str], at: int, class_on: str, bins,
                  else_label: str, static_cols: Sequence[str] = (),
                  history_col: str = "history", class_col: str = "class",
                  current_col: str = "current_period") -> DataFrame:
    """Snapshot ``at`` from snapshot ``at-1`` and period ``at``'s rows (op 1).

    ``facts`` has at most one row per (key, period); ``prev`` is the snapshot
    table (any periods; only ``at-1`` is read, so a period-partitioned table is
    pruned to one partition).
    """
    today = facts.where(F.col(period) == at).select(
        key, *static_cols, F.array(_entry(period, entry_cols)).alias("_new"),
        F.col(class_on).alias("_value"))
    return _step(prev, today, key, at, class_on, bins, else_label, static_cols,
                 history_col, class_col, current_col)


def cumulate_step_multi(prev: DataFrame, facts: DataFrame, key: str, period: str,
                        entry_cols: Sequence[str], rating_col: str, at: int, bins,
                        else_label: str, history_col: str = "history",
                        class_col: str = "class",
                        current_col: str = "current_period") -> DataFrame:
    """Op 2: as op 1, but many rows per entity per period.

    The period's rows are collected into a sorted array of entries and the class
    is taken from the average ``rating_col`` of the period (one partial
    aggregation, then the same full outer join as op 1).
    """
    today = (facts.where(F.col(period) == at)
                  .groupBy(key)
                  .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in entry_cols])))
                        .alias("_new"),
                       F.avg(rating_col).alias("_value")))
    return _step(prev, today, key, at, None, bins, else_label, (), history_col,
                 class_col, current_col)


def _step(prev, today, key, at, class_on, bins, else_label, static_cols, history_col,
          class_col, current_col):
    y = prev.where(F.col(current_col) == at - 1).alias("y")
    t = today.alias("t")
    j = t.join(y, F.col(f"t.{key}").eqNullSafe(F.col(f"y.{key}")), "full_outer")      # a NULL key is an entity
    seen_today = F.col("t._new").isNotNull()
    out = [F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key)]
    out += [F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")).alias(c) for c in static_cols]
    out += [
        F.when(seen_today, concat_arrays(F.col(f"y.{history_col}"), F.col("t._new")))
         .otherwise(F.col(f"y.{history_col}")).alias(history_col),
        F.when(seen_today, classify(F.col("t._value"), bins, else_label))
         .otherwise(F.col(f"y.{class_col}")).alias(class_col),
        F.when(seen_today, F.lit(0))
         .otherwise(F.col("y.years_since_last_active") + 1).alias("years_since_last_active"),
        seen_today.alias("is_active"),
        F.lit(at).alias(current_col),
    ]
    return j.select(*out)


def snapshot_multi_as_of(facts: DataFrame, key: str, period: str, entry_cols: Sequence[str],
                         rating_col: str, at: int, bins, else_label: str,
                         history_col: str = "history", class_col: str = "class",
                         current_col: str = "current_period") -> DataFrame:
    """The op-2 snapshot for period ``at`` computed directly from all rows <= ``at``.

    Equal to folding ``cumulate_step_multi`` from the first period; used to seed
    an incremental run without replaying every period.
    """
    per_period = (facts.where(F.col(period) <= at)
                       .groupBy(key, period)
                       .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in entry_cols])))
                             .alias("_films"),
                            F.avg(rating_col).alias("_value")))
    per_key = (per_period.groupBy(key)
                         .agg(F.sort_array(F.collect_list(
                             F.struct(F.col(period), F.col("_films"), F.col("_value"))))
                             .alias("_p")))
    last = last_elem("_p")
    return per_key.select(
        key,
        F.flatten(F.transform("_p", lambda x: x["_films"])).alias(history_col),
        classify(last["_value"], bins, else_label).alias(class_col),
        (F.lit(at) - last[period]).alias("years_since_last_active"),
        (last[period] == at).alias("is_active"),
        F.lit(at).alias(current_col))


def _period_summary(facts, key, rating_col):
    return facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.avg(rating_col).alias("_value"))


def cumulate_step_rows(prev: DataFrame, facts: DataFrame, key: str, period: str, rating_col: str, at: int,
                       bins, else_label: str, class_col: str = "class",
                       current_col: str = "current_period") -> DataFrame:
    """Op 2 with the history kept as rows.

    The entries stay where they are, one row each, in the period-partitioned ``facts``; the snapshot
    holds an entity's number of entries, class, gap and activity. Its rows have a fixed width, and a
    busy entity's period is counted and averaged before the shuffle.
    """
    y = prev.where(F.col(current_col) == at - 1).alias("y")
    t = _period_summary(facts.where(F.col(period) == at), key, rating_col).alias("t")
    j = t.join(y, F.col(f"t.{key}").eqNullSafe(F.col(f"y.{key}")), "full_outer")
    seen = F.col("t._n").isNotNull()
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        (F.coalesce("y.n_entries", F.lit(0)) + F.coalesce("t._n", F.lit(0))).alias("n_entries"),
        F.when(seen, classify(F.col("t._value"), bins, else_label))
         .otherwise(F.col(f"y.{class_col}")).alias(class_col),
        F.when(seen, F.lit(0)).otherwise(F.col("y.years_since_last_active") + 1)
         .alias("years_since_last_active"),
        seen.alias("is_active"), F.lit(at).alias(current_col))


def rows_summary_as_of(facts: DataFrame, key: str, period: str, rating_col: str, at: int, bins,
                       else_label: str, class_col: str = "class",
                       current_col: str = "current_period") -> DataFrame:
    """``cumulate_step_rows`` folded from the first period, computed directly."""
    f = facts.where(F.col(period) <= at)
    per = f.groupBy(key, period).agg(F.count(F.lit(1)).alias("_n"), F.avg(rating_col).alias("_value"))
    last = F.max(F.struct(period, "_value")).alias("_last")
    return per.groupBy(key).agg(F.sum("_n").alias("n_entries"), last).select(
        key, "n_entries", classify(F.col("_last._value"), bins, else_label).alias(class_col),
        (F.lit(at) - F.col(f"_last.{period}")).alias("years_since_last_active"),
        (F.col(f"_last.{period}") == at).alias("is_active"), F.lit(at).alias(current_col))


def unnest_history(snapshot: DataFrame, key: str, history_col: str = "history",
                   keep: Sequence[str] = ()) -> DataFrame:
    """One row per (entity, history entry), struct fields as columns (op 5)."""
    return snapshot.select(key, *keep, F.inline(history_col))


def history_ratio(snapshot: DataFrame, key: str, field: str, history_col: str = "history",
                  alias: str = "ratio") -> DataFrame:
    """Last entry's ``field`` over the first entry's, zero denominator -> 1 (op 6).

    Reads the array in place: no shuffle.
    """
    last = last_elem(history_col)[field]
    first = first_elem(history_col)[field]
    return snapshot.select(key, safe_ratio(last, first).alias(alias))
