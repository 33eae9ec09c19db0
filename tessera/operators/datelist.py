"""Activity datelists and 32-bit activity masks.

A datelist snapshot has one row per (entity, date) with the array of active
dates, newest first. Day filters are written as half-open timestamp ranges so
they reach the parquet scan as pushed filters (``to_date(ts) = d`` would not).
Nothing here builds an entity x day grid: masks come from the dates that exist,
through a higher-order function or a ``bit_or`` aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import any_bits, bit_at, bit_count, bits_text

DateLike = str | dt.date


def _d(day: DateLike) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def midnight(day: DateLike) -> Column:
    """``TIMESTAMP_NTZ 'day 00:00:00'`` -- built from text, so the session time
    zone plays no part (a Python datetime literal would be zone-converted)."""
    return F.lit(f"{_d(day).isoformat()} 00:00:00").cast("timestamp_ntz")


def before_day_end(ts: str, day: DateLike) -> Column:
    """``to_date(ts) <= day`` as a pushable range predicate."""
    return F.col(ts) < midnight(_d(day) + dt.timedelta(days=1))


def on_day(ts: str, day: DateLike) -> Column:
    """``to_date(ts) = day`` as a pushable range predicate."""
    return (F.col(ts) >= midnight(day)) & before_day_end(ts, day)


def between_days(ts: str, first: DateLike, last: DateLike) -> Column:
    return (F.col(ts) >= midnight(first)) & before_day_end(ts, last)


def event_range(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Earliest and latest event time (op 22); partial aggregate, one row out."""
    return events.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def active_days(events: DataFrame, key: str, ts: str = "ts",
                not_null: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (key, day) pairs with a non-NULL key (and non-NULL ``not_null``)."""
    cond = F.col(key).isNotNull()
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    return events.where(cond).select(key, F.to_date(ts).alias("day")).distinct()


def datelist_step(prev: DataFrame, events: DataFrame, key: str, day: DateLike,
                  ts: str = "ts", list_col: str = "dates_active", date_col: str = "date",
                  not_null: tuple[str, ...] = ()) -> DataFrame:
    """Snapshot for ``day`` from the snapshot of ``day - 1`` and ``day``'s events (ops 23, 24).

    Today's date is prepended (newest first); entities absent today keep their
    list and move to ``day``.
    """
    d = _d(day)
    today = active_days(events.where(on_day(ts, d)), key, ts, not_null).alias("t")
    y = prev.where(F.col(date_col) == F.lit(d - dt.timedelta(days=1))).alias("y")
    j = today.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full_outer")
    t_day = F.col("t.day")
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.when(F.col(f"y.{list_col}").isNull(), F.array(t_day))
         .when(t_day.isNull(), F.col(f"y.{list_col}"))
         .otherwise(F.concat(F.array(t_day), F.col(f"y.{list_col}"))).alias(list_col),
        F.coalesce(t_day, F.date_add(F.col(f"y.{date_col}"), 1)).alias(date_col))


def datelist_as_of(events: DataFrame, key: str, day: DateLike, ts: str = "ts",
                   list_col: str = "dates_active", date_col: str = "date",
                   not_null: tuple[str, ...] = ()) -> DataFrame:
    """The snapshot for ``day`` straight from the events (seed for a daily run).

    Equal to folding ``datelist_step`` over every day up to ``day``; one partial
    ``distinct`` then one ``groupBy(key)``, the list bounded by the day count.
    """
    d = _d(day)
    days = active_days(events.where(before_day_end(ts, d)), key, ts, not_null)
    return (days.groupBy(key)
                .agg(F.sort_array(F.collect_list("day"), asc=False).alias(list_col))
                .withColumn(date_col, F.lit(d)))


def datelist_history(events: DataFrame, key: str, first: DateLike, last: DateLike,
                     ts: str = "ts", list_col: str = "dates_active", date_col: str = "date",
                     not_null: tuple[str, ...] = ()) -> DataFrame:
    """Every daily snapshot from ``first`` to ``last`` in one job (datelist backfill).

    Lists hold all active days up to the snapshot, also those before ``first``: each
    snapshot equals ``datelist_as_of`` that day. One ``groupBy(key)`` collects each entity's active days once; a row per
    snapshot date is generated with ``explode(sequence)`` and its list is a
    ``filter`` of the collected days -- no join against a date series.
    """
    f, la = _d(first), _d(last)
    days = active_days(events.where(before_day_end(ts, la)), key, ts, not_null)
    per = days.groupBy(key).agg(F.sort_array(F.collect_list("day"), asc=False).alias("_all"),
                                F.min("day").alias("_first"))
    rows = per.select(key, "_all",
                      F.explode(F.sequence(F.greatest("_first", F.lit(f)), F.lit(la))).alias(date_col))
    cur = F.col(date_col)
    return rows.select(key, F.filter("_all", lambda x: x <= cur).alias(list_col), date_col)


def active_on(snapshot: DataFrame, day: DateLike, list_col: str = "dates_active") -> DataFrame:
    """Rows whose datelist holds ``day`` (op 25)."""
    return snapshot.where(F.array_contains(list_col, F.lit(_d(day))))


def _flags(df: DataFrame, mask: str, n_bits: int) -> DataFrame:
    weekly = ((1 << 7) - 1) << (n_bits - 7)
    daily = 1 << (n_bits - 1)
    return (df.withColumn("bits", bits_text(mask, n_bits))
              .withColumn("dim_is_monthly_active", F.col(mask) != 0)
              .withColumn("dim_is_weekly_active", any_bits(mask, weekly))
              .withColumn("dim_is_daily_active", any_bits(mask, daily))
              .withColumn("n_active_days", bit_count(mask)))


def activity_flags(snapshot: DataFrame, key: str, day: DateLike,
                   list_col: str = "dates_active", n_bits: int = 32) -> DataFrame:
    """Activity bitmask of the last ``n_bits`` days from a datelist (op 26).

    Bit ``n_bits - 1 - age`` is set when the entity was active ``age`` days
    before ``day`` (the snapshot day is the top bit); older days are dropped.
    Flags: monthly = any bit, weekly = any of the top 7, daily = the top bit.
    Computed per row with ``aggregate`` over the array: no cross join with a
    date series.
    """
    d = F.lit(_d(day))
    ages = F.transform(list_col, lambda x: F.datediff(d, x))
    kept = F.filter(ages, lambda a: (a >= 0) & (a < n_bits))
    mask = F.aggregate(kept, F.lit(0).cast("bigint"),
                       lambda acc, a: acc.bitwiseOR(bit_at(n_bits - 1 - a)))
    return _flags(snapshot.select(key, mask.alias("bitmask")), "bitmask", n_bits)


def activity_mask_from_events(events: DataFrame, key: str, day: DateLike, ts: str = "ts",
                              n_bits: int = 32, not_null: tuple[str, ...] = ()) -> DataFrame:
    """The op-26 mask computed straight from events with a ``bit_or`` aggregate.

    Only the last ``n_bits`` days are scanned (pushed range filter). ``bit_or``
    is idempotent, so no ``distinct`` is needed first: one fixed-width partial
    HashAggregate folds a hot entity on the mappers, then one shuffle.
    """
    d = _d(day)
    first = d - dt.timedelta(days=n_bits - 1)
    cond = between_days(ts, first, d) & F.col(key).isNotNull()
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    age = F.datediff(F.lit(d), F.to_date(ts))
    m = (events.where(cond).groupBy(key)
               .agg(F.bit_or(bit_at(F.lit(n_bits - 1) - age)).alias("bitmask")))
    return _flags(m, "bitmask", n_bits)
