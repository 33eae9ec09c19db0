"""Monthly metric arrays: one row per (entity, month) with one element per day.

Element ``i`` of a month's array is the metric on ``month_start + i``. The
daily step sets the day's element and keeps all others (padding with zeros up
to the day when the entity is new or was missing) -- so a re-run of any day
rewrites that day alone, whether or not later days are loaded, and an entity
first seen on day ``k`` stays aligned with its dates.

A host's distinct visitors are kept as rows, one per (host, date, visitor): no
stored row grows with a popular host, and re-running a day replaces that day's
rows alone. The month's distinct count is taken from the rows when reported.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.datelist import between_days, on_day


def _month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def _with_day(prev_arr: Column, offset: int, value: Column) -> Column:
    """``prev_arr`` with element ``offset`` set to ``value`` (NULL: 0), later elements kept."""
    none = F.array().cast("array<bigint>")
    have = F.coalesce(prev_arr, none)
    before = F.slice(have, 1, offset) if offset > 0 else none
    pad = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(offset) - F.size(before),
                                                               F.lit(0)))
    after = F.slice(have, offset + 2, F.greatest(F.size(have) - F.lit(offset + 1), F.lit(0)))
    return F.concat(before, pad, F.array(F.coalesce(value, F.lit(0)).cast("bigint")), after)


def daily_counts(events: DataFrame, key: str, day: dt.date, ts: str = "ts",
                 not_null: str | None = None) -> DataFrame:
    """Rows per key on ``day`` (the 'site hits' metric)."""
    ev = events.where(on_day(ts, day) & F.col(key).isNotNull())
    if not_null:
        ev = ev.where(F.col(not_null).isNotNull())
    return ev.groupBy(key).agg(F.count(F.lit(1)).alias("_v"))


def month_array_step(prev: DataFrame, events: DataFrame, key: str, metric_name: str,
                     day: dt.date, ts: str = "ts", array_col: str = "metric_array") -> DataFrame:
    """Fold ``day``'s count per key into the month's arrays (op 29).

    ``prev`` is the array table (any months); only ``(month(day), metric_name)``
    rows are read. One full outer join on the key.
    """
    m, off = _month(day), (day - _month(day)).days
    y = prev.where((F.col("month_start") == F.lit(m)) &
                   (F.col("metric_name") == metric_name)).alias("y")
    t = daily_counts(events, key, day, ts).alias("t")
    j = t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full_outer")
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.lit(m).alias("month_start"),
        F.lit(metric_name).alias("metric_name"),
        _with_day(F.col(f"y.{array_col}"), off, F.col("t._v")).alias(array_col))


def month_arrays_as_of(events: DataFrame, key: str, metric_name: str, day: dt.date,
                       ts: str = "ts", array_col: str = "metric_array") -> DataFrame:
    """The month's arrays up to ``day`` straight from events (seed / check).

    Per (key, day) counts (partial aggregate), then one ``groupBy(key)`` into an
    offset -> count map that is densified with ``transform(sequence)``.
    """
    m, off = _month(day), (day - _month(day)).days
    per_day = (events.where(between_days(ts, m, day) & F.col(key).isNotNull())
                     .groupBy(key, F.to_date(ts).alias("_d"))
                     .agg(F.count(F.lit(1)).alias("_v")))
    per_key = per_day.groupBy(key).agg(F.map_from_entries(F.collect_list(
        F.struct(F.datediff("_d", F.lit(m)).alias("_o"), F.col("_v")))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(off)),
                        lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(0)).cast("bigint"))
    return per_key.select(key, F.lit(m).alias("month_start"),
                          F.lit(metric_name).alias("metric_name"), dense.alias(array_col))


def host_month_step(prev: DataFrame, events: DataFrame, day: dt.date, key: str = "host",
                    ts: str = "ts") -> DataFrame:
    """Reduced monthly host fact: the hit array (op 30); its visitors are ``host_visitors_of_day``."""
    m, off = _month(day), (day - _month(day)).days
    y = prev.where(F.col("month_start") == F.lit(m)).alias("y")
    t = daily_counts(events, key, day, ts).alias("t")
    j = t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full_outer")
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.lit(m).alias("month_start"),
        _with_day(F.col("y.hit_array"), off, F.col("t._v")).alias("hit_array"))


def host_month_as_of(events: DataFrame, day: dt.date, key: str = "host",
                     ts: str = "ts") -> DataFrame:
    """``host_month_step`` folded from the month start, computed directly."""
    return (month_arrays_as_of(events, key, "hits", day, ts, "hit_array")
            .select(key, "month_start", "hit_array"))


def host_visitors_of_day(events: DataFrame, day: dt.date, key: str = "host",
                         visitor: str = "user_id", ts: str = "ts") -> DataFrame:
    """(host, date, visitor) rows of one day: the partition that the day's load replaces (op 30)."""
    cond = on_day(ts, day) & F.col(key).isNotNull() & F.col(visitor).isNotNull()
    return (events.where(cond).select(key, F.lit(day).alias("date"),
                                      F.col(visitor).cast("string").alias("visitor")).distinct())


def host_visitors_as_of(events: DataFrame, day: dt.date, key: str = "host",
                        visitor: str = "user_id", ts: str = "ts") -> DataFrame:
    """``host_visitors_of_day`` of every day of the month up to ``day``."""
    cond = between_days(ts, _month(day), day) & F.col(key).isNotNull() & F.col(visitor).isNotNull()
    return (events.where(cond).select(key, F.to_date(ts).alias("date"),
                                      F.col(visitor).cast("string").alias("visitor")).distinct())


def month_visitors(visitors: DataFrame, key: str = "host") -> DataFrame:
    """(host, month_start, visitor): the month's distinct visitors, one row each."""
    return visitors.select(key, F.trunc("date", "month").alias("month_start"), "visitor").distinct()


def _bitmaps(events: DataFrame, cond: Column, month: Column, key: str, visitor: str) -> DataFrame:
    ev = events.where(cond & F.col(key).isNotNull() & F.col(visitor).isNotNull())
    return (ev.groupBy(key, month.alias("month_start"), F.bitmap_bucket_number(visitor).alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(visitor)).alias("bitmap")))


def host_visitor_bitmaps_of_day(events: DataFrame, day: dt.date, key: str = "host", visitor: str = "user_id",
                                ts: str = "ts") -> DataFrame:
    """(host, month_start, bucket, bitmap): one day's visitors, a bit each (op 30 with integer visitors).

    A bitmap has a fixed size and stands for the ids of one bucket, so no row grows with a popular host and
    none is lost: counts are exact. A partial aggregate builds a hot host's bitmaps on the mappers. For ids that are
    scattered over a wide range, where a bucket holds few visitors, keep them as rows (``host_visitors_of_day``).
    """
    return _bitmaps(events, on_day(ts, day), F.lit(_month(day)), key, visitor)


def host_visitor_bitmaps_as_of(events: DataFrame, day: dt.date, key: str = "host", visitor: str = "user_id",
                               ts: str = "ts") -> DataFrame:
    """The month's bitmaps up to ``day`` straight from events (seed / check)."""
    return _bitmaps(events, between_days(ts, _month(day), day), F.lit(_month(day)), key, visitor)


def merge_visitor_bitmaps(prev: DataFrame, today: DataFrame, key: str = "host") -> DataFrame:
    """The month's bitmaps with a day's merged in: an OR per (host, month, bucket), without the rows behind them.

    Merging a day again changes nothing; months that ``today`` has no rows of come out as they are.
    """
    cols = [key, "month_start", "bucket"]
    both = prev.select(*cols, "bitmap").unionByName(today.select(*cols, "bitmap"))
    return both.groupBy(*cols).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def month_visitor_counts(bitmaps: DataFrame, key: str = "host") -> DataFrame:
    """(host, month_start, n_visitors): distinct visitors, the bits of a month's bitmaps."""
    return bitmaps.groupBy(key, "month_start").agg(F.sum(F.bitmap_count("bitmap")).alias("n_visitors"))


def unpack_month_arrays(t: DataFrame, array_col: str = "metric_array",
                        group: tuple[str, ...] = ("metric_name",)) -> DataFrame:
    """Element-wise sum across entities, one row per day (op 31).

    ``posexplode`` then a partial ``groupBy(group, month_start, pos)``; works
    for any array length.
    """
    x = t.select(*group, "month_start", F.posexplode(array_col).alias("_pos", "_v"))
    return (x.groupBy(*group, "month_start", "_pos")
             .agg(F.sum("_v").alias("value"))
             .select(*group, F.date_add("month_start", F.col("_pos")).alias("date"), "value"))
