"""Per-dimension activity maps (user -> {browser: dates | mask}).

Plan: events are first reduced to distinct (user, device, day) -- a partial
aggregate, so a hot user or device is folded on the mappers -- and only then
joined to the deduplicated device dimension. One shuffle by user then serves the
distinct and both levels of the map. Where a user may have a large share of all (device,
day) rows, ``one_shuffle=False`` reduces them on the mappers by (user, browser, day) first, and
shuffles once more.
The map is built per user from at most (#browsers x #days) entries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import bit_at
from tessera.operators.datelist import before_day_end, between_days


def _user_device_days(events, devices, key, device, dim, ts, cond, one_shuffle):
    ev = (events.where(cond & F.col(key).isNotNull())
                .select(key, device, F.to_date(ts).alias("day"))
                .distinct())
    # DISTINCT (device, dim) keeps a device with two values twice (fan-out kept)
    dd = devices.select(device, dim).distinct()
    mapped = ev.join(dd, device).where(F.col(dim).isNotNull()).select(key, dim, "day")
    return (mapped.repartition(key) if one_shuffle else mapped).distinct()


def _shape(df: DataFrame, out_col: str, as_json: bool) -> DataFrame:
    # as_json: the stored form struct(browser_dates = JSON object text)
    if not as_json:
        return df
    return df.withColumn(out_col, F.struct(F.to_json(out_col).alias("browser_dates")))


def device_datelist(events: DataFrame, devices: DataFrame, day: dt.date, key: str = "user_id",
                    device: str = "device_id", dim: str = "browser_type", ts: str = "ts",
                    out_col: str = "device_activity_datelist",
                    as_json: bool = False, one_shuffle: bool = True) -> DataFrame:
    """Map of ``dim`` -> ascending active dates up to ``day`` per user (op 27).

    ``as_json=True`` returns ``struct(browser_dates: JSON text)`` instead of the map.
    """
    days = _user_device_days(events, devices, key, device, dim, ts, before_day_end(ts, day), one_shuffle)
    per_dim = days.groupBy(key, dim).agg(F.sort_array(F.collect_list("day")).alias("_dates"))
    out = (per_dim.groupBy(key)
                  .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(dim, "_dates"))))
                       .alias(out_col))
                  .withColumn("date", F.lit(day)))
    return _shape(out, out_col, as_json)


def device_datelist_int(events: DataFrame, devices: DataFrame, month_start: dt.date,
                        day: dt.date, key: str = "user_id", device: str = "device_id",
                        dim: str = "browser_type", ts: str = "ts",
                        out_col: str = "datelist_int", as_json: bool = False,
                        one_shuffle: bool = True) -> DataFrame:
    """Map of ``dim`` -> 32-bit activity mask per user (op 28).

    Bit ``k`` is set when the user was active ``k`` days after ``month_start``
    (0 <= k <= 31); days outside that window are not scanned. ``bit_or``, so two
    events on one day set one bit.
    """
    last = min(day, month_start + dt.timedelta(days=31))
    # bit_or is idempotent: fold events per (user, device) first (partial, fixed
    # width), join the much smaller result to the device dimension, fold again
    off = F.datediff(F.to_date(ts), F.lit(month_start))
    per_device = (events.where(between_days(ts, month_start, last) & F.col(key).isNotNull())
                        .groupBy(key, device).agg(F.bit_or(bit_at(off)).alias("_m")))
    dd = devices.select(device, dim).distinct()
    mapped = per_device.join(dd, device).where(F.col(dim).isNotNull()).select(key, dim, "_m")
    per_dim = (mapped.repartition(key) if one_shuffle else mapped).groupBy(key, dim).agg(F.bit_or("_m").alias("_mask"))
    out = (per_dim.groupBy(key)
                  .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(dim, "_mask"))))
                       .alias(out_col))
                  .withColumn("date", F.lit(day)))
    return _shape(out, out_col, as_json)


def explode_map(df: DataFrame, key: str, map_col: str, k: str, v: str) -> DataFrame:
    """Flat (key, map key, map value) rows of a map column."""
    return df.select(key, "date", F.explode(map_col).alias(k, v))
