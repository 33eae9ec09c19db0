"""Fact table build and report.

Plan: duplicates are removed on the detail grain *before* joining the header
(the header side is unique per game, so the order of the two steps does not
change the result). The details are shuffled once, by game, which serves the
dedup and the join. Where duplicates abound or one game dominates, the caller
asks for two shuffles: the dedup's partial group-limit then runs before its shuffle
on the whole grain, and adaptive execution can split the join at a hot game.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import dedup


def minutes_from_text(text: str | Column, sep: str = ":") -> Column:
    """'mm:ss' text to fractional minutes; missing seconds count as 0.

    Text with no numeric minutes (empty, NULL, garbage) gives NULL instead of an
    ANSI cast error.
    """
    t = F.col(text) if isinstance(text, str) else text
    mins = F.split_part(t, F.lit(sep), F.lit(1)).try_cast("double")
    secs = F.split_part(t, F.lit(sep), F.lit(2)).try_cast("double")
    return mins + F.coalesce(secs, F.lit(0.0)) / 60.0


def contains_flag(text: str | Column, needle: str) -> Column:
    """``coalesce(position(needle in text), 0) > 0``: NULL text is False."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.instr(t, needle), F.lit(0)) > 0


def build_fact(details: DataFrame, headers: DataFrame, game_key: str,
               grain: Sequence[str], order: Sequence[str | Column],
               dims: Mapping[str, str | Column], flags: Mapping[str, str],
               text_col: str, measures: Mapping[str, str | Column],
               minutes_col: str | None = None, home_flag: tuple[str, str] | None = None,
               one_shuffle: bool = True) -> DataFrame:
    """Deduplicated fact table with ``dim_*`` and ``m_*`` columns (op 20).

    ``grain``: the fact's key on the detail rows (e.g. game, team, player);
    ``order``: unique tie-break for the duplicate kept; ``flags``: output name
    -> substring searched in ``text_col``; ``home_flag``: (detail team column,
    header home-team column) compared for ``dim_is_playing_at_home``.
    """
    if one_shuffle and game_key in grain:
        details = details.repartition(game_key)
    d = dedup(details, grain, order).drop("row_num")
    j = d.join(headers, game_key)
    out: list[Column] = [(F.col(v) if isinstance(v, str) else v).alias(k)
                         for k, v in dims.items()]
    if home_flag:
        out.append((F.col(home_flag[0]) == F.col(home_flag[1])).alias("dim_is_playing_at_home"))
    out += [contains_flag(text_col, needle).alias(name) for name, needle in flags.items()]
    if minutes_col:
        out.append(minutes_from_text(minutes_col).alias("m_minutes"))
    out += [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in measures.items()]
    return j.select(*out)


def absence_report(fact: DataFrame, by: str, points: str, flag: str) -> DataFrame:
    """Games, points, flagged count and its share per ``by`` (op 21).

    Sorted by share descending with NULLs first, as the SQL report.
    """
    return (fact.groupBy(by)
                .agg(F.count(F.lit(1)).alias("num_games"),
                     F.sum(points).alias("total_pts"),
                     F.count_if(F.col(flag)).alias("bailed_num"))
                .withColumn("bailed_pct", F.col("bailed_num").cast("double") / F.col("num_games"))
                .orderBy(F.col("bailed_pct").desc_nulls_first(), F.col(by)))
