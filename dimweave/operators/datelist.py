"""Datelist bitmaps: the last N days of activity packed into the bits of one
integer, and the activity flags read from it with masks.

Default layout: bit 31 is the anchor day, bit 31-d is d days before it.  The
array of dates is folded with ``aggregate`` -- no cross join with a calendar
and no shuffle beyond the one that already grouped the entity.

``compat=True`` reproduces the reference bit for bit: ``2^(32-d)`` summed per
user and cut to its low 32 bits, which loses the anchor day and lets the same
day in two browsers carry into the next bit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.columns import MASK_ANCHOR_DAY, MASK_LAST_7, MASK_PREVIOUS_7

LOW_32 = (1 << 32) - 1


def _pow2(n: Column) -> Column:
    """2^n as BIGINT (exact: powers of two are exact doubles up to 2^62)."""
    return F.pow(F.lit(2.0), n).cast("long")


def _bits_expr(dates: Column, anchor: Column, days: int, compat: bool) -> Column:
    def fold(acc, d):
        back = F.datediff(anchor, d)
        inside = (back >= 0) & (back < days)
        if compat:
            return acc + F.when(inside, _pow2(F.lit(32) - back)).otherwise(F.lit(0).cast("long"))
        return acc.bitwiseOR(F.when(inside, _pow2(F.lit(31) - back)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(dates, F.lit(0).cast("long"), fold)


def datelist_int(
    cum: DataFrame,
    keys: Sequence[str],
    dates_col: str,
    anchor: str | dt.date,
    days: int = 32,
    compat: bool = False,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    """Pack each row's dates (within ``days`` of ``anchor``) into bits.

    ``group_by`` (a prefix of ``keys``) merges several rows per entity --
    e.g. one row per browser into one value per user -- with a bitwise OR
    (``compat``: an arithmetic sum cut to 32 bits, as the reference does)."""
    a = F.to_date(F.lit(str(anchor)))
    per_row = cum.select(*keys, _bits_expr(F.col(dates_col), a, days, compat).alias("datelist_int"))
    if group_by is not None:
        agg = F.sum("datelist_int") if compat else F.bit_or("datelist_int")
        per_row = per_row.groupBy(*group_by).agg(agg.alias("datelist_int"))
        keys = list(group_by)
    if compat:
        per_row = per_row.withColumn("datelist_int", F.col("datelist_int").bitwiseAND(F.lit(LOW_32)))
    return per_row.select(*keys, "datelist_int", a.alias("date"))


def activity_flags(bits: DataFrame, keys: Sequence[str], col: str = "datelist_int") -> DataFrame:
    """Monthly / weekly / previous-week / daily activity from a datelist."""
    x = F.col(col)

    def count_in(mask: int) -> Column:
        return F.bit_count(x.bitwiseAND(F.lit(mask).cast("long")))

    return bits.select(
        *keys,
        F.bit_count(x).alias("l32"),
        (F.bit_count(x) > 0).alias("monthly_active"),
        count_in(MASK_LAST_7).alias("l7"),
        (count_in(MASK_LAST_7) > 0).alias("weekly_active"),
        (count_in(MASK_PREVIOUS_7) > 0).alias("weekly_active_previous_week"),
        (count_in(MASK_ANCHOR_DAY) > 0).alias("daily_active"),
    )


def dates_as_of(events: DataFrame, keys: Sequence[str], anchor: str | dt.date, require_user: bool = True,
                window_days: int | None = None) -> DataFrame:
    """The cumulated snapshot on ``anchor`` without building earlier days:
    per key, the set of active dates up to the anchor.  With ``window_days``
    only dates inside the last ``window_days`` days are collected -- all a
    bitmap needs -- so the set shipped per key stays bounded; every key ever
    active is still present (with an empty set when idle in the window), as
    in the cumulative table."""
    a = F.to_date(F.lit(str(anchor)))
    ev = events.filter(F.col("event_date") <= a)
    if require_user:
        ev = ev.filter(F.col("user_id").isNotNull())
    d = F.col("event_date")
    if window_days is not None:
        d = F.when(d >= F.date_sub(a, window_days - 1), d)
    return ev.groupBy(*keys).agg(F.array_sort(F.collect_set(d)).alias("dates_active"))
