"""Registered queries: datelist bitmaps and activity flags."""

from __future__ import annotations

from dimweave.operators.datelist import activity_flags, datelist_int, dates_as_of
from dimweave.plans.oracle_views import with_views
from dimweave.plans.q_cumulative import DEVICE_EVENTS
from dimweave.plans.registry import last_day, register
from dimweave.sources import adapters as A



def _days(first: int, n: int) -> int:
    """Bits of n days from the first-th before the anchor day (bit 31) on."""
    return sum(1 << (31 - first - k) for k in range(n))


_USER_BITS = [
    ("daily", "SELECT DISTINCT user_id, event_date AS d FROM web_events WHERE user_id IS NOT NULL"),
    ("anchor", "SELECT MAX(d) AS a FROM daily"),
    (
        "bits",
        """SELECT user_id,
                  CAST(bit_or(CASE WHEN anchor.a - d BETWEEN 0 AND 31 THEN (CAST(1 AS BIGINT) << (31 - (anchor.a - d)))
                                   ELSE CAST(0 AS BIGINT) END) AS BIGINT) AS datelist_int,
                  anchor.a AS date
           FROM daily, anchor GROUP BY user_id, anchor.a""",
    ),
]

DATELIST_SQL = with_views(["web_events"], "SELECT * FROM bits", _USER_BITS)

FLAGS_SQL = with_views(
    ["web_events"],
    f"""SELECT user_id, CAST(bit_count(datelist_int) AS INTEGER) AS l32,
               bit_count(datelist_int) > 0 AS monthly_active,
               CAST(bit_count(datelist_int & {_days(0, 7)}) AS INTEGER) AS l7,
               bit_count(datelist_int & {_days(0, 7)}) > 0 AS weekly_active,
               bit_count(datelist_int & {_days(7, 7)}) > 0 AS weekly_active_previous_week,
               bit_count(datelist_int & {_days(0, 1)}) > 0 AS daily_active
        FROM bits""",
    _USER_BITS,
)

_DEVICE_BITS = [
    DEVICE_EVENTS,
    ("daily", "SELECT DISTINCT user_id, browser_type, event_date AS d FROM dev_events WHERE user_id IS NOT NULL"),
    ("anchor", "SELECT MAX(d) AS a FROM daily"),
]

DEVICE_DATELIST_SQL = with_views(
    ["web_events", "devices"],
    """SELECT user_id, CAST(bit_or(v) AS BIGINT) AS datelist_int, a AS date FROM (
         SELECT user_id, browser_type, anchor.a,
                bit_or(CASE WHEN anchor.a - d BETWEEN 0 AND 31 THEN (CAST(1 AS BIGINT) << (31 - (anchor.a - d)))
                            ELSE CAST(0 AS BIGINT) END) AS v
         FROM daily, anchor GROUP BY user_id, browser_type, anchor.a)
       GROUP BY user_id, a""",
    _DEVICE_BITS,
)

COMPAT_SQL = with_views(
    ["web_events", "devices"],
    """SELECT user_id, CAST(SUM(v) & 4294967295 AS BIGINT) AS datelist_int, a AS date FROM (
         SELECT user_id, browser_type, anchor.a,
                SUM(CASE WHEN anchor.a - d BETWEEN 0 AND 31 THEN (CAST(1 AS BIGINT) << (32 - (anchor.a - d)))
                         ELSE CAST(0 AS BIGINT) END) AS v
         FROM daily, anchor GROUP BY user_id, browser_type, anchor.a)
       GROUP BY user_id, a""",
    _DEVICE_BITS,
)


def _user_bits(t):
    ev = A.web_events(t)
    anchor = last_day(t, "user_id")
    snap = dates_as_of(ev, ["user_id"], anchor, window_days=32)
    return datelist_int(snap, ["user_id"], "dates_active", anchor)


@register("datelist_int", DATELIST_SQL)
def q_datelist_int(t):
    """C20: 32-day activity bitmap per user on the last day."""
    return _user_bits(t)


@register("activity_flags", FLAGS_SQL)
def q_activity_flags(t):
    """Monthly / weekly / previous-week / daily flags from the bitmap."""
    return activity_flags(_user_bits(t), ["user_id"])


def _device_bits(t, compat: bool):
    ev = A.web_events(t).join(A.devices(t).select("device_id", "browser_type"), "device_id")
    anchor = last_day(t, "user_id")
    snap = dates_as_of(ev, ["user_id", "browser_type"], anchor, window_days=32)
    return datelist_int(
        snap, ["user_id", "browser_type"], "dates_active", anchor, compat=compat, group_by=["user_id"]
    )


@register("device_datelist_int", DEVICE_DATELIST_SQL)
def q_device_datelist_int(t):
    """C20 over the per-browser datelist, merged per user with bit_or."""
    return _device_bits(t, compat=False)


@register("datelist_int_compat", COMPAT_SQL)
def q_datelist_int_compat(t):
    """C20 in the reference's exact arithmetic (2^(32-d), summed, low 32 bits)."""
    return _device_bits(t, compat=True)
