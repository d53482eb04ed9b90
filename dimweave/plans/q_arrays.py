"""Registered queries: reduced monthly array facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dimweave.functions.columns import array_text
from dimweave.operators.arrays import (
    array_day_sums,
    array_to_daily,
    host_activity_reduced_step,
    month_array_history,
    month_array_step,
    monthly_hits_step,
)
from dimweave.plans.oracle_views import with_views
from dimweave.plans.registry import last_day, register
from dimweave.sources import adapters as A


def _month_ctes(key: str, measures: dict[str, str], user_filter: bool = True):
    where = "WHERE user_id IS NOT NULL" if user_filter else ""
    ms = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    return [
        ("daily_m", f"SELECT {key}, event_date AS d, {ms} FROM web_events {where} GROUP BY {key}, event_date"),
        ("upto", "SELECT MAX(d) AS u FROM daily_m"),
        (
            "mkeys",
            f"""SELECT {key}, CAST(date_trunc('month', d) AS DATE) AS month_start, MIN(d) AS first_found_date
                FROM daily_m GROUP BY {key}, CAST(date_trunc('month', d) AS DATE)""",
        ),
        (
            "mdays",
            """SELECT k.*, CAST(g.day AS DATE) AS day, least(last_day(k.month_start), upto.u) AS date_partition
               FROM mkeys k, upto,
                    unnest(generate_series(k.month_start, least(last_day(k.month_start), upto.u), INTERVAL 1 DAY)) AS g(day)""",
        ),
    ]


def _arr_sql(name: str, fill: str) -> str:
    return f"string_agg(COALESCE(CAST(COALESCE(dm.{name}, {fill}) AS VARCHAR), 'null'), ',' ORDER BY k.day) AS {name}"


MONTH_ARRAY_SQL = with_views(
    ["web_events"],
    f"""SELECT k.user_id, k.month_start, 'site_hits' AS metric_name, {_arr_sql('n', '0').replace(' AS n', ' AS metric_array')}
        FROM mdays k LEFT JOIN daily_m dm ON dm.user_id = k.user_id AND dm.d = k.day
        GROUP BY k.user_id, k.month_start""",
    _month_ctes("user_id", {"n": "COUNT(*)"}),
)

MONTHLY_HITS_SQL = with_views(
    ["web_events"],
    f"""SELECT k.user_id, {_arr_sql('n', 'NULL').replace(' AS n', ' AS hit_array')}, k.month_start,
               k.first_found_date, k.date_partition
        FROM mdays k LEFT JOIN daily_m dm ON dm.user_id = k.user_id AND dm.d = k.day
        GROUP BY k.user_id, k.month_start, k.first_found_date, k.date_partition""",
    _month_ctes("user_id", {"n": "COUNT(*)"}),
)

HOST_REDUCED_SQL = with_views(
    ["web_events"],
    f"""SELECT k.month_start AS month, k.host, {_arr_sql('hits', '0').replace(' AS hits', ' AS hit_array')},
               {_arr_sql('visitors', '0').replace(' AS visitors', ' AS unique_visitors_array')}
        FROM mdays k LEFT JOIN daily_m dm ON dm.host = k.host AND dm.d = k.day
        GROUP BY k.month_start, k.host""",
    _month_ctes("host", {"hits": "COUNT(*)", "visitors": "COUNT(DISTINCT user_id)"}, user_filter=False),
)

DAY_SUMS_SQL = with_views(
    ["web_events"],
    """SELECT k.month_start,
              CAST(SUM(CASE WHEN k.day = k.month_start THEN COALESCE(dm.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_day_1,
              CAST(SUM(CASE WHEN k.day = k.month_start + 1 THEN COALESCE(dm.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_day_2,
              CAST(SUM(CASE WHEN k.day = k.month_start + 2 THEN COALESCE(dm.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_day_3
       FROM mdays k LEFT JOIN daily_m dm ON dm.user_id = k.user_id AND dm.d = k.day, upto
       WHERE k.date_partition = upto.u
       GROUP BY k.month_start""",
    _month_ctes("user_id", {"n": "COUNT(*)"}),
)

TO_DAILY_SQL = with_views(
    ["web_events"],
    """SELECT 'site_hits' AS metric_name, k.day AS date, CAST(SUM(COALESCE(dm.n, 0)) AS BIGINT) AS value
       FROM mdays k LEFT JOIN daily_m dm ON dm.user_id = k.user_id AND dm.d = k.day
       GROUP BY k.day""",
    _month_ctes("user_id", {"n": "COUNT(*)"}),
)


def _user_months(ev, upto=None, fill=0):
    return month_array_history(
        ev, ["user_id"], {"metric_array": F.count(F.lit(1))}, upto=upto, fill=fill,
        require=F.col("user_id").isNotNull(),
    )


def _metric_rows(hist):
    return hist.select("user_id", "month_start", F.lit("site_hits").alias("metric_name"), "metric_array")


@register("month_array", MONTH_ARRAY_SQL)
def q_month_array(t):
    """Zero-filled per-user monthly hit arrays, all months at once."""
    ev = A.web_events(t)
    out = _metric_rows(_user_months(ev, upto=last_day(t, "user_id")))
    return out.withColumn("metric_array", array_text("metric_array"))


@register("month_array_step", MONTH_ARRAY_SQL)
def q_month_array_step(t):
    """The last day loaded incrementally onto the state of the day
    before (equals the closed form)."""
    ev = A.web_events(t)
    day = last_day(t, "user_id")
    prev = _metric_rows(_user_months(ev, upto=day - dt.timedelta(days=1)))
    out = month_array_step(prev, ev, day)
    return out.withColumn("metric_array", array_text("metric_array"))


def _hits_rows(hist):
    return hist.select(
        "user_id", F.col("metric_array").alias("hit_array"), "month_start", "first_found_date", "date_partition"
    )


@register("monthly_hits", MONTHLY_HITS_SQL)
def q_monthly_hits(t):
    """C24 closed form: NULL-filled monthly hit arrays with first_found_date."""
    ev = A.web_events(t)
    out = _hits_rows(_user_months(ev, upto=last_day(t, "user_id"), fill=None))
    return out.withColumn("hit_array", array_text("hit_array"))


@register("monthly_hits_step", MONTHLY_HITS_SQL)
def q_monthly_hits_step(t):
    """One daily load onto the previous day's partition."""
    ev = A.web_events(t)
    day = last_day(t, "user_id")
    prev = _hits_rows(_user_months(ev, upto=day - dt.timedelta(days=1), fill=None))
    out = monthly_hits_step(prev, ev, day)
    return out.withColumn("hit_array", array_text("hit_array"))


def _host_months(ev, upto=None):
    hist = month_array_history(
        ev, ["host"],
        {"hit_array": F.count(F.lit(1)), "unique_visitors_array": F.countDistinct("user_id")},
        upto=upto,
    )
    return hist.select(F.col("month_start").alias("month"), "host", "hit_array", "unique_visitors_array")


def _host_flat(df):
    return df.withColumn("hit_array", array_text("hit_array")).withColumn(
        "unique_visitors_array", array_text("unique_visitors_array")
    )


@register("host_reduced", HOST_REDUCED_SQL)
def q_host_reduced(t):
    """C25 closed form: per host and month, daily hits and distinct visitors."""
    ev = A.web_events(t)
    return _host_flat(_host_months(ev, upto=last_day(t)))


@register("host_reduced_step", HOST_REDUCED_SQL)
def q_host_reduced_step(t):
    """The last day loaded onto the previous state."""
    ev = A.web_events(t)
    day = last_day(t)
    prev = _host_months(ev, upto=day - dt.timedelta(days=1))
    return _host_flat(host_activity_reduced_step(prev, ev, day))


@register("array_day_sums", DAY_SUMS_SQL)
def q_array_day_sums(t):
    """Sums of the first three days over the latest partition."""
    ev = A.web_events(t)
    day = last_day(t, "user_id")
    hits = _hits_rows(_user_months(ev, upto=day, fill=None))
    return array_day_sums(hits, day, 3)


@register("array_to_daily", TO_DAILY_SQL)
def q_array_to_daily(t):
    """Arrays summed by position and unpivoted to (metric, date, value)."""
    ev = A.web_events(t)
    return array_to_daily(_metric_rows(_user_months(ev, upto=last_day(t, "user_id"))))
