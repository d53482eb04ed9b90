"""Registered queries: experiments, KPI tables, quality report, upsert,
layout report (C43, C49-C52, S8)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.operators.behaviour import events_with_devices
from dimweave.operators.experiment import assign_cells, experiment_readout
from dimweave.operators.growth import growth_accounting_history
from dimweave.operators.kpis import engagement_daily, growth_daily, growth_total, profit_total, profit_unit
from dimweave.operators.layout import layout_report
from dimweave.operators.quality import checked_rows, quality_report, violation_counts
from dimweave.plans.oracle_views import with_views
from dimweave.plans.q_growth import _ga_ctes
from dimweave.plans.registry import last_day, register
from dimweave.sources import adapters as A
from dimweave.sources.io import upsert

EXPERIMENT = "signup_flow_v1"

_ASSIGN = (
    "assigned",
    f"""SELECT user_id, '{EXPERIMENT}' AS experiment,
               CASE WHEN CAST('0x' || substr(md5('{EXPERIMENT}' || '.' || CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT)
                         % 100 < 50 THEN 'control' ELSE 'test' END AS cell
        FROM (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL)""",
)

ASSIGN_SQL = with_views(["web_events"], "SELECT * FROM assigned", [_ASSIGN])

READOUT_SQL = with_views(
    ["web_events"],
    """SELECT p.experiment, p.cell, p.users, p.exposed, p.converted, p.rate,
              p.rate / NULLIF(c.rate, 0) - 1.0 AS lift,
              (p.rate - c.rate) / NULLIF(sqrt((CAST(p.converted + c.converted AS DOUBLE) / (p.exposed + c.exposed))
                                       * (1.0 - (CAST(p.converted + c.converted AS DOUBLE) / (p.exposed + c.exposed)))
                                       * (1.0 / p.exposed + 1.0 / c.exposed)), 0) AS z
       FROM per_cell p LEFT JOIN (SELECT * FROM per_cell WHERE cell = 'control') c
         ON p.experiment = c.experiment""",
    [
        _ASSIGN,
        ("exp", "SELECT user_id, MIN(event_time) AS t_exp FROM web_events WHERE url = 'signup' GROUP BY user_id"),
        (
            "conv",
            """SELECT DISTINCT o.user_id FROM web_events o JOIN exp ON o.user_id = exp.user_id
               WHERE o.url = 'purchase' AND o.event_time >= exp.t_exp
                 AND o.event_time <= exp.t_exp + INTERVAL 24 HOUR""",
        ),
        (
            "per_cell",
            """SELECT a.experiment, a.cell, COUNT(*) AS users, COUNT(exp.t_exp) AS exposed,
                      COUNT(CASE WHEN exp.t_exp IS NOT NULL AND conv.user_id IS NOT NULL THEN 1 END) AS converted,
                      CAST(COUNT(CASE WHEN exp.t_exp IS NOT NULL AND conv.user_id IS NOT NULL THEN 1 END) AS DOUBLE)
                        / COUNT(exp.t_exp) AS rate
               FROM assigned a LEFT JOIN exp ON a.user_id = exp.user_id
               LEFT JOIN conv ON a.user_id = conv.user_id
               GROUP BY a.experiment, a.cell""",
        ),
    ],
)

_UNIT = (
    "unit",
    """SELECT l.l_orderkey AS order_key, CAST(o.o_orderdate AS DATE) AS order_date,
              CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))))
                   AS DECIMAL(18,2)) AS revenue,
              CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2))
                       * CAST('0.75' AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS cost,
              CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))))
                   - SUM(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2))
                         * CAST('0.75' AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS profit
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
       GROUP BY l.l_orderkey, CAST(o.o_orderdate AS DATE)""",
)
PROFIT_UNIT_SQL = with_views([], "SELECT * FROM unit", [_UNIT])
PROFIT_TOTAL_SQL = with_views(
    [],
    """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS orders,
              CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue, CAST(SUM(profit) AS DECIMAL(18,2)) AS profit
       FROM unit GROUP BY 1""",
    [_UNIT],
)

GROWTH_DAILY_SQL = with_views(
    ["web_events"],
    """SELECT date, COUNT(CASE WHEN daily_active_state = 'New' THEN 1 END) AS new,
              COUNT(CASE WHEN daily_active_state = 'Retained' THEN 1 END) AS retained,
              COUNT(CASE WHEN daily_active_state = 'Resurrected' THEN 1 END) AS resurrected,
              COUNT(CASE WHEN daily_active_state = 'Churned' THEN 1 END) AS churned,
              COUNT(CASE WHEN daily_active_state = 'Stale' THEN 1 END) AS stale,
              COUNT(CASE WHEN daily_active_state IN ('New', 'Retained', 'Resurrected') THEN 1 END) AS active_users
       FROM ga GROUP BY date""",
    _ga_ctes("web_events"),
)
GROWTH_TOTAL_SQL = with_views(
    ["web_events"],
    """SELECT CAST(date_trunc('month', date) AS DATE) AS month,
              COUNT(CASE WHEN daily_active_state = 'New' THEN 1 END) AS new_users,
              COUNT(DISTINCT CASE WHEN daily_active_state IN ('New', 'Retained', 'Resurrected') THEN user_id END)
                  AS active_users
       FROM ga GROUP BY 1""",
    _ga_ctes("web_events"),
)
ENGAGEMENT_SQL = with_views(
    ["web_events"],
    """SELECT event_date, COUNT(DISTINCT user_id) AS active_users, COUNT(*) AS events,
              CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT user_id) AS events_per_user
       FROM web_events WHERE user_id IS NOT NULL GROUP BY event_date""",
)

QUALITY_LINEITEM_SQL = """
SELECT 'duplicate_key:l_orderkey,l_linenumber' AS "check",
       (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)) AS n_bad
UNION ALL SELECT 'null:l_partkey', COUNT(CASE WHEN l_partkey IS NULL THEN 1 END) FROM lineitem
UNION ALL SELECT 'null:l_suppkey', COUNT(CASE WHEN l_suppkey IS NULL THEN 1 END) FROM lineitem
UNION ALL SELECT 'null:l_shipdate', COUNT(CASE WHEN l_shipdate IS NULL THEN 1 END) FROM lineitem
"""

FRESH_DAY = "2024-01-30"
QUALITY_EVENTS_SQL = with_views(
    ["web_events"],
    f"""SELECT 'duplicate_key:event_id' AS "check",
               (SELECT COUNT(*) FROM (SELECT 1 FROM web_events GROUP BY event_id HAVING COUNT(*) > 1)) AS n_bad
        UNION ALL SELECT 'null:user_id', COUNT(CASE WHEN user_id IS NULL THEN 1 END) FROM web_events
        UNION ALL SELECT 'null:referrer', COUNT(CASE WHEN referrer IS NULL THEN 1 END) FROM web_events
        UNION ALL SELECT 'stale_partition:event_date',
                         CASE WHEN COUNT(CASE WHEN event_date = DATE '{FRESH_DAY}' THEN 1 END) = 0 THEN 1 ELSE 0 END
                  FROM web_events""",
)

UPSERT_SQL = with_views(
    ["web_events"],
    """SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.user_id = t.user_id
                                                  AND d.event_date = t.event_date)
       UNION ALL SELECT * FROM delta""",
    [
        (
            "target",
            "SELECT user_id, event_date, COUNT(*) AS hits FROM web_events GROUP BY user_id, event_date",
        ),
        (
            "delta",
            """SELECT user_id, event_date, COUNT(DISTINCT url) AS hits FROM web_events
               WHERE event_date > (SELECT MAX(event_date) FROM web_events) - 7
               GROUP BY user_id, event_date""",
        ),
    ],
)


def _users(t):
    return A.web_events(t).filter(F.col("user_id").isNotNull()).select("user_id").distinct()


@register("assign_cells", ASSIGN_SQL)
def q_assign_cells(t):
    """Deterministic 50/50 assignment of every user."""
    return assign_cells(_users(t), EXPERIMENT)


@register("experiment_readout", READOUT_SQL)
def q_experiment_readout(t):
    """exposure = signup, outcome = purchase within 24 h after the first
    exposure."""
    ev = A.web_events(t)
    return experiment_readout(
        assign_cells(_users(t), EXPERIMENT), ev.filter(F.col("url") == "signup"), ev.filter(F.col("url") == "purchase")
    )


@register("profit_unit", PROFIT_UNIT_SQL)
def q_profit_unit(t):
    """Unit-level profit per order."""
    return profit_unit(A.order_profit_inputs(t))


@register("profit_total", PROFIT_TOTAL_SQL)
def q_profit_total(t):
    """Monthly profit aggregate."""
    return profit_total(profit_unit(A.order_profit_inputs(t)))


@register("growth_daily", GROWTH_DAILY_SQL)
def q_growth_daily(t):
    """Daily growth (users per lifecycle state)."""
    ev = A.web_events(t)
    return growth_daily(growth_accounting_history(ev, last_day(t, "user_id"), with_dates=False))


@register("growth_total", GROWTH_TOTAL_SQL)
def q_growth_total(t):
    """Monthly growth aggregate."""
    ev = A.web_events(t)
    return growth_total(growth_accounting_history(ev, last_day(t, "user_id"), with_dates=False))


@register("engagement_daily", ENGAGEMENT_SQL)
def q_engagement_daily(t):
    """Daily engagement."""
    return engagement_daily(A.web_events(t))


@register("quality_report", QUALITY_LINEITEM_SQL)
def q_quality_report(t):
    """Key uniqueness and null checks on lineitem."""
    return quality_report(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"])


@register("quality_events", QUALITY_EVENTS_SQL)
def q_quality_events(t):
    """Key, null and freshness checks on the web events."""
    return quality_report(A.web_events(t), ["event_id"], ["user_id", "referrer"], "event_date", FRESH_DAY)


@register("events_upsert", UPSERT_SQL)
def q_events_upsert(t):
    """Hit counts of all user-days; the last week's are counted anew as
    distinct pages and win on (user, day)."""
    ev = A.web_events(t)
    target = ev.groupBy("user_id", "event_date").agg(F.count(F.lit(1)).alias("hits"))
    last = ev.agg(F.max("event_date")).scalar()
    delta = (
        ev.filter(F.col("event_date") > F.date_sub(last, 7))
        .groupBy("user_id", "event_date")
        .agg(F.countDistinct("url").alias("hits"))
    )
    return upsert(target, delta, ["user_id", "event_date"])


LAYOUT_SQL = with_views(
    ["web_events", "devices"],
    """SELECT variant, COUNT(*) AS n_rows FROM web_events e JOIN devices d ON e.device_id = d.device_id,
              (VALUES ('unsorted'), ('date_host'), ('date_browser_host')) v(variant) GROUP BY variant""",
)


def _layouts(t):
    df = events_with_devices(A.web_events(t), A.devices(t))
    variants = {"unsorted": [], "date_host": ["event_date", "host"], "date_browser_host": ["event_date", "browser_type", "host"]}
    return layout_report(df, variants, partition_by=["event_date"])


@register("layout_report", LAYOUT_SQL)
def q_layout_report(t):
    """The enriched events written unsorted and with two
    sort-within-partition orders; the variants and their stored rows."""
    return _layouts(t).select("variant", "n_rows")


@register("layout_sizes")
def q_layout_sizes(t):
    """The same with files and bytes of each variant (which have no
    SQL; a test compares them with the file system)."""
    return _layouts(t)


#: What the web events promise.  Devices are numbers below 45 here, so that
#: every kind of violation occurs.
EVENT_CONTRACT = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("referrer", T.StringType(), False),
        T.StructField("host", T.IntegerType()),
        T.StructField("device_id", T.IntegerType(), False),
    ]
)
DEVICE_LIMIT = 45


def _checked_events(t):
    # the host is read as the number behind its letter; h2 is stored as text
    host = F.when(F.col("host") != "h2", F.substring("host", 2, 9)).otherwise(F.col("host"))
    raw = A.web_events(t).select("event_id", "user_id", "referrer", host.alias("host"), "device_id")
    return checked_rows(raw, EVENT_CONTRACT, {"device_id:known": F.col("device_id") < DEVICE_LIMIT})


_CHECKED = (
    "checked",
    f"""SELECT event_id, user_id, referrer, TRY_CAST(CASE WHEN host <> 'h2' THEN substr(host, 2) ELSE host END AS INTEGER) AS host,
               CAST(device_id AS INTEGER) AS device_id,
               array_to_string(list_filter([CASE WHEN user_id IS NULL THEN 'user_id:null' END,
                   CASE WHEN referrer IS NULL THEN 'referrer:null' END,
                   CASE WHEN host = 'h2' THEN 'host:type' END,
                   CASE WHEN device_id IS NULL THEN 'device_id:null' END,
                   CASE WHEN device_id >= {DEVICE_LIMIT} THEN 'device_id:known' END], lambda x: x IS NOT NULL), ',') AS violations
        FROM web_events""",
)


@register("events_checked", with_views(["web_events"], "SELECT * FROM checked", [_CHECKED]))
def q_events_checked(t):
    """The web events under their contract: every row typed, with what it
    violates (nothing: a valid row; else one for the quarantine)."""
    return _checked_events(t).withColumn("violations", F.array_join("violations", ","))


@register(
    "events_violations",
    with_views(
        ["web_events"],
        """SELECT rule, COUNT(*) AS n
           FROM (SELECT unnest(string_split(CASE WHEN violations = '' THEN 'valid' ELSE violations END, ',')) AS rule FROM checked)
           GROUP BY rule""",
        [_CHECKED],
    ),
)
def q_events_violations(t):
    """Rows by violated rule, and the valid ones, in one pass."""
    return violation_counts(_checked_events(t))
