"""Registered queries: batch twins of the streaming jobs (C46-C48).  The
streaming runs themselves (watermark, late data, checkpoints) are tested in
tests/test_streaming.py."""

from __future__ import annotations

from dimweave.plans.oracle_views import with_views
from dimweave.plans.registry import register
from dimweave.sources import adapters as A
from dimweave.streaming.ingest import ingest_enriched
from dimweave.streaming.windows import session_stats, sessionize, tumbling_hits

TUMBLING_SQL = with_views(
    ["web_events"],
    """SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, host, COUNT(host) AS num_hits
       FROM web_events GROUP BY 1, 2""",
)
TUMBLING_REF_SQL = with_views(
    ["web_events"],
    """SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, host, referrer,
              COUNT(host) AS num_hits
       FROM web_events GROUP BY 1, 2, 3""",
)


def _sessions_ctes(gap: int):
    return [
        (
            "lagged",
            """SELECT ip, host, event_time, event_id,
                      LAG(event_time) OVER (PARTITION BY ip, host ORDER BY event_time, event_id) AS prev
               FROM web_events""",
        ),
        (
            "numbered",
            f"""SELECT *, SUM(CASE WHEN prev IS NULL OR event_time > prev + INTERVAL {gap} SECOND THEN 1 ELSE 0 END)
                          OVER (PARTITION BY ip, host ORDER BY event_time, event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
                FROM lagged""",
        ),
        (
            "sessions",
            f"""SELECT ip, host, MIN(event_time) AS session_start,
                       MAX(event_time) + INTERVAL {gap} SECOND AS session_end, COUNT(*) AS n
                FROM numbered GROUP BY ip, host, sid""",
        ),
    ]


def _sessions_sql(gap: int) -> str:
    return with_views(["web_events"], "SELECT * FROM sessions", _sessions_ctes(gap))


def _stats_sql(gap: int) -> str:
    return with_views(
        ["web_events"],
        "SELECT host, AVG(n) AS avg_events, COUNT(*) AS n_sessions FROM sessions GROUP BY host",
        _sessions_ctes(gap),
    )


INGEST_SQL = with_views(
    ["web_events", "geo_ranges"],
    """SELECT e.ip, e.event_time AS event_timestamp, e.referrer, e.host, e.url,
              CASE WHEN g.ip_lo IS NULL THEN '{}'
                   ELSE CAST(json_object('country', g.country, 'state', g.state, 'city', g.city) AS VARCHAR)
              END AS geodata
       FROM web_events e LEFT JOIN geo_ranges g ON e.ip_num BETWEEN g.ip_lo AND g.ip_hi""",
)


@register("tumbling_hits", TUMBLING_SQL)
def q_tumbling_hits(t):
    """5-minute tumbling hit counts per host (batch twin)."""
    return tumbling_hits(A.web_events(t), ["host"])


@register("tumbling_hits_referrer", TUMBLING_REF_SQL)
def q_tumbling_hits_referrer(t):
    """5-minute tumbling hit counts per host and referrer."""
    return tumbling_hits(A.web_events(t), ["host", "referrer"])


@register("sessions", _sessions_sql(300))
def q_sessions(t):
    """Sessions per (ip, host) with a 5-minute gap."""
    return sessionize(A.web_events(t), ["ip", "host"], 300)


@register("sessions_6h", _sessions_sql(21600))
def q_sessions_6h(t):
    """Sessions with a 6-hour gap (5-minute sessions are nearly all
    single events on this data)."""
    return sessionize(A.web_events(t), ["ip", "host"], 21600)


@register("session_stats", _stats_sql(300))
def q_session_stats(t):
    """Average events per session by host, 5-minute gap."""
    return session_stats(sessionize(A.web_events(t), ["ip", "host"], 300), ["host"])


@register("session_stats_6h", _stats_sql(21600))
def q_session_stats_6h(t):
    """C47/T6 with a 6-hour gap."""
    return session_stats(sessionize(A.web_events(t), ["ip", "host"], 21600), ["host"])


@register("ingest_enriched", INGEST_SQL)
def q_ingest_enriched(t):
    """Events with geodata from the IP range table (batch twin)."""
    return ingest_enriched(A.web_events(t), A.geo_ranges(t))
