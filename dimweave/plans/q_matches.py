"""Registered queries: match analytics, shared-aggregate rollups, enrichment
(C42, C44, C45)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dimweave.operators.matches import (
    bucketed_matches,
    details_on_day,
    devices_on_events,
    enrich_events,
    events_aggregated,
    match_tops,
    rollups,
    users_and_devices,
)
from dimweave.plans.oracle_views import with_views
from dimweave.plans.registry import register
from dimweave.sources import adapters as A

MEDAL = "Brand#1"
MATCH_DAY = "1995-03-05"

MATCH_TOPS_SQL = with_views(
    ["matches", "match_details", "medals_matches_players", "medals", "maps"],
    f"""SELECT * FROM (SELECT 'player_avg_kills' AS metric, d.player_gamertag AS winner,
                              CAST(AVG(d.player_total_kills) AS DOUBLE) AS value
                       FROM match_details d JOIN matches m ON d.match_id = m.match_id
                       GROUP BY d.player_gamertag ORDER BY value DESC, winner ASC LIMIT 1)
        UNION ALL
        SELECT * FROM (SELECT 'top_playlist', m.playlist_id, CAST(COUNT(DISTINCT d.match_id) AS DOUBLE) AS value
                       FROM match_details d JOIN matches m ON d.match_id = m.match_id
                       GROUP BY m.playlist_id ORDER BY value DESC, m.playlist_id ASC LIMIT 1)
        UNION ALL
        SELECT * FROM (SELECT 'top_map', mp.name, CAST(COUNT(DISTINCT d.match_id) AS DOUBLE) AS value
                       FROM match_details d JOIN matches m ON d.match_id = m.match_id
                       JOIN maps mp ON m.mapid = mp.mapid
                       GROUP BY mp.name ORDER BY value DESC, mp.name ASC LIMIT 1)
        UNION ALL
        SELECT * FROM (SELECT 'top_map_for_medal:{MEDAL}', mp.name, CAST(SUM(mm.count) AS DOUBLE) AS value
                       FROM medals_matches_players mm JOIN medals md ON mm.medal_id = md.medal_id
                       JOIN matches m ON mm.match_id = m.match_id JOIN maps mp ON m.mapid = mp.mapid
                       WHERE md.name = '{MEDAL}'
                       GROUP BY mp.name ORDER BY value DESC, mp.name ASC LIMIT 1)""",
)

_AGG = (
    "agg",
    """SELECT user_id, device_id, COUNT(*) AS event_counts,
              array_to_string(list_sort(list(DISTINCT host)), ',') AS host_array
       FROM web_events WHERE user_id IS NOT NULL GROUP BY user_id, device_id""",
)

EVENTS_AGG_SQL = with_views(["web_events"], "SELECT * FROM agg", [_AGG])
USERS_DEVICES_SQL = with_views(
    ["web_events"],
    """SELECT user_id, MAX(event_counts) AS max_device_hits, CAST(SUM(event_counts) AS BIGINT) AS total_hits,
              COUNT(*) AS n_devices FROM agg GROUP BY user_id""",
    [_AGG],
)
DEVICES_ON_EVENTS_SQL = with_views(
    ["web_events", "devices"],
    """SELECT d.device_id, d.device_type, COUNT(*) AS n_users, CAST(SUM(a.event_counts) AS BIGINT) AS n_events
       FROM devices d JOIN agg a ON d.device_id = a.device_id GROUP BY d.device_id, d.device_type""",
    [_AGG],
)

ENRICH_SQL = with_views(
    ["web_events", "devices"],
    """SELECT e.user_id, e.device_id, upper(d.browser_type) AS browser_type, d.os_type, d.device_type,
              COALESCE(e.referrer, 'unknow') AS referrer, e.host, e.url, e.event_time
       FROM web_events e JOIN devices d ON e.device_id = d.device_id
       WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""",
)


ENRICH_LEFT_SQL = with_views(
    ["web_events", "devices"],
    """SELECT e.user_id, e.device_id, upper(d.browser_type) AS browser_family, d.os_type AS os_family,
              d.device_type, COALESCE(e.referrer, 'unknow') AS referrer, e.host, e.url, e.event_time
       FROM web_events e LEFT JOIN devices d ON e.device_id = d.device_id
       WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""",
)


@register("match_tops", MATCH_TOPS_SQL)
def q_match_tops(t):
    """Top player by average kills, top playlist, top map, top map for a
    medal, over the three match tables in buckets by match_id (16, or as many
    times 16 as their rows ask for)."""
    tables = bucketed_matches(A.match_details(t), A.matches(t), A.medals_matches_players(t))
    return match_tops(*tables, A.medals(t), A.maps(t), MEDAL)


@register(
    "match_details_on_day",
    with_views(
        ["matches", "match_details"],
        f"""SELECT d.*, m.playlist_id, m.mapid, m.completion_date
            FROM match_details d JOIN matches m ON d.match_id = m.match_id AND m.completion_date = TIMESTAMP '{MATCH_DAY} 00:00:00'""",
    ),
)
def q_match_details_on_day(t):
    """Bucketed join with the date in its ON clause."""
    details, matches, _ = bucketed_matches(A.match_details(t), A.matches(t), A.medals_matches_players(t))
    return details_on_day(details, matches, dt.datetime.fromisoformat(MATCH_DAY))


@register("events_aggregated", EVENTS_AGG_SQL)
def q_events_aggregated(t):
    """The shared (user, device) aggregate."""
    return events_aggregated(A.web_events(t)).withColumn("host_array", F.array_join("host_array", ","))


@register("cached_rollups", USERS_DEVICES_SQL)
def q_cached_rollups(t):
    """Per-user rollup off the aggregate."""
    return users_and_devices(events_aggregated(A.web_events(t)))


@register(
    "shared_rollups",
    with_views(
        ["web_events", "devices"],
        """SELECT 'user' AS kind, user_id AS id, NULL AS label, COUNT(*) AS n, CAST(SUM(event_counts) AS BIGINT) AS hits
           FROM agg GROUP BY user_id
           UNION ALL
           SELECT 'device', d.device_id, d.device_type, COUNT(*), CAST(SUM(a.event_counts) AS BIGINT)
           FROM devices d JOIN agg a ON d.device_id = a.device_id GROUP BY d.device_id, d.device_type""",
        [_AGG],
    ),
)
def q_shared_rollups(t):
    """Both rollups off one cached aggregate."""
    return rollups(A.web_events(t), A.devices(t))


@register("devices_on_events", DEVICES_ON_EVENTS_SQL)
def q_devices_on_events(t):
    """Per-device rollup off the aggregate."""
    return devices_on_events(A.devices(t), events_aggregated(A.web_events(t)))


@register("enrich_events", ENRICH_SQL)
def q_enrich_events(t):
    """Events with device attributes, inner join."""
    return enrich_events(A.web_events(t), A.devices(t))


@register("enrich_events_left", ENRICH_LEFT_SQL)
def q_enrich_events_left(t):
    """C45 left variant: events kept without a known device, browser and os
    renamed to *_family."""
    return enrich_events(A.web_events(t), A.devices(t), how="left")
