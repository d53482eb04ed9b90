"""Registered queries: histories bounded in their middle, one increment on the
snapshot before it for every step operator, and an SCD step with an entity
missing from the new snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dimweave.functions.columns import array_text
from dimweave.operators.cumulative import (
    actors_history,
    cumulate_history,
    dates_active_history,
    dates_active_step,
    device_datelist_as_map,
    device_datelist_history,
    device_datelist_step,
    host_datelist_history,
    host_datelist_init,
    host_datelist_step,
)
from dimweave.operators.growth import growth_accounting_history, growth_accounting_step
from dimweave.operators.scd import scd2_history, scd2_step
from dimweave.plans.oracle_views import with_views
from dimweave.plans.q_arrays import MONTH_ARRAY_SQL, _metric_rows, _user_months
from dimweave.plans.q_cumulative import (
    ACTOR_COLS,
    ACTORS_CTES,
    DEVICE_EVENTS,
    PLAYER_COLS,
    PLAYERS_CTES,
    _actors_flat,
    _datelist_ctes,
    _players_flat,
)
from dimweave.plans.q_growth import _ga_ctes, _ga_flat
from dimweave.plans.registry import last_day, last_season, register
from dimweave.sources import adapters as A
from dimweave.sources.snapshots import SnapshotTable

# Bounds inside the data: entities whose first period is later must not show.
MID_SEASON = 1997
MID_DAY = dt.date(2024, 1, 9)


def _cut(name: str, source: str, column: str, bound: str) -> tuple[str, str]:
    return name, f"SELECT * FROM {source} WHERE {column} <= {bound}"


def _over(ctes, source: str, name: str):
    """The same expressions over another source."""
    return [(n, sql.replace(source, name)) for n, sql in ctes]


_SEASONS = _cut("early_seasons", "player_seasons", "season", str(MID_SEASON))
_FILMS = _cut("early_films", "actor_films", "year", str(MID_SEASON))
_EVENTS = _cut("early_events", "web_events", "event_date", f"DATE '{MID_DAY}'")
_DEV_EVENTS = ("early_dev_events", "SELECT e.*, d.browser_type FROM early_events e JOIN devices d ON e.device_id = d.device_id")


@register(
    "players_history_until",
    with_views(["player_seasons"], f"SELECT {PLAYER_COLS} FROM players_hist", [_SEASONS, *_over(PLAYERS_CTES, "player_seasons", "early_seasons")]),
)
def q_players_history_until(t):
    """C2 up to a season in the middle."""
    return _players_flat(cumulate_history(A.player_seasons(t), MID_SEASON))


@register(
    "actors_history_until",
    with_views(["actor_films"], f"SELECT {ACTOR_COLS} FROM actors_hist", [_FILMS, *_over(ACTORS_CTES, "actor_films", "early_films")]),
)
def q_actors_history_until(t):
    """C10 up to a year in the middle."""
    return _actors_flat(actors_history(A.actor_films(t), MID_SEASON))


@register(
    "dates_active_until",
    with_views(
        ["web_events"],
        "SELECT user_id, lst AS dates_active, sdate AS date FROM lists",
        [_EVENTS, *_datelist_ctes("early_events", "user_id", "ASC")],
    ),
)
def q_dates_active_until(t):
    """C18 up to a day in the middle."""
    return dates_active_history(A.web_events(t), MID_DAY).withColumn("dates_active", array_text("dates_active"))


@register(
    "device_datelist_until",
    with_views(
        ["web_events", "devices"],
        "SELECT user_id, browser_type, lst AS device_activity_datelist, sdate AS record_date FROM lists",
        [_EVENTS, _DEV_EVENTS, *_datelist_ctes("early_dev_events", "user_id, browser_type", "DESC")],
    ),
)
def q_device_datelist_until(t):
    """C19 up to a day in the middle."""
    out = device_datelist_history(A.web_events(t), A.devices(t), MID_DAY)
    return out.withColumn("device_activity_datelist", array_text("device_activity_datelist"))


@register(
    "host_datelist_until",
    with_views(
        ["web_events"],
        "SELECT host, lst AS host_activity_datelist, sdate AS record_date FROM lists",
        [_EVENTS, *_datelist_ctes("early_events", "host", "DESC", user_filter=False)],
    ),
)
def q_host_datelist_until(t):
    """C22 up to a day in the middle."""
    out = host_datelist_history(A.web_events(t), MID_DAY)
    return out.withColumn("host_activity_datelist", array_text("host_activity_datelist"))


@register(
    "growth_accounting_until",
    with_views(["web_events"], "SELECT * FROM ga", [_EVENTS, *_ga_ctes("early_events")]),
)
def q_growth_accounting_until(t):
    """C31 up to a day in the middle."""
    return _ga_flat(growth_accounting_history(A.web_events(t), MID_DAY))


@register("month_array_until", MONTH_ARRAY_SQL.replace("FROM web_events WHERE user_id IS NOT NULL", f"FROM web_events WHERE user_id IS NOT NULL AND event_date <= DATE '{MID_DAY}'"))
def q_month_array_until(t):
    """C26 up to a day in the middle of a month."""
    out = _metric_rows(_user_months(A.web_events(t), upto=MID_DAY))
    return out.withColumn("metric_array", array_text("metric_array"))


# -- one increment on the stored snapshot of the period before ------------------
# The state that the jobs before would have left is stored first; the step then
# reads that partition and one period of facts, and stores its own.


def _day_before(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=1)


@register(
    "dates_active_step",
    with_views(
        ["web_events"],
        "SELECT user_id, lst AS dates_active, sdate AS date FROM lists, upto WHERE sdate = upto.u",
        _datelist_ctes("web_events", "user_id", "ASC"),
    ),
)
def q_dates_active_step(t):
    """C17: the last day as one increment."""
    ev, day = A.web_events(t), last_day(t, "user_id")
    table = SnapshotTable.scratch(t.spark, "users_cumulated", "user_id", "date")
    table.write(dates_active_history(ev, _day_before(day), periods=[_day_before(day)]), _day_before(day))
    out = table.advance(lambda prev: dates_active_step(prev, ev, day), _day_before(day), day)
    return out.withColumn("dates_active", array_text("dates_active"))


_DEVICE_LAST = "FROM lists, upto WHERE sdate = upto.u"
_DEVICE_LISTS = [DEVICE_EVENTS, *_datelist_ctes("dev_events", "user_id, browser_type", "DESC")]


def _device_step(t):
    ev, devices, day = A.web_events(t), A.devices(t), last_day(t, "user_id")
    table = SnapshotTable.scratch(t.spark, "user_devices_cumulated", "user_id", "record_date")
    table.write(device_datelist_history(ev, devices, _day_before(day), periods=[_day_before(day)]), _day_before(day))
    return table.advance(lambda prev: device_datelist_step(prev, ev, devices, day), _day_before(day), day)


@register(
    "device_datelist_step",
    with_views(
        ["web_events", "devices"],
        f"SELECT user_id, browser_type, lst AS device_activity_datelist, sdate AS record_date {_DEVICE_LAST}",
        _DEVICE_LISTS,
    ),
)
def q_device_datelist_step(t):
    """The last day as one increment."""
    return _device_step(t).withColumn("device_activity_datelist", array_text("device_activity_datelist"))


@register(
    "device_datelist_map",
    with_views(
        ["web_events", "devices"],
        f"""SELECT user_id, sdate AS record_date,
                   string_agg(browser_type || '=' || lst, ';' ORDER BY browser_type) AS device_activity_datelist
            {_DEVICE_LAST} GROUP BY user_id, sdate""",
        _DEVICE_LISTS,
    ),
)
def q_device_datelist_map(t):
    """C19 as one map from browser to dates per user, on the last day."""
    entries = F.array_sort(F.map_entries("device_activity_datelist"))
    as_text = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(F.transform(e["value"], lambda d: d.cast("string")), ",")))
    return device_datelist_as_map(_device_step(t)).withColumn("device_activity_datelist", F.array_join(as_text, ";"))


def _host_lists(day: str):
    return with_views(
        ["web_events"],
        f"SELECT host, lst AS host_activity_datelist, sdate AS record_date FROM lists WHERE sdate = {day}",
        _datelist_ctes("web_events", "host", "DESC", user_filter=False),
    )


@register("host_datelist_step", _host_lists("(SELECT u FROM upto)"))
def q_host_datelist_step(t):
    """The last day as one increment."""
    ev, day = A.web_events(t), last_day(t)
    table = SnapshotTable.scratch(t.spark, "hosts_cumulated", "host", "record_date")
    table.write(host_datelist_history(ev, _day_before(day), periods=[_day_before(day)]), _day_before(day))
    out = table.advance(lambda prev: host_datelist_step(prev, ev, day), _day_before(day), day)
    return out.withColumn("host_activity_datelist", array_text("host_activity_datelist"))


@register("host_datelist_init", _host_lists("(SELECT MIN(d) FROM daily)"))
def q_host_datelist_init(t):
    """The first day's snapshot."""
    ev = A.web_events(t)
    first = t.events.agg(F.to_date(F.min("ts"))).first()[0]
    return host_datelist_init(ev, first).withColumn("host_activity_datelist", array_text("host_activity_datelist"))


@register(
    "growth_accounting_step",
    with_views(["web_events"], "SELECT ga.* FROM ga, upto WHERE date = upto.u", _ga_ctes("web_events")),
)
def q_growth_accounting_step(t):
    """The last day as one increment."""
    ev, day = A.web_events(t), last_day(t, "user_id")
    table = SnapshotTable.scratch(t.spark, "users_growth_accounting", "user_id", "date")
    table.write(growth_accounting_history(ev, _day_before(day), periods=[_day_before(day)]), _day_before(day))
    return _ga_flat(table.advance(lambda prev: growth_accounting_step(prev, ev, day), _day_before(day), day))


@register(
    "scd_step_absent",
    with_views(
        ["player_seasons"],
        """SELECT player_name, scoring_class, MIN(current_season) AS start_period, MAX(current_season) AS end_period,
                  CAST((SELECT last_s FROM ps_last) AS INTEGER) AS as_of
           FROM (SELECT *, COUNT(*) FILTER (WHERE changed) OVER (PARTITION BY player_name ORDER BY current_season) AS run
                 FROM (SELECT player_name, scoring_class, current_season,
                              scoring_class IS DISTINCT FROM LAG(scoring_class) OVER (PARTITION BY player_name ORDER BY current_season) AS changed
                       FROM players_hist, ps_last WHERE is_active OR current_season < last_s))
           GROUP BY player_name, scoring_class, run""",
        PLAYERS_CTES,
    ),
)
def q_scd_step_absent(t):
    """A snapshot without the players who don't play in it; their runs
    stay as they were."""
    last = last_season(t)
    seasons = A.player_seasons(t)
    table = SnapshotTable.scratch(t.spark, "players_scd", "player_name", "as_of")
    table.write(scd2_history(cumulate_history(seasons, last - 1), "player_name", "current_season", ["scoring_class"], upto=last - 1), last - 1)
    present = cumulate_history(seasons, last, periods=[last]).filter(F.col("is_active"))
    return table.advance(lambda scd: scd2_step(scd, present, "player_name", "current_season", ["scoring_class"], last), last - 1, last)
