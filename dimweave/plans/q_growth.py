"""Registered queries: growth accounting, retention, state changes."""

from __future__ import annotations

from dimweave.functions.columns import array_text
from dimweave.operators.cumulative import cumulate_history
from dimweave.operators.growth import growth_accounting_history, retention, state_changes
from dimweave.plans.oracle_views import with_views
from dimweave.plans.registry import last_day, last_season, register
from dimweave.sources import adapters as A

# -- oracle SQL --------------------------------------------------------------

_GA_CTES = [
    ("daily", "SELECT DISTINCT user_id, event_date AS d FROM {src} WHERE user_id IS NOT NULL"),
    ("firsts", "SELECT user_id, MIN(d) AS first_d FROM daily GROUP BY user_id"),
    ("upto", "SELECT MAX(d) AS u FROM daily"),
    (
        "spine",
        """SELECT f.user_id, f.first_d, CAST(g.day AS DATE) AS date
           FROM firsts f, upto, unnest(generate_series(f.first_d, upto.u, INTERVAL 1 DAY)) AS g(day)""",
    ),
    (
        "flagged",
        """SELECT s.user_id, s.first_d, s.date, (dl.d IS NOT NULL) AS a
           FROM spine s LEFT JOIN daily dl ON dl.user_id = s.user_id AND dl.d = s.date""",
    ),
    (
        "lagged",
        """SELECT *, MAX(CASE WHEN a THEN date END) OVER (PARTITION BY user_id ORDER BY date
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM flagged""",
    ),
    (
        "ga",
        """SELECT user_id, first_d AS first_active_date,
                  CASE WHEN a THEN date ELSE l END AS last_active_date,
                  CASE WHEN date = first_d THEN 'New'
                       WHEN a AND l = date - 1 THEN 'Retained'
                       WHEN a AND l < date - 1 THEN 'Resurrected'
                       WHEN NOT a AND l = date - 1 THEN 'Churned'
                       ELSE 'Stale' END AS daily_active_state,
                  CASE WHEN date = first_d THEN 'New'
                       WHEN a AND l < date - 7 THEN 'Resurrected'
                       WHEN NOT a AND l = date - 8 THEN 'Churned'
                       WHEN (CASE WHEN a THEN date ELSE l END) + 7 >= date - 1 THEN 'Retained'
                       ELSE 'Stale' END AS weekly_active_state,
                  (SELECT array_to_string(list(x.d ORDER BY x.d), ',') FROM daily x
                    WHERE x.user_id = lagged.user_id AND x.d <= lagged.date) AS dates_active,
                  date
           FROM lagged""",
    ),
]


def _ga_ctes(src: str):
    return [(n, sql.replace("{src}", src)) for n, sql in _GA_CTES]


GA_SQL = with_views(["web_events"], "SELECT * FROM ga", _ga_ctes("web_events"))
GA_SPARSE_SQL = with_views(["sparse_events"], "SELECT * FROM ga", _ga_ctes("sparse_events"))

# A user is in an active state on exactly the days of activity, which are the
# rows whose last active day is the row's own.
RETENTION_SQL = with_views(
    ["web_events"],
    """SELECT CAST(date - first_active_date AS INTEGER) AS days_since_first_active,
              CAST(COUNT(*) FILTER (WHERE last_active_date = date) AS DOUBLE) / COUNT(*) AS pct_active,
              COUNT(*) AS n
       FROM ga GROUP BY 1""",
    _ga_ctes("web_events"),
)

STATE_CHANGES_SQL = with_views(
    ["player_seasons"],
    """SELECT player_name, current_season,
              CASE WHEN prev IS NULL THEN CASE WHEN is_active THEN 'New' ELSE 'Stayed Retired' END
                   WHEN prev AND is_active THEN 'Continued Playing'
                   WHEN prev AND NOT is_active THEN 'Retired'
                   WHEN NOT prev AND is_active THEN 'Returned from Retirement'
                   ELSE 'Stayed Retired' END AS state
       FROM (SELECT *, LAG(is_active) OVER (PARTITION BY player_name ORDER BY current_season) AS prev
             FROM players_hist)""",
    [
        ("firsts", "SELECT player_name, MIN(season) AS first_season FROM player_seasons GROUP BY player_name"),
        ("last_season", "SELECT MAX(season) AS last_s FROM player_seasons"),
        (
            "players_hist",
            """SELECT f.player_name, CAST(g.s AS INTEGER) AS current_season,
                      EXISTS (SELECT 1 FROM player_seasons ps WHERE ps.player_name = f.player_name
                              AND ps.season = g.s) AS is_active
               FROM firsts f, last_season, unnest(range(f.first_season, last_s + 1)) AS g(s)""",
        ),
    ],
)


# -- queries -----------------------------------------------------------------


def _ga_flat(ga):
    return ga.withColumn("dates_active", array_text("dates_active"))


@register("growth_accounting", GA_SQL)
def q_growth_accounting(t):
    """Daily/weekly lifecycle states for every user-day (closed form)."""
    ev = A.web_events(t)
    return _ga_flat(growth_accounting_history(ev, last_day(t, "user_id")))


@register("growth_accounting_sparse", GA_SPARSE_SQL)
def q_growth_accounting_sparse(t):
    """Same on the sparse event subset, which reaches every state."""
    ev = A.web_events(t, sparse=True)
    return _ga_flat(growth_accounting_history(ev, last_day(t, "user_id")))


@register("retention", RETENTION_SQL)
def q_retention(t):
    """J-curve over the growth-accounting table."""
    ev = A.web_events(t)
    return retention(growth_accounting_history(ev, last_day(t, "user_id"), with_dates=False))


@register("state_changes", STATE_CHANGES_SQL)
def q_state_changes(t):
    """Player lifecycle labels from the cumulative players table."""
    ps = A.player_seasons(t)
    players = cumulate_history(ps, last_season(t))
    return state_changes(players, "player_name", "current_season", "is_active")
