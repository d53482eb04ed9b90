"""Registered queries: SCD type 2 backfill and increment."""

from __future__ import annotations


from dimweave.operators.cumulative import actors_history, cumulate_history
from dimweave.operators.scd import scd2_history, scd2_step
from dimweave.plans.oracle_views import with_views
from dimweave.plans.q_cumulative import ACTORS_CTES, PLAYERS_CTES
from dimweave.plans.registry import last_film_year, last_season, register
from dimweave.sources import adapters as A
from dimweave.sources.snapshots import SnapshotTable


def scd_sql(src: str, key: str, period: str, attrs: list[str]) -> str:
    lag_cmp = " OR ".join(
        f"(LAG({a}) OVER w IS DISTINCT FROM {a})" for a in attrs
    )
    attr_list = ", ".join(attrs)
    return f"""SELECT {key}, {attr_list}, MIN({period}) AS start_period, MAX({period}) AS end_period,
                      CAST((SELECT MAX({period}) FROM {src}) AS INTEGER) AS as_of
               FROM (SELECT *, SUM(chg) OVER (PARTITION BY {key} ORDER BY {period}
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
                     FROM (SELECT {key}, {period}, {attr_list},
                                  CASE WHEN LAG({period}) OVER w IS NULL OR {lag_cmp} THEN 1 ELSE 0 END AS chg
                           FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY {period})))
               GROUP BY {key}, streak, {attr_list}"""


SCD_SINGLE_SQL = with_views(
    ["player_seasons"], scd_sql("players_hist", "player_name", "current_season", ["scoring_class"]), PLAYERS_CTES
)
SCD_MULTI_SQL = with_views(
    ["player_seasons"],
    scd_sql("players_hist", "player_name", "current_season", ["scoring_class", "is_active"]),
    PLAYERS_CTES,
)
ACTORS_SCD_SQL = with_views(
    ["actor_films"], scd_sql("actors_hist", "actor", "current_year", ["quality_class", "is_active"]), ACTORS_CTES
)


@register("scd_single", SCD_SINGLE_SQL)
def q_scd_single(t):
    """Runs of unchanged scoring class per player."""
    ps = A.player_seasons(t)
    last = last_season(t)
    return scd2_history(cumulate_history(ps, last), "player_name", "current_season", ["scoring_class"], upto=last)


@register("scd_multi", SCD_MULTI_SQL)
def q_scd_multi(t):
    """Runs of unchanged (scoring class, activity) per player."""
    ps = A.player_seasons(t)
    last = last_season(t)
    attrs = ["scoring_class", "is_active"]
    return scd2_history(cumulate_history(ps, last), "player_name", "current_season", attrs, upto=last)


@register("scd_step", SCD_MULTI_SQL)
def q_scd_step(t):
    """Backfill up to the season before the last, then one incremental
    step; equals the full backfill."""
    ps = A.player_seasons(t)
    last = last_season(t)
    attrs = ["scoring_class", "is_active"]
    table = SnapshotTable.scratch(t.spark, "players_scd", "player_name", "as_of")
    table.write(scd2_history(cumulate_history(ps, last - 1), "player_name", "current_season", attrs, upto=last - 1), last - 1)
    season = cumulate_history(ps, last, periods=[last])
    return table.advance(lambda scd: scd2_step(scd, season, "player_name", "current_season", attrs, last), last - 1, last)


@register("actors_scd", ACTORS_SCD_SQL)
def q_actors_scd(t):
    """C11: SCD of (quality class, activity) over the actors table."""
    films = A.actor_films(t)
    last = last_film_year(t)
    actors = actors_history(films, last, with_films=False)
    return scd2_history(actors, "actor", "current_year", ["quality_class", "is_active"], upto=last)


@register("actors_scd_step", ACTORS_SCD_SQL)
def q_actors_scd_step(t):
    """C11 incremental: backfill to the year before the last, one step."""
    films = A.actor_films(t)
    last = last_film_year(t)
    attrs = ["quality_class", "is_active"]
    table = SnapshotTable.scratch(t.spark, "actors_scd", "actor", "as_of")
    table.write(scd2_history(actors_history(films, last - 1, with_films=False), "actor", "current_year", attrs, upto=last - 1), last - 1)
    year = actors_history(films, last, periods=[last], with_films=False)
    return table.advance(lambda scd: scd2_step(scd, year, "actor", "current_year", attrs, last), last - 1, last)
