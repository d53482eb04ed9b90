"""Registered queries: dedupe, grain check, rollups, stretches, streaks
(C29, A12, C39-C41)."""

from __future__ import annotations

from dimweave.operators.sports import best_stretch, dedupe, game_rollups, grain_check, longest_streak
from dimweave.plans.oracle_views import with_views
from dimweave.plans.registry import register
from dimweave.sources import adapters as A

GRAIN = ["game_id", "team_id", "player_id"]
DETAIL_COLS = "game_id, team_id, team_abbreviation, player_id, player_name, start_position, pts, reb, ast"
_DEDUPED = (
    "deduped",
    f"""SELECT {DETAIL_COLS} FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, team_id, player_id
                                       ORDER BY team_abbreviation, player_name, start_position, pts, reb, ast) AS rn
          FROM game_details) WHERE rn = 1""",
)

DEDUPE_SQL = with_views(["game_details"], "SELECT * FROM deduped", [_DEDUPED])
GRAIN_SQL = with_views(
    ["game_details"],
    "SELECT game_id, team_id, player_id, COUNT(*) AS n FROM game_details GROUP BY 1, 2, 3 HAVING COUNT(*) > 1",
)
ROLLUPS_SQL = with_views(
    ["game_details"],
    """SELECT CASE WHEN GROUPING(player_id) = 0 AND GROUPING(team_id) = 0 THEN 'player_team'
                   WHEN GROUPING(player_id) = 0 AND GROUPING(season) = 0 THEN 'player_season'
                   ELSE 'team' END AS aggregation_level,
              player_id, team_id, season, SUM(pts) AS points,
              COUNT(DISTINCT CASE WHEN won THEN game_id END) AS games_won
       FROM joined
       GROUP BY GROUPING SETS ((player_id, team_id), (player_id, season), (team_id))""",
    [
        _DEDUPED,
        (
            "joined",
            """SELECT d.*, g.season,
                      (d.team_id = g.home_team_id AND g.home_team_wins = 1)
                      OR (d.team_id = g.visitor_team_id AND g.home_team_wins = 0) AS won
               FROM deduped d JOIN games g ON d.game_id = g.game_id""",
        ),
    ],
)
STRETCH_SQL = with_views(
    ["games"],
    """SELECT team_id, CAST(MAX(w) AS BIGINT) AS best_wins FROM (
         SELECT team_id, SUM(won) OVER (PARTITION BY team_id ORDER BY game_date_est, game_id
                                        ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS w
         FROM tg) GROUP BY team_id""",
    [
        (
            "tg",
            """SELECT home_team_id AS team_id, game_id, game_date_est,
                      CASE WHEN home_team_wins = 1 THEN 1 ELSE 0 END AS won FROM games
               UNION ALL
               SELECT visitor_team_id, game_id, game_date_est,
                      CASE WHEN home_team_wins = 0 THEN 1 ELSE 0 END FROM games""",
        )
    ],
)
STREAK_SQL = with_views(
    ["game_details"],
    """SELECT player_id, streak_len, start_date, end_date FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY streak_len DESC, start_date, end_date) AS rn
         FROM runs) WHERE rn = 1""",
    [
        _DEDUPED,
        (
            "s",
            """SELECT d.player_id, d.game_id, g.game_date_est, d.pts,
                      ROW_NUMBER() OVER (PARTITION BY d.player_id ORDER BY g.game_date_est, d.game_id) AS r
               FROM deduped d JOIN games g ON d.game_id = g.game_id WHERE d.pts IS NOT NULL""",
        ),
        (
            "q",
            """SELECT *, r - ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY game_date_est, game_id) AS island
               FROM s WHERE pts > 10""",
        ),
        (
            "runs",
            """SELECT player_id, island, COUNT(*) AS streak_len, MIN(game_date_est) AS start_date,
                      MAX(game_date_est) AS end_date FROM q GROUP BY player_id, island""",
        ),
    ],
)


def deduped_details(t):
    return dedupe(A.game_details(t), GRAIN)


@register("dedupe_details", DEDUPE_SQL)
def q_dedupe_details(t):
    """One box-score row per (game, team, player)."""
    return deduped_details(t)


@register("grain_check", GRAIN_SQL)
def q_grain_check(t):
    """(game, team, player) keys occurring more than once."""
    return grain_check(A.game_details(t), GRAIN)


@register("game_rollups", ROLLUPS_SQL)
def q_game_rollups(t):
    """Points and games won by (player, team), (player, season), team."""
    return game_rollups(deduped_details(t), A.games(t))


@register("best_stretch", STRETCH_SQL)
def q_best_stretch(t):
    """Most wins per team in any 90 consecutive games."""
    return best_stretch(A.games(t), 90)


@register("longest_streak", STREAK_SQL)
def q_longest_streak(t):
    """Longest run of games with more than 10 points per player."""
    return longest_streak(deduped_details(t), A.games(t), 10.0)
