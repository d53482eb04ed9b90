"""Registered queries: cumulative players / actors / users / devices / hosts
tables (C1, C2, C4, C5, C9, C10, C17-C19, C22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimweave.functions.columns import array_text
from dimweave.operators.chunks import chunk_days, chunked_snapshots, closed_chunks, expand
from dimweave.operators.cumulative import (
    actors_history,
    actors_step,
    cumulate_history,
    cumulate_step,
    dates_active_history,
    device_datelist_history,
    host_datelist_history,
    improvement_ratio,
    unnest_history,
)
from dimweave.plans.oracle_views import with_views
from dimweave.plans.registry import last_day, last_film_year, last_season, register
from dimweave.session import scratch_path
from dimweave.sources import adapters as A
from dimweave.sources.snapshots import SnapshotTable

# -- canonical text of nested values ------------------------------------------


def season_text(x):
    return F.concat_ws(
        ":",
        x["season"].cast("string"),
        x["gp"].cast("string"),
        x["pts"].cast("decimal(18,2)").cast("string"),
        x["reb"].cast("decimal(18,2)").cast("string"),
        x["ast"].cast("decimal(18,2)").cast("string"),
    )


def film_text(x):
    return F.concat_ws(
        ":", x["filmid"], x["film"], x["votes"].cast("string"), x["rating"].cast("bigint").cast("string")
    )


SEASON_SQL = (
    "CAST(ps.season AS VARCHAR) || ':' || CAST(ps.gp AS VARCHAR) || ':' || "
    "CAST(CAST(ps.pts AS DECIMAL(18,2)) AS VARCHAR) || ':' || CAST(CAST(ps.reb AS DECIMAL(18,2)) AS VARCHAR)"
    " || ':' || CAST(CAST(ps.ast AS DECIMAL(18,2)) AS VARCHAR)"
)
FILM_SQL = (
    "af.filmid || ':' || af.film || ':' || CAST(af.votes AS VARCHAR) || ':' || "
    "CAST(CAST(af.rating AS BIGINT) AS VARCHAR)"
)


def player_class_sql(v: str) -> str:
    return (
        f"CASE WHEN {v} > 20 THEN 'star' WHEN {v} > 15 THEN 'good' WHEN {v} > 10 THEN 'average' ELSE 'bad' END"
    )


def actor_class_sql(v: str) -> str:
    return f"CASE WHEN {v} > 8 THEN 'star' WHEN {v} > 7 THEN 'good' WHEN {v} > 6 THEN 'average' ELSE 'bad' END"


PLAYERS_CTES = [
    (
        "ps_first",
        """SELECT player_name, MIN(season) AS first_s, MAX(height) AS height, MAX(college) AS college,
                  MAX(country) AS country, MAX(draft_year) AS draft_year, MAX(draft_round) AS draft_round,
                  MAX(draft_number) AS draft_number
           FROM player_seasons GROUP BY player_name""",
    ),
    ("ps_last", "SELECT MAX(season) AS last_s FROM player_seasons"),
    (
        "p_spine",
        """SELECT f.*, CAST(g.s AS INTEGER) AS current_season
           FROM ps_first f, ps_last, unnest(range(f.first_s, ps_last.last_s + 1)) AS g(s)""",
    ),
    (
        "players_agg",
        f"""SELECT sp.player_name, sp.current_season,
                   string_agg({SEASON_SQL}, '|' ORDER BY ps.season) AS seasons,
                   arg_max(ps.pts, ps.season) AS last_pts, MAX(ps.season) AS last_played,
                   arg_min(ps.pts, ps.season) AS first_pts
            FROM p_spine sp JOIN player_seasons ps
              ON ps.player_name = sp.player_name AND ps.season <= sp.current_season
            GROUP BY sp.player_name, sp.current_season""",
    ),
    (
        "players_hist",
        f"""SELECT sp.player_name, sp.height, sp.college, sp.country, sp.draft_year, sp.draft_round,
                   sp.draft_number, pa.seasons, {player_class_sql('pa.last_pts')} AS scoring_class,
                   CAST(sp.current_season - pa.last_played AS INTEGER) AS years_since_last_active,
                   pa.last_played = sp.current_season AS is_active, sp.current_season,
                   pa.last_pts, pa.first_pts
            FROM p_spine sp JOIN players_agg pa
              ON pa.player_name = sp.player_name AND pa.current_season = sp.current_season""",
    ),
]

PLAYER_COLS = (
    "player_name, height, college, country, draft_year, draft_round, draft_number, seasons, "
    "scoring_class, years_since_last_active, is_active, current_season"
)

ACTORS_CTES = [
    ("af_year", "SELECT actor, year, avg(rating) AS avg_rating FROM actor_films GROUP BY actor, year"),
    ("a_first", "SELECT actor, MIN(year) AS first_y FROM af_year GROUP BY actor"),
    ("a_last", "SELECT MAX(year) AS last_y FROM af_year"),
    (
        "a_spine",
        """SELECT f.actor, CAST(g.y AS INTEGER) AS current_year
           FROM a_first f, a_last, unnest(range(f.first_y, a_last.last_y + 1)) AS g(y)""",
    ),
    (
        "a_films",
        f"""SELECT sp.actor, sp.current_year,
                   string_agg({FILM_SQL}, '|' ORDER BY af.year, af.film, af.votes, af.rating, af.filmid) AS films
            FROM a_spine sp JOIN actor_films af ON af.actor = sp.actor AND af.year <= sp.current_year
            GROUP BY sp.actor, sp.current_year""",
    ),
    (
        "a_class",
        """SELECT sp.actor, sp.current_year, arg_max(ay.avg_rating, ay.year) AS last_avg,
                  MAX(ay.year) AS last_year
           FROM a_spine sp JOIN af_year ay ON ay.actor = sp.actor AND ay.year <= sp.current_year
           GROUP BY sp.actor, sp.current_year""",
    ),
    (
        "actors_hist",
        f"""SELECT f.actor, f.films, {actor_class_sql('c.last_avg')} AS quality_class,
                   c.last_year = f.current_year AS is_active, f.current_year
            FROM a_films f JOIN a_class c ON c.actor = f.actor AND c.current_year = f.current_year""",
    ),
]


def _datelist_ctes(src: str, keys: str, order: str, user_filter: bool = True):
    where = "WHERE user_id IS NOT NULL" if user_filter else ""
    on = " AND ".join(f"x.{k.strip()} = sp.{k.strip()}" for k in keys.split(","))
    sp_keys = ", ".join(f"sp.{k.strip()}" for k in keys.split(","))
    return [
        ("daily", f"SELECT DISTINCT {keys}, event_date AS d FROM {src} {where}"),
        ("firsts", f"SELECT {keys}, MIN(d) AS first_d FROM daily GROUP BY {keys}"),
        ("upto", "SELECT MAX(d) AS u FROM daily"),
        (
            "spine",
            """SELECT f.*, CAST(g.day AS DATE) AS sdate
               FROM firsts f, upto, unnest(generate_series(f.first_d, upto.u, INTERVAL 1 DAY)) AS g(day)""",
        ),
        (
            "lists",
            f"""SELECT {sp_keys}, sp.sdate,
                       string_agg(CAST(x.d AS VARCHAR), ',' ORDER BY x.d {order}) AS lst
                FROM spine sp JOIN daily x ON {on} AND x.d <= sp.sdate
                GROUP BY {sp_keys}, sp.sdate""",
        ),
    ]


DEVICE_EVENTS = (
    "dev_events",
    "SELECT e.*, d.browser_type FROM web_events e JOIN devices d ON e.device_id = d.device_id",
)


# -- queries -------------------------------------------------------------------


def _players_flat(df):
    return df.withColumn("seasons", array_text("seasons", season_text, "|"))


@register("players_history", with_views(["player_seasons"], f"SELECT {PLAYER_COLS} FROM players_hist", PLAYERS_CTES))
def q_players_history(t):
    """Cumulative players table backfilled for every season."""
    ps = A.player_seasons(t)
    return _players_flat(cumulate_history(ps, last_season(t)))


@register(
    "players_step",
    with_views(
        ["player_seasons"],
        f"SELECT {PLAYER_COLS} FROM players_hist, ps_last WHERE current_season = ps_last.last_s",
        PLAYERS_CTES,
    ),
)
def q_players_step(t):
    """The last season applied as one increment to the backfill of the
    seasons before it (equals the backfill's last season)."""
    ps = A.player_seasons(t)
    last = last_season(t)
    table = SnapshotTable.scratch(t.spark, "players", "player_name", "current_season")
    table.write(cumulate_history(ps, upto=last - 1, periods=[last - 1]), last - 1)
    return _players_flat(table.advance(lambda prev: cumulate_step(prev, ps, last), last - 1, last))


@register(
    "improvement",
    with_views(
        ["player_seasons"],
        """SELECT player_name, last_pts AS latest,
                  CASE WHEN first_pts = 0 THEN 1.0 ELSE first_pts END AS first,
                  last_pts / CASE WHEN first_pts = 0 THEN 1.0 ELSE first_pts END AS ratio
           FROM players_hist, ps_last WHERE current_season = ps_last.last_s""",
        PLAYERS_CTES,
    ),
)
def q_improvement(t):
    """C4: newest-season points over first-season points, latest snapshot."""
    ps = A.player_seasons(t)
    last = last_season(t)
    return improvement_ratio(cumulate_history(ps, last, periods=[last]), last)


@register(
    "unnest_history",
    with_views(["player_seasons"], "SELECT player_name, season, gp, pts, reb, ast FROM player_seasons"),
)
def q_unnest_history(t):
    """The latest snapshot exploded back to one row per season."""
    ps = A.player_seasons(t)
    last = last_season(t)
    return unnest_history(cumulate_history(ps, last, periods=[last]), last)


def _actors_flat(df):
    return df.withColumn("films", array_text("films", film_text, "|"))


ACTOR_COLS = "actor, films, quality_class, is_active, current_year"


@register("actors_history", with_views(["actor_films"], f"SELECT {ACTOR_COLS} FROM actors_hist", ACTORS_CTES))
def q_actors_history(t):
    """Cumulative actors table for every year."""
    films = A.actor_films(t)
    return _actors_flat(actors_history(films, last_film_year(t)))


@register(
    "actors_step",
    with_views(
        ["actor_films"],
        f"SELECT {ACTOR_COLS} FROM actors_hist, a_last WHERE current_year = a_last.last_y",
        ACTORS_CTES,
    ),
)
def q_actors_step(t):
    """The last year applied as one increment to the earlier backfill."""
    films = A.actor_films(t)
    last = last_film_year(t)
    table = SnapshotTable.scratch(t.spark, "actors", "actor", "current_year")
    table.write(actors_history(films, upto=last - 1, periods=[last - 1]), last - 1)
    return _actors_flat(table.advance(lambda prev: actors_step(prev, films, last), last - 1, last))


@register(
    "dates_active",
    with_views(
        ["web_events"],
        "SELECT user_id, lst AS dates_active, sdate AS date FROM lists",
        _datelist_ctes("web_events", "user_id", "ASC"),
    ),
)
def q_dates_active(t):
    """users_cumulated (active dates, oldest first) for every day."""
    ev = A.web_events(t)
    out = dates_active_history(ev, last_day(t, "user_id"))
    return out.withColumn("dates_active", array_text("dates_active"))


@register(
    "dates_active_chunked",
    with_views(
        ["web_events"],
        "SELECT user_id, lst AS dates_active, sdate AS date FROM lists",
        _datelist_ctes("web_events", "user_id", "ASC"),
    ),
)
def q_dates_active_chunked(t):
    """C18 stored in chunks of seven days (closed chunks once, snapshots with
    their open tail) and expanded to the whole lists again."""
    day, keys, size = last_day(t, "user_id"), ["user_id"], 7
    chunks = chunk_days(A.web_events(t), keys, day, size)
    paths = scratch_path(t.spark, "closed_chunks"), scratch_path(t.spark, "chunked_snapshots")
    closed_chunks(chunks, keys, day, size).write.parquet(paths[0])
    chunked_snapshots(chunks, keys, day, size).write.parquet(paths[1])
    closed, snapshots = map(t.spark.read.parquet, paths)
    return expand(snapshots, closed, keys, "dates_active").withColumn("dates_active", array_text("dates_active"))


@register(
    "device_datelist",
    with_views(
        ["web_events", "devices"],
        """SELECT user_id, browser_type, lst AS device_activity_datelist, sdate AS record_date FROM lists""",
        [DEVICE_EVENTS] + _datelist_ctes("dev_events", "user_id, browser_type", "DESC"),
    ),
)
def q_device_datelist(t):
    """Per (user, browser) active dates, newest first, every day."""
    ev = A.web_events(t)
    out = device_datelist_history(ev, A.devices(t), last_day(t, "user_id"))
    return out.withColumn("device_activity_datelist", array_text("device_activity_datelist"))


@register(
    "host_datelist",
    with_views(
        ["web_events"],
        "SELECT host, lst AS host_activity_datelist, sdate AS record_date FROM lists",
        _datelist_ctes("web_events", "host", "DESC", user_filter=False),
    ),
)
def q_host_datelist(t):
    """Per host active dates, newest first, every day."""
    ev = A.web_events(t)
    out = host_datelist_history(ev, last_day(t))
    return out.withColumn("host_activity_datelist", array_text("host_activity_datelist"))
