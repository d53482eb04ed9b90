"""The adapter rules of ``dimweave.sources.adapters`` restated in DuckDB SQL.

``with_views(names, body)`` prefixes a query with the CTEs it needs (and
their dependencies, in order)."""

from __future__ import annotations

# The adapters' values, stated again so that a wrong one shows.
IP_BASE = 10 * 256**3
N_TEAMS = 25
REFERRERS = (
    "https://www.linkedin.com/feed/",
    "https://t.co/a1b2",
    "https://www.google.com/search?q=x",
    "https://lnkd.in/c3d4",
    "https://shop.example.com/cart",
    "https://blog.example.com/post/1",
    "https://news.example.org/",
    None,
)


def _referrer_case() -> str:
    arms = " ".join(
        f"WHEN {i} THEN '{r}'" for i, r in enumerate(REFERRERS) if r is not None
    )
    return f"CASE k % 8 {arms} ELSE NULL END"


_IP = f"({IP_BASE} + user_id)"

VIEWS: dict[str, tuple[list[str], str]] = {
    "ev_k": (
        [],
        "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    ),
    "web_events": (
        ["ev_k"],
        f"""SELECT event_id, user_id, CAST(k AS BIGINT) AS device_id, event_type AS url,
            'h' || CAST(k % 3 AS VARCHAR) AS host, {_referrer_case()} AS referrer,
            concat_ws('.', CAST(({_IP} >> 24) % 256 AS VARCHAR), CAST(({_IP} >> 16) % 256 AS VARCHAR),
                      CAST(({_IP} >> 8) % 256 AS VARCHAR), CAST({_IP} % 256 AS VARCHAR)) AS ip,
            CAST({_IP} AS BIGINT) AS ip_num,
            ts AS event_time, CAST(ts AS DATE) AS event_date
            FROM ev_k""",
    ),
    "sparse_events": (["web_events"], "SELECT * FROM web_events WHERE device_id < 5"),
    "devices": (
        [],
        """SELECT p_partkey AS device_id, p_brand AS browser_type, p_type AS device_type,
           split_part(p_name, ' ', 1) AS os_type FROM part""",
    ),
    "player_seasons": (
        [],
        """SELECT c.c_name AS player_name, c.c_mktsegment AS height,
                  'college_' || CAST(c.c_nationkey % 7 AS VARCHAR) AS college,
                  'country_' || CAST(c.c_nationkey AS VARCHAR) AS country,
                  CAST(1990 + c.c_custkey % 10 AS VARCHAR) AS draft_year,
                  CAST(1 + c.c_custkey % 2 AS VARCHAR) AS draft_round,
                  CAST(1 + c.c_custkey % 60 AS VARCHAR) AS draft_number,
                  CAST(s.season AS INTEGER) AS season, s.gp, s.pts, s.reb, s.ast
           FROM (SELECT o_custkey, year(o_orderdate) AS season, COUNT(*) AS gp,
                        round(avg(o_totalprice) / 20000, 2) AS pts,
                        round(avg(o_totalprice) / 50000, 2) AS reb,
                        CAST(COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS ast
                 FROM orders GROUP BY o_custkey, year(o_orderdate)) s
           JOIN customer c ON c.c_custkey = s.o_custkey""",
    ),
    "actor_films": (
        [],
        """SELECT 'actor_' || CAST(o.o_custkey AS VARCHAR) AS actor, o.o_custkey AS actorid,
                  p.p_name AS film, CAST(year(l.l_shipdate) AS INTEGER) AS year,
                  CAST(l.l_quantity AS INTEGER) AS votes, round(l.l_discount * 100) AS rating,
                  CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS filmid
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN part p ON l.l_partkey = p.p_partkey""",
    ),
    "games": (
        [],
        f"""SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS game_date_est,
                   CAST(year(o.o_orderdate) AS INTEGER) AS season,
                   CAST(c.c_nationkey AS BIGINT) AS home_team_id,
                   CAST(((c.c_nationkey + 1 + o.o_orderkey % {N_TEAMS - 1}) % {N_TEAMS} + {N_TEAMS}) % {N_TEAMS} AS BIGINT) AS visitor_team_id,
                   CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    ),
    "game_details": (
        ["games"],
        """SELECT g.game_id,
                  CASE WHEN s.s_nationkey % 2 = 0 THEN g.home_team_id ELSE g.visitor_team_id END AS team_id,
                  'T' || CAST(CASE WHEN s.s_nationkey % 2 = 0 THEN g.home_team_id ELSE g.visitor_team_id END AS VARCHAR) AS team_abbreviation,
                  l.l_suppkey AS player_id, s.s_name AS player_name, l.l_returnflag AS start_position,
                  l.l_quantity AS pts, CAST(l.l_linenumber AS DOUBLE) AS reb, round(l.l_tax * 100) AS ast
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
           JOIN games g ON l.l_orderkey = g.game_id""",
    ),
    "teams": (
        ["game_details"],
        """SELECT d.team_id, 'T' || CAST(d.team_id AS VARCHAR) AS abbreviation,
                  CASE WHEN d.player_id % 2 = 0 THEN n.n_name ELSE 'Former ' || n.n_name END AS nickname,
                  r.r_name AS city, r.r_name || ' Arena' AS arena, CAST(1900 + d.team_id AS BIGINT) AS yearfounded
           FROM game_details d JOIN nation n ON d.team_id = n.n_nationkey
           JOIN region r ON n.n_regionkey = r.r_regionkey""",
    ),
    "matches": (
        [],
        f"""SELECT o_orderkey AS match_id, o_orderstatus <> 'P' AS is_team_game,
                   o_orderpriority AS playlist_id, CAST(o_custkey % {N_TEAMS} AS INTEGER) AS mapid,
                   o_orderdate AS completion_date FROM orders""",
    ),
    "match_details": (
        [],
        """SELECT l_orderkey AS match_id, 'player_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
                  CAST(l_quantity AS INTEGER) AS player_total_kills, l_linenumber AS player_total_deaths
           FROM lineitem""",
    ),
    "medals_matches_players": (
        [],
        """SELECT l_orderkey AS match_id, 'player_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
                  l_partkey AS medal_id, 1 AS count FROM lineitem""",
    ),
    "medals": ([], "SELECT p_partkey AS medal_id, p_brand AS name FROM part"),
    "maps": ([], "SELECT n_nationkey AS mapid, n_name AS name FROM nation"),
    "geo_ranges": (
        [],
        f"""SELECT CAST({IP_BASE} + n_nationkey * 8 AS BIGINT) AS ip_lo,
                   CAST({IP_BASE} + n_nationkey * 8 + 5 AS BIGINT) AS ip_hi,
                   r_name AS country, n_name AS state, 'city_' || CAST(n_nationkey AS VARCHAR) AS city
            FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <adapter views>, <extra CTEs> <body>``."""
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in _order(names)]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
