"""Adapters from the driver tables to the source shapes the operators expect.

The reference's own tables (web events, devices, player seasons, actor films,
game box scores, matches) are not shipped, so each is derived from the star
schema with a fixed, documented rule.  Every adapter is a lazy DataFrame:
its filters and projections push into the Parquet scans.

The same rules are restated in DuckDB SQL in ``dimweave.plans.oracle`` so the
registered queries can be checked by an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.functions.columns import props_int
from dimweave.operators.joins import tasks_for
from dimweave.sources.tables import Tables

# Domains that count as the site's own in the test data.
OWN_DOMAINS = ("shop.example.com", "blog.example.com")
# Referrer by (k mod 8): search and social sites, the site's own domains, a
# site of no channel, and no referrer at all.
REFERRERS = [
    "https://www.linkedin.com/feed/",
    "https://t.co/a1b2",
    "https://www.google.com/search?q=x",
    "https://lnkd.in/c3d4",
    "https://shop.example.com/cart",
    "https://blog.example.com/post/1",
    "https://news.example.org/",
    None,
]
IP_BASE = 167772160  # 10.0.0.0: web-event ips are IP_BASE + user_id
N_TEAMS = 25  # teams are nations
GAME_ROWS_PER_TASK = 500_000  # box scores that one task joins and groups


def web_events(t: Tables, sparse: bool = False) -> DataFrame:
    """events -> (event_id, user_id, device_id, url, host, referrer, ip,
    ip_num, event_time, event_date).  ``sparse`` keeps k < 5 only, which
    leaves long gaps per user so every activity state occurs."""
    # k is parsed once in its own projection (Catalyst keeps an expensive
    # expression that is used several times in a separate Project).
    base = t.events.select("event_id", "user_id", "event_type", "ts", props_int("props", "k").alias("k"))
    k = F.col("k")
    referrer = F.element_at(F.array(*[F.lit(r).cast("string") for r in REFERRERS]), (k % 8) + 1)
    ip_num = F.lit(IP_BASE).cast("long") + F.col("user_id")
    ip = F.concat_ws(
        ".",
        *[(F.shiftright(ip_num, s) % 256).cast("string") for s in (24, 16, 8, 0)],
    )
    ev = base.select(
        "event_id",
        "user_id",
        k.cast("long").alias("device_id"),
        F.col("event_type").alias("url"),
        F.concat(F.lit("h"), (k % 3).cast("string")).alias("host"),
        referrer.alias("referrer"),
        ip.alias("ip"),
        ip_num.alias("ip_num"),
        F.col("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
    )
    if sparse:
        ev = ev.filter(F.col("device_id") < 5)
    return ev


def devices(t: Tables) -> DataFrame:
    """part -> (device_id, browser_type, device_type, os_type)."""
    return t.part.select(
        F.col("p_partkey").alias("device_id"),
        F.col("p_brand").alias("browser_type"),
        F.col("p_type").alias("device_type"),
        F.element_at(F.split("p_name", " "), 1).alias("os_type"),
    )


def player_seasons(t: Tables) -> DataFrame:
    """orders grouped by (customer, order year) -> one season per player.

    gp = orders, pts = avg price / 20000, reb = avg price / 50000,
    ast = finished orders; statics come from customer."""
    o = t.orders.select(
        "o_custkey",
        F.year("o_orderdate").alias("season"),
        "o_totalprice",
        "o_orderstatus",
    )
    stats = o.groupBy("o_custkey", "season").agg(
        F.count(F.lit(1)).alias("gp"),
        F.round(F.avg("o_totalprice") / 20000, 2).alias("pts"),
        F.round(F.avg("o_totalprice") / 50000, 2).alias("reb"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).cast("double").alias("ast"),
    )
    c = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("height"),
        F.concat(F.lit("college_"), (F.col("c_nationkey") % 7).cast("string")).alias("college"),
        F.concat(F.lit("country_"), F.col("c_nationkey").cast("string")).alias("country"),
        (F.lit(1990) + F.col("c_custkey") % 10).cast("string").alias("draft_year"),
        (F.lit(1) + F.col("c_custkey") % 2).cast("string").alias("draft_round"),
        (F.lit(1) + F.col("c_custkey") % 60).cast("string").alias("draft_number"),
    )
    return stats.join(c, "o_custkey").select(
        "player_name", "height", "college", "country", "draft_year", "draft_round", "draft_number",
        F.col("season").cast("int").alias("season"), "gp", "pts", "reb", "ast",
    )


def actor_films(t: Tables) -> DataFrame:
    """lineitem x orders x part -> (actor, actorid, film, year, votes, rating,
    filmid).  rating = round(discount * 100) in 0..10."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    p = t.part.select("p_partkey", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, F.col("l_partkey") == p.p_partkey)
    return j.select(
        F.concat(F.lit("actor_"), F.col("o_custkey").cast("string")).alias("actor"),
        F.col("o_custkey").alias("actorid"),
        F.col("p_name").alias("film"),
        F.year("l_shipdate").cast("int").alias("year"),
        F.col("l_quantity").cast("int").alias("votes"),
        F.round(F.col("l_discount") * 100).alias("rating"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("filmid"),
    )


def games(t: Tables) -> DataFrame:
    """orders x customer -> one game per order.  Home team = customer nation,
    visitor = another nation picked from the order key, home wins when the
    order is finished."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    home = F.col("c_nationkey").cast("long")
    visitor = F.pmod(home + 1 + F.col("o_orderkey") % (N_TEAMS - 1), F.lit(N_TEAMS))
    return o.join(c, "o_custkey").select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        home.alias("home_team_id"),
        visitor.cast("long").alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"),
    )


def game_details(t: Tables, by_game: bool = True) -> DataFrame:
    """lineitem x supplier x games -> box-score rows.  player = supplier,
    pts = quantity, reb = line number, ast = round(tax * 100); an even-nation
    supplier plays for the home team, odd for the visitor.  Contains repeated
    (game, player) rows, as the reference's table does.

    What groups the rows by game runs in the tasks of the join.  Adaptive
    execution merges shuffle partitions to about one task per core, so with
    ``by_game`` both sides of a join that is larger than the cores can hold at
    ``GAME_ROWS_PER_TASK`` are dealt out by game to as many tasks as it asks
    for.  Without it the join is left to the planner, which may split a game of
    very many rows."""
    li = t.lineitem.select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag"
    )
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    g = games(t).select("game_id", "home_team_id", "visitor_team_id")
    rows = li.join(s, li.l_suppkey == s.s_suppkey)
    n = tasks_for(GAME_ROWS_PER_TASK, t.lineitem) if by_game else 1
    if n > t.spark.sparkContext.defaultParallelism:
        rows, g = rows.repartition(n, "l_orderkey"), g.repartition(n, "game_id")
    j = rows.join(g, F.col("l_orderkey") == g.game_id)
    team = F.when(F.col("s_nationkey") % 2 == 0, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return j.select(
        "game_id",
        team.alias("team_id"),
        F.concat(F.lit("T"), team.cast("string")).alias("team_abbreviation"),
        F.col("l_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        F.col("l_returnflag").alias("start_position"),
        F.col("l_quantity").alias("pts"),
        F.col("l_linenumber").cast("double").alias("reb"),
        F.round(F.col("l_tax") * 100).alias("ast"),
    )


def teams(t: Tables) -> DataFrame:
    """One team row per box-score appearance: team attributes from nation x
    region, the nickname written two ways (appearances of odd players carry a
    'Former ' variant), so building team vertices is a de-duplication over
    data that grows with the box scores."""
    d = game_details(t, by_game=False).select("team_id", "player_id")
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("team_id"), "n_name", "r_name"
    )
    j = d.join(n, "team_id")
    nickname = F.when(F.col("player_id") % 2 == 0, F.col("n_name")).otherwise(F.concat(F.lit("Former "), "n_name"))
    return j.select(
        "team_id",
        F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("abbreviation"),
        nickname.alias("nickname"),
        F.col("r_name").alias("city"),
        F.concat(F.col("r_name"), F.lit(" Arena")).alias("arena"),
        (F.lit(1900) + F.col("team_id")).cast("long").alias("yearfounded"),
    )


# -- match analytics (bucket / broadcast joins) ------------------------------


def matches(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("match_id"),
        (F.col("o_orderstatus") != "P").alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        (F.col("o_custkey") % N_TEAMS).cast("int").alias("mapid"),
        F.col("o_orderdate").alias("completion_date"),
    )


def match_details(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("player_"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
        F.col("l_quantity").cast("int").alias("player_total_kills"),
        F.col("l_linenumber").alias("player_total_deaths"),
    )


def medals_matches_players(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("player_"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
        F.col("l_partkey").alias("medal_id"),
        F.lit(1).cast("int").alias("count"),
    )


def medals(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("medal_id"), F.col("p_brand").alias("name"))


def maps(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name"))


def geo_ranges(t: Tables, width: int = 6, stride: int = 8) -> DataFrame:
    """IP ranges -> location, derived from nation x region: nation n owns
    [IP_BASE + n*stride, IP_BASE + n*stride + width - 1]; the addresses in
    between and past the last nation have no location."""
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    lo = F.lit(IP_BASE).cast("long") + F.col("n_nationkey").cast("long") * stride
    return n.select(
        lo.alias("ip_lo"),
        (lo + (width - 1)).alias("ip_hi"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("state"),
        F.concat(F.lit("city_"), F.col("n_nationkey").cast("string")).alias("city"),
    )


def order_profit_inputs(t: Tables) -> DataFrame:
    """lineitem x part x orders for the profit pipelines."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    p = t.part.select("p_partkey", "p_retailprice")
    o = t.orders.select("o_orderkey", "o_orderdate")
    return li.join(p, F.col("l_partkey") == p.p_partkey).join(o, F.col("l_orderkey") == o.o_orderkey)
