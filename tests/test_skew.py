"""One key holding a third of all rows: results stay exact and the hot key is
split across tasks."""

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimweave.operators.behaviour import day_ends, funnel
from dimweave.operators.growth import growth_accounting_history
from dimweave.operators.joins import salted_join
from dimweave.operators.sports import dedupe, grain_check
from dimweave.plans.inspect import physical_tree
from dimweave.sources import adapters as A
from dimweave.sources.tables import Tables

HOT_USER = 999999


@pytest.fixture(scope="module")
def skewed(spark, tables, tmp_path_factory):
    """Web events where every third event belongs to one user on one day."""
    hot = F.col("event_id") % 3 == 0
    ev = A.web_events(tables)
    ev = (
        ev.withColumn("user_id", F.when(hot, F.lit(HOT_USER)).otherwise(F.col("user_id")))
        .withColumn(
            "event_time",
            F.when(
                hot,
                F.to_timestamp_ntz(F.concat(F.lit("2024-01-15 "), F.date_format("event_time", "HH:mm:ss.SSSSSS"))),
            ).otherwise(F.col("event_time")),
        )
        .withColumn("event_date", F.to_date("event_time"))
    )
    path = str(tmp_path_factory.mktemp("skew") / "events")
    ev.write.parquet(path)
    return spark.read.parquet(path), path


def test_funnel_exact_under_hot_user_day(spark, skewed):
    ev, path = skewed
    got = funnel(ev, "purchase", min_n=0, salt_buckets=8)
    sql = f"""
    WITH deduped AS (SELECT url, host, user_id, event_time FROM read_parquet('{path}/*.parquet') GROUP BY 1,2,3,4),
         clean AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM deduped WHERE user_id IS NOT NULL),
         converted AS (
           SELECT ce1.user_id, ce1.event_time, ce1.url,
                  COUNT(DISTINCT CASE WHEN ce2.url = 'purchase' THEN ce2.url END) AS converted
           FROM clean ce1 JOIN clean ce2 ON ce2.user_id = ce1.user_id AND ce2.event_date = ce1.event_date
                                        AND ce2.event_time > ce1.event_time
           GROUP BY 1, 2, 3)
    SELECT url, COUNT(1) AS n, CAST(SUM(converted) AS DOUBLE) / COUNT(1) AS conversion_rate
    FROM converted GROUP BY url HAVING CAST(SUM(converted) AS DOUBLE) / COUNT(1) > 0"""
    expected = {r[0]: (r[1], r[2]) for r in duckdb.sql(sql).fetchall()}
    assert {r.url: (r.n, pytest.approx(r.conversion_rate)) for r in got.collect()} == expected


def test_salt_spreads_the_hot_key(spark, skewed):
    ev, _ = skewed
    day = ev.groupBy("user_id", "event_date").agg(F.count(F.lit(1)).alias("n"))
    j = salted_join(ev, day, ["user_id", "event_date"], 8, ["url", "event_time"])
    assert j.count() == ev.count()
    hot = ev.filter(F.col("user_id") == HOT_USER).withColumn(
        "_salt", F.pmod(F.xxhash64("url", "event_time"), F.lit(8))
    )
    per_salt = [r["count"] for r in hot.groupBy("_salt").count().collect()]
    assert len(per_salt) == 8
    assert max(per_salt) < 2 * (sum(per_salt) / 8)


def test_funnel_never_broadcasts_copies_of_days(spark):
    # 3000 user-days of one or two events; one user-day of 500
    n = F.col("id")
    user = F.when(n < 500, F.lit(-1)).otherwise(n % 3000)
    at = F.timestamp_seconds(F.lit(1704067200) + F.when(n < 500, n * 60).otherwise(n)).cast("timestamp_ntz")
    url = F.when(n % 7 == 0, F.lit("buy")).otherwise(F.lit("view"))
    ev = spark.range(5000).select(user.alias("user_id"), url.alias("url"), at.alias("event_time"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "10m", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m", "spark.sql.shuffle.partitions": "200"}
    was = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = funnel(ev, "buy", min_n=0)
        got = sorted((r.url, r.n, round(r.conversion_rate, 9)) for r in out.collect())
        ran = physical_tree(out)
        days = day_ends(ev.withColumn("event_date", F.to_date("event_time")), "buy", 66)
        copies = days.agg(F.sum(F.size("_salts"))).first()[0]
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = [(r.user_id, r.event_time, r.url) for r in ev.collect()]
    days_of = {}
    for u, t, to in rows:
        days_of.setdefault((u, t.date()), []).append((t, to))
    later = {}
    for u, t, to in rows:
        after = [x for at_, x in days_of[u, t.date()] if at_ > t]
        if after:
            later.setdefault(to, []).append("buy" in after)
    assert got == sorted((to, len(v), round(sum(v) / len(v), 9)) for to, v in later.items())
    assert "Broadcast" not in ran
    assert copies <= len(rows)  # 66 for each day before


def test_growth_history_with_hot_user(spark, skewed):
    ev, _ = skewed
    ga = growth_accounting_history(ev, with_dates=False)
    hot = ga.filter(F.col("user_id") == HOT_USER).collect()
    # the hot user appears once per day from its first day, not once per event
    days = {r.date for r in hot}
    assert len(hot) == len(days)


def test_dedupe_limits_groups_before_the_shuffle(spark, skewed):
    ev, _ = skewed
    d = ev.select("user_id", "event_date", "url", "event_time")
    got = dedupe(d, ["user_id", "event_date"])
    tree = physical_tree(got)
    # a group limit below the exchange: a hot key sends one row per map task
    assert "WindowGroupLimit" in tree.split("Exchange")[-1]
    assert "SortAggregate" not in tree
    # same answer as the window form (first row by url, then event_time)
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "event_date").orderBy("url", "event_time")
    expected = d.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    assertDataFrameEqual(got, expected)


@pytest.fixture(scope="module")
def hot_box_scores(spark, tables, tmp_path_factory):
    """Box scores of which a third lie in one game (of very many players) and
    a third belong to one player."""
    d = A.game_details(tables).withColumn("_n", F.monotonically_increasing_id())
    hot_game = F.col("_n") % 3 == 0
    hot_player = F.col("_n") % 3 == 1
    d = d.withColumn("player_id", F.when(hot_game, 1000 + F.col("_n") % 400).when(hot_player, F.lit(7)).otherwise(F.col("player_id")).cast("long"))
    d = d.withColumn("player_name", F.concat(F.lit("P"), F.col("player_id").cast("string")))
    d = d.withColumn("game_id", F.when(hot_game, F.lit(1)).otherwise(F.col("game_id")).cast("long")).drop("_n")
    path = str(tmp_path_factory.mktemp("hot") / "details")
    d.write.parquet(path)
    games = str(tmp_path_factory.mktemp("hot") / "games")
    A.games(tables).write.parquet(games)
    return spark.read.parquet(path), spark.read.parquet(games)


def test_pair_edges_meet_in_tiles_of_bounded_size(spark, hot_box_scores):
    from dimweave.operators.graph import _one_row_per_player_game, player_pair_edges, roster_tiles

    details, _ = hot_box_scores
    one_tile = player_pair_edges(details, block_players=1_000_000)
    assertDataFrameEqual(player_pair_edges(details, block_players=16), one_tile)
    assert one_tile.count() > 10_000
    tiles = roster_tiles(_one_row_per_player_game(details), 16)
    sizes = [r["count"] for r in tiles.groupBy("game_id", "_low", "_high").count().collect()]
    assert max(sizes) < 4 * 16
    # every pair of a game meets exactly once
    a, b = tiles.alias("a"), tiles.alias("b")
    met = a.join(b, (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a._low") == F.col("b._low")) & (F.col("a._high") == F.col("b._high")) & (F.col("a.player_id") > F.col("b.player_id")))
    met = met.filter("a._low = a._high or a._block <> b._block").filter("a.game_id = 1")
    k = _one_row_per_player_game(details).filter("game_id = 1").count()
    assert met.count() == met.select("a.player_id", "b.player_id").distinct().count() == k * (k - 1) // 2


def test_runs_are_folded_from_monthly_summaries(spark, hot_box_scores, monkeypatch):
    """Two shuffles behind the input joins, and a hot player's or team's games
    are spread over the months."""
    from dimweave.operators.sports import best_stretch, longest_streak
    from dimweave.plans.inspect import exchanges

    details, games = hot_box_scores
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(best_stretch(games)) == 2
        assert exchanges(longest_streak(details, games)) == 2 + 2
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    scored = details.join(games, "game_id")
    spread = [r["count"] for r in scored.filter("player_id = 7").groupBy(F.trunc("game_date_est", "MM")).count().collect()]
    assert max(spread) < sum(spread) / 10
    got = {r.player_id: (r.streak_len, r.start_date, r.end_date) for r in longest_streak(details, games).collect()}
    want, open_ = {}, {}
    for r in sorted(scored.filter("pts is not null").collect(), key=lambda r: (r.game_date_est, r.game_id, r.pts > 10)):
        run = open_.get(r.player_id) if r.pts > 10 else None
        if r.pts > 10:
            run = (run[0] + 1, run[1], r.game_date_est) if run else (1, r.game_date_est, r.game_date_est)
            best = want.get(r.player_id)
            if best is None or run[0] > best[0]:
                want[r.player_id] = run
        open_[r.player_id] = run
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 7, 90])
def test_best_stretch_of_a_hot_team(spark, hot_box_scores, n):
    from dimweave.operators.sports import best_stretch, team_games

    _, games = hot_box_scores
    games = games.withColumn("home_team_id", F.when(F.col("game_id") % 2 == 0, 3).otherwise(F.col("home_team_id")).cast("long"))
    games = games.filter("home_team_id <> visitor_team_id")
    results = {}
    for r in sorted(team_games(games).collect(), key=lambda r: (r.game_date_est, r.game_id)):
        results.setdefault(r.team_id, []).append(r.won)
    want = {t: max(sum(w[max(0, i - n + 1) : i + 1]) for i in range(len(w))) for t, w in results.items()}
    assert {r.team_id: r.best_wins for r in best_stretch(games, n).collect()} == want


def test_match_buckets_grow_with_the_rows(spark, monkeypatch):
    from dimweave.operators import matches as operator
    from dimweave.operators.matches import bucketed_matches, match_frame

    monkeypatch.setattr(operator, "BUCKET_ROWS", 100)
    medals = spark.createDataFrame([(1, "gold")], "medal_id long, name string")

    def tables(n):
        rows, player = spark.range(n), F.concat(F.lit("p"), (F.col("id") % 5).cast("string"))
        match = (F.col("id") / 5).cast("long").alias("match_id")
        details = rows.select(match, player.alias("player_gamertag"), F.lit(2).alias("player_total_kills"))
        earned = rows.select(match, player.alias("player_gamertag"), (F.col("id") % 2).alias("medal_id"), F.lit(1).alias("count"))
        matches = rows.filter("id % 5 = 0").select(
            match, F.lit("a").alias("playlist_id"), F.lit(1).alias("mapid"), F.lit(None).cast("timestamp_ntz").alias("completion_date")
        )
        return details, matches, earned

    for n in (1000, 8000):
        details, matches, earned = bucketed_matches(*tables(n))
        buckets = [len(df.select(F.input_file_name()).distinct().collect()) for df in (details, matches, earned)]
        assert max(buckets) <= (16 if n == 1000 else 80)
        largest = details.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert largest < 200  # of 8000 rows, 16 buckets have 500
        got = match_frame(details, matches, earned, medals, "gold")
        want = match_frame(*tables(n), medals, "gold")
        assertDataFrameEqual(got, want)


def test_box_scores_of_a_task_do_not_grow(spark, tmp_path, monkeypatch):
    # 4000 line items of 800 orders; every tenth order lists its first supplier twice
    n = F.col("id")
    order, line = (n / 5).cast("long"), (n % 5).cast("int")
    again = (order % 10 == 0) & (line == 4)
    tables = {
        "lineitem": spark.range(4000).select(
            order.alias("l_orderkey"), F.when(again, 0).otherwise(line).cast("long").alias("l_suppkey"), line.alias("l_linenumber"),
            F.lit(1.0).alias("l_quantity"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"),
        ),
        "supplier": spark.range(5).select(n.alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(2).alias("s_nationkey")),
        "orders": spark.range(800).select(
            n.alias("o_orderkey"), (n % 3).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit("1995-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        ),
        "customer": spark.range(3).select(n.alias("c_custkey"), n.cast("int").alias("c_nationkey")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(A, "GAME_ROWS_PER_TASK", 100, raising=False)
    details = A.game_details(Tables(spark, str(tmp_path)))
    most = details.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 250  # a thousand and more, in the session's 4 partitions
    got = sorted(map(tuple, grain_check(details, ["game_id", "team_id", "player_id"]).collect()))
    assert got == [(g, g % 3, 0, 2) for g in range(0, 800, 10)]
    # the planner's own join has the same rows
    assertDataFrameEqual(A.game_details(Tables(spark, str(tmp_path)), by_game=False), details)
