"""Box-score patterns: de-duplication to a grain, grain checks,
grouping-sets rollups, best N-game stretch, longest scoring streak."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(
    df: DataFrame,
    grain: Sequence[str],
    order: Sequence[tuple[str, bool]] | None = None,
) -> DataFrame:
    """One row per ``grain``: the first row by a total order, given as
    (column, ascending) pairs -- default every other column ascending -- so
    the result never depends on input order.  NULLs sort first when
    ascending, last when descending.

    One shuffle on the grain.  Spark pushes the rank limit below it (a group
    limit per map task), so a key that holds a third of all rows sends one row
    per map task to the task that ranks it."""
    if order is None:
        order = [(c, True) for c in df.columns if c not in grain]
    spec = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    w = Window.partitionBy(*grain).orderBy(*(spec or [F.lit(0)]))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def grain_check(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def details_with_results(details: DataFrame, games: DataFrame) -> DataFrame:
    """Box scores joined to their game, with ``won`` for the player's team."""
    g = games.select("game_id", "season", "game_date_est", "home_team_id", "visitor_team_id", "home_team_wins")
    j = details.join(g, "game_id")
    won = ((F.col("team_id") == F.col("home_team_id")) & (F.col("home_team_wins") == 1)) | (
        (F.col("team_id") == F.col("visitor_team_id")) & (F.col("home_team_wins") == 0)
    )
    return j.withColumn("won", won)


def game_rollups(details: DataFrame, games: DataFrame) -> DataFrame:
    """GROUPING SETS ((player, team), (player, season), (team)): points and
    games won (distinct games, not box-score rows)."""
    j = details_with_results(details, games)
    g = j.groupingSets(
        [["player_id", "team_id"], ["player_id", "season"], ["team_id"]], "player_id", "team_id", "season"
    ).agg(
        F.sum("pts").alias("points"),
        F.countDistinct(F.when(F.col("won"), F.col("game_id"))).alias("games_won"),
        F.grouping("player_id").alias("_gp"),
        F.grouping("team_id").alias("_gt"),
        F.grouping("season").alias("_gs"),
    )
    level = (
        F.when((F.col("_gp") == 0) & (F.col("_gt") == 0), "player_team")
        .when((F.col("_gp") == 0) & (F.col("_gs") == 0), "player_season")
        .otherwise("team")
    )
    return g.select(level.alias("aggregation_level"), "player_id", "team_id", "season", "points", "games_won")


def team_games(games: DataFrame) -> DataFrame:
    """One row per (team, game): the home and the visitor side of each game,
    with ``won``, from a single pass over the games."""
    home_won = (F.col("home_team_wins") == 1).cast("int")
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), home_won.alias("won")),
        F.struct(F.col("visitor_team_id").alias("team_id"), (F.lit(1) - home_won).alias("won")),
    )
    return games.select("game_id", "game_date_est", F.inline(sides))


def best_stretch(games: DataFrame, n: int = 90) -> DataFrame:
    """Most wins of each team in any ``n`` consecutive games (ordered by date,
    then game id; a window shorter than ``n`` at the start counts what it has).

    Games are summarised per (team, month): their number and wins, the best
    ``n`` in a row inside, and the first and last ``n`` - 1 results.  Such
    summaries combine associatively -- what lies across two of them is in the
    end of one and the beginning of the next -- so a team's history is folded
    from one small row per month, whatever the number of its games.  Two
    shuffles: one by (team, month), one of the summaries."""
    tg = team_games(games).withColumn("_bucket", F.trunc("game_date_est", "MM"))
    ordered = Window.partitionBy("team_id", "_bucket").orderBy("game_date_est", "game_id")
    whole = Window.partitionBy("team_id", "_bucket")
    rows = tg.select(
        "team_id", "_bucket", "won",
        F.row_number().over(ordered).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_n"),
        F.sum("won").over(ordered.rowsBetween(1 - n, 0)).alias("_last"),
    )
    result = F.struct("_rn", "won")
    buckets = rows.groupBy("team_id", "_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("won").alias("wins"),
        F.max(F.when(F.col("_rn") >= n, F.col("_last"))).alias("best"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_rn") < n, result))), lambda r: r["won"]).alias("first"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_rn") > F.col("_n") - (n - 1), result))), lambda r: r["won"]).alias("last"),
    )
    months = buckets.groupBy("team_id").agg(F.array_sort(F.collect_list(F.struct("_bucket", "n", "wins", "best", "first", "last"))).alias("months"))
    start = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("wins"), F.lit(0).cast("long").alias("best"),
        F.array().cast("array<int>").alias("last"),
    )

    def step(s: Column, m: Column) -> Column:
        across = F.concat(s["last"], m["first"])
        tail = F.when(m["n"] >= n - 1, m["last"]).otherwise(F.concat(s["last"], m["first"]))
        size = F.size(tail)
        return F.struct(
            (s["n"] + m["n"]).alias("n"),
            (s["wins"] + m["wins"]).alias("wins"),
            F.greatest(s["best"], F.coalesce(m["best"], F.lit(0)), _best_window(across, n)).cast("long").alias("best"),
            F.slice(tail, F.greatest(size - (n - 2), F.lit(1)), F.lit(n - 1)).alias("last"),
        )

    # fewer games than n: all of them are the best window
    total = F.aggregate("months", start, step, lambda s: F.when(s["n"] < n, s["wins"]).otherwise(s["best"]))
    return months.select("team_id", total.cast("long").alias("best_wins"))


def _best_window(values: Column, n: int) -> Column:
    """Largest sum of ``n`` values in a row (0 for fewer): one pass with a
    running sum."""
    positions = F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("best"))

    def step(s: Column, p: Column) -> Column:
        out = F.when(p["i"] >= n, F.get(values, p["i"] - n)).otherwise(F.lit(0))
        run = (s["run"] + p["v"] - out).cast("long")
        return F.struct(run.alias("run"), F.when(p["i"] >= n - 1, F.greatest(s["best"], run)).otherwise(s["best"]).alias("best"))

    return F.aggregate(positions, start, step, lambda s: s["best"])


def longest_streak(details: DataFrame, games: DataFrame, min_pts: float = 10.0, player=None) -> DataFrame:
    """Longest run of consecutive games (by date, game id) with pts > min_pts
    per player.  Games without a score (NULL pts) are skipped, neither
    breaking nor extending a run.  Of several rows of one player's game those
    that break a run come first.  Ties: the earliest run.  Returns players
    with at least one qualifying game.

    Games are summarised per (player, month): the run they begin with, the run
    they end with, the best run and whether nothing else happened.  Summaries
    combine associatively, so a player's history is folded from one row per
    month.  Two shuffles behind the join: one by (player, month), one of the
    summaries."""
    g = games.select("game_id", "game_date_est")
    if player is not None:
        details = details.filter(F.col("player_id") == F.lit(player))
    scored = details.filter(F.col("pts").isNotNull()).join(g, "game_id")
    good = F.col("pts") > min_pts
    marked = scored.select("player_id", F.trunc("game_date_est", "MM").alias("_bucket"), "game_date_est", "game_id", good.alias("_good"))
    ordered = Window.partitionBy("player_id", "_bucket").orderBy("game_date_est", "game_id", "_good").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("player_id", "_bucket")
    broken = marked.withColumn("_breaks", F.sum((~F.col("_good")).cast("int")).over(ordered)).withColumn(
        "_all", F.sum((~F.col("_good")).cast("int")).over(whole)
    )
    # rows that break a run keep their month's summary alive as run -1
    island = F.when(F.col("_good"), F.col("_breaks")).otherwise(-1)
    day = F.when(F.col("_good"), F.col("game_date_est"))
    runs = broken.groupBy("player_id", "_bucket", island.alias("_breaks"), "_all").agg(
        F.sum(F.col("_good").cast("long")).alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi")
    )
    run = F.struct("n", "lo", "hi")
    buckets = runs.groupBy("player_id", "_bucket").agg(
        F.max("_all").alias("breaks"),
        F.max(F.when(F.col("_breaks") == 0, run)).alias("first"),
        F.max(F.when(F.col("_breaks") == F.col("_all"), run)).alias("last"),
        F.max_by(F.when(F.col("n") > 0, run), F.when(F.col("n") > 0, _rank(run))).alias("best"),
    )
    months = buckets.groupBy("player_id").agg(F.array_sort(F.collect_list(F.struct("_bucket", "breaks", "first", "last", "best"))).alias("months"))
    empty = F.lit(None).cast("struct<n:bigint,lo:date,hi:date>")

    def joined(a: Column, b: Column) -> Column:
        both = F.struct((a["n"] + b["n"]).alias("n"), a["lo"].alias("lo"), b["hi"].alias("hi"))
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)

    def better(a: Column, b: Column) -> Column:
        return F.when(a.isNull(), b).when(b.isNull(), a).when(_rank(b) > _rank(a), b).otherwise(a)

    def step(s: Column, m: Column) -> Column:
        across = joined(s["open"], m["first"])
        still = F.when(m["breaks"] == 0, across).otherwise(m["last"])
        return F.struct(still.alias("open"), better(better(s["best"], across), m["best"]).alias("best"))

    best = F.aggregate("months", F.struct(empty.alias("open"), empty.alias("best")), step, lambda s: s["best"])
    out = months.select("player_id", best.alias("_b")).filter(F.col("_b").isNotNull() & (F.col("_b.n") > 0))
    return out.select("player_id", F.col("_b.n").alias("streak_len"), F.col("_b.lo").alias("start_date"), F.col("_b.hi").alias("end_date"))


def _rank(run: Column) -> Column:
    """Longest, then earliest start, then earliest end."""
    epoch = F.lit("1970-01-01")
    return F.struct(run["n"], F.negative(F.datediff(run["lo"], epoch)), F.negative(F.datediff(run["hi"], epoch)))
