"""Property graph from box scores: vertices (identifier, type, properties)
and edges (subject, object, edge_type, properties)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.functions.columns import json_object, string_map
from dimweave.operators.joins import salted_join
from dimweave.operators.sports import dedupe


def team_vertices(teams: DataFrame) -> DataFrame:
    """One vertex per team id.  Duplicate team rows are resolved by a total
    order -- shortest nickname first, then the attributes ascending.  Equal
    rows are merged before anything is ordered (a hash aggregate that combines
    map-side), so a team present in a third of all rows costs nothing."""
    attributes = ["team_id", "nickname", "abbreviation", "city", "arena", "yearfounded"]
    keyed = teams.select(*attributes).distinct().withColumn("_nick_len", F.length("nickname"))
    order = [("_nick_len", True)] + [(c, True) for c in ("nickname", "abbreviation", "city", "arena", "yearfounded")]
    d = dedupe(keyed, ["team_id"], order)
    return d.select(
        F.col("team_id").alias("identifier"),
        F.lit("team").alias("type"),
        string_map(
            ("abbreviation", F.col("abbreviation")),
            ("nickname", F.col("nickname")),
            ("city", F.col("city")),
            ("arena", F.col("arena")),
            ("year_founded", F.col("yearfounded")),
        ).alias("properties"),
    )


def player_vertices(details: DataFrame) -> DataFrame:
    """One vertex per player: name, games played, total points, teams (from
    one box-score row per player and game)."""
    g = _one_row_per_player_game(details).groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.countDistinct("game_id").alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.array_join(F.array_sort(F.collect_set(F.col("team_id").cast("string"))), ",").alias("teams"),
    )
    return g.select(
        F.col("player_id").alias("identifier"),
        F.lit("player").alias("type"),
        string_map(
            ("player_name", F.col("player_name")),
            ("number_of_games", F.col("number_of_games")),
            ("total_points", F.col("total_points").cast("decimal(18,2)")),
            ("teams", F.col("teams")),
        ).alias("properties"),
    )


def game_vertices(games: DataFrame) -> DataFrame:
    """One vertex per game: season, teams and winner."""
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return games.select(
        F.col("game_id").alias("identifier"),
        F.lit("game").alias("type"),
        string_map(
            ("season", F.col("season")),
            ("home_team_id", F.col("home_team_id")),
            ("visitor_team_id", F.col("visitor_team_id")),
            ("winning_team", winner),
        ).alias("properties"),
    )


def _one_row_per_player_game(details: DataFrame) -> DataFrame:
    """The reference keeps an arbitrary row per (player, game); we keep the
    highest-scoring one, ties broken by the remaining columns."""
    order = [("pts", False)] + [(c, True) for c in details.columns if c not in ("player_id", "game_id", "pts")]
    return dedupe(details, ["player_id", "game_id"], order)


def plays_in_edges(details: DataFrame) -> DataFrame:
    """player -plays_in-> game, properties as JSON (start position, points,
    team)."""
    d = _one_row_per_player_game(details)
    return d.select(
        F.col("player_id").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("game_id").alias("object_identifier"),
        F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_object(
            ("start_position", F.col("start_position")),
            ("pts", F.col("pts")),
            ("team_id", F.col("team_id")),
            ("team_abbreviation", F.col("team_abbreviation")),
        ).alias("properties"),
    )


def plays_on_edges(details: DataFrame) -> DataFrame:
    """player -plays_on-> team, with the number of games together."""
    d = _one_row_per_player_game(details)
    g = d.groupBy("player_id", "team_id").agg(F.count(F.lit(1)).alias("num_games"))
    return g.select(
        F.col("player_id").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("team_id").alias("object_identifier"),
        F.lit("team").alias("object_type"),
        F.lit("plays_on").alias("edge_type"),
        json_object(("num_games", F.col("num_games"))).alias("properties"),
    )


#: Players of a block: a game's pairs are computed in tiles of two blocks.
BLOCK_PLAYERS = 256


def player_pair_edges(details: DataFrame, block_players: int = BLOCK_PLAYERS) -> DataFrame:
    """player -shares_team / plays_against-> player per game pair, aggregated
    over games: number of games and each side's points.

    The edge set is by definition the co-occurring pairs.  A game's roster is
    cut into blocks of about ``block_players`` players, as many as its size
    asks for, and the pairs of blocks (i, j), i <= j, are the join's keys:
    every pair meets in exactly one tile, and no task holds more of a game than
    two blocks, however many players it has.  An ordinary game is one block and
    one tile.  The tiles are shuffled once (both sides of the self-join read
    the same shuffle) and pairs are partially aggregated in the joining task."""
    d = _one_row_per_player_game(details).select("game_id", "player_id", "player_name", "team_abbreviation", "pts")
    return _aggregate_pairs(_pairs(roster_tiles(d, block_players, rows=details)))


def roster_tiles(d: DataFrame, block_players: int = BLOCK_PLAYERS, rows: DataFrame | None = None) -> DataFrame:
    """The rows of each game once per tile of their block: columns _block,
    _low and _high (the tile's two blocks).

    Games are sized by the number of their ``rows`` (default: ``d``), box
    scores that may repeat, so nothing has to be deduplicated a second time to
    be counted.  P players with R rows make at most R * max(1, P / block) tile
    rows, and the pairs don't depend on the number of blocks.  The sizes of
    games of more than one block meet the rows in a salted join, so a game that
    holds a third of all rows is spread over many tasks here, too."""
    counted = d if rows is None else rows
    sizes = counted.groupBy("game_id").agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > block_players)
    blocks = sizes.select("game_id", F.ceil(F.col("_k") / block_players).cast("int").alias("_n"))
    sized = salted_join(d, blocks, ["game_id"], salt_of=["player_id"], how="left")
    n = F.coalesce("_n", F.lit(1))
    own = sized.withColumn("_block", F.pmod(F.xxhash64("player_id"), n).cast("int"))
    others = F.explode(F.sequence(F.lit(0), n - 1))
    tiles = own.withColumn("_other", others)
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    return tiles.select(*d.columns, "_block", low.alias("_low"), high.alias("_high"))


def _pairs(tiles: DataFrame) -> DataFrame:
    """Pairs of rows of one tile, one orientation, distinct names, with the
    edge type.  Two players of one block meet in its own tile only."""
    a, b = tiles.alias("a"), tiles.alias("b")
    cond = F.col("a.player_id") > F.col("b.player_id")
    for k in ("game_id", "_low", "_high"):
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    cond = cond & ((F.col("a._low") == F.col("a._high")) | (F.col("a._block") != F.col("b._block")))
    cond = cond & (F.col("a.player_name") != F.col("b.player_name"))
    return a.join(b, cond).select(
        F.col("a.player_id").alias("subject"), F.col("a.player_name").alias("subject_name"),
        F.col("b.player_id").alias("object"), F.col("b.player_name").alias("object_name"),
        F.when(F.col("a.team_abbreviation") == F.col("b.team_abbreviation"), "shares_team")
        .otherwise("plays_against").alias("edge_type"),
        F.col("a.pts").alias("_lp"), F.col("b.pts").alias("_rp"),
    )


def _aggregate_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("subject", "subject_name", "object", "object_name", "edge_type").agg(
        F.count(F.lit(1)).alias("num_games"), F.sum("_lp").alias("left_points"), F.sum("_rp").alias("right_points")
    )
