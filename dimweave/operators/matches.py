"""Match analytics over bucketed / broadcast joins, the shared-aggregate
rollups, and event enrichment with device attributes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.functions.columns import MISSING_REFERRER
from dimweave.operators.joins import broadcast_if_small, tasks_for
from dimweave.session import scratch_path

MATCH_BUCKETS = 16
BUCKET_ROWS = 250_000
SMALL_DIM_ROWS = 1_000_000


def write_bucketed(df: DataFrame, table: str, key: str = "match_id", buckets: int = MATCH_BUCKETS,
                   sort: bool = True, path: str | None = None) -> DataFrame:
    """Save ``df`` as a table bucketed (and sorted) on ``key`` and return it.
    Tables that share bucket count and key are joined later without any
    exchange: the rows are placed once, here, one file per bucket.  With
    ``path`` the files lie there instead of in the warehouse."""
    w = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def bucketed_matches(details: DataFrame, matches: DataFrame, medals_mp: DataFrame,
                     buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three match tables in ``buckets`` buckets by match_id, as catalog
    tables with fresh names and files in the shared folder.  ``buckets`` is the
    parallelism of every join over them: by default 16, and the multiple of 16
    that the largest table's rows ask for (``tasks_for``), so that a bucket
    doesn't grow with the tables."""
    spark = details.sparkSession
    if buckets is None:
        buckets = MATCH_BUCKETS * -(-tasks_for(BUCKET_ROWS, details, matches, medals_mp) // MATCH_BUCKETS)
    run = uuid.uuid4().hex[:12]
    parts = {"match_details": details, "matches": matches, "medals_matches_players": medals_mp}
    return tuple(
        write_bucketed(df, f"{name}_{run}", buckets=buckets, path=scratch_path(spark, name)) for name, df in parts.items()
    )


def details_on_day(details: DataFrame, matches: DataFrame, day) -> DataFrame:
    """Box-score rows of the matches completed on ``day``: the date belongs to
    the join condition and reaches the scan of the matches."""
    d, m = details.alias("d"), matches.alias("m")
    on = (F.col("d.match_id") == F.col("m.match_id")) & (F.col("m.completion_date") == F.lit(day))
    return d.join(m, on).select("d.*", "m.playlist_id", "m.mapid", "m.completion_date")


def match_frame(details: DataFrame, matches: DataFrame, medals_mp: DataFrame, medals: DataFrame, medal: str) -> DataFrame:
    """Per (match, player): kills and appearances, with the match's playlist,
    map and number of medals named ``medal``.  ``counts`` marks one row of each
    match, the one that stands for it; a match without players has one row
    with a null player.  Over tables of ``bucketed_matches`` neither the joins
    nor the aggregates move a row."""
    wanted = broadcast_if_small(medals.filter(F.col("name") == medal).select("medal_id").distinct(), SMALL_DIM_ROWS)
    earned = medals_mp.join(wanted, "medal_id", "left_semi").groupBy("match_id").agg(F.sum("count").alias("n_medals"))
    per_player = details.groupBy("match_id", "player_gamertag").agg(
        F.sum("player_total_kills").alias("kills"), F.count("player_total_kills").alias("games")
    )
    frame = matches.select("match_id", "playlist_id", "mapid").join(per_player, "match_id", "left").join(earned, "match_id", "left")
    first = Window.partitionBy("match_id").orderBy("player_gamertag")
    return frame.withColumn("counts", (F.row_number().over(first) == 1).cast("int"))


def match_tops(details, matches, medals_mp, medals, maps, medal: str) -> DataFrame:
    """Four top-1 reports as (metric, winner, value) rows: the player with the
    highest average kills per appearance, the playlist and the map of the most
    matches, the map on which the named medal is earned most often; ties go to
    the smallest name.  All four come from one pass over the joined frame, by
    grouping sets; the limit of one row per metric is the feature."""
    frame = match_frame(details, matches, medals_mp, medals, medal)
    names = broadcast_if_small(maps.select("mapid", F.col("name").alias("map_name")), SMALL_DIM_ROWS)
    played = F.when(F.col("player_gamertag").isNotNull() & (F.col("counts") == 1), 1).otherwise(0)
    sums = (
        frame.join(names, "mapid", "left")
        .groupingSets([["player_gamertag"], ["playlist_id"], ["map_name"]], "player_gamertag", "playlist_id", "map_name")
        .agg(
            (F.sum("kills") / F.sum("games")).alias("average"),
            F.sum(played).alias("matches"),
            F.sum(F.when(F.col("counts") == 1, F.col("n_medals"))).alias("medals"),
            F.grouping_id().alias("level"),
        )
    )

    def metric(name: str, level: int, winner: str, value: str) -> Column:
        of_level = (F.col("level") == level) & F.col(winner).isNotNull() & F.col(value).isNotNull() & (F.col(value) > 0)
        row = F.struct(F.lit(name).alias("metric"), F.col(winner).cast("string").alias("winner"), F.col(value).cast("double").alias("value"))
        return F.when(of_level, row)

    metrics = F.array(
        metric("player_avg_kills", 0b011, "player_gamertag", "average"),
        metric("top_playlist", 0b101, "playlist_id", "matches"),
        metric("top_map", 0b110, "map_name", "matches"),
        metric(f"top_map_for_medal:{medal}", 0b110, "map_name", "medals"),
    )
    rows = sums.select(F.inline(F.array_compact(metrics)))
    best = Window.partitionBy("metric").orderBy(F.desc("value"), "winner")
    return rows.withColumn("nth", F.row_number().over(best)).filter("nth = 1").drop("nth")


# -- C44: one cached aggregate, two rollups -----------------------------------


def events_aggregated(events: DataFrame) -> DataFrame:
    """(user, device): event count and the distinct hosts (a set bounded by
    the number of hosts)."""
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "device_id")
        .agg(F.count(F.lit(1)).alias("event_counts"), F.array_sort(F.collect_set("host")).alias("host_array"))
    )


def users_and_devices(agg: DataFrame) -> DataFrame:
    """Per user, from the aggregate (not re-joined with raw events, which
    would repeat every device once per event): largest per-device count,
    true total and number of devices."""
    return agg.groupBy("user_id").agg(
        F.max("event_counts").alias("max_device_hits"),
        F.sum("event_counts").alias("total_hits"),
        F.count(F.lit(1)).alias("n_devices"),
    )


def devices_on_events(devices: DataFrame, agg: DataFrame) -> DataFrame:
    """Per device: its type, number of users and events.  Users stay in long
    form (``agg``); collecting them per device would put a popular device's
    whole audience in one row."""
    d = devices.select("device_id", "device_type")
    j = d.join(agg.select("device_id", "user_id", "event_counts"), "device_id")
    return j.groupBy("device_id", "device_type").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("event_counts").alias("n_events")
    )


def rollups(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Both rollups from one aggregate that is computed once: rows (kind, id,
    label, n, hits) with the users (n devices) and the devices (n users).  The
    aggregate is written to the shared folder once and read twice: nothing
    stays cached, and a lost executor costs nothing that is written."""
    spark = events.sparkSession
    path = scratch_path(spark, "events_aggregated")
    events_aggregated(events).write.parquet(path)
    agg = spark.read.parquet(path)
    users = users_and_devices(agg).select(
        F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.lit(None).cast("string").alias("label"),
        F.col("n_devices").alias("n"), F.col("total_hits").alias("hits"),
    )
    by_device = devices_on_events(devices, agg).select(
        F.lit("device").alias("kind"), F.col("device_id").alias("id"), F.col("device_type").alias("label"),
        F.col("n_users").alias("n"), F.col("n_events").alias("hits"),
    )
    return users.unionByName(by_device)


# -- C45: enrichment -----------------------------------------------------------


def enrich_events(events: DataFrame, devices: DataFrame, how: str = "inner",
                  max_broadcast_rows: int | None = SMALL_DIM_ROWS) -> DataFrame:
    """Events with device attributes: rows without user or device dropped,
    browser upper-cased, missing referrer defaulted.  ``how='left'`` keeps
    events whose device is unknown and renames browser/os to *_family."""
    ev = events.filter(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())
    d = devices.select("device_id", "browser_type", "os_type", "device_type")
    if max_broadcast_rows is not None:
        d = broadcast_if_small(d, max_broadcast_rows)
    j = ev.join(d, "device_id", how)
    out = j.select(
        "user_id", "device_id",
        F.upper("browser_type").alias("browser_type"), "os_type", "device_type",
        F.coalesce("referrer", F.lit(MISSING_REFERRER)).alias("referrer"),
        "host", "url", "event_time",
    )
    if how == "left":
        out = out.withColumnsRenamed({"browser_type": "browser_family", "os_type": "os_family"})
    return out
