"""Cumulative snapshot tables: one row per (entity, period) carrying the whole
history in an array.

Every table has two forms:

* ``*_step(prev, source, period)`` -- the daily/yearly increment: the
  previous snapshot full-joined with the new period's facts.
* ``*_history(source, upto)`` -- every period at once.  Facts are grouped
  once per entity into a sorted list (bounded by the number of periods, never
  by event volume), the period spine is generated per entity with
  ``sequence`` inside that partition, and each snapshot row filters the list.
  No loop over periods, no cross join with a calendar, one shuffle.

Folding the step from the first period equals the history form (tested).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.columns import (
    no_later,
    on_day,
    ACTOR_CLASSES,
    ACTOR_FALLBACK,
    PLAYER_CLASSES,
    PLAYER_FALLBACK,
    first_element,
    last_element,
    safe_ratio,
    threshold_class,
)

PLAYER_STATICS = ["height", "college", "country", "draft_year", "draft_round", "draft_number"]
PLAYER_STATS = ["season", "gp", "pts", "reb", "ast"]


def _lit_date(d: str | dt.date) -> Column:
    return F.to_date(F.lit(str(d)))


def _empty(typ: str) -> Column:
    return F.array().cast(f"array<{typ}>")


def merge_period(
    prev: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    list_col: str,
    newest_first: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """keys and ``list_col``: the previous snapshot's lists, with the entry
    that ``today`` (keys, _entry) has for a key added at its newest end.  With
    ``carry``, also _was (those columns of the previous row) and _now (a struct
    of today's); null where the key has no such row."""
    empty = F.array().cast(prev.schema[list_col].dataType)
    old = F.coalesce(F.col("_old"), empty)
    new = F.when(F.col("_entry").isNotNull(), F.array("_entry")).otherwise(empty)
    was = [F.struct(*carry).alias("_was")] if carry else []
    sides = prev.select(*keys, F.col(list_col).alias("_old"), *was).join(
        today.select(*keys, "_entry", *(["_now"] if carry else [])), list(keys), "full"
    )
    merged = (F.concat(new, old) if newest_first else F.concat(old, new)).alias(list_col)
    return sides.select(*keys, merged, *(["_was", "_now"] if carry else []))


# ---------------------------------------------------------------------------
# players
# ---------------------------------------------------------------------------


def cumulate_step(
    prev: DataFrame,
    today: DataFrame,
    period: int,
    key: str = "player_name",
    statics: Sequence[str] = PLAYER_STATICS,
    stats: Sequence[str] = PLAYER_STATS,
    period_col: str = "season",
    class_col: str = "pts",
    classes=PLAYER_CLASSES,
    fallback: str = PLAYER_FALLBACK,
    statics_rule: str = "first",
) -> DataFrame:
    """The snapshot of one season from the one before it.

    | known before | plays now | seasons  | class        | years since | active |
    |--------------|-----------|----------|--------------|-------------|--------|
    | no           | yes       | one      | from today   | 0           | yes    |
    | yes          | yes       | appended | from today   | 0           | yes    |
    | yes          | no        | kept     | carried      | one more    | no     |

    A static keeps its earliest known value (``statics_rule='first'``) or
    takes the newest known one ('latest')."""
    if statics_rule not in ("first", "latest"):
        raise ValueError(statics_rule)
    facts = today.filter(F.col(period_col) == period).select(
        key, F.struct(*stats).alias("_entry"), F.struct(*statics, threshold_class(F.col(class_col), classes, fallback).alias("_class")).alias("_now")
    )
    kept = [*statics, "scoring_class", "years_since_last_active"]
    merged = merge_period(prev, facts, [key], "seasons", carry=kept)
    by_rule = ("_was", "_now") if statics_rule == "first" else ("_now", "_was")
    active = F.col("_now").isNotNull()
    idle = F.col("_was.years_since_last_active") + 1
    return merged.select(
        key,
        *[F.coalesce(*[F.col(f"{side}.{c}") for side in by_rule]).alias(c) for c in statics],
        "seasons",
        F.when(active, F.col("_now._class")).otherwise(F.col("_was.scoring_class")).alias("scoring_class"),
        F.when(active, 0).otherwise(idle).alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period).cast("int").alias("current_season"),
    )


def cumulate_history(
    facts: DataFrame,
    upto: int | None = None,
    key: str = "player_name",
    statics: Sequence[str] = PLAYER_STATICS,
    stats: Sequence[str] = PLAYER_STATS,
    period_col: str = "season",
    class_col: str = "pts",
    classes=PLAYER_CLASSES,
    fallback: str = PLAYER_FALLBACK,
    periods: Sequence[int] | None = None,
) -> DataFrame:
    """Backfill of every season from each entity's first season to ``upto``
    (default: the last season in the facts), or only the ``periods``
    snapshots.  Statics are MAX per entity, class from the newest season so
    far, ``years_since_last_active`` = season - newest season, ``is_active``
    = played this season."""
    per_entity = no_later(facts, period_col, upto).groupBy(key).agg(
        *[F.max(c).alias(c) for c in statics],
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in stats]))).alias("_all"),
    )
    # the default bound comes from the aggregate itself, so the scalar
    # subquery reuses its exchange instead of recomputing the facts
    upto_col = per_entity.agg(F.max(last_element("_all")[period_col])).scalar() if upto is None else F.lit(upto)
    s = F.col("current_season")
    first_period = first_element("_all")[period_col]
    if periods is None:
        seasons = F.sequence(first_period, upto_col.cast("int"))
    else:
        per_entity = per_entity.withColumn("_upto", upto_col.cast("int"))
        wanted = F.array(*[F.lit(int(p)) for p in periods])
        seasons = F.filter(wanted, lambda p: (p >= first_period) & (p <= F.col("_upto")))
    spine = per_entity.select(*[c for c in per_entity.columns if c != "_upto"],
                              F.explode(seasons).alias("current_season"))
    hist = F.filter("_all", lambda x: x[period_col] <= s)
    spine = spine.withColumn("seasons", hist).withColumn("_last", last_element("seasons"))
    return spine.select(
        key,
        *statics,
        "seasons",
        threshold_class(F.col("_last")[class_col], classes, fallback).alias("scoring_class"),
        (s - F.col("_last")[period_col]).cast("int").alias("years_since_last_active"),
        (F.col("_last")[period_col] == s).alias("is_active"),
        s.cast("int").alias("current_season"),
    )


def improvement_ratio(snap: DataFrame, period: int, key: str = "player_name", field: str = "pts") -> DataFrame:
    """Newest season's value over the first season's (a zero first value
    counts as 1) for one snapshot period."""
    cur = snap.filter(F.col("current_season") == period)
    latest = last_element("seasons")[field]
    first = first_element("seasons")[field]
    first_or_one = F.when(first == 0, F.lit(1.0)).otherwise(first)
    return cur.select(
        key,
        latest.alias("latest"),
        first_or_one.alias("first"),
        safe_ratio(latest, first_or_one).alias("ratio"),
    )


def unnest_history(snap: DataFrame, period: int, key: str = "player_name", key_filter=None) -> DataFrame:
    """One row per season held in the snapshot of ``period``."""
    cur = snap.filter(F.col("current_season") == period)
    if key_filter is not None:
        cur = cur.filter(F.col(key).isin(list(key_filter)))
    return cur.select(key, F.inline("seasons"))


# ---------------------------------------------------------------------------
# actors
# ---------------------------------------------------------------------------

FILM_FIELDS = ["film", "votes", "rating", "filmid"]


def _years_of_films(films: DataFrame, with_films: bool) -> DataFrame:
    """(actor, year, avg_rating[, films]): one aggregation; a year's films are
    sorted by their fields."""
    entries = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in FILM_FIELDS])))
    return films.groupBy("actor", "year").agg(
        F.avg("rating").alias("avg_rating"), *([entries.alias("films")] if with_films else [])
    )


def actors_step(prev: DataFrame, films: DataFrame, year: int) -> DataFrame:
    """One year of the actors table: an actor with films in ``year`` is
    active, gets them appended and the class of their average rating; the
    others keep list and class."""
    today = _years_of_films(films.filter(F.col("year") == year), True)
    today = today.select("actor", F.col("films").alias("_new"), "avg_rating")
    both = prev.select("actor", F.col("films").alias("_old"), "quality_class").join(today, "actor", "full")
    empty = F.array().cast(prev.schema["films"].dataType)
    active = F.col("_new").isNotNull()
    fresh = threshold_class("avg_rating", ACTOR_CLASSES, ACTOR_FALLBACK)
    return both.select(
        "actor",
        F.concat(F.coalesce("_old", empty), F.coalesce("_new", empty)).alias("films"),
        F.when(active, fresh).otherwise(F.col("quality_class")).alias("quality_class"),
        active.alias("is_active"),
        F.lit(year).cast("int").alias("current_year"),
    )


def actors_history(
    films: DataFrame, upto: int | None = None, periods: Sequence[int] | None = None, with_films: bool = True
) -> DataFrame:
    """Every year of the actors table up to ``upto`` at once (or only
    ``periods``).

    The films are read once: one aggregation by (actor, year) gives each
    year's average rating and, unless an SCD over quality and activity skips
    them, its films; one by actor puts the years in order.  A snapshot takes
    the years up to its own, so what is filtered per row is a list of years,
    not of films."""
    per_year = _years_of_films(no_later(films, "year", upto), with_films)
    entry = F.struct("year", "avg_rating", *(["films"] if with_films else []))
    per_actor = per_year.groupBy("actor").agg(F.array_sort(F.collect_list(entry)).alias("_years"))
    last_year = per_actor.agg(F.max(last_element("_years")["year"])).scalar() if upto is None else F.lit(upto)
    first_year = first_element("_years")["year"]
    if periods is None:
        years = F.sequence(first_year, last_year.cast("int"))
    else:
        per_actor = per_actor.withColumn("_upto", last_year.cast("int"))
        wanted = F.array(*[F.lit(int(p)) for p in periods])
        years = F.filter(wanted, lambda p: (p >= first_year) & (p <= F.col("_upto")))
    y = F.col("current_year")
    spine = per_actor.select("actor", "_years", F.explode(years).alias("current_year"))
    spine = spine.select("actor", y, F.filter("_years", lambda e: e["year"] <= y).alias("_past"))
    newest = last_element("_past")
    cols = [
        threshold_class(newest["avg_rating"], ACTOR_CLASSES, ACTOR_FALLBACK).alias("quality_class"),
        (newest["year"] == y).alias("is_active"),
        y.cast("int").alias("current_year"),
    ]
    if with_films:
        cols.insert(0, F.flatten(F.transform("_past", lambda e: e["films"])).alias("films"))
    return spine.select("actor", *cols)


# ---------------------------------------------------------------------------
# users_cumulated (dates active, oldest first)
# ---------------------------------------------------------------------------


def _distinct_active(events: DataFrame, keys: Sequence[str], require_user: bool = True) -> DataFrame:
    if require_user:
        events = events.filter(F.col("user_id").isNotNull())
    return events.select(*keys, F.col("event_date").alias("d")).distinct()


def _active_on(events: DataFrame, keys: Sequence[str], day: str | dt.date, require_user: bool = True) -> DataFrame:
    """keys active on ``day``, each with the day as the list's new entry."""
    today = _distinct_active(on_day(events, day), keys, require_user)
    return today.select(*keys, F.col("d").alias("_entry"))


def dates_active_step(prev: DataFrame, events: DataFrame, day: str | dt.date) -> DataFrame:
    """The snapshot of ``day`` from the newest one before it: active users get
    the day appended, the others carry their list; all rows bear ``day``, also
    where days have been skipped."""
    merged = merge_period(prev, _active_on(events, ["user_id"], day), ["user_id"], "dates_active")
    return merged.select("user_id", "dates_active", _lit_date(day).alias("date"))


def _keyed_history(
    events: DataFrame, keys: Sequence[str], upto, newest_first: bool, list_name: str, date_name: str,
    require_user: bool = True, periods=None,
):
    if require_user:
        events = events.filter(F.col("user_id").isNotNull())
    events = no_later(events, "event_date", upto)
    per_key = events.groupBy(*keys).agg(F.array_sort(F.collect_set("event_date")).alias("_days"))
    upto_col = per_key.agg(F.max(last_element("_days"))).scalar() if upto is None else _lit_date(upto)
    s = F.col(date_name)
    if periods is None:
        dates = F.sequence(first_element("_days"), upto_col, F.expr("INTERVAL 1 DAY"))
    else:
        # only the requested snapshot days (scalar subqueries may not sit
        # inside a higher-order function, so the bound is a column first)
        per_key = per_key.withColumn("_upto", upto_col)
        wanted = F.array(*[_lit_date(p) for p in periods])
        dates = F.filter(wanted, lambda p: (p >= first_element("_days")) & (p <= F.col("_upto")))
    spine = per_key.select(*keys, "_days", F.explode(dates).alias(date_name))
    lst = F.filter("_days", lambda x: x <= s)
    if newest_first:
        lst = F.reverse(lst)
    return spine.select(*keys, lst.alias(list_name), s)


def dates_active_history(events: DataFrame, upto: str | dt.date | None = None, periods=None) -> DataFrame:
    """users_cumulated for every day from each user's first activity (or
    only the ``periods`` snapshot days)."""
    return _keyed_history(events, ["user_id"], upto, False, "dates_active", "date", periods=periods)


# ---------------------------------------------------------------------------
# User x browser device datelist (newest first)
# ---------------------------------------------------------------------------


def _events_with_browser(events: DataFrame, devices: DataFrame) -> DataFrame:
    return events.join(devices.select("device_id", "browser_type"), "device_id")


def device_datelist_step(
    prev: DataFrame, events: DataFrame, devices: DataFrame, day: str | dt.date, as_map: bool = False
) -> DataFrame:
    """The snapshot of ``day``: (user, browser) pairs active on it get the day
    prepended, the others carry their list."""
    keys = ["user_id", "browser_type"]
    today = _active_on(_events_with_browser(on_day(events, day), devices), keys, day)
    out = merge_period(prev, today, keys, "device_activity_datelist", newest_first=True)
    out = out.withColumn("record_date", _lit_date(day))
    return device_datelist_as_map(out) if as_map else out


def device_datelist_history(
    events: DataFrame, devices: DataFrame, upto: str | dt.date | None = None, as_map: bool = False, periods=None
) -> DataFrame:
    ev = _events_with_browser(events, devices)
    out = _keyed_history(
        ev, ["user_id", "browser_type"], upto, True, "device_activity_datelist", "record_date", periods=periods
    )
    return device_datelist_as_map(out) if as_map else out


def device_datelist_as_map(long_form: DataFrame) -> DataFrame:
    """MAP<browser, ARRAY<DATE>> per (user, record_date).  The number of
    browsers per user bounds the collected group."""
    return long_form.groupBy("user_id", "record_date").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("browser_type", "device_activity_datelist")))
        ).alias("device_activity_datelist")
    )


# ---------------------------------------------------------------------------
# hosts_cumulated (newest first)
# ---------------------------------------------------------------------------


def host_datelist_init(events: DataFrame, day: str | dt.date) -> DataFrame:
    """The first snapshot: hosts active on ``day``."""
    today = _active_on(events, ["host"], day, require_user=False)
    return today.select("host", F.array("_entry").alias("host_activity_datelist"), F.col("_entry").alias("record_date"))


def host_datelist_step(prev: DataFrame, events: DataFrame, day: str | dt.date) -> DataFrame:
    """The rows of ``day`` only: hosts active on it get it prepended, the
    others carry their list.  Earlier rows stay in their own partitions."""
    today = _active_on(events, ["host"], day, require_user=False)
    merged = merge_period(prev, today, ["host"], "host_activity_datelist", newest_first=True)
    return merged.withColumn("record_date", _lit_date(day))


def host_datelist_history(events: DataFrame, upto: str | dt.date | None = None, periods=None) -> DataFrame:
    return _keyed_history(
        events, ["host"], upto, True, "host_activity_datelist", "record_date", require_user=False, periods=periods
    )
