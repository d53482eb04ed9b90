"""Folding each step operator over every period equals its set-based history
form (the invariant that lets a backfill replace a loop)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimweave.functions.columns import array_text
from dimweave.operators import arrays as AR
from dimweave.operators import cumulative as C
from dimweave.operators.growth import growth_accounting_history, growth_accounting_step
from dimweave.operators.scd import scd2_history, scd2_step
from dimweave.session import cut_lineage
from dimweave.sources import adapters as A


def _days(ev):
    lo, hi = ev.agg(F.min("event_date"), F.max("event_date")).first()
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def _fold(prev, steps, step_fn, every=5):
    """Apply ``step_fn(prev, period)`` for each period, collecting every
    snapshot; checkpoint every few steps so the plan stays shallow."""
    out = []
    for i, p in enumerate(steps):
        prev = step_fn(prev, p)
        if i % every == every - 1:
            prev = cut_lineage(prev)
        out.append(prev)
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


GA_SCHEMA = (
    "user_id bigint, first_active_date date, last_active_date date, daily_active_state string, "
    "weekly_active_state string, dates_active array<date>, date date"
)


@pytest.mark.parametrize("sparse", [False, True])
def test_growth_accounting_fold(spark, tables, sparse):
    ev = A.web_events(tables, sparse=sparse)
    empty = spark.createDataFrame([], GA_SCHEMA)
    folded = _fold(empty, _days(ev), lambda prev, d: growth_accounting_step(prev, ev, d))
    hist = growth_accounting_history(ev, upto=_days(ev)[-1])
    assertDataFrameEqual(folded, hist)
    if sparse:
        states = {r[0] for r in hist.select("daily_active_state").distinct().collect()}
        weekly = {r[0] for r in hist.select("weekly_active_state").distinct().collect()}
        assert states == {"New", "Retained", "Resurrected", "Churned", "Stale"}
        assert weekly == {"New", "Retained", "Resurrected", "Churned", "Stale"}


PLAYERS_SCHEMA = (
    "player_name string, height string, college string, country string, draft_year string, "
    "draft_round string, draft_number string, "
    "seasons array<struct<season:int,gp:bigint,pts:double,reb:double,ast:double>>, scoring_class string, "
    "years_since_last_active int, is_active boolean, current_season int"
)


def _flat_players(df):
    from dimweave.plans.q_cumulative import season_text

    return df.withColumn("seasons", array_text("seasons", season_text, "|"))


def test_players_fold(spark, tables):
    ps = A.player_seasons(tables)
    lo, hi = ps.agg(F.min("season"), F.max("season")).first()
    empty = spark.createDataFrame([], PLAYERS_SCHEMA)
    folded = _fold(empty, range(lo, hi + 1), lambda prev, s: C.cumulate_step(prev, ps, s))
    hist = C.cumulate_history(ps)
    assertDataFrameEqual(_flat_players(folded), _flat_players(hist))


def test_scd_fold(spark, tables):
    ps = A.player_seasons(tables)
    players = C.cumulate_history(ps)
    lo, hi = ps.agg(F.min("season"), F.max("season")).first()
    attrs = ["scoring_class", "is_active"]
    scd = scd2_history(players, "player_name", "current_season", attrs, upto=lo)
    for s in range(lo + 1, hi + 1):
        scd = cut_lineage(scd2_step(scd, players, "player_name", "current_season", attrs, s))
    assertDataFrameEqual(scd, scd2_history(players, "player_name", "current_season", attrs))


def test_scd_intervals_rebuild_snapshot(spark, tables):
    players = C.cumulate_history(A.player_seasons(tables))
    attrs = ["scoring_class", "is_active"]
    scd = scd2_history(players, "player_name", "current_season", attrs)
    rebuilt = scd.select(
        "player_name", *attrs, F.explode(F.sequence("start_period", "end_period")).alias("current_season")
    )
    # intervals per entity are disjoint, contiguous and give back every snapshot row
    assertDataFrameEqual(rebuilt, players.select("player_name", *attrs, "current_season"))


ACTORS_SCHEMA = (
    "actor string, films array<struct<film:string,votes:int,rating:double,filmid:string>>, "
    "quality_class string, is_active boolean, current_year int"
)


def test_actors_fold(spark, tables):
    films = A.actor_films(tables)
    lo, hi = films.agg(F.min("year"), F.max("year")).first()
    empty = spark.createDataFrame([], ACTORS_SCHEMA)
    folded = _fold(empty, range(lo, hi + 1), lambda prev, y: C.actors_step(prev, films, y))
    hist = C.actors_history(films)
    assertDataFrameEqual(folded, hist)


def test_dates_active_fold(spark, tables):
    ev = A.web_events(tables)
    empty = spark.createDataFrame([], "user_id bigint, dates_active array<date>, date date")
    folded = _fold(empty, _days(ev), lambda prev, d: C.dates_active_step(prev, ev, d))
    assertDataFrameEqual(folded, C.dates_active_history(ev))


def test_device_datelist_fold(spark, tables):
    ev, dev = A.web_events(tables), A.devices(tables)
    empty = spark.createDataFrame(
        [], "user_id bigint, browser_type string, device_activity_datelist array<date>, record_date date"
    )
    folded = _fold(empty, _days(ev), lambda prev, d: C.device_datelist_step(prev, ev, dev, d))
    assertDataFrameEqual(folded, C.device_datelist_history(ev, dev))


def test_host_datelist_fold(spark, tables):
    ev = A.web_events(tables)
    days = _days(ev)
    init = C.host_datelist_init(ev, days[0])
    folded = init.unionByName(_fold(init, days[1:], lambda prev, d: C.host_datelist_step(prev, ev, d)))
    assertDataFrameEqual(folded, C.host_datelist_history(ev))


def test_month_array_fold_idempotent_and_gap_safe(spark, tables):
    ev = A.web_events(tables)
    days = _days(ev)
    empty = spark.createDataFrame(
        [], "user_id bigint, month_start date, metric_name string, metric_array array<bigint>"
    )
    state = empty
    for i, d in enumerate(days):
        state = AR.month_array_step(state, ev, d)
        if i % 5 == 4:
            state = cut_lineage(state)
    hist = AR.month_array_history(ev, ["user_id"], {"metric_array": F.count(F.lit(1))},
                                  require=F.col("user_id").isNotNull())
    hist = hist.select("user_id", "month_start", F.lit("site_hits").alias("metric_name"), "metric_array")
    assertDataFrameEqual(state, hist)
    # re-running the last day changes nothing
    assertDataFrameEqual(AR.month_array_step(state, ev, days[-1]), hist)
    # skipping a day leaves a zero at its position instead of shifting
    skip = days[3]
    gap_state = empty
    for d in days:
        if d != skip:
            gap_state = AR.month_array_step(gap_state, ev, d)
    gap_hist = AR.month_array_history(ev.filter(F.col("event_date") != skip), ["user_id"],
                                      {"metric_array": F.count(F.lit(1))}, upto=days[-1],
                                      require=F.col("user_id").isNotNull())
    gap_hist = gap_hist.select("user_id", "month_start", F.lit("site_hits").alias("metric_name"), "metric_array")
    assertDataFrameEqual(gap_state, gap_hist)


def test_monthly_hits_and_host_reduced_fold(spark, tables):
    ev = A.web_events(tables)
    days = _days(ev)
    hits = spark.createDataFrame(
        [], "user_id bigint, hit_array array<bigint>, month_start date, first_found_date date, date_partition date"
    )
    hosts = spark.createDataFrame(
        [], "month date, host string, hit_array array<bigint>, unique_visitors_array array<bigint>"
    )
    for i, d in enumerate(days):
        hits = AR.monthly_hits_step(hits, ev, d)
        hosts = AR.host_activity_reduced_step(hosts, ev, d)
        if i % 5 == 4:
            hits, hosts = cut_lineage(hits), cut_lineage(hosts)
    h = AR.month_array_history(ev, ["user_id"], {"hit_array": F.count(F.lit(1))}, fill=None,
                               require=F.col("user_id").isNotNull())
    assertDataFrameEqual(hits, h.select("user_id", "hit_array", "month_start", "first_found_date", "date_partition"))
    hh = AR.month_array_history(
        ev, ["host"], {"hit_array": F.count(F.lit(1)), "unique_visitors_array": F.countDistinct("user_id")}
    )
    assertDataFrameEqual(hosts, hh.select(F.col("month_start").alias("month"), "host", "hit_array",
                                          "unique_visitors_array"))
