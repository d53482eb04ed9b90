"""Hand-made fixtures for the edge cases the driver tables never reach, and
invariants over the tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimweave.functions.columns import CHANNEL_RULES, channel_of, threshold_class
from dimweave.operators.arrays import array_to_daily, month_array_history, monthly_hits_step
from dimweave.operators.behaviour import funnel
from dimweave.operators.datelist import activity_flags, datelist_int
from dimweave.operators.growth import growth_accounting_history
from dimweave.operators.scd import scd2_history, scd2_step
from dimweave.operators.sports import best_stretch, longest_streak
from dimweave.sources import adapters as A

D = dt.date


def _ev(spark, rows):
    """rows: (user_id, event_time) -> web-event shaped frame."""
    df = spark.createDataFrame(rows, "user_id bigint, event_time timestamp_ntz")
    return df.withColumn("event_date", F.to_date("event_time"))


def test_growth_accounting_every_state(spark):
    t = dt.datetime
    rows = [
        (1, t(2024, 1, 1, 9)), (1, t(2024, 1, 2, 9)),            # New, Retained
        (2, t(2024, 1, 1, 9)), (2, t(2024, 1, 12, 9)),           # ..., Churned, Stale, Resurrected
    ]
    ga = growth_accounting_history(_ev(spark, rows), upto="2024-01-12")
    got = {(r.user_id, r.date.day): (r.daily_active_state, r.weekly_active_state) for r in ga.collect()}
    assert got[(1, 1)] == ("New", "New")
    assert got[(1, 2)] == ("Retained", "Retained")
    assert got[(1, 3)] == ("Churned", "Retained")
    assert got[(1, 4)] == ("Stale", "Retained")
    assert got[(1, 10)] == ("Stale", "Churned")     # last active 8 days before
    assert got[(1, 11)] == ("Stale", "Stale")
    assert got[(2, 2)] == ("Churned", "Retained")
    assert got[(2, 12)] == ("Resurrected", "Resurrected")
    # every user has exactly one row per day from first activity on
    assert ga.count() == 12 + 12


def test_growth_states_partition_users(spark, tables):
    ga = growth_accounting_history(A.web_events(tables), with_dates=False)
    per_day = ga.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    seen = ga.groupBy("user_id").agg(F.min("first_active_date").alias("f"))
    cum = per_day.join(seen, F.col("f") <= F.col("date")).groupBy("date", "n").agg(F.count(F.lit(1)).alias("m"))
    assert cum.filter(F.col("n") != F.col("m")).count() == 0


def test_datelist_bits_plain_and_compat(spark):
    anchor = D(2024, 1, 31)
    dates = [anchor - dt.timedelta(days=k) for k in (0, 1, 31, 32)]
    cum = spark.createDataFrame([(1, dates)], "user_id bigint, dates_active array<date>")
    plain = datelist_int(cum, ["user_id"], "dates_active", anchor).first().datelist_int
    assert plain == (1 << 31) | (1 << 30) | (1 << 0)          # day 32 is outside the window
    compat = datelist_int(cum, ["user_id"], "dates_active", anchor, compat=True).first().datelist_int
    assert compat == ((1 << 32) + (1 << 31) + (1 << 1)) & 0xFFFFFFFF   # the anchor day falls off
    flags = activity_flags(datelist_int(cum, ["user_id"], "dates_active", anchor), ["user_id"]).first()
    assert (flags.l32, flags.l7, flags.daily_active, flags.weekly_active_previous_week) == (3, 2, True, False)


def test_bit_count_equals_dates_in_window(spark, tables):
    from dimweave.operators.datelist import dates_as_of

    ev = A.web_events(tables)
    anchor = ev.agg(F.max("event_date")).first()[0]
    snap = dates_as_of(ev, ["user_id"], anchor)
    bits = activity_flags(datelist_int(snap, ["user_id"], "dates_active", anchor), ["user_id"])
    in_window = snap.select(
        "user_id", F.size(F.filter("dates_active", lambda d: F.datediff(F.lit(anchor), d) < 32)).alias("k")
    )
    j = bits.join(in_window, "user_id")
    assert j.filter(F.col("l32") != F.col("k")).count() == 0


def test_month_array_first_event_mid_month_and_inactive_user(spark):
    t = dt.datetime
    ev = _ev(spark, [(1, t(2024, 3, 3, 10)), (1, t(2024, 3, 3, 11)), (2, t(2024, 3, 1, 8))])
    hist = month_array_history(ev, ["user_id"], {"a": F.count(F.lit(1))}, upto="2024-03-03")
    got = {r.user_id: r.a for r in hist.collect()}
    assert got == {1: [0, 0, 2], 2: [1, 0, 0]}
    # NULL-fill variant keeps first_found_date for a user inactive today
    prev = spark.createDataFrame(
        [(2, [1, None], D(2024, 3, 1), D(2024, 3, 1), D(2024, 3, 2))],
        "user_id bigint, hit_array array<bigint>, month_start date, first_found_date date, date_partition date",
    )
    out = {r.user_id: r for r in monthly_hits_step(prev, ev, "2024-03-03").collect()}
    assert out[2].hit_array == [1, None, None] and out[2].first_found_date == D(2024, 3, 1)
    assert out[1].hit_array == [None, None, 2] and out[1].first_found_date == D(2024, 3, 3)


def test_unpivot_total_equals_raw_count(spark, tables):
    ev = A.web_events(tables)
    hist = month_array_history(ev, ["user_id"], {"metric_array": F.count(F.lit(1))},
                               require=F.col("user_id").isNotNull())
    daily = array_to_daily(hist.withColumn("metric_name", F.lit("site_hits")))
    assert daily.agg(F.sum("value")).first()[0] == ev.filter(F.col("user_id").isNotNull()).count()


def test_scd_change_only_in_activity_and_null_attribute(spark):
    snap = spark.createDataFrame(
        [
            ("a", 1, "good", True), ("a", 2, "good", False), ("a", 3, "good", False),
            ("b", 1, None, True), ("b", 2, None, True), ("b", 3, "bad", True),
        ],
        "k string, p int, cls string, act boolean",
    )
    hist = scd2_history(snap, "k", "p", ["cls", "act"], as_of_name=None)
    got = sorted(
        ((r.k, r.cls, r.act, r.start_period, r.end_period) for r in hist.collect()),
        key=lambda x: (x[0], x[3]),
    )
    assert got == [
        ("a", "good", True, 1, 1), ("a", "good", False, 2, 3),
        ("b", None, True, 1, 2), ("b", "bad", True, 3, 3),
    ]
    # the incremental step keeps a NULL attribute's run (null-safe compare)
    scd = scd2_history(snap, "k", "p", ["cls", "act"], upto=1)
    stepped = scd2_step(scd, snap, "k", "p", ["cls", "act"], 2)
    assert sorted((r.k, r.start_period, r.end_period) for r in stepped.collect()) == [
        ("a", 1, 1), ("a", 2, 2), ("b", 1, 2),
    ]


def test_funnel_last_event_of_day_is_not_counted(spark):
    t = dt.datetime
    ev = spark.createDataFrame(
        [
            (1, "view", t(2024, 1, 1, 9)), (1, "buy", t(2024, 1, 1, 10)),   # view converts, buy is last
            (2, "view", t(2024, 1, 1, 9)), (2, "view", t(2024, 1, 1, 11)),  # first view: no conversion
            (3, "view", t(2024, 1, 1, 23)), (3, "buy", t(2024, 1, 2, 1)),   # next day: not counted
        ],
        "user_id bigint, url string, event_time timestamp_ntz",
    )
    out = {r.url: (r.n, r.conversion_rate) for r in funnel(ev, "buy", min_n=0).collect()}
    assert out == {"view": (2, 0.5)}


def test_streak_skips_unscored_games(spark):
    details = spark.createDataFrame(
        [(1, 1, 12.0), (2, 1, None), (3, 1, 15.0), (4, 1, 3.0), (5, 1, 20.0)],
        "game_id bigint, player_id bigint, pts double",
    )
    games = spark.createDataFrame(
        [(i, D(2024, 1, i)) for i in range(1, 6)], "game_id bigint, game_date_est date"
    )
    r = longest_streak(details, games, 10.0).first()
    assert (r.streak_len, r.start_date, r.end_date) == (2, D(2024, 1, 1), D(2024, 1, 3))


def test_best_stretch_short_history(spark):
    games = spark.createDataFrame(
        [(i, D(2024, 1, i), 0, 1, 1 if i % 2 else 0) for i in range(1, 8)],
        "game_id bigint, game_date_est date, home_team_id bigint, visitor_team_id bigint, home_team_wins int",
    )
    got = {r.team_id: r.best_wins for r in best_stretch(games, 3).collect()}
    assert got == {0: 2, 1: 2}
    got_long = {r.team_id: r.best_wins for r in best_stretch(games, 90).collect()}
    assert got_long == {0: 4, 1: 3}


def test_threshold_class_and_channels(spark):
    df = spark.createDataFrame([(25.0,), (20.0,), (10.5,), (None,)], "v double")
    out = [r[0] for r in df.select(threshold_class("v", [(20, "star"), (15, "good"), (10, "average")], "bad")).collect()]
    assert out == ["star", "good", "average", "bad"]
    refs = spark.createDataFrame(
        [("https://lnkd.in/x",), ("https://t.co/y",), ("https://other.org",), (None,)], "r string"
    )
    got = [r[0] for r in refs.select(channel_of("r", CHANNEL_RULES)).collect()]
    assert got == ["Linkedin", "Twitter", "https://other.org", None]
    own = [r[0] for r in refs.select(channel_of("r", on_site=["other.org"])).collect()]
    assert own == ["Linkedin", "Twitter", "On Site", None]


def test_requested_periods_equal_full_history(spark, tables):
    from dimweave.operators.cumulative import cumulate_history, dates_active_history

    ev = A.web_events(tables)
    days = [D(2024, 1, 7), D(2024, 1, 30)]
    full = growth_accounting_history(ev).filter(F.col("date").isin(days))
    assertDataFrameEqual(growth_accounting_history(ev, periods=days), full)
    assertDataFrameEqual(
        dates_active_history(ev, periods=days), dates_active_history(ev).filter(F.col("date").isin(days))
    )
    ps = A.player_seasons(tables)
    assertDataFrameEqual(
        cumulate_history(ps, periods=[1997, 2001]),
        cumulate_history(ps).filter(F.col("current_season").isin(1997, 2001)),
    )


def test_device_datelist_as_map(spark, tables):
    from dimweave.operators.cumulative import device_datelist_history

    ev, dev = A.web_events(tables), A.devices(tables)
    long_form = device_datelist_history(ev, dev)
    as_map = device_datelist_history(ev, dev, as_map=True)
    day = long_form.agg(F.max("record_date")).first()[0]
    m = {r.user_id: r.device_activity_datelist for r in as_map.filter(F.col("record_date") == day).collect()}
    for r in long_form.filter(F.col("record_date") == day).collect():
        assert m[r.user_id][r.browser_type] == r.device_activity_datelist


def test_step_statics_rule_and_streak_player_filter(spark):
    from dimweave.operators.cumulative import cumulate_step

    prev = spark.createDataFrame(
        [("p", "old", "c", "x", "1", "1", "1", [(2000, 1, 12.0, 1.0, 1.0)], "average", 0, True, 2000)],
        "player_name string, height string, college string, country string, draft_year string, draft_round string,"
        " draft_number string, seasons array<struct<season:int,gp:bigint,pts:double,reb:double,ast:double>>,"
        " scoring_class string, years_since_last_active int, is_active boolean, current_season int",
    )
    today = spark.createDataFrame(
        [("p", "new", "c", "x", "1", "1", "1", 2001, 1, 21.0, 1.0, 1.0)],
        "player_name string, height string, college string, country string, draft_year string, draft_round string,"
        " draft_number string, season int, gp bigint, pts double, reb double, ast double",
    )
    first = cumulate_step(prev, today, 2001).first()
    latest = cumulate_step(prev, today, 2001, statics_rule="latest").first()
    assert (first.height, latest.height) == ("old", "new")
    assert first.scoring_class == "star" and len(first.seasons) == 2
    details = spark.createDataFrame(
        [(1, 1, 12.0), (2, 1, 15.0), (1, 2, 30.0)], "game_id bigint, player_id bigint, pts double"
    )
    games = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], "game_id bigint, game_date_est date")
    rows = longest_streak(details, games, 10.0, player=1).collect()
    assert [(r.player_id, r.streak_len) for r in rows] == [(1, 2)]


def test_sessionize_matches_session_window_semantics(spark):
    from dimweave.streaming.windows import sessionize

    t = dt.datetime
    ev = spark.createDataFrame(
        [("a", t(2024, 1, 1, 0, 0)), ("a", t(2024, 1, 1, 0, 5)), ("a", t(2024, 1, 1, 0, 10, 1)),
         ("a", t(2024, 1, 1, 0, 58)), ("a", t(2024, 1, 1, 1, 2)), ("a", None), ("b", t(2024, 1, 1, 0, 1))],
        "k string, event_time timestamp_ntz",
    )
    got = sessionize(ev, ["k"], 300, tiebreak=None)
    expected = ev.filter("event_time is not null").groupBy("k", F.session_window("event_time", "5 minutes").alias("s")).agg(
        F.count(F.lit(1)).alias("n")
    ).select("k", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
    # exactly-gap events merge; sessions cross the hour buckets
    assertDataFrameEqual(got, expected)
    assert got.count() == 4


def test_datelist_keeps_users_idle_in_window(spark):
    from dimweave.operators.datelist import dates_as_of

    ev = _ev(spark, [(1, dt.datetime(2024, 1, 1, 9)), (2, dt.datetime(2024, 3, 1, 9))])
    snap = dates_as_of(ev, ["user_id"], "2024-03-01", window_days=32)
    got = {r.user_id: r.datelist_int for r in datelist_int(snap, ["user_id"], "dates_active", "2024-03-01").collect()}
    assert got == {1: 0, 2: 1 << 31}


def test_scd_step_keeps_absent_entities_and_can_be_run_again(spark):
    from dimweave.operators.scd import scd2_step

    scd = spark.createDataFrame([("a", "x", 1, 1, 1), ("z", "x", 1, 1, 1)], "k string, v string, start_period int, end_period int, as_of int")
    snap = spark.createDataFrame([("a", "y", 2), ("b", "x", 2)], "k string, v string, p int")
    once = scd2_step(scd, snap, "k", "p", ["v"], 2)
    want = {("a", "x", 1, 1, 2), ("a", "y", 2, 2, 2), ("b", "x", 2, 2, 2), ("z", "x", 1, 1, 2)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in scd2_step(once, snap, "k", "p", ["v"], 2).collect()} == want
    dropped = scd2_step(scd, snap, "k", "p", ["v"], 2, drop_absent=True)
    assert {tuple(r) for r in dropped.collect()} == {r for r in want if r[0] != "z"}


def test_scd_step_again_after_an_unchanged_run(spark):
    from dimweave.operators.scd import scd2_step

    scd = spark.createDataFrame([("a", "x", 1, 1, 1)], "k string, v string, start_period int, end_period int, as_of int")
    snap = spark.createDataFrame([("a", "x", 2)], "k string, v string, p int")
    once = scd2_step(scd, snap, "k", "p", ["v"], 2)
    assert [tuple(r) for r in once.collect()] == [("a", "x", 1, 2, 2)]
    assert [tuple(r) for r in scd2_step(once, snap, "k", "p", ["v"], 2).collect()] == [("a", "x", 1, 2, 2)]


def test_histories_end_at_their_bound(spark, tables):
    from dimweave.operators.arrays import month_array_history
    from dimweave.operators.cumulative import actors_history, cumulate_history, dates_active_history

    ps = A.player_seasons(tables)
    early = cumulate_history(ps, upto=1996)
    assert early.agg(F.max("current_season")).first()[0] == 1996
    assert early.count() == cumulate_history(ps).filter("current_season <= 1996").count()
    films = A.actor_films(tables)
    assert actors_history(films, 1996).count() == actors_history(films).filter("current_year <= 1996").count()
    ev = A.web_events(tables)
    assert dates_active_history(ev, D(2024, 1, 3)).count() == dates_active_history(ev).filter("date <= date'2024-01-03'").count()
    late = spark.createDataFrame([(1, D(2024, 1, 5)), (1, D(2024, 2, 3))], "user_id long, event_date date")
    rows = month_array_history(late, ["user_id"], {"n": F.count(F.lit(1))}, upto=D(2024, 1, 31)).collect()
    assert [(r.month_start, len(r.n), sum(r.n)) for r in rows] == [(D(2024, 1, 1), 31, 1)]


def test_a_previous_row_without_history_stays_empty(spark):
    from dimweave.operators.cumulative import cumulate_step

    prev = spark.createDataFrame(
        [("p", None, None, "bad", 1, False, 2000)],
        "player_name string, height string, seasons array<struct<season:int,gp:bigint,pts:double,reb:double,ast:double>>, "
        "scoring_class string, years_since_last_active int, is_active boolean, current_season int",
    )
    today = spark.createDataFrame([], "player_name string, height string, season int, gp bigint, pts double, reb double, ast double")
    row = cumulate_step(prev, today, 2001, statics=["height"]).first()
    assert row.seasons == [] and row.years_since_last_active == 2


def test_overwrite_goes_by_name(spark):
    from dimweave.sources.io import drop_table, ensure_table, overwrite_table

    drop_table(spark, "t_by_name")
    ensure_table(spark, "t_by_name", "a string, b string, p int", partitioned_by=["p"])
    overwrite_table(spark.createDataFrame([("bb", 1, "aa")], "b string, p int, a string"), "t_by_name")
    assert [tuple(r) for r in spark.table("t_by_name").collect()] == [("aa", "bb", 1)]
    drop_table(spark, "t_by_name")


def test_geo_ranges_wide_and_overlapping(spark):
    from dimweave.streaming.ingest import geo_lookup

    ranges = [(0, 2**32 - 1, "world"), (10 * 2**24, 11 * 2**24 - 1, "net10"), (10 * 2**24 + 5, 10 * 2**24 + 900, "office"),
              (10 * 2**24 + 7, 10 * 2**24 + 7, "desk"), (300, 299, "none"), (2**16 - 3, 3 * 2**16 + 2, "odd")]
    geo = spark.createDataFrame([(a, b, n, n, n) for a, b, n in ranges], "ip_lo long, ip_hi long, country string, state string, city string")
    ips = [0, 1, 2**16 - 4, 2**16 - 3, 2**16, 2 * 2**16 + 77, 3 * 2**16 + 2, 3 * 2**16 + 3, 10 * 2**24, 10 * 2**24 + 5,
           10 * 2**24 + 7, 10 * 2**24 + 900, 10 * 2**24 + 901, 11 * 2**24 - 1, 11 * 2**24, 2**32 - 1]

    def expected(ip, among):
        hits = [(b - a, a, n) for a, b, n in among if a <= ip <= b]
        return min(hits)[2] if hits else None

    for among in (ranges, ranges[1:]):
        some = geo.filter(F.col("country").isin([n for _, _, n in among]))
        got = geo_lookup(spark.createDataFrame([(i,) for i in ips], "ip_num long"), some)
        found = {r.ip_num: r.geodata for r in got.collect()}
        assert len(found) == len(ips) == got.count()
        for ip in ips:
            name = expected(ip, among)
            assert found[ip] == ("{}" if name is None else f'{{"country":"{name}","state":"{name}","city":"{name}"}}')


def test_geo_many_ranges_as_disjoint_intervals(spark):
    """10^5 ranges: single addresses, nested, overlapping and repeated ones
    against a sweep; the broadcast bound counts flat rows."""
    import bisect
    import heapq
    import random

    from dimweave.operators.joins import row_bytes
    from dimweave.streaming.ingest import flat_intervals, geo_lookup

    rng = random.Random(4)
    base = 10 * 2**24
    ranges = [(a, a) for a in (base + rng.randrange(200_000) for _ in range(60_000))]
    ranges += [(a, a + rng.choice([1, 7, 300, 5000, 70_000])) for a in (base + rng.randrange(300_000) for _ in range(40_000))]
    ranges += [(base, base + 400_000), (base, base + 400_000), (5, 4), (2**32 - 9, 2**32 - 1)]
    geo = spark.createDataFrame([(a, b, f"c{a}", f"s{b}", f"t{b - a}") for a, b in ranges], "ip_lo long, ip_hi long, country string, state string, city string").repartition(4)
    # brute force: a sweep with a heap over the ends
    known = sorted({(a, b) for a, b in ranges if a <= b})
    cuts = sorted({x for a, b in known for x in (a, b + 1)})
    want, heap, i = [], [], 0
    for at, following in zip(cuts, [*cuts[1:], None]):
        while i < len(known) and known[i][0] <= at:
            heapq.heappush(heap, (known[i][1] - known[i][0], *known[i]))
            i += 1
        while heap and heap[0][2] < at:
            heapq.heappop(heap)
        if heap:
            want.append((at, following - 1, f"c{heap[0][1]}", f"s{heap[0][2]}", f"t{heap[0][0]}"))
    got = flat_intervals(geo).select("ip_lo", "ip_hi", "country", "state", "city")
    assert sorted(map(tuple, got.collect())) == want
    ips = [base - 1, base + 400_001, 2**32 - 10, 2**32 - 1, *(base + rng.randrange(410_000) for _ in range(3000))]
    events = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i long, ip_num long")
    for rows in (10_000_000, 10):  # broadcast, and joined by shuffle
        places = {r.i: r.geodata for r in geo_lookup(events, geo, max_broadcast_rows=rows).collect()}
        assert len(places) == len(ips)
        for i, ip in enumerate(ips):
            w = want[max(0, bisect.bisect_right(want, (ip, 2**40)) - 1)]
            hit = [w] if w[0] <= ip <= w[1] else []
            assert places[i] == (f'{{"country":"{hit[0][2]}","state":"{hit[0][3]}","city":"{hit[0][4]}"}}' if hit else "{}")
    with pytest.raises(ValueError):
        row_bytes(spark.createDataFrame([], "a array<int>").schema)
