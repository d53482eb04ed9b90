"""Property tests: operators against brute-force Python models of the same
rules, on small random inputs."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from dimweave.operators.datelist import datelist_int
from dimweave.operators.growth import growth_accounting_history
from dimweave.operators.scd import scd2_history

BASE = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None)


def _runs(rows):
    """Brute-force SCD: (key, attr, start, end) runs over sorted periods."""
    out = []
    by_key = {}
    for k, p, a in rows:
        by_key.setdefault(k, []).append((p, a))
    for k, seq in by_key.items():
        seq.sort()
        start, cur = seq[0][0], seq[0][1]
        last = start
        for p, a in seq[1:]:
            if a != cur:
                out.append((k, cur, start, last))
                start, cur = p, a
            last = p
        out.append((k, cur, start, last))
    return sorted(out, key=repr)


@SETTINGS
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(1, 12), st.sampled_from(["a", "b", None])),
        min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1]),
    )
)
def test_scd_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, p int, attr string")
    got = sorted(
        ((r.k, r.attr, r.start_period, r.end_period)
         for r in scd2_history(df, "k", "p", ["attr"], as_of_name=None).collect()),
        key=repr,
    )
    assert got == _runs(rows)


def _ga_model(days, upto):
    """Brute-force growth accounting: walk each day from a user's first
    activity, applying the daily and weekly rules to the previous state."""
    out = {}
    for user, active in days.items():
        first = min(active)
        last = None
        d = first
        while d <= upto:
            a = d in active
            if d == first:
                daily = weekly = "New"
            else:
                y = d - dt.timedelta(days=1)
                if a and last == y:
                    daily = "Retained"
                elif a and last < y:
                    daily = "Resurrected"
                elif not a and last == y:
                    daily = "Churned"
                else:
                    daily = "Stale"
                if a and last < d - dt.timedelta(days=7):
                    weekly = "Resurrected"
                elif not a and last == d - dt.timedelta(days=8):
                    weekly = "Churned"
                elif (d if a else last) + dt.timedelta(days=7) >= y:
                    weekly = "Retained"
                else:
                    weekly = "Stale"
            out[(user, d)] = (daily, weekly, d if a else last)
            if a:
                last = d
            d += dt.timedelta(days=1)
    return out


@SETTINGS
@given(st.dictionaries(st.integers(1, 4), st.sets(st.integers(0, 25), min_size=1, max_size=8), min_size=1, max_size=4))
def test_growth_accounting_matches_model(spark, activity):
    days = {u: {BASE + dt.timedelta(days=i) for i in s} for u, s in activity.items()}
    rows = [(u, dt.datetime.combine(d, dt.time(12))) for u, ds in days.items() for d in ds]
    ev = spark.createDataFrame(rows, "user_id bigint, event_time timestamp_ntz")
    ev = ev.withColumn("event_date", ev.event_time.cast("date"))
    upto = BASE + dt.timedelta(days=28)
    got = {
        (r.user_id, r.date): (r.daily_active_state, r.weekly_active_state, r.last_active_date)
        for r in growth_accounting_history(ev, upto=upto, with_dates=False).collect()
    }
    assert got == _ga_model(days, upto)


@SETTINGS
@given(st.sets(st.integers(0, 40), max_size=12), st.booleans())
def test_datelist_bits_match_model(spark, offsets, compat):
    anchor = BASE + dt.timedelta(days=40)
    dates = sorted(anchor - dt.timedelta(days=o) for o in offsets)
    cum = spark.createDataFrame([(1, dates)], "user_id bigint, dates_active array<date>")
    got = datelist_int(cum, ["user_id"], "dates_active", anchor, compat=compat).first().datelist_int
    if compat:
        want = sum(1 << (32 - o) for o in offsets if o < 32) & 0xFFFFFFFF
    else:
        want = 0
        for o in offsets:
            if o < 32:
                want |= 1 << (31 - o)
    assert got == want


def _sessions_model(events, gap_s):
    """Brute-force sessions: sort each key's times, split where the next
    event is more than ``gap_s`` after the previous one."""
    out = []
    by_key = {}
    for k, t in events:
        by_key.setdefault(k, []).append(t)
    for k, ts in by_key.items():
        ts.sort()
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if (t - prev).total_seconds() > gap_s:
                out.append((k, start, prev + dt.timedelta(seconds=gap_s), n))
                start, n = t, 0
            prev = t
            n += 1
        out.append((k, start, prev + dt.timedelta(seconds=gap_s), n))
    return sorted(out)


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 4 * 3600)), min_size=1, max_size=40),
    st.sampled_from([60, 300, 1800]),
)
def test_sessionize_matches_model(spark, raw, gap_s):
    from dimweave.streaming.windows import sessionize

    t0 = dt.datetime(2024, 1, 1, 23, 0)   # crosses an hour and a day boundary
    events = [(k, t0 + dt.timedelta(seconds=s)) for k, s in raw]
    df = spark.createDataFrame(events, "k string, event_time timestamp_ntz")
    got = sorted(
        (r.k, r.session_start, r.session_end, r.n) for r in sessionize(df, ["k"], gap_s, tiebreak=None).collect()
    )
    assert got == _sessions_model(events, gap_s)


@SETTINGS
@given(
    st.lists(
        st.tuples(st.integers(1, 3), st.integers(0, 15), st.one_of(st.none(), st.integers(0, 20))),
        min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]),
    )
)
def test_longest_streak_matches_model(spark, rows):
    from dimweave.operators.sports import longest_streak

    # game g is played on day g // 3 (several games share a date)
    details = spark.createDataFrame(
        [(g, p, None if pts is None else float(pts)) for p, g, pts in rows], "game_id bigint, player_id bigint, pts double"
    )
    games = spark.createDataFrame(
        [(g, BASE + dt.timedelta(days=g // 3)) for g in range(16)], "game_id bigint, game_date_est date"
    )
    want = {}
    for p in {r[0] for r in rows}:
        seq = sorted((g // 3, g, pts) for q, g, pts in rows if q == p and pts is not None)
        best = None
        run = []
        for day, g, pts in seq + [(None, None, -1)]:
            if pts is not None and pts > 10:
                run.append(day)
                continue
            if run:
                cand = (len(run), -run[0], -run[-1])
                if best is None or cand > best:
                    best = cand
            run = []
        if best:
            want[p] = (best[0], BASE + dt.timedelta(days=-best[1]), BASE + dt.timedelta(days=-best[2]))
    got = {r.player_id: (r.streak_len, r.start_date, r.end_date) for r in longest_streak(details, games, 10.0).collect()}
    assert got == want


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.booleans()), min_size=1, max_size=40),
    st.integers(1, 6),
)
def test_best_stretch_matches_model(spark, raw, n):
    from dimweave.operators.sports import best_stretch

    games = [(g, BASE + dt.timedelta(days=g // 2), h, (h + 1 + v) % 5, int(w)) for g, (h, v, w) in enumerate(raw)]
    df = spark.createDataFrame(
        games, "game_id bigint, game_date_est date, home_team_id bigint, visitor_team_id bigint, home_team_wins int"
    )
    seqs = {}
    for g, d, h, v, w in sorted(games, key=lambda x: (x[1], x[0])):
        seqs.setdefault(h, []).append(w)
        seqs.setdefault(v, []).append(1 - w)
    want = {t: max(sum(s[max(0, i - n + 1): i + 1]) for i in range(len(s))) for t, s in seqs.items()}
    got = {r.team_id: r.best_wins for r in best_stretch(df, n).collect()}
    assert got == want


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 45)), min_size=1, max_size=20))
def test_month_arrays_across_month_boundaries(spark, raw):
    import calendar

    from pyspark.sql import functions as F

    from dimweave.operators.arrays import month_array_history, month_array_step
    from dimweave.session import cut_lineage
    from dimweave.sources.io import upsert

    start = dt.date(2024, 1, 20)
    rows = [(u, dt.datetime.combine(start + dt.timedelta(days=o), dt.time(8))) for u, o in raw]
    ev = spark.createDataFrame(rows, "user_id bigint, event_time timestamp_ntz").withColumn(
        "event_date", F.to_date("event_time")
    )
    upto = start + dt.timedelta(days=45)
    hist = month_array_history(ev, ["user_id"], {"metric_array": F.count(F.lit(1))}, upto=upto)
    got = {(r.user_id, r.month_start): r.metric_array for r in hist.collect()}
    # model: every (user, month) with activity, zero-filled to month end or upto
    counts = {}
    for u, ts in rows:
        counts[(u, ts.date())] = counts.get((u, ts.date()), 0) + 1
    want = {}
    for (u, d) in counts:
        m = d.replace(day=1)
        if (u, m) in want:
            continue
        last = min(m.replace(day=calendar.monthrange(m.year, m.month)[1]), upto)
        want[(u, m)] = [counts.get((u, m + dt.timedelta(days=i)), 0) for i in range((last - m).days + 1)]
    assert got == want
    # the daily step, upserted into the state day by day, reaches the same table
    state = spark.createDataFrame([], "user_id bigint, month_start date, metric_name string, metric_array array<bigint>")
    keys = ["user_id", "month_start", "metric_name"]
    first = min(ts.date() for _, ts in rows)
    d = first
    while d <= upto:
        # the state is read twice per step (previous month state and upsert
        # target), so the lineage is cut every day to keep the plan linear
        state = cut_lineage(upsert(state, month_array_step(state, ev, d), keys))
        d += dt.timedelta(days=1)
    stepped = {(r.user_id, r.month_start): r.metric_array for r in state.collect()}
    # a month's rows are only rewritten on that month's days: months before the
    # last stop at their own month end, exactly as in the closed form
    assert stepped == want
