"""Stored snapshots: a step reads one period of state and one of facts, is
idempotent, and never builds on a run that did not finish."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimweave.operators.cumulative import cumulate_history, cumulate_step, dates_active_history, dates_active_step
from dimweave.operators.growth import growth_accounting_history, growth_accounting_step
from dimweave.plans.inspect import exchanges, physical_tree, plan_text, pushed_filters
from dimweave.sources import adapters as A
from dimweave.sources.snapshots import NotCommitted, SnapshotTable

DAYS = [dt.date(2024, 1, d) for d in (8, 9, 10, 11)]


@pytest.fixture()
def users(spark, tables):
    ev = A.web_events(tables)
    table = SnapshotTable.scratch(spark, "t_users", "user_id", "date", buckets=4)
    table.write(dates_active_history(ev, DAYS[0], periods=[DAYS[0]]), DAYS[0])
    return ev, table


def test_steps_follow_each_other_through_the_store(spark, users):
    ev, table = users
    for before, day in zip(DAYS, DAYS[1:]):
        table.advance(lambda prev: dates_active_step(prev, ev, day), before, day)
    for day in DAYS:
        assertDataFrameEqual(table.read(day).select("user_id", "dates_active", "date"), dates_active_history(ev, day, periods=[day]))
    assert table.periods().keys() == {str(d) for d in DAYS}


def test_a_step_scans_one_partition_and_one_day(spark, users):
    ev, table = users
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        step = dates_active_step(table.read(DAYS[0]), ev, DAYS[1])
        plan = plan_text(step)
        assert physical_tree(step).count("Scan parquet") == 2
        assert "(date#" in plan and f"= {DAYS[0]})" in plan.split("PartitionFilters:", 1)[1].split("\n")[0]
        pushed = " ".join(pushed_filters(step))
        assert f"GreaterThanOrEqual(ts,{DAYS[1]}" in pushed and f"LessThan(ts,{DAYS[2]}" in pushed
        # the facts are made distinct and placed by user; the state doesn't move
        assert exchanges(step) <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_a_period_run_again_gives_the_same_partition(spark, users):
    ev, table = users
    step = lambda prev: dates_active_step(prev, ev, DAYS[1])
    first = sorted(map(str, table.advance(step, DAYS[0], DAYS[1]).collect()))
    table.advance(lambda prev: dates_active_step(prev, ev, DAYS[2]), DAYS[1], DAYS[2])
    assert sorted(map(str, table.advance(step, DAYS[0], DAYS[1]).collect())) == first
    assert table.read(DAYS[2]).count() and table.read(DAYS[0]).count()
    files = spark.table(table.name).filter(F.col("date") == F.lit(DAYS[1])).select("_metadata.file_path").distinct().count()
    assert files <= table.buckets


def test_an_unfinished_period_is_refused(spark, users):
    ev, table = users
    with pytest.raises(NotCommitted):
        table.read(DAYS[1])

    def dies(prev):
        return dates_active_step(prev, ev, DAYS[1]).withColumn("date", F.when(F.raise_error(F.lit("lost")).isNull(), F.col("date")))

    with pytest.raises(Exception):
        table.advance(dies, DAYS[0], DAYS[1])
    with pytest.raises(NotCommitted):
        table.read(DAYS[1])
    table.advance(lambda prev: dates_active_step(prev, ev, DAYS[1]), DAYS[0], DAYS[1])
    assertDataFrameEqual(table.read(DAYS[1]).select("user_id", "dates_active", "date"), dates_active_history(ev, DAYS[1], periods=[DAYS[1]]))
    # a run that starts again takes the commit back until it has finished
    with pytest.raises(ValueError):
        table.write(table.read(DAYS[0]).filter("user_id is null"), DAYS[1])
    with pytest.raises(NotCommitted):
        table.read(DAYS[1])


def test_other_steps_equal_their_histories(spark, tables):
    ev, ps = A.web_events(tables), A.player_seasons(tables)
    growth = SnapshotTable.scratch(spark, "t_growth", "user_id", "date", buckets=2)
    growth.write(growth_accounting_history(ev, DAYS[0], periods=[DAYS[0]]), DAYS[0])
    # a day is left out: the rows bear the later one
    out = growth.advance(lambda prev: growth_accounting_step(prev, ev.filter(F.col("event_date") != F.lit(DAYS[1])), DAYS[2]), DAYS[0], DAYS[2])
    want = growth_accounting_history(ev.filter(F.col("event_date") != F.lit(DAYS[1])), DAYS[2], periods=[DAYS[2]])
    assertDataFrameEqual(out.select(*want.columns), want)
    players = SnapshotTable.scratch(spark, "t_players", "player_name", "current_season", buckets=2)
    players.write(cumulate_history(ps, 1996, periods=[1996]), 1996)
    want = cumulate_history(ps, 1997, periods=[1997])
    assertDataFrameEqual(players.advance(lambda prev: cumulate_step(prev, ps, 1997), 1996, 1997).select(*want.columns), want)


@pytest.mark.parametrize("size", [1, 4, 30])
def test_chunked_histories_expand_to_the_whole_lists(spark, tables, size):
    from dimweave.operators.chunks import chunk_days, chunked_snapshots, closed_chunks, expand

    ev = A.web_events(tables).filter("user_id % 3 = 0 or event_date < date'2024-01-09'")  # idle ends and whole idle chunks
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")).cast("long"))
    day = dt.date(2024, 1, 25)
    chunks = chunk_days(hot, ["user_id"], day, size)
    closed, rows = closed_chunks(chunks, ["user_id"], day, size), chunked_snapshots(chunks, ["user_id"], day, size)
    want = dates_active_history(hot, day)
    assertDataFrameEqual(expand(rows, closed, ["user_id"], "dates_active").select("user_id", "dates_active", "date"), want)
    assert rows.agg(F.max(F.size("tail"))).first()[0] <= size
    if size == 4:
        stored = closed.agg(F.sum(F.size("days"))).first()[0] + rows.agg(F.sum(F.size("tail"))).first()[0]
        assert 2 * stored < want.agg(F.sum(F.size("dates_active"))).first()[0]
    # no events, and none up to the day
    assert chunked_snapshots(chunk_days(hot.limit(0), ["user_id"], day, size), ["user_id"], day, size).count() == 0
    assert chunk_days(hot, ["user_id"], "2023-12-01", size).count() == 0
