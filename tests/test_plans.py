"""Assertions on physical plans: the strategy is checked, not assumed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimweave.operators.joins import broadcast_if_small
from dimweave.operators.matches import write_bucketed
from dimweave.plans.inspect import count_operator, exchanges, physical_tree, pushed_filters, read_schemas
from dimweave.sources import adapters as A


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_broadcast_only_under_checked_bound(spark, tables, no_auto_broadcast):
    ev, dev = A.web_events(tables), A.devices(tables)
    small = ev.join(broadcast_if_small(dev, 1_000), "device_id")
    assert count_operator(small, "BroadcastHashJoin") == 1
    # over the bound: no hint, the planner shuffles (sort-merge join)
    big = ev.join(broadcast_if_small(dev, 10), "device_id")
    assert count_operator(big, "BroadcastHashJoin") == 0
    assert count_operator(big, "SortMergeJoin") == 1


def test_bucketed_join_has_no_exchange(spark, tables, no_auto_broadcast):
    details, matches = A.match_details(tables), A.matches(tables)
    write_bucketed(details, "t_match_details_bucketed")
    write_bucketed(matches, "t_matches_bucketed")
    joined = spark.table("t_match_details_bucketed").join(spark.table("t_matches_bucketed"), "match_id")
    assert exchanges(joined) == 0
    assert count_operator(joined, "SortMergeJoin") == 1
    plain = details.join(matches, "match_id")
    assert exchanges(plain) == 2
    assert joined.count() == plain.count()
    # a predicate in the ON clause still reaches the bucketed scan
    on_day = spark.table("t_match_details_bucketed").join(
        spark.table("t_matches_bucketed").filter(F.col("completion_date") >= F.lit("1998-01-01").cast("timestamp_ntz")),
        "match_id",
    )
    assert any("completion_date" in f for f in pushed_filters(on_day))


def test_no_nested_loop_or_cartesian_in_registered_queries(spark):
    from __spark_entry__ import queries

    for name, q in queries().items():
        tree = physical_tree(q(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in tree, name
        assert "BroadcastNestedLoopJoin" not in tree, name
        assert "BatchEvalPython" not in tree, name


def test_day_filter_and_pruning_reach_the_scan(spark, tables):
    from dimweave.operators.arrays import month_array_step

    prev = spark.createDataFrame([], "user_id bigint, month_start date, metric_name string, metric_array array<bigint>")
    df = month_array_step(prev, A.web_events(tables), "2024-01-30")
    pf = " ".join(pushed_filters(df))
    assert "GreaterThanOrEqual(ts" in pf and "LessThan(ts" in pf
    # only the needed columns are read
    assert all("value" not in s for s in read_schemas(df))


def test_growth_history_single_shuffle(spark, tables):
    from dimweave.operators.growth import growth_accounting_history

    df = growth_accounting_history(A.web_events(tables))
    # one exchange builds the per-user day sets; the window reuses it
    assert exchanges(df) == 1
    assert count_operator(df, "Window") == 1


def test_windowed_traffic_frames_share_partitioning(spark, tables, no_auto_broadcast):
    from dimweave.operators.behaviour import windowed_traffic

    df = windowed_traffic(A.web_events(tables), A.devices(tables), 0)
    tree = physical_tree(df)
    # all windows sit on the partitioning of the join with the pair totals
    assert count_operator(df, "Window") >= 1
    assert "Exchange" not in tree[tree.rindex("Window") :].split("SortMergeJoin")[0]


def test_actor_history_reads_the_films_once(spark, tables):
    from dimweave.operators.cumulative import actors_history

    tree = physical_tree(actors_history(A.actor_films(tables), 1999))
    assert tree.count("FileScan") + tree.count("Scan parquet") == 3  # lineitem, orders, part


def test_building_a_query_with_a_run_date_starts_no_job(spark):
    from dimweave.plans.registry import QUERIES, RUN_DATE, load_all

    load_all()
    spark.conf.set(RUN_DATE, "2024-01-30")
    tracker = spark.sparkContext.statusTracker()
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for name in ("players_history", "dates_active", "growth_accounting", "month_array", "host_datelist", "datelist_int"):
            QUERIES[name](spark, "/root/testdata/sf0.001")
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.conf.unset(RUN_DATE)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_step_over_bucketed_snapshot_shuffles_only_new_facts(spark, tables, no_auto_broadcast):
    from dimweave.operators.cumulative import cumulate_history, cumulate_step
    from dimweave.sources.io import drop_table, write_snapshot

    ps = A.player_seasons(tables)
    hist = cumulate_history(ps, upto=2000)
    drop_table(spark, "t_players_snap")
    write_snapshot(hist, "t_players_snap", "player_name", "current_season", 8, mode="overwrite")
    prev = spark.table("t_players_snap").filter(F.col("current_season") == 2000)
    step = cumulate_step(prev, ps, 2001)
    tree = physical_tree(step)
    snapshot_branch = tree.split("SortMergeJoin FullOuter")[1].split("+- Sort")[0]
    assert "Exchange" not in snapshot_branch and "players_snap" in snapshot_branch
    plain = cumulate_step(hist.filter(F.col("current_season") == 2000), ps, 2001)
    assert exchanges(step) < exchanges(plain)
    assert step.count() == plain.count()


def test_match_frame_over_bucketed_tables_moves_no_row(spark, tables, no_auto_broadcast):
    from dimweave.operators.matches import bucketed_matches, details_on_day, match_frame, match_tops

    plain = A.match_details(tables), A.matches(tables), A.medals_matches_players(tables)
    details, matches, medals_mp = bucketed = bucketed_matches(*plain)
    # all three joined, aggregated per match and player: no exchange at all
    frame = match_frame(*bucketed, A.medals(tables).coalesce(1), "Brand#1")
    assert frame.count() > 0
    below = physical_tree(match_frame(*bucketed, spark.createDataFrame([(1, "Brand#1")], "medal_id long, name string"), "Brand#1"))
    assert len([line for line in below.splitlines() if " Exchange (" in line]) <= 1  # the names of the one medal
    assert below.count("SortMergeJoin") == 2
    # every answer sits on one aggregate of that frame and one limited ranking
    tops = match_tops(*bucketed, A.medals(tables), A.maps(tables), "Brand#1")
    assert physical_tree(tops).count("SortMergeJoin") == 2
    assert sorted(map(tuple, tops.collect())) == sorted(map(tuple, match_tops(*plain, A.medals(tables), A.maps(tables), "Brand#1").collect()))
    # a date in the ON clause reaches the scan
    day = details_on_day(details, matches, dt.datetime(1995, 3, 5))
    assert exchanges(day) == 0
    assert any("EqualTo(completion_date" in f for f in pushed_filters(day))
