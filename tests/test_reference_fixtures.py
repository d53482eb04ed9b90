"""The three unit fixtures of the reference's Spark jobs, as whole-DataFrame
equality checks."""

import datetime as dt

from pyspark.sql import Row
from pyspark.testing import assertDataFrameEqual

from dimweave.operators.arrays import array_day_sums
from dimweave.operators.graph import team_vertices
from dimweave.operators.scd import scd2_history


def test_monthly_array_sum(spark):
    ds = "2023-03-01"
    df = spark.createDataFrame(
        [
            ("2023-03-01", [0, 1, 3], ds),
            ("2023-03-01", [1, 2, 3], ds),
            ("2023-04-01", [], ds),
            ("2023-04-01", [], ""),
        ],
        "month_start string, hit_array array<bigint>, date_partition string",
    )
    out = array_day_sums(
        df, ds, 3, names=["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"]
    )
    expected = spark.createDataFrame(
        [("2023-03-01", 1, 3, 6), ("2023-04-01", 0, 0, 0)],
        "month_start string, num_hits_first_day bigint, num_hits_second_day bigint, num_hits_third_day bigint",
    )
    assertDataFrameEqual(out, expected)


def test_player_scd(spark):
    df = spark.createDataFrame(
        [
            ("Michael Jordan", 2001, "Good"),
            ("Michael Jordan", 2002, "Good"),
            ("Michael Jordan", 2003, "Bad"),
            ("Someone Else", 2003, "Bad"),
        ],
        "player_name string, current_season bigint, scoring_class string",
    )
    out = scd2_history(
        df, "player_name", "current_season", ["scoring_class"], start_name="start_date", end_name="end_date",
        as_of_name=None,
    )
    expected = spark.createDataFrame(
        [
            ("Michael Jordan", "Good", 2001, 2002),
            ("Michael Jordan", "Bad", 2003, 2003),
            ("Someone Else", "Bad", 2003, 2003),
        ],
        "player_name string, scoring_class string, start_date bigint, end_date bigint",
    )
    assertDataFrameEqual(out, expected)


def test_team_vertex(spark):
    df = spark.createDataFrame(
        [
            (1, "GSW", "Warriors", "San Francisco", "Chase Center", 1900),
            (1, "GSW", "Bad Warriors", "San Francisco", "Chase Center", 1900),
        ],
        "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint",
    )
    out = team_vertices(df)
    expected = [
        Row(
            identifier=1,
            type="team",
            properties={
                "abbreviation": "GSW",
                "nickname": "Warriors",
                "city": "San Francisco",
                "arena": "Chase Center",
                "year_founded": "1900",
            },
        )
    ]
    assert out.collect() == expected


def test_scd_dates_are_typed(spark):
    # a snapshot column of dates works the same as integer periods
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), "x"), ("a", dt.date(2024, 1, 2), "x"), ("a", dt.date(2024, 1, 3), "y")],
        "k string, d date, v string",
    )
    out = scd2_history(df, "k", "d", ["v"], as_of_name=None).orderBy("start_period").collect()
    assert [(r.v, r.start_period, r.end_period) for r in out] == [
        ("x", dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
        ("y", dt.date(2024, 1, 3), dt.date(2024, 1, 3)),
    ]
