"""Reduced monthly facts: one row per (key, month) holding a per-day metric
array (index = day of month - 1).

Step forms take the previous state of the month and one day of events; they
pad (or cut) the stored array to ``day - month_start`` before writing the
day, so re-running a day is idempotent and a skipped day leaves a gap of the
fill value instead of shifting later positions.  The history form builds all
months at once from a dense day index.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.columns import no_later, on_day, safe_get


def _d(day: str | dt.date) -> Column:
    return F.to_date(F.lit(str(day)))


def _fit(arr: Column, n: Column, fill, typ: str) -> Column:
    """``arr`` padded with ``fill`` / cut to exactly ``n`` elements."""
    base = F.coalesce(arr, F.array().cast(f"array<{typ}>"))
    pad = F.array_repeat(F.lit(fill).cast(typ), n)
    return F.slice(F.concat(base, pad), 1, n)


def month_array_step(
    prev: DataFrame,
    events: DataFrame,
    day: str | dt.date,
    key: str = "user_id",
    metric_name: str = "site_hits",
) -> DataFrame:
    """Daily load of ``array_metrics``: count of today's events appended at
    position ``day - month_start``; a key without events today gets 0; a new
    key gets zeros for the earlier days.  Output replaces the month's rows
    (upsert on key, month, metric)."""
    d = _d(day)
    month = F.trunc(d, "month")
    today = (
        on_day(events, day).filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .alias("t")
    )
    y = prev.filter((F.col("month_start") == month) & (F.col("metric_name") == metric_name)).alias("y")
    j = today.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full")
    pos = F.datediff(d, month)
    arr = F.concat(_fit(F.col("y.metric_array"), pos, 0, "bigint"), F.array(F.coalesce(F.col("t.n"), F.lit(0).cast("long"))))
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        month.alias("month_start"),
        F.lit(metric_name).alias("metric_name"),
        arr.alias("metric_array"),
    )


def monthly_hits_step(prev: DataFrame, events: DataFrame, day: str | dt.date, key: str = "user_id") -> DataFrame:
    """Daily load of ``monthly_user_site_hits``: NULL for days without hits,
    ``first_found_date`` = the earlier of the stored one and today (a user
    inactive today keeps it)."""
    d = _d(day)
    month = F.trunc(d, "month")
    today = (
        on_day(events, day).filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("num_hits"))
        .alias("t")
    )
    y = prev.filter(F.col("month_start") == month).alias("y")
    j = y.join(today, F.col(f"t.{key}") == F.col(f"y.{key}"), "full")
    pos = F.datediff(d, month)
    arr = F.concat(_fit(F.col("y.hit_array"), pos, None, "bigint"), F.array(F.col("t.num_hits")))
    found_today = F.when(F.col("t.num_hits").isNotNull(), d)
    return j.select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        arr.alias("hit_array"),
        month.alias("month_start"),
        F.least(F.col("y.first_found_date"), found_today).alias("first_found_date"),
        d.alias("date_partition"),
    )


def host_activity_reduced_step(prev: DataFrame, events: DataFrame, day: str | dt.date) -> DataFrame:
    """Daily load of ``host_activity_reduced``: hits and distinct visitors per
    host, zero filled, upsert on (month, host)."""
    d = _d(day)
    month = F.trunc(d, "month")
    today = (
        on_day(events, day)
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("hits"), F.countDistinct("user_id").alias("visitors"))
        .alias("t")
    )
    y = prev.filter(F.col("month") == month).alias("y")
    j = today.join(y, F.col("t.host") == F.col("y.host"), "full")
    pos = F.datediff(d, month)
    zero = F.lit(0).cast("long")
    return j.select(
        month.alias("month"),
        F.coalesce(F.col("t.host"), F.col("y.host")).alias("host"),
        F.concat(_fit(F.col("y.hit_array"), pos, 0, "bigint"), F.array(F.coalesce(F.col("t.hits"), zero))).alias(
            "hit_array"
        ),
        F.concat(
            _fit(F.col("y.unique_visitors_array"), pos, 0, "bigint"),
            F.array(F.coalesce(F.col("t.visitors"), zero)),
        ).alias("unique_visitors_array"),
    )


def month_array_history(
    events: DataFrame,
    by: Sequence[str],
    measures: dict[str, Column],
    upto: str | dt.date | None = None,
    fill=0,
    require: Column | None = None,
) -> DataFrame:
    """Closed form of the daily loads: for every (key, month) with activity,
    one array per measure over the days from the month start to the month end
    (or ``upto`` in the last month), missing days = ``fill``.

    Two aggregations, both keyed by (key, month): per-day measures, then the
    per-month assembly from a map of at most 31 entries -- bounded however
    hot the key."""
    ev = no_later(events if require is None else events.filter(require), "event_date", upto)
    upto_col = ev.agg(F.max("event_date")).scalar() if upto is None else _d(upto)
    daily = ev.groupBy(*by, F.col("event_date").alias("d")).agg(
        *[m.alias(name) for name, m in measures.items()]
    )
    per_month = daily.groupBy(*by, F.trunc("d", "month").alias("month_start")).agg(
        *[
            F.map_from_entries(F.collect_list(F.struct(F.datediff("d", F.trunc("d", "month")), F.col(name)))).alias(
                f"_m_{name}"
            )
            for name in measures
        ],
        F.min("d").alias("first_found_date"),
    )
    # The partition date and day count are plain columns first: a scalar
    # subquery may not appear inside a higher-order function.
    out = per_month.withColumn("date_partition", F.least(F.last_day("month_start"), upto_col))
    out = out.withColumn("_n", F.datediff("date_partition", "month_start") + 1)
    idx = F.sequence(F.lit(0), F.col("_n") - 1)
    fill_col = F.lit(fill).cast("bigint")

    def dense(name: str) -> Column:
        m = F.col(f"_m_{name}")
        return F.transform(idx, lambda i: F.coalesce(m[i], fill_col))

    for name in measures:
        out = out.withColumn(name, dense(name))
    return out.select(*by, "month_start", *measures.keys(), "first_found_date", "date_partition")


def array_day_sums(
    monthly: DataFrame, ds: str | dt.date | Column, n: int = 3, array_col: str = "hit_array",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Per month, the sums of the first ``n`` array positions over one
    partition (``date_partition = ds``); missing positions count as 0."""
    names = list(names) if names else [f"num_hits_day_{i + 1}" for i in range(n)]
    dsc = ds if isinstance(ds, Column) else F.lit(str(ds))
    cur = monthly.filter(F.col("date_partition") == dsc)
    return cur.groupBy("month_start").agg(
        *[F.sum(F.coalesce(safe_get(array_col, i), F.lit(0))).alias(names[i]) for i in range(n)]
    )


def array_to_daily(arrays: DataFrame, array_col: str = "metric_array", width: int = 31) -> DataFrame:
    """Sum the arrays position by position and unpivot to one row per
    (metric, date).

    The arrays (at most ``width`` long: days of a month) are summed as vectors:
    one sum per position, all in one aggregation that combines map-side.  No
    array is taken apart into rows; only the sums are, one row per metric and
    month before."""
    positions = [f"_p{i}" for i in range(width)]
    sums = arrays.groupBy("metric_name", "month_start").agg(
        F.max(F.size(array_col)).alias("_n"), *[F.sum(F.get(array_col, F.lit(i))).alias(p) for i, p in enumerate(positions)]
    )
    daily = sums.unpivot(["metric_name", "month_start", "_n"], positions, "_at", "value")
    at = F.substring("_at", 3, 3).cast("int")
    return daily.filter(at < F.col("_n")).select("metric_name", F.date_add("month_start", at).alias("date"), "value")
