"""Slowly changing dimension, type 2: one row per (entity, unchanged run of
tracked attributes) with its first and last period.

``scd2_history`` is the backfill (gaps and islands: change flag, running sum
as streak id, min/max per streak).  ``scd2_step`` extends the previous SCD
snapshot by one period with a single full join.  Attribute comparisons are
null-safe, so a NULL attribute neither vanishes nor splits a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(prev_cols: Sequence[Column], cur_cols: Sequence[Column]) -> Column:
    cond = F.lit(False)
    for p, c in zip(prev_cols, cur_cols):
        cond = cond | ~p.eqNullSafe(c)
    return cond


def scd2_history(
    snap: DataFrame,
    key: str,
    period_col: str,
    attrs: Sequence[str],
    upto: int | None = None,
    start_name: str = "start_period",
    end_name: str = "end_period",
    as_of_name: str | None = "as_of",
) -> DataFrame:
    """Runs of unchanged ``attrs`` per ``key`` over the snapshot periods up to
    ``upto`` (all periods when None).

    The window and the aggregate share the partitioning on ``key``: one
    exchange in total.  A run can never be larger than the number of periods,
    so even a hot key stays a bounded sort."""
    src = snap if upto is None else snap.filter(F.col(period_col) <= upto)
    w = Window.partitionBy(key).orderBy(period_col)
    first_row = F.lag(period_col).over(w).isNull()
    change = first_row | _changed([F.lag(a).over(w) for a in attrs], [F.col(a) for a in attrs])
    flagged = src.select(key, period_col, *attrs, change.cast("int").alias("_chg"))
    streaks = flagged.withColumn(
        "_streak", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    out = streaks.groupBy(key, "_streak", *attrs).agg(
        F.min(period_col).alias(start_name), F.max(period_col).alias(end_name)
    )
    cols = [key, *attrs, start_name, end_name]
    if as_of_name:
        as_of = F.lit(upto) if upto is not None else src.agg(F.max(period_col)).scalar()
        out = out.withColumn(as_of_name, as_of.cast("int"))
        cols.append(as_of_name)
    return out.select(*cols)


def scd2_step(
    scd: DataFrame,
    snap: DataFrame,
    key: str,
    period_col: str,
    attrs: Sequence[str],
    period: int,
    drop_absent: bool = False,
    start_name: str = "start_period",
    end_name: str = "end_period",
    as_of_name: str = "as_of",
) -> DataFrame:
    """Extend the SCD (as of ``period - 1``) with the snapshot of ``period``.

    historical rows (closed before the previous period) pass through; open
    rows are full-joined with today's snapshot once and emit:
    unchanged -> the run extended to ``period``; changed -> the old run as is
    plus a new run; new entity -> a new run.  Entities missing from today's
    snapshot keep their runs as they are; ``drop_absent=True`` drops their
    open run, as an input that holds every entity allows.

    Running a period again changes nothing: what an earlier run of ``period``
    has added is taken back first (runs that start in it go, runs that reach
    into it end before it)."""
    prev = period - 1
    scd = scd.filter(F.col(start_name) <= prev).withColumn(end_name, F.least(F.col(end_name), F.lit(prev).cast("int")))
    historical = scd.filter(F.col(end_name) < prev).select(key, *attrs, start_name, end_name)
    last = scd.filter(F.col(end_name) == prev).alias("ls")
    cur = snap.filter(F.col(period_col) == period).select(key, *attrs).alias("ts")
    j = cur.join(last, F.col(f"ts.{key}") == F.col(f"ls.{key}"), "full")

    def run(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{a}").alias(a) for a in attrs], start.alias(start_name), end.alias(end_name))

    has_ts = F.col(f"ts.{key}").isNotNull()
    has_ls = F.col(f"ls.{key}").isNotNull()
    same = ~_changed([F.col(f"ls.{a}") for a in attrs], [F.col(f"ts.{a}") for a in attrs])
    p = F.lit(period)
    old_run = run("ls", F.col(f"ls.{start_name}"), F.col(f"ls.{end_name}"))
    new_run = run("ts", p, p)
    extended = run("ts", F.col(f"ls.{start_name}"), p)
    runs = (
        F.when(has_ts & has_ls & same, F.array(extended))
        .when(has_ts & has_ls, F.array(old_run, new_run))
        .when(has_ts, F.array(new_run))
        .otherwise(F.array(old_run))
    )
    emitted = j.select(F.coalesce(F.col(f"ts.{key}"), F.col(f"ls.{key}")).alias(key), has_ts.alias("_ts"), F.inline(runs))
    if drop_absent:
        emitted = emitted.filter(F.col("_ts"))
    out = emitted.select(key, *attrs, start_name, end_name).unionByName(historical)
    return out.withColumn(as_of_name, F.lit(period).cast("int"))
