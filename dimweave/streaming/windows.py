"""Event-time windows: tumbling hit counts and sessions.

The aggregate is written once and used by both the batch twin and the
streaming query (``withWatermark`` + append mode, where a window is emitted
once the watermark passes its end and rows behind the watermark are
dropped)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tumbling_hits(events: DataFrame, by: Sequence[str] = ("host",), minutes: int = 5,
                  time_col: str = "event_time", watermark: str | None = None) -> DataFrame:
    """Hits per tumbling window and ``by`` (count of non-null ``by[0]``).
    Pass ``watermark`` (e.g. "15 seconds") for a stream."""
    ev = events.withWatermark(time_col, watermark) if watermark else events
    g = ev.groupBy(F.window(time_col, f"{minutes} minutes").alias("w"), *by).agg(
        F.count(F.col(by[0])).alias("num_hits")
    )
    return g.select(F.col("w.start").alias("window_start"), *by, "num_hits")


def sessions_stream(events: DataFrame, by: Sequence[str] = ("ip", "host"), gap: str = "5 minutes",
                    time_col: str = "event_time", watermark: str = "15 seconds") -> DataFrame:
    """Streaming sessions: ``session_window`` state per key, closed when the
    watermark passes the session end."""
    ev = events.withWatermark(time_col, watermark)
    g = ev.groupBy(*by, F.session_window(time_col, gap).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*by, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def sessionize(events: DataFrame, by: Sequence[str] = ("ip", "host"), gap_seconds: int = 300,
               time_col: str = "event_time", tiebreak: str | None = "event_id",
               bucket_unit: str = "minute") -> DataFrame:
    """Batch sessions with the semantics of ``session_window``: an event more
    than ``gap_seconds`` after the previous event of its key starts a new
    session; a session ends ``gap`` after its last event.

    Distributed even for a key holding a third of all events: events are
    ordered only within (key, minute bucket); a per-bucket summary (first,
    last, internal starts) ordered per key -- one row per bucket -- links
    each bucket to the previous one and numbers the sessions; then a
    partially aggregated group by (key, session) builds the output."""
    gap = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    t = F.col(time_col)
    order = [time_col] + ([tiebreak] if tiebreak else [])
    # rows without an event time belong to no session (as in session_window)
    ev = events.filter(t.isNotNull()).select(*by, *order).withColumn("_b", F.date_trunc(bucket_unit, t))
    wb = Window.partitionBy(*by, "_b").orderBy(*order)
    local_prev = F.lag(t).over(wb)
    ev = ev.withColumn("_internal", (local_prev.isNotNull() & (t > local_prev + gap)).cast("int"))
    ev = ev.withColumn("_run", F.sum("_internal").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    per_bucket = ev.groupBy(*by, "_b").agg(
        F.min(time_col).alias("_bmin"), F.max(time_col).alias("_bmax"), F.sum("_internal").alias("_bint")
    )
    wk = Window.partitionBy(*by).orderBy("_b")
    prev_max = F.lag("_bmax").over(wk)
    per_bucket = per_bucket.withColumn(
        "_first", (prev_max.isNull() | (F.col("_bmin") > prev_max + gap)).cast("int")
    ).withColumn("_starts", F.col("_first") + F.col("_bint"))
    per_bucket = per_bucket.withColumn(
        "_off", F.coalesce(F.sum("_starts").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(*by, "_b", "_first", "_off")
    j = ev.join(per_bucket, [*by, "_b"])
    j = j.withColumn("_session", F.col("_off") + F.col("_first") + F.col("_run"))
    return j.groupBy(*by, "_session").agg(
        F.min(time_col).alias("session_start"),
        (F.max(time_col) + gap).alias("session_end"),
        F.count(F.lit(1)).alias("n"),
    ).drop("_session")


def session_stats(sessions: DataFrame, by: Sequence[str] = ("host",)) -> DataFrame:
    """Average events per session and number of sessions, per ``by``."""
    return sessions.groupBy(*by).agg(F.avg("n").alias("avg_events"), F.count(F.lit(1)).alias("n_sessions"))
