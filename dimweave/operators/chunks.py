"""Cumulative histories in chunks.

A snapshot table whose rows each carry the whole history grows with the square
of the number of periods.  Here a history is cut into chunks of a fixed number
of periods: a closed chunk is stored once per entity, and a snapshot row holds
only the entries of the chunk that its period lies in (its open tail) and that
chunk's number, which says which closed chunks come before.  Storage grows
with entries and with rows x chunk size.  ``expand`` gives the whole lists
back, for the rows that are asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_DAYS = 30


def chunk_number(day: Column, size: int) -> Column:
    """The chunk of ``size`` days that a day lies in, counted from 1970-01-01."""
    return F.floor(F.datediff(day, F.lit("1970-01-01")) / size).cast("int")


def chunk_days(events: DataFrame, keys: Sequence[str], upto: str | dt.date, size: int = CHUNK_DAYS,
               day_col: str = "event_date") -> DataFrame:
    """keys, chunk, days (ascending, distinct): one row for every chunk from an
    entity's first one to that of ``upto``, without days where it was idle.

    One shuffle: each entity's distinct days (combined map-side, bounded by the
    number of periods) are cut where they are collected."""
    last = F.to_date(F.lit(str(upto)))
    known = events.filter((F.col(day_col) <= last) & F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())
    days = known.groupBy(*keys).agg(F.array_sort(F.collect_set(day_col)).alias("_days"))
    chunks = F.sequence(chunk_number(F.element_at("_days", 1), size), chunk_number(last, size))
    cut = days.select(*keys, "_days", F.explode(chunks).alias("chunk"))
    return cut.select(*keys, "chunk", F.filter("_days", lambda d: chunk_number(d, size) == F.col("chunk")).alias("days"), F.element_at("_days", 1).alias("first_day"))


def closed_chunks(chunks: DataFrame, keys: Sequence[str], upto: str | dt.date, size: int = CHUNK_DAYS) -> DataFrame:
    """keys, chunk, days of the chunks that have ended before ``upto`` and hold
    days: rows that never change again."""
    open_ = chunk_number(F.to_date(F.lit(str(upto))), size)
    return chunks.filter((F.col("chunk") < open_) & (F.size("days") > 0)).select(*keys, "chunk", "days")


def chunked_snapshots(chunks: DataFrame, keys: Sequence[str], upto: str | dt.date, size: int = CHUNK_DAYS,
                      date_name: str = "date") -> DataFrame:
    """keys, date, chunk, tail (days of the date's chunk up to the date): a row
    for every day from an entity's first one on, from the chunks alone."""
    begin = F.date_add(F.lit("1970-01-01"), F.col("chunk") * size)
    low = F.greatest(F.col("first_day"), begin)
    high = F.least(F.to_date(F.lit(str(upto))), F.date_add(begin, size - 1))
    rows = chunks.select(*keys, "chunk", "days", F.explode(F.sequence(low, high, F.expr("INTERVAL 1 DAY"))).alias(date_name))
    return rows.select(*keys, date_name, "chunk", F.filter("days", lambda d: d <= F.col(date_name)).alias("tail"))


def expand(snapshots: DataFrame, closed: DataFrame, keys: Sequence[str], list_name: str) -> DataFrame:
    """Snapshot rows with their whole lists (ascending): the closed chunks
    before each row's own, then its tail."""
    entry = F.struct("chunk", "days")
    before = closed.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_closed"))
    rows = snapshots.join(before, list(keys), "left")
    nothing = F.array().cast(before.schema["_closed"].dataType)
    earlier = F.filter(F.coalesce("_closed", nothing), lambda c: c["chunk"] < F.col("chunk"))
    whole = F.concat(F.flatten(F.transform(earlier, lambda c: c["days"])), F.col("tail"))
    return rows.withColumn(list_name, whole).drop("_closed", "chunk", "tail")
