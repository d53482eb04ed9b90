"""Stateless enrich-and-load: web events with a geolocation looked up from an
IP range table (instead of one HTTP call per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.operators.joins import is_small
from dimweave.session import scratch_path

#: Most rows (an interval or a part of one, by address block) to broadcast.
GEO_BROADCAST_ROWS = 200_000
#: Bits of an address, and most files that hold the intervals.
ADDRESS_BITS = 32
GEO_FILES = 64
#: Block sizes in bits: a range is listed under the largest blocks that it
#: fills, so even the whole address space is a few hundred rows.
LEVELS = (8, 16, 24)


def _entry(bits: int):
    return lambda block: F.struct(F.lit(bits).alias("level"), block.alias("block"))


def _blocks(lo: Column, hi: Column) -> Column:
    """(level, block) entries of a range: blocks of the finest level that it
    touches, but for those inside a coarser block that it fills."""
    entries = []
    for k, bits in enumerate(LEVELS):
        size = 1 << bits
        if k == 0:
            first, last = F.floor(lo / size), F.floor(hi / size)
        else:
            first, last = F.ceil(lo / size), F.floor((hi + 1) / size) - 1
        pieces = [(first, last)]
        if k + 1 < len(LEVELS):  # without what a coarser level holds
            ratio = 1 << (LEVELS[k + 1] - bits)
            above, below = F.ceil(lo / (size * ratio)), F.floor((hi + 1) / (size * ratio)) - 1
            filled = below >= above
            pieces = [
                (first, F.when(filled, F.least(last, above * ratio - 1)).otherwise(last)),
                (F.when(filled, F.greatest(first, (below + 1) * ratio)).otherwise(last + 1), last),
            ]
        for a, b in pieces:
            blocks = F.when(b >= a, F.sequence(a.cast("long"), F.greatest(a, b).cast("long"))).otherwise(F.array().cast("array<bigint>"))
            entries.append(F.transform(blocks, _entry(bits)))
    return F.concat(*entries)


def _aligned(ranges: DataFrame) -> DataFrame:
    """The fewest aligned power-of-two blocks (level, prefix) that make up each
    range: at most two of each level, those that no larger one of the range
    holds."""
    of_level = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(ADDRESS_BITS))))
    of_level = of_level.selectExpr(
        "span",
        "level",
        "(_lo + shiftleft(1L, level) - 1) div shiftleft(1L, level) as first",
        "(_hi + 1) div shiftleft(1L, level) as end",
        "2 * ((_lo + shiftleft(2L, level) - 1) div shiftleft(2L, level)) as held",
        "2 * ((_hi + 1) div shiftleft(2L, level)) as held_end",
    )
    ends = F.explode(F.array_distinct(F.array(F.col("first"), F.col("end") - 1))).alias("prefix")
    out = of_level.filter("end > first").select("*", ends)
    return out.filter("prefix < held or prefix >= held_end").select("level", "prefix", "span")


def flat_intervals(geo: DataFrame) -> DataFrame:
    """Overlapping ranges as disjoint intervals, each with the range that
    counts there: the narrowest (then the lowest) one around it.

    A sweep over the ranges' ends without a queue: every range becomes its
    aligned blocks, of equal blocks the best range stays (an aggregate that
    combines map-side), and every end takes the best block around it, one of
    each level, by an equi-join.  What counts changes at ends only, so an
    interval reaches from one end to the next."""
    span = F.struct((F.col("ip_hi") - F.col("ip_lo")).alias("width"), "ip_lo", "ip_hi", "country", "state", "city")
    ranges = geo.filter("ip_lo <= ip_hi").select(span.alias("span"), F.col("ip_lo").alias("_lo"), F.col("ip_hi").alias("_hi"))
    blocks = _aligned(ranges).groupBy("level", "prefix").agg(F.min("span").alias("span"))
    ends = ranges.select(F.explode(F.array(F.col("_lo"), F.col("_hi") + 1)).alias("at")).distinct()
    around = ends.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(ADDRESS_BITS)))).withColumn("prefix", F.expr("shiftright(at, level)"))
    best = around.join(blocks, ["level", "prefix"], "left").groupBy("at").agg(F.min("span").alias("span"))
    # the next end: within 65,536 addresses by a window, across them by the
    # first end of the next part that has one (one row per part)
    parts = best.withColumn("_part", F.shiftright("at", 16))
    following = Window.partitionBy("_part").orderBy("at")
    firsts = parts.groupBy("_part").agg(F.min("at").alias("_first"))
    later = firsts.select("_part", F.lead("_first").over(Window.orderBy("_part")).alias("_later"))
    ended = parts.withColumn("_next", F.lead("at").over(following)).join(later, "_part")
    inside = ended.filter(F.col("span").isNotNull())
    return inside.select(
        F.col("at").alias("ip_lo"), (F.coalesce("_next", "_later") - 1).alias("ip_hi"), "span.country", "span.state", "span.city"
    )


def geo_lookup(events: DataFrame, geo: DataFrame, ip_col: str = "ip_num",
               max_broadcast_rows: int = GEO_BROADCAST_ROWS) -> DataFrame:
    """Left range join of ``ip_col`` into [ip_lo, ip_hi] ranges, adding
    ``geodata`` JSON {country, state, city}, or '{}' without a match.  Where
    ranges overlap, the narrowest (then the lowest) one counts, so an event
    stays one row.

    The ranges become disjoint intervals once (written to the shared folder),
    and those are listed under address blocks of three sizes.  An event looks
    up its block of each size: equi-joins, of which at most one matches, never
    a nested loop.  The listed rows are flat and broadcast only where all of
    them are proved to be few; a stream-static join keeps the stream on the
    left."""
    spark = geo.sparkSession
    path = scratch_path(spark, "geo_intervals")
    at = F.explode(_blocks(F.col("ip_lo"), F.col("ip_hi"))).alias("at")
    flat_intervals(geo).select("*", at).select("at.level", "at.block", "ip_lo", "ip_hi", "country", "state", "city").coalesce(
        GEO_FILES
    ).write.parquet(path)
    listed = spark.read.parquet(path)
    few = is_small(listed, max_broadcast_rows)
    ip, out, found = F.col(ip_col), events, []
    for bits in LEVELS:
        own = listed.filter(F.col("level") == bits).select(
            F.col("block").alias("_block"), F.col("ip_lo").alias("_lo"), F.col("ip_hi").alias("_hi"),
            F.struct("country", "state", "city").alias(f"_place_{bits}"),
        )
        inside = (F.shiftright(ip, bits) == F.col("_block")) & ip.between(F.col("_lo"), F.col("_hi"))
        out = out.join(F.broadcast(own) if few else own, inside, "left").drop("_block", "_lo", "_hi")
        found.append(F.col(f"_place_{bits}"))
    place = F.coalesce(*found)
    geodata = F.when(place.isNull(), F.lit("{}")).otherwise(F.to_json(place))
    return out.select(*events.columns, geodata.alias("geodata"))


def ingest_enriched(events: DataFrame, geo: DataFrame, **kw) -> DataFrame:
    """processed_events rows: ip, event_timestamp, referrer, host, url,
    geodata.  Works on a batch or a streaming ``events``."""
    enriched = geo_lookup(events, geo, **kw)
    return enriched.select(
        "ip", F.col("event_time").alias("event_timestamp"), "referrer", "host", "url", "geodata"
    )
