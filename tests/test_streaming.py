"""Structured Streaming runs of the windowed jobs: the stream equals the batch
twin minus the windows still open at the end, rows behind the watermark are
dropped, and a restart from the checkpoint continues exactly once."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimweave.sources import adapters as A
from dimweave.streaming.ingest import ingest_enriched
from dimweave.streaming.io import file_sink, foreach_batch, read_file_stream, to_event_time, to_sinks
from dimweave.streaming.windows import sessionize, sessions_stream, tumbling_hits

WATERMARK = "15 seconds"


@pytest.fixture(scope="module")
def stream_dir(spark, tables, tmp_path_factory):
    """Web events (event_time as TIMESTAMP) in two on-time files, split at
    the middle of the period, then one late file with copies of day-1 rows."""
    base = str(tmp_path_factory.mktemp("stream"))
    ev = to_event_time(A.web_events(tables)).select(
        "event_id", "user_id", "device_id", "url", "host", "referrer", "ip", "ip_num", "event_time"
    )
    mid = dt.datetime(2024, 1, 15)
    src = os.path.join(base, "in")
    parts = [
        ev.filter(F.col("event_time") < F.lit(mid)),
        ev.filter(F.col("event_time") >= F.lit(mid)),
        ev.filter(F.col("event_time") < F.lit(dt.datetime(2024, 1, 2))).withColumn(
            "event_id", F.col("event_id") + 10_000_000
        ),
    ]
    staging = []
    for i, p in enumerate(parts):
        d = os.path.join(base, f"part{i}")
        p.coalesce(1).write.parquet(d)
        staging.append(d)
    os.makedirs(src)
    return base, src, staging, ev.schema, ev


def _feed(src, staging, upto):
    """Move staged parquet files into the source directory in order."""
    for i, d in enumerate(staging[:upto]):
        for f in sorted(os.listdir(d)):
            if f.endswith(".parquet"):
                target = os.path.join(src, f"{i:03d}-{f}")
                if not os.path.exists(target):
                    with open(os.path.join(d, f), "rb") as a, open(target, "wb") as b:
                        b.write(a.read())
                    time.sleep(1.1)


def _run(spark, df, name, checkpoint):
    q = df.writeStream.outputMode("append").format("memory").queryName(name).option(
        "checkpointLocation", checkpoint
    ).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_tumbling_stream_equals_closed_batch_windows_and_drops_late(spark, stream_dir):
    base, src, staging, schema, ev = stream_dir
    _feed(src, staging, 3)
    stream = read_file_stream(spark, src, schema, max_files_per_trigger=1)
    out = _run(spark, tumbling_hits(stream, ["host"], watermark=WATERMARK), "tumbling_out", f"{base}/ck1")
    max_t = ev.agg(F.max("event_time")).first()[0]
    closed_until = max_t - dt.timedelta(seconds=15)
    batch = tumbling_hits(ev, ["host"]).filter(
        F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(closed_until)
    )
    # the late file (copies of day-1 rows) must not change any window
    assertDataFrameEqual(out, batch)
    assert out.count() >= batch.count() > 0


def test_restart_from_checkpoint_is_exactly_once(spark, stream_dir, tmp_path):
    base, _, staging, schema, ev = stream_dir
    src = str(tmp_path / "src")
    os.makedirs(src)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")

    def run_once():
        stream = read_file_stream(spark, src, schema)
        agg = tumbling_hits(stream, ["host", "referrer"], watermark=WATERMARK)
        q = (
            agg.writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", ck).trigger(availableNow=True).start()
        )
        q.awaitTermination()

    _feed(src, staging, 1)
    run_once()
    _feed(src, staging, 2)
    run_once()
    got = spark.read.parquet(sink)
    closed_until = ev.agg(F.max("event_time")).first()[0] - dt.timedelta(seconds=15)
    batch = tumbling_hits(ev, ["host", "referrer"]).filter(
        F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(closed_until)
    )
    assertDataFrameEqual(got, batch)


def test_session_stream_equals_batch_sessions(spark, stream_dir):
    base, src, staging, schema, ev = stream_dir
    _feed(src, staging, 3)
    stream = read_file_stream(spark, src, schema, max_files_per_trigger=1)
    out = _run(spark, sessions_stream(stream, ["ip", "host"], "6 hours", watermark=WATERMARK), "sess_out",
               f"{base}/ck2")
    closed_until = ev.agg(F.max("event_time")).first()[0] - dt.timedelta(seconds=15)
    batch = sessionize(ev, ["ip", "host"], 6 * 3600).filter(F.col("session_end") <= F.lit(closed_until))
    assertDataFrameEqual(out, batch)


def test_stream_static_geo_enrichment_and_two_sinks(spark, stream_dir, tables, tmp_path):
    base, _, staging, schema, ev = stream_dir
    src = str(tmp_path / "src")
    os.makedirs(src)
    _feed(src, staging, 2)
    geo = A.geo_ranges(tables)
    stream = read_file_stream(spark, src, schema)
    seen = []
    raw, located_only = file_sink(str(tmp_path / "raw")), file_sink(str(tmp_path / "located"))
    both = to_sinks(raw, lambda batch, k: located_only(batch.filter(F.col("geodata") != "{}"), k))

    def sink(batch, batch_id):
        both(batch, batch_id)
        both(batch, batch_id)  # as after a failure before the checkpoint
        seen.append(batch_id)

    q = foreach_batch(ingest_enriched(stream, geo), sink, str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "raw")).drop("batch_id")
    on_time = ev.filter(F.col("event_id") < 10_000_000)
    assertDataFrameEqual(got, ingest_enriched(on_time, geo))
    located = spark.read.parquet(str(tmp_path / "located")).count()
    assert 0 < located < got.count()
    assert seen


def test_json_records_stream(spark, tables, tmp_path):
    """The Kafka path minus the connector: JSON text records -> typed rows
    with the ISO event time parsed; a malformed record gets a NULL time."""
    from dimweave.streaming.io import WEB_EVENT_JSON, parse_json_records

    ev = A.web_events(tables)
    lines = ev.select(
        F.to_json(
            F.struct(
                "url", "referrer", F.lit("ua").alias("user_agent"), "host", "ip", F.lit("{}").alias("headers"),
                F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
            )
        ).alias("value")
    )
    src = str(tmp_path / "json")
    lines.coalesce(1).write.text(src)
    with open(f"{src}/zz-bad.txt", "w") as f:
        f.write('{"url": "x", "event_time": "not a time"}\n')
    stream = parse_json_records(spark.readStream.text(src), WEB_EVENT_JSON)
    q = stream.writeStream.format("memory").queryName("json_out").start()
    q.processAllAvailable()
    q.stop()
    out = spark.table("json_out")
    assert out.count() == ev.count() + 1
    assert out.filter(F.col("event_timestamp").isNull()).count() == 1
    batch = parse_json_records(spark.read.text(src), WEB_EVENT_JSON)
    assertDataFrameEqual(out, batch)


def test_a_ledger_keeps_an_appending_sink_from_doubling_a_batch(spark, tmp_path):
    """A replayed batch, a batch that died after its write, and one that died
    with no way to clear it."""
    import shutil

    from dimweave.streaming.io import BatchLedger, UnknownBatch, append_sink, once

    target, ledger = str(tmp_path / "target"), BatchLedger(spark, str(tmp_path / "ledger"))
    batches = [spark.range(10 * i, 10 * i + 10) for i in range(3)]
    plain = append_sink(target)
    guarded = once(plain, ledger)
    for _ in range(2):  # the stream restarts and replays both
        guarded(batches[0], 0)
        guarded(batches[1], 1)
    assert spark.read.parquet(target).count() == 20

    def dies_after(batch, batch_id):
        plain(batch, batch_id)
        raise OSError("lost")

    with pytest.raises(OSError):
        once(dies_after, ledger)(batches[2], 2)
    with pytest.raises(UnknownBatch):
        guarded(batches[2], 2)
    assert spark.read.parquet(target).count() == 30

    def undo(batch_id):
        kept = spark.read.parquet(target).filter(f"batch_id <> {batch_id}").collect()
        shutil.rmtree(target)
        spark.createDataFrame(kept, "id long, batch_id long").write.parquet(target)

    for _ in range(2):
        once(plain, ledger, undo)(batches[2], 2)
    rows = spark.read.parquet(target)
    assert sorted(r.id for r in rows.collect()) == list(range(30))
    assert ledger.states(2) == {"started", "committed"} and ledger.states(7) == set()
