"""Stream sources and sinks.

Kafka and JDBC need connector jars that a deployment provides; the functions
only set options.  Tests drive the same code paths with the Parquet file
source and the memory / foreachBatch sinks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: event-time text format of the JSON web events.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

WEB_EVENT_JSON = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("url", "referrer", "user_agent", "host", "ip", "headers", "event_time")]
)


def read_kafka_json(spark: SparkSession, schema: T.StructType, options: dict[str, str],
                    time_field: str = "event_time", time_format: str = EVENT_TIME_FORMAT) -> DataFrame:
    """Kafka topic of JSON records -> typed columns plus ``event_timestamp``
    (NULL when the text does not parse).  ``options`` carries
    kafka.bootstrap.servers, subscribe, startingOffsets=latest, SASL
    settings, all from the deployment's configuration."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return parse_json_records(raw, schema, "value", time_field, time_format)


def parse_json_records(raw: DataFrame, schema: T.StructType, value_col: str = "value",
                       time_field: str = "event_time", time_format: str = EVENT_TIME_FORMAT) -> DataFrame:
    """JSON text records (a Kafka ``value``, a line of a text file) -> typed
    columns plus ``event_timestamp``; a malformed record yields NULL fields
    and a NULL timestamp instead of failing the stream."""
    parsed = raw.select(F.from_json(F.col(value_col).cast("string"), schema).alias("r")).select("r.*")
    return with_event_timestamp(parsed, time_field, time_format)


def with_event_timestamp(df: DataFrame, time_field: str = "event_time",
                         time_format: str = EVENT_TIME_FORMAT) -> DataFrame:
    return df.withColumn("event_timestamp", F.try_to_timestamp(F.col(time_field), F.lit(time_format)))


def read_file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def to_event_time(df: DataFrame, col: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): reinterpret the wall
    clock in the session time zone (UTC in our sessions)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def write_kafka(df: DataFrame, topic: str, options: dict[str, str], checkpoint: str):
    """Every row as one JSON record."""
    out = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    return (
        out.writeStream.format("kafka").options(**options).option("topic", topic)
        .option("checkpointLocation", checkpoint).start()
    )


BatchSink = Callable[[DataFrame, int], None]


class UnknownBatch(RuntimeError):
    """A batch was started before and nobody knows what of it has arrived."""


class BatchLedger:
    """Batch ids beside a sink that can't replace what it has written: one
    small file per batch that was started, one per batch that was committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def states(self, batch_id: int) -> set[str]:
        try:
            log = self.spark.read.schema("batch_id long, state string").json(self.path)
        except Exception as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return set()
            raise
        return {r.state for r in log.filter(F.col("batch_id") == batch_id).distinct().collect()}

    def log(self, batch_id: int, state: str) -> None:
        entry = self.spark.range(0, 1, 1, 1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(state).alias("state"))
        entry.write.mode("append").json(self.path)


def once(sink: BatchSink, ledger: BatchLedger, undo: Callable[[int], None] | None = None) -> BatchSink:
    """``sink`` for appending targets, each batch applied once.

    The ledger is read before anything is written: a batch that was committed
    is skipped.  One that was started and not committed may have arrived in
    part; ``undo`` (such as a delete by batch id) clears it before it is
    written again, and without one the batch is refused instead of doubled."""

    def write(batch: DataFrame, batch_id: int) -> None:
        states = ledger.states(batch_id)
        if "committed" in states:
            return
        if "started" in states:
            if undo is None:
                raise UnknownBatch(f"batch {batch_id} was started before; clear it from the target and the ledger")
            undo(batch_id)
        else:
            ledger.log(batch_id, "started")
        sink(batch, batch_id)
        ledger.log(batch_id, "committed")

    return write


def append_sink(path: str, fmt: str = "parquet") -> BatchSink:
    """Append a micro-batch to a folder of files, with its batch id: a replay
    appends it again unless ``once`` guards it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.format(fmt).mode("append").save(path)

    return write


def jdbc_sink(url: str, table: str, properties: dict[str, str], batch_col: str | None = None) -> BatchSink:
    """Append a micro-batch to a JDBC table, columns as they are and, if
    ``batch_col`` is given, the batch id under that name (what an ``undo``
    deletes by).  JDBC has no overwrite of one batch: wrap it in ``once``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if batch_col is None else batch.withColumn(batch_col, F.lit(batch_id).cast("long"))
        rows.write.jdbc(url, table, mode="append", properties=properties)

    return write


def file_sink(path: str, fmt: str = "parquet") -> BatchSink:
    """Write each micro-batch to a partition of its own (``batch_id=N``),
    replacing it: a replayed batch is there once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def to_sinks(*sinks: BatchSink) -> BatchSink:
    """One sink that hands every micro-batch, computed once, to all of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def write_jdbc_stream(df: DataFrame, url: str, table: str, properties: dict[str, str], checkpoint: str,
                      trigger_seconds: int = 10, ledger: str | None = None, undo: Callable[[int], None] | None = None):
    """Append each micro-batch through JDBC; with a ``ledger`` folder each one
    once (see ``once``)."""
    sink = jdbc_sink(url, table, properties, "batch_id" if undo is not None else None)
    if ledger is not None:
        sink = once(sink, BatchLedger(df.sparkSession, ledger), undo)
    return foreach_batch(df, sink, checkpoint, trigger_seconds)


def foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger_seconds: int | None = None, available_now: bool = False, output_mode: str = "append"):
    w = df.writeStream.outputMode(output_mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
