"""Stored cumulative tables: one partition per period, bucketed by entity, with
a ledger of commits.

A scheduled step reads the partition of the period before it, joins it with
that period's facts and replaces its own partition.  The ledger (a small table
beside the data) says which partitions are whole: a step that died halfway
leaves its period marked as started, and the next step refuses to build on it
until it has been run again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimweave.session import scratch_path
from dimweave.sources.io import overwrite_table, write_snapshot

STARTED, COMMITTED = "started", "committed"


class NotCommitted(RuntimeError):
    """A period was asked for that no run has finished."""


class SnapshotTable:
    """A cumulative table stored under a catalog name, its files and ledger
    below ``path`` (a shared folder).

    Rows of one period lie in one partition, placed by ``key`` in ``buckets``
    buckets, so the next step's full join shuffles only the new facts."""

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, period_col: str, buckets: int = 8):
        self.spark, self.name, self.key, self.period_col, self.buckets = spark, name, key, period_col, buckets
        self.data, self.ledger = f"{path.rstrip('/')}/data", f"{path.rstrip('/')}/ledger"

    @classmethod
    def scratch(cls, spark: SparkSession, name: str, key: str, period_col: str, buckets: int = 8) -> SnapshotTable:
        """A table with a fresh name below the shared checkpoint folder."""
        return cls(spark, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, name), key, period_col, buckets)

    def _log(self, period, state: str, rows: int | None) -> None:
        entry = [F.lit(str(period)).alias("period"), F.lit(state).alias("state"), F.lit(rows).cast("long").alias("n_rows")]
        log = self.spark.range(0, 1, 1, 1).select(*entry, F.lit(time.time_ns()).alias("at"))
        log.write.mode("append").parquet(self.ledger)

    def periods(self) -> dict[str, int]:
        """Rows of every committed period (the ledger's newest entry counts)."""
        try:
            log = self.spark.read.schema("period string, state string, n_rows long, at long").parquet(self.ledger)
        except Exception as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return {}
            raise
        newest = log.groupBy("period").agg(F.max_by(F.struct("state", "n_rows"), "at").alias("e"))
        return {r.period: r.e.n_rows for r in newest.collect() if r.e.state == COMMITTED}

    def read(self, period) -> DataFrame:
        """The rows of a committed period: a scan of its partition only."""
        if str(period) not in self.periods():
            raise NotCommitted(f"{self.name}: {self.period_col} {period} is not committed")
        return self._partition(period)

    def _partition(self, period) -> DataFrame:
        return self.spark.table(self.name).filter(F.col(self.period_col) == F.lit(period))

    def write(self, rows: DataFrame, period) -> int:
        """Store ``rows`` as the partition of ``period``, replacing what an
        earlier run left there, and commit it.  Returns their number; no rows
        at all raise (the partition can't be replaced by nothing) and leave
        the period uncommitted."""
        exists = self.spark.catalog.tableExists(self.name)
        if exists:  # before the first period there is no commit to take back
            self._log(period, STARTED, None)
        counted = Observation()
        rows = rows.filter(F.col(self.period_col) == F.lit(period)).observe(counted, F.count(F.lit(1)).alias("n"))
        if exists:
            overwrite_table(rows.repartition(self.buckets, self.key), self.name)
        else:
            write_snapshot(rows, self.name, self.key, self.period_col, self.buckets, mode="overwrite", path=self.data)
        self.spark.catalog.refreshTable(self.name)
        n = counted.get["n"]
        if not n:
            raise ValueError(f"{self.name}: no rows for {self.period_col} {period}")
        self._log(period, COMMITTED, n)
        return n

    def advance(self, step: Callable[[DataFrame], DataFrame], previous, period) -> DataFrame:
        """Run ``step`` on the stored partition of ``previous``, store its
        result as ``period`` and return that partition."""
        self.write(step(self.read(previous)), period)
        return self._partition(period)
