"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (coalesce small shuffle
# partitions, split skewed join partitions), UTC session time and no web UI.
# Broadcasts: the static planner's threshold trusts a compressed-file-size
# estimate, which can understate a table's in-memory size many times, so it
# is off; joins are demoted to broadcast at run time only when AQE has
# *measured* the materialised side under 32 MB, and operators broadcast
# explicitly only behind a row-count proof (operators/joins.py).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    master: str | None = "local[*]",
    app: str = "dimweave",
    shuffle_partitions: int = 8,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to roughly input bytes / 128 MB and let AQE
    coalesce.  ``spark.checkpoint.dir`` is only set here when the caller did
    not provide one (local runs and tests).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        # local runs and tests get a scratch folder; on a cluster the shared
        # folder is required only when a job actually cuts lineage
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names that folder (a shared filesystem / object store path);
    it is read from the session.  Only a local-mode session without one gets a
    fresh scratch folder, as tests need.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job must name a shared folder"
            )
        path = tempfile.mkdtemp(prefix="dimweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used by loops that fold a step operator over many periods, where the
    plan would otherwise grow with every period.  Reliable (not local)
    checkpoints survive executor loss.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}tables/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()
