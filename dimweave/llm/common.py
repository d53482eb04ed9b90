"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import sys
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

import dimweave
from dimweave.session import checkpoint_dir
from dimweave.sources.tables import table_path

# str.split() also splits at the four controls 1C-1F, which the Unicode
# White_Space property (what the tokenizer's patterns use) does not hold.
_CONTROL_SEPARATORS = re.compile("[\x1c-\x1f]")
_NOT_WHITE_SPACE = re.compile(
    "[^\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def white_space_chunks(text: str) -> list[str]:
    """The maximal runs of ``text`` without Unicode white space."""
    if _CONTROL_SEPARATORS.search(text):
        return _NOT_WHITE_SPACE.findall(text)
    return text.split()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read back: cuts the
    lineage with files that every executor can read again.  Much of what is
    written are digests, which Parquet's default codec doesn't shorten."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package: once per application, unless
    the job was submitted with it (``--py-files``), the driver serves a zip of
    its sources."""
    sc = spark.sparkContext
    if any("dimweave" in f for f in sc._python_includes):
        return
    root = Path(dimweave.__file__).parent
    archive = os.path.join(SparkFiles.getRootDirectory(), f"dimweave-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent).as_posix())
    sc.addPyFile(archive)


def release_memory() -> None:
    """Give freed memory back to the system.  Workers are kept between tasks;
    what their allocators hold on to after one stage would be missing in the
    next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


_model: dict = {}


def worker_model(key, make: Callable):
    """What a worker keeps between tasks: the model of the operator that ran
    last.  Workers outlive stages, so another operator's model makes room."""
    if key not in _model:
        _model.clear()
        release_memory()
        _model[key] = make()
    return _model[key]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``max_bytes`` bytes
    (one row at least), so that a task's working set doesn't depend on how
    many rows Arrow packs together."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, int(n * max_bytes / max(1, batch.column(column).nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, step)
    release_memory()
