"""Storage layout experiment: write the same data with different
sort-within-partition orders and compare bytes and file counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.session import scratch_path
from dimweave.sources.io import file_stats


def rebalanced(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows placed by the columns ``by`` (none: evenly) for writing, in
    partitions that adaptive execution sizes, splitting those of hot values."""
    hint = f"REBALANCE({', '.join(f'`{c}`' for c in by)})" if by else "REBALANCE"
    return df.sparkSession.sql(f"SELECT /*+ {hint} */ * FROM {{rows}}", rows=df)


def layout_report(
    df: DataFrame,
    variants: dict[str, Sequence[str]],
    partition_by: Sequence[str] = (),
    n_partitions: int | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """For each variant (name -> sort columns; empty = unsorted) write ``df``
    clustered by ``partition_by`` and sorted within partitions, then read back
    the file count, total bytes and rows.

    The rows are rebalanced by ``partition_by``: adaptive execution merges
    small partitions and splits large ones at its advisory size, so a day that
    holds a third of all rows becomes many files written by many tasks.  Only
    an explicit ``n_partitions`` fixes their number instead.

    Files go under the shared checkpoint folder (``spark.checkpoint.dir``)
    unless ``base_path`` is given."""
    spark = df.sparkSession
    rows = None
    for name, sort_cols in variants.items():
        path = f"{base_path}/{name}" if base_path else scratch_path(spark, f"layout-{name}")
        out = df.repartition(n_partitions, *partition_by) if n_partitions else rebalanced(df, partition_by)
        if sort_cols:
            out = out.sortWithinPartitions(*sort_cols)
        out.write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        n = stored.agg(F.count(F.lit(1)).alias("n_rows"))
        stats = file_stats(stored).unionByName(n, allowMissingColumns=True)
        whole = stats.agg(F.max("bytes").alias("bytes"), F.max("files").alias("files"), F.max("n_rows").alias("n_rows"))
        variant = whole.select(F.lit(name).alias("variant"), "bytes", "files", "n_rows")
        rows = variant if rows is None else rows.unionByName(variant)
    return rows
