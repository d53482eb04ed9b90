"""Sources and sinks at the edge of the operators: CSV with a declared
schema, table / view registration, append, idempotent partition overwrite,
upsert, partitioned and bucketed layouts, file statistics, spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan.  Pass a schema: inference costs a full extra pass over the
    files and guesses types per run."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` for SQL.  (``spark.sql(q, df=df)`` with a ``{df}``
    placeholder avoids the global name.)"""
    df.createOrReplaceTempView(name)
    return df


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """INSERT ... SELECT: add files for one period without touching others."""
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition
    overwrite): re-running a period is idempotent and leaves the rest."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def overwrite_table(df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE into an existing catalog table, replacing only the
    partitions present in ``df`` (re-runs are idempotent).  Columns are matched
    by name: the insert itself goes by position, so the target's columns are
    selected first, and one that ``df`` lacks raises."""
    spark = df.sparkSession
    df = df.select(*[F.col(f"`{c}`") for c in spark.table(table).columns])
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def save_as(df: DataFrame, name: str, partition_cols: Sequence[str] = ()) -> None:
    """CREATE TABLE AS SELECT."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)


def write_snapshot(df: DataFrame, table: str, key: str, period_col: str, buckets: int, mode: str = "append",
                   path: str | None = None) -> None:
    """Store a cumulative snapshot table partitioned by period and bucketed
    (and sorted) by the entity key.  The next period's step reads one period
    partition whose rows are already hash-placed by key: its full join with
    the new facts shuffles only the new facts.  With ``path`` the files lie
    there instead of in the warehouse."""
    # a task per bucket: one file for each bucket and period
    w = df.repartition(buckets, key).write.mode(mode).partitionBy(period_col).bucketBy(buckets, key).sortBy(key)
    (w if path is None else w.option("path", path)).saveAsTable(table)


def ensure_table(spark: SparkSession, name: str, ddl_columns: str, using: str = "parquet",
                 partitioned_by: Sequence[str] = ()) -> None:
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING {using}{part}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last write wins on ``keys``: target rows without a delta row, plus the
    delta.  Write the result to a new location (or one partition with
    ``overwrite_partitions``); never overwrite a table while reading it."""
    return target.join(delta.select(*keys), list(keys), "left_anti").unionByName(delta)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*cols).parquet(path)


def write_layout(df: DataFrame, path: str, year_of: str | None = None,
                 sort_within: Sequence[str] = (), repartition_by: Sequence[str] = (),
                 n_partitions: int | None = None) -> None:
    """Hidden-partition style layout: a derived ``year`` partition column from
    a date (``years(date)``), optional clustering by columns and sorting
    within partitions so low-cardinality columns compress well."""
    out = df
    if year_of:
        out = out.withColumn("year", F.year(year_of))
    if repartition_by:
        out = out.repartition(n_partitions, *repartition_by) if n_partitions else out.repartition(*repartition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode("overwrite")
    if year_of:
        w = w.partitionBy("year")
    w.parquet(path)


def file_stats(df: DataFrame) -> DataFrame:
    """Number of files and total bytes behind a file-based DataFrame, from the
    hidden ``_metadata`` column (no listing on the driver)."""
    files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).distinct()
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("s").alias("bytes"))


def spine(spark: SparkSession, lo, hi, step: int = 1, name: str = "value") -> DataFrame:
    """Integer or date series [lo, hi] -- ``spark.range`` for integers,
    ``sequence`` for dates (generated on executors)."""
    if isinstance(lo, (dt.date, str)) and not isinstance(lo, int):
        seq = F.sequence(F.to_date(F.lit(str(lo))), F.to_date(F.lit(str(hi))), F.expr(f"INTERVAL {step} DAY"))
        return spark.range(1).select(F.explode(seq).alias(name))
    return spark.range(lo, hi + 1, step).withColumnRenamed("id", name)


def describe(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Column metadata: (name, type, nullable)."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
