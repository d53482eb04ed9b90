"""Sources, sinks and contracts at the edge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing import assertDataFrameEqual

from dimweave.operators.layout import layout_report
from dimweave.operators.quality import enforce_schema, quality_report
from dimweave.sources import io
from dimweave.sources.tables import SCHEMAS


def test_read_csv_with_declared_schema(spark, tables, tmp_dir):
    nation = tables.nation
    nation.write.mode("overwrite").option("header", True).csv(f"{tmp_dir}/nation")
    back = io.read_csv(spark, f"{tmp_dir}/nation", SCHEMAS["nation"])
    assert back.schema == SCHEMAS["nation"]
    assertDataFrameEqual(back, nation)


def test_enforce_schema_fail_and_quarantine(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("x", T.StringType(), True)])
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, x string")
    valid, invalid = enforce_schema(df, schema, mode="quarantine")
    assert [r.id for r in valid.collect()] == [1] and invalid.count() == 1
    with pytest.raises(Exception, match="non-nullable"):
        enforce_schema(df, schema, mode="fail").collect()
    assert enforce_schema(df.filter("id is not null"), schema).count() == 1


def test_upsert_last_write_wins(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assertDataFrameEqual(io.upsert(target, delta, ["k"]), spark.createDataFrame(
        [(1, "a"), (2, "B"), (3, "C")], "k int, v string"))


def test_partition_overwrite_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    d1 = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, ds string")
    io.write_partitioned(d1, path, ["ds"])
    rerun = spark.createDataFrame([(9, "2024-01-02")], "v int, ds string")
    io.overwrite_partitions(rerun, path, ["ds"])
    io.overwrite_partitions(rerun, path, ["ds"])
    got = sorted((r.v, str(r.ds)) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2024-01-01"), (9, "2024-01-02")]
    io.append(spark.createDataFrame([(3, "2024-01-03")], "v int, ds string"), path, ["ds"])
    assert spark.read.parquet(path).count() == 3


def test_layout_year_partition_and_file_stats(spark, tables, tmp_dir):
    orders = tables.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("d"))
    io.write_layout(orders, f"{tmp_dir}/o", year_of="d", sort_within=["o_orderpriority"],
                    repartition_by=["d"], n_partitions=2)
    back = spark.read.parquet(f"{tmp_dir}/o")
    assert back.filter(F.col("year") == 1998).count() == orders.filter(F.year("d") == 1998).count()
    stats = io.file_stats(back).first()
    assert stats.files >= 1 and stats.bytes > 0


def test_layout_report(spark, tables, tmp_dir):
    df = tables.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    rep = layout_report(df, {"none": [], "by_priority": ["o_orderpriority", "o_orderstatus"]}, base_path=tmp_dir)
    rows = {r.variant: r for r in rep.collect()}
    assert set(rows) == {"none", "by_priority"} and all(r.bytes > 0 for r in rows.values())


def test_spine_describe_tables_views(spark, tmp_dir):
    assert [r.value for r in io.spine(spark, 1996, 1999).collect()] == [1996, 1997, 1998, 1999]
    days = [r.value for r in io.spine(spark, "2024-01-30", "2024-02-02").collect()]
    assert days[0] == dt.date(2024, 1, 30) and len(days) == 4
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert io.describe(df) == [("a", "int", True), ("b", "string", True)]
    io.as_view(df, "v_io_test")
    assert spark.sql("SELECT count(*) AS n FROM v_io_test").first().n == 1
    io.ensure_table(spark, "t_io_test", "a INT, ds STRING", partitioned_by=["ds"])
    io.ensure_table(spark, "t_io_test", "a INT, ds STRING", partitioned_by=["ds"])
    io.save_as(df, "t_io_ctas")
    assert io.table(spark, "t_io_ctas").count() == 1
    io.drop_table(spark, "t_io_test")
    io.drop_table(spark, "t_io_ctas")


def test_quality_report_counts(spark):
    df = spark.createDataFrame([(1, None, "2024-01-01"), (1, "x", "2024-01-01"), (2, "y", "2024-01-02")],
                               "k int, v string, ds string")
    rep = {r.check: r.n_bad for r in quality_report(df, ["k"], ["v"], "ds", "2024-01-03").collect()}
    assert rep == {"duplicate_key:k": 1, "null:v": 1, "stale_partition:ds": 1}


def test_overwrite_table_dynamic_partitions(spark):
    io.drop_table(spark, "t_io_ow")
    io.ensure_table(spark, "t_io_ow", "v INT, ds STRING", partitioned_by=["ds"])
    io.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, ds string"), "t_io_ow")
    io.overwrite_table(spark.createDataFrame([(9, "b")], "v int, ds string"), "t_io_ow")
    io.overwrite_table(spark.createDataFrame([(9, "b")], "v int, ds string"), "t_io_ow")
    assert sorted((r.v, r.ds) for r in spark.table("t_io_ow").collect()) == [(1, "a"), (9, "b")]
    io.drop_table(spark, "t_io_ow")


def test_job_runner_writes_partitioned_output(spark, tmp_dir):
    from dimweave.run import main

    out = f"{tmp_dir}/job"
    assert main(["engagement_daily", "--sf-dir", "/root/testdata/sf0.001", "--out", out,
                 "--partition-by", "event_date", "--shuffle-partitions", "4"]) == 0
    assert spark.read.parquet(out).count() == 30
    # re-running replaces the same partitions (idempotent)
    main(["engagement_daily", "--sf-dir", "/root/testdata/sf0.001", "--out", out,
          "--partition-by", "event_date", "--shuffle-partitions", "4"])
    assert spark.read.parquet(out).count() == 30


def test_checked_rows_name_what_is_broken(spark):
    from dimweave.operators.quality import checked_rows, quarantine, violation_counts

    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("n", T.IntegerType()), T.StructField("gone", T.StringType(), False)])
    rows = [("1", "2", "x"), (None, "3", "x"), ("a", "b", None), ("4", None, "x"), ("5", "99", "x")]
    df = spark.createDataFrame(rows, "id string, n string, gone string")
    checked = checked_rows(df, schema, {"n:small": F.col("n") < 50})
    got = [(r.id, r.n, r.gone, r.violations) for r in checked.collect()]
    assert got == [
        (1, 2, "x", []),
        (None, 3, "x", ["id:null"]),
        (None, None, None, ["id:type", "n:type", "gone:null"]),
        (4, None, "x", []),
        (5, 99, "x", ["n:small"]),
    ]
    valid, bad = quarantine(checked)
    assert [r.id for r in valid.collect()] == [1, 4] and bad.count() == 3
    counts = {r.rule: r.n for r in violation_counts(checked).collect()}
    assert counts == {"valid": 2, "id:null": 1, "id:type": 1, "n:type": 1, "gone:null": 1, "n:small": 1}
    # a column that the data lack, an empty table
    lacking = checked_rows(df.select("id"), schema).first()
    assert lacking.violations == ["gone:null"]
    assert checked_rows(df.limit(0), schema).count() == 0


def test_layout_splits_a_hot_day_and_reports_its_files(spark, tables, tmp_dir):
    """A third of the rows on one day: several files of it, none much larger
    than the advisory size asks for; sizes as the file system has them."""
    import os

    from dimweave.operators.layout import rebalanced

    events = tables.events.repartition(8).withColumn("day", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.date_format("ts", "yyyy-MM-dd")))
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "2k")
    try:
        rep = {r.variant: r for r in layout_report(events, {"plain": [], "sorted": ["day", "event_type"]}, partition_by=["day"], base_path=tmp_dir).collect()}
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)
    for name, r in rep.items():
        files = [f"{tmp_dir}/{name}/{f}" for f in os.listdir(f"{tmp_dir}/{name}") if f.endswith(".parquet")]
        assert (r.files, r.bytes, r.n_rows) == (len(files), sum(map(os.path.getsize, files)), events.count())
        stored = spark.read.parquet(f"{tmp_dir}/{name}").withColumn("f", F.input_file_name())
        assert stored.filter("day = 'hot'").select("f").distinct().count() > 1
    per_file = spark.read.parquet(f"{tmp_dir}/sorted").withColumn("f", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    assert per_file.count() == events.count()
    assert rebalanced(events).count() == events.count()


def test_array_sums_take_no_array_apart(spark):
    from dimweave.operators.arrays import array_to_daily
    from dimweave.plans.inspect import physical_tree

    rows = [("m", "2024-01-01", [1, 2, None]), ("m", "2024-01-01", [10]), ("m", "2024-02-01", [5] * 29), ("k", "2024-01-01", []), ("k", "2024-01-01", None)]
    df = spark.createDataFrame(rows, "metric_name string, month_start string, metric_array array<bigint>").withColumn("month_start", F.to_date("month_start"))
    out = array_to_daily(df)
    assert "Generate" not in physical_tree(out)
    got = {(r.metric_name, str(r.date)): r.value for r in out.collect()}
    assert len(got) == 3 + 29 and got[("m", "2024-01-01")] == 11 and got[("m", "2024-01-02")] == 2 and got[("m", "2024-01-03")] is None
    assert got[("m", "2024-02-29")] == 5
