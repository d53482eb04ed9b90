"""Experiment assignment and read-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.functions.columns import hash_bucket, safe_ratio

DEFAULT_CELLS = (("control", 50), ("test", 50))


def cell_of(bucket, cells: Sequence[tuple[str, int]]):
    """Map a bucket in [0, 100) to a cell by cumulative allocation."""
    expr, upper = None, 0
    for name, share in cells:
        upper += share
        cond = bucket < upper
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    if upper != 100:
        raise ValueError("cell allocations must add up to 100")
    return expr


def assign_cells(users: DataFrame, experiment: str, cells: Sequence[tuple[str, int]] = DEFAULT_CELLS,
                 key: str = "user_id") -> DataFrame:
    """Deterministic assignment: md5(experiment.user) -> bucket -> cell.  A
    user always lands in the same cell, independently per experiment, with
    no state and no shuffle."""
    b = hash_bucket(F.col(key), experiment, 100)
    return users.select(key, F.lit(experiment).alias("experiment"), cell_of(b, cells).alias("cell"))


def experiment_readout(assignments: DataFrame, exposures: DataFrame, outcomes: DataFrame,
                       control: str = "control", key: str = "user_id", within_hours: int | None = 24) -> DataFrame:
    """Per cell: assigned users, exposed users, converted users (an outcome at
    or after the first exposure, within ``within_hours`` of it when given),
    conversion rate, lift over control and the two-proportion z statistic
    against control.  Degenerate ratios (no exposure, zero variance) are NULL
    rather than errors."""
    first_exp = exposures.groupBy(key).agg(F.min("event_time").alias("_exp"))
    after = F.col("_out") >= F.col("_exp")
    if within_hours is not None:
        after = after & (F.col("_out") <= F.col("_exp") + F.expr(f"INTERVAL {within_hours} HOURS"))
    conv = (
        outcomes.select(key, F.col("event_time").alias("_out"))
        .join(first_exp, key)
        .filter(after)
        .select(key)
        .distinct()
        .withColumn("_conv", F.lit(1))
    )
    j = assignments.join(first_exp, key, "left").join(conv, key, "left")
    per_cell = j.groupBy("experiment", "cell").agg(
        F.count(F.lit(1)).alias("users"),
        F.count("_exp").alias("exposed"),
        F.count(F.when(F.col("_exp").isNotNull(), F.col("_conv"))).alias("converted"),
    )
    per_cell = per_cell.withColumn("rate", safe_ratio("converted", "exposed"))
    # Control figures beside every cell of the same experiment.  The table
    # has one row per (experiment, cell), so this window is tiny; a join on
    # the experiment name would be folded into a nested loop when the name
    # is a literal.
    w = Window.partitionBy("experiment")
    is_ctrl = F.col("cell") == control
    k = per_cell.select(
        "*",
        F.max(F.when(is_ctrl, F.col("exposed"))).over(w).alias("_n0"),
        F.max(F.when(is_ctrl, F.col("converted"))).over(w).alias("_c0"),
        F.max(F.when(is_ctrl, F.col("rate"))).over(w).alias("_r0"),
    )
    pooled = safe_ratio(F.col("converted") + F.col("_c0"), F.col("exposed") + F.col("_n0"))
    inv_n = safe_ratio(F.lit(1.0), "exposed") + safe_ratio(F.lit(1.0), "_n0")
    se = F.sqrt(pooled * (F.lit(1.0) - pooled) * inv_n)
    return k.select(
        "experiment", "cell", "users", "exposed", "converted", "rate",
        (safe_ratio("rate", "_r0") - F.lit(1.0)).alias("lift"),
        safe_ratio(F.col("rate") - F.col("_r0"), se).alias("z"),
    )
