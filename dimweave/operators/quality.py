"""Data contracts: typed reads with a runtime null contract, and a quality
report (key uniqueness, nulls, partition freshness) in few passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _violations(schema: T.StructType) -> Column | None:
    cond = None
    for f in schema.fields:
        if not f.nullable:
            c = F.col(f.name).isNull()
            cond = c if cond is None else cond | c
    return cond


def enforce_schema(df: DataFrame, schema: T.StructType, mode: str = "fail"):
    """Cast to ``schema`` and enforce its non-nullable fields, which file
    reads silently relax.

    ``fail``: a NULL in a non-nullable field raises when the row is read.
    ``quarantine``: returns (valid, invalid) split by one predicate."""
    cast = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    bad = _violations(schema)
    if bad is None:
        return cast if mode == "fail" else (cast, cast.limit(0))
    if mode == "fail":
        # In a filter (not a projected column, which would be pruned) the
        # check runs for every row that is read.
        return cast.filter(F.when(bad, F.raise_error(F.lit("non-nullable field is NULL"))).otherwise(F.lit(True)))
    if mode == "quarantine":
        return cast.filter(~bad), cast.filter(bad)
    raise ValueError(mode)


def checked_rows(df: DataFrame, schema: T.StructType, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` cast to ``schema``, every row kept, with ``violations``: the
    names of what it breaks, in the order of the fields, then of the rules.

    ``<field>:type`` -- a value that doesn't cast to the field's type (null in
    the result); ``<field>:null`` -- no value in a non-nullable field;
    ``<rule>`` -- a predicate over the cast columns that is false (null, as
    with missing values, breaks nothing).  One pass, nothing is moved."""
    source = {c.lower() for c in df.columns}
    raw = F.struct(*[F.col(f"`{f.name}`") if f.name.lower() in source else F.lit(None).cast("string").alias(f.name) for f in schema.fields])
    cast = df.select(raw.alias("_raw"))
    cast = cast.select("_raw", *[F.col("_raw")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    found = []
    for f in schema.fields:
        given = F.col("_raw")[f.name].isNotNull()
        found.append(F.when(given & F.col(f.name).isNull(), F.lit(f"{f.name}:type")))
        if not f.nullable:
            found.append(F.when(~given, F.lit(f"{f.name}:null")))
    found += [F.when(~rule, F.lit(name)) for name, rule in (rules or {}).items()]
    return cast.select(*[f.name for f in schema.fields], F.array_compact(F.array(*found)).alias("violations"))


def quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows with violations) of ``checked_rows``."""
    bad = F.size("violations") > 0
    return checked.filter(~bad).drop("violations"), checked.filter(bad)


def violation_counts(checked: DataFrame) -> DataFrame:
    """(rule, n): rows that break each rule, and ``valid`` ones, in one pass;
    a row that breaks several counts for each of them."""
    rules = F.when(F.size("violations") > 0, F.col("violations")).otherwise(F.array(F.lit("valid")))
    return checked.select(F.explode(rules).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def quality_report(
    df: DataFrame,
    keys: Sequence[str],
    not_null: Sequence[str] = (),
    partition_col: str | None = None,
    partition_value=None,
) -> DataFrame:
    """(check, n_bad) rows: keys occurring more than once, NULLs per column,
    and whether the expected partition holds rows (freshness)."""
    dup = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .agg(F.count(F.lit(1)).alias("n_bad"))
        .select(F.lit(f"duplicate_key:{','.join(keys)}").alias("check"), "n_bad")
    )
    aggs = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null:{c}") for c in not_null]
    if partition_col is not None:
        aggs.append(
            F.when(F.count(F.when(F.col(partition_col) == F.lit(partition_value), 1)) == 0, 1)
            .otherwise(0)
            .cast("long")
            .alias(f"stale_partition:{partition_col}")
        )
    out = dup
    if aggs:
        one = df.agg(*aggs)
        names = one.columns
        stacked = one.select(
            F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").cast("long").alias("n_bad")) for n in names]))
        )
        out = out.unionByName(stacked)
    return out
