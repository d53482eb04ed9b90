"""Join helpers: size-checked broadcast and distributed per-key row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side we broadcast without asking: rows and bytes, checked before
# planning.
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20
_TEXT_BYTES = 64  # what a text column counts as


def row_bytes(schema: T.StructType) -> int:
    """About how many bytes a row of the schema takes in memory.  Structs count
    their fields; an array or a map has no bound and raises."""
    fixed = {T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.IntegerType: 8, T.DateType: 8, T.BooleanType: 8}

    def width(kind: T.DataType) -> int:
        if isinstance(kind, (T.ArrayType, T.MapType)):
            raise ValueError(f"rows of {kind.simpleString()} have no bound: check flat rows before they are grouped")
        if isinstance(kind, T.StructType):
            return 8 + sum(width(f.dataType) for f in kind.fields)
        return fixed.get(type(kind), _TEXT_BYTES)

    return 16 + sum(width(f.dataType) for f in schema.fields)


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proved to hold at most ``max_rows`` rows and, at its
    schema's row width, ``max_bytes`` bytes.

    The proof is ``df.limit(n + 1).count()`` for the smaller of both bounds: it
    stops scanning as soon as the bound is exceeded, so checking a large table
    is cheap."""
    bound = min(max_rows, max(1, max_bytes // row_bytes(df.schema)))
    return df.limit(bound + 1).count() <= bound


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast hint only for a side that ``is_small`` proves small.  Beyond
    the bound the side is returned unhinted and the planner shuffles it (and
    AQE may still demote the join to a broadcast after measuring it)."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def tasks_for(rows_per_task: int, *frames: DataFrame) -> int:
    """Into how many tasks the largest of ``frames`` is dealt, so that a task's
    rows don't grow with the table.  Counting the rows of a Parquet scan reads
    the files' footers only."""
    return max(1, *(-(-df.count() // rows_per_task) for df in frames))


def salt_buckets_of(df: DataFrame) -> int:
    """As many tasks for one key as the cluster's size suggests: with a third
    of all rows it is then no more than a task's usual share."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 3)


def salt(cols: Sequence[str], buckets: int) -> Column:
    """A deterministic number in [0, buckets) from a hash of ``cols``."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    buckets: int | None = None,
    salt_of: Sequence[str] | None = None,
    how: str = "inner",
    salts: str | None = None,
) -> DataFrame:
    """Equi-join that spreads every key of ``big`` over ``buckets`` tasks
    (default: a third of the session's shuffle partitions).

    ``big`` rows get a deterministic ``salt`` of ``salt_of`` (default: all its
    columns); each ``small`` row -- typically one aggregate row per key -- is
    replicated once per salt, or, with ``salts``, once per element of that
    array column of ``small``: the salts that ``big`` has under the key, so
    that there are no more copies than ``big`` has rows.  A key holding a
    third of ``big`` is then processed by ``buckets`` tasks instead of one.
    The planner can't see that the copies are many times ``small`` and would
    broadcast them by the size of ``small``: the join is always a sort-merge
    join.  Use it where AQE's skew split cannot apply (e.g. when one side is
    an aggregate that already sits on the join key's partitioning)."""
    if buckets is None:
        buckets = salt_buckets_of(big)
    if buckets <= 1 and salts is None:
        return big.join(small, list(keys), how)
    cols = list(salt_of) if salt_of else big.columns
    salted = big.withColumn("_salt", salt(cols, buckets))
    used = F.col(salts) if salts else F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    copies = small.select(*[c for c in small.columns if c != salts], F.explode(used).alias("_salt"))
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def ordered_index(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    name: str = "_idx",
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """1-based position of each row within ``keys`` ordered by (``bucket``,
    ``order``), plus running sums, without a window over a whole key.

    The rows are shuffled once, on (key, bucket), and numbered inside each
    bucket; bucket totals come from the same windowed rows (the first row of
    each bucket carries them).  Those one-row-per-bucket totals are ordered
    per key -- so a hot key costs its number of buckets, not its number of
    rows -- into offsets, which are joined back.  Only the small per-bucket
    table moves again; ``sums`` become prefix sums the same way."""
    sums = sums or {}
    wb = Window.partitionBy(*keys, bucket).orderBy(*order)
    running = wb.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys, bucket)
    within = df.select(
        "*",
        F.row_number().over(wb).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_bn"),
        *[F.sum(c).over(running).alias(f"_run_{n}") for n, c in sums.items()],
        *[F.sum(c).over(whole).alias(f"_bs_{n}") for n, c in sums.items()],
    )
    # One row per bucket, taken from the numbered rows themselves: both
    # branches sit on the same (key, bucket) exchange, which is reused.
    per_bucket = within.filter(F.col("_rn") == 1).select(*keys, bucket, "_bn", *[f"_bs_{n}" for n in sums])
    wk = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys,
        bucket,
        F.coalesce(F.sum("_bn").over(wk), F.lit(0)).alias("_off"),
        *[F.coalesce(F.sum(f"_bs_{n}").over(wk), F.lit(0)).alias(f"_soff_{n}") for n in sums],
    )
    out = within.join(offsets, [*keys, bucket]).withColumn(name, F.col("_off") + F.col("_rn"))
    for n in sums:
        out = out.withColumn(n, F.col(f"_soff_{n}") + F.col(f"_run_{n}"))
    drop = ["_off", "_rn", "_bn"] + [f"_soff_{n}" for n in sums] + [f"_run_{n}" for n in sums]
    drop += [f"_bs_{n}" for n in sums]
    return out.drop(*drop)
