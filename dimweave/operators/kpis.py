"""Business KPI tables behind the maintenance run-books: unit and total
profit, daily and monthly growth, daily engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.operators.growth import ACTIVE_STATES, CHURNED, NEW, RESURRECTED, RETAINED, STALE

# Fixed assumption: supply cost of a line = quantity x retail price x 75%.
COST_PCT = 75
MONEY = "decimal(18,2)"


def _cents(c: str):
    """A 2-decimal money or quantity column as exact integer hundredths."""
    return F.round(F.col(c) * 100).cast("long")


def _money(units, scale_digits: int):
    """Exact integer units of 10^-scale_digits -> decimal(18,2), half up."""
    return (units.cast("decimal(38,0)") / F.lit(10 ** scale_digits).cast("decimal(38,0)")).cast(MONEY)


def profit_unit(lines: DataFrame) -> DataFrame:
    """Per order: revenue (discounted extended price), cost and profit.

    Arithmetic is exact fixed point on 64-bit integers -- revenue in 10^-4
    units (cents x basis points), cost in 10^-6 units -- summed as longs and
    converted to decimal(18,2) once per order, instead of 38-digit decimal
    products that fall back to arbitrary-precision arithmetic per row.
    ``lines`` = lineitem x part x orders."""
    rev = _cents("l_extendedprice") * (F.lit(100) - _cents("l_discount"))
    cost = _cents("l_quantity") * _cents("p_retailprice") * F.lit(COST_PCT)
    g = lines.groupBy(F.col("l_orderkey").alias("order_key"), F.to_date("o_orderdate").alias("order_date")).agg(
        F.sum(rev).alias("_rev"), F.sum(cost).alias("_cost")
    )
    return g.select(
        "order_key", "order_date",
        _money(F.col("_rev"), 4).alias("revenue"),
        _money(F.col("_cost"), 6).alias("cost"),
        _money(F.col("_rev") * 100 - F.col("_cost"), 6).alias("profit"),
    )


def profit_total(unit: DataFrame) -> DataFrame:
    """Per month: orders, revenue and profit (the investor aggregate)."""
    return unit.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.sum("profit").cast(MONEY).alias("profit"),
    )


def growth_daily(ga: DataFrame) -> DataFrame:
    """Per day: users in each daily lifecycle state and active users."""
    s = F.col("daily_active_state")
    return ga.groupBy("date").agg(
        *[F.count(F.when(s == st, 1)).alias(st.lower()) for st in (NEW, RETAINED, RESURRECTED, CHURNED, STALE)],
        F.count(F.when(s.isin(*ACTIVE_STATES), 1)).alias("active_users"),
    )


def growth_total(ga: DataFrame) -> DataFrame:
    """Per month: new users and users active at least once."""
    active = F.col("daily_active_state").isin(*ACTIVE_STATES)
    return ga.groupBy(F.trunc("date", "month").alias("month")).agg(
        F.count(F.when(F.col("daily_active_state") == NEW, 1)).alias("new_users"),
        F.countDistinct(F.when(active, F.col("user_id"))).alias("active_users"),
    )


def engagement_daily(events: DataFrame) -> DataFrame:
    """Per day: active users, events and events per active user."""
    g = events.filter(F.col("user_id").isNotNull()).groupBy("event_date").agg(
        F.countDistinct("user_id").alias("active_users"), F.count(F.lit(1)).alias("events")
    )
    return g.withColumn("events_per_user", F.col("events") / F.col("active_users"))
