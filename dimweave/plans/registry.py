"""Registry of named queries over the driver tables, each optionally paired
with an equivalent DuckDB SQL text (the oracle)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Session setting with the run date (yyyy-mm-dd) of a scheduled job.
RUN_DATE = "spark.dimweave.run_date"

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: ``fn(t: Tables) -> DataFrame`` becomes query ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def last_day(t: Tables, require: str | None = None):
    """The newest day of the events, as a literal for a query's run bound.
    Taken from the base table's own columns: no join and no derived frame is
    computed for it.  ``run_date`` in the session's settings (as a scheduler
    passes it) replaces the look-up."""
    given = t.spark.conf.get(RUN_DATE, None)
    if given:
        return dt.date.fromisoformat(given)
    src = t.events.filter(F.col(require).isNotNull()) if require else t.events
    return src.agg(F.to_date(F.max("ts"))).first()[0]


def last_year(t: Tables, table: str, column: str) -> int | None:
    """The newest year of a base table's date column; see ``last_day``."""
    given = t.spark.conf.get(RUN_DATE, None)
    if given:
        return dt.date.fromisoformat(given).year
    return getattr(t, table).agg(F.year(F.max(column))).first()[0]


def last_season(t: Tables) -> int | None:
    """Newest season of the players (the year of an order)."""
    return last_year(t, "orders", "o_orderdate")


def last_film_year(t: Tables) -> int | None:
    """Newest year of the films (the year of a shipment)."""
    return last_year(t, "lineitem", "l_shipdate")


def load_all() -> None:
    """Import every module that registers queries."""
    from dimweave.plans import (  # noqa: F401
        q_arrays,
        q_behaviour,
        q_cumulative,
        q_datelist,
        q_graph,
        q_growth,
        q_increments,
        q_matches,
        q_ops,
        q_scd,
        q_sports,
        q_streaming,
    )
