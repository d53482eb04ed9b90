"""Plan inspection from ``DataFrame.explain`` output: used by tests to assert
the physical strategy (broadcast, bucketed join, pushed filters, no nested
loops) instead of trusting it."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_tree(df: DataFrame) -> str:
    """The operator tree of the physical plan (the part before the node
    details in formatted mode)."""
    text = plan_text(df, "formatted")
    return text.split("\n\n\n")[0]


def count_operator(df: DataFrame, name: str) -> int:
    return len(re.findall(rf"\b{re.escape(name)}\b", physical_tree(df)))


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges (broadcast exchanges excluded)."""
    return len(re.findall(r"(?<![A-Za-z])Exchange \(\d+\)", physical_tree(df)))


def pushed_filters(df: DataFrame) -> list[str]:
    return [line.split(":", 1)[1].strip() for line in plan_text(df).splitlines() if "PushedFilters" in line]


def read_schemas(df: DataFrame) -> list[str]:
    return [line.split(":", 1)[1].strip() for line in plan_text(df).splitlines() if line.startswith("ReadSchema")]
