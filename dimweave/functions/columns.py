"""Column-level helpers.  All of them build Catalyst expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Scoring classes of a season (strict ">"; anything else, NULL included, is
# the fallback class).
PLAYER_CLASSES = [(20, "star"), (15, "good"), (10, "average")]
PLAYER_FALLBACK = "bad"
# Quality classes of a year of films, by average rating.
ACTOR_CLASSES = [(8, "star"), (7, "good"), (6, "average")]
ACTOR_FALLBACK = "bad"
# Referrer channel rules, first match wins, otherwise the raw referrer.
CHANNEL_RULES = [
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
]
ON_SITE = "On Site"  # referrers of the site's own domains
# Activity masks over a 32-bit datelist whose bit 31 is the anchor day.
MASK_LAST_7 = int("11111110000000000000000000000000", 2)
MASK_PREVIOUS_7 = int("00000001111111000000000000000000", 2)
MASK_ANCHOR_DAY = int("10000000000000000000000000000000", 2)
# Default referrer of an event that has none (spelling as in the source).
MISSING_REFERRER = "unknow"
# ---------------------------------------------------------------------------


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_class(value: str | Column, rules: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """``CASE WHEN v > b1 THEN l1 WHEN v > b2 THEN l2 ... ELSE otherwise``.

    Rules are given highest bound first; comparison is strict and a NULL value
    lands in ``otherwise`` as in SQL's searched CASE."""
    v = col_(value)
    expr = None
    for bound, label in rules:
        expr = F.when(v > F.lit(bound), F.lit(label)) if expr is None else expr.when(v > F.lit(bound), F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def channel_of(
    referrer: str | Column,
    rules: Iterable[tuple[str, str]] = CHANNEL_RULES,
    on_site: Iterable[str] = (),
) -> Column:
    """Map a referrer URL to a channel by ordered LIKE rules, then by the
    site's own domains (``on_site``); other referrers stay as they are."""
    r = col_(referrer)
    expr = None
    for pattern, label in [*rules, *((f"%{domain}%", ON_SITE) for domain in on_site)]:
        cond = r.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return r if expr is None else expr.otherwise(r)


def safe_get(arr: str | Column, index: int | Column) -> Column:
    """0-based element access that yields NULL out of range (never raises
    under ANSI mode)."""
    return F.get(col_(arr), index if isinstance(index, Column) else F.lit(index))


def last_element(arr: str | Column) -> Column:
    return F.try_element_at(col_(arr), F.lit(-1))


def first_element(arr: str | Column) -> Column:
    return F.try_element_at(col_(arr), F.lit(1))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero divisor instead of raising."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def props_int(props: str | Column, key: str) -> Column:
    """Integer field of a JSON ``props`` string."""
    return F.get_json_object(col_(props), f"$.{key}").cast("int")


def json_object(*names_and_cols: tuple[str, Column]) -> Column:
    """``json_build_object``: JSON text keeping NULL fields (Spark drops them
    by default)."""
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in names_and_cols]), {"ignoreNullFields": "false"}
    )


def string_map(*names_and_cols: tuple[str, Column]) -> Column:
    """``map('k1', v1, ...)`` with values cast to string."""
    parts: list[Column] = []
    for name, c in names_and_cols:
        parts += [F.lit(name), c.cast("string")]
    return F.create_map(*parts)


def hash_bucket(key: Column, salt: str, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from md5(salt || key): stable
    across engines and runs (the same formula is portable to any SQL with
    md5)."""
    digest = F.md5(F.concat(F.lit(salt), F.lit("."), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def array_text(arr: str | Column, field_fmt=None, sep: str = ",") -> Column:
    """Canonical text of an array (for equality checks and sinks without
    nested types)."""
    a = col_(arr)
    if field_fmt is not None:
        a = F.transform(a, field_fmt)
    return F.array_join(a, sep, "null")


def on_day(df, day, date_col: str = "event_date", time_col: str = "event_time"):
    """Rows of one calendar day.  Besides ``date_col = day`` the bound is
    restated as a range on the raw timestamp, which (unlike a cast) reaches
    the Parquet scan as a pushed filter and skips row groups."""
    d = F.to_date(F.lit(str(day)))
    out = df.filter(F.col(date_col) == d)
    if time_col in df.columns:
        lo = d.cast("timestamp_ntz")
        hi = F.date_add(d, 1).cast("timestamp_ntz")
        ts = F.col(time_col)
        if dict(df.dtypes).get(time_col) == "timestamp":
            lo, hi = d.cast("timestamp"), F.date_add(d, 1).cast("timestamp")
        out = out.filter((ts >= lo) & (ts < hi))
    return out


def no_later(facts: DataFrame, period_col: str, upto) -> DataFrame:
    """The facts up to a history's bound (a period number, a day, or None for
    all): nothing that came later may show in an earlier snapshot."""
    if upto is None:
        return facts
    bound = F.lit(upto) if isinstance(upto, int) else F.to_date(F.lit(str(upto)))
    return facts.filter(F.col(period_col) <= bound)
