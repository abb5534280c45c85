"""Numbers, levels, dates and costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayline.functions.text import strip


def level_rank(c: Column) -> Column:
    level = F.lower(F.coalesce(c, F.lit("")))
    return F.when(level == "high", 3).when(level == "medium", 2).when(level == "low", 1).otherwise(0)


def direction(current: Column, historical: Column) -> Column:
    return (
        F.when(historical <= 0, "no_historical_baseline")
        .when(current >= historical + 2, "much_higher")
        .when(current > historical, "higher")
        .when(current <= historical - 2, "much_lower")
        .when(current < historical, "lower")
        .otherwise("stable")
    )


def as_int(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def as_double(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def token_cost(prompt: Column, completion: Column, price_in: Column, price_out: Column, unit: Column) -> Column:
    """Cost in 10 decimals; an unknown price costs nothing."""
    zero = F.lit(0)
    cost = (
        F.greatest(prompt, zero) / unit * price_in + F.greatest(completion, zero) / unit * price_out
    )
    return F.coalesce(F.bround(cost, 10), F.lit(0.0))


def feed_timestamp(c: Column) -> Column:
    """ISO 8601 (``Z`` or offset, naive = UTC) or RFC 2822; unparsable is null."""
    text = strip(c)
    text = F.when(text != "", text)
    # The parser rejects weekday names, and they carry no information.
    mail = F.regexp_replace(text, r"^\w{3,9},\s*", "")
    candidates = [F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-"), text))]
    for pattern in ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm z", "d MMM yyyy HH:mm:ss"):
        candidates.append(F.try_to_timestamp(F.when(~text.rlike(r"^\d{4}-"), mail), F.lit(pattern)))
    return F.coalesce(*candidates)


def epoch_timestamp(c: Column) -> Column:
    return F.timestamp_seconds(c.try_cast("bigint"))


def report_day(ts: Column, timezone: str = "UTC") -> Column:
    """Calendar day of an instant in the report time zone."""
    return F.to_date(F.from_utc_timestamp(ts, timezone))
