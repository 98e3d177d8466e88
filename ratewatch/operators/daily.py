"""Lookback filter and daily roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.clock import Clock, utc_date, utc_instant
from ratewatch.functions.stats import average_value
from ratewatch.operators.resolve import ID_KEYS, Lookups, heavy_pairs, join_resolved_pairs, pair_counts
from ratewatch.specs import MetricSpec

LOOKBACK_DAYS = 30

# Fact measure -> daily sum.
MEASURES = {
    "accepted_payments": "accepted_sum",
    "requested_payments": "requested_sum",
    "captured_amount_usd": "captured_amount_sum",
    "captured_payments": "captured_sum",
    "fraud_reported_payments": "fraud_reported_sum",
    "disputed_payments": "disputed_sum",
}
SUMS = tuple(MEASURES.values())
# A day without any of these is a zero, not an unknown: it stays in the baseline.
ZERO_WHEN_ABSENT = ("captured_amount_sum", "fraud_reported_sum", "disputed_sum")

CHANNEL_KEYS = ("alias_name", "channel_id", "is_mit")
MERCHANT_KEYS = ("alias_name", "is_mit")


def lookback(
    payments: DataFrame,
    clock: Clock,
    days: int = LOOKBACK_DAYS,
    upto: datetime | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """Payments of the last ``days`` days by timestamp, with their UTC date.

    The oldest date may be cut within the day, and there is no upper bound
    unless ``upto`` gives one. ``day_column`` names a date partition column of
    the source (in UTC), so that whole partitions are skipped as well.
    """
    since = clock.days_before(days)
    recent = payments.where(F.col("requested_at") >= utc_instant(payments, "requested_at", since))
    if day_column is not None:
        recent = recent.where(F.col(day_column) >= F.lit(since.date()))
    if upto is not None:
        recent = recent.where(F.col("requested_at") < utc_instant(payments, "requested_at", upto))
        if day_column is not None:
            recent = recent.where(F.col(day_column) <= F.lit(upto.date()))
    return recent.select(
        utc_date(payments, "requested_at").alias("requested_date"),
        "entity_id",
        "merchant_account_id",
        F.col("processing_channel_id").alias("channel_id"),
        F.col("is_merchant_initiated").alias("is_mit"),
        "accepted_payments",
        "requested_payments",
        "captured_amount_usd",
        "captured_payments",
        "fraud_reported_payments",
        "disputed_payments",
    )


def daily_performance(
    payments: DataFrame,
    lookups: Lookups,
    clock: Clock,
    lookback_days: int = LOOKBACK_DAYS,
    upto: datetime | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """Sums per (date, alias, channel, MIT flag), plus the average value per capture.

    Small lookups are broadcast, so the facts are shuffled once, after partial
    aggregation. Larger lookups need shuffle joins on ids that may be badly
    skewed. Then only the distinct id pairs go through them, and the facts,
    summed per pair and day, meet the resolved pairs in a single join, in which
    the pairs with the most facts are salted. Sums are
    linear and a row's resolution depends on its pair alone, so both ways give
    the same result, also where duplicate lookup keys multiply rows.
    """
    facts = lookback(payments, clock, lookback_days, upto, day_column)
    if lookups.small:
        return roll_up_days(lookups.resolve(facts))
    counted = pair_counts(facts)
    sums = [F.sum(measure).alias(measure) for measure in MEASURES]
    summed = facts.groupBy("requested_date", *ID_KEYS, "channel_id", "is_mit").agg(*sums)
    return roll_up_days(join_resolved_pairs(summed, lookups.resolve(counted), heavy_pairs(counted)))


def roll_up_days(resolved: DataFrame) -> DataFrame:
    """Daily sums of resolved facts."""
    sums = []
    for measure, name in MEASURES.items():
        # Money is summed as it is stored, exactly if that is a decimal; rates and impacts are doubles.
        total = f"cast(sum({measure}) AS double)" if measure == "captured_amount_usd" else f"sum({measure})"
        sums.append(f"coalesce({total}, 0) AS {name}" if name in ZERO_WHEN_ABSENT else f"{total} AS {name}")
    daily = resolved.groupBy("requested_date", *CHANNEL_KEYS).agg(*map(F.expr, sums))
    return daily.selectExpr("*", f"{average_value('captured_amount_sum', 'captured_sum')} AS daily_atv")


def merchant_daily(daily: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Channel days summed to merchant days.

    ``<key>_rate`` is a ratio of sums, not a mean of ratios.
    ``<key>_active_volume`` is the volume of the channels that have a rate that
    day; yesterday's value is the whole that channel shares refer to.
    """
    sums = [f"sum({name}) AS {name}" for name in SUMS]
    sums += [
        f"sum({spec.volume}) FILTER (WHERE {spec.rate()} IS NOT NULL) AS {spec.key}_active_volume"
        for spec in specs
    ]
    summed = daily.groupBy("requested_date", *MERCHANT_KEYS).agg(*map(F.expr, sums))
    return summed.selectExpr("*", *[f"{spec.rate()} AS {spec.key}_rate" for spec in specs])
