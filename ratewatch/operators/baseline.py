"""Baselines: mean, spread, day count and yesterday's record, per merchant and per channel.

The baseline is the whole lookback, yesterday included. All metrics are
aggregated side by side in one pass and only then unpivoted, so the shuffles
carry one row per key and day, not one per metric.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.clock import Clock
from ratewatch.functions.stats import average_value, mean, spread
from ratewatch.functions.text import quoted
from ratewatch.operators.daily import CHANNEL_KEYS, MERCHANT_KEYS, SUMS, merchant_daily
from ratewatch.specs import MetricSpec


def sums_in_use(specs: Sequence[MetricSpec]) -> list[str]:
    used = {name for spec in specs for name in (spec.numerator, spec.denominator, spec.volume)}
    return [name for name in SUMS if name in used]


def _baseline(
    days: DataFrame, keys: Sequence[str], specs: Sequence[MetricSpec], clock: Clock, picked: Sequence[str] = ()
) -> DataFrame:
    """One row per key: day count, mean and spread of each rate, and yesterday's values.

    The date is unique within a group, so a plain count is the distinct count.
    Days without a rate count as days, but do not enter mean and spread.
    Yesterday's sums, ``picked`` columns and average value keep their names.
    """
    on_yesterday = {name: name for name in (*sums_in_use(specs), *picked)}
    on_yesterday["atv"] = average_value("captured_amount_sum", "captured_sum")
    aggregates = ["count(requested_date) AS n"]
    for name, value in on_yesterday.items():
        aggregates.append(f"max(CASE WHEN requested_date = DATE'{clock.yesterday}' THEN {value} END) AS {name}")
    for spec in specs:
        aggregates.append(f"{mean(spec.rate())} AS {spec.key}_mean")
        aggregates.append(f"{spread(spec.rate())} AS {spec.key}_std")
    return days.groupBy(*keys).agg(*map(F.expr, aggregates))


def fields(spec: MetricSpec) -> dict[str, str]:
    return {
        "t1": spec.rate(),
        "mean": f"{spec.key}_mean",
        "std": f"{spec.key}_std",
        "n": "n",
        # Only an estimated loss needs the average value.
        "atv": "atv" if spec.impact == "loss" else "CAST(NULL AS double)",
    }


def unpivot(
    wide: DataFrame,
    keys: Sequence[str],
    specs: Sequence[MetricSpec],
    fields: Callable[[MetricSpec], dict[str, str]],
) -> DataFrame:
    """One row per metric; ``fields(spec)`` names that metric's columns."""
    rows = []
    for spec in specs:
        columns = [f"{quoted(spec.label)} AS Anomaly_Type"]
        columns += [f"{value} AS {name}" for name, value in fields(spec).items()]
        rows.append(f"struct({', '.join(columns)})")
    return wide.selectExpr(*keys, f"inline(array({', '.join(rows)}))")


def merchant_baseline(daily: DataFrame, specs: Sequence[MetricSpec], clock: Clock) -> DataFrame:
    """(metric, alias, MIT flag): t1, mean, std, n, atv, active_volume.

    Carrying ``atv`` here too makes this branch need the same daily sums as the
    channel branch, so the planner computes the daily roll-up, and reads the
    facts, once for both.
    """
    days = merchant_daily(daily, specs)
    active = [f"{spec.key}_active_volume" for spec in specs]
    wide = _baseline(days, MERCHANT_KEYS, specs, clock, picked=active)
    return unpivot(
        wide, MERCHANT_KEYS, specs, lambda spec: {**fields(spec), "active_volume": f"{spec.key}_active_volume"}
    )


def channel_baseline(daily: DataFrame, specs: Sequence[MetricSpec], clock: Clock) -> DataFrame:
    """(metric, alias, channel, MIT flag): t1, mean, std, n, atv, volume, incidents.

    ``volume`` and ``incidents`` (the numerator) are yesterday's sums.
    """
    wide = _baseline(daily, CHANNEL_KEYS, specs, clock)
    return unpivot(
        wide,
        CHANNEL_KEYS,
        specs,
        lambda spec: {**fields(spec), "volume": spec.volume, "incidents": spec.numerator},
    )
