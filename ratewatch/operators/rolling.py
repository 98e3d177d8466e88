"""Baselines of many days at once, each over its own lookback.

Every day of a key is a tested day. Its baseline is a range frame over the key's
days, which ends with the tested day, so one pass gives what a run per day would. A
key has one row per day, so no frame and no partition holds more than the days.
The moments in the frames are exact: a day's baseline is the same to the last bit
whichever days are computed beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.functions.stats import average_value, mean_of, moments, spread_of
from ratewatch.operators.baseline import fields, sums_in_use, unpivot
from ratewatch.operators.daily import CHANNEL_KEYS, LOOKBACK_DAYS, MERCHANT_KEYS, merchant_daily
from ratewatch.specs import MetricSpec

TESTED = "requested_date"


def _rolling(
    days: DataFrame, keys: Sequence[str], specs: Sequence[MetricSpec], lookback_days: int, picked: Sequence[str] = ()
) -> DataFrame:
    """One row per key and day: the frame's day count, mean and spread of each rate, and the day's own values."""
    number = F.unix_date(TESTED)
    frame = Window.partitionBy(*keys).orderBy(number).rangeBetween(1 - lookback_days, 0)
    columns = {"n": F.count(TESTED).over(frame)}
    for spec in specs:
        of = moments(spec.rate())
        columns |= {f"_{spec.key}_{name}": F.expr(value).over(frame) for name, value in of.items()}
        columns[f"_{spec.key}_plain"] = F.expr(f"stddev_samp({spec.rate()})").over(frame)
    own = [TESTED, *keys, *sums_in_use(specs), *picked]
    with_frames = days.select(*own, F.expr(average_value("captured_amount_sum", "captured_sum")).alias("atv"),
                              *[value.alias(name) for name, value in columns.items()])
    exprs = []
    for spec in specs:
        values, total, units, squares, squared = (f"_{spec.key}_{name}" for name in moments(""))
        exprs.append(f"{mean_of(values, total)} AS {spec.key}_mean")
        exprs.append(f"coalesce({spread_of(values, units, squares, squared)}, _{spec.key}_plain) AS {spec.key}_std")
    return with_frames.selectExpr(*own, "atv", "n", *exprs)


def rolling_merchant_baseline(
    daily: DataFrame, specs: Sequence[MetricSpec], lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """(tested day, metric, alias, MIT flag): t1, mean, std, n, atv, active_volume."""
    active = [f"{spec.key}_active_volume" for spec in specs]
    wide = _rolling(merchant_daily(daily, specs), MERCHANT_KEYS, specs, lookback_days, picked=active)
    return unpivot(
        wide, [TESTED, *MERCHANT_KEYS], specs, lambda spec: {**fields(spec), "active_volume": f"{spec.key}_active_volume"}
    )


def rolling_channel_baseline(
    daily: DataFrame, specs: Sequence[MetricSpec], lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """(tested day, metric, alias, channel, MIT flag): t1, mean, std, n, atv, volume, incidents."""
    wide = _rolling(daily, CHANNEL_KEYS, specs, lookback_days)
    return unpivot(
        wide,
        [TESTED, *CHANNEL_KEYS],
        specs,
        lambda spec: {**fields(spec), "volume": spec.volume, "incidents": spec.numerator},
    )
