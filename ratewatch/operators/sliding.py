"""A baseline that slides: exact moments per key, from which days are taken and to which days are added.

The moments of a window are sums over its days, in whole numbers and decimals, so
taking a day away leaves exactly what the others give. Moving the window by a day
costs the state and two days, however long the window is, and the baseline that
comes out is the same to the last bit as the one over all days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.clock import Clock
from ratewatch.functions.stats import SCALE, average_value, mean_of, moments, spread_of
from ratewatch.operators.baseline import fields, sums_in_use, unpivot
from ratewatch.operators.daily import CHANNEL_KEYS, MERCHANT_KEYS
from ratewatch.specs import MetricSpec

_NAMES = tuple(moments(""))


def _columns(specs: Sequence[MetricSpec]) -> list[str]:
    return ["n", *(f"{spec.key}_{name}" for spec in specs for name in _NAMES)]


def state_of(days: DataFrame, keys: Sequence[str], specs: Sequence[MetricSpec]) -> DataFrame:
    """The state of these days: per key the day count and each rate's moments. A key has one row per day."""
    of = {f"{spec.key}_{name}": value for spec in specs for name, value in moments(spec.rate()).items()}
    filled = [F.coalesce(F.expr(value), F.lit(0)).alias(name) for name, value in of.items()]
    return days.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *filled)


def negated(state: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """What takes ``state`` away when it is merged."""
    return state.withColumns({name: -F.col(name) for name in _columns(specs)})


def merged(states: Sequence[DataFrame], keys: Sequence[str], specs: Sequence[MetricSpec]) -> DataFrame:
    """The sum of states. Keys without a day left go; NULLs are keys like any other."""
    together = reduce(DataFrame.unionByName, states)
    return together.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in _columns(specs))).where("n <> 0")


def slid(
    state: DataFrame, entering: DataFrame, leaving: DataFrame, keys: Sequence[str], specs: Sequence[MetricSpec]
) -> DataFrame:
    """``state`` with the days ``entering`` added and the days ``leaving`` taken away.

    A day whose facts have changed leaves as it was and enters as it is now.
    """
    parts = [state, state_of(entering, keys, specs), negated(state_of(leaving, keys, specs), specs)]
    return merged(parts, keys, specs)


def _wide(
    state: DataFrame, days: DataFrame, keys: Sequence[str], specs: Sequence[MetricSpec], clock: Clock, picked: Sequence[str] = ()
) -> DataFrame:
    """One row per key of the state, with the tested day's own values from ``days``."""
    own = [*sums_in_use(specs), *picked]
    atv = F.expr(average_value("captured_amount_sum", "captured_sum"))
    tested = days.where(F.col("requested_date") == F.lit(clock.yesterday)).select(*keys, *own, atv.alias("atv"))
    # The day's values join the state's rows in one aggregate, which keeps NULL keys.
    both = state.unionByName(tested, allowMissingColumns=True)
    sums = [F.sum(name).alias(name) for name in _columns(specs)]
    together = both.groupBy(*keys).agg(*sums, *(F.max(name).alias(name) for name in [*own, "atv"])).where("n > 0")
    exprs = []
    for spec in specs:
        values, total, units, squares, squared = (f"{spec.key}_{name}" for name in _NAMES)
        spread = spread_of(values, units, squares, squared)
        refused = f"raise_error('a rate of {spec.key} is too large for exact squares (from {1e19 / SCALE:,.0f} on)')"
        exprs.append(f"{mean_of(values, total)} AS {spec.key}_mean")
        exprs.append(f"if({squared} = {values}, {spread}, {refused}) AS {spec.key}_std")
    return together.selectExpr(*keys, *own, "atv", "n", *exprs)


def sliding_merchant_baseline(
    state: DataFrame, merchant_days: DataFrame, specs: Sequence[MetricSpec], clock: Clock
) -> DataFrame:
    """``merchant_baseline`` from a state of merchant days; ``merchant_days`` holds the tested day."""
    active = [f"{spec.key}_active_volume" for spec in specs]
    wide = _wide(state, merchant_days, MERCHANT_KEYS, specs, clock, picked=active)
    return unpivot(
        wide, MERCHANT_KEYS, specs, lambda spec: {**fields(spec), "active_volume": f"{spec.key}_active_volume"}
    )


def sliding_channel_baseline(
    state: DataFrame, channel_days: DataFrame, specs: Sequence[MetricSpec], clock: Clock
) -> DataFrame:
    """``channel_baseline`` from a state of channel days; ``channel_days`` holds the tested day."""
    wide = _wide(state, channel_days, CHANNEL_KEYS, specs, clock)
    return unpivot(
        wide,
        CHANNEL_KEYS,
        specs,
        lambda spec: {**fields(spec), "volume": spec.volume, "incidents": spec.numerator},
    )
