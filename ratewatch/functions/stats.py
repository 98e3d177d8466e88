"""NULL-safe statistics."""

from __future__ import annotations


def ratio(part: str, whole: str) -> str:
    """part / whole; NULL on a zero or NULL whole."""
    return f"try_divide({part}, {whole})"


def t_stat(value: str, mean: str, std: str, n: str, min_std: float | None = None) -> str:
    """(value - mean) / (std / sqrt(n)); NULL when any part is NULL or the spread is zero.

    ``min_std`` treats a spread at or below it as zero. It guards against
    near-constant series whose spread is only floating-point noise; off by
    default, since it changes results.
    """
    if min_std is not None:
        std = f"if({std} > {min_std!r}D, {std}, NULL)"
    return ratio(f"({value} - {mean})", ratio(std, f"sqrt({n})"))


def share_pct(part: str, whole: str) -> str:
    return f"round({ratio(part, whole)} * 100, 2)"


def clamp_at_zero(value: str) -> str:
    """max(0, value), but NULL stays NULL (``greatest`` would skip it)."""
    return f"if({value} IS NULL, NULL, greatest({value}, 0D))"


def average_value(amount: str, count: str) -> str:
    """Ratio of sums; no amount counts as zero, no count gives NULL."""
    return ratio(f"coalesce({amount}, 0)", count)


#: Rates are counted in hundred-millionths of a millionth, so that sums of their squares are whole numbers.
SCALE = 1e14


def moments(value: str) -> dict[str, str]:
    """Aggregates of doubles that are exact, so the same in any order, and that add and subtract.

    ``total`` is the sum for the mean: 18 digits behind the point hold a rate's.
    ``units`` and ``squares`` are sums in units of 1 / ``SCALE``, for the spread;
    ``squared`` counts the values whose square fits, those below 100,000, as a sum of squares may.
    """
    unit = f"cast(round({value} * {SCALE!r}D) AS decimal(38, 0))"
    square = f"try_multiply({unit}, {unit})"
    return {
        "values": f"count({value})",
        "total": f"sum(cast({value} AS decimal(38, 18)))",
        "units": f"sum({unit})",
        "squares": f"try_sum({square})",
        "squared": f"count({square})",
    }


def mean_of(values: str, total: str) -> str:
    """The mean of doubles from their moments.

    The order of a sum of doubles would decide which way losses that lie
    exactly halfway are rounded.
    """
    return ratio(f"cast({total} AS double)", values)


def spread_of(values: str, units: str, squares: str, squared: str) -> str:
    """The sample standard deviation from moments; NULL for a single value, or if a square didn't fit.

    Deviations are taken from the whole part of the mean, in whole numbers, so
    nothing cancels; the part behind the point is made up for at the end.
    """
    rest = f"pmod({units}, cast({values} AS decimal(20, 0)))"
    whole = f"cast(({units} - {rest}) / {values} AS decimal(38, 0))"
    around = f"cast({squares} - {whole} * ({units} + {rest}) AS double) - cast({rest} * {rest} AS double) / {values}"
    return (
        f"CASE WHEN {values} > 1 AND {squared} = {values} AND {squares} IS NOT NULL"
        f" THEN sqrt(greatest(({around}) / ({values} - 1), 0D)) / {SCALE!r}D END"
    )


def mean(value: str) -> str:
    """The exact mean as one aggregate."""
    of = moments(value)
    return mean_of(of["values"], of["total"])


def spread(value: str) -> str:
    """The sample standard deviation as one aggregate, the same to the last bit in any order.

    Only values too large for exact sums of squares, from about 100,000 on, take the sum of doubles.
    """
    of = moments(value)
    exact = spread_of(of["values"], of["units"], of["squares"], of["squared"])
    return f"coalesce({exact}, stddev_samp({value}))"


def lost_units(mean: str, value: str, volume: str) -> str:
    return f"round({clamp_at_zero(f'({mean} - {value})')} * {volume}, 0)"


def lost_amount(mean: str, value: str, volume: str, unit_value: str) -> str:
    """Money lost, from the unrounded loss."""
    return f"round({clamp_at_zero(f'({mean} - {value})')} * {volume} * {unit_value}, 2)"
