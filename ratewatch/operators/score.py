"""Score yesterday against both baselines, with channel share and impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ratewatch.clock import Clock
from ratewatch.functions.stats import lost_amount, lost_units, share_pct, t_stat
from ratewatch.operators.baseline import channel_baseline, merchant_baseline
from ratewatch.specs import MetricSpec, by_metric, require_distinct


def score_merchants(
    baselines: DataFrame, specs: Sequence[MetricSpec], min_std: float | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Merchant t-statistic and whether it breaches, per metric, and per ``by``."""
    t = t_stat("t1", "mean", "std", "n", min_std)
    breach = by_metric(specs, lambda spec: spec.breaches("t_stat_alias_global"))
    scored = baselines.selectExpr(
        *by, "Anomaly_Type", "alias_name", "is_mit", "active_volume", f"{t} AS t_stat_alias_global"
    )
    return scored.selectExpr("*", f"{breach} AS merchant_breach")


def score_channels(
    baselines: DataFrame, specs: Sequence[MetricSpec], min_std: float | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Channel t-statistic, impact estimate and both gates, for channels active yesterday."""

    def of_loss(estimate: str, otherwise: str = "CAST(NULL AS double)") -> str:
        return by_metric(specs, lambda spec: estimate if spec.impact == "loss" else otherwise)

    amount = of_loss(lost_amount("mean", "t1", "volume", "atv"))
    units = of_loss(lost_units("mean", "t1", "volume"), otherwise="CAST(incidents AS double)")
    scored = baselines.where("t1 IS NOT NULL").selectExpr(
        *by,
        "Anomaly_Type",
        "alias_name",
        "channel_id",
        "is_mit",
        "volume",
        f"{t_stat('t1', 'mean', 'std', 'n', min_std)} AS t_stat_channel_specific",
        f"{amount} AS Total_Volume_Amount_Lost",
        f"{units} AS Lost_Volume",
        f"{of_loss('atv')} AS ATV",
    )
    breach = by_metric(specs, lambda spec: spec.breaches("t_stat_channel_specific"))
    large = by_metric(specs, lambda spec: spec.impact_is_large("Lost_Volume", "Total_Volume_Amount_Lost"))
    return scored.selectExpr("*", f"{breach} AS channel_breach", f"{large} AS impact_is_large")


def score(
    daily: DataFrame, specs: Sequence[MetricSpec], clock: Clock, min_std: float | None = None
) -> DataFrame:
    """Both t-statistics, share and impact per (metric, alias, channel, MIT flag).

    The join drops unresolved merchants and unknown MIT flags, as ``=`` rejects
    NULL; a NULL channel stays. The share's whole comes from the merchant side
    as one more daily sum, so no window has to gather all channels of a
    merchant in one task.
    """
    require_distinct(specs)
    return score_baselines(
        merchant_baseline(daily, specs, clock), channel_baseline(daily, specs, clock), specs, min_std
    )


def score_baselines(
    merchants: DataFrame,
    channels: DataFrame,
    specs: Sequence[MetricSpec],
    min_std: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The same from both baselines; ``by`` names columns that tell several tested days apart."""
    scored_merchants = score_merchants(merchants, specs, min_std, by)
    scored_channels = score_channels(channels, specs, min_std, by)
    joined = scored_channels.join(scored_merchants, [*by, "Anomaly_Type", "alias_name", "is_mit"], "inner")
    return joined.selectExpr("*", f"{share_pct('volume', 'active_volume')} AS channel_vol_share_pct")
