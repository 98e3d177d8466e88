"""Keep what breaches at both levels with enough impact, label it, order it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.text import quoted
from ratewatch.specs import MetricSpec, by_metric

PRIMARY_SHARE_PCT = 50

BOTH_BREACH = "merchant_breach AND channel_breach"


def _severity(spec: MetricSpec) -> str:
    return (
        f"CASE WHEN {BOTH_BREACH} AND channel_vol_share_pct > {PRIMARY_SHARE_PCT}"
        f" THEN {quoted(spec.primary_label)}"
        f" WHEN {BOTH_BREACH} THEN {quoted(spec.global_label)}"
        f" ELSE {quoted(spec.below_label)} END"
    )


def classify(
    scored: DataFrame, specs: Sequence[MetricSpec], keep_all: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Severity label per row; drops rows below the gates unless ``keep_all``, and keeps columns ``by``.

    Each gate is a column of one join side, so the filters run before the join:
    only breaching merchants and breaching channels are ever shuffled to it.
    """
    if not keep_all:
        scored = scored.where(f"{BOTH_BREACH} AND impact_is_large")
    return scored.selectExpr(
        *by,
        "Anomaly_Type",
        f"{by_metric(specs, _severity)} AS overall_status",
        "alias_name",
        "channel_id",
        "is_mit",
        "t_stat_alias_global",
        "t_stat_channel_specific",
        "channel_vol_share_pct",
        "Total_Volume_Amount_Lost",
        "Lost_Volume",
        "ATV",
    )


def in_report_order(anomalies: DataFrame) -> DataFrame:
    """By metric, MIT flag and lost amount; alias and channel settle ties."""
    amount = F.expr("coalesce(Total_Volume_Amount_Lost, 0D)")
    return anomalies.orderBy("Anomaly_Type", "is_mit", amount.desc(), "alias_name", "channel_id")
