"""Run summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.text import quoted
from ratewatch.specs import MetricSpec


def counts_by_metric(anomalies: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """(Anomaly_Type, anomalies): the total and each metric, zero when it has none.

    Conditional counts in one pass; a metric without rows needs no outer join.
    """
    counts = ["struct('Total' AS Anomaly_Type, count(1) AS anomalies)"]
    for spec in specs:
        label = quoted(spec.label)
        counts.append(f"struct({label} AS Anomaly_Type, count_if(Anomaly_Type = {label}) AS anomalies)")
    counted = anomalies.agg(F.expr(f"array({', '.join(counts)})").alias("counts"))
    return counted.selectExpr("inline(counts)")
