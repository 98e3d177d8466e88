"""Declarative metric definitions: one pipeline, many ratios."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from ratewatch.functions.stats import ratio
from ratewatch.functions.text import quoted

# Two-sided 99 % quantile of the standard normal distribution.
CRITICAL_VALUE = 2.576


@dataclass(frozen=True)
class MetricSpec:
    """A daily rate, the direction that is bad, and the impact worth reporting.

    ``numerator``, ``denominator`` and ``volume`` name columns of the daily
    frame. ``impact`` is ``"loss"`` (estimate lost units and money from the rate
    drop) or ``"count"`` (report yesterday's numerator as it is).
    """

    key: str
    label: str
    numerator: str
    denominator: str
    rises: bool
    impact: str
    gate: float
    primary_label: str
    global_label: str
    below_label: str
    gate_inclusive: bool = False
    critical: float = CRITICAL_VALUE
    volume: str = ""

    def __post_init__(self) -> None:
        if self.impact not in ("loss", "count"):
            raise ValueError(f"impact must be 'loss' or 'count', not {self.impact!r}")
        if not self.volume:
            object.__setattr__(self, "volume", self.denominator)

    def rate(self) -> str:
        return ratio(self.numerator, self.denominator)

    def breaches(self, t: str) -> str:
        return f"{t} > {self.critical!r}D" if self.rises else f"{t} < {-self.critical!r}D"

    def impact_is_large(self, lost_volume: str, lost_amount: str) -> str:
        measured = lost_amount if self.impact == "loss" else lost_volume
        return f"{measured} {'>=' if self.gate_inclusive else '>'} {self.gate!r}D"


# Labels, gates and directions are part of the output contract.
ACCEPTANCE = MetricSpec(
    key="ar",
    label="AR Anomaly",
    numerator="accepted_sum",
    denominator="requested_sum",
    rises=False,
    impact="loss",
    gate=1000.0,
    primary_label="P1: Critical - Primary Channel Outage",
    global_label="P1: Critical - Global Merchant Outage",
    below_label="Alert: Significant Degradation",
)
FRAUD = MetricSpec(
    key="fraud",
    label="Fraud Anomaly",
    numerator="fraud_reported_sum",
    denominator="accepted_sum",
    rises=True,
    impact="count",
    gate=5.0,
    gate_inclusive=True,
    primary_label="P1: Critical - Primary Channel Spike",
    global_label="P1: Critical - Global Merchant Spike",
    below_label="Alert: Significant Increase",
)
DISPUTE = MetricSpec(
    key="dispute",
    label="Dispute Anomaly",
    numerator="disputed_sum",
    denominator="accepted_sum",
    rises=True,
    impact="count",
    gate=3.0,
    gate_inclusive=True,
    primary_label="P1: Critical - Primary Channel Spike",
    global_label="P1: Critical - Global Merchant Spike",
    below_label="Alert: Significant Increase",
)
DEFAULT_SPECS: tuple[MetricSpec, ...] = (ACCEPTANCE, FRAUD, DISPUTE)


def require_distinct(specs: Sequence[MetricSpec]) -> None:
    """Fail while the plan is built when two specs would share columns or rows."""
    for name in ("key", "label"):
        values = [getattr(spec, name) for spec in specs]
        if len(set(values)) < len(values):
            raise ValueError(f"specs need a {name} each, not {values}")


def by_metric(specs: Sequence[MetricSpec], value: Callable[[MetricSpec], str]) -> str:
    """``value(spec)`` for the spec named by each row's ``Anomaly_Type``."""
    cases = " ".join(f"WHEN {quoted(spec.label)} THEN {value(spec)}" for spec in specs)
    return f"CASE Anomaly_Type {cases} END"
