"""From the five inputs to the 15 result columns, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame

from ratewatch.clock import Clock
from ratewatch.operators.classify import classify, in_report_order
from ratewatch.operators.daily import LOOKBACK_DAYS, daily_performance
from ratewatch.operators.links import DEFAULT_BASE_URL, LinkStyle, with_links
from ratewatch.operators.managers import with_manager
from ratewatch.operators.resolve import BROADCAST_BYTES, BROADCAST_ROWS, Lookups
from ratewatch.operators.score import score
from ratewatch.sources.schemas import COLUMN_ORDER
from ratewatch.sources.tables import Tables
from ratewatch.specs import DEFAULT_SPECS, MetricSpec


def daily(
    tables: Tables,
    clock: Clock,
    lookback_days: int = LOOKBACK_DAYS,
    upto: datetime | None = None,
    day_column: str | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The daily roll-up of resolved payments."""
    lookups = Lookups.prepare(tables.account_map, tables.account_dim, tables.alias_dim, max_rows, max_bytes)
    return daily_performance(tables.payments, lookups, clock, lookback_days, upto, day_column)


def detect_in(
    daily_frame: DataFrame,
    tables: Tables,
    clock: Clock,
    specs: Sequence[MetricSpec] = DEFAULT_SPECS,
    base_url: str = DEFAULT_BASE_URL,
    min_std: float | None = None,
    link_style: LinkStyle | None = None,
) -> DataFrame:
    """Detect in a daily roll-up, unordered."""
    flagged = classify(score(daily_frame, specs, clock, min_std), specs)
    enriched = with_manager(flagged, tables.alias_dim, tables.employee_dim)
    return with_links(enriched, clock, base_url, link_style).select(*COLUMN_ORDER)


def detect(
    tables: Tables,
    as_of: Clock | datetime | date | str | None = None,
    specs: Sequence[MetricSpec] = DEFAULT_SPECS,
    lookback_days: int = LOOKBACK_DAYS,
    base_url: str = DEFAULT_BASE_URL,
    upto: datetime | None = None,
    day_column: str | None = None,
    min_std: float | None = None,
    link_style: LinkStyle | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Yesterday's anomalies in report order; ``as_of`` is a UTC instant, now when omitted."""
    clock = Clock.at(as_of)
    rolled = daily(tables, clock, lookback_days, upto, day_column, max_rows, max_bytes)
    return in_report_order(detect_in(rolled, tables, clock, specs, base_url, min_std, link_style))
