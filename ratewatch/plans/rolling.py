"""Many as-of days in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.clock import Clock
from ratewatch.operators.classify import classify
from ratewatch.operators.daily import LOOKBACK_DAYS
from ratewatch.operators.links import DEFAULT_BASE_URL, LinkStyle, with_links
from ratewatch.operators.managers import with_manager
from ratewatch.operators.resolve import BROADCAST_BYTES, BROADCAST_ROWS
from ratewatch.operators.rolling import TESTED, rolling_channel_baseline, rolling_merchant_baseline
from ratewatch.operators.score import score_baselines
from ratewatch.plans.detect import daily
from ratewatch.sources.schemas import COLUMN_ORDER
from ratewatch.sources.tables import Tables
from ratewatch.specs import DEFAULT_SPECS, MetricSpec, require_distinct


def _midnight(day: date | str) -> datetime:
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return datetime.combine(day, time())


def rolling_scores(
    daily_frame: DataFrame,
    first: date | str,
    last: date | str,
    specs: Sequence[MetricSpec] = DEFAULT_SPECS,
    lookback_days: int = LOOKBACK_DAYS,
    min_std: float | None = None,
) -> DataFrame:
    """``score`` for every as-of day from ``first`` to ``last``, with ``as_of``; both are included.

    An as-of day is its midnight in UTC, and sees nothing from then on, as a run
    with ``upto`` at that midnight. ``daily_frame`` holds the daily roll-up from
    ``lookback_days`` before ``first`` on.
    """
    require_distinct(specs)
    first, last = _midnight(first).date(), _midnight(last).date()
    seen = daily_frame.where(
        F.col(TESTED).between(F.lit(first - timedelta(days=lookback_days)), F.lit(last - timedelta(days=1)))
    )
    scored = score_baselines(
        rolling_merchant_baseline(seen, specs, lookback_days).where(_tested(first)),
        rolling_channel_baseline(seen, specs, lookback_days).where(_tested(first)),
        specs,
        min_std,
        by=[TESTED],
    )
    return scored.withColumn("as_of", F.date_add(TESTED, 1)).drop(TESTED)


def _tested(first: date):
    # Days before the first tested one only fill frames.
    return F.col(TESTED) >= F.lit(first - timedelta(days=1))


def rolling_detect(
    tables: Tables,
    first: date | str,
    last: date | str,
    specs: Sequence[MetricSpec] = DEFAULT_SPECS,
    lookback_days: int = LOOKBACK_DAYS,
    base_url: str = DEFAULT_BASE_URL,
    day_column: str | None = None,
    min_std: float | None = None,
    link_style: LinkStyle | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The anomalies of every as-of day from ``first`` to ``last``, unordered, in the columns of ``detect``.

    The union of ``detect(tables, day, upto=day)`` over these days, but the facts
    are scanned and rolled up once for all of them.
    """
    clock, days = Clock.at(_midnight(last)), (_midnight(last) - _midnight(first)).days
    rolled = daily(tables, clock, lookback_days + days, clock.as_of, day_column, max_rows, max_bytes)
    scored = rolling_scores(rolled, first, last, specs, lookback_days, min_std)
    flagged = classify(scored, specs, by=["as_of"])
    dated = flagged.withColumn("Date_of_Detection", F.date_format("as_of", "yyyy-MM-dd")).drop("as_of")
    enriched = with_manager(dated, tables.alias_dim, tables.employee_dim)
    return with_links(enriched, None, base_url, link_style).select(*COLUMN_ORDER)
