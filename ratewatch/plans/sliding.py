"""Baselines kept from day to day in a folder, instead of summed anew over the lookback."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.clock import Clock
from ratewatch.operators.classify import classify, in_report_order
from ratewatch.operators.daily import CHANNEL_KEYS, LOOKBACK_DAYS, MERCHANT_KEYS, merchant_daily
from ratewatch.operators.links import DEFAULT_BASE_URL, LinkStyle, with_links
from ratewatch.operators.managers import with_manager
from ratewatch.operators.score import score_baselines
from ratewatch.operators.sliding import sliding_channel_baseline, sliding_merchant_baseline, slid, state_of
from ratewatch.sinks import manifest
from ratewatch.sources.schemas import COLUMN_ORDER
from ratewatch.sources.tables import Tables
from ratewatch.specs import DEFAULT_SPECS, MetricSpec, require_distinct

_KEY = "baseline"


class BaselineState:
    """Two states, of merchants and of channels, for the window that ends before an as-of day.

    Every move writes new states beside the old ones and then makes them
    current, so that a failed move leaves the state where it was.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        specs: Sequence[MetricSpec] = DEFAULT_SPECS,
        lookback_days: int = LOOKBACK_DAYS,
    ):
        require_distinct(specs)
        self.spark, self.folder, self.specs, self.lookback_days = spark, folder, specs, lookback_days

    def as_of(self) -> date | None:
        """The as-of day of the stored window, or None before the first move."""
        entry = self._entry()
        return None if entry is None else date.fromisoformat(entry.facts["as_of"])

    def move(self, daily: DataFrame, as_of: date | str) -> None:
        """Slide the window to ``as_of``, whose days are the ``lookback_days`` before it.

        ``daily`` holds the daily roll-up of the days that enter and leave (of
        the whole window, the first time); no other days are read from it.
        """
        day = date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        now = self.as_of()
        if now is None:
            window = daily.where(self._within(day))
            self._write(day, {name: state_of(days, keys, self.specs) for name, days, keys in self._levels(window)})
            return
        entering = dict(self._kinds(daily.where(self._within(day) & ~self._within(now))))
        leaving = dict(self._kinds(daily.where(self._within(now) & ~self._within(day))))
        self._write(day, {
            name: slid(self._read(name), entering[name], leaving[name], keys, self.specs) for name, keys in _KEYS.items()
        })

    def moving(self, as_of: date) -> Column:
        """Whether ``move`` reads a row: its day enters or leaves the window."""
        now = self.as_of()
        if now is None:
            return self._within(as_of)
        return (self._within(as_of) & ~self._within(now)) | (self._within(now) & ~self._within(as_of))

    def correct(self, before: DataFrame, after: DataFrame) -> None:
        """Replace days of the window whose facts have changed: the roll-up of these days as it was and as it is."""
        now = self.as_of()
        if now is None:
            raise ValueError("there is no state to correct")
        entering, leaving = (dict(self._kinds(days.where(self._within(now)))) for days in (after, before))
        self._write(now, {
            name: slid(self._read(name), entering[name], leaving[name], keys, self.specs) for name, keys in _KEYS.items()
        })

    def merchants(self, daily: DataFrame) -> DataFrame:
        """``merchant_baseline`` of the stored window; ``daily`` holds its last day."""
        return sliding_merchant_baseline(self._read("merchants"), self._last_day(daily, "merchants"), self.specs, self._clock())

    def channels(self, daily: DataFrame) -> DataFrame:
        """``channel_baseline`` of the stored window; ``daily`` holds its last day."""
        return sliding_channel_baseline(self._read("channels"), self._last_day(daily, "channels"), self.specs, self._clock())

    def score(self, daily: DataFrame, min_std: float | None = None) -> DataFrame:
        """``score`` of the stored window's last day."""
        return score_baselines(self.merchants(daily), self.channels(daily), self.specs, min_std)

    def detect(
        self,
        tables: Tables,
        daily: DataFrame,
        base_url: str = DEFAULT_BASE_URL,
        min_std: float | None = None,
        link_style: LinkStyle | None = None,
    ) -> DataFrame:
        """``detect`` on the as-of day of the stored window, with ``upto`` that day, in report order."""
        flagged = classify(self.score(daily, min_std), self.specs)
        enriched = with_manager(flagged, tables.alias_dim, tables.employee_dim)
        return in_report_order(with_links(enriched, self._clock(), base_url, link_style).select(*COLUMN_ORDER))

    def _clock(self) -> Clock:
        return Clock.at(self.as_of())

    def _last_day(self, daily: DataFrame, name: str) -> DataFrame:
        yesterday = daily.where(F.col("requested_date") == F.lit(self._clock().yesterday))
        return dict(self._kinds(yesterday))[name]

    def _kinds(self, daily: DataFrame):
        return [(name, days) for name, days, _ in self._levels(daily)]

    def _levels(self, daily: DataFrame):
        days = {"merchants": merchant_daily(daily, self.specs), "channels": daily}
        return [(name, days[name], keys) for name, keys in _KEYS.items()]

    def _within(self, as_of: date):
        return F.col("requested_date").between(
            F.lit(as_of - timedelta(days=self.lookback_days)), F.lit(as_of - timedelta(days=1))
        )

    def _entry(self) -> manifest.Entry | None:
        found = manifest.latest(self.spark, f"{self.folder}/_manifest", [_KEY])
        return found[0] if found else None

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{self._entry().run}/{name}")

    def _write(self, as_of: date, states: dict[str, DataFrame]) -> None:
        run = manifest.new_run()
        for name, state in states.items():
            state.write.parquet(f"{self.folder}/{run}/{name}")
        manifest.add(self.spark, f"{self.folder}/_manifest", run, {_KEY: {"as_of": as_of.isoformat()}})


_KEYS = {"merchants": MERCHANT_KEYS, "channels": CHANNEL_KEYS}
