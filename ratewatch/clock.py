"""One clock for the whole run: every date derives from a single UTC instant."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SECONDS_PER_DAY = 86_400


@dataclass(frozen=True)
class Clock:
    """The as-of instant, kept as a naive UTC datetime."""

    as_of: datetime

    @classmethod
    def at(cls, as_of: Clock | datetime | date | str | None = None) -> Clock:
        """Build from a datetime, a date, an ISO string, or now when omitted."""
        if isinstance(as_of, Clock):
            return as_of
        if as_of is None:
            as_of = datetime.now(UTC)
        elif isinstance(as_of, str):
            as_of = datetime.fromisoformat(as_of)
        elif not isinstance(as_of, datetime):
            as_of = datetime(as_of.year, as_of.month, as_of.day)
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(UTC).replace(tzinfo=None)
        return cls(as_of)

    @property
    def today(self) -> date:
        return self.as_of.date()

    @property
    def yesterday(self) -> date:
        return self.today - timedelta(days=1)

    def days_before(self, days: int) -> datetime:
        return self.as_of - timedelta(days=days)


def utc_instant(frame: DataFrame, column: str, when: datetime) -> Column:
    """A foldable literal of ``column``'s own timestamp type, so the filter is pushed down."""
    if frame.schema[column].dataType.typeName() == "timestamp_ntz":
        return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")
    epoch = when.replace(tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    return F.timestamp_micros(F.lit(epoch // timedelta(microseconds=1)))


def utc_date(frame: DataFrame, column: str) -> Column:
    """The UTC calendar day of a timestamp, whatever the session time zone is."""
    value = F.col(column)
    if frame.schema[column].dataType.typeName() == "timestamp_ntz":
        return F.to_date(value)
    days = F.floor(F.unix_seconds(value) / _SECONDS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))
