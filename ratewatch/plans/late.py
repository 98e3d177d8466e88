"""A stored daily roll-up that follows late, repeated and removed files.

Facts lie in one folder per source day. Each source day's facts are summed once,
per requested date and id pair, and kept with the state of the files they came
from: names, sizes and times. A refresh lists the files, without reading them, and
sums only the source days whose state has changed. Sums are linear and ids are
resolved after them, so the roll-up equals one over all facts, whichever source
days its rows came from, and lookups may change without a new read of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.clock import Clock, utc_date
from ratewatch.operators.daily import LOOKBACK_DAYS, MEASURES, lookback, roll_up_days
from ratewatch.operators.resolve import ID_KEYS, Lookups, heavy_pairs, join_resolved_pairs, pair_counts
from ratewatch.plans.sliding import BaselineState
from ratewatch.sinks import manifest
from ratewatch.sources.schemas import PAYMENTS, require_columns

# Fixed value: the folder name of facts without a source day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_GROUP = ("requested_date", *ID_KEYS, "channel_id", "is_mit")


class DailyStore:
    """The roll-up of ``source``, a folder of parquet files partitioned by ``day_column``, kept in ``folder``.

    Every refresh writes the changed days beside the old ones and then makes
    them current at once. A file that changes while a refresh reads is seen
    as changed again by the next one.
    """

    def __init__(self, spark: SparkSession, folder: str, source: str, day_column: str):
        self.spark, self.folder, self.source, self.day_column = spark, folder, source, day_column

    def file_states(self) -> dict[str, str]:
        """The state of each source day's files. Listing reads no file; the driver gets a row per day."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.source)
        of_file = F.xxhash64("path", "length", "modificationTime")
        states = files.groupBy(self._day().alias("day")).agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor(of_file).alias("hash")
        )
        return {r["day"]: f"{r['files']} files, {r['bytes']} bytes, {r['hash'] & (2**64 - 1):016x}" for r in states.collect()}

    def facts(self, days: Sequence[str]) -> DataFrame:
        """The facts of these source days; no other partition is read."""
        payments = require_columns(self.spark.read.parquet(self.source), PAYMENTS, "payments")
        return payments.where(self._day().isin(list(days)))

    def _day(self) -> Column:
        return F.coalesce(F.col(self.day_column).cast("string"), F.lit(NO_DAY))

    def refresh(self) -> list[str]:
        """Sum the source days that are new or have changed, forget those that are gone, and name both."""
        now, entries = self.file_states(), self._entries()
        known = {key: entry.facts["state"] for key, entry in entries.items()}
        changed = sorted(day for day, state in now.items() if known.get(day) != state)
        gone = sorted(day for day, state in known.items() if state and day not in now)
        if not changed and not gone:
            return []
        run, facts = manifest.new_run(), {day: {"state": ""} for day in gone}
        if changed:
            sums = [F.sum(measure).alias(measure) for measure in MEASURES]
            read = self.facts(changed).select("*", self._day().alias("source_day"))
            rows = read.select(
                "source_day", utc_date(read, "requested_at").alias("requested_date"), *ID_KEYS,
                F.col("processing_channel_id").alias("channel_id"), F.col("is_merchant_initiated").alias("is_mit"), *MEASURES,
            )
            summed = rows.groupBy("source_day", *_GROUP).agg(*sums)
            summed.write.partitionBy("source_day").parquet(f"{self.folder}/{run}")
            dates = self.spark.read.parquet(f"{self.folder}/{run}").groupBy(F.coalesce(F.col("source_day").cast("string"), F.lit(NO_DAY)).alias("day"))
            held = {r["day"]: r for r in dates.agg(F.min("requested_date").alias("a"), F.max("requested_date").alias("z")).collect()}
            for day in changed:
                # A source day without rows, or with rows without a date only, has no dates.
                dated = held.get(day)
                first, last = (dated["a"], dated["z"]) if dated else (None, None)
                facts[day] = {"state": now[day], "first": str(first or ""), "last": str(last or "")}
        manifest.add(self.spark, f"{self.folder}/_manifest", run, facts)
        return sorted([*changed, *gone])

    def summed(self, first: date, last: date | None = None) -> DataFrame | None:
        """Stored sums of the requested dates from ``first`` to ``last``, by id pair; None if no source day has any."""
        upto = "9999" if last is None else last.isoformat()
        paths = [
            f"{self.folder}/{entry.run}/source_day={day}"
            for day, entry in sorted(self._entries().items())
            if entry.facts.get("first") and entry.facts["first"] <= upto and entry.facts["last"] >= first.isoformat()
        ]
        if not paths:
            return None
        stored = self.spark.read.parquet(*paths)
        dates = F.col("requested_date") >= F.lit(first)
        return stored.where(dates if last is None else dates & (F.col("requested_date") <= F.lit(last)))

    def daily(
        self, lookups: Lookups, clock: Clock, lookback_days: int = LOOKBACK_DAYS, upto: datetime | None = None
    ) -> DataFrame:
        """``daily_performance`` from the stored sums.

        Dates that the lookback or ``upto`` cuts within the day are read from
        the facts, in the source days that hold any of them.
        """
        since = clock.days_before(lookback_days)
        first = since.date() if since.time() == time() else since.date() + timedelta(days=1)
        last = None if upto is None else upto.date() - timedelta(days=1)
        cut = {day for day, at in ((since.date(), since), (upto and upto.date(), upto)) if at is not None and at.time() != time()}
        parts = [self._cut_day(day, clock, lookback_days, upto) for day in sorted(cut)]
        if last is None or first <= last:
            parts.append(self.summed(first, last))
        parts = [part.select(*_GROUP, *MEASURES) for part in parts if part is not None]
        if not parts:
            parts = [self._sums(self.facts([]), clock, lookback_days, upto)]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if lookups.small:
            return roll_up_days(lookups.resolve(rows))
        counted = pair_counts(rows)
        return roll_up_days(join_resolved_pairs(rows, lookups.resolve(counted), heavy_pairs(counted)))

    def held_dates(self) -> dict[str, tuple[date, date]]:
        """The first and the last requested date of every source day that has any, as last refreshed."""
        of_day = {day: entry.facts for day, entry in self._entries().items() if entry.facts.get("first")}
        return {day: (date.fromisoformat(f["first"]), date.fromisoformat(f["last"])) for day, f in of_day.items()}

    def written(self, rolled: DataFrame) -> DataFrame:
        """These rows from files of their own beside the store, so that no plan over them runs the roll-up again."""
        path = f"{self.folder}/_rolled/{manifest.new_run()}"
        rolled.write.parquet(path)
        return self.spark.read.schema(rolled.schema).parquet(path)

    def _cut_day(self, day: date, clock: Clock, lookback_days: int, upto: datetime | None) -> DataFrame | None:
        text = day.isoformat()
        holders = [
            source for source, entry in self._entries().items()
            if entry.facts.get("first") and entry.facts["first"] <= text <= entry.facts["last"]
        ]
        if not holders:
            return None
        return self._sums(self.facts(holders), clock, lookback_days, upto).where(F.col("requested_date") == F.lit(day))

    def _sums(self, facts: DataFrame, clock: Clock, lookback_days: int, upto: datetime | None) -> DataFrame:
        sums = [F.sum(measure).alias(measure) for measure in MEASURES]
        return lookback(facts, clock, lookback_days, upto).groupBy(*_GROUP).agg(*sums)

    def _entries(self) -> dict[str, manifest.Entry]:
        return {entry.key: entry for entry in manifest.latest(self.spark, f"{self.folder}/_manifest")}


def keep_up(store: DailyStore, state: BaselineState, lookups: Lookups, as_of: date | str) -> DataFrame:
    """Bring both up to ``as_of``: new and late facts into the store, and their days into the state.

    Days of the stored window whose facts have changed leave the state as they
    were and enter as they are; then the window moves on. What is read is the
    changed source days, and the stored sums of the days concerned. Returns the
    daily roll-up of the window, for ``state.detect``. Lookups must be those of
    the last move: a merchant that has changed its alias needs a new state.
    The roll-up of the days concerned is written once, and the state reads it
    many times; its lookups are shuffled, so that none passes the driver.
    """
    day = date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    window, lookups = state.as_of() or day, lookups.shuffled or lookups

    def rolled(first: date, until: date) -> DataFrame:
        at = datetime.combine(until, time())
        return store.daily(lookups, Clock(at), (until - first).days + state.lookback_days, upto=at)

    # The files it reads stay, so it still shows the days as they were after the refresh.
    before, held = rolled(window, window), store.held_dates()
    changed, now = store.refresh(), store.held_dates()
    spans = [of[source] for source in changed for of in (held, now) if source in of]
    after, concerned = rolled(min(window, day), max(window, day)), state.moving(day)
    if spans and state.as_of() is not None:
        dates = F.col("requested_date").between(F.lit(min(s[0] for s in spans)), F.lit(max(s[1] for s in spans)))
        was, stands = store.written(before.where(dates)), store.written(after.where(concerned | dates))
        state.correct(was, stands.where(dates))
    else:
        stands = store.written(after.where(concerned))
    state.move(stands, day)
    return after
