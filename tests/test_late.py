"""A stored roll-up after late, repeated and removed files equals one over all facts."""

from __future__ import annotations

import contextlib
import io
import os
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
import shop
from pyspark.sql import functions as F

from ratewatch import Clock, detect
from ratewatch.operators.daily import daily_performance
from ratewatch.operators.resolve import Lookups
from ratewatch.plans.late import DailyStore, keep_up
from ratewatch.plans.sliding import BaselineState
from ratewatch.sinks import manifest

CLOCK = Clock.at(shop.AS_OF)


def plan_of(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


class Source:
    """Facts by the day that brings them, and the store beside them."""

    def __init__(self, spark, folder):
        self.spark, self.path = spark, f"{folder}/facts"
        self.tables = shop.tables(spark)
        self.store = DailyStore(spark, f"{folder}/store", self.path, "arrived")

    def bring(self, rows, days_late=0):
        frame = self.spark.createDataFrame(rows, self.tables.payments.schema)
        arrived = F.date_add(F.to_date("requested_at"), days_late)
        frame.withColumn("arrived", arrived).repartition(1).write.partitionBy("arrived").mode("append").parquet(self.path)

    def lookups(self, **bounds):
        return Lookups.prepare(self.tables.account_map, self.tables.account_dim, self.tables.alias_dim, **bounds)

    def check(self, clock=CLOCK, upto=None, **bounds):
        lookups = self.lookups(**bounds)
        whole = daily_performance(self.spark.read.parquet(self.path), lookups, clock, upto=upto)
        kept = self.store.daily(lookups, clock, upto=upto)
        assert kept.schema == whole.schema
        rows = sorted(map(repr, kept.collect()))
        assert rows == sorted(map(repr, whole.collect()))
        return len(rows)


@pytest.fixture
def source(spark, tmp_path):
    own = Source(spark, tmp_path)
    own.bring([r for r in shop.payments() if r[0].day % 2 or r[1] != "Drop"])
    return own


def test_late_repeated_and_removed_files(source):
    every = source.store.refresh()
    assert len(every) >= 7 and source.check() > 50
    assert source.store.refresh() == []

    late = [r for r in shop.payments() if not r[0].day % 2 and r[1] == "Drop"]
    source.bring(late, days_late=3)
    changed = source.store.refresh()
    assert changed == sorted({(r[0].date() + timedelta(days=3)).isoformat() for r in late})
    source.check()

    source.bring([r for r in shop.payments() if r[1] == "Flat"])
    assert 0 < len(source.store.refresh()) <= 6
    source.check()

    day = Path(source.path) / "arrived=2024-01-29"
    sorted(day.glob("part-*.parquet"))[0].unlink()
    assert source.store.refresh() == ["2024-01-29"]
    source.check()

    for file in (Path(source.path) / "arrived=2024-01-28").glob("part-*.parquet"):
        file.unlink()
    assert source.store.refresh() == ["2024-01-28"]
    assert source.store.refresh() == []
    source.check()
    source.bring([shop.row("Drop", 3)])
    assert source.store.refresh() == ["2024-01-28"]
    source.check()


@pytest.mark.parametrize(
    ("as_of", "upto"),
    [
        ("2024-01-31T13:00:00", None), ("2024-01-31", datetime(2024, 1, 30, 12)), ("2024-01-31", datetime(2024, 1, 30)),
        ("2024-02-27T12:30:00", datetime(2024, 1, 28, 12)), ("2024-02-26T12:00:00", datetime(2024, 1, 27, 13)),
        ("2025-01-01", None), ("2024-01-31T23:00:00", datetime(2023, 12, 1)),
    ],
)
def test_dates_cut_within_the_day(source, as_of, upto):
    source.bring([r for r in shop.payments() if r[1] == "Idle"], days_late=2)
    source.store.refresh()
    source.check(Clock.at(as_of), upto)


def test_large_lookups_and_changed_lookups(spark, source):
    source.store.refresh()
    source.check(max_rows=0)
    before = source.store.daily(source.lookups(), CLOCK).where("alias_name = 'Drop'").count()
    renamed = source.tables.account_dim.where("account_id <> 'acc-Drop'")
    lookups = Lookups.prepare(source.tables.account_map, renamed, source.tables.alias_dim)
    assert before > 0 == source.store.daily(lookups, CLOCK).where("alias_name = 'Drop'").count()


def test_a_refresh_reads_changed_days_only(source):
    source.store.refresh()
    source.bring([shop.row("Drop", 1)])
    opened = os.stat(next((Path(source.path) / "arrived=2024-01-28").glob("part-*"))).st_mtime
    facts = source.store.facts(["2024-01-30"])
    assert "PartitionFilters: [(coalesce(cast(arrived" in plan_of(facts)
    assert {Path(f).parent.name for f in facts.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"arrived=2024-01-30"}
    # Unreadable files of other days do not matter to the refresh.
    broken = next((Path(source.path) / "arrived=2024-01-28").glob("part-*.parquet"))
    raw = broken.read_bytes()
    broken.write_bytes(b"x" * len(raw))
    os.utime(broken, (opened, opened))
    assert source.store.refresh() == ["2024-01-30"]


def test_listing_reads_no_file(source):
    files = source.spark.read.format("binaryFile").load(source.path).select("path", "length")
    assert "FileScan binaryFile [path#" in plan_of(files) and "content" not in plan_of(files)
    assert len(source.store.file_states()) >= 7


def test_a_failed_refresh_leaves_the_store(source, monkeypatch):
    source.store.refresh()
    kept = sorted(map(repr, source.store.daily(source.lookups(), CLOCK).collect()))
    source.bring([shop.row("Drop", 1, accepted=1)])
    monkeypatch.setattr(manifest, "add", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        source.store.refresh()
    monkeypatch.undo()
    assert sorted(map(repr, source.store.daily(source.lookups(), CLOCK).collect())) == kept
    assert source.store.refresh() == ["2024-01-30"]
    source.check()


def test_rows_without_a_date(spark, source):
    row = (None, *shop.row("Drop", 1)[1:])
    source.bring([row])
    assert source.store.refresh()
    assert "__HIVE_DEFAULT_PARTITION__" in source.store.file_states()
    source.check()
    assert source.store.summed(date(2030, 1, 1)) is None


# --- store and state together -----------------------------------------------


def test_kept_state_follows_late_facts(spark, source, tmp_path):
    """Day by day, with late, repeated and removed files: what a run over all facts would give."""
    state = BaselineState(spark, str(tmp_path / "state"))
    lookups, late = source.lookups(), [r for r in shop.payments() if not r[0].day % 2 and r[1] == "Drop"]

    def check(as_of):
        daily = keep_up(source.store, state, lookups, as_of)
        tables = replace(source.tables, payments=spark.read.parquet(source.path))
        upto = datetime.fromisoformat(as_of)
        expected = detect(tables, as_of, upto=upto)
        assert [repr(r) for r in state.detect(tables, daily).collect()] == [repr(r) for r in expected.collect()]
        fresh = BaselineState(spark, str(tmp_path / f"fresh-{as_of}-{len(list(tmp_path.iterdir()))}"))
        fresh.move(daily, as_of)
        for mine, other in ((state.channels(daily), fresh.channels(daily)), (state.merchants(daily), fresh.merchants(daily))):
            assert sorted(map(repr, mine.collect())) == sorted(map(repr, other.collect()))
        return expected.count()

    check("2024-01-30")
    source.bring(late, days_late=3)
    assert check("2024-01-31") > 10
    sorted((Path(source.path) / "arrived=2024-01-29").glob("part-*.parquet"))[0].unlink()
    source.bring([r for r in shop.payments() if r[1] == "Flat"])
    check("2024-01-31")
    check("2024-02-01")
    check("2024-01-30")


def test_keeping_up_without_changes_corrects_nothing(spark, source, tmp_path, monkeypatch):
    state = BaselineState(spark, str(tmp_path / "state"))
    keep_up(source.store, state, source.lookups(), "2024-01-31")
    monkeypatch.setattr(BaselineState, "correct", lambda *_: 1 / 0)
    keep_up(source.store, state, source.lookups(), date(2024, 2, 1))
    assert state.as_of() == date(2024, 2, 1)


def test_no_lookup_passes_the_driver_when_the_state_is_kept_up(spark, source, tmp_path, monkeypatch):
    """Small lookups have broadcast hints; a plan that the state runs many times must not send them each time."""
    state, lookups, read = BaselineState(spark, str(tmp_path / "state")), source.lookups(), []
    assert lookups.small
    for name in ("move", "correct"):
        own = getattr(BaselineState, name)
        monkeypatch.setattr(BaselineState, name, lambda *args, own=own: (read.extend(args[1:]), own(*args))[1])
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keep_up(source.store, state, lookups, "2024-01-30")
        source.bring([r for r in shop.payments() if not r[0].day % 2 and r[1] == "Drop"], days_late=3)
        kept = keep_up(source.store, state, lookups, "2024-01-31")
        plan = plan_of(kept).splitlines()
        expected = sorted(map(repr, source.store.daily(lookups, Clock.at("2024-01-31"), 31, CLOCK.as_of).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    # Only the bounded list of heavy pairs is broadcast.
    sent = [plan[i + 1 : i + 4] for i, line in enumerate(plan) if "BroadcastExchange" in line]
    assert sent and all(any("TakeOrderedAndProject" in line for line in below) for below in sent)
    # The state reads the roll-up from files, where it was written once.
    frames = [frame for frame in read if hasattr(frame, "schema")]
    assert len(frames) == 4 and not any("Join" in plan_of(frame) or "BroadcastExchange" in plan_of(frame) for frame in frames)
    assert sorted(map(repr, kept.collect())) == expected
