"""Many as-of days at once: the union of single runs. A window that slides: the baseline of all its days."""

from __future__ import annotations

import contextlib
import io
import random
import re
import statistics
from datetime import date, datetime, timedelta
from fractions import Fraction

import pytest
import shop
from pyspark.sql import functions as F

from ratewatch import DEFAULT_SPECS, Clock, detect
from ratewatch.functions.stats import mean, spread
from ratewatch.operators.baseline import channel_baseline, merchant_baseline
from ratewatch.operators.daily import merchant_daily
from ratewatch.operators.rolling import rolling_channel_baseline
from ratewatch.operators.score import score
from ratewatch.plans.detect import daily
from ratewatch.plans.rolling import rolling_detect, rolling_scores
from ratewatch.plans.sliding import BaselineState
from ratewatch.sources import testview

DATA = "/root/testdata/sf0.001"


def _sorted(frame):
    return sorted(map(repr, frame.collect()))


def test_equals_single_runs(spark):
    tables = shop.tables(spark)
    days = [date(2024, 1, 29) + timedelta(days=i) for i in range(5)]
    single = [r for day in days for r in _sorted(detect(tables, day, upto=datetime.combine(day, datetime.min.time())))]
    assert len(single) > 10
    assert _sorted(rolling_detect(tables, days[0], days[-1])) == sorted(single)
    assert _sorted(rolling_detect(tables, days[2].isoformat(), days[2].isoformat())) == _sorted(
        detect(tables, days[2], upto=datetime.combine(days[2], datetime.min.time()))
    )


def test_equals_single_scores_of_every_day(spark):
    tables = testview.customer_tables(spark, DATA)
    first, last = date(2024, 1, 3), date(2024, 1, 12)
    rolled = daily(tables, Clock.at(last), 40, datetime(2024, 1, 12)).cache()
    found = rolling_scores(rolled, first, last, lookback_days=5)
    columns = sorted(c for c in found.columns if c != "as_of")
    day = first
    while day <= last:
        clock = Clock.at(day)
        seen = rolled.where((F.col("requested_date") >= F.lit(day - timedelta(days=5))) & (F.col("requested_date") < F.lit(day)))
        own = found.where(F.col("as_of") == F.lit(day)).select(*columns)
        assert _sorted(own) == _sorted(score(seen, DEFAULT_SPECS, clock).select(*columns))
        day += timedelta(days=1)
    rolled.unpersist()


def test_facts_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "payments")
    tables = shop.tables(spark)
    tables.payments.write.parquet(path)
    from dataclasses import replace

    found = rolling_detect(replace(tables, payments=spark.read.parquet(path)), "2024-01-20", "2024-02-01")
    found.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        found.explain()
    final = text.getvalue().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[requested_at", final)) <= 1 + final.count("ReusedExchange")


def test_frames_do_not_depend_on_the_days_beside_them(spark):
    tables = testview.customer_tables(spark, DATA)
    rolled = daily(tables, Clock.at("2024-01-31"), 30, datetime(2024, 1, 31)).cache()
    whole = rolling_channel_baseline(rolled, DEFAULT_SPECS, 7).where("requested_date = DATE'2024-01-20'")
    part = rolling_channel_baseline(
        rolled.where("requested_date BETWEEN DATE'2024-01-14' AND DATE'2024-01-20'").repartition(13), DEFAULT_SPECS, 7
    ).where("requested_date = DATE'2024-01-20'")
    assert _sorted(whole) == _sorted(part) and whole.count() > 50
    rolled.unpersist()


# --- exact spread -----------------------------------------------------------


def test_spread_has_the_same_bits_in_any_order(spark):
    rng = random.Random(3)
    rows = []
    for group in range(120):
        base, size = rng.choice([0.5, 1 / 3, 1e-6, 100.0, -5.0, 0.0, 2000.0]), rng.choice([0, 1e-9, 1e-3, 1])
        rows += [(group, None if rng.random() < 0.1 else base + size * rng.random()) for _ in range(rng.randint(1, 60))]
    results = set()
    for partitions in (1, 7, 64):
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "g int, x double").repartition(partitions)
        found = frame.groupBy("g").agg(F.expr(spread("x")).alias("s"), F.expr(mean("x")).alias("m")).collect()
        results.add(tuple(sorted((r.g, repr(r.s), repr(r.m)) for r in found)))
    assert len(results) == 1
    for group, s, _ in results.pop():
        values = [Fraction(x) for g, x in rows if g == group and x is not None]
        if len(values) < 2:
            assert s == "None"
        else:
            exact = float(statistics.variance(values)) ** 0.5
            assert float(s) == pytest.approx(exact, rel=1e-6, abs=3e-13 * max(map(abs, values)))


def test_equal_rates_have_no_spread_and_large_ones_are_not_lost(spark):
    frame = spark.createDataFrame([(0, 0.1)] * 9 + [(1, 1e9), (1, 1e9 + 4)] + [(2, 99_999.0 + i) for i in range(40)], "g int, x double")
    found = {r.g: r.s for r in frame.groupBy("g").agg(F.expr(spread("x")).alias("s")).collect()}
    assert found[0] == 0.0
    assert found[1] == pytest.approx(8**0.5)
    assert found[2] == pytest.approx(statistics.stdev(range(40)), rel=1e-6)


def test_the_t_statistic_has_the_same_bits_in_any_order(spark):
    tables = testview.customer_tables(spark, DATA)
    rolled = daily(tables, Clock.at(testview.AS_OF)).cache()
    results = {
        tuple(_sorted(score(rolled.repartition(n), DEFAULT_SPECS, Clock.at(testview.AS_OF)))) for n in (1, 7, 64)
    }
    assert len(results) == 1
    rolled.unpersist()


# --- sliding state ----------------------------------------------------------


def test_every_day_equals_the_baseline_over_the_window(spark, tmp_path):
    tables, length = testview.customer_tables(spark, DATA), 6
    rolled = daily(tables, Clock.at("2024-01-20"), 40, datetime(2024, 1, 20)).cache()
    state = BaselineState(spark, str(tmp_path), lookback_days=length)
    assert state.as_of() is None
    for day in (date(2024, 1, 7) + timedelta(days=i) for i in (0, 1, 2, 5, 4, 13)):
        state.move(rolled, day)
        assert state.as_of() == day
        clock = Clock.at(day)
        seen = rolled.where((F.col("requested_date") >= F.lit(day - timedelta(days=length))) & (F.col("requested_date") < F.lit(day)))
        columns = ["Anomaly_Type", "alias_name", "channel_id", "is_mit", "n", "mean", "std", "t1", "atv", "volume", "incidents"]
        assert _sorted(state.channels(rolled).select(*columns)) == _sorted(
            channel_baseline(seen, DEFAULT_SPECS, clock).select(*columns)
        )
        columns = ["Anomaly_Type", "alias_name", "is_mit", "n", "mean", "std", "t1", "atv", "active_volume"]
        assert _sorted(state.merchants(rolled).select(*columns)) == _sorted(
            merchant_baseline(seen, DEFAULT_SPECS, clock).select(*columns)
        )
    rolled.unpersist()


def test_a_move_reads_only_the_days_that_enter_and_leave(spark, tmp_path):
    rolled = daily(testview.customer_tables(spark, DATA), Clock.at("2024-01-20"), 40, datetime(2024, 1, 20)).cache()
    state, same = BaselineState(spark, f"{tmp_path}/a", lookback_days=10), BaselineState(spark, f"{tmp_path}/b", lookback_days=10)
    for s in (state, same):
        s.move(rolled, "2024-01-15")
    state.move(rolled.where("requested_date IN (DATE'2024-01-05', DATE'2024-01-15')"), "2024-01-16")
    same.move(rolled, "2024-01-16")
    assert _sorted(state.score(rolled)) == _sorted(same.score(rolled))
    rolled.unpersist()


def test_a_failed_move_leaves_the_state(spark, tmp_path, monkeypatch):
    from ratewatch.sinks import manifest

    rolled = daily(shop.tables(spark), Clock.at("2024-01-31"), 30, datetime(2024, 1, 31)).cache()
    state = BaselineState(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no state"):
        state.correct(rolled, rolled)
    state.move(rolled, "2024-01-30")
    before = _sorted(state.channels(rolled))
    monkeypatch.setattr(manifest, "add", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        state.move(rolled, "2024-01-31")
    assert state.as_of() == date(2024, 1, 30) and _sorted(state.channels(rolled)) == before
    rolled.unpersist()


def test_corrected_days_and_null_keys(spark, tmp_path):
    tables = shop.tables(spark)
    rolled = daily(tables, Clock.at("2024-01-31"), 30, datetime(2024, 1, 31)).cache()
    wrong = rolled.withColumn("accepted_sum", F.when(F.col("requested_date") == "2024-01-29", 1).otherwise(F.col("accepted_sum")))
    state, right = BaselineState(spark, f"{tmp_path}/a"), BaselineState(spark, f"{tmp_path}/b")
    state.move(wrong, "2024-01-31")
    right.move(rolled, "2024-01-31")
    assert _sorted(state.channels(rolled)) != _sorted(right.channels(rolled))
    day = "requested_date = DATE'2024-01-29'"
    state.correct(wrong.where(day), rolled.where(day))
    assert _sorted(state.channels(rolled)) == _sorted(right.channels(rolled))
    assert _sorted(state.merchants(rolled)) == _sorted(right.merchants(rolled))
    assert state.channels(rolled).where("channel_id IS NULL").count() > 0
    assert state.merchants(rolled).where("alias_name IS NULL").count() > 0
    assert merchant_daily(rolled, DEFAULT_SPECS).where("alias_name IS NULL").count() > 0
    rolled.unpersist()


def test_a_rate_too_large_for_exact_squares_is_refused(spark, tmp_path):
    rows = [shop.row("Drop", d, requested=1, accepted=10**6 + d) for d in (1, 2, 3)]
    rolled = daily(shop.tables(spark, rows), Clock.at("2024-01-31"), 30).cache()
    state = BaselineState(spark, str(tmp_path))
    state.move(rolled, "2024-01-31")
    with pytest.raises(Exception, match="too large for exact squares"):
        state.channels(rolled).collect()
    rolled.unpersist()
