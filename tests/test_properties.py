"""Laws that hold for any input, checked on the test tables."""

from __future__ import annotations

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ratewatch import ACCEPTANCE, DEFAULT_SPECS, Clock
from ratewatch.functions.stats import t_stat
from ratewatch.operators.baseline import channel_baseline
from ratewatch.operators.classify import classify
from ratewatch.operators.daily import MEASURES
from ratewatch.operators.score import score
from ratewatch.plans.detect import daily
from ratewatch.sources import testview

SF_DIR = "/root/testdata/sf0.001"
CLOCK = Clock.at(testview.AS_OF)


@pytest.fixture(scope="module")
def tables(spark):
    return testview.tables(spark, SF_DIR)


def labelled(tables, specs=DEFAULT_SPECS):
    scored = score(daily(tables, CLOCK), specs, CLOCK)
    rows = classify(scored, specs, keep_all=True).collect()
    return {(r.Anomaly_Type, r.alias_name, r.channel_id, r.is_mit): r for r in rows}


@pytest.fixture(scope="module")
def reference(tables):
    return labelled(tables)


def statistics(row):
    return row.t_stat_alias_global, row.t_stat_channel_specific, row.channel_vol_share_pct


def assert_same(got, wanted, fields=lambda row: tuple(row)[1:]):
    assert got.keys() == wanted.keys()
    for key, row in wanted.items():
        for one, other in zip(fields(got[key]), fields(row), strict=True):
            same = pytest.approx(other, abs=1e-9) if isinstance(other, float) else other
            assert one == same, key


def test_a_statistic_never_exceeds_its_day_count(spark, tables):
    sparse = testview.customer_tables(spark, SF_DIR)
    for source in (tables, sparse):
        base = channel_baseline(daily(source, CLOCK), [ACCEPTANCE], CLOCK)
        rows = base.selectExpr(f"{t_stat('t1', 'mean', 'std', 'n')} AS t", "n").where("t IS NOT NULL").collect()
        assert rows and all(abs(r.t) <= r.n - 1 + 1e-9 for r in rows)


def test_shares_of_a_merchant_add_up(reference):
    totals = {}
    for (metric, alias, _, mit), row in reference.items():
        totals.setdefault((metric, alias, mit), []).append(row.channel_vol_share_pct)
    for shares in totals.values():
        assert math.fsum(shares) == pytest.approx(100, abs=0.005 * len(shares))


def test_scaling_all_counts_changes_no_statistic(tables, reference):
    scaled = {name: (F.col(name) * 7).cast(tables.payments.schema[name].dataType) for name in MEASURES}
    assert_same(labelled(replace(tables, payments=tables.payments.withColumns(scaled))), reference, statistics)


def test_row_order_does_not_matter(tables, reference):
    shuffled = tables.payments.orderBy(F.xxhash64("requested_at")).repartition(7)
    assert_same(labelled(replace(tables, payments=shuffled)), reference)


def test_metrics_together_equal_metrics_apart(tables, reference):
    apart = {}
    for spec in DEFAULT_SPECS:
        apart |= labelled(tables, [spec])
    assert_same(apart, reference)


def test_pre_summed_facts_give_the_same(tables, reference):
    keys = [name for name in tables.payments.columns if name not in MEASURES]
    summed = tables.payments.withColumn("requested_at", F.date_trunc("day", "requested_at").cast("timestamp_ntz"))
    summed = summed.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in MEASURES])
    assert_same(labelled(replace(tables, payments=summed)), reference)
