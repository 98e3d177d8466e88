"""Readers, checks, and metrics of one's own."""

from __future__ import annotations

import pytest
import shop

from ratewatch import DEFAULT_SPECS, Clock, MetricSpec, detect, from_catalog, from_files
from ratewatch.operators.resolve import all_within
from ratewatch.sources import schemas
from ratewatch.sources.tables import NAMES

INPUTS = ("payments", "account_map", "account_dim", "alias_dim", "employee_dim")


@pytest.fixture(scope="module")
def expected(spark):
    return sorted(detect(shop.tables(spark), shop.AS_OF).collect(), key=repr)


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_from_files(spark, tmp_path, expected, file_format):
    tables = shop.tables(spark)
    for name, attribute in zip(NAMES, INPUTS, strict=True):
        getattr(tables, attribute).write.format(file_format).save(f"{tmp_path}/{name}")
    stored = from_files(spark, str(tmp_path), file_format)
    assert _keys(detect(stored, shop.AS_OF).collect()) == _keys(expected)


def test_from_catalog(spark, expected):
    tables = shop.tables(spark)
    for name, attribute in zip(NAMES, INPUTS, strict=True):
        getattr(tables, attribute).createOrReplaceGlobalTempView(name)
    assert _keys(detect(from_catalog(spark, "global_temp"), shop.AS_OF).collect()) == _keys(expected)


def _keys(rows):
    return [(r.Anomaly_Type, r.alias_name, r.channel_id, r.is_mit, r.Lost_Volume) for r in sorted(rows, key=repr)]


def test_decimal_money(spark, expected):
    tables = shop.tables(spark)
    exact = tables.payments.withColumn("captured_amount_usd", tables.payments.captured_amount_usd.cast("decimal(18,4)"))
    rows = detect(type(tables)(exact, *[getattr(tables, a) for a in INPUTS[1:]]), shop.AS_OF)
    assert rows.schema == detect(tables, shop.AS_OF).schema
    assert _keys(rows.collect()) == _keys(expected)


def test_another_ratio_is_another_spec(spark):
    capture = MetricSpec(
        key="capture", label="Owner's \"capture\" metric", numerator="captured_sum", denominator="accepted_sum",
        rises=False, impact="count", gate=0.0, gate_inclusive=True,
        primary_label="Primary", global_label="Global", below_label="Below",
    )
    rows = detect(shop.tables(spark), shop.AS_OF, specs=[capture, *DEFAULT_SPECS]).collect()
    mine = [r for r in rows if r.Anomaly_Type == capture.label]
    assert [(r.alias_name, r.overall_status, r.Lost_Volume) for r in mine] == [("Uncaptured", "Primary", 0.0)]
    assert {r.Anomaly_Type for r in rows} == {capture.label} | {s.label for s in DEFAULT_SPECS}


def test_money_can_be_a_numerator(spark):
    ticket = MetricSpec(
        key="ticket", label="Ticket", numerator="captured_amount_sum", denominator="captured_sum",
        rises=True, impact="count", gate=100_000.0,
        primary_label="Primary", global_label="Global", below_label="Below",
    )
    rows = [shop.row("Drop", 5 - i, amount=25_000.0 if i < 4 else 150_000.0) for i in range(5)]
    found = detect(shop.tables(spark, rows), shop.AS_OF, specs=[*DEFAULT_SPECS, ticket]).collect()
    assert [(r.Anomaly_Type, r.Lost_Volume, r.ATV) for r in found] == [("Ticket", 150_000.0, None)]
    assert found[0].t_stat_alias_global == pytest.approx(4)


def test_specs_are_checked():
    with pytest.raises(ValueError, match="impact"):
        MetricSpec("x", "X", "a", "b", True, "maybe", 1.0, "p", "g", "b")


def test_lookups_are_measured(spark):
    frame = spark.range(100).selectExpr("id", "repeat('x', 10) AS text", "CAST(NULL AS string) AS nothing")
    assert all_within([frame], max_rows=100, max_bytes=1190)
    assert not all_within([frame], max_rows=99, max_bytes=1190)
    assert not all_within([frame], max_rows=100, max_bytes=1189)
    assert not all_within([frame, frame.limit(1)], max_rows=50, max_bytes=1 << 20)
    assert all_within([frame.where("id < 0")], max_rows=0, max_bytes=0)


def test_shorter_lookback_and_other_thresholds(spark):
    tables = shop.tables(spark)
    # Three days are too few to breach, except with a fourth row, of today.
    assert {r.alias_name for r in detect(tables, shop.AS_OF, lookback_days=3).collect()} == {"Today"}
    loose = [MetricSpec(**{**vars(spec), "critical": 1.9, "gate": 2.0}) for spec in DEFAULT_SPECS]
    rows = detect(tables, shop.AS_OF, specs=loose).collect()
    assert {"Short", "Fraud4", "Dispute2"} <= {r.alias_name for r in rows}
    clock = Clock.at(shop.AS_OF)
    assert {r.Date_of_Detection for r in rows} == {clock.today.isoformat()}


def test_unique_lookups_pass_the_check(spark):
    alias_dim = shop.tables(spark).alias_dim
    schemas.assert_unique(alias_dim, ["salesforce_alias"], "alias_dim")
    assert schemas.duplicate_keys(alias_dim, ["salesforce_alias"]).count() == 0


def test_text_ids_meet_numbers(spark):
    from ratewatch.operators.resolve import Lookups

    facts = spark.createDataFrame([("7", "1"), ("x7", "2"), (None, "5")], "entity_id string, merchant_account_id string")
    account_map = spark.createDataFrame(
        [(7, None, 70), (None, 5, 50)], "entity_id bigint, merchant_account_id bigint, account_id bigint"
    )
    account_dim = spark.createDataFrame([("70", "A"), ("50", "B")], "account_id string, salesforce_alias string")
    for bound in (0, 1000):
        lookups = Lookups.prepare(account_map, account_dim, account_dim.select("salesforce_alias"), max_rows=bound)
        found = {r["merchant_account_id"]: r["alias_name"] for r in lookups.resolve(facts).collect()}
        assert found == {"1": "A", "2": None, "5": "B"}
