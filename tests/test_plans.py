"""The executed plans: what is scanned, shuffled and gathered."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ratewatch import DEFAULT_SPECS, FRAUD, Clock, detect
from ratewatch.operators import digest
from ratewatch.operators.daily import daily_performance, lookback
from ratewatch.operators.resolve import Lookups, join_account, join_entity, join_merchant_account
from ratewatch.plans.detect import detect_in
from ratewatch.sources import schemas, testview

SF_DIR = "/root/testdata/sf0.01"
CLOCK = Clock.at(testview.AS_OF)


def executed(frame):
    frame.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue().split("== Initial Plan ==")[0]


def fact_scans(plan):
    return re.findall(r"FileScan parquet \[[^\]]*user_id[^\n]*", plan)


@pytest.mark.parametrize("specs", [DEFAULT_SPECS, (FRAUD,)], ids=["all", "fraud"])
def test_facts_are_scanned_once(spark, specs):
    plan = executed(detect(testview.tables(spark, SF_DIR), CLOCK, specs))
    scans = fact_scans(plan)
    assert len(scans) == 1
    assert "ReusedExchange" in plan
    assert "SortAggregate" not in plan
    assert "GreaterThanOrEqual(ts" in scans[0]
    assert "event_id" not in scans[0]
    assert "Window" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "UDF" not in plan


def test_small_lookups_are_broadcast_and_facts_shuffled_once(spark):
    tables = testview.tables(spark, SF_DIR)
    lookups = Lookups.prepare(tables.account_map, tables.account_dim, tables.alias_dim)
    plan = executed(daily_performance(tables.payments, lookups, CLOCK))
    assert lookups.small
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2


def test_large_lookups_meet_pre_aggregated_facts(spark):
    tables = testview.tables(spark, SF_DIR)
    lookups = Lookups.prepare(tables.account_map, tables.account_dim, tables.alias_dim, max_rows=1)
    assert not lookups.small
    plan = executed(detect_in(daily_performance(tables.payments, lookups, CLOCK), tables, CLOCK))
    # One scan for the sums, one of the ids alone for the distinct pairs.
    schemas_read = sorted(re.search(r"ReadSchema: (\S+)", scan).group(1) for scan in fact_scans(plan))
    assert schemas_read[1] == "struct<ts:timestamp_ntz,user_id:bigint>"
    assert len(schemas_read) == 2
    # The facts are aggregated on their own ids before they meet any lookup.
    assert re.search(r"HashAggregate\(keys=\[requested_date\S*, entity_id", plan)


def test_a_hot_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    facts = spark.range(0, 60_000, 1, 8).selectExpr(
        "timestampadd(HOUR, -1 - cast(id % 700 AS int), TIMESTAMP'2024-01-31 00:00:00') AS requested_at",
        "if(id % 3 = 0, 'hot', concat('e', id % 900)) AS entity_id",
        "CAST(NULL AS string) AS merchant_account_id",
        "concat('pc_', xxhash64(id) % 4000) AS processing_channel_id",
        "id % 2 = 0 AS is_merchant_initiated",
        "1L AS accepted_payments", "1L AS requested_payments", "1D AS captured_amount_usd",
        "1L AS captured_payments", "0L AS fraud_reported_payments", "0L AS disputed_payments",
    )
    account_map = spark.range(900).selectExpr(
        "if(id = 0, 'hot', concat('e', id)) AS entity_id", "CAST(NULL AS bigint) AS merchant_account_id",
        "cast(id AS string) AS account_id",
    )
    account_dim = spark.range(900).selectExpr("cast(id AS string) AS account_id", "concat('s', id) AS salesforce_alias")
    alias_dim = account_dim.select("salesforce_alias")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        lookups = Lookups.prepare(account_map, account_dim, alias_dim, max_rows=1)
        daily = daily_performance(facts, lookups, CLOCK)
        plan = executed(daily)
        rows = daily.groupBy().sum("requested_sum").first()[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    # The pair is salted (``test_hot_pairs.py`` counts its rows per task), so adaptive execution finds nothing to split.
    assert re.search(r"SortMergeJoin \[[^\]]*salt", plan)
    assert "skew=true" not in plan
    assert rows == 60_000


def test_rows_without_a_key_are_dealt_out(spark):
    """With 60 % of the ids missing, no partition of a shuffle join holds over twice the mean."""
    facts = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 10 < 6, NULL, concat('e', id)) AS entity_id", "concat('m', id) AS merchant_account_id"
    )
    account_map = spark.range(0, 200_000, 7).selectExpr(
        "concat('e', id) AS entity_id", "CAST(NULL AS bigint) AS merchant_account_id", "cast(id AS string) AS account_id"
    )
    account_dim = account_map.selectExpr("account_id", "concat('s', account_id) AS salesforce_alias")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        lookups = Lookups.prepare(account_map, account_dim, account_dim.select("salesforce_alias"), max_rows=0)
        joins = [join_entity(facts, lookups.account_map, spread=True)]
        joins.append(join_merchant_account(joins[0], lookups.account_map, spread=True))
        joins.append(join_account(joins[1], lookups.accounts, spread=True))
        for joined in joins:
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 200_000 and max(sizes) <= 2 * 200_000 / 16
        found = joins[2].where("alias_name IS NOT NULL").count()
        assert found == facts.join(account_map, "entity_id").count() > 0
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_partition_column_prunes_days(spark, tmp_path):
    path = str(tmp_path / "payments")
    payments = testview.payments_daily(spark, SF_DIR).selectExpr("*", "to_date(requested_at) AS day")
    payments.write.partitionBy("day").parquet(path)
    recent = lookback(spark.read.parquet(path), Clock.at("2024-02-20"), day_column="day")
    scan = re.search(r"FileScan.*", executed(recent)).group()
    assert re.search(r"PartitionFilters: \[[^\]]*day\S* >= 2024-01-21", scan)
    assert recent.count() == payments.where("day >= DATE'2024-01-21'").count()
    bounded = lookback(spark.read.parquet(path), CLOCK, upto=datetime(2024, 1, 5, 12), day_column="day")
    scan = re.search(r"FileScan.*", executed(bounded)).group()
    assert re.search(r"PartitionFilters: \[[^\]]*day\S* <= 2024-01-05", scan)
    assert bounded.count() == payments.where("requested_at < TIMESTAMP_NTZ'2024-01-05 12:00:00'").count()


def test_digest_ranks_before_it_shuffles(spark, tmp_path):
    rows = [
        (
            "AR Anomaly", "P1", f"alias{i % 9}", f"pc_{i}", False, -3.0, -3.0, 1.0, 1000.0 + i, 1.0, 1.0,
            "2024-01-31", "", None, None,
        )
        for i in range(500)
    ]
    spark.createDataFrame(rows, schemas.ANOMALIES).write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    merchants = digest.top_merchants(stored)
    assert "TakeOrderedAndProject" in executed(merchants)
    plan = executed(digest.top_channels(stored, merchants))
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    assert "BroadcastHashJoin" in plan


def test_time_zone_aware_timestamps_push_down(spark, tmp_path):
    path = str(tmp_path / "payments")
    payments = testview.payments_daily(spark, SF_DIR)
    payments.withColumn("requested_at", payments.requested_at.cast("timestamp")).write.parquet(path)
    scan = re.search(r"FileScan.*", executed(lookback(spark.read.parquet(path), CLOCK))).group()
    assert "GreaterThanOrEqual(requested_at,2024-01-01" in scan
