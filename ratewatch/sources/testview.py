"""The given test tables, seen as the five inputs.

Every row of ``events`` is one payment attempt. Customers are the merchants:
even ones are mapped by entity, odd ones only by merchant account, so both
resolution paths carry rows. The accounts of one region carry an alias that
the alias table does not know, so their payments stay unresolved.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.sources.tables import Tables

AS_OF = "2024-01-31"
# A day with more breaches, for the ranked digest.
DIGEST_AS_OF = "2024-01-21"
# A mid-day instant whose lookback cuts the event range within a day.
MID_DAY_AS_OF = "2024-02-10T12:00:00"


# The columns read, declared so that no job has to infer them.
_COLUMNS = {
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def payments_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.get_json_object("props", "$.k").cast("int")
    events = _read(spark, sf_dir, "events").withColumn("k", parsed)
    k = F.col("k")
    accepted = F.col("event_type") != "error"
    return events.select(
        F.col("ts").alias("requested_at"),
        F.col("user_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("merchant_account_id"),
        F.when(k < 60, "pc_0").when(k < 85, "pc_1").otherwise("pc_2").alias("processing_channel_id"),
        (k % 2 == 0).alias("is_merchant_initiated"),
        accepted.cast("bigint").alias("accepted_payments"),
        F.lit(1).cast("bigint").alias("requested_payments"),
        F.when(accepted, F.col("value") * 100).otherwise(0.0).alias("captured_amount_usd"),
        accepted.cast("bigint").alias("captured_payments"),
        (F.col("event_type") == "click").cast("bigint").alias("fraud_reported_payments"),
        (F.col("event_type") == "view").cast("bigint").alias("disputed_payments"),
    )


def account_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    return _read(spark, sf_dir, "customer").select(
        F.when(even, F.col("c_custkey")).alias("entity_id"),
        F.when(~even, F.col("c_custkey")).alias("merchant_account_id"),
        F.col("c_nationkey").alias("account_id"),
    )


def account_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    alias = F.when(F.col("r_name") == "MIDDLE EAST", "UNLISTED").otherwise(F.col("r_name"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("account_id"), alias.alias("salesforce_alias")
    )


def alias_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "region").select(
        F.col("r_name").alias("salesforce_alias"),
        F.col("r_regionkey").alias("account_manager_id"),
        F.concat(F.lit("Manager "), F.col("r_name")).alias("account_manager_name"),
    )


def employee_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    local_part = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(".")))
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("user_id"),
        F.concat(local_part, F.lit("@example.com")).alias("email"),
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        payments=payments_daily(spark, sf_dir),
        account_map=account_map(spark, sf_dir),
        account_dim=account_dim(spark, sf_dir),
        alias_dim=alias_dim(spark, sf_dir),
        employee_dim=employee_dim(spark, sf_dir),
    )


def customer_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The same payments with every customer as a merchant of its own: many short, sparse series."""
    customer = _read(spark, sf_dir, "customer")
    regional = tables(spark, sf_dir)
    even = F.col("c_custkey") % 2 == 0
    return replace(
        regional,
        account_map=customer.select(
            F.when(even, F.col("c_custkey")).alias("entity_id"),
            F.when(~even, F.col("c_custkey")).alias("merchant_account_id"),
            F.col("c_custkey").alias("account_id"),
        ),
        account_dim=customer.select(
            F.col("c_custkey").alias("account_id"), F.col("c_name").alias("salesforce_alias")
        ),
        alias_dim=customer.select(
            F.col("c_name").alias("salesforce_alias"),
            F.col("c_nationkey").alias("account_manager_id"),
            F.concat(F.lit("Manager "), F.col("c_nationkey")).alias("account_manager_name"),
        ),
    )


def text_id_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The regional tables with text entity ids in the facts, which the map stores as numbers."""
    regional = tables(spark, sf_dir)
    return replace(regional, payments=regional.payments.withColumn("entity_id", F.col("entity_id").cast("string")))


def awkward_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Many merchants of many channels, with spaces, commas, quotes, stars, tildes and line breaks in their names."""
    regional = tables(spark, sf_dir)
    customer, nation = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "nation")
    number = F.col("n_nationkey")
    alias = F.concat(
        F.when(number % 3 == 0, " Shop, ").otherwise("Shop "), number.cast("string"),
        F.when(number % 4 == 0, ' "A" *').when(number % 4 == 1, "~ ").when(number % 4 == 2, "\nline").otherwise("'s é"),
    )
    named = nation.select(number, alias.alias("alias"))
    channel = F.concat(F.lit("pc "), (F.hour("requested_at") % 9).cast("string"), F.lit(" "))
    even = F.col("c_custkey") % 2 == 0
    return replace(
        regional,
        payments=regional.payments.withColumn("processing_channel_id", channel),
        account_map=customer.select(
            F.when(even, F.col("c_custkey")).alias("entity_id"),
            F.when(~even, F.col("c_custkey")).alias("merchant_account_id"),
            F.col("c_nationkey").alias("account_id"),
        ),
        account_dim=named.select(number.alias("account_id"), F.col("alias").alias("salesforce_alias")),
        alias_dim=named.select(
            F.col("alias").alias("salesforce_alias"),
            number.alias("account_manager_id"),
            F.concat(F.lit("Manager "), number).alias("account_manager_name"),
        ),
    )
