"""Input and output schemas, and the checks that fail early."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYMENTS = T.StructType(
    [
        T.StructField("requested_at", T.TimestampType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("merchant_account_id", T.StringType()),
        T.StructField("processing_channel_id", T.StringType()),
        T.StructField("is_merchant_initiated", T.BooleanType()),
        T.StructField("accepted_payments", T.LongType()),
        T.StructField("requested_payments", T.LongType()),
        T.StructField("captured_amount_usd", T.DoubleType()),
        T.StructField("captured_payments", T.LongType()),
        T.StructField("fraud_reported_payments", T.LongType()),
        T.StructField("disputed_payments", T.LongType()),
    ]
)
ACCOUNT_MAP = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("merchant_account_id", T.LongType()),
        T.StructField("account_id", T.StringType()),
    ]
)
ACCOUNT_DIM = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("salesforce_alias", T.StringType()),
    ]
)
ALIAS_DIM = T.StructType(
    [
        T.StructField("salesforce_alias", T.StringType()),
        T.StructField("account_manager_id", T.StringType()),
        T.StructField("account_manager_name", T.StringType()),
    ]
)
EMPLOYEE_DIM = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("email", T.StringType()),
    ]
)

# Names, order and types of the result.
ANOMALIES = T.StructType(
    [
        T.StructField("Anomaly_Type", T.StringType()),
        T.StructField("overall_status", T.StringType()),
        T.StructField("alias_name", T.StringType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("is_mit", T.BooleanType()),
        T.StructField("t_stat_alias_global", T.DoubleType()),
        T.StructField("t_stat_channel_specific", T.DoubleType()),
        T.StructField("channel_vol_share_pct", T.DoubleType()),
        T.StructField("Total_Volume_Amount_Lost", T.DoubleType()),
        T.StructField("Lost_Volume", T.DoubleType()),
        T.StructField("ATV", T.DoubleType()),
        T.StructField("Date_of_Detection", T.StringType()),
        T.StructField("Link_to_Look", T.StringType()),
        T.StructField("Account_Manager_Name", T.StringType()),
        T.StructField("Account_Manager_Email", T.StringType()),
    ]
)
COLUMN_ORDER: tuple[str, ...] = tuple(ANOMALIES.fieldNames())


def require_columns(frame: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Fail while the plan is built when an input lacks a column the pipeline reads.

    Only names are checked: identifier types vary between warehouses. Ids that
    two tables store in different types are compared as text.
    """
    missing = [field for field in schema.fieldNames() if field not in frame.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}; it has {frame.columns}")
    return frame


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys never join, so they pass."""
    present = frame.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def assert_unique(frame: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise when a lookup has duplicate keys, which would multiply the sums joined to it."""
    examples = duplicate_keys(frame, keys).limit(5).collect()
    if examples:
        shown = [row.asDict() for row in examples]
        raise ValueError(f"{name} has duplicate keys on {list(keys)}, for example {shown}")
