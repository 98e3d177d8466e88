"""Account managers of the flagged merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manager_lookup(alias_dim: DataFrame, employee_dim: DataFrame) -> DataFrame:
    """(salesforce_alias, Account_Manager_Name, Account_Manager_Email)."""
    employees = employee_dim.select(
        F.col("user_id").alias("account_manager_id"), F.col("email").alias("Account_Manager_Email")
    )
    return alias_dim.join(employees, "account_manager_id", "left").select(
        "salesforce_alias", F.col("account_manager_name").alias("Account_Manager_Name"), "Account_Manager_Email"
    )


def with_manager(anomalies: DataFrame, alias_dim: DataFrame, employee_dim: DataFrame) -> DataFrame:
    """Adds manager name and email; merchants without a manager keep their rows.

    The anomalies are the small side here, and their size is only known at run
    time, so the join strategy is left to the adaptive planner.
    """
    managers = manager_lookup(alias_dim, employee_dim).withColumnRenamed("salesforce_alias", "alias_name")
    return anomalies.join(managers, "alias_name", "left").select(
        *anomalies.columns, "Account_Manager_Name", "Account_Manager_Email"
    )
