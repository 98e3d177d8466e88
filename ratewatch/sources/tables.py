"""The five inputs, read from a catalog or from files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ratewatch.sources import schemas


@dataclass(frozen=True)
class Tables:
    payments: DataFrame
    account_map: DataFrame
    account_dim: DataFrame
    alias_dim: DataFrame
    employee_dim: DataFrame

    def __post_init__(self) -> None:
        schemas.require_columns(self.payments, schemas.PAYMENTS, "payments")
        schemas.require_columns(self.account_map, schemas.ACCOUNT_MAP, "account_map")
        schemas.require_columns(self.account_dim, schemas.ACCOUNT_DIM, "account_dim")
        schemas.require_columns(self.alias_dim, schemas.ALIAS_DIM, "alias_dim")
        schemas.require_columns(self.employee_dim, schemas.EMPLOYEE_DIM, "employee_dim")

    def assert_unique_lookups(self) -> None:
        """Optional check: duplicates in a lookup multiply every sum that meets them."""
        schemas.assert_unique(self.account_map, ["entity_id"], "account_map")
        schemas.assert_unique(self.account_map, ["merchant_account_id"], "account_map")
        schemas.assert_unique(self.account_dim, ["account_id"], "account_dim")
        schemas.assert_unique(self.alias_dim, ["salesforce_alias"], "alias_dim")
        schemas.assert_unique(self.employee_dim, ["user_id"], "employee_dim")


# Default names of the five inputs, as table names or as file names.
NAMES = ("payments_daily", "account_map", "account_dim", "alias_dim", "employee_dim")


def from_catalog(spark: SparkSession, database: str, names: tuple[str, ...] = NAMES) -> Tables:
    return Tables(*[spark.table(f"{database}.{name}") for name in names])


def from_files(
    spark: SparkSession, directory: str, file_format: str = "parquet", names: tuple[str, ...] = NAMES
) -> Tables:
    """Read ``directory/<name>`` for each input, in a self-describing format."""
    return Tables(*[spark.read.format(file_format).load(f"{directory}/{name}") for name in names])
