"""Resolve payment facts to merchant aliases.

Four left joins by definition: fact to map by entity, fact to map by merchant
account (the fallback), account to alias, alias to the alias master. The last
two touch lookups only, so they are joined to each other first and the facts
meet three lookups instead of four; a left join whose condition rejects NULLs
is associative, so the rows are the same, duplicate keys included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only when a count proves it lies within both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# The fact ids that decide a row's resolution.
ID_KEYS = ("entity_id", "merchant_account_id")


# Parts that rows without a key are dealt to in a shuffle join.
NULL_PARTS = 4096
# Id pairs that are salted in the join of facts and pairs, and copies of each per shuffle partition.
HEAVY_PAIRS = 100
SALTS_PER_PARTITION = 4


def left_join(facts: DataFrame, lookup: DataFrame, key: str, spread: bool = False) -> DataFrame:
    """A left join on ``key``, as text where the two sides store it in different types.

    A NULL key finds nothing, but in a shuffle all rows without a key would
    still go to one task. With ``spread`` the join has a second key, which is
    zero but for these rows: one of ``NULL_PARTS`` by a hash of the row.
    """
    same_type = facts.schema[key].dataType == lookup.schema[key].dataType
    value = F.col(key) if same_type else F.col(key).cast("string")
    known = lookup.withColumn("_key", value).drop(key)
    if not spread:
        return facts.withColumn("_key", value).join(known, "_key", "left").drop("_key")
    # Always zero, but no constant, which the planner would take out of the join's keys.
    zero = F.pmod(F.xxhash64("_key"), F.lit(1))
    others = F.xxhash64(F.lit(0), *[F.col(name) for name in facts.columns if name != key])
    part = F.when(F.col("_key").isNull(), F.pmod(others, F.lit(NULL_PARTS))).otherwise(zero)
    dealt = facts.withColumn("_key", value).withColumn("_part", part)
    return dealt.join(known.withColumn("_part", zero), ["_key", "_part"], "left").drop("_key", "_part")


def join_entity(facts: DataFrame, account_map: DataFrame, spread: bool = False) -> DataFrame:
    """Adds ``entity_account_id``: the account mapped to the fact's entity, or NULL."""
    return left_join(facts, _by_entity(account_map), "entity_id", spread)


def join_merchant_account(facts: DataFrame, account_map: DataFrame, spread: bool = False) -> DataFrame:
    """Adds ``merchant_account_ref``: the account mapped to the merchant account, or NULL."""
    return left_join(facts, _by_merchant_account(account_map), "merchant_account_id", spread)


def join_account(facts: DataFrame, accounts: DataFrame, spread: bool = False) -> DataFrame:
    """Joins account attributes on the entity's account, else the merchant account's."""
    resolved = facts.withColumn("account_id", F.coalesce("entity_account_id", "merchant_account_ref"))
    return left_join(resolved, accounts, "account_id", spread)


def accounts_with_alias(account_dim: DataFrame, alias_dim: DataFrame) -> DataFrame:
    """(account_id, alias_name); the alias is NULL unless the alias master lists it."""
    listed = alias_dim.select(F.col("salesforce_alias").alias("alias_name"))
    claimed = account_dim.select("account_id", "salesforce_alias")
    matched = claimed.join(listed, F.col("salesforce_alias") == F.col("alias_name"), "left")
    return matched.select("account_id", "alias_name")


def _by_entity(account_map: DataFrame) -> DataFrame:
    known = account_map.where(F.col("entity_id").isNotNull())
    return known.select("entity_id", F.col("account_id").alias("entity_account_id"))


def _by_merchant_account(account_map: DataFrame) -> DataFrame:
    known = account_map.where(F.col("merchant_account_id").isNotNull())
    return known.select(
        F.col("merchant_account_id").cast("string").alias("merchant_account_id"),
        F.col("account_id").alias("merchant_account_ref"),
    )


@dataclass(frozen=True)
class Lookups:
    """The resolution lookups, and whether they are proven small enough to broadcast.

    A broadcast passes the driver, once for every run of a plan. ``shuffled`` are
    the same lookups for plans that run many times: none of them passes the driver.
    """

    account_map: DataFrame
    accounts: DataFrame
    small: bool
    shuffled: Lookups | None = None

    @classmethod
    def prepare(
        cls,
        account_map: DataFrame,
        account_dim: DataFrame,
        alias_dim: DataFrame,
        max_rows: int = BROADCAST_ROWS,
        max_bytes: int = BROADCAST_BYTES,
    ) -> Lookups:
        """Count the lookups' rows and bytes in one aggregation, and hint a broadcast if both fit."""
        keys = account_map.select("entity_id", "merchant_account_id", "account_id")
        accounts = accounts_with_alias(account_dim, alias_dim)
        small = all_within([keys, accounts], max_rows, max_bytes)
        merged = accounts_with_alias(account_dim, alias_dim.hint("merge")).hint("merge")
        shuffled = cls(keys.hint("merge"), merged, False)
        if small:
            keys, accounts = F.broadcast(keys), F.broadcast(accounts)
        return cls(keys, accounts, small, shuffled)

    def resolve(self, facts: DataFrame) -> DataFrame:
        """Adds ``alias_name``; NULL when the merchant cannot be resolved."""
        spread = not self.small
        mapped = join_entity(facts, self.account_map, spread)
        mapped = join_merchant_account(mapped, self.account_map, spread)
        dropped = ("account_id", "entity_account_id", "merchant_account_ref")
        return join_account(mapped, self.accounts, spread).drop(*dropped)


def all_within(frames: list[DataFrame], max_rows: int, max_bytes: int) -> bool:
    """Whether every frame has at most ``max_rows`` rows and ``max_bytes`` of text."""
    measured = None
    for frame in frames:
        widths = " + ".join(f"coalesce(octet_length(cast({name} AS string)), 0)" for name in frame.columns)
        size = frame.agg(F.expr("count(1) AS rows"), F.expr(f"coalesce(sum({widths}), 0) AS bytes"))
        measured = size if measured is None else measured.union(size)
    return all(row["rows"] <= max_rows and row["bytes"] <= max_bytes for row in measured.collect())


def pair_counts(facts: DataFrame) -> DataFrame:
    """The distinct id pairs, with their number of rows."""
    return facts.groupBy(*ID_KEYS).agg(F.count(F.lit(1)).alias("pair_rows"))


def heavy_pairs(counted: DataFrame, most: int = HEAVY_PAIRS) -> DataFrame:
    """The ``most`` id pairs with the most rows: a distributed top-k, and so a bounded frame."""
    return counted.orderBy(F.desc("pair_rows"), *ID_KEYS).limit(most)


def _same_pair(other: str) -> list[Column]:
    return [F.col(key).eqNullSafe(F.col(f"{other}_{key}")) for key in ID_KEYS]


def _renamed(pairs: DataFrame, prefix: str) -> list[Column]:
    return [F.col(key).alias(f"{prefix}_{key}") for key in ID_KEYS]


def join_resolved_pairs(facts: DataFrame, pairs: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Adds ``alias_name`` from resolved id pairs; an absent id matches an absent id.

    Rows of ``heavy`` pairs, which have many days and channels, are dealt to
    salted copies of their pair, so that none waits for one task. All others
    have one copy. ``heavy`` is bounded and broadcast; ``pairs`` then are
    resolved ``pair_counts``, so that both need the same counts, made once.
    """
    known = pairs.select(*_renamed(pairs, "pair"), "alias_name", *(["pair_rows"] if heavy is not None else []))
    if heavy is None:
        return facts.join(known, _same_pair("pair"), "inner").drop(*[f"pair_{key}" for key in ID_KEYS])
    salts = SALTS_PER_PARTITION * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = F.broadcast(heavy.select(*_renamed(heavy, "heavy"), F.col("pair_rows").alias("heavy_rows")))
    keys = [*(f"heavy_{key}" for key in ID_KEYS), "heavy_rows"]
    row = F.xxhash64(F.lit(0), *[c for c in facts.columns if c not in ID_KEYS])
    marked = facts.join(listed, _same_pair("heavy"), "left")
    dealt = marked.withColumn("salt", F.when(F.col("heavy_rows").isNotNull(), F.pmod(row, F.lit(salts))).otherwise(0).cast("int"))
    of_pair = [F.col(f"pair_{key}").eqNullSafe(F.col(f"heavy_{key}")) for key in ID_KEYS]
    of_pair.append(F.col("pair_rows") == F.col("heavy_rows"))
    copies = F.when(F.col("heavy_rows").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = known.join(listed, of_pair, "left").withColumn("pair_salt", F.explode(copies)).drop(*keys, "pair_rows")
    joined = dealt.drop(*keys).join(copied, [*_same_pair("pair"), F.col("salt") == F.col("pair_salt")], "inner")
    return joined.drop(*[f"pair_{key}" for key in ID_KEYS], "salt", "pair_salt")


def resolve_alias(
    payments: DataFrame, account_map: DataFrame, account_dim: DataFrame, alias_dim: DataFrame
) -> DataFrame:
    """Facts with ``alias_name`` added."""
    return Lookups.prepare(account_map, account_dim, alias_dim).resolve(payments)
