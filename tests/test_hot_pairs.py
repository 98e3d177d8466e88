"""One id pair with a third of the rows, and rows without ids, in the joins of large lookups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ratewatch.operators import resolve

PARTITIONS = 16


@pytest.fixture
def plain(spark):
    """Without adaptive execution, which could split what is skewed, and without broadcasts by size."""
    conf = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(PARTITIONS),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def facts(spark, rows=30_000):
    n = F.col("id")
    entity = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), (n % 1000).cast("string")))
    return spark.range(rows).select(
        F.when(n % 50 != 1, entity).alias("entity_id"),
        F.when(n % 3 != 0, (n % 997).cast("string")).alias("merchant_account_id"),
        n.alias("channel_id"),
        (n % 7).alias("accepted_payments"),
    )


def pairs_of(frame):
    alias = F.concat(F.lit("alias "), F.coalesce("entity_id", F.lit("?")))
    return resolve.pair_counts(frame).withColumn("alias_name", alias)


def heavy_of(frame, most):
    return resolve.heavy_pairs(resolve.pair_counts(frame), most)


def per_task(frame):
    counted = frame.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    return [r["n"] for r in counted.collect()]


def test_a_hot_pair_is_dealt_to_all_tasks(plain):
    rows = facts(plain)
    pairs, heavy = pairs_of(rows), heavy_of(rows, 5)
    assert heavy.collect()[0]["entity_id"] == "hot" and heavy.count() == 5
    joined = resolve.join_resolved_pairs(rows, pairs, heavy)
    dealt, mean = per_task(joined), rows.count() / PARTITIONS
    assert len(dealt) == PARTITIONS and max(dealt) <= 2 * mean
    assert max(per_task(resolve.join_resolved_pairs(rows, pairs))) > 4 * mean
    assert joined.columns == [*rows.columns, "alias_name"]
    key = lambda frame: sorted(map(repr, frame.collect()))
    assert key(joined) == key(resolve.join_resolved_pairs(rows, pairs))


def test_duplicate_pairs_multiply_alike(plain):
    rows = facts(plain, 600)
    twice = pairs_of(rows).withColumn("alias_name", F.explode(F.array(F.lit("a"), F.lit("b"))))
    joined = resolve.join_resolved_pairs(rows, twice, heavy_of(rows, 3))
    assert joined.count() == 1200
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, resolve.join_resolved_pairs(rows, twice).collect()))


def test_rows_without_a_key_are_dealt_to_all_tasks(plain):
    rows = plain.range(20_000).select(F.when(F.col("id") < 0, "x").alias("entity_id"), F.col("id").alias("channel_id"))
    lookup = plain.createDataFrame([("a", 1), (None, 2), ("\0" + "7", 3)], "entity_id string, account int")
    joined = resolve.left_join(rows, lookup, "entity_id", spread=True)
    dealt = per_task(joined)
    assert sum(dealt) == 20_000 and max(dealt) <= 2 * 20_000 / PARTITIONS
    assert joined.where("account IS NOT NULL").count() == 0


@pytest.mark.parametrize("spread", [False, True])
def test_any_id_is_found_both_ways(plain, spread):
    """Ids that start with a NUL character too, and numbers are compared as numbers where both sides store them."""
    texts = plain.createDataFrame([("\0" + "7",), ("a",), (None,), ("",)], "entity_id string")
    lookup = plain.createDataFrame([("\0" + "7", 1), ("", 2), (None, 3)], "entity_id string, account int")
    found = {r["entity_id"]: r["account"] for r in resolve.left_join(texts, lookup, "entity_id", spread).collect()}
    assert found == {"\0" + "7": 1, "a": None, None: None, "": 2}
    numbers = plain.createDataFrame([(1.0,), (-0.0,)], "entity_id double")
    known = plain.createDataFrame([(1.0, 1), (0.0, 2)], "entity_id double, account int")
    assert {r["account"] for r in resolve.left_join(numbers, known, "entity_id", spread).collect()} == {1, 2}
    mixed = plain.createDataFrame([("1",)], "entity_id string")
    ints = plain.createDataFrame([(1, 5)], "entity_id long, account int")
    assert resolve.left_join(mixed, ints, "entity_id", spread).first()["account"] == 5
