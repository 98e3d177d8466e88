"""Settings of sizes, remembered values, gathered runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from ratewatch.llm import common


@pytest.mark.parametrize(
    ("text", "size"),
    [("4194304b", 4 << 20), ("4194304", 4 << 20), ("512k", 512 << 10), ("1m", 1 << 20), ("1MB", 1 << 20), (" 2 g ", 2 << 30), ("-1", -1), ("", -1)],
)
def test_byte_sizes(text, size):
    assert common.byte_size(text) == size


@pytest.mark.parametrize(("before", "after"), [("64m", "4194304b"), ("1m", "1m"), ("512k", "512k")])
def test_a_lower_limit_of_batches_stays(spark, before, after):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    kept = spark.conf.get(name)
    spark.conf.set(name, before)
    common.small_batches(spark.range(1))
    assert spark.conf.get(name) == after
    spark.conf.set(name, kept)


def test_remembered_values(monkeypatch):
    monkeypatch.setattr(common, "REMEMBERED", 4)
    asked = []

    def values(keys):
        asked.extend(keys)
        return [k.upper().encode() for k in keys]

    recent = common.Recent(values)
    for keys in (["a", "b"], ["b", "c"], ["d", "e", "a"], ["x" * 60, "e"], []):
        assert recent(pa.array(keys, pa.string())) == [k.upper().encode() for k in keys]
        assert len(recent.now) <= 4 + len(keys)
    assert asked.count("b") == 1 and "x" * 60 not in recent.now
    # Values may be empty, and are still known.
    empty = common.Recent(lambda keys: [b"" for _ in keys])
    assert empty(pa.array(["", "q"], pa.string())) == [b"", b""] == empty(pa.array(["q", ""], pa.string()))


def test_gathered_runs():
    values = np.arange(10) * 10
    assert common.gathered(values, np.array([3, 0, 9]), np.array([2, 0, 1])).tolist() == [30, 40, 90]
    assert common.gathered(values, np.empty(0, int), np.empty(0, int)).tolist() == []


def test_mapped_rows_come_back_and_memory_is_given_back(spark):
    def twice(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("id").to_numpy() * 2)], ["id"])

    rows = common.mapped(spark.range(0, 1000, 1, 3), twice, "id bigint").collect()
    assert sorted(r["id"] for r in rows) == list(range(0, 2000, 2))
    common.give_back()


def test_a_stored_table_is_read_again(spark):
    frame = spark.range(5).selectExpr("id", "'y' AS _x")
    kept = common.stored(frame, "test")
    assert kept.columns == ["id", "_x"] and sorted(kept.collect()) == sorted(frame.collect())
    assert len(kept.inputFiles()) >= 1
