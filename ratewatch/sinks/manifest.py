"""What is current: a list of small entries that is only ever added to.

Outputs are written to a folder that no reader looks at yet, and one entry makes
them current, all at once. An entry is a folder of its own with one file, which
the file system shows only when it is whole; a writer that dies before leaves the
last entry in force. Of several entries for a key the last one counts: the highest
sequence, then the later run name, so that writers who met take turns alike for all.
Nothing is deleted here, so a reader keeps what it started on.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "sequence bigint, run string, key string, facts map<string, string>"


@dataclass(frozen=True)
class Entry:
    key: str
    run: str
    facts: dict[str, str]


def new_run() -> str:
    """A name for one run; later runs sort behind earlier ones."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _entries(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(_ENTRY).json(f"{folder}/entry=*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def add(spark: SparkSession, folder: str, run: str, facts: dict[str, dict[str, str]]) -> None:
    """Make ``facts``, by key, current: one small file, whole or not there."""
    known = _entries(spark, folder)
    last = known.agg(F.max("sequence")).first()[0] if known is not None else None
    rows = [((last or 0) + 1, run, key, own) for key, own in facts.items()]
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.json(f"{folder}/entry={run}")


def latest(spark: SparkSession, folder: str, keys: Sequence[str] | None = None) -> list[Entry]:
    """The current entry of each key, in order of the keys. There is one key per day."""
    known = _entries(spark, folder)
    if known is None:
        return []
    if keys is not None:
        known = known.where(F.col("key").isin(list(keys)))
    current = known.groupBy("key").agg(F.max_by(F.struct("run", "facts"), F.struct("sequence", "run")).alias("of"))
    rows = current.select("key", "of.run", "of.facts").collect()
    return sorted((Entry(r["key"], r["run"], dict(r["facts"])) for r in rows), key=lambda e: e.key)


def superseded(spark: SparkSession, folder: str) -> list[Entry]:
    """Entries that a later one has replaced."""
    known = _entries(spark, folder)
    if known is None:
        return []
    now = {(e.key, e.run) for e in latest(spark, folder)}
    rows = known.select("key", "run", "facts").collect()
    return sorted((Entry(r["key"], r["run"], dict(r["facts"])) for r in rows if (r["key"], r["run"]) not in now), key=lambda e: (e.key, e.run))
