"""The daily job: detect once, write the table, then feed the reports from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame

from ratewatch.clock import Clock
from ratewatch.operators.counts import counts_by_metric
from ratewatch.operators.daily import LOOKBACK_DAYS
from ratewatch.operators.digest import (
    MESSAGE_LIMIT,
    TOP_CHANNELS,
    TOP_MERCHANTS,
    DigestStyle,
    digest_document,
    digest_messages,
    split_messages,
)
from ratewatch.operators.links import DEFAULT_BASE_URL, LinkStyle
from ratewatch.operators.resolve import BROADCAST_BYTES, BROADCAST_ROWS
from ratewatch.plans.detect import daily, detect_in
from ratewatch.sinks.files import publish, read_table, run_folder, write_csv, write_digest, write_table
from ratewatch.sinks.manifest import new_run
from ratewatch.sources.tables import Tables
from ratewatch.specs import ACCEPTANCE, DEFAULT_SPECS, MetricSpec


@dataclass(frozen=True)
class RunResult:
    table_path: str
    csv_path: str
    digest_path: str | None
    counts: DataFrame


def run(
    tables: Tables,
    out_dir: str,
    as_of: Clock | datetime | date | str | None = None,
    specs: Sequence[MetricSpec] = DEFAULT_SPECS,
    lookback_days: int = LOOKBACK_DAYS,
    base_url: str = DEFAULT_BASE_URL,
    style: DigestStyle | None = None,
    day_column: str | None = None,
    upto: datetime | None = None,
    min_std: float | None = None,
    top: int = TOP_MERCHANTS,
    channels: int = TOP_CHANNELS,
    metric: str = ACCEPTANCE.label,
    link_style: LinkStyle | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    message_limit: int = MESSAGE_LIMIT,
) -> RunResult:
    """Run one day and write the result table, the CSV and, if anything dropped, the digest.

    All of it goes to a folder of this run, and becomes the day's result in one
    step when the last file is written. Until then, and if the run fails anywhere
    before, readers of ``out_dir`` see the day's earlier run as a whole. The
    files of a replaced run stay until ``clear_superseded``.

    The daily roll-up is staged in that folder as well: it is far smaller than
    the facts, and once it is written no failure later in the run reads the
    facts again. The reports read the written result, not the plan. The end of
    the run empties the staged roll-up.

    ``upto`` bounds the facts, so that a past day run again gives what it gave
    then. ``top``, ``channels`` and ``metric`` shape the digest, whose messages
    are split at ``message_limit`` characters; ``max_rows`` and ``max_bytes``
    bound the lookups that may be broadcast.
    """
    clock = Clock.at(as_of)
    spark = tables.payments.sparkSession
    run_name = new_run()
    folder = run_folder(out_dir, clock, run_name)
    plan = daily(tables, clock, lookback_days, upto, day_column, max_rows, max_bytes)
    staged = f"{folder}/staged_daily"
    plan.write.parquet(staged)
    rolled = spark.read.schema(plan.schema).parquet(staged)
    write_table(detect_in(rolled, tables, clock, specs, base_url, min_std, link_style), folder, clock)
    anomalies = read_table(spark, folder, clock)
    critical = next((spec.critical for spec in specs if spec.label == metric), ACCEPTANCE.critical)
    messages = digest_messages(anomalies, clock, top, channels, style, metric, lookback_days, critical)
    write_csv(anomalies, folder, clock)
    parts = split_messages(messages, message_limit)
    digest_path = write_digest(digest_document(parts, clock, style), folder, clock)
    day = publish(spark, out_dir, clock, run_name, digest_path)
    # Nothing reads the roll-up any more.
    plan.limit(0).write.mode("overwrite").parquet(staged)
    return RunResult(
        table_path=day.table_path,
        csv_path=day.csv_path,
        digest_path=day.digest_path,
        counts=counts_by_metric(anomalies, specs),
    )
