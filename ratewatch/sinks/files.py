"""Dated outputs.

Each writer here replaces one day's folder. ``publish`` puts a day's table, CSV and
digest in a folder of their own and makes them current together, so that readers
see one whole run of a day, whatever becomes of the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ratewatch.clock import Clock
from ratewatch.functions.text import plain_decimal
from ratewatch.operators.classify import in_report_order
from ratewatch.sinks import manifest
from ratewatch.sources.schemas import ANOMALIES, COLUMN_ORDER

# Fixed value: the export is named after its day.
CSV_NAME = "AnomalyFile_{today}.csv"
DIGEST_NAME = "digest_{today}.json"

# Texts keep the spaces at their ends.
_CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def table_path(out_dir: str, clock: Clock) -> str:
    return f"{out_dir}/anomalies/Date_of_Detection={clock.today.isoformat()}"


def write_table(anomalies: DataFrame, out_dir: str, clock: Clock) -> str:
    """Replace the day's partition of the parquet table, also by an empty result."""
    path = table_path(out_dir, clock)
    anomalies.drop("Date_of_Detection").write.mode("overwrite").parquet(path)
    return path


@dataclass(frozen=True)
class Day:
    """The current outputs of a day; ``digest_path`` is None on a day without a digest."""

    today: str
    run: str
    table_path: str
    csv_path: str
    digest_path: str | None


def manifest_folder(out_dir: str) -> str:
    return f"{out_dir}/_manifest"


def run_folder(out_dir: str, clock: Clock, run: str) -> str:
    return f"{out_dir}/runs/{clock.today.isoformat()}/{run}"


def publish(spark: SparkSession, out_dir: str, clock: Clock, run: str, digest_path: str | None) -> Day:
    """Make what ``run`` has written in its folder the day's table, CSV and digest, in one step."""
    folder = run_folder(out_dir, clock, run)
    day = Day(clock.today.isoformat(), run, table_path(folder, clock), csv_path(folder, clock), digest_path)
    # Paths below the output folder, so that it can be moved.
    written = {"table": day.table_path, "csv": day.csv_path, "digest": digest_path}
    facts = {name: path[len(out_dir) + 1 :] for name, path in written.items() if path is not None}
    manifest.add(spark, manifest_folder(out_dir), run, {day.today: facts})
    return day


def published(spark: SparkSession, out_dir: str, clock: Clock | None = None) -> list[Day]:
    """The current outputs of the given day, or of all days, in order."""
    keys = None if clock is None else [clock.today.isoformat()]
    return [_day(out_dir, entry) for entry in manifest.latest(spark, manifest_folder(out_dir), keys)]


def _day(out_dir: str, entry: manifest.Entry) -> Day:
    path = {name: f"{out_dir}/{below}" for name, below in entry.facts.items()}
    return Day(entry.key, entry.run, path["table"], path["csv"], path.get("digest"))


def clear_superseded(spark: SparkSession, out_dir: str) -> list[str]:
    """Empty the outputs of runs that later runs of their day have replaced, and name their folders.

    For a time when no reader is left on them. Files go, folders stay.
    """
    folders = []
    for entry in manifest.superseded(spark, manifest_folder(out_dir)):
        day = _day(out_dir, entry)
        none = spark.createDataFrame([], ANOMALIES)
        none.write.mode("overwrite").parquet(day.table_path)
        none.write.mode("overwrite").csv(day.csv_path)
        if day.digest_path is not None:
            none.write.mode("overwrite").json(day.digest_path)
        folders.append(day.table_path.rsplit("/", 2)[0])
    return folders


def read_table(spark: SparkSession, out_dir: str, clock: Clock | None = None) -> DataFrame:
    """The result table: one day, or all days. Published days are read as published."""
    paths = [day.table_path for day in published(spark, out_dir, clock)]
    if paths:
        tables = [spark.read.schema(ANOMALIES).option("basePath", path.rsplit("/", 1)[0]).parquet(path) for path in paths]
        return reduce(DataFrame.unionByName, [table.select(*COLUMN_ORDER) for table in tables])
    table = spark.read.schema(ANOMALIES).option("basePath", f"{out_dir}/anomalies")
    stored = table.parquet(f"{out_dir}/anomalies" if clock is None else table_path(out_dir, clock))
    return stored.select(*COLUMN_ORDER)


def csv_text(anomalies: DataFrame) -> DataFrame:
    """The columns as spreadsheet users expect them: True/False, no exponents in money and counts."""
    texts = {"is_mit": "initcap(cast(is_mit AS string))"}
    for column in ("Total_Volume_Amount_Lost", "Lost_Volume", "channel_vol_share_pct"):
        texts[column] = plain_decimal(column)
    return anomalies.selectExpr(*[f"{texts.get(column, column)} AS {column}" for column in COLUMN_ORDER])


def csv_path(out_dir: str, clock: Clock) -> str:
    return f"{out_dir}/{CSV_NAME.format(today=clock.today.isoformat())}"


def write_csv(anomalies: DataFrame, out_dir: str, clock: Clock) -> str:
    """Replace the day's CSV, with a header also when it is empty.

    The global sort leaves a small result in a single part file; a large one
    keeps several, in order, instead of passing through one task.
    """
    path = csv_path(out_dir, clock)
    csv_text(in_report_order(anomalies)).write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANOMALIES).options(**_CSV_OPTIONS).option("multiLine", True).csv(path)


def write_digest(document: DataFrame, out_dir: str, clock: Clock) -> str | None:
    """Replace the day's digest; without a document the day has none, and the result is None.

    The plan runs once: what it wrote tells whether there was a document.
    """
    path = f"{out_dir}/{DIGEST_NAME.format(today=clock.today.isoformat())}"
    document.write.mode("overwrite").json(path)
    if document.sparkSession.read.schema(document.schema).json(path).isEmpty():
        remove(document.sparkSession, path)
        return None
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system the path names; over Spark Connect, which can't, it stays as it is."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
