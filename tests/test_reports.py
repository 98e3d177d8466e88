"""Digest, counts, sinks and the daily job."""

from __future__ import annotations

import csv
import glob
import json
import random
from datetime import datetime

import pytest
import shop

from ratewatch import DEFAULT_SPECS, Clock, detect, run
from ratewatch.operators import digest
from ratewatch.operators.counts import counts_by_metric
from ratewatch.sinks import files
from ratewatch.sources import schemas

CLOCK = Clock.at(shop.AS_OF)


def anomaly(alias, channel, amount, units=10.0, mit=False, metric="AR Anomaly", link="https://d/x"):
    formula = None if link is None else f'=HYPERLINK("{link}","label")'
    return (
        metric, "P1: Critical - Global Merchant Outage", alias, channel, mit, -3.0, -3.0, 40.0,
        amount, units, 5.0, "2024-01-31", formula, "Manager", "m@example.com",
    )


@pytest.fixture(scope="module")
def anomalies(spark):
    rows = [anomaly("Big", f"pc_{i}", 10_000.5 + i, 1000.0 + i) for i in range(7)]
    rows += [anomaly("Even A", "pc", 2000.0), anomaly("Even B", "pc", 2000.0)]
    rows += [anomaly("Both", "pc", 1500.0, mit=True), anomaly("Both", "pc", 1500.0, mit=False)]
    rows += [anomaly("Small", None, 1200.0, link=None), anomaly("Sixth", "pc", 1100.0)]
    rows += [anomaly("Fraudster", "pc", None, 9.0, metric="Fraud Anomaly")]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, schemas.ANOMALIES)


def test_top_merchants_rank_by_amount_then_alias(anomalies):
    rows = digest.top_merchants(anomalies).orderBy("rank").collect()
    assert [(r["rank"], r.alias_name) for r in rows] == [
        (1, "Big"), (2, "Both"), (3, "Even A"), (4, "Even B"), (5, "Small"),
    ]
    assert (rows[0].lost_amount, rows[0].lost_payments, rows[0].channels) == (70024.5, 7021.0, 7)
    assert {r.merchants for r in rows} == {5}


def test_top_channels_are_cut_per_merchant(anomalies):
    ranked = digest.top_channels(anomalies, digest.top_merchants(anomalies))
    rows = ranked.orderBy("alias_name", "channel_rank").collect()
    big = [r.channel_id for r in rows if r.alias_name == "Big"]
    assert big == ["pc_6", "pc_5", "pc_4", "pc_3", "pc_2"]
    assert [r.is_mit for r in rows if r.alias_name == "Both"] == [False, True]
    assert {r.alias_name for r in rows}.isdisjoint({"Sixth", "Fraudster"})


def test_messages(anomalies):
    rows = digest.digest_messages(anomalies, CLOCK).orderBy("position").collect()
    assert [r.position for r in rows] == [0, 1, 2, 3, 4, 5]
    assert all(r.fits and r.length == len(r.message) for r in rows)
    header, first, *_, last = [r.message for r in rows]
    assert header.split("\n")[1] == (
        "📅 **31 Jan 2024**  |  Critical value: ±2.576  |  Baseline: 30-day average"
    )
    assert header.split("\n")[3].startswith("Flagged **5 merchants** with the highest")
    status = "P1: Critical - Global Merchant Outage"
    assert first.split("\n") == [
        "━" * 40,
        "",
        "**1️⃣  Big**",
        "> 📅 Date of Detection: **31 Jan 2024**",
        "> 🔍 Anomaly Type: **AR Anomaly**",
        "> 💳 Lost Payments: **7,021**",
        "> 💰 Lost Volume Amount: **$70,024**",
        "",
        "**Channel Breakdown:**",
        *[
            f"• `pc_{i}` | {status} | MIT: No | 1,00{i} payments | **${round(10_000.5 + i):,}**"
            " | <https://d/x|🔍 Dashboard>"
            for i in (6, 5, 4, 3, 2)
        ],
        "_...2 more channel(s) — see CSV for full breakdown_",
    ]
    assert last.split("\n")[9:] == [
        f"• `` | {status} | MIT: No | 10 payments | **$1,200**",
        "",
        "━" * 40,
        "_Powered by ratewatch_",
    ]


def test_no_breaches_no_digest(spark, anomalies, tmp_path):
    none = anomalies.where("Anomaly_Type = 'Fraud Anomaly'")
    document = digest.digest_document(digest.digest_messages(none, CLOCK), CLOCK)
    assert document.count() == 0
    assert files.write_digest(document, str(tmp_path), CLOCK) is None
    assert not list(tmp_path.iterdir())


def test_digest_document_as_json(anomalies, tmp_path):
    document = digest.digest_document(digest.digest_messages(anomalies, CLOCK), CLOCK)
    path = files.write_digest(document, str(tmp_path), CLOCK)
    parts = glob.glob(f"{path}/part-*.json")
    lines = [line for part in parts for line in open(part, encoding="utf-8")]
    assert len(lines) == 1
    parsed = json.loads(lines[0])
    assert list(parsed) == ["channel_id", "messages", "today"]
    assert (parsed["channel_id"], parsed["today"], len(parsed["messages"])) == ("rate-alerts", "2024-01-31", 6)


def test_counts_include_absent_metrics(anomalies):
    counted = {r.Anomaly_Type: r.anomalies for r in counts_by_metric(anomalies, DEFAULT_SPECS).collect()}
    assert counted == {"Total": 14, "AR Anomaly": 13, "Fraud Anomaly": 1, "Dispute Anomaly": 0}


def _csv_rows(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as handle:
            rows += list(csv.DictReader(handle))
    return rows


def test_csv_reads_back_and_suits_spreadsheets(spark, tmp_path):
    rows = [anomaly('Shop "A", Inc.', "pc", 15_000_000.0, 12_345_678.0, mit=True), anomaly("B", None, 1200.25)]
    frame = spark.createDataFrame(rows, schemas.ANOMALIES)
    path = files.write_csv(frame, str(tmp_path), CLOCK)
    assert path.endswith("/AnomalyFile_2024-01-31.csv")
    assert sorted(files.read_csv(spark, path).collect()) == sorted(frame.collect())
    texts = {r["alias_name"]: r for r in _csv_rows(path)}
    tricky = texts['Shop "A", Inc.']
    assert tuple(tricky) == schemas.COLUMN_ORDER
    assert (tricky["is_mit"], texts["B"]["is_mit"], texts["B"]["channel_id"]) == ("True", "False", "")
    assert (tricky["Total_Volume_Amount_Lost"], tricky["Lost_Volume"]) == ("15000000.0", "12345678.0")


def test_a_small_csv_is_one_file_in_report_order(spark, anomalies, tmp_path):
    path = files.write_csv(anomalies, str(tmp_path), CLOCK)
    assert len(glob.glob(f"{path}/part-*.csv")) == 1
    amounts = [float(r["Total_Volume_Amount_Lost"] or 0) for r in _csv_rows(path) if r["is_mit"] == "False"]
    assert amounts[:12] == sorted(amounts[:12], reverse=True)


def test_run_writes_everything_and_a_rerun_replaces_it(spark, tmp_path):
    out = str(tmp_path)
    result = run(shop.tables(spark), out, shop.AS_OF)
    expected = sorted(detect(shop.tables(spark), shop.AS_OF).collect())
    assert len(expected) > 10
    assert _same(files.read_table(spark, out, CLOCK).collect(), expected)
    assert _same(files.read_csv(spark, result.csv_path).collect(), expected)
    counted = {r.Anomaly_Type: r.anomalies for r in result.counts.collect()}
    assert counted["Total"] == len(expected)
    assert result.digest_path is not None

    # Another day leaves the first in place.
    run(shop.tables(spark), out, "2024-02-01")
    assert files.read_table(spark, out).where("Date_of_Detection = '2024-01-31'").count() == len(expected)

    # The first day again, with nothing to report: no stale rows, a CSV with only its header.
    quiet = run(shop.tables(spark, shop.series("Flat", [900] * 6)), out, shop.AS_OF)
    assert files.read_table(spark, out, CLOCK).count() == 0
    assert _csv_rows(quiet.csv_path) == []
    header = open(glob.glob(f"{quiet.csv_path}/part-*.csv")[0], encoding="utf-8").read().strip()
    assert header == ",".join(schemas.COLUMN_ORDER)
    assert quiet.digest_path is None
    (day,) = files.published(spark, out, CLOCK)
    assert (day.table_path, day.csv_path, day.digest_path) == (quiet.table_path, quiet.csv_path, None)
    assert spark.read.parquet(*glob.glob(f"{out}/runs/*/*/staged_daily")).count() == 0
    assert {r.anomalies for r in quiet.counts.collect()} == {0}


def _same(rows, expected):
    def text(row):
        return tuple(round(v, 9) if isinstance(v, float) else v for v in row)

    return sorted(map(text, rows), key=repr) == sorted(map(text, expected), key=repr)


def test_csv_keeps_spaces_quotes_and_line_breaks(spark, tmp_path):
    names = [" Shop ", "pc ", '"quoted"', "a,b", "two\nlines", "tab\t", "  "]
    rows = [anomaly(name, f" {name}", 1000.0 + i) for i, name in enumerate(names)]
    frame = spark.createDataFrame(rows, schemas.ANOMALIES)
    path = files.write_csv(frame, str(tmp_path), CLOCK)
    assert sorted(files.read_csv(spark, path).collect()) == sorted(frame.collect())
    assert sorted(r["alias_name"] for r in _csv_rows(path)) == sorted(names)


def test_run_takes_what_detect_takes(spark, tmp_path):
    tables = shop.tables(spark)
    upto = datetime(2024, 1, 31)
    result = run(
        tables, str(tmp_path), "2024-01-31", upto=upto, min_std=1e-9, top=2, channels=1, max_rows=0, max_bytes=0
    )
    expected = sorted(detect(tables, "2024-01-31", upto=upto, min_std=1e-9).collect())
    assert _same(files.read_table(spark, str(tmp_path), CLOCK).collect(), expected)
    (document,) = spark.read.json(result.digest_path).collect()
    assert len(document["messages"]) == 3
    assert "more channel(s)" in "".join(document["messages"])
    assert spark.read.parquet(*glob.glob(f"{tmp_path}/runs/2024-01-31/*/staged_daily")).count() == 0


def test_a_past_day_gives_what_it_gave_then(spark, tmp_path):
    early = shop.series("Drop", shop.DROP)
    later = [shop.row("Drop", -d, accepted=100) for d in (1, 2)]
    upto = datetime(2024, 2, 1)
    run(shop.tables(spark, early), f"{tmp_path}/then", shop.AS_OF, upto=upto)
    run(shop.tables(spark, early + later), f"{tmp_path}/now", shop.AS_OF, upto=upto)
    then, now = (files.read_table(spark, f"{tmp_path}/{name}", CLOCK).collect() for name in ("then", "now"))
    assert len(then) == 1 and _same(then, now)


def test_ranks_above_nine_have_no_keycap(spark):
    rows = [anomaly(f"Shop {i:02}", "pc", 5000.0 - i) for i in range(11)]
    frame = spark.createDataFrame(rows, schemas.ANOMALIES)
    messages = digest.digest_messages(frame, CLOCK, top=11).orderBy("position").collect()
    assert "**9️⃣  Shop 08**" in messages[9].message and "**11.  Shop 10**" in messages[11].message
