"""

Each query reads the whole given tables through ``ratewatch.sources.testview``.
Doubles that come out of divisions are rounded to six digits here, and in the
oracle, because two engines may sum floating-point values in different orders.
"""

from __future__ import annotations

import sys
import uuid
import warnings
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles  # noqa: E402
from ratewatch import DEFAULT_SPECS, Clock, detect, run  # noqa: E402
from ratewatch.operators import baseline, classify, counts, daily, digest, links, managers, resolve, score  # noqa: E402
from ratewatch.plans import late, rolling, sliding  # noqa: E402
from ratewatch.plans.detect import daily as plan_daily  # noqa: E402
from ratewatch.plans.detect import detect_in  # noqa: E402
from ratewatch.plans.rolling import rolling_detect  # noqa: E402
from ratewatch.sinks import files  # noqa: E402
from ratewatch.sources import schemas, testview  # noqa: E402
from ratewatch.specs import ACCEPTANCE, FRAUD, MetricSpec  # noqa: E402

try:
    import corpus_pipeline
    from ratewatch.llm import queries as corpus
except ImportError as missing:
    # The subpackage, its pipeline and the packages that only they need are optional.
    warnings.warn(f"the corpus queries are left out: {missing}", stacklevel=2)
    corpus_pipeline = corpus = None

Query = Callable[[SparkSession, str], DataFrame]

_CLOCK = Clock.at(testview.AS_OF)
_DIGEST_CLOCK = Clock.at(testview.DIGEST_AS_OF)
_MID_DAY_CLOCK = Clock.at(testview.MID_DAY_AS_OF)
ANY_DROP = (replace(ACCEPTANCE, critical=0.0, gate=0.0),)
# A second acceptance metric beside the default one, looser.
TWO_LEVELS = (ACCEPTANCE, replace(ACCEPTANCE, key="ar_loose", label="AR Drift", critical=1.0, gate=100.0), FRAUD)
# Characters of a part of a message: shorter than some lines.
PART_LIMIT = 150
# First and last as-of day of a rolling run.
ROLLING_DAYS = ("2024-01-18", "2024-01-27")
_ROUNDED = ("t_stat_alias_global", "t_stat_channel_specific", "ATV")


def _rounded(frame: DataFrame, columns: Sequence[str] = _ROUNDED) -> DataFrame:
    # Adding zero turns a negative zero into zero.
    return frame.withColumns({name: F.round(name, 6) + 0.0 for name in columns if name in frame.columns})


def _daily(spark: SparkSession, sf_dir: str, clock: Clock = _CLOCK) -> DataFrame:
    return plan_daily(testview.tables(spark, sf_dir), clock)


def _anomalies(spark: SparkSession, sf_dir: str, clock: Clock = _CLOCK) -> DataFrame:
    return classify.classify(score.score(_daily(spark, sf_dir, clock), DEFAULT_SPECS, clock), DEFAULT_SPECS)


def _stored_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result as the reports see it: written once, then read."""
    tables = testview.tables(spark, sf_dir)
    return _written(spark, detect_in(plan_daily(tables, _DIGEST_CLOCK), tables, _DIGEST_CLOCK))


def _awkward_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any drop in acceptance counts, so there are more merchants and channels than the digest lists."""
    tables = testview.awkward_tables(spark, sf_dir)
    return _written(spark, detect_in(plan_daily(tables, _DIGEST_CLOCK), tables, _DIGEST_CLOCK, ANY_DROP))


def _written(spark: SparkSession, anomalies: DataFrame) -> DataFrame:
    out_dir = _fresh_dir(spark)
    files.write_table(anomalies, out_dir, _DIGEST_CLOCK)
    return files.read_table(spark, out_dir, _DIGEST_CLOCK)


def _fresh_dir(spark: SparkSession) -> str:
    """A new folder where the cluster shares files: its checkpoint folder, or its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared}/ratewatch-out-{uuid.uuid4().hex}"


# --- scans and resolution -------------------------------------------------


def scan_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.lookback(testview.payments_daily(spark, sf_dir), _MID_DAY_CLOCK)


def resolve_entity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments, account_map = testview.payments_daily(spark, sf_dir), testview.account_map(spark, sf_dir)
    return resolve.join_entity(payments, account_map).select("requested_at", "entity_id", "entity_account_id")


def _by_both_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments, account_map = testview.payments_daily(spark, sf_dir), testview.account_map(spark, sf_dir)
    return resolve.join_merchant_account(resolve.join_entity(payments, account_map), account_map)


def resolve_merchant_fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_both_keys(spark, sf_dir).select(
        "requested_at", "merchant_account_id", "entity_account_id", "merchant_account_ref"
    )


def resolve_account_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = resolve.join_account(_by_both_keys(spark, sf_dir), testview.account_dim(spark, sf_dir))
    return joined.select("requested_at", "entity_id", "account_id", "salesforce_alias")


def resolve_alias_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testview.tables(spark, sf_dir)
    resolved = resolve.resolve_alias(tables.payments, tables.account_map, tables.account_dim, tables.alias_dim)
    return resolved.select("requested_at", "entity_id", "alias_name")


def duplicate_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.duplicate_keys(testview.account_map(spark, sf_dir), ["account_id"])


# --- daily roll-ups -------------------------------------------------------


def daily_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_daily(spark, sf_dir), ("captured_amount_sum", "daily_atv"))


def daily_performance_mid_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_daily(spark, sf_dir, _MID_DAY_CLOCK), ("captured_amount_sum", "daily_atv"))


def daily_performance_shuffle_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the lookups exceed the broadcast bound."""
    tables = testview.tables(spark, sf_dir)
    lookups = resolve.Lookups.prepare(tables.account_map, tables.account_dim, tables.alias_dim, max_rows=0)
    return _rounded(
        daily.daily_performance(tables.payments, lookups, _CLOCK), ("captured_amount_sum", "daily_atv")
    )


def daily_by_customer_shuffle_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That way with many merchants; half of the map's rows lack one id."""
    tables = testview.customer_tables(spark, sf_dir)
    return _rounded(plan_daily(tables, _CLOCK, max_rows=0), ("captured_amount_sum", "daily_atv"))


def daily_performance_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with text ids against a map with numbers."""
    rolled = plan_daily(testview.text_id_tables(spark, sf_dir), _CLOCK)
    return _rounded(rolled, ("captured_amount_sum", "daily_atv"))


def _alias_daily(spec: MetricSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = daily.merchant_daily(_daily(spark, sf_dir), [spec])
        return days.select(
            "requested_date", "alias_name", "is_mit",
            F.round(f"{spec.key}_rate", 6).alias("rate"),
            F.col(f"{spec.key}_active_volume").alias("active_volume"),
        )

    return query


# --- baselines and scores -------------------------------------------------


def _alias_baseline(spec: MetricSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = baseline.merchant_baseline(_daily(spark, sf_dir), [spec], _CLOCK)
        return _rounded(base, ("t1", "mean", "std")).drop("Anomaly_Type", "active_volume", "atv")

    return query


def _channel_baseline(spec: MetricSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = baseline.channel_baseline(_daily(spark, sf_dir), [spec], _CLOCK)
        return _rounded(base, ("t1", "mean", "std", "atv")).drop("Anomaly_Type")

    return query


def _scored(spec: MetricSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = score.score(_daily(spark, sf_dir), [spec], _CLOCK)
        return _rounded(scored).select(
            "alias_name", "channel_id", "is_mit", "t_stat_alias_global", "t_stat_channel_specific",
            "channel_vol_share_pct", "Total_Volume_Amount_Lost", "Lost_Volume", "ATV",
        )

    return query


def channel_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score.score(_daily(spark, sf_dir), DEFAULT_SPECS, _CLOCK)
    return scored.select("Anomaly_Type", "alias_name", "channel_id", "is_mit", "volume", "channel_vol_share_pct")


def lost_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score.score(_daily(spark, sf_dir), [ACCEPTANCE], _CLOCK)
    return _rounded(scored).select(
        "alias_name", "channel_id", "is_mit", "Lost_Volume", "Total_Volume_Amount_Lost", "ATV"
    )


# --- classification and enrichment ----------------------------------------


def severity_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score.score(_daily(spark, sf_dir), DEFAULT_SPECS, _CLOCK)
    return _rounded(classify.classify(scored, DEFAULT_SPECS, keep_all=True))


def severity_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sparse merchants: days without rates, single days, no spread, losses exactly halfway."""
    rolled = plan_daily(testview.customer_tables(spark, sf_dir), _CLOCK)
    scored = score.score(rolled, DEFAULT_SPECS, _CLOCK)
    return _rounded(classify.classify(scored, DEFAULT_SPECS, keep_all=True))


def baseline_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = plan_daily(testview.customer_tables(spark, sf_dir), _CLOCK)
    base = baseline.channel_baseline(rolled, DEFAULT_SPECS, _CLOCK)
    return _rounded(base, ("t1", "mean", "std", "atv"))


def two_levels_of_one_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics over the same ratio, each with its own label and gates."""
    scored = score.score(_daily(spark, sf_dir, _DIGEST_CLOCK), TWO_LEVELS, _DIGEST_CLOCK)
    return _rounded(classify.classify(scored, TWO_LEVELS))


def anomalies_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_anomalies(spark, sf_dir))


def manager_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return managers.manager_lookup(testview.alias_dim(spark, sf_dir), testview.employee_dim(spark, sf_dir))


def anomalies_with_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    alias_dim, employee_dim = testview.alias_dim(spark, sf_dir), testview.employee_dim(spark, sf_dir)
    enriched = managers.with_manager(_anomalies(spark, sf_dir), alias_dim, employee_dim)
    return _rounded(classify.in_report_order(enriched))


def anomalies_with_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(links.with_links(_anomalies(spark, sf_dir), _CLOCK))


def detect_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(detect(testview.tables(spark, sf_dir), _CLOCK))


def detect_full_more_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(detect(testview.tables(spark, sf_dir), _DIGEST_CLOCK))


# --- reports and sinks ----------------------------------------------------


def counts_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.counts_by_metric(_anomalies(spark, sf_dir), DEFAULT_SPECS)


def digest_top_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    merchants = digest.top_merchants(_stored_anomalies(spark, sf_dir))
    return merchants.withColumn("lost_amount", F.round("lost_amount", 2))


def digest_top_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    anomalies = _stored_anomalies(spark, sf_dir)
    return digest.top_channels(anomalies, digest.top_merchants(anomalies))


def digest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.digest_messages(_stored_anomalies(spark, sf_dir), _DIGEST_CLOCK)


def digest_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both cuts and the overflow line, over awkward names."""
    return digest.digest_messages(_awkward_anomalies(spark, sf_dir), _DIGEST_CLOCK, critical=0.0)


def digest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, split at a length that cuts them between lines and within lines."""
    return digest.split_messages(digest_by_customer(spark, sf_dir), PART_LIMIT)


def links_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _awkward_anomalies(spark, sf_dir)
    return found.select("alias_name", "channel_id", "is_mit", "Link_to_Look")


def csv_awkward_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with spaces at their ends, quotes, commas and line breaks, through the CSV."""
    path = files.write_csv(_awkward_anomalies(spark, sf_dir), _fresh_dir(spark), _DIGEST_CLOCK)
    return _rounded(files.read_csv(spark, path))


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, files.Day]:
    """A day run twice, the second time over what the first has published."""
    out_dir = _fresh_dir(spark)
    for _ in range(2):
        run(testview.tables(spark, sf_dir), out_dir, _DIGEST_CLOCK)
    return out_dir, files.published(spark, out_dir, _DIGEST_CLOCK)[0]


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = _fresh_dir(spark)
    run(testview.tables(spark, sf_dir), out_dir, _DIGEST_CLOCK)
    return _rounded(files.read_table(spark, out_dir, _DIGEST_CLOCK))


def rerun_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of a day that was run twice."""
    return _rounded(files.read_table(spark, _published(spark, sf_dir)[0], _DIGEST_CLOCK))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = _fresh_dir(spark)
    day = run(testview.tables(spark, sf_dir), out_dir, _DIGEST_CLOCK)
    return _rounded(files.read_csv(spark, day.csv_path))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published digest; the list is joined to one text so that it compares as a value."""
    _, day = _published(spark, sf_dir)
    schema = "channel_id string, messages array<string>, today string"
    stored = spark.createDataFrame([], schema) if day.digest_path is None else spark.read.schema(schema).json(day.digest_path)
    return stored.withColumn("messages", F.concat_ws("\n", "messages"))


# --- many days, late data, kept state --------------------------------------


def rolling_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomalies of many as-of days, from one pass."""
    return _rounded(rolling_detect(testview.tables(spark, sf_dir), *ROLLING_DAYS))


def rolling_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every score of these days, in sparse series of many merchants."""
    tables, (first, last) = testview.customer_tables(spark, sf_dir), ROLLING_DAYS
    clock = Clock.at(last)
    days = (clock.today - Clock.at(first).today).days
    rolled = plan_daily(tables, clock, 30 + days, clock.as_of)
    return _rounded(rolling.rolling_scores(rolled, first, last)).select(
        "as_of", "Anomaly_Type", "alias_name", "channel_id", "is_mit", "t_stat_alias_global", "t_stat_channel_specific",
        "channel_vol_share_pct", "Total_Volume_Amount_Lost", "Lost_Volume", "ATV",
    )


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments by the day that brings them: of every fifth entity, two days late."""
    payments = testview.payments_daily(spark, sf_dir)
    late = F.when(F.col("entity_id") % 5 == 0, 2).otherwise(0)
    return payments.withColumn("arrived", F.date_add(F.to_date("requested_at"), late))


def late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roll-up refreshed after late rows, repeated rows and replaced files; then cut within two days."""
    folder = _fresh_dir(spark)
    source = f"{folder}/payments"
    arrivals = _arrivals(spark, sf_dir).repartition("arrived")
    on_time = F.col("entity_id") % 5 != 0
    store = late.DailyStore(spark, f"{folder}/store", source, "arrived")
    arrivals.where(on_time).write.partitionBy("arrived").parquet(source)
    store.refresh()
    more = arrivals.where(~on_time).unionByName(arrivals.where(on_time & (F.col("entity_id") % 11 == 0)))
    more.write.partitionBy("arrived").mode("append").parquet(source)
    kept = arrivals.where((F.col("arrived") == "2024-01-20") & (F.col("entity_id") % 3 != 0))
    kept.write.partitionBy("arrived").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(source)
    store.refresh()
    tables = testview.tables(spark, sf_dir)
    lookups = resolve.Lookups.prepare(tables.account_map, tables.account_dim, tables.alias_dim)
    rolled = store.daily(lookups, _MID_DAY_CLOCK, upto=datetime(2024, 1, 28, 18))
    return _rounded(rolled, ("captured_amount_sum", "daily_atv"))


def kept_up_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from a kept state, after days on each of which new and late files came."""
    folder = _fresh_dir(spark)
    source = f"{folder}/payments"
    arrivals = _arrivals(spark, sf_dir).repartition("arrived")
    store = late.DailyStore(spark, f"{folder}/store", source, "arrived")
    state = sliding.BaselineState(spark, f"{folder}/state")
    tables = testview.customer_tables(spark, sf_dir)
    lookups = resolve.Lookups.prepare(tables.account_map, tables.account_dim, tables.alias_dim)
    come, rolled = F.to_date(F.lit("2024-01-01")), None
    for day in ("2024-01-24", "2024-01-25", "2024-01-27"):
        new = (F.col("arrived") >= come) & (F.col("arrived") < F.lit(day))
        arrivals.where(new).write.partitionBy("arrived").mode("append").parquet(source)
        rolled, come = late.keep_up(store, state, lookups, day), F.to_date(F.lit(day))
    return _rounded(state.score(rolled)).select(
        "Anomaly_Type", "alias_name", "channel_id", "is_mit", "t_stat_alias_global", "t_stat_channel_specific",
        "channel_vol_share_pct", "Total_Volume_Amount_Lost", "Lost_Volume", "ATV",
    )


def sliding_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel baselines of a window that was moved day by day, and once corrected, to where it stands."""
    tables, clock = testview.customer_tables(spark, sf_dir), _CLOCK
    rolled = plan_daily(tables, clock, 40, clock.as_of)
    folder = _fresh_dir(spark)
    rolled.write.parquet(f"{folder}/daily")
    rolled = spark.read.schema(rolled.schema).parquet(f"{folder}/daily")
    state = sliding.BaselineState(spark, f"{folder}/state")
    wrong = rolled.where("requested_date <> DATE'2024-01-25' OR channel_id <> 'pc_0'")
    state.move(wrong, "2024-01-28")
    state.correct(*(days.where("requested_date = DATE'2024-01-25'") for days in (wrong, rolled)))
    for day in ("2024-01-29", "2024-01-30", "2024-01-31"):
        state.move(rolled, day)
    return _rounded(state.channels(rolled), ("t1", "mean", "std", "atv"))


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: yesterday's anomalies, all 15 columns."""
    return detect_full(spark, "/root/testdata/sf0.001")


def own_queries() -> dict[str, Query]:
    """The queries of the reference's operators; each has an oracle."""
    registered = [
        scan_lookback, resolve_entity_join, resolve_merchant_fallback_join, resolve_account_join,
        resolve_alias_join, duplicate_lookup_keys, daily_performance, daily_performance_mid_day,
        daily_performance_shuffle_joins, daily_by_customer_shuffle_joins, daily_performance_text_ids, channel_share, lost_impact, severity_all,
        severity_by_customer, baseline_by_customer, two_levels_of_one_rate, anomalies_union,
        manager_lookup, anomalies_with_manager, anomalies_with_links, detect_full,
        detect_full_more_breaches, counts_by_metric, digest_top_merchants, digest_top_channels,
        digest_messages, digest_by_customer, digest_parts, links_by_customer, run_table, csv_roundtrip,
        csv_awkward_roundtrip, json_roundtrip,
        rerun_table, rolling_days, rolling_scores, late_days, sliding_baseline, kept_up_scores,
    ]
    by_name: dict[str, Query] = {query.__name__: query for query in registered}
    for spec in DEFAULT_SPECS:
        by_name[f"alias_daily_{spec.key}"] = _alias_daily(spec)
        by_name[f"alias_baseline_{spec.key}"] = _alias_baseline(spec)
        by_name[f"channel_baseline_{spec.key}"] = _channel_baseline(spec)
        by_name[f"scored_{spec.key}"] = _scored(spec)
    return by_name


def queries() -> dict[str, Query]:
    return own_queries() | (corpus.queries() | {"pipeline": corpus_pipeline.run} if corpus else {})


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | (corpus.oracle_sql() if corpus else {})
