"""DuckDB SQL for every registered query, written as the plain definition.

Four literal joins, COUNT(DISTINCT), a window for the share: none of the
rewrites the Spark plan makes (lookups joined to each other, pre-aggregation,
share from the merchant sums) appears here, so an error in one of them shows.
"""

from __future__ import annotations

AS_OF, DIGEST_AS_OF, MID_DAY_AS_OF = "2024-01-31", "2024-01-21", "2024-02-10T12:00:00"

# Fixed values, written out here so that a wrong one in the package shows.
BASE_URL = "https://dashboards.example.com/payments"
LINK_LABEL = "🔍 View Channel Data "
TITLE = "🤖 **Rate Watch** — Acceptance Rate Anomaly Report"
CHANNEL_LINK = "🔍 Dashboard"
FOOTER = "_Powered by ratewatch_"
TARGET = "rate-alerts"
RULE = "━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━━"
EXPLANATION = (
    " merchants** with the highest estimated processing volume impact due to acceptance rate drops"
    " vs. their historical baseline. Figures represent estimated lost payments and processing volume."
)

_PAYMENTS = """
payments AS (
  SELECT ts AS requested_at, user_id AS entity_id, CAST(user_id AS VARCHAR) AS merchant_account_id,
         CASE WHEN k < 60 THEN 'pc_0' WHEN k < 85 THEN 'pc_1' ELSE 'pc_2' END AS processing_channel_id,
         k % 2 = 0 AS is_merchant_initiated,
         CAST(event_type <> 'error' AS BIGINT) AS accepted_payments,
         CAST(1 AS BIGINT) AS requested_payments,
         CASE WHEN event_type <> 'error' THEN value * 100 ELSE 0 END AS captured_amount_usd,
         CAST(event_type <> 'error' AS BIGINT) AS captured_payments,
         CAST(event_type = 'click' AS BIGINT) AS fraud_reported_payments,
         CAST(event_type = 'view' AS BIGINT) AS disputed_payments
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),"""

_REGIONAL = """
account_map AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS entity_id,
         CASE WHEN c_custkey % 2 <> 0 THEN c_custkey END AS merchant_account_id,
         c_nationkey AS account_id
  FROM customer
),
account_dim AS (
  SELECT n_nationkey AS account_id,
         CASE WHEN r_name = 'MIDDLE EAST' THEN 'UNLISTED' ELSE r_name END AS salesforce_alias
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
alias_dim AS (
  SELECT r_name AS salesforce_alias, r_regionkey AS account_manager_id,
         'Manager ' || r_name AS account_manager_name
  FROM region
),"""

_AWKWARD = """
account_map AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS entity_id,
         CASE WHEN c_custkey % 2 <> 0 THEN c_custkey END AS merchant_account_id,
         c_nationkey AS account_id
  FROM customer
),
account_dim AS (
  SELECT n_nationkey AS account_id,
         CASE WHEN n_nationkey % 3 = 0 THEN ' Shop, ' ELSE 'Shop ' END || n_nationkey
           || CASE n_nationkey % 4 WHEN 0 THEN ' "A" *' WHEN 1 THEN '~ ' WHEN 2 THEN chr(10) || 'line'
                ELSE chr(39) || 's é' END AS salesforce_alias
  FROM nation
),
alias_dim AS (
  SELECT salesforce_alias, account_id AS account_manager_id, 'Manager ' || account_id AS account_manager_name
  FROM account_dim
),"""

# Every customer is a merchant of its own.
_CUSTOMERS = """
account_map AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS entity_id,
         CASE WHEN c_custkey % 2 <> 0 THEN c_custkey END AS merchant_account_id,
         c_custkey AS account_id
  FROM customer
),
account_dim AS (SELECT c_custkey AS account_id, c_name AS salesforce_alias FROM customer),
alias_dim AS (
  SELECT c_name AS salesforce_alias, c_nationkey AS account_manager_id,
         'Manager ' || c_nationkey AS account_manager_name
  FROM customer
),"""

_RESOLVED = """
employee_dim AS (
  SELECT s_suppkey AS user_id, lower(replace(s_name, '#', '.')) || '@example.com' AS email
  FROM supplier
),
resolved AS (
  SELECT p.*, e.account_id AS entity_account_id, m.account_id AS merchant_account_ref,
         COALESCE(e.account_id, m.account_id) AS account_id,
         d.salesforce_alias, a.salesforce_alias AS alias_name
  FROM payments p
  LEFT JOIN account_map e ON e.entity_id = p.entity_id
  LEFT JOIN account_map m ON CAST(m.merchant_account_id AS VARCHAR) = p.merchant_account_id
  LEFT JOIN account_dim d ON d.account_id = COALESCE(e.account_id, m.account_id)
  LEFT JOIN alias_dim a ON a.salesforce_alias = d.salesforce_alias
)"""

INPUTS = _PAYMENTS + _REGIONAL + _RESOLVED
CUSTOMER_INPUTS = _PAYMENTS + _CUSTOMERS + _RESOLVED
_CHANNELS = "CASE WHEN k < 60 THEN 'pc_0' WHEN k < 85 THEN 'pc_1' ELSE 'pc_2' END"
AWKWARD_INPUTS = _PAYMENTS.replace(_CHANNELS, "'pc ' || (hour(ts) % 9) || ' '") + _AWKWARD + _RESOLVED


def _clock(as_of: str) -> str:
    return f"TIMESTAMP '{as_of.replace('T', ' ')}'"


def _yesterday(as_of: str) -> str:
    return f"(CAST({_clock(as_of)} AS DATE) - INTERVAL 1 DAY)"


def _decimal_mean(rate: str) -> str:
    """An exact mean, by the decimal text of each double, as a correctly rounded double."""
    total = f"SUM(CAST(CAST({rate} AS VARCHAR) AS DECIMAL(38, 18)))"
    return f"CAST(CAST({total} AS VARCHAR) AS DOUBLE) / NULLIF(COUNT({rate}), 0)"


def _round(value: str, digits: int) -> str:
    """A double rounded once, half away from zero by its decimal text."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def _detection(as_of: str, inputs: str = INPUTS, critical: float = 2.576, gate: float = 1000, loose: bool = False, upto: str = "") -> str:
    """CTEs from the resolved facts to labelled, enriched anomalies.

    ``critical`` and ``gate`` are those of the acceptance rate; ``loose`` adds a
    second metric over it. ``upto`` is an instant that the facts lie before.
    """
    day_before = f"requested_date = {_yesterday(as_of)}"
    metrics = {
        "AR Anomaly": ("accepted_sum", "requested_sum"),
        "Fraud Anomaly": ("fraud_reported_sum", "accepted_sum"),
        "Dispute Anomaly": ("disputed_sum", "accepted_sum"),
    }
    if loose:
        metrics["AR Drift"] = metrics["AR Anomaly"]
        del metrics["Dispute Anomaly"]
    measured = " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, requested_date, alias_name, channel_id, is_mit, daily_atv, "
        f"{part} AS part, {whole} AS whole, CAST({part} AS DOUBLE) / NULLIF({whole}, 0) AS rate FROM daily"
        for metric, (part, whole) in metrics.items()
    )
    return f"""{inputs},
daily AS (
  SELECT CAST(requested_at AS DATE) AS requested_date, alias_name,
         processing_channel_id AS channel_id, is_merchant_initiated AS is_mit,
         CAST(SUM(accepted_payments) AS BIGINT) AS accepted_sum,
         CAST(SUM(requested_payments) AS BIGINT) AS requested_sum,
         COALESCE(SUM(captured_amount_usd), 0) AS captured_amount_sum,
         CAST(SUM(captured_payments) AS BIGINT) AS captured_sum,
         CAST(COALESCE(SUM(fraud_reported_payments), 0) AS BIGINT) AS fraud_reported_sum,
         CAST(COALESCE(SUM(disputed_payments), 0) AS BIGINT) AS disputed_sum,
         COALESCE(SUM(captured_amount_usd), 0) / NULLIF(SUM(captured_payments), 0) AS daily_atv
  FROM resolved WHERE requested_at >= {_clock(as_of)} - INTERVAL 30 DAY{f" AND requested_at < {_clock(upto)}" if upto else ""}
  GROUP BY 1, 2, 3, 4
),
measured AS ({measured}),
merchant_days AS (
  SELECT metric, requested_date, alias_name, is_mit,
         CAST(SUM(part) AS DOUBLE) / NULLIF(SUM(whole), 0) AS rate,
         CAST(SUM(whole) FILTER (WHERE rate IS NOT NULL) AS BIGINT) AS active_volume
  FROM measured GROUP BY 1, 2, 3, 4
),
merchants AS (
  SELECT metric, alias_name, is_mit, MAX(rate) FILTER (WHERE {day_before}) AS t1,
         {_decimal_mean("rate")} AS mean,
         STDDEV_SAMP(rate) AS std, COUNT(DISTINCT requested_date) AS n
  FROM merchant_days GROUP BY 1, 2, 3
),
channels AS (
  SELECT metric, alias_name, channel_id, is_mit, MAX(rate) FILTER (WHERE {day_before}) AS t1,
         {_decimal_mean("rate")} AS mean, STDDEV_SAMP(rate) AS std, COUNT(DISTINCT requested_date) AS n,
         MAX(whole) FILTER (WHERE {day_before}) AS volume,
         MAX(part) FILTER (WHERE {day_before}) AS incidents,
         CASE WHEN metric LIKE 'AR %' THEN MAX(daily_atv) FILTER (WHERE {day_before}) END AS atv
  FROM measured GROUP BY 1, 2, 3, 4
),
scored AS (
  SELECT c.metric AS Anomaly_Type, c.alias_name, c.channel_id, c.is_mit, c.volume,
         (m.t1 - m.mean) / NULLIF(m.std / SQRT(m.n), 0) AS t_stat_alias_global,
         (c.t1 - c.mean) / NULLIF(c.std / SQRT(c.n), 0) AS t_stat_channel_specific,
         ROUND(CAST(c.volume AS DOUBLE) /
               NULLIF(SUM(c.volume) OVER (PARTITION BY c.metric, c.alias_name, c.is_mit), 0) * 100, 2)
           AS channel_vol_share_pct,
         CASE WHEN c.metric LIKE 'AR %'
              THEN {_round("CASE WHEN c.mean > c.t1 THEN c.mean - c.t1 ELSE 0 END * c.volume", 0)}
              ELSE CAST(c.incidents AS DOUBLE) END AS Lost_Volume,
         CASE WHEN c.metric LIKE 'AR %'
              THEN {_round("CASE WHEN c.mean > c.t1 THEN c.mean - c.t1 ELSE 0 END * c.volume * c.atv", 2)}
              END AS Total_Volume_Amount_Lost,
         CASE WHEN c.metric LIKE 'AR %' THEN c.atv END AS ATV
  FROM channels c
  JOIN merchants m ON m.metric = c.metric AND m.alias_name = c.alias_name AND m.is_mit = c.is_mit
  WHERE c.t1 IS NOT NULL
),
judged AS (
  SELECT *,
         CASE WHEN Anomaly_Type = 'AR Anomaly'
              THEN t_stat_alias_global < -{critical} AND t_stat_channel_specific < -{critical}
              WHEN Anomaly_Type = 'AR Drift'
              THEN t_stat_alias_global < -1 AND t_stat_channel_specific < -1
              ELSE t_stat_alias_global > 2.576 AND t_stat_channel_specific > 2.576 END AS breach,
         CASE Anomaly_Type WHEN 'AR Anomaly' THEN Total_Volume_Amount_Lost > {gate}
              WHEN 'AR Drift' THEN Total_Volume_Amount_Lost > 100
              WHEN 'Fraud Anomaly' THEN Lost_Volume >= 5 ELSE Lost_Volume >= 3 END AS large,
         CASE WHEN Anomaly_Type LIKE 'AR %' THEN 'Outage' ELSE 'Spike' END AS word
  FROM scored
),
labelled AS (
  SELECT *,
         CASE WHEN breach AND channel_vol_share_pct > 50 THEN 'P1: Critical - Primary Channel ' || word
              WHEN breach THEN 'P1: Critical - Global Merchant ' || word
              WHEN Anomaly_Type LIKE 'AR %' THEN 'Alert: Significant Degradation'
              ELSE 'Alert: Significant Increase' END AS overall_status
  FROM judged
),
anomalies AS (SELECT * FROM labelled WHERE breach AND large),
managers AS (
  SELECT a.salesforce_alias, a.account_manager_name AS Account_Manager_Name,
         e.email AS Account_Manager_Email
  FROM alias_dim a LEFT JOIN employee_dim e ON e.user_id = a.account_manager_id
),
linked AS (
  SELECT a.*, g.Account_Manager_Name, g.Account_Manager_Email,
         strftime({_clock(as_of)}, '%Y-%m-%d') AS Date_of_Detection,
         '{BASE_URL}?mit=' || CASE WHEN is_mit THEN 'Yes' ELSE 'No' END
           || '&alias=' || url_encode('"' || alias_name || '"')
           || '&channel=' || url_encode(COALESCE(channel_id, '')) AS url,
         '=HYPERLINK("' || url || '","{LINK_LABEL}' || replace(alias_name, '"', '""') || '")' AS Link_to_Look
  FROM anomalies a LEFT JOIN managers g ON g.salesforce_alias = a.alias_name
),
ar AS (
  SELECT alias_name, channel_id, is_mit, overall_status, url, Total_Volume_Amount_Lost AS lost_amount,
         Lost_Volume AS lost_payments,
         ROW_NUMBER() OVER (PARTITION BY alias_name
           ORDER BY Total_Volume_Amount_Lost DESC, is_mit, channel_id NULLS FIRST) AS channel_rank
  FROM linked WHERE Anomaly_Type = 'AR Anomaly'
),
totals AS (
  SELECT alias_name, SUM(lost_amount) AS lost_amount, SUM(lost_payments) AS lost_payments, COUNT(*) AS channels
  FROM ar GROUP BY 1
),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY lost_amount DESC, alias_name) AS rank FROM totals
),
top AS (SELECT *, COUNT(*) OVER () AS merchants FROM ranked WHERE rank <= 5),
texts AS (
  SELECT t.alias_name, STRING_AGG('• `' || COALESCE(channel_id, '') || '` | ' || overall_status || ' | MIT: '
           || CASE WHEN is_mit THEN 'Yes' ELSE 'No' END || ' | '
           || format('{{:,}}', CAST(trunc(a.lost_payments) AS BIGINT)) || ' payments | **$'
           || format('{{:,}}', CAST(round_even(a.lost_amount, 0) AS BIGINT)) || '** | <' || url
           || '|{CHANNEL_LINK}>', chr(10) ORDER BY channel_rank) AS lines
  FROM ar a JOIN top t ON t.alias_name = a.alias_name WHERE channel_rank <= 5 GROUP BY 1
),
messages AS (
  SELECT CAST(0 AS INTEGER) AS position,
         '{TITLE}' || chr(10) || '📅 **' || strftime({_clock(as_of)}, '%-d %b %Y')
           || '**  |  Critical value: ±{critical:g}  |  Baseline: 30-day average'
           || chr(10) || chr(10) || 'Flagged **' || merchants || '{EXPLANATION}' AS message
  FROM top WHERE rank = 1
  UNION ALL
  SELECT CAST(rank AS INTEGER),
         '{RULE}' || chr(10) || chr(10) || '**' || rank || '️⃣  ' || t.alias_name || '**' || chr(10)
           || '> 📅 Date of Detection: **' || strftime({_clock(as_of)}, '%-d %b %Y') || '**' || chr(10)
           || '> 🔍 Anomaly Type: **AR Anomaly**' || chr(10)
           || '> 💳 Lost Payments: **' || format('{{:,}}', CAST(trunc(lost_payments) AS BIGINT)) || '**' || chr(10)
           || '> 💰 Lost Volume Amount: **$' || format('{{:,}}', CAST(round_even(lost_amount, 0) AS BIGINT))
           || '**' || chr(10) || chr(10) || '**Channel Breakdown:**' || chr(10) || lines
           || CASE WHEN channels > 5 THEN chr(10) || '_...' || (channels - 5)
                || ' more channel(s) — see CSV for full breakdown_' ELSE '' END
           || CASE WHEN rank = merchants THEN chr(10) || chr(10) || '{RULE}' || chr(10) || '{FOOTER}'
                ELSE '' END
  FROM top t JOIN texts x ON x.alias_name = t.alias_name
)"""


# Rounded statistics; a tiny negative one must not become a negative zero.
_STATISTICS = ", ".join(
    f"CASE WHEN ROUND({name}, 6) = 0 THEN 0 ELSE ROUND({name}, 6) END AS {name}"
    for name in ("t_stat_alias_global", "t_stat_channel_specific")
)
_ANOMALY = f"""Anomaly_Type, overall_status, alias_name, channel_id, is_mit, {_STATISTICS},
  channel_vol_share_pct, Total_Volume_Amount_Lost, Lost_Volume, ROUND(ATV, 6) AS ATV"""
_RESULT = f"{_ANOMALY}, Date_of_Detection, Link_to_Look, Account_Manager_Name, Account_Manager_Email"
_BASELINE = "ROUND(t1, 6) AS t1, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, n"
_FACT = """processing_channel_id AS channel_id, is_merchant_initiated AS is_mit,
  accepted_payments, requested_payments, captured_amount_usd, captured_payments,
  fraud_reported_payments, disputed_payments"""
_DAILY = """requested_date, alias_name, channel_id, is_mit, accepted_sum, requested_sum,
  ROUND(captured_amount_sum, 6) AS captured_amount_sum, captured_sum,
  fraud_reported_sum, disputed_sum, ROUND(daily_atv, 6) AS daily_atv"""


def _from(select: str, as_of: str = AS_OF, inputs: str = INPUTS, **gates) -> str:
    return f"WITH {_detection(as_of, inputs, **gates)} {select}"


def _per_metric(metric: str) -> dict[str, str]:
    return {
        "alias_daily": f"SELECT requested_date, alias_name, is_mit, ROUND(rate, 6) AS rate, active_volume "
        f"FROM merchant_days WHERE metric = '{metric}'",
        "alias_baseline": f"SELECT alias_name, is_mit, {_BASELINE} FROM merchants WHERE metric = '{metric}'",
        "channel_baseline": f"SELECT alias_name, channel_id, is_mit, {_BASELINE}, volume, incidents, "
        f"ROUND(atv, 6) AS atv FROM channels WHERE metric = '{metric}'",
        "scored": f"""SELECT alias_name, channel_id, is_mit, {_STATISTICS}, channel_vol_share_pct,
          Total_Volume_Amount_Lost, Lost_Volume, ROUND(ATV, 6) AS ATV
          FROM scored WHERE Anomaly_Type = '{metric}'""",
    }


# Facts as they lie when all have arrived: entities of 11 twice, and a day whose files were replaced by fewer rows.
_ON_TIME = "entity_id % 5 <> 0"
_ARRIVED = f"CAST(requested_at AS DATE) + CASE WHEN {_ON_TIME} THEN INTERVAL 0 DAY ELSE INTERVAL 2 DAY END"
_REPLACED = f"{_ARRIVED} = DATE '2024-01-20'"
LATE_INPUTS = _PAYMENTS.replace("payments AS", "all_payments AS", 1) + f"""
payments AS (
  SELECT * FROM all_payments WHERE NOT ({_REPLACED}) OR entity_id % 3 <> 0
  UNION ALL
  SELECT * FROM all_payments WHERE {_ON_TIME} AND entity_id % 11 = 0 AND NOT ({_REPLACED})
),""" + _REGIONAL + _RESOLVED
# What had arrived before the day.
KEPT_UP_INPUTS = _PAYMENTS.replace("payments AS", "all_payments AS", 1) + f"""
payments AS (
  SELECT * FROM all_payments WHERE {_ARRIVED} BETWEEN DATE '2024-01-01' AND DATE '2024-01-26'
),""" + _CUSTOMERS + _RESOLVED
PART_LIMIT = 150
ROLLING_DAYS = [f"2024-01-{day}" for day in range(18, 28)]


def _each_day(select: str, inputs: str = INPUTS) -> str:
    """The union of single runs, each of which sees nothing from its own day on."""
    runs = [_from(select.format(day=day), day, inputs, upto=day) for day in ROLLING_DAYS]
    return " UNION ALL ".join(f"SELECT * FROM ({run})" for run in runs)


def oracle_sql() -> dict[str, str]:
    detect = f"SELECT {_RESULT} FROM linked"
    daily = f"SELECT {_DAILY} FROM daily"
    messages = (
        "SELECT position, message, CAST(length(message) AS INTEGER) AS length, "
        "length(message) <= 5000 AS fits FROM messages"
    )
    any_drop = {"critical": 0.0, "gate": 0.0}
    sql = {
        "scan_lookback": f"""WITH {INPUTS}
            SELECT CAST(requested_at AS DATE) AS requested_date, entity_id, merchant_account_id, {_FACT}
            FROM payments WHERE requested_at >= {_clock(MID_DAY_AS_OF)} - INTERVAL 30 DAY""",
        "resolve_entity_join": f"WITH {INPUTS} SELECT requested_at, entity_id, entity_account_id FROM resolved",
        "resolve_merchant_fallback_join": f"""WITH {INPUTS}
            SELECT requested_at, merchant_account_id, entity_account_id, merchant_account_ref FROM resolved""",
        "resolve_account_join": f"""WITH {INPUTS}
            SELECT requested_at, entity_id, account_id, salesforce_alias FROM resolved""",
        "resolve_alias_join": f"WITH {INPUTS} SELECT requested_at, entity_id, alias_name FROM resolved",
        "duplicate_lookup_keys": f"""WITH {INPUTS}
            SELECT account_id, COUNT(*) AS copies FROM account_map
            WHERE account_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""",
        "daily_performance": _from(daily),
        "daily_performance_shuffle_joins": _from(daily),
        "daily_performance_mid_day": _from(daily, MID_DAY_AS_OF),
        "channel_share": _from(
            "SELECT Anomaly_Type, alias_name, channel_id, is_mit, volume, channel_vol_share_pct FROM scored"
        ),
        "lost_impact": _from(
            "SELECT alias_name, channel_id, is_mit, Lost_Volume, Total_Volume_Amount_Lost, ROUND(ATV, 6) AS ATV "
            "FROM scored WHERE Anomaly_Type = 'AR Anomaly'"
        ),
        "severity_all": _from(f"SELECT {_ANOMALY} FROM labelled"),
        "severity_by_customer": _from(f"SELECT {_ANOMALY} FROM labelled", inputs=CUSTOMER_INPUTS),
        "daily_by_customer_shuffle_joins": _from(daily, inputs=CUSTOMER_INPUTS),
        "daily_performance_text_ids": _from(daily),
        "two_levels_of_one_rate": _from(f"SELECT {_ANOMALY} FROM anomalies", DIGEST_AS_OF, loose=True),
        "digest_by_customer": _from(messages, DIGEST_AS_OF, AWKWARD_INPUTS, **any_drop),
        "digest_parts": _from(
            f"""SELECT position, CAST(generate_subscripts(parts, 1) AS INTEGER) AS part, unnest(parts).t AS message,
              CAST(length(unnest(parts).t) AS INTEGER) AS length, length(unnest(parts).t) <= {PART_LIMIT} AS fits,
              unnest(parts).inside AS continues
            FROM (
              SELECT position, list_reduce(pieces, lambda done, p:
                CASE WHEN NOT p[1].inside AND length(done[-1].t) + 1 + length(p[1].t) <= {PART_LIMIT}
                  THEN list_append(done[:-2], {{'t': done[-1].t || chr(10) || p[1].t, 'inside': done[-1].inside}})
                  ELSE list_concat(done, p) END) AS parts
              FROM (
                SELECT position, flatten(list_transform(string_split(message, chr(10)), lambda l:
                  list_transform(range(greatest(length(l) - 1, 0) // {PART_LIMIT} + 1), lambda i:
                    [{{'t': substr(l, i * {PART_LIMIT} + 1, {PART_LIMIT}), 'inside': i > 0}}]))) AS pieces
                FROM messages
              )
            )""",
            DIGEST_AS_OF, AWKWARD_INPUTS, **any_drop,
        ),
        "links_by_customer": _from(
            "SELECT alias_name, channel_id, is_mit, Link_to_Look FROM linked WHERE Anomaly_Type = 'AR Anomaly'",
            DIGEST_AS_OF, AWKWARD_INPUTS, **any_drop,
        ),
        "csv_awkward_roundtrip": _from(
            f"{detect} WHERE Anomaly_Type = 'AR Anomaly'", DIGEST_AS_OF, AWKWARD_INPUTS, **any_drop
        ),
        "baseline_by_customer": _from(
            f"SELECT metric AS Anomaly_Type, alias_name, channel_id, is_mit, {_BASELINE}, volume, incidents, "
            "ROUND(atv, 6) AS atv FROM channels",
            inputs=CUSTOMER_INPUTS,
        ),
        "anomalies_union": _from(f"SELECT {_ANOMALY} FROM anomalies"),
        "manager_lookup": f"WITH {INPUTS}" + """
            SELECT a.salesforce_alias, a.account_manager_name AS Account_Manager_Name,
                   e.email AS Account_Manager_Email
            FROM alias_dim a LEFT JOIN employee_dim e ON e.user_id = a.account_manager_id""",
        "anomalies_with_manager": _from(f"SELECT {_ANOMALY}, Account_Manager_Name, Account_Manager_Email FROM linked"),
        "anomalies_with_links": _from(f"SELECT {_ANOMALY}, Date_of_Detection, Link_to_Look FROM linked"),
        "detect_full": _from(detect),
        "detect_full_more_breaches": _from(detect, DIGEST_AS_OF),
        "run_table": _from(detect, DIGEST_AS_OF),
        "counts_by_metric": _from(
            """SELECT 'Total' AS Anomaly_Type, COUNT(*) AS anomalies FROM anomalies
            UNION ALL SELECT 'AR Anomaly', COUNT(*) FROM anomalies WHERE Anomaly_Type = 'AR Anomaly'
            UNION ALL SELECT 'Fraud Anomaly', COUNT(*) FROM anomalies WHERE Anomaly_Type = 'Fraud Anomaly'
            UNION ALL SELECT 'Dispute Anomaly', COUNT(*) FROM anomalies WHERE Anomaly_Type = 'Dispute Anomaly'""",
        ),
        "digest_top_merchants": _from(
            """SELECT CAST(rank AS INTEGER) AS rank, alias_name, ROUND(lost_amount, 2) AS lost_amount,
            lost_payments, channels, merchants FROM top""",
            DIGEST_AS_OF,
        ),
        "digest_top_channels": _from(
            """SELECT a.alias_name, CAST(channel_rank AS INTEGER) AS channel_rank, channel_id, is_mit,
            overall_status, a.lost_amount, a.lost_payments, url
            FROM ar a JOIN top t ON t.alias_name = a.alias_name WHERE channel_rank <= 5""",
            DIGEST_AS_OF,
        ),
        "digest_messages": _from(messages, DIGEST_AS_OF),
        "csv_roundtrip": _from(detect, DIGEST_AS_OF),
        "rerun_table": _from(detect, DIGEST_AS_OF),
        "rolling_days": _each_day(detect),
        "rolling_scores": _each_day(
            f"""SELECT DATE '{{day}}' AS as_of, Anomaly_Type, alias_name, channel_id, is_mit, {_STATISTICS},
            channel_vol_share_pct, Total_Volume_Amount_Lost, Lost_Volume, ROUND(ATV, 6) AS ATV FROM scored""",
            CUSTOMER_INPUTS,
        ),
        "late_days": _from(daily, MID_DAY_AS_OF, LATE_INPUTS, upto="2024-01-28T18:00:00"),
        "kept_up_scores": _from(
            f"""SELECT Anomaly_Type, alias_name, channel_id, is_mit, {_STATISTICS}, channel_vol_share_pct,
            Total_Volume_Amount_Lost, Lost_Volume, ROUND(ATV, 6) AS ATV FROM scored""",
            "2024-01-27", KEPT_UP_INPUTS, upto="2024-01-27",
        ),
        "sliding_baseline": _from(
            f"SELECT metric AS Anomaly_Type, alias_name, channel_id, is_mit, {_BASELINE}, volume, incidents, "
            "ROUND(atv, 6) AS atv FROM channels",
            inputs=CUSTOMER_INPUTS,
            upto=AS_OF,
        ),
        "json_roundtrip": _from(
            f"""SELECT '{TARGET}' AS channel_id, STRING_AGG(message, chr(10) ORDER BY position) AS messages,
            '{DIGEST_AS_OF}' AS today FROM messages HAVING COUNT(*) > 0""",
            DIGEST_AS_OF,
        ),
    }
    for key, metric in (("ar", "AR Anomaly"), ("fraud", "Fraud Anomaly"), ("dispute", "Dispute Anomaly")):
        for name, select in _per_metric(metric).items():
            sql[f"{name}_{key}"] = _from(select)
    return sql
