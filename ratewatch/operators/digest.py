"""The ranked digest: top merchants by estimated loss, with their top channels.

The steps read the anomalies twice (totals, then the channels of the few chosen
merchants); hand them a stored table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.clock import Clock
from ratewatch.functions.text import blank_if_null, dollars, quoted, whole, yes_no
from ratewatch.operators.daily import LOOKBACK_DAYS
from ratewatch.operators.links import linked_url
from ratewatch.specs import ACCEPTANCE, CRITICAL_VALUE

TOP_MERCHANTS = 5
TOP_CHANNELS = 5
MESSAGE_LIMIT = 5000

# The digest's line formats.
RULE = "━" * 40
KEYCAP = "️⃣"
SUBTITLE = "  |  Critical value: ±{critical:g}  |  Baseline: {days}-day average"
EXPLANATION = (
    " merchants** with the highest estimated processing volume impact due to acceptance rate drops"
    " vs. their historical baseline. Figures represent estimated lost payments and processing volume."
)
OVERFLOW = " more channel(s) — see CSV for full breakdown_"


@dataclass(frozen=True)
class DigestStyle:
    """Texts that belong to the installation, not to the digest format."""

    target: str = "rate-alerts"
    title: str = "🤖 **Rate Watch** — Acceptance Rate Anomaly Report"
    link_label: str = "🔍 Dashboard"
    footer: str = "_Powered by ratewatch_"


def _rows_of(anomalies: DataFrame, metric: str) -> DataFrame:
    return anomalies.where(F.col("Anomaly_Type") == metric).selectExpr(
        f"{blank_if_null('alias_name')} AS alias_name",
        "channel_id",
        "is_mit",
        f"{blank_if_null('overall_status')} AS overall_status",
        "coalesce(Total_Volume_Amount_Lost, 0D) AS lost_amount",
        "coalesce(Lost_Volume, 0D) AS lost_payments",
        f"{blank_if_null(linked_url('Link_to_Look'))} AS url",
    )


def merchant_totals(anomalies: DataFrame, metric: str = ACCEPTANCE.label) -> DataFrame:
    """Lost amount, lost payments and channel count per alias, over MIT flags and channels.

    Amounts are in cents; rounding the sum to cents keeps its order of addition
    from deciding ties.
    """
    return (
        _rows_of(anomalies, metric)
        .groupBy("alias_name")
        .agg(
            F.round(F.sum("lost_amount"), 2).alias("lost_amount"),
            F.sum("lost_payments").alias("lost_payments"),
            F.count(F.lit(1)).alias("channels"),
        )
    )


def top_merchants(anomalies: DataFrame, top: int = TOP_MERCHANTS, metric: str = ACCEPTANCE.label) -> DataFrame:
    """The ``top`` merchants by lost amount, ranked; ties go by alias.

    The cut is a distributed top-k. The unpartitioned windows that number the
    rows see only what is left of it, ``top`` rows at most.
    """
    order = [F.col("lost_amount").desc(), F.col("alias_name")]
    chosen = merchant_totals(anomalies, metric).orderBy(*order).limit(top)
    return chosen.withColumns(
        {
            "rank": F.row_number().over(Window.orderBy(*order)),
            "merchants": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )


def top_channels(
    anomalies: DataFrame, merchants: DataFrame, top: int = TOP_CHANNELS, metric: str = ACCEPTANCE.label
) -> DataFrame:
    """The ``top`` rows by lost amount of each given merchant, ranked.

    ``merchants`` is cut to a few rows by ``top_merchants``, which bounds the
    broadcast. The rank filter is applied within each task before the shuffle,
    so a merchant with very many channels sends only its best ones.
    """
    chosen = F.broadcast(merchants.select("alias_name"))
    wanted = _rows_of(anomalies, metric).join(chosen, "alias_name", "left_semi")
    order = Window.partitionBy("alias_name").orderBy(F.col("lost_amount").desc(), "is_mit", "channel_id")
    return wanted.withColumn("channel_rank", F.row_number().over(order)).where(F.col("channel_rank") <= top)


def _text(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def _lines(*lines: str) -> str:
    # concat_ws skips NULLs, so optional lines simply disappear.
    return f"concat_ws('\\n', {', '.join(lines)})"


def _channel_line(style: DigestStyle) -> str:
    link = f"if(url = '', '', {_text(quoted(' | <'), 'url', quoted(f'|{style.link_label}>'))})"
    return _text(
        quoted("• `"), blank_if_null("channel_id"), quoted("` | "),
        "overall_status", quoted(" | MIT: "), yes_no("is_mit"), quoted(" | "),
        whole("lost_payments"), quoted(" payments | **"), dollars("lost_amount"), quoted("**"),
        link,
    )


def _header(date_text: str, subtitle: str, style: DigestStyle) -> str:
    return _lines(
        quoted(style.title),
        quoted(f"📅 **{date_text}**{subtitle}"),
        "''",
        _text(quoted("Flagged **"), "merchants", quoted(EXPLANATION)),
    )


def _block(date_text: str, metric: str, style: DigestStyle) -> str:
    overflow = _text(quoted("_..."), "channels - size(lines)", quoted(OVERFLOW))
    return _lines(
        quoted(RULE),
        "''",
        # A keycap makes one sign of one digit; longer numbers get a point.
        _text(quoted("**"), "rank", f"if(rank < 10, '{KEYCAP}', '.')", quoted("  "), "alias_name", quoted("**")),
        quoted(f"> 📅 Date of Detection: **{date_text}**"),
        quoted(f"> 🔍 Anomaly Type: **{metric}**"),
        _text(quoted("> 💳 Lost Payments: **"), whole("lost_payments"), quoted("**")),
        _text(quoted("> 💰 Lost Volume Amount: **"), dollars("lost_amount"), quoted("**")),
        "''",
        quoted("**Channel Breakdown:**"),
        "lines",
        f"if(channels > size(lines), {overflow}, NULL)",
        f"if(rank = merchants, {_lines(quoted(''), quoted(RULE), quoted(style.footer))}, NULL)",
    )


def digest_messages(
    anomalies: DataFrame,
    clock: Clock,
    top: int = TOP_MERCHANTS,
    channels: int = TOP_CHANNELS,
    style: DigestStyle | None = None,
    metric: str = ACCEPTANCE.label,
    lookback_days: int = LOOKBACK_DAYS,
    critical: float = CRITICAL_VALUE,
) -> DataFrame:
    """(position, message, length, fits): a header, then one message per ranked merchant.

    Empty when the metric has no rows. ``fits`` tells whether the message stays
    within the length that chat tools accept. ``lookback_days`` and ``critical``
    are what the detection used; the header states them.
    """
    style = style or DigestStyle()
    merchants = top_merchants(anomalies, top, metric)
    ranked = top_channels(anomalies, merchants, channels, metric)
    # At most ``channels`` lines are left per merchant.
    line = F.expr(f"struct(channel_rank, {_channel_line(style)} AS line)")
    lines = ranked.groupBy("alias_name").agg(F.sort_array(F.collect_list(line)).alias("ranked"))
    blocks = merchants.join(lines, "alias_name").selectExpr("*", "ranked.line AS lines")

    date_text = f"{clock.today.day} {clock.today:%b %Y}"
    subtitle = SUBTITLE.format(critical=critical, days=lookback_days)
    header = f"struct(0 AS position, {_header(date_text, subtitle, style)} AS message)"
    block = f"struct(rank AS position, {_block(date_text, metric, style)} AS message)"
    messages = blocks.selectExpr(f"inline(if(rank = 1, array({header}, {block}), array({block})))")
    return messages.selectExpr(
        "position",
        "message",
        "char_length(message) AS length",
        f"char_length(message) <= {MESSAGE_LIMIT} AS fits",
    )


def split_messages(messages: DataFrame, limit: int = MESSAGE_LIMIT) -> DataFrame:
    """(position, part, message, length, fits, continues): every message in parts of at most ``limit`` characters.

    Whole lines are packed into a part as long as they fit. A line longer than a
    part is cut: ``continues`` tells that a part goes on within a line. So the
    parts of a position, joined by line ends, or by nothing where one continues,
    are its message.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    piece = f"struct(substr(line, at * {limit} + 1, {limit}) AS text, at > 0 AS inside)"
    pieces = f"transform(sequence(0, greatest(char_length(line) - 1, 0) div {limit}), at -> {piece})"
    lines = f"flatten(transform(split(message, '\\n', -1), line -> {pieces}))"
    # The fold holds the closed parts and the one that is being packed.
    start = "struct(slice(lines, 1, 0) AS done, lines[0].text AS text, lines[0].inside AS inside)"
    fits = f"NOT next.inside AND char_length(of.text) + 1 + char_length(next.text) <= {limit}"
    longer = "struct(of.done AS done, concat(of.text, '\\n', next.text) AS text, of.inside AS inside)"
    closed = "array_append(of.done, struct(of.text AS text, of.inside AS inside))"
    another = f"struct({closed} AS done, next.text AS text, next.inside AS inside)"
    packed = f"aggregate(slice(lines, 2, size(lines)), {start}, (of, next) -> if({fits}, {longer}, {another}), of -> {closed})"
    parts = messages.selectExpr("position", f"{lines} AS lines").selectExpr("position", f"posexplode({packed}) AS (at, of)")
    return parts.selectExpr(
        "position",
        "at + 1 AS part",
        "of.text AS message",
        "char_length(of.text) AS length",
        f"char_length(of.text) <= {limit} AS fits",
        "of.inside AS continues",
    )


def digest_document(messages: DataFrame, clock: Clock, style: DigestStyle | None = None) -> DataFrame:
    """One row {channel_id, messages, today}; no row when there are no messages.

    ``channel_id`` is the chat target. The list is bounded by the digest's size;
    it has whole messages, or the parts of split ones.
    """
    style = style or DigestStyle()
    keys = [name for name in ("position", "part") if name in messages.columns]
    ordered = F.sort_array(F.collect_list(F.struct(*keys, "message")))
    return (
        messages.agg(ordered.alias("ordered"))
        .where("size(ordered) > 0")
        .selectExpr(
            f"{quoted(style.target)} AS channel_id",
            "ordered.message AS messages",
            f"'{clock.today}' AS today",
        )
    )
