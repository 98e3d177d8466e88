"""Drill-down links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ratewatch.clock import Clock
from ratewatch.functions.text import blank_if_null, percent_encode, quoted, yes_no

DEFAULT_BASE_URL = "https://dashboards.example.com/payments"


@dataclass(frozen=True)
class LinkStyle:
    """The dashboard's filter names, percent-encoded where need be, and the link label."""

    mit_filter: str = "mit"
    alias_filter: str = "alias"
    channel_filter: str = "channel"
    #: Further filters that every link carries, such as ``&days=30``.
    fixed_filters: str = ""
    label: str = "🔍 View Channel Data "


def drill_down_url(alias: str, channel: str, is_mit: str, base_url: str, style: LinkStyle) -> str:
    """Dashboard URL for one merchant, MIT flag and channel.

    The alias is wrapped in double quotes, so a comma in it is not read as two values.
    """
    quoted_alias = f"concat('\"', {blank_if_null(alias)}, '\"')"
    parts = [
        quoted(f"{base_url}?{style.mit_filter}="),
        yes_no(is_mit),
        quoted(f"{style.fixed_filters}&{style.alias_filter}="),
        percent_encode(quoted_alias),
        quoted(f"&{style.channel_filter}="),
        percent_encode(blank_if_null(channel)),
    ]
    return f"concat({', '.join(parts)})"


def hyperlink_formula(url: str, label: str) -> str:
    """Spreadsheet link; double quotes inside the label are doubled."""
    parts = [quoted('=HYPERLINK("'), url, quoted('","'), f"replace({label}, '\"', '\"\"')", quoted('")')]
    return f"concat({', '.join(parts)})"


def linked_url(formula: str) -> str:
    """The URL inside a link formula; blank when there is none."""
    pattern = quoted(r'HYPERLINK\("([^"]+)"')
    return f"regexp_extract({formula}, {pattern}, 1)"


def with_links(
    anomalies: DataFrame, clock: Clock | None, base_url: str = DEFAULT_BASE_URL, style: LinkStyle | None = None
) -> DataFrame:
    """Adds ``Date_of_Detection`` and ``Link_to_Look``; without a clock, rows have their date already."""
    style = style or LinkStyle()
    url = drill_down_url("alias_name", "channel_id", "is_mit", base_url, style)
    label = f"concat({quoted(style.label)}, {blank_if_null('alias_name')})"
    return anomalies.selectExpr(
        "*",
        *([f"'{clock.today}' AS Date_of_Detection"] if clock is not None else []),
        f"{hyperlink_formula(url, label)} AS Link_to_Look",
    )
