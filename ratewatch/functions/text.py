"""Text rendering."""

from __future__ import annotations


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def blank_if_null(value: str) -> str:
    return f"coalesce({value}, '')"


def yes_no(flag: str) -> str:
    return f"if({flag}, 'Yes', 'No')"


def percent_encode(value: str) -> str:
    """RFC 3986 percent-encoding that leaves only unreserved characters as they are."""
    encoded = f"url_encode({value})"
    for form_style, strict in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = f"replace({encoded}, '{form_style}', '{strict}')"
    return encoded


def whole(value: str) -> str:
    """Thousands separators, fraction cut off."""
    return f"format_number(cast({value} AS bigint), 0)"


def dollars(value: str) -> str:
    """Whole dollars with thousands separators, halves to even."""
    return f"concat('$', format_number({value}, 0))"


def plain_decimal(value: str) -> str:
    """Text of a number rounded to cents, never in exponent form: 15000000.0, 12.5, 7.25."""
    return rf"regexp_replace(cast(cast({value} AS decimal(38, 2)) AS string), '([.][0-9])0$', '$1')"
