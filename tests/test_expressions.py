"""Single expressions against Python's own results."""

from __future__ import annotations

import math
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewatch import Clock
from ratewatch.functions import stats, text
from ratewatch.operators.links import linked_url


def evaluate(spark, expression, rows, columns):
    return [r[0] for r in spark.createDataFrame(rows, columns).selectExpr(f"{expression} AS x").collect()]


def test_percent_encoding_matches_python(spark):
    samples = [chr(c) for c in range(32, 127)] + ["é", "日本", "🔍", "a b+c*d~e%7E", "", 'Shop "A", Inc.', "a/b?c=d&e"]
    encoded = evaluate(spark, text.percent_encode("s"), [(s,) for s in samples], "s string")
    assert encoded == [quote(s, safe="") for s in samples]


def test_number_texts_match_python(spark):
    samples = [0.0, 0.5, 1.5, 2.5, 999.5, 1234567.89, 15_000_000.0, 1164944.49, 0.49]
    rows = [(s,) for s in samples]
    assert evaluate(spark, text.whole("x"), rows, "x double") == [f"{int(s):,}" for s in samples]
    assert evaluate(spark, text.dollars("x"), rows, "x double") == [f"${s:,.0f}" for s in samples]
    cents = [0.0, 7.25, 12.5, 300.0, 15_000_000.0, 123456789.01, 98765432.1]
    assert evaluate(spark, text.plain_decimal("x"), [(c,) for c in cents], "x double") == [repr(c) for c in cents]


@settings(max_examples=30, deadline=None)
@given(st.text(max_size=40))
def test_quoted_text_survives_sql(spark, value):
    value = value.replace("\x00", "")
    try:
        value.encode("utf-8")
    except UnicodeEncodeError:
        return
    assert spark.sql(f"SELECT {text.quoted(value)} AS x").first().x == value


@pytest.mark.parametrize(
    ("value", "mean", "std", "n", "expected"),
    [
        (0.5, 0.8, 0.2, 4, -3.0),
        (0.5, 0.8, 0.0, 4, None),
        (0.5, 0.8, None, 1, None),
        (None, 0.8, 0.2, 4, None),
        (0.5, None, 0.2, 4, None),
    ],
)
def test_t_stat(spark, value, mean, std, n, expected):
    rows = [(value, mean, std, n)]
    result = evaluate(spark, stats.t_stat("v", "m", "s", "n"), rows, "v double, m double, s double, n long")[0]
    assert result == (None if expected is None else pytest.approx(expected, abs=1e-9))


def test_min_std_silences_rounding_noise(spark):
    rows, columns = [(0.8, 0.8 - 1e-16, 1e-17, 30)], "v double, m double, s double, n long"
    assert abs(evaluate(spark, stats.t_stat("v", "m", "s", "n"), rows, columns)[0]) > 1
    assert evaluate(spark, stats.t_stat("v", "m", "s", "n", min_std=1e-12), rows, columns) == [None]


def test_clamp_keeps_null(spark):
    rows = [(-1.0,), (0.0,), (2.5,), (None,)]
    assert evaluate(spark, stats.clamp_at_zero("x"), rows, "x double") == [0.0, 0.0, 2.5, None]


def test_rounding_is_half_away_from_zero(spark):
    rows = [(0.9, 0.5, 1.0), (0.4, 0.9, 10.0), (1.0, 0.75, 10.0)]
    lost = evaluate(spark, stats.lost_units("m", "v", "n"), rows, "m double, v double, n double")
    assert lost == [0.0, 0.0, 3.0]


def test_means_do_not_depend_on_the_order_of_their_values(spark):
    values = [1 / 3, 0.1, 1e-9, 0.7, 1.0, 0.30000000000000004, 2 / 7] * 9
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    orders = [frame.repartition(n).sortWithinPartitions(F.rand(n)) for n in (1, 3, 16)]
    means = {f.selectExpr(f"{stats.mean('x')} AS m").first().m for f in orders}
    assert len(means) == 1 and abs(means.pop() - sum(values) / len(values)) < 1e-15
    assert spark.sql(f"SELECT {stats.mean('x')} AS m FROM VALUES (CAST(NULL AS double)) AS t(x)").first().m is None


def test_linked_url(spark):
    rows = [('=HYPERLINK("https://x/y?a=%22b%22","label ""q""")',), ("no link",), (None,)]
    assert evaluate(spark, linked_url("s"), rows, "s string") == ["https://x/y?a=%22b%22", "", None]


def test_clock():
    clock = Clock.at("2024-03-01T01:00:00+02:00")
    assert clock.as_of.isoformat() == "2024-02-29T23:00:00"
    assert clock.today.isoformat() == "2024-02-29" and clock.yesterday.isoformat() == "2024-02-28"
    assert clock.days_before(30).isoformat() == "2024-01-30T23:00:00"
    assert math.isclose(Clock.at(None).as_of.timestamp(), Clock.at().as_of.timestamp(), abs_tol=5)
